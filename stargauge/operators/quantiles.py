"""Quantiles by mergeable sketches of a stated size, beside the exact median.

A KLL sketch (Karnin, Lang, Liberty 2016) keeps a bounded number of values whatever it has seen. Sketches are
built map-side, merge like sums, and can be stored per day or key and merged later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 4096


def rank_error(size: int = SIZE) -> float:
    """Bound on the error of a quantile's rank, as a share of all values, in 99 of 100 cases."""
    return 2.296 / size**0.9021


def quantile_sketches(df: DataFrame, column: str, by: list[str] | None = None, size: int = SIZE) -> DataFrame:
    """``by, sketch``: one sketch of the column per group; nulls and NaN are left out."""
    value = F.col(column).cast("double")
    known = F.when(~F.isnan(value), value)
    return df.groupBy(*(by or [])).agg(F.kll_sketch_agg_double(known, size).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: list[str] | None = None, size: int = SIZE) -> DataFrame:
    """Sketches of finer groups merged into those of ``by``."""
    return sketches.groupBy(*(by or [])).agg(F.kll_merge_agg_double("sketch", size).alias("sketch"))


def quantiles(sketches: DataFrame, shares: dict[str, float]) -> DataFrame:
    """One column per name: the least value that at least that share of the values does not exceed.

    Null where a sketch has seen no value.
    """
    some = F.kll_sketch_get_n_double("sketch") > 0
    cells = [
        F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(s)))).alias(n) for n, s in shares.items()
    ]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], *cells)


def approximate_quantiles(df: DataFrame, column: str, shares: dict[str, float], size: int = SIZE) -> dict[str, float | None]:
    """Quantiles of a whole column as a small dict."""
    return quantiles(quantile_sketches(df, column, size=size), shares).first().asDict()
