"""DuckDB SQL for the registered queries, over the same parquet tables."""

from __future__ import annotations

from itertools import combinations

from .formula import forward_pass

# The genres that occur in the test tables, sorted.
GENRES = [
    "anvil", "blue", "bolt", "cold", "gear", "gizmo", "hot", "large",
    "new", "old", "plate", "red", "ring", "rod", "small", "widget",
]

VIEWS = {
    "movies": """
        SELECT p_partkey AS movieId,
               concat(p_name, ' (', cast(1950 + p_size AS varchar), ')') AS title,
               CASE WHEN p_partkey % 23 = 0 THEN '(no genres listed)'
                    WHEN p_size % 3 = 0 THEN split_part(p_name, ' ', 1)
                    ELSE replace(p_name, ' ', '|') END AS genres
        FROM part""",
    "ratings_e": """
        SELECT event_id AS row_id, user_id AS userId,
               cast(json_extract_string(props, '$.k') AS bigint) AS movieId,
               cast(0.5 AS double) * (1 + cast(floor(value) AS bigint) % 10) AS rating,
               cast(floor(epoch(ts)) AS bigint) AS timestamp
        FROM events""",
    "ratings_l": """
        SELECT o_custkey AS userId, l_partkey AS movieId,
               cast(0.5 AS double) * (1 + (cast(l_quantity AS bigint) - 1) % 10) AS rating,
               cast(floor(epoch(l_shipdate)) AS bigint) AS timestamp
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "kept_movies": "SELECT * FROM movies WHERE genres IS DISTINCT FROM '(no genres listed)'",
    "prep_e": """
        SELECT r.*, m.genres FROM ratings_e r JOIN kept_movies m ON r.movieId = m.movieId""",
    "prep_l": """
        SELECT r.*, m.genres FROM ratings_l r JOIN kept_movies m ON r.movieId = m.movieId""",
    "split_e": """
        SELECT *, CASE WHEN cast('0x' || substr(md5(concat_ws('|', row_id, 42)), 1, 8) AS bigint) < 0.2 * 4294967296
                       THEN 'test' ELSE 'train' END AS split
        FROM prep_e""",
    "base_pred": """
        SELECT r.*, g.global_mean,
               coalesce(u.m, g.global_mean) AS user_mean, coalesce(i.m, g.global_mean) AS movie_mean,
               least(greatest(coalesce(u.m, g.global_mean) + coalesce(i.m, g.global_mean)
                              - g.global_mean, 0.5), 5.0) AS blend
        FROM split_e r
        LEFT JOIN (SELECT userId, avg(rating) AS m FROM split_e WHERE split = 'train' GROUP BY 1) u
               ON r.userId = u.userId
        LEFT JOIN (SELECT movieId, avg(rating) AS m FROM split_e WHERE split = 'train' GROUP BY 1) i
               ON r.movieId = i.movieId
        CROSS JOIN (SELECT avg(rating) AS global_mean FROM split_e WHERE split = 'train') g""",
    "long_pred": """
        SELECT split, rating, 'global_mean' AS model, 0 AS position, global_mean AS prediction FROM base_pred
        UNION ALL SELECT split, rating, 'user_mean', 1, user_mean FROM base_pred
        UNION ALL SELECT split, rating, 'movie_mean', 2, movie_mean FROM base_pred
        UNION ALL SELECT split, rating, 'blend', 3, blend FROM base_pred""",
    "wide_metrics": """
        SELECT model, position, split, sqrt(avg((rating - prediction) ** 2)) AS rmse,
               avg(abs(rating - prediction)) AS mae,
               1 - sum((rating - prediction) ** 2) / sum((rating - y_mean) ** 2) AS r2,
               avg(abs((rating - prediction) / (rating + 1e-8::double))) * 100 AS mape,
               avg((rating - prediction) ** 2) AS mse, count(*) AS n
        FROM (SELECT *, avg(rating) OVER (PARTITION BY model, split) AS y_mean FROM long_pred)
        GROUP BY 1, 2, 3""",
    "metric_rows": """
        SELECT model, position, split, 'rmse' AS metric, rmse AS value FROM wide_metrics
        UNION ALL SELECT model, position, split, 'mae', mae FROM wide_metrics
        UNION ALL SELECT model, position, split, 'r2', r2 FROM wide_metrics
        UNION ALL SELECT model, position, split, 'mape', mape FROM wide_metrics""",
    "ranked": """
        SELECT *, row_number() OVER (
                   PARTITION BY metric
                   ORDER BY CASE WHEN metric = 'r2' THEN -value ELSE value END, position) AS place
        FROM metric_rows WHERE split = 'test'""",
}

NEEDS = {
    "kept_movies": ["movies"],
    "prep_e": ["ratings_e", "kept_movies"],
    "prep_l": ["ratings_l", "kept_movies"],
    "split_e": ["prep_e"],
    "base_pred": ["split_e"],
    "long_pred": ["base_pred"],
    "wide_metrics": ["long_pred"],
    "metric_rows": ["wide_metrics"],
    "ranked": ["metric_rows"],
}

TS = "cast(make_timestamp(timestamp * 1000000) AS timestamp)"
HOUR = f"hour({TS})"
WEEKDAY = f"(isodow({TS}) - 1)"
MONTH = f"month({TS})"


def _closure(names: list[str]) -> list[str]:
    """The views ``names`` need, in the order of their definition."""
    wanted: set[str] = set()
    stack = list(names)
    while stack:
        name = stack.pop()
        if name not in wanted:
            wanted.add(name)
            stack += NEEDS.get(name, [])
    return [v for v in VIEWS if v in wanted]


def sql(select: str, *uses: str, **extra: str) -> str:
    """``select`` preceded by the views it uses and the extra named subqueries."""
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in _closure(list(uses))]
    parts += [f"{name} AS ({body.strip()})" for name, body in extra.items()]
    return f"WITH {', '.join(parts)} {select.strip()}" if parts else select.strip()


def r6(expression: str, name: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) AS {name}"


def big(expression: str, name: str) -> str:
    return f"cast({expression} AS bigint) AS {name}"


def token(genre: str, column: str = "genres") -> str:
    return f"list_contains(string_split({column}, '|'), '{genre}')"


def key_stats(key: str, prefix: str, std: str, source: str) -> str:
    return (
        f"SELECT {key}, avg(rating) AS {prefix}_avg_rating, "
        f"coalesce(stddev_samp(rating), 0) AS {std}, count(rating) AS {prefix}_rating_count "
        f"FROM {source} GROUP BY {key}"
    )


def rounded_stats(prefix: str, std: str) -> str:
    return ", ".join(
        [
            r6(f"{prefix}_avg_rating", f"{prefix}_avg_rating"),
            r6(std, std),
            big(f"{prefix}_rating_count", f"{prefix}_rating_count"),
        ]
    )


def profile_means(digits: int | None = 6) -> list[str]:
    pairs = [(f"user_dow_{i}_avg", f"{WEEKDAY} = {i}") for i in range(7)]
    pairs += [(f"user_month_{i}_avg", f"{MONTH} = {i}") for i in range(1, 13)]
    return [_mean(name, test, digits) for name, test in pairs]


def _mean(name: str, test: str, digits: int | None) -> str:
    value = f"coalesce(avg(rating) FILTER (WHERE {test}), 0)"
    return r6(value, name, digits) if digits is not None else f"{value} AS {name}"


def preferences(kind: str, digits: int | None = 6) -> list[str]:
    out = []
    for genre in GENRES:
        test = f"contains(genres, '{genre}')" if kind == "substring" else token(genre)
        value = (
            f"coalesce(sum(rating) FILTER (WHERE {test}), 0) "
            f"/ (count(*) FILTER (WHERE {test}) + 1e-6::double)"
        )
        name = f"user_{genre}_preference"
        out.append(r6(value, name, digits) if digits is not None else f"{value} AS {name}")
    return out


PREFERENCE_NAMES = [f"user_{g}_preference" for g in GENRES]

# --- the base features of the neural and the linear recipe ------------------------------------------

MEAN_NAMES = [
    "user_avg_rating", "user_std_rating", "user_rating_count",
    "movie_avg_rating", "movie_std_rating", "movie_rating_count",
    *[f"genre_{g}" for g in GENRES],
    "rating_hour", "rating_dayofweek", "user_movie_avg_interaction",
]

MEAN_FEATURES = {
    "us": key_stats("userId", "user", "user_std_rating", "prep_e"),
    "ms": key_stats("movieId", "movie", "movie_std_rating", "prep_e"),
    "base": f"""
        SELECT r.row_id, r.rating,
               user_avg_rating, user_std_rating, cast(user_rating_count AS double) AS user_rating_count,
               movie_avg_rating, movie_std_rating, cast(movie_rating_count AS double) AS movie_rating_count,
               {", ".join(f"cast({token(g)} AS double) AS genre_{g}" for g in GENRES)},
               cast({HOUR} AS double) AS rating_hour, cast({WEEKDAY} AS double) AS rating_dayofweek,
               user_avg_rating * movie_avg_rating AS user_movie_avg_interaction
        FROM prep_e r JOIN us ON r.userId = us.userId JOIN ms ON r.movieId = ms.movieId""",
}


def scaled(names: list[str], source: str) -> dict[str, str]:
    """Subqueries ``mo`` (moments) and ``sc`` (scaled columns, keys kept)."""
    moments = ", ".join(f"avg({n}) AS m_{n}, stddev_pop({n}) AS s_{n}" for n in names)
    cells = ", ".join(
        f"({n} - m_{n}) / CASE WHEN s_{n} < 1e-12 THEN 1 ELSE s_{n} END AS {n}" for n in names
    )
    return {
        "mo": f"SELECT {moments} FROM {source}",
        "sc": f"SELECT row_id, rating, {cells} FROM {source} CROSS JOIN mo",
    }


def mlp_features() -> str:
    cells = ", ".join(r6(n, n) for n in MEAN_NAMES)
    return sql(
        f"SELECT row_id, round(rating, 6) AS rating, {cells} FROM sc",
        "prep_e", **MEAN_FEATURES, **scaled(MEAN_NAMES, "base"),
    )


def linear_features() -> str:
    pairs = list(combinations(MEAN_NAMES, 2))
    names = [f"x{i}" for i in range(len(MEAN_NAMES) + len(pairs))]
    values = MEAN_NAMES + [f"{a} * {b}" for a, b in pairs]
    wide = ", ".join(f"{v} AS {n}" for v, n in zip(values, names))
    weighted = " + ".join(f"{i + 1} * {n}" for i, n in enumerate(names))
    squares = " + ".join(f"{n} * {n}" for n in names)
    return sql(
        f"""SELECT row_id, rating, cast({len(names)} AS bigint) AS n_features,
                   round({weighted}, 4) AS weighted_sum, round({squares}, 4) AS square_sum FROM sc""",
        "prep_e", **MEAN_FEATURES, wide=f"SELECT row_id, rating, {wide} FROM base", **scaled(names, "wide"),
    )


GENRE_ROWS = "SELECT row_id, movieId, unnest(list_distinct(string_split(genres, '|'))) AS genre FROM prep_e"


def genre_places() -> str:
    return sql(
        """SELECT r.row_id, coalesce(string_agg(cast(place AS varchar), ',' ORDER BY place), '') AS places
           FROM prep_e r LEFT JOIN t ON r.row_id = t.row_id LEFT JOIN v ON t.genre = v.genre GROUP BY 1""",
        "prep_e",
        t=GENRE_ROWS,
        v="""SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS place
             FROM (SELECT DISTINCT genre FROM t WHERE movieId % 2 = 0)""",
    )


def sparse_features() -> str:
    names = [n for n in MEAN_NAMES if not n.startswith("genre_")]
    weighted = " + ".join(f"{i + 1} * {n}" for i, n in enumerate(names))
    squares = " + ".join(f"{n} * {n}" for n in names)
    return sql(
        f"""SELECT sc.row_id, (SELECT count(*) FROM v) + {len(names)} AS width, {len(names)} + e.n AS entries,
                   round({weighted} + e.w, 4) AS weighted_sum, round({squares} + e.s, 4) AS square_sum
            FROM sc JOIN e ON sc.row_id = e.row_id""",
        "prep_e", **MEAN_FEATURES, **scaled(names, "base"),
        t=GENRE_ROWS,
        v="""SELECT genre, row_number() OVER (ORDER BY genre) AS place,
                    1 / sqrt(count(*) / (SELECT count(*) FROM prep_e) * (1 - count(*) / (SELECT count(*) FROM prep_e))) AS weight
             FROM t GROUP BY 1""",
        e=f"""SELECT row_id, count(*) AS n, sum(({len(names)} + place) * weight) AS w, sum(weight * weight) AS s
              FROM t JOIN v ON t.genre = v.genre GROUP BY 1""",
    )


def forest_features() -> str:
    flags = ", ".join(r6(f"cast({token(g)} AS double)", f"genre_{g}") for g in GENRES)
    return sql(
        f"""SELECT row_id, r.rating, {_doubles("user", "user_rating_std")},
                   {_doubles("movie", "movie_rating_std")}, {flags},
                   cast(len(list_distinct(string_split(genres, '|'))) AS double) AS num_genres,
                   {r6("r.rating - user_avg_rating", "user_rating_deviation")},
                   {r6("r.rating - movie_avg_rating", "movie_rating_deviation")}
            FROM prep_e r JOIN us ON r.userId = us.userId JOIN ms ON r.movieId = ms.movieId""",
        "prep_e",
        us=key_stats("userId", "user", "user_rating_std", "prep_e"),
        ms=key_stats("movieId", "movie", "movie_rating_std", "prep_e"),
    )


def _doubles(prefix: str, std: str) -> str:
    return ", ".join(
        [
            r6(f"{prefix}_avg_rating", f"{prefix}_avg_rating"),
            f"cast({prefix}_rating_count AS double) AS {prefix}_rating_count",
            r6(std, std),
        ]
    )


def boosting_features() -> str:
    parts = {
        "rating_month": MONTH,
        "rating_day": f"day({TS})",
        "rating_hour": HOUR,
        "rating_dayofweek": WEEKDAY,
        "rating_quarter": f"quarter({TS})",
        "rating_year": f"year({TS})",
    }
    time = ", ".join(f"cast({e} AS double) AS {n}" for n, e in parts.items())
    profile = [f"user_dow_{i}_avg" for i in range(7)] + [f"user_month_{i}_avg" for i in range(1, 13)]
    looked_up = profile + PREFERENCE_NAMES
    flags = ", ".join(f"cast({token(g)} AS double) AS genre_{g}" for g in GENRES)
    means = [
        "user_avg_rating", "movie_avg_rating", "user_rating_std", "movie_rating_std",
        "user_rating_rolling_5", "user_rating_rolling_10",
    ]
    return sql(
        f"""SELECT row_id, r.rating, {time}, {", ".join(r6(n, n) for n in looked_up + means)}, {flags},
                   cast(movie_popularity AS double) AS movie_popularity,
                   cast(user_activity AS double) AS user_activity
            FROM rolled r JOIN us ON r.userId = us.userId JOIN ms ON r.movieId = ms.movieId""",
        "prep_e",
        us=f"""SELECT userId, count(*) AS user_activity, avg(rating) AS user_avg_rating,
                      coalesce(stddev_samp(rating), 0) AS user_rating_std,
                      {", ".join(profile_means(None) + preferences("substring", None))}
               FROM prep_e GROUP BY userId""",
        ms="""SELECT movieId, count(*) AS movie_popularity, avg(rating) AS movie_avg_rating,
                     coalesce(stddev_samp(rating), 0) AS movie_rating_std
              FROM prep_e GROUP BY movieId""",
        rolled=f"SELECT *, {rolling(5, 0)} AS user_rating_rolling_5, "
               f"{rolling(10, 0)} AS user_rating_rolling_10 FROM prep_e",
    )


def rolling(size: int, shift: int) -> str:
    end = "CURRENT ROW" if shift == 0 else f"{shift} PRECEDING"
    return (
        "avg(rating) OVER (PARTITION BY userId ORDER BY timestamp, row_id "
        f"ROWS BETWEEN {size - 1 + shift} PRECEDING AND {end})"
    )


def rolling_query(sizes: list[int], shift: int) -> str:
    cells = ", ".join(r6(rolling(n, shift), f"user_rating_rolling_{n}") for n in sizes)
    return sql(f"SELECT row_id, userId, {cells} FROM prep_e", "prep_e")


def bias(source: str, group: str, name: str, join: str = "") -> str:
    return f"""
        SELECT {group} AS {name}, {r6("avg(r.rating - r.blend)", "mean_bias")},
               {r6("avg(abs(r.rating - r.blend))", "mean_abs_bias")},
               {r6("sqrt(avg((r.rating - r.blend) ** 2))", "rmse")}, count(*) AS n
        FROM {source} r {join} GROUP BY 1"""


def sized_bias(key: str, cases: str, where: str = "") -> str:
    join = f"LEFT JOIN (SELECT {key}, count(*) AS size FROM base_pred {where} GROUP BY 1) s ON r.{key} = s.{key}"
    return sql(bias("base_pred", f"CASE {cases} END", "segment", join), "base_pred")


def network_scores(select: str) -> str:
    return sql(select, "prep_e", **MEAN_FEATURES, **scaled(MEAN_NAMES, "base"), **forward_pass(MEAN_NAMES, "sc"))


def carried(where: str, *uses: str, **extra: str) -> str:
    cells = ", ".join(r6(rolling(n, 0), f"user_rating_rolling_{n}") for n in (5, 10))
    return sql(f"SELECT row_id, user_rating_rolling_5, user_rating_rolling_10 FROM w WHERE {where}", *uses,
               w=f"SELECT *, {cells} FROM {uses[0]}", **extra)


STUMP_NAMES = ["rating_hour", "rating_dayofweek", "rating_month", "num_genres"]
#: Every split between neighbouring values of a feature, the best one first.
STUMP = {
    "t": f"""SELECT row_id, rating, unnest(['rating_hour', 'rating_dayofweek', 'rating_month', 'num_genres']) AS feature,
                    unnest([{HOUR}, {WEEKDAY}, {MONTH}, len(list_distinct(string_split(genres, '|')))]) AS x FROM prep_e""",
    "c": "SELECT feature, x, count(*) AS n, sum(rating) AS s FROM t GROUP BY 1, 2",
    "l": """SELECT feature, x, sum(n) OVER w AS nl, sum(s) OVER w AS sl, sum(n) OVER p - sum(n) OVER w AS nr,
                   sum(s) OVER p - sum(s) OVER w AS sr
            FROM c WINDOW w AS (PARTITION BY feature ORDER BY x), p AS (PARTITION BY feature)""",
    "best": """SELECT feature, nl, sl, nr, sr FROM l WHERE nl >= 2 AND nr >= 2
               ORDER BY sl * sl / nl + sr * sr / nr DESC LIMIT 1""",
}


def evaluated() -> str:
    """Least squares on one and on two means, by their closed forms, measured on both sides."""
    rows = " UNION ALL ".join(
        f"SELECT model, split || '_{m}' AS key, round({m}, 5) AS value FROM m" for m in [*SUMMARY, "n"]
    )
    return sql(
        f"""SELECT 'stored' AS run, model, 'metric' AS kind, key, value, cast(NULL AS varchar) AS text FROM ({rows})
            UNION ALL SELECT 'stored', model, 'param', 'features', features, NULL
            FROM (VALUES ('both_means', 2.0::double), ('user_mean', 1.0::double)) AS f(model, features)
            UNION ALL SELECT 'stored', model, 'status', key, NULL, text
            FROM (VALUES ('both_means', 'ok', NULL), ('user_mean', 'ok', NULL),
                         ('never_stored', 'error', 'Model not found')) AS s(model, key, text)""",
        "base_pred",
        s="""SELECT avg(rating) AS my, avg(user_mean) AS m1, avg(movie_mean) AS m2, var_pop(user_mean) AS s11,
                    var_pop(movie_mean) AS s22, covar_pop(user_mean, movie_mean) AS s12,
                    covar_pop(user_mean, rating) AS s1y, covar_pop(movie_mean, rating) AS s2y
             FROM base_pred WHERE split = 'train'""",
        b="""SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
                    (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2, s1y / s11 AS b0 FROM s""",
        p="""SELECT 'both_means' AS model, split, rating, my + b1 * (user_mean - m1) + b2 * (movie_mean - m2) AS prediction
             FROM base_pred, b
             UNION ALL SELECT 'user_mean', split, rating, my + b0 * (user_mean - m1) FROM base_pred, b""",
        m="""SELECT model, split, sqrt(avg((rating - prediction) ** 2)) AS rmse, avg(abs(rating - prediction)) AS mae,
                    1 - sum((rating - prediction) ** 2) / sum((rating - y) ** 2) AS r2,
                    avg(abs((rating - prediction) / (rating + 1e-8::double))) * 100 AS mape,
                    avg((rating - prediction) ** 2) AS mse, count(*)::double AS n
             FROM (SELECT *, avg(rating) OVER (PARTITION BY model, split) AS y FROM p) GROUP BY 1, 2""",
    )


LOW_RANK = """
    SELECT userId, kind + 4 * turn AS movieId, mean * (turn + 0.7310585::double) AS rating
    FROM (SELECT userId, movieId % 4 AS kind, avg(rating) AS mean FROM prep_e GROUP BY 1, 2),
         (SELECT unnest(range(3)) AS turn)"""

SUMMARY = ["rmse", "mae", "r2", "mape", "mse"]
MODEL_METRICS = ["rmse", "mae", "r2", "mape"]


def model_comparison() -> str:
    cells = []
    for m in MODEL_METRICS:
        cells.append(r6(f"max(value) FILTER (WHERE metric = '{m}')", m))
        cells.append(f"bool_or(metric = '{m}' AND place = 1) AS {m}_best")
    return sql(
        f"SELECT model, cast(position AS bigint) AS position, {', '.join(cells)} FROM ranked GROUP BY 1, 2",
        "ranked",
    )


def run_log() -> str:
    return sql(
        """SELECT 'baseline' AS run, model, 'status' AS kind, 'ok' AS key,
                  cast(NULL AS double) AS value, cast(NULL AS varchar) AS text
           FROM wide_metrics WHERE split = 'test'
           UNION ALL SELECT 'baseline', model, 'param', p.key, p.value, p.text
           FROM (SELECT model FROM wide_metrics WHERE split = 'test'),
                (VALUES ('seed', 42.0::double, NULL), ('test_size', 0.2::double, NULL),
                        ('keys', NULL, '[''row_id'']')) AS p(key, value, text)
           UNION ALL SELECT 'baseline', model, 'metric', split || '_' || metric, round(value, 6), NULL
           FROM metric_rows""",
        "wide_metrics", "metric_rows",
    )


def two_scaled() -> str:
    names = ["userId", "movieId", "rating", "timestamp"]
    cells = ", ".join(
        r6(f"({n} - avg({n}) OVER ()) / stddev_pop({n}) OVER ()", f"{n}_scaled") for n in names
    )
    return sql(f"SELECT row_id, {cells} FROM prep_e", "prep_e")


def pair_products() -> str:
    names = ["rating", "h", "d", "g"]
    values = names + [f"{a} * {b}" for a, b in combinations(names, 2)]
    cells = ", ".join(r6(f"cast({v} AS double)", f"x{i}") for i, v in enumerate(values))
    return sql(
        f"SELECT row_id, {cells} FROM t", "prep_e",
        t=f"""SELECT row_id, rating, {HOUR} AS h, {WEEKDAY} AS d,
                     len(list_distinct(string_split(genres, '|'))) AS g FROM prep_e""",
    )


def lookups() -> str:
    names = ["user_avg_rating", "user_rating_std", *PREFERENCE_NAMES, "movie_avg_rating", "movie_rating_std"]
    return sql(
        f"""SELECT r.userId, r.movieId, r.rating, r.timestamp, r.genres,
                   {big("coalesce(user_activity, 0)", "user_activity")},
                   {big("coalesce(movie_popularity, 0)", "movie_popularity")},
                   {", ".join(r6(f"coalesce({n}, 0)", n) for n in names)}
            FROM prep_l r LEFT JOIN us ON r.userId = us.userId LEFT JOIN ms ON r.movieId = ms.movieId""",
        "prep_e", "prep_l",
        us=f"""SELECT userId, count(*) AS user_activity, avg(rating) AS user_avg_rating,
                      coalesce(stddev_samp(rating), 0) AS user_rating_std,
                      {", ".join(preferences("substring", None))} FROM prep_e GROUP BY userId""",
        ms="""SELECT movieId, count(*) AS movie_popularity, avg(rating) AS movie_avg_rating,
                     coalesce(stddev_samp(rating), 0) AS movie_rating_std FROM prep_e GROUP BY movieId""",
    )


def cold_start_fill() -> str:
    cells = []
    for side in ("user", "movie"):
        cells.append(r6(f"coalesce({side}_avg_rating, g.m)", f"{side}_avg_rating"))
        cells.append(r6(f"coalesce({side}_std_rating, 0)", f"{side}_std_rating"))
        cells.append(
            f"cast(coalesce({side}_rating_count, 1) AS double) AS {side}_rating_count"
        )
    return sql(
        f"""SELECT r.userId, r.movieId, r.rating, r.timestamp, r.genres, {", ".join(cells)}
            FROM prep_l r LEFT JOIN us ON r.userId = us.userId LEFT JOIN ms ON r.movieId = ms.movieId
            CROSS JOIN g""",
        "prep_e", "prep_l",
        us=key_stats("userId", "user", "user_std_rating", "prep_e"),
        ms=key_stats("movieId", "movie", "movie_std_rating", "prep_e"),
        g="SELECT avg(rating) AS m FROM prep_e",
    )


def group_columns(key: str, side: str) -> str:
    over = f"OVER (PARTITION BY {key})"
    mean = r6(f"avg(rating) {over}", f"{side}_avg_rating")
    return mean + ", " + r6(f"coalesce(stddev_samp(rating) {over}, 0)", f"{side}_rating_std")


def kfold_metrics(folds: int = 5) -> str:
    """Least squares on the means of the other folds, from the closed form for two features."""

    def means(key: str) -> str:
        return f"""SELECT {key}, f, sum(s) FILTER (WHERE fold <> f) / nullif(sum(n) FILTER (WHERE fold <> f), 0) AS m
                   FROM (SELECT {key}, fold, sum(rating) AS s, count(rating) AS n FROM k GROUP BY 1, 2), h GROUP BY 1, 2"""

    return sql(
        f"""SELECT cast(fold AS bigint) AS fold, {r6("sqrt(avg((rating - p) ** 2))", "rmse")},
                   {r6("avg(abs(rating - p))", "mae")},
                   {r6("1 - sum((rating - p) ** 2) / sum((rating - y) ** 2)", "r2")},
                   {r6("avg(abs((rating - p) / (rating + 1e-8::double))) * 100", "mape")},
                   {r6("avg((rating - p) ** 2)", "mse")}, count(*) AS n
            FROM (SELECT x.fold, rating, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p, avg(rating) OVER (PARTITION BY x.fold) AS y
                  FROM x JOIN b ON x.f = b.f WHERE x.fold = x.f) GROUP BY 1""",
        "prep_e",
        k=f"""SELECT *, cast('0x' || substr(md5(concat_ws('|', row_id, 42)), 1, 8) AS bigint) % {folds} AS fold FROM prep_e""",
        h=f"SELECT unnest(range({folds})) AS f",
        g="SELECT f, avg(rating) AS m FROM k, h WHERE fold <> f GROUP BY 1",
        u=means("userId"),
        i=means("movieId"),
        x="""SELECT k.fold, g.f, rating, coalesce(u.m, g.m) AS x1, coalesce(i.m, g.m) AS x2
             FROM k CROSS JOIN g LEFT JOIN u ON k.userId = u.userId AND g.f = u.f
             LEFT JOIN i ON k.movieId = i.movieId AND g.f = i.f""",
        b="""SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
                    (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2
             FROM (SELECT f, avg(rating) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS s11, var_pop(x2) AS s22,
                          covar_pop(x1, x2) AS s12, covar_pop(x1, rating) AS s1y, covar_pop(x2, rating) AS s2y
                   FROM x WHERE fold <> f GROUP BY f)""",
    )


def with_stats(cells: str) -> str:
    return sql(
        f"""SELECT row_id, {cells} FROM prep_e r
            JOIN (SELECT userId, avg(rating) AS ua FROM prep_e GROUP BY 1) u ON r.userId = u.userId
            JOIN (SELECT movieId, avg(rating) AS ma FROM prep_e GROUP BY 1) m ON r.movieId = m.movieId""",
        "prep_e",
    )


PREDICTION_OUTPUT = f"""
    SELECT {r6("blend", "predicted_rating")}, userId, movieId, timestamp, rating AS actual_rating,
           {r6("abs(blend - rating)", "error")}, row_id AS original_index FROM base_pred"""


def oracle_sql() -> dict[str, str]:
    count = "count({0}) AS {0}"
    profiled = ["row_id", "userId", "movieId", "rating", "timestamp", "genres"]
    types = dict(zip(profiled, ["bigint", "bigint", "bigint", "double", "bigint", "string"]))
    left_join = """
        SELECT r.*, m.genres FROM ratings_e r LEFT JOIN kept_movies m ON r.movieId = m.movieId"""
    year = r"try_cast(nullif(regexp_extract(title, '\((\d{4})\)', 1), '') AS bigint)"
    targets = "(VALUES ('rmse', '<', 0.7::double), ('mae', '<', 0.5::double), ('r2', '>', 0.4::double)) AS t(metric, relation, target)"
    return {
        "scan_ratings": sql("SELECT userId, movieId, rating, timestamp FROM ratings_e", "ratings_e"),
        "scan_movies": sql(
            """SELECT movieId, genres, CASE WHEN movieId % 5 = 0 THEN 'Say "' || title || '", twice'
                                            WHEN movieId % 7 = 0 THEN ''
                                            WHEN movieId % 11 <> 0 THEN title END AS title FROM movies""",
            "movies",
        ),
        "feature_table": mlp_features(),
        "profile": sql(
            " UNION ALL ".join(
                f"SELECT '{c}' AS column_name, '{types[c]}' AS data_type, {c} AS non_null, n AS row_count FROM c"
                for c in profiled
            ),
            "ratings_e", "kept_movies",
            c=f"SELECT count(*) AS n, {', '.join(count.format(c) for c in profiled)} FROM ({left_join})",
        ),
        "filter_sentinel": sql("SELECT * FROM kept_movies", "kept_movies"),
        "align_unseen": sql(
            f"""SELECT *, {", ".join(big(token(g), f"genre_{g}") for g in ["blue", "cold", "old", "vintage"])}
                FROM prep_l""",
            "prep_l",
        ),
        "cold_start_fill": cold_start_fill(),
        "preprocess_join": sql("SELECT * FROM prep_l", "prep_l"),
        "preprocess_left": sql(left_join, "ratings_e", "kept_movies"),
        "attach_user_stats": sql(
            f"""SELECT r.*, {rounded_stats("user", "user_std_rating")}
                FROM prep_l r JOIN us ON r.userId = us.userId""",
            "prep_l", us=key_stats("userId", "user", "user_std_rating", "prep_l"),
        ),
        "attach_movie_stats": sql(
            f"""SELECT r.*, {rounded_stats("movie", "movie_std_rating")}
                FROM prep_l r JOIN ms ON r.movieId = ms.movieId""",
            "prep_l", ms=key_stats("movieId", "movie", "movie_std_rating", "prep_l"),
        ),
        "attach_user_profile": sql(
            "SELECT r.*, p.* EXCLUDE (userId) FROM prep_e r JOIN p ON r.userId = p.userId",
            "prep_e", p=f"SELECT userId, {', '.join(profile_means())} FROM prep_e GROUP BY 1",
        ),
        "attach_lookups": lookups(),
        "provenance_join": sql(
            """SELECT p.* EXCLUDE (row_id), o.original_index, coalesce(o.n, 0) AS original_matches
               FROM prep_e p LEFT JOIN (
                   SELECT userId, movieId, timestamp, min(row_id) AS original_index, count(*) AS n
                   FROM ratings_e GROUP BY 1, 2, 3) o
               ON p.userId = o.userId AND p.movieId = o.movieId AND p.timestamp = o.timestamp""",
            "prep_e",
        ),
        "provenance_fan_out": sql(
            """SELECT p.* EXCLUDE (row_id), o.row_id AS original_index FROM prep_e p LEFT JOIN (
                   SELECT userId, movieId, timestamp, row_id FROM ratings_e
                   UNION ALL SELECT userId, movieId, timestamp, -row_id - 1 FROM ratings_e WHERE row_id % 3 = 0) o
               ON p.userId = o.userId AND p.movieId = o.movieId AND p.timestamp = o.timestamp""",
            "prep_e",
        ),
        "kept_rows": sql("SELECT row_id FROM prep_e", "prep_e"),
        "user_stats": sql(
            f"SELECT userId, {rounded_stats('user', 'user_std_rating')} FROM us",
            "prep_l", us=key_stats("userId", "user", "user_std_rating", "prep_l"),
        ),
        "movie_stats": sql(
            f"SELECT movieId, {rounded_stats('movie', 'movie_rating_std')} FROM ms",
            "prep_l", ms=key_stats("movieId", "movie", "movie_rating_std", "prep_l"),
        ),
        "global_mean": sql(f"SELECT {r6('avg(rating)', 'global_mean')} FROM prep_l", "prep_l"),
        "popularity_activity": sql(
            """SELECT 'movie_popularity' AS kind, movieId AS key, count(*) AS n FROM prep_l GROUP BY movieId
               UNION ALL SELECT 'user_activity', userId, count(*) FROM prep_l GROUP BY userId""",
            "prep_l",
        ),
        "user_dow_profile": sql(
            f"SELECT userId, {', '.join(profile_means()[:7])} FROM prep_l GROUP BY userId", "prep_l"
        ),
        "user_month_profile": sql(
            f"SELECT userId, {', '.join(profile_means()[7:])} FROM prep_l GROUP BY userId", "prep_l"
        ),
        "user_genre_pref": sql(
            f"SELECT userId, {', '.join(preferences('substring'))} FROM prep_l GROUP BY userId", "prep_l"
        ),
        "user_genre_pref_token": sql(
            f"SELECT userId, {', '.join(preferences('token'))} FROM prep_l GROUP BY userId", "prep_l"
        ),
        "user_genre_pref_long": sql(
            f"""SELECT userId, genre, {r6("sum(rating) / (count(*) + 1e-6::double)", "preference")}
                FROM (SELECT userId, rating, unnest(list_distinct(string_split(genres, '|'))) AS genre FROM prep_l)
                GROUP BY 1, 2""",
            "prep_l",
        ),
        "user_item_mean": sql(
            f"SELECT userId, movieId, {r6('avg(rating)', 'rating')} FROM prep_l GROUP BY 1, 2", "prep_l"
        ),
        "genre_vocab": sql(
            "SELECT DISTINCT unnest(string_split(genres, '|')) AS genre FROM prep_l", "prep_l"
        ),
        "filter_counts": sql(
            """SELECT a.n AS original_rows, b.n AS kept_rows, a.n - b.n AS filtered_rows
               FROM (SELECT count(*) AS n FROM ratings_l) a, (SELECT count(*) AS n FROM prep_l) b""",
            "prep_l",
        ),
        "rolling_mean_5": rolling_query([5], 0),
        "rolling_mean_10": rolling_query([5, 10], 0),
        "rolling_mean_previous": rolling_query([5, 10], 1),
        "group_transform": sql(
            f"SELECT *, {group_columns('userId', 'user')}, {group_columns('movieId', 'movie')} FROM prep_l",
            "prep_l",
        ),
        "time_features": sql(
            f"""SELECT row_id, timestamp, {big(MONTH, "rating_month")}, {big(f"day({TS})", "rating_day")},
                       {big(HOUR, "rating_hour")}, {big(WEEKDAY, "rating_dayofweek")},
                       {big(f"quarter({TS})", "rating_quarter")}, {big(f"year({TS})", "rating_year")}
                FROM ratings_e""",
            "ratings_e",
        ),
        "genre_multi_hot": sql(
            f"SELECT row_id, {', '.join(big(token(g), f'genre_{g}') for g in GENRES)} FROM prep_e", "prep_e"
        ),
        "num_genres": sql(
            "SELECT row_id, genres, len(list_distinct(string_split(genres, '|'))) AS num_genres FROM prep_e",
            "prep_e",
        ),
        "movie_year_age": sql(
            f"""SELECT row_id, r.movieId, {year} AS movie_year, 2024 - {year} AS movie_age
                FROM ratings_e r LEFT JOIN kept_movies m ON r.movieId = m.movieId""",
            "ratings_e", "kept_movies",
        ),
        "mean_interaction": with_stats(r6("ua * ma", "user_movie_avg_interaction")),
        "rating_deviation": with_stats(
            r6("rating - ua", "user_rating_deviation") + ", " + r6("rating - ma", "movie_rating_deviation")
        ),
        "clip_predictions": sql(
            f"""SELECT row_id, {r6("raw", "raw")}, {r6("clipped", "clipped")}, {r6("abs(clipped - rating)", "error")}
                FROM (SELECT *, CASE WHEN raw IS NULL OR isnan(raw) THEN raw
                                     ELSE least(greatest(raw, 0.5), 5.0) END AS clipped
                      FROM (SELECT row_id, rating, CASE WHEN row_id % 10 = 5 THEN 'nan'::DOUBLE
                                                        WHEN row_id % 10 <> 0 THEN blend * 3 - 5 END AS raw
                            FROM base_pred))""",
            "base_pred",
        ),
        "standard_scale": two_scaled(),
        "pairwise_interactions": pair_products(),
        "svd_energy": sql(
            """SELECT round(sum(m * m), 3) AS energy
               FROM (SELECT avg(rating) AS m FROM prep_e GROUP BY userId, movieId)""",
            "prep_e",
        ),
        "svd_reconstruction": sql(
            f"SELECT userId, movieId, {r6('avg(rating)', 'rating', 4)} FROM prep_e GROUP BY 1, 2", "prep_e"
        ),
        "factor_products": sql(
            "SELECT userId, movieId, round(rating, 4) AS rating, round(rating, 4) AS product FROM low", "prep_e", low=LOW_RANK
        ),
        "fit_linear_means": sql(
            """SELECT 'user_mean' AS term, round(b1, 5) AS coefficient FROM b
               UNION ALL SELECT 'movie_mean', round(b2, 5) FROM b
               UNION ALL SELECT 'intercept', round(my - b1 * m1 - b2 * m2, 5) FROM b""",
            "base_pred",
            s="""SELECT avg(rating) AS my, avg(user_mean) AS m1, avg(movie_mean) AS m2,
                        var_pop(user_mean) AS s11, var_pop(movie_mean) AS s22,
                        covar_pop(user_mean, movie_mean) AS s12, covar_pop(user_mean, rating) AS s1y,
                        covar_pop(movie_mean, rating) AS s2y
                 FROM base_pred WHERE split = 'train'""",
            b="""SELECT *, (s22 * s1y - s12 * s2y) / (s11 * s22 - s12 * s12) AS b1,
                        (s11 * s2y - s12 * s1y) / (s11 * s22 - s12 * s12) AS b2 FROM s""",
        ),
        "recipe_mlp": mlp_features(),
        "vocabulary_table": sql(
            """SELECT genre, cast(row_number() OVER (ORDER BY genre) - 1 AS integer) AS place, count(*) AS n
               FROM (SELECT unnest(list_distinct(string_split(genres, '|'))) AS genre FROM prep_l) GROUP BY 1""",
            "prep_l",
        ),
        "genre_places": genre_places(),
        "recipe_sparse": sparse_features(),
        "recipe_linear": linear_features(),
        "recipe_forest_stats": forest_features(),
        "recipe_boosting": boosting_features(),
        "hash_split": sql(
            """SELECT row_id, CASE WHEN cast('0x' || substr(md5(concat_ws('|', row_id, 42)), 1, 8) AS bigint) < 0.2 * 4294967296
                                   THEN 'test' ELSE 'train' END AS split FROM ratings_e""",
            "ratings_e",
        ),
        "hash_split_eighth": sql(
            """SELECT row_id, CASE WHEN cast('0x' || substr(md5(concat_ws('|', row_id, 42)), 1, 8) AS bigint) < 0.125 * 4294967296
                                   THEN 'test' ELSE 'train' END AS split FROM ratings_e""",
            "ratings_e",
        ),
        "fit_stump": sql(
            """SELECT round(sl / nl, 6) AS prediction, cast(nl AS bigint) AS n, round(sl / nl, 6) AS mean_rating FROM best
               UNION ALL SELECT round(sr / nr, 6), cast(nr AS bigint), round(sr / nr, 6) FROM best""",
            "prep_e", **STUMP,
        ),
        "boosting_stump": sql(
            """SELECT round(sl / nl, 6) AS prediction, cast(nl AS bigint) AS n FROM best
               UNION ALL SELECT round(sr / nr, 6), cast(nr AS bigint) FROM best""",
            "prep_e", **STUMP,
        ),
        "network_loss": network_scores(
            """SELECT count(*) AS n, round(avg((prediction - r.rating) ** 2), 5) AS loss
               FROM net JOIN prep_e r ON net.row_id = r.row_id
               WHERE cast('0x' || substr(md5(concat_ws('|', r.row_id, 1051)), 1, 8) AS bigint) < 0.1 * 4294967296"""
        ),
        "written_predictions": sql(
            f"SELECT * FROM ({PREDICTION_OUTPUT}), (SELECT unnest(['csv', 'parquet']) AS fmt)", "base_pred"
        ),
        "top_importances": sql(
            f"""SELECT feature, CASE WHEN feature = (SELECT feature FROM best) THEN 1.0::double ELSE 0.0::double END AS importance
                FROM (SELECT unnest({STUMP_NAMES}) AS feature)""",
            "prep_e", **STUMP,
        ),
        "score_mlp": network_scores("SELECT row_id, round(prediction, 5) AS prediction FROM net"),
        "batch_score": network_scores(
            """SELECT round(p, 5) AS predicted_rating, userId, movieId, timestamp, r.rating AS actual_rating,
                      round(abs(p - r.rating), 5) AS error, r.row_id AS original_index
               FROM (SELECT row_id, least(greatest(prediction, 0.5), 5.0) AS p FROM net) n JOIN prep_e r ON n.row_id = r.row_id"""
        ),
        "rolling_carried": carried(
            "timestamp >= (SELECT (min(timestamp) + max(timestamp)) // 2 FROM prep_e)", "prep_e"
        ),
        "rolling_test_side": carried("split = 'test'", "split_e"),
        "row_index": sql(
            "SELECT userId, movieId, rating, timestamp, row_number() OVER (ORDER BY row_id) - 1 AS row_id FROM ratings_e",
            "ratings_e",
        ),
        "evaluate_stored": evaluated(),
        "run_log_rewritten": " UNION ALL ".join(
            f"SELECT '{run}' AS run, * EXCLUDE (run) FROM ({run_log()})" for run in ("first", "second", "third")
        ),
        "metrics_file": sql(
            """SELECT run, model, split, metric, round(value, 6) AS value
               FROM metric_rows, (SELECT unnest(['first', 'second']) AS run)""",
            "metric_rows",
        ),
        "sketched_quantiles": "SELECT 'q' || i AS name, true AS close FROM (SELECT unnest(range(1, 10)) AS i)",
        "bias_by_engagement_thirds": sql(
            bias(
                "base_pred",
                "CASE WHEN size <= low THEN 'low' WHEN size <= medium THEN 'medium' ELSE 'high' END",
                "segment",
                """LEFT JOIN (SELECT userId, count(*) AS size FROM base_pred GROUP BY 1) s ON r.userId = s.userId
                   CROSS JOIN (SELECT quantile_disc(size, 1 / 3) AS low, quantile_disc(size, 2 / 3) AS medium
                               FROM (SELECT count(*) AS size FROM base_pred GROUP BY userId)) q""",
            ),
            "base_pred",
        ),
        "prediction_output": sql(PREDICTION_OUTPUT, "base_pred"),
        "head_predictions": sql(
            f"""SELECT userId, movieId, predicted_rating, actual_rating, error, original_index
                FROM ({PREDICTION_OUTPUT}) ORDER BY original_index LIMIT 10""",
            "base_pred",
        ),
        "prediction_summary": sql(
            f"""SELECT count(*) AS total_predictions, {r6("avg(blend)", "predicted_mean")},
                       {r6("stddev_samp(blend)", "predicted_std")}, {r6("min(blend)", "predicted_min")},
                       {r6("max(blend)", "predicted_max")}, {r6("avg(rating)", "actual_mean")},
                       {r6("stddev_samp(rating)", "actual_std")}, {r6("min(rating)", "actual_min")},
                       {r6("max(rating)", "actual_max")},
                       {r6("avg(abs(blend - rating))", "mean_absolute_error")},
                       {r6("sqrt(avg((blend - rating) ** 2))", "rmse")},
                       {r6("median(blend)", "predicted_median")} FROM base_pred""",
            "base_pred",
        ),
        "regression_metrics": sql(
            f"""SELECT {r6("sqrt(avg((rating - blend) ** 2))", "rmse")}, {r6("avg(abs(rating - blend))", "mae")},
                       {r6("1 - sum((rating - blend) ** 2) / sum((rating - y) ** 2)", "r2")},
                       {r6("avg(abs((rating - blend) / (rating + 1e-8::double))) * 100", "mape")},
                       {r6("avg((rating - blend) ** 2)", "mse")}, count(*) AS n
                FROM (SELECT *, avg(rating) OVER () AS y FROM base_pred)""",
            "base_pred",
        ),
        "metrics_by_model_split": sql(
            f"""SELECT model, {big("position", "position")}, split, {", ".join(r6(m, m) for m in SUMMARY)}, n
                FROM wide_metrics""",
            "wide_metrics",
        ),
        "best_model": sql("SELECT metric, model AS best_model FROM ranked WHERE place = 1", "ranked"),
        "model_comparison": model_comparison(),
        "run_log": run_log(),
        "kfold_metrics": kfold_metrics(),
        "overfit_ratio": sql(
            f"""SELECT model, metric, {r6("a", "train_value")}, {r6("b", "test_value")},
                       {r6("CASE WHEN abs(a) > 1e-9 THEN (b - a) / a END", "degradation")}
                FROM (SELECT model, metric, max(value) FILTER (WHERE split = 'train') AS a,
                             max(value) FILTER (WHERE split = 'test') AS b FROM metric_rows GROUP BY 1, 2)""",
            "metric_rows",
        ),
        "threshold_check": sql(
            f"""SELECT m.metric, model, {r6("value", "value")}, relation, target,
                       CASE WHEN relation = '<' THEN value < target ELSE value > target END AS met
                FROM metric_rows m JOIN {targets} ON m.metric = t.metric
                WHERE split = 'test' AND model = 'blend'""",
            "metric_rows",
        ),
        "bias_by_user_activity": sized_bias(
            "userId",
            """WHEN size < 50 THEN 'new' WHEN size < 60 THEN 'casual' WHEN size < 70 THEN 'regular'
               WHEN size < 80 THEN 'active' ELSE 'power'""",
        ),
        "bias_by_engagement": sized_bias(
            "userId", "WHEN size < 60 THEN 'low' WHEN size < 70 THEN 'medium' ELSE 'high'"
        ),
        "bias_by_popularity": sized_bias(
            "movieId",
            """WHEN coalesce(size, 0) < 60 THEN 'unknown' WHEN size < 70 THEN 'niche'
               WHEN size < 80 THEN 'cult' WHEN size < 90 THEN 'popular' ELSE 'blockbuster'""",
            "WHERE split = 'train'",
        ),
        "bias_by_genre": sql(
            bias("e", "genre", "genre"), "base_pred",
            e="SELECT *, unnest(list_distinct(string_split(genres, '|'))) AS genre FROM base_pred",
        ),
        "bias_by_weekpart": sql(
            bias("base_pred", f"CASE WHEN {WEEKDAY} >= 5 THEN 'weekend' ELSE 'weekday' END", "segment"),
            "base_pred",
        ),
        "bias_by_daypart": sql(
            bias(
                "base_pred",
                f"""CASE WHEN {HOUR} < 6 THEN 'late_night' WHEN {HOUR} < 12 THEN 'morning'
                         WHEN {HOUR} < 18 THEN 'afternoon' ELSE 'evening' END""",
                "segment",
            ),
            "base_pred",
        ),
        "cold_start_flag": sql(
            """SELECT r.*, u.user_activity, m.movie_popularity,
                      u.user_activity <= 5 OR m.movie_popularity <= 10 AS is_cold
               FROM prep_l r
               JOIN (SELECT userId, count(*) AS user_activity FROM prep_l GROUP BY 1) u ON r.userId = u.userId
               JOIN (SELECT movieId, count(*) AS movie_popularity FROM prep_l GROUP BY 1) m
                    ON r.movieId = m.movieId""",
            "prep_l",
        ),
    }
