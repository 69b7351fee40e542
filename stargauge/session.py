"""Spark session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOCAL_FOLDERS: dict[str, str] = {}


def build_session(
    app_name: str = "stargauge",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings this library is tuned for.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the first comes from
    spark-submit, and adaptive execution merges small shuffle partitions and splits skewed ones.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; one temporary folder where all runs in one process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach before running on a cluster"
        )
    if context.applicationId not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="stargauge-")
    return _LOCAL_FOLDERS[context.applicationId]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give Spark a checkpoint folder unless the session already has one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def new_scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/stargauge/{app}/{label}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession) -> bool:
    """Remove the tables this application wrote to the shared folder; True if there were any.

    Frames that read them (fitted recipes among them) cannot be used afterwards.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(
        f"{shared_folder(spark)}/stargauge/{spark.sparkContext.applicationId}"
    )
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back, as ``schema`` if given.

    Cuts the lineage, survives lost executors, and gives the optimizer the real table size, so
    that broadcast decisions rest on measured bytes.
    """
    spark = df.sparkSession
    path = new_scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def at_rest(df: DataFrame, label: str, key: str | None = "userId") -> DataFrame:
    """Like :func:`materialize`, laid out for being read many times.

    Rows are clustered by ``key``, so later per-user aggregations combine almost fully before they
    shuffle. The rebalance hint lets adaptive execution split a hot key over several files and
    merge small ones, which a plain ``repartition(key)`` would not.
    """
    keys = [F.col(key)] if key and key in df.columns else []
    return materialize(df.hint("rebalance", *keys), label)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint that keeps partitioning and row order (unlike a parquet table)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def colocated(df: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """``df`` dealt by ``keys`` and checkpointed so that later joins on the keys leave its rows in place.

    The partitioning is only remembered when the plan is final, so this one plan is not re-planned.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.repartition(parts, *keys).checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
