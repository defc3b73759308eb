"""Session helpers: the shared scratch folder, staged tables and size checks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A table may be broadcast when it has been measured to stay under both limits.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can read: ``spark.checkpoint.dir``, or the context's checkpoint folder."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    named = named or sc.getCheckpointDir()
    if not named:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{scratch_root(spark)}/termlake/{_session_folder(spark)}/{uuid.uuid4().hex}/{label}"


def _session_folder(spark: SparkSession) -> str:
    return spark.sparkContext.applicationId


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application has staged; tables read from there are gone."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/termlake/{_session_folder(spark)}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back; ``options`` go to the writer.

    This cuts the lineage, survives the loss of executors, and lets each
    consumer read only the columns it needs.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)


def measure(
    df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> tuple[int, bool]:
    """Rows of ``df`` and whether it is small.

    Plain sums: each task returns one row. A limit would first move up to that
    many rows of every task into one.
    """
    width = F.lit(0).cast("bigint")
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if kind in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16
        elif kind.startswith(("array", "map", "struct")):
            width = width + F.coalesce(F.length(F.to_json(F.struct(F.col(field.name)))), F.lit(0)) + 16
        else:
            width = width + 16
    got = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("b")).first()
    return got["n"], got["n"] <= max_rows and (got["b"] or 0) <= max_bytes


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` was measured to fit a broadcast."""
    return measure(df, max_rows, max_bytes)[1]


def broadcast_if_small(df: DataFrame, **limits) -> DataFrame:
    """Hint a broadcast only when the measured size allows it."""
    return F.broadcast(df) if is_small(df, **limits) else df
