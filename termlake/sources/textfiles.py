"""Text files listed in a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import is_small

PACKED = "path string, content binary"


def plain_path(path: Column) -> Column:
    """A local path without its ``file:`` prefix; other schemes are kept."""
    return F.regexp_replace(path, r"^file:/+", "/")


def write_packed(files: DataFrame, root: str, mode: str = "errorifexists") -> None:
    """Text files ``(path, content BINARY)`` packed below ``root``: rows of Parquet in place of a file each.

    Listing, opening and committing a file costs milliseconds, whatever its
    size; in packs the work follows the bytes.
    """
    files.select("path", "content").write.mode(mode).parquet(root)


def read_text_docs(manifest: DataFrame, root: str, packed: bool = False) -> DataFrame:
    """``(id, path, text)`` for ``manifest(id, path)`` over the files below ``root``.

    ``packed`` says that ``root`` was written by :func:`write_packed`.
    A missing or non-UTF-8 file gives an empty text. Line ends become ``\\n``.
    """
    spark = manifest.sparkSession
    if packed:
        files = spark.read.schema(PACKED).parquet(root)
    else:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    files = files.select(plain_path(F.col("path")).alias("_path"), "content")
    decoded = F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))
    text = F.regexp_replace(F.coalesce(decoded, F.lit("")), r"\r\n?", "\n").alias("text")
    listed = manifest.select("id", "path", plain_path(F.col("path")).alias("_path"))
    if is_small(listed):
        # The files' contents stay where they are read; only paths are compared.
        found = files.join(F.broadcast(listed), "_path").select("id", "path", text)
        missing = listed.join(files.select("_path"), "_path", "left_anti")
        return found.unionByName(missing.select("id", "path", F.lit("").alias("text")))
    return listed.join(files, "_path", "left").select("id", "path", text)
