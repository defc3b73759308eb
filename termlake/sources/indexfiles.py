"""Documents and indexes on disk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores
from ..functions.numbers import to_float

RAW = "map<string,string>"
VECTOR = "map<string,double>"


def write_docs(docs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON document ``{id, url, title, text}`` per line."""
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("id", "url", "title", "text")]
    docs.select(*blank).write.mode(mode).json(path)


def index_records(vecs: DataFrame, docs: DataFrame) -> DataFrame:
    """``(id, url, title, tfidf MAP)`` from document vectors and their pages."""
    meta = docs.select("id", "url", F.coalesce("title", F.lit("")).alias("title"))
    joined = meta.join(vecs.select("id", "tfidf"), "id", "left")
    as_map = F.coalesce(F.map_from_entries("tfidf"), F.create_map().cast(VECTOR))
    return joined.select("id", "url", "title", as_map.alias("tfidf"))


def bag_records(weighed: DataFrame, blank: bool = True) -> DataFrame:
    """``(id, url, title, tfidf MAP)`` from rows ``(id, url, title, tfidf)``; a null id has no vector.

    ``blank`` makes null titles empty.
    """
    title = F.coalesce("title", F.lit("")).alias("title") if blank else "title"
    as_map = F.when(F.col("id").isNotNull(), F.map_from_entries("tfidf")).otherwise(F.create_map().cast(VECTOR))
    return weighed.select("id", "url", title, as_map.alias("tfidf"))


def record_postings(records: DataFrame) -> DataFrame:
    """``(id, norm, term, w)`` from index records."""
    # The norm comes first, in its own step: next to the explode it would be
    # computed again for every term.
    normed = records.select("id", scores.norm(F.map_values("tfidf")).alias("norm"), "tfidf")
    rows = normed.select("id", "norm", F.explode_outer("tfidf").alias("term", "w"))
    return rows.where(F.col("term").isNotNull())


def write_index(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record ``{id, url, title, tfidf{}}`` per line."""
    records.select("id", "url", "title", "tfidf").write.mode(mode).json(path)


def write_file_index(records: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON record ``{id, path, tfidf{}}`` per line, as for an index of text files."""
    records.select("id", F.col("url").alias("path"), "tfidf").write.mode(mode).json(path)


def write_index_keyed(records: DataFrame, path: str, order: str | None = None, mode: str = "errorifexists") -> None:
    """Parquet with one row per id; the last by ``order`` wins.

    Without ``order`` the ids must be unique already and no shuffle is needed.
    """
    if order is not None:
        last = F.max_by(F.struct("url", "title", "tfidf"), order).alias("_last")
        records = records.groupBy("id").agg(last).select("id", "_last.*")
    records.select("id", "url", "title", "tfidf").write.mode(mode).parquet(path)


def write_postings(postings: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Postings in term order, so a scan for a few terms skips most row groups.

    The range is on (term, id): a common term is cut into several files.
    """
    postings.repartitionByRange("term", "id").sortWithinPartitions("term", "id").write.mode(mode).parquet(path)


def coerce_tfidf(raw: Column) -> Column:
    """``MAP<STRING,DOUBLE>`` from JSON text of an object (or of a string that
    holds one). Booleans count as 1 and 0, other non-numbers are dropped."""
    parsed = F.from_json(raw, RAW)
    numbers = F.transform_values(
        parsed,
        lambda _, v: F.when(v == "true", F.lit(1.0)).when(v == "false", F.lit(0.0)).otherwise(to_float(v)),
    )
    kept = F.map_filter(numbers, lambda _, v: v.isNotNull())
    return F.coalesce(kept, F.create_map().cast(VECTOR))


def _record(m: Column, path_fallback: bool) -> Column:
    url = F.coalesce(F.nullif(m["url"], F.lit("")), m["path"]) if path_fallback else m["url"]
    return F.struct(
        F.coalesce(url, F.lit("")).alias("url"),
        F.coalesce(m["title"], F.lit("")).alias("title"),
        coerce_tfidf(m["tfidf"]).alias("tfidf"),
    )


def parse_index(lines: DataFrame, order: list[str], path_fallback: bool = True) -> DataFrame:
    """``(id, url, title, tfidf)`` from ``lines(value, *order)``.

    A line is one record (``id`` with ``tfidf`` or ``url``) or an object of
    records by id; anything else is skipped. The last record of an id by
    ``order`` wins, decided by partial aggregation before the shuffle.
    """
    parsed = lines.select(*order, F.from_json("value", RAW).alias("m")).where(F.col("m").isNotNull())
    m = F.col("m")
    single = F.map_contains_key(m, F.lit("id")) & (
        F.map_contains_key(m, F.lit("tfidf")) | F.map_contains_key(m, F.lit("url"))
    )
    nested = ~single & F.forall(F.map_values(m), lambda v: F.coalesce(F.startswith(v, F.lit("{")), F.lit(False)))
    # Both shapes as entries of one array: one pass over the file.
    alone = F.array(F.struct(m["id"].alias("key"), m.alias("value")))
    many = F.transform(
        F.map_entries(m), lambda e: F.struct(e["key"].alias("key"), F.from_json(e["value"], RAW).alias("value"))
    )
    entries = F.when(single, alone).when(nested, many)
    rows = parsed.select(*order, F.posexplode_outer(entries).alias("_pos", "_e"))
    # A record may have a null id.
    records = rows.where(F.col("_e.value").isNotNull()).select(
        F.col("_e.key").alias("id"),
        F.struct(*order, "_pos").alias("_order"),
        _record(F.col("_e.value"), path_fallback).alias("_rec"),
    )
    last = records.groupBy("id").agg(F.max_by("_rec", "_order").alias("_rec"))
    return last.select("id", "_rec.*")


def read_index(spark: SparkSession, path: str, whole: bool = False) -> DataFrame:
    """Lenient index reader: JSON lines, single records or objects by id.

    ``whole`` reads each file as one JSON value, for pretty-printed files.
    """
    text = spark.read.text(path, wholetext=whole)
    lines = text.select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"),
    )
    return parse_index(lines, ["_file", "_start", "_row"], path_fallback=not whole)
