"""Usable HTML pages of a table of fetched pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def read_pages(pages: DataFrame) -> DataFrame:
    """Pages with HTML; where the table has ``status`` and ``content_type``,
    only successful ``text/html`` responses. Filters reach the scan."""
    kept = pages.where(F.col("html").isNotNull() & (F.col("html") != ""))
    if "status" in pages.columns:
        kept = kept.where(F.col("status").between(200, 299))
    if "content_type" in pages.columns:
        kept = kept.where(F.contains(F.col("content_type"), F.lit("text/html")))
    return kept
