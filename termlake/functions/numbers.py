"""Number parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FLOAT = r"(?i)^\s*[+-]?(?:\d+\.?\d*(?:e[+-]?\d+)?|\.\d+(?:e[+-]?\d+)?|inf(?:inity)?|nan)\s*$"


def to_float(text: Column) -> Column:
    """Double from decimal text, null for anything else (no suffixes, no hex)."""
    return F.when(F.rlike(text, F.lit(_FLOAT)), text.try_cast("double"))
