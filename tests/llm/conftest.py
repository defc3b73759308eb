import pytest
from pyspark.sql import functions as F

WORDS = "the stone of river and light in a house was under green hill with old road by water that morning".split()


def prose(seed: int, n: int) -> str:
    """Words in an order that follows from the seed; no window of eight repeats by design."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 16) % len(WORDS)] + ("" if x % 3 else chr(97 + (x >> 8) % 26)))
    return " ".join(out)


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def scratch(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("scratch")))
    return spark


def _rows():
    long = "\n".join(prose(i, 40) for i in range(300))
    rows = [
        (1, prose(1, 60), "en", "a", 1),
        (2, prose(1, 60), "en", "a", 1),
        (3, None, "en", "a", None),
        (4, "", None, "b", 0),
        (5, long, "de", None, 9),
        (6, prose(6, 60), None, None, None),
        (6, prose(6, 60), None, None, None),
        (None, prose(7, 50), "en", "a", 3),
        (None, None, None, None, None),
        (8, "!!! ???", "en", "b", 7),
        (9, "one", "fr", "c", 3),
        (10, long, "de", "a", 9),
        (11, "a b\n" * 30 + "\t\x0b ", "en", "a", 5),
    ]
    return rows


@pytest.fixture(scope="session")
def odd_docs(scratch):
    """Nulls in every column, empty and long texts, copies and repeated rows, and clashing extra columns."""
    df = scratch.createDataFrame(_rows(), SCHEMA)
    extra = ["_counts", "_row", "_gone", "_id", "key", "rep", "n", "spans", "score", "held_out", "_topic", "_hash", "block", "label"]
    return df.withColumns({c: F.lit(f"extra {c}") for c in extra})


@pytest.fixture(scope="session")
def no_docs(scratch):
    return scratch.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def no_labels(scratch):
    return scratch.createDataFrame([], "doc_id bigint, quality int, toxic int")
