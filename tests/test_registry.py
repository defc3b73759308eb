import os

import pytest

import __spark_entry__ as entry
import check

SF = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


def test_every_query_has_sql():
    own = {name for name in entry.queries() if name != "pipeline" and not name.startswith("op")}
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_queries_equal_their_sql(spark):
    names = ["html_text", "html_links", "tfidf", "search_topk", "host_throttle", "robots_filter", "crawl_closure", "read_index"]
    assert check.compare(spark, SF, names) == 0


@needs_data
def test_entry_has_rows(spark):
    rows = entry.entry(spark)
    assert rows.columns == ["qid", "rank", "score", "id", "url", "title"] and rows.count() > 0
