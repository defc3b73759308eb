"""Every operator on nulls, empty and long texts, copies, repeated rows, no rows, and clashing columns."""

import hashlib

import pytest
from pyspark.sql import functions as F

from termlake.llm import bpe, line_chunks, mixing, ngram_join, quality_net, quality_rules, repeats, spotsigs, toxicity, warc
from termlake.llm.queries import byte_bpe


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_bpe(odd_docs, no_docs):
    rows = bpe.round_trip(odd_docs, byte_bpe()).collect()
    assert len(rows) == 13
    empty = hashlib.sha256(b"").hexdigest()
    assert {(r["n_tokens"], r["ids_sha256"]) for r in rows if r["doc_id"] in (3, 4)} == {(0, empty)}
    assert bpe.round_trip(no_docs, byte_bpe()).count() == 0


def test_quality_rules(odd_docs, no_docs):
    rows = quality_rules.quality_table(odd_docs).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 13 and got[3]["n_words"] == 0 and got[3]["base_failed"] and not got[3]["kept"]
    assert got[1]["kept"] and got[11]["base_failed"]
    kept = quality_rules.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["kept"] for r in rows)
    assert quality_rules.quality_table(no_docs).count() == 0


def test_mixing(odd_docs, no_docs):
    rows = mixing.mix(odd_docs, 0.5).collect()
    assert len(rows) == 13 and all(0 <= r["probability"] <= 1 for r in rows)
    assert all(r["probability"] == 0 for r in rows if r["n_tokens"] == 0)
    kept = mixing.keep_sampled(odd_docs, 0.5)
    assert kept.columns == odd_docs.columns and kept.count() == sum(r["sampled"] for r in rows)
    assert mixing.mix(no_docs, 0.5).count() == 0


def test_ngram_join(odd_docs, no_docs):
    got = by_id(ngram_join.near_duplicates(odd_docs))
    assert None not in got and got[2]["class_id"] == 1 and got[10]["class_id"] == 5 and got[1]["n_links"] == 1
    assert got[3]["class_id"] == 3 and got[4]["class_id"] == 3 and got[8]["class_id"] == 8
    assert got[6]["n_links"] == 1  # the repeated row
    kept = ngram_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 0, 1, 3, 5, 6, 8, 9, 11]
    assert ngram_join.near_duplicates(no_docs).count() == 0


def test_ngram_join_takes_one_text_of_an_id(scratch):
    docs = scratch.createDataFrame([(1, "a b c d e f"), (1, "g h i j k l"), (2, "m n o p q r")], "doc_id bigint, text string")
    rows = ngram_join.near_duplicates(docs).collect()
    assert sorted((r["doc_id"], r["class_id"], r["n_links"]) for r in rows) == [(1, 1, 0), (2, 2, 0)]


def test_repeats(odd_docs, no_docs):
    rows = repeats.remove_repeats(odd_docs).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 13 and got[3]["n_bytes"] == 0 and got[3]["removed"] == [] and got[4]["kept"] == b""
    assert bytes(got[5]["kept"]) == b"" and len(got[5]["removed"]) == 1
    assert repeats.remove_repeats(no_docs).count() == 0


def test_line_chunks(odd_docs, no_docs):
    done = line_chunks.dedup_lines(odd_docs)
    assert done.columns == [*odd_docs.columns, "_n_removed"]
    rows = done.collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 13 and got[3]["text"] is None and got[4]["text"] == ""
    assert got[5]["_n_removed"] == 0 and got[10]["_n_removed"] > 0 and len(got[10]["text"]) < len(got[5]["text"]) / 2
    assert [r["_n_removed"] for r in rows if r["doc_id"] == 6] == [0, 0]
    assert line_chunks.dedup_lines(no_docs).count() == 0


def test_spotsigs(odd_docs, no_docs):
    rows = spotsigs.fingerprint_table(odd_docs).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == 13 and got[1]["fingerprint"] == got[2]["fingerprint"] != "" and got[3]["fingerprint"] == ""
    assert got[2]["near_next"] == 1.0 and got[2]["near_edited"] > 0.3
    assert spotsigs.fingerprint_table(no_docs).count() == 0


def test_classifiers_without_labels(odd_docs, no_docs, no_labels):
    rows = toxicity.toxicity_table(odd_docs, no_labels).collect()
    assert len(rows) == 13 and all(r["score"] < 0.01 and r["predicted"] == 0 for r in rows)
    rows = quality_net.quality_scores(odd_docs, no_labels).collect()
    assert len(rows) == 13 and all(r["score"] == 0.5 for r in rows)
    assert toxicity.toxicity_table(no_docs, no_labels).count() == 0
    assert quality_net.quality_scores(no_docs, no_labels).count() == 0


def test_warc(scratch):
    rows = [(5, "http://a/\r\nx", "<p>x"), (2, None, "<p>x"), (7, "http://b/", None), (8, "http://c/", ""), (2, None, "<p>x"), (None, "u", "<p>x"), (9, "d", "ü" * 100_000)]
    pages = scratch.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("revisit", F.lit("extra"))
    got = warc.read_archives(warc.archive_pages(pages)).collect()
    assert len(got) == 7 and all(r["intact"] for r in got)
    kinds = sorted((r["page_id"] or 0, r["record_type"], r["refers_to"] or 0) for r in got)
    assert kinds == [(0, "revisit", 2), (2, "response", 0), (2, "response", 0), (5, "revisit", 2), (7, "response", 0), (8, "revisit", 7), (9, "response", 0)]
    assert {r["payload_bytes"] for r in got if r["page_id"] == 9} == {200_000}
    assert warc.read_archives(warc.archive_pages(pages.limit(0))).count() == 0
