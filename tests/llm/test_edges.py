"""Odd and empty tables through every operator: nothing crashes, and the results are those the docstrings state."""

import hashlib

import pytest
from pyspark.sql import functions as F

from lamella.llm import language_id, minhash, mixing, order_minhash, packing, paragraphs, quality_classifier, quality_rules, surrogates, warc


def ids(rows):
    return sorted((r["doc_id"] for r in rows), key=lambda v: (v is not None, v))


def test_paragraphs(odd, nothing):
    got = paragraphs.repeated_paragraphs(odd).collect()
    assert {(r.doc_id, r.removed) for r in got} == {(5, False), (6, True)} and {r.cluster_doc_id for r in got} == {5}
    assert paragraphs.repeated_paragraphs(nothing).collect() == []
    texts = {r.doc_id: r.text for r in paragraphs.without_repeats(odd).collect()}
    assert texts[6] == "" and texts[5] and texts[1] is None


def test_languages(odd, nothing):
    held = F.pmod(F.col("doc_id"), F.lit(4)) == 2
    got = language_id.languages(odd, held).collect()
    assert len(got) == 12
    for r in got:
        assert 0 <= r.score <= 1 and r.held_out == (r.doc_id is not None and r.doc_id % 4 == 2)
        assert (r.lang_pred == "und") == (r.doc_id in (1, 2, 3, 8))
    assert language_id.languages(nothing, held).collect() == []
    assert {r.lang_pred for r in language_id.languages(odd, F.lit(True)).collect()} == {"und"}


def test_fingerprints(odd, nothing):
    got = order_minhash.fingerprints(odd).collect()
    assert len(got) == 12
    by = {}
    for r in got:
        by.setdefault(r.doc_id, r)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert by[1].fingerprint == by[2].fingerprint == "" and by[1].near_next == 1.0
    assert by[5].fingerprint == by[6].fingerprint and by[7].n_chars == 3
    assert by[7].edited_sha256 == hashlib.sha256(("on" + "…").encode()).hexdigest()
    assert order_minhash.fingerprints(nothing).collect() == []
    alone = order_minhash.fingerprints(odd.where("doc_id = 7")).collect()
    assert alone[0].near_next == 1.0 and alone[0].edited_sha256 == hashlib.sha256(b"ono").hexdigest()


def test_warc(spark):
    big = "x" * 1500
    rows = [(1, "http://b.example/1", big), (2, None, big), (3, "http://a.example/", None), (4, "HTTP://A.example:80/?q=1#f", "é" * 499), (5, "http://a.example/", big), (None, "u", big), (4, "again", ""), (6, "bad url \r\n with lines", "é" * 500), (7, "http://a.example/", "é" * 500)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as d", "2 as archive", "3 as last")
    got = warc.round_trip(pages).collect()
    assert len(got) == 9
    kind = {r.page_id: (r.record_type, r.refers_to, r.payload_bytes) for r in got if r.page_id not in (None, 4)}
    assert kind == {1: ("revisit", 5, 1500), 2: ("revisit", 5, 1500), 3: ("response", None, 0), 5: ("response", None, 1500), 6: ("revisit", 7, 1000), 7: ("response", None, 1000)}
    assert [r.record_type for r in got if r.page_id is None] == ["response"]
    assert all(r.payload_digest == hashlib.sha1(big.encode()).hexdigest() for r in got if r.page_id in (1, 2, 5))
    keys = [(r.url_key, r.timestamp) for r in got]
    assert keys == sorted(keys)
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_surrogates(odd, nothing):
    got = surrogates.anonymised_documents(odd)
    assert got.columns == odd.columns and got.count() == 12
    by = {r.doc_id: r for r in got.collect()}
    assert by[1].text is None and by[2].text == "" and by[7].text == "one" and by[7].n_chars == 3
    assert surrogates.anonymised_documents(nothing).collect() == []


def test_packing(odd, nothing):
    got = packing.packed(odd).collect()
    assert {r.doc_id for r in got} == {1, 2, 3, 4, 5, 6, 7, 8, 9, -4, None} and sum(1 for r in got if r.doc_id == 5) == 2
    assert [r.length for r in got if r.doc_id in (1, 2)] == [1, 1]
    fill = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert fill.get(r.sequence_id, 0) == r.offset
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 1024 and len(fill) == -(-sum(r.length for r in got) // 1024)
    long = sorted((r for r in got if r.doc_id == 4), key=lambda r: r.piece)
    assert all(r.length == 1024 for r in long[1:]) and [r.start for r in long] == [0, *(long[0].length + 1024 * i for i in range(len(long) - 1))]
    assert packing.packed(nothing).collect() == []


def test_near_duplicates(odd, nothing):
    got = minhash.near_duplicates(odd, k=4).collect()
    assert len(got) == 12
    by = {r.id: r for r in got}
    assert by[5].component_id == by[6].component_id == 5 and by[5].kept and not by[6].kept
    assert [by[i].n_shingles for i in (1, 2, 3, 7)] == [0, 0, 0, 1] and by[1].kept and by[3].component_id == 3
    assert by[None].component_id is None and not by[None].kept
    assert minhash.near_duplicates(nothing).collect() == []
    kept = minhash.kept_documents(odd)
    assert kept.columns == odd.columns and ids(kept.collect()) == [None, -4, 1, 2, 3, 4, 5, 7, 8, 9]


def test_rules(odd, nothing):
    got = quality_rules.quality_rules(odd).collect()
    assert len(got) == 12
    by = {r.doc_id: r for r in got}
    assert [by[i].n_words for i in (1, 2, 3, 5)] == [0, 0, 0, 60] and by[1].base_failed and not by[1].kept and by[1].log_perplexity is None
    assert by[4].base_failed and by[4].n_repeat_words == by[4].n_words and not by[5].base_failed
    assert quality_rules.quality_rules(nothing).collect() == []


def test_mix(odd, nothing):
    got = mixing.mixed(odd).collect()
    assert len(got) == 12
    total, taken = sum(r["size"] for r in got), sum(r.taken for r in got)
    assert taken <= total and all(0 <= r.taken <= 3 * r["size"] for r in got)
    by = {r.source: (r.source_size, r.target) for r in got}
    assert sum(t for _, t in by.values()) == pytest.approx(total) and all(t <= 3 * s + 1e-6 for s, t in by.values())
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mixed(odd).collect()), key=repr)
    assert mixing.mixed(nothing).collect() == []
    docs = mixing.mixed_documents(odd)
    assert docs.columns == odd.columns
    assert mixing.mixed(odd.where("doc_id in (1, 2)")).agg(F.sum("taken")).first()[0] == 0


def test_quality(spark, odd, nothing):
    labels = spark.createDataFrame([(i, q, 0) for i, q in ((1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 1), (7, 1), (9, 1), (None, 1), (8, None))], "doc_id long, quality int, toxic int")
    got = quality_classifier.quality_scores(odd, labels).collect()
    assert len(got) == 12 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert quality_classifier.quality_scores(nothing, labels).collect() == []
    assert {r.score for r in quality_classifier.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.accepted_documents(odd, labels).columns == odd.columns


def test_a_shard_of_pruned_grams_is_not_written(tmp_path):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array(["en", "en"]), pa.array([256, 257]), pa.array([None, None], pa.float64()), pa.array([1, 1]), pa.array([1.0, 1.0])], names=["lang", "code", "share", "ctx", "left"])
    got = list(quality_rules._written(f"file://{tmp_path}/shards", 2)([batch]))
    assert len(got) == 1 and got[0].column(2).to_pylist() == got[0].column(3).to_pylist() == [1 + (2 << quality_rules._LENGTH) + quality_rules._CONTEXT]
