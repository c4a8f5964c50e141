"""Every operator and stage on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from foliospark.llm import decontaminate, fingerprint, language_id, license_scan, line_dedup, packing, sharding, simhash, token_grammar, warc
from foliospark.session import work_folder
from tests.llm.conftest import LONG, MANY_LINES, ROWS

N = len(ROWS)
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def same_inputs(out, edge, but=()):
    """The further columns come through as they were."""
    kept = [c for c in edge.columns if c in out.columns and c not in but]
    assert len(set(out.columns)) == len(out.columns)
    want = Counter(map(tuple, edge.select(*kept).collect()))
    assert Counter(map(tuple, out.select(*kept).collect())) == want


def test_license_scan(edge, empty):
    out = license_scan.scan(edge)
    same_inputs(out, edge, ("places", "notices"))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert [m["label"] for m in rows[1]["notices"]] == ["all-rights-reserved"] * 2  # the line, and three lines from the first
    assert rows[3]["n_words"] == 0 and rows[4]["n_words"] == 0 and rows[4]["notices"] == []
    assert rows[5]["n_words"] == 40_000
    assert license_scan.scan(empty).count() == 0


def test_line_dedup(edge, empty):
    out = line_dedup.drop_boilerplate(edge, max_ratio=0.4, min_pages=3)
    same_inputs(out, edge, ("text", "n_lines"))
    assert {"_host", "_text"} <= set(out.columns)
    rows = Counter((r["doc_id"], r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect())
    assert rows[(2, "", 2, 2)] == 2 and rows[(1, "", 2, 2)] == 1  # on 3 of 7 pages
    assert rows[(4, None, 0, 0)] == 1 and rows[(3, "", 1, 0)] == 1 and rows[(5, LONG, 1, 0)] == 1
    assert rows[(6, MANY_LINES, 3000, 0)] == 1
    assert line_dedup.drop_boilerplate(empty).count() == 0


def test_sharding(edge, empty):
    out = sharding.shard(edge, limit=100)
    same_inputs(out, edge, sharding.ADDED)
    rows = out.collect()
    assert len(rows) == N and all(r["shard"] is not None for r in rows)
    size, of = Counter(), {}
    for r in rows:
        size[r["shard"]] += r["bytes"]
        of.setdefault(r["shard"], []).append(r)
    for shard, members in of.items():
        assert size[shard] == members[0]["shard_bytes"]
        assert size[shard] <= 100 or len(members) == 1
    assert sharding.shard(empty).count() == 0


def test_equal_rows_beyond_the_limit(ready_spark):
    docs = ready_spark.range(50).select(F.lit(1).alias("doc_id"), F.lit("x" * 30).alias("text")).unionByName(ready_spark.createDataFrame([(2, "y"), (3, "z")], "doc_id int, text string"))
    rows = sharding.shard(docs, limit=100).collect()
    assert len(rows) == 52
    size = Counter()
    for r in rows:
        size[r["shard"]] += r["bytes"]
    assert max(size.values()) == 90 and len(size) >= 17


def check_packing(pieces, length=2048):
    bins = {}
    for r in pieces:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in bins.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= length
    return bins


def test_packing(edge, empty):
    out = packing.pack_documents(edge, BYTES).collect()
    check_packing(out)
    ends = Counter(r["doc_id"] for r in out if r["start"] == 0)
    assert ends == Counter(r[0] for r in ROWS)
    assert [r["length"] for r in out if r["doc_id"] in (3, 4)] == [1, 1]
    assert packing.pack_documents(empty, BYTES).count() == 0


def test_decontamination(edge, empty, ready_spark):
    benchmark = ready_spark.createDataFrame([(1, "The QUICK brown fox all rights reserved"), (2, None), (None, "line 7 of a very long text"), (3, ""), (4, "fox")], "item_id bigint, text string")
    found = Counter(map(tuple, decontaminate.contaminated(edge, benchmark).collect()))
    assert found == Counter({(1, 1, 0, 7, 0): 1, (2, 1, 0, 7, 0): 2, (6, None, 49, 7, 0): 1})
    left = decontaminate.clean(edge, benchmark)
    assert left.columns == edge.columns and left.count() == N - 4
    assert decontaminate.clean(empty, benchmark).count() == 0
    assert decontaminate.clean(edge, benchmark.limit(0)).count() == N


def test_language_id(edge, empty):
    model = language_id.fit(edge)
    out = language_id.identify(edge, model)
    same_inputs(out, edge, ("score", "lang_pred"))
    rows = {r["doc_id"]: r for r in out.collect()}
    assert {rows[i]["lang_pred"] for i in (3, 4, 8, 9)} == {"und"} and rows[4]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in rows.values()) and rows[None]["lang_pred"] in ("de", "en")
    assert language_id.accepted(edge, model).columns == edge.columns
    none = language_id.fit(empty)
    assert {r["lang_pred"] for r in language_id.identify(edge, none).collect()} == {"und"}
    assert language_id.identify(empty, model).count() == 0


def test_simhash(edge, empty):
    rows = simhash.near_duplicates(edge).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ROWS)
    component = {r["doc_id"]: r["component_id"] for r in rows}
    assert component[2] == 1 and component[4] == 3 and component[8] == 3 and component[None] is None
    assert simhash.near_duplicates(empty).count() == 0
    left = simhash.one_of_each(edge)
    assert left.columns == edge.columns
    assert Counter(r["doc_id"] for r in left.collect()) == Counter([1, 3, None, 5, 6, 7, 9, -3])
    assert simhash.one_of_each(empty).count() == 0


def test_unrelated_texts_of_null_or_equal_ids_stay(ready_spark):
    texts = [" ".join(f"{word}{i}" for i in range(30)) for word in ("red", "blue", "green", "white", "black")]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4]), (8, texts[4])]
    left = simhash.one_of_each(ready_spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(map(tuple, left.collect())) == Counter([(None, texts[0]), (None, texts[1]), (None, texts[2]), (7, texts[3]), (7, texts[4])])


def test_fingerprints(edge, empty):
    rows = fingerprint.fingerprints(edge).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ROWS)
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["fingerprint"] == by[2]["fingerprint"] and by[1]["near_next"] == 1.0
    assert by[3]["near_edited"] == 1.0 and by[4]["n_chars"] == 0 and by[6]["near_edited"] > 0.5
    assert fingerprint.fingerprints(empty).count() == 0


def test_token_files(edge, empty, ready_spark):
    path = f"{work_folder(ready_spark)}/tokens"
    token_grammar.write_tokens(edge, path, WORDS, shard_ids=5_000)
    rows = token_grammar.document_digests(ready_spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in rows] == sorted((r[0] for r in ROWS), key=lambda d: (d is not None, d))
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:i]) for i in range(N)]
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4, 8)} == {1}
    path = f"{work_folder(ready_spark)}/tokens"
    token_grammar.write_tokens(empty, path, WORDS)
    assert token_grammar.document_digests(ready_spark, path).count() == 0


def test_revisits(ready_spark):
    h = lambda **k: [(a.replace("_", "-"), b) for a, b in k.items()]
    records = ready_spark.createDataFrame([
        (1, "http://www.X.org:80/a/?b=2&a=1&utm_source=q#top", "response", 10, h(ETag='"1"', Cache_Control="old", Content_Type="text/html"), "p1", 5),
        (2, "https://x.org/a?a=1&b=2", "response", 20, h(ETag='"2"', Set_Cookie="s"), "p2", 6),
        (3, "x", "response", None, h(), "p3", 7),
        (4, "//x.org/a?a=1&b=2", "revisit", 20, h(etag='W/"1"', Cache_Control="new", Content_Type="no"), None, None),
        (5, "//x.org/a?a=1&b=2", "revisit", 21, h(ETag='"1"'), None, None), (5, "//x.org/a?a=1&b=2", "revisit", 21, h(ETag='"1"'), None, None),
        (6, None, "revisit", 30, h(), None, None), (7, "", "revisit", 30, None, None, None), (8, "//x.org/a?a=1&b=2", "revisit", 99, None, None, None),
        (9, "x", "revisit", 50, h(ETag='"1"'), None, None), (10, "//x.org/a?a=1&b=2", "revisit", None, h(ETag='"2"'), None, None),
        (11, "//x.org/a?a=1&b=2", "revisit", 22, h(ETag='"2"', Expires="soon"), None, None),
    ], warc.RECORD).withColumns({c: F.lit(1) for c in ("outcome", "refers_to", "_span", "_full", "found")})
    out = warc.resolve_revisits(records)
    rows = out.collect()
    got = Counter((r["record_id"], r["outcome"], r["refers_to"], r["payload_sha256"]) for r in rows)
    assert got == Counter([(4, "etag", 1, "p1"), (5, "changed", 2, None), (5, "changed", 2, None), (6, "no_response", None, None), (7, "no_response", None, None), (8, "unverified", 2, None),
                           (9, "no_response", None, None), (10, "no_response", None, None), (11, "etag", 2, "p2")])
    headers = {r["record_id"]: r["headers"] and [tuple(x) for x in r["headers"]] for r in rows}
    assert headers[4] == [("cache-control", "new"), ("content-type", "text/html"), ("etag", 'W/"1"')]
    assert headers[11] == [("etag", '"2"'), ("expires", "soon"), ("set-cookie", "s")] and headers[5] is None
    assert warc.resolve_revisits(records.limit(0)).count() == 0
    assert warc.crawl_records(ready_spark.createDataFrame([(None, None, None)], "page_id bigint, url string, html string")).count() == 2


@pytest.mark.parametrize("number", range(len(corpus_pipeline.STAGES)))
def test_stages(edge, empty, ready_spark, tmp_path, number):
    ready_spark.createDataFrame([(1, "The quick brown fox all rights reserved")], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    name, stage = corpus_pipeline.STAGES[number]
    for docs in (edge, empty):
        out = stage(ready_spark, docs, str(tmp_path))
        assert name == "packing" or out.columns == docs.columns
        assert out.count() <= docs.count() or name == "packing"
