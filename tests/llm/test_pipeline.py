"""The pipeline's stages against plain Python on the smallest data."""

from collections import Counter

import pytest

import corpus_pipeline
from foliospark.llm import decontaminate, language_id, line_dedup
from foliospark.sources.tables import stage
from tests.conftest import SF


@pytest.fixture(scope="module")
def steps(ready_spark):
    """The documents before each stage and after the last, as (frame, rows)."""
    docs = ready_spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(ready_spark, docs, SF), "stage")
        out.append(docs)
    return [(d, d.collect()) for d in out]


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_names_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "line dedup", "SimHash near-dedup", "decontamination", "packing"]
    assert all(frame.columns == steps[0][0].columns for frame, _ in steps[:-1])


def test_language_stage(steps):
    before, after = texts(steps[0][1]), texts(steps[1][1])
    model = language_id.fit(steps[0][0])
    names, scores = model.predict(list(before.values()))
    want = {d: t for (d, t), n, s in zip(before.items(), names, scores) if n != "und" and s >= language_id.REJECT_BELOW}
    assert after == want and len(want) > 0.97 * len(before)


def test_line_stage(steps):
    before, after = steps[1][1], texts(steps[2][1])
    pages, on = Counter(r["source"] for r in before), Counter()
    for r in before:
        on.update((r["source"], x) for x in {x.strip(" \t\r") for x in r["text"].split("\n")} if x)
    gone = {k for k, n in on.items() if n >= line_dedup.MIN_PAGES and n > line_dedup.MAX_RATIO * pages[k[0]]}
    want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if (r["source"], x.strip(" \t\r")) not in gone) for r in before}
    assert after == want
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2][1] if r["text"] != texts(before)[r["doc_id"]])


def test_near_copy_stage(steps):
    """One text stays of every component of pairs with 0.8 of their five-word shingles in common, by all pairs."""
    before, after = texts(steps[2][1]), texts(steps[3][1])
    ids = sorted(before)
    sets = []
    for d in ids:
        found = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in before[d] or "").encode().split()
        sets.append({tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))})
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 5 * shared >= 4 * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    kept = {find(i) for i in range(len(ids))}
    assert len(kept) < len(ids) and after == {ids[i]: before[ids[i]] for i in kept}


def test_benchmark_stage(ready_spark, steps):
    before, after = texts(steps[3][1]), texts(steps[4][1])
    items = [decontaminate.words(r["text"]) for r in ready_spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    joined = {d: b" " + b" ".join(decontaminate.words(t)) + b" " for d, t in before.items()}
    leaks = {d for d, t in joined.items() if any(b" " + b" ".join(x) + b" " in t for x in items)}
    dropped = set(before) - set(after)
    assert leaks and leaks <= dropped and all(after[d] == before[d] for d in after)
    for d in dropped - leaks:  # near copies of an item only: within the bound of some window
        ws = decontaminate.words(before[d])
        assert any(decontaminate.edit_distance(ws[i:i + len(x)], x, int(decontaminate.EDITS * len(x))) <= int(decontaminate.EDITS * len(x)) for x in items for i in range(len(ws) - len(x) + 1))


def test_packing_stage(steps):
    docs, rows = texts(steps[4][1]), steps[5][1]
    bins, ids = {}, {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        ids.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert set(ids) == set(docs)
    for spans in [*bins.values(), *ids.values()]:
        at = 0
        for start, n in sorted(spans):
            assert start == at
            at += n
    total = sum(r["length"] for r in rows)
    assert max(sum(n for _, n in s) for s in bins.values()) <= 2048 and len(bins) <= -(-total // 2048) + 1
