"""Links of near copies: fingerprints first, few pairs compared, none lost."""

import random

from pyspark.sql import functions as F

from foliospark.llm import simhash


def variants(n, rng):
    """Copies of one text with a few words changed: some pairs have 0.8 of their shingles in common, most have less."""
    base = [f"w{rng.randrange(10_000)}" for _ in range(140)]
    out = []
    for _ in range(n):
        words = list(base)
        for at in rng.sample(range(len(words)), rng.randrange(1, 14)):
            words[at] = f"x{rng.randrange(10**9)}"
        out.append(" ".join(words))
    return out


def smallest(n, pairs):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_a_group_of_variants(ready_spark, monkeypatch):
    rng = random.Random(3)
    texts = variants(400, rng) + [" ".join(f"y{rng.randrange(300)}" for _ in range(rng.randrange(1, 60))) for _ in range(100)]
    sets = [set(simhash.shingle_set(t).tolist()) for t in texts]
    alike = [(i, j) for i in range(len(texts)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    compared, filed, verify, segments = [], [], simhash._alike, simhash._segments

    def counted(pairs, *more):
        compared.append(pairs.count())
        return verify(pairs, *more)

    monkeypatch.setattr(simhash, "_alike", counted)
    monkeypatch.setattr(simhash, "_segments", lambda fp, tables: filed.append(tables) or segments(fp, tables))
    rows = ready_spark.createDataFrame(list(enumerate(texts)), "node bigint, _text string").repartition(4)
    rows = rows.select("node", F.struct(F.col("node").alias("id")).alias("doc"), F.md5("_text").alias("_digest"), "_text")
    links = [tuple(r) for r in simhash.set_links(rows).select("a", "b").collect()]
    assert smallest(len(texts), links) == smallest(len(texts), alike)
    assert filed and sum(bits for bits, _ in filed[0]) == 256  # the fingerprints' tables are searched
    assert sum(compared) < 25 * len(texts) < len(texts) ** 2 / 10


def test_pairs_that_meet_in_many_entries_are_given_few_times(ready_spark):
    rng = random.Random(5)
    base = [f"w{rng.randrange(10_000)}" for _ in range(400)]
    # 360 common words and 40 of each text's own: every two are alike and have most of their first entries in common.
    texts = [" ".join(base[:360] + [f"z{rng.randrange(10**9)}" for _ in range(40)]) for _ in range(60)]
    members = [(e, (len(t.split()) - 4, node, at), node) for node, t in enumerate(texts) for at, e in enumerate(sorted(simhash.shingle_set(t).view("int64").tolist())[:90])]
    members = ready_spark.createDataFrame(members, "entry bigint, m struct<n: int, node: bigint, at: int>, root bigint")
    maps = ready_spark.createDataFrame([(node, len(t.split()) - 4, *simhash.bits(simhash.shingle_set(t)).view("int64").tolist()) for node, t in enumerate(texts)],
                                       "_node bigint, n int, " + ", ".join(f"_bits{i} bigint" for i in range(simhash.BITS)))
    given = simhash._meeting(members, maps).select("m.node", F.col("o.node").alias("other"))
    other = members.select("entry", F.col("m").alias("o"), F.col("root").alias("root_o"))
    every = members.join(other, "entry").where((F.col("m.node") < F.col("o.node")) & simhash._possible(F.col("m"), F.col("o"))).select("m.node", F.col("o.node").alias("other"))
    assert given.distinct().count() == every.distinct().count() > 1_000
    assert given.count() < 2 * given.distinct().count() < every.count() / 10


def test_equal_texts_are_set_aside_without_a_shuffle_of_texts(ready_spark, monkeypatch):
    plans, write = [], simhash.written

    def noted(df, label):
        if "text" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    monkeypatch.setattr(simhash, "written", noted)
    docs = ready_spark.createDataFrame([(3, "a b c"), (None, "a b c"), (1, "a b c"), (1, "a b c"), (2, "d e f"), (None, "g"), (None, "g")], "doc_id bigint, text string").repartition(3).localCheckpoint()
    left = simhash.one_of_each(docs)
    assert sorted((r["text"], r["doc_id"]) for r in left.collect()) == [("a b c", 1), ("d e f", 2), ("g", None)]
    assert plans and not any("Exchange" in p for p in plans)
