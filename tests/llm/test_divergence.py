"""Source divergences against counting in plain Python."""

import random
import re
from collections import Counter, defaultdict

import pytest

from foliospark.llm import divergence
from foliospark.llm.queries import ORACLES, QUERIES
from tests.conftest import SF
from tests.llm.conftest import ROWS
from tools.compare import connect, difference

SCHEMA = "doc_id bigint, text string, lang string, source string"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def expected(rows, min_docs, top=10):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        found = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower(text or ""))
        groups[lang].add(source)
        count[lang, source].update(found)
        docs[lang].update(set(found))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        v = len(kept)
        p = {}
        for s in [*sources, None]:
            n = {t: count[lang, s][t] if s is not None else sum(count[lang, x][t] for x in sources) for t in kept}
            p[s] = {t: 1 + 1_000_000_000 * (n[t] + 2) // (sum(n.values()) + 2 * v) for t in kept}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(-sum(f(p[s][t], p[x][t]) for t in kept), x) for x in sources if x != s]
            terms = [(-f(p[s][t], p[None][t]), t) for t in kept if count[lang, s][t] and p[s][t] > p[None][t]]
            for part, some in (("pair", pairs), ("term", terms)):
                ranked = sorted(some, key=lambda x: (x[0], x[1].encode()))
                out |= {(lang, s, part, item, -value, i) for i, (value, item) in enumerate(ranked[:None if part == "pair" else top], 1)}
    return out


def rows_of(df):
    rows = df.collect()
    out = {tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("block_bytes, fan_in, parts", [(divergence.BLOCK_BYTES, divergence.FAN_IN, 3), (4_000, 3, 5)])
def test_against_counting(ready_spark, block_bytes, fan_in, parts):
    rng = random.Random(3)
    words = ["Ab", "ab", "été", "É", "x1y", "don't", "日本", "😀", "zz", "ﬀ", *(f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9))]
    rows = [(i, " ".join(rng.choices(words, weights=range(len(words), 0, -1), k=rng.randrange(40))), rng.choice(["en", "de", "", None]), rng.choice(["a", "a", "a", "b", "c", "", None, "Ω"])) for i in range(300)]
    rows += rows[:20] + [(None, None, "xx", "only"), (1, "Rare words", "xx", "other"), (2, "", "yy", "alone")]
    docs = ready_spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = rows_of(divergence.audit(docs, min_docs=4, block_bytes=block_bytes, fan_in=fan_in, shards=3))
    assert got == expected(rows, 4)


def test_blocks_spill_sorted_runs(ready_spark):
    docs = ready_spark.read.parquet(f"{SF}/documents.parquet")
    runs = divergence.spilled(docs, shards=4, block_bytes=200_000).collect()
    assert all(r["terms"] == sorted(r["terms"]) and len(r["terms"]) == len(r["sizes"]) == len(r["docs"]) and sum(r["sizes"]) == len(r["at"]) == len(r["n"]) for r in runs)
    assert len({r["run"] for r in runs}) > 4


def test_query(ready_spark):
    got = QUERIES["op11_source_divergence"](ready_spark, SF)
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    assert difference(got.toPandas(), connect(SF).execute(ORACLES["op11_source_divergence"]).df()) is None


def test_edges(edge, empty):
    got = rows_of(divergence.audit(edge, min_docs=2))
    assert got == expected(ROWS, 2)
    assert divergence.audit(empty).count() == 0


def test_long_texts_in_parts():
    text = b"Abc d\xc3\xa9f, " * 1_000_000
    parts = list(divergence.terms_of(text))
    assert len(parts) > 1 and sum(map(len, parts)) == 2_000_000 and {t for p in parts for t in p} == {b"abc", b"d\xc3\xa9f"}
