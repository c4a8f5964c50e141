"""How far the sources of a language differ in their words: exact divergences of every pair of sources, and the words each source overuses.

Counting is single-pass in-memory indexing. A task counts terms per source and documents per term until its block takes ``BLOCK_BYTES``, then spills it as runs sorted by
term, one per language and hash shard of the terms. The runs of a shard are merged with a heap, about ``FAN_IN`` at most at a time and in rounds, into the frequencies of each term in each source. Terms in fewer than ``MIN_DOCS`` documents of the language are dropped there.

The divergence of two sources is a sum over all kept terms, most of which neither has. It is that of "neither" times the number of terms, and corrections: for the terms of one
source, taken once per distinct count, and for the terms that both have, which are streamed through and summed per pair within each task. So no table of all
terms by all sources is made, and all sums are whole numbers.

Terms are runs of Latin letters and anything beyond ASCII, A-Z in lower case. Null text, language and source are read as empty; equal rows count each; a document without terms
still makes its source occur; a language without kept terms gives pairs of value 0. Ties are ordered by name, in UTF-8. Very long texts are counted in parts.
An empty table gives none. Only the text, ``lang`` and ``source`` are read, so further columns cannot clash.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import small, text_or_empty, written
from foliospark.sources.tables import stage

MIN_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
BLOCK_BYTES = 64 << 20
ENTRY_BYTES = 160  # of a term in a dictionary
FAN_IN = 256
PART_BYTES = 4 << 20
PAIRS_AT_ONCE = 1 << 20

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
_LONGS, _NAMES = pa.list_(pa.int64()), pa.list_(pa.binary())
RUNS = pa.schema([("lang", pa.string()), ("shard", pa.int32()), ("run", pa.int64()), ("sources", pa.list_(pa.string())), ("terms", _NAMES), ("docs", _LONGS), ("sizes", _LONGS), ("at", _LONGS), ("n", _LONGS)])
RUN_ROW = "lang string, shard int, run bigint, sources array<string>, terms array<binary>, docs array<bigint>, sizes array<bigint>, at array<bigint>, n array<bigint>"
FREQUENCIES = "lang string, term binary, docs bigint, total bigint, postings array<struct<source:string,n:bigint>>"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, part by part."""
    clean, at = text.translate(_LETTERS), 0
    while at < len(clean):
        stop = clean.find(b" ", at + PART_BYTES)
        stop = len(clean) if stop < 0 else stop
        yield clean[at:stop].split()
        at = stop


class Block:
    """Term counts per language and source, and the documents per term and language."""

    def __init__(self):
        self.counts: dict[str, dict[str, Counter]] = {}
        self.docs: dict[str, Counter] = {}
        self.bytes = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts = self.counts.setdefault(lang, {}).setdefault(source, Counter())
        docs = self.docs.setdefault(lang, Counter())
        before, seen, n = len(counts) + len(docs), set(), 0
        for terms in terms_of(text):
            counts.update(terms)
            seen.update(terms)
            n += len(terms)
        docs.update(seen)
        self.bytes += ENTRY_BYTES * (len(counts) + len(docs) - before) + (len(text) if len(text) > 64 * n else 0)

    def runs(self, run: int, shards: int) -> Iterator[pa.RecordBatch]:
        """A run per language and shard of its terms."""
        for lang in sorted(self.docs):
            terms = sorted(self.docs[lang])
            place = {t: i for i, t in enumerate(terms)}
            docs = np.fromiter(map(self.docs[lang].__getitem__, terms), dtype=np.int64, count=len(terms))
            sources = sorted(self.counts[lang])
            own = [self.counts[lang][s] for s in sources]
            term = np.concatenate([np.fromiter(map(place.__getitem__, c), dtype=np.int64, count=len(c)) for c in own])
            n = np.concatenate([np.fromiter(c.values(), dtype=np.int64, count=len(c)) for c in own])
            at = np.repeat(np.arange(len(own)), [len(c) for c in own])
            order = np.lexsort((at, term))
            term, at, n = term[order], at[order], n[order]
            shard = np.fromiter(map(zlib.crc32, terms), dtype=np.int64, count=len(terms)) % shards
            for k in np.unique(shard).tolist():
                mine = np.flatnonzero(shard == k)
                here = shard[term] == k
                yield _run(lang, k, run, sources, [terms[i] for i in mine.tolist()], docs[mine], np.bincount(term, minlength=len(terms))[mine], at[here], n[here])


def _run(lang: str, shard: int, run: int, sources: list[str], terms: list[bytes], *numbers: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([shard], pa.int32()), pa.array([run], pa.int64()), pa.array([sources], pa.list_(pa.string())), pa.array([terms], _NAMES),
                                       *[pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x, pa.int64())) for x in numbers]], schema=RUNS)


def spilled(docs: DataFrame, text: str = "text", shards: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The runs of all documents; ``run`` counts up within a language and shard over the tasks."""
    spread = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, run = Block(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for lang, source, own in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                block.add(lang, source, own)
                if block.bytes >= block_bytes:
                    yield from block.runs(run, spread)
                    block, run = Block(), run + 1
        yield from block.runs(run, spread)

    rows = docs.select(text_or_empty("lang").cast("string").alias("lang"), text_or_empty("source").cast("string").alias("source"), text_or_empty(text).cast("binary").alias("text"))
    return rows.mapInArrow(index, RUN_ROW)


def _merge(runs: pa.Table) -> tuple[list[str], list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(sources, terms, docs, sizes, at, n) of runs of one language and shard, merged by a heap."""
    names, lists = runs.column("sources").to_pylist(), runs.column("terms").to_pylist()
    docs, sizes, at, n = (runs.column(c).combine_chunks().flatten().to_numpy() for c in ("docs", "sizes", "at", "n"))
    base = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    terms: list[bytes] = []
    group, place = [], []
    for term, number in heapq.merge(*[zip(x, range(int(b), int(b) + len(x))) for x, b in zip(lists, base)]):
        if not terms or term != terms[-1]:
            terms.append(term)
        group.append(len(terms) - 1)
        place.append(number)
    group, place = np.array(group, dtype=np.int64), np.array(place, dtype=np.int64)
    docs_of = np.zeros(len(terms), dtype=np.int64)
    np.add.at(docs_of, group, docs[place])
    sources = sorted({s for some in names for s in some})
    code = {s: i for i, s in enumerate(sources)}
    # The postings' sources by number, then the postings' terms in merged order.
    run_of = np.repeat(np.arange(len(lists)), np.diff(base))
    posting_run = np.repeat(run_of, sizes)
    offset = np.concatenate([[0], np.cumsum([len(s) for s in names])])[:-1]
    at = np.array([code[s] for some in names for s in some], dtype=np.int64)[at + offset[posting_run]]
    group_of = np.empty(len(place), dtype=np.int64)
    group_of[place] = group
    key, back = np.unique(np.repeat(group_of, sizes) * max(1, len(sources)) + at, return_inverse=True)
    sums = np.zeros(len(key), dtype=np.int64)
    np.add.at(sums, back, n)
    own, at = np.divmod(key, max(1, len(sources)))
    return sources, terms, docs_of, np.bincount(own, minlength=len(terms)), at, sums


def frequencies(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, shards: int | None = None, block_bytes: int = BLOCK_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """(lang, term, docs, total, postings) of the terms in at least ``min_docs`` documents of a language."""
    runs = stage(spilled(docs, text, shards, block_bytes), "runs")

    def merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sources, terms, *numbers = _merge(table)
        return pa.Table.from_batches([_run(key[0].as_py(), key[1].as_py(), key[2].as_py(), sources, terms, *numbers)])

    def finish(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        sources, terms, docs_of, sizes, at, n = _merge(table)
        kept = docs_of >= min_docs
        here = np.repeat(kept, sizes)
        stops = np.concatenate([[0], np.cumsum(sizes[kept])])
        total = np.zeros(int(kept.sum()), dtype=np.int64)
        np.add.at(total, np.repeat(np.arange(len(total)), sizes[kept]), n[here])
        postings = pa.StructArray.from_arrays([pa.array(sources, pa.string()).take(pa.array(at[here], pa.int64())), pa.array(n[here], pa.int64())], names=["source", "n"])
        return pa.Table.from_arrays([pa.array([key[0].as_py()] * len(total), pa.string()), pa.array([terms[i] for i in np.flatnonzero(kept).tolist()], pa.binary()), pa.array(docs_of[kept], pa.int64()),
                                     pa.array(total, pa.int64()), pa.ListArray.from_arrays(pa.array(stops, pa.int32()), postings)], names=["lang", "term", "docs", "total", "postings"])

    while (most := runs.groupBy("lang", "shard").count().agg(F.max("count")).first()[0] or 0) > fan_in:
        group = F.pmod(F.xxhash64("run"), F.lit(-(-2 * most // fan_in)))  # about half of ``fan_in`` runs each
        runs = stage(runs.withColumn("run", group).groupBy("lang", "shard", "run").applyInArrow(merge, RUN_ROW), "runs")
    return runs.groupBy("lang", "shard").applyInArrow(finish, FREQUENCIES).withColumn("term", F.col("term").cast("string"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """The smoothed share of a count in whole parts of ``SCALE``, from 1 on."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", top, (total + 2 * terms).cast("decimal(19,0)"))


def divergence(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections for terms that both sources of a pair have, summed per pair."""
    sums: dict[tuple[str, str, str], int] = {}

    def flush() -> pa.RecordBatch:
        keys = list(sums)
        out = pa.RecordBatch.from_arrays([pa.array([k[j] for k in keys], pa.string()) for j in range(3)] + [pa.array(list(sums.values()), pa.int64())], names=["lang", "a", "b", "f"])
        sums.clear()
        return out

    for batch in batches:
        postings = batch.column("postings").flatten()
        names = postings.field("source").dictionary_encode()
        source, p, none = np.asarray(names.indices), np.asarray(postings.field("p")), np.asarray(postings.field("p0"))
        names, langs = names.dictionary.to_pylist(), batch.column("lang").dictionary_encode()
        size = np.asarray(batch.column("postings").value_lengths()).astype(np.int64)
        lang = np.repeat(np.asarray(langs.indices).astype(np.int64), size)
        langs = langs.dictionary.to_pylist()
        later = np.repeat(np.cumsum(size), size) - np.arange(len(p)) - 1  # partners after each posting in its term
        cuts = np.searchsorted(np.cumsum(later), np.arange(0, int(later.sum()) + PAIRS_AT_ONCE, PAIRS_AT_ONCE), side="left")
        for low, high in zip(cuts, [*cuts[1:], len(p)]):
            n = later[low:high]
            left = np.repeat(np.arange(low, high), n)
            right = left + 1 + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
            f = _f(p[left], p[right]) - _f(p[left], none[right]) - _f(none[left], p[right]) + _f(none[left], none[right])
            key, back = np.unique((lang[left] * len(names) + source[left]) * len(names) + source[right], return_inverse=True)
            total = np.zeros(len(key), dtype=np.int64)
            np.add.at(total, back, f)
            for k, value in zip(key.tolist(), total.tolist()):
                k, b = divmod(k, len(names))
                k, a = divmod(k, len(names))
                a, b = sorted((names[a], names[b]))
                sums[langs[k], a, b] = sums.get((langs[k], a, b), 0) + value
            if len(sums) >= PAIRS_AT_ONCE:
                yield flush()
    if sums:
        yield flush()


def audit(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS, top: int = TOP_TERMS, **settings) -> DataFrame:
    """(lang, source, part, item, value, rank): part ``pair`` has every other source of the language, part ``term`` the ``top`` terms that a source uses more than its language."""
    table, _ = written(frequencies(docs, text, min_docs, **settings), "frequencies")
    postings = table.select("lang", "term", "total", F.inline("postings"))
    counted = postings.groupBy("lang", "source").agg(F.sum("n").alias("n_source"))
    occurring = docs.select(text_or_empty("lang").cast("string").alias("lang"), text_or_empty("source").cast("string").alias("source")).distinct()
    vocabulary = table.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("n_lang"))
    zero = F.lit(0).cast("bigint")
    groups = occurring.join(counted, ["lang", "source"], "left").join(vocabulary, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("n_source", "terms", "n_lang")])
    # Without kept terms nothing is shared out, and any share will do.
    groups = groups.withColumn("p0", F.when(F.col("terms") > 0, share(zero, F.col("n_source"), F.col("terms"))).otherwise(1))
    groups, n_groups = written(groups, "groups")
    known = small(groups, n_groups)

    p = share(F.col("n"), F.col("n_source"), F.col("terms"))
    shares = postings.join(known, ["lang", "source"]).select("lang", "source", "term", "total", "n", "n_lang", "terms", "p0", p.alias("p"))
    shares, _ = written(shares, "shares")

    q = share(F.col("total"), F.col("n_lang"), F.col("terms"))
    over = shares.select("lang", "source", F.col("term").alias("item"), "p", q.alias("q")).where(F.col("p") > F.col("q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    words = over.select("lang", "source", F.lit("term").alias("part"), "item", divergence(F.col("p"), F.col("q")).alias("value")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    a, b = groups.select("lang", F.col("source").alias("a"), F.col("p0").alias("p_a"), "terms"), known.select("lang", F.col("source").alias("b"), F.col("p0").alias("p_b"))
    neither = a.join(b, "lang").where(F.col("a") != F.col("b")).select("lang", "a", "b", (F.col("terms") * divergence(F.col("p_a"), F.col("p_b"))).alias("f"))
    times = shares.groupBy("lang", F.col("source").alias("a"), "p", F.col("p0").alias("p_a")).agg(F.count(F.lit(1)).alias("k"))
    one = times.join(b, "lang").where(F.col("a") != F.col("b")).select(
        "lang", "a", "b", (F.col("k") * (divergence(F.col("p"), F.col("p_b")) - divergence(F.col("p_a"), F.col("p_b")))).alias("f")).groupBy("lang", "a", "b").agg(F.sum("f").alias("f"))
    both = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "p0")).alias("postings")).select("lang", "postings").mapInArrow(_shared, "lang string, a string, b string, f bigint")
    turned = lambda d: d.unionByName(d.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "f"))
    pairs = neither.unionByName(turned(one)).unionByName(turned(both)).groupBy("lang", F.col("a").alias("source"), F.col("b").alias("item")).agg(F.sum("f").alias("value"))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(words)
