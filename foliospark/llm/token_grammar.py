"""Token ids stored as Re-Pair grammars.

Per shard the most frequent pairs of neighbouring ids become nonterminals, again and again, so long as a pair is frequent.
A shard's file has its rules, the expansion length of each, and the remaining sequence, so a range of ids is decoded without the rest of the shard.
The files are rows of a Parquet folder, one blob per shard: the folder is committed whole, a lost task is run again,
and any file system that Spark reads will do.

Blob: ``RPG1``, then little-endian unsigned 32-bit counts (documents, ids, first nonterminal, rules, symbols, bytes per symbol), the ids per document,
left and right symbol and expansion length per rule (32 bits each), then the symbols.

Documents are in ascending (doc_id, text) order, nulls first; a null or empty text is its end id alone; repeated rows are kept;
an empty table makes an empty folder, which reads as no rows. Only ``doc_id`` and the text column are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliospark.llm.common import text_or_empty
from foliospark.llm.tokens import encoder

END_ID = 2
SHARD_IDS = 1 << 20
MIN_PAIRS = 8  # a rule is made for pairs that occur this often
LEAST_GAIN = 0.002  # a round that shortens the sequence by less is the last
_HASH_BITS = 21
MAGIC = b"RPG1"

SHARDS = "part int, shard int, n_docs int, n_ids bigint, doc_ids array<bigint>, data binary"


def compress(ids: np.ndarray, min_pairs: int = MIN_PAIRS, least_gain: float = LEAST_GAIN) -> tuple[int, np.ndarray, np.ndarray]:
    """(first nonterminal, rules as rows of two symbols, remaining sequence)."""
    first = int(ids.max()) + 1 if len(ids) else 0
    seq, rules, n_rules, limit = ids.astype(np.uint32), [], 0, None
    while len(seq) > 1:
        # Counting by hash bounds each pair's frequency from above without a sort; the pairs taken are then counted exactly.
        spread = (seq[:-1] * np.uint32(0x9E3779B1) + seq[1:]) * np.uint32(0x85EBCA77) >> np.uint32(32 - _HASH_BITS)
        counts = np.bincount(spread, minlength=1 << _HASH_BITS)
        if limit is None:
            limit = max(min_pairs, int(counts.max()) // 4)
        at = np.flatnonzero((counts >= limit)[spread])
        made = 0
        if len(at):
            # In a run of overlapping pairs every other one is taken.
            run = np.arange(len(at))
            start = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, run, 0))
            at = at[(run - start) % 2 == 0]
            pair, rank, used = np.unique(seq[at].astype(np.uint64) << np.uint64(32) | seq[at + 1], return_inverse=True, return_counts=True)
            worth = used >= max(min_pairs, limit // 2)
            number = np.cumsum(worth) - 1
            taken = worth[rank]
            place, made = at[taken], int(taken.sum())
            pair = pair[worth]
            keep = np.ones(len(seq), dtype=bool)
            keep[place + 1] = False
            seq[place] = (first + n_rules + number[rank[taken]]).astype(np.uint32)
            seq = seq[keep]
            rules.append(np.stack([pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)], axis=1).astype(np.uint32))
            n_rules += len(pair)
        if limit == min_pairs and made < least_gain * len(seq):
            break
        limit = max(min_pairs, limit // 4)
    return first, np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.uint32), seq


def lengths_of(first: int, rules: np.ndarray) -> np.ndarray:
    """Expansion length of each rule. A rule only refers to earlier ones, so each pass settles one more level."""
    out = np.zeros(len(rules), dtype=np.int64)
    open_rules = np.arange(len(rules))
    while len(open_rules):
        parts = rules[open_rules].astype(np.int64) - first
        size = np.where(parts < 0, 1, out[np.maximum(parts, 0)])
        ready = (size > 0).all(axis=1)
        out[open_rules[ready]] = size[ready].sum(axis=1)
        open_rules = open_rules[~ready]
    return out


def pack_shard(ids: np.ndarray, doc_lengths: list[int]) -> bytes:
    first, rules, seq = compress(ids)
    top = first + len(rules)
    kind = "<u2" if top <= 1 << 16 else "<u4"
    head = np.array([len(doc_lengths), len(ids), first, len(rules), len(seq), np.dtype(kind).itemsize], dtype="<u4")
    return b"".join([MAGIC, head.tobytes(), np.array(doc_lengths, dtype="<u4").tobytes(), rules[:, 0].astype("<u4").tobytes(), rules[:, 1].astype("<u4").tobytes(),
                     lengths_of(first, rules).astype("<u4").tobytes(), seq.astype(kind).tobytes()])


class Shard:
    """Random access to one blob."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token shard")
        n_docs, self.n_ids, self.first, n_rules, n_seq, width = (int(x) for x in np.frombuffer(data, "<u4", 6, 4))
        at = 28
        parts = []
        for n in (n_docs, n_rules, n_rules, n_rules):
            parts.append(np.frombuffer(data, "<u4", n, at))
            at += 4 * n
        self.doc_lengths, self.left, self.right, self.lengths = parts
        self.seq = np.frombuffer(data, f"<u{width}", n_seq, at).astype(np.int64)
        self.stops = np.cumsum(self._size(self.seq))
        self._flat: tuple[np.ndarray, np.ndarray] | None = None

    def _size(self, symbols: np.ndarray) -> np.ndarray:
        rule = symbols - self.first
        if not len(self.lengths):
            return np.ones(len(symbols), dtype=np.int64)
        return np.where(rule < 0, 1, self.lengths[np.maximum(rule, 0)]).astype(np.int64)

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        """Replace nonterminals level by level until only ids are left."""
        while len(symbols) and (symbols >= self.first).any():
            rule = np.maximum(symbols - self.first, 0)
            is_rule = symbols >= self.first
            out = np.repeat(symbols, 1 + is_rule)
            place = np.flatnonzero(is_rule) + np.arange(is_rule.sum())
            out[place], out[place + 1] = self.left[rule[is_rule]], self.right[rule[is_rule]]
            symbols = out
        return symbols

    def ids(self, start: int = 0, n: int | None = None) -> np.ndarray:
        """``n`` ids from ``start``; only the symbols that cover them are expanded."""
        stop = self.n_ids if n is None else min(self.n_ids, start + n)
        if start >= stop:
            return np.zeros(0, dtype=np.uint32)
        a, b = np.searchsorted(self.stops, start, side="right"), np.searchsorted(self.stops, stop, side="left") + 1
        before = int(self.stops[a - 1]) if a else 0
        return self._expand(self.seq[a:b])[start - before:stop - before].astype(np.uint32)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, text: str = "text", end_id: int = END_ID, shard_ids: int = SHARD_IDS, partitions: int | None = None) -> None:
    """Write the ids of all documents as shards. Ranges of (doc_id, text hash) make the partitions, so ``part``, ``shard`` and the place in a shard follow the document order."""

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, end = TaskContext.get().partitionId(), np.array([end_id], dtype="<u4").tobytes()
        docs, ids, size, number = [], [], 0, 0

        def flush() -> pd.DataFrame:
            blob = pack_shard(np.frombuffer(b"".join(ids), dtype="<u4"), [len(x) // 4 for x in ids])
            return pd.DataFrame({"part": [part], "shard": [number], "n_docs": [len(ids)], "n_ids": [size], "doc_ids": [docs], "data": [blob]})

        for batch in batches:
            for at in range(0, len(batch), 500):
                some = batch.iloc[at:at + 500]
                for doc, own in zip(some["doc_id"].array, encoder(tokenizer).encode(some["text"].tolist())):
                    docs.append(None if pd.isna(doc) else int(doc))
                    ids.append(own + end)
                    size += len(ids[-1]) // 4
                    if size >= shard_ids:
                        yield flush()
                        docs, ids, size, number = [], [], 0, number + 1
        if ids:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("bigint"), text_or_empty(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text").asc()]
    parts = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    ranged.mapInPandas(encode, SHARDS).write.option("compression", "zstd").parquet(path)


def shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards with ``start``, the ids of all shards before. Sums per partition first: one row per partition meets in one task."""
    table = spark.read.schema(SHARDS).parquet(path)
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.select(F.col("part").alias("_part"), F.coalesce(F.sum("_ids").over(before(Window.orderBy("part"))), F.lit(0)).alias("_before"))
    inside = table.select("part", "shard", "n_ids").select(
        F.col("part").alias("_p"), F.col("shard").alias("_s"), F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("shard"))), F.lit(0)).alias("_inside"))
    starts = inside.join(parts, F.col("_p") == F.col("_part")).select("_p", "_s", (F.col("_before") + F.col("_inside")).alias("start"))
    return table.join(starts, (F.col("part") == F.col("_p")) & (F.col("shard") == F.col("_s"))).drop("_p", "_s")


def _decoded(spark: SparkSession, path: str, last: str, value) -> DataFrame:
    """Per document doc_id, start, n_tokens and ``value`` of its ids as little-endian bytes."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, docs, data in zip(batch["start"], batch["doc_ids"], batch["data"]):
                shard = Shard(data)
                ids, stops = memoryview(shard.ids().astype("<u4").tobytes()), np.cumsum(shard.doc_lengths, dtype=np.int64)
                begins = stops - shard.doc_lengths
                yield pd.DataFrame({"doc_id": pd.array([None if d is None or d != d else int(d) for d in docs], dtype="Int64"), "start": start + begins, "n_tokens": shard.doc_lengths.astype(np.int64),
                                    last.split()[0]: [value(ids[4 * a:4 * b]) for a, b in zip(begins, stops)]})

    return shards(spark, path).select("start", "doc_ids", "data").mapInPandas(decode, f"doc_id bigint, start bigint, n_tokens bigint, {last}")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens and its ids as little-endian bytes, decoded from the files."""
    return _decoded(spark, path, "ids binary", bytes)


def read_range(spark: SparkSession, path: str, start: int, n: int) -> DataFrame:
    """The ids from place ``start`` on, a row per shard touched; a shard expands only the symbols that cover its part."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for begin, data in zip(batch["start"], batch["data"]):
                shard = Shard(data)
                low = max(0, start - begin)
                got = shard.ids(low, start + n - begin - low)
                yield pd.DataFrame({"start": [begin + low], "ids": [got.tolist()]})

    touched = shards(spark, path).where((F.col("start") < start + n) & (F.col("start") + F.col("n_ids") > start))
    return touched.select("start", "data").mapInPandas(decode, "start bigint, ids array<bigint>")


def document_digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and the CRC-32 of each document's ids, read back from the files."""
    return _decoded(spark, path, "ids_crc32 bigint", zlib.crc32)
