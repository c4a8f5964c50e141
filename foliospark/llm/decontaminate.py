"""Benchmark passages in documents, within an edit distance.

Texts are strings of words. A passage is a run of words of a document whose edit distance from a benchmark item, counted in words, is at most ``EDITS`` of the
item's length; it can be longer or shorter than the item, and lie at an end of the document.

An edit spoils at most two neighbouring pairs of words, so a passage of at most length + edits words keeps length - 1 - 2 * edits pairs of its item. Places with
so many pairs of the items of one length are looked at, and there the items that have so many; their exact distance, with free ends, decides. So every passage is found.
Documents are scanned where they lie; the items are sent to every task in blocks of ``BLOCK_ITEMS``, one pass per block, so their size is bounded.

Words are ASCII letters in lower case, digits, and anything beyond ASCII. An item of fewer than ``LEAST_WORDS`` words cannot be told from chance and is not
looked for. Null and empty texts have no passages; a null id is reported as null; repeated rows or items are reported each. Per document and item the closest passage is given, of equal ones
the one that ends first and is nearest to the item in length; ``n_words`` is the item's length. An empty benchmark finds nothing, an empty table
gives no rows. Very long texts are searched whole. ``clean`` keeps the documents' own columns, whatever their names; ``contaminated`` reads ``doc_id`` and the text only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import held, keeps_columns
from foliospark.sources.tables import stage

EDITS = 0.2
LEAST_WORDS = 5
BLOCK_ITEMS = 20_000
SCAN_WORDS = 200_000
_MASK = (1 << 22) - 1
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))

PASSAGES = "array<struct<item_id:bigint,word_start:int,n_words:int,edits:int>>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_CLEAN).split()


def edit_distance(a: list[int], b: list[int], most: int) -> int:
    """Edit distance, or ``most`` + 1 if it is larger; only cells within ``most`` of the diagonal are filled."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        low, high = max(1, i - most), min(len(b), i + most)
        above, row[0] = row[low - 1], i
        left = i if low == 1 else most + 1
        best = left
        for j in range(low, high + 1):
            here = above if x == b[j - 1] else 1 + min(above, row[j] if j < i + most else most + 1, left)
            above, row[j] = row[j], here
            left = here
            best = min(best, here)
        if best > most:
            return most + 1
    return min(row[len(b)], most + 1)


def closest(item: list[int], text: list[int]) -> tuple[int, int]:
    """The least edit distance of the item from any run of words of the text, and where the first such run ends (Myers' bit vectors)."""
    n = len(item)
    at: dict[int, int] = {}
    for i, x in enumerate(item):
        at[x] = at.get(x, 0) | 1 << i
    every, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best, stop = every, 0, n, n, 0
    for j, x in enumerate(text, 1):
        equal = at.get(x, 0)
        v = equal | down
        h = (((equal & up) + up) ^ up) | equal
        right, left = (down | ~(h | up)) & every, up & h
        if right & top:
            score += 1
        elif left & top:
            score -= 1
            if score < best:
                best, stop = score, j
        right, left = right << 1 & every, left << 1 & every
        up, down = (left | ~(v | right)) & every, right & v
    return best, stop


class Benchmark:
    """The index of one block of items."""

    def __init__(self, items: list[tuple[int | None, str]]):
        found = [(i, words(t)) for i, t in items]
        found = [(i, w) for i, w in found if len(w) >= LEAST_WORDS]
        self.number: dict[bytes, int] = {}
        self.ids, self.items = [i for i, _ in found], [[self.number.setdefault(x, len(self.number) + 1) for x in w] for _, w in found]
        self.pairs = np.zeros(_MASK + 1, dtype=bool)
        self.by_length: dict[int, list[int]] = {}
        self.having: dict[tuple[int, int], list[int]] = {}  # the items by length and pair
        pairs_of: dict[int, list[np.ndarray]] = {}
        for k, item in enumerate(self.items):
            own = np.array(item, dtype=np.int64)
            codes = self._pair(own[:-1], own[1:])
            self.pairs[codes] = True
            self.by_length.setdefault(len(item), []).append(k)
            pairs_of.setdefault(len(item), []).append(codes)
            for c in set(codes.tolist()):
                self.having.setdefault((len(item), c), []).append(k)
        self.repeats = any((np.diff(item) == 0).any() for item in self.items)
        self.pairs_of = {n: np.unique(np.concatenate(codes)) for n, codes in pairs_of.items()}
        self.edits = {n: int(EDITS * n) for n in self.by_length}

    @staticmethod
    def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a * 1_000_003 + b) & _MASK

    def search(self, texts: list[str | None]) -> list[list[tuple]]:
        """Per text its passages: (item id, first word, words, edits)."""
        out: list[list[tuple]] = []
        at = 0
        while at < len(texts):
            coded, stop, n = [], at, 0
            while stop < len(texts) and n < SCAN_WORDS:
                own = words(texts[stop])
                coded.append(np.fromiter(map(self.number.get, own, [0] * len(own)), dtype=np.int64, count=len(own)))
                n += len(own) + 1
                stop += 1
            out += self._scan(coded)
            at = stop
        return out

    def _scan(self, coded: list[np.ndarray]) -> list[list[tuple]]:
        gap = np.zeros(1, dtype=np.int64)
        run = np.concatenate([x for c in coded for x in (c, gap)])
        begin = np.cumsum([0] + [len(c) + 1 for c in coded])
        code = self._pair(run[:-1], run[1:])
        good = self.pairs[code] & (run[:-1] > 0) & (run[1:] > 0)
        if not self.repeats:  # of a pair said over and over only one can be in a passage
            good[1:] &= (run[:-2] != run[1:-1]) | (run[1:-1] != run[2:])
        shared = np.flatnonzero(good)
        code = code[shared]

        best: list[dict[int, tuple]] = [{} for _ in coded]
        for n, most in self.edits.items():
            need, span = n - 1 - 2 * most, n + most

            def dense(places: np.ndarray) -> np.ndarray:
                """Which places have enough of the places in a longest passage from there on."""
                return np.searchsorted(places, places + span - 1) - np.arange(len(places)) >= need

            if not dense(shared).any():
                continue
            mine = np.isin(code, self.pairs_of[n])  # the pairs of the items of this length
            own, own_code = shared[mine], code[mine]
            starts = own[dense(own)]
            if not len(starts):
                continue
            doc = np.searchsorted(begin, starts, side="right") - 1
            low, high = np.maximum(starts - span, begin[doc]), np.minimum(starts + span, begin[doc + 1] - 1)
            first = np.flatnonzero(np.concatenate([[True], low[1:] > high[:-1]]))  # of each run of overlapping places
            last = np.concatenate([first[1:], [len(starts)]]) - 1
            for d, a, b in zip(doc[first].tolist(), low[first].tolist(), high[last].tolist()):
                inside = own_code[np.searchsorted(own, a):np.searchsorted(own, b - 1)]
                self._verify(run[a:b].tolist(), a - int(begin[d]), inside.tolist(), n, most, need, best[d])
        return [[(self.ids[k], start, n, edits) for k, (edits, start, n) in sorted(b.items())] for b in best]

    def _verify(self, text: list[int], offset: int, codes: list[int], n: int, most: int, need: int, best: dict[int, tuple]) -> None:
        counts: dict[int, int] = {}
        for c in codes:
            for k in self.having[n, c]:
                counts[k] = counts.get(k, 0) + 1
        for k, count in counts.items():
            bound = min(most, best[k][0] - 1) if k in best else most
            if count < need or bound < 0:
                continue
            edits, stop = closest(self.items[k], text)
            if edits <= bound:
                lengths = sorted(range(max(n - edits, 0), min(n + edits, stop) + 1), key=lambda x: (abs(x - n), -x))
                length = next(x for x in lengths if edit_distance(text[stop - x:stop], self.items[k], edits) <= edits)
                best[k] = (edits, offset + stop - length, n)


def _searcher(shared: Broadcast):
    name = str(uuid.uuid4())  # under which a worker keeps the index

    @F.pandas_udf(PASSAGES)
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = held(name, lambda: Benchmark(shared.value))
        for batch in batches:
            yield pd.Series([[dict(zip(("item_id", "word_start", "n_words", "edits"), p)) for p in found] for found in index.search(batch.tolist())])

    return search


def passages(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> Iterator[Column]:
    """For each block of items the column of their passages in a text. A block is read when its column is asked for."""
    context = docs.sparkSession.sparkContext
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where(F.col("text").isNotNull())
    blocks = max(1, -(-items.count() // BLOCK_ITEMS))
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for block in range(blocks):
        rows = [(r["item_id"], r["text"]) for r in items.where(block_of == block).collect()]
        yield _searcher(context.broadcast(rows))(F.col(f"`{text}`"))


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """A row per document and item found in it: doc_id, item_id, word_start, n_words, edits. Each block of items is a pass of its own, so a worker holds one block."""
    parts = [docs.select("doc_id", F.explode(found).alias("_p")).select("doc_id", "_p.*") for found in passages(docs, benchmark, text)]
    return reduce(DataFrame.unionByName, parts)


@keeps_columns
def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a benchmark passage, with their columns."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    for number, found in enumerate(passages(docs, benchmark, text)):
        rest = stage(docs, "clean") if number else docs  # of the blocks before
        docs = rest.withColumn("_found", found).where(F.size("_found") == 0).select(*columns)
    return docs
