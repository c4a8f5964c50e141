"""Runs of words that repeat with a period, found by seed and extend on the diagonals of a text.

A run is a stretch of words with smallest period q (words q apart are equal) and at least ``max(LEAST, TIMES * q)`` words that no neighbouring word extends. Two words q apart
lie on diagonal q, so a run is a stretch of at least ``max(LEAST - q, (TIMES - 1) * q)`` matches there. For the lags from 2^j to 2^(j+1) - 1 that guarantees a common k-gram of
k = 3 * 2^j words (5 for lag 1). As k is not below the lag, two occurrences nearer than the period would give the run a smaller one; so the first k-gram of a run
and its next occurrence are neighbours in the k-gram's list, and only neighbours in the lists are paired: a stretch of one word said n times gives n pairs, not n squared.
K-grams are told apart exactly, by numbering pairs of shorter ones, and only places whose shorter ones come again in the same document are numbered on. A pair is extended both ways, word by word; a
table of the furthest place covered per lag skips pairs inside a stretch already found.

Words are runs of anything but blank and ASCII control space, compared as they are. Null and empty texts have no words and no runs; a null id stays null; repeated rows are each looked at; an empty table
gives none. Documents are taken whole, a very long one by itself, with memory in proportion to its words. Only ``doc_id`` and the text are read, so further columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST, TIMES = 6, 4
SCAN_WORDS = 200_000

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary"


class _Grams:
    """The places of the k-grams that come again, and a number for each k-gram."""

    def __init__(self, n: int, at: np.ndarray, key: np.ndarray):
        _, rank, count = np.unique(key, return_inverse=True, return_counts=True)
        again = count[rank] > 1
        self.at, self.rank = at[again], rank[again]
        self.full = np.full(n, -1, dtype=np.int64)
        self.full[self.at] = self.rank

    def followed(self, other: _Grams, shift: int) -> _Grams:
        """The longer grams of one at a place and ``other`` at ``shift`` words on."""
        n = len(self.full)
        inside = self.at + shift < n
        at, rank = self.at[inside], self.rank[inside]
        then = other.full[at + shift]
        good = then >= 0
        return _Grams(n, at[good], rank[good] * np.int64(n) + then[good])

    def neighbours(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, lag) of a gram's occurrences next to each other with ``low`` <= lag < ``high``."""
        order = np.argsort(self.rank, kind="stable")
        at, rank = self.at[order], self.rank[order]
        lag = np.diff(at)
        good = (rank[1:] == rank[:-1]) & (lag >= low) & (lag < high)
        return at[:-1][good], lag[good]


def _seeds(ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, places, lags) for each span of lags; ids of different documents differ."""
    n = len(ids)
    one = _Grams(n, np.arange(n), ids)
    two = one.followed(one, 1)
    four = two.followed(two, 2)
    grams = four.followed(one, 4)
    yield (5, *grams.neighbours(1, 2))
    grams, k, low = grams.followed(grams, 1), 6, 2
    while len(grams.at) and TIMES * low <= n:
        yield (k, *grams.neighbours(low, 2 * low))
        grams, k, low = grams.followed(grams, k), 2 * k, 2 * low


def _forth(ids: np.ndarray, a: int, lag: int) -> int:
    """The first place from ``a`` on whose word differs from that ``lag`` words on."""
    step = 64
    while True:
        later = ids[a + lag:a + lag + step]
        differ = np.flatnonzero(ids[a:a + len(later)] != later)
        if len(differ):
            return a + int(differ[0])
        a += len(later)
        if len(later) < step:
            return a
        step *= 4


def _back(ids: np.ndarray, a: int, lag: int) -> int:
    """The first place of the stretch of matches that ends before ``a``."""
    step = 64
    while a > 0:
        low = max(0, a - step)
        differ = np.flatnonzero(ids[low:a] != ids[low + lag:a + lag])
        if len(differ):
            return low + int(differ[-1]) + 1
        a, step = low, step * 4
    return a


def runs_of(ids: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) by start and period, of one or more documents whose ids differ."""
    found: dict[tuple[int, int], int] = {}
    covered: dict[int, int] = {}
    for k, places, lags in _seeds(ids):
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        fresh = np.ones(len(places), dtype=bool)
        fresh[1:] = (np.diff(lags) != 0) | (np.diff(places) != 1)
        for at, lag in zip(places[fresh].tolist(), lags[fresh].tolist()):
            if at < covered.get(lag, 0):
                continue
            start, stop = _back(ids, at, lag), _forth(ids, at + k, lag)
            covered[lag] = stop
            length = stop - start + lag
            if length >= max(LEAST, TIMES * lag):
                found[start, length] = min(lag, found.get((start, length), lag))
    out = np.array([(s, n, q) for (s, n), q in found.items()], dtype=np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words no run repeats: all but those after the first period of a run."""
    depth = np.zeros(n + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(depth[:-1]) == 0


def _searched(texts: list[list[bytes]]) -> tuple[list[np.ndarray], list[bytes]]:
    """Per document its runs and its text with every run cut to one period."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    words = [w for t in texts for w in t]
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
    doc = np.repeat(np.arange(len(texts)), sizes)
    every = runs_of(doc * max(1, len(number)) + codes)
    begin = np.concatenate([[0], np.cumsum(sizes)])
    cuts = np.searchsorted(every[:, 0], begin)
    runs, collapsed = [], []
    for d, own in enumerate(texts):
        mine = every[cuts[d]:cuts[d + 1]] - [begin[d], 0, 0]
        runs.append(mine)
        kept = own if not len(mine) else [own[i] for i in np.flatnonzero(_kept(len(own), mine)).tolist()]
        collapsed.append(b" ".join(kept))
    return runs, collapsed


def find(docs: DataFrame, text: str = "text", edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per document: doc_id, n_words, its ``runs`` by start and period, and ``collapsed``, the words without those after a run's first period, joined by one blank.

    ``edit`` changes the words of a document before the search.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            some: list[list[bytes]] = []
            done, n = 0, 0
            for i, value in enumerate(batch.column("text").to_pylist()):
                own = (value or b"").split()
                some.append(edit(ids[i], own) if edit else own)
                n += len(some[-1])
                if n >= SCAN_WORDS or i == len(ids) - 1:
                    runs, collapsed = _searched(some)
                    flat = np.concatenate(runs) if runs else np.zeros((0, 3), dtype=np.int64)
                    offsets = np.cumsum([0, *map(len, runs)])
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(flat[:, j], pa.int64()) for j in range(3)], fields=list(RUN)))
                    yield pa.RecordBatch.from_arrays([pa.array(ids[done:i + 1], pa.int64()), pa.array([len(t) for t in some], pa.int64()), lists, pa.array(collapsed, pa.binary())],
                                                     names=["doc_id", "n_words", "runs", "collapsed"])
                    some, done, n = [], i + 1, 0

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col(f"`{text}`").cast("binary").alias("text"))
    return rows.mapInArrow(search, FOUND).withColumn("collapsed", F.col("collapsed").cast("string"))


def strongest(runs: Column) -> Column:
    """The run that repeats most often; of equal ones the first by start, then period. Null without runs."""
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document, from some place on replaced by their first few over and over in one document of ten, by the CRC-32 of its decimal id."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return words[:a] + (unit * (-(-(n - a) // p)))[:n - a]
