"""Documents packed into fixed-length sequences.

A document's ids and its end id are cut into pieces only if they are longer than a sequence; the first piece takes the
remainder. Pieces are dealt by hash into groups of a bounded size. In each group best fit, longest first, makes the bins, and a local search
then empties the emptiest ones: it moves a piece, exchanges one piece for one, or one for two, between bins with room, whenever that raises the
sum of squared fills. What stands in bins that remain underfull goes on to the next round with fewer groups, down to a single one.

A null or empty text is its end id alone. Repeated rows are packed as often as they occur, ties are broken by
the row's own values, and an empty table gives no rows. Only ``doc_id`` and the text column are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliospark.llm.common import text_or_empty, written
from foliospark.llm.tokens import KNOWN_BYTES, encoder

LENGTH = 2048
END_ID = 0
GROUP_PIECES = 32_768
CLOSED = 0.995  # bins at least this full are not opened again
BIN_BITS, GROUP_BITS = 24, 30

PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint"


def pieces(docs: DataFrame, tokenizer: str, text: str = "text", length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False, known_bytes: int = KNOWN_BYTES) -> DataFrame:
    """One row per piece of every document, with its ids as little-endian bytes if asked for."""
    schema = PIECES + (", ids binary" if with_ids else "")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, known_bytes).encode
        end, columns = np.array([end_id], dtype="<u4").tobytes(), [c.split()[0] for c in schema.split(", ")]
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part, rows = batch.iloc[at:at + 1000], []
                for doc, ids in zip(part["doc_id"].array, encode(part["text"].tolist())):
                    ids += end
                    n = len(ids) // 4
                    stops = range((n - 1) % length + 1, n + 1, length)
                    start = 0
                    for k, stop in enumerate(stops):
                        own = ids[4 * start:4 * stop]
                        rows.append((doc, k, start, stop - start, zlib.crc32(own), own)[:len(columns)])
                        start = stop
                out = pd.DataFrame(rows, columns=columns)
                out["doc_id"] = pd.array(out["doc_id"], dtype="Int64")
                yield out

    return docs.select(F.col("doc_id").cast("bigint"), text_or_empty(text).alias("text")).mapInPandas(cut, schema)


class Bins:
    """The bins of one group; pieces are numbers, known by their length."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.free: list[int] = []

    def best_fit(self) -> None:
        """Longest piece first, each into the fullest bin that takes it."""
        by_room: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        some = 0  # bit r: there is a bin with room r
        for item in sorted(range(len(self.lengths)), key=lambda i: -self.lengths[i]):
            size = self.lengths[item]
            fitting = some >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                at = by_room[room].pop()
                if not by_room[room]:
                    some &= ~(1 << room)
            else:
                room, at = self.capacity, len(self.bins)
                self.bins.append([])
                self.free.append(0)
            self.bins[at].append(item)
            self.free[at] = room - size
            by_room[room - size].append(at)
            some |= 1 << (room - size)

    def local_search(self) -> None:
        """Empty the emptiest bins by exchanges with the other underfull ones."""
        while True:
            open_bins = [b for b in range(len(self.bins)) if self.free[b] and self.bins[b]]
            if sum(self.free[b] for b in open_bins) < self.capacity:
                return  # no bin can be saved
            victim = max(open_bins, key=lambda b: (self.free[b], b))
            if not self._empty(victim, [b for b in open_bins if b != victim]):
                return  # the emptiest cannot be emptied, so no fuller one can

    def _empty(self, victim: int, others: list[int]) -> bool:
        """Shift length from ``victim`` into ``others`` until it is empty or no step raises the squared fill."""
        room = np.array([self.free[b] for b in others])
        owner = np.array([k for k, b in enumerate(others) for _ in self.bins[b]], dtype=np.int64)
        item = np.array([i for b in others for i in self.bins[b]], dtype=np.int64)
        size = np.array(self.lengths)[item] if len(item) else np.zeros(0, dtype=np.int64)
        pairs = self._pairs(owner, size)
        own, touched = sorted(self.bins[victim], key=lambda i: -self.lengths[i]), set()

        def put(x: int, k: int) -> None:
            nonlocal owner, item, size
            owner, item, size = np.append(owner, k), np.append(item, x), np.append(size, self.lengths[x])

        while own:
            step = None
            filled = self.capacity - room
            left = sum(self.lengths[i] for i in own)
            for x in own:  # a move needs room for the whole piece; the fullest bin that has it
                fit = np.flatnonzero(room >= self.lengths[x])
                if len(fit):
                    step = (self.lengths[x], x, int(fit[np.argmin(room[fit])]), ())
                    break
            if step is None:
                for x in own:
                    gain = self.lengths[x] - size
                    ok = (gain > 0) & (gain <= room[owner]) & (filled[owner] + gain > left)
                    if ok.any():
                        j = int(np.argmax(np.where(ok, gain, 0)))
                        if step is None or gain[j] > step[0]:
                            step = (int(gain[j]), x, int(owner[j]), (j,))
                    first, second, both = pairs
                    gain2 = self.lengths[x] - both
                    if len(both):
                        k = owner[first]
                        live = (k == owner[second]) & (k >= 0)
                        ok2 = live & (gain2 > 0) & (gain2 <= room[k]) & (filled[k] + gain2 > left)
                        if ok2.any():
                            j = int(np.argmax(np.where(ok2, gain2, 0)))
                            if step is None or gain2[j] > step[0]:
                                step = (int(gain2[j]), x, int(k[j]), (int(first[j]), int(second[j])))
            if step is None:
                break
            gain, x, k, out = step
            own.remove(x)
            own += [int(item[j]) for j in out]
            for j in out:
                owner[j], size[j] = -1, 2 * self.capacity  # gone from the others: never a gain
            room = room.copy()
            room[k] -= gain
            put(x, k)
            touched.add(k)
        for k, b in enumerate(others):
            if k in touched:
                self.bins[b] = [int(i) for i in item[owner == k]]
                self.free[b] = int(room[k])
        self.bins[victim] = own
        self.free[victim] = self.capacity - sum(self.lengths[i] for i in own)
        return not own

    @staticmethod
    def _pairs(owner: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbouring pieces of the same bin, shortest with next, as (first, second, joint length)."""
        if len(owner) < 2:
            none = np.zeros(0, dtype=np.int64)
            return none, none, none
        order = np.lexsort((size, owner))
        first, second = order[:-1], order[1:]
        same = owner[first] == owner[second]
        first, second = first[same], second[same]
        return first, second, size[first] + size[second]


def _round(table: DataFrame, number: int, groups: int, capacity: int) -> DataFrame:
    columns = [f.name for f in table.schema.fields]
    schema = T.StructType([*table.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("_fill", T.IntegerType())])

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop(columns="_group").sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], ignore_index=True)
        made = Bins(rows["length"].tolist(), capacity)
        made.best_fit()
        made.local_search()
        sequence, offset, fill = (np.zeros(len(rows), dtype=np.int64) for _ in range(3))
        name = (number << (BIN_BITS + GROUP_BITS)) + (int(key[0]) << BIN_BITS)
        for b, items in enumerate(made.bins):
            at = 0
            for i in items:
                sequence[i], offset[i] = name + b, at
                at += made.lengths[i]
            fill[items] = at
        return rows.assign(sequence_id=sequence, offset=offset, _fill=fill.astype(np.int32))

    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.lit(number)), F.lit(groups)).alias("_group")
    return table.select(*columns, group).groupBy("_group").applyInPandas(pack, schema)


def pack(table: DataFrame, capacity: int = LENGTH, group_pieces: int = GROUP_PIECES, closed: float = CLOSED) -> DataFrame:
    """``pieces`` rows with ``sequence_id`` and ``offset``. Repeated rows of one piece meet in one group, the others spread by hash."""
    done, number = None, 0
    n = table.count()
    while True:
        groups = max(1, -(-n // group_pieces))
        packed, _ = written(_round(table, number, groups, capacity), "packed")
        last = groups == 1
        keep = packed if last else packed.where(F.col("_fill") >= closed * capacity)
        keep = keep.drop("_fill")
        done = keep if done is None else done.unionByName(keep)
        if last:
            return done
        table = packed.where(F.col("_fill") < closed * capacity).drop("sequence_id", "offset", "_fill")
        left = table.count()
        if left > n // 2:  # hardly any bin closed: fewer and larger groups must not grow without bound, so these bins stand
            return done.unionByName(packed.where(F.col("_fill") < closed * capacity).drop("_fill"))
        n, number = left, number + 1


def pack_documents(docs: DataFrame, tokenizer: str, text: str = "text", length: int = LENGTH, end_id: int = END_ID, with_ids: bool = False, known_bytes: int = KNOWN_BYTES) -> DataFrame:
    """Tokenize, cut and pack; the pieces are written once, as packing reads them more than once."""
    table, _ = written(pieces(docs, tokenizer, text, length, end_id, with_ids, known_bytes), "pieces")
    return pack(table, length)
