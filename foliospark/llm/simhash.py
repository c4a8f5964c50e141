"""SimHash near-duplicates by multi-index hashing.

A fingerprint bit is 1 if it is set in over half of the shingle hashes. Fingerprints are cut into segments; every fingerprint is
filed under its segment and under the small Hamming ball around it, and what meets in a table is compared over all bits. Two 32-bit segments, the first with a ball of
radius 1, the second exact, find every pair of 64-bit fingerprints within 2 bits. (A ball only turns 0 bits to 1: of two values
that differ in one bit, one turns into the other.)

Work is on distinct fingerprints, so copies cost one row. Within a table entry each fingerprint is compared with its next few neighbours only; for larger entries, whose other pairs
are left, a second pass compares exactly the pairs that are not yet in one component. So a large group of near copies gives
links in proportion to its size, and the components are those of all links.

``component_id`` is the smallest doc_id reachable over links, itself included; null ids count last, and a component of null ids alone has a null. Null and empty
texts have fingerprint zero and are linked like any other. Repeated rows are kept. Very long texts are hashed whole. A table without rows gives none. ``near_duplicates`` reads ``doc_id`` and the text only,
``one_of_each`` keeps the documents' own columns, whatever their names.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import keeps_columns, small, written

SEED = 42
SHINGLE = 3
NEAR_BITS = 2
PAIR = ((32, 1), (32, 0))  # (bits, radius) of each segment: exact for 2 bits of 64
# The corpus filter links texts with 4 of 5 of their five-word shingles in common. Such pairs differ in about 39 +- 6 of 256 bits (angle of 2 * 0.8 / 1.8; measured on
# check_s: at most 57 in 8,999 pairs, while pairs with less than 3 of 10 in common differ in 62 and more). That is more than segments with small balls can cover, so a prefix filter on the sets follows.
CORPUS_SHINGLE, ALIKE = 5, (4, 5)
SET_WIDTH, SET_BITS = 256, 64  # fingerprints of shingle sets, and the distance up to which two of them are compared exactly
TABLES = tuple((16, 0) for _ in range(SET_WIDTH // 16))
ROUNDS = (6, 16)  # tables of the first pass, and those of the second up to here
SHARE = 16  # sets that are alike have more than one in so many of their shingles in common among their first ones
ORDER_SHARE, FREQUENT = 8, 100_000  # one text in so many sets the order of shingles; so many are told apart
NEXT = 4  # neighbours compared in the first pass
BITS = 16  # words of 64 bits in which a set's shingles are marked
CHAIN = 50_000  # members of an entry that one task orders
LANES = 16  # orders of the entries; a pair that meets in several of them is given at the first entry of an order where that is the same

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of every run of ``words`` words, or of all words if there are fewer."""
    import xxhash

    found = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    joined, digest = b" ".join(found), xxhash.xxh64_intdigest
    size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    stop = np.cumsum(size + 1) - 1
    start = stop - size
    k = min(words, len(found))
    return np.array([digest(joined[a:b], SEED) for a, b in zip(start[:len(found) - k + 1].tolist(), stop[k - 1:].tolist())], dtype=np.uint64)


def _mix(h: np.ndarray, lane: int) -> np.ndarray:
    """Further independent bits of a hash; lane 0 is the hash itself."""
    if lane == 0:
        return h
    with np.errstate(over="ignore"):
        x = h + np.uint64(lane * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


def fingerprint_of(hashes: np.ndarray, width: int = 64) -> list[int]:
    """The fingerprint as signed 64-bit numbers, lowest bits first."""
    out = []
    for lane in range(width // 64):
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), 65_536):
            part = _mix(hashes[at:at + 65_536], lane)
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0]) if len(hashes) else 0)
    return out


def fingerprints(text: Column, words: int = SHINGLE, width: int = 64, repeats: bool = True) -> Column:
    @F.pandas_udf("array<bigint>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            hashes = (shingle_hashes(t, words) for t in batch)
            yield pd.Series([fingerprint_of(h if repeats else np.unique(h), width) for h in hashes])

    return compute(text)


def _segments(fp: Column, segments: tuple[tuple[int, int], ...]) -> Column:
    """Table entries of a fingerprint: segment number and value in one bigint, for the value and the ball around it."""
    entries, low = [], 0
    for number, (bits, radius) in enumerate(segments):
        word, shift = divmod(low, 64)
        value = F.shiftrightunsigned(F.get(fp, F.lit(word)), shift)
        if shift + bits > 64:
            value = value.bitwiseOR(F.shiftleft(F.get(fp, F.lit(word + 1)), 64 - shift))
        value = value.bitwiseAND(F.lit((1 << bits) - 1)).bitwiseOR(F.lit(number << 40))
        ball = F.array(value)
        if radius == 1:
            up = F.filter(F.array(*[F.lit(1 << i).cast("bigint") for i in range(bits)]), lambda b: value.bitwiseAND(b) == 0)
            ball = F.concat(ball, F.transform(up, lambda b: value.bitwiseOR(b)))
        elif radius:
            raise ValueError("balls have radius 0 or 1")
        entries.append(ball)
        low += bits
    return F.concat(*entries)


def _distance(a: str, b: str, width: int) -> Column:
    return reduce(operator.add, [F.bit_count(F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))) for i in range(width // 64)])


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, root_doc, root): the node with the smallest (doc, node) of each component, for the nodes that have an edge.

    Each round takes the smallest label around and then the label of the label, so rounds grow with the logarithm of a component's length. Every round
    is written, which ends its lineage.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both, n = written(both, "links")
    ends = both.select(F.col("a").alias("node")).distinct()
    labels = ends.join(nodes.select("node", "doc"), "node").select("node", F.struct("doc", "node").alias("label"))
    labels, ends = written(labels, "labels")
    while n:
        known = small(labels.select(F.col("node").alias("b"), F.col("label").alias("near")), ends)
        around = both.join(known, "b").groupBy("a").agg(F.min("near").alias("near"))
        nearer = labels.join(small(around, ends), F.col("node") == F.col("a")).select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = small(labels.select(F.col("node").alias("up"), F.col("label").alias("up_label")), ends)
        jumped = nearer.join(up, F.col("label.node") == F.col("up")).select("node", F.least("label", "up_label").alias("label"), (F.col("old") != F.least("label", "up_label")).alias("moved"))
        jumped, _ = written(jumped, "labels")
        n = jumped.where("moved").count()
        labels = jumped.drop("moved")
    return labels.select("node", F.col("label.doc").alias("root_doc"), F.col("label.node").alias("root"))


def links(nodes: DataFrame, segments: tuple[tuple[int, int], ...], bits: int, width: int) -> DataFrame:
    """Pairs (a, b) of nodes within ``bits``: enough of them to give the components of all such pairs."""
    members = nodes.select("node", F.explode(_segments(F.col("fp"), segments)).alias("entry"))
    inside = Window.partitionBy("entry").orderBy("node")
    seen = members.select("node", "entry", *[F.lead("node", i).over(inside).alias(f"_n{i}") for i in range(1, NEXT + 1)], F.row_number().over(inside).alias("_at"))
    seen, _ = written(seen.where(F.col("_n1").isNotNull() | (F.col("_at") == NEXT + 2)), "entries")
    pairs = seen.select(F.col("node").alias("a"), F.explode(F.array_compact(F.array(*[f"_n{i}" for i in range(1, NEXT + 1)]))).alias("b")).distinct()
    fp_a, fp_b = nodes.select(F.col("node").alias("a"), F.col("fp").alias("fp_a")), nodes.select(F.col("node").alias("b"), F.col("fp").alias("fp_b"))
    close = pairs.join(fp_a, "a").join(fp_b, "b").where(_distance("fp_a", "fp_b", width) <= bits).select("a", "b")
    close, _ = written(close, "close")
    larger, n_larger = written(seen.where(F.col("_at") == NEXT + 2).select("entry").distinct(), "larger")
    if not n_larger:
        return close
    labelled = nodes.join(components(close, nodes).select("node", "root"), "node", "left").select("node", "fp", F.coalesce("root", "node").alias("root"))
    inner = labelled.select("node", "fp", "root", F.explode(_segments(F.col("fp"), segments)).alias("entry")).join(small(larger, n_larger), "entry")
    inner, _ = written(inner, "inner")
    left = inner.select("entry", F.col("node").alias("a"), F.col("fp").alias("fp_a"), F.col("root").alias("root_a"))
    right = inner.select(F.col("entry").alias("entry_b"), F.col("node").alias("b"), F.col("fp").alias("fp_b"), F.col("root").alias("root_b"))
    rest = left.join(right, (F.col("entry") == F.col("entry_b")) & (F.col("a") < F.col("b")) & (F.col("root_a") != F.col("root_b")) & (_distance("fp_a", "fp_b", width) <= bits))
    return close.unionByName(rest.select("a", "b").distinct())


def classes(prints: DataFrame, segments: tuple[tuple[int, int], ...] = PAIR, bits: int = NEAR_BITS, width: int = 64) -> DataFrame:
    """(fp, component_id, root) for every distinct fingerprint of ``prints`` (doc_id, fp); ``root`` tells components apart, also those of equal or null ids."""
    last = F.lit(2**63 - 1)
    grouped = prints.groupBy("fp").agg(F.min(F.coalesce("doc_id", last)).alias("doc"))
    # The numbers hold once the table is written; nothing reads the frame that made them.
    nodes, _ = written(grouped.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = components(links(nodes, segments, bits, width), nodes)
    out = nodes.join(found, "node", "left").select("fp", F.coalesce("root_doc", "doc").alias("component_id"), F.coalesce("root", "node").alias("root"))
    return out.withColumn("component_id", F.when(F.col("component_id") != last, F.col("component_id")))


def near_duplicates(docs: DataFrame, text: str = "text", words: int = SHINGLE, segments: tuple[tuple[int, int], ...] = PAIR, bits: int = NEAR_BITS,
                    width: int = 64, repeats: bool = True) -> DataFrame:
    """One row per document: doc_id, fp and component_id."""
    prints, _ = written(docs.select(F.col("doc_id").cast("bigint"), fingerprints(F.col(f"`{text}`"), words, width, repeats).alias("fp")), "prints")
    return prints.join(classes(prints, segments, bits, width), "fp").select("doc_id", "fp", "component_id")


def hexadecimal(fp: Column) -> Column:
    """A 64-bit fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.get(fp, F.lit(0))), 16, "0"))


def shingle_set(text: str | None) -> np.ndarray:
    """The sorted set of a text's five-word shingles; texts without words have one in common."""
    own = np.unique(shingle_hashes(text, CORPUS_SHINGLE))
    return own if len(own) else np.zeros(1, dtype=np.uint64)


def prefix(own: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of a set, frequent ones last: whatever the order, of two sets that are alike the smaller ``wanted`` of the two are in both."""
    order = np.arange(len(own))
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, own), len(frequent) - 1)
        order = np.argsort(np.where(frequent[at] == own, rank[at] + 1, 0), kind="stable")
    return own[order[:len(own) - least(len(own)) + wanted(len(own))]]


def least(n: int) -> int:
    """How many shingles a set has in common with one that is alike, at least; no smaller set is alike."""
    common, of = ALIKE
    return -(-common * n // of)


def wanted(n: int) -> int:
    """How many common shingles are looked for among the first ones."""
    return 1 + n // SHARE


def frequent_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of a share of the texts, sorted, and their rank. They set an order only, so a sample and a bound cost no pair."""

    @F.pandas_udf("array<bigint>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([shingle_set(t).view(np.int64) for t in batch])

    some = texts.where(F.pmod(F.crc32("_digest"), F.lit(ORDER_SHARE)) == 0).select(F.explode(compute("_text")).alias("entry"))
    counts, _ = written(some.groupBy("entry").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 2), "frequent")
    least, total = 3, 0
    for r in sorted(counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):
        total += r["k"]
        if total > FREQUENT:
            least = r["n"] + 1
            break
    rows = sorted((r["n"], r["entry"]) for r in counts.where(F.col("n") >= least).collect())
    found = np.array([e for _, e in rows], dtype=np.int64).view(np.uint64)
    order = np.argsort(found)
    return found[order], order


def _alike(pairs: DataFrame, texts: DataFrame, maps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets have ``ALIKE`` of their union in common. Texts are fetched only where the bitmaps leave room for it."""
    common, of = ALIKE

    @F.pandas_udf("boolean")
    def verify(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            sets = {t: shingle_set(t) for t in {*left, *right}}
            out = []
            for x, y in zip(left, right):
                x, y = sets[x], sets[y]
                shared = len(np.intersect1d(x, y, assume_unique=True))
                out.append(shared * of >= common * (len(x) + len(y) - shared))
            yield pd.Series(out, dtype=bool)

    one, two = (maps.select(F.col("_node").alias(at), *[F.col(f"_bits{i}").alias(f"_bits{o}{i}") for i in range(BITS)], F.struct("n").alias(name)) for at, o, name in (("a", "", "m"), ("b", "_o", "o")))
    pairs, _ = written(pairs.join(one, "a").join(two, "b").where(_overlapping()).select("a", "b"), "possible")
    ends, n = written(pairs.select(F.explode(F.array("a", "b")).alias("_node")).distinct(), "ends")
    texts = texts.join(small(ends, n), F.col("node") == F.col("_node"), "left_semi")
    a, b = texts.select(F.col("node").alias("a"), F.col("_text").alias("text_a")), texts.select(F.col("node").alias("b"), F.col("_text").alias("text_b"))
    return pairs.join(a, "a").join(b, "b").where(verify("text_a", "text_b")).select("a", "b")


def _possible(a: Column, b: Column) -> Column:
    """Length and positional filter for two (node, n, at) that share the entry at these places."""
    common, of = ALIKE
    most = F.least(a["at"], b["at"]) + 1 + F.least(a["n"] - a["at"], b["n"] - b["at"]) - 1
    return most * (common + of) >= (a["n"] + b["n"]) * common


def bits(own: np.ndarray) -> np.ndarray:
    """A bitmap with a bit for every shingle of a set."""
    out = np.zeros(64 * BITS, dtype=np.uint8)
    out[(own >> np.uint64(40)) % np.uint64(64 * BITS)] = 1
    return np.packbits(out, bitorder="little").view(np.uint64)


def _overlapping() -> Column:
    """Whether the bitmaps of m and o leave room for enough in common: a bit that only one has stands for at least one shingle that only it has."""
    common, of = ALIKE
    only = lambda x, y: reduce(operator.add, [F.bit_count(F.col(f"{x}{i}").bitwiseAND(F.bitwise_not(F.col(f"{y}{i}")))) for i in range(BITS)])
    most = F.least(F.col("m.n") - only("_bits", "_bits_o"), F.col("o.n") - only("_bits_o", "_bits"))
    return most * (common + of) >= (F.col("m.n") + F.col("o.n")) * common


def _chained(members: DataFrame, order: Column) -> DataFrame:
    """(m, root, o, root_o): every member of an entry with the next one in order. Members of a large entry are dealt to several chains, whose heads form one more."""
    hot, n_hot = written(members.groupBy("entry").agg(F.ceil(F.count(F.lit(1)) / CHAIN).alias("_chains")).where(F.col("_chains") > 1), "hot")
    chain = F.lit(0)
    if n_hot:
        members = members.join(small(hot, n_hot), "entry", "left")
        chain = F.pmod(F.xxhash64("m.node"), F.coalesce("_chains", F.lit(1)))
    inside = Window.partitionBy("entry", "_chain").orderBy(order)
    following = lambda w: [F.lead("m").over(w).alias("o"), F.lead("root").over(w).alias("root_o")]
    own = members.withColumn("_chain", chain).select("entry", "_chain", "m", "root", *following(inside), F.row_number().over(inside).alias("_at"))
    pairs = own.select("m", "root", "o", "root_o")
    if n_hot:
        heads = own.where(F.col("_at") == 1).join(small(hot, n_hot), "entry", "left_semi")
        pairs = pairs.unionByName(heads.select("m", "root", *following(Window.partitionBy("entry").orderBy("_chain"))))
    return pairs.where(F.col("o").isNotNull())


def _rooted(members: DataFrame, edges: DataFrame, texts: DataFrame) -> DataFrame:
    """The members with the root of their component."""
    roots, n = written(components(edges, texts).select(F.col("node").alias("_node"), F.col("root").alias("_root")), "roots")
    return members.drop("root").join(small(roots, n), F.col("m.node") == F.col("_node"), "left").select("entry", "m", F.coalesce("_root", "m.node").alias("root"))


def _mixed(members: DataFrame) -> DataFrame:
    """The members of entries that hold several components, of texts that have enough such entries: of two texts that are alike and still apart, each has."""
    for _ in range(2):
        apart, n = written(members.groupBy("entry").agg(F.min("root").alias("_low"), F.max("root").alias("_high")).where(F.col("_low") < F.col("_high")).select("entry"), "mixed")
        members, _ = written(members.join(small(apart, n), "entry", "left_semi"), "inner")
        smaller = F.ceil(F.col("m.n") * ALIKE[0] / ALIKE[1])  # no text with fewer shingles is alike
        enough, n = written(members.groupBy(F.col("m.node").alias("_node"), (1 + F.floor(smaller / SHARE)).alias("_wanted")).count().where(F.col("count") >= F.col("_wanted")).select("_node"), "enough")
        members = members.join(small(enough, n), F.col("m.node") == F.col("_node"), "left_semi")
    return written(members, "inner")[0]


def _first(members: DataFrame) -> DataFrame:
    """Of entries with the same members one; and of each text only as many places as two texts that are alike need to have one in common."""
    members = members.where(F.col("m.at") <= F.col("m.n") - F.ceil(F.col("m.n") * ALIKE[0] / ALIKE[1]))
    lists = members.groupBy("entry").agg(F.count(F.lit(1)).alias("_k"), F.bit_xor(F.xxhash64("m.node")).alias("_x"), F.bit_xor(F.xxhash64("m.node", F.lit(1))).alias("_y"))
    kept, n = written(lists.where(F.col("_k") > 1).groupBy("_k", "_x", "_y").agg(F.min("entry").alias("entry")).select("entry"), "kept")
    return members.join(small(kept, n), "entry", "left_semi")


def _turned(lane: int) -> Column:
    """The entry in another order: turning bits keeps entries apart."""
    mask = lane * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
    return F.col("entry").bitwiseXOR(F.lit(mask - (mask >> 63 << 64)))


def _comparable(members: DataFrame, maps: DataFrame) -> DataFrame:
    """The members with their bitmaps and the first of their entries in each order."""
    first = members.groupBy(F.col("m.node").alias("_node")).agg(*[F.min(_turned(i)).alias(f"_first{i}") for i in range(LANES)])
    ends, _ = written(maps.drop("n").join(first, "_node"), "firsts")
    return members.join(ends, F.col("m.node") == F.col("_node")).drop("_node")


def _here() -> Column:
    """Whether this entry is the one where the two texts are given: the first of both in the first order where they agree, else every entry."""
    out = F.lit(True)
    for i in reversed(range(LANES)):
        out = F.when(F.col(f"_first{i}") == F.col(f"_first_o{i}"), _turned(i) == F.col(f"_first{i}")).otherwise(out)
    return out


def _apart(m: Column, o: Column) -> Column:
    """Whether two members of an entry are in different components and long enough for it."""
    return (F.col("root") != F.col("root_o")) & _possible(m, o)


def _meeting(members: DataFrame, maps: DataFrame) -> DataFrame:
    """(m, o) that meet in an entry, are still apart and may be alike. What meets in many entries is given few times, most pairs once."""
    inner = _comparable(members, maps)
    other = inner.select(F.col("entry").alias("entry_o"), F.col("m").alias("o"), F.col("root").alias("root_o"), *[F.col(f"{x}{i}").alias(f"{x}_o{i}") for x, k in (("_bits", BITS), ("_first", LANES)) for i in range(k)])
    return inner.join(other, (F.col("entry") == F.col("entry_o")) & (F.col("m.node") < F.col("o.node")) & _apart(F.col("m"), F.col("o")) & _here() & _overlapping()).select("m", "o")


def set_links(texts: DataFrame, copies: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b) of ``texts`` (node, doc, _digest, _text) that are alike: enough of them to give the components of all such pairs. The nodes in ``copies`` (_node) take no part.

    SimHash comes first: 256-bit fingerprints of the shingle sets are filed under their 16-bit segments, neighbours in an entry that differ in at most ``SET_BITS`` are compared exactly,
    so a group of near copies is joined by links in proportion to its size. Alike texts whose fingerprints never are neighbours are left for a prefix filter, which loses none: it takes entries that hold several
    components, and texts that have enough of them; first neighbours in some order are compared, then all that are still apart. What is in one component is never compared again.
    """
    own = texts if copies is None else texts.join(copies, F.col("node") == F.col("_node"), "left_anti")
    shared = texts.sparkSession.sparkContext.broadcast(frequent_shingles(own))

    @F.pandas_udf("n int, head array<bigint>, fp array<bigint>, bits array<bigint>")
    def compute(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t) for t in batch]
            yield pd.DataFrame({"n": [len(x) for x in sets], "head": [prefix(x, *shared.value).view(np.int64) for x in sets], "fp": [fingerprint_of(x, SET_WIDTH) for x in sets],
                                "bits": [bits(x).view(np.int64) for x in sets]})

    heads, _ = written(own.select("node", compute("_text").alias("_p")).select("node", "_p.*"), "heads")
    maps = heads.select(F.col("node").alias("_node"), "n", *[F.get("bits", F.lit(i)).alias(f"_bits{i}") for i in range(BITS)])
    ends = F.least("m.node", "o.node").alias("a"), F.greatest("m.node", "o.node").alias("b")
    sizes = F.least("m.n", "o.n") * ALIKE[1] >= F.greatest("m.n", "o.n") * ALIKE[0]
    differing = reduce(operator.add, [F.bit_count(F.get("m.fp", F.lit(i)).bitwiseXOR(F.get("o.fp", F.lit(i)))) for i in range(SET_WIDTH // 64)])
    following = F.get("m.fp", F.pmod(F.shiftrightunsigned("entry", 42) + 1, F.lit(SET_WIDTH // 64)).cast("int"))  # the word after that of the segment

    close, done = None, 0
    for upto in ROUNDS:
        tables = F.slice(_segments(F.col("fp"), TABLES), done + 1, upto - done)
        filed = heads.select(F.explode(tables).alias("entry"), F.struct("n", "node", "fp").alias("m"), F.col("node").alias("root"))
        if close is not None:
            filed = _rooted(filed, close, texts)
        near = _chained(filed, F.struct(following, F.col("m.node"))).where((F.col("root") != F.col("root_o")) & sizes & (differing <= SET_BITS))
        near, _ = written(near.select(*ends).distinct(), "near")
        found, _ = written(_alike(near, texts, maps), "close")
        close, done = found if close is None else written(close.unionByName(found), "close")[0], upto

    members = heads.select("n", "node", F.posexplode("head").alias("at", "entry")).select("entry", F.struct("n", "node", "at").alias("m"))
    inner = _mixed(_rooted(members, close, texts))
    tried, _ = written(_chained(inner, F.xxhash64("entry", "m.node")).where(_apart(F.col("m"), F.col("o"))).select(*ends).distinct(), "tried")
    joined, n_joined = written(_alike(tried, texts, maps), "joined")
    if n_joined:
        close, _ = written(close.unionByName(joined), "close")
        inner = _mixed(_rooted(inner, close, texts))
    rest = _meeting(_first(inner), maps)
    rest, _ = written(rest.select(*ends).distinct().join(tried, ["a", "b"], "left_anti"), "apart")
    rest, _ = written(_alike(rest, texts, maps), "rest")
    return close.unionByName(rest)


@keeps_columns
def one_of_each(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents without near copies: of every component the row with the smallest doc_id stays, with its columns.

    Of equal texts all rows but one are set aside first, by their numbers: the texts are not shuffled for it. Distinct texts are linked where the exact Jaccard similarity
    of their sets of five-word shingles is ``ALIKE`` or more; all such pairs are covered.
    """
    digest = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    columns = docs.columns
    # The numbers hold once the table is written.
    numbered, _ = written(docs.withColumn("_digest", digest).withColumn("_node", F.monotonically_increasing_id()), "numbered")
    first = numbered.groupBy("_digest").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_node")).alias("_first")).select(F.col("_first._node").alias("_node"))
    copies, n_copies = written(numbered.select("_node").join(first, "_node", "left_anti"), "copies")
    # Of a component the smallest doc_id stays, then the smallest digest.
    doc = F.struct(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1)).alias("id"), "_digest")
    texts = numbered.select(F.col("_node").alias("node"), doc.alias("doc"), "_digest", F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    near = components(set_links(texts, small(copies, n_copies)), texts).where(F.col("node") != F.col("root")).select(F.col("node").alias("_node"))
    gone, n = written(near.unionByName(copies), "gone")
    return numbered.join(small(gone, n), "_node", "left_anti").select(*[F.col(f"`{c}`") for c in columns])
