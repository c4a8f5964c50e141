"""Document fingerprints that tell two versions apart: invertible Bloom lookup sketches of paragraph digests.

A text's paragraphs are its lines; a line longer than ``LONG_LINE`` characters is cut after its sentences. Blank ones do not count, and a paragraph counts once. Each digest
is added to three cells of a sketch, one per third: a count, the XOR of the digests and the XOR of their checks. Two sketches are
subtracted cell by cell; cells left with a single digest are peeled until nothing is left, which gives the digests that only one side has. If that fails, the digests of
both sides are dealt by hash into blocks of about ``BLOCK_KEYS``, each with a sketch of its own, and a block that fails is tried again with twice the cells.

Likeness is the number of common paragraphs over that of all, 1 for two texts without paragraphs. Everything is made of SQL functions within a row.

Nulls are empty texts. The next document of a row is that of the next larger doc_id (of several rows, the one of smallest text hash), after the last the first; a null id sorts
first. A single document is its own next. Repeated rows give repeated results; an empty table gives none. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliospark.llm.common import text_or_empty

CELLS = 24
LONG_LINE = 400
BLOCK_KEYS, BLOCK_CELLS = 12, 36
ROUNDS = 16
TRIES = 12
SPAN_BITS = 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def paragraph_digests(text: Column) -> Column:
    lines = F.flatten(F.transform(F.split(text, "\n"), lambda x: F.when(F.length(x) > LONG_LINE, F.split(x, r"(?<=[.!?])\s+")).otherwise(F.array(x))))
    return F.array_distinct(F.transform(F.filter(lines, lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))


def _check(key: Column) -> Column:
    return F.xxhash64(key, F.lit(101)).bitwiseAND(F.lit(0xFFFFFFFF))


def _cell(n: Column, k: Column, h: Column) -> Column:
    return F.struct(n.cast("int").alias("n"), k.cast("bigint").alias("k"), h.cast("bigint").alias("h"))


def _places(key: Column, third: Column, salt: Column) -> list[Column]:
    """The cell of a digest in each third, from 0."""
    return [F.pmod(F.xxhash64(key, salt, F.lit(i)), third).cast("int").alias(name) for i, name in enumerate("abc")]


def _put(thirds: Column, x: Column, sign: Column, third: Column) -> Column:
    """Add or take a digest: one cell of each third is replaced."""
    def one(name: str) -> Column:
        at = x[name]
        return F.transform(thirds[name], lambda c, i: F.when(i == at, _cell(c["n"] + sign, c["k"].bitwiseXOR(x["k"]), c["h"].bitwiseXOR(x["h"]))).otherwise(c)).alias(name)

    return F.struct(*[one(name) for name in "abc"])


def sketch(keys: Column, third: Column, salt: Column) -> Column:
    """A set of digests as three thirds of cells."""
    none = F.array_repeat(_cell(F.lit(0), F.lit(0), F.lit(0)), third)
    placed = F.transform(keys, lambda k: F.struct(k.alias("k"), _check(k).alias("h"), *_places(k, third, salt)))
    return F.aggregate(placed, F.struct(*[none.alias(x) for x in "abc"]), lambda s, x: _put(s, x, F.lit(1), third))


def subtract(one: Column, other: Column) -> Column:
    cells = lambda a, b: F.zip_with(a, b, lambda x, y: _cell(x["n"] - y["n"], x["k"].bitwiseXOR(y["k"]), x["h"].bitwiseXOR(y["h"])))
    return let(F.struct(one.alias("one"), other.alias("other")), lambda s: F.struct(*[cells(s["one"][x], s["other"][x]).alias(x) for x in "abc"]))


def peel(difference: Column, third: Column, salt: Column) -> Column:
    """(only_a, only_b): the digests on one side only, or null if the sketch is too small for them.

    A round takes every digest that stands alone in a cell out of its three cells; the last round finds none.
    """
    def alone(thirds: Column) -> Column:
        cells = F.filter(F.concat(thirds["a"], thirds["b"], thirds["c"]), lambda c: (F.abs(c["n"]) == 1) & (_check(c["k"]) == c["h"]))
        return F.transform(F.array_distinct(cells), lambda c: F.struct(c["n"].alias("n"), c["k"].alias("k"), c["h"].alias("h"), *_places(c["k"], third, salt)))

    def take(state: Column, out: Column) -> Column:
        left = F.aggregate(out, state["cells"], lambda s, x: _put(s, x, -x["n"], third))
        return F.struct(left.alias("cells"), F.concat(state["out"], F.transform(out, lambda x: F.struct(x["n"].alias("n"), x["k"].alias("k")))).alias("out"), (F.size(out) == 0).alias("done"))

    none = F.array().cast("array<struct<n:int,k:bigint>>")
    start = F.struct(difference.alias("cells"), none.alias("out"), F.lit(False).alias("done"))
    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    end = F.aggregate(rounds, start, lambda state, _: F.when(state["done"], state).otherwise(let(alone(state["cells"]), lambda out: take(state, out))))
    some = lambda cells: F.exists(cells, lambda c: (c["n"] != 0) | (c["k"] != 0))
    side = lambda s, n: F.transform(F.filter(s["out"], lambda x: x["n"] == n), lambda x: x["k"])
    return let(end, lambda s: F.when(~(some(s["cells"]["a"]) | some(s["cells"]["b"]) | some(s["cells"]["c"])), F.struct(side(s, 1).alias("only_a"), side(s, -1).alias("only_b"))))


def _blocks(a: Column, b: Column) -> Column:
    """(only_a, only_b) by blocks, each tried with more cells until it peels."""
    count = F.greatest(F.lit(1).cast("bigint"), F.ceil((F.size(a) + F.size(b)) / F.lit(BLOCK_KEYS)))
    kind = "struct<only_a:array<bigint>,only_b:array<bigint>>"

    def block(i: Column, n: Column) -> Column:
        own = lambda keys: F.filter(keys, lambda k: F.pmod(F.xxhash64(k, F.lit(77)), n) == i)
        return let(F.struct(own(a).alias("a"), own(b).alias("b")), lambda s: F.aggregate(
            F.sequence(F.lit(0), F.lit(TRIES)), F.lit(None).cast(kind), lambda found, t: F.coalesce(found, let(
                F.call_function("shiftleft", F.lit(BLOCK_CELLS // 3), t), lambda m: peel(subtract(sketch(s["a"], m, t + 1), sketch(s["b"], m, t + 1)), m, t + 1).cast(kind)))))

    parts = let(count, lambda n: F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: block(i, n)))
    return let(parts, lambda p: F.struct(F.flatten(F.transform(p, lambda x: x["only_a"])).alias("only_a"), F.flatten(F.transform(p, lambda x: x["only_b"])).alias("only_b")))


def differing(a: Column, b: Column, sketch_a: Column, sketch_b: Column) -> Column:
    """The digests only one side has, from the two fingerprints or else from larger sketches."""
    return F.coalesce(peel(subtract(sketch_a, sketch_b), F.lit(CELLS // 3), F.lit(0)), _blocks(a, b))


def likeness(n_a: Column, difference: Column) -> Column:
    common = n_a - F.size(difference["only_a"])
    every = n_a + F.size(difference["only_b"])
    return F.when(every == 0, F.lit(1.0)).otherwise(common / every)


def fingerprint(keys: Column) -> Column:
    return sketch(keys, F.lit(CELLS // 3), F.lit(0))


def written_out(cells: Column) -> Column:
    """The cells as hex: count, digests and checks of each."""
    two = lambda c, n: F.lower(F.lpad(F.hex(c), n, "0"))
    return F.array_join(F.transform(F.concat(cells["a"], cells["b"], cells["c"]), lambda c: F.concat(two(c["n"].cast("bigint"), 4), two(c["k"], 16), two(c["h"], 8))), "")


def successors(ids: DataFrame, levels: int = 4) -> DataFrame:
    """(id, next): the next larger of some distinct numbers; null for the largest.

    A span of 2^16 numbers has no more rows than that, so each window is bounded whatever the ids are; the first number after a span is found the same way among the spans.
    """
    inside = Window.partitionBy("_span").orderBy("id")
    spanned = ids.select("id", F.shiftright("id", SPAN_BITS).alias("_span"))
    lead = spanned.select("id", "_span", F.lead("id").over(inside).alias("next"))
    if levels == 1:
        return lead.select("id", "next")
    firsts = spanned.groupBy("_span").agg(F.min("id").alias("_first"))
    after = successors(firsts.select(F.col("_span").alias("id")), levels - 1).where(F.col("next").isNotNull())
    begin = after.join(firsts, F.col("next") == F.col("_span")).select(F.col("id").alias("_of"), F.col("_first").alias("_begin"))
    last = lead.where(F.col("next").isNull()).join(begin, F.col("_span") == F.col("_of"), "left").select("id", F.col("_begin").alias("next"))
    return lead.where(F.col("next").isNotNull()).select("id", "next").unionByName(last)


def with_next(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, text, keys, and of the next document ``next_keys`` and ``next_start``, as much of its text as the edit takes.

    The texts are shuffled once, by id, for both joins; what goes from a document to the one before it is a quarter of that one's length.
    """
    null_id = F.lit(-(2**63))  # sorts first; both joins use the same columns, so that they share one shuffle
    base = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), null_id).alias("_key"), text_or_empty(text).alias("text"))
    base = base.withColumn("keys", paragraph_digests(F.col("text")))
    sizes = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(2**63))).alias("id"), F.length(text_or_empty(text)).alias("_n")).groupBy("id").agg(F.max("_n").alias("_n"))
    smallest = sizes.agg(F.min("id")).first()[0]
    chain = successors(sizes.select("id")).select("id", F.coalesce("next", F.lit(smallest).cast("bigint")).alias("next"))
    wanted = chain.join(sizes, "id").select(F.col("id").alias("_before"), F.col("next").alias("_next"), F.floor(F.col("_n") / 4).cast("int").alias("_take"))
    given = base.join(wanted, F.col("_key") == F.col("_next")).select("_before", F.xxhash64("text").alias("_h"), F.col("text").substr(F.lit(1), F.col("_take")).alias("next_start"), F.col("keys").alias("next_keys"))
    given = given.groupBy("_before").agg(F.min_by(F.struct("next_start", "next_keys"), "_h").alias("_given"))
    return base.join(given, F.col("_key") == F.col("_before")).select(F.when(F.col("_key") != null_id, F.col("_key")).alias("doc_id"), "text", "keys", "_given.next_start", "_given.next_keys")


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per document its fingerprint and that of the edited text, both differences, and both likenesses."""
    rows = with_next(docs, text)
    n = F.length("text")
    taken = F.floor(n / 4).cast("int")
    rows = rows.withColumn("n_chars", n.cast("bigint")).withColumn("edited", F.concat(F.col("text").substr(F.lit(1), n - taken), F.col("next_start").substr(F.lit(1), taken)))
    rows = rows.withColumns({"edited_keys": paragraph_digests(F.col("edited")), "edited_sha256": F.sha2("edited", 256)}).drop("edited", "next_start", "text")
    rows = rows.withColumns({"cells": fingerprint(F.col("keys")), "edited_cells": fingerprint(F.col("edited_keys")), "next_cells": fingerprint(F.col("next_keys"))})
    rows = rows.withColumns({"to_edited": differing(F.col("keys"), F.col("edited_keys"), F.col("cells"), F.col("edited_cells")),
                             "to_next": differing(F.col("keys"), F.col("next_keys"), F.col("cells"), F.col("next_cells"))})
    size = F.size("keys")
    return rows.withColumns({"fingerprint": written_out(F.col("cells")), "edited_fingerprint": written_out(F.col("edited_cells")),
                             "near_edited": likeness(size, F.col("to_edited")), "near_next": likeness(size, F.col("to_next"))})
