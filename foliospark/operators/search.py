"""Substring search over a catalogue through positional trigram postings.

Every text is cut into its trigrams; a posting has a text's places of one of them, and postings lie in folders by a hash of the trigram, sorted by it. A needle
stands in a text exactly where its trigrams stand one after another, so hits are found and verified by joining the places of the trigrams that cover the needle, the rarest first,
and no text is read. The rows shown are then looked up by number in folders of their own.

Case is folded by ``lower``. Texts are followed by two fillers, so each place starts a trigram and needles of one or two characters are found by the trigrams that begin with them;
that a hit ends inside its text is checked by the text's length. An empty needle lists the first rows. Null texts are not found; repeated rows are found each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.sources.tables import stage

BUCKETS = 64
ROW_BLOCK = 50_000  # rows of the catalogue in one folder
FILLER = "￿"


def _bucket(gram: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(gram), F.lit(buckets)).cast("int")


def _store(rows: DataFrame, path: str, folder: str, order: list[str], empty: bool) -> None:
    """Write rows in folders and sorted inside; without rows one empty file, so that the columns are known."""
    if empty:
        rows.limit(0).write.parquet(path)
    else:
        rows.hint("rebalance", folder).sortWithinPartitions(folder, *order).write.partitionBy(folder).parquet(path)


def build(catalogue: DataFrame, path: str, fields: tuple[str, ...] = ("title", "author"), key: str = "book_id", buckets: int = BUCKETS) -> None:
    """Write the index of the ``fields`` of a catalogue: ``grams`` with their number of texts, ``postings`` and the ``rows`` themselves."""
    # The numbers hold once the table is written.
    rows = stage(catalogue.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    block = F.floor(F.col("_row") / ROW_BLOCK)
    _store(rows.withColumn("_block", block), f"{path}/rows", "_block", ["_row"], rows.isEmpty())
    texts = reduce(DataFrame.unionByName, [rows.select("_row", key, F.lit(i).alias("field"), F.lower(f).alias("_text")) for i, f in enumerate(fields)]).where(F.col("_text").isNotNull())
    letters = F.split(F.concat("_text", F.lit(FILLER * 2)), "")
    n = F.length("_text")
    grams = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.concat(F.get(F.col("_letters"), i), F.get(F.col("_letters"), i + 1), F.get(F.col("_letters"), i + 2)))
    cut = texts.where(n > 0).withColumns({"_letters": letters, "n": n}).select("_row", key, "field", "n", F.posexplode(grams).alias("place", "gram"))
    postings = cut.groupBy("gram", "_row", key, "field", "n").agg(F.sort_array(F.collect_list("place")).alias("places"))
    postings = postings.withColumn("bucket", _bucket(F.col("gram"), buckets))
    nothing = texts.where(n > 0).isEmpty()
    _store(postings, f"{path}/postings", "bucket", ["gram", key], nothing)
    stored = catalogue.sparkSession.read.parquet(f"{path}/postings")
    counts = stored.groupBy("bucket", "gram").agg(F.count(F.lit(1)).alias("texts"))
    _store(counts, f"{path}/grams", "bucket", ["gram"], nothing)


def _starts(spark: SparkSession, path: str, key: str, condition: Column, offset: int, length: int) -> DataFrame:
    """(_row, key, field, start) of the needles that these postings allow."""
    start = F.col("place") - offset
    some = spark.read.parquet(f"{path}/postings").where(condition).select("_row", key, "field", "n", F.explode("places").alias("place"))
    return some.select("_row", key, "field", "n", start.alias("start")).where((F.col("start") >= 0) & (F.col("start") + length <= F.col("n"))).drop("n")


def matches(spark: SparkSession, path: str, needle: str, key: str = "book_id", buckets: int = BUCKETS) -> DataFrame:
    """(_row, key) of the rows with the needle in one of the fields; reads the folders of its trigrams only."""
    folded = spark.range(1).select(F.lower(F.lit(needle)).alias("n")).select("n", F.length("n").alias("m")).first()
    text, m = folded["n"], folded["m"]
    if m < 3:
        found = _starts(spark, path, key, F.col("gram").startswith(text), 0, m)
        return found.select("_row", key).distinct()
    grams = [text[i:i + 3] for i in range(m - 2)]
    places = spark.createDataFrame([(i, g) for i, g in enumerate(grams)], "at int, gram string").select("at", _bucket(F.col("gram"), buckets).alias("b")).collect()
    bucket = {grams[r["at"]]: r["b"] for r in places}
    known = spark.read.parquet(f"{path}/grams").where(F.col("bucket").isin(sorted(set(bucket.values()))) & F.col("gram").isin(sorted(bucket)))
    texts = {r["gram"]: r["texts"] for r in known.collect()}  # as many as the needle has trigrams
    rarest = min(range(m - 2), key=lambda i: (texts.get(grams[i], 0), i))
    cover = {*range(0, m - 2, 3), m - 3}  # these trigrams hold every character
    order = [rarest, *sorted(cover - {rarest}, key=lambda i: texts.get(grams[i], 0))]
    found = None
    for i in order:
        some = _starts(spark, path, key, (F.col("bucket") == bucket[grams[i]]) & (F.col("gram") == grams[i]), i, m)
        found = some if found is None else found.join(some.select("_row", "field", "start"), ["_row", "field", "start"], "left_semi")
    return found.select("_row", key).distinct()


def search(spark: SparkSession, path: str, needle: str, key: str = "book_id", hits: int = 20, listed: int = 10, buckets: int = BUCKETS) -> DataFrame:
    """The first ``hits`` rows with the needle by ``key``; the first ``listed`` of all for an empty needle."""
    rows = spark.read.parquet(f"{path}/rows").drop("_block")
    if not needle:
        return rows.orderBy(key, "_row").limit(listed).drop("_row")
    found = matches(spark, path, needle, key, buckets).orderBy(key, "_row").limit(hits).select("_row").collect()
    numbers = [r["_row"] for r in found]  # at most ``hits``
    blocks = sorted({n // ROW_BLOCK for n in numbers})
    return spark.read.parquet(f"{path}/rows").where(F.col("_block").isin(blocks) & F.col("_row").isin(numbers)).orderBy(key, "_row").drop("_row", "_block")
