"""From documents to packed training sequences: one filter after another, each over all that the one before kept.

Every stage is written as Parquet and read again, which ends its lineage. All but the last return the columns of ``documents``, and further columns of the caller with their own values, whatever their names.

Every stage takes texts whole, very long ones too, treats repeated rows alike, and gives no rows for an empty table. Null and empty texts go in the first stage, as they have no letter; a stage that is called by itself
treats them as its operator does: the line stage keeps a null text null, the near-copy stage counts null and empty texts as copies of each other, the benchmark stage keeps them, packing gives each its end id.
A null ``doc_id`` is kept as it is; among near copies it comes last. Ties are broken by ``doc_id``, then by the text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import decontaminate, language_id, line_dedup, packing, simhash
from foliospark.llm.common import ready
from foliospark.sources.tables import stage

ENCODER_BYTES = 32 << 20  # of words kept per worker: the workers of the other stages live on beside them


def recognised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned; texts without letters and texts that every regression turns down go."""
    ready(spark)
    return language_id.accepted(docs, language_id.fit(docs))


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines its source repeats; ``n_chars`` follows the text."""
    ready(spark)
    aside = {c: f"input of the line stage {c}" for c in ("n_lines", "n_dropped") if c in docs.columns}
    out = line_dedup.drop_boilerplate(docs.withColumnsRenamed(aside))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    out = out.drop("n_lines", "n_dropped").withColumnsRenamed({v: k for k, v in aside.items()})
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of exact or near copies: that of the smallest doc_id."""
    ready(spark)
    return simhash.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    ready(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 ids."""
    ready(spark)
    out = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), known_bytes=ENCODER_BYTES)
    return out.select("doc_id", "piece", "start", F.col("length").cast("bigint"), "ids_crc32", "sequence_id", "offset")


STAGES = [("language ID", recognised), ("line dedup", without_boilerplate), ("SimHash near-dedup", one_of_each), ("decontamination", without_benchmark), ("packing", packed)]

# Kernel regression, edit distance and packing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
