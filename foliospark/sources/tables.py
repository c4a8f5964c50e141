"""Reading, writing and maintaining tables kept as Parquet folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.session import work_folder


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def _file_system(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def writer(df: DataFrame, mode: str, partition_by: Iterable[str] = ()):
    """Writer of a table. Rows of one partition are brought together first, so a partition gets few files, not one
    per task; AQE splits the partitions that are too large for one task.
    """
    columns = list(partition_by)
    laid_out = df.hint("rebalance", *columns) if columns else df
    return laid_out.write.mode(mode).partitionBy(*columns)


def replace(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Overwrite the table at ``path`` with ``df``; ``df`` must not read ``path`` (see ``replace_from_self``)."""
    writer(df, "overwrite", partition_by).parquet(path)
    return read(df.sparkSession, path)


def replace_from_self(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Overwrite a table with a result that reads the same table: write aside, then swap the folders."""
    spark, aside = df.sparkSession, f"{path.rstrip('/')}__next"
    writer(df, "overwrite", partition_by).parquet(aside)
    _swap(spark, aside, path)
    return read(spark, path)


def _swap(spark: SparkSession, aside: str, path: str) -> None:
    """Put the folder ``aside`` in the place of ``path``. After a crash between the two renames the old table lies at ``path__old``."""
    fs, target = _file_system(spark, path)
    _, jaside = _file_system(spark, aside)
    _, jold = _file_system(spark, f"{path.rstrip('/')}__old")
    if fs.exists(target):
        fs.delete(jold, True)
        if not fs.rename(target, jold):
            raise IOError(f"could not set aside {path}")
    if not fs.rename(jaside, target):
        raise IOError(f"could not move the new table to {path}")
    fs.delete(jold, True)
    spark.catalog.refreshByPath(path)


def append(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> DataFrame:
    writer(df, "append", partition_by).parquet(path)
    return read(df.sparkSession, path)


def create_if_missing(spark: SparkSession, path: str, schema: str, partition_by: Iterable[str] = ()) -> bool:
    """Create an empty table with this schema; an existing one is left alone. True when created."""
    if exists(spark, path):
        return False
    spark.createDataFrame([], schema).write.partitionBy(*partition_by).parquet(path)
    return True


def add_missing_column(df: DataFrame, name: str, data_type: str = "string") -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(data_type))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One labelled count per table."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_type"), "record_count")
        out = one if out is None else out.unionByName(one)
    return out


def metadata(df: DataFrame, table: str, as_of: Column) -> DataFrame:
    """One row per column: name, type, mode, with the table's row count and the time of the listing."""
    spark = df.sparkSession
    fields = [(i, f.name, f.dataType.simpleString(), "NULLABLE" if f.nullable else "REQUIRED")
              for i, f in enumerate(df.schema.fields, 1)]
    listing = spark.createDataFrame(fields, "ordinal int, column_name string, column_type string, mode string")
    count = df.agg(F.count(F.lit(1)).alias("row_count"))
    return listing.crossJoin(F.broadcast(count)).select(
        F.lit(table).alias("table_name"), "ordinal", "column_name", "column_type", "mode", "row_count",
        as_of.alias("collected_at"))


def structure(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string")


def promote(spark: SparkSession, pairs: dict[str, str]) -> DataFrame:
    """Copy each staging table beside its production table, check the counts, swap, then drop the staging table.

    Production is only touched when every copy is whole. Returns one row per table.
    """
    done = []
    for staging, production in pairs.items():
        source, aside = read(spark, staging), f"{production.rstrip('/')}__next"
        copied = replace(source, aside).count()
        if copied != source.count():
            raise IOError(f"{aside} does not hold every row of {staging}")
        done.append((staging, production, copied))
    for _, production, _ in done:  # nothing is swapped before every copy is whole
        _swap(spark, f"{production.rstrip('/')}__next", production)
    for staging in pairs:
        fs, jpath = _file_system(spark, staging)
        fs.delete(jpath, True)
    return spark.createDataFrame(done, "staging string, production string, row_count bigint")


def stage(df: DataFrame, label: str = "table") -> DataFrame:
    """Write an intermediate result once to the shared working folder and go on from the written copy.

    For results that several later steps read: the copy is computed once, survives lost executors, can be
    pruned by column, and tells the optimizer its size.
    """
    path = f"{work_folder(df.sparkSession)}/{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def system_sample(df: DataFrame, fraction: float, limit: int, seed: int = 42) -> DataFrame:
    """Bounded random sample for export."""
    return df.sample(fraction=fraction, seed=seed).limit(limit)


def hashed_sample(df: DataFrame, keys: Iterable[str], limit: int, seed: int = 42) -> DataFrame:
    """Random rows that are the same on every run: the ``limit`` lowest seeded key hashes."""
    keys = list(keys)
    return df.orderBy(F.md5(F.concat_ws("/", *[F.col(k).cast("string") for k in keys], F.lit(seed).cast("string"))), *keys).limit(limit)


def round_trip(df: DataFrame, writer: str = "parquet", **options) -> DataFrame:
    """Write ``df`` to a fresh working folder and read it back."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/table"
    df.write.format(writer).options(**options).save(path)
    return spark.read.format(writer).options(**options).schema(df.schema).load(path)
