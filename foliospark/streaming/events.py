"""Continuous event ETL: validate, append, and resolve against the interaction table when it is read."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from foliospark.operators.etl import INTERACTION_COLUMNS, resolve, strongest_events, to_interactions
from foliospark.operators.quality import split_events
from foliospark.sources import tables
from foliospark.streaming import sinks


def append_sink(path: str, rejected: str):
    """Write a micro-batch as a folder of its own: the strongest event per pair, in the shape of the interaction table; bad events go to ``rejected``.

    The table is never rewritten, and a replayed batch overwrites its own folder.
    """
    good, bad = sinks.batch_folder(path), sinks.batch_folder(rejected)

    def append(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.DISK_ONLY)  # read for the good and the bad rows
        valid, other = split_events(batch)
        bad(other, batch_id)
        good(to_interactions(strongest_events(valid)).select(*INTERACTION_COLUMNS), batch_id)
        batch.unpersist()

    return append


def ingest(stream: DataFrame, path: str, work: str) -> None:
    """Append everything available in the event stream to the batches at ``path``."""
    sinks.run(stream, f"{work}/checkpoint", append_sink(path, f"{work}/rejected"))


def current(spark: SparkSession, path: str, stored: DataFrame | None = None) -> DataFrame:
    """The interaction table: the stored interactions with all appended events resolved against them."""
    events = tables.read(spark, path).select(*INTERACTION_COLUMNS)
    return resolve(events if stored is None else stored.select(*INTERACTION_COLUMNS).unionByName(events))


def compact(spark: SparkSession, paths: list[str], target: str, stored: DataFrame | None = None) -> DataFrame:
    """Write the resolved table to a new place; the batches it holds can then be deleted. A separate job, run when batches have piled up."""
    rows = [tables.read(spark, p).select(*INTERACTION_COLUMNS) for p in paths]
    rows += [] if stored is None else [stored.select(*INTERACTION_COLUMNS)]
    return tables.replace(resolve(reduce(DataFrame.unionByName, rows)), target)


def unique_events(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Each event id once, however often it is delivered within the delay."""
    return stream.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["event_id"])
