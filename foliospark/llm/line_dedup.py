"""Boilerplate lines by site-relative frequency.

A line is boilerplate on a host when it stands on more than ``max_ratio`` of that host's pages, and on at least
``min_pages`` of them. Such lines are dropped from the pages of that host; every other line keeps its place.

A line is compared without the spaces, tabs and carriage returns around it. Blank lines are neither counted nor
dropped. A line repeated on one page counts once for the page and all its copies go. Pages without a host
form one site of their own. A null text stays null and counts as a page without lines; a text all of whose lines go becomes
empty. Repeated rows are pages of their own. Very long texts and lines are taken whole; an empty table gives no rows. Input
columns named like the added counters are replaced; all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import keeps_columns, small, written

MAX_RATIO = 0.1
MIN_PAGES = 5


def _bare(line: Column) -> Column:
    return F.trim(line, F.lit(" \t\r"))


def _digest(line: Column) -> Column:
    return F.unhex(F.md5(_bare(line)))


def _line_digests(text: Column) -> Column:
    """Distinct digests of the lines that are not blank."""
    full = F.filter(F.split(text, "\n", -1), lambda x: _bare(x) != "")
    return F.array_distinct(F.transform(full, _digest))


def boilerplate(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """(host, lines): the digests of the lines each host repeats too often.

    A line on more than ``max_ratio`` of a host's pages uses up that share of all its line places, so a host has at most
    (mean lines per page / ``max_ratio``) of them, whatever its size. Hot lines and hosts are counted before the shuffle.
    """
    page = pages.select(F.col(f"`{host}`").alias("_host"), F.col(f"`{text}`").alias("_text"))
    totals = page.groupBy("_host").agg(F.count(F.lit(1)).alias("_pages"))
    counts = (page.select("_host", F.explode(_line_digests(F.col("_text"))).alias("_line"))
              .groupBy("_host", "_line").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_pages))
    often = counts.join(totals.withColumnRenamed("_host", "_of"), F.col("_host").eqNullSafe(F.col("_of")))
    return (often.where(F.col("_n") > F.lit(max_ratio) * F.col("_pages")).groupBy("_host")
            .agg(F.collect_list("_line").alias("_lines")))


@keeps_columns
def drop_boilerplate(pages: DataFrame, host: str = "source", text: str = "text", max_ratio: float = MAX_RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """The pages without their host's boilerplate lines, with ``n_lines`` and ``n_dropped``."""
    pages = pages.drop("n_lines", "n_dropped")
    found, hosts = written(boilerplate(pages, host, text, max_ratio, min_pages), "boilerplate")
    joined = pages.join(small(found, hosts, 10_000), F.col(f"`{host}`").eqNullSafe(F.col("_host")), "left")
    lines = F.split(F.col(f"`{text}`"), "\n", -1)
    # The few lines of this page that are boilerplate; most pages end here.
    joined = joined.withColumn("_hit", F.when(F.col("_lines").isNotNull(), F.array_intersect(_line_digests(F.col(f"`{text}`")), "_lines")))
    hit = F.coalesce(F.size("_hit"), F.lit(0)) > 0
    kept = F.filter(lines, lambda x: (_bare(x) == "") | ~F.array_contains("_hit", _digest(x)))
    n_lines = F.coalesce(F.size(lines), F.lit(0))
    joined = joined.withColumn("_kept", F.when(hit, kept))
    return joined.withColumns({
        "n_lines": F.when(F.col(f"`{text}`").isNull(), 0).otherwise(n_lines),
        "n_dropped": F.when(hit, n_lines - F.size("_kept")).otherwise(0),
        text: F.when(hit, F.array_join("_kept", "\n")).otherwise(F.col(f"`{text}`")),
    }).drop("_host", "_lines", "_hit", "_kept")
