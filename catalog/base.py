"""Shared pieces of the query catalogue: inputs per data folder, result presentation, oracle composition."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.ctes import CTES
from foliospark.plans.tables import Derived, Inputs
from foliospark.sources import adapters


def derived(spark: SparkSession, sf_dir: str) -> Derived:
    return Derived(Inputs(
        adapters.books(spark, sf_dir), adapters.interactions(spark, sf_dir), adapters.authors(spark, sf_dir),
        adapters.name_genders(spark, sf_dir), adapters.AS_OF))


def present(df: DataFrame, digits: int = 4) -> DataFrame:
    """Comparable column types: whole numbers as bigint, rounded doubles, times and dates as text, arrays as JSON."""
    out = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(t, (T.FractionalType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)
        elif isinstance(t, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(t, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(t, (T.ArrayType, T.StructType)):
            c = F.to_json(c)
        out.append(c.alias(f.name))
    return df.select(*out)


_WORD = re.compile(r"[a-z_][a-z0-9_]*")
_MARK = re.compile(r"\br4\(")


def _expand_r4(sql: str) -> str:
    """Write out ``r4(x)``: round to four digits, with no negative zero."""
    while (m := _MARK.search(sql)) is not None:
        depth, i = 1, m.end()
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[i], 0)
            i += 1
        inner = sql[m.end():i - 1]
        sql = f"{sql[:m.start()]}coalesce(nullif(round(cast({inner} AS DOUBLE), 4), 0), abs(0 * ({inner}))){sql[i:]}"
    return sql


def oracle(body: str) -> str:
    """The query with the CTEs it needs in front."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in _WORD.findall(text):
            if name in CTES and name not in needed:
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    order = [n for n in CTES if n in needed]
    head = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order)
    return _expand_r4(f"WITH {head}\n{body.strip()}" if head else body.strip())
