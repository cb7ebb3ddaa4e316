"""Registration of named queries and of the checking SQL that belongs to each."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.plans.checkviews import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def as_text(df: DataFrame) -> DataFrame:
    """Dates, times and decimals as text, so both engines show the same values."""
    out = []
    for f in df.schema:
        c, kind = F.col(f.name), f.dataType.simpleString()
        if kind == "timestamp_ntz":
            s = c.cast("string")
            c = F.concat(
                F.substring(s, 1, 19), F.lit("."), F.rpad(F.substring(s, 21, 3), 3, "0")
            )
        elif kind == "date" or kind.startswith("decimal"):
            c = c.cast("string")
        elif kind in ("int", "smallint", "tinyint"):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def with_views(sql: str) -> str:
    """Put the checking views a query mentions in front of it, dependencies first."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEWS[name])
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    own = sql.strip()
    tail = ",\n" + own[5:] if own.upper().startswith("WITH ") else "\n" + own
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed) + tail


def query(check: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with the SQL that must agree with it."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = lambda spark, sf_dir: as_text(fn(spark, sf_dir))
        if check is not None:
            CHECKS[fn.__name__] = with_views(check)
        return fn

    return register
