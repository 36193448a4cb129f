"""Catalog-side resolution of input tables. Metadata calls only, save that an optional table is
probed by fetching one row."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ratecell.operators.schema import missing_columns


def unfit(spark: SparkSession, name: str, need: Iterable[str], read: bool = False) -> str | None:
    """Why a table can't serve: it doesn't exist, lacks columns or, with ``read``, can't be read (one row is
    fetched, so that missing or broken files show now and not in the middle of a job). None if it can."""
    if not spark.catalog.tableExists(name):
        return "missing table"
    try:
        table = spark.table(name)
        if gaps := missing_columns(table, need):
            return f"missing {gaps}"
        if read:
            table.limit(1).collect()
    except (PySparkException, Py4JJavaError) as e:
        return f"not readable: {str(e).strip().splitlines()[0]}"
    return None


def resolve_table(spark: SparkSession, candidates: Sequence[str],
                  required: Iterable[str]) -> tuple[str, DataFrame]:
    """The first of several tables that can serve; if none can, one error says why for each."""
    need, reasons = list(required), {}
    for name in candidates:
        reasons[name] = unfit(spark, name, need)
        if reasons[name] is None:
            return name, spark.table(name)
    raise ValueError("none of the candidate tables can be used:\n" + "\n".join(f"  {n} -> {why}" for n, why in reasons.items()))


def optional_table(spark: SparkSession, name: str | None, need: Iterable[str],
                   caveats: list[str]) -> DataFrame | None:
    """A table that an exhibit can do without: None, and the reason as a caveat, if it is named but doesn't
    exist, lacks columns or can't be read. No name is no caveat."""
    if not name:
        return None
    if why := unfit(spark, name, need, read=True):
        caveats.append(f"optional source {name} left out: {why}")
        return None
    return spark.table(name)


def require_tables(spark: SparkSession, tables: Mapping[object, str],
                   how_to_make: Mapping[object, str] | None = None,
                   non_empty: bool = False) -> None:
    """Every table exists (and, if asked, has a row: ``isEmpty`` reads one row,
    not a full count); else one error naming each problem and how to fix it."""
    lines = []
    for key, t in tables.items():
        hint = f"      -> {how_to_make[key]}" if how_to_make and key in how_to_make else None
        if not spark.catalog.tableExists(t):
            lines += [f"  {t} (missing)"] + ([hint] if hint else [])
        elif non_empty and spark.table(t).isEmpty():
            lines += [f"  {t} (empty)"] + ([hint] if hint else [])
    if lines:
        raise ValueError("Missing input table(s):\n" + "\n".join(lines))


def latest_version(spark: SparkSession, prefix: str, db: str | None = None) -> tuple[str, int]:
    """Versioned lookup tables ``<prefix><year>``: the one with the largest year."""
    found = []
    for t in spark.catalog.listTables(dbName=db, pattern=f"{prefix}*"):
        m = re.fullmatch(re.escape(prefix) + r"(\d{4})", t.name)
        if m:
            found.append((int(m.group(1)), t.name))
    if not found:
        raise ValueError(f"no table named {prefix}<year>")
    year, name = max(found)
    return name, year
