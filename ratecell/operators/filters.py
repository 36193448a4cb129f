"""Row filters. All are plain predicates, so Catalyst pushes them to the scan."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecell import spec


def in_jurisdiction(df: DataFrame, province: str | Iterable[str] | None,
                    col: str = "pol_jurisdiction_cd") -> DataFrame:
    """Equality (one province, upper-cased) or IN-list; ``None`` keeps every row."""
    if province is None:
        return df
    if isinstance(province, str):
        return df.filter(F.col(col) == F.lit(province.upper()))
    return df.filter(F.col(col).isin([p.upper() for p in province]))


def chosen_jurisdiction(df: DataFrame, province: str | Iterable[str] | None, where: str,
                        col: str = "pol_jurisdiction_cd") -> DataFrame:
    """``in_jurisdiction`` for exhibits whose cells carry no province: none named raises, since
    a table of several provinces would blend them; ``spec.ALL_PROVINCES`` says to do so."""
    if province is None:
        raise ValueError(f"{where}: name the province (or several), or pass spec.ALL_PROVINCES "
                         "to put all of them into the same cells")
    return in_jurisdiction(df, None if province == spec.ALL_PROVINCES else province, col)


def not_null_all(cols: Iterable[str]) -> Column:
    """``a IS NOT NULL AND b IS NOT NULL AND ...``. Unlike ``na.drop`` this keeps NaN."""
    return reduce(lambda acc, c: acc & F.col(c).isNotNull(), cols, F.lit(True))


def exclude_value(df: DataFrame, col: str, value) -> DataFrame:
    """``col != value``: SQL three-valued logic drops null ``col`` too."""
    return df.filter(F.col(col) != F.lit(value))


def exclude_occasional_principal(df: DataFrame, col: str = "dri_type_cd") -> DataFrame:
    return exclude_value(df, col, spec.OCCASIONAL_PRINCIPAL)


def keep_value(df: DataFrame, col: str, value) -> DataFrame:
    return df.filter(F.col(col) == F.lit(value))


def filter_if_present(df: DataFrame, conditions: Mapping[str, object]) -> DataFrame:
    """Apply ``col == value`` only for the columns that exist (plan-time branch)."""
    for c, v in conditions.items():
        if c in df.columns:
            df = df.filter(F.col(c) == F.lit(v))
    return df
