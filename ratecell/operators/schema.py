"""Schema-driven projections: required columns, renames, affix selection.

Column presence drives these exhibits (tables are chosen, variables skipped and
spellings resolved by what exists), so every check here runs at plan time on
``df.columns`` and costs no Spark job.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, cols: Iterable[str]) -> list[str]:
    """Names of ``cols`` that are no columns of ``df``, each once, in order."""
    return [c for c in dict.fromkeys(cols) if c not in df.columns]


def require_columns(df: DataFrame, cols: Iterable[str], where: str = "input") -> DataFrame:
    """``df`` itself if it has all the columns; otherwise one error that lists every gap."""
    if gaps := missing_columns(df, cols):
        raise ValueError(f"{where} lacks {', '.join(gaps)}")
    return df


def rename_columns(df: DataFrame, mapping: Mapping[str, str], strict: bool = True,
                   where: str = "rename") -> DataFrame:
    """Rename by map in one projection. Spark silently ignores a rename of an
    absent column, so ``strict`` (the default) raises instead."""
    if strict:
        require_columns(df, mapping.keys(), where)
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def rename_suffix(df: DataFrame, suffix: str, new_suffix: str) -> DataFrame:
    """Columns ending in ``suffix`` get it replaced by ``new_suffix`` (one select).
    ``_OnLvl_Am`` -> ``_OnLvl_Am_Prop`` leaves ``_OnLvl_End_Am`` alone."""
    return df.select(*[F.col(c).alias(c[: -len(suffix)] + new_suffix) if c.endswith(suffix)
                       else F.col(c) for c in df.columns])


def affix_columns(df: DataFrame, keys: Iterable[str] = (), prefix: str | None = None,
                  suffix: str | None = None) -> list[str]:
    """``keys`` then every column with the prefix/suffix, de-duplicated in order,
    keeping only names that exist."""
    matches = [c for c in df.columns
               if (prefix is None or c.startswith(prefix)) and (suffix is None or c.endswith(suffix))]
    names = list(dict.fromkeys(list(keys) + matches))
    return [c for c in names if c in df.columns]


def select_by_affix(df: DataFrame, keys: Iterable[str] = (), prefix: str | None = None,
                    suffix: str | None = None) -> DataFrame:
    return df.select(*affix_columns(df, keys, prefix, suffix))


def split_available(df: DataFrame, candidates: Iterable[str]) -> tuple[list[str], list[str]]:
    """(present, absent) in candidate order."""
    have = set(df.columns)
    cand = list(candidates)
    return [c for c in cand if c in have], [c for c in cand if c not in have]


def select_existing(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """Final fixed column order, keeping only the names that exist."""
    have = set(df.columns)
    return df.select(*[c for c in order if c in have])


def with_typed_nulls(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add ``name -> typed null`` so differently-shaped branches stack by name."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in columns.items()})
