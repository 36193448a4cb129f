"""Steps shared by several exhibits."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell import spec
from ratecell.functions.prep import DEFAULT_PREP, PrepSpec, classification_prep
from ratecell.functions.scalars import company_map, fsa_normalize


def map_company(df: DataFrame, col: str = "pol_uwcompany_cd") -> DataFrame:
    return df.withColumn(col, company_map(col))


def with_fsa(df: DataFrame, fsa_col: str = "veh_fsa_tx", out: str = "fsa_tx",
             where: str = "input") -> DataFrame:
    """The area code of ``fsa_col``, normalised, as ``out``. A table without that column raises and names
    the columns that may be meant."""
    if fsa_col in df.columns:
        return df.withColumn(out, fsa_normalize(fsa_col))
    near = sorted(c for c in df.columns if "fsa" in c.lower()) or "none"
    raise ValueError(f"{where} has no column {fsa_col!r} to cut by; similar columns: {near}")


def prep_with_fsa(df: DataFrame, fsa_col: str = "veh_fsa_tx", prep: PrepSpec = DEFAULT_PREP,
                  required: Iterable[str] = (), where: str = "input") -> DataFrame:
    """Classification prep, then the normalised FSA; ``required`` names must exist after."""
    d = with_fsa(classification_prep(df, prep), fsa_col, where=where)
    missing = [c for c in required if c not in d.columns]
    if missing:
        raise ValueError(f"{where}: classification prep did not produce {missing}")
    return d


def prep_inputs(outputs: Iterable[str], fsa_col: str = "veh_fsa_tx",
                prep: PrepSpec = DEFAULT_PREP) -> list[str]:
    """Raw columns the prep needs to produce ``outputs`` (used to carry only those)."""
    need: list[str] = []
    for v in outputs:
        if v == "fsa_tx":
            need.append(fsa_col)
        elif v in prep.interactions:
            need.extend(prep.interactions[v])
        else:
            need.append(v)
    return list(dict.fromkeys(need))


def standard_filters(df: DataFrame, drop_occasional_principal: bool = True) -> DataFrame:
    """``dri_type_cd != 'OccasionalPrincipal'`` (null types drop too) and the company map."""
    if drop_occasional_principal:
        df = df.filter(F.col("dri_type_cd") != F.lit(spec.OCCASIONAL_PRINCIPAL))
    return map_company(df)
