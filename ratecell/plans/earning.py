"""Earned premium for a scored TRX table: AP override, composites, endorsement
split and earning. Row-level only - every step is a projection, so the whole
job is one scan and one codegen stage, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell import spec
from ratecell.functions.scalars import sum_strict
from ratecell.operators.joins import split_endorsements
from ratecell.operators.schema import rename_columns

# Endorsement split used by the registered queries (endorsement, coverage, share).
# The real split table is an input file whose layout is not known; this one is
# this library's example, in binary fractions so sums stay exact.
EXAMPLE_SPLIT = [
    ("End_02", "BI", 0.5), ("End_02", "PD", 0.5),
    ("End_06A", "AB", 1.0),
    ("End_16", "AP_COL", 0.5), ("End_16", "AP_SP_CMP", 0.5),
    ("End_20", "AP_COL", 0.25), ("End_20", "AP_SP_CMP", 0.75),
    ("End_23B", "BI", 1.0),
    ("End_27", "AP_COL", 1.0),
    ("End_27S", "AP_SP_CMP", 1.0),
    ("End_38", "DC", 1.0),
    ("End_43", "AP_COL", 0.5), ("End_43", "AP_SP_CMP", 0.5),
    ("End_43R", "AP_COL", 0.5), ("End_43R", "AP_SP_CMP", 0.5),
    ("End_43S", "AP_SP_CMP", 1.0),
    ("End_60", "UA", 1.0),
    ("End_70", "PD", 1.0),
]


def ap_override(d: DataFrame) -> DataFrame:
    """If the vehicle carries AP, collision and comprehensive premium and
    exposure are 0 (AP replaces them); then the AP composites (null-propagating)."""
    ap = F.col("cov_ap_in") == 1
    d = d.withColumns({c: F.when(ap, F.lit(0)).otherwise(F.col(c))
                       for c in ["Prm_Trm_COL_Uncap_Am", "Prm_Trm_CMP_Uncap_Am",
                                 "Xpo_Ern_COL_Nb", "Xpo_Ern_CMP_Nb"]})
    return d.withColumns({
        "Prm_Trm_AP_COL_Uncap_Am": sum_strict(["Coll_Portion_of_AP", "Prm_Trm_COL_Uncap_Am"]),
        "Prm_Trm_AP_SP_CMP_Uncap_Am": sum_strict(["Prm_Trm_SP_Uncap_Am", "Comp_Portion_of_AP",
                                                  "Prm_Trm_CMP_Uncap_Am"]),
        "Xpo_Ern_AP_COL_Nb": sum_strict(["Xpo_Ern_AP_Nb", "Xpo_Ern_COL_Nb"]),
        "Xpo_Ern_AP_SP_CMP_Nb": sum_strict(["Xpo_Ern_SPE_Nb", "Xpo_Ern_AP_Nb", "Xpo_Ern_CMP_Nb"]),
    })


def earned_columns(d: DataFrame) -> DataFrame:
    """Endorsement portions, earned premium, and earned premium with endorsements
    (UI has no split, so its 'with endorsements' uses the base premium)."""
    d = d.withColumns({f"{c}_Portion_All": F.col(f"Prm_Trm_{c}_Uncap_Am_End")
                       - F.col(f"Prm_Trm_{c}_Uncap_Am") for c in spec.COV_END})
    d = d.withColumns({f"Prm_Ern_{c}_OnLvl_Am": F.col(f"Prm_Trm_{c}_Uncap_Am")
                       * F.col(f"Xpo_Ern_{c}_Nb") for c in spec.COV_ALL})
    return d.withColumns({
        f"Prm_Ern_{c}_OnLvl_End_Am": F.col(f"Prm_Trm_{c}_Uncap_Am" + ("" if c == "UI" else "_End"))
        * F.col(f"Xpo_Ern_{c}_Nb") for c in spec.COV_ALL})


def earn(scored: DataFrame, split: DataFrame | Iterable = EXAMPLE_SPLIT) -> DataFrame:
    """Scored TRX -> earned TRX (the table the TRX classification and the
    dislocation summary read)."""
    d = rename_columns(scored, spec.ENDORSEMENTS, where="endorsement premiums")
    d = rename_columns(d, spec.EARN_EXPOSURES, where="earned exposures")
    d = ap_override(d)
    ends = {e: e for e in spec.ENDORSEMENTS.values()}
    d = split_endorsements(d, split, ends, spec.EARN_PREMIUMS[:-1])
    return earned_columns(d)
