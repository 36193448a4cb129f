"""Classification prep: band the rating variables in place and add interaction keys.

One ``withColumns`` call, so the whole prep is a single Project in the plan.
The same prep must be applied to every frame that is later compared or joined
on a level (inforce, closing, both dislocation sides), which is why it is a
value (``PrepSpec``) and not a hand-written chain per notebook. FSA columns are
never touched.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecell.functions import bands
from ratecell.functions.scalars import nz_num, nz_str


def _cap(n: int) -> Callable[[Column], Column]:
    return lambda c: bands.cap_as_string(c, n)


@dataclass(frozen=True)
class PrepSpec:
    """``bands``: column -> Column function applied in place.
    ``interactions``: new column -> component columns (banded values joined)."""
    bands: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    interactions: dict[str, list[str]] = field(default_factory=dict)


DEFAULT_PREP = PrepSpec(
    bands={
        "rat_km_annual_nb": bands.km_annual_band,
        "rat_km_work_nb": bands.km_work_band,
        "rat_km_business_nb": bands.km_business_band,
        "number_veh_in_family": _cap(8),
        "number_au_mh": _cap(8),
        "veh_dri_onp_nb": _cap(4),
        "veh_age_nb": bands.veh_age_band,
        "veh_vicc_price_am": bands.price_band,
        "clt_p_holder_credit_score_no": bands.credit_band,
        "cov_col_ded_am": lambda c: nz_str(c, "N"),
        "cov_cmp_ded_am": lambda c: nz_str(c, "N"),
        "exp_col_af_10yrs_avg_nb": lambda c: nz_num(c, 99),
        "exp_minor_03yrs_avg_nb": lambda c: nz_num(c, 99),
        "exp_col_af_10yrs_nb": lambda c: nz_num(c, 0),
        "exp_minor_03yrs_nb": lambda c: nz_num(c, 0),
        "exp_major_03yrs_nb": lambda c: nz_num(c, 0),
    },
    interactions={
        "dri_type_cd_x_number_au_mh_x_veh_dri_onp_nb": ["dri_type_cd", "number_au_mh",
                                                         "veh_dri_onp_nb"],
        "dri_type_cd_x_rat_km_work_nb": ["dri_type_cd", "rat_km_work_nb"],
        "dri_type_cd_x_rat_km_business_nb": ["dri_type_cd", "rat_km_business_nb"],
        "dri_type_cd_x_rat_km_annual_nb": ["dri_type_cd", "rat_km_annual_nb"],
        "dri_yrs_licensed_au_nb_x_dri_gender_cd": ["dri_yrs_licensed_au_nb", "dri_gender_cd"],
    },
)


def prep_columns(columns: list[str], prep: PrepSpec = DEFAULT_PREP) -> dict[str, Column]:
    """The expressions ``classification_prep`` adds, for frames with ``columns``."""
    banded = {c: fn(F.col(c)) for c, fn in prep.bands.items() if c in columns}
    out = dict(banded)
    for name, parts in prep.interactions.items():
        if all(p in columns for p in parts):
            out[name] = bands.interaction_key(*[banded.get(p, F.col(p)) for p in parts])
    return out


def classification_prep(df: DataFrame, prep: PrepSpec = DEFAULT_PREP) -> DataFrame:
    """Band every present variable in place and add the interaction keys."""
    cols = prep_columns(df.columns, prep)
    return df.withColumns(cols) if cols else df
