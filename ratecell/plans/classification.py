"""Classification exhibits: sums of premium, exposure and claims per cell.

Plan: filters and the company map are projections/predicates pushed into the
scan; the exhibit is ONE hash aggregate (partial per task, final after one
shuffle on the cell keys). The coverage check is a separate one-row aggregate
(``operators.checks.coverage_check``), run only when asked for.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell import spec
from ratecell.functions.prep import DEFAULT_PREP, PrepSpec
from ratecell.functions.scalars import sum_null_safe_int
from ratecell.operators.aggregates import sum_by
from ratecell.operators.checks import Guard
from ratecell.operators.filters import chosen_jurisdiction, in_jurisdiction, not_null_all
from ratecell.operators.schema import require_columns
from ratecell.plans.common import prep_with_fsa, standard_filters


def trx_prepared(trx: DataFrame, province: str | None = None, fsa_col: str = "veh_fsa_tx",
                 prep: PrepSpec = DEFAULT_PREP, guard: Guard | None = None) -> DataFrame:
    """TRX rows ready to cut: province, no OccasionalPrincipal, all six premiums
    present, company mapped, prep applied, ``fsa_tx`` added."""
    require_columns(trx, spec.TRX_GROUP + spec.TRX_MEASURES + ["dri_type_cd", fsa_col], "TRX")
    d = in_jurisdiction(trx, province)
    d = d.filter(not_null_all(spec.TRX_PREMIUMS))
    d = standard_filters(d)
    d = prep_with_fsa(d, fsa_col, prep, where="TRX")
    return guard.watch(d) if guard else d


def trx_classification(trx: DataFrame, variable: str = "fsa_tx", province: str | None = None,
                       fsa_col: str = "veh_fsa_tx", prep: PrepSpec = DEFAULT_PREP,
                       guard: Guard | None = None) -> DataFrame:
    """Jurisdiction x company x accident year x level -> 26 sums. ``guard`` (here and below) watches the
    prepared rows on their way into the sums; check it after the exhibit is written."""
    d = trx_prepared(trx, province, fsa_col, prep, guard)
    return sum_by(d, spec.TRX_GROUP + [variable], spec.TRX_MEASURES)


def inforce_prepared(inf: DataFrame, province: str | None = None, fsa_col: str = "veh_fsa_tx",
                     prep: PrepSpec = DEFAULT_PREP, guard: Guard | None = None) -> DataFrame:
    """Inforce rows: composite AP indicators (null-safe), no OccasionalPrincipal,
    company mapped, prep applied, ``fsa_tx`` added. (The original builds an
    all-premiums-present predicate here but never applies it; neither do we.)"""
    require_columns(inf, spec.INF_PREMIUMS + spec.INF_RAW_INDICATORS
                    + ["dri_type_cd", "pol_uwcompany_cd", "pol_jurisdiction_cd", fsa_col], "inforce")
    d = chosen_jurisdiction(inf, province, "inforce")
    d = d.withColumns({n: sum_null_safe_int(parts) for n, parts in spec.INF_COMPOSITES.items()})
    d = standard_filters(d)
    d = prep_with_fsa(d, fsa_col, prep, where="inforce")
    return guard.watch(d) if guard else d


def inforce_classification(inf: DataFrame, variable: str = "fsa_tx", province: str | None = None,
                           fsa_col: str = "veh_fsa_tx", prep: PrepSpec = DEFAULT_PREP,
                           guard: Guard | None = None) -> DataFrame:
    """Company x level -> six exposures (indicator sums) and six term premiums."""
    d = inforce_prepared(inf, province, fsa_col, prep, guard)
    keys = ["pol_uwcompany_cd", variable]
    return d.groupBy(*keys).agg(
        *[F.sum(ind).alias(xpo) for xpo, ind in spec.INF_EXPOSURES],
        *[F.sum(p).alias(p) for p in spec.INF_PREMIUMS])


def exhibits(prepared: DataFrame, variables: Iterable[str], build) -> dict[str, DataFrame]:
    """One exhibit per variable (the notebooks' loop), sharing the prepared input."""
    return {v: build(prepared, v) for v in variables}


def trx_classification_long(trx: DataFrame, variables: Iterable[str], province: str | None = None,
                            fsa_col: str = "veh_fsa_tx", prep: PrepSpec = DEFAULT_PREP) -> DataFrame:
    """The notebooks' per-variable loop in ONE pass: every row exploded to one
    (variable, level-as-text) pair per variable, one aggregate keyed by the
    exhibit keys + variable + level. One scan and one shuffle for any number of
    variables, instead of one of each per variable."""
    from ratecell.operators.aggregates import explode_levels, variable_names
    d = trx_prepared(trx, province, fsa_col, prep)
    vs = list(variables)
    missing = [v for v in vs if v not in d.columns]
    if missing:
        raise ValueError(f"TRX: variables not on the prepared table: {missing}")
    g = (d.select(*spec.TRX_GROUP, *spec.TRX_MEASURES, *explode_levels(vs))
         .groupBy(*spec.TRX_GROUP, "_var", "level_value")
         .agg(*[F.sum(m).alias(m) for m in spec.TRX_MEASURES]))
    return g.withColumn("variable_name", variable_names(vs)).drop("_var")


def split_long(long_df: DataFrame, variables: Iterable[str]) -> dict[str, DataFrame]:
    """One exhibit per variable from the long result (level column named after
    the variable, as text). Write ``long_df`` first (``sources.sinks.materialize``)
    when several exhibits are exported, so each reads the small result."""
    return {v: long_df.filter(F.col("variable_name") == F.lit(v))
            .withColumnRenamed("level_value", v).drop("variable_name") for v in variables}


def inforce_classification_long(inf: DataFrame, variables: Iterable[str],
                                province: str | None = None, fsa_col: str = "veh_fsa_tx",
                                prep: PrepSpec = DEFAULT_PREP) -> DataFrame:
    """Inforce exhibits for several variables in ONE pass (see ``trx_classification_long``)."""
    from ratecell.operators.aggregates import explode_levels, variable_names
    d = inforce_prepared(inf, province, fsa_col, prep)
    vs = list(variables)
    missing = [v for v in vs if v not in d.columns]
    if missing:
        raise ValueError(f"inforce: variables not on the prepared table: {missing}")
    inds = [ind for _, ind in spec.INF_EXPOSURES]
    g = (d.select("pol_uwcompany_cd", *inds, *spec.INF_PREMIUMS, *explode_levels(vs))
         .groupBy("pol_uwcompany_cd", "_var", "level_value")
         .agg(*[F.sum(ind).alias(xpo) for xpo, ind in spec.INF_EXPOSURES],
              *[F.sum(p).alias(p) for p in spec.INF_PREMIUMS]))
    return g.withColumn("variable_name", variable_names(vs)).drop("_var")
