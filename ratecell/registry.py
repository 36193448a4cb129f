"""Named queries over the driver's tables: one per operator or exhibit.

Every query reads the given tables (through the fixture book, which Spark
derives from them) and runs over all of their rows. Each has a DuckDB
counterpart in ``ratecell.oracle`` under the same name unless noted there.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ratecell import spec
from ratecell.functions import bands as BD
from ratecell.functions import scalars as SC
from ratecell.operators import checks as CK
from ratecell.operators import filters as FL
from ratecell.operators import joins as JN
from ratecell.operators import schema as SCH
from ratecell.operators import windows as WN
from ratecell.plans import earning as EA
from ratecell.plans import scoring as SG
from ratecell.plans.common import map_company
from ratecell.session import ensure_checkpoint_dir
from ratecell.sources import catalog as CAT
from ratecell.sources import extract as EX
from ratecell.sources import sinks as SK
from ratecell.plans import classification as C
from ratecell.plans import dislocation as D
from ratecell.plans import elr as E
from ratecell.sources import book as B

Query = Callable[[SparkSession, str], DataFrame]


def _tag(sf: str) -> str:
    """View-name suffix per input folder, so views registered for one scale
    factor are never replaced under a frame built for another."""
    import re
    return re.sub(r"\W", "_", sf.rstrip("/").rsplit("/", 1)[-1])


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return _sides_bucketed(spark, sf)[0]


def _sides_bucketed(spark: SparkSession, sf: str) -> tuple[tuple[DataFrame, DataFrame], tuple[str, int] | None]:
    """Both sides and how what is made of them vehicle by vehicle is bucketed, ``None`` if it is not."""
    rows, buckets = B.vehicle_rows_buckets(spark, sf)       # the tables are joined once for both sides
    sides = B.book(spark, sf, "current", rows), B.book(spark, sf, "proposed", rows)
    return sides, buckets and ("veh_id_no", buckets)


def q_dislocation_trx_vehicle(spark, sf):
    return D.trx_by_vehicle(*_sides(spark, sf))


def _by_driver(spark, sf, **options):
    # Over bucketed sides the join and the bands move no row: they are run where they are read, not written.
    sides, bucketed = _sides_bucketed(spark, sf)
    return D.trx_by_driver(*sides, materialize=not bucketed, **options)


def q_dislocation_trx_driver(spark, sf):
    return _by_driver(spark, sf)


def q_dislocation_inf_vehicle(spark, sf):
    return D.inf_by_vehicle(*_sides(spark, sf))


# Other edges and one cut variable: each cell sums many rows, and each band many vehicles.
WIDE_BOUNDS = (-0.2, 0.3, 0.1)
CUTS = ["dri_gender_cd"]


def q_dislocation_trx_vehicle_wide(spark, sf):
    return D.trx_by_vehicle(*_sides(spark, sf), bounds=WIDE_BOUNDS)


def q_dislocation_trx_driver_cuts(spark, sf):
    return _by_driver(spark, sf, bounds=WIDE_BOUNDS, c_variables=CUTS, drop_occasional_principal=True)


def q_dislocation_inf_vehicle_cuts(spark, sf):
    return D.inf_by_vehicle(*_sides(spark, sf), bounds=WIDE_BOUNDS, c_variables=CUTS)


def q_trx_classification(spark, sf):
    return C.trx_classification(B.book(spark, sf))


TRX_VARIABLES = ["fsa_tx", "ter_onlvl_ibc_no", "veh_age_nb", "rat_km_annual_nb", "dri_gender_cd",
                 "veh_vicc_price_am"]


def q_trx_classification_long(spark, sf):
    return C.trx_classification_long(B.book(spark, sf), TRX_VARIABLES)


INF_VARIABLES = ["fsa_tx", "ter_onlvl_ibc_no", "veh_age_nb", "number_veh_in_family",
                 "clt_p_holder_credit_score_no", "dri_type_cd_x_rat_km_work_nb"]


def q_inforce_classification_long(spark, sf):
    return C.inforce_classification_long(B.book(spark, sf), INF_VARIABLES, province=spec.ALL_PROVINCES)


def q_inforce_classification(spark, sf):
    return C.inforce_classification(B.book(spark, sf), province=spec.ALL_PROVINCES)


def q_elr(spark, sf):
    return E.elr_exhibit(B.book(spark, sf), province=spec.ALL_PROVINCES)


def q_elr_long(spark, sf, **options):
    rows = B.written_rows(spark, sf)            # the tables are joined once for the three sources
    return E.elr_long(B.book(spark, sf, rows=rows), closing=B.closing(spark, sf, rows),
                      retention=B.retention(spark, sf, rows), province=spec.ALL_PROVINCES, write_cells=True, **options)


# --- sources, projections, filters ---------------------------------------------------------
AS_OF = "2025-06-30"
EXTRACT_COLS = ["veh_id_no", "dri_id_no", "pol_jurisdiction_cd", "veh_product_cd",
                "pol_commercial_in", "trx_offset_onset_cd", "Prm_Ern_BI_OnLvl_End_Am"]


def q_extract_trx(spark, sf):
    # every as-of date and year type
    return EX.extract_trx(B.book(spark, sf), EXTRACT_COLS, province="america", as_of=None, year_type=None)


def q_extract_inforce(spark, sf):
    d = EX.extract_inforce(B.book(spark, sf), province=["AMERICA", "EUROPE"], as_of=None)
    return d.groupBy("pol_jurisdiction_cd", "veh_product_cd").agg(F.count(F.lit(1)).alias("rows"))


def q_extract_loss_cost(spark, sf):
    cols = spec.LOSS_COST_KEYS + list(spec.LOSS_COST_RENAME)
    d = EX.extract_loss_cost(B.loss_cost_table(spark, sf), columns=cols)
    return d.groupBy("pol_jurisdiction_cd", "veh_product_cd").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("lc_losscost_bi_pred_rebase").alias("lc_bi"),
        F.sum("lc_losscost_total_pred_rebase").alias("lc_total"))


def q_select_by_suffix(spark, sf):
    prop = SCH.rename_suffix(B.book(spark, sf, "proposed"), "_OnLvl_Am", "_OnLvl_Am_Prop")
    sel = SCH.select_by_affix(prop, spec.TRX_UNIQUE_KEYS + ["pol_uwcompany_cd"],
                              suffix="_OnLvl_Am_Prop")
    sums = [c for c in sel.columns if c.endswith("_Prop")]
    return sel.groupBy("pol_jurisdiction_cd").agg(F.count(F.lit(1)).alias("rows"),
                                                  *[F.sum(c).alias(c) for c in sums])


def q_rename_map(spark, sf):
    d = SCH.rename_columns(B.book(spark, sf), spec.ELR_RENAME)
    return d.groupBy("pol_jurisdiction_cd").agg(*[F.sum(c).alias(c) for c in spec.ELR_RENAME.values()])


def q_not_null_all(spark, sf):
    d = B.book(spark, sf).withColumn("all_present", FL.not_null_all(spec.TRX_PREMIUMS))
    return d.groupBy("pol_jurisdiction_cd", "all_present").agg(F.count(F.lit(1)).alias("rows"))


def q_exclude_null_safe(spark, sf):
    d = FL.exclude_occasional_principal(B.book(spark, sf))
    return d.groupBy("dri_type_cd").agg(F.count(F.lit(1)).alias("rows"))


def q_keep_principal(spark, sf):
    d = FL.keep_value(B.book(spark, sf), "dri_type_cd", spec.PRINCIPAL)
    return d.groupBy("pol_jurisdiction_cd").agg(F.count(F.lit(1)).alias("rows"))


def q_filter_if_present(spark, sf):
    d = FL.filter_if_present(B.closing(spark, sf), {"veh_product_cd": "ppa", "pol_commercial_in": 0,
                                                    "not_a_column": 1})
    return d.groupBy("pol_jurisdiction_cd").agg(F.count(F.lit(1)).alias("rows"))


def q_row_profile(spark, sf):
    return CK.row_profile(B.book(spark, sf))


# --- scalars and bands -----------------------------------------------------------------------
def q_fsa_normalize(spark, sf):
    d = B.book(spark, sf).select("veh_fsa_tx", SC.fsa_normalize("veh_fsa_tx").alias("fsa_tx"))
    return d.groupBy("veh_fsa_tx", "fsa_tx").agg(F.count(F.lit(1)).alias("rows"))


def q_fsa_strict(spark, sf):
    d = B.book(spark, sf).select("veh_fsa_tx", SC.fsa_strict("veh_fsa_tx").alias("fsa_strict"))
    return d.groupBy("veh_fsa_tx", "fsa_strict").agg(F.count(F.lit(1)).alias("rows"))


def q_company_map(spark, sf):
    d = B.book(spark, sf).select("pol_uwcompany_cd",
                                 SC.company_map("pol_uwcompany_cd").alias("company"),
                                 SC.company_map_keep_null("pol_uwcompany_cd").alias("company_keep_null"))
    return d.groupBy("pol_uwcompany_cd", "company", "company_keep_null").agg(
        F.count(F.lit(1)).alias("rows"))


def q_nz_defaults(spark, sf):
    b = B.book(spark, sf)
    d = b.select(SC.nz_str("cov_col_ded_am").alias("ded"),
                 SC.nz_num("exp_minor_03yrs_nb", 0).alias("minor"),
                 (SC.nz("rat_km_annual_nb") == 0).alias("km_missing"),
                 SC.nz_num("rat_fulldemand_closing_fc", 99).alias("closing_fc"),
                 SC.coalesce_any(b, ["Prm_Trm_AP_SP_COMP_Uncap_Am",
                                     "Prm_Trm_AP_SP_CMP_Uncap_Am"]).alias("cmp_any"),
                 SC.coalesce_any(b, ["no_such_column"]).alias("none_any"))
    return d.groupBy("ded", "minor", "km_missing").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("closing_fc").alias("closing_fc_sum"),
        F.sum("cmp_any").alias("cmp_any_sum"), F.sum("none_any").alias("none_any_sum"))


def q_band_km(spark, sf):
    d = B.book(spark, sf).select(
        "rat_km_annual_nb", "rat_km_work_nb", "rat_km_business_nb",
        BD.km_annual_band("rat_km_annual_nb").alias("annual_band"),
        BD.km_work_band("rat_km_work_nb").alias("work_band"),
        BD.km_business_band("rat_km_business_nb").alias("business_band"))
    return d.groupBy("annual_band", "work_band", "business_band").agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{n}_{c}") for c in ["rat_km_annual_nb", "rat_km_work_nb", "rat_km_business_nb"]
          for n, f in (("min", F.min), ("max", F.max))])


def q_band_caps(spark, sf):
    raw = ["number_veh_in_family", "number_au_mh", "veh_dri_onp_nb", "veh_age_nb"]
    d = B.book(spark, sf).select(
        *raw, BD.cap_as_string("number_veh_in_family", 8).alias("family_band"),
        BD.cap_as_string("number_au_mh", 8).alias("au_mh_band"),
        BD.cap_as_string("veh_dri_onp_nb", 4).alias("onp_band"),
        BD.veh_age_band("veh_age_nb").alias("age_band"))
    return d.groupBy("family_band", "au_mh_band", "onp_band", "age_band").agg(
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{n}_{c}") for c in raw for n, f in (("min", F.min), ("max", F.max))])


def q_band_price(spark, sf):
    d = B.book(spark, sf).select("veh_vicc_price_am",
                                 BD.price_band("veh_vicc_price_am").alias("price_band"))
    return d.groupBy("price_band").agg(F.count(F.lit(1)).alias("rows"),
                                       F.min("veh_vicc_price_am").alias("min_price"),
                                       F.max("veh_vicc_price_am").alias("max_price"))


def q_band_credit(spark, sf):
    d = B.book(spark, sf).select("clt_p_holder_credit_score_no",
                                 BD.credit_band("clt_p_holder_credit_score_no").alias("credit_band"))
    return d.groupBy("clt_p_holder_credit_score_no", "credit_band").agg(
        F.count(F.lit(1)).alias("rows"))


def q_interaction_keys(spark, sf):
    from ratecell.functions.prep import classification_prep
    d = classification_prep(B.book(spark, sf))
    keys = [k for k in spec.CANDIDATE_VARS if "_x_" in k]
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))


def q_rate_change_bucket(spark, sf):
    v = D.trx_vehicle_bands(D.trx_joined(*_sides(spark, sf)))
    return v.groupBy("Rate_Change_Level").agg(
        F.count(F.lit(1)).alias("vehicles"), F.min("Rate_Change_Pc").alias("min_rc"),
        F.max("Rate_Change_Pc").alias("max_rc"),
        F.count_if(F.col("Rate_Change_Pc").isNull()).alias("null_rc"))


# --- earning ---------------------------------------------------------------------------------
SCORED_TRX = (["pol_jurisdiction_cd", "pol_uwcompany_cd", "veh_id_no", "dri_id_no", "cov_ap_in",
               "Coll_Portion_of_AP", "Comp_Portion_of_AP"]
              + [f"Prm_Trm_{c}_Uncap_Am" for c in ["BI", "PD", "DC", "AB", "UA", "UI", "COL", "CMP", "SP"]]
              + list(spec.ENDORSEMENTS) + list(spec.EARN_EXPOSURES))


def scored_trx(spark, sf):
    return B.book(spark, sf).select(*SCORED_TRX)


def q_ap_override(spark, sf):
    d = SCH.rename_columns(scored_trx(spark, sf), spec.EARN_EXPOSURES)
    d = EA.ap_override(d)
    cols = ["Prm_Trm_COL_Uncap_Am", "Prm_Trm_CMP_Uncap_Am", "Xpo_Ern_COL_Nb", "Xpo_Ern_CMP_Nb",
            "Prm_Trm_AP_COL_Uncap_Am", "Prm_Trm_AP_SP_CMP_Uncap_Am", "Xpo_Ern_AP_COL_Nb",
            "Xpo_Ern_AP_SP_CMP_Nb"]
    return d.groupBy("cov_ap_in").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in cols])


def q_endorsement_split(spark, sf):
    d = SCH.rename_columns(scored_trx(spark, sf), spec.ENDORSEMENTS)
    d = EA.ap_override(SCH.rename_columns(d, spec.EARN_EXPOSURES))
    d = JN.split_endorsements(d, EA.EXAMPLE_SPLIT, {e: e for e in spec.ENDORSEMENTS.values()},
                              spec.EARN_PREMIUMS[:-1])
    outs = [f"{p}_End" for p in spec.EARN_PREMIUMS[:-1]]
    return d.groupBy("pol_jurisdiction_cd").agg(*[F.sum(c).alias(c) for c in outs])


def q_earned_premium(spark, sf):
    d = EA.earn(scored_trx(spark, sf))
    cols = ([f"Prm_Ern_{c}_OnLvl_Am" for c in spec.COV_ALL]
            + [f"Prm_Ern_{c}_OnLvl_End_Am" for c in spec.COV_ALL]
            + [f"{c}_Portion_All" for c in spec.COV_END])
    return d.groupBy("pol_jurisdiction_cd").agg(*[F.sum(c).alias(c) for c in cols])


def q_side_totals(spark, sf):
    j = D.trx_joined(*_sides(spark, sf))
    cols = ([f"Prm_Trm_{o}_Uncap_Am_Ern" for o, _ in spec.EARN_MAP] + ["Prm_Trm_TOT_Uncap_Am_Ern"]
            + [f"Prm_Trm_{o}_Uncap_Am_Prop_Ern" for o, _ in spec.EARN_MAP]
            + ["Prm_Trm_TOT_Uncap_Am_Prop_Ern", "Clm_Tot_Am"])
    return j.groupBy("pol_uwcompany_cd").agg(*[F.sum(c).alias(c) for c in cols])


def q_household_counts(spark, sf):
    d = E.household_counts(B.closing(spark, sf))
    return d.groupBy("veh_product_cd", "number_au_mh", "number_veh_in_family").agg(
        F.count(F.lit(1)).alias("rows"))


def q_mandatory_only(spark, sf):
    j = D.inf_joined(*_sides(spark, sf))
    v = D.inf_principal_vehicles(j, ["dri_type_cd"])
    v = v.withColumn("Mandatory_Only", SC.mandatory_only("Prm_Trm_Veh_AP_COL_Uncap_Am",
                                                         "Prm_Trm_Veh_AP_SP_COMP_Uncap_Am"))
    return v.groupBy("pol_uwcompany_cd", "Mandatory_Only").agg(F.count(F.lit(1)).alias("vehicles"))


# --- aggregates and checks -----------------------------------------------------------------
def q_weighted_mean(spark, sf):
    from ratecell.operators.aggregates import weighted_mean_parts
    d = map_company(B.book(spark, sf))
    num, den = weighted_mean_parts("rat_fulldemand_closing_fc", "Prm_Trm_Dri_Tot_Uncap_Am")
    g = d.groupBy("pol_uwcompany_cd").agg(F.avg("rat_fulldemand_closing_fc").alias("pred_closing"),
                                          num.alias("num"), den.alias("den"))
    return g.select("pol_uwcompany_cd", "pred_closing",
                    SC.ratio_or_null("num", "den").alias("pred_closing_prem_wtd"))


def q_closing_ratio(spark, sf):
    from ratecell.operators.aggregates import distinct_flagged_by
    c = E.closing_prepared(B.closing(spark, sf), spec.ALL_PROVINCES)
    g = distinct_flagged_by(c, ["pol_uwcompany_cd", "veh_fsa_tx"], "pol_quote_no", "clo_bound_in",
                            "quotes", "bound")
    return g.withColumn("closing_ratio", SC.ratio_or_null("bound", "quotes"))


def q_retention_ratio(spark, sf):
    from ratecell.operators.aggregates import distinct_flagged_by
    r = E.retention_prepared(B.retention(spark, sf), spec.ALL_PROVINCES)
    g = distinct_flagged_by(r, ["pol_uwcompany_cd", "dri_gender_cd"], "pol_policy_no", "retained_in",
                            "policies_exposed", "policies_retained")
    return g.withColumn("retention_actual", SC.ratio_or_null("policies_retained", "policies_exposed"))


def q_coverage_check(spark, sf):
    return CK.coverage_check(C.trx_prepared(B.book(spark, sf)))


def q_unknown_share(spark, sf):
    return CK.unknown_share(CK.coverage_check(
        C.inforce_prepared(B.book(spark, sf), province=spec.ALL_PROVINCES)))


def q_double_count_guard(spark, sf):
    d = C.inforce_prepared(B.book(spark, sf), province=spec.ALL_PROVINCES)
    return CK.double_count_rows(d, list(spec.INF_COMPOSITES))


def q_reconcile(spark, sf):
    fine = C.trx_classification(B.book(spark, sf))
    coarse = C.sum_by(C.trx_prepared(B.book(spark, sf)), spec.TRX_GROUP, spec.TRX_MEASURES)
    return CK.reconcile(fine, coarse, spec.TRX_GROUP, ["Prm_Ern_BI_OnLvl_End_Am", "Xpo_Ern_BI_Nb"])


def q_thin_cells(spark, sf):
    ex = C.inforce_classification(B.book(spark, sf), province=spec.ALL_PROVINCES)
    return CK.thin_cells(ex, "Xpo_BI", 100.0, by=["pol_uwcompany_cd"])


def q_null_operands(spark, sf):
    return CK.null_operands(B.book(spark, sf), ["cov_col_in", "Prm_Trm_BI_Uncap_Am",
                                                "rat_km_annual_nb", "pol_uwcompany_cd"])


def q_single_jurisdiction(spark, sf):
    return CK.jurisdictions_in(EX.extract_trx(B.book(spark, sf), None, province="AMERICA", as_of=AS_OF))


def q_side_balance(spark, sf):
    cur, prop = _sides(spark, sf)
    return CK.side_counts({("trx", "current"): cur, ("trx", "proposed"): prop,
                           ("inf", "current"): EX.extract_inforce(cur, province=None, as_of=AS_OF),
                           ("inf", "proposed"): EX.extract_inforce(prop, province=None, as_of=AS_OF)})


# --- joins ------------------------------------------------------------------------------------
def q_cur_prop_join(spark, sf):
    j = D.inf_joined(*_sides(spark, sf))
    return j.groupBy("pol_uwcompany_cd").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("Prm_Trm_Dri_Tot_Uncap_Am_Prop").isNotNull()).alias("matched"),
        F.sum("Prm_Trm_Dri_Tot_Uncap_Am").alias("cur_tot"),
        F.sum("Prm_Trm_Dri_Tot_Uncap_Am_Prop").alias("prop_tot"))


def q_band_back_join(spark, sf):
    sides, bucketed = _sides_bucketed(spark, sf)
    j = D.trx_joined(*sides).select(*spec.TRX_VEHICLE, "dri_id_no", "Prm_Trm_TOT_Uncap_Am_Ern",
                                    "Prm_Trm_TOT_Uncap_Am_Prop_Ern")
    d = D.trx_rows_banded(SK.materialize(j, "band_back_join", bucketed), bucketed=bucketed)
    return d.groupBy("Rate_Change_Level").agg(F.count(F.lit(1)).alias("rows"),
                                              F.sum("Prm_Trm_TOT_Uncap_Am_Ern").alias("cur_tot"))


def q_loss_cost_join(spark, sf):
    lc_out = list(spec.LOSS_COST_RENAME.values())
    base = B.book(spark, sf).drop(*lc_out)
    d = JN.attach_loss_cost(base, B.loss_cost_table(spark, sf), spec.LOSS_COST_KEYS,
                            spec.LOSS_COST_RENAME)
    return d.groupBy("pol_jurisdiction_cd", "veh_product_cd").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("lc_losscost_bi_pred_am").isNull()).alias("unmatched"),
        F.sum("lc_losscost_bi_pred_am").alias("lc_bi"),
        F.sum("lc_losscost_total_pred_am").alias("lc_total"))


def _register_clear(spark, sf):
    prefix = f"rate_group_{_tag(sf)}_"
    for year in (2024, 2025):
        B.clear_table(spark, sf, year).createOrReplaceTempView(f"{prefix}{year}")
    return CAT.latest_version(spark, prefix)


def q_versioned_lookup(spark, sf):
    name, year = _register_clear(spark, sf)
    d = SG.onlevel_clear(B.book(spark, sf), spark.table(name))
    return d.groupBy("veh_rg_col_no", "veh_rg_cmp_no").agg(F.count(F.lit(1)).alias("rows"),
                                                          F.lit(year).alias("clear_year"))


def q_rerate(spark, sf):
    d = JN.rerate(map_company(B.book(spark, sf)), SG.EXAMPLE_CHART, SG.RERATED)
    return d.groupBy("pol_uwcompany_cd").agg(*[F.sum(c).alias(c) for c in SG.RERATED])


def q_score_inforce(spark, sf):
    name, _ = _register_clear(spark, sf)
    inf = EX.extract_inforce(B.book(spark, sf), province=None, as_of=None)
    d = SG.score_inforce(inf, B.loss_cost_table(spark, sf), spark.table(name))
    return d.groupBy("pol_jurisdiction_cd").agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in SG.RERATED],
        F.sum("lc_losscost_total_pred_am").alias("lc_total"))


def q_merge_test(spark, sf):
    name, _ = _register_clear(spark, sf)
    inf = EX.extract_inforce(B.book(spark, sf), province=None, as_of=AS_OF)
    scored = SG.score_inforce(inf, B.loss_cost_table(spark, sf), spark.table(name))
    return CK.same_rows(inf, scored)


# --- windows, dedup, unions -------------------------------------------------------------------
def _principal_summary(v):
    return v.groupBy("pol_uwcompany_cd").agg(
        F.count(F.lit(1)).alias("vehicles"),
        F.sum("Prm_Trm_Veh_Base_Uncap_Am").alias("veh_base"),
        F.sum("Prm_Trm_Veh_Base_Uncap_Am_Prop").alias("veh_base_prop"),
        F.sum("veh_age_nb").alias("principal_age_sum"))


def q_vehicle_window_totals(spark, sf):
    """Vehicle totals kept on every driver row (aggregate joined back with hot vehicles
    split, no window over the vehicle), then one principal row per vehicle."""
    sides, bucketed = _sides_bucketed(spark, sf)
    j = D.inf_joined(*sides)
    totals = {k: v for k, v in D._vehicle_totals(j).items() if "_Base_" in k}
    j = SK.materialize(j.select(*spec.INF_VEHICLE, "dri_id_no", "dri_type_cd", "veh_age_nb",
                                "Prm_Trm_Dri_Base_Uncap_Am", "Prm_Trm_Dri_Base_Uncap_Am_Prop"), "vehicle_rows",
                       bucketed)
    rows = WN.with_group_totals_split(j, spec.INF_VEHICLE, totals, bucketed=bucketed)
    one = WN.first_per_group(rows.select(*spec.INF_VEHICLE, "dri_id_no", "dri_type_cd", "veh_age_nb",
                                         *totals),
                             spec.INF_VEHICLE, ["dri_id_no"],
                             where=F.col("dri_type_cd") == F.lit(spec.PRINCIPAL))
    return _principal_summary(one)


def q_principal_dedup(spark, sf):
    j = D.inf_joined(*_sides(spark, sf))
    return _principal_summary(D.inf_principal_vehicles(j, ["dri_type_cd", "veh_age_nb"]))


def q_first_per_group(spark, sf):
    d = map_company(B.book(spark, sf))
    one = WN.first_per_group(d.select(*spec.INF_VEHICLE, "dri_id_no", "dri_type_cd", "veh_age_nb"),
                             spec.INF_VEHICLE, ["dri_id_no"],
                             where=F.col("dri_type_cd") == F.lit(spec.PRINCIPAL))
    return one.groupBy("pol_uwcompany_cd").agg(F.count(F.lit(1)).alias("vehicles"),
                                               F.sum("veh_age_nb").alias("principal_age_sum"))


def q_row_index(spark, sf):
    d = WN.row_index(B.book(spark, sf))
    return d.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("index_id").alias("ids"))


def q_union_variables(spark, sf):
    rows = B.written_rows(spark, sf)            # each variable's aggregate reads the written rows
    return E.elr_long_per_variable(B.book(spark, sf, rows=rows), province=spec.ALL_PROVINCES)


# --- catalog and sinks --------------------------------------------------------------------------
def q_resolve_table(spark, sf):
    b = B.book(spark, sf)
    t = _tag(sf)
    # The first candidate doesn't exist, the second lacks columns and the last holds other rows.
    b.where("pol_jurisdiction_cd = 'ASIA'").drop(*spec.TRX_PREMIUMS).createOrReplaceTempView(f"trx_candidate_b_{t}")
    b.createOrReplaceTempView(f"trx_candidate_c_{t}")
    b.where("pol_jurisdiction_cd <> 'ASIA'").createOrReplaceTempView(f"trx_candidate_d_{t}")
    _, d = CAT.resolve_table(spark, [f"trx_candidate_a_{t}", f"trx_candidate_b_{t}",
                                     f"trx_candidate_c_{t}", f"trx_candidate_d_{t}"],
                             spec.TRX_GROUP + spec.TRX_MEASURES + ["dri_type_cd", "veh_fsa_tx"])
    return CK.row_profile(d)


def q_optional_source(spark, sf):
    from ratecell.operators.aggregates import distinct_flagged_by
    caveats: list[str] = []
    B.closing(spark, sf).createOrReplaceTempView(f"closing_rows_{_tag(sf)}")
    clo = CAT.optional_table(spark, f"closing_rows_{_tag(sf)}",
                             ["pol_quote_no", "clo_bound_in", "pol_jurisdiction_cd"], caveats)
    ret = CAT.optional_table(spark, "retention_missing", ["retained_in"], caveats)
    c = E.closing_prepared(clo, spec.ALL_PROVINCES)
    g = distinct_flagged_by(c, ["pol_uwcompany_cd"], "pol_quote_no", "clo_bound_in", "quotes", "bound")
    g = g.withColumn("closing_ratio", SC.ratio_or_null("bound", "quotes"))
    if ret is None:
        g = SCH.with_typed_nulls(g, {"policies_exposed": "long", "retention_actual": "double"})
    return g


def q_config_projection(spark, sf):
    """Helper CSV lists the extract's columns (S6, S7); the projection is registered
    as a view (S8), checked to exist and be non-empty (S9), then queried in SQL."""
    helper = f"{ensure_checkpoint_dir(spark)}/helpers/{_tag(sf)}/trx_extract_helper.csv"
    (spark.createDataFrame([(c,) for c in EXTRACT_COLS], "var_name string").coalesce(1)
     .write.mode("overwrite").option("header", True).csv(helper))
    names = EX.config_columns(EX.read_helper(spark, helper))
    view = f"trx_extract_view_{_tag(sf)}"
    EX.register(B.book(spark, sf).select(*names), view)
    CAT.require_tables(spark, {"extract": view}, non_empty=True)
    return spark.sql("SELECT pol_jurisdiction_cd, veh_product_cd, COUNT(*) AS rows, "
                     f"SUM(Prm_Ern_BI_OnLvl_End_Am) AS prm_bi FROM {view} "
                     "GROUP BY pol_jurisdiction_cd, veh_product_cd")


def q_write_read_exhibit(spark, sf):
    import uuid
    ex = D.trx_by_vehicle(*_sides(spark, sf))
    # a folder per call: the returned frame reads these files lazily
    folder = f"{ensure_checkpoint_dir(spark)}/exhibits/{uuid.uuid4().hex}"
    log: list = []
    SK.write_exhibit(ex, folder, 1001, "dislocation", "TRX_by_Vehicle", dry_run=True, log=log)
    path = SK.write_exhibit(ex, folder, 1001, "dislocation", "TRX_by_Vehicle", log=log)
    return spark.read.parquet(path)


# --- saved sides, checks in one pass, scoring on charts -----------------------------------------------
def _folder(spark, name: str) -> str:
    """A new folder of this query's run in the shared checkpoint folder."""
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}/{uuid.uuid4().hex}"


def q_cur_prop_join_bucketed(spark, sf):
    """``cur_prop_join`` over two saved sides: no exchange under the join."""
    import uuid
    names = [f"side_{x}_{uuid.uuid4().hex}" for x in ("current", "proposed")]
    keep = spec.INF_UNIQUE_KEYS + ["pol_uwcompany_cd", "Prm_Trm_Dri_Tot_Uncap_Am"]
    sides = D.saved_sides(*[d.select(*keep) for d in _sides(spark, sf)], spec.INF_UNIQUE_KEYS + ["pol_uwcompany_cd"],
                          int(spark.conf.get("spark.sql.shuffle.partitions")), names, [_folder(spark, n) for n in names])
    j = D.inf_joined(*sides, map_codes=False)
    return j.groupBy("pol_uwcompany_cd").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("Prm_Trm_Dri_Tot_Uncap_Am_Prop").isNotNull()).alias("matched"),
        F.sum("Prm_Trm_Dri_Tot_Uncap_Am").alias("cur_tot"),
        F.sum("Prm_Trm_Dri_Tot_Uncap_Am_Prop").alias("prop_tot"))


def q_elr_long_bitmaps(spark, sf):
    return q_elr_long(spark, sf, distinct="bitmaps")


def q_row_index_ordered(spark, sf):
    return WN.row_index(B.book(spark, sf).select("veh_id_no", "dri_id_no"), order=["veh_id_no", "dri_id_no"])


def q_reconcile_one_pass(spark, sf):
    return CK.reconcile_one_pass(C.trx_prepared(B.book(spark, sf)), spec.TRX_GROUP, "fsa_tx",
                                 ["Prm_Ern_BI_OnLvl_End_Am", "Xpo_Ern_BI_Nb"])


def q_merge_test_rows(spark, sf):
    """The merge test on keys: scored rows hold the extract's, rows with some policies exchanged don't."""
    name, _ = _register_clear(spark, sf)
    inf = EX.extract_inforce(B.book(spark, sf), province=None, as_of=AS_OF)
    scored = SG.score_inforce(inf, B.loss_cost_table(spark, sf), spark.table(name))
    swapped = inf.withColumn("pol_policy_no", F.expr("CASE WHEN veh_id_no % 1000 = 7 THEN -1 ELSE pol_policy_no END"))
    tests = [CK.same_row_set(inf, d, spec.INF_UNIQUE_KEYS).select(F.lit(n).alias("compared"), "*")
             for n, d in (("scored", scored), ("swapped", swapped))]
    return tests[0].unionByName(tests[1])


def q_exhibit_guards(spark, sf):
    """Counts that ride on the jobs that write two exhibits, one row for each exhibit."""
    reports = []
    for n, build, more in (("inforce", C.inforce_classification, {"composites": list(spec.INF_COMPOSITES)}),
                           ("elr", E.elr_exhibit, {})):
        guard = CK.Guard(n, operands=["dri_gender_cd", "rat_km_annual_nb"], **more)
        ex = build(B.book(spark, sf), province=spec.ALL_PROVINCES, guard=guard)
        SK.write_exhibit(ex, _folder(spark, "guarded"), 1001, "guards", n)
        r = guard.report()
        reports.append((n, *[r[c] for c in ("rows", "unknown", "double_counted_rows", "rat_km_annual_nb_nulls",
                                            "unknown_warning", "single_jurisdiction")]))
    return spark.createDataFrame(reports, "exhibit string, rows long, unknown long, double_counted_rows long, "
                                 "km_nulls long, unknown_warning boolean, single_jurisdiction boolean")


CHARTS = {"current": SG.EXAMPLE_CHART, "proposed": SG.PROPOSED_CHART}


def _raw_trx(spark, sf, more=(), rows=None):
    cols = (list(SCORED_TRX) + spec.TRX_UNIQUE_KEYS + spec.DISLOCATION_CLAIMS
            + ["veh_rg_col_no", "dri_gender_cd", "ter_onlvl_ibc_no", *more])
    return EX.extract_trx(B.book(spark, sf, rows=rows), list(dict.fromkeys(cols)), province=None, as_of=AS_OF)


def q_score_trx(spark, sf):
    d = SG.score_trx(_raw_trx(spark, sf), CHARTS)
    cols = [f"Prm_Ern_{c}_OnLvl{e}_Am" for c in spec.COV_ALL for e in ("", "_End")]
    return d.groupBy("chart", "pol_jurisdiction_cd").agg(F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(c) for c in cols])


def q_dislocation_two_charts(spark, sf):
    """Transactions scored on two charts in one pass, written by chart, then the vehicle exhibit."""
    # The merge tests read the extract again: the tables are joined once, and only the extract's rows are written.
    rows, buckets = B.vehicle_rows_buckets(spark, sf, lambda d, cols: EX.extract_trx(d, cols, province=None, as_of=AS_OF))
    trx, path = _raw_trx(spark, sf, rows=rows), _folder(spark, "scored_trx")
    sides = SG.write_scored(SG.score_trx(trx, CHARTS), trx, path, "both", list(CHARTS), spec.TRX_UNIQUE_KEYS,
                            buckets and ("veh_id_no", buckets))
    return D.trx_by_vehicle(*[sides[c] for c in CHARTS], bounds=WIDE_BOUNDS)


QUERIES: dict[str, Query] = {
    "dislocation_trx_vehicle": q_dislocation_trx_vehicle,
    "dislocation_trx_driver": q_dislocation_trx_driver,
    "dislocation_inf_vehicle": q_dislocation_inf_vehicle,
    "dislocation_trx_vehicle_wide": q_dislocation_trx_vehicle_wide,
    "dislocation_trx_driver_cuts": q_dislocation_trx_driver_cuts,
    "dislocation_inf_vehicle_cuts": q_dislocation_inf_vehicle_cuts,
    "trx_classification": q_trx_classification,
    "trx_classification_long": q_trx_classification_long,
    "inforce_classification": q_inforce_classification,
    "inforce_classification_long": q_inforce_classification_long,
    "elr": q_elr,
    "elr_long": q_elr_long,
    "extract_trx": q_extract_trx,
    "extract_inforce": q_extract_inforce,
    "extract_loss_cost": q_extract_loss_cost,
    "select_by_suffix": q_select_by_suffix,
    "rename_map": q_rename_map,
    "not_null_all": q_not_null_all,
    "exclude_null_safe": q_exclude_null_safe,
    "keep_principal": q_keep_principal,
    "filter_if_present": q_filter_if_present,
    "row_profile": q_row_profile,
    "fsa_normalize": q_fsa_normalize,
    "fsa_strict": q_fsa_strict,
    "company_map": q_company_map,
    "nz_defaults": q_nz_defaults,
    "band_km": q_band_km,
    "band_caps": q_band_caps,
    "band_price": q_band_price,
    "band_credit": q_band_credit,
    "interaction_keys": q_interaction_keys,
    "rate_change_bucket": q_rate_change_bucket,
    "ap_override": q_ap_override,
    "endorsement_split": q_endorsement_split,
    "earned_premium": q_earned_premium,
    "side_totals": q_side_totals,
    "household_counts": q_household_counts,
    "mandatory_only": q_mandatory_only,
    "weighted_mean": q_weighted_mean,
    "closing_ratio": q_closing_ratio,
    "retention_ratio": q_retention_ratio,
    "coverage_check": q_coverage_check,
    "unknown_share": q_unknown_share,
    "double_count_guard": q_double_count_guard,
    "reconcile": q_reconcile,
    "thin_cells": q_thin_cells,
    "null_operands": q_null_operands,
    "single_jurisdiction": q_single_jurisdiction,
    "side_balance": q_side_balance,
    "cur_prop_join": q_cur_prop_join,
    "band_back_join": q_band_back_join,
    "loss_cost_join": q_loss_cost_join,
    "versioned_lookup": q_versioned_lookup,
    "rerate": q_rerate,
    "score_inforce": q_score_inforce,
    "merge_test": q_merge_test,
    "vehicle_window_totals": q_vehicle_window_totals,
    "principal_dedup": q_principal_dedup,
    "first_per_group": q_first_per_group,
    "row_index": q_row_index,
    "union_variables": q_union_variables,
    "resolve_table": q_resolve_table,
    "optional_source": q_optional_source,
    "write_read_exhibit": q_write_read_exhibit,
    "config_projection": q_config_projection,
    "cur_prop_join_bucketed": q_cur_prop_join_bucketed,
    "elr_long_bitmaps": q_elr_long_bitmaps,
    "row_index_ordered": q_row_index_ordered,
    "reconcile_one_pass": q_reconcile_one_pass,
    "merge_test_rows": q_merge_test_rows,
    "exhibit_guards": q_exhibit_guards,
    "score_trx": q_score_trx,
    "dislocation_two_charts": q_dislocation_two_charts,
}
