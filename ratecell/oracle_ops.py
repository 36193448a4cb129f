"""DuckDB SQL for the per-operator queries (sources, filters, scalars, bands,
checks, joins, windows). Same conventions as ``ratecell.oracle``."""

from __future__ import annotations

from ratecell import oracle as O
from ratecell.sources.book import (book_sql, clear_sql, closing_sql, loss_cost_sql,
                                   retention_sql)

BC = f"({book_sql('current')})"
BP = f"({book_sql('proposed')})"
COMPANY = O.COMPANY_SQL
FSA = O.FSA_SQL
COVS8 = ["BI", "PD", "DC", "AB", "UA", "AP_COL", "AP_SP_CMP", "UI"]
ELR_RENAME = {
    "Prm_Trm_BI_Uncap_Am": "Prm_OnLvl_BI_Uncap_Am", "Prm_Trm_PD_Uncap_Am": "Prm_OnLvl_PD_Uncap_Am",
    "Prm_Trm_DC_Uncap_Am": "Prm_OnLvl_DC_Uncap_Am", "Prm_Trm_AB_Uncap_Am": "Prm_OnLvl_AB_Uncap_Am",
    "Prm_Trm_UA_Uncap_Am": "Prm_OnLvl_UM_Uncap_Am",
    "Prm_Trm_AP_SP_CMP_Uncap_Am": "Prm_OnLvl_AP_SP_CMP_Uncap_Am",
    "Prm_Trm_AP_COL_Uncap_Am": "Prm_OnLvl_AP_COL_Uncap_Am",
    "Prm_Trm_SP_Uncap_Am": "Prm_OnLvl_SPE_Uncap_Am", "Prm_Trm_UI_Uncap_Am": "Prm_OnLvl_UI_Uncap_Am",
    "Prm_Trm_Dri_Tot_Uncap_Am": "Prm_OnLvl_Dri_Tot_Uncap_Am"}


def _count_by(src: str, keys: str, where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    return f"SELECT {keys}, COUNT(*) AS rows FROM {src}{w} GROUP BY {keys}"


# --- sources, projections, filters ------------------------------------------------------------
def extract_trx():
    return ("SELECT veh_id_no, dri_id_no, pol_jurisdiction_cd, veh_product_cd, pol_commercial_in, "
            f"trx_offset_onset_cd, Prm_Ern_BI_OnLvl_End_Am FROM {BC} WHERE pol_region_cd = 'AP' "
            "AND veh_product_cd IN ('ppa') AND pol_commercial_in = 0 "
            "AND trx_offset_onset_cd IS NOT NULL AND pol_jurisdiction_cd = 'AMERICA'")


INF_EVERY_DATE_WHERE = "pol_region_cd = 'AP' AND veh_product_cd IN ('ppa', 'motor_home') AND pol_commercial_in = 0"
INF_EXTRACT_WHERE = INF_EVERY_DATE_WHERE + " AND dat_as_of_dt = '2025-06-30'"
TRX_EXTRACT_WHERE = ("pol_region_cd = 'AP' AND veh_product_cd = 'ppa' AND pol_commercial_in = 0 "
                     "AND trx_offset_onset_cd IS NOT NULL AND dat_as_of_dt = '2025-06-30' AND dat_year_type_tx = 'AY'")


def extract_inforce():
    return _count_by(BC, "pol_jurisdiction_cd, veh_product_cd",
                     INF_EVERY_DATE_WHERE + " AND pol_jurisdiction_cd IN ('AMERICA', 'EUROPE')")


def extract_loss_cost():
    return ("SELECT pol_jurisdiction_cd, veh_product_cd, COUNT(*) AS rows, "
            "SUM(lc_losscost_bi_pred_rebase) AS lc_bi, SUM(lc_losscost_total_pred_rebase) AS lc_total "
            f"FROM ({loss_cost_sql()}) WHERE pol_region_cd = 'AP' "
            "AND veh_product_cd IN ('ppa', 'motor_home') GROUP BY pol_jurisdiction_cd, veh_product_cd")


def select_by_suffix():
    sums = ", ".join(f"SUM(Prm_Ern_{c}_OnLvl_Am) AS Prm_Ern_{c}_OnLvl_Am_Prop" for c in COVS8)
    return f"SELECT pol_jurisdiction_cd, COUNT(*) AS rows, {sums} FROM {BP} GROUP BY pol_jurisdiction_cd"


def rename_map():
    sums = ", ".join(f"SUM({a}) AS {b}" for a, b in ELR_RENAME.items())
    return f"SELECT pol_jurisdiction_cd, {sums} FROM {BC} GROUP BY pol_jurisdiction_cd"


def not_null_all():
    cond = " AND ".join(f"{c} IS NOT NULL" for c in O.TRX_PREM)
    return (f"SELECT pol_jurisdiction_cd, ({cond}) AS all_present, COUNT(*) AS rows FROM {BC} "
            "GROUP BY pol_jurisdiction_cd, all_present")


def exclude_null_safe():
    return _count_by(BC, "dri_type_cd", "dri_type_cd <> 'OccasionalPrincipal'")


def keep_principal():
    return _count_by(BC, "pol_jurisdiction_cd", "dri_type_cd = 'Principal'")


def filter_if_present():
    return _count_by(f"({closing_sql()})", "pol_jurisdiction_cd",
                     "veh_product_cd = 'ppa' AND pol_commercial_in = 0")


def row_profile():
    return _count_by(BC, "pol_jurisdiction_cd")


# --- scalars and bands ---------------------------------------------------------------------------
def fsa_normalize():
    return f"SELECT veh_fsa_tx, {FSA} AS fsa_tx, COUNT(*) AS rows FROM {BC} GROUP BY veh_fsa_tx, fsa_tx"


def fsa_strict():
    return (f"SELECT veh_fsa_tx, CASE WHEN n <> 'UNKNOWN' AND NOT regexp_matches(n, '^[A-Z][0-9][A-Z]$') "
            f"THEN 'INVALID' ELSE n END AS fsa_strict, COUNT(*) AS rows FROM "
            f"(SELECT veh_fsa_tx, {FSA} AS n FROM {BC}) GROUP BY veh_fsa_tx, fsa_strict")


def company_map():
    return (f"SELECT pol_uwcompany_cd, {COMPANY} AS company, CASE WHEN pol_uwcompany_cd IS NULL "
            f"THEN NULL ELSE {COMPANY} END AS company_keep_null, COUNT(*) AS rows FROM {BC} "
            "GROUP BY pol_uwcompany_cd, company, company_keep_null")


def nz_defaults():
    return ("SELECT COALESCE(CAST(cov_col_ded_am AS VARCHAR), 'N') AS ded, "
            "COALESCE(exp_minor_03yrs_nb, 0) AS minor, (COALESCE(rat_km_annual_nb, 0) = 0) AS km_missing, "
            "COUNT(*) AS rows, SUM(COALESCE(rat_fulldemand_closing_fc, 99)) AS closing_fc_sum, "
            "SUM(Prm_Trm_AP_SP_CMP_Uncap_Am) AS cmp_any_sum, SUM(0e0) AS none_any_sum "
            f"FROM {BC} GROUP BY ded, minor, km_missing")


def _minmax(cols):
    return ", ".join(f"{f.upper()}({c}) AS {f}_{c}" for c in cols for f in ("min", "max"))


def band_km():
    raw = ["rat_km_annual_nb", "rat_km_work_nb", "rat_km_business_nb"]
    return (f"SELECT {O._band_km_annual('rat_km_annual_nb')} AS annual_band, "
            f"{O._band_km_work('rat_km_work_nb')} AS work_band, "
            f"{O._band_km_business('rat_km_business_nb')} AS business_band, COUNT(*) AS rows, "
            f"{_minmax(raw)} FROM {BC} GROUP BY annual_band, work_band, business_band")


def band_caps():
    raw = ["number_veh_in_family", "number_au_mh", "veh_dri_onp_nb", "veh_age_nb"]
    return (f"SELECT {O._cap('number_veh_in_family', 8)} AS family_band, "
            f"{O._cap('number_au_mh', 8)} AS au_mh_band, {O._cap('veh_dri_onp_nb', 4)} AS onp_band, "
            f"{O._veh_age('veh_age_nb')} AS age_band, COUNT(*) AS rows, {_minmax(raw)} FROM {BC} "
            "GROUP BY family_band, au_mh_band, onp_band, age_band")


def band_price():
    return (f"SELECT {O._band_price('veh_vicc_price_am')} AS price_band, COUNT(*) AS rows, "
            f"MIN(veh_vicc_price_am) AS min_price, MAX(veh_vicc_price_am) AS max_price FROM {BC} "
            "GROUP BY price_band")


def band_credit():
    return (f"SELECT clt_p_holder_credit_score_no, {O._band_credit('clt_p_holder_credit_score_no')} "
            f"AS credit_band, COUNT(*) AS rows FROM {BC} GROUP BY clt_p_holder_credit_score_no, credit_band")


def interaction_keys():
    keys = ", ".join(O.INTERACTIONS_SQL)
    return (f"SELECT {keys}, COUNT(*) AS rows FROM "
            f"({O.prep_sql(f'SELECT * FROM {BC}', O._book_cols(), fsa=None)}) GROUP BY {keys}")


def rate_change_bucket():
    return (f"WITH {O._trx_joined_sql()}\n"
            "SELECT Rate_Change_Level, COUNT(*) AS vehicles, MIN(rc) AS min_rc, MAX(rc) AS max_rc, "
            "COUNT(*) FILTER (WHERE rc IS NULL) AS null_rc FROM vband GROUP BY Rate_Change_Level")


# --- earning ----------------------------------------------------------------------------------------
# FIXED example split (same config as the earning plan's EXAMPLE_SPLIT)
SPLIT = [("End_02", "BI", 0.5), ("End_02", "PD", 0.5), ("End_06A", "AB", 1.0),
         ("End_16", "AP_COL", 0.5), ("End_16", "AP_SP_CMP", 0.5),
         ("End_20", "AP_COL", 0.25), ("End_20", "AP_SP_CMP", 0.75), ("End_23B", "BI", 1.0),
         ("End_27", "AP_COL", 1.0), ("End_27S", "AP_SP_CMP", 1.0), ("End_38", "DC", 1.0),
         ("End_43", "AP_COL", 0.5), ("End_43", "AP_SP_CMP", 0.5),
         ("End_43R", "AP_COL", 0.5), ("End_43R", "AP_SP_CMP", 0.5),
         ("End_43S", "AP_SP_CMP", 1.0), ("End_60", "UA", 1.0), ("End_70", "PD", 1.0)]
END_COL = {"End_02": "02", "End_06A": "06", "End_16": "16", "End_20": "20", "End_23B": "23B",
           "End_27": "27", "End_27S": "27S", "End_38": "38", "End_43": "43", "End_43R": "43R",
           "End_43S": "43S", "End_60": "60S", "End_70": "70"}
COV_END = ["BI", "PD", "DC", "AB", "AP_COL", "AP_SP_CMP", "UA"]
XPO = {"BI": "xpo_ern_chap_bi_nb", "PD": "xpo_ern_chap_pd_nb", "DC": "xpo_ern_chap_dc_nb",
       "AB": "xpo_ern_chap_ab_nb", "UA": "xpo_ern_chap_um_nb", "UI": "xpo_ern_chap_ui_nb",
       "AP_COL": "x_ap_col", "AP_SP_CMP": "x_ap_sp_cmp"}


def _earn_ctes(source: str = BC) -> str:
    s1 = ("SELECT *, CASE WHEN cov_ap_in = 1 THEN 0 ELSE Prm_Trm_COL_Uncap_Am END AS o_col, "
          "CASE WHEN cov_ap_in = 1 THEN 0 ELSE Prm_Trm_CMP_Uncap_Am END AS o_cmp, "
          "CASE WHEN cov_ap_in = 1 THEN 0 ELSE xpo_ern_chap_col_nb END AS o_xcol, "
          "CASE WHEN cov_ap_in = 1 THEN 0 ELSE xpo_ern_chap_cmp_nb END AS o_xcmp "
          f"FROM {source}")
    s2 = ("SELECT *, Coll_Portion_of_AP + o_col AS b_AP_COL, "
          "Prm_Trm_SP_Uncap_Am + Comp_Portion_of_AP + o_cmp AS b_AP_SP_CMP, "
          "xpo_ern_chap_ap_nb + o_xcol AS x_ap_col, "
          "xpo_ern_chap_spe_nb + xpo_ern_chap_ap_nb + o_xcmp AS x_ap_sp_cmp FROM s1")
    ends = []
    for cov in COV_END:
        base = f"b_{cov}" if cov in ("AP_COL", "AP_SP_CMP") else f"Prm_Trm_{cov}_Uncap_Am"
        terms = [f"COALESCE(Prm_Trm_End_{END_COL[e]}_Uncap_Am, 0) * {repr(sh)}e0"
                 for e, c, sh in SPLIT if c == cov]
        ends.append(" + ".join([base] + terms) + f" AS e_{cov}")
    s3 = f"SELECT *, {', '.join(ends)} FROM s2"
    return f"s1 AS ({s1}),\n s2 AS ({s2}),\n s3 AS ({s3})"


def ap_override():
    return (f"WITH {_earn_ctes()}\n"
            "SELECT cov_ap_in, COUNT(*) AS rows, SUM(o_col) AS Prm_Trm_COL_Uncap_Am, "
            "SUM(o_cmp) AS Prm_Trm_CMP_Uncap_Am, SUM(o_xcol) AS Xpo_Ern_COL_Nb, "
            "SUM(o_xcmp) AS Xpo_Ern_CMP_Nb, SUM(b_AP_COL) AS Prm_Trm_AP_COL_Uncap_Am, "
            "SUM(b_AP_SP_CMP) AS Prm_Trm_AP_SP_CMP_Uncap_Am, SUM(x_ap_col) AS Xpo_Ern_AP_COL_Nb, "
            "SUM(x_ap_sp_cmp) AS Xpo_Ern_AP_SP_CMP_Nb FROM s3 GROUP BY cov_ap_in")


def endorsement_split():
    sums = ", ".join(f"SUM(e_{c}) AS Prm_Trm_{c}_Uncap_Am_End" for c in COV_END)
    return f"WITH {_earn_ctes()}\nSELECT pol_jurisdiction_cd, {sums} FROM s3 GROUP BY pol_jurisdiction_cd"


def earned_premium():
    def base(c):
        return f"b_{c}" if c in ("AP_COL", "AP_SP_CMP") else f"Prm_Trm_{c}_Uncap_Am"
    cov_all = COV_END + ["UI"]
    sums = ([f"SUM({base(c)} * {XPO[c]}) AS Prm_Ern_{c}_OnLvl_Am" for c in cov_all]
            + [f"SUM({('e_' + c) if c != 'UI' else base(c)} * {XPO[c]}) AS Prm_Ern_{c}_OnLvl_End_Am"
               for c in cov_all]
            + [f"SUM(e_{c} - {base(c)}) AS {c}_Portion_All" for c in COV_END])
    return (f"WITH {_earn_ctes()}\nSELECT pol_jurisdiction_cd, {', '.join(sums)} FROM s3 "
            "GROUP BY pol_jurisdiction_cd")


def side_totals():
    outs = O.EARN_OUT
    sums = ([f"SUM(e_{o}) AS Prm_Trm_{o}_Uncap_Am_Ern" for o in outs]
            + ["SUM(e_tot) AS Prm_Trm_TOT_Uncap_Am_Ern"]
            + [f"SUM(pe_{o}) AS Prm_Trm_{o}_Uncap_Am_Prop_Ern" for o in outs]
            + ["SUM(pe_tot) AS Prm_Trm_TOT_Uncap_Am_Prop_Ern", "SUM(clm_tot) AS Clm_Tot_Am"])
    return f"WITH {O._trx_joined_sql()}\nSELECT pol_uwcompany_cd, {', '.join(sums)} FROM j2 GROUP BY pol_uwcompany_cd"


def household_counts():
    return ("SELECT veh_product_cd, CASE WHEN veh_product_cd = 'motor_home' THEN clt_veh_mh_nb "
            "ELSE clt_veh_au_nb END AS number_au_mh, COALESCE(clt_veh_au_nb, 0) + "
            "COALESCE(clt_veh_mh_nb, 0) AS number_veh_in_family, COUNT(*) AS rows "
            f"FROM ({closing_sql()}) GROUP BY veh_product_cd, number_au_mh, number_veh_in_family")


def mandatory_only():
    return (f"WITH {O._inf_ctes()}\n"
            "SELECT pol_uwcompany_cd, CASE WHEN COALESCE(Prm_Trm_Veh_AP_COL_Uncap_Am, 0) + "
            "COALESCE(Prm_Trm_Veh_AP_SP_COMP_Uncap_Am, 0) = 0 THEN 1 ELSE 0 END AS Mandatory_Only, "
            "COUNT(*) AS vehicles FROM pr GROUP BY pol_uwcompany_cd, Mandatory_Only")


# --- aggregates and checks ----------------------------------------------------------------------------
def weighted_mean():
    fc, tot = "rat_fulldemand_closing_fc", "Prm_Trm_Dri_Tot_Uncap_Am"
    return (f"SELECT pol_uwcompany_cd, pred_closing, CASE WHEN den IS NULL OR den = 0 THEN NULL "
            f"ELSE num / den END AS pred_closing_prem_wtd FROM (SELECT {COMPANY} AS pol_uwcompany_cd, "
            f"AVG({fc}) AS pred_closing, SUM(COALESCE({fc}, 0) * COALESCE({tot}, 0)) AS num, "
            f"SUM(CASE WHEN {fc} IS NULL THEN 0 ELSE COALESCE({tot}, 0) END) AS den FROM {BC} "
            "GROUP BY 1)")


CLO_PREP = (f"SELECT * REPLACE ({COMPANY} AS pol_uwcompany_cd, {FSA} AS veh_fsa_tx) "
            f"FROM ({closing_sql()}) WHERE veh_product_cd = 'ppa' AND pol_commercial_in = 0")


def closing_ratio():
    return ("SELECT *, CASE WHEN quotes IS NULL OR quotes = 0 THEN NULL ELSE bound / quotes END "
            "AS closing_ratio FROM (SELECT pol_uwcompany_cd, veh_fsa_tx, COUNT(DISTINCT pol_quote_no) "
            "AS quotes, COUNT(DISTINCT CASE WHEN COALESCE(clo_bound_in, 0) = 1 THEN pol_quote_no END) "
            f"AS bound FROM ({CLO_PREP}) GROUP BY pol_uwcompany_cd, veh_fsa_tx)")


def retention_ratio():
    return ("SELECT *, CASE WHEN policies_exposed IS NULL OR policies_exposed = 0 THEN NULL "
            "ELSE policies_retained / policies_exposed END AS retention_actual FROM ("
            "SELECT 'TDHA' AS pol_uwcompany_cd, dri_gender_cd, COUNT(DISTINCT pol_policy_no) AS "
            "policies_exposed, COUNT(DISTINCT CASE WHEN COALESCE(retained_in, 0) = 1 THEN pol_policy_no "
            f"END) AS policies_retained FROM ({retention_sql()}) GROUP BY dri_gender_cd)")


TRX_PREP = (f"SELECT * REPLACE ({COMPANY} AS pol_uwcompany_cd), {FSA} AS fsa_tx FROM {BC} "
            "WHERE dri_type_cd <> 'OccasionalPrincipal' AND "
            + " AND ".join(f"{c} IS NOT NULL" for c in O.TRX_PREM))
INF_PREP = (f"SELECT * REPLACE ({COMPANY} AS pol_uwcompany_cd), {FSA} AS fsa_tx, "
            "COALESCE(cov_ap_in, 0) + COALESCE(cov_col_in, 0) AS cov_ap_col_in, "
            "COALESCE(cov_ap_in, 0) + COALESCE(cov_spe_in, 0) + COALESCE(cov_cmp_in, 0) AS cov_ap_sp_cmp_in "
            f"FROM {BC} WHERE dri_type_cd <> 'OccasionalPrincipal'")
COVERAGE = ("COUNT(*) AS rows, COUNT(DISTINCT fsa_tx) AS cells, "
            "CAST(SUM(CASE WHEN fsa_tx = 'UNKNOWN' THEN 1 ELSE 0 END) AS BIGINT) AS unknown")


def coverage_check():
    return f"SELECT {COVERAGE} FROM ({TRX_PREP})"


def unknown_share():
    return ("SELECT *, COALESCE(unknown_share > 0.01e0, false) AS unknown_warning FROM ("
            "SELECT *, CASE WHEN rows = 0 THEN NULL ELSE unknown / rows END AS unknown_share FROM "
            f"(SELECT {COVERAGE} FROM ({INF_PREP})))")


def double_count_guard():
    return ("SELECT COUNT(*) FILTER (WHERE cov_ap_col_in > 1 OR cov_ap_sp_cmp_in > 1) "
            f"AS double_counted_rows FROM ({INF_PREP})")


def reconcile():
    keys = "pol_jurisdiction_cd, pol_uwcompany_cd, pol_acc_yr_dt"
    ms = ["Prm_Ern_BI_OnLvl_End_Am", "Xpo_Ern_BI_Nb"]
    fine = (f"SELECT {keys}, fsa_tx, " + ", ".join(f"SUM({m}) AS {m}" for m in ms)
            + f" FROM ({TRX_PREP}) GROUP BY {keys}, fsa_tx")
    up = f"SELECT {keys}, " + ", ".join(f"SUM({m}) AS {m}_fine" for m in ms) + f" FROM ({fine}) GROUP BY {keys}"
    co = f"SELECT {keys}, " + ", ".join(f"SUM({m}) AS {m}_coarse" for m in ms) + f" FROM ({TRX_PREP}) GROUP BY {keys}"
    diffs = [f"COALESCE({m}_fine, 0) - COALESCE({m}_coarse, 0) AS {m}_diff" for m in ms]
    tied = " AND ".join(f"abs(COALESCE({m}_fine, 0) - COALESCE({m}_coarse, 0)) <= 1e-6" for m in ms)
    return (f"SELECT *, {', '.join(diffs)}, ({tied}) AS tied FROM ({up}) u "
            f"FULL OUTER JOIN ({co}) c USING ({keys})")


def thin_cells():
    ex = (f"SELECT pol_uwcompany_cd, fsa_tx, CAST(SUM(cov_bi_in) AS BIGINT) AS Xpo_BI FROM ({INF_PREP}) "
          "GROUP BY pol_uwcompany_cd, fsa_tx")
    return ("SELECT pol_uwcompany_cd, COUNT(*) AS cells, COUNT(*) FILTER (WHERE COALESCE(Xpo_BI, 0) < 100) "
            f"AS thin_cells FROM ({ex}) GROUP BY pol_uwcompany_cd")


def null_operands():
    cols = ["cov_col_in", "Prm_Trm_BI_Uncap_Am", "rat_km_annual_nb", "pol_uwcompany_cd"]
    return ("SELECT COUNT(*) AS rows, "
            + ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls" for c in cols) + f" FROM {BC}")


def single_jurisdiction():
    return ("SELECT COUNT(DISTINCT pol_jurisdiction_cd) AS jurisdictions, "
            "(COUNT(DISTINCT pol_jurisdiction_cd) = 1) AS single_jurisdiction FROM "
            f"{BC} WHERE {TRX_EXTRACT_WHERE} AND pol_jurisdiction_cd = 'AMERICA'")


def side_balance():
    return (f"WITH c AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE {INF_EXTRACT_WHERE}) AS i FROM {BC}), "
            f"p AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE {INF_EXTRACT_WHERE}) AS i FROM {BP})\n"
            "SELECT 'trx' AS dataset, c.n AS current_rows, p.n AS proposed_rows, c.n = p.n AS balanced "
            "FROM c, p UNION ALL SELECT 'inf', c.i, p.i, c.i = p.i FROM c, p")


# --- joins -------------------------------------------------------------------------------------------------
def cur_prop_join():
    return (f"WITH {O._inf_ctes()}\n"
            "SELECT pol_uwcompany_cd, COUNT(*) AS rows, "
            "COUNT(*) FILTER (WHERE Prm_Trm_Dri_Tot_Uncap_Am_Prop IS NOT NULL) AS matched, "
            "SUM(Prm_Trm_Dri_Tot_Uncap_Am) AS cur_tot, SUM(Prm_Trm_Dri_Tot_Uncap_Am_Prop) AS prop_tot "
            "FROM j GROUP BY pol_uwcompany_cd")


def band_back_join():
    on = " AND ".join(f"j2.{k} = b.{k}" for k in O.VEH)
    return (f"WITH {O._trx_joined_sql()}\n"
            "SELECT b.Rate_Change_Level, COUNT(*) AS rows, SUM(j2.e_tot) AS cur_tot "
            f"FROM j2 LEFT JOIN vband b ON {on} GROUP BY b.Rate_Change_Level")


LC_PAIRS = [("bi", "bi"), ("pd", "pd"), ("dc", "dc"), ("ab", "ab"), ("col", "coll"),
            ("cmp", "comp"), ("total", "total")]
LC_ON = ("b.vehicle_driver_version_key = l.vehicle_driver_version_key AND "
         "b.pol_jurisdiction_cd = l.pol_jurisdiction_cd AND b.veh_product_cd = l.veh_product_cd")


def loss_cost_join():
    return ("SELECT b.pol_jurisdiction_cd, b.veh_product_cd, COUNT(*) AS rows, "
            "COUNT(*) FILTER (WHERE l.lc_losscost_bi_pred_rebase IS NULL) AS unmatched, "
            "SUM(l.lc_losscost_bi_pred_rebase) AS lc_bi, SUM(l.lc_losscost_total_pred_rebase) AS lc_total "
            f"FROM {BC} b LEFT JOIN ({loss_cost_sql()}) l ON {LC_ON} "
            "GROUP BY b.pol_jurisdiction_cd, b.veh_product_cd")


def _clear_applied(src: str, alias: str = "b") -> str:
    return (f"SELECT {alias}.* REPLACE (COALESCE(k.veh_rg_col_no, {alias}.veh_rg_col_no) AS veh_rg_col_no, "
            f"COALESCE(k.veh_rg_cmp_no, {alias}.veh_rg_cmp_no) AS veh_rg_cmp_no) FROM {src} {alias} "
            f"LEFT JOIN ({clear_sql(2025)}) k ON {alias}.veh_vicc_cd = k.veh_vicc_cd")


def versioned_lookup():
    return (f"SELECT veh_rg_col_no, veh_rg_cmp_no, COUNT(*) AS rows, 2025 AS clear_year FROM "
            f"({_clear_applied(BC)}) GROUP BY veh_rg_col_no, veh_rg_cmp_no")


# FIXED example chart (same config as the scoring plan's EXAMPLE_CHART)
def _factor_sql() -> str:
    col = " ".join(f"WHEN '{g}' THEN {0.875 + (g % 5) / 16!r}e0" for g in range(1, 13))
    ter = " ".join(f"WHEN '{t}' THEN {0.875 + (t % 4) / 16!r}e0" for t in range(1, 7))
    return (f"(CASE CAST(veh_rg_col_no AS VARCHAR) {col} ELSE 1e0 END) * "
            "(CASE CAST(dri_gender_cd AS VARCHAR) WHEN 'M' THEN 1.0625e0 WHEN 'F' THEN 0.9375e0 ELSE 1e0 END) * "
            f"(CASE CAST(ter_onlvl_ibc_no AS VARCHAR) {ter} ELSE 1e0 END)")


RERATED = ["Prm_Trm_BI_Uncap_Am", "Prm_Trm_PD_Uncap_Am", "Prm_Trm_DC_Uncap_Am",
           "Prm_Trm_AB_Uncap_Am", "Prm_Trm_AP_COL_Uncap_Am", "Prm_Trm_AP_SP_CMP_Uncap_Am",
           "Prm_Trm_Dri_Tot_Uncap_Am"]


def rerate():
    sums = ", ".join(f"SUM({p} * f) AS {p}" for p in RERATED)
    return (f"SELECT pol_uwcompany_cd, {sums} FROM (SELECT {COMPANY} AS pol_uwcompany_cd, "
            f"{', '.join(RERATED)}, {_factor_sql()} AS f FROM {BC}) GROUP BY pol_uwcompany_cd")


def _scored_sql(where: str = INF_EXTRACT_WHERE) -> str:
    lc_out = ", ".join(f"l.lc_losscost_{s}_pred_rebase AS lc_losscost_{a}_pred_am" for a, s in LC_PAIRS)
    drop = ", ".join(f"lc_losscost_{a}_pred_am" for a, _ in LC_PAIRS)
    ext = f"(SELECT * EXCLUDE ({drop}) FROM {BC} WHERE {where})"
    with_lc = f"(SELECT b.*, {lc_out} FROM {ext} b LEFT JOIN ({loss_cost_sql()}) l ON {LC_ON})"
    return f"SELECT *, {_factor_sql()} AS f FROM ({_clear_applied(with_lc, 'x')})"


def score_inforce():
    sums = ", ".join(f"SUM({p} * f) AS {p}" for p in RERATED)
    return (f"SELECT pol_jurisdiction_cd, COUNT(*) AS rows, {sums}, "
            f"SUM(lc_losscost_total_pred_am) AS lc_total FROM ({_scored_sql(INF_EVERY_DATE_WHERE)}) GROUP BY pol_jurisdiction_cd")


def merge_test():
    return (f"SELECT a.n AS left_rows, b.n AS right_rows, a.n = b.n AS same FROM "
            f"(SELECT COUNT(*) AS n FROM {BC} WHERE {INF_EXTRACT_WHERE}) a, "
            f"(SELECT COUNT(*) AS n FROM ({_scored_sql()})) b")


# --- windows, dedup, unions -----------------------------------------------------------------------------
def principal_summary():
    return (f"WITH {O._inf_ctes()}\n"
            "SELECT pol_uwcompany_cd, COUNT(*) AS vehicles, SUM(Prm_Trm_Veh_Base_Uncap_Am) AS veh_base, "
            "SUM(Prm_Trm_Veh_Base_Uncap_Am_Prop) AS veh_base_prop, "
            "CAST(SUM(veh_age_nb) AS BIGINT) AS principal_age_sum FROM pr GROUP BY pol_uwcompany_cd")


def first_per_group():
    keys = ", ".join(O.INF_VEH)
    return (f"SELECT pol_uwcompany_cd, COUNT(*) AS vehicles, CAST(SUM(veh_age_nb) AS BIGINT) AS "
            f"principal_age_sum FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {keys} ORDER BY dri_id_no) "
            f"AS rn FROM (SELECT * REPLACE ({COMPANY} AS pol_uwcompany_cd) FROM {BC}) "
            "WHERE dri_type_cd = 'Principal') WHERE rn = 1 GROUP BY pol_uwcompany_cd")


def row_index():
    return f"SELECT COUNT(*) AS rows, COUNT(*) AS ids FROM {BC}"


def union_variables():
    return O.elr_long_sql(elr_block_only=True)


def optional_source():
    return ("SELECT *, CASE WHEN quotes IS NULL OR quotes = 0 THEN NULL ELSE bound / quotes END AS "
            "closing_ratio, CAST(NULL AS BIGINT) AS policies_exposed, CAST(NULL AS DOUBLE) AS "
            "retention_actual FROM (SELECT pol_uwcompany_cd, COUNT(DISTINCT pol_quote_no) AS quotes, "
            "COUNT(DISTINCT CASE WHEN COALESCE(clo_bound_in, 0) = 1 THEN pol_quote_no END) AS bound "
            f"FROM ({CLO_PREP}) GROUP BY pol_uwcompany_cd)")


def config_projection():
    return ("SELECT pol_jurisdiction_cd, veh_product_cd, COUNT(*) AS rows, "
            f"SUM(Prm_Ern_BI_OnLvl_End_Am) AS prm_bi FROM {BC} GROUP BY pol_jurisdiction_cd, veh_product_cd")


def trx_classification_long():
    variables = ["fsa_tx", "ter_onlvl_ibc_no", "veh_age_nb", "rat_km_annual_nb", "dri_gender_cd",
                 "veh_vicc_price_am"]
    meas = O.TRX_PREM + O.TRX_XPO + O.TRX_CLM_NB + O.TRX_CLM_AM
    keys = "pol_jurisdiction_cd, pol_uwcompany_cd, pol_acc_yr_dt"
    src = O.prep_sql(TRX_PREP, O._book_cols() + ["fsa_tx"], fsa=None)
    parts = [f"SELECT {keys}, '{v}' AS variable_name, CAST({v} AS VARCHAR) AS level_value, "
             + ", ".join(f"SUM({m}) AS {m}" for m in meas)
             + f" FROM p GROUP BY {keys}, CAST({v} AS VARCHAR)" for v in variables]
    return f"WITH p AS ({src})\n" + " UNION ALL ".join(parts)


def inforce_classification_long():
    variables = ["fsa_tx", "ter_onlvl_ibc_no", "veh_age_nb", "number_veh_in_family",
                 "clt_p_holder_credit_score_no", "dri_type_cd_x_rat_km_work_nb"]
    xpo = [("Xpo_BI", "cov_bi_in"), ("Xpo_DC", "cov_dc_in"), ("Xpo_PD", "cov_pd_in"),
           ("Xpo_AB", "cov_ab_in"), ("Xpo_AP_COL", "cov_ap_col_in"),
           ("Xpo_AP_SP_CMP", "cov_ap_sp_cmp_in")]
    prm = ["Prm_Trm_BI_Uncap_Am", "Prm_Trm_DC_Uncap_Am", "Prm_Trm_PD_Uncap_Am",
           "Prm_Trm_AB_Uncap_Am", "Prm_Trm_AP_COL_Uncap_Am", "Prm_Trm_AP_SP_CMP_Uncap_Am"]
    aggs = ", ".join([f"CAST(SUM({i}) AS BIGINT) AS {x}" for x, i in xpo] + [f"SUM({p}) AS {p}" for p in prm])
    src = O.prep_sql(INF_PREP, O._book_cols() + ["fsa_tx", "cov_ap_col_in", "cov_ap_sp_cmp_in"], fsa=None)
    parts = [f"SELECT pol_uwcompany_cd, '{v}' AS variable_name, CAST({v} AS VARCHAR) AS level_value, "
             f"{aggs} FROM p GROUP BY pol_uwcompany_cd, CAST({v} AS VARCHAR)" for v in variables]
    return f"WITH p AS ({src})\n" + " UNION ALL ".join(parts)


# --- one-pass checks and scoring on charts ----------------------------------------------------------------
def row_index_ordered():
    return f"SELECT veh_id_no, dri_id_no, ROW_NUMBER() OVER (ORDER BY veh_id_no, dri_id_no) AS index_id FROM {BC}"


def merge_test_rows():
    keys = "pol_policy_no, veh_id_no, dri_id_no, pol_eff_dt"
    swapped = f"SELECT CASE WHEN veh_id_no % 1000 = 7 THEN -1 ELSE pol_policy_no END AS pol_policy_no, veh_id_no, dri_id_no, pol_eff_dt FROM i"

    def one(name, src):
        gone = f"SELECT COUNT(*) FROM (SELECT {keys} FROM i EXCEPT ALL {src})"
        more = f"SELECT COUNT(*) FROM ({src} EXCEPT ALL SELECT {keys} FROM i)"
        return (f"SELECT '{name}' AS compared, (SELECT COUNT(*) FROM i) AS left_rows, (SELECT COUNT(*) FROM ({src})) AS right_rows, "
                f"(SELECT COUNT(*) FROM i) = (SELECT COUNT(*) FROM ({src})) AS same, ({gone}) = 0 AND ({more}) = 0 AS same_keys")

    return (f"WITH i AS (SELECT * FROM {BC} WHERE {INF_EXTRACT_WHERE}), s AS ({_scored_sql()})\n"
            + one("scored", f"SELECT {keys} FROM s") + " UNION ALL " + one("swapped", swapped))


def exhibit_guards():
    def one(name, double):
        return (f"SELECT '{name}' AS exhibit, COUNT(*) AS rows, COUNT(*) FILTER (WHERE fsa_tx = 'UNKNOWN') AS unknown, "
                f"COUNT(*) FILTER (WHERE {double}) AS double_counted_rows, "
                "COUNT(*) FILTER (WHERE rat_km_annual_nb IS NULL) AS km_nulls, "
                "COUNT(*) FILTER (WHERE fsa_tx = 'UNKNOWN') > 0.01e0 * COUNT(*) AS unknown_warning, "
                f"COUNT(DISTINCT pol_jurisdiction_cd) <= 1 AS single_jurisdiction FROM ({INF_PREP})")
    return one("inforce", "cov_ap_col_in > 1 OR cov_ap_sp_cmp_in > 1") + " UNION ALL " + one("elr", "FALSE")


# FIXED example charts (same config as the scoring plan's)
def _proposed_factor_sql() -> str:
    col = " ".join(f"WHEN '{g}' THEN {0.875 + (g % 3) / 8!r}e0" for g in range(1, 13))
    return (f"(CASE CAST(veh_rg_col_no AS VARCHAR) {col} ELSE 1e0 END) * "
            "(CASE CAST(dri_gender_cd AS VARCHAR) WHEN 'M' THEN 1e0 WHEN 'F' THEN 1.125e0 ELSE 1e0 END)")


TRX_RERATED = ["Prm_Trm_BI_Uncap_Am", "Prm_Trm_PD_Uncap_Am", "Prm_Trm_DC_Uncap_Am", "Prm_Trm_AB_Uncap_Am",
               "Prm_Trm_UA_Uncap_Am", "Prm_Trm_UI_Uncap_Am", "Prm_Trm_COL_Uncap_Am", "Prm_Trm_CMP_Uncap_Am",
               "Prm_Trm_SP_Uncap_Am", "Coll_Portion_of_AP", "Comp_Portion_of_AP"]


def _scored_trx(factor: str) -> str:
    rated = ", ".join(f"{p} * f AS {p}" for p in TRX_RERATED)
    return (f"(SELECT * REPLACE ({rated}) FROM (SELECT *, {factor} AS f FROM {BC} WHERE {TRX_EXTRACT_WHERE}))")


def _earned(c: str, end: bool) -> str:
    base = f"b_{c}" if c in ("AP_COL", "AP_SP_CMP") else f"Prm_Trm_{c}_Uncap_Am"
    return f"({'e_' + c if end and c != 'UI' else base}) * {XPO[c]}"


def score_trx():
    sums = ", ".join(f"SUM({_earned(c, e)}) AS Prm_Ern_{c}_OnLvl{'_End' if e else ''}_Am"
                     for c in COV_END + ["UI"] for e in (False, True))
    return " UNION ALL ".join(
        f"SELECT * FROM (WITH {_earn_ctes(_scored_trx(f))}\nSELECT '{n}' AS chart, pol_jurisdiction_cd, COUNT(*) AS rows, "
        f"{sums} FROM s3 GROUP BY pol_jurisdiction_cd)" for n, f in (("current", _factor_sql()), ("proposed", _proposed_factor_sql())))


def dislocation_two_charts():
    keys = [k for k in O.TRX_KEYS if k != "pol_uwcompany_cd"]
    tot = " + ".join(f"COALESCE({_earned(c, False)}, 0)" for c in COV_END + ["UI"])
    claims = " + ".join(f"COALESCE({c}, 0)" for c in O.CLAIMS)

    def side(f):
        return (f"SELECT * FROM (WITH {_earn_ctes(_scored_trx(f))}\nSELECT {', '.join(keys)}, {COMPANY} AS pol_uwcompany_cd, "
                f"{tot} AS t, {claims} AS clm FROM s3)")

    on = " AND ".join(f"c.{k} = p.{k}" for k in O.TRX_KEYS)
    return (f"WITH c AS ({side(_factor_sql())}), p AS ({side(_proposed_factor_sql())}),\n"
            f"v AS (SELECT {', '.join('c.' + k for k in O.VEH)}, SUM(c.t) AS vb, SUM(COALESCE(p.t, 0)) AS vbp, SUM(c.clm) AS vclm "
            f"FROM c LEFT JOIN p ON {on} GROUP BY {', '.join('c.' + k for k in O.VEH)}),\n"
            f"b AS (SELECT *, {O._rc_level('rc', *O.WIDE)} AS Rate_Change_Level FROM "
            "(SELECT *, CASE WHEN vb = 0 THEN NULL ELSE vbp / vb - 1 END AS rc FROM v))\n"
            "SELECT Rate_Change_Level, pol_acc_yr_dt, pol_uwcompany_cd, SUM(vb) AS Prm_Trm_Veh_Base_Uncap_Am_Sum, "
            "SUM(vbp) AS Prm_Trm_Veh_Base_Uncap_Am_Prop_Sum, SUM(vclm) AS clm_veh_chap_tot_am FROM b "
            "GROUP BY Rate_Change_Level, pol_acc_yr_dt, pol_uwcompany_cd")


def oracle_sql() -> dict[str, str]:
    out = {n: f() for n, f in [
        ("extract_trx", extract_trx), ("extract_inforce", extract_inforce),
        ("extract_loss_cost", extract_loss_cost), ("select_by_suffix", select_by_suffix),
        ("rename_map", rename_map), ("not_null_all", not_null_all),
        ("exclude_null_safe", exclude_null_safe), ("keep_principal", keep_principal),
        ("filter_if_present", filter_if_present), ("row_profile", row_profile),
        ("fsa_normalize", fsa_normalize), ("fsa_strict", fsa_strict), ("company_map", company_map),
        ("nz_defaults", nz_defaults), ("band_km", band_km), ("band_caps", band_caps),
        ("band_price", band_price), ("band_credit", band_credit),
        ("interaction_keys", interaction_keys), ("rate_change_bucket", rate_change_bucket),
        ("ap_override", ap_override), ("endorsement_split", endorsement_split),
        ("earned_premium", earned_premium), ("side_totals", side_totals),
        ("household_counts", household_counts), ("mandatory_only", mandatory_only),
        ("weighted_mean", weighted_mean), ("closing_ratio", closing_ratio),
        ("retention_ratio", retention_ratio), ("coverage_check", coverage_check),
        ("unknown_share", unknown_share), ("double_count_guard", double_count_guard),
        ("reconcile", reconcile), ("thin_cells", thin_cells), ("null_operands", null_operands),
        ("single_jurisdiction", single_jurisdiction), ("side_balance", side_balance),
        ("cur_prop_join", cur_prop_join), ("band_back_join", band_back_join),
        ("loss_cost_join", loss_cost_join), ("versioned_lookup", versioned_lookup),
        ("rerate", rerate), ("score_inforce", score_inforce), ("merge_test", merge_test),
        ("vehicle_window_totals", principal_summary), ("principal_dedup", principal_summary),
        ("first_per_group", first_per_group), ("row_index", row_index),
        ("union_variables", union_variables), ("resolve_table", row_profile),
        ("optional_source", optional_source), ("write_read_exhibit", O.trx_by_vehicle_sql),
        ("config_projection", config_projection), ("cur_prop_join_bucketed", cur_prop_join),
        ("elr_long_bitmaps", O.elr_long_sql), ("row_index_ordered", row_index_ordered),
        ("reconcile_one_pass", reconcile), ("merge_test_rows", merge_test_rows), ("exhibit_guards", exhibit_guards),
        ("score_trx", score_trx), ("dislocation_two_charts", dislocation_two_charts),
        ("trx_classification_long", trx_classification_long),
        ("inforce_classification_long", inforce_classification_long)]}
    return out
