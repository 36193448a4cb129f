"""DuckDB SQL for every registered query: the independent side of the correctness check.

Each string runs on the driver's pre-registered views. Side joins are plain left joins. The book CTEs come from
``sources.book`` (same input text in both engines); everything after them is
written here in plain SQL following the original notebooks step by step (one
aggregate per variable, window + row_number dedup, ...), not from the Spark code.
"""

from __future__ import annotations

from ratecell.sources.book import book_sql, closing_sql, retention_sql

# FIXED values: rate-change edges and labels as the original builds them for
# lower=-0.05, upper=0.15, step=0.05 (note the float drift of the last two edges).
RC_EDGES = ["-0.05e0", "0.0e0", "0.05e0", "0.10000000000000002e0", "0.15000000000000002e0"]
RC_LABELS = ["[-Inf,-0.05)", "[-0.05,0)", "[0,0.05)", "[0.05,0.1)", "[0.1,0.15)", "[0.15,Inf)"]
# The same for lower=-0.2, upper=0.3, step=0.1.
WIDE = (["-0.2e0", "-0.1e0", "0.0e0", "0.10000000000000003e0", "0.2e0", "0.3e0"],
        ["[-Inf,-0.2)", "[-0.2,-0.1)", "[-0.1,0)", "[0,0.1)", "[0.1,0.2)", "[0.2,0.3)", "[0.3,Inf)"])

COMPANY_SQL = ("CASE WHEN pol_uwcompany_cd = 'snic' THEN 'SN' "
               "WHEN pol_uwcompany_cd = 'prim' THEN 'PIC' ELSE 'TDHA' END")


def _rc_level(x: str, edges=RC_EDGES, labels=RC_LABELS) -> str:
    parts = [f"WHEN {x} IS NULL THEN '{labels[0]}'"]
    parts += [f"WHEN {x} < {e} THEN '{lab}'" for e, lab in zip(edges, labels)]
    return "CASE " + " ".join(parts) + f" ELSE '{labels[-1]}' END"


def _nzsum(cols, alias_prefix="") -> str:
    return " + ".join(f"COALESCE({alias_prefix}{c}, 0)" for c in cols)


def _mapped(side: str) -> str:
    return f"SELECT * REPLACE ({COMPANY_SQL} AS pol_uwcompany_cd) FROM ({book_sql(side)})"


# --- classification prep in SQL -------------------------------------------------------
# FIXED values: lower edges of the price bands.
PRICE_EDGES = [10000, 15000, 20000, 25000, 30000, 35000, 40000, 45000, 50000, 55000, 60000, 65000, 70000, 75000, 80000,
               85000, 90000, 95000, 100000, 125000, 150000, 200000]


def _band_price(x: str) -> str:
    s = f"CASE WHEN {x} IS NULL OR {x} <= 0 THEN 'Not Available' "
    for lo, hi in zip([0, *PRICE_EDGES], PRICE_EDGES):
        s += f"WHEN {x} < {hi} THEN '{lo}-{hi - 1}' "
    return s + "ELSE '200000+' END"


def _band_credit(x: str) -> str:
    v = f"TRY_CAST(CAST({x} AS VARCHAR) AS DOUBLE)"
    edges = [1, 500, 600, 650, 700, 750, 800, 850]
    s = f"CASE WHEN {v} IS NULL OR {v} < 1 THEN 'NA' "
    for lo, hi in zip(edges, edges[1:]):
        s += f"WHEN {v} < {hi} THEN '{lo}-{hi - 1}' "
    return s + "ELSE '850+' END"


def _band_km_annual(x):
    return (f"CASE WHEN {x} <= 5000 THEN '0-5000' WHEN {x} <= 10000 THEN '5001-10000' "
            f"WHEN {x} <= 15000 THEN '10001-15000' WHEN {x} <= 20000 THEN '15001-20000' "
            f"WHEN {x} > 20000 THEN '20001+' END")


def _band_km_work(x):
    return (f"CASE WHEN {x} = 0 THEN '0' WHEN {x} > 0 AND {x} <= 5 THEN '1-5' "
            f"WHEN {x} > 5 AND {x} <= 15 THEN '6-15' WHEN {x} > 15 AND {x} <= 30 THEN '16-30' "
            f"WHEN {x} > 30 THEN '31+' END")


def _band_km_business(x):
    return f"CASE WHEN {x} = 0 THEN '0' WHEN {x} > 0 THEN '1+' END"


def _cap(x, n):
    return f"CASE WHEN {x} > {n} THEN '>{n}' ELSE CAST({x} AS VARCHAR) END"


def _veh_age(x):
    return f"CASE WHEN {x} > 10 THEN '10+' ELSE CAST({x} AS VARCHAR) END"


PREP_SQL = {
    "rat_km_annual_nb": _band_km_annual,
    "rat_km_work_nb": _band_km_work,
    "rat_km_business_nb": _band_km_business,
    "number_veh_in_family": lambda x: _cap(x, 8),
    "number_au_mh": lambda x: _cap(x, 8),
    "veh_dri_onp_nb": lambda x: _cap(x, 4),
    "veh_age_nb": _veh_age,
    "veh_vicc_price_am": _band_price,
    "clt_p_holder_credit_score_no": _band_credit,
    "cov_col_ded_am": lambda x: f"COALESCE(CAST({x} AS VARCHAR), 'N')",
    "cov_cmp_ded_am": lambda x: f"COALESCE(CAST({x} AS VARCHAR), 'N')",
    "exp_col_af_10yrs_avg_nb": lambda x: f"COALESCE({x}, 99)",
    "exp_minor_03yrs_avg_nb": lambda x: f"COALESCE({x}, 99)",
    "exp_col_af_10yrs_nb": lambda x: f"COALESCE({x}, 0)",
    "exp_minor_03yrs_nb": lambda x: f"COALESCE({x}, 0)",
    "exp_major_03yrs_nb": lambda x: f"COALESCE({x}, 0)",
}
INTERACTIONS_SQL = {
    "dri_type_cd_x_number_au_mh_x_veh_dri_onp_nb": ["dri_type_cd", "number_au_mh", "veh_dri_onp_nb"],
    "dri_type_cd_x_rat_km_work_nb": ["dri_type_cd", "rat_km_work_nb"],
    "dri_type_cd_x_rat_km_business_nb": ["dri_type_cd", "rat_km_business_nb"],
    "dri_type_cd_x_rat_km_annual_nb": ["dri_type_cd", "rat_km_annual_nb"],
    "dri_yrs_licensed_au_nb_x_dri_gender_cd": ["dri_yrs_licensed_au_nb", "dri_gender_cd"],
}


def prep_sql(src: str, columns: list[str], fsa: str | None = "veh_fsa_tx") -> str:
    """SELECT with the prep applied in place (+ interactions, + fsa_tx) over ``src``.
    ``columns`` are the source's columns (for presence checks)."""
    repl = {c: f(c) for c, f in PREP_SQL.items() if c in columns}
    extra = []
    for name, parts in INTERACTIONS_SQL.items():
        if all(p in columns for p in parts):
            parts_sql = ", ".join(f"CAST({repl.get(p, p)} AS VARCHAR)" for p in parts)
            extra.append(f"concat_ws('_', {parts_sql}) AS {name}")
    if fsa:
        extra.append(f"CASE WHEN upper(trim({fsa})) IS NULL OR upper(trim({fsa})) = '' "
                     f"THEN 'UNKNOWN' ELSE upper(trim({fsa})) END AS fsa_tx")
    rep = ", ".join(f"{v} AS {k}" for k, v in repl.items())
    star = f"* REPLACE ({rep})" if rep else "*"
    return f"SELECT {star}{', ' if extra else ''}{', '.join(extra)} FROM ({src})"


# --- dislocation ------------------------------------------------------------------------
TRX_KEYS = ["pol_insurer_no", "clt_account_no", "pol_policy_no", "veh_id_no", "dri_id_no",
            "pol_eff_dt", "trx_eff_dt", "trx_ent_dt", "pol_acc_yr_dt", "trx_offset_onset_cd",
            "pol_jurisdiction_cd", "vehicle_driver_version_key", "pol_uwcompany_cd"]
VEH = ["pol_acc_yr_dt", "pol_uwcompany_cd", "pol_insurer_no", "clt_account_no",
       "pol_policy_no", "veh_id_no"]
EARN_SRC = ["BI", "PD", "DC", "AB", "UA", "AP_COL", "AP_SP_CMP", "UI"]
EARN_OUT = ["BI", "PD", "DC", "AB", "UA", "AP_COL", "AP_SP_COMP", "UI"]
CLAIMS = ["clm_chap_bi_cap500k_am", "clm_chap_pd_am", "clm_chap_dc_am",
          "clm_chap_ab_cap500k_am", "clm_chap_um_am", "clm_chap_col_am",
          "clm_chap_cmp_am", "clm_chap_ui_am"]


def _trx_joined_sql(bands=(RC_EDGES, RC_LABELS)) -> str:
    on = " AND ".join(f"c.{k} = p.{k}" for k in TRX_KEYS)
    cur_e = ", ".join(f"COALESCE(c.Prm_Ern_{s}_OnLvl_Am, 0) AS e_{o}" for s, o in zip(EARN_SRC, EARN_OUT))
    prp_e = ", ".join(f"COALESCE(p.Prm_Ern_{s}_OnLvl_Am, 0) AS pe_{o}" for s, o in zip(EARN_SRC, EARN_OUT))
    return (f"cur AS ({_mapped('current')}),\n"
            f" prop AS ({_mapped('proposed')}),\n"
            f" j AS (SELECT c.*, {cur_e}, {prp_e}, {_nzsum(CLAIMS, 'c.')} AS clm_tot "
            f"FROM cur c LEFT JOIN prop p ON {on}),\n"
            f" j2 AS (SELECT *, {' + '.join('e_' + o for o in EARN_OUT)} AS e_tot, "
            f"{' + '.join('pe_' + o for o in EARN_OUT)} AS pe_tot FROM j),\n"
            f" veh AS (SELECT {', '.join(VEH)}, SUM(e_tot) AS vb, SUM(pe_tot) AS vbp, "
            f"SUM(clm_tot) AS vclm FROM j2 GROUP BY {', '.join(VEH)}),\n"
            f" vband AS (SELECT *, {_rc_level('rc', *bands)} AS Rate_Change_Level FROM "
            f"(SELECT *, CASE WHEN vb = 0 THEN NULL ELSE vbp / vb - 1 END AS rc FROM veh))")


def trx_by_vehicle_sql(bands=(RC_EDGES, RC_LABELS)) -> str:
    return (f"WITH {_trx_joined_sql(bands)}\n"
            "SELECT Rate_Change_Level, pol_acc_yr_dt, pol_uwcompany_cd, "
            "SUM(vb) AS Prm_Trm_Veh_Base_Uncap_Am_Sum, SUM(vbp) AS Prm_Trm_Veh_Base_Uncap_Am_Prop_Sum, "
            "SUM(vclm) AS clm_veh_chap_tot_am FROM vband "
            "GROUP BY Rate_Change_Level, pol_acc_yr_dt, pol_uwcompany_cd")


C_VARS = ["dri_type_cd_x_rat_km_work_nb", "dri_type_cd_x_rat_km_business_nb",
          "dri_type_cd_x_rat_km_annual_nb", "dri_yrs_licensed_au_nb_x_dri_gender_cd",
          "clt_p_holder_credit_score_no", "veh_vicc_price_am", "veh_rg_ab_no", "veh_rg_dc_no",
          "veh_rg_col_no", "veh_rg_cmp_no", "fsa_tx"]


def _book_cols() -> list[str]:
    from ratecell.sources.book import book_columns
    return [n for n, _ in book_columns("current")]


def trx_by_driver_sql(bands=(RC_EDGES, RC_LABELS), c_vars=C_VARS, where="TRUE") -> str:
    cols = _book_cols() + [f"e_{o}" for o in EARN_OUT] + [f"pe_{o}" for o in EARN_OUT] + \
        ["clm_tot", "e_tot", "pe_tot", "Rate_Change_Level"]
    src = ("SELECT j2.*, b.Rate_Change_Level FROM j2 LEFT JOIN vband b ON "
           + " AND ".join(f"j2.{k} = b.{k}" for k in VEH))
    dri_alias = ["BI", "PD", "DC", "AB", "UA", "COL", "CMP", "UI"]
    src += f" WHERE {where}"
    keys = ["Rate_Change_Level", "pol_acc_yr_dt", "pol_uwcompany_cd", *c_vars, "pol_business_cd"]
    aggs = ([f"SUM(e_{o}) AS Prm_Trm_{a}_Uncap_Am_Sum" for o, a in zip(EARN_OUT, dri_alias)]
            + ["SUM(e_tot) AS Prm_Trm_Base_Uncap_Am_Sum"]
            + [f"SUM(pe_{o}) AS Prm_Trm_{a}_Uncap_Am_Prop_Sum" for o, a in zip(EARN_OUT, dri_alias)]
            + ["SUM(pe_tot) AS Prm_Trm_Dri_Base_Uncap_Am_Prop_Sum"]
            + [f"SUM(COALESCE({c}, 0)) AS {c}" for c in CLAIMS]
            + [f"SUM({_nzsum(CLAIMS)}) AS clm_chap_tot_am"])
    return (f"WITH {_trx_joined_sql(bands)},\n d AS ({prep_sql(src, cols)})\n"
            f"SELECT {', '.join(keys)}, {', '.join(aggs)} FROM d GROUP BY {', '.join(keys)}")


INF_KEYS = ["pol_policy_no", "veh_id_no", "dri_id_no", "pol_eff_dt", "pol_uwcompany_cd"]
INF_VEH = ["pol_uwcompany_cd", "pol_insurer_no", "clt_account_no", "pol_policy_no", "veh_id_no"]
INF_COVS = ["BI", "PD", "DC", "AB", "UA", "AP_COL"]


def _inf_ctes() -> str:
    """cur, prop, j (side join), w (vehicle window totals), pr (one principal row per vehicle)."""
    on = " AND ".join(f"c.{k} = p.{k}" for k in INF_KEYS)
    prm = [n for n in _book_cols() if n.startswith("Prm_Trm_") and n.endswith("Uncap_Am")]
    prop_cols = ", ".join(f"p.{n} AS {n}_Prop" for n in prm)
    win = f"OVER (PARTITION BY {', '.join(INF_VEH)})"
    tot = []
    for sfx in ["", "_Prop"]:
        for cov in INF_COVS:
            tot.append(f"SUM(COALESCE(Prm_Trm_{cov}_Uncap_Am{sfx}, 0)) {win} AS Prm_Trm_Veh_{cov}_Uncap_Am{sfx}")
        tot.append(f"SUM(COALESCE(Prm_Trm_AP_SP_CMP_Uncap_Am{sfx}, 0)) {win} AS Prm_Trm_Veh_AP_SP_COMP_Uncap_Am{sfx}")
        tot.append(f"SUM(COALESCE(Prm_Trm_UI_Uncap_Am{sfx}, 0)) {win} AS Prm_Trm_Veh_UI_Uncap_Am{sfx}")
        tot.append(f"SUM(COALESCE(Prm_Trm_Dri_Base_Uncap_Am{sfx}, 0)) {win} AS Prm_Trm_Veh_Base_Uncap_Am{sfx}")
    return (f"cur AS ({_mapped('current')}),\n"
            f" prop AS ({_mapped('proposed')}),\n"
            f" j AS (SELECT c.*, {prop_cols} FROM cur c LEFT JOIN prop p ON {on}),\n"
            f" w AS (SELECT *, {', '.join(tot)} FROM j),\n"
            f" pr AS (SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
            f"{', '.join(INF_VEH)} ORDER BY dri_id_no) AS rn FROM w WHERE dri_type_cd = 'Principal') "
            f"WHERE rn = 1)")


def _inf_cols() -> list[str]:
    prm = [n for n in _book_cols() if n.startswith("Prm_Trm_") and n.endswith("Uncap_Am")]
    veh = [f"Prm_Trm_Veh_{c}_Uncap_Am{sfx}" for sfx in ["", "_Prop"]
           for c in INF_COVS + ["AP_SP_COMP", "UI", "Base"]]
    return _book_cols() + [f"{n}_Prop" for n in prm] + veh


def inf_by_vehicle_sql(bands=(RC_EDGES, RC_LABELS), c_vars=C_VARS) -> str:
    cols = _inf_cols() + ["rc", "Rate_Change_Level"]
    sums = ["BI", "PD", "DC", "AB", "UA", "AP_COL", "AP_SP_COMP", "UI", "Base"]
    keys = ["Rate_Change_Level", "pol_uwcompany_cd", "pol_business_cd", *c_vars]
    aggs = (["COUNT(*) AS Xpo_Tot",
             "CAST(SUM(CASE WHEN COALESCE(Prm_Trm_Veh_AP_COL_Uncap_Am, 0) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS Xpo_Col",
             "CAST(SUM(CASE WHEN COALESCE(Prm_Trm_Veh_AP_SP_COMP_Uncap_Am, 0) > 0 THEN 1 ELSE 0 END) AS BIGINT) AS Xpo_Cmp"]
            + [f"SUM(COALESCE(Prm_Trm_Veh_{c}_Uncap_Am, 0)) AS Prm_Trm_Veh_{c}_Uncap_Am_Sum" for c in sums]
            + [f"SUM(COALESCE(Prm_Trm_Veh_{c}_Uncap_Am_Prop, 0)) AS Prm_Trm_Veh_{c}_Uncap_Am_Prop_Sum"
               for c in sums])
    return (f"WITH {_inf_ctes()},\n"
            f" b AS (SELECT *, {_rc_level('rc', *bands)} AS Rate_Change_Level FROM "
            f"(SELECT *, CASE WHEN Prm_Trm_Veh_Base_Uncap_Am = 0 THEN NULL "
            f"ELSE Prm_Trm_Veh_Base_Uncap_Am_Prop / Prm_Trm_Veh_Base_Uncap_Am - 1 END AS rc FROM pr)),\n"
            f" d AS ({prep_sql('SELECT * FROM b', cols)})\n"
            f"SELECT {', '.join(keys)}, {', '.join(aggs)} FROM d GROUP BY {', '.join(keys)}")


# --- classification and ELR --------------------------------------------------------------
FSA_SQL = ("CASE WHEN upper(trim(veh_fsa_tx)) IS NULL OR upper(trim(veh_fsa_tx)) = '' "
           "THEN 'UNKNOWN' ELSE upper(trim(veh_fsa_tx)) END")
TRX_PREM = [f"Prm_Ern_{c}_OnLvl_End_Am" for c in ["BI", "PD", "DC", "AB", "AP_COL", "AP_SP_CMP"]]
TRX_XPO = [f"Xpo_Ern_{c}_Nb" for c in ["BI", "PD", "DC", "AB", "AP_COL", "AP_SP_CMP"]]
TRX_CLM_NB = [f"clm_chap_{c}_nb" for c in ["tpl", "bi", "dc", "pd", "ab", "col", "cmp"]]
TRX_CLM_AM = ["clm_chap_tpl_cap500k_am", "clm_chap_bi_cap500k_am", "clm_chap_pd_cap500k_am",
              "clm_chap_dc_am", "clm_chap_ab_cap500k_am", "clm_chap_col_am", "clm_chap_cmp_am"]


def trx_classification_sql() -> str:
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in TRX_PREM)
    meas = TRX_PREM + TRX_XPO + TRX_CLM_NB + TRX_CLM_AM
    keys = "pol_jurisdiction_cd, pol_uwcompany_cd, pol_acc_yr_dt, fsa_tx"
    return (f"WITH b AS ({book_sql('current')}),\n"
            f" f AS (SELECT * REPLACE ({COMPANY_SQL} AS pol_uwcompany_cd), {FSA_SQL} AS fsa_tx FROM b "
            f"WHERE dri_type_cd <> 'OccasionalPrincipal' AND {notnull})\n"
            f"SELECT {keys}, {', '.join(f'SUM({m}) AS {m}' for m in meas)} FROM f GROUP BY {keys}")


def inforce_classification_sql() -> str:
    xpo = [("Xpo_BI", "cov_bi_in"), ("Xpo_DC", "cov_dc_in"), ("Xpo_PD", "cov_pd_in"),
           ("Xpo_AB", "cov_ab_in"), ("Xpo_AP_COL", "cov_ap_col_in"),
           ("Xpo_AP_SP_CMP", "cov_ap_sp_cmp_in")]
    prm = ["Prm_Trm_BI_Uncap_Am", "Prm_Trm_DC_Uncap_Am", "Prm_Trm_PD_Uncap_Am",
           "Prm_Trm_AB_Uncap_Am", "Prm_Trm_AP_COL_Uncap_Am", "Prm_Trm_AP_SP_CMP_Uncap_Am"]
    aggs = [f"CAST(SUM({i}) AS BIGINT) AS {x}" for x, i in xpo] + [f"SUM({p}) AS {p}" for p in prm]
    return (f"WITH b AS ({book_sql('current')}),\n"
            f" f AS (SELECT * REPLACE ({COMPANY_SQL} AS pol_uwcompany_cd), {FSA_SQL} AS fsa_tx, "
            f"COALESCE(cov_ap_in, 0) + COALESCE(cov_col_in, 0) AS cov_ap_col_in, "
            f"COALESCE(cov_ap_in, 0) + COALESCE(cov_spe_in, 0) + COALESCE(cov_cmp_in, 0) AS cov_ap_sp_cmp_in "
            f"FROM b WHERE dri_type_cd <> 'OccasionalPrincipal')\n"
            f"SELECT pol_uwcompany_cd, fsa_tx, {', '.join(aggs)} FROM f GROUP BY pol_uwcompany_cd, fsa_tx")


ELR_COV = [("BI", "BI", "bi"), ("PD", "PD", "pd"), ("DC", "DC", "dc"), ("AB", "AB", "ab"),
           ("COL", "AP_COL", "col"), ("CMP", "AP_SP_CMP", "cmp"), ("TOT", "Dri_Tot", "total")]


def _elr_cols() -> str:
    out = []
    for name, cov, lc in ELR_COV:
        out.append(f"Prm_Trm_{cov}_Uncap_Am AS Prm_OnLvl_{cov}_Uncap_Am")
        out.append(f"CASE WHEN Prm_Trm_{cov}_Uncap_Am IS NULL THEN 0e0 "
                   f"ELSE lc_losscost_{lc}_pred_am END AS LC_{name}")
    return ", ".join(out)


def _lr(name, cov) -> str:
    p = f"Prm_OnLvl_{cov}_Uncap_Am"
    return f"CASE WHEN {p} IS NULL OR {p} = 0 THEN 0e0 ELSE LC_{name} / {p} END AS LR_{name}"


def elr_exhibit_sql() -> str:
    sums = [f"SUM(Prm_OnLvl_{c}_Uncap_Am) AS Prm_OnLvl_{c}_Uncap_Am" for _, c, _ in ELR_COV] + \
        [f"SUM(LC_{n}) AS LC_{n}" for n, _, _ in ELR_COV]
    return (f"WITH b AS ({book_sql('current')}),\n"
            f" f AS (SELECT {COMPANY_SQL} AS pol_uwcompany_cd, {FSA_SQL} AS fsa_tx, {_elr_cols()} "
            f"FROM b WHERE dri_type_cd <> 'OccasionalPrincipal'),\n"
            f" g AS (SELECT pol_uwcompany_cd, fsa_tx, {', '.join(sums)} FROM f "
            f"GROUP BY pol_uwcompany_cd, fsa_tx)\n"
            f"SELECT *, {', '.join(_lr(n, c) for n, c, _ in ELR_COV)} FROM g")


LONG_VARS = ["dri_type_cd", "dri_gender_cd", "dri_yrs_licensed_au_nb", "rat_km_annual_nb",
             "rat_km_work_nb", "rat_km_business_nb", "number_veh_in_family", "number_au_mh",
             "veh_dri_onp_nb", "veh_age_nb", "veh_vicc_price_am", "veh_rg_ab_no", "veh_rg_dc_no",
             "veh_rg_col_no", "veh_rg_cmp_no", "cov_col_ded_am", "clt_p_holder_credit_score_no",
             "exp_minor_03yrs_nb", "cov_cmp_ded_am", "cov_tpl_limit_am", "exp_col_af_10yrs_nb",
             "exp_col_af_10yrs_avg_nb", "exp_minor_03yrs_avg_nb", "exp_major_03yrs_nb", "exp_criminal_03yrs_nb",
             "exp_susp_minus_03yrs_nb", "exp_susp_plus_03yrs_nb", "exp_canc_nopay_03yrs_nb",
             "ter_onlvl_ibc_no", "veh_fsa_tx",
             "dri_type_cd_x_number_au_mh_x_veh_dri_onp_nb", "dri_type_cd_x_rat_km_work_nb",
             "dri_type_cd_x_rat_km_business_nb", "dri_type_cd_x_rat_km_annual_nb",
             "dri_yrs_licensed_au_nb_x_dri_gender_cd"]
RET_VARS = ["dri_gender_cd", "veh_age_nb", "ter_onlvl_ibc_no"]
CLO_VARS = [v for v in LONG_VARS if not v.startswith("cov_")]   # the closing view has no coverages
FCS = [("closing", "rat_fulldemand_closing_fc"), ("ft_retention", "rat_fulldemand_ft_retention_fc"),
       ("mt_retention", "rat_fulldemand_mt_retention_fc")]


def elr_long_sql(elr_block_only: bool = False) -> str:
    from ratecell.sources.book import closing_columns
    inf_src = (f"SELECT * REPLACE ({COMPANY_SQL} AS pol_uwcompany_cd, {FSA_SQL} AS veh_fsa_tx), "
               f"{_elr_cols()} FROM b WHERE dri_type_cd <> 'OccasionalPrincipal'")
    clo_cols = [n for n, _ in closing_columns()] + ["number_au_mh", "number_veh_in_family"]
    clo_src = (f"SELECT * REPLACE ({COMPANY_SQL} AS pol_uwcompany_cd, {FSA_SQL} AS veh_fsa_tx), "
               "CASE WHEN veh_product_cd = 'motor_home' THEN clt_veh_mh_nb ELSE clt_veh_au_nb END "
               "AS number_au_mh, COALESCE(clt_veh_au_nb, 0) + COALESCE(clt_veh_mh_nb, 0) "
               "AS number_veh_in_family FROM c0 WHERE veh_product_cd = 'ppa' AND pol_commercial_in = 0")
    sums = [f"SUM(Prm_OnLvl_{c}_Uncap_Am) AS Prm_OnLvl_{c}_Uncap_Am" for _, c, _ in ELR_COV] + \
        [f"SUM(LC_{n}) AS LC_{n}" for n, _, _ in ELR_COV] + ["COUNT(*) AS vehicles"]
    tot = "Prm_Trm_Dri_Tot_Uncap_Am"
    for s, fc in FCS:
        sums += [f"AVG({fc}) AS pred_{s}",
                 f"SUM(COALESCE({fc}, 0) * COALESCE({tot}, 0)) AS n_{s}",
                 f"SUM(CASE WHEN {fc} IS NULL THEN 0 ELSE COALESCE({tot}, 0) END) AS d_{s}"]
    if elr_block_only:
        sums = sums[:15]
    main = " UNION ALL ".join(
        f"SELECT pol_uwcompany_cd, '{v}' AS variable_name, CAST({v} AS VARCHAR) AS level_value, "
        f"{', '.join(sums)} FROM inf GROUP BY pol_uwcompany_cd, CAST({v} AS VARCHAR)" for v in LONG_VARS)
    clo = " UNION ALL ".join(
        f"SELECT pol_uwcompany_cd, '{v}' AS variable_name, CAST({v} AS VARCHAR) AS level_value, "
        "COUNT(DISTINCT pol_quote_no) AS quotes, COUNT(DISTINCT CASE WHEN COALESCE(clo_bound_in, 0) = 1 "
        f"THEN pol_quote_no END) AS bound FROM clo GROUP BY pol_uwcompany_cd, CAST({v} AS VARCHAR)"
        for v in CLO_VARS)
    ret = " UNION ALL ".join(
        f"SELECT pol_uwcompany_cd, '{v}' AS variable_name, CAST({v} AS VARCHAR) AS level_value, "
        "COUNT(DISTINCT pol_policy_no) AS policies_exposed, COUNT(DISTINCT CASE WHEN "
        "COALESCE(retained_in, 0) = 1 THEN pol_policy_no END) AS policies_retained FROM ret "
        f"GROUP BY pol_uwcompany_cd, CAST({v} AS VARCHAR)" for v in RET_VARS)
    wtd = ", ".join(f"CASE WHEN d_{s} IS NULL OR d_{s} = 0 THEN NULL ELSE n_{s} / d_{s} END "
                    f"AS pred_{s}_prem_wtd" for s, _ in FCS)
    out_cols = (["variable_name", "level_value", "pol_uwcompany_cd", "vehicles"]
                + [f"Prm_OnLvl_{c}_Uncap_Am" for _, c, _ in ELR_COV] + [f"LC_{n}" for n, _, _ in ELR_COV]
                + [_lr(n, c) for n, c, _ in ELR_COV]
                + [x for s, _ in FCS for x in (f"pred_{s}", f"pred_{s}_prem_wtd")]
                + ["quotes", "bound",
                   "CASE WHEN quotes IS NULL OR quotes = 0 THEN NULL ELSE bound / quotes END AS closing_ratio",
                   "policies_exposed", "policies_retained",
                   "CASE WHEN policies_exposed IS NULL OR policies_exposed = 0 THEN NULL "
                   "ELSE policies_retained / policies_exposed END AS retention_actual"])
    if elr_block_only:
        lrs = ", ".join(_lr(n, c) for n, c, _ in ELR_COV)
        return (f"WITH b AS ({book_sql('current')}),\n"
                f" inf AS ({prep_sql(inf_src, _book_cols(), fsa=None)})\n"
                f"SELECT *, {lrs} FROM ({main})")
    cell = "m.pol_uwcompany_cd = {a}.pol_uwcompany_cd AND m.variable_name = {a}.variable_name " \
           "AND m.level_value = {a}.level_value"
    return (f"WITH b AS ({book_sql('current')}),\n"
            f" inf AS ({prep_sql(inf_src, _book_cols(), fsa=None)}),\n"
            f" c0 AS ({closing_sql()}),\n"
            f" clo AS ({prep_sql(clo_src, clo_cols, fsa=None)}),\n"
            f" ret AS (SELECT *, 'TDHA' AS pol_uwcompany_cd FROM ({retention_sql()})),\n"
            f" m0 AS ({main}),\n m AS (SELECT *, {wtd} FROM m0),\n cq AS ({clo}),\n rq AS ({ret}),\n"
            f" j AS (SELECT m.*, cq.quotes, cq.bound, rq.policies_exposed, rq.policies_retained FROM m "
            f"LEFT JOIN cq ON {cell.format(a='cq')} LEFT JOIN rq ON {cell.format(a='rq')})\n"
            f"SELECT {', '.join(out_cols)} FROM j")


def oracle_sql() -> dict[str, str]:
    """SQL per registered query name (queries without SQL get a rows-only check)."""
    return {
        "dislocation_trx_vehicle": trx_by_vehicle_sql(),
        "dislocation_trx_driver": trx_by_driver_sql(),
        "dislocation_inf_vehicle": inf_by_vehicle_sql(),
        "dislocation_trx_vehicle_wide": trx_by_vehicle_sql(WIDE),
        "dislocation_trx_driver_cuts": trx_by_driver_sql(
            WIDE, ["dri_gender_cd"], "j2.dri_type_cd <> 'OccasionalPrincipal'"),
        "dislocation_inf_vehicle_cuts": inf_by_vehicle_sql(WIDE, ["dri_gender_cd"]),
        "trx_classification": trx_classification_sql(),
        "inforce_classification": inforce_classification_sql(),
        "elr": elr_exhibit_sql(),
        "elr_long": elr_long_sql(),
    } | __import__("ratecell.oracle_ops", fromlist=["oracle_sql"]).oracle_sql()
