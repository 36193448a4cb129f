"""The original notebooks' own fixtures and expected values, on real Spark.

Seven base rows (mixed case, blanks, a filtered driver type, a foreign
province) plus a null-premium TRX row and a zero-premium inforce row; then the
guard paths. Also the corners the pandas shim of the original could not see
(all-null premium cell, tab in an FSA, null join keys).
"""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratecell import spec
from ratecell.operators import checks
from ratecell.plans import classification as C
from ratecell.plans import elr as E
from ratecell.sources.catalog import optional_table, resolve_table

ROWS = [("B3H", "NS", "snic", "Principal"),
        ("b3h ", "NS", "snic", "Principal"),
        ("B3J", "NS", "prim", "Principal"),
        (None, "NS", "other", "Principal"),
        ("", "NS", "other", "Principal"),
        ("B4K", "NS", "other", "OccasionalPrincipal"),
        ("E1C", "NB", "snic", "Principal")]
KEYS = ["veh_fsa_tx", "pol_jurisdiction_cd", "pol_uwcompany_cd", "dri_type_cd"]


def _frame(spark, rows, doubles, ints=(), strings=()):
    fields = ([T.StructField(k, T.StringType()) for k in KEYS]
              + [T.StructField(c, T.StringType()) for c in strings]
              + [T.StructField(c, T.IntegerType()) for c in ints]
              + [T.StructField(c, T.DoubleType()) for c in doubles])
    return spark.createDataFrame(rows, T.StructType(fields))


def trx_frame(spark, with_earned=True):
    meas = spec.TRX_MEASURES if with_earned else []
    rows = []
    for i, r in enumerate(ROWS):
        vals = [100.0 + i] * 6 + [1.0] * 6 + [1.0] * 7 + [500.0] * 7 if with_earned else []
        rows.append(tuple(r) + ("2025",) + (3,) + tuple(vals))
    if with_earned:
        extra = list(rows[0])
        extra[0] = "B9Z"
        extra[KEYS.__len__() + 2] = None      # Prm_Ern_BI_OnLvl_End_Am
        rows.append(tuple(extra))
    return _frame(spark, rows, meas, ints=["ter_onlvl_ibc_no"], strings=["pol_acc_yr_dt"])


INF_PREM = spec.INF_PREMIUMS + ["Prm_Trm_UA_Uncap_Am", "Prm_Trm_SP_Uncap_Am", "Prm_Trm_UI_Uncap_Am",
                                "Prm_Trm_Dri_Tot_Uncap_Am"]
LC_SRC = [lc for _, _, lc in spec.ELR_COVERAGES]
IND = spec.INF_RAW_INDICATORS


def inf_frame(spark, ap_on_row0=False, drop=()):
    rows = []
    for i, r in enumerate(ROWS):
        ind = [1, 1, 1, 1, 1 if (ap_on_row0 and i == 0) else 0, 1, 0, 1]
        rows.append(tuple(r) + (3,) + tuple(ind) + tuple([200.0 + i] * len(INF_PREM))
                    + tuple([50.0 + i] * len(LC_SRC)))
    z = list(rows[2])
    z[0] = "B0Z"
    base = len(KEYS) + 1 + len(IND)
    for j in range(len(INF_PREM)):
        z[base + j] = 0.0
    rows.append(tuple(z))
    df = _frame(spark, rows, INF_PREM + LC_SRC, ints=["ter_onlvl_ibc_no"] + IND)
    return df.drop(*drop)


def _cell(df, fsa, col):
    return df.filter(F.col("fsa_tx") == fsa).select(col).first()[0]


def test_trx_classification_golden(spark):
    out = C.trx_classification(trx_frame(spark), province="ns")
    fsas = [r[0] for r in out.select("fsa_tx").collect()]
    assert set(out.select("pol_jurisdiction_cd").distinct().toPandas().iloc[:, 0]) == {"NS"}
    assert "B4K" not in fsas and "B9Z" not in fsas
    assert fsas.count("B3H") == 1 and fsas.count("UNKNOWN") == 1
    assert _cell(out, "B3H", "Prm_Ern_BI_OnLvl_End_Am") == 201.0
    assert out.agg(F.sum("Xpo_Ern_BI_Nb")).first()[0] == 5.0
    assert set(spec.TRX_MEASURES) <= set(out.columns)


def test_trx_guard_missing_fsa(spark):
    with pytest.raises(ValueError, match="veh_fsa_tx"):
        C.trx_classification(trx_frame(spark).drop("veh_fsa_tx"), province="NS")


def test_inforce_classification_golden(spark):
    out = C.inforce_classification(inf_frame(spark), province="NS")
    assert "B4K" not in [r[0] for r in out.select("fsa_tx").collect()]
    assert {r[0] for r in out.select("pol_uwcompany_cd").distinct().collect()} <= {"SN", "PIC", "TDHA"}
    assert out.agg(F.sum("Xpo_AP_COL")).first()[0] == 6
    assert _cell(out, "B3H", "Xpo_BI") == 2


def test_double_count_guard_fires(spark):
    d = C.inforce_prepared(inf_frame(spark, ap_on_row0=True), province="NS")
    with pytest.raises(AssertionError, match="double count"):
        checks.assert_no_double_count(d, list(spec.INF_COMPOSITES))
    checks.assert_no_double_count(C.inforce_prepared(inf_frame(spark), province="NS"),
                                  list(spec.INF_COMPOSITES))


def test_elr_golden(spark):
    out = E.elr_exhibit(inf_frame(spark), province="NS")
    assert all(p in out.columns for p in E.PREMIUMS)
    assert all(f"LR_{n}" in out.columns for n, _, _ in spec.ELR_COVERAGES)
    assert _cell(out, "B3H", "LR_BI") == pytest.approx(101 / 401)
    assert _cell(out, "B0Z", "LR_TOT") == 0.0


def test_elr_guard_missing_rename_column(spark):
    with pytest.raises(ValueError, match="Prm_Trm_Dri_Tot_Uncap_Am"):
        E.elr_exhibit(inf_frame(spark, drop=["Prm_Trm_Dri_Tot_Uncap_Am"]), province="NS")


def test_all_null_premium_cell_gives_zero_lr(spark):
    df = inf_frame(spark).withColumn(
        "Prm_Trm_BI_Uncap_Am", F.when(F.col("veh_fsa_tx") == "B3J", None)
        .otherwise(F.col("Prm_Trm_BI_Uncap_Am")))
    out = E.elr_exhibit(df, province="NS")
    assert _cell(out, "B3J", "Prm_OnLvl_BI_Uncap_Am") is None
    assert _cell(out, "B3J", "LC_BI") == 0.0
    assert _cell(out, "B3J", "LR_BI") == 0.0


def closing_frame(spark):
    rows = []
    for q in range(4):
        for _ in range(2):
            rows.append((f"Q-B3H-{q}", 1 if q == 0 else 0, "B3H", "Principal", "NS", "snic", "ppa", 0))
    for q in range(2):
        rows.append((f"Q-B3J-{q}", 1, "B3J", "Principal", "NS", "prim", "ppa", 0))
    rows.append(("Q-NB-0", 1, "E1C", "Principal", "NB", "snic", "ppa", 0))
    schema = ("pol_quote_no string, clo_bound_in int, veh_fsa_tx string, dri_type_cd string, "
              "pol_jurisdiction_cd string, pol_uwcompany_cd string, veh_product_cd string, "
              "pol_commercial_in int")
    return spark.createDataFrame(rows, schema)


def test_elr_long_closing_golden(spark):
    demand = inf_frame(spark).withColumns({"rat_fulldemand_closing_fc": F.lit(0.5),
                                           "rat_fulldemand_ft_retention_fc": F.lit(0.9),
                                           "rat_fulldemand_mt_retention_fc": F.lit(0.95)})
    caveats = []
    out = E.elr_long(demand, closing=closing_frame(spark), province="NS", caveats=caveats)
    b3h = out.filter((F.col("variable_name") == "veh_fsa_tx") & (F.col("level_value") == "B3H")).first()
    assert b3h["quotes"] == 4 and b3h["bound"] == 1 and b3h["closing_ratio"] == 0.25
    assert b3h["pred_closing"] == 0.5 and b3h["pred_closing_prem_wtd"] == 0.5
    b3j = out.filter((F.col("variable_name") == "veh_fsa_tx") & (F.col("level_value") == "B3J")).first()
    assert b3j["closing_ratio"] == 1.0
    assert out.columns[:4] == ["variable_name", "level_value", "pol_uwcompany_cd", "vehicles"]
    assert any("PREDICTED" in c for c in caveats)


def test_elr_long_unreadable_closing_still_builds(spark):
    caveats = []
    clo = optional_table(spark, "no_such_closing_view", ["pol_quote_no"], caveats)
    assert clo is None and caveats
    out = E.elr_long(inf_frame(spark), closing=clo, province="NS")
    assert out.count() > 0
    assert out.filter(F.col("quotes").isNotNull()).count() == 0


def test_resolve_table_lists_every_rejection(spark):
    trx_frame(spark, with_earned=False).createOrReplaceTempView("trx_ns_pre_earning")
    with pytest.raises(ValueError) as e:
        resolve_table(spark, ["trx_absent", "trx_ns_pre_earning"], spec.TRX_MEASURES)
    msg = str(e.value)
    assert "trx_absent -> missing table" in msg and "trx_ns_pre_earning -> missing" in msg
    trx_frame(spark).createOrReplaceTempView("trx_ap_earned")
    name, _ = resolve_table(spark, ["trx_absent", "trx_ns_pre_earning", "trx_ap_earned"],
                            spec.TRX_MEASURES)
    assert name == "trx_ap_earned"


def test_tab_survives_trim(spark):
    from ratecell.functions.scalars import fsa_normalize
    df = spark.createDataFrame([("\tb3h",), (" b3h ",)], "f string")
    vals = [r[0] for r in df.select(fsa_normalize("f")).collect()]
    assert vals == ["\tB3H", "B3H"]


def test_null_join_keys_do_not_match(spark):
    from ratecell.operators.joins import join_sides
    a = spark.createDataFrame([(None, 1.0), ("k", 2.0)], "k string, v double")
    b = spark.createDataFrame([(None, 10.0), ("k", 20.0)], "k string, w double")
    out = {r["v"]: r["w"] for r in join_sides(a, b, ["k"]).collect()}
    assert out == {1.0: None, 2.0: 20.0}


def test_dislocation_summary_matches_single_exhibits(spark):
    from conftest import SF0001
    from ratecell.plans import dislocation as D
    from ratecell.sources import book as B
    cur, prop = B.book(spark, SF0001), B.book(spark, SF0001, "proposed")
    with pytest.raises(ValueError, match="row counts differ"):
        D.dislocation_summary(cur, prop, cur, prop)
    out = D.dislocation_summary(cur, prop, cur, prop, check_balance=False)
    assert out["TRX_by_Vehicle"].exceptAll(D.trx_by_vehicle(cur, prop)).count() == 0
    assert out["TRX_by_Driver"].count() == D.trx_by_driver(cur, prop).count()
    assert out["Inf_by_Vehicle"].exceptAll(D.inf_by_vehicle(cur, prop)).count() == 0


def test_side_join_raises_on_a_repeated_key(spark):
    from ratecell.operators.joins import join_sides
    a = spark.createDataFrame([("k", 1.0)] * 50 + [("m", 3.0)], "k string, v double")
    b = spark.createDataFrame([("k", 2.0)] * 2, "k string, w double")
    with pytest.raises(ValueError, match="proposed side"):
        join_sides(a, b, ["k"])
    assert join_sides(a, b, ["k"], check_unique=False).count() == 101      # a plain left join
    one = join_sides(a, b.limit(1), ["k"])
    assert one.count() == 51 and one.filter("w IS NULL").count() == 1


def test_retention_levels_match_only_when_prepped(spark):
    from conftest import SF0001
    from ratecell.sources import book as B
    inf, ret = B.book(spark, SF0001), B.retention(spark, SF0001)

    def ten_plus(df):
        return df.filter((F.col("variable_name") == "veh_age_nb") & (F.col("level_value") == "10+")
                         & (F.col("pol_uwcompany_cd") == "TDHA")).first()

    raw = ten_plus(E.elr_long(inf, retention=ret, province="*"))
    assert raw["policies_exposed"] is None           # raw ages 11..14 never equal the band '10+'
    prepped = ten_plus(E.elr_long(inf, retention=ret, province="*", prep_retention=True))
    assert prepped["policies_exposed"] > 0
    assert 0.0 <= prepped["retention_actual"] <= 1.0


def test_blended_provinces_need_a_choice(spark):
    both = inf_frame(spark).withColumn("pol_jurisdiction_cd", F.lit("NB")).unionByName(inf_frame(spark))
    for exhibit in (C.inforce_classification, E.elr_exhibit, E.elr_long):
        with pytest.raises(ValueError, match="province"):
            exhibit(both)

    def exposure(province):
        return C.inforce_classification(both, province=province).agg(F.sum("Xpo_BI")).first()[0]

    assert exposure(["NS", "NB"]) == exposure("NS") + exposure("NB") > exposure("NS") > 0
    assert exposure(spec.ALL_PROVINCES) >= exposure(["NS", "NB"])


def test_missing_demand_scores_and_closing_are_caveats(spark):
    caveats = []
    E.elr_long(inf_frame(spark), closing=closing_frame(spark), province="NS", caveats=caveats)
    assert any("demand scores" in c for c in caveats)
    assert any("closing ratio" in c for c in caveats)
