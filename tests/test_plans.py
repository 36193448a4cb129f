"""Plan shape: the scale properties the design relies on, read off the physical plan."""

from conftest import SF0001
from ratecell.plans import dislocation as D
from ratecell.plans import elr as E
from ratecell.sources import book as B


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _count(plan: str, node: str) -> int:
    return plan.count(node)


def test_elr_long_one_pass(spark):
    """One aggregate over an exploded input, not one aggregate per variable."""
    df = E.elr_long(B.book(spark, SF0001), province="*")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1
    assert plan.count("Relation") == 6          # lineitem, orders, customer, nation, region, part
    per_var = E.elr_long_per_variable(B.book(spark, SF0001), province="*")
    assert per_var._jdf.queryExecution().optimizedPlan().toString().count("Relation") > 6 * 10


def test_elr_long_equals_per_variable_union(spark):
    one = E.elr_long(B.book(spark, SF0001), province="*")
    many = E.elr_long_per_variable(B.book(spark, SF0001), province="*")
    cols = ["variable_name", "level_value", "pol_uwcompany_cd", "vehicles"] + E.PREMIUMS + E.LCS
    assert one.select(cols).exceptAll(many.select(cols)).count() == 0
    assert many.select(cols).exceptAll(one.select(cols)).count() == 0


def test_inforce_vehicle_has_no_window(spark):
    """Vehicle totals and the principal pick come from one aggregate, not a Window."""
    df = D.inf_by_vehicle(B.book(spark, SF0001), B.book(spark, SF0001, "proposed"))
    plan = _plan(df)
    assert "Window" not in plan


def test_window_form_has_one_window_node(spark):
    j = D.inf_joined(B.book(spark, SF0001), B.book(spark, SF0001, "proposed"))
    plan = _plan(D.inf_window_principal(j))
    # 18 totals share one spec -> one Window for them, one for the row_number dedup
    assert _count(plan, "Window [") <= 2


def test_principal_pick_equals_window_form(spark):
    j = D.inf_joined(B.book(spark, SF0001), B.book(spark, SF0001, "proposed"))
    agg = D.inf_principal_vehicles(j, ["dri_type_cd", "veh_age_nb"])
    win = D.inf_window_principal(j)
    cols = ["pol_uwcompany_cd", "veh_id_no", "Prm_Trm_Veh_Base_Uncap_Am",
            "Prm_Trm_Veh_Base_Uncap_Am_Prop", "dri_id_no", "veh_age_nb"]
    assert agg.select(cols).exceptAll(win.select(cols)).count() == 0
    assert win.select(cols).exceptAll(agg.select(cols)).count() == 0


def test_filters_reach_the_scan(spark):
    from ratecell.sources.extract import extract_trx
    df = extract_trx(B.book(spark, SF0001), ["veh_id_no"], province="AMERICA")
    plan = _plan(df)
    assert "PushedFilters" in plan or "DataFilters" in plan


def test_config_tables_in_the_plan(spark):
    """The chart adds one join per variable, the endorsement split none."""
    from ratecell import spec
    from ratecell.operators.joins import rerate, split_endorsements
    from ratecell.plans.scoring import EXAMPLE_CHART, RERATED
    b = B.book(spark, SF0001)
    before = _plan(b).count("Join")
    assert _plan(rerate(b, EXAMPLE_CHART, RERATED)).count("Join") == before + 3
    one = split_endorsements(b, [("e", "BI", 0.5)], {"e": list(spec.ENDORSEMENTS)[0]}, ["Prm_Trm_BI_Uncap_Am"])
    assert _plan(one).count("Join") == before


def test_hot_vehicle_is_pre_reduced_not_windowed(spark):
    """A vehicle holding a third of all rows: totals and principal pick stay exact,
    and the plan has no Window (the hot vehicle is never gathered into one task)."""
    from pyspark.sql import functions as F
    from ratecell import spec
    rows = []
    for i in range(300):
        veh = 1 if i % 3 == 0 else 100 + i
        rows.append(("SN", 1, 7, 7, veh, f"{i:04d}", "Principal" if i % 2 == 0 else "Occasional",
                     float(i), float(i)))
    j = spark.createDataFrame(rows, "pol_uwcompany_cd string, pol_insurer_no int, "
                                    "clt_account_no int, pol_policy_no int, veh_id_no int, "
                                    "dri_id_no string, dri_type_cd string, "
                                    "Prm_Trm_Dri_Base_Uncap_Am double, Prm_Trm_Dri_Base_Uncap_Am_Prop double")
    for c in ["BI", "PD", "DC", "AB", "UA", "AP_COL", "AP_SP_CMP", "UI"]:
        j = j.withColumn(f"Prm_Trm_{c}_Uncap_Am", F.lit(1.0)).withColumn(f"Prm_Trm_{c}_Uncap_Am_Prop",
                                                                          F.lit(1.0))
    v = D.inf_principal_vehicles(j, ["dri_type_cd"])
    assert "Window" not in _plan(v)
    hot = v.filter(F.col("veh_id_no") == 1).first()
    assert hot["Prm_Trm_Veh_Base_Uncap_Am"] == float(sum(i for i in range(0, 300, 3)))
    assert hot["Prm_Trm_Veh_BI_Uncap_Am"] == 100.0
    assert hot["dri_id_no"] == "0000"
    assert spec.INF_VEHICLE[0] == "pol_uwcompany_cd"


def test_group_totals_window_and_join_agree(spark):
    from pyspark.sql import functions as F
    from ratecell.operators.windows import with_group_totals
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 5.0)], "k string, v double")
    w = with_group_totals(df, ["k"], {"t": F.col("v")}, method="window")
    j = with_group_totals(df, ["k"], {"t": F.col("v")}, method="join")
    assert w.select("k", "v", "t").exceptAll(j.select("k", "v", "t")).count() == 0
    assert "Window" not in _plan(j)


def test_classification_long_splits_to_single_exhibits(spark):
    from ratecell.plans import classification as C
    b = B.book(spark, SF0001)
    long_df = C.trx_classification_long(b, ["fsa_tx", "dri_gender_cd"])
    one = C.split_long(long_df, ["fsa_tx"])["fsa_tx"]
    ref = C.trx_classification(b)
    cols = sorted(ref.columns)
    assert one.select(cols).exceptAll(ref.select(cols)).count() == 0
    assert ref.select(cols).exceptAll(one.select(cols)).count() == 0
    plan = long_df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and plan.count("Relation") == 6
