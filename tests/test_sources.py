"""Catalog resolution, preconditions and sinks."""

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from ratecell.sources import book as B
from ratecell.sources import catalog, sinks


def test_require_tables_names_each_problem(spark):
    spark.range(0).createOrReplaceTempView("empty_view")
    spark.range(3).createOrReplaceTempView("full_view")
    catalog.require_tables(spark, {"a": "full_view"}, non_empty=True)
    with pytest.raises(ValueError) as e:
        catalog.require_tables(spark, {"a": "missing_view", "b": "empty_view"},
                               how_to_make={"a": "run the scoring for dataset=trx"}, non_empty=True)
    msg = str(e.value)
    assert "missing_view (missing)" in msg and "run the scoring" in msg and "empty_view (empty)" in msg


def test_latest_version(spark):
    for y in (2023, 2025, 2024):
        spark.range(1).createOrReplaceTempView(f"lookup_v_{y}")
    assert catalog.latest_version(spark, "lookup_v_") == ("lookup_v_2025", 2025)
    with pytest.raises(ValueError):
        catalog.latest_version(spark, "no_such_prefix_")


def test_save_table_bucketed_and_copy(spark):
    ex = B.book(spark, SF0001).groupBy("pol_policy_no", "pol_jurisdiction_cd").agg(
        F.sum("Prm_Trm_Dri_Tot_Uncap_Am").alias("tot"))
    sinks.save_table(ex, "exhibit_policy", bucket_by=(4, ["pol_policy_no"]), sort_by=["pol_policy_no"])
    sinks.save_table(ex, "exhibit_policy", bucket_by=(4, ["pol_policy_no"]))   # overwrite works
    sinks.copy_table(spark, "exhibit_policy", "exhibit_policy_copy")
    assert spark.table("exhibit_policy_copy").count() == ex.count()
    # two tables bucketed the same way join without an exchange
    sinks.save_table(ex, "exhibit_policy_b", bucket_by=(4, ["pol_policy_no"]))
    j = spark.table("exhibit_policy").join(spark.table("exhibit_policy_b"), "pol_policy_no")
    assert "Exchange hashpartitioning" not in j._jdf.queryExecution().executedPlan().toString()


def test_write_exhibits_dry_run(spark, tmp_path):
    ex = {"A": spark.range(3), "B": spark.range(2)}
    log = sinks.write_exhibits(ex, str(tmp_path), 1001, "dislocation", dry_run=True)
    assert [x["written"] for x in log] == [False, False]
    assert not any(tmp_path.iterdir())
    log = sinks.write_exhibits(ex, str(tmp_path), 1001, "dislocation")
    assert spark.read.parquet(log[0]["path"]).count() == 3


def test_checkpoint_cuts_lineage(spark):
    from ratecell.session import ensure_checkpoint_dir
    assert ensure_checkpoint_dir(spark)
    d = sinks.cut_lineage(B.book(spark, SF0001).select("veh_id_no"))
    assert "Scan parquet" not in d._jdf.queryExecution().optimizedPlan().toString()
    assert d.count() == 6000


def test_score_job_writes_bucketed_table(spark):
    from ratecell import spec
    from ratecell.plans import scoring
    from ratecell.sources.extract import extract_inforce
    for y in (2024, 2025):
        B.clear_table(spark, SF0001, y).createOrReplaceTempView(f"rate_group_{y}")
    inf = extract_inforce(B.book(spark, SF0001), province=None)
    out = scoring.score_job(inf, B.loss_cost_table(spark, SF0001), "inf_scored_cur",
                            bucket_by=(8, spec.INF_UNIQUE_KEYS))
    t = spark.table(out)
    assert t.count() == inf.count()
    assert t.filter(F.col("lc_losscost_total_pred_am").isNull()).count() == 0
