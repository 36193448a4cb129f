"""Saved sides, guards that ride on a job, bitmaps, dense row numbers, hot groups and chart partitions."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF0001
from ratecell import spec
from ratecell.operators import aggregates, checks, joins, windows
from ratecell.plans import classification as C
from ratecell.plans import dislocation as D
from ratecell.plans import scoring
from ratecell.sources import book as B
from ratecell.sources import catalog, extract, sinks


def _final_plan(df):
    """The physical plan after adaptive execution, of the part that ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("+- == Initial Plan ==")[0]


def test_saved_sides_join_without_exchange(spark, tmp_path):
    cur, prop = B.book(spark, SF0001), B.book(spark, SF0001, "proposed")
    names = [f"side_{x}_{uuid.uuid4().hex}" for x in "cp"]
    keys = spec.TRX_UNIQUE_KEYS + ["pol_uwcompany_cd"]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sides = D.saved_sides(cur, prop, keys, 4, names)
        joined = D.trx_joined(*sides, map_codes=False)
        plan = _final_plan(joined)
        assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Aggregate") == 2
        again = D.trx_joined(cur, prop)
        cols = ["veh_id_no", "dri_id_no", "pol_uwcompany_cd", "Prm_Trm_TOT_Uncap_Am_Ern", "Prm_Trm_TOT_Uncap_Am_Prop_Ern"]
        assert joined.select(cols).exceptAll(again.select(cols)).isEmpty() and joined.count() == again.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def test_repeated_key_raises_in_the_run(spark):
    a = spark.createDataFrame([("k", 1.0), (None, 2.0)], "k string, v double")
    b = spark.createDataFrame([("k", 2.0), (None, 1.0), (None, 3.0)], "k string, w double")
    got = joins.join_sides(a, b, ["k"], check_unique="in_flight")
    assert sorted(map(str, got.collect())) == sorted(map(str, joins.join_sides(a, b.where("k IS NOT NULL"), ["k"]).collect()))
    lazy = joins.join_sides(a, b.union(b), ["k"], check_unique="in_flight")        # nothing has run yet
    with pytest.raises(Exception, match="proposed side: a key repeats"):
        lazy.collect()


def test_dense_row_index(spark):
    df = spark.range(10_000).select((F.pmod(F.xxhash64("id"), F.lit(500))).alias("k"), "id").repartition(7)
    got = windows.row_index(df, "n", ["k", "id"]).collect()
    assert [r.n for r in sorted(got, key=lambda r: (r.k, r.id))] == list(range(1, 10_001))
    plan = windows.row_index(df, "n", ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(_n" in plan                                  # the only window is over one row per partition
    assert windows.row_index(df.limit(0), "n", ["k"]).count() == 0


def test_bitmaps_equal_count_distinct(spark):
    df = spark.range(200_000).select((F.col("id") % 70_001).alias("q"), (F.col("id") % 13).alias("cell"),
                                     F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 2).alias("f"))
    df = df.withColumn("q", F.when(F.col("q") % 101 != 0, F.col("q")))               # some keys are null
    got = aggregates.distinct_flagged_bitmaps(df, ["cell"], "q", "f", "n", "m")
    want = df.groupBy("cell").agg(*[c.alias(n) for c, n in zip(aggregates.distinct_and_flagged("q", "f"), "nm")])
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert got.schema["n"].dataType == want.schema["n"].dataType


def test_hot_group_totals_are_split(spark):
    """A third of 60,000 rows in one group: the totals are those of a window, and no task gets the group."""
    df = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 9973).alias("k"),
                                    F.lit("x").alias("j"), F.col("id").cast("double").alias("v"), "id").repartition(8)
    totals = {"t": F.col("v"), "c": F.lit(1)}
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = windows.with_group_totals_split(sinks.materialize(df, "hot"), ["k", "j"], totals)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 60_000 and max(sizes) < 2 * 60_000 / 8
    want = windows.with_group_totals(df, ["k", "j"], totals, method="window")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert windows.with_group_totals_split(df.limit(0), ["k"], totals).count() == 0


def _indicators(spark, twice):
    cols = spec.INF_PREMIUMS + spec.INF_RAW_INDICATORS
    rows = [("Principal", "snic", p, f, *[1.0] * len(spec.INF_PREMIUMS), 1, 1, 1, 1, ap, 1 if twice or not ap else 0, 0, 0)
            for p, f, ap in (("NS", "b3h", 1), ("NS", None, 0), ("NS", "B3J", None))]
    schema = "dri_type_cd string, pol_uwcompany_cd string, pol_jurisdiction_cd string, veh_fsa_tx string, "
    return spark.createDataFrame(rows, schema + ", ".join(f"{c} {'double' if c.startswith('Prm') else 'int'}" for c in cols))


def test_guards_ride_on_the_write(spark, tmp_path):
    composites = list(spec.INF_COMPOSITES)
    good = checks.Guard("inforce", composites=composites, single=True)
    log = sinks.write_exhibits({"ok": C.inforce_classification(_indicators(spark, False), province="NS", guard=good)},
                               str(tmp_path), 1, "x", guards={"ok": good})
    seen = log[0]["guard"]
    assert (seen["rows"], seen["unknown"], seen["double_counted_rows"]) == (3, 1, 0)
    assert seen["unknown_warning"] and seen["single_jurisdiction"]
    bad = checks.Guard("inforce", composites=composites)
    with pytest.raises(AssertionError, match="double count"):
        sinks.write_exhibits({"twice": C.inforce_classification(_indicators(spark, True), province="NS", guard=bad)},
                             str(tmp_path), 1, "x", guards={"twice": bad})
    assert os.path.exists(log[0]["path"]) and not os.path.exists(sinks.exhibit_path(str(tmp_path), 1, "x", "twice"))
    blend = checks.Guard("inforce", single=True)
    two = _indicators(spark, False).unionByName(_indicators(spark, False).withColumn("pol_jurisdiction_cd", F.lit("NB")))
    C.inforce_classification(two, province=spec.ALL_PROVINCES, guard=blend).collect()
    with pytest.raises(AssertionError, match="NB to NS"):
        blend.check()


def test_the_books_double_counted_rows_fire(spark):
    d = C.inforce_prepared(B.book(spark, SF0001), province=spec.ALL_PROVINCES)
    assert checks.double_count_rows(d, list(spec.INF_COMPOSITES)).first()[0] > 0


def test_merge_test_finds_a_swapped_row(spark):
    a = spark.createDataFrame([(1, "x", None), (2, "y", 1), (2, "y", 1), (3, None, 2)], "k int, s string, t int")
    same = checks.same_row_set(a, a.orderBy(F.desc("k")), ["k", "s", "t"]).first()
    assert same["same"] and same["same_keys"]
    for rows in ([(1, "x", None), (2, "y", 1), (3, None, 2), (3, None, 2)], [(1, None, None), (2, "y", 1), (2, "y", 1), (3, "x", 2)],
                 [(1, "x", None), (2, "y", 1), (2, "y", 1), (3, None, None)]):
        got = checks.same_row_set(a, spark.createDataFrame(rows, a.schema), ["k", "s", "t"]).first()
        assert got["same"] and not got["same_keys"]
    empty = checks.same_row_set(a.limit(0), a.limit(0), ["k"]).first()
    assert empty["same_keys"] and empty["left_rows"] == 0


def test_one_pass_reconciliation(spark):
    rows = spark.createDataFrame([("a", None, 1.0), ("a", "x", 2.0), ("b", "x", None), ("b", None, 5.0)], "k string, l string, m double")
    got = {r["k"]: r for r in checks.reconcile_one_pass(rows, ["k"], "l", ["m"]).collect()}
    assert (got["a"]["m_fine"], got["a"]["m_coarse"], got["b"]["m_coarse"]) == (3.0, 3.0, 5.0) and got["b"]["tied"]
    trx = C.trx_prepared(B.book(spark, SF0001))
    one = checks.reconcile_one_pass(trx, spec.TRX_GROUP, "fsa_tx", ["Xpo_Ern_BI_Nb"])
    assert one._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 6        # the six tables, once
    coarse = C.sum_by(trx, spec.TRX_GROUP, ["Xpo_Ern_BI_Nb"])
    two = checks.reconcile(C.trx_classification(B.book(spark, SF0001)), coarse, spec.TRX_GROUP, ["Xpo_Ern_BI_Nb"])
    assert sorted(map(str, one.collect())) == sorted(map(str, two.select(one.columns).collect()))


def test_scoring_one_chart_again_leaves_the_other(spark, tmp_path):
    path = str(tmp_path / "scored")
    rows = spark.range(50).select(F.col("id").alias("k"), (F.col("id") % 3).alias("v"), F.lit(8.0).alias("p"))
    charts = {"current": [("v", 0, 0.5)], "proposed": [("v", 1, 2.0)]}

    def files():
        return {c: sorted(os.listdir(f"{path}/chart={c}")) for c in charts}

    scoring.write_scored(joins.rerate_charts(rows, charts, ["p"]), rows, path, "first", list(charts), ["k"])
    before = files()
    again = {"proposed": [("v", 1, 4.0)]}
    scoring.write_scored(joins.rerate_charts(rows, again, ["p"]), rows, path, "second", list(again), ["k"])
    after = files()
    assert after["current"] == before["current"] and after["proposed"] != before["proposed"]
    t = spark.read.parquet(path)
    got = {(r["chart"], r["run_id"]): r["s"] for r in t.groupBy("chart", "run_id").agg(F.sum("p").alias("s")).collect()}
    assert got == {("current", "first"): 17 * 4.0 + 33 * 8.0, ("proposed", "second"): 17 * 32.0 + 33 * 8.0}
    with pytest.raises(ValueError, match="changed the rows"):
        scoring.write_scored(joins.rerate_charts(rows.limit(49), again, ["p"]), rows, path, "third", list(again), ["k"])


def test_charts_in_one_pass_equal_one_after_the_other(spark):
    rows = spark.createDataFrame([(1, "a", None, 8.0), (2, "b", 3, 4.0), (3, None, 9, None)], "k int, u string, v int, p double")
    charts = {"x": [("u", "a", 0.5), ("v", 3, 2.0)], "y": [("v", 9, 4.0), ("v", 3, 0.25)]}
    got = joins.rerate_charts(rows, charts, ["p"])
    for n, chart in charts.items():
        one = got.where(F.col("chart") == n).select(rows.columns)
        assert sorted(map(str, one.collect())) == sorted(map(str, joins.rerate(rows, chart, ["p"]).collect()))
    with pytest.raises(ValueError, match="'3' of 'v'"):
        joins.rerate_charts(rows, {"x": [("v", 3, 1.0), ("v", 3, 2.0)]}, ["p"])


def test_two_chart_summary_gives_the_three_exhibits(spark, tmp_path):
    for y in (2024, 2025):
        B.clear_table(spark, SF0001, y).createOrReplaceTempView(f"two_chart_clear_{y}")
    trx = extract.extract_trx(B.book(spark, SF0001), None, province=None)
    inf = extract.extract_inforce(B.book(spark, SF0001), province=None)
    ex = scoring.two_chart_summary(trx.drop(*[c for c in trx.columns if c.startswith(("Prm_Ern_", "Xpo_Ern_"))]),
                                   inf, B.loss_cost_table(spark, SF0001), spark.table("two_chart_clear_2025"),
                                   scoring.EXAMPLE_CHART, scoring.PROPOSED_CHART, str(tmp_path), "run", materialize=False,
                                   c_variables=["dri_gender_cd"])
    assert set(ex) == {"TRX_by_Vehicle", "TRX_by_Driver", "Inf_by_Vehicle"}
    total = ex["TRX_by_Vehicle"].agg(F.sum("Prm_Trm_Veh_Base_Uncap_Am_Sum"), F.sum("Prm_Trm_Veh_Base_Uncap_Am_Prop_Sum")).first()
    side = scoring.chart_side(spark, f"{tmp_path}/trx", "proposed")
    assert total[1] == side.agg(F.sum(sum((F.coalesce(F.col(f"Prm_Ern_{c}_OnLvl_Am"), F.lit(0.0)) for c in spec.COV_ALL), F.lit(0.0)))).first()[0]
    assert ex["Inf_by_Vehicle"].agg(F.sum("Xpo_Tot")).first()[0] > 0 and total[0] != total[1]


def test_optional_table_that_cannot_be_read(spark, tmp_path):
    path = str(tmp_path / "broken")
    spark.range(5).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("broken_view")
    caveats = []
    assert catalog.optional_table(spark, "broken_view", ["id"], caveats) is not None and caveats == []
    for f in os.listdir(path):
        if f.startswith("part-"):
            with open(f"{path}/{f}", "wb") as out:
                out.write(b"not parquet")
        elif f.startswith(".part-"):
            os.remove(f"{path}/{f}")
    assert catalog.optional_table(spark, "broken_view", ["id"], caveats) is None
    assert "broken_view" in caveats[0] and "not readable" in caveats[0]


def test_extracts_take_the_latest_date_and_accident_years(spark):
    b = B.book(spark, SF0001)
    got = extract.extract_trx(b, ["dat_as_of_dt", "dat_year_type_tx"], province=None).distinct().collect()
    assert [tuple(r) for r in got] == [("2025-06-30", "AY")]
    every = extract.extract_trx(b, ["dat_as_of_dt", "dat_year_type_tx"], province=None, as_of=None, year_type=None)
    assert every.distinct().count() == 4
    assert extract.extract_inforce(b, None).select("dat_as_of_dt").distinct().count() == 1


def test_release_deletes_what_was_materialized(spark):
    df = sinks.materialize(spark.range(3), "released")
    path = df.inputFiles()[0].rsplit("/", 1)[0].replace("file://", "")
    assert os.path.exists(path) and df.count() == 3
    assert sinks.release(spark) >= 1 and not os.path.exists(path)
    assert sinks.release(spark) == 0


@pytest.mark.parametrize("name", ["extract_trx", "extract_inforce", "score_inforce"])
def test_extract_queries_keep_every_date_and_year_type(spark, name):
    """Rows of each as-of date and year type of the book are in the query's result."""
    from ratecell.registry import QUERIES
    b = B.book(spark, SF0001).where("pol_region_cd = 'AP' AND pol_commercial_in = 0")
    ppa = b.where("veh_product_cd = 'ppa' AND trx_offset_onset_cd IS NOT NULL AND pol_jurisdiction_cd = 'AMERICA'")
    inf = b.where("veh_product_cd IN ('ppa', 'motor_home')")
    want = {"extract_trx": ppa, "score_inforce": inf,
            "extract_inforce": inf.where("pol_jurisdiction_cd IN ('AMERICA', 'EUROPE')")}[name]
    got = QUERIES[name](spark, SF0001)
    n = got.count() if name == "extract_trx" else got.agg(F.sum("rows")).first()[0]
    assert n == want.count() > want.where("dat_as_of_dt = '2025-06-30'").count()


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_materialize_leaves_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    df = sinks.materialize(spark.range(5000).groupBy((F.col("id") % 999).alias("k")).agg(F.sum("id").alias("v")), "no_shuffles")
    assert not _shuffle_files(spark) - before and df.count() == 999


def test_the_tables_are_joined_once_for_both_sides(spark):
    from ratecell import registry
    cur, prop = registry._sides(spark, SF0001)
    for side, d in (("current", cur), ("proposed", prop)):
        assert d._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
        plain = B.book(spark, SF0001, side)
        assert d.columns == plain.columns and d.exceptAll(plain).isEmpty() and plain.exceptAll(d).isEmpty()


def _exchanges(d):
    plan = d._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning"), plan


def test_sides_are_joined_bucket_by_bucket(spark):
    """Neither the side join nor the sum by vehicle moves rows; only the exhibit's cells move."""
    from ratecell import registry
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for build in (D.trx_by_vehicle, D.inf_by_vehicle):
            d = build(*registry._sides(spark, SF0001))
            n, plan = _exchanges(d)
            assert n == 1 and "SortMergeJoin" in plan, plan
            plain = build(B.book(spark, SF0001), B.book(spark, SF0001, "proposed"))
            assert sorted(map(str, d.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_sides_raise_on_a_repeated_key(spark, tmp_path):
    rows = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    for t in ("orders", "customer", "nation", "region", "part"):
        os.symlink(f"{SF0001}/{t}.parquet", tmp_path / f"{t}.parquet")
    rows.unionByName(rows.where("l_linenumber = 1").limit(1)).write.parquet(str(tmp_path / "lineitem.parquet"))
    from ratecell import registry
    with pytest.raises(Exception, match="a key repeats"):
        D.trx_by_vehicle(*registry._sides(spark, str(tmp_path))).collect()


def test_a_hot_vehicle_is_not_put_into_a_bucket(spark, monkeypatch, tmp_path):
    from ratecell import registry
    want = sorted(map(str, D.trx_by_vehicle(*registry._sides(spark, SF0001)).collect()))
    monkeypatch.setattr(B, "HOT_ROWS", 300)
    monkeypatch.setattr(B, "HOT_SHARE", 0.05)
    n, hot = B._vehicle_sizes(spark, SF0001)
    assert n == spark.read.parquet(f"{SF0001}/lineitem.parquet").count() and not hot
    for t in ("orders", "customer", "nation", "region", "part"):
        os.symlink(f"{SF0001}/{t}.parquet", tmp_path / f"{t}.parquet")
    lines = spark.read.parquet(f"{SF0001}/lineitem.parquet")
    one = lines.select("l_orderkey").first()[0]
    lines.withColumn("l_orderkey", F.when(F.pmod(F.xxhash64(*lines.columns), F.lit(5)) == 0, one).otherwise(F.col("l_orderkey"))
                     ).write.parquet(str(tmp_path / "lineitem.parquet"))
    assert B._vehicle_sizes(spark, str(tmp_path)) == (n, True)
    rows = B.vehicle_rows(spark, str(tmp_path))
    assert rows.groupBy("l_orderkey").count()._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    monkeypatch.setattr(B, "HOT_SHARE", -1)
    monkeypatch.setattr(B, "HOT_ROWS", -1)              # every slot counts as hot: rows move by all keys
    assert sorted(map(str, D.trx_by_vehicle(*registry._sides(spark, SF0001)).collect())) == want


def test_group_totals_of_a_bucketed_table_join_without_exchange(spark):
    """Totals of a table bucketed on a key are summed and joined bucket by bucket; nulls in other keys are a group."""
    rows = [(i % 40, None if i % 3 == 0 else i % 2, float(i)) for i in range(600)]
    df = spark.createDataFrame(rows, "k long, j int, v double").repartition(8, "k")
    totals, bucketed = {"t": F.col("v"), "m": F.col("v") * 2}, ("k", 8)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for share in (windows.HOT_SHARE, 0.5):          # every group is hot, or none
            got = windows.with_group_totals_split(sinks.materialize(df, "bucketed", bucketed), ["k", "j"], totals, share, bucketed)
            n, plan = _exchanges(got)
            assert n == 0 and "SortMergeJoin" in plan, plan
            want = windows.with_group_totals(df, ["k", "j"], totals, method="window")
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", ["vehicle_window_totals", "band_back_join"])
def test_vehicle_totals_move_no_rows(spark, monkeypatch, name):
    """Only the exhibit's cells are moved after the side join, and a hot vehicle's rows still give the same."""
    from ratecell import registry
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = registry.QUERIES[name](spark, SF0001)
        n, plan = _exchanges(d)
        assert n == 1 and "SortMergeJoin" in plan, plan
        got = sorted(map(str, d.collect()))
        monkeypatch.setattr(B, "HOT_SHARE", -1)
        monkeypatch.setattr(B, "HOT_ROWS", -1)
        assert B.vehicle_rows_buckets(spark, SF0001)[1] is None
        assert sorted(map(str, registry.QUERIES[name](spark, SF0001).collect())) == got
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_driver_exhibit_moves_its_cells_only(spark):
    """The side join, the vehicles' bands and the join back to the drivers run bucket by bucket, and only the
    parts of the totals are moved."""
    from ratecell import registry
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = registry.QUERIES["dislocation_trx_driver_cuts"](spark, SF0001)
        n, plan = _exchanges(d)
        assert n == 1 and plan.count("SortMergeJoin") >= 3, plan
        got = sorted(map(str, d.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plain = D.trx_by_driver(B.book(spark, SF0001), B.book(spark, SF0001, "proposed"), bounds=registry.WIDE_BOUNDS,
                            c_variables=registry.CUTS, drop_occasional_principal=True)
    assert got == sorted(map(str, plain.collect()))
    for side, total in (("", "Prm_Trm_Base_Uncap_Am_Sum"), ("_Prop", "Prm_Trm_Dri_Base_Uncap_Am_Prop_Sum")):
        parts = [F.col(f"Prm_Trm_{shown}_Uncap_Am{side}_Sum") for _, shown in spec.DRIVER_ALIASES]
        assert d.where(F.col(total) != sum(parts, F.lit(0.0))).isEmpty()


def test_bucketed_rows_are_released(spark):
    rows = B.vehicle_rows(spark, SF0001)
    path = os.path.dirname(rows.inputFiles()[0].replace("file://", ""))
    names = {t.name for t in spark.catalog.listTables()}
    assert sinks.release(spark) >= 1 and not os.path.exists(path)
    gone = names - {t.name for t in spark.catalog.listTables()}
    assert any(g.startswith("book_rows_") for g in gone)


def test_side_join_moves_totals_only(spark):
    """The vehicle exhibit reads totals: no earned column by coverage and no claim crosses the join."""
    plan = D.trx_by_vehicle(B.book(spark, SF0001), B.book(spark, SF0001, "proposed"))._jdf.queryExecution().optimizedPlan().toString()
    above = plan[:plan.index("Join LeftOuter")]
    assert "BI_OnLvl" not in above and "clm_chap_bi" not in above and "Prm_Trm_TOT_Uncap_Am_Ern" in above


def test_charted_levels_are_broadcast(spark, monkeypatch):
    """Rows are not moved by level, where a chart of two levels would fill two tasks; a large chart is joined."""
    rows = spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 2).alias("v"), F.lit(8.0).alias("p"))
    chart = [("v", 0, 0.5), ("v", 1, 2.0)]
    table = spark.createDataFrame([("v", "0", 0.5), ("v", "1", 2.0)], "a string, b string, c double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for c in (chart, table):
            for d in (joins.rerate(rows, c, ["p"]), joins.rerate_charts(rows, {"x": c, "y": chart}, ["p"])):
                plan = d._jdf.queryExecution().executedPlan().toString()
                assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        monkeypatch.setattr(joins, "BROADCAST_LEVELS", 1)
        large = joins.rerate(rows, chart, ["p"])
        assert "SortMergeJoin" in large._jdf.queryExecution().executedPlan().toString()
        assert large.agg(F.sum("p")).first()[0] == 50 * 4.0 + 50 * 16.0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("how", ["rows", "bitmaps"])
def test_distinct_counts_move_rows_before_they_are_multiplied(spark, how):
    from ratecell.plans import elr
    d = spark.range(3000).select((F.col("id") % 3).cast("string").alias("pol_uwcompany_cd"), (F.col("id") % 7).alias("a"),
                                 F.when(F.col("id") % 5 > 0, F.col("id") % 4).alias("b"), (F.col("id") % 700).alias("q"),
                                 (F.col("id") % 2).alias("f"))
    got = elr._distinct(d, ["a", "b"], "q", "f", "n", "m", how)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan[plan.index("Generate posexplode"):]
    want = {}
    for r in d.collect():
        for i, level in enumerate((r.a, r.b)):
            cell = want.setdefault((r.pol_uwcompany_cd, i, None if level is None else str(level)), (set(), set()))
            cell[0].add(r.q)
            if r.f == 1:
                cell[1].add(r.q)
    assert {(r.pol_uwcompany_cd, r["_var"], r.level_value): (r.n, r.m) for r in got.collect()} == {
        k: (len(a), len(b)) for k, (a, b) in want.items()}


def _mixed_keys(spark):
    """Keys with flagged and other rows in a cell, null levels, keys, flags and companies."""
    rows = [("ab"[i % 2] if i % 11 else None, None if i % 7 == 0 else i % 3, str(i % 4) if i % 5 else None,
             None if i % 13 == 0 else i % 37, None if i % 3 == 0 else i % 2) for i in range(800)]
    return spark.createDataFrame(rows, "pol_uwcompany_cd string, a int, b string, q int, f int"), rows


@pytest.mark.parametrize("how, hot", [("rows", False), ("rows", True), ("bitmaps", False)])
def test_distinct_counts_with_mixed_flags_and_nulls(spark, monkeypatch, how, hot):
    """Without a hot key no state is kept per cell and key: a hash aggregate holds cells or blocks of bitmaps."""
    from ratecell.plans import elr
    monkeypatch.setattr(aggregates, "KEY_ROWS", -10_000 if hot else aggregates.KEY_ROWS)
    monkeypatch.setattr(aggregates, "RANGE", 50)            # several ranges
    d, rows = _mixed_keys(spark)
    got = elr._distinct(d, ["a", "b"], "q", "f", "n", "m", how)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
    if how == "bitmaps":
        assert "SortAggregate" not in plan and "bit_or" in plan
    else:
        assert ("collect_list" in plan) != hot
    want = {}
    for c, a, b, q, f in rows:
        for i, level in enumerate((a, b)):
            if q is not None:
                cell = want.setdefault((c, i, None if level is None else str(level)), (set(), set()))
                cell[0].add(q)
                if f == 1:
                    cell[1].add(q)
    assert {(r.pol_uwcompany_cd, r["_var"], r.level_value): (r.n, r.m) for r in got.collect()} == {
        k: (len(a), len(b)) for k, (a, b) in want.items()}
    assert elr._distinct(d.limit(0), ["a", "b"], "q", "f", "n", "m", how).isEmpty()


def test_long_elr_prepares_rows_before_it_multiplies_them(spark, monkeypatch):
    """The prep is a projection of its own under the multiplied rows, and each source's cells are written."""
    from ratecell.plans import elr
    plans = []
    monkeypatch.setattr(elr, "materialize", lambda df, name: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or sinks.materialize(df, name))
    elr.elr_long(B.book(spark, SF0001), closing=B.closing(spark, SF0001), retention=B.retention(spark, SF0001),
                 province=spec.ALL_PROVINCES, write_cells=True)
    assert len(plans) == 3
    between = plans[0][plans[0].index("Generate posexplode"):]
    assert between.index("Coalesce") < between.index("CASE WHEN")


def test_two_charts_write_the_extract_only_and_join_without_exchange(spark, monkeypatch):
    """Rows outside the extract are not written, and the charts' sides join and are summed bucket by bucket."""
    from ratecell import registry
    written, build = [], B.vehicle_rows_buckets
    monkeypatch.setattr(B, "vehicle_rows_buckets", lambda *a: written.append(build(*a)) or written[-1])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        d = registry.QUERIES["dislocation_two_charts"](spark, SF0001)
        n, plan = _exchanges(d)
        assert n == 1 and "SortMergeJoin" in plan, plan
        assert written[0][0].count() == registry._raw_trx(spark, SF0001).count() < B.book(spark, SF0001).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
