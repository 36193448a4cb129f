"""Charts, splits and helper lists of any size; null keys, NaN and safe table replacement."""

import pytest
from pyspark.sql import functions as F

from ratecell.functions.bands import rate_change_band
from ratecell.operators.joins import rerate, split_endorsements
from ratecell.operators.windows import with_group_totals
from ratecell.sources import catalog, extract, sinks


def test_chart_of_50000_levels(spark):
    chart = spark.range(50000).selectExpr("'v' AS variable", "cast(id AS string) AS level", "1 + (id % 4) / 4D AS factor")
    rows = spark.range(60000).selectExpr("id AS v", "8D AS p", "'x' AS level")
    got = rerate(rows, chart, ["p"])
    assert got.columns == rows.columns and got.count() == 60000
    assert got.filter("p <> CASE WHEN v < 50000 THEN 8 * (1 + (v % 4) / 4D) ELSE 8 END").count() == 0


def test_chart_errors_name_the_level(spark):
    rows = spark.createDataFrame([("a", 1.0)], "v string, p double")
    with pytest.raises(ValueError, match="'a' of 'v'"):
        rerate(rows, [("v", "a", 1.0), ("v", "a", 2.0)], ["p"])
    with pytest.raises(ValueError, match="nope"):
        rerate(rows, [("nope", "a", 1.0)], ["p"])


def test_split_of_20000_rows(spark):
    split = spark.range(20000).selectExpr("concat('e', id) AS e", "'BI' AS c", "0.5D AS s")
    rows = spark.createDataFrame([(10.0, 4.0, None)], "Prm_Trm_BI_Uncap_Am double, x double, y double")
    got = split_endorsements(rows, split, {"e7": "x", "e19999": "y"}, ["Prm_Trm_BI_Uncap_Am"]).first()
    assert got["Prm_Trm_BI_Uncap_Am_End"] == 12.0


def test_helper_of_20000_names(spark):
    names = extract.config_columns(spark.range(20000).selectExpr("concat('c', id) AS var_name"))
    assert len(names) == 20000


def test_every_missing_column_is_listed(spark):
    spark.range(1).createOrReplaceTempView("gaps_view")
    with pytest.raises(ValueError, match="c0.*c11"):
        catalog.resolve_table(spark, ["gaps_view"], [f"c{i}" for i in range(12)])


def test_group_totals_keep_null_keys(spark):
    df = spark.createDataFrame([(None, "a", 1.0), (None, "a", 2.0), ("k", None, 5.0)], "k string, j string, v double")
    a = with_group_totals(df, ["k", "j"], {"t": F.col("v")}, method="window")
    b = with_group_totals(df, ["k", "j"], {"t": F.col("v")}, method="join")
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_nan_rate_change_is_filed_like_null(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (9.0,)], "x double")
    got = [r[0] for r in df.select(rate_change_band("x", null_label="none")).collect()]
    assert got[0] == got[1] == "none" != got[2]


def test_save_table_may_replace_what_it_reads(spark):
    sinks.save_table(spark.range(5), "self_read")
    sinks.save_table(spark.table("self_read").where("id > 1"), "self_read")
    assert spark.table("self_read").count() == 3
    with pytest.raises(Exception):
        sinks.save_table(spark.range(5).select(F.raise_error(F.lit("no")).cast("int").alias("x")), "self_read")
    assert spark.table("self_read").count() == 3
