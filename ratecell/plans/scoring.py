"""Scoring one dataset on one rating chart.

The original hands a table to an external rating service. Here the re-rating
is a Spark projection over a factor chart (``operators.joins.rerate``), so the
whole scoring is: extract -> loss costs (many-to-one join) -> CLEAR rate
groups from the latest lookup (many-to-one join) -> re-rate (projection) ->
merge test (one two-count job). The result is meant to be written
(``sources.sinks.save_table``) so the summary reads a materialised table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell import spec
from ratecell.operators.joins import attach, attach_loss_cost, rerate, rerate_charts
from ratecell.plans.earning import EXAMPLE_SPLIT, earn

# Example chart (variable, level, factor) used by the registered queries; factors
# are sixteenths so the re-rated sums stay exact.
EXAMPLE_CHART = ([("veh_rg_col_no", str(g), 0.875 + (g % 5) / 16) for g in range(1, 13)]
                 + [("dri_gender_cd", "M", 1.0625), ("dri_gender_cd", "F", 0.9375)]
                 + [("ter_onlvl_ibc_no", str(t), 0.875 + (t % 4) / 16) for t in range(1, 7)])
RERATED = ["Prm_Trm_BI_Uncap_Am", "Prm_Trm_PD_Uncap_Am", "Prm_Trm_DC_Uncap_Am",
           "Prm_Trm_AB_Uncap_Am", "Prm_Trm_AP_COL_Uncap_Am", "Prm_Trm_AP_SP_CMP_Uncap_Am",
           "Prm_Trm_Dri_Tot_Uncap_Am"]


PROPOSED_CHART = ([("veh_rg_col_no", str(g), 0.875 + (g % 3) / 8) for g in range(1, 13)]
                  + [("dri_gender_cd", "M", 1.0), ("dri_gender_cd", "F", 1.125)])
# Premiums of a transaction that a chart re-rates, before the AP override makes the composites of them.
TRX_RERATED = [f"Prm_Trm_{c}_Uncap_Am" for c in ("BI", "PD", "DC", "AB", "UA", "UI", "COL", "CMP", "SP")] + \
    ["Coll_Portion_of_AP", "Comp_Portion_of_AP"]


def onlevel_clear(df: DataFrame, clear: DataFrame, key: str = "veh_vicc_cd",
                  columns: Sequence[str] = ("veh_rg_col_no", "veh_rg_cmp_no")) -> DataFrame:
    """Replace vehicle rate groups by the CLEAR table's, where the vehicle is listed."""
    c = clear.select(key, *[F.col(x).alias(f"_clear_{x}") for x in columns])
    j = attach(df, c, [key])
    return j.withColumns({x: F.coalesce(F.col(f"_clear_{x}"), F.col(x)) for x in columns}) \
            .drop(*[f"_clear_{x}" for x in columns])


def score_inforce(inforce: DataFrame, loss_cost: DataFrame, clear: DataFrame,
                  chart=EXAMPLE_CHART, premiums: Sequence[str] = RERATED) -> DataFrame:
    """Inforce extract -> loss costs -> CLEAR groups -> premiums re-rated on ``chart``."""
    lc_out = list(spec.LOSS_COST_RENAME.values())
    base = inforce.drop(*[c for c in lc_out if c in inforce.columns])
    d = attach_loss_cost(base, loss_cost, spec.LOSS_COST_KEYS, spec.LOSS_COST_RENAME)
    d = onlevel_clear(d, clear)
    return rerate(d, chart, premiums)


def score_job(inforce: DataFrame, loss_cost: DataFrame, out_table: str,
              clear_prefix: str = "rate_group_", chart=EXAMPLE_CHART,
              premiums: Sequence[str] = RERATED, fmt: str = "parquet",
              bucket_by: tuple[int, Sequence[str]] | None = None) -> str:
    """The scoring step end to end: latest CLEAR table from the catalog, score,
    write the result as a table (bucketed on the later side-join keys if asked,
    so the summary's join needs no shuffle), then the merge test against the
    written table - the summary then reads files, not this lineage."""
    from ratecell.operators.checks import assert_same_rows
    from ratecell.sources.catalog import latest_version
    from ratecell.sources.sinks import save_table
    spark = inforce.sparkSession
    clear_name, _ = latest_version(spark, clear_prefix)
    scored = score_inforce(inforce, loss_cost, spark.table(clear_name), chart, premiums)
    save_table(scored, out_table, fmt, bucket_by=bucket_by)
    assert_same_rows(inforce, spark.table(out_table))
    return out_table


# --- several charts in one pass ------------------------------------------------------------------------

def score_trx(trx: DataFrame, charts: Mapping[str, object], split=EXAMPLE_SPLIT,
              premiums: Sequence[str] = TRX_RERATED) -> DataFrame:
    """TRX extract -> premiums re-rated on every chart -> endorsement split -> earned: each row once per
    chart, with the chart's name in ``chart``. One scan of the transactions, whatever the number of charts."""
    return earn(rerate_charts(trx, charts, premiums), split)


def score_inforce_charts(inforce: DataFrame, loss_cost: DataFrame, clear: DataFrame, charts: Mapping[str, object],
                         premiums: Sequence[str] = RERATED) -> DataFrame:
    """``score_inforce`` on several charts in one pass: each row once per chart."""
    base = score_inforce(inforce, loss_cost, clear, [], premiums)
    return rerate_charts(base, charts, premiums)


def write_scored(scored: DataFrame, source: DataFrame, path: str, run: str, charts: Sequence[str],
                 keys: Sequence[str], bucketed: tuple[str, int] | None = None) -> dict[str, DataFrame]:
    """Write scored rows into the table folder ``path``, one partition per chart, and test the merge on
    rows: each partition written must hold the source's keys, no more and no fewer. Charts not scored now
    keep their files, so that one chart can be scored again without the others. Returns the charts' rows;
    ``bucketed``: how a new folder is bucketed, so that they join without an exchange."""
    from ratecell.operators.checks import same_row_set
    from ratecell.sources.sinks import save_partitions
    written = save_partitions(scored, path, "chart", run, bucketed)
    sides = {chart: _of_chart(written, chart) for chart in charts}
    for chart, side in sides.items():
        got = same_row_set(source, side, keys).first()
        if not got["same_keys"]:
            raise ValueError(f"scoring on {chart} changed the rows: {got['left_rows']:,} -> {got['right_rows']:,}")
    return sides


def _of_chart(written: DataFrame, chart: str) -> DataFrame:
    return written.where(F.col("chart") == chart).drop("chart", "run_id")


def chart_side(spark, path: str, chart: str) -> DataFrame:
    """The rows of one chart from a table folder of scored rows (only its partition is read)."""
    return _of_chart(spark.read.parquet(path), chart)


def two_chart_summary(trx: DataFrame, inforce: DataFrame, loss_cost: DataFrame, clear: DataFrame, current,
                      proposed, folder: str, run: str, split=EXAMPLE_SPLIT, **options) -> dict[str, DataFrame]:
    """From two rating charts to the three exhibits: both datasets scored on both charts in one pass each,
    written by chart under ``folder``, merge-tested, and summarised as current against proposed.
    ``options`` go to ``dislocation_summary``."""
    from ratecell.plans.dislocation import dislocation_summary
    spark = trx.sparkSession
    charts = {"current": current, "proposed": proposed}
    paths = {"trx": f"{folder}/trx", "inf": f"{folder}/inf"}
    write_scored(score_trx(trx, charts, split), trx, paths["trx"], run, list(charts), spec.TRX_UNIQUE_KEYS)
    write_scored(score_inforce_charts(inforce, loss_cost, clear, charts), inforce, paths["inf"], run, list(charts),
                 spec.INF_UNIQUE_KEYS)
    sides = [chart_side(spark, paths[d], c) for d in ("trx", "inf") for c in charts]
    return dislocation_summary(*sides, **options)
