"""Joins used by the exhibits. Every data join is an equi LEFT join.

Scale notes
-----------
* Side joins (current ⟕ proposed) are big-to-big left joins on keys that are unique on the proposed
  side. A repeated key raises: in the join's own run (``check_unique="in_flight"``, what the exhibits
  use), by counting the rows of each key on the partitioning that the join needs anyway, or in a job
  before it (``True``).
* Lookup joins (loss costs, CLEAR groups, vehicle bands) are many-to-one; the
  planner broadcasts the right side only when its measured size is under
  ``spark.sql.autoBroadcastJoinThreshold`` and AQE's skew-join splits a hot key
  otherwise. Nothing here forces a broadcast of data whose size grows.
* A rating chart is joined as a long table, one variable after the other; a variable's levels are
  broadcast up to ``BROADCAST_LEVELS`` of them, counted before the join. An endorsement split is summed to one share per endorsement
  and coverage that the table has, which its columns bound.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecell.functions.scalars import nz
from ratecell.operators.checks import assert_unique
from ratecell.operators.schema import require_columns


def join_sides(current: DataFrame, proposed: DataFrame, keys: Sequence[str],
               how: str = "left", check_unique: bool | str = True) -> DataFrame:
    """``current ⟕ proposed`` on ``keys``; unmatched proposed values stay null.

    The proposed side's keys must be unique, as each current row would else appear once per match.
    ``check_unique=True`` raises at once, after a job over the proposed side's keys; ``"in_flight"``
    raises when the join runs, which then reads that side once; ``False`` leaves the check out, for
    tables that were checked when they were written.
    """
    require_columns(current, keys, "current side")
    require_columns(proposed, keys, "proposed side")
    if check_unique == "in_flight":
        if how not in ("left", "inner"):
            raise ValueError(f"a {how} join keeps proposed rows that match nothing: check their keys before it")
        proposed = raise_on_repeats(proposed, keys, "proposed side")
    elif check_unique:
        assert_unique(proposed, keys, "proposed side")
    return current.join(proposed, on=list(keys), how=how)


def raise_on_repeats(df: DataFrame, keys: Sequence[str], where: str) -> DataFrame:
    """``df`` grouped by its keys, in a job that raises where a key has more than one row. A join on the
    same keys needs that partitioning anyway, so that the check adds no exchange. Rows with a null among
    their keys, which match nothing, may repeat; one of them stays."""
    rest = [F.first(c).alias(c) for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(*rest, F.count(F.lit(1)).alias("_rows"))
    text = F.concat(F.lit(f"{where}: a key repeats on {list(keys)}: "), F.to_json(F.struct(*keys)))
    fails = reduce(lambda a, k: a & F.col(k).isNotNull(), keys, F.col("_rows") > 1)
    return one.where(F.when(fails, F.raise_error(text).cast("boolean")).otherwise(True)).drop("_rows")


def attach(rows: DataFrame, lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Many-to-one left join of a per-key lookup (band, loss cost, CLEAR group)."""
    return rows.join(lookup, on=list(keys), how="left")


def attach_loss_cost(inforce: DataFrame, loss_cost: DataFrame, keys: Sequence[str],
                     rename: Mapping[str, str]) -> DataFrame:
    """Loss costs onto inforce, then their names mapped to ``lc_*_pred_am``."""
    missing = [c for c in rename if c not in loss_cost.columns]
    if missing:
        raise ValueError(f"loss cost table is missing: {missing}")
    lc = loss_cost.select(*keys, *rename.keys())
    return attach(inforce, lc, keys).withColumnsRenamed(dict(rename))


def endorsement_split_columns(split: DataFrame | Iterable[tuple[str, str, float]],
                              endorsement_cols: Mapping[str, str],
                              premium_cols: Sequence[str],
                              coverage_of=lambda p: p[len("Prm_Trm_"):-len("_Uncap_Am")]
                              ) -> dict[str, Column]:
    """``Prm_Trm_<cov>_Uncap_Am_End = base + Σ share(e, cov) · nz(endorsement e)``.

    ``split`` rows are (endorsement, coverage, share) in any number; ``endorsement_cols`` maps an
    endorsement name to its premium column. Shares of one endorsement and coverage add up; those of
    names that the table doesn't have are left out. Coverages without a share keep their base
    premium. The shares in use are bounded by the columns, so they become literals in a projection.
    """
    wanted = {coverage_of(p) for p in premium_cols}
    if isinstance(split, DataFrame):
        e, c, s = (F.col(x) for x in split.columns[:3])
        used = (split.select(e.alias("e"), c.alias("c"), s.cast("double").alias("s"))
                .where(F.col("e").isin(list(endorsement_cols)) & F.col("c").isin(sorted(wanted)))
                .groupBy("e", "c").agg(F.sum("s").alias("s")).orderBy("c", "e"))
        split = [tuple(r) for r in used.collect()]          # at most endorsements x coverages
    shares: dict[tuple[str, str], float] = {}
    for name, cov, share in split:
        if name in endorsement_cols and share:
            shares[cov, name] = shares.get((cov, name), 0.0) + float(share)
    out = {}
    for p in premium_cols:
        terms = [nz(F.col(endorsement_cols[n])) * F.lit(s) for (c, n), s in shares.items() if c == coverage_of(p)]
        out[f"{p}_End"] = reduce(add, terms, F.col(p)) if terms else F.col(p)
    return out


def split_endorsements(df: DataFrame, split, endorsement_cols: Mapping[str, str],
                       premium_cols: Sequence[str]) -> DataFrame:
    return df.withColumns(endorsement_split_columns(split, endorsement_cols, premium_cols))


# A variable with more levels than this is joined as any table, not broadcast.
BROADCAST_LEVELS = 500_000


def chart_table(spark, chart: DataFrame | Iterable[tuple[str, str, float]]) -> tuple[DataFrame, dict[str, int]]:
    """A rating chart as a long table (variable, level as text, factor) and the variables it has with their
    numbers of levels. A level that a variable has twice raises, naming it: for rows given as a list at once, for a table after one
    job over it, which also finds the variables."""
    if not isinstance(chart, DataFrame):
        rows = [(v, str(lv), float(f)) for v, lv, f in chart]
        seen = Counter((v, lv) for v, lv, _ in rows)
        twice = sorted((*k, n) for k, n in seen.items() if n > 1)
        variables = Counter(v for v, _, _ in rows)
        chart = spark.createDataFrame(rows, "variable string, level string, factor double")
    else:
        v, lv, f = (F.col(c) for c in chart.columns[:3])
        chart = chart.select(v.cast("string").alias("variable"), lv.cast("string").alias("level"),
                             f.cast("double").alias("factor"))
        found = (chart.groupBy("variable", "level").count().groupBy("variable")
                 .agg(F.min(F.when(F.col("count") > 1, F.struct("level", "count"))).alias("twice"),
                      F.sum("count").alias("levels")).collect())
        twice = sorted((r["variable"], r["twice"]["level"], r["twice"]["count"]) for r in found if r["twice"])
        variables = {r["variable"]: r["levels"] for r in found}    # columns of the table to re-rate
    if twice:
        v, lv, n = twice[0]
        raise ValueError(f"rating chart lists level {lv!r} of {v!r} {n} times")
    return chart, {v: variables[v] for v in sorted(variables)}


def _on_level(rows: DataFrame, lookup: DataFrame, variable: str, level: str, levels: int) -> DataFrame:
    """Left join of a variable's charted levels. Few levels are broadcast: a join that moves the rows by level
    would give all rows of a level, of which a chart may have two, to one task."""
    lookup = F.broadcast(lookup) if levels <= BROADCAST_LEVELS else lookup
    return rows.join(lookup, F.col(variable).cast("string") == F.col(level), "left")


def _charted(df: DataFrame, variables: Iterable[str]) -> None:
    if missing := [v for v in variables if v not in df.columns]:
        raise ValueError(f"rating chart names variables not on the table: {missing}")


def rerate(df: DataFrame, chart, premium_cols: Sequence[str]) -> DataFrame:
    """Re-rate on a chart of any size: each premium times the product of its variables' factors,
    1.0 where a level is not charted. One left join per variable on the level's text; same rows in,
    same rows out, and only the premium columns change."""
    chart, names = chart_table(df.sparkSession, chart)
    _charted(df, names)
    out, total = df, F.lit(1.0)
    for i, v in enumerate(names):
        one = chart.where(F.col("variable") == v).select(F.col("level").alias(f"_level{i}"), F.col("factor").alias(f"_factor{i}"))
        out = _on_level(out, one, v, f"_level{i}", names[v])
        total = total * F.coalesce(F.col(f"_factor{i}"), F.lit(1.0))
    return out.withColumns({p: F.col(p) * total for p in premium_cols}).select(*df.columns)


def rerate_charts(df: DataFrame, charts: Mapping[str, object], premium_cols: Sequence[str],
                  chart_col: str = "chart") -> DataFrame:
    """Re-rate on several charts in one pass: each row once per chart, with the chart's name in
    ``chart_col`` and its premiums. The charts become one long table; each variable that any of them
    has is one left join that brings all charts' factors, 1.0 where a chart lacks the level."""
    parts, names = [], Counter()
    for name, chart in charts.items():
        table, variables = chart_table(df.sparkSession, chart)
        parts.append(table.withColumn("chart", F.lit(name)))
        names.update(variables)
    _charted(df, sorted(names))
    long = reduce(DataFrame.unionByName, parts)
    out, totals = df, {name: F.lit(1.0) for name in charts}
    for i, v in enumerate(sorted(names)):
        factors = [F.max(F.when(F.col("chart") == n, F.col("factor"))).alias(f"_f{i}_{k}") for k, n in enumerate(charts)]
        one = long.where(F.col("variable") == v).groupBy(F.col("level").alias(f"_level{i}")).agg(*factors)
        out = _on_level(out, one, v, f"_level{i}", names[v])
        totals = {n: t * F.coalesce(F.col(f"_f{i}_{k}"), F.lit(1.0)) for k, (n, t) in enumerate(totals.items())}
    rated = [F.struct(F.lit(n).alias(chart_col), *[(F.col(p) * t).alias(p) for p in premium_cols]) for n, t in totals.items()]
    return out.select(*[c for c in df.columns if c not in premium_cols], F.inline(F.array(*rated)))
