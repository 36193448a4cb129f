"""Checks that make an exhibit safe to use.

Each check is a DataFrame (so it can be registered, written, or joined into a
report) plus, where the notebooks stop on failure, an ``assert_*`` that runs
the one-row aggregate and raises. Every check is a single aggregate: one scan,
no collect of data rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ratecell import spec


def coverage_check(df: DataFrame, cell_col: str = "fsa_tx",
                   unknown: str = spec.UNKNOWN_FSA) -> DataFrame:
    """rows, distinct cells and UNKNOWN rows in ONE aggregate (not three scans)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.count_distinct(F.col(cell_col)).alias("cells"),
                  F.sum(F.when(F.col(cell_col) == unknown, 1).otherwise(0))
                  .cast("long").alias("unknown"))


def unknown_share(coverage: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Adds the UNKNOWN share and a warning flag above ``threshold`` (1%)."""
    share = F.when(F.col("rows") == 0, F.lit(None).cast("double")).otherwise(
        F.col("unknown").cast("double") / F.col("rows").cast("double"))
    return coverage.withColumn("unknown_share", share).withColumn(
        "unknown_warning", F.coalesce(share > threshold, F.lit(False)))


def double_count_rows(df: DataFrame, composites: Sequence[str]) -> DataFrame:
    """Rows whose composite indicator exceeds 1 (AP overlapping COL/CMP/SPE)."""
    bad = None
    for c in composites:
        cond = F.col(c) > 1
        bad = cond if bad is None else (bad | cond)
    return df.agg(F.count_if(F.coalesce(bad, F.lit(False))).alias("double_counted_rows"))


def assert_no_double_count(df: DataFrame, composites: Sequence[str]) -> None:
    n = double_count_rows(df, composites).first()[0]
    if n:
        raise AssertionError(f"{n:,} rows double count AP exposure - "
                             f"did this table go through data prep?")


def row_profile(df: DataFrame, by: Sequence[str] = ("pol_jurisdiction_cd",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"))


def side_counts(frames: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Row counts of every (dataset, side) frame in ONE job: tag, union, group.
    Output: dataset, current_rows, proposed_rows, balanced."""
    tagged = None
    for (ds, side), d in frames.items():
        t = d.select(F.lit(ds).alias("dataset"), F.lit(side).alias("side"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return (tagged.groupBy("dataset")
            .agg(F.count_if(F.col("side") == "current").alias("current_rows"),
                 F.count_if(F.col("side") == "proposed").alias("proposed_rows"))
            .withColumn("balanced", F.col("current_rows") == F.col("proposed_rows")))


def assert_balanced(frames: Mapping[tuple[str, str], DataFrame]) -> None:
    bad = [r.asDict() for r in side_counts(frames).filter(~F.col("balanced")).collect()]
    if bad:
        raise ValueError(f"current and proposed row counts differ: {bad} - the two "
                         f"scorings were built on different source data")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Row counts of two frames in one job (the merge test: prep must keep the row set)."""
    t = (a.select(F.lit(1).alias("_s"))
         .unionByName(b.select(F.lit(2).alias("_s"))))
    return (t.agg(F.count_if(F.col("_s") == 1).alias("left_rows"),
                  F.count_if(F.col("_s") == 2).alias("right_rows"))
            .withColumn("same", F.col("left_rows") == F.col("right_rows")))


def assert_same_rows(a: DataFrame, b: DataFrame) -> None:
    r = same_rows(a, b).first()
    if not r["same"]:
        raise ValueError(f"row count changed: {r['left_rows']:,} -> {r['right_rows']:,}")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (partial counts per task before the shuffle)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str], where: str = "input") -> None:
    d = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("keys"),
                                     F.sum("n").alias("rows")).first()
    if d["keys"]:
        raise ValueError(f"{where}: {d['keys']:,} keys repeat over {d['rows']:,} rows "
                         f"on {list(keys)}; the side join would fan out")


def reconcile(fine: DataFrame, coarse: DataFrame, keys: Sequence[str],
              measures: Sequence[str], tolerance: float = 1e-6) -> DataFrame:
    """Roll the fine exhibit up to ``keys`` and full-outer compare with the coarse
    run. One row per key with both totals, the difference and a ``tied`` flag."""
    up = fine.groupBy(*keys).agg(*[F.sum(m).alias(f"{m}_fine") for m in measures])
    co = coarse.select(*keys, *[F.col(m).alias(f"{m}_coarse") for m in measures])
    j = up.join(co, on=list(keys), how="full_outer")
    tied = F.lit(True)
    for m in measures:
        diff = F.coalesce(F.col(f"{m}_fine"), F.lit(0.0)) - F.coalesce(F.col(f"{m}_coarse"), F.lit(0.0))
        j = j.withColumn(f"{m}_diff", diff)
        tied = tied & (F.abs(diff) <= tolerance)
    return j.withColumn("tied", tied)


def thin_cells(exhibit: DataFrame, exposure_col: str, floor: float,
               by: Sequence[str] = ()) -> DataFrame:
    """Cells whose exposure is under ``floor`` (null counts as 0), per ``by`` group."""
    thin = F.coalesce(F.col(exposure_col), F.lit(0.0)) < floor
    agg = [F.count(F.lit(1)).alias("cells"), F.count_if(thin).alias("thin_cells")]
    return exhibit.groupBy(*by).agg(*agg) if by else exhibit.agg(*agg)


def null_operands(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where each operand is null, all in one aggregate."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in cols])


def jurisdictions_in(df: DataFrame, col: str = "pol_jurisdiction_cd") -> DataFrame:
    """Distinct jurisdictions and whether there is exactly one."""
    return (df.agg(F.count_distinct(F.col(col)).alias("jurisdictions"))
            .withColumn("single_jurisdiction", F.col("jurisdictions") == 1))


# --- checks that cost no run of their own -----------------------------------------------------------

def same_row_set(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The merge test on rows: counts, and whether both frames hold the same multiset of keys. Each side is
    digested by two sums of 64-bit hashes of the key columns (nulls included), which no order changes; a row
    swapped for another differs even where the counts agree."""
    def tagged(d, side):
        k = [F.col(c) for c in keys]
        # a null and the hash's seed look alike, so the nulls' places are hashed too
        nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in k])
        return d.select(F.lit(side).alias("_s"), F.xxhash64(nulls, *k).cast("decimal(20,0)").alias("_h"),
                        F.xxhash64(*reversed(k), nulls).cast("decimal(20,0)").alias("_g"))

    def of(side, c):
        return F.coalesce(F.sum(F.when(F.col("_s") == side, F.col(c))), F.lit(0).cast("decimal(38,0)"))

    t = tagged(a, 1).unionByName(tagged(b, 2))
    one = t.agg(F.count_if(F.col("_s") == 1).alias("left_rows"), F.count_if(F.col("_s") == 2).alias("right_rows"),
                *[of(s, c).alias(f"{c}{s}") for s in (1, 2) for c in ("_h", "_g")])
    return one.select("left_rows", "right_rows", (F.col("left_rows") == F.col("right_rows")).alias("same"),
                      ((F.col("left_rows") == F.col("right_rows")) & (F.col("_h1") == F.col("_h2"))
                       & (F.col("_g1") == F.col("_g2"))).alias("same_keys"))


def reconcile_one_pass(rows: DataFrame, keys: Sequence[str], level: str, measures: Sequence[str],
                       tolerance: float = 1e-6) -> DataFrame:
    """``reconcile`` of the exhibit by ``keys`` and ``level`` with the one by ``keys``, both made from one scan:
    grouping sets give the cells and the subtotals, and the grouping id tells a subtotal from the cell of a
    null level."""
    both = (rows.select(*keys, level, *measures)
            .groupingSets([[*[F.col(k) for k in keys], F.col(level)], [F.col(k) for k in keys]], *keys, level)
            .agg(F.grouping_id().alias("_gid"), *[F.sum(m).alias(m) for m in measures]))
    fine = F.col("_gid") == 0
    out = both.groupBy(*keys).agg(*[F.sum(F.when(fine, F.col(m))).alias(f"{m}_fine") for m in measures],
                                  *[F.max(F.when(~fine, F.col(m))).alias(f"{m}_coarse") for m in measures])
    diff = {f"{m}_diff": F.coalesce(F.col(f"{m}_fine"), F.lit(0.0)) - F.coalesce(F.col(f"{m}_coarse"), F.lit(0.0))
            for m in measures}
    out = out.withColumns(diff)
    return out.withColumn("tied", reduce(lambda a, c: a & (F.abs(F.col(c)) <= tolerance), diff, F.lit(True)))


class Guard:
    """Checks that ride on the job that writes an exhibit: ``watch`` adds counts to the rows on their way
    (``DataFrame.observe``; nothing is scanned for them), and ``check``, after the job, raises or reports.

    Counted: rows, rows of the unknown cell, rows whose composites double count, nulls of operands, and
    the smallest and largest jurisdiction. ``check`` raises for double counting and, if ``single`` is set,
    for more than one jurisdiction; a share of unknown cells above ``threshold`` is a warning.
    """

    def __init__(self, name: str, cell: str = "fsa_tx", composites: Sequence[str] = (), operands: Sequence[str] = (),
                 jurisdiction: str = "pol_jurisdiction_cd", single: bool = False, threshold: float = 0.01,
                 unknown: str = spec.UNKNOWN_FSA):
        self.name, self.cell, self.composites, self.operands = name, cell, list(composites), list(operands)
        self.jurisdiction, self.single, self.threshold, self.unknown = jurisdiction, single, threshold, unknown
        self.seen = None

    def watch(self, df: DataFrame) -> DataFrame:
        """``df``, counted when it runs. One guard watches one run: watching again starts anew."""
        self.seen = Observation()
        twice = reduce(lambda a, c: a | (F.col(c) > 1), self.composites, F.lit(False))
        return df.observe(
            self.seen, F.count(F.lit(1)).alias("rows"), F.count_if(F.col(self.cell) == self.unknown).alias("unknown"),
            F.count_if(F.coalesce(twice, F.lit(False))).alias("double_counted_rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in self.operands],
            F.min(self.jurisdiction).alias("first_jurisdiction"), F.max(self.jurisdiction).alias("last_jurisdiction"))

    def report(self) -> dict:
        """The counts of the run that has been watched, with the unknown share and warnings."""
        if self.seen is None:
            raise ValueError(f"{self.name}: nothing has been watched")
        got = dict(self.seen.get)
        share = got["unknown"] / got["rows"] if got["rows"] else None
        one = got["rows"] == 0 or got["first_jurisdiction"] == got["last_jurisdiction"]
        return got | {"unknown_share": share, "unknown_warning": bool(share and share > self.threshold),
                      "single_jurisdiction": one}

    def check(self) -> dict:
        got = self.report()
        if got["double_counted_rows"]:
            raise AssertionError(f"{self.name}: {got['double_counted_rows']:,} rows double count AP exposure")
        if self.single and not got["single_jurisdiction"]:
            raise AssertionError(f"{self.name}: jurisdictions from {got['first_jurisdiction']} to "
                                 f"{got['last_jurisdiction']} in one exhibit")
        return got
