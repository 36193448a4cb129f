"""Aggregate building blocks. All are hash aggregates with map-side partial
aggregation, so a hot group is pre-reduced in every task before the shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sums(cols: Iterable[str], nz_first: bool = False) -> list[Column]:
    """``sum(c) AS c`` per column (null-skipping; an all-null cell stays null)."""
    if nz_first:
        return [F.sum(F.coalesce(F.col(c), F.lit(0.0))).alias(c) for c in cols]
    return [F.sum(F.col(c)).alias(c) for c in cols]


def sum_by(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Project keys + measures and sum the measures by the keys."""
    return df.select(*keys, *measures).groupBy(*keys).agg(*sums(measures))


def weighted_mean_parts(value: str, weight: str) -> tuple[Column, Column]:
    """(sum of value times weight, sum of the weights that have a value): their ratio is the weighted mean
    over the rows that have both. A null takes no part; without any weight the second is null or 0."""
    v, w = F.col(value), F.col(weight)
    return F.sum(v * w), F.sum(F.nvl2(v, w, F.lit(None).cast("double")))


def count_rows() -> Column:
    return F.count(F.lit(1))


def distinct_and_flagged(key: str, flag: str) -> tuple[Column, Column]:
    """(exact distinct keys, exact distinct keys whose coalesced flag is 1)."""
    return (F.count_distinct(F.col(key)),
            F.count_distinct(F.when(F.coalesce(F.col(flag), F.lit(0)) == 1, F.col(key))))


def explode_levels(variables: Sequence[str], index: str = "_var", level: str = "level_value") -> list[Column]:
    """``posexplode`` of the variables' values as text: one (variable index, level)
    row per variable. N variables aggregate in ONE pass (one scan, one shuffle)
    instead of N aggregates + unions. The integer index keeps the grouping key
    narrow; ``variable_names`` turns it back into the name after aggregation."""
    return [F.posexplode(F.array(*[F.col(v).cast("string") for v in variables])).alias(index, level)]


def variable_names(variables: Sequence[str], index: str = "_var") -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in variables]), F.col(index) + 1)


def distinct_flagged_by(df: DataFrame, keys: Sequence[str], key: str, flag: str,
                        total: str, flagged: str) -> DataFrame:
    """Exact ``count(distinct key)`` and ``count(distinct key where flag = 1)`` per
    ``keys``, as two plain aggregates: first one row per (keys, key) with the
    max flag (partial aggregation collapses repeats inside every task), then a
    count and a sum. Same result as two ``count_distinct``s without the Expand
    that doubles every row before the shuffle."""
    per_key = (df.groupBy(*keys, key)
               .agg(F.max(F.when(F.coalesce(F.col(flag), F.lit(0)) == 1, 1).otherwise(0)).alias("_f"))
               .filter(F.col(key).isNotNull()))
    return per_key.groupBy(*keys).agg(F.count(F.lit(1)).alias(total),
                                      F.sum("_f").cast("long").alias(flagged))


def distinct_flagged_levels(df: DataFrame, group: str, variables: Sequence[str], key: str, flag: str, total: str,
                            flagged: str, buckets: int) -> DataFrame:
    """``distinct_flagged_by`` of the cells (``group``, variable index, level) that ``explode_levels`` makes, for
    keys of which none holds so many rows that they should not meet in one array (``key_buckets``). Rows are moved once, by
    key into ``buckets`` partitions. A key's rows in a group are gathered and each variable's levels made distinct there, so that what is
    multiplied has no repeats and no state is kept per cell and key."""
    levels = [F.col(v).cast("string").alias(f"v{i}") for i, v in enumerate(variables)]
    rows = df.select(group, key, flag, *variables).where(F.col(key).isNotNull()).repartition(buckets, key)
    rows = rows.select(group, key, F.struct((F.coalesce(F.col(flag), F.lit(0)) == 1).alias("f"), *levels).alias("_row"))
    found = rows.groupBy(group, key).agg(F.collect_list("_row").alias("_all"),
                                         F.count_if("_row.f").alias("_f")).withColumn("_rows", F.size("_all"))

    def sets(n: Column, m: Column, of: Column) -> Column:
        return F.struct(n.alias("_n"), m.alias("_m"),
                        F.array(*[F.array_distinct(of.getField(f"v{i}")) for i in range(len(levels))]).alias("_sets"))

    whole = sets(F.lit(1), (F.col("_f") == F.col("_rows")).cast("int"), F.col("_all"))
    part = sets(F.lit(0), F.lit(1), F.filter("_all", lambda r: r["f"]))
    mixed = (F.col("_f") > 0) & (F.col("_f") < F.col("_rows"))
    d = found.select(group, F.inline(F.when(mixed, F.array(whole, part)).otherwise(F.array(whole))))
    d = d.select(group, "_n", "_m", F.posexplode("_sets").alias("_var", "_set"))
    d = d.select(group, "_var", "_n", "_m", F.explode("_set").alias("level_value"))
    return d.groupBy(group, "_var", "level_value").agg(F.sum("_n").alias(total), F.sum("_m").alias(flagged))


KEY_SLOTS, KEY_ROWS, BUCKET_ROWS = 4096, 10_000, 500_000


def key_buckets(df: DataFrame, key: str) -> int | None:
    """Into how many partitions to move the rows by ``key``, with about ``BUCKET_ROWS`` at most in one; ``None`` where a
    key may hold very many rows: a slot of hashed keys has more than twice the mean and ``KEY_ROWS``."""
    n = (df.select(key).where(F.col(key).isNotNull()).groupBy(F.pmod(F.xxhash64(key), F.lit(KEY_SLOTS)).alias("slot"))
         .agg(F.count(F.lit(1)).alias("n")))
    rows, most = n.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    return None if most > 2 * rows / KEY_SLOTS + KEY_ROWS else _buckets(df, rows)


def _buckets(df: DataFrame, rows: int) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return partitions * max(1, -(-rows // (BUCKET_ROWS * partitions)))


RANGE, WORDS = 32_768, 8


def distinct_flagged_bitmaps(df: DataFrame, keys: Sequence[str], key: str, flag: str, total: str, flagged: str,
                             explode: Sequence[Column] = (), keep: Sequence[str] = ()) -> DataFrame:
    """``distinct_flagged_by`` with bitmaps as states. The rows are moved once, before they are multiplied, by
    ranges of hashed keys with about 32,768 keys at most. In a range the distinct keys are numbered, so that a
    cell's keys are bits of bitmaps of ``WORDS`` times 64 numbers, and a cell's counts are bit counts. The bitmaps'
    words are plain columns, which a hash aggregate updates in place: the multiplied rows are neither sorted nor moved.

    ``explode``: generators applied after the numbering (as ``explode_levels`` gives), so that rows get
    their numbers before they are multiplied; ``keep``: the columns they and the ``keys`` need.
    """
    rows = df.select(*dict.fromkeys([*keep, *[c for c in keys if c in df.columns], key, flag])).where(F.col(key).isNotNull())
    n = rows.select(key).count()
    buckets, ranges = _buckets(df, n), max(1, -(-n // RANGE))          # of rows: there are no more keys
    rows = rows.withColumn("_range", F.pmod(F.xxhash64(key), F.lit(ranges))).repartition(buckets, "_range")
    number = F.dense_rank().over(Window.partitionBy("_range").orderBy(key)) - 1
    rows = rows.withColumn("_number", number).withColumn("_flagged", F.coalesce(F.col(flag), F.lit(0)) == 1)
    bits = [c for c in keys if c in rows.columns]
    rows = rows.select(*bits, "_range", F.expr(f"_number div {64 * WORDS}").alias("_block"),
                       F.expr(f"_number div 64 % {WORDS}").alias("_word"), "_flagged",
                       F.expr("shiftleft(1L, _number % 64)").alias("_bit"), *explode)
    words = [F.when(F.col("_word") == w, F.col("_bit")).otherwise(F.lit(0).cast("long")) for w in range(WORDS)]
    none = F.lit(0).cast("long")
    maps = rows.groupBy(*keys, "_range", "_block").agg(
        *[F.bit_or(w).alias(f"_a{i}") for i, w in enumerate(words)],
        *[F.bit_or(F.when(F.col("_flagged"), w).otherwise(none)).alias(f"_f{i}") for i, w in enumerate(words)])

    def size(which: str) -> Column:
        return F.sum(reduce(add, [F.bit_count(f"{which}{i}") for i in range(WORDS)]))

    return maps.groupBy(*keys).agg(size("_a").alias(total), size("_f").alias(flagged))
