"""Group totals on every row, one row per group, row ids.

A window over ``partitionBy(vehicle)`` puts every row of a vehicle in one task;
a hot key then becomes one straggler. The default here is the aggregate form
(partial sums per task, one row per key after the shuffle) joined back; the rows'
side of that join comes straight from its exchange unless the input is itself a
join or aggregate on the same keys (write such an input first). The window form is kept for parity and for
callers who know their keys are small.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecell.sources.sinks import materialize


def group_totals(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column]) -> DataFrame:
    """One row per key with ``name -> sum(expr)``."""
    return df.groupBy(*keys).agg(*[F.sum(e).alias(n) for n, e in totals.items()])


def with_group_totals(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column],
                      method: str = "join") -> DataFrame:
    """Every row gets its group's totals. ``method='window'`` uses one shared
    unordered window (one Window node, one exchange); ``'join'`` aggregates and
    joins back on null-safe keys, so that null is a group like any other, as in a window."""
    if method == "window":
        w = Window.partitionBy(*keys)
        return df.withColumns({n: F.sum(e).over(w) for n, e in totals.items()})
    t = group_totals(df, keys, totals).withColumnsRenamed({k: f"_group_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys]
    return df.join(t, on, "left").drop(*[f"_group_{k}" for k in keys])


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    where: Column | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order`` values (ties broken by
    the remaining columns), optionally among rows matching ``where``.

    Done as ``min(struct(order..., rest...))`` per key - an aggregate with a
    partial phase, so a hot key is reduced in every task before the shuffle and
    never buffered whole in one task as ``row_number()`` over a window would.
    """
    rest = [c for c in df.columns if c not in set(keys) | set(order)]
    packed = F.struct(*[F.col(c) for c in list(order) + rest])
    if where is not None:
        packed = F.when(where, packed)
    picked = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return picked.filter(F.col("_first").isNotNull()).select(
        *keys, *[F.col(f"_first.{c}").alias(c) for c in list(order) + rest])


def row_index(df: DataFrame, name: str = "index_id", order: Sequence[str] = ()) -> DataFrame:
    """Row numbers without a single-partition sort.

    With ``order`` they are 1..N in that order: a range-partitioned sort, written once so that its
    partitions stay as they are; then each partition's offset from the partitions' row counts (one row
    per partition). Rows equal in ``order`` are numbered one after another in either order. Without
    ``order`` they are unique 64-bit ids, not consecutive.
    """
    if not order:
        return df.withColumn(name, F.monotonically_increasing_id())
    place, part, first = "_place", "_part", "_first"
    rows = materialize(df.orderBy(*order).withColumn(place, F.monotonically_increasing_id()), "row_index")
    of_part = F.shiftright(place, 33)           # the id holds the partition above, the row below
    sizes = rows.groupBy(of_part.alias(part)).agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(part, (F.sum("_n").over(Window.orderBy(part)) - F.col("_n")).alias(first))
    numbered = rows.withColumn(part, of_part).join(starts, part)
    row = F.col(place).bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.select(*df.columns, (F.col(first) + row + 1).alias(name))


# A group with more than this share of all rows is hot; so there are fewer hot groups than its inverse.
HOT_SHARE = 1 / 500
SALTS = 64


def with_group_totals_split(df: DataFrame, keys: Sequence[str], totals: Mapping[str, Column],
                            hot_share: float = HOT_SHARE, bucketed: tuple[str, int] | None = None) -> DataFrame:
    """``with_group_totals`` where one group may hold a large part of all rows.

    The totals are written with their groups' sizes. Those of hot groups, at most ``1 / hot_share``, are
    broadcast to the rows; all other rows join their totals by key. In that join the rows of hot groups are
    spread over ``SALTS`` salts that no total has, so that no task gets a hot group whole. ``df`` should be
    a written table or a cheap plan: its rows are read twice.

    ``bucketed=(key, buckets)``: ``df`` is a written table bucketed so on one of the keys, which has no nulls
    and no hot value. The totals are then written alike, and summed and joined without an exchange.
    """
    n = "_group_rows"
    # The salt of totals is written with them: a literal would be folded out of the join's keys.
    t = materialize(df.groupBy(*keys).agg(*[F.sum(e).alias(x) for x, e in totals.items()], F.count(F.lit(1)).alias(n))
                    .withColumn("salt", F.lit(0)), "group_totals", bucketed)
    rows = t.agg(F.sum(n)).first()[0] or 0
    limit = rows * hot_share

    def side(part: DataFrame, tag: str) -> DataFrame:
        return part.select(*[F.col(k).alias(f"{tag}{k}") for k in keys], *[F.col(x).alias(f"{tag}{x}") for x in totals],
                           F.col("salt").alias(f"{tag}salt"))

    def same(tag: str) -> Column:
        # A null-safe comparison is not on the bucketed column itself, so its join would move the rows.
        plain = {bucketed[0]} if bucketed else set()
        pairs = [(k, F.col(k), F.col(f"{tag}{k}")) for k in keys]
        return reduce(lambda a, b: a & b, [x == y if k in plain else x.eqNullSafe(y) for k, x, y in pairs])

    hot, cold = side(t.where(F.col(n) > limit), "_hot_"), side(t.where(F.col(n) <= limit), "_cold_")
    d = df.join(F.broadcast(hot), same("_hot_"), "left")
    spread = (F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)) + 1).cast("int")
    d = d.withColumn("_salt", F.when(F.col("_hot_salt").isNotNull(), spread).otherwise(0))
    d = d.join(cold, same("_cold_") & (F.col("_salt") == F.col("_cold_salt")), "left")
    return d.select(*df.columns, *[F.coalesce(f"_hot_{x}", f"_cold_{x}").alias(x) for x in totals])
