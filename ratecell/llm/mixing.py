"""Mixing sources to target weights with hash-threshold histograms.

Size is the number of words (``[^\\x20\\x09-\\x0D]+``) of a text. The sources, by code point with
null last, weigh 3, 1, 2, 3, 1, 2, ... and share ``BUDGET`` times all words. A source takes at most
``CAP`` times its words; what it can't take is shared among the others by weight until none is
above. A target of t words of a source that has s takes every document t // s times, and once more
those whose hash lies below a threshold that is found as follows: words are summed by hash bucket
(the highest bits), the bucket in which the running sum passes the rest is split by its next bits,
and so on until one hash value is left; that last document is taken if this comes nearer to the
target. Nothing is sorted, and each level moves at most ``2**BITS`` sums for each source.

The hash is the first 36 bits of the MD5 of doc_id in decimal (null: of the empty string), then the
first 24 bits of the MD5 of the text (null: empty), so reruns agree, and rows without an id, or with one
id and different texts, are taken or left one by one. Only rows equal in both stay together. Null and empty
texts have size 0; they follow their source's threshold and take 0 words. An empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell.llm.common import free_name, global_index, written

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
BITS, LEVELS = 12, 5            # 60 bits of hash


def doc_hash(doc_id, text):
    by_id, by_text = (F.md5(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) for c in (doc_id, text))
    return F.conv(F.concat(F.substring(by_id, 1, 9), F.substring(by_text, 1, 6)), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, h for every document, written to the shared folder: a few bytes each,
    read by every later step instead of the texts."""
    s = docs.select("doc_id", F.col("source").cast("string").alias("source"),
                    F.regexp_count(F.coalesce(F.col("text").cast("string"), F.lit("")),
                                   F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size"),
                    doc_hash(F.col("doc_id"), F.col("text")).alias("h"))
    return written(s, "mix-sizes")


def targets(sized: DataFrame) -> DataFrame:
    """source, source_size, weight, target (double): one row per source."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = global_index(per, [F.col("source").asc_nulls_last()], "mix-sources", "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    per = written(rank.withColumn("weight", w).select("source", "source_size", "weight"), "mix-weights")
    total = per.agg(F.sum("source_size")).first()[0] or 0
    # Each round fixes the sources that reach their cap at the present rate; two sums come back.
    rate, capped = None, F.lit(False)
    while True:
        over, open_weight = per.agg(F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)),
                                    F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0))).first()
        if not open_weight:
            break
        new = (BUDGET * total - CAP * over) / open_weight
        if rate is not None and new <= rate:
            break
        rate = new
        capped = (CAP * F.col("source_size")).cast("double") < F.lit(rate) * F.col("weight")
    full = (CAP * F.col("source_size")).cast("double")
    return per.withColumn("target", full if rate is None else F.least(full, F.lit(rate) * F.col("weight")))


def thresholds(sized: DataFrame) -> DataFrame:
    """source, source_size, target, passes (how often all its documents are taken) and cut (those
    with a hash up to it are taken once more)."""
    t = targets(sized)
    s = F.col("source_size")
    passes = F.when(s > 0, F.floor(F.col("target") / s)).otherwise(0).cast("int")
    state = t.select("source", "source_size", "target", passes.alias("passes"),
                     (F.col("target") - passes * s).alias("rest"), F.lit(0).cast("long").alias("prefix"))
    state = written(state, "mix-level0")
    for level in range(LEVELS):
        shift = 60 - BITS * (level + 1)
        here = sized.join(state.select(F.col("source").alias("_s"), "prefix"), F.col("source").eqNullSafe(F.col("_s")))
        here = here.where(F.shiftright("h", shift + BITS) == F.col("prefix"))
        # Level 0 takes every document of the source; each later one those of the boundary bucket.
        hist = (here.groupBy("source", F.shiftright("h", shift).alias("b")).agg(F.sum("size").alias("n"))
                .groupBy("source").agg(F.sort_array(F.collect_list(F.struct("b", "n"))).alias("hist")))
        # The first bucket whose running sum passes the rest (the last one, if none does).
        walk = F.aggregate(
            "hist", F.struct(F.lit(None).cast("long").alias("b"), F.lit(0).cast("long").alias("below"),
                             F.lit(0).cast("long").alias("n"), F.lit(False).alias("done")),
            lambda a, x: F.when(a["done"], a).otherwise(F.struct(
                x["b"].alias("b"), (a["below"] + a["n"]).alias("below"), x["n"].alias("n"),
                ((a["below"] + a["n"] + x["n"]).cast("double") > F.col("rest")).alias("done"))))
        # The join key may be null: a source of its own.
        hist = hist.withColumnRenamed("source", "_s")
        state = (state.join(hist, F.col("source").eqNullSafe(F.col("_s")), "left").withColumn("w", walk)
                 .select("source", "source_size", "target", "passes",
                         (F.col("rest") - F.coalesce("w.below", F.lit(0))).alias("rest"),
                         F.coalesce("w.b", F.shiftleft("prefix", BITS)).alias("prefix"),
                         F.coalesce("w.n", F.lit(0)).alias("last")))
        state = written(state, f"mix-level{level + 1}")
    # One hash value is left: taken if the sum then comes nearer to the target.
    more = F.when(F.col("last") <= 2 * F.col("rest"), F.col("prefix")).otherwise(F.col("prefix") - 1)
    return state.select("source", "source_size", "target", "passes", more.alias("cut"))


def _times(h):
    return F.col("passes") + ((h <= F.col("cut")) & (F.col("passes") < CAP)).cast("int")


def mix_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document."""
    sized = sizes(docs)
    cut = thresholds(sized).withColumnRenamed("source", "_s")
    return (sized.join(cut, F.col("source").eqNullSafe(F.col("_s")))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * _times(F.col("h"))).alias("taken")))


def mix(docs: DataFrame) -> DataFrame:
    """The mix: each document as often as it is taken, columns unchanged. The thresholds, one row
    for each source, meet the documents; no row is sorted."""
    cut = thresholds(sizes(docs))
    src, n = free_name(docs, "_src"), free_name(docs, "_n")
    times = docs.select(F.col("*"), F.struct(doc_hash(F.col("doc_id"), F.col("text")).alias("h")).alias(n))
    got = times.join(cut.select(F.col("source").alias(src), F.struct("passes", "cut").alias(src + "c")),
                     F.col("source").cast("string").eqNullSafe(F.col(src)))
    count = F.col(f"{src}c.passes") + ((F.col(f"{n}.h") <= F.col(f"{src}c.cut"))
                                       & (F.col(f"{src}c.passes") < CAP)).cast("int")
    return (got.withColumn(n, count).where(F.col(n) > 0)
            .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))).drop(n, src, src + "c"))


# The same as a running sum in hash order.
ORACLE = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 9) || substr(md5(coalesce(text, '')), 1, 6))::BIGINT AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
  FROM d GROUP BY source),
-- sources by the rate at which they reach their cap; the rate if the first k of them are capped
r AS (
  SELECT *, coalesce(sum(source_size) OVER p, 0)::DOUBLE AS over, sum(weight) OVER () - coalesce(sum(weight) OVER p, 0) AS open_weight,
         sum(source_size) OVER ()::DOUBLE AS total
  FROM s
  WINDOW p AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
rate AS (
  -- capping too few or too many sources gives a lower rate
  SELECT max((1.5 * total - 2 * over) / open_weight) AS rate FROM r),
t AS (
  SELECT source, source_size, least(2 * source_size::DOUBLE, rate * weight) AS target FROM s, rate),
b AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::INT ELSE 0 END AS passes FROM t),
c AS (
  SELECT d.*, b.source_size, b.target, b.passes, b.target - b.passes * b.source_size AS rest,
         sum(size) OVER (PARTITION BY d.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS same
  FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source),
f AS (
  -- a document is taken if all up to it fit, or if it is the first that doesn't and taking it comes nearer
  SELECT *, passes < 2 AND (upto <= rest OR (upto - same <= rest AND same <= 2 * (rest - (upto - same)))) AS more FROM c)
SELECT doc_id, size, source_size, target, (size * (passes + more::INT))::BIGINT AS taken FROM f
"""
