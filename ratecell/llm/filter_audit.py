"""Filter interaction audit: what each of five filters removes, in every order of applying them.

The failure conditions of a text (words are maximal runs of characters other than ASCII white space):

* A: fewer than 200 words;
* B: fewer than half of its words are distinct (case-sensitive);
* C: more than 3 % of its code points are A to Z;
* D: it holds any of # $ % & * |;
* E: a document of a smaller doc_id has the same text.

Every part (a language; null counts as the empty string) gets one contingency tensor of shape
2 x 2 x 2 x 2 x 2: the number of its documents by pass or fail of each filter, and the same for good
and for toxic documents. Spark makes the counts; at most 32 cells a part remain, which become the
tensor. For each of the 120 orders and 5 steps, an einsum selects pass, fail or all along each axis:
earlier filters pass and the step's own fails (removed), the same with its own passing (kept), its own
fails and the rest is free (failures, of which those not removed here are redundant), its own fails and
the others pass (unique failures). The Shapley sum of a filter adds its removals over all orders.

A to D depend on the text alone and E on the smallest doc_id of the text, so rows are counted by
text digest (SHA-256) and label first, with partial sums in every task. Copies of one text, however
many, are thus a few rows by the time they meet, and no step holds the documents of a group.

Null texts count as empty: they fail A only (and E). A null doc_id is neither smaller nor larger than
any other, so it never fails E and has no label. Rows that repeat a doc_id with the same text don't fail
E by each other. A document is good (toxic) if any label row of its doc_id says so; label rows without
a document are ignored. An empty table has no part and gives no row. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ratecell.llm.common import ship, texts

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT = 50          # per cent of the words
MAX_CAPITALS = 3           # per cent of the code points
WORD = r"[^\x20\x09-\x0D]+"
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_failures(text: Column) -> list[Column]:
    """The conditions that a text meets or not by itself, A to D."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return [F.size(words) < MIN_WORDS,
            F.size(F.array_distinct(words)).cast("long") * 100 < F.size(words).cast("long") * MIN_DISTINCT,
            capitals * 100 > F.length(text).cast("long") * MAX_CAPITALS,
            text.rlike(r"[#$%&*|]")]


def label_flags(labels: DataFrame) -> DataFrame:
    """label_id, good, toxic: one row per labelled doc_id."""
    return (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("label_id"))
            .agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"),
                 F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic")))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (bit i: fails filter i), n, good, toxic: the non-empty cells of every tensor."""
    bits = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(F.col("text")))]
    t = texts(docs, "lang").select("doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                                   sum(bits[1:], bits[0]).alias("mask"),
                                   F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))
    t = t.groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n"))
    # Rows without an id have no label; a hash of their own spreads them over the join's tasks.
    t = t.withColumn("no_id", F.col("doc_id").isNull())
    t = t.withColumn("key", F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("digest", "part")))
    known = label_flags(labels).select(F.col("label_id").cast("long").alias("key"), F.lit(False).alias("no_id"), "good", "toxic")
    t = (t.join(known, ["key", "no_id"], "left")
         .fillna(False, ["good", "toxic"]))
    # Of each text: the rows of its smallest id pass E, and so do those without an id.
    g = (t.groupBy("digest", "mask", "part", "good", "toxic")
         .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("no_id"), F.col("n")).otherwise(0)).alias("without"),
              F.min(F.when(~F.col("no_id"), F.struct("doc_id", "n"))).alias("first")))
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    g = g.withColumn("passing", F.col("without") + F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0))
    by_e = F.inline(F.array(F.struct(F.col("mask").alias("m"), F.col("passing").alias("k")),
                            F.struct((F.col("mask") + 16).alias("m"), (F.col("n") - F.col("passing")).alias("k"))))
    counted = g.select("part", "good", "toxic", by_e).where("k > 0")
    return (counted.groupBy("part", F.col("m").alias("mask"))
            .agg(F.sum("k").alias("n"), F.sum(F.when(F.col("good"), F.col("k")).otherwise(0)).alias("good"),
                 F.sum(F.when(F.col("toxic"), F.col("k")).otherwise(0)).alias("toxic")))


# --- tensors ----------------------------------------------------------------------------------------

PASS, FAIL, ANY = np.array([[1, 0], [0, 1], [1, 1]])
ORDERS = ["".join(p) for p in permutations(FILTERS)]


def select(tensor: np.ndarray, selectors: np.ndarray) -> np.ndarray:
    """Sums of a stack of tensors (z, 2, 2, 2, 2, 2) for each row of ``selectors`` (n, 5, 2): which of
    pass and fail counts along each axis. Shape (z, n)."""
    return np.einsum("zabcde,na,nb,nc,nd,ne->zn", tensor, *(selectors[:, i] for i in range(5)))


def selectors(own: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """For every order and step: ``own`` along the step's filter, ``before`` along those applied earlier,
    ``after`` along those still to come."""
    out = np.empty((len(ORDERS) * 5, 5, 2), np.int64)
    for n, (order, step) in enumerate((o, s) for o in ORDERS for s in range(5)):
        for place, letter in enumerate(order):
            out[n, FILTERS.index(letter)] = own if place == step else before if place < step else after
    return out


def audit_part(tensor: np.ndarray) -> pd.DataFrame:
    """All 600 rows of one part from its tensors of all, good and toxic documents."""
    removed, good, toxic = select(tensor, selectors(FAIL, PASS, ANY))
    every = tensor[:1]
    out = pd.DataFrame({"filter_order": np.repeat(ORDERS, 5), "step": np.tile(np.arange(1, 6, dtype=np.int32), len(ORDERS)),
                        "kept": select(every, selectors(PASS, PASS, ANY))[0], "removed": removed,
                        "redundant": select(every, selectors(FAIL, ANY, ANY))[0] - removed,
                        "unique_fails": select(every, selectors(FAIL, PASS, PASS))[0],
                        "good_lost": good, "toxic_lost": toxic})
    letter = np.array([o[s] for o in ORDERS for s in range(5)])
    out["shapley"] = out.groupby(letter)["removed"].transform("sum")
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley."""
    ship(docs.sparkSession)

    def run(key, found):
        tensor = np.zeros((3, 32), np.int64)
        tensor[:, found["mask"]] = found[["n", "good", "toxic"]].to_numpy(np.int64).T
        # bit 0 is filter A: the last axis of a C-ordered tensor, so the axes are turned round
        out = audit_part(tensor.reshape(3, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1))
        out.insert(0, "part", key[0])
        return out

    return cells(docs, labels).groupBy("part").applyInPandas(run, SCHEMA)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels GROUP BY doc_id),
w AS (
  SELECT doc_id, part, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS least
  FROM d),
f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         (CASE WHEN len(words) < 200 THEN 'A' ELSE '' END
          || CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END
          || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text) THEN 'C' ELSE '' END
          || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
          || CASE WHEN w.doc_id > least THEN 'E' ELSE '' END) AS fails
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
m AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM x a, x b, x c, x d, x e
  WHERE a.x <> b.x AND a.x <> c.x AND a.x <> d.x AND a.x <> e.x AND b.x <> c.x AND b.x <> d.x AND b.x <> e.x
    AND c.x <> d.x AND c.x <> e.x AND d.x <> e.x),
s AS (SELECT unnest([1, 2, 3, 4, 5]) AS step),
g AS (
  SELECT part, filter_order, step, fails, n, good, toxic, substr(filter_order, step, 1) AS own,
         CASE WHEN instr(fails, substr(filter_order, 1, 1)) > 0 THEN 1 WHEN instr(fails, substr(filter_order, 2, 1)) > 0 THEN 2
              WHEN instr(fails, substr(filter_order, 3, 1)) > 0 THEN 3 WHEN instr(fails, substr(filter_order, 4, 1)) > 0 THEN 4
              WHEN instr(fails, substr(filter_order, 5, 1)) > 0 THEN 5 ELSE 6 END AS gone
  FROM m, o, s),
r AS (
  SELECT part, filter_order, step, own,
         sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept, sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone < step AND instr(fails, own) > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM g GROUP BY part, filter_order, step, own),
h AS (SELECT part, own, sum(removed) AS shapley FROM r GROUP BY part, own)
SELECT r.part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, shapley::BIGINT AS shapley
FROM r JOIN h ON r.part = h.part AND r.own = h.own
"""
