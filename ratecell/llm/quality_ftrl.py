"""Quality classifier: logistic regression over hashed word n-grams, learned with
follow-the-regularised-leader (FTRL-proximal) updates and scored as a sparse dot product.

Tokens are runs of letters and digits, or runs of ASCII punctuation, of the lower-cased text;
features are tokens, pairs of neighbouring tokens, and "the same token again" (next, or next but
one), hashed to ``2**BITS`` slots. A text with n
features has the value 1/sqrt(n) for each occurrence, so that length does not decide.

Learning uses at most about ``MAX_LABELLED`` labelled texts (a documented bound: a hash of doc_id
picks them), in shards of ``SHARD`` texts; the shards' weights are averaged. Scoring reads every
whole text. An empty or null text has no feature and scores the learned bias. Without a usable
label the model is None and every score is 0.5. Repeated rows score alike; several labels of one
document count as their mean, from 0.5 up as 1; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell.llm.common import MARKS, drop_tables, free_name, held_out, mix, ship, slices, texts, token_hashes

BITS = 18
MAX_LABELLED = 16384
SHARD = 2048
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
THRESHOLD = 0.7
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_AGAIN = mix(np.array([1, 2], np.uint64))
_SHIFT = np.uint64(64 - BITS)


def features(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature slots of the texts, sorted by text, and each text's number of features."""
    h, doc = token_hashes([t.lower().encode("utf-8", "replace") for t in docs], MARKS)
    pair = mix(h[:-1] * _PAIR + h[1:])
    same = doc[:-1] == doc[1:]
    # A token that follows itself, or follows itself after one other, is one n-gram whatever the token.
    again = [np.flatnonzero((h[:-k] == h[k:]) & (doc[:-k] == doc[k:])) for k in (1, 2)]
    slot = np.concatenate([h, pair[same]] + [np.full(len(x), _AGAIN[k]) for k, x in enumerate(again)]) >> _SHIFT
    doc = np.concatenate([doc, doc[:-1][same]] + [doc[x] for x in again])
    order = np.argsort(doc, kind="stable")
    return slot[order].astype(np.int64), np.bincount(doc, minlength=len(docs))


def learn(docs: list[str], labels: list[int]) -> np.ndarray:
    """FTRL-proximal over the texts, ``EPOCHS`` times; weights, the last one is the bias."""
    size = 1 << BITS
    z, n, w = np.zeros(size + 1), np.zeros(size + 1), np.zeros(size + 1)
    rows = []
    for a, b in slices(len(docs), [len(t) for t in docs]):
        slot, count = features(docs[a:b])
        at = np.cumsum(count) - count
        for i, k in enumerate(count):
            u, c = np.unique(slot[at[i]:at[i] + k], return_counts=True)
            rows.append((np.append(u, size).astype(np.int32),
                         np.append(c / np.sqrt(max(k, 1)), 1.0).astype(np.float32)))
    rng = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            u, x = rows[i]
            zu, nu = z[u], n[u]
            wu = np.where(np.abs(zu) <= L1, 0.0,
                          -(zu - np.sign(zu) * L1) / ((BETA + np.sqrt(nu)) / ALPHA + L2))
            p = 1.0 / (1.0 + np.exp(-np.clip(wu @ x, -35, 35)))
            g = (p - labels[i]) * x
            sigma = (np.sqrt(nu + g * g) - np.sqrt(nu)) / ALPHA
            z[u] = zu + g - sigma * wu
            n[u] = nu + g * g
    on = np.abs(z) > L1
    w[on] = -(z[on] - np.sign(z[on]) * L1) / ((BETA + np.sqrt(n[on])) / ALPHA + L2)
    return w


def train(docs: DataFrame, labels: DataFrame) -> np.ndarray | None:
    """Weights from the labelled documents that are not held out."""
    spark = docs.sparkSession
    ship(spark)
    marked = (labels.select("doc_id", F.col("quality").cast("double").alias("y"))
              .where("doc_id IS NOT NULL AND y IS NOT NULL").where(~held_out())
              .groupBy("doc_id").agg((F.avg("y") >= 0.5).cast("int").alias("y")))
    total = marked.count()
    if not total:
        return None
    keep = marked.where(F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("fit")), F.lit(1 << 30))
                        < int((1 << 30) * min(1.0, MAX_LABELLED / total)))
    shards = -(-min(total, MAX_LABELLED) // SHARD)

    def fit(pdf):
        drop_tables()
        pdf = pdf.sort_values(["doc_id", "text"])       # the same order wherever the task runs
        return pd.DataFrame({"n": [len(pdf)], "w": [learn(pdf.text.tolist(), pdf.y.tolist()).tobytes()]})

    # The sample's ids are bounded by MAX_LABELLED, so they may be broadcast.
    got = (texts(docs).join(F.broadcast(keep), "doc_id")
           .withColumn("shard", F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("shard")), F.lit(shards)))
           .groupBy("shard").applyInPandas(fit, "n long, w binary").collect())
    if not got:
        return None
    return sum(r.n * np.frombuffer(r.w) for r in got) / sum(r.n for r in got)


def scorer(weights: np.ndarray | None):
    """Pandas UDF: text -> score."""
    w = None if weights is None else weights.astype(np.float32)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        drop_tables()
        docs = text.fillna("").tolist()
        if w is None:
            return pd.Series(np.full(len(docs), 0.5))
        out = np.empty(len(docs))
        for a, b in slices(len(docs), [len(t) for t in docs]):
            slot, count = features(docs[a:b])
            hit = np.concatenate([[0.0], np.cumsum(w[slot], dtype=np.float64)])
            end = np.cumsum(count)
            dot = (hit[end] - hit[end - count]) / np.sqrt(np.maximum(count, 1)) + w[-1]
            out[a:b] = 1.0 / (1.0 + np.exp(-np.clip(dot, -35, 35)))
        return pd.Series(out)

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    model = train(docs, labels)
    s = texts(docs).select("doc_id", held_out().alias("held_out"), scorer(model)("text").alias("score"))
    return s.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches ``THRESHOLD``, all columns unchanged; all of them if
    there is nothing to learn from."""
    model = train(docs, labels)
    if model is None:
        return docs
    c = free_name(docs, "_quality")
    return docs.withColumn(c, scorer(model)("text")).where(F.col(c) >= THRESHOLD).drop(c)
