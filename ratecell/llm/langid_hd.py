"""Language identification with hyperdimensional profiles.

Every letter (and the gap between words) has a random vector of +1 and -1. A trigram is bound as
the product of its letters' vectors, rotated by two, one and no places; a text's vector is the
bundle (sum) of its trigrams' vectors, and a language's prototype the sum of its texts' unit
vectors. A text gets the language whose prototype has the largest cosine (ties: the first name).

Two bounds tell whether a text resembles its language. Its cosine must be out of the noise: unrelated
texts have cosines of standard deviation 1 / sqrt(``DIM``). Random letters of a learned alphabet hit
some trigrams of the language, and the more of them, the larger their cosine; so the mean product of
a trigram with the prototype must be ``MIN_SHARE`` of its mean in the language's learning texts.

Prototypes are learned from at most about ``MAX_PER_LANG`` texts of each language (a documented
bound; a hash of doc_id picks them), summed per partition before they reach the driver. Every
whole text is scored. A text that is null or has no letter is ``und`` with score 0; without any
labelled text all are ``und``. Repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell.llm.common import drop_tables, free_name, held_out, ship, slices, texts

DIM = 4096
SEED = 11
MAX_PER_LANG = 2000
MIN_SCORE = 4 / DIM ** 0.5
MIN_SHARE = 0.25
_GAP = 32
_LETTER = None
_VECTORS: dict[int, np.ndarray] = {}


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return _LETTER


def letter_vector(code: int) -> np.ndarray:
    v = _VECTORS.get(code)
    if v is None:
        if len(_VECTORS) > 20000:
            _VECTORS.clear()
        v = np.random.default_rng([SEED, int(code)]).integers(0, 2, DIM).astype(np.int8) * 2 - 1
        _VECTORS[code] = v
    return v


def trigrams(text: str) -> np.ndarray:
    """Trigrams over lower-cased letters, each gap between words as one symbol, as 63-bit codes."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    letter = _letters()[code]
    if not letter.any():
        return np.zeros(0, np.int64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]                       # the first non-letter after a letter stands for the gap
    s = np.concatenate([[_GAP], np.where(letter, code, _GAP)[keep], [_GAP]])
    return (s[:-2] << 42) | (s[1:-1] << 21) | s[2:]


def vectors(docs: list[str]) -> np.ndarray:
    """One bundled vector per text."""
    return bundles(docs)[0]


def bundles(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One bundled vector per text, and its number of trigrams."""
    out = np.zeros((len(docs), DIM), np.float32)
    grams = [trigrams(t) for t in docs]
    size = np.fromiter(map(len, grams), np.int64, len(grams))
    if not size.sum():
        return out, size
    all_grams, at = np.unique(np.concatenate(grams), return_inverse=True)
    row = np.repeat(np.arange(len(docs)), size)
    mask = (1 << 21) - 1
    sym, inv = np.unique(np.concatenate([all_grams >> 42, (all_grams >> 21) & mask, all_grams & mask]),
                         return_inverse=True)
    base = np.stack([letter_vector(c) for c in sym])
    i, j, k = inv.reshape(3, -1)
    two, one = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    for a in range(0, len(all_grams), 1024):        # bounded blocks of trigrams, whatever the alphabet
        b = min(a + 1024, len(all_grams))
        hit = (at >= a) & (at < b)
        counts = np.bincount(row[hit] * (b - a) + at[hit] - a, minlength=len(docs) * (b - a))
        bound = two[i[a:b]]
        bound *= one[j[a:b]]
        bound *= base[k[a:b]]
        out += counts.reshape(len(docs), b - a).astype(np.float32) @ bound.astype(np.float32)
    return out, size


def _unit(v: np.ndarray) -> np.ndarray:
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def _batches(docs: list[str]):
    """Row ranges of at most 64 texts and about 400,000 letters."""
    for a, b in slices(len(docs), [max(len(t), 6250) for t in docs], 400_000):
        yield a, b


def train(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Language names in order, their unit prototypes, and the mean product of a trigram of their
    learning texts with them."""
    spark = docs.sparkSession
    ship(spark)
    known = docs.where(F.col("lang").isNotNull()).where(~held_out())
    per = {r["lang"]: r["n"] for r in known.groupBy(F.col("lang").cast("string").alias("lang"))
           .agg(F.count("*").alias("n")).collect()}        # one row per language
    if not per:
        return [], np.zeros((0, DIM), np.float32), np.zeros(0)
    share = F.create_map(*[F.lit(x) for k, n in sorted(per.items())
                           for x in (k, int((1 << 30) * min(1.0, MAX_PER_LANG / n)))])
    pick = (texts(known, F.col("lang").cast("string").alias("lang"))
            .where(F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("fit")), F.lit(1 << 30)) < share[F.col("lang")])
            .select("lang", "text"))

    def bundle(batches):
        drop_tables()
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, docs_ = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in _batches(docs_):
                v, n = bundles(docs_[a:b])
                # unit vectors, means of the trigrams' vectors, texts with a trigram
                rows = np.hstack([_unit(v), v / np.maximum(n, 1)[:, None], (n > 0)[:, None]])
                for lang, x in zip(langs[a:b], rows):
                    total[lang] = total.get(lang, 0) + x.astype(np.float64)
        yield pa.RecordBatch.from_pydict({"lang": list(total), "v": [v.tolist() for v in total.values()]},
                                         pa.schema([("lang", pa.string()), ("v", pa.list_(pa.float64()))]))

    summed = (pick.mapInArrow(bundle, "lang string, v array<double>")
              .select("lang", F.posexplode("v").alias("i", "x"))
              # decimals add up alike in any order, so reruns agree
              .groupBy("lang", "i").agg(F.sum(F.col("x").cast("decimal(28,9)")).cast("double").alias("x"))
              .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")))
    got = sorted((r["lang"], [e["x"] for e in r["v"]]) for r in summed.collect())
    if not got:
        return [], np.zeros((0, DIM), np.float32), np.zeros(0)
    sums = np.array([v for _, v in got])
    proto = _unit(sums[:, :DIM])
    own = (sums[:, DIM:2 * DIM] * proto).sum(axis=1) / np.maximum(sums[:, 2 * DIM], 1)
    return [k for k, _ in got], proto.astype(np.float32), own


def predictor(model: tuple[list[str], np.ndarray, np.ndarray]):
    """Pandas UDF: text -> (lang, score, share); share: its trigrams' mean product with the
    prototype, as a multiple of that of the language's learning texts."""

    names, proto, own = model

    @F.pandas_udf("lang string, score double, share double")
    def predict(text: pd.Series) -> pd.DataFrame:
        drop_tables()
        docs = text.fillna("").tolist()
        lang, score, share = np.full(len(docs), "und", dtype=object), np.zeros(len(docs)), np.zeros(len(docs))
        for a, b in _batches(docs) if names else ():
            v, n = bundles(docs[a:b])
            some = np.abs(v).any(axis=1)
            cos = _unit(v) @ proto.T
            best = cos.argmax(axis=1)
            lang[a:b] = np.where(some, np.array(names, dtype=object)[best], "und")
            top = cos[np.arange(b - a), best]
            score[a:b] = np.where(some, np.clip(top, 0.0, 1.0), 0.0)
            share[a:b] = top * np.linalg.norm(v, axis=1) / np.maximum(n, 1) / np.maximum(own[best], 1e-12)
        return pd.DataFrame({"lang": lang, "score": score, "share": share})

    return predict


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document."""
    p = texts(docs).select("doc_id", predictor(train(docs))("text").alias("p"))
    return p.select("doc_id", held_out().alias("held_out"), F.col("p.lang").alias("lang_pred"),
                    F.col("p.score").alias("score"))


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents that resemble a learned language (cosine of ``MIN_SCORE`` and share of
    ``MIN_SHARE`` or more), all columns unchanged; all of them if there is nothing to learn from."""
    model = train(docs)
    if not model[0]:
        return docs
    c = free_name(docs, "_language")
    return docs.withColumn(c, predictor(model)("text")).where((F.col(f"{c}.score") >= MIN_SCORE) & (F.col(f"{c}.share") >= MIN_SHARE)).drop(c)
