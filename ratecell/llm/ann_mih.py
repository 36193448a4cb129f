"""Nearest neighbours by multi-index hashing over learned rotated binary codes.

Codes: vectors are centred and turned by ``ROTATIONS`` rotations that iterative quantisation learns
from at most ``SAMPLE`` vectors (a documented bound; a hash of the id picks them); the signs are the
code's bits. Index: a code is cut into substrings of 16 bits, each with a directory of its values
and the rows that have them. Probing: a code within Hamming radius r of the query's has, in one of
the first r mod m + 1 substrings, at most floor(r / m) bits different, or in one of the others at
most floor(r / m) - 1 (pigeonhole); the rows in those cells are candidates, and those whose whole
code lies within r are reranked by the Euclidean distance of the original vectors in double
precision. The radius is the one within which the sample's queries have ``COVER`` of their true
neighbours; where a block holds fewer than k rows within it, it is widened until there are k.

Every row is indexed, in blocks dealt by a hash of the id: a ``BLOCKS``-th of the rows, at least ``BLOCK_ROWS``
and at most as many as fit in ``BLOCK_BYTES``. A row is shuffled once, to its block, and a block's index is
built once; the stated queries follow it in the same sorted partition, so a task holds one block and one
Arrow batch of queries. A query is shuffled once for each block (``BLOCKS`` times, until blocks have reached
``BLOCK_BYTES``), which answers with k rows, and the k nearest of all are kept; ties go to the smaller id.
Equal or crowded vectors are spread like any others.

Vectors that are null, zero, of another length than most, or that hold a null or non-finite number
take no part, nor do rows with a null id. Of rows that repeat an id the smallest vector counts. A
query is never its own neighbour. With fewer than k other rows all are returned. Extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratecell.llm.common import ship, written

BITS_IN_PART = 16
ROTATIONS = 4
SAMPLE = 4096
COVER = 0.99
BLOCKS = 64
BLOCK_ROWS = 8192
BLOCK_BYTES = 64 << 20
ITERATIONS = 30


class Codes:
    """Learned rotations; vectors -> 16-bit substrings of their codes."""

    def __init__(self, sample: np.ndarray, seed: int = 5):
        self.mean = sample.mean(axis=0)
        x = sample - self.mean
        dim = x.shape[1]
        bits = -(-dim * ROTATIONS // BITS_IN_PART) * BITS_IN_PART
        rng = np.random.default_rng(seed)
        turns = []
        for _ in range(-(-bits // dim)):
            turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
            for _ in range(ITERATIONS):         # the rotation that brings the vectors closest to their signs
                sign = np.where(x @ turn >= 0, 1.0, -1.0)
                u, _, v = np.linalg.svd(x.T @ sign)
                turn = u @ v
            turns.append(turn)
        self.turn = np.concatenate(turns, axis=1)[:, :bits]
        self.parts = bits // BITS_IN_PART

    def __call__(self, x: np.ndarray) -> np.ndarray:
        bits = (x - self.mean) @ self.turn >= 0
        return np.packbits(bits, axis=1, bitorder="little").view("<u2")


def hamming(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


class Index:
    """The substrings of one block of codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.cells = []
        for j in range(codes.shape[1]):
            order = np.argsort(codes[:, j], kind="stable")
            values, start = np.unique(codes[order, j], return_index=True)
            self.cells.append((order, values, start, np.append(start[1:], len(order))))

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows whose code is within the radius, and their Hamming distances."""
        m = len(self.cells)
        near, first = divmod(radius, m)
        found = np.zeros(len(self.codes), bool)
        for j, (order, values, start, end) in enumerate(self.cells):
            limit = near if j <= first else near - 1
            if limit < 0:
                continue
            if limit < 2:           # few enough cells to look up one by one
                want = np.append(code[j], code[j] ^ _FLIPS) if limit else code[j:j + 1]
                at = np.searchsorted(values, want)
                at = at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == want)]
            else:                   # more cells than the directory has: go through the directory
                at = np.flatnonzero(np.bitwise_count(values ^ code[j]) <= limit)
            size = end[at] - start[at]
            rows = np.repeat(start[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
            found[order[rows]] = True
        rows = np.flatnonzero(found)
        dist = hamming(self.codes[rows], code)
        ok = dist <= radius
        return rows[ok], dist[ok]


_FLIPS = (1 << np.arange(BITS_IN_PART)).astype(np.uint16)


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - query) ** 2).sum(axis=1))


def vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id, v (array of doubles) of the vectors that take part."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    df = df.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    df = df.where("id IS NOT NULL AND v IS NOT NULL").where(~bad & F.exists(v, lambda x: x != 0))
    return df.groupBy("id").agg(F.min("v").alias("v"))


def learn(vecs: DataFrame, k: int) -> tuple[Codes, int] | None:
    """Codes and search radius from a bounded sample; None without a vector."""
    rows = vecs.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    if not rows:
        return None
    x = np.array([r["v"] for r in rows])
    codes = Codes(x)
    c = codes(x)
    q = min(len(x), 512)
    far = []
    for i in range(q):
        d = distances(x, x[i])
        d[i] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(x) - 1)]
        far.append(hamming(c[near], c[i]))
    far = np.concatenate(far)
    return codes, int(np.ceil(np.quantile(far, COVER))) if len(far) else 0


def search(df: DataFrame, queries: DataFrame, id_col: str, vec_col: str, k: int = 10) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) of each query's k nearest found."""
    spark = df.sparkSession
    ship(spark)
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"query_id {id_type}, vec_id {id_type}, score double"
    vecs = vectors(df, id_col, vec_col)
    size = vecs.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if size is None:
        return spark.createDataFrame([], f"query_id {id_type}, rank int, vec_id {id_type}, score double")
    vecs = written(vecs.where(F.size("v") == size["n"]), "ann-vectors")
    asked = vectors(queries, id_col, vec_col).where(F.size("v") == size["n"])
    asked = written(asked, "ann-queries")
    n = vecs.count()
    codes, radius = learn(vecs, k)
    in_block = min(max(BLOCK_ROWS, n // BLOCKS), max(1, BLOCK_BYTES // (8 * size["n"])))
    blocks = -(-n // in_block)
    rows = vecs.select(F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"),
                       "id", "v")
    ask = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"),
                       "id", "v")

    def probe(batches):
        block, held, index, ids, x = None, [], None, None, None
        for batch in batches:
            number, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((number[1:] != number[:-1]) | (asks[1:] != asks[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, batch.num_rows]):
                if a == b:
                    continue
                if number[a] != block:
                    block, held, index = number[a], [], None
                own = batch.column(2).slice(a, b - a)
                v = batch.column(3).slice(a, b - a).flatten().to_numpy().reshape(b - a, -1)
                if not asks[a]:
                    held.append((own, v))
                elif held or index:
                    if index is None:       # the block's rows are complete, in order of their ids
                        ids, x = pa.concat_arrays([i for i, _ in held]), np.concatenate([r for _, r in held])
                        held, index = [], Index(codes(x))
                        place = {i: at for at, i in enumerate(ids.to_pylist())}
                    yield answers(index, x, ids, place, own, v)

    def answers(index, x, ids, place, own, queries):
        asked_by, found, score = [], [], []
        bits = codes.parts * BITS_IN_PART
        for number, (q, c, qid) in enumerate(zip(queries, codes(queries), own.to_pylist())):
            r, itself = radius, place.get(qid, -1)
            while True:
                near, _ = index.within(c, r)
                near = near[near != itself]
                if len(near) >= k or r >= bits:
                    break
                r = min(bits, r + codes.parts)
            d = distances(x[near], q)
            best = np.argsort(d, kind="stable")[:k]
            asked_by.append(np.full(len(best), number))
            found.append(near[best])
            score.append(d[best])
        return pa.RecordBatch.from_arrays([own.take(pa.array(np.concatenate(asked_by))),
                                           ids.take(pa.array(np.concatenate(found))), pa.array(np.concatenate(score))],
                                          ["query_id", "vec_id", "score"])

    dealt = rows.unionByName(ask).repartition(blocks, "block").sortWithinPartitions("block", "asks", "id")
    got = dealt.mapInArrow(probe, schema)
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (got.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
