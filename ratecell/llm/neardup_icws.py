"""Near-duplicates by improved consistent weighted sampling (ICWS) over TF-IDF shingles.

A text is a weighted set of its shingles of ``WORDS_IN_SHINGLE`` lower-cased, white-space-separated
words (all its words, if it has fewer). A shingle's weight is its count times the mean inverse
document frequency of its words: 1 + ln((1 + N) / (1 + df)), with df counted over all documents in
``2**DF_BITS`` hashed slots (the hashing trick, so that the table is of fixed size and may be sent
to every task). Frequencies are those of words, not of shingles: a shingle's own frequency would
make large groups of copies look unlike, because what they share would weigh least.

``K`` samples of each text are consistent: two texts draw the same sample with a probability equal
to their weighted Jaccard similarity. ``BANDS`` bands of ``ROWS`` samples put similar texts in a
common bucket. Two texts are linked if their weighted Jaccard similarity, computed exactly, is at
least ``THRESHOLD``; classes are the connected components.

* Texts that are equal share one class from the start; each different text is one node.
* Each text is compared with the first text of its largest bucket; links join components. In every
  bucket that still holds several components, each text outside its first text's component is
  compared with that first text, and components are joined again.
* In buckets that even then hold several components, the texts outside the bucket's largest one
  (strays) are compared with all texts of other components, inside tasks, in cells of about
  ``BLOCK`` strays and ``BLOCK`` texts. A bucket of n texts with s strays sends n ceil(s / BLOCK) +
  s ceil(n / BLOCK) rows, so a few strays among many copies cost no more than the copies; no task
  holds a large bucket and no pair is emitted unless it is a link. Sketches first rule out pairs whose
  estimate is below ``ESTIMATE``; the rest are computed exactly.

A pair at the threshold shares no band with a probability of (1 - 0.8^4)^10 = 0.5 %, one at 0.85 with
0.06 %; with 40 samples its estimate is below ``ESTIMATE`` in 1 of 100,000 cases.

Null and empty texts are equal texts: one class, linked to nothing else. In ``classes`` rows that
share a doc_id share a class, whatever their texts, and a class without any doc_id has class_id null;
``drop_copies`` goes by the texts alone. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell.llm.common import WORDS, drop_tables, free_name, mix, ship, slices, texts, token_hashes, written

WORDS_IN_SHINGLE = 5
THRESHOLD = 0.8
DF_BITS = 18
ROWS, BANDS = 4, 10
K = ROWS * BANDS
ESTIMATE = 0.5
BLOCK = 512
STEP = 64                   # strays compared at once
_ADD = mix(np.arange(1, K + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_ORDER = mix(np.arange(100, 100 + WORDS_IN_SHINGLE, dtype=np.uint64)) | np.uint64(1)
_PART = 1 << 12
_ODD = np.uint64(0x9FB21C651E98DF25)
_S20, _S29, _S32 = (np.uint64(i) for i in (20, 29, 32))
_U9, _ONE, _ALMOST = np.uint32(9), np.uint32(0x3F800000), np.float32(1 - 2.0 ** -24)
_SLOT = np.arange(K)
BLOCK_ROWS = 1024


def _words(docs: list[str]):
    return token_hashes([t.lower().encode("utf-8", "replace") for t in docs], WORDS)


def _slot(word: np.ndarray) -> np.ndarray:
    return (word >> np.uint64(64 - DF_BITS)).astype(np.int64)


def document_frequency(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many each hashed word slot occurs."""
    ship(docs.sparkSession)

    def count(batches):
        drop_tables()
        df, n = np.zeros(1 << DF_BITS, np.int64), 0
        for batch in batches:
            col = batch.column(1).to_pylist()
            n += len(col)
            for a, b in slices(len(col), [len(t) for t in col]):
                h, doc = _words(col[a:b])
                seen = np.unique(doc << DF_BITS | _slot(h))
                df += np.bincount(seen & ((1 << DF_BITS) - 1), minlength=1 << DF_BITS)
        parts = df.reshape(-1, _PART)
        some = np.flatnonzero(parts.any(axis=1)) if n else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([*map(int, some), -1], pa.int32()), pa.array([*(parts[i].tobytes() for i in some), np.int64(n).tobytes()], pa.binary())],
            ["part", "v"])

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            for v in batch.column("v").to_pylist():
                total = total + np.frombuffer(v, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         ["part", "v"])

    # 64 fixed-size blocks for each task; their sums are one bounded table.
    got = (texts(docs).mapInArrow(count, "part int, v binary").groupBy("part").applyInArrow(add, "part int, v binary"))
    df, n = np.zeros((1 << DF_BITS) // _PART * _PART, np.int64), 0
    for r in got.collect():
        v = np.frombuffer(r["v"], np.int64)
        if r["part"] < 0:
            n = int(v[0])
        else:
            df[r["part"] * _PART:(r["part"] + 1) * _PART] = v
    return n, df


def idf(n: int, df: np.ndarray) -> np.ndarray:
    return (1.0 + np.log((1.0 + n) / (1.0 + df))).astype(np.float32)


def shingles(docs: list[str], weight: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct shingles' 64-bit hashes, ascending, and their weights."""
    h, doc = _words(docs)
    size = np.bincount(doc, minlength=len(docs))
    at = np.cumsum(size) - size
    w = weight[_slot(h)].astype(np.float64)
    out = []
    k = WORDS_IN_SHINGLE
    full = mix(sum(h[j:len(h) - k + 1 + j] * _ORDER[j] for j in range(k))) if len(h) >= k else h[:0]
    run = np.concatenate([[0.0], np.cumsum(w)])
    for i, n in enumerate(size):
        a = at[i]
        if not n:
            out.append((h[:0], np.zeros(0, np.float32)))
        elif n < k:
            s = mix(np.atleast_1d((h[a:a + n] * _ORDER[:n]).sum(dtype=np.uint64)))
            out.append((s, np.array([w[a:a + n].mean()], np.float32)))
        else:
            s, first, c = np.unique(full[a:a + n - k + 1], return_index=True, return_counts=True)
            # each shingle's mean weight from its own five words, so that it is the same in every text
            mean = w[a + first[:, None] + np.arange(k)].mean(axis=1)
            out.append((s, (c * mean).astype(np.float32)))
    return out


class _Room:
    """Arrays that the sampling of one block after the other works in."""

    def __init__(self):
        self.x, self.y, self.t = (np.empty((BLOCK_ROWS, K), np.uint64) for _ in range(3))
        self.f = [np.empty((BLOCK_ROWS, K), np.float32) for _ in range(4)]


_ROOM = None


def _unit(v: np.ndarray, half: int, out: np.ndarray) -> np.ndarray:
    """23 bits of a half of each hash as a number between 0 and 1, both excluded."""
    bits = out.view(np.uint32)
    np.right_shift(v.view(np.uint32)[:, half::2], _U9, out=bits)
    np.bitwise_or(bits, _ONE, out=bits)             # a number from 1 up to 2
    out -= _ALMOST
    return out


def _block(s: np.ndarray, lw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cost and quantised weight of each (shingle, sample), at most ``BLOCK_ROWS`` shingles."""
    global _ROOM
    if _ROOM is None:
        _ROOM = _Room()
    n = len(s)
    x, y, t, (r, u, c, q) = _ROOM.x[:n], _ROOM.y[:n], _ROOM.t[:n], [f[:n] for f in _ROOM.f]
    np.multiply(s[:, None], _ADD, out=x)
    np.right_shift(x, _S32, out=t)
    x ^= t
    x *= _ODD
    np.right_shift(x, _S29, out=t)
    x ^= t
    np.multiply(x, _ADD, out=y)
    np.right_shift(y, _S32, out=t)
    y ^= t
    r = _unit(x, 0, r)
    r *= _unit(x, 1, u)
    np.negative(np.log(r, out=r), out=r)            # r: Gamma(2, 1)
    c = _unit(y, 0, c)
    c *= _unit(y, 1, u)
    np.log(np.negative(np.log(c, out=c), out=c), out=c)     # ln c, c: Gamma(2, 1)
    np.right_shift(x, _S20, out=t)
    t ^= y
    beta = _unit(t, 0, u)
    np.divide(lw[:, None], r, out=q)
    q += beta
    np.floor(q, out=q)                              # t = floor(ln w / r + beta)
    np.subtract(q, beta, out=u)                     # ln y = r (t - beta); ln a = ln c - ln y - r
    u += np.float32(1)
    u *= r
    c -= u
    return c, q


def samples(sets: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray | None]:
    """``K`` consistent weighted samples of each weighted set, each sample as a hash of (shingle,
    quantised weight); None for an empty set."""
    out: list[np.ndarray | None] = [None] * len(sets)
    some = [i for i, (s, _) in enumerate(sets) if len(s)]
    for a, b in slices(len(some), [len(sets[i][0]) for i in some], BLOCK_ROWS):
        which = some[a:b]
        s = np.concatenate([sets[i][0] for i in which])
        lw = np.log(np.concatenate([sets[i][1] for i in which]))
        size = np.array([len(sets[i][0]) for i in which])
        if b - a == 1:                              # a set may be larger than a block
            best, pick = np.full(K, np.inf, np.float32), np.zeros(K, np.uint64)
            for p in range(0, len(s), BLOCK_ROWS):
                c, q = _block(s[p:p + BLOCK_ROWS], lw[p:p + BLOCK_ROWS])
                at = c.argmin(axis=0)
                low = c[at, _SLOT]
                new = low < best
                best[new] = low[new]
                pick[new] = _sample(s[p + at], q[at, _SLOT])[new]
            out[which[0]] = pick
            continue
        c, q = _block(s, lw)
        low = np.minimum.reduceat(c, np.cumsum(size) - size, axis=0)
        own = np.repeat(np.arange(b - a), size)
        row, col = np.nonzero(c == low[own])
        at = np.zeros((b - a, K), np.int64)
        at[own[row[::-1]], col[::-1]] = row[::-1]   # the first of equal costs, as argmin
        pick = _sample(s[at], q[at, _SLOT])
        for k, i in enumerate(which):
            out[i] = pick[k]
    return out


def _sample(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    return mix(s + t.astype(np.int64).astype(np.uint64) * _ADD)


def similarity(a: tuple, b: tuple) -> float:
    """Weighted Jaccard similarity of two texts' shingles."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    low = np.minimum(a[1][i], b[1][j]).sum(dtype=np.float64)
    both = a[1].sum(dtype=np.float64) + b[1].sum(dtype=np.float64) - low
    return low / both if both > 0 else 0.0


def _pack(s: tuple) -> bytes:
    return s[0].tobytes() + s[1].tobytes()


def _unpack(blob: bytes) -> tuple:
    n = len(blob) // 12
    return np.frombuffer(blob, np.uint64, n), np.frombuffer(blob, np.float32, n, 8 * n)


def sketches(docs: DataFrame, weight: np.ndarray) -> DataFrame:
    """doc_id, digest of the text, samples (binary; null without a shingle), bands (longs)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        drop_tables()
        for batch in batches:
            col = batch.column(2).to_pylist()
            for a, b in slices(len(col), [len(t) for t in col], 1 << 19):
                sig, bands = [], []
                for x in samples(shingles(col[a:b], weight)):
                    if x is None:
                        sig.append(None)
                        bands.append([])
                        continue
                    sig.append(x.astype(np.uint32).tobytes())
                    band = mix((x.reshape(BANDS, ROWS) * _ADD[:ROWS]).sum(axis=1, dtype=np.uint64))
                    bands.append(band.view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a), pa.array(sig, pa.binary()),
                     pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "digest", "sig", "bands"])

    t = texts(docs).select("doc_id", F.md5(F.col("text").cast("binary")).alias("digest"), "text")
    return t.mapInArrow(run, f"doc_id {id_type}, digest string, sig binary, bands array<bigint>")


def components(edges: DataFrame, name: str) -> DataFrame:
    """node, root (its component's smallest node) for the nodes of the edges (a, b): alternating
    small-star and large-star steps until nothing changes. Each step is written to the shared
    folder; a hub's edges are joined with its minimum, never gathered."""
    def tidy(e):
        return e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()

    e, seen = written(tidy(edges), f"{name}-0"), None
    step = 0
    while True:
        mark = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = mark
        step += 1
        # Small star: a node's smaller neighbours and itself go to the smallest of them. Each edge gives one.
        low = e.groupBy("a").agg(F.min("b").alias("m"))
        e = tidy(e.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                         F.col("m").alias("b")))
        # Large star: a node's larger neighbours go to the smallest of its neighbours and itself.
        e = written(e, f"{name}-{step}-small")
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")).withColumnRenamed("a", "b")
        e = tidy(e.join(low, "b").select("a", F.col("m").alias("b")))
        e = written(e, f"{name}-{step}")


def _links(pairs: DataFrame, blobs: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that are similar enough."""
    left = blobs.select(F.col("node").alias("a"), F.col("blob").alias("blob_a"))
    right = blobs.select(F.col("node").alias("b"), F.col("blob").alias("blob_b"))

    @F.pandas_udf("double")
    def sim(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([similarity(_unpack(p), _unpack(q)) for p, q in zip(x, y)], dtype="float64")

    return pairs.join(right, "b").join(left, "a").where(sim("blob_a", "blob_b") >= threshold).select("a", "b")


def _cells(members: DataFrame) -> DataFrame:
    """Of members (band, key, node, root) those of buckets with several components, once for each cell
    (i, j) of block i of the strays and block j of all members: as a stray (``stray``), as a member, or,
    in different rows, both. ``out`` tells whether the member is outside the largest component."""
    bucket = ["band", "key"]
    size = members.groupBy(*bucket, "root").agg(F.count("*").alias("c"))
    open_ = (size.groupBy(*bucket).agg(F.sum("c").alias("n"), F.max(F.struct("c", "root")).alias("big"), F.count("*").alias("several"))
             .where("several > 1")
             .select(*bucket, F.col("big.root").alias("big"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
                     F.ceil((F.col("n") - F.col("big.c")) / BLOCK).cast("int").alias("strays")))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    mine = F.pmod(F.xxhash64("node", F.lit(1)), F.col("strays")).cast("int")
    member = F.transform(F.sequence(F.lit(0), F.col("strays") - 1),
                         lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(False).alias("stray")))
    stray = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda j: F.struct(mine.alias("i"), j.alias("j"), F.lit(True).alias("stray")))
    out = F.col("root") != F.col("big")
    return (members.join(open_, bucket).withColumn("out", out)
            .select(*bucket, "node", "root", "out", F.explode(F.when(F.col("out"), F.concat(member, stray)).otherwise(member)).alias("cell"))
            .select(*bucket, "node", "root", "out", "cell.*"))


def _compare(exact: bool, threshold: float):
    """For a cell of one bucket: the rows that have a possible partner in another component
    (exact=False), or the links between components (exact=True)."""
    def run(key, pdf):
        band = key[0]
        pdf = pdf.sort_values(["stray", "node"]).reset_index(drop=True)
        sig = np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(len(pdf), K)
        comp, node, out = pdf["root"].to_numpy(), pdf["node"].to_numpy(), pdf["out"].to_numpy()
        first = int((~pdf["stray"]).sum())          # members, then strays
        hit = np.zeros(len(pdf), bool)
        found = []
        cache = {}

        def blob(q):
            if node[q] not in cache:
                cache[node[q]] = _unpack(pdf["blob"].iat[q])
            return cache[node[q]]

        by_sample = np.ascontiguousarray(sig[:first].T)
        for a in range(first, len(pdf), STEP):
            strays = sig[a:a + STEP]
            hits = np.zeros((len(strays), first), np.uint8)
            for k in range(K):
                hits += by_sample[k] == strays[:, k, None]
            for x, hit_x in enumerate(hits, a):
                y = np.flatnonzero(hit_x >= ESTIMATE * K)
                # of two strays the one with the larger number is the stray
                y = y[(comp[y] != comp[x]) & (~out[y] | (node[y] < node[x]))]
                # a pair is compared in the first band that it shares
                shared = (sig[y] == sig[x]).reshape(len(y), BANDS, ROWS).all(axis=2)
                y = y[~shared[:, :band].any(axis=1)]
                if exact:
                    found += [(node[x], node[z]) for z in y if similarity(blob(x), blob(z)) >= threshold]
                elif len(y):
                    hit[x] = True
                    hit[y] = True
        if exact:
            return pd.DataFrame(found, columns=["a", "b"])
        return pdf.loc[hit, ["band", "key", "i", "j", "node", "root", "out", "stray"]]
    return run


def _labelled(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """doc_id, digest of every row; and digest, doc_id (its smallest), root (the component of the
    links between texts) of every different text."""
    spark = docs.sparkSession
    ship(spark)
    base = texts(docs)
    weight = idf(*document_frequency(docs))
    sk = written(sketches(docs, weight), "nd-sketch")
    # Each different text is a node with a number, fixed by writing it. Only digests and ids move.
    nodes = written(sk.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("sig").alias("sig"),
                                             F.first("bands").alias("bands"))
                    .withColumn("node", F.monotonically_increasing_id()), "nd-nodes")
    inband = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    buckets = inband.groupBy("band", "key").agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    inband = written(inband.join(buckets, ["band", "key"]), "nd-buckets")
    # Shingles of the texts that share a bucket with another one; one row of each text is read. The
    # hash of doc_id keeps a text's other rows away.
    want = (inband.select("node").distinct().join(nodes, "node")
            .select("node", "digest", F.xxhash64("doc_id").alias("of_id")))
    small = (base.select(F.xxhash64("doc_id").alias("of_id"), F.md5(F.col("text").cast("binary")).alias("digest"), "text")
             .join(want, ["of_id", "digest"]).dropDuplicates(["of_id", "digest"]))

    @F.pandas_udf("binary")
    def blob(text: pd.Series) -> pd.Series:
        drop_tables()
        out, col = [], text.tolist()
        for a, b in slices(len(col), [len(t) for t in col]):
            out += map(_pack, shingles(col[a:b], weight))
        return pd.Series(out)

    blobs = written(small.select("node", blob("text").alias("blob")), "nd-shingles")
    # Each text and the first text of its largest bucket: at most one pair a text.
    star = (inband.groupBy("node").agg(F.max(F.struct("n", (-F.col("first")).alias("f"))).alias("m"))
            .select((-F.col("m.f")).alias("a"), F.col("node").alias("b")).where("a <> b"))
    linked = written(_links(star, blobs, threshold), "nd-star")

    def with_roots(rows: DataFrame, roots: DataFrame, node: str, root: str) -> DataFrame:
        r = roots.select(F.col("node").alias(node), F.col("root").alias("_r"))
        return rows.join(r, node, "left").withColumn(root, F.coalesce("_r", node)).drop("_r")

    # Texts of the first text's component need no comparison in that bucket.
    roots = components(linked, "nd-roots")
    part = with_roots(with_roots(inband.select("band", "key", "first", "node"), roots, "node", "root"), roots, "first", "top")
    star = (part.where("root <> top").select(F.col("first").alias("a"), F.col("node").alias("b")).distinct()
            .join(star, ["a", "b"], "left_anti"))
    linked = written(linked.unionByName(_links(star, blobs, threshold)), "nd-stars")
    roots = components(linked, "nd-joined")

    # Buckets that still hold several components.
    sig = nodes.select("node", "sig")
    cells = _cells(written(with_roots(inband.select("band", "key", "node"), roots, "node", "root"), "nd-parts"))
    keys = ["band", "key", "i", "j"]
    maybe = cells.join(sig, "node").groupBy(*keys).applyInPandas(
        _compare(False, threshold), "band int, key bigint, i int, j int, node bigint, root bigint, out boolean, stray boolean")
    maybe = written(maybe, "nd-maybe")
    again = maybe.join(sig, "node").join(blobs, "node")
    more = again.groupBy(*keys).applyInPandas(_compare(True, threshold), "a bigint, b bigint")
    final = components(linked.unionByName(written(more, "nd-more")), "nd-classes")
    label = (nodes.select("node", "digest", "doc_id").join(final, "node", "left")
             .select("digest", "doc_id", F.coalesce("root", "node").alias("root")))
    return sk.select("doc_id", "digest"), written(label, "nd-label")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id (the smallest doc_id of its class) for every row."""
    rows, label = _labelled(docs, threshold)
    member = written(rows.join(label.select("digest", "root"), "digest").select("doc_id", "root"), "nd-member")
    # A doc_id with texts of several components joins them.
    several = (member.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("root").alias("b"), F.max("root").alias("hi"))
               .where("b <> hi").select("doc_id", "b"))
    if not several.isEmpty():
        joined = components(member.join(several, "doc_id").select(F.col("root").alias("a"), "b"), "nd-shared")
        member = (member.join(joined.select(F.col("node").alias("root"), F.col("root").alias("low")), "root", "left")
                  .select("doc_id", F.coalesce("low", "root").alias("root")))
    # Written, so that the join may split a large class's rows.
    names = written(member.groupBy("root").agg(F.min("doc_id").alias("class_id")), "nd-names")
    return member.join(names, "root").select("doc_id", "class_id")


def drop_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class of texts, columns unchanged: the one of the smallest doc_id (null after
    all others), then of the smallest digest; of rows that repeat both doc_id and text, the smallest."""
    rows, label = _labelled(docs, threshold)
    best = label.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest")).alias("b"))
    h, x, did, dig = (free_name(docs, n) for n in ("_of_id", "_digest", "_keep", "_text"))
    keep = written(best.select(F.xxhash64("b.doc_id").alias(h), F.col("b.digest").alias(x), F.col("b.doc_id").alias(did)), "nd-keep")
    same = F.col("doc_id").eqNullSafe(F.col(did))
    twice = (rows.select(F.xxhash64("doc_id").alias(h), F.col("digest").alias(x), "doc_id").join(keep, [h, x]).where(same)
             .groupBy(h, x).agg(F.count("*").alias("n")).where("n > 1").select(h, x))
    got = (docs.withColumn(h, F.xxhash64("doc_id"))
           .withColumn(x, F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
           .join(keep, [h, x]).where(same))
    if twice.isEmpty():
        return got.select(*docs.columns)
    # Partial minima, so that a row repeated many times doesn't gather in one task.
    return got.groupBy(h, x).agg(F.min(F.struct(*docs.columns)).alias(dig)).select(f"{dig}.*")
