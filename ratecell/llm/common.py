"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import io
import os
import tempfile
import uuid
import zipfile
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

import ratecell
from ratecell.session import ensure_checkpoint_dir

# Rows in one Arrow batch sent to a Python worker: a batch of 1,000 documents of 20,000 words
# still fits a small executor.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers (once per context) and keep
    Arrow batches small."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    sc = spark.sparkContext
    if getattr(sc, "_ratecell_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(ratecell.__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for folder, _, names in os.walk(root):
            for n in sorted(names):
                if n.endswith(".py"):
                    p = os.path.join(folder, n)
                    z.write(p, os.path.join("ratecell", os.path.relpath(p, root)))
    # addPyFile serves the driver's file to the executors; nothing else reads this folder.
    path = os.path.join(tempfile.mkdtemp(prefix="ratecell-py-"), "ratecell_package.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(path)
    sc._ratecell_shipped = True


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder path under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/ratecell-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage, and fixes
    values that depend on partitioning."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until the frame has no such column (names compare without case)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name += "_"
    return name


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null as empty) and the named columns; every other column is left out, so
    that extra columns of any name do no harm."""
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *more)


def held_out():
    """True for the quarter of documents that no model learns from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def global_index(df: DataFrame, order: list, name: str, index: str) -> DataFrame:
    """``df`` with ``index`` 0, 1, 2... in the given order: a range-partitioned sort, then each
    partition's offset from the partitions' row counts (one row per partition)."""
    # Written first, so that partition numbers can't differ between the two readings.
    s = written(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), name)
    pid = F.shiftright(F.col("_m"), 33)
    offs = (s.groupBy(pid.alias("_p")).count()
            .withColumn("_o", F.sum("count").over(Window.orderBy("_p")) - F.col("count")).select("_p", "_o"))
    return (s.withColumn("_p", pid).join(offs, "_p")
            .withColumn(index, F.col("_o") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_p", "_o", "_m"))


_TABLES: list = []


def kept_between_tasks(make):
    """``make`` with its last two results kept in the Python worker, so that a stage's tasks make them once."""
    kept = lru_cache(maxsize=2)(make)
    _TABLES.append(kept)
    return kept


def drop_tables() -> None:
    """Spark hands a Python worker on from stage to stage: the tables that another operator's tasks have kept there
    go, so that an executor never holds those of several."""
    full = [kept for kept in _TABLES if kept.cache_info().currsize]
    for kept in full:
        kept.cache_clear()
    if full:
        gc.collect()                # the tables hold references to themselves


class Recent(dict):
    """A bounded memo of ``make(key)`` in two generations: when one is full it becomes the older
    one, and keys found there move up again. Keys longer than ``LONGEST`` are not remembered, so that
    the limit of entries bounds the bytes too."""

    LONGEST = 100

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        if not isinstance(key, int) and len(key) > self.LONGEST:
            return self.make(key)
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


# --- vectorised hashing of tokens in UTF-8 text -------------------------------------------------

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.full(4096, _BASE, np.uint64))
_BYTE = None


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def token_hashes(docs: list[bytes], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the tokens of UTF-8 texts, and each token's text number.

    ``classes`` maps a byte to a class; a token is a longest run of one class, class 0 separates.
    """
    global _BYTE
    if _BYTE is None:
        _BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    lens = np.fromiter(map(len, docs), np.int64, len(docs))
    sep = b"\n"                      # class 0 in every table used here
    buf = np.frombuffer(sep + sep.join(docs) + sep, np.uint8)
    cls = classes[buf]
    edge = np.flatnonzero(cls[1:] != cls[:-1]) + 1
    if not len(edge):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    starts = edge
    ends = np.append(edge[1:], len(buf))
    keep = cls[starts] != 0
    starts, ends = starts[keep], ends[keep]
    size = ends - starts
    total = int(size.sum())
    first = np.cumsum(size) - size
    local = np.arange(total) - np.repeat(first, size)
    at = local + np.repeat(starts, size)
    h = np.add.reduceat(_BYTE[buf[at]] * _POWERS[local & 4095], first) if total else np.zeros(0, np.uint64)
    doc_start = np.cumsum(lens + 1) - lens
    return mix(h + size.astype(np.uint64)), np.searchsorted(doc_start, starts, side="right") - 1


def slices(n: int, sizes, limit: int = 1 << 20):
    """Row ranges [a, b) whose sizes add up to about ``limit`` at most (one row at least)."""
    a, total = 0, 0
    for i in range(n):
        if i > a and total + sizes[i] > limit:
            yield a, i
            a, total = i, 0
        total += sizes[i]
    if a < n:
        yield a, n


WORDS = np.ones(256, np.int8)          # white space separates
WORDS[[9, 10, 11, 12, 13, 32]] = 0
MARKS = WORDS.copy()                   # white space separates, ASCII punctuation forms its own tokens
for _b in range(33, 127):
    if not chr(_b).isalnum():
        MARKS[_b] = 2
