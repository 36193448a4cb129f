"""Spelling variant grouping: words one edit apart, found as pairs of trie nodes.

Words are the runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of all texts, A-Z lower-cased. Where
199 divides the CRC-32 of ``<doc_id>:<run>``, the run loses the code point at (CRC-32 mod its length).
A word has at least ``MIN_LENGTH`` code points and ``MIN_COUNT`` occurrences in all texts.

Every prefix of a word is a node of the trie of all words, every suffix one of the trie of the reversed
words. The nodes are numbered (below), so that a word of length L is the integer pairs (prefix node i,
suffix node L - i), and the word without its letter i is the pair (prefix node i, suffix node L - i - 1).
Two different words that share the latter pair differ by one replaced letter; a word whose own pair
equals another's pair without a letter is that word with the letter deleted. Of a run of equal letters only
the first deletion counts, so that each neighbour is met at exactly one pair. This is exact: no hashes, no
candidates to verify.

A pair is shared by at most one whole word and by as many words with a skipped letter as there are
letters (94), whatever the corpus: these small sets give each word its number of neighbours there and
the best of them by a window, without making pairs of words.

Numbering. Words are sorted over range partitions, in each of which the trie's path to the word at hand
is a stack: the part shared with the word before keeps its numbers, the rest gets new ones. A node whose
prefix runs over the border of two partitions is numbered by the first border it crosses and its depth;
for this the driver holds the first and last word of each partition (as many as there are shuffle
partitions) and nothing else.

A word's form is its near word of largest n (ties: smallest in code-point order) if that is at least
``RATIO`` times its own n. Following forms multiplies n by ``RATIO`` at each step, so chains are short
(26 steps at most in 64 bits) and pointer doubling ends after five rounds at most.

Null texts have no words. A null doc_id counts as the empty string in the CRC-32 key. Rows that repeat
are documents of their own and count as often. A table without words gives no row. Words may be of any
length: all steps are linear in it. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_type

from ratecell.llm.common import ship, texts, written

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
DELETE_EVERY = 199
BATCH_NODES = 100_000      # node numbers in one Arrow batch
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """word, n: the words of all texts and their occurrences."""
    # A run shorter than MIN_LENGTH can't become a word, so that runs are matched from that length on.
    runs = F.regexp_extract_all(F.translate("text", UPPER, UPPER.lower()),
                                F.lit(f"[a-zÀ-ÿ]{{{MIN_LENGTH},}}"), F.lit(0))
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    run = (texts(docs).select("doc_id", F.explode(runs).alias("run"))
           .select("run", F.crc32(F.encode(key, "UTF-8")).alias("h")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = run.select(F.when(F.col("h") % DELETE_EVERY == 0, cut).otherwise(F.col("run")).alias("word"))
    return (word.where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= min_count))


# --- numbering trie nodes ---------------------------------------------------------------------------

def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return n


def borders(ends: list[tuple[int, str, str]]) -> dict[int, tuple[list[int], int, str]]:
    """From (partition, first word, last word) in order: for each partition the numbers of its first
    word's prefixes that an earlier partition has too, and how long a prefix of its last word the
    next partition has too."""
    out, head = {}, []
    for k, (pid, first, last) in enumerate(ends):
        over = _shared(last, ends[k + 1][1]) if k + 1 < len(ends) else 0
        out[pid] = (head, over, last)
        kept = min(len(head), _shared(first, last), over)
        head = head[:kept] + [(1 << 62) | (pid << 32) | d for d in range(kept + 1, over + 1)]
    return out


def path_numbers(words, head: list[int], over: int, last: str, pid: int):
    """For each of a partition's sorted words, the node numbers of its prefixes (the empty one is 0)."""
    stack, before, new = [0], None, (pid + 1) << 40
    for w in words:
        if before is None:
            stack += head
            depth = len(head)
        else:
            depth = _shared(before, w)
            del stack[depth + 1:]
        at_border = min(_shared(w, last), over) if depth < over else 0
        if at_border > depth:
            stack += [(1 << 62) | (pid << 32) | d for d in range(depth + 1, at_border + 1)]
            depth = at_border
        fresh = len(w) - depth
        stack += range(new, new + fresh)
        new, before = new + fresh, w
        yield list(stack)


def with_nodes(df: DataFrame, key: str, nodes: str, extra: str, number: str | None = None) -> DataFrame:
    """``df`` with ``nodes``, the trie node numbers of all prefixes of the strings ``key`` (unique, not
    empty); ``extra`` names and types the other columns. ``number``: a column of longs in the order of
    the keys."""
    ship(df.sparkSession)
    s = written(df.orderBy(key).withColumn("_pid", F.spark_partition_id()), "trie-sorted")
    ends = [tuple(r) for r in s.groupBy("_pid").agg(F.min(key), F.max(key)).orderBy("_pid").collect()]
    info = borders(ends)
    others = [c for c in df.columns if c != key]

    def run(batches):
        rows = ((pid, w, rest) for b in batches
                for pid, w, *rest in zip(b.column("_pid").to_pylist(), b.column(key).to_pylist(),
                                         *(b.column(c).to_pylist() for c in others)))
        part, size = [], 0
        for pid, of_pid in groupby(rows, itemgetter(0)):
            at_hand = []        # the row whose word was taken last
            words = (at_hand.append(r) or r[1] for r in of_pid)
            for i, path in enumerate(path_numbers(words, *info[pid], pid)):
                part.append((at_hand.pop(), path, (pid << 40) | i))
                size += len(path)
                if size > BATCH_NODES:
                    yield batch(part)
                    part, size = [], 0
        yield batch(part)

    def batch(part):
        cols = {key: pa.array([p[0][1] for p in part], pa.string())}
        for j, c in enumerate(others):
            cols[c] = pa.array([p[0][2][j] for p in part], types[c])
        cols[nodes] = pa.array([p[1] for p in part], pa.list_(pa.int64()))
        if number:
            cols[number] = pa.array([p[2] for p in part], pa.int64())
        return pa.RecordBatch.from_pydict(cols)

    types = {f.name: to_arrow_type(f.dataType) for f in df.schema}
    schema = ", ".join([f"{key} string", *filter(None, [extra]), f"{nodes} array<long>"] + ([f"{number} long"] if number else []))
    # Whole partitions of the sort meet in a task, in order; their number stays that of the sort.
    placed = s.repartition(max(len(ends), 1), "_pid").sortWithinPartitions("_pid", key)
    return placed.mapInArrow(run, schema)


# --- neighbours -------------------------------------------------------------------------------------

def pairs(words: DataFrame) -> DataFrame:
    """a, b, id, n, kind of every word: kind 0 for the word itself at each place, 1 for a skipped letter
    that is the first of its run, 2 for another skipped letter."""
    def at(a, i):
        return F.struct(a.alias("a"), F.get("suffixes", F.size("suffixes") - 1 - i).alias("b"), F.lit(0).alias("kind"))

    def skip(a, i):
        first = F.get("firsts", i)
        return F.struct(a.alias("a"), F.get("suffixes", F.size("suffixes") - 2 - i).alias("b"),
                        F.when(first, 1).otherwise(2).alias("kind"))

    whole = F.transform("prefixes", at)
    skipped = F.transform(F.slice("prefixes", F.lit(1), F.size("prefixes") - 1), skip)
    return words.select("id", "n", F.inline(F.concat(whole, skipped)))


def neighbours(words: DataFrame) -> DataFrame:
    """id, n_near, best (n and -id of the near word of largest n, ties to the smallest id) of every word
    that has a near word; ``words``: id, n, prefixes, suffixes, firsts."""
    p = pairs(words)
    me = F.struct("n", (-F.col("id")).alias("neg"))
    spec = Window.partitionBy("a", "b")
    ordered = spec.orderBy(F.when(F.col("kind") == 0, 1).otherwise(0), F.desc("n"), F.asc("id")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    p = p.select("id", "kind", me.alias("me"),
                 F.count(F.when(F.col("kind") > 0, 1)).over(ordered).alias("skips"),
                 F.count(F.when(F.col("kind") == 1, 1)).over(ordered).alias("firsts"),
                 F.max(F.when(F.col("kind") == 0, me)).over(ordered).alias("whole"),
                 F.max(F.when(F.col("kind") == 1, me)).over(ordered).alias("longer"),
                 F.first(me).over(ordered).alias("one"), F.nth_value(me, 2).over(ordered).alias("two"))
    replaced = F.when(F.col("kind") > 0, F.col("skips") - 1).otherwise(0)
    other = F.when(F.col("kind") > 0, F.when(F.col("one") != F.col("me"), F.col("one"))
                   .when(F.col("skips") > 1, F.col("two")))
    shorter = F.when(F.col("kind") == 1, F.col("whole"))
    inserted = F.when(F.col("kind") == 0, F.col("firsts")).when(shorter.isNotNull(), 1).otherwise(0)
    longer = F.when(F.col("kind") == 0, F.col("longer"))
    p = p.select("id", (replaced + inserted).alias("k"), F.greatest(other, shorter, longer).alias("best"))
    return p.where("k > 0").groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))


def chain_ends(links: DataFrame) -> DataFrame:
    """id, form_id, root_id: the end of each chain of id -> form_id, by pointer doubling. Chains must
    not be circular."""
    cur = written(links.select("id", "form_id", F.col("form_id").alias("root_id")), "trie-links")
    while True:
        ahead = cur.select(F.col("id").alias("_at"), F.col("root_id").alias("_to"))
        nxt = cur.join(ahead, F.col("root_id") == F.col("_at"), "left")
        nxt = written(nxt.select("id", "form_id", F.coalesce("_to", "root_id").alias("root_id"),
                                 F.col("_to").isNotNull().alias("moved")), "trie-roots")
        if nxt.where("moved").isEmpty():
            return nxt.drop("moved")
        cur = nxt.drop("moved")


def group_variants(docs: DataFrame, min_count: int = MIN_COUNT, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    letters = F.split("word", "")
    found = with_nodes(word_counts(docs, min_count), "word", "prefixes", "n long", "id")
    # firsts: whether a letter differs from the one before
    firsts = F.zip_with(letters, F.concat(F.array(F.lit("")), F.slice(letters, F.lit(1), F.size(letters) - 1)),
                        lambda x, y: x != y)
    found = written(found.select("id", "word", "n", "prefixes", firsts.alias("firsts")), "trie-words")
    back = found.select(F.reverse("word").alias("back"), "id", "n", "prefixes", "firsts")
    both = with_nodes(back, "back", "suffixes", "id long, n long, prefixes array<long>, firsts array<boolean>")
    near = written(neighbours(both), "trie-near")
    words = found.select("id", "word", "n")
    near = near.select("id", "n_near", (-F.col("best.neg")).alias("best_id"), F.col("best.n").alias("best_n"))
    all_words = words.join(near, "id", "left")
    formed = all_words.where(F.col("best_n") >= F.col("n") * ratio).select("id", F.col("best_id").alias("form_id"))
    ends = chain_ends(formed)
    name = words.select(F.col("id").alias("_id"), F.col("word").alias("_word"))
    named = (ends.join(name, F.col("form_id") == F.col("_id")).select("id", F.col("_word").alias("form"), "root_id")
             .join(name, F.col("root_id") == F.col("_id")).select("id", "form", F.col("_word").alias("root")))
    return all_words.join(named, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("form").isNotNull(), F.col("best_n")).alias("form_n"))
