"""Document fingerprints as invertible Bloom lookup tables (IBLT) of paragraph digests, in
DataFrame functions only.

Paragraphs end with lines, and within lines where the characters around a place say so, so that an edit
changes only the digests it touches. The first ``HEAD_PIECES`` of a text end after a word whose last
character is one of a few (``FINE``), so that short texts have several too; the rest of the text is cut at fewer
places (``COARSE``). What is still longer than ``HEAD_LONG`` or ``REST_LONG`` code points is cut at each so many;
white space alone is no paragraph. Its digest is a 64-bit hash; a text's paragraphs
form a set. An IBLT of c cells in each of three
subtables adds every digest to one cell of each: a count, the XOR of digests and the XOR of the
digests' check hashes. Only cells that are not empty are kept. The fingerprint is the table of
``CELLS`` cells a subtable, as text: equal texts have equal fingerprints.

Two versions' tables subtract cell by cell, so that common paragraphs vanish. Peeling takes cells
of count 1 or -1 whose check fits, notes their digest and side, and removes it from its other
cells, until the table is empty. If it gets stuck, both tables are made anew with four times the
cells, from ``CELLS`` up; after ``TRIES`` sizes the digests themselves are compared. With d differing
paragraphs between texts of a and b paragraphs, the likeness is (a + b - d) / (a + b + d): the
Jaccard similarity of the paragraph sets; two empty sets have likeness 1.

Null texts count as empty, which have no paragraph. Rows that repeat both doc_id and text are one
version in the order of documents, and each of them gets its result. Rows that share a doc_id with
different texts are documents of their own, ordered by a hash of the text. A null doc_id comes
before all others. A single document is followed by itself. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecell.llm.common import global_index, texts, written

HEAD_PIECES, HEAD_LONG, REST_LONG = 12, 120, 600
FINE = r"[\r\n]+|(?<=[d.,;:!?]) +|(?<=[\u3000-\u303f\uff00-\uff1f])"
COARSE = r"[\r\n]+|(?<=[.!?]) +(?=[AÀ])|(?<=\u3002)"
CELLS = 8
SPARSE = 4                  # cells of a subtable for each expected digest, at least
TRIES = 9
SAMPLE = 16
ROUNDS = 40


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _paragraphs(pieces: Column, longest: int) -> Column:
    return F.flatten(F.transform(pieces, lambda x: F.when(
        F.length(x) > longest, F.regexp_extract_all(x, F.lit(f"(?s).{{1,{longest}}}"), F.lit(0))).otherwise(F.array(x))))


def digests(text: Column) -> Column:
    """Digests of the text's paragraphs: distinct longs, ascending."""
    def of(parts):
        rest = F.coalesce(F.get(parts, F.lit(HEAD_PIECES)), F.lit(""))
        return F.concat(_paragraphs(F.slice(parts, 1, HEAD_PIECES), HEAD_LONG), _paragraphs(F.split(rest, COARSE), REST_LONG))

    units = F.filter(F.transform(let(F.split(text, FINE, HEAD_PIECES + 1), of), lambda x: F.trim(x)), lambda x: x != "")
    return F.sort_array(F.array_distinct(F.transform(units, lambda x: F.xxhash64(x))))


def _check(d: Column) -> Column:
    return F.xxhash64(d)


def _entries(keys: Column, sign: int, cells: Column) -> Column:
    """A cell entry for each digest and subtable. Digests are hashes: their lowest, middle and
    highest bits give the three places."""
    def three(d):
        return F.array(*[F.struct(
            (F.shiftrightunsigned(d, 20 * t).bitwiseAND((cells - 1).cast("long")) + F.lit(t << 48)).alias("cell"),
            F.lit(sign).alias("n"), d.alias("key"), _check(d).alias("check")) for t in range(3)])
    return F.flatten(F.transform(keys, three))


def _merge(entries: Column) -> Column:
    """Entries of the same cell added up, empty cells left out: sort, then sum each run."""
    def runs(s):
        starts = F.filter(F.sequence(F.lit(1), F.size(s)),
                          lambda i: (i == 1) | (F.get(s, i - 1)["cell"] != F.get(s, i - 2)["cell"]))
        # most runs have one entry, or two that cancel out
        return let(starts, lambda at: F.transform(at, lambda st, j: let(
            F.coalesce(F.get(at, j + 1), F.size(s) + 1) - st,
            lambda n: F.when(n == 1, F.get(s, st - 1)).when(n == 2, add(F.get(s, st - 1), F.get(s, st)))
            .otherwise(F.aggregate(F.slice(s, st + 1, n - 1), F.get(s, st - 1), add)))))

    def add(a, x):
        return F.struct(a["cell"].alias("cell"), (a["n"] + x["n"]).alias("n"), a["key"].bitwiseXOR(x["key"]).alias("key"),
                        a["check"].bitwiseXOR(x["check"]).alias("check"))

    def made(s):
        return F.filter(runs(s), lambda c: (c["n"] != 0) | (c["key"] != 0) | (c["check"] != 0))

    # sort_array compares values directly; array_sort would interpret a comparator at each step.
    return let(F.sort_array(entries), lambda s: F.when(F.size(s) == 0, s).otherwise(made(s)))


def table(keys: Column, cells) -> Column:
    """The non-empty cells of an IBLT with ``cells`` cells in each subtable."""
    return _merge(_entries(keys, 1, F.lit(cells)))


def _round(state: Column, cells: Column) -> Column:
    """Take all pure cells at once."""
    def take(p):
        gone = F.concat(_entries(p["plus"], -1, cells), _entries(p["minus"], 1, cells))
        return F.struct(_merge(F.concat(state["cells"], gone)).alias("cells"),
                        F.concat(state["plus"], p["plus"]).alias("plus"),
                        F.concat(state["minus"], p["minus"]).alias("minus"),
                        ((F.size(p["plus"]) == 0) & (F.size(p["minus"]) == 0)).alias("stuck"))

    return let(F.struct(_pure(state["cells"], 1).alias("plus"), _pure(state["cells"], -1).alias("minus")), take)


def _pure(cells: Column, n: int) -> Column:
    """Digests of the cells that hold one digest of this side."""
    # Distinct longs go through a hash set; distinct structs would be compared pair by pair.
    return F.array_distinct(F.transform(F.filter(cells, lambda c: (c["n"] == n) & (_check(c["key"]) == c["check"])),
                                        lambda c: c["key"]))


def difference(a: Column, b: Column) -> Column:
    """Digests in a only (plus) and in b only (minus), recovered from the two tables' difference;
    tries: tables made. a and b are sets of digests."""
    none = F.array().cast("array<bigint>")

    def peeled(t, cells):
        """All rounds, from the table's cells."""
        start = F.struct(t.alias("cells"), none.alias("plus"), none.alias("minus"), F.lit(False).alias("stuck"))
        end = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start,
                          lambda s, _: F.when((F.size(s["cells"]) == 0) | s["stuck"], s).otherwise(_round(s, cells)))
        return let(end, lambda e: F.struct((F.size(e["cells"]) == 0).alias("done"), e["plus"].alias("plus"), e["minus"].alias("minus")))

    def looked(t, cells):
        """Each digest is in three cells, so its XOR stays in that of all cells: if the digests of the pure cells
        make up the table's count, XOR and XOR of checks, one look has recovered all and nothing is left to
        remove. Digests alone may cancel out, as four consecutive numbers do."""
        def judge(p):
            n = F.aggregate(t, F.lit(0), lambda x, c: x + c["n"])
            xor = F.aggregate(t, F.lit(0).cast("long"), lambda x, c: x.bitwiseXOR(c["key"]))
            found = F.aggregate(F.concat(p["plus"], p["minus"]), xor, lambda x, k: x.bitwiseXOR(k))
            checks = F.aggregate(t, F.lit(0).cast("long"), lambda x, c: x.bitwiseXOR(c["check"].cast("long")))
            seen = F.aggregate(F.concat(p["plus"], p["minus"]), checks, lambda x, k: x.bitwiseXOR(_check(k).cast("long")))
            return F.when(((F.size(p["plus"]) - F.size(p["minus"])) * 3 == n) & (found == 0) & (seen == 0), F.struct(
                F.lit(True).alias("done"), p["plus"].alias("plus"), p["minus"].alias("minus"))).otherwise(peeled(t, cells))
        return let(F.struct(_pure(t, 1).alias("plus"), _pure(t, -1).alias("minus")), judge)

    def attempt(st, cells):
        made = _merge(F.concat(_entries(a, 1, cells), _entries(b, -1, cells)))
        return let(let(made, lambda t: looked(t, cells)),
                   lambda e: F.struct(e["done"], e["plus"], e["minus"], (st["tries"] + 1).alias("tries")))

    begin = F.struct(F.lit(False).alias("done"), none.alias("plus"), none.alias("minus"), F.lit(0).alias("tries"))
    # Where to begin: the smallest digests of both sets are a sample of their union, whose overlap
    # estimates the difference. A table much smaller than that can't be peeled and isn't tried.
    same = F.size(F.array_intersect(F.slice(a, 1, SAMPLE), F.slice(b, 1, SAMPLE))) / F.lit(float(SAMPLE))
    least = F.greatest(F.abs(F.size(a) - F.size(b)).cast("double"),
                       (F.size(a) + F.size(b)) * (F.lit(1.0) - same) / (F.lit(1.0) + same))
    sizes = F.array(*[F.lit(CELLS << 2 * k) for k in range(TRIES)])
    got = let(least, lambda low: F.aggregate(F.filter(sizes, lambda c: (c >= SPARSE * low) | (c == CELLS << 2 * (TRIES - 1))),
                                             begin, lambda s, c: F.when(s["done"], s).otherwise(attempt(s, c))))
    exact = F.struct(F.lit(True).alias("done"), F.array_except(a, b).alias("plus"), F.array_except(b, a).alias("minus"),
                     F.lit(TRIES + 1).alias("tries"))
    return let(got, lambda g: F.when(g["done"], g).otherwise(exact))


def likeness(a: Column, b: Column) -> Column:
    """(a + b - d) / (a + b + d) for two sets of digests, as ``digests`` gives them (ascending)."""
    d = let(difference(a, b), lambda g: F.size(g["plus"]) + F.size(g["minus"])).cast("double")
    both = (F.size(a) + F.size(b)).cast("double")
    return F.when(a == b, 1.0).otherwise((both - d) / (both + d))


def fingerprint(keys: Column) -> Column:
    """The table of ``CELLS`` cells as text: paragraphs, then cell.count.digests.checks each."""
    cell = F.transform(table(keys, CELLS), lambda c: F.concat_ws(
        ".", F.hex(F.shiftright(c["cell"], 48) * CELLS + c["cell"].bitwiseAND(F.lit(0xFFFFFFFF))),
        c["n"].cast("string"), F.hex(c["key"]), F.hex(c["check"].bitwiseAND(F.lit(0xFFFFFFFF)))))
    return F.concat_ws("-", F.size(keys).cast("string"), F.array_join(cell, "-"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every document."""
    return texts(docs).select("doc_id", fingerprint(digests(F.col("text"))).alias("fingerprint"))


def compare_versions(docs: DataFrame) -> DataFrame:
    """Every text, its edited version (the last third replaced by the start of the next document in
    descending doc_id order) and the next document, compared by their fingerprints."""
    # id and h name a text: doc_id (a null one as the smallest number) and a hash of the text, its
    # bits turned over if doc_id is null. Both joins read these four columns and no other, so that
    # they share one shuffle of the texts, and digests are made once, before it.
    least, of_text = F.lit(-(1 << 63)), F.xxhash64("text")
    base = texts(docs).select(F.coalesce(F.col("doc_id").cast("long"), least).alias("id"),
                              F.when(F.col("doc_id").isNull(), F.bitwise_not(of_text)).otherwise(of_text).alias("h"),
                              "text", digests(F.col("text")).alias("own"))
    doc_id = F.when((F.col("id") > least) | (F.col("h") == of_text), F.col("id")).cast(docs.schema["doc_id"].dataType)
    ids = base.select("id", "h", F.length("text").alias("n")).distinct()
    ids = written(global_index(ids, ["id", "h"], "iblt-order", "i"), "iblt-ids")
    total = ids.count()
    # Each text serves as the next of the one after it; the last one, of the first.
    after = ids.select(F.col("id").alias("for_id"), F.col("h").alias("for_h"),
                       F.pmod(F.col("i") - 1, F.lit(max(total, 1))).alias("i"), F.floor(F.col("n") / 3).alias("k"))
    link = ids.select("id", "h", "i").join(after, "i").drop("i")
    # Only the leads and the digests of the next texts are shuffled besides (once for repeated rows).
    start = (base.hint("merge").join(link, ["id", "h"])
             .select(F.col("for_id").alias("id"), F.col("for_h").alias("h"),
                     F.struct(F.substring("text", F.lit(1), F.col("k").cast("int")).alias("lead"),
                              F.col("own").alias("next")).alias("s"))
             .groupBy("id", "h").agg(F.first("s").alias("s")).select("id", "h", "s.lead", "s.next"))
    n = F.length("text")
    both = base.hint("merge").join(start, ["id", "h"]).select(
        doc_id.alias("doc_id"), n.cast("long").alias("n_chars"), "own",
        F.concat(F.substring("text", F.lit(1), (n - F.floor(n / 3)).cast("int")), "lead").alias("edited"), "next")
    got = both.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                      F.struct(F.col("own"), digests(F.col("edited")).alias("edited"), F.col("next")).alias("d"))
    d = F.col("d")
    return got.select(
        "doc_id", "n_chars", "edited_sha256",
        let(d["own"], fingerprint).alias("fingerprint"), let(d["edited"], fingerprint).alias("edited_fingerprint"),
        let(d, lambda x: likeness(x["own"], x["edited"])).alias("near_edited"),
        let(d, lambda x: likeness(x["own"], x["next"])).alias("near_next"))
