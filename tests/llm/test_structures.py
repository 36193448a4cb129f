"""Nearest neighbours, fingerprints, near-duplicates, WARC and the pipeline against brute force."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
import public_tokenizers
from ratecell.llm import ann_mih, bpe_fst, iblt, neardup_icws, warc
from ratecell.llm.common import scratch

SF = "/root/testdata/sf0.001"


# --- nearest neighbours -----------------------------------------------------------------------------

def nearest(rows, q, k=10):
    d = sorted((math.dist(v, rows[q]), i) for i, v in rows.items() if i != q)
    return [i for _, i in d[:k]]


def test_neighbours_recall_and_scores(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = {r.vec_id: np.array(r.embedding, float) for r in e.collect()}
    got = {}
    for r in ann_mih.search(e, e.where("vec_id % 100 = 0"), "vec_id", "embedding").collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r
    assert set(got) == {i for i in rows if i % 100 == 0}
    hits = 0
    for q, ranks in got.items():
        assert sorted(ranks) == list(range(1, 11))
        hits += len({r.vec_id for r in ranks.values()} & set(nearest(rows, q)))
        for r in ranks.values():
            assert abs(r.score - math.dist(rows[q], rows[r.vec_id])) < 1e-9
    assert hits / (10 * len(got)) >= 0.9


def test_neighbours_edges(spark):
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(30)]
    rows += [(100, rows[0][1]), (200, rows[0][1]), (300, [0.0] * 4), (400, None), (500, [1.0, None, 0.0, 0.0]),
             (600, [float("nan"), 1.0, 1.0, 1.0]), (700, [float("inf"), 0.0, 0.0, 0.0]), (800, [1.0]), (None, rows[1][1]), rows[0]]
    e = spark.createDataFrame([(i, v, 1.5, "x") for i, v in rows], "vec_id long, embedding array<double>, score double, block string")
    got = [tuple(x) for x in ann_mih.search(e, e.where("vec_id % 100 = 0"), "vec_id", "embedding").collect()]
    ok = {i: v for i, v in rows if i is not None and (i < 300)}
    for q in (0, 100, 200):
        mine = [v for a, k, v, s in sorted(got) if a == q]
        assert mine[:2] == sorted({0, 100, 200} - {q}) and len(mine) == 10
        assert mine == nearest(ok, q)
    assert {a for a, *_ in got} == {0, 100, 200}
    few = e.where("vec_id IN (0, 100, 300)")
    assert [tuple(x) for x in ann_mih.search(few, few, "vec_id", "embedding").orderBy("query_id").collect()] == [
        (0, 1, 100, 0.0), (100, 1, 0, 0.0)]
    assert ann_mih.search(e.limit(0), e, "vec_id", "embedding").count() == 0


def test_neighbours_over_many_blocks(spark, monkeypatch):
    """Small blocks and batches, every code within the radius: the exact neighbours, whatever the blocks; ids as text."""
    monkeypatch.setattr(ann_mih, "BLOCK_ROWS", 40)
    learn = ann_mih.learn
    monkeypatch.setattr(ann_mih, "learn", lambda v, k: (learn(v, k)[0], 10_000))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        r = random.Random(2)
        rows = {f"id{i:03d}": [float(r.randrange(-2, 3)) for _ in range(5)] + [1.0] for i in range(300)}
        e = spark.createDataFrame(list(rows.items()), "vec_id string, embedding array<double>")
        got = {}
        for q, rank, v, _ in ann_mih.search(e, e.where("vec_id < 'id090'"), "vec_id", "embedding", 7).collect():
            got.setdefault(q, {})[rank] = v
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 90
    for q, ranks in got.items():
        assert [ranks[i] for i in range(1, 8)] == nearest(rows, q, 7)


def test_probing_finds_every_code_within_the_radius():
    codes = np.random.default_rng(0).integers(0, 65536, (500, 4), dtype=np.uint16)
    codes[1::2] = codes[::2] ^ (1 << np.random.default_rng(1).integers(0, 16, (250, 4))).astype(np.uint16)
    index = ann_mih.Index(codes)
    for radius in (0, 1, 3, 4, 5, 9, 20, 30, 64):
        for q in range(0, 40, 7):
            rows, dist = index.within(codes[q], radius)
            want = np.flatnonzero(ann_mih.hamming(codes, codes[q]) <= radius)
            assert np.array_equal(rows, want)


# --- fingerprints -----------------------------------------------------------------------------------

def paragraphs(text):
    """The cut rule character by character."""
    def pieces(text, ends, nexts, zero, most):
        out, at, i = [], 0, 0
        while i < len(text) and len(out) < most:
            end = i
            while end < len(text) and text[end] in "\r\n":
                end += 1
            if end == i and i and text[i - 1] in ends:
                while end < len(text) and text[end] == " ":
                    end += 1
                while end > i and nexts and not (end < len(text) and text[end] in nexts):
                    end -= 1
            if end > i or (i > at and text[i - 1] in zero):
                out.append(text[at:i])
                at = end
                i = max(end, i + 1) if end == i else end
            else:
                i += 1
        return out, text[at:]

    head, rest = pieces(text, "d.,;:!?", "", "".join(map(chr, [*range(0x3000, 0x3040), *range(0xFF00, 0xFF20)])), iblt.HEAD_PIECES)
    if len(head) < iblt.HEAD_PIECES:
        head, rest = [*head, rest], ""
    more, last = pieces(rest, ".!?", "AÀ", "。", 10 ** 9)
    out = set()
    for found, long in ((head, iblt.HEAD_LONG), ([*more, last], iblt.REST_LONG)):
        for x in found:
            out |= {x[i:i + long].strip(" ") for i in range(0, len(x), long)}
    return out - {""}


def jaccard(a, b):
    return 1.0 if a == b else len(a & b) / len(a | b)


DOCS = [(3, None), (8, ""), (5, "one\ntwo\nthree\nfour\nfive\nsix"), (6, "one\ntwo\nthree\nfour\nfive\nsix"),
        (7, "é" * 10), (12, "A. B! " * 300), (9, "\n".join(f"line {i}" for i in range(3000))), (15, "one\ntwo\n\none"), (15, "other"),
        (20, "x"), (20, "x")]


def test_fingerprints(spark):
    docs = spark.createDataFrame([(d, t, 5, "l", "f") for d, t in DOCS], "doc_id long, text string, n_chars long, lead string, h string")
    got = iblt.compare_versions(docs).collect()
    assert len(got) == len(DOCS)
    prints = {}
    for r in got:
        prints.setdefault(r.fingerprint, set()).add(r.doc_id)
    assert {frozenset(x) for x in prints.values()} >= {frozenset({3, 8}), frozenset({5, 6})}
    uniq = {d: t or "" for d, t in DOCS if d != 15}
    order = sorted({*uniq, 15}, reverse=True)
    for r in got:
        if r.doc_id == 15:
            continue
        t, nxt = uniq[r.doc_id], order[(order.index(r.doc_id) + 1) % len(order)]
        if nxt == 15:
            continue                                   # two texts share this id: ordered by a hash
        k = len(t) // 3
        edited = t[:len(t) - k] + uniq[nxt][:k]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(paragraphs(t), paragraphs(edited)))
        assert r.near_next == pytest.approx(jaccard(paragraphs(t), paragraphs(uniq[nxt])))
    assert iblt.compare_versions(docs.limit(0)).count() == 0
    assert iblt.compare_versions(docs.where("doc_id = 5")).first().near_next == 1.0


def test_fingerprints_of_all_texts_follow_the_cut_rule(spark):
    """Every text of a table against the brute-force cut: number of digests, likeness to the edited text and
    to the next; texts over 100 characters keep some likeness to their edited text."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts_ = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(texts_, reverse=True)
    got, none = iblt.compare_versions(docs).collect(), []
    assert len(got) == len(texts_)
    for r in got:
        t, nxt = texts_[r.doc_id], texts_[order[(order.index(r.doc_id) + 1) % len(order)]]
        edited = t[:len(t) - len(t) // 3] + nxt[:len(t) // 3]
        own = paragraphs(t)
        assert int(r.fingerprint.split("-")[0]) == len(own)
        assert r.near_edited == pytest.approx(jaccard(own, paragraphs(edited)))
        assert r.near_next == pytest.approx(jaccard(own, paragraphs(nxt)))
        if len(t) > 100 and not r.near_edited:
            none.append(r.doc_id)
    assert len(none) <= len(got) // 100


def test_fingerprints_of_few_lines_stay_alike(spark):
    r = random.Random(6)
    words = ["".join(r.choice("abcdefghilmnorstu") for _ in range(r.randint(2, 8))) for _ in range(500)]
    run = [r.choice(words) for _ in range(400)]
    han = "".join(chr(r.randrange(0x4E00, 0x5200)) for _ in range(900))
    texts_ = [" ".join(run), ", ".join(run), "word " * 500, han, "。".join(han[i:i + 9] for i in range(0, 900, 9)),
              " ".join(run[:30])]
    rows = [(t, t[:len(t) - len(t) // 3] + "".join(r.choice("xyz ") for _ in range(len(t) // 3))) for t in texts_]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [x.p for x in df.select(iblt.likeness(iblt.digests(F.col("a")), iblt.digests(F.col("b"))).alias("p")).collect()]
    assert min(got) > 0, got
    assert spark.createDataFrame([("z" + texts_[0], texts_[0])], "a string, b string").select(
        iblt.likeness(iblt.digests(F.col("a")), iblt.digests(F.col("b"))).alias("p")).first().p > 0.9


def test_peeling_recovers_both_sides_and_retries(spark):
    rows = [(list(range(n)), list(range(n - c, n + d))) for n, c, d in ((0, 0, 0), (5, 5, 0), (40, 40, 1), (400, 300, 50), (30, 0, 200))]
    # sets whose smallest digests agree: the first table is far too small
    rows.append(([*range(16), *range(1000, 1400)], [*range(16), *range(2000, 2400)]))
    df = spark.createDataFrame(rows, "a array<bigint>, b array<bigint>")
    got = df.select("a", "b", iblt.difference(F.col("a"), F.col("b")).alias("d")).collect()
    for r in got:
        assert set(r.d.plus) == set(r.a) - set(r.b) and set(r.d.minus) == set(r.b) - set(r.a)
        assert len(r.d.plus) == len(set(r.d.plus)) and r.d.tries <= iblt.TRIES
    assert max(r.d.tries for r in got) > 1


# --- near-duplicates ----------------------------------------------------------------------------------

def test_cells_compare_each_pair_of_components_once():
    """More strays than are compared at once, among members that some bands leave out."""
    nd, rng = neardup_icws, np.random.default_rng(5)
    base = rng.integers(0, 2 ** 32, (6, nd.K), dtype=np.uint32)
    members, strays = 150, 2 * nd.STEP + 9
    sig = base[rng.integers(0, 6, members + strays)]
    other = rng.random(sig.shape) < 0.35
    sig[other] = rng.integers(0, 2 ** 32, other.sum(), dtype=np.uint32)
    node = np.r_[np.arange(members), np.arange(1000, 1000 + strays)]
    out = np.r_[rng.random(members) < 0.3, np.ones(strays, bool)]
    root = np.where(rng.random(members + strays) < 0.2, 0, node)
    stray = np.r_[np.zeros(members, bool), np.ones(strays, bool)]
    pdf = pd.DataFrame({"band": 3, "key": 1, "i": 0, "j": 0, "node": node, "root": root, "out": out, "stray": stray,
                        "sig": [r.tobytes() for r in sig]})
    want = set()
    for x in range(members, members + strays):
        for y in range(members):
            same = sig[x] == sig[y]
            earlier = same.reshape(nd.BANDS, nd.ROWS).all(axis=1)[:3].any()
            if root[x] != root[y] and (not out[y] or node[y] < node[x]) and same.mean() >= nd.ESTIMATE and not earlier:
                want |= {node[x], node[y]}
    assert 20 < len(want) < members + strays
    assert set(nd._compare(False, 0.8)((3, 1, 0, 0), pdf.sample(frac=1, random_state=1))["node"]) == want


def classes_by_hand(rows, n, df):
    """Connected components of all pairs."""
    ids, text = [d for d, _ in rows], [t or "" for _, t in rows]
    sets = neardup_icws.shingles(text, neardup_icws.idf(n, df))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if text[i] == text[j] or (len(sets[i][0]) and neardup_icws.similarity(sets[i], sets[j]) >= 0.8):
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return {d: low[find(i)] for i, d in enumerate(ids)}


def test_classes_equal_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: r.class_id for r in neardup_icws.classes(docs).collect()}
    assert got == classes_by_hand([tuple(r) for r in docs.collect()], *neardup_icws.document_frequency(docs))


def test_classes_edges_and_hot_groups(spark):
    r = random.Random(2)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    base = [r.choice(vocab) for _ in range(120)]
    rows = [(1, None), (2, ""), (3, "one two"), (4, "One  two"), (5, "one two three"), (6, " ".join(vocab * 60))]
    for i in range(10, 110):                            # a large group of near copies, another of exact ones
        w = list(base)
        for _ in range(r.randint(0, 3)):
            w[r.randrange(120)] = r.choice(vocab)
        rows.append((i, " ".join(w)))
    rows += [(i, "the same words in each of these many documents") for i in range(200, 260)]
    rows += [(i, " ".join(base[:20] + [r.choice(vocab) for _ in range(100)])) for i in range(300, 340)]   # a shared passage
    docs = spark.createDataFrame([(d, t, "s", 1) for d, t in rows], "doc_id long, text string, sig string, node long")
    got = {x.doc_id: x.class_id for x in neardup_icws.classes(docs).collect()}
    assert got == classes_by_hand(rows, *neardup_icws.document_frequency(docs))
    assert got[2] == 1 and got[4] == 3 and got[5] == 5
    kept = neardup_icws.drop_copies(docs.unionByName(docs.where("doc_id = 3")))
    assert kept.columns == docs.columns
    assert sorted(x.doc_id for x in kept.collect()) == sorted(set(got.values()))
    assert neardup_icws.classes(docs.limit(0)).count() == 0


def test_cells_hold_every_pair_of_components_once_and_strays_cost_little(spark, monkeypatch):
    monkeypatch.setattr(neardup_icws, "BLOCK", 8)
    many = [(0, 7, n, 1000) for n in range(500)] + [(0, 7, 500, 500)]                   # one stray among copies
    some = [(1, 8, n, n % 5) for n in range(60)] + [(2, 9, n, 1) for n in range(30)]      # the last bucket is closed
    rows = spark.createDataFrame(many + some, "band int, key long, node long, root long")
    cells = neardup_icws._cells(rows).collect()
    assert sum(x.band == 0 for x in cells) == 501 + -(-501 // 8)
    assert not [x for x in cells if x.band == 2]
    for band, members in ((0, many), (1, some[:60])):
        groups = {}
        for x in cells:
            if x.band == band:
                groups.setdefault((x.i, x.j), []).append(x)
        assert max(map(len, groups.values())) < 60
        pairs = [frozenset((a.node, b.node)) for g in groups.values() for a in g if a.stray for b in g
                 if not b.stray and a.root != b.root and (not b.out or b.node < a.node)]
        assert len(pairs) == len(set(pairs))
        assert set(pairs) == {frozenset((a[2], b[2])) for a in members for b in members if a[3] != b[3]}


def test_classes_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(neardup_icws, "BLOCK", 4)
    test_classes_edges_and_hot_groups(spark)


def test_components_of_random_graphs(spark):
    r = random.Random(12)
    edges = [(r.randrange(3000), r.randrange(3000)) for _ in range(1400)] + [(i, i + 1) for i in range(4000, 4060)]
    edges += [(5000, i) for i in range(5001, 5400)] + [(6000 - i, 5000 - i) for i in range(3)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = neardup_icws.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    assert {x.node: x.root for x in got} == {x: find(x) for x in root if find(x) != x}
    assert len(got) == len({x.node for x in got})


def test_only_copies_are_dropped_whatever_the_ids(spark):
    r = random.Random(8)
    vocab = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    text = [" ".join(r.choice(vocab) for _ in range(80)) for _ in range(7)]
    near = text[1] + " " + vocab[0]                   # a near copy of text 1
    rows = [(None, text[0]), (None, text[1]), (None, text[2]), (None, text[2]), (None, near), (5, text[3]), (5, text[4]),
            (5, text[4]), (6, text[4]), (7, text[5]), (None, text[5]), (8, None), (9, ""), (None, None), (5, text[6]), (10, near)]
    docs = spark.createDataFrame([(d, t, "s", i) for i, (d, t) in enumerate(rows)], "doc_id long, text string, node string, n long")
    kept = neardup_icws.drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(((x.doc_id, x.text) for x in kept.collect()), key=str) == sorted(
        [(None, text[0]), (10, near), (None, text[2]), (5, text[3]), (5, text[4]), (7, text[5]), (8, None), (5, text[6])], key=str)
    got = {(x.doc_id, x.class_id) for x in neardup_icws.classes(docs).collect()}
    assert got == {(None, None), (None, 10), (10, 10), (5, 5), (6, 5), (7, 7), (None, 7), (8, 8), (9, 8), (None, 8)}


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(4)
    pairs = []
    for _ in range(60):
        s = np.sort(rng.integers(0, 2**63, 300).astype(np.uint64))
        w = rng.uniform(1, 9, 300).astype(np.float32)
        keep = rng.random(300) < 0.8
        a, b = (s, w), (s[keep], (w[keep] * 1.1).astype(np.float32))
        pairs.append((np.mean(neardup_icws.samples([a])[0] == neardup_icws.samples([b])[0]), neardup_icws.similarity(a, b)))
    est, exact = np.mean(pairs, axis=0)
    assert abs(est - exact) < 0.03


# --- WARC ---------------------------------------------------------------------------------------------

def test_warc_equals_sql(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    big = pages.where("page_id < 5").selectExpr("page_id + 100000 AS page_id", "url", "repeat(html, 40) AS html")
    copies = pages.where("page_id < 9").selectExpr("page_id + 200000 AS page_id", "url", "html")
    pages = pages.unionByName(big).unionByName(copies)
    got = sorted(map(tuple, warc.round_trip(pages).collect()))
    con = duckdb.connect()
    con.register("pages", pages.toPandas())
    want = sorted(con.sql(f"SELECT page_id, payload_bytes, payload_digest, record_type, refers_to FROM ({warc.ORACLE})").fetchall())
    assert got == want
    assert any(r[3] == "revisit" for r in got)


def test_warc_edges(spark):
    rows = [(1, None, None), (2, "u\r\nx", ""), (3, "u", "é" * 60000), (4, "v", "é" * 60000), (4, "v", "é" * 60000), (None, "w", "a"),
            (6, "w", "a" * 999), (7, "w", "a" * 999), (8, "w", "0\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "s") for r in rows], "page_id long, url string, html string, sha1 string")
    folder = scratch(spark, "warc-test")
    got = sorted(map(tuple, warc.round_trip(pages, folder).collect()), key=str)
    want = []
    for p, _, h in rows:
        b = (h or "").encode()
        last = 4 if len(b) > 999 else None
        refers = last if last and p < last else None
        want.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if refers else "response", refers))
    assert got == sorted(want, key=str)
    rec = warc.read_records(spark, folder)
    assert rec.where("type = 'continuation'").count() > 0
    # a lost segment, and one that comes twice, are noticed
    for broken in (rec.where("NOT coalesce(segment = 2, false)"), rec.unionByName(rec.where("segment = 2")),
                   rec.where("total IS NULL")):
        bad = warc.reassemble(broken).where("NOT complete").collect()
        assert bad and all(r.block is None for r in bad)
    assert warc.reassemble(rec).where("NOT complete").count() == 0
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_chunked_framing():
    for n in (0, 1, 4096, 10000):
        data = random.Random(n).randbytes(n)
        assert warc.unchunked(warc.chunked(data)) == data
    assert warc.unchunked(b"3;x=y\r\nabc\r\n0\r\n\r\n") == b"abc"
    assert warc.unchunked(b"5\r\nabc\r\n0\r\n\r\n") is None and warc.unchunked(b"zz\r\n") is None


def test_warc_reads_only_what_was_committed(spark):
    """A file that a lost attempt left in the folder changes nothing."""
    pages = spark.createDataFrame([(k, f"u{k}", f"<p>{k % 4}</p>" * 300) for k in range(20)], "page_id long, url string, html string")
    folder = scratch(spark, "warc-stale")
    files = warc.write_archives(pages, folder)
    before = sorted(map(tuple, warc.read_records(spark, folder, files).select("type", "id").collect()))
    stale = warc.write_archives(pages.where("page_id < 3"), folder)          # another attempt's files
    assert warc.read_records(spark, folder).count() > len(before) == 20
    assert sorted(map(tuple, warc.read_records(spark, folder, files).select("type", "id").collect())) == before
    assert not {r.name for r in stale.collect()} & {r.name for r in files.collect()}
    assert warc.read_records(spark, folder, files.limit(0)).count() == 0


def test_warc_segments_in_several_files(spark, tmp_path):
    """Segments of one record in files of their own meet by origin; one that is missing leaves no payload."""
    payload = bytes(random.Random(2).randrange(97, 123) for _ in range(60_000))
    sha = hashlib.sha1(payload).hexdigest()
    whole, broken = (warc.page_records(f"{k}:x", "u", payload, sha, None) for k in (1, 2))
    assert len(whole) > 2
    names = []
    for n, parts in enumerate([[whole[1]], [whole[0], *whole[2:], *broken[:-1]], warc.page_records("3:x", "u", b"<p>", "00" * 20, None)]):
        names.append((f"f{n}.warc.gz",))
        (tmp_path / names[-1][0]).write_bytes(b"".join(parts))
    files = spark.createDataFrame(names, "name string")
    got = {r.id: (r.payload_bytes, r.payload_digest) for r in warc.read_digests(spark, str(tmp_path), files).collect()}
    assert got == {"<urn:page:1:x>": (60_000, sha), "<urn:page:2:x>": (None, None),
                   "<urn:page:3:x>": (3, hashlib.sha1(b"<p>").hexdigest())}


# --- pipeline -------------------------------------------------------------------------------------------

def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    now, before = docs, set(rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, SF)
        assert now.columns == docs.columns
        path = scratch(spark, "pipeline-test")
        now.write.parquet(path)
        now = spark.read.parquet(path)
        kept = [r.doc_id for r in now.collect()]
        assert set(kept) <= before
        if name == "quality":
            assert np.mean([labels[d] for d in set(labels) & set(kept)]) > 0.95
            good = [d for d in labels if labels[d] == 1]
            assert len(set(good) & set(kept)) > 0.97 * len(good)
        if name == "near_duplicates":
            assert len(kept) == len(set(kept)) == len({rows[d].text for d in kept})
        before = set(kept)
    final = corpus_pipeline.STAGES[-1][1](spark, now, SF).collect()
    assert sorted(r.doc_id for r in final) == sorted(kept)
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                            mergeable_ranks=bpe_fst.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    for r in final[:20]:
        assert np.frombuffer(r.ids, "<u4").tolist() == tik.encode_ordinary(rows[r.doc_id].text)
    assert all(r.decoded_sha256 == hashlib.sha256(rows[r.doc_id].text.encode()).hexdigest() for r in final)


def test_pipeline_edges(spark):
    """Null, empty, repeated and extra data pass through every stage."""
    rows = [(1, None, "en", "a", 0, 0.1), (2, "", None, None, 0, 0.2), (None, "the cat and the dog", "en", "a", 19, 0.3),
            (4, "the cat", "en", None, 7, 0.4), (4, "the cat", "en", None, 7, 0.4), (5, "der Hund " * 5000, "de", "b", 45000, 0.5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double")
    for name, stage in corpus_pipeline.STAGES:
        for d in (docs, docs.limit(0)):
            got = stage(spark, d, SF)
            got.collect()
            if name != "bpe":
                assert got.columns == docs.columns


def test_no_link_of_all_pairs_is_lost():
    """The different texts of sf0.1: every pair at 0.8 or more, found by an exact prefix filter (two such texts share
    one of the rarest shingles that hold a fifth of the weight), shares a band and isn't ruled out by its estimate."""
    n, df, text = 0, np.zeros(1 << neardup_icws.DF_BITS, np.int64), []
    for batch in pq.ParquetDataset("/root/testdata/sf0.1/documents.parquet").read(["text"]).to_batches(200):
        part = [t or "" for t in batch.column(0).to_pylist()]
        h, doc = neardup_icws._words(part)
        df += np.bincount(np.unique(doc << neardup_icws.DF_BITS | neardup_icws._slot(h)) & (len(df) - 1), minlength=len(df))
        n, text = n + len(part), text + part
    text, weight, sets = [t for t in dict.fromkeys(text) if t.strip()], neardup_icws.idf(n, df), []
    for a in range(0, len(text), 200):
        sets += neardup_icws.shingles(text[a:a + 200], weight)
    seen, count = np.unique(np.concatenate([s for s, _ in sets]), return_counts=True)
    post, links = {}, []
    for i, (s, w) in enumerate(sets):
        often = count[np.searchsorted(seen, s)]
        order = np.lexsort((s, often))
        upto = np.cumsum(w[order].astype(float))
        first = order[:np.searchsorted(upto, 0.2001 * upto[-1], side="right") + 1]
        near = set()
        for shingle in s[first[often[first] > 1]].tolist():
            near.update(post.setdefault(shingle, []))
            post[shingle].append(i)
        links += [(i, j) for j in near if neardup_icws.similarity(sets[i], sets[j]) >= 0.8]
    assert len(links) > 40
    for i, j in links:
        a, b = neardup_icws.samples([sets[i], sets[j]])
        same = a == b
        assert same.reshape(neardup_icws.BANDS, neardup_icws.ROWS).all(axis=1).any() and same.mean() >= neardup_icws.ESTIMATE


def test_warc_reading_feeds_each_byte_about_once(monkeypatch):
    """A file of many small members is read in time linear in its size."""
    whole = b"".join(warc.record("response", [("WARC-Record-ID", f"<{k}>")], b"%d" % k * 300) for k in range(2000))
    fed, make = [], warc.zlib.decompressobj

    class Counting:
        def __init__(self, bits):
            self.z = make(bits)

        def decompress(self, data):
            fed.append(len(data))
            return self.z.decompress(data)

        def __getattr__(self, name):
            return getattr(self.z, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Counting)
    got = list(warc.records(whole))
    assert [(f["warc-record-id"], b) for f, b in got] == [(f"<{k}>", b"%d" % k * 300) for k in range(2000)]
    assert sum(fed) <= len(whole) + 2000 * warc.READ_BYTES
