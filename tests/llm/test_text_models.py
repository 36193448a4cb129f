"""Quality classifier, language ID and mixing: held-out accuracy, oracle, edge cases."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pytest

from ratecell.llm import langid_hd, mixing, quality_ftrl

SF = "/root/testdata/sf0.01"
# extra columns with names that the operators use themselves
EDGE = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, h string, times int"


def edge_docs(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 7, "h", 3) for r in rows], EDGE)


ROWS = [(1, None, "en", "a", 0), (2, "", "en", None, 0), (3, "the cat and the dog " * 3000, "en", "a", 60000),
        (4, "le chat et le chien", "fr", "b", 19), (4, "le chat et le chien", "fr", "b", 19), (5, "!!! 123", None, "b", 7),
        (None, "the cat", "en", None, 7), (6, "der Hund und die Katze", "de", "é", 22), (7, "the cat and", None, "z", 11)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_quality_held_out_accuracy(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_ftrl.score_documents(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.95
    assert got[got.quality == 1].predicted.mean() > 0.99
    assert got.score.between(0, 1).all()


def test_quality_uses_no_held_out_label(spark, docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    a, b = quality_ftrl.train(docs, labels), quality_ftrl.train(docs, flipped)
    assert np.array_equal(a, b)


def test_quality_edges(spark):
    docs = edge_docs(spark, ROWS)
    labels = spark.createDataFrame([(3, 1), (3, 1), (4, 0), (1, 0), (6, None), (None, 1)], "doc_id long, quality int")
    got = quality_ftrl.score_documents(docs, labels).collect()
    assert len(got) == len(ROWS)
    by = {}
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        assert by.setdefault(r.doc_id, r.score) == r.score       # repeated rows score alike
    assert by[1] == by[2]                                         # null scores like empty
    none = quality_ftrl.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_ftrl.keep_good(docs, labels.limit(0)).columns == docs.columns
    assert quality_ftrl.keep_good(docs, labels).columns == docs.columns
    assert quality_ftrl.score_documents(docs.limit(0), labels).count() == 0


def test_language_held_out_accuracy(docs):
    got = langid_hd.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_language_vector_is_the_bundle_of_bound_letters():
    text = "ab cÉ"
    want = np.zeros(langid_hd.DIM)
    s = " ab cé "
    for x, y, z in zip(s, s[1:], s[2:]):
        want += (np.roll(langid_hd.letter_vector(ord(x)), 2) * np.roll(langid_hd.letter_vector(ord(y)), 1)
                 * langid_hd.letter_vector(ord(z)))
    assert np.array_equal(langid_hd.vectors([text, ""])[0], want)


def test_language_edges(spark):
    docs = edge_docs(spark, ROWS)
    got = {r.doc_id: r for r in langid_hd.identify(docs).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[5].lang_pred == "und"
    assert got[1].score == 0 and got[3].lang_pred in ("en", "fr", "de")
    assert langid_hd.identify(docs).count() == len(ROWS)
    kept = langid_hd.keep_known(docs)
    assert kept.columns == docs.columns
    assert not {1, 2, 5} & {r.doc_id for r in kept.collect()}
    assert langid_hd.identify(docs.limit(0)).count() == 0
    unlabelled = docs.withColumn("lang", docs.lang.substr(100, 1)).where("false").unionByName(docs).selectExpr(
        "doc_id", "text", "cast(null AS string) AS lang")
    assert {r.lang_pred for r in langid_hd.identify(unlabelled).collect()} == {"und"}


def test_language_stage_drops_unlearned_scripts_and_random_letters(spark, docs):
    r = random.Random(3)
    alphabets = ["абвгдежзийклмнопрстуфхцчшщыьэюя", "αβγδεζηθικλμνξοπρστυφχψω", "".join(map(chr, range(0x4E00, 0x55D0))),
                 "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "abcdefghijklmnopqrstuvwxyz", "bcdfghjklmnpqrstvwxz"]
    foreign = [" ".join("".join(r.choice(x) for _ in range(r.randint(2, 9))) for _ in range(n))
               for x in alphabets for n in (30, 150) for _ in range(50)]
    bad = spark.createDataFrame([(10**6 + i, t) for i, t in enumerate(foreign)], "doc_id long, text string")
    kept = {x.doc_id for x in langid_hd.keep_known(docs.unionByName(bad, allowMissingColumns=True)).select("doc_id").collect()}
    assert not [i for i in range(len(foreign)) if 10**6 + i in kept]
    clean = {x.doc_id for x in docs.where(langid_hd.held_out()).select("doc_id").collect()}
    assert clean and clean <= kept


def mixed_by_hand(rows):
    """(doc_id, text, source) -> expected (doc_id, size, source_size, target, taken), by sorting."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sources = sorted({s for _, _, s in rows if s is not None}) + ([None] if any(s is None for _, _, s in rows) else [])
    total = {s: sum(n for n, r in zip(size, rows) if r[2] == s) for s in sources}
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(sources)}
    capped, budget = set(), 1.5 * sum(total.values())
    while True:
        free = [s for s in sources if s not in capped]
        if not free:
            break
        rate = (budget - 2 * sum(total[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if 2 * total[s] < rate * weight[s]}
        if not over:
            break
        capped |= over
    target = {s: 2.0 * total[s] if s in capped else min(2.0 * total[s], rate * weight[s]) for s in sources}
    out = []
    for s in sources:
        passes = int(target[s] // total[s]) if total[s] else 0
        rest = target[s] - passes * total[s]
        mine = sorted((int(hashlib.md5(("" if d is None else str(d)).encode()).hexdigest()[:15], 16), d, n)
                      for (d, _, x), n in zip(rows, size) if x == s)
        below = 0
        for h in sorted({h for h, _, _ in mine}):
            same = [(d, n) for k, d, n in mine if k == h]
            step = sum(n for _, n in same)
            more = passes < 2 and (below + step <= rest or (below <= rest and step <= 2 * (rest - below)))
            out += [(d, n, total[s], target[s], n * (passes + more)) for d, n in same]
            below += step
    return sorted(out, key=str)


def test_mixing_matches_sql_and_targets(spark, docs):
    got = mixing.mix_report(docs).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.sql(mixing.ORACLE).df().sort_values("doc_id").reset_index(drop=True)[got.columns]
    assert got.equals(want)
    assert (got.taken <= 2 * got["size"]).all()
    per = mixing.mix(docs).groupBy("source").count().count()
    assert per == docs.select("source").distinct().count()


def test_mixing_edges(spark):
    rows = [r for r in ROWS if r[0] is not None] + [(k, "w " * (k % 7), "hot", 0) for k in range(100, 400)]
    rows = [(*r[:2], "en", r[-2], 0) if len(r) == 5 else (r[0], r[1], "en", r[2], 0) for r in rows]
    docs = edge_docs(spark, rows)
    got = sorted(map(tuple, mixing.mix_report(docs).collect()), key=str)
    want = mixed_by_hand([(r[0], r[1], r[3]) for r in rows])
    assert got == want
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    taken = {}
    for r in mixed.collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + len((r.text or "").split())
    assert all(taken.get(d, 0) == t * sum(x[0] == d for x in rows) or t == 0 for d, _, _, _, t in want)
    assert mixing.mix_report(docs.limit(0)).count() == 0
    assert mixing.mix(docs.limit(0)).count() == 0
    empty = edge_docs(spark, [(1, None, "en", None, 0), (2, "", "en", "a", 0)])
    assert {tuple(r) for r in mixing.mix_report(empty).collect()} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_mixing_splits_rows_without_an_id(spark):
    """A source whose rows have no id, or one id and different texts, still comes near its target."""
    rows = [(None if k % 2 else 7, f"text {k} " + "w " * (k % 9), "en", "hot", 0) for k in range(600)]
    rows += [(k, "w w w", "en", "b", 0) for k in range(1000, 1400)] + [(None, None, "en", "hot", 0), (None, "same", "en", "hot", 0)] * 2
    docs = edge_docs(spark, rows)
    got = mixing.mix_report(docs).toPandas()
    assert len(got) == len(rows)
    for _, g in got.groupby("source_size"):
        assert abs(g.taken.sum() - g.target.iloc[0]) <= 2 * g["size"].max()
    mixed = mixing.mix(docs).groupBy("source").count().count()
    assert mixed == 2
    con = duckdb.connect()
    documents = docs.select("doc_id", "text", "source").toPandas()          # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    want = con.sql(mixing.ORACLE).df()
    key = ["size", "source_size", "target", "taken"]
    assert sorted(map(tuple, got[key].values.tolist())) == sorted(map(tuple, want[key].values.tolist()))


def hashed(token):
    """The token hash, digit by digit."""
    mask = (1 << 64) - 1

    def mix(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & mask
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & mask
        return x ^ (x >> 31)

    base, power, total = 0x9E3779B97F4A7C15, 1, 0
    for b in token:
        power = power * base & mask
        total += mix((b + 1) * base & mask) * power
    return mix((total + len(token)) & mask), mix


def features_by_hand(text):
    """Feature slot -> value of a text."""
    tokens = [t.encode() for t in re.findall(r"[^\x09-\x0d\x20-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+|[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]+", text.lower())]
    mix = hashed(b"")[1]
    h = [hashed(t)[0] for t in tokens]
    found = h + [mix((a * 0xD6E8FEB86659FD93 + b) & ((1 << 64) - 1)) for a, b in zip(h, h[1:])]
    found += [mix(k) for k in (1, 2) for a, b in zip(h, h[k:]) if a == b]
    out = {}
    for x in found:
        slot = x >> (64 - quality_ftrl.BITS)
        out[slot] = out.get(slot, 0) + 1
    return {s: np.float32(n / np.sqrt(len(found))) for s, n in out.items()}


def ftrl_by_hand(docs, labels):
    """FTRL-proximal, one coordinate at a time."""
    q, z, n = quality_ftrl, {}, {}

    def weight(s):
        if abs(z.get(s, 0.0)) <= q.L1:
            return 0.0
        return -(z[s] - np.sign(z[s]) * q.L1) / ((q.BETA + np.sqrt(n[s])) / q.ALPHA + q.L2)

    rows = [features_by_hand(d) | {"bias": np.float32(1)} for d in docs]
    rng = np.random.default_rng(7)
    for _ in range(q.EPOCHS):
        for i in rng.permutation(len(rows)):
            w = {s: weight(s) for s in rows[i]}
            p = 1 / (1 + np.exp(-sum(w[s] * x for s, x in rows[i].items())))
            for s, x in rows[i].items():
                g = (p - labels[i]) * x
                sigma = (np.sqrt(n.get(s, 0.0) + g * g) - np.sqrt(n.get(s, 0.0))) / q.ALPHA
                z[s] = z.get(s, 0.0) + g - sigma * w[s]
                n[s] = n.get(s, 0.0) + g * g
    return {s: weight(s) for s in z}


def test_quality_weights_and_scores_equal_brute_force(spark):
    r = random.Random(4)
    words = ["the", "cat", "été", "dog!!", "a1", "...", "sat"]
    docs = [" ".join(r.choice(words) for _ in range(r.randint(0, 25))) for _ in range(60)] + ["", "x x x x"]
    labels = [int("cat" in d) for d in docs]
    got, want = quality_ftrl.learn(docs, labels), ftrl_by_hand(docs, labels)
    assert got[-1] == pytest.approx(want.pop("bias"), abs=1e-6)
    assert set(np.flatnonzero(got[:-1])) == {s for s, x in want.items() if x}
    for s, x in want.items():
        assert got[s] == pytest.approx(x, abs=1e-6)
    scored = spark.createDataFrame([(d,) for d in docs], "text string").select(quality_ftrl.scorer(got)("text")).collect()
    for d, (s,) in zip(docs, scored):
        dot = got[-1] + sum(got[k] * x for k, x in features_by_hand(d).items())
        assert s == pytest.approx(1 / (1 + np.exp(-dot)), abs=1e-5)
