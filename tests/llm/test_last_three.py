"""Spelling variants and the filter audit against brute force, main-text extraction on known pages."""

import random
import re
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratecell.llm import filter_audit, html_lstm, spelling_trie

SF = "/root/testdata/sf0.01"
# extra columns with names that the operators use themselves
EDGE = "doc_id long, text string, lang string, n long, id long, word string, mask int, part string, digest string, kind int"
EXTRA = (7, 8, "w", 1, "p", "d", 2)


# --- spelling variants ----------------------------------------------------------------------------------

def brute_variants(rows):
    count = Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 6 and n >= 5}
    letters = {c for w in words for c in w}
    form, near = {}, {}
    for w in words:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        found = [v for v in edits - {w} if v in words]
        near[w] = len(found)
        best = min(found, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, near[w], words.get(form[w])))
    return sorted(out)


def test_variants_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(tuple(r) for r in spelling_trie.group_variants(docs).collect())
    assert got == brute_variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert sum(r[1] is not None for r in got) > 100 and any(r[1] != r[2] for r in got if r[1])


def test_variants_of_a_small_alphabet(spark):
    """Few letters: runs of equal letters, long chains of shared prefixes, ties, every pair set full."""
    rnd = random.Random(5)
    weight = [rnd.choice([1, 1, 6, 40]) for _ in range(300)]
    vocabulary = ["".join(rnd.choice("abÿ") for _ in range(rnd.choice([6, 7, 8]))) for _ in weight]
    rows = [(i if i % 7 else None, " ".join(rnd.choices(vocabulary, weight, k=300)) + " ×÷ ÀÈÀÈÀÈ", "xx", *EXTRA) for i in range(60)]
    rows += [(99, None, None, *EXTRA), (100, "", "xx", *EXTRA)]
    rows += [(101, "q" * 3000 + " " + ("q" * 2999 + "'") * 30, "xx", *EXTRA)] * 6          # repeated rows, long words
    docs = spark.createDataFrame(rows, EDGE)
    got = sorted(tuple(r) for r in spelling_trie.group_variants(docs).collect())
    assert got == brute_variants([r[:2] for r in rows])
    assert sum(r[1] is not None for r in got) > 20
    assert spelling_trie.group_variants(docs.limit(0)).count() == 0


def test_node_numbers_are_those_of_one_trie(spark):
    """Cut anywhere, sorted partitions number the prefixes of all words alike, and no two alike."""
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.randint(1, 9))) for _ in range(400)})
    for cuts in ([], [1, 2, 3], sorted(rnd.sample(range(1, len(words)), 40))):
        pieces = [words[a:b] for a, b in zip([0, *cuts], [*cuts, len(words)])]
        info = spelling_trie.borders([(p, piece[0], piece[-1]) for p, piece in enumerate(pieces)])
        number = {}
        for p, piece in enumerate(pieces):
            for w, path in zip(piece, spelling_trie.path_numbers(piece, *info[p], p)):
                assert len(path) == len(w) + 1
                for d, x in enumerate(path):
                    assert number.setdefault(w[:d], x) == x
        assert len(set(number.values())) == len(number)


def test_variants_make_no_pairs_of_words(spark):
    """Rows grow with the letters of the words, not with the neighbours they have."""
    words = spark.createDataFrame([(1, 6, [0, 1, 2, 3], [0, 9, 8, 7], [True, False, True])],
                                  "id long, n long, prefixes array<long>, suffixes array<long>, firsts array<boolean>")
    assert sorted(tuple(r) for r in spelling_trie.pairs(words).collect()) == [
        (1, 6, 0, 7, 0), (1, 6, 0, 8, 1), (1, 6, 1, 8, 0), (1, 6, 1, 9, 2), (1, 6, 2, 0, 1), (1, 6, 2, 9, 0), (1, 6, 3, 0, 0)]


# --- main text -------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def weights(spark):
    return html_lstm.fit(spark.read.parquet(f"{SF}/pages.parquet"))


def article(html):
    """Main text of a page of the given tables, by their known form."""
    body = re.sub(r"<br>", " ", re.search(r"<article>(.*?)</article>", html, re.S)[1])
    from html import unescape
    blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", body)]
    return "\n".join(b for b in blocks if b)


def test_main_text_of_all_pages(spark, weights):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    got = html_lstm.extract(pages, weights).join(pages.select("page_id", "html"), "page_id").collect()
    assert len(got) == pages.count()
    wrong = [r.page_id for r in got if r.text != article(r.html)]
    assert len(wrong) <= len(got) // 500, wrong[:5]
    assert all(r.n_chars == len(r.text) for r in got)


def test_main_text_of_other_layouts(spark, weights):
    """Pages generated with another seed from texts not learned from."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 2000").limit(150).collect()
    rng, right, total = random.Random(991), 0, 0
    texts = [article(r.html).split("\n") for r in pages]
    pool = [t for x in texts for t in x]
    for text in texts:
        page = html_lstm.Page(html_lstm.layout(rng, text[:30], pool))
        right += int(((html_lstm.label(html_lstm.Batch([page]), weights) >= 0.5) == html_lstm.marked(page)).sum())
        total += len(page.texts)
    assert right / total > 0.985


HANDMADE = """<!doctype html><html><head><title>T</title><style>p{color:red}</style><script>if (a<b) document.write("<p>no</p>")</script></head>
<body class="home"><div class="gdpr-overlay cookie"><p>We use cookies to improve your visit.</p><button>Accept</button></div>
<header class="site-header"><a href="/">The Paper</a><nav class="site-nav"><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li>
<li><a href="/c">Sport</a></li></ul></nav></header>
<div id="wrap"><main><article class="story"><h1>Flood &amp; storm</h1><p>The river rose by two metres on <a href="/m">Monday</a>, and
the&nbsp;town&#39;s <b>bridge</b> was closed for the night.</p><div class="ad advert"><p>Buy a boat now!</p></div>
<p>People were told to stay at home<br>until the water had gone down again.</p><ul><li>Two roads are shut</li><li>The school is closed</li></ul>
<!-- <p>not this</p> --><blockquote><p>We have never seen such a night, the mayor said.</p></blockquote></article></main>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">A story</a></li><li><a href="/2">Other story</a></li></ul></aside></div>
<form class="newsletter-form"><label>Your e-mail address</label><input name="m"><button>Subscribe</button></form>
<section id="comments"><h3>2 comments</h3><div class="comment"><b>guest</b><p>I saw it too.</p></div><div class="comment"><b>ann</b><p>Stay safe!</p></div></section>
<footer><p>&copy; The Paper. All rights reserved.</p><a href="/t">Terms of use</a></footer><script>var t="</p>";</script></body></html>"""


def test_main_text_of_a_handmade_page(spark, weights):
    page = html_lstm.Page(HANDMADE)
    keep = html_lstm.label(html_lstm.Batch([page]), weights) >= 0.5
    assert [t for t, k in zip(page.texts, keep) if k] == [
        "Flood & storm", "The river rose by two metres on Monday, and the town's bridge was closed for the night.",
        "People were told to stay at home until the water had gone down again.", "Two roads are shut", "The school is closed",
        "We have never seen such a night, the mayor said."]


def test_reading_broken_pages():
    read = lambda html: html_lstm.Page(html).texts                     # noqa: E731
    assert read("") == read("<p></p> <br> &nbsp;") == read("<!-- open <p>x</p>") == read("<script>x</script") == []
    assert read("plain a < b &lt;c&gt;") == ["plain a < b <c>"]
    assert read("<p>one<p>two<div>three</p>four") == ["one", "two", "three", "four"]
    assert read("<ul><li>a<li>b</ul></ul></p>c") == ["a", "b", "c"]
    assert read("x<svg><text>no</text></svg>y<SCRIPT>'</p>'</SCRIPT >z") == ["xy", "z"]
    assert read("<p title='a>b'>in</p><p class=\"never closed") == ["in"]
    assert read("a<b>b</b>c<a href=x>d</a>") == ["abcd"]
    deep = html_lstm.Page("<div>" * 3000 + "x" + "</div>" * 3000)
    assert deep.texts == ["x"] and len(deep.names) == 3001


def test_gradients_of_the_network():
    rng = random.Random(0)
    pages = [html_lstm.Page(html_lstm.layout(rng, ["Some words of text.", "And more of it here."], ["the cat sat"])) for _ in range(3)]
    batch, truth = html_lstm.Batch(pages), np.concatenate([html_lstm.marked(p) for p in pages])
    w = {k: v.astype(np.float64) for k, v in html_lstm.new_weights(np.random.default_rng(0)).items()}
    _, grads = html_lstm.loss_and_gradients(batch, truth, w)
    for k, g in grads.items():
        i = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        w[k][i] += 0.01
        up, _ = html_lstm.loss_and_gradients(batch, truth, w)
        w[k][i] -= 0.02
        down, _ = html_lstm.loss_and_gradients(batch, truth, w)
        w[k][i] += 0.01
        assert (up - down) / 0.02 == pytest.approx(float(g[i]), rel=0.02), k


def test_labels_depend_on_the_whole_page_and_not_on_the_batch(weights):
    pages = [html_lstm.Page(HANDMADE), html_lstm.Page("<p>Only this.</p>"), html_lstm.Page(""), html_lstm.Page(HANDMADE * 30)]
    together = html_lstm.label(html_lstm.Batch(pages), weights)
    alone = np.concatenate([html_lstm.label(html_lstm.Batch([p]), weights) for p in pages])
    assert np.allclose(together, alone, atol=1e-4)


def test_main_text_edges(spark, weights):
    long = "<article>" + "<p>Many words stand in this line.</p>" * 20000 + "</article>"
    rows = [(1, "u", HANDMADE, "t", 3), (1, "u", HANDMADE, "t", 3), (2, None, None, None, None), (3, "v", "", "t", 0),
            (None, "w", "<article><p>Text with no id</p></article>", "t", 1), (4, "x", long, "t", 1),
            (5, "y", "<nav><a href='/'>Home</a></nav>", "t", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = html_lstm.extract(pages, weights)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    got = got.collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and by[2].text == by[3].text == by[5].text == "" and by[2].url is None
    assert by[None].text == "Text with no id" and by[4].text.count("\n") == 19999
    assert len({r.text for r in got if r.page_id == 1}) == 1
    assert html_lstm.extract(pages.limit(0), weights).count() == 0
    assert html_lstm.fit(pages.limit(0))["out"].shape == weights["out"].shape


# --- filter audit -------------------------------------------------------------------------------------------

def brute_audit(rows, labels):
    text_of = [(d, t or "", p or "") for d, t, p in rows]
    least = {}
    for d, t, _ in text_of:
        if d is not None:
            least[t] = min(d, least.get(t, d))
    docs = []
    for d, t, p in text_of:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": d is not None and d > least[t]}
        docs.append((p, {x for x, f in fails.items() if f}, any(q == 1 for i, q, _ in labels if d is not None and i == d),
                     any(x == 1 for i, _, x in labels if d is not None and i == d)))
    out = {}
    for part in {d[0] for d in docs}:
        mine, shapley = [d for d in docs if d[0] == part], Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                out[part, "".join(order), step] = [
                    len(left) - len(gone), len(gone), sum(f in d[1] for d in mine) - len(gone), sum(d[1] == {f} for d in mine),
                    sum(d[2] for d in gone), sum(d[3] for d in gone)]
                shapley[f] += len(gone)
                left = [d for d in left if f not in d[1]]
        for (p, o, s), v in out.items():
            if p == part:
                v.append(shapley[o[s - 1]])
    return out


def audited(docs, labels):
    got = filter_audit.audit(docs, labels).collect()
    out = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
           for r in got}
    assert len(out) == len(got)
    return out


def test_audit_equals_sql(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    with duckdb.connect() as c:
        for t in ("documents", "labels"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
        want = sorted(c.execute(f"SELECT {', '.join(f.split()[0] for f in filter_audit.SCHEMA.split(', '))} FROM ({filter_audit.ORACLE})").fetchall())
    assert sorted(tuple(r) for r in filter_audit.audit(docs, labels).collect()) == want


def test_audit_equals_brute_force_on_edges(spark):
    rnd = random.Random(2)
    many = " ".join(f"w{i}" for i in range(250))
    kinds = [None, "", many, many + " #", many.upper(), "a " * 300, "A " * 300 + "|", "short\x0bword\x1cone x É", "x" * 50000]
    rows = [(rnd.choice([None, *range(40)]), rnd.choice(kinds), rnd.choice([None, "", "en", "de"]), *EXTRA) for _ in range(300)]
    rows += rows[:40]
    labels = [(i % 50, rnd.choice([None, 0, 1]), rnd.choice([None, 0, 1])) for i in range(70)] + [(None, 1, 1)]
    docs = spark.createDataFrame(rows, EDGE)
    marks = spark.createDataFrame([(*x, "d") for x in labels], "doc_id long, quality int, toxic int, digest string")
    assert audited(docs, marks) == brute_audit([r[:3] for r in rows], labels)
    assert audited(docs, marks.limit(0)) == brute_audit([r[:3] for r in rows], [])
    assert audited(docs.limit(0), marks) == {}


def test_audit_counts_copies_before_they_meet(spark):
    """However many copies of a text there are, one row per part and label reaches the window."""
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("copy").alias("text"), F.lit("en").alias("lang"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {(r.mask, r.n) for r in filter_audit.cells(docs, labels).collect()}
    assert got == {(1, 1), (17, 1999)} and audited(docs, labels)["en", "ABCDE", 1][:2] == [0, 2000]
