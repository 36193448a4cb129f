"""BPE encoding, token counts and token files against the public libraries."""

import hashlib
import random
import weakref
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratecell.llm import bpe_count, bpe_fst, langid_hd, quality_ftrl, token_dac

WORD = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIB = Tokenizer.from_file(WORD)
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_fst.load_ranks(RANKS), special_tokens={})
ODD = ["<|endoftext|>a <|ENDOFTEXT|> b", "Σας ΣΑΣ İx", "a\x1cb\x85c　d", "don't DON'T 123", "é x́ ́y", "", " \n  x",
       "a<|startoftext|>b ﬁ Å", "ǅ ß ẞ", "日本語テキスト한국어", "😀👍🏽 x", "a" * 300, "'s's'll x'd", "Straße, Ünter| ÿ.", "x" * 50 + " " * 50]
SCHEMA = "doc_id long, text string, n_tokens long, start long, name string, ids binary"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, 1, 2, "n", b"x") for d, t in rows], SCHEMA)


def random_texts(n, seed=0):
    r = random.Random(seed)
    letters = "aábcdeéЯяΣσ 's1٣²Ⅷ.\n\t ́<|>endoftextİKK日ÀÿßÉ"
    return ["".join(r.choice(letters) for _ in range(r.randint(0, 40))) for _ in range(n)]


def test_counts_equal_the_library():
    c = bpe_count.counter(WORD)
    for t in ODD + random_texts(3000):
        assert c.count(t) == len(LIB.encode(t, add_special_tokens=False).ids), ascii(t)


def test_word_encoder_equals_the_library():
    e = token_dac.encoder(WORD)
    for t in ODD + random_texts(3000, 1):
        assert np.frombuffer(e.encode(t), "<u4").tolist() == LIB.encode(t, add_special_tokens=False).ids, ascii(t)


def test_word_encoder_of_many_texts():
    """Texts encoded together, cut at borders of letters, digits and marks, are those the library gives."""
    marks = list("abzIÉß×÷'’.,|!<=>*&$#%019 \t\x1c\x85\u3000\u0301\u0307\u0338\u0327İſΣς中🙂½²\u20e3\u0661") + ["'s", "'LL", "<|endoftext|>", "<|"]
    rng = random.Random(3)
    texts = ODD + random_texts(2000, 4) + ["".join(rng.choices(marks, k=rng.randrange(40))) for _ in range(20000)]
    got = token_dac.encoder(WORD).encode_all(texts)
    for t, g in zip(texts, got, strict=True):
        assert np.frombuffer(g, "<u4").tolist() == LIB.encode(t, add_special_tokens=False).ids, ascii(t)
    assert token_dac.encoder(WORD).encode_all([]) == []


def test_transducer_equals_tiktoken():
    c = bpe_fst.codec(RANKS, public_tokenizers.PATTERN)
    for t in ODD + random_texts(3000, 2):
        ids = c.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == TIK.encode_ordinary(t), ascii(t)
        assert c.decode(ids) == t


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    text = text.encode("utf-8", "replace").decode()
    c = bpe_fst.codec(RANKS, public_tokenizers.PATTERN)
    assert np.frombuffer(c.encode(text), "<u4").tolist() == TIK.encode_ordinary(text)
    assert bpe_count.counter(WORD).count(text) == len(LIB.encode(text, add_special_tokens=False).ids)


def test_counts_of_new_characters():
    """Characters that the regex package knows as letters or digits, Python's or the library's tables not yet."""
    c = bpe_count.counter(WORD)
    for i in [0x558, 0x58B, 0x88F, 0x1C89, 0xA7CB, 0xA7DC, 0x105C0, 0x10D40, 0x10D50, 0x1CCF0, 0x1E6C0, 0x323B0, 0x3347F, 0x378, 0xE0080]:
        for t in ("Ô" + chr(i), f"a{chr(i)}B 1{chr(i)}.{chr(i)}É", chr(i) * 3 + "\u0301"):
            assert c.count(t) == len(LIB.encode(t, add_special_tokens=False).ids), ascii(t)


def test_transducer_with_small_tables():
    """Few states: the tables start anew all the time; ties and repeats of a toy vocabulary."""
    ranks = {bytes([b]): b for b in range(256)}
    for k, t in enumerate([b"aa", b"ab", b"aaa", b"ba", b"aab", b"abab", b"bb", b"aaaa"]):
        ranks[t] = 256 + k
    toy = tiktoken.Encoding("toy", pat_str=r"[ab]+", mergeable_ranks=ranks, special_tokens={})
    r = random.Random(3)
    fst, old = bpe_fst.Transducer(ranks), bpe_fst.STATES
    bpe_fst.STATES = 5
    try:
        for _ in range(3000):
            t = "".join(r.choice("ab") for _ in range(r.randint(1, 14)))
            assert fst.encode(t.encode()) == toy.encode_ordinary(t), t
    finally:
        bpe_fst.STATES = old


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=40), st.lists(st.integers(1, 5), max_size=20))
def test_streaming_decode_equals_whole_decode(data, cuts):
    pending, out, at = b"", [], 0
    for n in [*cuts, len(data)]:
        pending, text = bpe_fst.utf8_step(pending, data[at:at + n])
        out.append(text)
        at += n
    assert "".join(out) + pending.decode("utf-8", "replace") == data.decode("utf-8", "replace")


ROWS = [(5, None), (1, ""), (9, "the cat " * 20000), (2, "don't <|endoftext|> Stop."), (2, "don't <|endoftext|> Stop."),
        (2, "other"), (None, "no id"), (7, "日本 é"), (12, "one" + "a" * 5000)]


def test_bpe_query_form(spark):
    docs = docs_of(spark, ROWS)
    got = sorted(map(tuple, bpe_fst.encode(docs, RANKS, public_tokenizers.PATTERN, ids=False, check=True).collect()), key=str)
    want = []
    for d, t in ROWS:
        ids = TIK.encode_ordinary(t or "")
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    coded = bpe_fst.encode(docs, RANKS, public_tokenizers.PATTERN)
    back = bpe_fst.decode(coded, RANKS, public_tokenizers.PATTERN)
    assert sorted((tuple(r) for r in back.collect()), key=str) == sorted(((d, t or "") for d, t in ROWS), key=str)
    assert bpe_fst.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_count_query_form(spark):
    got = sorted(map(tuple, bpe_count.count_tokens(docs_of(spark, ROWS), WORD).collect()), key=str)
    want = [(d, len((t or "").encode()), n := len(LIB.encode(t or "", add_special_tokens=False).ids), n > 2048) for d, t in ROWS]
    assert got == sorted(want, key=str)
    assert bpe_count.count_tokens(docs_of(spark, ROWS).limit(0), WORD).count() == 0


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65535, 65536, 2**32 - 1, 7] * 400, list(range(3000))])
def test_dac_random_access(ids):
    r = token_dac.Reader(token_dac.to_bytes([4, None], np.array([1, len(ids)]), np.array(ids, np.int64)))
    assert r.doc_ids == [4, None] and len(r) == len(ids)
    assert r.tokens().tolist() == ids
    for i in range(0, len(ids), 7):
        assert r.token(i) == ids[i]
    places = np.arange(len(ids))[::-1]
    assert r.at(places).tolist() == ids[::-1]


def test_token_files(spark):
    got = [tuple(r) for r in token_dac.round_trip(docs_of(spark, ROWS), WORD).collect()]
    order = sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for d, t in order:
        ids = LIB.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert token_dac.round_trip(docs_of(spark, ROWS).limit(0), WORD).count() == 0


def test_token_files_keep_texts_on_the_executors(spark):
    """What the range sampler may send to the driver is an id, a short prefix and a hash."""
    docs = docs_of(spark, [(k, "word " * 2000) for k in range(40)] + [(None, f"{k} no id") for k in range(40)])
    got = token_dac.round_trip(docs, WORD).collect()
    assert sorted((r.start, r.n_tokens) for r in got) and sum(r.doc_id is None for r in got) == 40
    spans = sorted((r.start, r.start + r.n_tokens) for r in got)
    assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[0][0] == 0


def test_memo_is_bounded_in_bytes():
    from ratecell.llm.common import Recent
    made = []
    memo = Recent(lambda k: made.append(k) or k, 10)
    for _ in range(2):
        assert memo["x" * 101] == "x" * 101 and memo["y"] == "y"
    assert made == ["x" * 101, "y", "x" * 101] and list(memo) == ["y"]


def test_other_operators_drop_the_codec(spark):
    """A Python worker that goes on to another operator's tasks doesn't hold the codec's tables any longer."""
    text = pd.Series(["some text", ""])
    none = ([], np.zeros((0, langid_hd.DIM), np.float32), np.zeros(0))
    for task in (quality_ftrl.scorer(None).func, langid_hd.predictor(none).func):
        codec = weakref.ref(bpe_fst.codec(RANKS, public_tokenizers.PATTERN))
        assert codec() is bpe_fst.codec(RANKS, public_tokenizers.PATTERN)
        assert len(task(text)) == 2
        assert codec() is None
