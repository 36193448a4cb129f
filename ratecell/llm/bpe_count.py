"""Token counts by heap-and-linked-list byte-pair merging, for word-level BPE vocabularies with an
end-of-word suffix (``word_bpe_49k.json``).

A word starts as one symbol a byte. The adjacent pair of the lowest rank is popped from a heap
(ties: leftmost), its symbols are merged in a doubly linked list, and the new neighbours are
pushed. Each merge leaves one symbol less, so the count is the initial symbols minus the merges;
no identifiers are made.

Text is prepared as the vocabulary's file says: special strings first (one token each), then NFC,
white space, lower case and the split into words. Counts of pieces are kept in bounded memos. Pieces with
characters newer than Python's tables are split by the library itself, whose tables may be of another version.
Null texts count as empty: 0 bytes, 0 tokens. Repeated rows count alike; extra columns are
ignored; nothing is truncated.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell.llm.common import Recent, ship, texts

LIMIT = 2048
MEMO = 250_000
# The vocabulary's special strings, white space and word pattern.
SPECIAL = regex.compile(r"<\|startoftext\|>|<\|endoftext\|>")
SPACE = r"\t\n\x0b\x0c\r\x20\x85\xa0  -     　"
WORD = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACE}\p{{L}}\p{{N}}]+")
BLANK = regex.compile(rf"[{SPACE}]+")
NOT_SPACE = regex.compile("[\x1c-\x1f]")      # str.split() takes these for white space


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Counter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocab, self.end = model["vocab"], model["end_of_word_suffix"] or ""
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        # (left id, right id) packed in one integer -> (rank, merged id)
        self.merges = {self.vocab[a] << 32 | self.vocab[b]: (r, self.vocab[a + b]) for r, (a, b) in enumerate(pairs)}
        letters = byte_letters()
        self.inner = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.end] for c in letters]
        self.path, self.lib, self.byte = path, None, {c: b for b, c in enumerate(letters)}
        self.words = Recent(self.word, MEMO)
        self.chunks = Recent(self.chunk, MEMO)

    def word(self, word: str) -> int:
        data = word.encode("utf-8", "replace")
        n = len(data)
        sym = [self.inner[b] for b in data]
        sym[-1] = self.last[data[-1]]
        if n == 1:
            return 1
        merges = self.merges
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            m = merges.get(sym[i] << 32 | sym[i + 1])
            if m:
                heap.append((m[0], i, m[1], sym[i], sym[i + 1]))
        heapq.heapify(heap)
        count = n
        while heap:
            _, i, new, a, b = heapq.heappop(heap)
            j = after[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue                      # one of the two has been merged meanwhile
            count -= 1
            sym[i], sym[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                m = merges.get(new << 32 | sym[k])
                if m:
                    heapq.heappush(heap, (m[0], i, m[1], new, sym[k]))
            h = before[i]
            if h >= 0:
                m = merges.get(sym[h] << 32 | new)
                if m:
                    heapq.heappush(heap, (m[0], h, m[1], sym[h], new))
        return count

    def chunk(self, chunk: str) -> int:
        """Tokens of a text without white space."""
        if not chunk.isascii() and "Cn" in map(unicodedata.category, chunk):
            return sum([self.words[w] for w in self.split(chunk)])
        s = chunk if chunk.isascii() else unicodedata.normalize("NFC", chunk)
        # Letter by letter where lower() would look at a letter's neighbours.
        s = s.lower() if "Σ" not in s else "".join(map(str.lower, s))
        words = self.words
        return sum([words[w] for w in WORD.findall(s)])

    def split(self, chunk: str) -> list[str]:
        """The words of a text without white space, as the library splits it."""
        if self.lib is None:
            from tokenizers import Tokenizer
            self.lib = Tokenizer.from_file(self.path)
        s = self.lib.normalizer.normalize_str(chunk.encode("utf-8", "replace").decode())
        return [bytes(map(self.byte.__getitem__, w)).decode() for w, _ in self.lib.pre_tokenizer.pre_tokenize_str(s)]

    def plain(self, text: str) -> int:
        parts = BLANK.split(text) if NOT_SPACE.search(text) else text.split()
        return sum(map(self.chunks.__getitem__, parts))

    def count(self, text: str) -> int:
        if "<|" not in text:
            return self.plain(text)
        return len(SPECIAL.findall(text)) + sum(map(self.plain, SPECIAL.split(text)))


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every document."""
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def tokens(text: pd.Series) -> pd.Series:
        return text.map(counter(path).count).astype("int64")

    t = texts(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"),
                           tokens("text").alias("n_tokens"))
    return t.withColumn("over_limit", F.col("n_tokens") > limit)
