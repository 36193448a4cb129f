"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

The merges are compiled to a nondeterministic transducer: a configuration is (last token, place in
the trie of tokens). Reading a byte moves down the trie; where a token ends, it may be emitted if
it can follow the last one, that is, if merging the two tokens' bytes gives just these two. BPE
gives the one token sequence whose neighbours all fit so, hence only one configuration of each
prefix stands at the root. The subset construction makes it deterministic: a state is the set of
live configurations with the tokens each still owes; what all of them owe alike is emitted, which
takes a lookahead of at most the longest token. States and transitions are made when first met and
memoised up to a bound; beyond it the tables start anew.

Decoding maps ids to bytes and feeds them to an incremental UTF-8 machine, whose state carries an
unfinished character from one token to the next.

Null texts count as empty: no ids. Special strings are ordinary text. Repeated rows are coded
alike; extra columns are ignored; nothing is truncated.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecell.llm.common import Recent, kept_between_tasks, ship, texts

MEMO = 250_000
STATES = 150_000
_NO = 1 << 60


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, from lines of base64 bytes and rank."""
    ranks = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                ranks[base64.b64decode(token)] = int(rank)
    return ranks


class Transducer:
    """Encoder of single pieces for one table of ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {r: b for b, r in ranks.items()}
        # The trie: child node by node << 8 | byte; the token that ends at a node.
        self.child: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for b in token:
                nxt = self.child.get(node << 8 | b)
                if nxt is None:
                    nxt = self.child[node << 8 | b] = len(self.ends)
                    self.ends.append(-1)
                node = nxt
            self.ends[node] = rank
        self.inner = bytearray(len(self.ends))          # nodes that have children
        for key in self.child:
            self.inner[key >> 8] = 1
        self.spine: dict[int, tuple | None] = {}
        self.fits = Recent(lambda key: self._fit(key >> 24, key & 0xFFFFFF), 200_000)
        self._reset()

    def _reset(self) -> None:
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.step: dict[int, tuple] = {}
        self.start = self._state(((-1, 0, ()),))

    def _state(self, configs: tuple) -> int:
        n = self.number.get(configs)
        if n is None:
            n = self.number[configs] = len(self.states)
            self.states.append(configs)
        return n

    # --- which tokens may stand side by side ---------------------------------------------------

    def _spines(self, token: int):
        """How a token's two edge symbols come about: ((rank of the merge that ends a symbol,
        symbol before it)... along the right edge, along the left edge), or None if merging its
        bytes does not give the token."""
        got = self.spine.get(token, 0)
        if got != 0:
            return got
        parts = [bytes([b]) for b in self.tokens[token]]
        right, left = [], []
        while len(parts) > 1:
            best, at = _NO, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], _NO)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            if at == len(parts) - 2:
                right.append((best, parts[-1]))
            if at == 0:
                left.append((best, parts[0]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        got = None
        if len(parts) == 1:
            whole = (_NO, parts[0])
            got = ((*right, whole), (*left, whole))
        self.spine[token] = got
        return got

    def _fit(self, first: int, second: int) -> bool:
        """Do the two tokens' bytes merge to just these two tokens?"""
        a, b = self._spines(first), self._spines(second)
        if a is None or b is None:
            return False
        right, left, i, j = a[0], b[1], 0, 0
        while True:
            (ra, x), (rb, y) = right[i], left[j]
            m = self.ranks.get(x + y, _NO)
            # A merge across the border comes first if its rank is lower; among equal ranks the
            # leftmost pair comes first.
            if m < ra and m <= rb and m < _NO:
                return False
            if ra == rb == _NO:
                return True
            if ra <= rb:
                i += 1
            else:
                j += 1

    # --- the deterministic machine -------------------------------------------------------------

    def _move(self, state: int, byte: int) -> tuple:
        """(next state, ids emitted) after a byte."""
        out = []
        child, ends, fits, inner = self.child, self.ends, self.fits, self.inner
        for last, node, owed in self.states[state]:
            nxt = child.get(node << 8 | byte)
            if nxt is None:
                continue
            if inner[nxt]:
                out.append((last, nxt, owed))
            token = ends[nxt]
            if token >= 0 and (fits[last << 24 | token] if last >= 0 else self._spines(token)):
                out.append((token, 0, (*owed, token)))
        if not out:
            raise ValueError("a byte that no token holds")
        first = out[0][2]
        shared = len(first)
        for _, _, owed in out:
            while owed[:shared] != first[:shared]:
                shared -= 1
        if shared:
            out = [(last, node, owed[shared:]) for last, node, owed in out]
        return self._state(tuple(out)), first[:shared]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.states) > STATES:
            self._reset()
        state, ids, step = self.start, [], self.step
        for byte in piece:
            key = state << 8 | byte
            got = step.get(key)
            if got is None:
                got = step[key] = self._move(state, byte)
            state, emitted = got
            if emitted:
                ids.extend(emitted)
        # The configuration at the trie's root has read the piece to its end.
        ids.extend(next(owed for _, node, owed in self.states[state] if node == 0))
        return ids


# --- the incremental UTF-8 machine --------------------------------------------------------------

def utf8_step(pending: bytes, data: bytes) -> tuple[bytes, str]:
    """Text completed by ``data`` after the unfinished bytes ``pending``, and the bytes that are
    unfinished now. Bytes that can't be part of UTF-8 become U+FFFD, as many as bytes.decode makes."""
    data = pending + data
    n = len(data)
    for back in range(1, min(3, n) + 1):          # does a character start so near the end that it isn't complete?
        b = data[n - back]
        if b >= 0xC2 and b < 0xF5:
            need = 2 if b < 0xE0 else 3 if b < 0xF0 else 4
            tail = data[n - back:]
            if need > back and _may_go_on(tail):
                return tail, data[:n - back].decode("utf-8", "replace")
            break
        if b < 0x80 or b >= 0xC0:
            break
    return b"", data.decode("utf-8", "replace")


def _may_go_on(tail: bytes) -> bool:
    """Is the start of a character, with what follows, the beginning of a valid one?"""
    if len(tail) < 2:
        return True
    low, high = {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(tail[0], (0x80, 0xBF))
    return low <= tail[1] <= high and all(0x80 <= b <= 0xBF for b in tail[2:])


def pack(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class Codec:
    """Encodes and decodes whole texts for one file of ranks and one pattern."""

    def __init__(self, path: str, pattern: str):
        self.fst = Transducer(load_ranks(path))
        self.split = regex.compile(pattern).findall
        self.pieces = Recent(lambda p: pack(self.fst.encode(p.encode("utf-8", "replace"))), MEMO)
        self.table = np.array([self.fst.tokens.get(i, b"") for i in range(max(self.fst.tokens) + 1)], dtype=object)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def stream(self, ids: bytes, block: int = 4096):
        """Decoded text, a block of ids at a time."""
        pending = b""
        for a in range(0, len(ids), 4 * block):
            data = b"".join(self.table[np.frombuffer(ids[a:a + 4 * block], "<u4")].tolist())
            pending, text = utf8_step(pending, data)
            yield text
        if pending:
            yield pending.decode("utf-8", "replace")

    def decode(self, ids: bytes) -> str:
        return "".join(self.stream(ids))


@kept_between_tasks
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, ids: bool = True, check: bool = False) -> DataFrame:
    """doc_id, n_tokens and, as asked for: ids (binary, little-endian unsigned 32-bit) and the
    SHA-256 of the ids and of the UTF-8 bytes decoded from them."""
    ship(docs.sparkSession)
    fields = [("n_tokens", pa.int64(), "long")] + [("ids", pa.binary(), "binary")] * ids
    fields += [(n, pa.string(), "string") for n in ("ids_sha256", "decoded_sha256")] * check
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        c = codec(path, pattern)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                coded = [c.encode(t) for t in part.column(1).to_pylist()]
                cols = [pa.array([len(x) // 4 for x in coded], pa.int64())]
                if ids:
                    cols.append(pa.array(coded, pa.binary()))
                if check:
                    cols.append(pa.array([hashlib.sha256(x).hexdigest() for x in coded], pa.string()))
                    cols.append(pa.array([hashlib.sha256(c.decode(x).encode("utf-8", "replace")).hexdigest() for x in coded],
                                         pa.string()))
                yield pa.RecordBatch.from_arrays([part.column(0), *cols], ["doc_id", *(f[0] for f in fields)])

    schema = ", ".join([f"doc_id {id_type}", *(f"{n} {t}" for n, _, t in fields)])
    return texts(docs).mapInArrow(run, schema)


def decode(coded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the text that its ids stand for (null ids: null)."""
    import pandas as pd
    ship(coded.sparkSession)

    def text(ids):
        return ids.map(lambda x: None if x is None else codec(path, pattern).decode(bytes(x)))

    text.__annotations__ = {"ids": pd.Series, "return": pd.Series}
    return coded.select("doc_id", F.pandas_udf(text, "string")("ids").alias("text"))
