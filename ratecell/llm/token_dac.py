"""Token ids in files of directly addressable codes (DAC).

An id is cut into chunks of 8 bits, lowest first. Level 0 holds every id's first chunk, level 1
the second chunk of the ids that have one, and so on. A continuation bitmap at each level says
which ids go on, and a rank directory (ones before each block of 512 bits) finds an id's place in
the next level, so that any token is read by a few lookups, without decoding a block.

File: the magic ``RCDA1``, a JSON header padded to 8 bytes (array lengths), then doc ids (int64),
missing-id flags (uint8), each document's end (uint64, tokens), and for each level the chunks
(uint8), the bitmap (bits, lowest first) and the rank directory (uint32). Documents are in ascending
doc_id order within a file and across the files by name; rows with a null doc_id come first, rows
that repeat a doc_id in the order of their texts' first ``PREFIX`` code points, then of a hash of the text (so
that no text leaves the executors to find the files' bounds, and many rows without an id spread). Null texts count as empty; every document ends
with the end id, so an empty one has one token. Extra columns are ignored. An empty table writes no file.
"""

from __future__ import annotations

import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratecell.llm.bpe_count import SPACE, byte_letters
from ratecell.llm.bpe_fst import pack
from ratecell.llm.common import Recent, scratch, ship, slices, texts, written
from ratecell.llm.files import make_folder, put

END_ID = 2
MEMO = 400_000
TOKENS_IN_FILE = 2_000_000
MAGIC = b"RCDA1"
PREFIX = 32
BLOCK = 512
# Lower-case letters that NFC leaves as they are.
PLAIN = regex.compile("[a-zà-öø-ÿ]+")
# White space beyond ASCII (the vocabulary's separators); a text with one of the special strings takes the plain path.
ODD_BLANK = re.compile(f"[{SPACE[SPACE.index(chr(92) + 'x85'):]}]")
SLICE = 1 << 23
# What a byte is: 0 white space, 1 letter, 2 digit, 3 punctuation but the apostrophe, 4 anything else. High bytes
# count as letters only in the two-byte letters À to ÿ.
_KIND = np.full(256, 4, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = 0
for _b in range(33, 127):
    _KIND[_b] = 4 if _b == 39 else 1 if chr(_b).isalpha() else 2 if chr(_b).isdigit() else 3
_LOWER = bytes(range(256)).lower()


class Encoder:
    """Whole texts to ids with the tokenizers library. White space always separates words in this vocabulary, as
    does the border between a letter and a mark other than the apostrophe, and a digit stands alone; so texts
    are cut there, each slice's different pieces are looked up once, and their ids are remembered (bounded)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        self.letters = dict(enumerate(byte_letters()))
        self.pieces = Recent(self.piece, MEMO)

    def piece(self, piece: str) -> bytes:
        """Ids of a piece without white space: plain letters by the library's model alone."""
        if piece.isascii():
            if piece.isalpha() and piece.islower():
                return pack([t.id for t in self.model.tokenize(piece)])
        elif PLAIN.fullmatch(lower := piece.lower()):
            word = lower.encode().decode("latin-1").translate(self.letters)
            return pack([t.id for t in self.model.tokenize(word)])
        return self.whole(piece)

    def whole(self, text: str) -> bytes:
        return pack(self.lib.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for a, b in slices(len(texts), list(map(len, texts)), SLICE):
            part = texts[a:b]
            odd = {i for i, t in enumerate(part) if "<|" in t or "\u0307" in t}
            coded = self.slice(["" if i in odd else t for i, t in enumerate(part)] if odd else part)
            for i in odd:
                coded[i] = self.whole(part[i])
            out += coded
        return out

    def slice(self, texts: list[str]) -> list[bytes]:
        """Ids of texts without special strings and without the combining dot above, the one mark that makes an
        I's lower case depend on what follows it; those texts go to the library whole."""
        data = [(t if t.isascii() else ODD_BLANK.sub(" ", t)).encode().translate(_LOWER) for t in texts]
        size = np.fromiter(map(len, data), np.int64, len(data))
        buf = np.frombuffer(b" ".join(data) + b" ", np.uint8)
        kind = _KIND[buf]
        lead = np.flatnonzero(buf[:-1] == 0xC3)
        lead = lead[(buf[lead + 1] != 0x97) & (buf[lead + 1] != 0xB7)]      # the signs × and ÷
        kind[lead] = kind[lead + 1] = 1
        here, last = kind[1:], kind[:-1]
        # The end of every piece: a blank, a border of kinds, or a digit after a digit.
        cut = (here != last) & (here < 4) & (last < 4) & (last > 0) | (here == 0) | (here == 2) & (last == 2)
        ends = np.flatnonzero(cut) + 1
        if kind[0] == 0:
            ends = np.append(0, ends)
        packed, blank = buf[kind > 0], kind[ends] == 0      # every blank ends a piece
        to = (ends - np.cumsum(blank) + blank).astype(np.int32)
        table = pa.StringArray.from_buffers(len(to), pa.py_buffer(np.append(np.int32(0), to)), pa.py_buffer(packed))
        table = table.dictionary_encode()
        which = table.indices.to_numpy()
        ids = [self.pieces[p] if p else b"" for p in table.dictionary.to_pylist()]
        n = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        first, ids = np.cumsum(n) - n, np.frombuffer(b"".join(ids), "<u4")
        n = n[which]
        upto = np.cumsum(n)
        ids = ids[np.arange(upto[-1]) + np.repeat(first[which] - (upto - n), n)]
        stop = upto[np.searchsorted(ends, np.cumsum(size + 1) - 1)]
        return [ids[a:b].tobytes() for a, b in zip(np.append(0, stop[:-1]), stop)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


# --- the format -----------------------------------------------------------------------------------

def to_bytes(doc_ids: list, ends: np.ndarray, ids: np.ndarray) -> bytes:
    """One file: doc ids (None allowed), each document's end, all ids."""
    arrays = [np.array([0 if d is None else d for d in doc_ids], "<i8"),
              np.array([d is None for d in doc_ids], np.uint8), np.asarray(ends, "<u8")]
    rest, levels = np.asarray(ids, "<u4"), 0
    while len(rest):
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.int64)
        arrays += [(rest & 255).astype(np.uint8), bits, (np.cumsum(ones) - ones).astype("<u4")]
        rest, levels = rest[more] >> 8, levels + 1
    head = json.dumps({"levels": levels, "sizes": [[a.dtype.str, len(a)] for a in arrays]}).encode()
    head += b" " * (-(len(MAGIC) + 4 + len(head)) % 8)
    out = [MAGIC, len(head).to_bytes(4, "little"), head]
    for a in arrays:
        b = a.tobytes()
        out += [b, b"\0" * (-len(b) % 8)]
    return b"".join(out)


_ONES = np.array([bin(b).count("1") for b in range(256)], np.int64)


class Reader:
    """A file's documents and tokens."""

    def __init__(self, data: bytes):
        if data[:5] != MAGIC:
            raise ValueError("not a token file")
        n = int.from_bytes(data[5:9], "little")
        head = json.loads(data[9:9 + n])
        at, arrays = 9 + n, []
        for dtype, size in head["sizes"]:
            a = np.frombuffer(data, dtype, size, at)
            arrays.append(a)
            at += a.nbytes + -a.nbytes % 8
        ids, missing, self.ends = arrays[:3]
        self.doc_ids = [None if m else int(d) for d, m in zip(ids, missing)]
        self.levels = [arrays[3 + 3 * k:6 + 3 * k] for k in range(head["levels"])]

    def __len__(self) -> int:
        return len(self.levels[0][0]) if self.levels else 0

    def token(self, i: int) -> int:
        """The i-th token, by rank lookups only."""
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            start = i // BLOCK * BLOCK
            before = np.unpackbits(bits[start >> 3:(i >> 3) + 1], bitorder="little")[:i - start].sum()
            i, shift = int(ranks[i // BLOCK]) + int(before), shift + 8
        return value

    def at(self, places: np.ndarray) -> np.ndarray:
        """The tokens at several places, by rank lookups only."""
        value, live, i = np.zeros(len(places), np.int64), np.arange(len(places)), np.asarray(places, np.int64)
        for k, (chunks, bits, ranks) in enumerate(self.levels):
            value[live] |= chunks[i].astype(np.int64) << 8 * k
            more = bits[i >> 3] >> (i & 7).astype(np.uint8) & 1 == 1
            live, i = live[more], i[more]
            if not len(i):
                break
            # ones of the place's block before the place: whole bytes, then the bits of the last one
            byte = (i // BLOCK * (BLOCK // 8))[:, None] + np.arange(BLOCK // 8)
            before = np.where(byte < (i >> 3)[:, None], _ONES[bits[np.minimum(byte, len(bits) - 1)]], 0).sum(axis=1)
            before += _ONES[bits[i >> 3] & ((1 << (i & 7)) - 1).astype(np.uint8)]
            i = ranks[i // BLOCK].astype(np.int64) + before
        return value

    def tokens(self) -> np.ndarray:
        """All tokens."""
        value = np.zeros(len(self), "<u4")
        where = np.arange(len(self))
        for k, (chunks, bits, _) in enumerate(self.levels):
            value[where] |= chunks.astype("<u4") << np.uint32(8 * k)
            where = where[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return value


# --- writing and reading ----------------------------------------------------------------------------

def write_files(docs: DataFrame, path: str, folder: str) -> DataFrame:
    """Encode every document, write the files to ``folder`` and return name, part, n_tokens of each."""
    ship(docs.sparkSession)
    make_folder(folder)

    def run(batches):
        enc, part, number = encoder(path), TaskContext.get().partitionId(), 0
        doc_ids, coded, size, done = [], [], 0, []

        def flush():
            nonlocal doc_ids, coded, size, number
            ends = np.cumsum([len(c) // 4 for c in coded])
            name = f"tokens-{part:08d}-{number:06d}.dac"
            put(folder, name, to_bytes(doc_ids, ends, np.frombuffer(b"".join(coded), "<u4")))
            done.append((name, part, int(ends[-1])))
            doc_ids, coded, size, number = [], [], 0, number + 1

        end = pack([END_ID])

        def add(rows):
            nonlocal size
            for (d, _), ids in zip(rows, enc.encode_all([t for _, t in rows])):
                doc_ids.append(d)
                coded.append(ids + end)
                size += len(coded[-1]) // 4
                if size >= TOKENS_IN_FILE:
                    flush()

        rows, chars = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append(row)
                chars += len(row[1])
                if chars >= SLICE:
                    add(rows)
                    rows, chars = [], 0
        add(rows)
        if coded:
            flush()
        cols = list(zip(*done)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()),
                                          pa.array(cols[2], pa.int64())], ["name", "part", "n_tokens"])

    t = texts(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    order = [F.col("doc_id"), F.substring("text", 1, PREFIX), F.xxhash64("text")]
    t = t.repartitionByRange(*order).sortWithinPartitions(*order)
    # Written at once: the files come from one run of this job.
    return written(t.mapInArrow(run, "name string, part long, n_tokens long"), "dac-files")


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """name, doc_id, start (in the file), n_tokens, ids_crc32, last_id of every document in the files: the
    last by direct access (rank directories), the rest by decoding the levels."""
    ship(spark)

    def run(batches):
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                r = Reader(data.as_buffer().to_pybytes())
                ids, ends = r.tokens(), r.ends.astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
                last = r.at(ends - 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(ends), pa.string()), pa.array(r.doc_ids, pa.int64()), pa.array(starts),
                     pa.array(ends - starts), pa.array(crc, pa.int64()), pa.array(last, pa.int64())],
                    ["name", "doc_id", "start", "n_tokens", "ids_crc32", "last_id"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.dac").load(folder)
    return (files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
            .mapInArrow(run, "name string, doc_id long, start long, n_tokens long, ids_crc32 long, last_id long"))


def round_trip(docs: DataFrame, path: str, folder: str | None = None) -> DataFrame:
    """doc_id, start (tokens of all documents before it), n_tokens, ids_crc32, from the files. A document
    whose last token, read by direct access, is not the end id raises."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "dac")
    files = write_files(docs, path, folder)
    # Tokens before each file: those of earlier partitions, then of earlier files of its own.
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    own = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("name")) - F.col("n_tokens")
    base = files.withColumn("own", own).join(parts, "part").select("name", (F.col("before") + F.col("own")).alias("base"))
    ended = F.when(F.col("last_id") == END_ID, F.col("n_tokens")).otherwise(
        F.raise_error(F.concat(F.lit("no end id in "), "name")).cast("long"))
    return (read_files(spark, folder).join(base, "name").withColumn("n_tokens", ended)
            .select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32"))
