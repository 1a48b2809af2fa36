"""Packing along a space-filling curve.

Tokenised documents become hashed count vectors, projected at random to few
dimensions and ordered by their Hilbert key. The documents of a range of keys
follow each other in one partition and are cut into full sequences; what is left
at a partition's end is cut at powers of two, so nothing is padded.

Tokens are made once and staged with the key; the range sort then samples and
moves staged rows only. There are as many ranges as the staged bytes ask for; a
partition holds one open sequence at a time.
"""

from __future__ import annotations

import zlib
from math import ceil

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import as_bytes, owned, small_batches, stage

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END = 1
LENGTH = 2048
BUCKETS = 256
DIMENSIONS = 3
BITS = 16
#: Entries of a worker's memo of words.
MEMO = 600_000
#: Bytes of token ids that a range holds at most, about.
RANGE_BYTES = 128 << 20
_MARKS = (b".", b",", b";", b":", b"!", b"?")


def _printable() -> list[str]:
    """The character that byte-level vocabularies write for each byte: itself if it prints, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    odd = iter(range(256, 512))
    return [chr(b if b in plain else next(odd)) for b in range(256)]


class Encoder:
    """Token ids of whole texts, equal to the tokenizer's own, with memos of words and of their letters.

    The tokenizer never joins across ASCII white space, and cuts letters from the
    marks after them; so a text's ids are those of its words in turn, and a
    word's those of its letters and its mark. Letters of Latin scripts go to the
    merges directly, all else through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.printable = _printable()
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[bytes, bytes] = {}
        self.misses = 0

    def _part(self, part: bytes, latin: bool) -> bytes:
        """Ids of letters, or of anything that stands alone."""
        key = part.lower() if latin and part.isascii() else part
        if (ids := self.parts.get(key)) is None:
            if len(self.parts) >= 2 * MEMO:
                self.parts.clear()
            if latin:
                low = part.decode().lower().encode()
                ids = [t.id for t in self.model.tokenize("".join(map(self.printable.__getitem__, low)))]
            else:
                ids = self.tokenizer.encode(part.decode(), add_special_tokens=False).ids
            ids = self.parts[key] = np.array(ids, self.kind).tobytes()
        return ids

    @staticmethod
    def _latin(part: bytes) -> bool:
        """Letters below U+0250, without the one whose small letter is two characters."""
        if part.isascii():
            return part.isalpha()
        text = part.decode()
        return text.isalpha() and max(text) < "\u0250" and "\u0130" not in text

    def _word(self, word: bytes) -> bytes:
        if self._latin(word):
            ids = self._part(word, True)
        elif word[-1:] in _MARKS and self._latin(word[:-1]):
            ids = self._part(word[:-1], True) + self._part(word[-1:], False)
        else:
            ids = self._part(word, False)
        self.misses += 1
        if len(self.words) < MEMO:
            self.words[word] = ids
        elif self.misses > 5 * MEMO:  # other words have become common
            self.words.clear()
            self.misses = 0
        return ids

    def __call__(self, text: bytes) -> bytes:
        words = text.split()
        ids = list(map(self.words.get, words))
        if None in ids:
            ids = [self._word(w) if x is None else x for w, x in zip(words, ids, strict=True)]
        return b"".join(ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder."""
    owned("packing", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Hilbert index of each row of an unsigned integer array, by Skilling's transform of axes to the transposed index."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0]) ^ swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[n - 1] & q, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def _plane(dimensions: int) -> np.ndarray:
    return np.random.default_rng(20).standard_normal((BUCKETS, dimensions)) * 2


def keys(ids: list[np.ndarray], dimensions: int = DIMENSIONS, bits: int = BITS) -> np.ndarray:
    """Hilbert keys of documents given by their token ids."""
    counts = np.stack([np.bincount((x.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(24), minlength=BUCKETS) for x in ids])
    unit = counts / np.maximum(np.linalg.norm(counts, axis=1, keepdims=True), 1)
    even = 0.5 + np.arctan(unit @ _plane(dimensions)) / np.pi
    return hilbert(np.minimum((even * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits)


def tokenised(docs: DataFrame, tokenizer: str = TOKENIZER, end: int = END, dimensions: int = DIMENSIONS) -> DataFrame:
    """(doc_id, key, n, ids) of every row; ids as little-endian unsigned numbers, of 16 bits if the vocabulary allows it."""
    small_batches(docs.sparkSession)

    def encode(batches):
        code = encoder(tokenizer)
        last = np.array([end], code.kind).tobytes()
        for batch in batches:
            if batch.num_rows:
                ids = [code(x) + last for x in as_bytes(batch.column("text"))]
                rows = [np.frombuffer(x, code.kind) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(keys(rows, dimensions)), pa.array([len(x) for x in rows], pa.int64()), pa.array(ids, pa.binary())],
                    ["doc_id", "key", "n", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, key long, n long, ids binary")


def powers(n: int) -> list[int]:
    """The powers of two that make n, largest first."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


def pieces(rows, length: int, first: int):
    """Cuts documents (doc_id, n, ids) into sequences; yields (doc_id, start, ids, n, sequence, offset)."""
    held: list[tuple] = []  # of the open sequence: doc_id, start, ids, n
    have, sequence = 0, first
    for doc_id, n, ids in rows:
        at = 0
        while at < n:
            part = ids[at : at + length - have]
            held.append((doc_id, at, part, n))
            have += len(part)
            at += len(part)
            if have == length:
                offset = 0
                for d, s, p, m in held:
                    yield d, s, p, m, sequence, offset
                    offset += len(p)
                held, have, sequence = [], 0, sequence + 1
    for size in powers(have):
        offset = 0
        while offset < size:
            d, s, p, m = held.pop(0)
            if len(p) > size - offset:
                held.insert(0, (d, s + size - offset, p[size - offset :], m))
                p = p[: size - offset]
            yield d, s, p, m, sequence, offset
            offset += len(p)
        sequence += 1


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH, end: int = END, dimensions: int = DIMENSIONS) -> DataFrame:
    """A row for each piece of a document of docs (doc_id, text): doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Every document ends with the id `end`, so a null or empty text is one token.
    Sequences are full or of a power of two, so none needs padding. Repeated rows
    are packed each for itself; with equal doc_id and text they are alike, so any
    order of them gives the same rows. Other columns are ignored.
    """
    small_batches(docs.sparkSession)
    staged = stage(tokenised(docs, tokenizer, end, dimensions))
    order = ["key", "doc_id", F.xxhash64("ids")]
    wide = np.dtype("<u4")

    def cut(batches):
        kind = encoder_kind(tokenizer)
        first = TaskContext.get().partitionId() << 40

        def rows():
            for batch in batches:
                for d, n, x in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n", "ids")), strict=True):
                    yield d, n, np.frombuffer(x, kind)

        out: list[tuple] = []
        held = 0
        for piece in pieces(rows(), length, first):
            out.append(piece)
            held += len(piece[2])
            if held > 1 << 20:
                yield table(out)
                out, held = [], 0
        if out:
            yield table(out)

    def table(out):
        d, s, p, m, q, o = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(d, pa.int64()), pa.array(s, pa.int64()), pa.array(map(len, p), pa.int64()),
             pa.array([x.astype(wide).tobytes() for x in p], pa.binary()), pa.array([zlib.crc32(x.astype(wide).tobytes()) for x in p], pa.int64()),
             pa.array(m, pa.int64()), pa.array(q, pa.int64()), pa.array(o, pa.int64())],
            ["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    ranges = ceil((staged.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) / RANGE_BYTES)
    many = ranges > int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # else Spark's own number is enough
    ranged = (staged.repartitionByRange(ranges, *order) if many else staged.repartitionByRange(*order)).sortWithinPartitions(*order)
    schema = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return ranged.select("doc_id", "n", "ids").mapInArrow(cut, schema)


def encoder_kind(path: str) -> np.dtype:
    return encoder(path).kind
