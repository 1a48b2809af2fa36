"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of the id pairs that meet.

Both tokenizers cut a text's bytes; places where both end cut it into groups, and
every place where either ends closes one link, the A and the B token that overlap
there. Neither joins across a space or a line end that follows something else, so
a text is a sequence of words that begin there, and a word is encoded and aligned
once for each chunk of texts, however often it comes.

Pass one encodes every text and keeps, for each chunk, its words' ids, the texts
as numbers of words, and how many links hold each id pair. The distinct pairs are
dealt into buckets by hash; a bucket gets a minimal perfect hash, a cascade of bit
arrays whose ranks number its keys without gaps. Chunks then add to dense count
vectors, indexed by that hash, each key verified against the one stored at its
place; the vectors are summed up a tree of FAN to one. Pass two aligns the texts
again and looks its chunk's pairs up.

Nothing whole passes through one task: a bucket holds about BUCKET_KEYS pairs, a
chunk one batch of texts, and what goes to all tasks is one number for each B
token, which the vocabulary bounds.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from math import ceil

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import small_batches, stage, whole_runs
from quern.llm.packing import _printable

BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BUCKET_KEYS = 1 << 16
FAN = 64
#: Words that are encoded at once, at most.
RUN = 1000
#: A word: a space or line end after something that is no white space, and all up to the next one.
_WORDS = re.compile(r"[ \n]\s*+\S*+(?:[^\S \n]\s*+\S*+)*+")


# -- encoding and aligning ---------------------------------------------------------------------------------------------


class Encoders:
    """Both tokenizers: A byte-level, B of pieces with bytes to fall back to; a token's bytes by its id.

    A's merges are ranked by id, so its vocabulary alone encodes, without special
    tokens: their strings in a text are plain text.
    """

    def __init__(self, byte_level: str, pieces: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        byte_of = {c: i for i, c in enumerate(_printable())}
        whole = Tokenizer.from_file(byte_level)
        special = {x.content for x in whole.get_added_tokens_decoder().values()}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in whole.get_vocab(with_added_tokens=True).items() if token not in special}
        self.a = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_sizes, self.b_sizes = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        #: An A id in decimal, then each of the marks: another of its group, B's part of the group, the next group.
        self.written = [f"{i}{mark}" for mark in ",|;" for i in range(max(len(self.a_bytes), len(self.b_bytes)))]

        joined = [x for i, x in enumerate(self.b_bytes) if not self.b.is_byte(i) and re.search(rb"[^ ] |\n", x)]
        if joined:
            raise ValueError("pieces join words, so words can't be encoded by themselves")
        self.kind = np.dtype("<u2" if max(len(self.a_bytes), len(self.b_bytes)) <= 1 << 16 else "<u4")

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[1:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def cut(self, text: str | None) -> list[str]:
        """The words of a space and the text; none of a null or empty text."""
        return _WORDS.findall(" " + text) if text else []

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[int]]:
        """A's and B's ids of words that follow each other, how many each word has, and the words that either's tokens do not spell, which have none."""
        parts, lost, start = [], [], 0
        for i, word in enumerate(words):
            if word[-1].isspace() or i + 1 == len(words) or i + 1 - start == RUN:  # after white space the next word would not begin here
                self._run(words, start, i + 1, parts, lost)
                start = i + 1
        kinds = (self.kind, self.kind, np.dtype("<u4"), np.dtype("<u4"))
        joined = [np.concatenate([np.zeros(0, k), *(p[j] for p in parts)]).astype(k) for j, k in enumerate(kinds)]
        return (*joined, lost)

    def _run(self, words: list[str], start: int, end: int, parts: list, lost: list[int]) -> None:
        """Encodes a run of words at once; one that is not spelled is halved until the word is found."""
        text = "".join(words[start:end])
        true = text.encode()
        # B puts a space before a text; a line end after it keeps that apart from the words
        a, b = self.a.encode_to_numpy(text), np.array(self.b.encode("\n" + text)[2:], np.int64)
        if b"".join(map(self.a_bytes.__getitem__, a.tolist())) == true == b"".join(map(self.b_bytes.__getitem__, b.tolist())):
            ends = np.cumsum(np.fromiter((len(w) if w.isascii() else len(w.encode()) for w in words[start:end]), np.int64, end - start))
            count = lambda sizes: np.diff(np.searchsorted(np.cumsum(sizes), ends, "right"), prepend=0)
            parts.append((a, b, count(self.a_sizes[a]), count(self.b_sizes[b])))
        elif end - start == 1:
            lost.append(start)
            parts.append((a[:0], b[:0], np.zeros(1, np.int64), np.zeros(1, np.int64)))
        else:
            for x, y in ((start, (start + end) // 2), ((start + end) // 2, end)):
                self._run(words, x, y, parts, lost)


@lru_cache(2)
def encoders(byte_level: str, pieces: str) -> Encoders:
    """This worker's tokenizers."""
    return Encoders(byte_level, pieces)


class Aligned:
    """The links of words, one after the other; per word the numbers of tokens, groups and links. a and b: the ids; n_a and n_b: how many of each word."""

    def __init__(self, of: Encoders, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.of, self.a, self.b, self.n_a, self.n_b = of, a.astype(np.int64), b.astype(np.int64), n_a.astype(np.int64), n_b.astype(np.int64)
        a_ends, b_ends = np.cumsum(of.a_sizes[self.a]), np.cumsum(of.b_sizes[self.b])
        size = int(a_ends[-1]) + 1 if len(a_ends) else 1
        in_a, in_b = np.zeros(size, bool), np.zeros(size, bool)
        in_a[a_ends], in_b[b_ends] = True, True
        ends = np.flatnonzero(in_a | in_b)
        #: Tokens of each link, and the links that end a group.
        self.of_a, self.of_b = np.searchsorted(a_ends, ends), np.searchsorted(b_ends, ends)
        self.closing = in_a[ends] & in_b[ends]
        self.keys = self.a[self.of_a].astype(np.uint64) << np.uint64(32) | self.b[self.of_b].astype(np.uint64)
        self.link_ends = np.searchsorted(self.of_a, np.cumsum(self.n_a))  # a word's last link ends with its last token
        self.n_links, self.n_groups = self.per_word(np.ones(len(ends), np.int64)), self.per_word(self.closing)

    def per_word(self, values: np.ndarray) -> np.ndarray:
        """Sums over the links of each word."""
        return np.diff(np.concatenate([[0], np.cumsum(values, dtype=np.int64)])[self.link_ends], prepend=0)

    def groups(self) -> list[str]:
        """Each word's groups as `a1,a2|b1;a3|b2,b3`."""
        n, half = len(self.a), len(self.of.written) // 3
        closing_a, closing_b = self.of_a[self.closing], self.of_b[self.closing]
        before_a = np.zeros(n, np.int64)  # a token's group
        before_a[closing_a] = 1
        group_a = np.cumsum(before_a) - before_a
        before_b = np.zeros(len(self.b), np.int64)
        before_b[closing_b] = 1
        group_b = np.cumsum(before_b) - before_b
        ends_a, ends_b = np.concatenate([[0], closing_a + 1]), np.concatenate([[0], closing_b + 1])
        order = np.zeros(n + len(self.b), np.int64)
        order[np.arange(n) + ends_b[group_a]] = self.a + half * before_a
        order[np.arange(len(self.b)) + ends_a[group_b + 1]] = self.b + 2 * half * before_b
        cuts = np.cumsum(self.n_a + self.n_b).tolist()
        written, out, start = self.of.written, [], 0
        for cut in cuts:
            out.append("".join(map(written.__getitem__, order[start:cut].tolist()))[:-1])
            start = cut
        return out


# -- minimal perfect hashing -------------------------------------------------------------------------------------------


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """64 well-mixed bits of each key."""
    x = keys ^ np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(31)


class PerfectHash:
    """A minimal perfect hash of distinct keys: at each level those that share no place set its bit, the others go on to the next.

    A key's number is the rank of its bit among the bits of all levels. The keys
    by number are stored as well, so a key that is not of the set is found out.
    """

    def __init__(self, levels: list[np.ndarray], keys: np.ndarray):
        self.levels, self.keys = levels, keys
        ranks = np.cumsum(np.concatenate([*levels, np.zeros(0, bool)]))
        starts = np.cumsum([0, *map(len, levels)])
        self.ranks = [ranks[a:b] for a, b in zip(starts, starts[1:], strict=False)]

    @classmethod
    def built(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys."""
        levels, left = [], keys
        while len(left):
            at = (mixed(left, len(levels)) % np.uint64(len(left))).astype(np.int64)
            levels.append(np.bincount(at, minlength=len(left)) == 1)
            left = left[~levels[-1][at]]
        made = cls(levels, keys)
        made.keys = keys[np.argsort(made._places(keys))] if len(keys) else keys
        return made

    def _places(self, keys: np.ndarray) -> np.ndarray:
        places = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for seed, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = (mixed(keys[open_], seed) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[at]
            places[open_[hit]] = ranks[at[hit]] - 1
            open_ = open_[~hit]
        return places

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number; a key that is not of the set is an error."""
        places = self._places(keys)
        if (places < 0).any() or (self.keys[places] != keys).any():
            raise KeyError("a pair is not among the hashed ones")
        return places

    def stored(self) -> tuple[str, bytes, bytes]:
        """The lengths of the levels, their bits, and the keys."""
        bits = np.packbits(np.concatenate([*self.levels, np.zeros(0, bool)]))
        return json.dumps([len(x) for x in self.levels]), bits.tobytes(), self.keys.astype("<u8").tobytes()

    @classmethod
    def loaded(cls, sizes: str, bits: bytes, keys: bytes) -> PerfectHash:
        sizes = json.loads(sizes)
        flat = np.unpackbits(np.frombuffer(bits, np.uint8))[: sum(sizes)].astype(bool)
        return cls(np.split(flat, np.cumsum(sizes)[:-1]) if sizes else [], np.frombuffer(keys, "<u8"))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys, 1 << 20) % np.uint64(buckets)).astype(np.int64)


# -- the passes --------------------------------------------------------------------------------------------------------


def _batch(values: list, kinds: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


def _squeezed(values: np.ndarray) -> bytes:
    return len(raw := values.tobytes()).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _spread(data: bytes, kind: np.dtype | str) -> np.ndarray:
    return np.frombuffer(pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True), kind)


#: Of a chunk: its texts' ids; its words' A and B ids and how many each has; the texts' words by number and how many each text has; its pairs and their links.
ENCODED = "chunk long, doc_ids array<bigint>, a binary, b binary, n_a binary, n_b binary, words binary, n_words binary, keys binary, counts binary"
PARTS = {"n_a": "<u4", "n_b": "<u4", "words": "<u4", "n_words": "<i8"}


def _encoded(docs: DataFrame, byte_level: str, pieces: str) -> DataFrame:
    """A row for each chunk, the batch that its texts are read in."""
    names = [c.split()[0] for c in ENCODED.split(", ")]
    kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 8]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = encoders(byte_level, pieces)
        first = TaskContext.get().partitionId() << 32
        for i, batch in enumerate(batches):
            numbers = _Numbers()
            texts = [list(map(numbers.__getitem__, of.cut(text.as_py()))) for text in batch.column("text")]
            a, b, n_a, n_b, lost = of(list(numbers))
            if lost:  # such texts have no tokens
                texts = [[] if not set(lost).isdisjoint(t) else t for t in texts]
            n_words = np.fromiter(map(len, texts), "<i8", len(texts))
            words = np.fromiter(chain.from_iterable(texts), "<u4", int(n_words.sum()))
            aligned = Aligned(of, a, b, n_a, n_b)
            keys, at = np.unique(aligned.keys, return_inverse=True)
            times = np.repeat(np.bincount(words, minlength=len(numbers)), aligned.n_links)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, at, times)
            yield _batch(
                [[first + i], [batch.column("doc_id").to_pylist()], *([_squeezed(x)] for x in (a, b, n_a, n_b, words, n_words)),
                 [keys[counts > 0].tobytes()], [counts[counts > 0].tobytes()]], kinds, names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, ENCODED)


def _distinct(links: DataFrame) -> DataFrame:
    """(key) of every pair that occurs."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column("keys"):
                yield _batch([np.frombuffer(one.as_py(), "<i8")], [pa.int64()], ["key"])

    return links.select("keys").mapInArrow(keys, "key long").distinct()


HASHES = "bucket long, sizes string, bits binary, keys binary"


def _hashes(pairs: DataFrame, buckets: int) -> DataFrame:
    """A perfect hash of each bucket's pairs."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = bucket_of(batch.column("key").to_numpy().astype(np.uint64), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("key")], ["bucket", "key"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, "bucket"):
            at, keys = table["bucket"].to_numpy(), table["key"].to_numpy().astype(np.uint64)
            for bucket in np.unique(at).tolist():
                made = PerfectHash.built(keys[at == bucket])
                yield _batch([[bucket], *([x] for x in made.stored())], [pa.int64(), pa.string(), pa.binary(), pa.binary()], ["bucket", "sizes", "bits", "keys"])

    return pairs.mapInArrow(place, "bucket long, key long").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(build, HASHES)


def _dealt(links: DataFrame, buckets: int) -> DataFrame:
    """(bucket, chunk, asked, added): each chunk's pairs and counts by bucket."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = np.frombuffer(row["keys"], "<u8"), np.frombuffer(row["counts"], "<i8")
                at = bucket_of(keys, buckets)
                order = np.argsort(at, kind="stable")
                some, first = np.unique(at[order], return_index=True)
                parts = np.split(order, first[1:])
                yield _batch(
                    [some, [row["chunk"]] * len(some), [keys[p].tobytes() for p in parts], [counts[p].tobytes() for p in parts]],
                    [pa.int64(), pa.int64(), pa.binary(), pa.binary()], ["bucket", "chunk", "asked", "added"])

    return links.mapInArrow(deal, "bucket long, chunk long, asked binary, added binary")


def _past_hashes(hashes: DataFrame, rows: DataFrame, branches: int, work, schema: str) -> DataFrame:
    """work(hash row, rows) for each bucket and branch: a bucket's rows are dealt to branches by chunk, and its hash goes to each."""
    sent = hashes.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(branches - 1))))
    both = sent.unionByName(rows.withColumn("branch", F.pmod(F.xxhash64("chunk"), F.lit(branches)).cast("int")), allowMissingColumns=True)
    ordered = both.withColumn("late", F.col("chunk").isNotNull()).repartition("bucket", "branch").sortWithinPartitions("bucket", "branch", "late")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(row for batch in batches for i in range(batch.num_rows) for row in batch.slice(i, 1).to_pylist())

    return ordered.mapInArrow(run, schema)


def _counted(hashes: DataFrame, dealt: DataFrame, chunks: int) -> DataFrame:
    """The hashes with the dense vector of the counts, summed up a tree."""
    branches = max(1, ceil(chunks / FAN))

    def add(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        of, at, total = None, None, None
        out = lambda: _batch([[at[0]], [at[1]], [total.tobytes()]], [pa.int64(), pa.int64(), pa.binary()], ["bucket", "branch", "counts"])
        for row in rows:
            if not row["late"]:
                if total is not None and total.any():
                    yield out()
                at, of = (row["bucket"], row["branch"]), PerfectHash.loaded(row["sizes"], row["bits"], row["keys"])
                total = np.zeros(len(of.keys), np.int64)
            else:
                total[of(np.frombuffer(row["asked"], "<u8"))] += np.frombuffer(row["added"], "<i8")
        if total is not None and total.any():
            yield out()

    vectors = _past_hashes(hashes, dealt, branches, add, "bucket long, branch long, counts binary")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sums = None, None
        out = lambda: _batch([[at[0]], [at[1]], [sums.tobytes()]], [pa.int64(), pa.int64(), pa.binary()], ["bucket", "branch", "counts"])
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if at != (row["bucket"], row["branch"]):
                    if at is not None:
                        yield out()
                    at, sums = (row["bucket"], row["branch"]), np.zeros(len(row["counts"]) // 8, np.int64)
                sums += np.frombuffer(row["counts"], "<i8")
        if at is not None:
            yield out()

    while True:
        branches = ceil(branches / FAN)
        up = vectors.withColumn("branch", F.col("branch") % branches)
        vectors = up.repartition("bucket", "branch").sortWithinPartitions("bucket", "branch").mapInArrow(total, vectors.schema)
        if branches == 1:
            return hashes.join(vectors.drop("branch"), "bucket")


def _rows_of_pairs(counted: DataFrame) -> DataFrame:
    """(a, b, links) of every distinct pair."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
                key = np.frombuffer(keys.as_py(), "<u8")
                parts = [(key >> np.uint64(32)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.int64), np.frombuffer(counts.as_py(), "<i8")]
                yield _batch(parts, [pa.int64()] * 3, ["a", "b", "links"])

    return counted.select("keys", "counts").mapInArrow(rows, "a long, b long, links long")


def _lookups(counted: DataFrame, dealt: DataFrame, chunks: int, best: np.ndarray) -> DataFrame:
    """(chunk, keys, counts): what each chunk asked for; a count that is its B id's highest is below zero."""

    def look(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        of, known = None, None
        for row in rows:
            if not row["late"]:
                of, known = PerfectHash.loaded(row["sizes"], row["bits"], row["keys"]), np.frombuffer(row["counts"], "<i8")
                known = np.where(known == best[(of.keys & np.uint64(0xFFFFFFFF)).astype(np.int64)], -known, known)
            else:
                found = known[of(np.frombuffer(row["asked"], "<u8"))]
                yield _batch([[row["chunk"]], [row["asked"]], [found.tobytes()]], [pa.int64(), pa.binary(), pa.binary()], ["chunk", "keys", "counts"])

    return _past_hashes(counted, dealt.drop("added"), max(1, ceil(chunks / FAN)), look, "chunk long, keys binary, counts binary")


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string"


class Alignment:
    """The two passes over (doc_id, text), with the pairs' counts between them.

    Null and empty texts, and those whose tokens do not spell a space and the text,
    have no tokens: zeros and no groups. Long texts are aligned whole, one that is
    larger than a batch is a chunk of its own. Rows that repeat are rows each for
    itself and count as such; a null doc_id stays null. Other columns are ignored;
    an empty table gives an empty result. Ids, pairs, hashes and counts are staged.
    """

    def __init__(self, docs: DataFrame, byte_level: str = BYTE_LEVEL, pieces: str = PIECES, bucket_keys: int = BUCKET_KEYS):
        small_batches(docs.sparkSession)
        self.paths = byte_level, pieces
        self.chunks = stage(_encoded(docs, *self.paths))
        links = self.chunks.select("chunk", "keys", "counts").where(F.octet_length("keys") > 0)
        pairs = stage(_distinct(links))
        n, self.n_chunks = pairs.count(), links.count()
        buckets = max(1, ceil(n / bucket_keys))
        self.dealt = stage(_dealt(links, buckets))
        self.counted = stage(_counted(stage(_hashes(pairs, buckets)), self.dealt, self.n_chunks))

    def pairs(self) -> DataFrame:
        """(a, b, links): how many links hold each id pair."""
        return _rows_of_pairs(self.counted)

    def highest(self) -> np.ndarray:
        """The highest count of each B id, as one vector; the vocabulary bounds it."""
        rows = self.pairs().groupBy("b").agg(F.max("links").alias("most")).collect()
        most = np.zeros(max((r.b for r in rows), default=0) + 1, np.int64)
        for r in rows:
            most[r.b] = r.most
        return most

    def documents(self) -> DataFrame:
        """A row for each document: RESULT, with the groups as `a1,a2|b1;a3|b2,b3`."""
        known = _lookups(self.counted, self.dealt, self.n_chunks, self.highest())
        texts = self.chunks.drop("keys", "counts").withColumn("late", F.lit(True))
        ordered = texts.unionByName(known.withColumn("late", F.lit(False)), allowMissingColumns=True).repartition("chunk").sortWithinPartitions("chunk", "late")
        paths = self.paths
        names = [c.split()[0] for c in RESULT.split(", ")]
        kinds = [pa.int64()] * 7 + [pa.string()]

        def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of = encoders(*paths)
            at, found = None, Looked()
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1)
                    if at != row.column("chunk")[0].as_py():
                        at, found = row.column("chunk")[0].as_py(), Looked()
                    if not row.column("late")[0].as_py():
                        found.add(row)
                        continue
                    get = lambda name, kind: _spread(row.column(name)[0].as_py(), kind)  # noqa: B023, E731
                    n_a, n_b, words, n_words = (get(name, kind) for name, kind in PARTS.items())
                    aligned = Aligned(of, get("a", of.kind), get("b", of.kind), n_a, n_b)
                    counts = found(aligned.keys)
                    if ((np.bincount(words, minlength=len(n_a)) > 0) & (aligned.per_word(counts == 0) > 0)).any():
                        raise KeyError("a pair of the second pass is not of the first")
                    ends = np.cumsum(n_words)
                    per_text = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[words])])[ends], prepend=0)  # noqa: B023, E731
                    sums = [aligned.n_a, aligned.n_b, aligned.n_groups, aligned.n_links, aligned.per_word(counts < 0), aligned.per_word(np.abs(counts))]
                    groups, numbers = aligned.groups(), words.tolist()
                    joined = [";".join(map(groups.__getitem__, numbers[start:end])) for start, end in zip([0, *ends.tolist()], ends.tolist())]
                    yield _batch([row.column("doc_ids")[0].as_py(), *map(per_text, sums), joined], kinds, names)

        return ordered.mapInArrow(again, RESULT)


class Looked:
    """What a chunk asked for: counts by key."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.keys: np.ndarray | None = None

    def add(self, rows: pa.RecordBatch) -> None:
        for keys, counts in zip(rows.column("keys"), rows.column("counts"), strict=True):
            self.parts.append((np.frombuffer(keys.as_py(), "<u8"), np.frombuffer(counts.as_py(), "<i8")))

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(keys) or not any(len(k) for k, _ in self.parts):
            return np.zeros(len(keys), np.int64)
        if self.keys is None:
            every = np.concatenate([k for k, _ in self.parts])
            order = np.argsort(every)
            self.keys, self.counts = every[order], np.concatenate([c for _, c in self.parts])[order]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.counts[at], 0)  # zero: a word of texts that have no tokens


def align(docs: DataFrame, **settings) -> DataFrame:
    """A row for each document, by both passes; see Alignment."""
    return Alignment(docs, **settings).documents()
