"""Repeated passages by prefix-partitioned suffix trees.

A passage is `depth` words. Every window of `depth` words has one anchor: of the
places where a prefix of `label` words fits into it, the one whose prefix has the
least hash, so equal windows have it at the same offset. The suffixes that begin
at anchors are the leaves; neighbouring windows of one anchor are a run and go
with it as one row. Prefixes that occur once are dropped before any text is moved.

Prefixes are of variable length. Runs that are equal in all their words are one
kind from the start. A prefix with over `most` kinds is lengthened: the windows
of its runs are dealt into a near and a far half by their offset, and each half
has the longer prefix that all its windows share. So groups shrink, equal runs
meet again and lone prefixes drop out, until a group fits or has one window,
which is one node by itself. No task holds more than `most` kinds of a prefix.

A group becomes its tree: leaves sorted by the words from the anchor on, with the
array of common prefix lengths, and likewise by the words before it, backward.
Internal nodes of both, whose depths add up to `depth`, are the repeats at each
offset. The first leaf of a node by (doc_id, start) stays, the words under the
others go; overlapping windows of these make up the maximal repeats.

What moves: for each prefix in a document a hash and the doc_id, then the texts
of documents that share prefixes, then of each kind of run the words of one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import small_batches, stage, whole_runs

DEPTH = 20
LABEL = 8
MOST = 1000
#: In place of a null doc_id, which comes last.
LAST = (1 << 63) - 1
#: Bytes of text whose words are handled at once; one text is never cut.
CHUNK = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.full(n, np.uint64(0xD6E8FEB86659FD93)))


_POWERS = _powers(1 << 12)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(32)) * _ODD
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


class Words:
    """The words of some texts in turn, by byte bounds; doc is the number of each word's text, first the first word of each text."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        gap = _SPACE[data]
        edge = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
        self.data, self.gap = data, gap
        self.start, self.end = edge[::2], edge[1::2]
        self.doc = np.searchsorted(bounds, self.start, "right") - 1
        self.first = np.searchsorted(self.start, bounds)

    def hashes(self) -> np.ndarray:
        length = self.end - self.start
        if not len(length):
            return np.zeros(0, np.uint64)
        letters = np.flatnonzero(~self.gap)
        begin = np.concatenate([[0], np.cumsum(length)[:-1]])
        within = np.arange(len(letters)) - np.repeat(begin, length)
        value = (self.data[letters].astype(np.uint64) + np.uint64(1)) * _POWERS[within & len(_POWERS) - 1]
        return _mixed(np.add.reduceat(value, begin) + length.astype(np.uint64))

    def suffixes(self, depth: int, label: int) -> tuple[np.ndarray, ...]:
        """Runs of suffix starts that share a label: first start, number, place of the label, and the label's hash."""
        none = np.zeros(0, np.int64)
        n = len(self.start)
        if n < depth:
            return none, none, none, none
        word = self.hashes()
        gram = np.zeros(n - label + 1, np.uint64)
        for i in range(label):
            gram = gram * np.uint64(0xD1342543DE82EF95) + word[i : n - label + 1 + i]
        gram = _mixed(gram)
        least, place, width = gram, np.arange(len(gram)), 1
        reach = depth - label + 1
        while width < reach:
            step = min(width, reach - width)
            a, b = slice(0, len(least) - step), slice(step, None)
            left = least[a] <= least[b]
            least, place = np.where(left, least[a], least[b]), np.where(left, place[a], place[b])
            width += step
        start = np.flatnonzero(self.doc[: n - depth + 1] == self.doc[depth - 1 :])
        if not len(start):
            return none, none, none, none
        place = place[start]
        new = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)]))
        return start[new], np.diff(np.concatenate([new, [len(start)]])), place[new], gram[place[new]].view(np.int64)


def _chunks(batch: pa.RecordBatch):
    """Parts of a batch of about CHUNK bytes of text, as (part, texts)."""
    texts = [x or b"" for x in batch.column("text").cast(pa.binary()).to_pylist()]
    a = size = 0
    for b, x in enumerate(texts, 1):
        size += len(x)
        if size >= CHUNK or b == len(texts):
            yield batch.slice(a, b - a), texts[a:b]
            a, size = b, 0


def labels(docs: DataFrame, depth: int, label: int) -> DataFrame:
    """(label, key, n): how many runs of windows of each document have a prefix; key is for doc_id and text."""

    def find(batches):
        for batch in batches:
            for part, texts in _chunks(batch):
                words = Words(texts)
                start, _, _, key = words.suffixes(depth, label)
                if len(start):
                    of = part.column("key").to_numpy()[words.doc[start]]
                    order = np.lexsort((key, of))
                    of, key = of[order], key[order]
                    new = np.flatnonzero(np.concatenate([[True], (of[1:] != of[:-1]) | (key[1:] != key[:-1])]))
                    count = np.diff(np.concatenate([new, [len(of)]])).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(key[new]), pa.array(of[new]), pa.array(count)], ["label", "key", "n"])

    return docs.mapInArrow(find, "label long, key long, n int")


def _found(batches, depth: int, label: int, column: str):
    """For each part: its words, rows, and the runs of suffixes whose label is in the row's list."""
    for batch in batches:
        for part, texts in _chunks(batch):
            words = Words(texts)
            start, count, place, key = words.suffixes(depth, label)
            if len(start):
                lists = part.column(column)
                wanted = lists.flatten().to_numpy()
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                of = words.doc[start]
                have = _pair_in(of, key, row, wanted)
                if have.any():
                    yield words, part, of[have], start[have], count[have], place[have], key[have]


def _pair_in(a1: np.ndarray, a2: np.ndarray, b1: np.ndarray, b2: np.ndarray) -> np.ndarray:
    """Which pairs (a1, a2) are among the pairs (b1, b2)."""
    names, code = np.unique(np.concatenate([a2, b2]), return_inverse=True)
    pair = np.concatenate([a1, b1]) * len(names) + code
    return np.isin(pair[: len(a1)], pair[len(a1) :])


def _two(values: list[bytes]) -> np.ndarray:
    """128-bit digests as two columns of longs."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, values)), "<i8").reshape(-1, 2)


RUN = "label long, h1 long, h2 long, did long, digest long, start int, n int, low int"


def _spaced(words: Words, start: np.ndarray, count: np.ndarray, depth: int) -> list[bytes]:
    """The words of each run of windows, joined by single spaces."""
    data, last = words.data, start + count + depth - 2
    return [b" ".join(data[a:b].tobytes().split()) for a, b in zip(words.start[start].tolist(), words.end[last].tolist(), strict=True)]


def runs_of(rows: DataFrame, depth: int, label: int) -> DataFrame:
    """RUN: the runs of windows whose prefix is in the row's list `labels`; rows: did, digest, key, text, labels.

    start is the first window's first word, n the number of windows, low the offset of the last window's anchor.
    """

    def find(batches):
        for words, part, of, start, count, place, key in _found(batches, depth, label, "labels"):
            two = _two(_spaced(words, start, count, depth))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(part.column("did").to_numpy()[of]),
                 pa.array(part.column("digest").to_numpy()[of]), pa.array((start - words.first[of]).astype(np.int32)),
                 pa.array(count.astype(np.int32)), pa.array((place - start - count + 1).astype(np.int32))],
                ["label", "h1", "h2", "did", "digest", "start", "n", "low"])

    return rows.mapInArrow(find, RUN)


def _kinds(runs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of staged runs the first of each kind, with the number of kinds of its prefix (over one), and marks for all others.

    Joined by a hash of the kind, not by the kind itself: both sides are dealt anew, so a hot kind's side can be split.
    """
    first = stage(runs.groupBy("label", "h1", "h2").agg(
        F.min(F.struct("did", "digest", "start", "n", "low")).alias("run"), F.count("*").alias("leaves")))
    ends = first.where("leaves > 1").select(
        F.xxhash64("h1", "h2").alias("kind"), F.col("h1").alias("f1"), F.col("h2").alias("f2"), F.struct("run.did", "run.digest", "run.start").alias("place"))
    joined = runs.select("h1", "h2", "did", "digest", "start", "n").withColumn("kind", F.xxhash64("h1", "h2")).join(ends, "kind")
    later = joined.where("h1 - f1 = 0 and h2 - f2 = 0").where(F.struct("did", "digest", "start") != F.col("place"))
    marks = later.select("did", "digest", "start", (F.expr("shiftleft(1L, n)") - 1).alias("mask"))
    sizes = first.groupBy("label").agg(F.count("*").alias("kinds")).where("kinds > 1").select(F.xxhash64("label").alias("key"), F.col("label").alias("of"), "kinds")
    sized = first.select("label", "h1", "h2", "run.*").withColumn("key", F.xxhash64("label")).join(sizes, "key").where("label - of = 0")
    return sized.drop("key", "of"), marks


def _sent(rows: DataFrame, depth: int) -> DataFrame:
    """The given runs with their words; rows: did, digest, text, runs (array of structs, with the digest of their text)."""

    def send(batches):
        for batch in batches:
            for part, texts in _chunks(batch):
                lists = part.column("runs")
                fields = {f.name: lists.flatten().field(i).to_numpy() for i, f in enumerate(lists.type.value_type)}
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                mine = fields["digest"] == part.column("digest").to_numpy()[row]
                if mine.any():
                    fields, row = {k: v[mine] for k, v in fields.items()}, row[mine]
                    words = Words(texts)
                    around = _spaced(words, words.first[row] + fields["start"], fields["n"], depth)
                    columns = {"label": fields["label"], "did": part.column("did").to_numpy()[row]} | {k: fields[k] for k in ("digest", "start", "n", "low", "kinds")}
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns.values()), pa.array(around, pa.binary())], [*columns, "words"])

    return rows.mapInArrow(send, "label long, did long, digest long, start int, n int, low int, kinds long, words binary")


def _lengthened(runs: DataFrame, depth: int, span: int) -> DataFrame:
    """RUN with words: each run's windows in two halves, with the prefix that a half's windows share; offsets are 0 to span."""
    middle = (span + 1) // 2

    def halve(batches):
        for batch in batches:
            out = []
            values = zip(*(batch.column(c).to_pylist() for c in ("label", "did", "digest", "start", "n", "low", "words")), strict=True)
            for label, did, digest, start, n, low, text in values:
                w, high = text.split(b" "), low + n - 1
                for half, a, b in ((0, low, min(high, middle - 1)), (1, max(low, middle), high)):
                    if a <= b:
                        skip, most = high - b, (span - middle, middle - 1)[half == 0]
                        at = high - middle * half  # where the longer prefix begins
                        prefix = b" ".join(w[at : at + depth - most])
                        out.append((xxhash.xxh64_intdigest(prefix, label & 0xFFFFFFFF ^ half) - (1 << 63), did, digest, start + skip, b - a + 1, a - middle * half,
                                    b" ".join(w[skip : skip + b - a + depth])))
            if out:
                label, did, digest, start, n, low, words = zip(*out, strict=True)
                two = _two(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label, pa.int64()), pa.array(two[:, 0]), pa.array(two[:, 1]), pa.array(did, pa.int64()), pa.array(digest, pa.int64()),
                     pa.array(start, pa.int32()), pa.array(n, pa.int32()), pa.array(low, pa.int32()), pa.array(words, pa.binary())],
                    ["label", "h1", "h2", "did", "digest", "start", "n", "low", "words"])

    return runs.mapInArrow(halve, RUN + ", words binary")


def _common(sorted_rows: np.ndarray) -> np.ndarray:
    """Common prefix length of each row and the one before it; 0 for the first."""
    differ = sorted_rows[1:] != sorted_rows[:-1]
    length = np.where(differ.any(axis=1), differ.argmax(axis=1), sorted_rows.shape[1])
    return np.concatenate([[0], length])


class Tree:
    """The sorted leaves of some words a leaf, as numbers, and their common prefix lengths."""

    def __init__(self, words: np.ndarray):
        self.order = np.lexsort(words.T[::-1]) if words.shape[1] else np.arange(len(words))
        self.common = _common(words[self.order])

    def nodes(self, depth: int) -> np.ndarray:
        """For each leaf the number of the node of that depth that it hangs from."""
        node = np.empty(len(self.order), np.int64)
        node[self.order] = np.cumsum(self.common < depth) - (0 < depth)
        return node


def repeats(number: np.ndarray, begin: np.ndarray, n: np.ndarray, low: np.ndarray, depth: int) -> np.ndarray:
    """For runs in the order of their places, a mask of their windows that an earlier run has too.

    number holds the words of all runs, as numbers; begin is where each run's words begin in it.
    """
    m, high = len(n), low + n - 1
    span = int(high.max(initial=0))
    at = begin + high
    take = lambda ok, places: np.where(ok, number[np.where(ok, places, 0)], -1)
    after = np.stack([take(j < depth - low, at + j) for j in range(depth)], axis=1)
    before = np.stack([take(j < high, at - 1 - j) for j in range(span)], axis=1) if span else np.zeros((m, 0), np.int64)
    forward, backward = Tree(after), Tree(before)
    masks = np.zeros(m, np.int64)
    for offset in range(span + 1):
        have = np.flatnonzero((low <= offset) & (offset <= high))
        if len(have) > 1:
            node = forward.nodes(depth - offset)[have] * m + backward.nodes(offset)[have]
            _, first, which = np.unique(node, return_index=True, return_inverse=True)
            later = first[which] != np.arange(len(have))
            masks[have[later]] |= np.int64(1) << (high[have[later]] - offset)
    return masks


def _gathered(tables, rows: int):
    """Tables put together to about so many rows."""
    held, n = [], 0
    for table in tables:
        held.append(table)
        n += table.num_rows
        if n >= rows:
            yield pa.concat_tables(held)
            held, n = [], 0
    if held:
        yield pa.concat_tables(held)


def _subtrees(sent: DataFrame, depth: int) -> DataFrame:
    """The trees of groups: rows (label, did, digest, start, n, low, words) to marks (did, digest, start, mask).

    Bit i of mask is for the window at start + i.
    """

    def build(batches):
        for table in _gathered(whole_runs(batches, "label"), 8192):
            did, digest, start, n, low = (table[c].to_numpy() for c in ("did", "digest", "start", "n", "low"))
            order = np.lexsort((start + n + low, digest, did))
            words = pc.split_pattern(table["words"].combine_chunks(), b" ")
            number = words.flatten().dictionary_encode().indices.to_numpy().astype(np.int64)
            begin = words.offsets.to_numpy()[:-1].astype(np.int64) - words.offsets[0].as_py()
            masks = repeats(number, begin[order], n[order], low[order], depth)
            some = masks > 0
            at = order[some]
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(did[at]), pa.array(digest[at]), pa.array(start[at]), pa.array(masks[some])], ["did", "digest", "start", "mask"])

    rows = sent.select("label", "did", "digest", "start", "n", "low", "words").repartition("label").sortWithinPartitions("label")
    return rows.mapInArrow(build, "did long, digest long, start int, mask long")


def marked(base: DataFrame, depth: int = DEPTH, label: int = LABEL, most: int = MOST) -> DataFrame:
    """Marks (did, digest, start, mask) of the repeated windows of base (did, digest, key, text) but the first of each."""
    found = stage(labels(base, depth, label))
    shared = stage(found.groupBy("label").agg(F.sum("n").alias("n")).where("n > 1").select("label"))
    mine = found.select("label", "key").join(shared, "label").groupBy("key").agg(F.collect_list("label").alias("labels"))
    runs = stage(runs_of(base.join(mine, "key"), depth, label))
    kinds, marks = _kinds(runs)
    wanted = kinds.groupBy(F.xxhash64("did", "digest").alias("key")).agg(F.collect_list(F.struct("label", "digest", "start", "n", "low", "kinds")).alias("runs"))
    sent = stage(_sent(base.join(wanted, "key"), depth))
    few, many, span = sent.where(F.col("kinds") <= most), sent.where(F.col("kinds") > most), depth - label
    while span and many.limit(1).count():
        runs = stage(_lengthened(many, depth, span))
        span -= (span + 1) // 2
        kinds, more = _kinds(runs.drop("words"))
        keys = ["label", "h1", "h2", "did", "digest", "start", "n", "low"]
        sent = stage(kinds.join(runs.dropDuplicates(keys), keys).select("label", "did", "digest", "start", "n", "low", "kinds", "words"))
        marks = marks.unionByName(more)
        few, many = few.unionByName(sent.where(F.col("kinds") <= most)), sent.where(F.col("kinds") > most)
    return marks.unionByName(_subtrees(few, depth))


def keep_first(docs: DataFrame, depth: int = DEPTH, label: int = LABEL, most: int = MOST) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row of docs (doc_id, text); kept is the kept words, joined by spaces.

    Null texts have no words; texts shorter than `depth` words lose none. A null
    doc_id comes after all others. Rows that repeat a doc_id with another text
    stand in the order of the texts' hashes; with the same text they are one
    document and lose nothing to each other. Other columns are ignored; an empty
    table gives an empty result. The same words are removed whatever `label` and
    `most` are; those set sizes only.
    """
    if not 0 < depth - label < 62:
        raise ValueError("a prefix is 1 to 61 words shorter than a passage")
    small_batches(docs.sparkSession)
    hashed = F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(LAST))
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("did"),
        F.when(F.col("doc_id").isNull(), hashed).otherwise(hashed - F.lit(LAST) - 1).alias("digest"),  # so nulls come last
        F.coalesce("text", F.lit("")).alias("text"))
    base = base.withColumn("key", F.xxhash64("did", "digest"))
    gone = marked(base.drop("doc_id"), depth, label, most)
    gone = gone.groupBy(F.xxhash64("did", "digest").alias("key")).agg(F.collect_list("start").alias("start"), F.collect_list("mask").alias("mask"))
    joined = base.join(gone, "key", "left")

    def cut(batches):
        for batch in batches:
            out = []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, starts, masks in zip(texts, batch.column("start").to_pylist(), batch.column("mask").to_pylist(), strict=True):
                words = text.split()
                n = len(words)
                if starts:
                    begin, mask = np.array(starts, np.int64), np.array(masks, np.int64)
                    change = np.zeros(n + 1, np.int64)
                    for i in range(int(mask.max(initial=0)).bit_length()):
                        at = begin[mask >> i & 1 == 1] + i
                        np.add.at(change, at, 1)
                        np.add.at(change, at + depth, -1)
                    words = [words[i] for i in np.flatnonzero(np.cumsum(change[:n]) == 0).tolist()]
                out.append((n, n - len(words), b" ".join(words)))
            n, removed, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"])

    return joined.select("doc_id", "text", "start", "mask").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
