"""Hard negatives: rows of another label that score almost as high as an anchor's own positives.

Vectors are rotated at random and coded by one bit a dimension: the code of a
vector is the signs of its rotation, its stored alignment the inner product of
both. What the code leaves over is rotated anew and coded again, LEVELS times in
all, so a row has a few words of bits, as many alignments, and lengths of residues.

An anchor's inner product with a code is a sum of popcounts over the bit planes of
its rounded rotation. Weighted by the alignments they estimate the score; by
Cauchy-Schwarz it lies within |residue| times the part of the anchor that is
orthogonal to the last code, plus what rounding the anchor can add. So the
interval is sure, and rows whose interval cannot reach the best are left out after
each level. Survivors get their exact integer score.

Two passes over stored blocks: the first finds the positives, the second, which
knows their scores, the negatives between 80 % and all of each.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.bitslice import SCALE, _scores, vectors
from quern.llm.common import small_batches, stage
from quern.llm.vectorblocks import BATCH, Dealing, matrix, packed, streamed

POSITIVES = 5
NEGATIVES = 5
EVERY = 100
LEVELS = 4
PLANES = 8
#: Relative error of the floating-point sums that the intervals allow for.
SLACK = 1e-11


@lru_cache(8)
def rotation(dim: int, level: int) -> np.ndarray:
    """A fixed random orthogonal matrix for each level."""
    q, r = np.linalg.qr(np.random.default_rng([11, level]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Bits [n, dim] as [n, words]."""
    full = np.zeros((len(bits), max(1, -(-bits.shape[1] // 64)) * 8), np.uint8)
    some = np.packbits(bits, axis=1, bitorder="little")
    full[:, : some.shape[1]] = some
    return full.view("<u8")


class Codes:
    """One-bit codes of the rows of a block: of each level the bits [n, words], the alignments and the length of the residue [n]."""

    def __init__(self, x: np.ndarray, levels: int = LEVELS):
        self.dim, self.unit = x.shape[1], 1 / np.sqrt(max(1, x.shape[1]))
        rest = x.astype(float)
        self.length = np.linalg.norm(rest, axis=1)
        self.bits, self.aligned, self.residue = [], [], []
        for level in range(levels):
            turn = rotation(self.dim, level)
            turned = rest @ turn.T
            self.bits.append(_words(turned >= 0))
            self.aligned.append(np.abs(turned).sum(1) * self.unit)
            turned -= np.where(turned >= 0, self.unit, -self.unit) * self.aligned[level][:, None]
            self.residue.append(np.linalg.norm(turned, axis=1))
            rest = turned @ turn


class Anchor:
    """An anchor's rotation of a level, rounded to whole steps, as bit planes."""

    def __init__(self, q: np.ndarray, level: int, planes: int = PLANES):
        turned = q.astype(float) @ rotation(len(q), level).T
        self.length = float(np.linalg.norm(q.astype(float)))
        self.low = float(turned.min(initial=0))
        self.step = max((float(turned.max(initial=0)) - self.low) / ((1 << planes) - 1), np.finfo(float).tiny)
        digits = np.clip(np.rint((turned - self.low) / self.step), 0, (1 << planes) - 1).astype(np.int64)
        rounded = self.low + digits * self.step
        self.error, self.sum = float(np.linalg.norm(turned - rounded)), float(rounded.sum())
        self.planes = _words(digits[None, :] >> np.arange(planes)[:, None] & 1)

    def times(self, bits: np.ndarray, unit: float) -> np.ndarray:
        """Inner products of the rounded anchor with codes [n, words]."""
        count = np.zeros(len(bits), np.int64)
        for p, plane in enumerate(self.planes):
            count += np.bitwise_count(bits & plane).sum(1, dtype=np.int64) << p
        return unit * (2 * (self.low * np.bitwise_count(bits).sum(1, dtype=np.int64) + self.step * count) - self.sum)


def intervals(codes: Codes, q: np.ndarray, at: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows among `at` that keep(low, high) keeps at every level, and the bounds of their scores with q."""
    total, rounding = np.zeros(len(at)), np.zeros(len(at))
    low, high = np.full(len(at), -np.inf), np.full(len(at), np.inf)
    for level, aligned in enumerate(codes.aligned):
        anchor = Anchor(q, level)
        along = anchor.times(codes.bits[level][at], codes.unit)
        total = total + aligned[at] * along
        rounding = rounding + aligned[at] * anchor.error
        least = np.maximum(0, np.abs(along) - anchor.error)  # of the true anchor's product with this code
        across = np.sqrt(np.maximum(0, anchor.length**2 * (1 + SLACK) - least**2))
        width = codes.residue[level][at] * across + rounding + SLACK * (1 + anchor.length * codes.length[at])
        low, high = np.maximum(low, total - width), np.minimum(high, total + width)
        kept = keep(low, high)
        at, total, rounding, low, high = at[kept], total[kept], rounding[kept], low[kept], high[kept]
    return at, low, high


def _kth(values: np.ndarray, k: int) -> float:
    """The k-th largest, or minus infinity if there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


class Block:
    """A block's rows by label, with their codes."""

    def __init__(self, row: dict):
        ids, labels = np.frombuffer(row["vec_id"], "<i8"), np.frombuffer(row["label"], "<i8")
        order = np.lexsort((ids, labels))
        self.ids, self.labels, self.x = ids[order], labels[order], matrix(row, "x", "<i8")[order]
        self.codes = Codes(self.x)

    def _best(self, at: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
        return np.lexsort((self.ids[at], -scores))[:k]

    def positives(self, vec_id: int, label: int, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best other rows of the label."""
        a, b = np.searchsorted(self.labels, [label, label + 1])
        at = np.arange(a, b)
        at = at[self.ids[at] != vec_id]
        at, _, _ = intervals(self.codes, q, at, lambda low, high: high >= _kth(low, k))
        scores = _scores(self.x[at], q)
        best = self._best(at, scores, k)
        return self.ids[at[best]], scores[best]

    def negatives(self, vec_id: int, label: int, q: np.ndarray, tops: list[int], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each positive score, its place and the k best rows of another label between 80 % and all of it."""
        a, b = np.searchsorted(self.labels, [label, label + 1])
        at = np.concatenate([np.arange(a), np.arange(b, len(self.ids))])
        at = at[self.ids[at] != vec_id]
        windows = [(-(-4 * top // 5), top) for top in tops]

        def keep(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            kept = np.zeros(len(low), bool)
            for least, top in windows:
                if least <= top:
                    sure = low[(high <= top) & (low >= least)]
                    kept |= (high >= max(least, _kth(sure, k))) & (low <= top)
            return kept

        at, _, _ = intervals(self.codes, q, at, keep)
        scores = _scores(self.x[at], q)
        for place, (least, top) in enumerate(windows):
            inside = np.flatnonzero((scores >= least) & (scores <= top))
            best = inside[self._best(at[inside], scores[inside], k)]
            yield place, self.ids[at[best]], scores[best]


def _search_positives(k: int):
    def search(block: Block, row: dict) -> Iterator[list[np.ndarray]]:
        ids, labels, q = np.frombuffer(row["vec_id"], "<i8"), np.frombuffer(row["label"], "<i8"), matrix(row, "x", "<i8")
        for i in range(len(ids)):
            found, scores = block.positives(int(ids[i]), int(labels[i]), q[i], k)
            yield [np.full(len(found), ids[i]), found, scores]

    return search


def _search_negatives(k: int):
    def search(block: Block, row: dict) -> Iterator[list[np.ndarray]]:
        ids, labels, q = np.frombuffer(row["vec_id"], "<i8"), np.frombuffer(row["label"], "<i8"), matrix(row, "x", "<i8")
        ends, tops = np.cumsum(np.frombuffer(row["n_tops"], "<i8")).tolist(), np.frombuffer(row["tops"], "<i8").tolist()
        for i in range(len(ids)):
            own = tops[ends[i - 1] if i else 0 : ends[i]]
            for place, found, scores in block.negatives(int(ids[i]), int(labels[i]), q[i], own, k):
                yield [np.full(len(found), ids[i]), np.full(len(found), place + 1), found, scores]

    return search


def relabelled(rows: DataFrame, every: int = 7, classes: int = 10) -> DataFrame:
    """Rows with the label moved on by one, modulo classes, where vec_id is divisible by `every`."""
    moved = (F.col("label") + 1) % classes
    return rows.withColumn("label", F.when(F.col("vec_id") % every == 0, moved).otherwise(F.col("label")))


def mine(rows: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, every: int = EVERY, scale: int = SCALE,
         block_rows: int | None = None, batch: int = BATCH) -> DataFrame:
    """(anchor_id, positive_rank, positive_id, rank, negative_id, positive_score, negative_score) over rows (vec_id, embedding, label).

    Anchors have a vec_id divisible by `every`; their positives are the first
    `positives` other rows of the label by integer inner product, ties by smaller
    vec_id. For each of them: the first `negatives` rows of another label that
    score at least 80 % of it and no more than it. None in that range gives no
    row, so a positive below zero gives none.

    Rows with a null vec_id, label or vector, or a null or non-finite component
    take no part; vectors of another length are not compared; other columns are
    ignored; an empty table gives an empty result. Rows that repeat a vec_id are
    candidates each for itself, never for their own id; of an anchor's rows that
    of the least label, then the least vector, asks. A score beyond a long fails
    the task. Blocks are staged; neither side is broadcast or collected.
    """
    small_batches(rows.sparkSession)
    named = rows.where(F.col("label").isNotNull()).select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    usable = stage(vectors(named, scale, "label").withColumn("deal", F.rand(11)))
    asks = F.col("vec_id") % every == 0
    dealing = Dealing(usable, asks, block_rows, batch)
    kinds = {"vec_id": "<i8", "label": "<i8", "x": "<i8"}
    blocks = stage(packed(usable.withColumn("block", dealing.block()), kinds))
    one = F.min(F.struct("label", "dim", "x", "deal")).alias("one")
    anchors = stage(usable.where(asks).groupBy("vec_id").agg(one).select("vec_id", "one.*").withColumn("block", dealing.batch()))

    near = streamed(blocks, stage(packed(anchors, kinds)), Block, _search_positives(positives), "vec_id long, positive_id long, positive_score long")
    best = Window.partitionBy("vec_id").orderBy(F.desc("positive_score"), "positive_id")
    own = stage(near.withColumn("positive_rank", F.row_number().over(best)).where(F.col("positive_rank") <= positives))

    tops = own.groupBy("vec_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("positive_rank", "positive_score"))), lambda s: s["positive_score"]).alias("tops"))
    asked = anchors.join(tops, "vec_id").withColumn("n_tops", F.size("tops").cast("long"))
    far = streamed(blocks, stage(packed(asked, kinds | {"n_tops": "<i8", "tops": "<i8"})), Block, _search_negatives(negatives),
                   "vec_id long, positive_rank long, negative_id long, negative_score long")
    order = Window.partitionBy("vec_id", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    found = far.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return stage(found).join(own, ["vec_id", "positive_rank"]).select(
        F.col("vec_id").alias("anchor_id"), F.col("positive_rank").cast("int").alias("positive_rank"), "positive_id", "rank", "negative_id",
        "positive_score", "negative_score")
