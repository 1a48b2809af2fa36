"""Exact top-k by inner product over a bit-sliced index.

Rows are dealt into blocks by a hash. A block's index has, for each dimension,
the leading bits of every row's attribute as bitmaps, one a slice; it is built
once and stored with the exact attributes. For a batch of queries the slices,
weighted by the queries' own leading bits, are added up with carry-save bitmap
adders; the sum is again a row of slices, over which the k-th best is found from
the most significant slice downward. Rows that come within the quantisation
error of it are the boundary; their exact integer scores decide. Each block gives
k rows a query, and a window takes the best k.

The error is bounded by Cauchy-Schwarz from the residues, so nothing is missed.
Each block is moved and loaded once; the batches of queries stream past it, as
numbers of the fewest bytes. A task holds one block, one batch and their sums.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import small_batches, stage, whole_runs

K = 5
BLOCK_ROWS = 4096
BATCH = 256
SLICES = 5
SCALE = 256
EVERY = 50
#: Scaled components beyond it are an error, as differences of two must fit a long.
LARGEST = 1 << 60


def vectors(rows: DataFrame, scale: int = SCALE, *kept: str) -> DataFrame:
    """(vec_id, dim, x, then the columns kept): floor(scale * component) of each usable vector.

    Left out: null vectors, those with a null or non-finite component, and null
    ids. Rows that repeat a vec_id stay rows. A finite component beyond LARGEST
    fails the task.
    """
    fits = lambda v: F.abs(v.cast("double")) <= LARGEST / scale
    too_large = F.raise_error(F.lit("a component's score would not fit a long")).cast("bigint")
    x = F.transform("embedding", lambda v: F.when(fits(v), F.floor(F.lit(scale) * v.cast("double"))).otherwise(too_large))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), x.cast("array<bigint>").alias("x"), *kept)


def _least_kind(x: np.ndarray) -> np.ndarray:
    """x as integers of the fewest bytes that hold it."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)) + 1))
    return x.astype(next(k for k in ("<i1", "<i2", "<i4", "<i8") if most <= np.iinfo(k).max))


def _matrix(data: bytes, kind: str, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, kind).reshape(n, dim).astype(np.int64)


PACKED = "dim int, block long, ids binary, x binary, kind string, slices binary, shift int, residue double, spread double"


def _packed(rows: DataFrame, slices: int) -> DataFrame:
    """One row for each (dim, block): ids, the matrix, and with slices the index; as bytes."""
    rows = rows.withColumn("run", F.xxhash64("dim", "block")).repartition("run").sortWithinPartitions("run", "dim", "block", "vec_id")

    def pack(batches):
        for table in whole_runs(batches, "run"):
            for part in _groups(table):
                ids = part["vec_id"].to_numpy().astype("<i8")
                dim = part["dim"][0].as_py()
                x = part["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dim)
                index = Index.built(ids, x, slices) if slices else None
                least = _least_kind(x)
                values = [dim, part["block"][0].as_py(), ids.tobytes(), least.tobytes(), least.dtype.str]
                values += [index.bitmaps.tobytes(), index.shift, index.residue, index.spread] if index else [None] * 4
                kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.binary(), pa.int32(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [c.split()[0] for c in PACKED.split(", ")])

    return rows.mapInArrow(pack, PACKED)


def _groups(table: pa.Table):
    dim, at = table["dim"].to_numpy(), table["block"].to_numpy()
    cuts = np.flatnonzero((dim[1:] != dim[:-1]) | (at[1:] != at[:-1])) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(dim)], strict=True):
        yield table.slice(a, b - a)


def _mask(bits: np.ndarray) -> np.ndarray:
    """True as all ones, as a column over words of bitmaps."""
    return np.where(bits, ~np.uint64(0), np.uint64(0))[:, None]


def _scores(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products; one beyond a long is an error."""
    if not x.size or float(np.abs(x).max()) * float(np.abs(q).astype(float).sum()) < 1 << 62:
        return x @ q
    scores = x.astype(object) @ q.astype(object)
    if any(abs(s) >= 1 << 63 for s in scores):
        raise OverflowError("a score does not fit a long")
    return scores.astype(np.int64)


class Index:
    """The bit-sliced index of a block: ids [n], exact attributes x [n, dim], bitmaps [dim, slices, words]."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, bitmaps: np.ndarray, shift: int, residue: float, spread: float):
        self.ids, self.x, self.bitmaps, self.shift, self.residue, self.spread = ids, x, bitmaps, shift, residue, spread
        self.slices = bitmaps.shape[1]
        valid = np.zeros(bitmaps.shape[2] * 8, np.uint8)
        every = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
        valid[: len(every)] = every
        self.valid = valid.view("<u8")

    @classmethod
    def built(cls, ids: np.ndarray, x: np.ndarray, slices: int = SLICES) -> Index:
        n, dim = x.shape
        low = int(x.min()) if x.size else 0
        span = (int(x.max()) - low if x.size else 0).bit_length()
        shift = max(0, span - slices)
        lead = (x - low) >> shift
        centre = (1 << slices) / 2 - 0.5
        residue = (x - low) - (lead << shift) - ((1 << shift) - 1) / 2
        words = -(-n // 64) * 8
        bitmaps = np.zeros((dim, slices, words // 8), np.uint64)
        for b in range(slices):
            packed = np.packbits((lead >> b & 1).astype(np.uint8).T, axis=1, bitorder="little")
            full = np.zeros((dim, words), np.uint8)
            full[:, : packed.shape[1]] = packed
            bitmaps[:, b] = full.view("<u8")
        longest = lambda v: float(np.sqrt((v**2).sum(1).max(initial=0.0)))
        return cls(ids, x, bitmaps, shift, longest(residue), longest((lead - centre) * float(1 << shift)))

    @classmethod
    def stored(cls, row: dict) -> Index:
        ids, dim = np.frombuffer(row["ids"], "<i8"), row["dim"]
        words = -(-len(ids) // 64)
        slices = len(row["slices"]) // max(1, 8 * dim * words) or 1
        bitmaps = np.frombuffer(row["slices"], "<u8").reshape(dim, slices, words)
        return cls(ids, _matrix(row["x"], row["kind"], len(ids), dim), bitmaps, row["shift"], row["residue"], row["spread"])

    def sums(self, q: np.ndarray) -> tuple[list[np.ndarray], int, np.ndarray]:
        """Slices of the quantised score of every row for each query, the shift of the queries' digits, and the error in score."""
        size = np.abs(q)
        shift = max(0, int(size.max(initial=0)).bit_length() - self.slices)
        lead = size >> shift
        rest = size - (lead << shift)  # whole: the sums have the leading digits only
        error = np.linalg.norm(rest, axis=1) * self.spread + np.linalg.norm(q, axis=1) * self.residue
        columns: list[list[np.ndarray]] = []
        zero = np.zeros((len(q), len(self.valid)), np.uint64)

        def add(weight: int, bits: np.ndarray) -> None:
            while True:
                while len(columns) <= weight:
                    columns.append([])
                waiting = columns[weight]
                if len(waiting) < 2:
                    waiting.append(bits)
                    return
                a, b = waiting.pop(), waiting.pop()
                half = a ^ b
                carry = (a & b) | (half & bits)
                waiting.append(half ^ bits)
                weight, bits = weight + 1, carry

        for d in range(q.shape[1]):
            flip = _mask(q[:, d] < 0)
            digits = [(a, _mask(lead[:, d] >> a & 1 == 1)) for a in range(self.slices) if (lead[:, d] >> a & 1).any()]
            if digits:
                for b in range(self.slices):
                    bits = self.bitmaps[d, b][None, :] ^ flip
                    for a, digit in digits:
                        add(a + b, bits & digit)
        weight = 0
        while weight < len(columns):
            while len(columns[weight]) > 1:
                add(weight, zero)
            weight += 1
        return [c[0] if c else zero for c in columns], shift, error

    def search(self, queries: np.ndarray, q: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(query, vec_id, score) of the k best rows of the block for each query, its own id left out."""
        n = len(self.ids)
        slices, shift, error = self.sums(q)
        threshold = np.zeros(len(q), np.int64)
        own = np.maximum(1, np.isin(self.ids, queries).sum() and (self.ids[None, :] == queries[:, None]).sum(1))
        if n > k + 1:  # the query's own rows may be among the best
            sure, tied = np.zeros((len(q), len(self.valid)), np.uint64), np.repeat(self.valid[None, :], len(q), 0)
            for w in range(len(slices) - 1, -1, -1):
                better = tied & slices[w]
                many = np.bitwise_count(sure | better).sum(1, dtype=np.int64) >= k + own
                threshold += np.where(many, 1 << w, 0)
                keep = _mask(many)
                sure, tied = np.where(keep, sure, sure | better), np.where(keep, better, tied & ~slices[w])
        unit = 1 << (self.shift + shift)
        limit = np.maximum(0, np.floor(threshold - 2 * error / float(unit) - 1).astype(np.int64))
        above, level = np.zeros((len(q), len(self.valid)), np.uint64), np.repeat(self.valid[None, :], len(q), 0)
        for w in range(len(slices) - 1, -1, -1):
            bit = _mask(limit >> w & 1 == 1)
            above |= level & slices[w] & ~bit
            level &= ~(slices[w] ^ bit)
        chosen = above | level
        out = []
        for i, row in enumerate(chosen):
            at = np.flatnonzero(np.unpackbits(row.view(np.uint8), bitorder="little")[:n])
            at = at[self.ids[at] != queries[i]]
            scores = _scores(self.x[at], q[i])
            best = np.lexsort((self.ids[at], -scores))[:k]
            out += zip([int(queries[i])] * len(best), self.ids[at][best].tolist(), scores[best].tolist(), strict=True)
        return out


def top_k(rows: DataFrame, k: int = K, every: int = EVERY, scale: int = SCALE, block_rows: int | None = None, batch: int = BATCH) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by `every`, the k other vectors of best integer inner product.

    Ties go to the smaller vec_id; fewer than k others give fewer rows. Rows that
    repeat a vec_id are candidates each for itself, though never for their own id.
    Vectors of another length are not compared; those with null or non-finite
    components or a null vec_id take no part. Other columns are ignored; an empty
    table gives an empty result. A score beyond a long fails the task.

    A block has `block_rows` rows; by default a 256th of all, within BLOCK_ROWS
    and 16 times that, since the queries are sent once to each block. The blocks
    are staged; neither side is broadcast or collected.
    """
    spark = rows.sparkSession
    small_batches(spark)
    usable = stage(vectors(rows, scale))
    asks = F.col("vec_id") % every == 0
    n, m = usable.agg(F.sum(F.col("dim") + 1), F.sum(F.when(asks, F.col("dim") + 1))).first()
    n, m = (n or 1) / 65, (m or 1) / 65  # as vectors of 64 dimensions: longer ones make blocks of fewer rows
    block_rows = block_rows or max(BLOCK_ROWS, min(16 * BLOCK_ROWS, int(n) // 256))
    n_blocks, n_batches = ceil(n / block_rows), ceil(m / batch)
    dealt = lambda c: F.pmod(F.xxhash64("vec_id", "x"), F.lit(c))
    blocks = stage(_packed(usable.withColumn("block", dealt(n_blocks)), SLICES))
    asked = stage(_packed(usable.where(asks).withColumn("block", dealt(n_batches)), 0))
    places = blocks.select("dim", F.col("block").alias("to"))
    sent = asked.join(places, "dim").withColumn("block", F.col("to")).select(*blocks.columns)
    stream = blocks.unionByName(sent).withColumn("query", F.col("slices").isNull()).repartition(max(1, n_blocks), "dim", "block")

    def search(batches):
        at, index = None, None
        for part in batches:
            for row in part.to_pylist():
                if not row["query"]:
                    at, index = (row["dim"], row["block"]), Index.stored(row)
                    continue
                if at != (row["dim"], row["block"]):
                    raise ValueError("a batch came before its block")
                ids = np.frombuffer(row["ids"], "<i8")
                q = _matrix(row["x"], row["kind"], len(ids), row["dim"])
                for a in range(0, len(q), 2 * batch):
                    if found := index.search(ids[a : a + 2 * batch], q[a : a + 2 * batch], k):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(v, pa.int64()) for v in zip(*found, strict=True)], ["query_id", "vec_id", "score"])

    found = stage(stream.sortWithinPartitions("dim", "block", "query").mapInArrow(search, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
