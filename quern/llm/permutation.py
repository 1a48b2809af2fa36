"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of distance. Each block has
an inverted file: for each pivot the rows that hold it among their nearest, with
its place there. A query reads the lists of its own nearest pivots only; the
footrule distance of a row is the sum of the differences of places, where a pivot
that one side lacks counts as the place after its last. Rows come in order of that
distance, and the nearest SHARE of a block, with all rows that tie at the cut, are
reranked by their exact Euclidean distance.

The pivots are fitted on a bounded sample; every vector is indexed. SHARE is how
deep the index is read, in proportion to the block, so it behaves alike at every
size; on vectors without any structure, the worst case, recall is above 0.9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import small_batches, stage
from quern.llm.vectorblocks import BATCH, Dealing, finite, matrix, packed, streamed

K = 10
EVERY = 100
#: Pivots of each length of vectors, and how many of them, nearest first, stand for a vector.
PIVOTS = 160
NEAREST = 128
#: Part of a block that is reranked.
SHARE = 0.25
#: Distinct vectors that the pivots are chosen from, about.
SAMPLE = 8192


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact Euclidean distances, each from its own row alone, so that equal vectors tie."""
    return np.sqrt(((x - q) ** 2).sum(1))


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """[n, nearest] numbers of the nearest pivots in order; ties by number."""
    near = (pivots**2).sum(1) / 2 - x @ pivots.T
    return np.argsort(near, axis=1, kind="stable")[:, :nearest]


class Index:
    """A block's inverted files: the rows and places of each pivot's postings, one after the other."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, pivots: np.ndarray, rows: np.ndarray, places: np.ndarray, ends: np.ndarray):
        self.ids, self.x, self.pivots, self.rows, self.places, self.ends = ids, x, pivots, rows, places, ends

    @staticmethod
    def posted(x: np.ndarray, pivots: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, places, ends): postings sorted by pivot, and where each pivot's end."""
        order = nearest_pivots(x, pivots, nearest)
        flat = order.ravel()
        by_pivot = np.argsort(flat, kind="stable")
        rows, places = np.divmod(by_pivot, order.shape[1])
        return rows.astype("<i4"), places.astype("<i2"), np.cumsum(np.bincount(flat, minlength=len(pivots))).astype("<i8")

    @classmethod
    def stored(cls, row: dict) -> Index:
        parts = [np.frombuffer(row[n], k) for n, k in (("rows", "<i4"), ("places", "<i2"), ("ends", "<i8"))]
        pivots = np.frombuffer(row["pivots"], "<f8").reshape(-1, row["dim"])
        return cls(np.frombuffer(row["vec_id"], "<i8"), matrix(row, "x", "<f8"), pivots, *parts)

    def footrules(self, order: np.ndarray) -> np.ndarray:
        """Footrule distance of every row to a query whose nearest pivots are `order`."""
        k = len(order)
        # as if no pivot were shared: both sides' places against the one after the last; what is shared is taken off
        total = np.full(len(self.ids), k * (k + 1), np.int64)
        for place, pivot in enumerate(order.tolist()):
            a, b = (self.ends[pivot - 1] if pivot else 0), self.ends[pivot]
            there = self.places[a:b].astype(np.int64)
            total[self.rows[a:b]] += np.abs(there - place) - (k - there) - (k - place)
        return total

    def search(self, vec_id: int, q: np.ndarray, order: np.ndarray, k: int, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest among the share of the block that comes first by footrule."""
        others = np.flatnonzero(self.ids != vec_id)
        far = self.footrules(order)[others]
        read = max(k, int(np.ceil(share * len(others))))
        if read < len(others):
            others = others[far <= np.partition(far, read - 1)[read - 1]]
        exact = distances(self.x[others], q)
        best = np.lexsort((self.ids[others], exact))[:k]
        return self.ids[others[best]], exact[best]


def vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, dim, x): the usable vectors in double precision."""
    usable = rows.where(F.col("vec_id").isNotNull() & finite("embedding")).where(F.exists("embedding", lambda v: v != 0))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("embedding").alias("dim"), F.col("embedding").cast("array<double>").alias("x"))


def chosen_pivots(usable: DataFrame, pivots: int = PIVOTS, sample: int = SAMPLE) -> DataFrame:
    """(dim, pivots): for each length, distinct vectors with the least hashes of a sample of about `sample` distinct vectors or all.

    Copies have one hash, so a vector that is everywhere is one pivot at most.
    """
    sizes = usable.groupBy("dim").agg(F.count("*").alias("n"))
    hashed = usable.select("dim", "x", F.xxhash64("x").alias("h")).join(sizes, "dim")
    some = hashed.where(F.pmod("h", F.greatest(F.lit(1), F.floor(F.col("n") / sample))) == 0).dropDuplicates(["dim", "x"])
    first = Window.partitionBy("dim").orderBy("h", "x")
    few = some.withColumn("place", F.row_number().over(first)).where(F.col("place") <= pivots)
    return few.groupBy("dim").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", "x"))), lambda s: s["x"])).alias("pivots"))


def indexed(packed_blocks: DataFrame, pivots: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """Blocks with their pivots and inverted files."""
    names = ["dim", "block", "vec_id", "x", "pivots", "rows", "places", "ends"]
    schema = "dim int, block long, " + ", ".join(f"{n} binary" for n in names[2:])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                of = np.array(row["pivots"]).reshape(-1, row["dim"])
                parts = [of.astype("<f8"), *Index.posted(matrix(row, "x", "<f8"), of, nearest)]
                values = [pa.array([row["dim"]], pa.int32()), pa.array([row["block"]], pa.int64()), pa.array([row["vec_id"]]), pa.array([row["x"]])]
                yield pa.RecordBatch.from_arrays(values + [pa.array([p.tobytes()]) for p in parts], names)

    return packed_blocks.join(pivots, "dim").mapInArrow(post, schema)


def nearest(rows: DataFrame, k: int = K, every: int = EVERY, pivots: int = PIVOTS, nearest_of: int = NEAREST, share: float = SHARE,
            block_rows: int | None = None, batch: int = BATCH) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by `every`, the k nearest found by Euclidean distance, ties by smaller vec_id.

    A share of 1 reranks every row and is exact. Null vectors, zero vectors, those
    with null or non-finite components and those without a vec_id take no part;
    vectors of another length are not compared; other columns are ignored; fewer
    than k others give fewer rows, an empty table none. Rows that repeat a vec_id
    are candidates each for itself, never for their own id; of a query's rows the
    least vector asks. Blocks are staged; neither side is broadcast or collected.
    """
    small_batches(rows.sparkSession)
    usable = stage(vectors(rows).withColumn("deal", F.rand(13)))
    asks = F.col("vec_id") % every == 0
    dealing = Dealing(usable, asks, block_rows, batch)
    kinds = {"vec_id": "<i8", "x": "<f8"}
    blocks = stage(indexed(packed(usable.withColumn("block", dealing.block()), kinds), chosen_pivots(usable, pivots), nearest_of))
    one = F.min(F.struct("dim", "x", "deal")).alias("one")
    asked = usable.where(asks).groupBy("vec_id").agg(one).select("vec_id", "one.*").withColumn("block", dealing.batch())

    def search(index: Index, row: dict) -> Iterator[list[np.ndarray]]:
        ids, q = np.frombuffer(row["vec_id"], "<i8"), matrix(row, "x", "<f8")
        orders = nearest_pivots(q, index.pivots, nearest_of)
        for i in range(len(ids)):
            found, exact = index.search(int(ids[i]), q[i], orders[i], k, share)
            yield [np.full(len(found), ids[i]), found, exact]

    found = stage(streamed(blocks, stage(packed(asked, kinds)), Index.stored, search, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
