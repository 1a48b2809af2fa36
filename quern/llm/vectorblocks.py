"""Vectors dealt into blocks, and batches of queries that stream past each block.

A block is one row that holds its vectors as bytes; it is moved and loaded once.
A task holds one block, one batch and what it finds for that batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import whole_runs

BLOCK_ROWS = 4096
BATCH = 256
#: A block has as many numbers as BLOCK_ROWS vectors of this length and one more.
USUAL = 65


def finite(vector: str) -> Column:
    """The vector is there, and so is each component, as a finite number."""
    sound = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return F.col(vector).isNotNull() & sound


class Dealing:
    """How many blocks and batches a staged table (dim, deal, ...) makes; deal is a random number fixed by staging.

    Blocks are a 256th of all, within BLOCK_ROWS and 16 times that, as the queries
    are sent once to each. Repeated rows are dealt apart, so no block is hot.
    """

    def __init__(self, rows: DataFrame, asks: Column, block_rows: int | None = None, batch: int = BATCH):
        weight = F.col("dim") + 1
        n, m = rows.agg(F.sum(weight), F.sum(F.when(asks, weight))).first()
        n, m = (n or 1) / USUAL, (m or 1) / USUAL
        self.blocks = ceil(n / (block_rows or max(BLOCK_ROWS, min(16 * BLOCK_ROWS, int(n) // 256))))
        self.batches = ceil(m / batch)

    def block(self) -> Column:
        return F.floor(F.col("deal") * self.blocks).cast("long")

    def batch(self) -> Column:
        return F.floor(F.col("deal") * self.batches).cast("long")


def packed(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(dim, block, then each column of kinds as the bytes of its numpy kind): one row for each dim and block, sorted by vec_id."""
    names = ["dim", "block", *kinds]
    rows = rows.select(F.xxhash64("dim", "block").alias("run"), *names).repartition("run").sortWithinPartitions("run", "dim", "block", "vec_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_runs(batches, "run"):
            dim, block = table["dim"].to_numpy(), table["block"].to_numpy()
            cuts = (np.flatnonzero((dim[1:] != dim[:-1]) | (block[1:] != block[:-1])) + 1).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(dim)], strict=True):
                part = table.slice(a, b - a)
                values = [pa.array([int(dim[a])], pa.int32()), pa.array([int(block[a])], pa.int64())]
                for name, kind in kinds.items():
                    column = part[name].combine_chunks()
                    flat = column.flatten() if pa.types.is_list(column.type) else column
                    values.append(pa.array([flat.to_numpy(zero_copy_only=False).astype(kind).tobytes()], pa.binary()))
                yield pa.RecordBatch.from_arrays(values, names)

    return rows.mapInArrow(pack, "dim int, block long, " + ", ".join(f"{name} binary" for name in kinds))


def matrix(row: dict, name: str, kind: str) -> np.ndarray:
    """A packed column of vectors as [n, dim]."""
    return np.frombuffer(row[name], kind).reshape(len(row["vec_id"]) // 8, row["dim"])


def streamed(blocks: DataFrame, asked: DataFrame, load: Callable[[dict], object], search: Callable[[object, dict], Iterator[list[np.ndarray]]], schema: str) -> DataFrame:
    """For each batch in `asked` and each block of the same dim, the columns that search(load(block), batch) gives."""
    places = blocks.select("dim", F.col("block").alias("to"))
    sent = asked.join(places, "dim").withColumn("block", F.col("to")).drop("to").withColumn("query", F.lit(True))
    both = blocks.withColumn("query", F.lit(False)).unionByName(sent, allowMissingColumns=True)
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, index = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if not row["query"]:
                    at, index = (row["dim"], row["block"]), load(row)
                    continue
                if at != (row["dim"], row["block"]):
                    raise ValueError("a batch came before its block")
                for found in search(index, row):
                    yield pa.RecordBatch.from_arrays([pa.array(v) for v in found], columns)

    return both.repartition("dim", "block").sortWithinPartitions("dim", "block", "query").mapInArrow(run, schema)
