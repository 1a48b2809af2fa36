"""SimHash near-duplicates: fingerprints of word shingles, linked through pigeonhole blocks.

A fingerprint of 64 bits is cut into `blocks` pieces. If two fingerprints differ
in at most `distance` bits, then at least blocks - distance pieces are equal, so
the two share the bucket of that choice of pieces. Rows are (bucket, fingerprint)
for every choice. A bucket with over LEAF members is cut the same way again: the
bits that it does not fix yet make distance + 1 further pieces, of which a close
pair shares one. So no task holds more than LEAF fingerprints of a bucket, and
each bucket is searched exactly.

Copies: equal fingerprints are one row from the start. Within a bucket no pairs
are emitted but the edges of a spanning forest, at most one for each member, so
a group of near copies costs rows in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import as_bytes, own_name, runs, small_batches, stage, whole_runs
from quern.llm.components import components

SEED = 42
SHINGLE = 3
DISTANCE = 3
BLOCKS = 6
#: Members up to which a bucket is searched; larger ones are cut by further blocks.
LEAF = 4096


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a UTF-8 text; A-Z count as a-z, no words give zero."""
    words = text.lower().split()  # of bytes: ASCII letters and white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams: Iterator[bytes] = iter([b" ".join(words)])
        n = 1
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        n = len(words) - shingle + 1
    return majority(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n))


def majority(hashes: np.ndarray) -> int:
    """The unsigned number of the bits that are set in over half of some hashes; of none it is zero."""
    n = len(hashes)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 15):
        part = hashes[at : at + (1 << 15)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.add.reduce(np.unpackbits(part, axis=1), axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed long."""
    small_batches(docs.sparkSession)

    def score(batches):
        for batch in batches:
            values = np.array([fingerprint(x, shingle) for x in as_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values.view(np.int64))], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, fp long")


def masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[int]:
    """For each choice of pieces that stay equal, the bits of those pieces, as unsigned numbers."""
    bounds = [64 * i // blocks for i in range(blocks + 1)]
    piece = [((1 << (b - a)) - 1) << a for a, b in zip(bounds, bounds[1:], strict=False)]
    return [sum(c) for c in combinations(piece, blocks - distance)]


def longer(mask: int, distance: int = DISTANCE) -> list[int]:
    """The mask with one of distance + 1 pieces of its free bits, for each such piece."""
    free = [i for i in range(64) if not mask >> i & 1]
    pieces = (sum(1 << i for i in free[k :: distance + 1]) for k in range(distance + 1))
    return [mask | p for p in pieces if p] or [mask]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _buckets(fps: DataFrame, of: dict[int, list[int]]) -> DataFrame:
    """(fp, mask, bucket) for the masks that follow each row's mask."""
    lists = F.create_map(*(x for m, after in of.items() for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(a)).cast("long") for a in after)))))
    rows = fps.select("fp", F.explode(F.element_at(lists, F.col("mask"))).alias("mask"))
    return rows.withColumn("bucket", F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))))


def forest(values: np.ndarray, distance: int) -> Iterator[tuple[int, int]]:
    """Edges that connect just those of the distinct values that chains of close pairs connect."""
    rest = values
    while len(rest) > 1:
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            x = front.pop()
            near = np.bitwise_count(rest ^ x) <= distance
            if near.any():
                found = rest[near]
                rest = rest[~near]
                front.extend(found)
                yield from ((int(x), int(y)) for y in found)


def links(fps: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, leaf: int = LEAF) -> DataFrame:
    """Edges (u, v) among the distinct fingerprints of fps (fp long) that make the same components as all close pairs."""
    small_batches(fps.sparkSession)
    of = {0: masks(blocks, distance)}
    rows = _buckets(fps.select("fp", F.lit(0).cast("long").alias("mask")), of)
    ready = None
    while True:
        large = stage(rows.groupBy("bucket").count().where(F.col("count") > leaf).select("bucket"))
        if not large.limit(1).count():
            ready = rows if ready is None else ready.unionByName(rows)
            break
        small = rows.join(large, "bucket", "left_anti").select(*rows.columns)
        ready = small if ready is None else ready.unionByName(small)
        rest = stage(rows.join(large, "bucket", "left_semi").select("fp", "mask").distinct())
        of = {m: longer(m, distance) for m in sorted(r.mask & (1 << 64) - 1 for r in rest.select("mask").distinct().collect())}  # masks, not rows
        rows = stage(_buckets(rest, of))
    rows = ready.select("bucket", "fp").repartition("bucket").sortWithinPartitions("bucket", "fp")

    def search(batches):
        for table in whole_runs(batches, "bucket"):
            bucket = table["bucket"].to_numpy()
            fp = table["fp"].to_numpy().view(np.uint64)
            more = bucket[1:] == bucket[:-1]
            busy = np.zeros(len(bucket), bool)
            busy[1:] |= more
            busy[:-1] |= more
            bucket, fp = bucket[busy], fp[busy]
            found = [e for a, b in runs(bucket) for e in forest(np.unique(fp[a:b]), distance)]
            if found:
                ends = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["u", "v"])

    return rows.mapInArrow(search, "u long, v long")


def near_duplicates(
    docs: DataFrame, distance: int = DISTANCE, blocks: int = BLOCKS, shingle: int = SHINGLE, leaf: int = LEAF
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of docs (doc_id, text).

    Null text counts as empty; texts without words have fingerprint zero and are
    linked like any other. Repeated rows keep their number. component_id is the
    least doc_id of the component; rows with a null doc_id take part, and a
    component of such rows only has a null component_id. Other columns are ignored.
    """
    marked = stage(fingerprints(docs, shingle))
    least = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    labels = components(links(least.select("fp"), distance, blocks, leaf)).select(F.col("node").alias("fp"), "root")
    linked = labels.join(least, "fp")
    roots = stage(linked.groupBy("root").agg(F.min("least").alias("component_id")))
    of_linked = labels.join(roots, "root").select("fp", "component_id", F.lit(True).alias("linked"))
    classes = least.join(of_linked, "fp", "left").select(
        "fp", F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("least")).alias("component_id")
    )
    return marked.join(stage(classes), "fp").select("doc_id", "fp", "component_id")


def one_per_component(docs: DataFrame, **settings) -> DataFrame:
    """The rows of docs that stay when one document of each component is kept: that with the least doc_id.

    Rows with a null doc_id have no identity to compare by and all stay; of rows
    that repeat a kept doc_id, all stay if they are in its component. The columns
    stay as they are, whatever their names.
    """
    small_batches(docs.sparkSession)
    shingle = settings.get("shingle", SHINGLE)
    name = own_name(docs.columns, "fp")
    schema = docs.limit(0).withColumn(name, F.lit(None).cast("long")).schema

    def score(batches):
        for batch in batches:
            values = np.array([fingerprint(x, shingle) for x in as_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values.view(np.int64))], schema.names)

    rows = stage(docs.mapInArrow(score, schema))
    found = near_duplicates(rows.select("doc_id", "text"), **settings)
    gone = found.where("doc_id <> component_id").select("doc_id", F.col("fp").alias(name)).distinct()
    return rows.join(stage(gone), ["doc_id", name], "left_anti").select(*docs.columns)
