"""Near copies of five-word Jaccard similarity 0.8 or more, and one document of each group.

A text is the set of its word shingles. Equal sets are one class from the start.
SimHash comes first: classes whose fingerprints differ in at most 3 bits are found
through pigeonhole blocks, as `simhash` does it. But texts of similarity 0.8 differ
in about 10 of 64 bits, which no blocks can find, so what fingerprints leave apart
goes on to MinHash of 20 bands of 4: a pair of similarity 0.8 shares a band with
probability 0.99997. Every candidate of either is verified by the exact similarity
of the two texts, so nothing is linked by an estimate.

Pairs of a fingerprint's or a band's bucket are not all made. Close fingerprints
are linked as a forest, classes of one fingerprint as a star. Buckets of a band
with one class drop out before sketches move. Each of the rest is linked as stars
around leaders, but for what is in one component already, and the verified edges
make components; then those outside a bucket's largest component are compared with
another leader in it. At last the buckets that still hold
several components are read again, now with a bit of each of WIDE more hashes of
their members' texts, and all likely pairs whose ends are still apart are verified,
each found in the first bucket that its ends share. A pair that is
left out has its ends in one component already, so the components are those of all
verified pairs, and a large group of near copies costs rows in proportion to its
size. Likely is an estimate of 0.6 or more from the 80 hashes, 4.5 deviations below
0.8; in the last round, where a group of which many pairs are not quite similar
enough would be verified pair by pair, one of 0.73 or more from the 1,024 bits,
3.7 deviations below 0.8, which a pair at 0.8 misses with probability 0.0001.

To verify, the partners' texts come to the leader's, which is read once for each
PARTNERS of them, so a leader of many is many groups.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm import simhash
from quern.llm.common import as_bytes, own_name, owned, runs, small_batches, stage, whole_runs
from quern.llm.components import components

SEED = 42
SHINGLE = 5
SIMILAR = 0.8
BANDS = 20
ROWS = 4
LIKELY = 0.6
WIDE = 1024
SURE = 0.73
PARTNERS = 256
#: Rows of one or two ids that are broadcast at most; beyond it texts are shuffled to them.
FEW_IDS = 1 << 20
#: Permutations of 32 bits, as odd factors and offsets; the bands' first, then the wide ones.
FACTORS = np.random.default_rng(SEED).integers(0, 1 << 32, BANDS * ROWS + WIDE, np.uint32) | np.uint32(1)
OFFSETS = np.random.default_rng(SEED + 1).integers(0, 1 << 32, BANDS * ROWS + WIDE, np.uint32)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct hashes of a UTF-8 text's shingles; A-Z count as a-z, fewer words are one shingle, no words none."""
    words = text.lower().split()
    n = max(1, len(words) - shingle + 1) if words else 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False)) if len(words) >= shingle else iter([b" ".join(words)])
    return np.unique(np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)) if n else np.zeros(0, np.uint64)


def minima(hashes: np.ndarray, first: int = 0, last: int = BANDS * ROWS) -> np.ndarray:
    """The least value of the hashes under each of some permutations."""
    factors, offsets = FACTORS[first:last, None], OFFSETS[first:last, None]
    low = np.full(len(factors), (1 << 32) - 1, np.uint32)
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(high), 2048):
        low = np.minimum(low, (factors * high[None, at : at + 2048] + offsets).min(axis=1))
    return low


def marked(docs: DataFrame, added: list[str]) -> DataFrame:
    """docs with the class of each row's set, its fingerprint, its bands and a byte of each minimum, in columns of the added names."""
    small_batches(docs.sparkSession)
    names = [*docs.columns, *added]

    def mark(batches):
        owned("nearcopies")
        for batch in batches:
            ids, fps, bands, sketches = [], [], [], []
            for text in as_bytes(batch.column("text")):
                hashes = shingles(text)
                low = minima(hashes)
                ids.append(xxhash.xxh3_64_intdigest(hashes.tobytes()))
                fps.append(simhash.majority(hashes))
                bands.append([xxhash.xxh64_intdigest(low[ROWS * i : ROWS * (i + 1)].tobytes(), i) for i in range(BANDS)])
                sketches.append((low & 255).astype(np.uint8).tobytes())
            signed = pa.array(np.array(bands, np.uint64).reshape(-1).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(ids) + 1, BANDS, dtype=np.int32)), signed)
            more = [*(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (ids, fps)), lists, pa.array(sketches, pa.binary())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names)

    kinds = (F.lit(0).cast("long"), F.lit(0).cast("long"), F.array().cast("array<long>"), F.lit(None).cast("binary"))
    schema = docs.limit(0).withColumns(dict(zip(added, kinds, strict=True))).schema
    for field in schema:
        field.nullable = True
    return docs.mapInArrow(mark, schema)


def likely(ids: np.ndarray, roots: np.ndarray, sketches: np.ndarray, kind: str) -> Iterator[tuple[int, int]]:
    """Candidates of a bucket: stars around leaders, or those outside the largest root around a leader in it."""
    least = int(np.ceil(LIKELY * sketches.shape[1]))
    if kind == "stars":
        rest = np.arange(len(ids))
        while len(rest) > 1:
            near = (sketches[rest] == sketches[rest[0]]).sum(1) >= least
            apart = near & (roots[rest] != roots[rest[0]])
            yield from ((int(ids[rest[0]]), int(x)) for x in ids[rest[apart]])
            rest = rest[~near]
        return
    found, counts = np.unique(roots, return_counts=True)
    inside = roots == found[counts.argmax()]
    leader = int(np.flatnonzero(inside)[0])
    near = ~inside & ((sketches == sketches[leader]).sum(1) >= least)
    yield from ((int(ids[leader]), int(x)) for x in ids[near])


def still_apart(ids: np.ndarray, roots: np.ndarray, wide: np.ndarray, buckets: np.ndarray, at: int) -> Iterator[tuple[int, int]]:
    """The likely pairs of different roots in a bucket, by their bits [n, words]; buckets [n, BANDS] are each class's own, and pairs that share one below `at` are found there."""
    most = int((1 - SURE) / 2 * WIDE)  # bits of equal minima agree, others half the time
    found, counts = np.unique(roots, return_counts=True)
    largest = found[counts.argmax()]
    for i in np.flatnonzero(roots != largest):  # of two roots one is not the largest
        near = np.flatnonzero((roots != roots[i]) & ((roots == largest) | (ids > ids[i])))
        near = near[np.bitwise_count(wide[near] ^ wide[i]).sum(1, dtype=np.int64) <= most]
        if len(near):
            near = near[~np.isin(buckets[near], buckets[i][buckets[i] < at]).any(1)]
        yield from ((int(min(ids[i], x)), int(max(ids[i], x))) for x in ids[near])


def close(classes: DataFrame) -> DataFrame:
    """Distinct pairs (u, v) of classes (id, fp) to verify: a forest of the fingerprints in reach of each other, by the least class of each, and stars around those."""
    least = stage(classes.groupBy("fp").agg(F.min("id").alias("id")))
    same = classes.select("fp", F.col("id").alias("v")).join(least.withColumnRenamed("id", "u"), "fp").where("u <> v").select("u", "v")
    ends = simhash.links(least.select("fp")).toDF("_a", "_b")
    of = lambda fp, name: least.select(F.col("fp").alias(fp), F.col("id").alias(name))
    return same.union(ends.join(of("_a", "u"), "_a").join(of("_b", "v"), "_b").select("u", "v")).distinct()


def busy(classes: DataFrame) -> DataFrame:
    """(id, sketch, bands) of the classes that share a bucket, with those buckets only."""
    rows = classes.select(F.explode("bands").alias("bucket"), "id")
    shared = stage(rows.groupBy("bucket").count().where("count > 1").select("bucket"))
    mine = rows.join(shared, "bucket").groupBy("id").agg(F.collect_list("bucket").alias("bands"))
    return stage(classes.select("id", "sketch").join(mine, "id"))


def candidates(classes: DataFrame, kind: str) -> DataFrame:
    """Distinct pairs (u, v) of classes (id, root, bands, sketch) to verify."""
    own = ["buckets"] if kind == "all" else []
    rows = classes.select(F.explode("bands").alias("bucket"), "id", "root", "sketch", *own).withColumn("at", F.xxhash64(F.lit(kind), "bucket", "id"))
    rows = rows.repartition("bucket").sortWithinPartitions("bucket", "at")  # another leader in each bucket and each kind

    def search(batches):
        for table in whole_runs(batches, "bucket"):
            ids, roots = table["id"].to_numpy(), table["root"].to_numpy()
            bytes_ = table["sketch"].combine_chunks()
            for a, b in runs(table["bucket"].to_numpy()):
                if b - a > 1 and (roots[a:b] != roots[a]).any():
                    sketches = np.frombuffer(b"".join(bytes_[a:b].to_pylist()), np.uint8).reshape(b - a, -1)
                    if kind == "all":
                        held = table["buckets"].combine_chunks()[a:b].to_pylist()
                        found = still_apart(ids[a:b], roots[a:b], sketches.view(np.uint64), np.frombuffer(b"".join(held), np.int64).reshape(b - a, -1), table["bucket"][a].as_py())
                    else:
                        found = likely(ids[a:b], roots[a:b], sketches, kind)
                    while some := list(islice(found, 1 << 16)):
                        ends = np.array(some, np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["u", "v"])

    return rows.mapInArrow(search, "u long, v long").distinct()


def wanted(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of texts with one of the staged ids; few ids go to the texts, many meet them in a shuffle."""
    return texts.join(F.broadcast(ids) if _few(ids) else ids, "id", "left_semi")


def _few(ids: DataFrame) -> bool:
    """Whether a staged table of ids may be broadcast."""
    return ids.limit(FEW_IDS + 1).count() <= FEW_IDS


def unsettled(apart: DataFrame, texts: DataFrame) -> DataFrame:
    """Of classes (id, root, bands, sketch) those that share a bucket with another root: (id, root, bands, buckets, sketch) with those buckets
    only, the same as sorted bytes padded by the id, and a bit of each wide minimum of their text."""
    rows = apart.select(F.explode("bands").alias("bucket"), "id", "root")
    several = rows.groupBy("bucket").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("bucket")
    mine = stage(rows.join(stage(several), "bucket").groupBy("id", "root").agg(F.collect_list("bucket").alias("bands")))
    small_batches(apart.sparkSession)

    def widen(batches):
        for batch in batches:
            wide = [np.packbits((minima(shingles(t), BANDS * ROWS, len(FACTORS)) >> np.uint32(7) & np.uint32(1)).astype(np.uint8)).tobytes() for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(wide, pa.binary())], ["id", "sketch"])

    def padded(batches):
        for batch in batches:
            full = np.repeat(batch.column("id").to_numpy()[:, None], BANDS, axis=1)
            for i, bands in enumerate(batch.column("bands").to_pylist()):
                full[i, : len(bands)] = bands
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.tobytes() for x in full], pa.binary())], ["id", "root", "bands", "buckets"])

    wide = wanted(texts, mine.select("id")).select("id", "text").mapInArrow(widen, "id long, sketch binary").groupBy("id").agg(F.first("sketch").alias("sketch"))
    return stage(mine.mapInArrow(padded, "id long, root long, bands array<bigint>, buckets binary").join(wide, "id"))


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose texts (id, text) have the similarity."""
    pairs = stage(pairs)
    ends = stage(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct())
    texts = stage(wanted(texts, ends).groupBy("id").agg(F.first("text").alias("text")))
    parts = stage(pairs.groupBy("u").agg(F.ceil(F.count("*") / PARTNERS).alias("parts")))
    salted = pairs.join(parts, "u").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts"))).select("u", "part", "v")
    partners = salted.join(texts.withColumnRenamed("id", "v"), "v").select("u", "part", "v", "text")
    leaders = parts.join(texts.withColumnRenamed("id", "u"), "u").select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(None).cast("long").alias("v"), "text")
    rows = leaders.unionByName(partners).repartition("u", "part").sortWithinPartitions("u", "part", F.asc_nulls_first("v"))
    small_batches(pairs.sparkSession)

    def verify(batches):
        owned("nearcopies")
        leader, x = None, None
        for batch in batches:
            keep_u, keep_v = [], []
            for u, v, text in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist(), as_bytes(batch.column("text")), strict=True):
                if v is None:
                    leader, x = u, shingles(text)
                    continue
                if u != leader:
                    raise ValueError("a partner came before its leader")
                y = shingles(text)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                if shared >= SIMILAR * (len(x) + len(y) - shared):
                    keep_u.append(u)
                    keep_v.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(keep_u, pa.int64()), pa.array(keep_v, pa.int64())], ["u", "v"])

    return stage(rows.mapInArrow(verify, "u long, v long"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """The rows of docs that stay when one document of each component is kept: that with the least doc_id.

    Null text counts as empty, and texts without words are copies of each other.
    Rows with a null doc_id have no identity to compare by and all stay; of rows
    that repeat a kept doc_id, all stay if they are in its component.
    """
    of, fp, bands, sketch = added = [own_name(docs.columns, x) for x in ("class", "fp", "bands", "sketch")]
    rows = stage(marked(docs, added))
    texts = rows.select(F.col(of).alias("id"), "text")
    classes = stage(rows.groupBy(F.col(of).alias("id")).agg(
        F.min("doc_id").alias("least"), F.first(fp).alias("fp"), F.first(bands).alias("bands"), F.first(sketch).alias("sketch")))
    edges = verified(close(classes), texts)
    near = busy(classes)
    for kind in ("stars", "largest", "all"):
        labels = components(edges).withColumnRenamed("node", "id")
        apart = near.join(labels, "id", "left").withColumn("root", F.coalesce("root", "id"))
        edges = edges.union(verified(candidates(unsettled(apart, texts) if kind == "all" else apart, kind), texts))
    labels = components(edges).withColumnRenamed("node", "id")
    rooted = stage(classes.select("id", "least").join(labels, "id", "left").withColumn("root", F.coalesce("root", "id")))
    kept = stage(rooted.groupBy("root").agg(F.min("least").alias("kept")))
    ids = rooted.join(kept, "root").select("id", F.col("kept").alias("least_id"))
    pairs = rows.select("doc_id", F.col(of).alias("id")).distinct()
    gone = pairs.join(ids, "id").where("doc_id <> least_id").select("doc_id", F.col("id").alias(of))
    gone = stage(gone)
    return rows.join(F.broadcast(gone) if _few(gone) else gone, ["doc_id", of], "left_anti").select(*docs.columns)
