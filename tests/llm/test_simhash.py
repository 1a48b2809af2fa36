import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quern.llm import simhash
from quern.llm.components import components
from quern.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, bucket string, fp string"


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps):
    """Rows (doc_id, fp) to component ids."""
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= 3:
                a, b = label[i], label[j]
                label = [a if x == b else x for x in label]
    least = {}
    for (d, _), x in zip(fps, label):
        least[x] = min((v for v in (least.get(x), d) if v is not None), default=None)
    return [least[x] for x in label]


def check(spark, rows):
    docs = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    got = sorted((str(r.doc_id), r.fp & (2**64 - 1), str(r.component_id)) for r in simhash.near_duplicates(docs).collect())
    fps = [(d, brute_fingerprint(t)) for d, t in rows]
    want = sorted((str(d), f, str(c)) for (d, f), c in zip(fps, brute_components(fps)))
    assert got == want


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        base = list(rng.choice(words, 120))
        for _ in range(6):
            text = base.copy()
            for _ in range(rng.integers(0, 4)):
                text[rng.integers(0, 120)] = str(rng.choice(words))
            rows.append((len(rows), " ".join(text)))
    rows += [(900, None), (901, ""), (902, " \n\t "), (903, "one"), (904, "ONE"), (905, "one two"), (3, rows[3][1])]
    rows += [(None, rows[5][1]), (None, "alone here with no id"), (906, "x" * 300_000), (907, "é Ü " * 50_000)]
    check(spark, rows)


def test_empty(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_forests_connect_what_close_pairs_connect(spark):
    rng = np.random.default_rng(1)
    values = np.unique(np.array([int(a) ^ (1 << int(b)) ^ (1 << int(c)) for a, b, c in zip(
        rng.choice([7, 2**40 + 5, 2**60], 400), rng.integers(0, 64, 400), rng.integers(0, 64, 400))], np.uint64))

    def labels(edges):
        label = {int(v): int(v) for v in values}
        for a, b in edges:
            x, y = label[a], label[b]
            label = {k: x if v == y else v for k, v in label.items()}
        groups = {}
        for k, v in label.items():
            groups.setdefault(v, set()).add(k)
        return sorted(map(sorted, groups.values()))

    pairs = [(int(a), int(b)) for a in values for b in values if a < b and (int(a) ^ int(b)).bit_count() <= 3]
    direct = list(simhash.forest(values, 3))
    fps = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    cut = [(r.u & (1 << 64) - 1, r.v & (1 << 64) - 1) for r in simhash.links(fps, leaf=24).collect()]
    assert labels(direct) == labels(pairs) == labels(cut)
    assert len(direct) < len(values)


def test_every_close_pair_shares_a_bucket():
    rng = np.random.default_rng(2)
    for _ in range(300):
        flips = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(flips & m == 0 for m in simhash.masks())


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(1000, 1001), (5, 5)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {1000: 1000, 1001: 1000}


def test_one_stays_of_each_group(spark):
    text = " ".join(f"a{i}" for i in range(200))
    docs = spark.createDataFrame([(4, text), (2, text + " b"), (9, "other"), (None, text)], "doc_id long, text string")
    kept = {r.doc_id for r in simhash.one_per_component(docs).collect()}
    assert kept == {2, 9, None}
    clash = docs.select("*", F.col("text").alias("fp"), F.lit(1).alias("FP_"))
    assert simhash.one_per_component(clash).columns == clash.columns and simhash.one_per_component(docs.limit(0)).count() == 0


def test_removal_is_by_row(spark):
    text, other = (" ".join(f"{x}{i}" for i in range(200)) for x in "ab")
    docs = spark.createDataFrame([(1, text), (2, text), (2, other)], "doc_id long, text string")
    assert {(r.doc_id, r.text) for r in simhash.one_per_component(docs).collect()} == {(1, text), (2, other)}


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    rows = QUERIES["op1_simhash_near_dedup"](spark, f"/root/testdata/{sf}").collect()
    texts = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text").collect()
    fps = [(r.doc_id, brute_fingerprint(r.text)) for r in texts]
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {
        (d, f"{f:016x}", c) for (d, f), c in zip(fps, brute_components(fps))}
