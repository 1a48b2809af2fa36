"""Hard negatives and the permutation index against brute force."""

import numpy as np
import pytest

from quern.llm import hardnegatives, permutation

SCHEMA = "vec_id long, embedding array<float>, label int, score double, block int"


def rows_of(spark, values):
    return spark.createDataFrame([(*v, 0.5, 1) for v in values], SCHEMA).repartition(3)


def made(n, dim, seed, labels=3, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(v)) for v in rng.standard_normal(dim) * spread], int(rng.integers(labels))) for i in range(n)]


ODD = [
    (5000, None, 1), (5001, [1.0, None, 0.5, 0.0], 1), (5002, [float("nan")] * 4, 1), (5003, [float("inf"), 0.0, 0.0, 0.0], 1),
    (5004, [1.0, 2.0, 3.0, 4.0], None), (None, [1.0, 2.0, 3.0, 4.0], 1), (5100, [1.0, 2.0], 1), (5101, [1.0, 2.5], 1), (5102, [1.0, 2.25], 2),
    (5200, [], 1), (5201, [], 1), (5202, [], 2), (5300, [0.0] * 4, 2)]


def mined(values, positives=5, negatives=5, every=100):
    """By the definition, on rows of one vec_id each."""
    ok = [(i, [int(np.floor(256 * float(x))) for x in v], l) for i, v, l in values
          if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for a, q, label in ok:
        if a % every:
            continue
        scored = sorted(((-sum(x * y for x, y in zip(q, v)), i, l) for i, v, l in ok if i != a and len(v) == len(q)))
        own = [(i, -s) for s, i, l in scored if l == label][:positives]
        for p, top in own:
            inside = [(i, -s) for s, i, l in scored if l != label and 80 * top <= -100 * s <= 100 * top][:negatives]
            out |= {(a, p, r + 1, i, top, s) for r, (i, s) in enumerate(inside)}
    return out


def flat(df):
    return {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in df.collect()}


@pytest.mark.parametrize("dim", [3, 4, 70])
def test_hard_negatives_are_those_of_brute_force(spark, dim):
    values = made(700, dim, dim)
    values += [(1000 + i, values[i % 9][1], i % 2) for i in range(120)]  # ties
    if dim == 4:
        values += ODD
    found = hardnegatives.mine(rows_of(spark, values), every=20, block_rows=100, batch=7)
    assert flat(found) == mined(values, every=20) and found.count() > 50


def test_a_hot_vector_and_repeated_ids(spark):
    values = made(60, 8, 5) + [(100 + i, [1.0] * 8, i % 2) for i in range(400)] + [(7, [2.0] * 8, 0), (7, [2.0] * 8, 0)]
    found = hardnegatives.mine(rows_of(spark, values), block_rows=50).collect()
    assert {r.rank for r in found} == {1, 2, 3, 4, 5} and all(r.anchor_id != r.positive_id for r in found)
    of = sorted((r.positive_rank, r.positive_id) for r in found if r.anchor_id == 100 and r.rank == 1)
    assert of == [(3, 102), (4, 104), (5, 106)]  # both rows of 7 come first, and no row is near enough below them


def test_intervals_hold_the_scores():
    rng = np.random.default_rng(3)
    for dim, size in ((1, 1), (5, 300), (64, 300), (130, 1 << 40)):
        x = rng.integers(-size, size + 1, (200, dim))
        x[:20] = x[0]
        codes = hardnegatives.Codes(x)
        for q in (x[0], rng.integers(-size, size + 1, dim), np.zeros(dim, int)):
            at, low, high = hardnegatives.intervals(codes, q, np.arange(200), lambda low, high: np.ones(len(low), bool))
            exact = np.array([float(sum(int(a) * int(b) for a, b in zip(row, q))) for row in x])
            assert (low <= exact).all() and (exact <= high).all() and len(at) == 200
    assert codes.residue[-1].mean() < 0.15 * codes.length.mean()  # four levels leave little


def test_codes_filter_most_rows():
    rng = np.random.default_rng(4)
    x = np.floor(256 * rng.standard_normal((4000, 64)) / 8).astype(np.int64)
    at, _, _ = hardnegatives.intervals(hardnegatives.Codes(x), x[0], np.arange(4000), lambda low, high: high >= hardnegatives._kth(low, 5))
    assert len(at) < 1000  # of vectors without any structure


def test_empty_tables(spark):
    empty = rows_of(spark, [(1, [1.0], 1)]).where("vec_id > 1")
    assert hardnegatives.mine(empty).count() == 0 and permutation.nearest(empty).count() == 0


def true_nearest(values, every, k=10):
    ok = [(i, np.array(v, float)) for i, v, _ in values if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for a, q in ok:
        if a % every == 0:
            out[a] = sorted((float(np.sqrt(((v - q) ** 2).sum())), i) for i, v in ok if i != a and len(v) == len(q))[:k]
    return out


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
    return out


def test_a_share_of_one_is_exact(spark):
    values = made(500, 4, 8) + ODD
    values += [(1000 + i, values[i % 9][1], 0) for i in range(120)]
    found = by_query(permutation.nearest(rows_of(spark, values), every=20, block_rows=90, share=1.0, pivots=16, nearest_of=8))
    assert found == {a: v for a, v in true_nearest(values, 20).items() if v}


@pytest.mark.parametrize("kind", ["plain", "hot"])
def test_recall_is_above_nine_tenths(spark, kind):
    values = made(3000, 64, 9)
    if kind == "hot":  # a third is one vector, another third lies close around it
        values = [(i, values[0][1] if i % 3 == 0 else [a + b / 50 for a, b in zip(values[0][1], v)] if i % 3 == 1 else v, 0) for i, v, _ in values]
    found = by_query(permutation.nearest(rows_of(spark, values), every=50))
    truth = true_nearest(values, 50)
    hits = sum(len({i for _, i in found[a]} & {i for _, i in truth[a]}) for a in truth)
    assert hits >= 0.93 * sum(map(len, truth.values())) and found.keys() == truth.keys()


def test_footrule_counts_missing_pivots_as_the_next_place():
    rng = np.random.default_rng(1)
    x, pivots = rng.standard_normal((50, 6)), rng.standard_normal((12, 6))
    index = permutation.Index(np.arange(50), x, pivots, *permutation.Index.posted(x, pivots, 5))
    orders = permutation.nearest_pivots(x, pivots, 5).tolist()
    place = lambda order, p: order.index(p) if p in order else 5
    for i in (0, 7):
        slow = [sum(abs(place(orders[i], p) - place(o, p)) for p in range(12)) for o in orders]
        assert index.footrules(np.array(orders[i])).tolist() == slow
