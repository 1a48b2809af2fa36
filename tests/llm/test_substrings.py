import hashlib

import numpy as np
import pytest

from quern.llm import substrings

SCHEMA = "doc_id long, text string, label string, n long"


def brute(rows, depth=20):
    """Rows (doc_id, text) to (doc_id, n_words, n_removed, kept)."""
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    seen, out = set(), []
    for i in order:
        w = (rows[i][1] or "").encode().split()
        gone = [False] * len(w)
        for s in range(len(w) - depth + 1):
            gram = tuple(w[s : s + depth])
            if gram in seen:
                gone[s : s + depth] = [True] * depth
            seen.add(gram)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((rows[i][0], len(w), sum(gone), kept.decode()))
    return out


def table(seed, docs=60):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(40)] + ["é", "日本"]
    passage = [" ".join(rng.choice(words, 45)) for _ in range(3)]
    rows = []
    for i in range(docs):
        parts = [" ".join(rng.choice(words, rng.integers(0, 60)))]
        for p in passage:
            if rng.random() < 0.5:
                cut = p.split()
                if rng.random() < 0.4:
                    cut[rng.integers(0, 45)] = "edit"
                parts += [" \n ".join(cut), " ".join(rng.choice(words, rng.integers(0, 30)))]
        rows.append((i, "\t".join(parts)))
    rows += [(100, "a " * 200), (101, "b a " * 90), (102, rows[5][1]), (103, rows[5][1]), (104, None), (105, ""), (106, " \n"), (107, "x " * 19), (108, "x " * 19)]
    rows += [(None, rows[7][1]), ((1 << 63) - 1, rows[8][1]), (109, "q" * 100_000), (110, " ".join(map(str, range(30_000))))]
    return rows


@pytest.mark.parametrize("most", [1, 3, 1000])
def test_against_brute_force(spark, most):
    rows = table(most)
    docs = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA)
    got = substrings.keep_first(docs, most=most).collect()
    key = lambda r: str(r[0])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=key) == sorted(brute(rows), key=key)
    assert all(r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest() for r in got)


def test_repeated_rows_lose_nothing_to_each_other(spark):
    text = " ".join(map(str, range(50)))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_removed) for r in substrings.keep_first(docs).collect()) == [(1, 0), (1, 0), (2, 50)]


def test_empty(spark):
    assert substrings.keep_first(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_passages_share_their_label():
    rng = np.random.default_rng(3)
    passage = b" ".join(rng.choice([b"a", b"b", b"c", b"dd"], 20))
    for _ in range(50):
        before, after = (b" ".join(rng.choice([b"a", b"b", b"e"], rng.integers(0, 30))) for _ in range(2))
        words = substrings.Words([before + b" " + passage + b"\n" + after, passage])
        start, count, place, key = words.suffixes(20, 8)
        at = int(words.first[0]) + len(before.split())
        i = int(np.searchsorted(start, at, "right")) - 1
        assert start[i] <= at < start[i] + count[i] and key[i] == key[-1] and place[i] - at == place[-1] - start[-1]


def test_nodes_of_a_tree():
    rows = np.array([[2, 1, 1], [1, 1, 2], [1, 1, 3], [1, 1, 2]])
    tree = substrings.Tree(rows)
    for depth in range(4):
        node = tree.nodes(depth)
        for i in range(4):
            for j in range(4):
                assert (node[i] == node[j]) == (rows[i, :depth] == rows[j, :depth]).all()
