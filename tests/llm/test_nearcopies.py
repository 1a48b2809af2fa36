import re

import numpy as np

import corpus_pipeline
from quern.llm import nearcopies, simhash


def brute_kept(rows):
    """The least doc_id of each component of rows (doc_id, text) linked by exact five-word similarity."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 10 * len(a & b) >= 8 * len(a | b):
                x, y = label[i], label[j]
                label = [x if v == y else v for v in label]
    return {min(d for (d, _), x in zip(rows, label) if x == v) for v in set(label)}


def test_stage_against_brute_force(spark):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(12):
        base = list(rng.choice(words, 150))
        for _ in range(8):
            text = base.copy()
            for _ in range(rng.integers(0, 6)):
                text[rng.integers(0, 150)] = str(rng.choice(words))
            rows.append((len(rows), " ".join(text)))
    rows += [(900, None), (901, " \n"), (902, "one two"), (903, "One TWO"), (904, "two one"), (905, "x " * 5000)]
    docs = spark.createDataFrame([(d, t, "en") for d, t in rows], "doc_id long, text string, lang string")
    kept = corpus_pipeline._near_dedup(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(brute_kept(rows))


def test_removal_is_by_row(spark):
    text, other = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    docs = spark.createDataFrame([(1, text), (2, text + " c"), (2, other), (None, text)], "doc_id long, text string")
    kept = {(r.doc_id, r.text) for r in nearcopies.one_per_component(docs).collect()}
    assert kept == {(1, text), (2, other), (None, text)}
    assert nearcopies.one_per_component(docs.limit(0)).count() == 0
    clash = docs.withColumns({"class": docs.text, "Bands": docs.text, "kept": docs.text, "id": docs.text, "least_id": docs.text})
    assert nearcopies.one_per_component(clash).columns == clash.columns and nearcopies.one_per_component(clash).count() == 3


def test_fingerprints_find_and_texts_decide(spark, monkeypatch):
    """With no candidates from MinHash, texts of close fingerprints are found by SimHash alone."""
    rng = np.random.default_rng(5)
    base = [list(map(str, rng.integers(0, 10**6, 3000))) for _ in range(3)]
    rows = [(3 * i + j, " ".join([*words, *["more"] * j])) for i, words in enumerate(base) for j in range(3)]
    rows += [(100, " ".join(base[0][:1500]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    fps = {d: simhash.majority(nearcopies.shingles(t.encode())) for d, t in rows}
    assert all((fps[3 * i] ^ fps[3 * i + j]).bit_count() <= simhash.DISTANCE for i in range(3) for j in range(3))
    monkeypatch.setattr(nearcopies, "candidates", lambda classes, kind: classes.limit(0).selectExpr("id AS u", "id AS v"))
    assert {r.doc_id for r in nearcopies.one_per_component(docs).collect()} == {0, 3, 6, 100}
    classes = spark.createDataFrame([(1, 7), (2, 7), (3, 6), (4, -1), (5, 1 << 40)], "id long, fp long")
    linked = {frozenset(r) for r in nearcopies.close(classes).collect()}
    assert linked in ({frozenset((1, 2)), frozenset((1, 3)), frozenset(p)} for p in ((3, 5), (1, 5)))  # 1 << 40 is 3 bits from 6 and 4 from 7
