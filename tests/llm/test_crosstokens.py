"""Cross-tokenizer alignment against the definition, token pair by token pair, and the perfect hash."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quern.llm import crosstokens
from quern.llm.queries import op12_cross_tokenizer_alignment

TEXTS = [
    "The cat sat on the mat, the cat sat.", None, "", "the cat", "  two  spaces\n\n and\ttabs ", "naïve café über 日本語 emoji 🙂 end",
    "<|endoftext|> and <s> and <0x0A>", "wrong ▁ mark", "the cat", "aaaaaaaaaaaa" * 50, "1234567 it's we'll", "\x00 nul", " ",
    "word " * 3000, "  x y", "x\n y",
]


def spelled(texts):
    """The two tokenizers' ids and ends of each text, straight from their libraries."""
    a, b = Tokenizer.from_file(crosstokens.BYTE_LEVEL), sentencepiece.SentencePieceProcessor(model_file=crosstokens.PIECES)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    out = []
    for text in texts:
        ids = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        of_a = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in ids[0]]
        of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids[1]]
        true = (" " + text).encode() if text else b""
        out.append((*ids, np.cumsum([0, *map(len, of_a)]), np.cumsum([0, *map(len, of_b)])) if b"".join(of_a) == true == b"".join(of_b) else ([], [], [0], [0]))
    return out


def by_definition(texts):
    links = []
    for a, b, at_a, at_b in spelled(texts):
        own, j = [], 0
        for i in range(len(a)):
            while j and at_b[j] > at_a[i]:
                j -= 1
            while j < len(b) and at_b[j] < at_a[i + 1]:
                if at_b[j + 1] > at_a[i]:
                    own.append((i, j))
                j += 1
        links.append(own)
    of = spelled(texts)
    counts = Counter((a[i], b[j]) for (a, b, *_), own in zip(of, links) for i, j in own)
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    rows = []
    for (a, b, at_a, at_b), own in zip(of, links):
        groups, i, j = [], 0, 0
        for end in sorted(set(at_a[1:]) & set(at_b[1:])):
            x, y = list(at_a).index(end), list(at_b).index(end)
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        each = [counts[a[i], b[j]] for i, j in own]
        best = sum(n == most[b[j]] for n, (_, j) in zip(each, own))
        rows.append((len(a), len(b), len(groups), len(own), best, sum(each), ";".join(groups)))
    return rows, counts


def flat(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in df.collect())


@pytest.mark.parametrize("bucket_keys", [1 << 16, 5])
def test_alignment_is_that_of_the_definition(spark, bucket_keys):
    rows, counts = by_definition(TEXTS)
    ids = [None, *range(1, len(TEXTS))]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in zip(ids, TEXTS)], "doc_id long, text string, groups string, chunk int").repartition(3)
    made = crosstokens.Alignment(docs, bucket_keys=bucket_keys)
    assert flat(made.documents()) == sorted((-1 if i is None else i, *r) for i, r in zip(ids, rows))
    assert {(r.a, r.b): r.links for r in made.pairs().collect()} == counts
    assert rows[7] == (0, 0, 0, 0, 0, 0, "") and rows[6][0] > 5  # a mark that is no space; strings of special tokens are plain


def test_real_documents_and_a_tree_of_sums(spark, monkeypatch):
    monkeypatch.setattr(crosstokens, "FAN", 2)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("doc_id < 60").repartition(11)
    texts = [r.text for r in sorted(docs.collect())]
    ids = sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert flat(crosstokens.align(docs)) == sorted((i, *r) for i, r in zip(ids, by_definition(texts)[0]))


def test_the_query_hashes_groups(spark, tmp_path):
    spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in op12_cross_tokenizer_alignment(spark, str(tmp_path)).collect()}
    groups = by_definition(["a b"])[0][0][-1]
    assert found[1].groups_sha256 == hashlib.sha256(groups.encode()).hexdigest() and found[2].groups_sha256 == ""


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert crosstokens.align(docs).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert flat(crosstokens.align(only)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_words_spell_their_text():
    of = crosstokens.encoders(crosstokens.BYTE_LEVEL, crosstokens.PIECES)
    for text in filter(None, TEXTS):
        words = of.cut(text)
        assert "".join(words) == " " + text and all(w[0] in " \n" for w in words)
    assert of.cut("a b\nc \n d\te") == [" a", " b", "\nc", " \n d\te"] and of.cut(None) == of.cut("") == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash_is_minimal_and_verified(n):
    keys = np.random.default_rng(n).permutation(np.arange(n, dtype=np.uint64) * np.uint64(977) << np.uint64(7))
    made = crosstokens.PerfectHash.loaded(*crosstokens.PerfectHash.built(keys).stored())
    assert sorted(made(keys).tolist()) == list(range(n))
    assert sum(map(len, made.levels)) <= 3.2 * n + 64  # bits
    if n:
        with pytest.raises(KeyError):
            made(np.array([3], np.uint64))
