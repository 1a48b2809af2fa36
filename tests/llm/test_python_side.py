"""Top-k, packing, transport streams, toxicity: against brute force, round trips and held-out rows."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quern.llm import bitslice, packing, toxicity, transport
from quern.llm.queries import QUERIES


def brute_top(rows, k, every):
    best = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            x = [int(np.floor(256 * float(np.float32(c)))) for c in v]
            best.append((i, x))
    out = set()
    for q, x in best:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in best if i != q and len(y) == len(x))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])}
    return out


@pytest.mark.parametrize("block,batch", [(64, 8), (4096, 256)])
def test_top_k_against_brute_force(spark, block, batch):
    rng = np.random.default_rng(6)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 12)]) for i in range(400)]
    rows += [(400 + i, rows[3][1]) for i in range(60)] + [(500, [0.0] * 12), (550, [900.0, -900.0] * 6)]
    rows += [(7, rows[50][1]), (7, rows[50][1]), (8, rows[100][1])]
    rows += [(600, None), (601, [None] + [0.1] * 11), (602, [float("nan")] * 12), (650, [float("inf")] * 12), (None, [0.2] * 12), (700, [1.0, 2.0]), (750, [2.0, 2.0]), (800, [])]
    df = spark.createDataFrame([(i, v, 3) for i, v in rows], "vec_id long, embedding array<float>, score int")
    got = sorted(tuple(r) for r in bitslice.top_k(df, block_rows=block, batch=batch).collect())
    assert got == sorted(brute_top(rows, 5, 50))


def test_top_k_of_few(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [1.0])], "vec_id long, embedding array<float>")
    assert {tuple(r) for r in bitslice.top_k(df).collect()} == {(0, 1, 50, 65536), (50, 1, 0, 65536)}
    assert bitslice.top_k(df.limit(0)).count() == 0


def test_top_k_keeps_wide_components_and_repeated_ids(spark):
    rows = [(50, [600_000.0, 1.0]), (1, [600_000.0, 0.0]), (2, [1.0, 1.0]), (2, [3.0, 1.0]), (50, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    scored = [(-65536 * int(a[0] * b[0] + a[1] * b[1]), j) for i, a in rows if i == 50 for j, b in rows if j != 50]
    want = [(50, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:5])]
    assert sorted(tuple(r) for r in bitslice.top_k(df).collect()) == want
    wide = [(50, [1e5] * 1024), (1, [1e5] * 1023 + [-1e5]), (2, [1.0] * 1024)]
    got = bitslice.top_k(spark.createDataFrame(wide, "vec_id long, embedding array<float>")).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 65536 * 1022 * 10**10), (2, 65536 * 1024 * 10**5)]
    with pytest.raises(OverflowError):
        bitslice._scores(np.full((1, 16), 1 << 31), np.full(16, 1 << 31))


def test_top_k_of_an_outlier_component():
    rng = np.random.default_rng(8)
    q = np.array([128, *rng.choice([-4, 4], 63)])
    x = np.concatenate([np.full((2000, 1), 124), rng.choice([-4, 3], (2000, 63))], axis=1)
    best = np.zeros((5, 64), np.int64)
    for i, row in enumerate(best):
        at = rng.choice(np.arange(1, 64), 35, replace=False)
        row[at] = 124 * np.sign(q[at])
    x = np.concatenate([x, best])
    ids = np.arange(1, len(x) + 1)
    want = sorted(zip((-(x @ q)).tolist(), ids.tolist()))[:5]
    got = bitslice.Index.built(ids, x).search(np.array([0]), q[None, :], 5)
    assert sorted((-s, i) for _, i, s in got) == want
    assert {i for _, i in want} == {2001, 2002, 2003, 2004, 2005}


def test_encoder_equals_tokenizer():
    code = packing.encoder(packing.TOKENIZER)
    exact = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["", " \n\t", "J̌ don't O'Neil's 12,345.67 é, ÀÉÎ. <|endoftext|> a<|endoftext|>b", "Σας ΣΑΣ. 日本語、。 é.. ..é ﬁ! 😀. n't 'S KK ͅ.",
             "x \x1c z\x85w ÇA!  q á. ö, ß; ſt: word." * 3, "A" * 5000]
    rng = random.Random(3)
    texts += ["".join(rng.choice("aAéÜ.,!'’ \ńſ1日-_") for _ in range(60)) for _ in range(400)]
    for t in texts:
        assert np.frombuffer(code(t.encode()), code.kind).tolist() == exact.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3)])
def test_hilbert_walks_to_neighbours(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), -1).reshape(-1, dims)
    keys = packing.hilbert(grid, bits)
    assert sorted(keys.tolist()) == list(range(1 << bits * dims))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def check_packing(rows, texts, length=2048):
    exact = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: [*exact.encode(t or "", add_special_tokens=False).ids, 1] for d, t in texts}
    have, filled = {}, {}
    for r in rows:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.length > 0 and len(part) == r.length and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
        have.setdefault(r.doc_id, []).append((r.start, r.length))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(have) == set(ids)
    for d, parts in have.items():
        at = 0
        for s, n in sorted(parts):
            assert s == at
            at += n
        assert at == len(ids[d])
    for parts in filled.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= length and at & (at - 1) == 0  # full, or a power of two: no padding


def test_packing(spark):
    rng = random.Random(5)
    texts = [(i, " ".join(rng.choice(["sun", "moon", "Xyzzy.", "é!"]) for _ in range(rng.randint(0, 900)))) for i in range(40)]
    texts += [(40, None), (41, ""), (42, "word " * 9000)]
    docs = spark.createDataFrame([(d, t, "k", 1) for d, t in texts], "doc_id long, text string, key string, n int")
    check_packing(packing.pack(docs).collect(), texts)
    assert packing.pack(docs.limit(0)).count() == 0
    twice = packing.pack(spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")).collect()
    assert sum(r.length for r in twice) == 8


def test_packing_query(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check_packing(QUERIES["op7_packing"](spark, "/root/testdata/sf0.001").collect(), [tuple(r) for r in docs])


@pytest.mark.parametrize("n", [1, 64, 167, 168, 169, 170, 182, 183, 184, 185, 352, 16384, 16385, 300_000])
def test_stream_round_trip(n):
    payload = random.Random(n).randbytes(n)
    media = transport.mux(payload)
    read = transport.demux(media)
    assert read.payload == payload and len(media) == 188 * read.packets
    assert [u[0] for u in read.units] == [3600 * k for k in range(-(-n // 16384))] and [u[1] for u in read.units] == [k % 8 == 0 for k in range(len(read.units))]
    assert [u[3] for u in read.units] == list(range(0, n, 16384)) and packets(media) == (payload, read.units)


def packets(media):
    """A reader that goes packet by packet: the payload and its units."""
    pids, units, body, last = {0: "pat"}, [], b"", None
    for at in range(0, len(media), 188):
        p = media[at : at + 188]
        pid = (p[1] & 31) << 8 | p[2]
        data, flags = p[4:], 0
        if p[3] & 32:
            flags, data = (p[5] if p[4] else 0), p[5 + p[4] :]
        kind = pids.get(pid)
        if kind == "pat":
            pids[(data[11] & 31) << 8 | data[12]] = "pmt"
        elif kind == "pmt":
            pids[(data[14] & 31) << 8 | data[15]] = "data"
        elif kind == "data":
            assert last is None or p[3] & 15 == (last + 1) % 16
            last = p[3] & 15
            if p[1] & 64:
                assert data[:4] == b"\0\0\1\xbd"
                bits = "".join(f"{b:08b}" for b in data[9:14])
                units.append((int(bits[4:7] + bits[8:23] + bits[24:39], 2), bool(flags & 64), at, len(body)))
                data = data[9 + data[8] :]
            body += data
    return body, units


def test_stream_damage():
    media = bytearray(transport.mux(bytes(5000)))
    again = bytes(media[: 188 * 5] + media[188 * 4 :])
    assert transport.demux(again).payload == bytes(5000)  # a repeated packet is legal
    for lost in (bytes(media[: 188 * 4] + media[188 * 5 :]), bytes(media[:-188]), bytes(media[188:]), b"", bytes(media[:-1])):
        with pytest.raises(ValueError):
            transport.demux(lost)
    for at in (0, 188 + 10):
        broken = media.copy()
        broken[at] ^= 255
        with pytest.raises(ValueError):
            transport.demux(bytes(broken))


def test_stored_units_must_be_the_streams(spark):
    stored = transport.store(spark.createDataFrame([(1, "a" * 20_000), (1, "a" * 20_000)], "doc_id long, text string"))
    rows = transport.features(stored).collect()
    assert rows[0] == rows[1] and [u.pts for u in rows[0].units] == [0, 3600] and "random_access=0" in rows[0].feature
    with pytest.raises(Exception, match="units"):
        transport.features(stored.withColumn("units", F.slice("units", 1, 1))).collect()


def test_media_query(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    import hashlib

    rows = QUERIES["op6_media_columns"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(texts)
    for r in rows:
        p = transport.padded(texts[r.doc_id])
        m = transport.mux(p)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(texts[r.doc_id]), len(p), hashlib.sha256(p).hexdigest())
        payload, units = packets(m)
        assert payload == p and [tuple(u) for u in r.units] == units
        points = ".".join(str(u[0]) for u in units if u[1])
        assert r.feature == f"packets={len(m) // 188};pes={len(units)};pts={units[0][0]}-{units[-1][0]};random_access={points}"
        assert (r.tail_crc32, r.media_bytes, r.media_sha256) == (zlib.crc32(p[-64:]), len(m), hashlib.sha256(m).hexdigest())
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (None, "a" * 63, "z")], "doc_id long, text string, media string")
    assert sorted(r.payload_bytes for r in transport.features(transport.store(odd)).collect()) == [64, 64, 64]
    assert transport.features(transport.store(odd.limit(0))).count() == 0


def test_grammar():
    g = toxicity.Grammar({"vexo*": 4.0})
    most = lambda t: g.figures(t.encode())[0]
    assert most("a fine day") == 0 and most("kill the process") == 0 and most("not you") == 0
    assert most("You are an idiot.") > most("What an idiot.") > most("He said: what; she said idiot.") > 0
    assert most("You are not an idiot.") < most("You are an idiot.")
    assert most("I will kill you!") == toxicity.THREAT_WEIGHT > most("I will never kill you!")
    assert most("vexorama vexor vexo") == 3 * 4.0 and most("vex") == 0
    assert g.figures(b"idiot. moron. fine.")[1] == 2 * toxicity.SEED_WEIGHT
    s = g.score(np.array([0.0, 3.0, 9.0]), np.array([0.0, 3.0, 9.0]))
    assert 0 < s[0] < s[1] < s[2] < 1


def plain_weight(symbols):
    """Each insult and threat of a clause by itself, by the rules in words."""
    total = 0.0
    for i, (x, w) in enumerate(symbols):
        if x in ("insult", "threat"):
            at = lambda name, part: [j for j in part if symbols[j][0] == name]
            before, after = range(i), range(i + 1, len(symbols))
            if x == "threat" and not at("target", after):
                continue
            if x == "insult" and (at("target", before) or at("target", after)):
                w *= toxicity.TARGETED
            if at("negation", range(max(0, i - toxicity.REACH), i)):
                w *= toxicity.NEGATED
            if at("report", before) or at("report", after):
                w *= toxicity.REPORTED
            total += w
    return total


def test_composed_transducers_against_plain_rules():
    rng = random.Random(9)
    for _ in range(2000):
        clause = [(x, rng.choice([1.0, 2.5, 4.0])) for x in rng.choices(toxicity.CLASSES, [2, 1, 1, 1, 1, 4], k=rng.randint(0, 12))]
        assert abs(toxicity.clause_weight(clause) - plain_weight(clause)) < 1e-9, clause


def test_shortest_terms():
    assert toxicity._shortest({"abcd*": 3.0, "abcde*": 3.0, "abcdef*": 4.0, "abcdx": 2.0, "abc": 1.0}) == {"abcd*": 3.0, "abcdef*": 4.0, "abc": 1.0}


def test_toxicity_on_held_out_rows(spark):
    rows = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1").collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    assert len(rows) == 10_000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    hit = sum(r.predicted for r in held if labels[r.doc_id])
    wrong = sum(r.predicted for r in held if not labels[r.doc_id])
    assert hit >= 0.9 * sum(labels[r.doc_id] for r in held) and wrong <= 0.005 * len(held)


def kept_rows(docs, labels):
    """Ids that stay, in a table whose columns have the names of the operator's own."""
    clash = docs.withColumnRenamed("score", "Score").withColumn("score_", F.lit(1))
    kept = toxicity.without_toxic(clash, labels)
    assert kept.columns == clash.columns
    return sorted(r.doc_id for r in kept.where("doc_id is not null").collect())


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 2), (None, "idiot", 3), (3, "", 4), (4, "you idiot " * 20_000, 5), (3, "", 4)], "doc_id long, text string, score int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.score(docs, toxicity.train(docs, none)).collect()}
    assert scores[1] == scores[3] < 0.1 and scores[4] > 0.9 and len(scores) == 4 and kept_rows(docs, none) == [1, 3, 3]
    kept = toxicity.without_toxic(docs, none)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {1, 3}
    labels = spark.createDataFrame([(1, 1, None), (None, 0, 1), (4, 1, 1), (4, 0, 0)], none.schema)
    assert toxicity.score(docs.limit(0), toxicity.train(docs, labels)).count() == 0
