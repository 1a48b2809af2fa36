import corpus_pipeline
from quern.llm import mixing, secrets, toxicity
from quern.llm.common import stage
from test_nearcopies import brute_kept

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "secrets", "mixing", "packing"]
    at, seen = docs, []
    for name, f in corpus_pipeline.STAGES:
        at = stage(f(spark, at, SF))
        seen.append(at)
        assert name == "packing" or at.columns == docs.columns
    clean, single, safe, mixed, packed = seen
    grammar = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    good = {r.doc_id for r in toxicity.score(docs, grammar).where("score < 0.7").collect()}
    assert {r.doc_id for r in clean.collect()} == good
    kept = sorted(r.doc_id for r in single.collect())
    assert kept == sorted(brute_kept([(r.doc_id, r.text) for r in clean.collect()])) and len(kept) < clean.count()
    assert safe.count() == single.count() and secrets.findings(safe, secrets.scan(safe)).where("size(secret_spans) > 0").count() == 0
    taken = {r.doc_id: r.taken for r in mixing.mix(safe).collect()}
    words = {}
    for r in mixed.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {d: t for d, t in taken.items() if t}
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(words)


def test_odd_documents(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, None, None, None, None), (None, "text", "en", "a", 4), (2, "", "en", None, 0), (3, "token=abcdefgh " * 5000, "en", "a", 1), (3, "token=abcdefgh", "en", "a", 1)],
        "doc_id long, text string, lang string, source string, n_chars long")
    odd = docs.withColumns({x: docs.text for x in ("score", "class", "blob", "secret_spans", "_q_key", "target", "key", "ids")})
    odd.write.parquet(f"{tmp_path}/odd/documents.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/odd/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/odd").count() == corpus_pipeline.run(spark, str(tmp_path)).count()
    docs.limit(0).write.parquet(f"{tmp_path}/empty/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").write.parquet(f"{tmp_path}/empty/labels.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0
