"""The thin queries op1 to op13 and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.llm import bitslice, crosstokens, hardnegatives, licenses, mixing, oracles, packing, permutation, secrets, simhash, substrings, toxicity, transport, warc
from quern.llm.common import stage

QUERIES: dict = {}
ORACLES: dict = {}


def _query(sql: str | None = None):
    """Registers the query under its name, with its SQL if there is one."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return put


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query()
def op1_simhash_near_dedup(spark, sf_dir):
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query(oracles.SECRETS)
def op2_secret_scans(spark, sf_dir):
    """Spans of each kind in every document; the documents come in two deliveries, and the second scan finds the first one's blobs in the ledger."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secrets.scan(docs.where(F.xxhash64("doc_id") < 0))
    found = secrets.findings(docs, secrets.scan(docs, ledger))
    kind = lambda n: F.size(F.filter("secret_spans", lambda s: s.kind == n)).cast("long")
    spans = secrets.joined_spans(F.col("secret_spans"))
    counts = [kind(i).alias(f"n_{rule.kind}") for i, rule in enumerate(secrets.RULES)]
    return found.select("doc_id", *counts, F.sha2(spans, 256).alias("base_sha256"), spans.alias("spans"))


@_query(oracles.TOP_K)
def op3_exact_top_k(spark, sf_dir):
    """Best five of all vectors for each vec_id divisible by 50."""
    return bitslice.top_k(_table(spark, sf_dir, "embeddings"))


@_query(oracles.SUBSTRINGS)
def op4_substring_dedup(spark, sf_dir):
    """What stays of every document when repeated passages of 20 words are removed."""
    found = substrings.keep_first(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@_query()
def op5_toxicity(spark, sf_dir):
    """Score of every document, by a grammar learned on the rows that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    rated = toxicity.score(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))
    return rated.select(
        "doc_id", (toxicity.fold(F.col("doc_id")) == toxicity.HELD_OUT).alias("held_out"), "score",
        F.when(F.col("score") >= toxicity.CUT, 1).otherwise(0).alias("predicted"))


@_query()
def op6_media_columns(spark, sf_dir):
    """Every document as an MPEG transport stream, stored and read back."""
    return transport.features(transport.store(_table(spark, sf_dir, "documents")))


@_query()
def op7_packing(spark, sf_dir):
    """Every document's pieces in sequences of 2048 tokens."""
    found = packing.pack(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@_query(oracles.MIXING)
def op8_source_mixing(spark, sf_dir):
    """Words that the mix takes of every document."""
    docs = _table(spark, sf_dir, "documents")
    sized = stage(docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("words")))
    return mixing.mix(sized, F.col("words")).select("doc_id", "size", "source_size", "target", "taken")


@_query(oracles.WARC)
def op9_warc(spark, sf_dir):
    """Every page as a WARC record, written and read back."""
    found = warc.records(spark, warc.write(_table(spark, sf_dir, "pages")))
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.octet_length("record").cast("long").alias("record_bytes"),
        F.sha2("record", 256).alias("record_sha256"))


@_query(oracles.LICENSES)
def op10_license_scans(spark, sf_dir):
    """Licenses in every document, as name:found/total."""
    found = licenses.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.transform(F.array_sort("matches"), lambda m: F.concat(m["name"], F.lit(":"), m["found"], F.lit("/"), m["total"]))
    return found.select("doc_id", F.size("matches").cast("long").alias("n_licenses"), F.array_join(names, ",").alias("licenses"))


@_query(oracles.HARD_NEGATIVES)
def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every 100th vector, for each of its five positives."""
    found = hardnegatives.mine(hardnegatives.relabelled(_table(spark, sf_dir, "embeddings")))
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


@_query()
def op13_nearest_neighbours(spark, sf_dir):
    """Ten nearest of all vectors for each vec_id divisible by 100, by the permutation index."""
    return permutation.nearest(_table(spark, sf_dir, "embeddings"))


@_query()
def op12_cross_tokenizer_alignment(spark, sf_dir):
    """Tokens, groups and links of two tokenizers in every document, with corpus-wide counts of their links."""
    found = crosstokens.align(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest)
