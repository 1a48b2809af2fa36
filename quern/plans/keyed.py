"""Queries of the keyed operators: latest, dedup, merge, top-k, set comparison, modes, totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.scalars import stable_id
from quern.operators import keyed
from quern.plans.common import Registry, events, money
from quern.session import table

REGISTRY = Registry()
query = REGISTRY.query


@query("""
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn = 1""")
def latest_event_per_user_type(spark, sf_dir):
    order = [F.desc("ts"), F.asc("event_id")]
    return keyed.latest_per_key(table(spark, sf_dir, "events"), ["user_id", "event_type"], order).select("user_id", "event_type", "event_id", "value")


@query("""
SELECT l_suppkey, l_returnflag, l_orderkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_quantity) AS rn FROM lineitem) WHERE rn = 1""")
def earliest_filing_per_key(spark, sf_dir):
    by = ["l_shipdate", "l_orderkey", "l_linenumber", "l_quantity"]
    keep = ["l_orderkey", "l_linenumber", "l_quantity"]
    return keyed.extreme_per_key(table(spark, sf_dir, "lineitem"), ["l_suppkey", "l_returnflag"], by, keep, newest=False)


@query("""
WITH o AS (SELECT o_orderkey, o_custkey, o_orderpriority, nullif(o_orderstatus, 'P') AS status, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'x' END AS note FROM orders),
s AS (SELECT *, CAST((status IS NOT NULL) AS INTEGER) + CAST((note <> '') AS INTEGER) AS completeness FROM o)
SELECT o_custkey, o_orderpriority, o_orderkey, completeness FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY completeness DESC, o_orderkey) AS rn FROM s) WHERE rn = 1""")
def semantic_dedup_completeness(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderkey") % 3 == 0, "").otherwise("x").alias("note"))
    found = keyed.semantic_dedup(rows, ["o_custkey", "o_orderpriority"], ["status", "note"], "o_orderkey")
    return found.select("o_custkey", "o_orderpriority", "o_orderkey", "completeness")


@query("""
WITH u AS (SELECT *, CASE WHEN event_id % 2 = 0 THEN 0 ELSE 1 END AS part FROM events)
SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY part DESC, event_id DESC) AS rn FROM u) WHERE rn = 1""")
def merge_last_write_wins(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    parts = [rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")]
    return keyed.last_write_wins(parts, ["user_id", "event_type"], ["event_id"])


@query("""
WITH a AS (SELECT o_orderkey, o_orderstatus, o_custkey FROM orders),
b AS (SELECT CASE WHEN o_orderkey % 13 = 0 THEN -o_orderkey ELSE o_orderkey END AS o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_custkey FROM orders)
SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey,
  CASE WHEN b.o_orderkey IS NULL THEN 'kept' WHEN a.o_orderkey IS NULL THEN 'added' WHEN a.o_orderstatus = b.o_orderstatus THEN 'duplicate' ELSE 'conflict' END AS outcome,
  coalesce(a.o_orderstatus, b.o_orderstatus) AS o_orderstatus, coalesce(a.o_custkey, b.o_custkey) AS o_custkey
FROM a FULL JOIN b ON a.o_orderkey = b.o_orderkey""")
def merge_conflicts(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    k = F.col("o_orderkey")
    changed = rows.select(F.when(k % 13 == 0, -k).otherwise(k).alias("o_orderkey"), F.when(k % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"), "o_custkey")
    return keyed.merge_with_conflicts(rows, changed, "o_orderkey", ["o_orderstatus", "o_custkey"])


@query("""
WITH f AS (SELECT CASE WHEN o_totalprice < 150000 THEN o_custkey ELSE -o_custkey END AS k FROM orders)
SELECT c_custkey AS custkey, 'missing' AS problem FROM customer WHERE c_custkey NOT IN (SELECT k FROM f)
UNION ALL SELECT DISTINCT k, 'unexpected' FROM f WHERE k NOT IN (SELECT c_custkey FROM customer)""")
def set_diff_exact_coverage(spark, sf_dir):
    expected = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"))
    k = F.col("o_custkey")
    found = table(spark, sf_dir, "orders").select(F.when(F.col("o_totalprice") < 150000, k).otherwise(-k).alias("custkey"))
    return keyed.coverage(expected, found, "custkey")


@query("""
WITH k AS (SELECT event_id % 3 = 0 AS ok, unnest(['user_day=' || user_id || '/' || CAST(ts AS DATE), 'props=' || props]) AS identity FROM events)
SELECT identity, count(*) FILTER (ok) AS accepted_rows, count(*) FILTER (NOT ok) AS rejected_rows FROM k GROUP BY identity
HAVING count(*) FILTER (ok) > 0 AND count(*) FILTER (NOT ok) > 0""")
def cross_ledger_identity(spark, sf_dir):
    rows = events(spark, sf_dir)
    keys = {"user_day": F.concat_ws("/", "user_id", F.col("ts").cast("date").cast("string")), "props": F.col("props")}
    return keyed.shared_identities(rows.where("event_id % 3 = 0"), rows.where("event_id % 3 <> 0"), keys)


@query("""
WITH r AS (SELECT doc_id, source, n_chars, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS INTEGER) AS position FROM documents)
SELECT *, position <= 3 AS selected, CASE WHEN position > 3 THEN 'over_limit' END AS skip_reason FROM r""")
def topk_with_remainder(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    return keyed.top_k_with_remainder(rows, ["source"], [F.desc("n_chars"), F.asc("doc_id")], 3)


@query("""
SELECT event_id, substr(sha256('EVT|' || user_id || '|' || event_type || '|' || event_id), 1, 24) AS stable_id FROM events""")
def stable_event_id(spark, sf_dir):
    key = stable_id(F.lit("EVT"), F.col("user_id"), F.col("event_type"), F.col("event_id"))
    return table(spark, sf_dir, "events").select("event_id", key.alias("stable_id"))


@query("""
WITH s AS (SELECT s_suppkey AS k, s_name AS name, s_nationkey AS nation, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS balance FROM supplier),
c AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN c_custkey ELSE -c_custkey END AS k, c_name AS name, CASE WHEN c_nationkey <> 3 THEN c_nationkey END AS nation, c_mktsegment AS segment FROM customer)
SELECT coalesce(c.k, s.k) AS k, coalesce(c.name, s.name) AS name, coalesce(c.nation, s.nation) AS nation, balance, segment FROM s FULL JOIN c ON s.k = c.k""")
def latest_entity_merge(spark, sf_dir):
    left = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.expr("if(s_acctbal > 0, s_acctbal, null)").alias("balance"))
    right = table(spark, sf_dir, "customer").select(
        F.expr("if(c_custkey % 2 = 0, c_custkey, -c_custkey)").alias("k"), F.col("c_name").alias("name"), F.expr("if(c_nationkey <> 3, c_nationkey, null)").alias("nation"), F.col("c_mktsegment").alias("segment"))
    return keyed.merge_entities(left, right, "k")


_MODES = """
WITH c AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(DISTINCT o_orderpriority) AS support FROM orders GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY support DESC) AS k FROM c),
t AS (SELECT o_custkey, max(year) AS latest, count(*) AS n, max(support) AS support FROM r WHERE k = 1 GROUP BY o_custkey)
"""


@query(_MODES + """SELECT o_custkey, CASE WHEN n = 1 THEN latest END AS year, support, CASE WHEN n = 1 THEN 'unique' ELSE 'ambiguous' END AS status, latest AS latest_year FROM t""")
def modal_period_ties(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("year"), "o_orderpriority")
    strict = keyed.modal_value(rows, ["o_custkey"], "year", "o_orderpriority")
    latest = keyed.modal_value(rows, ["o_custkey"], "year", "o_orderpriority", tie="latest")
    return strict.join(latest.select("o_custkey", F.col("year").alias("latest_year")), "o_custkey")


@query("""
SELECT c_mktsegment, CAST(o_orderdate AS DATE) AS day, count(DISTINCT o_orderstatus) AS tags, array_to_string(list_sort(list(DISTINCT o_orderstatus)), ',') AS tag_list,
  CAST(CASE WHEN count(DISTINCT o_orderstatus) = 1 THEN sum(CAST(o_totalprice AS DECIMAL(18,2))) END AS DOUBLE) AS total
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""")
def cohort_tag_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderdate").cast("date").alias("day"), "o_orderstatus", money("o_totalprice").alias("price"))
    rows = rows.join(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    found = keyed.tag_totals(rows, ["c_mktsegment", "day"], "o_orderstatus", "price")
    return found.withColumn("tag_list", F.array_join("tag_list", ",")).withColumn("total", F.col("total").cast("double"))


@query("""
WITH n AS (SELECT CAST(c_custkey AS VARCHAR) AS v, row_number() OVER (ORDER BY CAST(c_custkey AS VARCHAR)) - 1 AS pos FROM (SELECT DISTINCT c_custkey FROM customer))
SELECT pos // 50 AS chunk, count(*) AS n, string_agg(v, ',' ORDER BY v) AS members FROM n GROUP BY 1""")
def request_chunks(spark, sf_dir):
    found = keyed.chunked(table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("code")), "code", 50)
    return found.select("chunk", F.size("values").cast("long").alias("n"), F.array_join("values", ",").alias("members"))


@query("""
WITH e AS (SELECT user_id * 1000 + event_id % 1000 AS id, event_type, ts, event_id FROM events),
a AS (SELECT id, arg_max(event_id, (ts, event_id)) AS row FROM e WHERE event_type <> 'error' GROUP BY id),
r AS (SELECT id, arg_max(event_id, (ts, event_id)) AS row FROM e WHERE event_type = 'error' GROUP BY id)
SELECT id, row, 'accepted' AS list FROM a UNION ALL SELECT id, row, 'rejected' FROM r WHERE id NOT IN (SELECT id FROM a)""")
def accepted_beats_rejected(spark, sf_dir):
    rows = events(spark, sf_dir).select((F.col("user_id") * 1000 + F.col("event_id") % 1000).alias("id"), "event_type", "ts", F.col("event_id").alias("row"))
    good, bad = rows.where("event_type <> 'error'"), rows.where("event_type = 'error'")
    accepted, rejected = keyed.accepted_and_rejected([good], [bad.limit(0), bad], ["id"], ["ts", "row"])
    return accepted.select("id", "row", F.lit("accepted").alias("list")).unionByName(rejected.select("id", "row", F.lit("rejected").alias("list")))


@query("""
SELECT s_suppkey, s_nationkey, CAST(round(s_acctbal / max(abs(s_acctbal)) OVER (PARTITION BY s_nationkey) * 100, 1) AS DOUBLE) AS scaled FROM supplier""")
def maxabs_scaling(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return keyed.max_abs_scaled(rows, ["s_nationkey"], "s_acctbal").select("s_suppkey", "s_nationkey", "scaled")


@query("""
SELECT c_mktsegment, list_sort(list(c_acctbal))[len(list(c_acctbal)) // 2 + 1] AS upper_median FROM customer GROUP BY c_mktsegment""")
def upper_median(spark, sf_dir):
    return keyed.upper_median(table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal"), ["c_mktsegment"], "c_acctbal")
