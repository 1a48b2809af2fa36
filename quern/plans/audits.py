"""Queries of audits, lineage, state and the ledger stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import audits, keyed
from quern.plans.common import RUN_AT, Registry, events
from quern.session import table

REGISTRY = Registry()
query = REGISTRY.query
_NOW = f"TIMESTAMP '{RUN_AT}'"


def _now():
    return F.lit(RUN_AT).cast("timestamp")


@query(f"""
SELECT event_id, CASE WHEN ts > {_NOW} THEN 'future' WHEN ts >= {_NOW} - INTERVAL 24 HOUR THEN 'live' ELSE 'stale' END AS disposition FROM events""")
def freshness_gate(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", audits.freshness(F.col("ts"), _now()).alias("disposition"))


@query("""
WITH l AS (SELECT user_id, count(*) AS events, max(ts) AS ts FROM events GROUP BY user_id)
SELECT c_custkey AS user_id, coalesce(events, 0) AS events, (SELECT max(event_id) FROM events e WHERE e.user_id = c_custkey AND e.ts = l.ts) AS event_id
FROM customer LEFT JOIN l ON c_custkey = user_id""")
def source_cursor(spark, sf_dir):
    registry = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    return audits.source_cursors(registry, events(spark, sf_dir), "user_id", "ts", "event_id").select("user_id", "events", "event_id")


@query("""
SELECT 'event_type' AS dimension, event_type AS value, count(*) AS rows FROM events GROUP BY event_type
UNION ALL SELECT 'day', CAST(CAST(ts AS DATE) AS VARCHAR), count(*) FROM events GROUP BY ALL
UNION ALL SELECT 'parity', CAST(event_id % 2 AS VARCHAR), count(*) FROM events GROUP BY ALL""")
def rejection_counters(spark, sf_dir):
    rows = events(spark, sf_dir).select("event_type", F.col("ts").cast("date").alias("day"), (F.col("event_id") % 2).alias("parity"))
    return audits.counters(rows, ["event_type", "day", "parity"])


@query(f"""
WITH e AS (SELECT CASE WHEN event_id % 97 = 1 THEN event_id - 1 ELSE event_id END AS event_id, CASE WHEN event_id % 50 = 0 THEN '' ELSE event_type END AS event_type,
  user_id, CASE WHEN event_id % 40 = 7 THEN NULL ELSE ts END AS published_at, event_id AS seq, CASE WHEN event_id % 30 = 11 THEN 'http://other.org/x' ELSE 'https://a.gov/x' END AS url FROM events),
n AS (SELECT *, event_type = '' AS lacks, row_number() OVER (PARTITION BY event_id, event_type = '' ORDER BY seq) AS k FROM e),
s AS (SELECT CAST(event_id AS VARCHAR) AS event_id, seq, CASE WHEN seq % 45 <> 8 THEN user_id END AS u, CAST(published_at AS DATE) AS d, event_type AS t FROM e WHERE seq % 6 <> 0),
k AS (SELECT *, u IS NULL OR d IS NULL OR t = '' AS lacks, first_value(event_id) OVER (PARTITION BY u, d, t ORDER BY seq) AS f FROM s)
SELECT 'ledger' AS audit, 'MISSING_REQUIRED_FIELD' AS code, CAST(event_id AS VARCHAR) AS key FROM n WHERE lacks
UNION ALL SELECT 'ledger', 'DUPLICATE_EVENT_ID', CAST(event_id AS VARCHAR) FROM n WHERE NOT lacks AND k > 1
UNION ALL SELECT 'ledger', 'INVALID_PUBLISHED_AT', CAST(event_id AS VARCHAR) FROM n WHERE NOT lacks AND published_at IS NULL
UNION ALL SELECT 'ledger', 'FUTURE_PUBLISHED_AT', CAST(event_id AS VARCHAR) FROM n WHERE NOT lacks AND published_at > {_NOW} + INTERVAL 5 MINUTE
UNION ALL SELECT 'ledger', 'NON_PRIMARY_DOMAIN', CAST(event_id AS VARCHAR) FROM n WHERE NOT lacks AND published_at IS NOT NULL AND url LIKE '%other%'
UNION ALL SELECT 'ledger', 'MISSING_VERIFIED_CIK', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_nationkey IN (1, 2) AND s_acctbal < 0
UNION ALL SELECT 'semantic_duplicates', CASE WHEN lacks THEN 'UNKEYABLE_SEC_EARNINGS_EVENT' ELSE 'DUPLICATE_SEMANTIC_EARNINGS_EVENT' END, event_id FROM k WHERE lacks OR event_id <> f""")
def ledger_audit_issues(spark, sf_dir):
    i = F.col("event_id")
    at = F.when(i % 40 != 7, F.col("ts"))
    rows = events(spark, sf_dir).select(
        F.when(i % 97 == 1, i - 1).otherwise(i).alias("event_id"), F.when(i % 50 == 0, "").otherwise(F.col("event_type")).alias("event_type"), "user_id",
        at.alias("published_at"), at.cast("date").alias("day"), i.alias("seq"), F.when(i % 30 == 11, "http://other.org/x").otherwise("https://a.gov/x").alias("source_url"),
        F.when(i % 6 == 0, "tdnet_public").otherwise("sec_edgar").alias("source_adapter"), F.when(i % 45 != 8, F.col("user_id")).alias("company_id"))
    rows = rows.withColumns({"report_date": F.col("day"), "document_type": F.col("event_type")})
    nation = F.col("s_nationkey")
    registry = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("source_id"), F.when(nation.isin(1, 2, 3), "sec_edgar").otherwise("other").alias("adapter"),
        F.when(nation == 2, F.lit(None)).when(nation == 3, False).otherwise(True).alias("enabled"), F.when(F.col("s_acctbal") >= 0, F.col("s_suppkey")).alias("cik"))
    found = audits.report([
        audits.ledger(rows, _now(), ["event_id", "event_type", "user_id"], ["a.gov"], "seq"), audits.unverified_sources(registry),
        audits.semantic_duplicates(rows, "seq")])
    return found.select("audit", "code", "key")


@query("""
WITH RECURSIVE e(a, b) AS (SELECT 'R' || r_regionkey, 'N' || n_nationkey FROM region JOIN nation ON n_regionkey = r_regionkey
  UNION ALL SELECT 'N' || n_nationkey, 'S' || s_suppkey FROM nation JOIN supplier ON s_nationkey = n_nationkey),
c(a, b, hops) AS (SELECT a, b, 1 FROM e UNION ALL SELECT c.a, e.b, hops + 1 FROM c JOIN e ON c.b = e.a)
SELECT a, b, CAST(min(hops) AS INTEGER) AS hops FROM c GROUP BY a, b""")
def lineage_edges_closure(spark, sf_dir):
    from quern.operators.lineage import closure

    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    regions = table(spark, sf_dir, "region").join(nation, F.col("n_regionkey") == F.col("r_regionkey"))
    edges = regions.select(name("R", "r_regionkey").alias("a"), name("N", "n_nationkey").alias("b")).unionByName(
        supplier.select(name("N", "s_nationkey").alias("a"), name("S", "s_suppkey").alias("b")))
    return closure(edges, "a", "b")


@query("""
WITH m AS (SELECT l_suppkey AS entity, l_returnflag AS concept, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_end, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY ALL)
SELECT m.entity, s_name AS name, concept, period_end, value FROM (SELECT *, row_number() OVER (PARTITION BY entity, concept ORDER BY period_end DESC) AS k FROM m) m
JOIN supplier ON s_suppkey = m.entity WHERE k = 1""")
def financial_db_views(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("entity"), F.col("l_returnflag").alias("concept"), F.trunc(F.col("l_shipdate").cast("date"), "month").alias("period_end")
    ).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("value"))
    latest = keyed.extreme_per_key(rows, ["entity", "concept"], ["period_end"], ["period_end", "value"])
    names = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("entity"), F.col("s_name").alias("name"))
    return latest.join(names, "entity").select("entity", "name", "concept", "period_end", "value")


@query("""
WITH s AS (SELECT o_custkey, count(*) AS observations, CAST(max(o_orderdate) AS DATE) AS latest FROM orders GROUP BY 1),
a AS (SELECT c_custkey AS o_custkey, coalesce(observations, 0) AS observations, latest, CAST(date_diff('day', latest, DATE '2001-08-01') AS INTEGER) AS age_days FROM customer LEFT JOIN s ON c_custkey = o_custkey)
SELECT *, CASE WHEN latest IS NULL THEN 'missing' WHEN age_days > 550 THEN 'stale' ELSE 'fresh' END AS state FROM a""")
def entity_coverage(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    entities = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return audits.entity_coverage(entities, rows, "o_custkey", "day", F.lit("2001-08-01").cast("date"))


@query("""
WITH u AS (SELECT CAST(ts AS DATE) AS day, count(*) AS attempts FROM events GROUP BY 1),
m AS (SELECT *, CAST(sum(attempts) OVER (PARTITION BY year(day), month(day) ORDER BY day) AS BIGINT) AS month_attempts FROM u)
SELECT *, attempts <= 330 AND month_attempts <= 8000 AS within FROM m""")
def quota_usage(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("ts").cast("date").alias("day"), F.lit(1).cast("long").alias("attempts"))
    return audits.quota(rows, 400, 70, 9000, 1000)


@query(f"""
SELECT event_id, user_id, event_type, CASE WHEN ts > {_NOW} THEN 'future' WHEN ts >= {_NOW} - INTERVAL 24 HOUR THEN 'live' ELSE 'stale' END AS disposition FROM events""")
def ledger_stream_available_now(spark, sf_dir):
    from quern.streaming import ledger

    rows = ledger.gated(ledger.stream(spark, sf_dir, "events", table(spark, sf_dir, "events").schema, "ts"), "ts", _now())
    stored = ledger.collected(rows.select("event_id", "user_id", "event_type", "disposition", "ts"), "event_id", "ts")
    return stored.select("event_id", "user_id", "event_type", "disposition")
