"""Queries of filings, collection plans and further audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import audits, filings
from quern.plans.common import Registry, events, money
from quern.session import table

REGISTRY = Registry()
query = REGISTRY.query


@query("""
WITH f AS (SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN '8-K' WHEN 1 THEN '6-K' WHEN 2 THEN '10-Q' WHEN 3 THEN '10-K' WHEN 4 THEN '20-F' ELSE 'S-1' END AS form, o_orderstatus, o_custkey % 5 AS c FROM orders)
SELECT k, form, CASE WHEN form = '8-K' THEN CASE WHEN o_orderstatus <> 'F' THEN 'NOT_EARNINGS_RELATED' END
  WHEN form = '6-K' THEN CASE WHEN c = 0 THEN 'UNVERIFIED_6K' WHEN c = 1 THEN 'SOURCE_FETCH_FAILED' WHEN o_orderstatus <> 'O' THEN 'NOT_EARNINGS_RELATED' END WHEN form = 'S-1' THEN 'NOT_EARNINGS_RELATED' END AS reason FROM f""")
def form_rule_reasons(spark, sf_dir):
    at, c, state = F.col("o_orderkey") % 6, F.col("o_custkey") % 5, F.col("o_orderstatus")
    form = F.when(at == 0, "8-K").when(at == 1, "6-K").when(at == 2, "10-Q").when(at == 3, "10-K").when(at == 4, "20-F").otherwise("S-1")
    items = F.when(state == "F", "1.01,2.02,9.01").otherwise("9.01")
    text = F.when(c == 1, F.lit(None)).when(state == "O", "<p>Results&nbsp;<b>of</b></p><p>Earnings Release: operating income</p>").otherwise("quarter, results and earnings; revenue")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), form.alias("form"), filings.form_reason(form, items, text, F.when(c != 0, "a.htm")).alias("reason"))


@query("""
WITH f AS (SELECT event_id, ts, CASE event_id % 3 WHEN 0 THEN '10-Q' WHEN 1 THEN '8-K' ELSE 'S-3' END AS form FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00')
SELECT event_id, form, CASE WHEN form = '10-Q' THEN 'PASS' ELSE 'REJECTED' END AS freshness, CASE WHEN form <> '10-Q' THEN 'NOT_EARNINGS_RELATED' END AS rejection_reason FROM f""")
def filings_screened(spark, sf_dir):
    at = F.col("event_id") % 3
    rows = events(spark, sf_dir).select(
        "event_id", F.when(at == 0, "10-Q").when(at == 1, "8-K").otherwise("S-3").alias("form"), F.col("ts").alias("accepted_at"),
        F.lit("").alias("items"), F.lit(None).cast("string").alias("text"), F.lit("a.htm").alias("document"))
    day = lambda d: F.lit(d).cast("timestamp")
    return filings.screened(rows, day("2024-01-10"), day("2024-01-20")).select("event_id", "form", "freshness", "rejection_reason")


@query("""
SELECT event_id FROM events WHERE ts >= TIMESTAMP '2024-01-14 22:00:00' AND ts < TIMESTAMP '2024-01-15 22:00:00'""")
def tokyo_day_window(spark, sf_dir):
    day = F.lit("2024-01-16").cast("date")
    return events(spark, sf_dir).where(filings.in_local_day(F.col("ts"), day)).select("event_id")


@query("""
SELECT event_id, CASE WHEN w AND r THEN 'both' WHEN w THEN 'window' ELSE 'required' END AS why FROM (
  SELECT event_id, ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-11 00:00:00' AS w, event_id % 100 = 0 AS r FROM events) WHERE w OR r""")
def window_or_required(spark, sf_dir):
    rows = events(spark, sf_dir)
    at = lambda d: F.lit(d).cast("timestamp")
    found = filings.in_window_or_required(rows, "ts", at("2024-01-10"), at("2024-01-11"), "event_id", rows.where("event_id % 100 = 0").select("event_id"))
    return found.select("event_id", "why")


@query("""
WITH f AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS fy, CAST(quarter(l_shipdate) AS INTEGER) AS fq, l_returnflag AS filed, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY ALL)
SELECT a.l_suppkey, a.fy, a.fq, a.filed, a.value, (SELECT arg_min(b.value, b.filed) FROM f b WHERE b.l_suppkey = a.l_suppkey AND b.fq = a.fq AND b.fy = a.fy - 1) AS prior_year_value FROM f a""")
def prior_year_same_period(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").groupBy(
        "l_suppkey", F.year("l_shipdate").alias("fy"), F.quarter("l_shipdate").alias("fq"), F.col("l_returnflag").alias("filed")).agg(F.sum(money("l_extendedprice")).cast("double").alias("value"))
    return filings.prior_year_same_period(rows, ["l_suppkey"], "fy", "fq", "value", "filed")


@query("""
WITH m AS (SELECT DISTINCT c_custkey, c FROM customer, (VALUES ('makers', 'MACHINERY'), ('makers', 'AUTOMOBILE'), ('homes', 'HOUSEHOLD'), ('homes', 'FURNITURE'), ('mixed', 'MACHINERY'), ('mixed', 'HOUSEHOLD')) v(c, s)
  WHERE s = c_mktsegment OR (s = 'HOUSEHOLD' AND c_nationkey = 3)) SELECT c AS cohort, c_custkey FROM m""")
def list_membership_join(spark, sf_dir):
    cohorts = spark.createDataFrame(
        [("makers", ["MACHINERY", "AUTOMOBILE"]), ("homes", ["HOUSEHOLD", "FURNITURE"]), ("mixed", ["MACHINERY", "HOUSEHOLD"])], "cohort string, accepted_roles array<string>")
    roles = F.array_compact(F.array("c_mktsegment", F.when(F.col("c_nationkey") == 3, "HOUSEHOLD")))
    return filings.members(table(spark, sf_dir, "customer").select("c_custkey", roles.alias("roles")), "roles", cohorts).select("cohort", "c_custkey")


@query("""
WITH p AS (SELECT sha256('GET|' || event_type || '|' || CAST(user_id % 10 AS VARCHAR)) AS fingerprint, event_type, user_id % 10 AS page, user_id FROM events)
SELECT fingerprint, event_type, page, array_to_string(list_sort(list(DISTINCT user_id)), ',') AS consumers FROM p
WHERE NOT (event_type = 'error' AND page < 5) GROUP BY ALL""")
def coalesced_requests(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.lit("GET").alias("method"), "event_type", (F.col("user_id") % 10).alias("page"), "user_id")
    plan = filings.request_plan(rows, "user_id", ["method", "event_type", "page"])
    log = plan.where("event_type = 'error' and page < 5").select("fingerprint", F.lit("success").alias("status"))
    found = filings.still_to_do(plan, log)
    return found.select("fingerprint", "event_type", "page", F.array_join(F.col("consumers").cast("array<string>"), ",").alias("consumers"))


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 AND o_orderpriority <> '5-LOW' THEN 'S' || o_custkey || o_orderpriority WHEN o_orderpriority = '5-LOW' THEN 'only' END AS source_id FROM orders""")
def source_resolution(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("company"), F.col("o_orderpriority").alias("adapter"))
    exact = rows.where("company % 3 = 0 and adapter <> '5-LOW'").select("company", "adapter").distinct().withColumn("source_id", F.concat(F.lit("S"), "company", "adapter"))
    only = spark.createDataFrame([("none", "5-LOW", "only"), ("none", "1-URGENT", "x"), ("none", "1-URGENT", "y")], "company string, adapter string, source_id string")
    registry = exact.unionByName(only).withColumn("enabled", F.lit(True))
    return filings.resolved_source(rows, registry).select("o_orderkey", "source_id")


@query("""
WITH l AS (SELECT o_custkey, CAST(max(o_orderdate) AS DATE) AS latest FROM orders GROUP BY 1),
s AS (SELECT c_custkey AS o_custkey, CASE WHEN c_nationkey <> 7 THEN 100 + c_nationkey * 10 END AS max_age_days FROM customer),
a AS (SELECT s.*, latest, date_diff('day', latest, DATE '2001-08-01') AS age FROM s LEFT JOIN l USING (o_custkey))
SELECT o_custkey, CASE WHEN max_age_days IS NULL THEN 'not_enforced' WHEN latest IS NULL THEN 'missing' WHEN age > max_age_days THEN 'stale' ELSE 'fresh' END AS state FROM a""")
def source_freshness(spark, sf_dir):
    registry = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_nationkey") != 7, 100 + F.col("c_nationkey") * 10).alias("max_age_days"))
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return filings.source_freshness(registry, rows, "o_custkey", "day", F.lit("2001-08-01").cast("date")).select("o_custkey", "state")


@query("""
SELECT c_custkey AS o_custkey, count(o_orderkey) AS found FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1 HAVING count(o_orderkey) < 8""")
def coverage_gate(spark, sf_dir):
    universe = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return filings.coverage_gate(universe, table(spark, sf_dir, "orders").select("o_custkey"), "o_custkey", 8)


@query("""
WITH c AS (SELECT regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1) AS host, page_id % 2 = 0 AS processed, DATE '2024-01-01' + CAST(page_id % 7 AS INTEGER) AS dated, page_id % 3 AS rank, url FROM pages)
SELECT host, url, CAST(row_number() OVER (PARTITION BY host ORDER BY processed, dated DESC, rank, url) AS INTEGER) AS position,
  CASE WHEN row_number() OVER (PARTITION BY host ORDER BY processed, dated DESC, rank, url) > 2 THEN 'per_source_limit' END AS skip_reason FROM c""")
def candidate_priority(spark, sf_dir):
    i = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select(
        F.regexp_extract("url", "^[a-z]+://([^/:?#]*)", 1).alias("host"), (i % 2 == 0).alias("processed"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 7).cast("int")).alias("dated"), (i % 3).alias("rank"), "url")
    return filings.candidates(rows, ["host"], 2).select("host", "url", "position", "skip_reason")


@query("""
WITH m AS (SELECT o_custkey, CAST(o_orderdate AS DATE) - CAST(dayofmonth(o_orderdate) - 1 AS INTEGER) AS day, count(*) AS n, min(CAST(o_totalprice AS DOUBLE)) AS v FROM orders GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY day DESC) AS k FROM m)
SELECT o_custkey, day, CASE WHEN n = 1 THEN v END AS value, CASE WHEN n = 1 THEN 'unique' ELSE 'ambiguous' END AS status FROM r WHERE k = 1""")
def latest_unique_period(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("day"), F.col("o_totalprice").alias("value"))
    return filings.latest_unique(rows, ["o_custkey"], "day", "value")


@query("""
SELECT p_partkey, metric, value FROM (SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN CAST(p_size AS DOUBLE) END AS size, CAST(p_retailprice AS DOUBLE) AS price FROM part) UNPIVOT (value FOR metric IN (size, price))""")
def wide_to_long(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 4 != 0, F.col("p_size")).cast("double").alias("size"), F.col("p_retailprice").alias("price"))
    return filings.long_rows(rows, ["p_partkey"], ["size", "price"])


@query("""
WITH o AS (SELECT CAST(l_suppkey AS VARCHAR) AS e, l_returnflag AS c, CASE WHEN l_returnflag <> 'R' THEN CAST(date_trunc('quarter', l_shipdate) AS DATE) END AS a, CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH AS DATE) - 1 AS b,
  CASE quarter(l_shipdate) WHEN 4 THEN 'FY' WHEN 3 THEN NULL ELSE 'Q' || quarter(l_shipdate) END AS fp, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY ALL)
SELECT 'observation:' || substr(sha256(e || '|' || c || '|actual|' || coalesce(CAST(a AS VARCHAR), '') || '|' || b || '|'), 1, 24) AS id, e AS entity_id, c AS concept_id, value,
  CASE WHEN a IS NULL THEN 'instant' WHEN fp = 'FY' THEN 'annual' WHEN fp LIKE 'Q%' THEN 'quarter' ELSE 'duration' END AS period_type, CAST(0 AS INTEGER) AS revision, 'consolidated' AS scope, 0 AS lists FROM o""")
def observation_rows(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    start, q = F.trunc(day, "quarter"), F.quarter(day)
    rows = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").cast("string").alias("entity_id"), F.col("l_returnflag").alias("concept_id"), F.when(F.col("l_returnflag") != "R", start).alias("period_start"),
        F.date_sub(F.add_months(start, 3), 1).alias("period_end"), F.when(q == 4, "FY").when(q < 3, F.concat(F.lit("Q"), q.cast("string"))).alias("fiscal_period")
    ).agg(F.sum(money("l_extendedprice")).cast("double").alias("value")).withColumn("value_type", F.lit("actual"))
    lists = F.size("assumptions") + F.size("evidence_ids") + F.size("quality_flags")
    return filings.as_observations(rows).select("id", "entity_id", "concept_id", "value", "period_type", "revision", "scope", lists.alias("lists"))


@query("""
WITH c AS (SELECT o_custkey AS k, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
x AS (SELECT o_custkey AS k, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT' GROUP BY 1),
f AS (SELECT c_custkey AS k, c_mktsegment = 'BUILDING' AS q FROM customer)
SELECT f.k, CASE WHEN c.k IS NULL AND x.k IS NULL THEN CASE WHEN q THEN 'public_no_quarterly_10q_facts' ELSE 'public_no_10q_facts_yet' END
  WHEN x.k IS NULL THEN 'capital_expenditure_fact_unavailable' WHEN c.a = x.a AND c.b = x.b THEN 'reported_facts_same_period' ELSE 'reported_facts_period_mismatch' END AS status
FROM f LEFT JOIN c ON c.k = f.k LEFT JOIN x ON x.k = f.k""")
def company_status(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("d"), "o_orderpriority")
    span = lambda df: df.groupBy("k").agg(F.min("d").alias("period_start"), F.max("d").alias("period_end"))
    forms = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.when(F.col("c_mktsegment") == "BUILDING", "10-Q").otherwise("8-K").alias("form"))
    return filings.company_status(span(rows), span(rows.where("o_orderpriority <> '1-URGENT'")), forms, "k")


@query("""
WITH s AS (SELECT CAST(user_id AS VARCHAR) || '/' || CAST(ts AS DATE) AS reservation, ts, CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'purchase' THEN 'completed' ELSE 'reserved' END AS status FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY reservation ORDER BY ts DESC, status DESC) AS k, count(*) OVER (PARTITION BY reservation) AS steps FROM s)
SELECT reservation, status, steps FROM r WHERE k = 1""")
def reservation_states(spark, sf_dir):
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "completed").otherwise("reserved")
    rows = events(spark, sf_dir).select(F.concat_ws("/", "user_id", F.col("ts").cast("date").cast("string")).alias("reservation"), "ts", status.alias("status"))
    return filings.latest_states(rows, "reservation", "ts", "status")


@query("""
WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 20 = 2 THEN '' ELSE CAST(CASE WHEN s_suppkey % 20 = 1 THEN s_suppkey - 1 ELSE s_suppkey END AS VARCHAR) END AS id, CASE WHEN s_suppkey % 9 <> 0 THEN s_name END AS name,
  CASE s_suppkey % 6 WHEN 3 THEN 'tdnet_public' WHEN 4 THEN 'opendart' WHEN 5 THEN 'other' ELSE 'sec_edgar' END AS adapter, CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE s_suppkey % 7 <> 0 END AS enabled,
  CASE WHEN s_suppkey % 14 = 0 THEN 'x' END AS why, CASE WHEN s_suppkey % 5 <> 4 THEN CASE WHEN s_suppkey % 8 = 1 THEN s_suppkey - 1 ELSE s_suppkey END END AS cik FROM supplier),
t AS (SELECT *, adapter = 'sec_edgar' AS sec, adapter = 'tdnet_public' AS td, k % 13 <> 0 AS https, CASE WHEN k % 17 = 0 THEN NULL WHEN k % 10 = 0 THEN k + 1 ELSE k END AS url_cik FROM s),
n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k) AS kid, row_number() OVER (PARTITION BY sec AND coalesce(cik > 0, false), cik ORDER BY k) AS kcik, row_number() OVER (PARTITION BY sec, id ORDER BY k) AS kco FROM t)
SELECT code, CASE WHEN id = '' THEN '<index:' || k || '>' ELSE id END AS key FROM (SELECT k, id, unnest([
  CASE WHEN id = '' THEN 'MISSING_SOURCE_ID' END, CASE WHEN id <> '' AND kid > 1 THEN 'DUPLICATE_SOURCE_ID' END, CASE WHEN adapter = 'other' THEN 'UNSUPPORTED_ADAPTER' END, CASE WHEN enabled IS NULL THEN 'INVALID_ENABLED_FLAG' END,
  CASE WHEN NOT coalesce(enabled, false) AND why IS NULL THEN 'MISSING_DISABLED_REASON' END, CASE WHEN adapter = 'other' OR NOT https THEN 'NON_PRIMARY_OFFICIAL_SOURCE' END, CASE WHEN name IS NULL THEN 'MISSING_REQUIRED_FIELD' END,
  CASE WHEN sec AND NOT coalesce(cik > 0, false) THEN 'INVALID_SEC_CIK' END, CASE WHEN sec AND cik > 0 AND kcik > 1 THEN 'DUPLICATE_SEC_CIK' END, CASE WHEN sec AND NOT coalesce(url_cik > 0, false) THEN 'MISSING_SEC_URL_CIK' END,
  CASE WHEN sec AND url_cik > 0 AND url_cik <> cik THEN 'SEC_URL_CIK_MISMATCH' END, CASE WHEN sec AND k % 4 = 0 THEN 'INVALID_SEC_TICKER' END, CASE WHEN td AND k % 4 <> 3 THEN 'INVALID_TDNET_CODES' END,
  CASE WHEN td THEN 'INVALID_TDNET_COMPANIES' END, CASE WHEN td AND k % 4 IN (1, 3) THEN 'TDNET_CODE_COMPANY_MISMATCH' END, CASE WHEN adapter = 'opendart' AND enabled THEN 'OPENDART_ENABLED_WITHOUT_AUTH_CONTRACT' END,
  CASE WHEN sec AND id <> '' AND kco > 1 THEN 'DUPLICATE_COMPANY_ID' END]) AS code FROM n) WHERE code IS NOT NULL""")
def source_registry_audit(spark, sf_dir):
    k = F.col("s_suppkey")
    kind, four = k % 6, k % 4
    adapter = F.when(kind == 3, "tdnet_public").when(kind == 4, "opendart").when(kind == 5, "other").otherwise("sec_edgar")
    url_cik = F.when(k % 17 == 0, F.lit("")).otherwise(F.concat(F.lit("?CIK="), F.when(k % 10 == 0, k + 1).otherwise(k).cast("string")))
    rest = F.when(kind == 3, "www.release.tdnet.info/inbs/I").when(kind > 3, "englishdart.fss.or.kr/a").otherwise(F.concat(F.lit("www.sec.gov/edgar/browse/"), url_cik))
    codes = F.when(four == 1, F.array(F.lit("1234"), F.lit("1234"))).when(four == 2, F.array(F.lit("12"))).when(four == 3, F.array(F.lit("5678")))
    rows = table(spark, sf_dir, "supplier").select(
        k.alias("seq"), F.when(k % 20 == 2, "").otherwise(F.when(k % 20 == 1, k - 1).otherwise(k).cast("string")).alias("source_id"), F.when(k % 9 != 0, F.col("s_name")).alias("name"),
        adapter.alias("adapter"), F.when(k % 11 != 0, k % 7 != 0).alias("enabled"), F.when(k % 14 == 0, "x").alias("disabled_reason"),
        F.concat(F.when(k % 13 == 0, "http://").otherwise("https://"), rest).alias("official_source"), F.when(k % 5 != 4, F.when(k % 8 == 1, k - 1).otherwise(k)).alias("cik"),
        F.when(four == 0, "low").otherwise("A.B-1").alias("ticker"), F.when(kind == 3, codes).alias("codes"), F.lit(None).cast("map<string,struct<id:string,ticker:string,name:string>>").alias("companies"))
    return audits.source_registry(rows, "seq").select("code", "key")


@query("""
WITH e AS (SELECT event_id AS i, CASE WHEN event_id % 31 = 5 THEN '' ELSE CAST(CASE WHEN event_id % 29 = 1 THEN event_id - 1 ELSE event_id END AS VARCHAR) END AS id, CASE event_id % 4 WHEN 1 THEN '8-K' WHEN 2 THEN '10-Q' ELSE '6-K' END AS form,
  CASE WHEN event_id % 10 = 9 THEN 'tdnet_public' WHEN event_id % 10 = 8 THEN 'odd' ELSE 'sec_edgar' END AS adapter,
  CASE event_id % 6 WHEN 0 THEN 'NOT_EARNINGS_RELATED' WHEN 1 THEN 'UNVERIFIED_6K' WHEN 2 THEN 'SOURCE_FETCH_FAILED' WHEN 3 THEN 'DUPLICATE' WHEN 4 THEN 'odd' ELSE '' END AS reason FROM events),
c AS (SELECT id, unnest([CASE WHEN id = '' OR i % 23 = 0 THEN 'MISSING_REJECTION_PROVENANCE_FIELD' END, CASE WHEN i % 21 = 0 THEN 'INVALID_REJECTED_SCHEMA_VERSION' END, CASE WHEN i % 37 = 0 THEN 'INVALID_REJECTED_PUBLISHED_AT' END,
  CASE WHEN i % 39 = 0 THEN 'INVALID_REJECTED_RETRIEVED_AT' END, CASE WHEN i % 41 = 0 AND i % 37 <> 0 AND i % 39 <> 0 THEN 'REJECTED_RETRIEVED_BEFORE_PUBLISHED' END, CASE WHEN adapter = 'odd' THEN 'UNKNOWN_REJECTION_SOURCE_ADAPTER' END,
  CASE WHEN adapter <> 'odd' AND i % 47 = 0 THEN 'REJECTION_SOURCE_DOMAIN_MISMATCH' END, CASE WHEN (adapter = 'sec_edgar' AND i % 53 = 0) OR (adapter = 'tdnet_public' AND i % 3 = 0) THEN 'MISSING_REJECTION_SOURCE_IDENTITY' END,
  CASE WHEN (adapter = 'sec_edgar' AND i % 43 = 0) OR (adapter = 'tdnet_public' AND i % 43 <> 0) THEN 'REJECTION_PUBLISHED_TIMEZONE_MISMATCH' END, CASE WHEN i % 59 = 0 THEN 'REJECTED_ROW_NOT_MARKED_REJECTED' END,
  CASE WHEN reason = '' THEN 'MISSING_REJECTION_REASON' END, CASE WHEN reason = 'odd' THEN 'UNKNOWN_REJECTION_REASON' END, CASE WHEN reason = 'UNVERIFIED_6K' AND form <> '6-K' THEN 'UNVERIFIED_6K_REASON_FORM_MISMATCH' END,
  CASE WHEN reason = 'SOURCE_FETCH_FAILED' AND form <> '6-K' THEN 'SOURCE_FETCH_FAILED_REASON_FORM_MISMATCH' END, CASE WHEN reason = 'NOT_EARNINGS_RELATED' AND form = '6-K' AND adapter <> 'sec_edgar' THEN 'SIX_K_CONTENT_REJECTION_NON_SEC_SOURCE' END]) AS code FROM e),
g AS (SELECT id, count(*) AS n FROM e GROUP BY id)
SELECT code, id AS key FROM c WHERE code IS NOT NULL UNION ALL SELECT 'MISSING_REJECTED_EVENT_ID', id FROM g WHERE id = '' UNION ALL SELECT 'DUPLICATE_REJECTED_EVENT_ID', id FROM g WHERE id <> '' AND n > 1
UNION ALL SELECT 'EVENT_ACCEPTED_AND_REJECTED', id FROM g WHERE id IN (SELECT CAST(o_orderkey * 7 AS VARCHAR) FROM orders)""")
def rejection_audit(spark, sf_dir):
    i = F.col("event_id")
    text = lambda ts: F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    adapter = F.when(i % 10 == 9, "tdnet_public").when(i % 10 == 8, "odd").otherwise("sec_edgar")
    hosts = F.when(i % 10 == 9, "www.release.tdnet.info/x").otherwise("www.sec.gov/x")
    reason = F.get(F.array(*(F.lit(x) for x in ("NOT_EARNINGS_RELATED", "UNVERIFIED_6K", "SOURCE_FETCH_FAILED", "DUPLICATE", "odd", None))), (i % 6).cast("int"))
    rows = events(spark, sf_dir).select(
        F.when(i % 21 == 0, "v0").otherwise(audits.EVENT_VERSION).alias("schema_version"), F.when(i % 31 == 5, "").otherwise(F.when(i % 29 == 1, i - 1).otherwise(i).cast("string")).alias("event_id"),
        F.lit("c").alias("company_id"), F.when(i % 23 != 0, "n").alias("company_name"), F.when(i % 4 == 1, "8-K").when(i % 4 == 2, "10-Q").otherwise("6-K").alias("document_type"),
        F.when(i % 37 == 0, "2024-01-01T00:00:00").otherwise(text(F.col("ts"))).alias("published_at"),
        F.when(i % 39 == 0, "soon").otherwise(text(F.when(i % 41 == 0, F.col("ts") - F.expr("interval 1 day")).otherwise(F.col("ts") + F.expr("interval 1 hour")))).alias("retrieved_at"),
        F.when(i % 43 == 0, "Asia/Tokyo").otherwise("UTC").alias("published_timezone"), adapter.alias("source_adapter"), F.concat(F.when(i % 47 == 0, "http://").otherwise("https://"), hosts).alias("source_url"),
        F.when(i % 53 != 0, "a").alias("accession_number"), F.lit(1).alias("cik"), F.when(i % 3 != 0, "7203").alias("security_code"), F.when(i % 59 == 0, "PASS").otherwise("REJECTED").alias("freshness"), reason.alias("rejection_reason"))
    accepted = table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 7).cast("string").alias("event_id"))
    return audits.rejections(rows, accepted).select("code", "key")


@query("""
SELECT CAST(event_id AS VARCHAR) AS key, unnest(CASE event_id % 10 WHEN 3 THEN ['FORBIDDEN_KEY'] WHEN 4 THEN ['FORBIDDEN_KEY'] WHEN 5 THEN ['FORBIDDEN_VALUE'] WHEN 6 THEN ['FORBIDDEN_KEY', 'FORBIDDEN_VALUE'] ELSE [] END) AS code FROM events""")
def consensus_separation_audit(spark, sf_dir):
    i = F.col("event_id") % 10
    keys = F.array(F.lit("value"), F.when(i == 3, "Consensus-Mean").when(i == 4, "unestimated").when(i == 6, "eps_surprise").otherwise("period_end"))
    values = F.array(F.when(i == 5, " Analyst consensus ").when(i == 6, "street-estimate").when(i == 7, "no consensus is supported here").otherwise("us-gaap"))
    rows = events(spark, sf_dir).select("event_id", keys.alias("keys"), values.alias("texts"))
    return audits.consensus_separation(rows, "event_id", "keys", "texts").select("key", "code")


@query("""
WITH m AS (SELECT o_orderkey AS k, CAST(CASE WHEN o_orderkey % 23 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS VARCHAR) AS id FROM orders),
n AS (SELECT k, CASE WHEN k % 29 = 0 THEN '' ELSE id END AS id, row_number() OVER (PARTITION BY CASE WHEN k % 29 = 0 THEN '' ELSE id END ORDER BY k) AS nth FROM m),
j AS (SELECT n.*, id = '' OR nth > 1 AS lacks, CAST(nullif(id, '') AS BIGINT) AS e FROM n),
f AS (SELECT *, CASE WHEN NOT lacks AND e IN (SELECT CASE WHEN o_orderkey % 13 = 0 THEN -o_orderkey ELSE o_orderkey END FROM orders) THEN true ELSE false END AS there, e % 11 <> 0 AS passed FROM j)
SELECT id AS key, code FROM (SELECT id, unnest([CASE WHEN lacks THEN 'DUPLICATE_OR_MISSING_EVENT_ID' END, CASE WHEN NOT lacks AND NOT there THEN 'METRIC_WITHOUT_ACCEPTED_EVENT' END, CASE WHEN there AND e % 17 = 0 THEN 'METRIC_EVENT_NOT_FRESH' END,
  CASE WHEN there AND e % 19 = 0 THEN 'METRIC_EVENT_NOT_SEC' END, CASE WHEN there AND e % 5 = 0 THEN 'METRIC_EVENT_FORM_NOT_ALLOWED' END, CASE WHEN there AND k % 31 = 0 THEN 'METRIC_EVENT_MISMATCH:company_id' END,
  CASE WHEN there AND k <> e THEN 'METRIC_EVENT_MISMATCH:accession_number' END, CASE WHEN there AND e % 5 = 0 THEN 'METRIC_EVENT_MISMATCH:document_type' END, CASE WHEN there AND e % 37 = 0 THEN 'METRIC_EVENT_MISMATCH:period_end' END,
  CASE WHEN there AND k % 41 = 0 THEN 'UNSAFE_METRIC_CONTRACT' END, CASE WHEN there AND k % 43 = 0 THEN 'NON_PRIMARY_METRIC_SOURCE' END, CASE WHEN there AND NOT passed THEN 'MISSING_PASS_EVIDENCE' END,
  CASE WHEN there AND passed AND e % 5 = 0 THEN 'EVIDENCE_EVENT_MISMATCH' END]) AS code FROM f) WHERE code IS NOT NULL""")
def metric_lineage_audit(spark, sf_dir):
    k = F.col("o_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    text = lambda c: c.cast("string")
    metrics = orders.select(
        k.alias("seq"), F.when(k % 29 == 0, "").otherwise(text(F.when(k % 23 == 1, k - 1).otherwise(k))).alias("event_id"), F.when(k % 31 == 0, "z").otherwise("c").alias("company_id"), F.lit("T").alias("ticker"),
        text(k).alias("accession_number"), F.lit("10-Q").alias("document_type"), F.lit("2024-03-31").alias("period_end"), F.lit("revenue").alias("metric"), F.when(k % 41 == 0, "JPY").otherwise("USD").alias("unit"),
        F.lit("us-gaap").alias("taxonomy"), F.when(k % 43 == 0, "https://a.org/").otherwise(audits.FACTS_PREFIX + "1.json").alias("source_url"))
    shown = orders.select(
        k.alias("seq"), text(F.when(k % 13 == 0, -k).otherwise(k)).alias("event_id"), F.lit("c").alias("company_id"), F.lit("T").alias("ticker"), text(k).alias("accession_number"),
        F.when(k % 5 == 0, "8-K").otherwise("10-Q").alias("document_type"), F.when(k % 37 != 0, "2024-03-31").alias("report_date"), F.when(k % 17 != 0, "PASS").alias("freshness"),
        F.when(k % 19 == 0, "tdnet_public").otherwise("sec_edgar").alias("source_adapter"))
    proofs = orders.select(k.alias("seq"), text(k).alias("event_id"), F.lit("c").alias("company_id"), F.lit("10-Q").alias("document_type"), F.when(k % 11 == 0, "FAIL").otherwise("PASS").alias("status"))
    return audits.metric_lineage(metrics, shown, proofs, "seq").select("key", "code")


@query("""
WITH e AS (SELECT event_id AS i, CAST(CASE WHEN event_id % 29 = 1 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS id, CASE WHEN event_id % 9 <> 4 THEN 'sec_edgar' ELSE 'tdnet_public' END AS a,
  CASE event_id % 7 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' WHEN 2 THEN '8-K' WHEN 3 THEN '6-K' WHEN 4 THEN '20-F' ELSE 'S-1' END AS f FROM events),
c AS (SELECT *, CASE WHEN a <> 'sec_edgar' THEN 'UNVERIFIED_PRIMARY_SOURCE_BASIS' WHEN f IN ('10-K', '10-Q') THEN 'US_GAAP_PRIMARY_FINANCIAL_STATEMENTS_PRESENT' WHEN f IN ('8-K', '6-K') THEN 'MIXED_OR_UNVERIFIED_EARNINGS_MATERIAL'
  WHEN f = '20-F' THEN 'ACCOUNTING_BASIS_UNVERIFIED_FROM_FORM' END AS context FROM e),
n AS (SELECT *, row_number() OVER (PARTITION BY id, context IS NOT NULL ORDER BY i) AS k FROM c)
SELECT id AS key, context AS outcome FROM n WHERE context IS NOT NULL AND k = 1 UNION ALL SELECT id, 'UNCLASSIFIED_ACCOUNTING_BASIS' FROM n WHERE context IS NULL
UNION ALL SELECT id, 'DUPLICATE_ACCOUNTING_BASIS_EVENT' FROM n WHERE context IS NOT NULL AND k > 1""")
def accounting_context_audit(spark, sf_dir):
    i = F.col("event_id")
    form = F.get(F.array(*(F.lit(x) for x in ("10-K", "10-Q", "8-K", "6-K", "20-F", "S-1", "S-1"))), (i % 7).cast("int"))
    rows = events(spark, sf_dir).select(
        i.alias("seq"), F.when(i % 29 == 1, i - 1).otherwise(i).cast("string").alias("event_id"), F.when(i % 9 == 4, "tdnet_public").otherwise("sec_edgar").alias("source_adapter"), form.alias("document_type"))
    items, found = audits.accounting_contexts(rows, "seq")
    return items.select(F.col("event_id").alias("key"), F.col("context").alias("outcome")).unionByName(found.select("key", F.col("code").alias("outcome")))


@query("""
SELECT CASE WHEN unit IS NULL THEN 'MISSING_UNIT' WHEN unit = 'EUR' THEN 'UNSUPPORTED_UNIT' ELSE 'SCALED_UNIT' END AS code, CAST(o_orderkey AS VARCHAR) AS key FROM (
  SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'JPY_million' WHEN 2 THEN 'JPY' WHEN 3 THEN 'EUR' END AS unit FROM orders) WHERE unit IS NULL OR unit NOT IN ('USD', 'JPY')""")
def money_unit_audit(spark, sf_dir):
    at = F.col("o_orderkey") % 5
    unit = F.when(at == 0, "USD").when(at == 1, "JPY_million").when(at == 2, "JPY").when(at == 3, "EUR")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", unit.alias("unit"))
    return audits.money_units(rows, "o_orderkey", "o_totalprice", "unit").select("code", "key")


@query("""
SELECT 'NOT_RENDERED' AS code, CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE o_orderkey % 10 = 0
UNION ALL SELECT 'STALE_ID', CAST(-o_orderkey - 1 AS VARCHAR) FROM orders WHERE o_orderkey % 10 = 0""")
def page_boundary_audit(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(k.alias("id"))
    rendered = table(spark, sf_dir, "orders").select(F.when(k % 10 == 0, -k - 1).otherwise(k).alias("id"))
    return audits.page_boundary(rendered, rows, "id").select("code", "key")
