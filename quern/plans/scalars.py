"""Queries of ids, dates, arithmetic, texts and the audits that work on single rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import scalars as S
from quern.functions import text as T
from quern.operators import analytics, audits, filings, growth, keyed
from quern.plans.common import RUN_AT, Registry, events, money
from quern.session import table

REGISTRY = Registry()
query = REGISTRY.query


@query("""
WITH a AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS v, CASE o_orderkey % 5 WHEN 0 THEN 0 WHEN 1 THEN -o_custkey WHEN 2 THEN NULL ELSE o_custkey END AS w FROM orders),
b AS (SELECT *, CAST(v * 100 AS HUGEINT) - CAST(w AS HUGEINT) * 100 AS d, CAST(abs(w) AS HUGEINT) * 100 AS m FROM a)
SELECT o_orderkey, round(CAST(v AS DOUBLE) / nullif(CAST(w AS DOUBLE), 0), 6) AS quotient, round(CAST(v AS DOUBLE) / nullif(CAST(w AS DOUBLE), 0) - 1, 6) AS change,
  CASE WHEN w <> 0 THEN CAST((CASE WHEN d < 0 THEN -1 ELSE 1 END) * ((2 * abs(d) * 1000000 + m) // (2 * m)) AS DOUBLE) / 10000 END AS percent,
  CASE WHEN w > 0 THEN round(pow(CAST(v AS DOUBLE) / w, 1.0 / 3) - 1, 8) END AS growth, CAST(round_even((o_orderkey % 200) / 200.0 * 10000 - 2500, 0) AS BIGINT) AS margin_bp FROM b""")
def growth_arithmetic(spark, sf_dir):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    w = F.when(k % 5 == 0, F.lit(0)).when(k % 5 == 1, -c).when(k % 5 == 3, c).when(k % 5 == 4, c)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", money("o_totalprice").alias("v"), w.alias("w"))
    v, w = F.col("v"), F.col("w")
    return rows.select(
        "o_orderkey", F.round(S.safe_divide(v, w), 6).alias("quotient"), F.round(S.ratio_change(v, w), 6).alias("change"), S.percent_change(v, w).cast("double").alias("percent"),
        F.round(S.growth_rate(w.cast("double"), v.cast("double"), F.lit(3)), 8).alias("growth"), analytics.margin_delta_bp((k % 200) / 200, F.lit(0.25)).alias("margin_bp"))


@query("""
WITH d AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT k, CASE WHEN k % 6 = 4 THEN NULL ELSE d END AS parsed, CASE WHEN k % 3 = 2 THEN NULL ELSE strftime(CAST(d AS TIMESTAMP) + INTERVAL (CASE k % 3 WHEN 0 THEN 8 ELSE 0 END) HOUR, '%Y-%m-%dT%H:%M:%SZ') END AS utc,
  CASE WHEN k % 4 = 3 THEN NULL WHEN year(d) < 2000 THEN NULL ELSE d END AS in_url FROM d""")
def dates_parsed(spark, sf_dir):
    k, d = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    shape = lambda f: F.date_format(d, f)
    text = F.when(k % 6 == 0, shape("yyyy-MM-dd")).when(k % 6 == 1, shape("yyyyMMdd")).when(k % 6 == 2, shape("yyyy/MM/dd")).when(k % 6 == 3, shape("MMMM d, yyyy")).when(k % 6 == 4, F.lit("soon")).otherwise(shape("yyyy-MM-dd'T'00:00"))
    zoned = F.concat(shape("yyyy-MM-dd"), F.when(k % 3 == 0, "T00:00:00-08:00").when(k % 3 == 1, "T00:00:00Z").otherwise("T00:00:00"))
    url = F.concat(F.lit("https://a/n"), F.when(k % 4 == 0, shape("/yyyy/MM/dd/")).when(k % 4 == 1, shape("-yyyyMMdd-")).when(k % 4 == 2, shape("/yyyy-M-d")).otherwise("/2024-13-40"))
    return table(spark, sf_dir, "orders").select(k.alias("k"), S.any_date(text).alias("parsed"), S.utc_text(S.instant(zoned)).alias("utc"), S.url_date(url).alias("in_url"))


@query("""
SELECT c_custkey AS k, 'https://a/' || c_custkey || '/' || '001' || c_custkey AS filing, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, 'fact:' || c_custkey || ':' || c_nationkey AS path_id,
  CASE c_custkey % 4 WHEN 0 THEN nullif(c_custkey, 0) WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE NULL END AS url_cik, CASE WHEN c_custkey % 2 = 0 THEN lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') ELSE lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '1' END AS code,
  lower(c_mktsegment) || '_' || c_nationkey AS snake FROM customer""")
def ids_and_urls(spark, sf_dir):
    k = F.col("c_custkey")
    text = k.cast("string")
    four = F.lpad((k % 10000).cast("string"), 4, "0")
    url = F.when(k % 4 == 0, F.concat(F.lit("https://a/b?x=1&CIK="), text)).when(k % 4 == 1, F.concat(F.lit("https://a/b?CIK=1&CIK="), text)).when(k % 4 == 2, F.lit("https://a/b?CIK=12345678901")).otherwise(F.lit("https://a/b?CIK=x1"))
    return table(spark, sf_dir, "customer").select(
        k.alias("k"), S.filing_url("https://a", F.lpad(text, 10, "0"), F.concat(F.lit("0-01-"), text)).alias("filing"), S.padded_cik(k).alias("cik"), S.path_id(F.lit("fact"), text, F.col("c_nationkey").cast("string")).alias("path_id"),
        S.url_cik(url).alias("url_cik"), S.security_code(F.concat(four, F.when(k % 2 == 0, "0").otherwise("1"))).alias("code"), T.snake(F.concat_ws(" (", "c_mktsegment", F.col("c_nationkey").cast("string"))).alias("snake"))


@query("""
SELECT n_nationkey, sha256('{"a":"' || n_name || '","b":[{"c":' || n_nationkey || '}]}') AS canonical, 'a,b,b[].c' AS paths, CASE WHEN n_nationkey % 2 = 0 THEN 2.67 ELSE 2.68 END AS rounded FROM nation""")
def canonical_json(spark, sf_dir):
    k = F.col("n_nationkey")
    doc = F.concat(F.lit('{ "b": [ {"c": '), k.cast("string"), F.lit('} ], "a": "'), F.col("n_name"), F.lit('" }'))
    return table(spark, sf_dir, "nation").select(
        "n_nationkey", T.canonical_hash(doc).alias("canonical"), F.array_join(T.key_paths(doc), ",").alias("paths"), T.python_round(F.when(k % 2 == 0, 2.675).otherwise(2.676), 2).alias("rounded"))


@query("""
SELECT o_orderkey AS k, o_orderkey % 2 = 0 AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderkey % 7 <> 0 AND o_custkey % 120 BETWEEN 70 AND 110 AS eligible,
  CASE WHEN o_orderstatus <> 'F' THEN 'third_party_source' WHEN o_orderkey % 3 = 1 THEN 'third_party_previous_source' END AS quarantine, o_orderkey % 5 = 0 AS has_keyword,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 4 = 3 THEN NULL WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 4 = 0 THEN 'annual' ELSE 'interim' END AS period_kind,
  CASE WHEN o_orderkey % 11 = 0 THEN 'MISSING_PERIOD_END' WHEN o_orderkey % 4 = 3 THEN 'UNKNOWN_FORM' WHEN o_orderkey % 13 = 0 THEN 'PERIOD_AFTER_PUBLICATION' END AS period_issue FROM orders""")
def filing_rules(spark, sf_dir):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    start = F.when(k % 7 != 0, F.date_sub(day, (F.col("o_custkey") % 120).cast("int")))
    title = F.when(k % 5 == 0, "2024年 決算短信(連結)").otherwise("notice")
    form = F.when(k % 4 == 0, "10-K").when(k % 4 == 1, "10-Q").when(k % 4 == 2, "6-K").otherwise("S-1")
    kind, issue = filings.reporting_period(form, F.when(k % 11 != 0, F.when(k % 13 == 0, F.date_add(day, 1)).otherwise(day)), day.cast("timestamp"))
    return table(spark, sf_dir, "orders").select(
        k.alias("k"), filings.eligible(F.when(k % 2 == 0, "USD").otherwise("EUR"), F.col("o_orderpriority"), start, day, ["1-URGENT", "2-HIGH"], 70, 110).alias("eligible"),
        filings.canonical_source(F.col("o_orderstatus"), F.when(k % 3 == 1, "X").when(k % 3 == 2, "F"), ["F"]).alias("quarantine"), filings.has_keyword(title, ["決算短信", "業績(修正)"]).alias("has_keyword"),
        kind.alias("period_kind"), issue.alias("period_issue"))


@query("""
WITH f AS (SELECT l_suppkey AS e, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS a, CAST(l_shipdate AS DATE) AS b, l_orderkey * 10 + l_linenumber AS n, CAST(l_extendedprice AS DOUBLE) AS value FROM lineitem),
r AS (SELECT *, CAST(date_diff('day', a, b) AS INTEGER) AS duration_days, row_number() OVER (PARTITION BY e, a, b ORDER BY n DESC) AS k FROM f WHERE b > a)
SELECT e AS entity, a AS period_start, b AS period_end, value, duration_days FROM r WHERE k = 1""")
def multi_period_actuals(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    facts = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"), F.trunc(day, "quarter").alias("period_start"), day.alias("period_end"), F.col("l_extendedprice").cast("double").alias("value"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("n"))
    return growth.multi_period_actuals(facts, ["entity", "period_start", "period_end"], "n").select("entity", "period_start", "period_end", "value", "duration_days")


@query("""
SELECT 'published_at' AS audit, CASE WHEN event_id % 10 = 0 THEN 'NO_ACCEPTANCE_TIME' ELSE 'PUBLISHED_AT_MISMATCH' END AS code, CAST(event_id AS VARCHAR) AS key FROM events WHERE event_id % 10 = 0 OR event_id % 10 = 3
UNION ALL SELECT 'growth_durations', c, CAST(o_orderkey AS VARCHAR) FROM (SELECT o_orderkey, unnest([CASE WHEN o_orderkey % 3 = 0 THEN 'BAD_GAP' END, CASE WHEN o_orderkey % 4 = 0 THEN 'BAD_DURATION' END, CASE WHEN o_orderkey % 5 = 0 THEN 'MISSING_PERCENT' END]) AS c FROM orders) WHERE c IS NOT NULL
UNION ALL SELECT 'accounting_basis', c, CAST(o_orderkey AS VARCHAR) FROM (SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'UNKNOWN_METRIC' WHEN 1 THEN 'NON_STANDARD_TAXONOMY' WHEN 3 THEN 'NOT_LABELLED_DERIVED' WHEN 4 THEN 'MISSING_INPUTS' END AS c FROM orders) WHERE c IS NOT NULL
UNION ALL SELECT 'projection', 'UNKNOWN_FIELD', CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 2 = 1""")
def row_audits(spark, sf_dir):
    i, k, day = F.col("event_id"), F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    shown = events(spark, sf_dir).select("event_id", F.col("ts").alias("published_at"))
    accepted = shown.select(F.when(i % 10 == 0, -i - 1).otherwise(i).alias("event_id"), F.when(i % 10 == 3, F.col("published_at") + F.expr("interval 1 second")).otherwise(F.col("published_at")).alias("accepted_at"))
    orders = table(spark, sf_dir, "orders")
    end = F.date_sub(day, F.when(k % 3 == 0, 300).otherwise(365))
    rows = orders.select(
        k.alias("event_id"), F.date_sub(day, 90).alias("period_start"), day.alias("period_end"), F.date_sub(end, F.when(k % 4 == 0, 100).otherwise(90)).alias("prior_start"), end.alias("prior_end"), F.when(k % 5 != 0, 1.0).alias("percent"))
    at = k % 6
    basis = orders.select(
        k.alias("event_id"), F.when(at == 0, "other").when(at <= 2, "revenue").otherwise("fcf").alias("metric"), F.when(at == 2, "us-gaap").alias("taxonomy"), F.when(at != 3, "derived").alias("basis"),
        F.when(at == 4, F.array(F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("inputs"))
    s = F.col("s_suppkey")
    records = table(spark, sf_dir, "supplier").select(s.alias("id"), F.concat(F.lit('{"a":1'), F.when(s % 2 == 1, ',"z":2').otherwise(""), F.lit("}")).alias("record"))
    found = audits.report([
        audits.published_at(shown, accepted, "event_id"), audits.comparable_periods(rows, (350, 380)), audits.stated_basis(basis, ["revenue"], ["fcf"]), audits.projection_allowed(records, ["a"])])
    return found.select("audit", "code", "key")


@query("""
WITH r AS (SELECT o_orderkey AS k, o_orderkey % 8 AS c FROM orders), n AS (SELECT count(*) AS n FROM orders),
x AS (SELECT k, CASE WHEN c = 1 THEN 'UNSAFE_GROWTH_PROVENANCE' WHEN c = 2 THEN 'INVALID_PERIOD_DATE' WHEN c = 3 THEN 'NON_POSITIVE_PERIOD_DURATION' WHEN c = 4 THEN 'INVALID_YOY_END_GAP' WHEN c = 5 THEN 'INVALID_YOY_DURATION_GAP'
  WHEN c = 6 THEN 'GROWTH_ROW_NOT_OBJECT' END AS code FROM r)
SELECT code, CAST(k AS VARCHAR) AS key, CASE code WHEN 'INVALID_YOY_END_GAP' THEN '300' WHEN 'INVALID_YOY_DURATION_GAP' THEN '8' ELSE '' END AS detail FROM x WHERE code IS NOT NULL
UNION ALL SELECT 'CALCULATED_COUNT_MISMATCH', '<growth>', '' UNION ALL SELECT 'UNCALCULATED_ROW_CONTAINS_GROWTH_VALUE', CAST(c_custkey AS VARCHAR), '' FROM customer WHERE c_custkey % 9 = 0""")
def growth_duration_audit(spark, sf_dir):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    c = k % 8
    end = F.date_sub(day, F.when(c == 4, 300).otherwise(365))
    text = lambda d: d.cast("string")
    rows = table(spark, sf_dir, "orders").select(
        (c != 6).alias("whole"), k.alias("event_id"), F.lit("YoY").alias("growth_type"), F.lit("revenue").alias("metric"), F.lit("USD").alias("unit"), F.lit("us-gaap").alias("taxonomy"), F.lit("10-Q").alias("document_type"),
        F.lit("x").alias("accession_number"), F.when(c == 1, "https://a.gov/api/xbrl/companyfacts/CIK1").otherwise("https://data.sec.gov/api/xbrl/companyfacts/CIK1").alias("source_url"),
        F.when(c == 2, "then").otherwise(text(F.date_sub(day, F.when(c == 3, 0).otherwise(90)))).alias("current_period_start"), text(day).alias("current_period_end"),
        text(F.date_sub(end, F.when(c == 5, 98).otherwise(90))).alias("prior_period_start"), text(end).alias("prior_period_end"))
    document = rows.agg(F.lit(True).alias("listed"), F.lit("PASS").alias("status"), F.lit(0).alias("issues"), F.lit(audits.GROWTH_VERSION).alias("schema_version"), (F.count("*") + 1).alias("calculated_yoy_total"))
    silent = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("event_id"), (F.col("c_custkey") % 9 == 0).alias("valued"))
    return audits.growth_durations(document, rows, silent).select("code", "key", "detail")


@query("""
WITH a(i, artifact, metric) AS (VALUES (0, 'verified_revenue_latest.json', 'revenue'), (1, 'verified_capex_latest.json', 'capital_expenditures'), (2, 'verified_inventory_latest.json', 'inventory_net'), (3, 'verified_fcf_latest.json', 'free_cash_flow')),
r AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 = 3 THEN 3 WHEN o_orderkey % 4 = 2 THEN 2 ELSE 0 END AS i, o_orderkey // 4 % 7 AS c, CASE WHEN o_orderkey // 4 % 11 = 3 THEN o_orderkey - 4 ELSE o_orderkey END AS e FROM orders),
s AS (SELECT *, c <> 6 AS sound, min(CASE WHEN c <> 6 THEN k END) OVER (PARTITION BY i, e) AS f FROM r WHERE i <> 2),
x AS (SELECT *, CASE WHEN NOT sound THEN 'INVALID_METRIC_IDENTITY' WHEN k <> f THEN 'DUPLICATE_VERIFIED_METRIC' WHEN i = 0 AND c = 1 THEN 'RAW_METRIC_NOT_BOUND_TO_US_GAAP_XBRL' WHEN i = 0 AND c = 2 THEN 'RAW_METRIC_ACCOUNTING_BASIS_CONFLICT'
  WHEN i = 3 AND c = 3 THEN 'DERIVED_METRIC_MISSING_NON_GAAP_LABEL' WHEN i = 3 AND c = 4 THEN 'DERIVED_METRIC_INPUT_PROVENANCE_INCOMPLETE' WHEN i = 3 AND c = 5 THEN 'DERIVED_METRIC_DERIVATION_MISSING' END AS code FROM s)
SELECT coalesce(code, CASE WHEN x.i = 0 THEN 'us-gaap-xbrl-fact' ELSE 'derived-non-gaap' END) AS outcome, CAST(e AS VARCHAR) AS key, artifact FROM x JOIN a ON a.i = x.i
UNION ALL SELECT 'MISSING_VERIFIED_METRIC_ARTIFACT', artifact, artifact FROM a WHERE i = 1 UNION ALL SELECT 'UPSTREAM_METRIC_ARTIFACT_NOT_PASS', artifact, artifact FROM a WHERE i = 2 UNION ALL SELECT 'VERIFIED_METRIC_COUNT_MISMATCH', artifact, artifact FROM a WHERE i = 3""")
def metric_basis_audit(spark, sf_dir):
    k = F.col("o_orderkey")
    c = F.floor(k / 4) % 7
    revenue, _, inventory, fcf = (F.lit(a) for a in (*audits.RAW_ARTIFACTS, *audits.DERIVED_ARTIFACTS))
    artifact = F.when(k % 4 == 3, fcf).when(k % 4 == 2, inventory).otherwise(revenue)
    metric = F.when(c == 6, "other").when(k % 4 == 3, "free_cash_flow").when(k % 4 == 2, "inventory_net").otherwise("revenue")
    fact = lambda name, tag: (F.lit(name), F.struct(F.lit("us-gaap").alias("taxonomy"), tag.alias("concept")))
    inputs = F.create_map(*fact("operating_cash_flow", F.lit("A")), *fact("capital_expenditures", F.when(c != 4, "B")))
    rows = table(spark, sf_dir, "orders").select(
        artifact.alias("artifact"), k.alias("n"), F.lit(True).alias("whole"), F.when(F.floor(k / 4) % 11 == 3, k - 4).otherwise(k).alias("event_id"), metric.alias("metric"),
        F.when(c == 1, "ifrs").otherwise("us-gaap").alias("taxonomy"), F.lit("R").alias("concept"), F.when(k % 4 == 3, F.when(c != 3, "derived-non-gaap")).otherwise(F.when(c == 2, "gaap")).alias("accounting_basis"),
        F.when(c != 5, "a - b").alias("derivation"), F.when(k % 4 == 3, inputs).alias("inputs"))
    documents = rows.groupBy("artifact").agg(F.when(F.col("artifact") == inventory, "FAIL").otherwise("PASS").alias("status"), F.lit(None).cast("int").alias("issues"), F.lit(True).alias("listed"),
                                             (F.count("*") + F.when(F.col("artifact") == fcf, 1).otherwise(0)).alias("verified_metrics_total"))
    items, found = audits.accounting_basis(documents, rows, "n")
    return found.select(F.col("code").alias("outcome"), "key", F.col("detail").alias("artifact")).unionByName(items.select(F.col("accounting_basis").alias("outcome"), F.col("event_id").alias("key"), "artifact"))


@query("""
WITH s AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS cash, CASE WHEN s_suppkey % 2 = 0 THEN 10.0 END AS inv, CASE WHEN s_suppkey % 4 = 0 THEN 1.0 END AS dc, CASE WHEN s_suppkey % 5 = 0 THEN 2.0 END AS dn, CASE WHEN s_suppkey % 7 <> 0 THEN 9.0 END AS dt FROM supplier)
SELECT k, round(cash + coalesce(inv, 0), 4) AS liquidity, CASE WHEN dc IS NOT NULL OR dn IS NOT NULL THEN coalesce(dc, 0) + coalesce(dn, 0) ELSE dt END AS debt,
  CASE WHEN dc IS NOT NULL OR dn IS NOT NULL THEN 'components' WHEN dt IS NOT NULL THEN 'reported_total' ELSE 'missing' END AS debt_method FROM s""")
def liquidity_and_debt(spark, sf_dir):
    k = F.col("s_suppkey")
    rows = table(spark, sf_dir, "supplier").select(
        k.alias("k"), F.when(k % 3 != 0, F.col("s_acctbal").cast("double")).alias("cash"), F.when(k % 2 == 0, 10.0).alias("investments"), F.when(k % 4 == 0, 1.0).alias("debt_current"),
        F.when(k % 5 == 0, 2.0).alias("debt_noncurrent"), F.when(k % 7 != 0, 9.0).alias("debt_total"))
    found = analytics.liquidity_and_debt(rows)
    return found.select("k", F.round("liquidity", 4).alias("liquidity"), F.col("debt").cast("double").alias("debt"), "debt_method")


@query("""
WITH u AS (SELECT c_custkey AS k FROM customer UNION ALL SELECT s_suppkey FROM supplier)
SELECT 'repeated' AS list, k, NULL AS first_at FROM u GROUP BY k HAVING count(*) > 1 UNION ALL SELECT 'first', user_id, min(event_id) FROM events GROUP BY user_id""")
def unions_and_firsts(spark, sf_dir):
    _, repeated = keyed.union_unique([table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))], "k")
    first = keyed.distinct_in_order(events(spark, sf_dir).select("user_id", "event_id"), "user_id", "event_id")
    return repeated.select(F.lit("repeated").alias("list"), F.col("k").cast("long").alias("k"), F.lit(None).cast("long").alias("first_at")).unionByName(
        first.select(F.lit("first").alias("list"), F.col("user_id").cast("long").alias("k"), F.col("event_id").cast("long").alias("first_at")))


@query("""
WITH p AS (SELECT page_id AS i, url || '#' || page_id AS u, sha1(html) AS h FROM pages),
o AS (SELECT i, u, CASE WHEN i % 3 = 0 THEN 'old' ELSE h END AS h, i % 7 AS r FROM p WHERE i % 4 <> 1),
n AS (SELECT i, u, CASE WHEN i % 5 <> 0 THEN h END AS h, i % 5 <> 0 AS ok FROM p)
SELECT n.u AS url, CASE WHEN ok THEN n.h ELSE o.h END AS sha256, CASE WHEN NOT ok THEN 'failed' WHEN o.h = n.h THEN 'unchanged' ELSE 'changed' END AS status,
  CAST(CASE WHEN ok THEN 0 ELSE coalesce(r, 0) + 1 END AS INTEGER) AS retries, o.u IS NULL AS new FROM n LEFT JOIN o ON o.u = n.u""")
def document_states(spark, sf_dir):
    from quern.streaming.ledger import document_state

    i = F.col("page_id")
    rows = table(spark, sf_dir, "pages").select("page_id", F.concat_ws("#", "url", i.cast("string")).alias("url"), F.sha1("html").alias("h"))
    before, now = F.lit("2024-01-01").cast("timestamp"), F.lit(RUN_AT).cast("timestamp")
    old = rows.where(i % 4 != 1).select(
        "url", F.when(i % 3 == 0, "old").otherwise(F.col("h")).alias("sha256"), F.lit("changed").alias("status"), (i % 7).cast("int").alias("retries"), before.alias("first_seen"), before.alias("last_checked"))
    seen = rows.select("url", F.when(i % 5 != 0, F.col("h")).alias("sha256"), (i % 5 != 0).alias("ok"))
    found = document_state(old, seen, now)
    return found.select("url", "sha256", "status", "retries", (F.col("first_seen") == now).alias("new"))
