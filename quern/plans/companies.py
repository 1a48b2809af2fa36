"""Queries of company analytics, text and money."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions import text
from quern.functions.scalars import base_money, host, normal_url, number, safe_divide
from quern.operators import analytics
from quern.plans.common import Registry, money
from quern.session import table

REGISTRY = Registry()
query = REGISTRY.query


@query("""
WITH r AS (SELECT s_suppkey, s_nationkey, s_acctbal, rank() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal) AS k,
  count(*) OVER (PARTITION BY s_nationkey, s_acctbal) AS ties, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier WHERE s_acctbal IS NOT NULL)
SELECT s_suppkey, s_nationkey, round((CAST(k - 1 AS DOUBLE) + CAST(0.5 AS DOUBLE) * ties) / CAST(n AS DOUBLE), 4) AS percentile FROM r""")
def peer_midrank_percentile(spark, sf_dir):
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    return analytics.mid_rank(rows, ["s_nationkey"], "s_acctbal").select("s_suppkey", "s_nationkey", "percentile")


@query("""
SELECT c_mktsegment, count(c_acctbal) AS peers, round(median(c_acctbal), 6) AS median, CASE WHEN count(c_acctbal) >= 2 THEN round(stddev_pop(c_acctbal), 6) END AS deviation
FROM customer GROUP BY c_mktsegment""")
def peer_median_stdev(spark, sf_dir):
    found = analytics.peer_stats(table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal"), ["c_mktsegment"], "c_acctbal")
    return found.select("c_mktsegment", "peers", F.round("median", 6).alias("median"), F.round("deviation", 6).alias("deviation"))


_COMPANIES = """m AS (
  SELECT l_suppkey AS company, CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS operating_cash_flow,
    CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS capex FROM lineitem GROUP BY 1),
k AS (SELECT m.*, s_acctbal * 10000 AS liquidity FROM m JOIN supplier ON company = s_suppkey),
s AS (SELECT k.*, v.scenario, round_even(operating_cash_flow * (1 - v.decline), 0) - round_even(capex * (1 - v.cut), 0) AS f FROM k,
  (VALUES ('cycle', CAST(0.30 AS DOUBLE), CAST(0.15 AS DOUBLE)), ('severe', CAST(0.60 AS DOUBLE), CAST(0.35 AS DOUBLE)), ('crisis', CAST(0.90 AS DOUBLE), CAST(0.50 AS DOUBLE))) v(scenario, decline, cut)),
t AS (SELECT *, greatest(-f, 0.0) AS burn, CASE WHEN -f > 0 THEN liquidity / -f END AS runway FROM s),
u AS (SELECT *, CASE WHEN burn = 0 THEN 'self_funding' WHEN runway >= 5 THEN 'five_years_plus' WHEN runway >= 2 THEN 'two_to_five_years' WHEN runway IS NOT NULL THEN 'under_two_years' END AS band FROM t)"""


def _companies(spark, sf_dir):
    part = lambda c: F.sum(F.when(F.col("l_returnflag") == c, money("l_extendedprice")).otherwise(0)).cast("double")
    flows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("company")).agg(part("A").alias("operating_cash_flow"), part("R").alias("capex"))
    cash = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("company"), (F.col("s_acctbal") * 10000).alias("liquidity"))
    return flows.join(cash, "company")


@query(f"WITH {_COMPANIES} SELECT company, scenario, round(f, 2) AS free_cash_flow, round(runway, 4) AS runway, band FROM u")
def scenario_runway(spark, sf_dir):
    found = analytics.scenarios(_companies(spark, sf_dir))
    return found.select("company", "scenario", F.round("stressed_free_cash_flow", 2).alias("free_cash_flow"), F.round("runway_years", 4).alias("runway"), "band")


_METRICS = _COMPANIES + """,
y AS (SELECT l_suppkey AS company, year(l_shipdate) AS fy, sum(CASE l_returnflag WHEN 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) WHEN 'R' THEN -CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS fcf FROM lineitem GROUP BY ALL),
p AS (SELECT company, count(*) FILTER (fcf > 0) / count(*) AS positive_fcf_ratio FROM y GROUP BY company),
x AS (SELECT u.company, f AS severe_stressed_fcf_usd, runway AS severe_runway_years, band AS severe_band, positive_fcf_ratio, CASE WHEN liquidity > 0 THEN liquidity - capex / 10 END AS net_liquidity_usd,
  operating_cash_flow - capex AS latest_fcf, (operating_cash_flow - capex) / nullif(operating_cash_flow, 0) AS operating_margin,
  (CASE WHEN liquidity > 0 THEN 1 ELSE 0 END + CASE WHEN operating_cash_flow > 0 THEN 1 ELSE 0 END + CASE WHEN capex > 0 THEN 1 ELSE 0 END) / 3 AS data_completeness FROM u JOIN p USING (company) WHERE scenario = 'severe')"""


def _metrics(spark, sf_dir):
    flow = F.when(F.col("l_returnflag") == "A", money("l_extendedprice")).when(F.col("l_returnflag") == "R", -money("l_extendedprice")).otherwise(0)
    yearly = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("company"), F.year("l_shipdate").alias("fy")).agg(F.sum(flow).alias("fcf"))
    positive = yearly.groupBy("company").agg((F.count_if(F.col("fcf") > 0) / F.count("*")).alias("positive_fcf_ratio"))
    severe = analytics.scenarios(_companies(spark, sf_dir)).where("scenario = 'severe'").join(positive, "company")
    cash, capex, liquid = (F.col(c) for c in ("operating_cash_flow", "capex", "liquidity"))
    checks = {"liquidity": liquid > 0, "cash_flow": cash > 0, "capex": capex > 0}
    return analytics.completeness(severe, checks).select(
        "company", F.col("stressed_free_cash_flow").alias("severe_stressed_fcf_usd"), F.col("runway_years").alias("severe_runway_years"), F.col("band").alias("severe_band"),
        "positive_fcf_ratio", F.when(liquid > 0, liquid - capex / 10).alias("net_liquidity_usd"), (cash - capex).alias("latest_fcf"),
        safe_divide(cash - capex, cash).alias("operating_margin"), F.col("completeness").alias("data_completeness"), (F.col("burn") == 0).alias("self_funding"))


def _rule(name: str, value: str, good: str, free: str = "false") -> str:
    return f"SELECT company, '{name}' AS rule, CASE WHEN {free} THEN 'pass' WHEN {value} IS NULL THEN 'unknown' WHEN {value} {good} THEN 'pass' ELSE 'fail' END AS result FROM x"


@query(f"WITH {_METRICS} " + " UNION ALL ".join((
    _rule("severe_self_funding", "severe_stressed_fcf_usd", ">= 0"), _rule("minimum_two_year_runway", "severe_runway_years", ">= 2", "severe_band = 'self_funding'"),
    _rule("fcf_consistency", "positive_fcf_ratio", ">= 0.6"), _rule("net_liquidity_nonnegative", "net_liquidity_usd", ">= 0"),
    _rule("operating_profitability", "operating_margin", "> 0"), _rule("minimum_data_quality", "data_completeness", ">= 0.8"))))
def rule_evaluation_matrix(spark, sf_dir):
    found = analytics.evaluated(_metrics(spark, sf_dir), "company", exempt={"minimum_two_year_runway": F.col("self_funding")})
    return found.select("company", "rule", "result")


@query(f"""
WITH {_METRICS} SELECT company, CASE WHEN severe_band = 'under_two_years' THEN 'vulnerable' WHEN severe_band IN ('two_to_five_years', 'five_years_plus') OR latest_fcf < 0 THEN 'watch'
  WHEN data_completeness < 0.8 THEN 'incomplete' ELSE 'resilient' END AS class FROM x""")
def company_classes(spark, sf_dir):
    return analytics.classified(_metrics(spark, sf_dir)).select("company", "class")


@query(f"""
WITH {_METRICS}, z AS (SELECT CASE WHEN severe_band = 'under_two_years' THEN 'vulnerable' WHEN severe_band IN ('two_to_five_years', 'five_years_plus') OR latest_fcf < 0 THEN 'watch'
  WHEN data_completeness < 0.8 THEN 'incomplete' ELSE 'resilient' END AS class FROM x)
SELECT v.class, count(z.class) AS companies FROM (VALUES ('resilient'), ('watch'), ('vulnerable'), ('incomplete')) v(class) LEFT JOIN z ON z.class = v.class GROUP BY v.class""")
def company_class_counts(spark, sf_dir):
    return analytics.class_counts(analytics.classified(_metrics(spark, sf_dir)))


@query("""
SELECT d.doc_id, CAST((d.text IS NOT NULL AND d.text <> '') AS INTEGER) + CAST((l.quality IS NOT NULL) AS INTEGER) + CAST((d.n_chars > 500) AS INTEGER) AS present,
  (CAST((d.text IS NOT NULL AND d.text <> '') AS INTEGER) + CAST((l.quality IS NOT NULL) AS INTEGER) + CAST((d.n_chars > 500) AS INTEGER)) / 3 AS completeness
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def completeness_ratio(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", (F.col("text") != "").alias("has_text"))
    rows = docs.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    checks = {"text": F.col("has_text"), "label": F.col("quality").isNotNull(), "length": F.col("n_chars") > 500}
    return analytics.completeness(rows, checks).select("doc_id", "present", "completeness")


@query("""SELECT event_id, CAST(props ->> '$.k' AS DOUBLE) AS k FROM events""")
def json_props_scalar(spark, sf_dir):
    k = number(F.get_json_object("props", "$.k"))
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"))


@query(r"""
WITH p AS (SELECT page_id, regexp_replace(url, '#.*$', '') AS u FROM pages), h AS (SELECT *, regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1) AS head FROM p)
SELECT page_id, lower(head) || substr(u, length(head) + 1) AS url, lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]*)', 1)) AS host FROM h""")
def url_host_normalize(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", normal_url(F.col("url")).alias("url"), host(F.col("url")).alias("host"))


@query(r"""
SELECT page_id, unnest(list_filter(regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1), lambda x: trim(x) <> '')) AS link FROM pages""")
def html_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.explode(text.links(F.col("html"))).alias("link"))


@query("""SELECT c_custkey, c_name FROM customer WHERE contains(lower(concat_ws(' ', c_custkey, c_name, c_mktsegment)), 'mach')""")
def text_search(spark, sf_dir):
    where = F.contains(F.lower(F.concat_ws(" ", F.col("c_custkey").cast("string"), "c_name", "c_mktsegment")), F.lit("mach"))
    return table(spark, sf_dir, "customer").where(where).select("c_custkey", "c_name")


@query("""
WITH o AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS v, CASE o_orderkey % 5 WHEN 0 THEN 'USD' WHEN 1 THEN 'JPY_million' WHEN 2 THEN 'USD_billion' WHEN 3 THEN 'EUR' END AS unit FROM orders)
SELECT o_orderkey, unit, CASE WHEN unit IN ('USD', 'USD_billion') THEN 'USD' WHEN unit = 'JPY_million' THEN 'JPY' END AS currency,
  CAST(v * CASE unit WHEN 'USD' THEN 1 WHEN 'JPY_million' THEN 1000000 WHEN 'USD_billion' THEN 1000000000 END AS DOUBLE) AS base_value,
  CASE WHEN unit IS NULL THEN 'missing_unit' WHEN unit = 'EUR' THEN 'unsupported_unit' END AS money_error FROM o""")
def money_unit_normalize(spark, sf_dir):
    at = F.col("o_orderkey") % 5
    unit = F.when(at == 0, "USD").when(at == 1, "JPY_million").when(at == 2, "USD_billion").when(at == 3, "EUR")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", money("o_totalprice").alias("v"), unit.alias("unit"))
    found = base_money(rows, "v", "unit")
    return found.select("o_orderkey", "unit", "currency", F.col("base_value").cast("double").alias("base_value"), "money_error")
