"""Queries of periods, verified metrics and growth."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.functions.scalars import days, duration_band
from quern.operators import growth, periods
from quern.plans.common import QUARTERS_SQL, Registry, money, quarters
from quern.session import table

REGISTRY = Registry()
query = REGISTRY.query
_GAP = "date_diff('day', period_start, period_end)"


@query("""
WITH p AS (SELECT l_suppkey, l_partkey, min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS b FROM lineitem GROUP BY ALL),
d AS (SELECT date_diff('day', a, b) AS days FROM p),
n AS (SELECT CASE WHEN days BETWEEN 70 AND 110 THEN 'quarter' WHEN days BETWEEN 150 AND 220 THEN 'half_year' WHEN days BETWEEN 240 AND 300 THEN 'nine_months'
  WHEN days BETWEEN 300 AND 380 THEN 'annual' END AS band, days FROM d)
SELECT band, count(*) AS periods, CAST(min(days) AS BIGINT) AS shortest, CAST(max(days) AS BIGINT) AS longest FROM n GROUP BY band""")
def period_duration_bands(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    spans = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.min(day).alias("a"), F.max(day).alias("b"))
    rows = spans.select(days(F.col("a"), F.col("b")).alias("days"))
    return rows.groupBy(duration_band(F.col("days")).alias("band")).agg(
        F.count("*").alias("periods"), F.min("days").cast("long").alias("shortest"), F.max("days").cast("long").alias("longest"))


@query(f"""
WITH {QUARTERS_SQL},
y AS (SELECT *, sum(value) OVER (PARTITION BY entity, fy ORDER BY fq) AS ytd, count(*) OVER (PARTITION BY entity, fy) AS n FROM q),
z AS (SELECT *, ytd - coalesce(lag(ytd) OVER (PARTITION BY entity, fy ORDER BY fq), 0) AS quarter_value FROM y)
SELECT entity, fy, fq, CAST(quarter_value AS DOUBLE) AS quarter_value FROM z WHERE n = 4""")
def quarter_from_ytd(spark, sf_dir):
    from pyspark.sql import Window

    to_date = F.sum("value").over(Window.partitionBy("entity", "fy").orderBy("fq"))
    found = periods.quarters_from_cumulative(quarters(spark, sf_dir).withColumn("ytd", to_date), ["entity"], "fy", "fq", "ytd")
    return found.select("entity", "fy", "fq", F.col("quarter_value").cast("double").alias("quarter_value"))


@query(f"""
WITH {QUARTERS_SQL}
SELECT entity, fy, CAST(CASE WHEN count(value) = 4 THEN sum(value) END AS DOUBLE) AS flow, CAST(max(CASE WHEN fq = 4 THEN value END) AS DOUBLE) AS stock,
  count(DISTINCT fq) AS quarters FROM q GROUP BY entity, fy""")
def annual_from_quarters(spark, sf_dir):
    rows = quarters(spark, sf_dir).withColumn("flow", F.col("value")).withColumn("stock", F.col("value"))
    found = periods.annual_from_quarters(rows, ["entity"], "fy", "fq", ["flow"], ["stock"])
    return found.select("entity", "fy", F.col("flow").cast("double").alias("flow"), F.col("stock").cast("double").alias("stock"), "quarters")


@query("""
WITH s AS (SELECT l_suppkey, l_returnflag AS concept, max(CAST(l_shipdate AS DATE)) AS latest_end, count(DISTINCT CAST(l_shipdate AS DATE)) AS periods,
  CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS p FROM lineitem GROUP BY ALL)
SELECT l_suppkey, concept, latest_end, periods FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY latest_end DESC, periods DESC, p) AS rn FROM s) WHERE rn = 1""")
def concept_recency_choice(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_returnflag").alias("concept"), F.col("l_shipdate").cast("date").alias("end"))
    priority = F.when(F.col("concept") == "A", 1).when(F.col("concept") == "N", 2).otherwise(3)
    return periods.recent_concept(rows, ["l_suppkey"], "concept", "end", priority)


@query("""
WITH e AS (SELECT o_orderkey AS k, o_orderpriority FROM orders),
f AS (SELECT CASE WHEN l_orderkey % 9 = 0 THEN -l_orderkey ELSE l_orderkey END AS k, count(DISTINCT l_returnflag) AS n, min(l_returnflag) AS v FROM lineitem GROUP BY 1)
SELECT e.k, o_orderpriority, CASE WHEN n = 1 THEN v END AS value, CASE WHEN n = 1 THEN 'verified' ELSE 'issue' END AS outcome,
  CASE WHEN n IS NULL THEN 'NO_VERIFIED_FLAG' WHEN n > 1 THEN 'AMBIGUOUS_FLAG' END AS issue FROM e LEFT JOIN f ON e.k = f.k""")
def verified_exact_key_join(spark, sf_dir):
    events = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderpriority")
    k = F.col("l_orderkey")
    facts = table(spark, sf_dir, "lineitem").select(F.when(k % 9 == 0, -k).otherwise(k).alias("k"), "l_returnflag")
    return growth.verified(events, facts, ["k"], ["l_returnflag"], "l_returnflag", "FLAG")


#: Facts of filings: every quarter twice, some restated, some with another start, some under another fiscal period's name.
_FACTS_SQL = QUARTERS_SQL + """,
f AS (SELECT entity, fy % 2 AS form, period_start, period_end, value, CASE WHEN entity % 6 = 0 AND fy % 3 = 0 THEN NULL WHEN entity % 6 = 1 AND fy % 3 = 0 THEN 'Q' || (5 - fq) ELSE 'Q' || fq END AS fp FROM q
  UNION ALL SELECT entity, fy % 2, period_start, period_end, value, 'Q' || fq FROM q
  UNION ALL SELECT entity, fy % 2, period_start, period_end, value + 1, 'Q' || fq FROM q WHERE entity % 7 = 0 AND fy % 4 = 1
  UNION ALL SELECT entity, fy % 2, period_start - 5, period_end, value, 'Q' || fq FROM q WHERE entity % 11 = 0 AND fy % 4 = 2
  UNION ALL SELECT entity, 1 - fy % 2, period_start, period_end, 0, 'Q' || fq FROM q WHERE entity % 13 = 0)"""


def _facts(spark, sf_dir):
    q = quarters(spark, sf_dir)
    e, y, own = F.col("entity"), F.col("fy"), F.concat(F.lit("Q"), F.col("fq").cast("string"))
    other = F.when((e % 6 == 0) & (y % 3 == 0), F.lit(None)).when((e % 6 == 1) & (y % 3 == 0), F.concat(F.lit("Q"), (5 - F.col("fq")).cast("string"))).otherwise(own)
    pick = lambda df, form, start, value, fp: df.select("entity", form.alias("form"), start.alias("period_start"), "period_end", value.cast("decimal(28,2)").alias("value"), fp.alias("fp"))
    start, value = F.col("period_start"), F.col("value")
    parts = [pick(q, y % 2, start, value, other), pick(q, y % 2, start, value, own), pick(q.where((e % 7 == 0) & (y % 4 == 1)), y % 2, start, value + 1, own),
             pick(q.where((e % 11 == 0) & (y % 4 == 2)), y % 2, F.date_sub(start, 5), value, own), pick(q.where(e % 13 == 0), 1 - y % 2, start, F.lit(0), own)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _growth(low: int, high: int, fits: str, keys: tuple[str, ...], fp: str, label: str) -> str:
    same = " AND ".join(f"p.{k} = c.{k}" for k in keys)
    cols = ", ".join(keys)
    hundredths = "CAST(CAST({} AS DECIMAL(28,2)) * 100 AS HUGEINT)"
    d, b = hundredths.format("(value - pv)"), hundredths.format("abs(pv)")
    return f"""(
WITH c AS (SELECT DISTINCT {cols}, period_start, period_end, value, fp FROM f),
s AS (SELECT {cols}, period_end, value, count(DISTINCT period_start) AS starts FROM c GROUP BY ALL),
m AS (SELECT c.*, (SELECT starts FROM s p WHERE {same} AND p.period_end = c.period_end AND p.value = c.value) AS starts, {fits} AS fits,
  (SELECT list(DISTINCT (p.period_start, p.period_end, p.value)) FROM c p WHERE {same} AND date_diff('day', p.period_end, c.period_end) BETWEEN {low} AND {high}
   AND abs(date_diff('day', c.period_start, c.period_end) - date_diff('day', p.period_start, p.period_end)) <= 7 {fp}) AS found FROM c),
n AS (SELECT *, coalesce(len(found), 0) AS n, found[1][2] AS pe, found[1][3] AS pv FROM m),
r AS (SELECT *, CASE WHEN starts > 1 THEN 'AMBIGUOUS_CURRENT' WHEN NOT fits THEN 'OUTSIDE_LENGTH' WHEN n = 0 THEN 'NO_COMPARABLE_PERIOD' WHEN n > 1 THEN 'AMBIGUOUS_PRIOR'
  WHEN pv = 0 THEN 'ZERO_PRIOR' END AS reason FROM n)
SELECT {cols}, period_start, period_end, fp, CAST(value AS DOUBLE) AS value, CASE WHEN reason IS NULL THEN pe END AS prior_end,
  CASE WHEN reason IS NULL THEN CAST((CASE WHEN value < pv THEN -1 ELSE 1 END) * ((2 * abs({d}) * 1000000 + {b}) // (2 * {b})) AS DOUBLE) / 10000 END AS percent,
  CASE WHEN reason IS NULL THEN 'growth' WHEN reason IN ('OUTSIDE_LENGTH', 'NO_COMPARABLE_PERIOD') THEN 'not_calculated' ELSE 'issue' END AS outcome, reason{label} FROM r)"""


_FP = "AND (p.fp IS NULL OR c.fp IS NULL OR p.fp = c.fp)"
_YOY = lambda label: _growth(350, 380, "true", ("entity", "form"), _FP, label)
_QOQ = lambda label: _growth(70, 110, "date_diff('day', c.period_start, c.period_end) BETWEEN 70 AND 110", ("entity", "form"), _FP, label)


def _shown(found, *more):
    numbers = {"value": F.col("value").cast("double"), "percent": F.col("percent").cast("double")}
    return found.withColumns(numbers).select("entity", "form", "period_start", "period_end", "fp", "value", "prior_end", "percent", "outcome", "reason", *more)


@query(f"WITH {_FACTS_SQL} SELECT * FROM {_YOY('')}")
def growth_yoy_band_join(spark, sf_dir):
    return _shown(growth.year_on_year(_facts(spark, sf_dir), ["entity", "form"], ["fp"]))


@query(f"""WITH {_FACTS_SQL.replace("'Q' || fq", "'Q'").replace("'Q' || (5 - fq)", "'Q'")} SELECT * FROM {_QOQ('')}""")
def growth_qoq_with_reasons(spark, sf_dir):
    facts = _facts(spark, sf_dir).withColumn("fp", F.when(F.col("fp").isNotNull(), "Q"))
    return _shown(growth.compared(facts, facts, ["entity", "form"], growth.QUARTER, growth.QUARTER, ["fp"]))


#: Verified metrics, a quarter each, and the actuals of their filings: the quarter, that of the year before as a comparative, and odd ones.
_ACTUALS_SQL = QUARTERS_SQL + """,
m AS (SELECT entity || '-' || fy || '-' || fq AS event_id, entity AS company_id, fy || '-' || fq AS accession_number, CASE fq WHEN 4 THEN '10-K' ELSE '10-Q' END AS document_type, period_start, period_end,
  CASE WHEN entity % 13 = 0 AND fq = 1 THEN 0 ELSE value END AS value, fy, fq FROM q),
a AS (SELECT company_id, accession_number, document_type, period_start, period_end, value, CASE WHEN company_id % 17 = 0 AND fq = 2 THEN 'EUR' ELSE 'USD' END AS unit FROM m
  UNION ALL SELECT company_id, (fy + 1) || '-' || fq, document_type, period_start, period_end, value + CASE WHEN company_id % 5 = 0 THEN 3 ELSE 0 END, 'USD' FROM m
  UNION ALL SELECT company_id, 'x', document_type, period_start, period_end, value + 1, 'USD' FROM m WHERE company_id % 7 = 0
  UNION ALL SELECT company_id, accession_number, document_type, period_start - 5, period_end, value, 'USD' FROM m WHERE company_id % 11 = 0 AND fq = 3)"""


def _actuals(spark, sf_dir):
    e, fq, fy = F.col("company_id"), F.col("fq"), F.col("fy")
    text = lambda c: c.cast("string")
    filing = lambda year: F.concat_ws("-", text(year), text(fq))
    own = quarters(spark, sf_dir).withColumnRenamed("entity", "company_id").withColumns({
        "event_id": F.concat_ws("-", text(e), text(fy), text(fq)), "concept": F.lit("R"), "accession_number": filing(fy), "document_type": F.when(fq == 4, "10-K").otherwise("10-Q"),
        "value": F.when((e % 13 == 0) & (fq == 1), F.lit(0)).otherwise(F.col("value")).cast("decimal(28,2)"), "unit": F.lit("USD")})
    value = lambda c: c.cast("decimal(28,2)")
    actuals = own.withColumn("unit", F.when((e % 17 == 0) & (fq == 2), "EUR").otherwise("USD"))
    for part in (own.withColumns({"accession_number": filing(fy + 1), "value": value(F.col("value") + F.when(e % 5 == 0, 3).otherwise(0))}),
                 own.where(e % 7 == 0).withColumns({"accession_number": F.lit("x"), "value": value(F.col("value") + 1)}),
                 own.where((e % 11 == 0) & (fq == 3)).withColumn("period_start", F.date_sub("period_start", 5))):
        actuals = actuals.unionByName(part)
    return own, actuals.withColumn("duration_days", F.datediff("period_end", "period_start"))


_HUNDREDTHS = "CAST(CAST({} AS DECIMAL(28,2)) * 100 AS HUGEINT)"


def _persisted(name: str, word: str, low: int, high: int, more: str, fits: str) -> str:
    d, b = _HUNDREDTHS.format("(value - pv)"), _HUNDREDTHS.format("abs(pv)")
    return f"""SELECT event_id, '{name}' AS growth_type, CASE WHEN reason IS NULL THEN pe END AS prior_end,
  CASE WHEN reason IS NULL THEN CAST((CASE WHEN value < pv THEN -1 ELSE 1 END) * ((2 * abs({d}) * 1000000 + {b}) // (2 * {b})) AS DOUBLE) / 10000 END AS percent, reason FROM (
  SELECT *, CASE WHEN NOT ({fits}) THEN 'CURRENT_FACT_NOT_STANDALONE_QUARTER' WHEN n = 0 THEN 'NO_COMPARABLE_PRIOR_{word}_ACTUAL' WHEN n > 1 THEN 'AMBIGUOUS_PRIOR_{word}_ACTUAL' WHEN pv = 0 THEN 'ZERO_OR_INVALID_PRIOR_VALUE' END AS reason
  FROM (SELECT *, coalesce(len(found), 0) AS n, found[1][2] AS pe, found[1][3] AS pv FROM (
    SELECT c.*, (SELECT list(DISTINCT (p.period_start, p.period_end, p.value)) FROM a p WHERE p.company_id = c.company_id AND p.unit = 'USD' AND date_diff('day', p.period_end, c.period_end) BETWEEN {low} AND {high}
      AND abs(c.duration - date_diff('day', p.period_start, p.period_end)) <= 7 {more}) AS found FROM c WHERE starts = 1)))"""


@query(f"""
WITH {_ACTUALS_SQL},
c AS (SELECT m.event_id, m.company_id, m.accession_number, m.period_end, m.value, count(DISTINCT a.period_start) AS starts, date_diff('day', min(a.period_start), m.period_end) AS duration FROM m LEFT JOIN a
  ON a.company_id = m.company_id AND a.unit = 'USD' AND a.accession_number = m.accession_number AND a.document_type = m.document_type AND a.period_end = m.period_end AND a.value = m.value GROUP BY m.event_id, m.company_id, m.accession_number, m.period_end, m.value)
SELECT event_id, NULL AS growth_type, CAST(NULL AS DATE) AS prior_end, CAST(NULL AS DOUBLE) AS percent, 'AMBIGUOUS_CURRENT_PERSISTED_ACTUAL' AS reason FROM c WHERE starts <> 1
UNION ALL {_persisted('QoQ', 'QUARTER', 70, 110, '', 'duration BETWEEN 70 AND 110')} UNION ALL {_persisted('YoY', 'YEAR', 350, 380, 'AND p.accession_number = c.accession_number', 'true')}""")
def persisted_growth(spark, sf_dir):
    return growth.persisted(*_actuals(spark, sf_dir)).select("event_id", "growth_type", "prior_end", "percent", "reason")


@query("""
WITH a AS (SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END) AS DOUBLE) AS value, nullif(min(o_orderpriority), '5-LOW') AS basis FROM orders GROUP BY ALL),
l AS (SELECT *, row_number() OVER w > 1 AND lag(basis) OVER w IS NOT DISTINCT FROM basis AS comparable, lag(value) OVER w AS prior_value FROM a WINDOW w AS (PARTITION BY o_custkey ORDER BY year))
SELECT o_custkey, year, prior_value, CASE WHEN NOT comparable THEN 'no_comparable_prior_period' WHEN value IS NULL OR prior_value IS NULL OR prior_value = 0 THEN 'missing_or_zero_prior_revenue' END AS null_reason,
  CASE WHEN comparable AND prior_value <> 0 THEN round(value / prior_value - 1, 8) END AS ratio FROM l""")
def adjacent_year_gate(spark, sf_dir):
    price = F.when(F.col("o_orderstatus") == "P", F.lit(0).cast("decimal(18,2)")).otherwise(money("o_totalprice"))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(price).cast("double").alias("value"), F.nullif(F.min("o_orderpriority"), F.lit("5-LOW")).alias("basis"))
    found = periods.adjacent_years(rows, ["o_custkey"], "year", "value", ["basis"])
    return found.select("o_custkey", "year", "prior_value", "null_reason", F.round("ratio", 8).alias("ratio"))


@query(f"""
WITH {QUARTERS_SQL}, y AS (SELECT *, sum(value) OVER (PARTITION BY entity, fy ORDER BY fq) AS ytd, CASE WHEN fq IN (1, 3) THEN value END AS direct FROM q),
z AS (SELECT *, CASE WHEN fq = 1 THEN ytd ELSE ytd - lag(ytd) OVER (PARTITION BY entity, fy ORDER BY fq) END AS derived FROM y)
SELECT entity, fy, fq, CAST(coalesce(direct, derived) AS DOUBLE) AS quarter_value, CASE WHEN direct IS NOT NULL THEN 'direct' WHEN derived IS NOT NULL THEN 'derived' END AS method FROM z""")
def direct_or_derived_quarter(spark, sf_dir):
    from pyspark.sql import Window

    rows = quarters(spark, sf_dir).withColumn("ytd", F.sum("value").over(Window.partitionBy("entity", "fy").orderBy("fq")))
    rows = rows.withColumn("direct", F.when(F.col("fq").isin(1, 3), F.col("value")))
    found = periods.direct_or_derived(rows, ["entity"], "fy", "fq", "direct", "ytd")
    return found.select("entity", "fy", "fq", F.col("quarter_value").cast("double").alias("quarter_value"), "method")


@query(f"""
WITH {QUARTERS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period_end DESC) AS k FROM q)
SELECT entity, period_end, CAST(value AS DOUBLE) AS value FROM r WHERE k <= 8""")
def last_eight_quarters(spark, sf_dir):
    found = periods.latest_periods(quarters(spark, sf_dir), ["entity"], "period_end", 8)
    return found.select("entity", "period_end", F.col("value").cast("double").alias("value"))


@query("""
WITH f AS (SELECT l_suppkey AS entity, l_returnflag AS c, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start, CAST(last_day(l_shipdate) AS DATE) AS period_end,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS value FROM lineitem GROUP BY ALL)
SELECT a.entity, a.period_start, a.period_end, a.value AS revenue, b.value AS cash_flow, r.value AS balance FROM f a
JOIN f b ON a.entity = b.entity AND a.period_start = b.period_start AND a.period_end = b.period_end AND b.c = 'N'
LEFT JOIN (SELECT * FROM f WHERE c = 'R' AND month(period_end) % 3 = 0) r ON a.entity = r.entity AND a.period_end = r.period_end WHERE a.c = 'A'""")
def aligned_periods(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    facts = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("entity"), F.col("l_returnflag").alias("c"), F.trunc(day, "month").alias("period_start"), F.last_day(day).alias("period_end")
    ).agg(F.sum(money("l_extendedprice")).cast("double").alias("value"))
    part = lambda c: facts.where(F.col("c") == c).drop("c")
    balance = part("R").where(F.month("period_end") % 3 == 0).drop("period_start")
    return periods.aligned({"revenue": part("A"), "cash_flow": part("N")}, {"balance": balance}, ["entity"], "period_end")


@query("""
WITH a AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey ELSE o_orderkey END AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS v, year(o_orderdate) AS y FROM orders),
b AS (SELECT CASE WHEN o_orderkey % 4 = 0 THEN -2 * o_orderkey ELSE o_orderkey END AS k, CAST(o_orderkey * (1 - 2 * (o_orderkey % 2)) AS DECIMAL(18,2)) AS v, CASE WHEN o_orderkey % 9 = 0 THEN 1900 ELSE year(o_orderdate) END AS y FROM orders),
j AS (SELECT coalesce(a.k, b.k) AS k, a.v AS av, b.v AS bv, CASE WHEN a.k IS NULL THEN 'MISSING_OPERATING_CASH_FLOW' WHEN b.k IS NULL THEN 'MISSING_CAPITAL_EXPENDITURE'
  WHEN a.y <> b.y THEN 'PERIOD_MISMATCH' END AS issue FROM a FULL JOIN b ON a.k = b.k)
SELECT k, CAST(CASE WHEN issue IS NULL THEN av - bv END AS DOUBLE) AS value, CAST(CASE WHEN issue IS NULL THEN av - abs(bv) END AS DOUBLE) AS by_magnitude, issue FROM j""")
def free_cash_flow(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), money("o_totalprice").alias("v"), F.year("o_orderdate").alias("y"))
    side = lambda key, value, y: rows.select(key.alias("k"), value.alias("value"), y.alias("period_start"), y.alias("period_end"))
    k = F.col("k")
    cash = side(F.when(k % 5 == 0, -k).otherwise(k), F.col("v"), F.col("y"))
    capex = side(F.when(k % 4 == 0, -2 * k).otherwise(k), (k * (1 - 2 * (k % 2))).cast("decimal(18,2)"), F.when(k % 9 == 0, 1900).otherwise(F.col("y")))
    both = growth.free_cash_flow(cash, capex, ["k"]).join(growth.free_cash_flow(cash, capex, ["k"], magnitude=True).select("k", F.col("value").alias("by_magnitude")), "k")
    return both.select("k", F.col("value").cast("double").alias("value"), F.col("by_magnitude").cast("double").alias("by_magnitude"), "issue")
