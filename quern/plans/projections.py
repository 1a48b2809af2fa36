"""Queries of small shapes: projections, enumerations, orders, roll-ups, quarters from filings, texts."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.functions import text
from quern.operators import projections
from quern.plans.common import QUARTERS_SQL, Registry, bars, events, money, quarters
from quern.session import table

REGISTRY = Registry()
query = REGISTRY.query


@query("""
WITH b AS (SELECT CASE WHEN event_id % 19 = 0 THEN '' ELSE CAST(CAST(ts AS DATE) AS VARCHAR) END AS date, event_type AS code, CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(value, 2) END AS a, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id % 100 END AS c FROM events)
SELECT date, code, min(coalesce(a, c)) AS close FROM b WHERE date <> '' AND coalesce(a, c) IS NOT NULL GROUP BY ALL""")
def bar_normalization(spark, sf_dir):
    i = F.col("event_id")
    record = F.to_json(F.struct(
        F.when(i % 19 == 0, " ").otherwise(F.col("ts").cast("date").cast("string")).alias("Date"), F.col("event_type").alias("Code"),
        F.when(i % 7 != 0, F.round("value", 2).cast("string")).alias("AdjC"), F.when(i % 5 != 0, i % 100).alias("C")))
    return projections.bars(events(spark, sf_dir).select(record.alias("record")), "record").select("date", "code", "close")


@query("""
SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)""")
def consumer_projection(spark, sf_dir):
    wanted = table(spark, sf_dir, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").alias("c_nationkey"))
    return projections.projection(table(spark, sf_dir, "customer"), "c_nationkey", wanted, ["c_custkey", "c_name", "not_there", "c_mktsegment"])


@query("""
SELECT o_orderkey, 'https://a/data/' || o_custkey || '/' || replace(o_clerk, '#', '') AS source_url, CAST(30 AS INTEGER) AS duration_days, o_orderpriority AS form FROM
  (SELECT o_orderkey, o_custkey, o_orderpriority, 'x#' || o_orderkey AS o_clerk FROM orders)""")
def filing_records(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    facts = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("cik"), F.concat(F.lit("x-"), F.col("o_orderkey").cast("string")).alias("accession"), F.lit("us-gaap").alias("taxonomy"), F.lit("Revenues").alias("concept"),
        F.col("o_orderpriority").alias("form"), day.alias("filed"), F.date_sub(day, 30).alias("period_start"), day.alias("period_end"))
    found = projections.filing_records(facts, "https://a/data")
    return found.select("o_orderkey", "source_url", "duration_days", F.col("provenance.form").alias("form"))


@query("""
SELECT p_partkey, CAST(p_retailprice AS DOUBLE) * 2 AS value, 'derived' AS value_type, 'retail price x 2' AS derivation,
  array_to_string(list_filter([CASE WHEN p_size > 25 THEN 'large' END, CASE WHEN p_retailprice > 1200 THEN 'dear' END, CASE WHEN p_name LIKE '%a%' THEN 'named' END], lambda x: x IS NOT NULL), ',') AS flags FROM part""")
def derived_facts_with_flags(spark, sf_dir):
    found = projections.derived(table(spark, sf_dir, "part"), F.col("p_retailprice").cast("double") * 2, "retail price x 2")
    named = projections.flags({"large": F.col("p_size") > 25, "dear": F.col("p_retailprice") > 1200, "named": F.col("p_name").contains("a")})
    return found.select("p_partkey", "value", "value_type", "derivation", F.array_join(named, ",").alias("flags"))


@query("""
SELECT c_custkey FROM customer WHERE contains(lower(c_name || ' T' || c_custkey), '1') AND c_mktsegment = 'MACHINERY'""")
def company_filter(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.concat(F.lit("T"), F.col("c_custkey").cast("string")).alias("ticker"), F.col("c_mktsegment").alias("role"), F.lit("watch").alias("class"))
    return projections.filtered(rows, " 1 ", "MACHINERY").select("c_custkey")


@query("""
SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 3 = 0""")
def required_ids_of_passed_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderstatus") == "F", "PASS").otherwise("FAIL").alias("status"), (F.col("o_orderkey") % 3).alias("issues"))
    return projections.required_ids(rows, "o_custkey")


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS company, v.o AS operation, v.p || s_suppkey AS path FROM supplier, (VALUES ('financials', '/f/'), ('prices', '/p/')) v(o, p) UNION ALL SELECT NULL, 'master', '/all'""")
def universe_requests(spark, sf_dir):
    universe = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("company"))
    return projections.requests_for(universe, {"financials": "/f/{company}", "prices": "/p/{company}"}, "/all")


@query("""
WITH j AS (SELECT o_custkey, o_orderstatus FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))
SELECT (SELECT count(*) FROM customer) AS companies, (SELECT count(DISTINCT o_custkey) FROM j) AS covered, (SELECT count(*) FROM j) AS rows, (SELECT count(*) FROM customer) - (SELECT count(DISTINCT o_custkey) FROM j) AS missing,
  (SELECT string_agg(s, ',' ORDER BY s) FROM (SELECT o_orderstatus || '=' || count(*) AS s FROM j GROUP BY o_orderstatus)) AS states""")
def universe_rollup(spark, sf_dir):
    universe = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"))
    found = projections.rolled_up(universe, table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus"), "o_custkey", "o_orderstatus")
    shown = F.array_join(F.array_sort(F.transform(F.map_entries("states"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))), ",")
    return found.select("companies", "covered", "rows", "missing", shown.alias("states"))


@query("""
SELECT source AS root, count(*) AS files, CAST(sum(n_chars) AS BIGINT) AS size_bytes FROM documents GROUP BY source""")
def manifest_totals(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("source", F.col("n_chars").alias("size_bytes"))
    return projections.manifest_totals(rows, F.col("source"))


@query("""
SELECT DISTINCT 'lang' AS column, lang AS value FROM documents WHERE lang IS NOT NULL UNION SELECT DISTINCT 'source', source FROM documents WHERE source IS NOT NULL""")
def distinct_values(spark, sf_dir):
    return projections.enumerated(table(spark, sf_dir, "documents").select("lang", "source"), ["lang", "source"])


@query("""
SELECT o_custkey, array_to_string(list_transform(list_sort(list({'d': CAST(o_orderdate AS DATE), 'k': o_orderkey})), lambda x: x.k), ',') AS evidence_ids FROM orders GROUP BY o_custkey""")
def evidence_of_keys(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), "o_orderkey")
    found = projections.evidence_ids(rows, ["o_custkey"], "o_orderkey", "day")
    return found.select("o_custkey", F.array_join(F.col("evidence_ids").cast("array<string>"), ",").alias("evidence_ids"))


@query("""
WITH s AS (SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'under_two_years' WHEN 1 THEN 'two_to_five_years' WHEN 2 THEN 'five_years_plus' WHEN 3 THEN 'self_funding' END AS band, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS runway, nullif(s_suppkey % 4, 0) AS t FROM supplier)
SELECT s_suppkey, CAST(row_number() OVER (ORDER BY CASE band WHEN 'under_two_years' THEN 0 WHEN 'two_to_five_years' THEN 1 WHEN 'five_years_plus' THEN 2 WHEN 'self_funding' THEN 3 ELSE 4 END, runway NULLS LAST, s_suppkey) AS INTEGER) AS place,
  CAST(row_number() OVER (ORDER BY coalesce(CAST(t AS VARCHAR), ''), s_suppkey) AS INTEGER) AS by_text FROM s""")
def display_order(spark, sf_dir):
    k = F.col("s_suppkey")
    band = F.get(F.array(*(F.lit(b) for b in (*projections.BAND_ORDER, None))), (k % 5).cast("int"))
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", band.alias("band"), F.when(k % 3 != 0, F.col("s_acctbal")).alias("runway"), F.nullif(k % 4, F.lit(0)).alias("t"))
    place = lambda order: F.row_number().over(Window.orderBy(*order, F.asc("s_suppkey")))  # noqa: E731  a list that is shown, not a table
    return rows.select("s_suppkey", place(projections.band_order(F.col("band"), F.col("runway"))).alias("place"), place(projections.text_order(["t"])).alias("by_text"))


@query("""
WITH r AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS k FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH'))
SELECT o_custkey, o_orderkey FROM r WHERE k <= 12""")
def newest_filings(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.col("o_orderkey").alias("accession"), F.col("o_orderdate").cast("date").alias("filing_date"), F.col("o_orderpriority").alias("form"))
    return projections.newest_filings(rows, ["o_custkey"], ["1-URGENT", "2-HIGH"]).select("o_custkey", "o_orderkey")


@query("""
WITH f AS (SELECT user_id, event_id % 7 AS item, min(event_id) AS first_at FROM events GROUP BY ALL), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY first_at, item) AS INTEGER) AS place FROM f)
SELECT user_id, item, first_at, place FROM r WHERE place <= 4""")
def compare_list(spark, sf_dir):
    rows = events(spark, sf_dir).select("user_id", (F.col("event_id") % 7).alias("item"), F.col("event_id").alias("first_at"))
    return projections.compare_list(rows, "user_id", "item", "first_at")


@query("""
WITH b AS (SELECT event_type AS code, CAST(ts AS DATE) AS day, count(*) AS volume FROM events GROUP BY ALL)
SELECT code, day, greatest(3.0, round(volume / max(volume) OVER (PARTITION BY code) * 100, 1)) AS height FROM b""")
def chart_heights(spark, sf_dir):
    most = F.max("volume").over(Window.partitionBy("code"))
    return bars(spark, sf_dir).select("code", "day", projections.bar_height(F.col("volume"), most).alias("height"))


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_id % 3 <> 0 AND event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0 AS reused FROM events""")
def evidence_reuse(spark, sf_dir):
    i = F.col("event_id")
    rows = events(spark, sf_dir).select(i.cast("string").alias("event_id"), "user_id", F.col("event_type").alias("document_type"), i.alias("i"))
    rows = rows.withColumn("company_id", F.col("user_id").cast("string")).drop("user_id")
    n = F.col("i")
    seen = rows.select(
        "event_id", F.when(n % 3 == 0, "other").otherwise(F.col("company_id")).alias("company_id"), "document_type", F.when(n % 5 == 0, "FAIL").otherwise("PASS").alias("status"),
        F.when(n % 7 == 0, "ABC").otherwise(F.sha2("event_id", 256)).alias("source_content_sha256"), F.when(n % 11 != 0, 10).alias("source_content_bytes"))
    return projections.reusable(rows.drop("i"), seen).select("event_id", "reused")


_FILINGS_SQL = QUARTERS_SQL + """,
y AS (SELECT entity, fy, fq, min(period_start) OVER w AS period_start, period_end, sum(value) OVER w AS value, count(*) OVER (PARTITION BY entity, fy) AS n FROM q WINDOW w AS (PARTITION BY entity, fy ORDER BY fq)),
f AS (SELECT entity, CASE WHEN fq = 4 THEN '10-K' ELSE '10-Q' END AS form, period_start, period_end, CASE WHEN entity % 5 = 0 AND fy % 3 = 0 AND fq = 2 THEN -value ELSE value END AS value, fy, fq FROM y)"""


def _filings(spark, sf_dir):
    w = Window.partitionBy("entity", "fy").orderBy("fq")
    rows = quarters(spark, sf_dir).withColumns({"period_start": F.min("period_start").over(w), "total": F.sum("value").over(w)})
    bad = (F.col("entity") % 5 == 0) & (F.col("fy") % 3 == 0) & (F.col("fq") == 2)
    return rows.select(
        "entity", F.when(F.col("fq") == 4, "10-K").otherwise("10-Q").alias("form"), "period_start", "period_end", F.when(bad, -F.col("total")).otherwise(F.col("total")).cast("decimal(28,2)").alias("value"),
        F.col("fy").alias("fiscal_year"), "fq")


#: Later filings repeat facts as comparatives, restated; some come twice on one day.
_REPEATED_SQL = _FILINGS_SQL + """,
g AS (SELECT *, period_end + 30 AS filed, 'b' AS accession FROM f UNION ALL SELECT entity, form, period_start, period_end, value + 7, fy + 1, fq, period_end + 395, 'a' FROM f WHERE (entity + fq) % 2 = 0
  UNION ALL SELECT entity, form, period_start, period_end, value + 9, fy, fq, period_end + 30, 'c' FROM f WHERE entity % 3 = 0 UNION ALL SELECT entity, form, period_start, period_end, 1, fy, fq, NULL, 'a' FROM f WHERE entity % 4 = 0)"""


def _repeated(spark, sf_dir):
    rows = _filings(spark, sf_dir)
    own = rows.withColumns({"filed": F.date_add("period_end", 30), "accession": F.lit("b")})
    change = lambda where, value, year, filed, accession: own.where(where).withColumns(
        {"value": value.cast("decimal(28,2)"), "fiscal_year": year, "filed": filed, "accession": F.lit(accession)})
    later, entity, v, y = F.date_add("period_end", 395), F.col("entity"), F.col("value"), F.col("fiscal_year")
    parts = [change((entity + F.col("fq")) % 2 == 0, v + 7, y + 1, later, "a"), change(entity % 3 == 0, v + 9, y, F.col("filed"), "c"),
             change(entity % 4 == 0, F.lit(1), y, F.lit(None).cast("date"), "a")]
    for part in parts:
        own = own.unionByName(part)
    return own


@query(f"""
WITH {_REPEATED_SQL},
h AS (SELECT * FROM g WHERE filed IS NOT NULL QUALIFY row_number() OVER (PARTITION BY entity, form, period_start, period_end ORDER BY filed, accession) = 1),
a AS (SELECT * FROM h WHERE form = '10-K' AND date_diff('day', period_start, period_end) BETWEEN 300 AND 400),
c AS (SELECT a.entity, a.fy, a.period_end AS ye, a.value AS yv, h.period_end, h.value, row_number() OVER (PARTITION BY a.entity, a.period_start, a.period_end ORDER BY h.period_end) AS k, count(*) OVER (PARTITION BY a.entity, a.period_start, a.period_end) AS n
  FROM a JOIN h ON h.entity = a.entity AND h.form = '10-Q' AND h.period_start = a.period_start AND h.period_end < a.period_end AND date_diff('day', h.period_start, h.period_end) BETWEEN 60 AND 300),
w AS (SELECT entity, fy, ye, yv, max(CASE WHEN k = 1 THEN value END) AS v1, max(CASE WHEN k = 2 THEN value END) AS v2, max(CASE WHEN k = 3 THEN value END) AS v3,
  max(CASE WHEN k = 1 THEN period_end END) AS e1, max(CASE WHEN k = 2 THEN period_end END) AS e2, max(CASE WHEN k = 3 THEN period_end END) AS e3 FROM c WHERE n = 3 GROUP BY entity, fy, ye, yv),
z AS (SELECT * FROM w WHERE v1 >= 0 AND v2 >= v1 AND v3 >= v2 AND yv >= v3)
SELECT entity, fy AS fiscal_year, 'Q1' AS fiscal_period, e1 AS period_end, CAST(v1 AS DOUBLE) AS value, 'Q1 year-to-date' AS formula FROM z
UNION ALL SELECT entity, fy, 'Q2', e2, CAST(v2 - v1 AS DOUBLE), 'Q2 year-to-date - Q1 year-to-date' FROM z UNION ALL SELECT entity, fy, 'Q3', e3, CAST(v3 - v2 AS DOUBLE), 'Q3 year-to-date - Q2 year-to-date' FROM z
UNION ALL SELECT entity, fy, 'Q4', ye, CAST(yv - v3 AS DOUBLE), 'FY - Q3 year-to-date' FROM z""")
def quarters_from_filings(spark, sf_dir):
    found = projections.quarters_from_filings(_repeated(spark, sf_dir), ["entity"])
    return found.withColumn("value", F.col("value").cast("double"))


@query(f"""
WITH {_REPEATED_SQL},
r AS (SELECT entity, fy, CASE fq WHEN 4 THEN 'FY' ELSE 'Q' || fq END AS fp, period_start AS s, period_end AS e, value, filed, accession FROM g WHERE filed IS NOT NULL
  UNION ALL SELECT entity, fy, CASE fq WHEN 4 THEN 'FY' ELSE 'Q' || fq END, period_start, period_end, value, period_end + 30, 'b' FROM q WHERE (entity + fy + fq) % 3 = 0),
b AS (SELECT *, date_diff('day', s, e) AS n FROM r),
p AS (SELECT entity, fy, fp, CASE WHEN n BETWEEN 70 AND 110 THEN 'q' WHEN n BETWEEN 150 AND 220 AND fp = 'Q2' THEN 'y' WHEN n BETWEEN 240 AND 300 AND fp = 'Q3' THEN 'y' WHEN n BETWEEN 300 AND 380 AND fp = 'FY' THEN 'y' END AS band,
  max((e, filed, accession, s, value)) AS m FROM b GROUP BY ALL),
t AS (SELECT d.entity, d.fy, v.fp, q.m AS q, y.m AS y, x.m AS x FROM (SELECT DISTINCT entity, fy FROM b) d, (VALUES ('Q1'), ('Q2'), ('Q3'), ('FY')) v(fp)
  LEFT JOIN p q ON q.entity = d.entity AND q.fy = d.fy AND q.fp = v.fp AND q.band = 'q' LEFT JOIN p y ON y.entity = d.entity AND y.fy = d.fy AND y.fp = v.fp AND y.band = 'y'
  LEFT JOIN p x ON x.entity = d.entity AND x.fy = d.fy AND (v.fp, x.fp, x.band) IN (('Q2', 'Q1', 'q'), ('Q3', 'Q2', 'y'), ('FY', 'Q3', 'y'))),
o AS (SELECT entity, fy AS fiscal_year, CASE fp WHEN 'FY' THEN 'Q4' ELSE fp END AS fiscal_period, CASE WHEN q IS NOT NULL THEN q[4] ELSE x[1] + 1 END AS period_start, CASE WHEN q IS NOT NULL THEN q[1] ELSE y[1] END AS period_end,
  CAST(CASE WHEN q IS NOT NULL THEN q[5] ELSE y[5] - x[5] END AS DOUBLE) AS value, CASE WHEN q IS NOT NULL THEN 'reported_quarter' ELSE 'derived_from_reported_periods' END AS value_type
FROM t WHERE q IS NOT NULL OR (y IS NOT NULL AND x IS NOT NULL))
SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY entity, period_start, period_end ORDER BY fiscal_year, fiscal_period DESC) = 1""")
def quarters_by_band(spark, sf_dir):
    name = F.when(F.col("fq") == 4, "FY").otherwise(F.concat(F.lit("Q"), F.col("fq").cast("string")))
    pick = lambda df, fy: df.select("entity", F.col(fy).alias("fiscal_year"), name.alias("fiscal_period"), "period_start", "period_end", "filed", "accession", "value")
    direct = quarters(spark, sf_dir).where((F.col("entity") + F.col("fy") + F.col("fq")) % 3 == 0).withColumns({"filed": F.date_add("period_end", 30), "accession": F.lit("b")})
    rows = pick(_repeated(spark, sf_dir).where(F.col("filed").isNotNull()), "fiscal_year").unionByName(pick(direct, "fy"))
    return projections.quarters_by_band(rows, ["entity"]).withColumn("value", F.col("value").cast("double"))


@query("""
WITH k AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_orderdate AS DATE) END AS d, CASE WHEN o_orderpriority = '5-LOW' THEN 'company_guidance' ELSE 'actual' END AS t,
  CASE o_orderkey % 3 WHEN 0 THEN 'nand_asp_change_qoq' WHEN 1 THEN 'nand_bit_shipments_change_qoq' ELSE 'revenue' END AS c FROM orders),
v AS (SELECT o_custkey, d, c, bool_or(t = 'actual') AS a, bool_or(t <> 'actual') AS g FROM k WHERE c <> 'revenue' AND d IS NOT NULL GROUP BY ALL)
SELECT 'error' AS severity, 'nand_reported_text_missing' AS code, CAST(o_orderkey AS VARCHAR) AS record_id, CAST(NULL AS BIGINT) AS entity_id, CAST(NULL AS DATE) AS period_end FROM k WHERE t = 'actual' AND c <> 'revenue' AND o_orderkey % 7 = 0
UNION ALL SELECT 'error', 'nand_normalization_policy_missing', CAST(o_orderkey AS VARCHAR), NULL, NULL FROM k WHERE t = 'actual' AND c <> 'revenue' AND o_orderkey % 2 = 0 AND o_orderkey % 5 = 0
UNION ALL SELECT 'warning', CASE c WHEN 'nand_asp_change_qoq' THEN 'nand_asp_guidance_not_disclosed' ELSE 'nand_bit_guidance_not_disclosed' END, NULL, o_custkey, d FROM v WHERE a AND NOT g""")
def kpi_audit(spark, sf_dir):
    k = F.col("o_orderkey")
    concept = F.when(k % 3 == 0, "nand_asp_change_qoq").when(k % 3 == 1, "nand_bit_shipments_change_qoq").otherwise("revenue")
    rows = table(spark, sf_dir, "orders").select(
        k.alias("id"), F.when(F.col("o_orderpriority") == "5-LOW", "company_guidance").otherwise("actual").alias("value_type"), concept.alias("concept_id"),
        F.when(k % 7 != 0, "up").alias("reported_text"), F.when(k % 2 == 0, F.array(F.lit("normalized_qualitative_band"))).otherwise(F.array().cast("array<string>")).alias("quality_flags"),
        F.when(k % 5 != 0, "v1").alias("normalization_method"), F.col("o_custkey").alias("entity_id"), F.when(k % 23 != 0, F.col("o_orderdate").cast("date")).alias("period_end"))
    return projections.kpi_audit(rows)


@query("""
WITH m AS (SELECT o_orderkey, o_orderkey % 4 AS c, 1 + o_orderkey % 12 AS mo, 2000 + o_orderkey % 30 AS y, (10 + o_orderkey % 900) / 10.0 AS v FROM orders)
SELECT o_orderkey, CASE WHEN c <> 3 THEN make_date(y, mo, 1) END AS month, CAST(CASE WHEN c <> 3 THEN v END AS DOUBLE) AS value, CASE WHEN c = 3 THEN 'no unambiguous monthly sales fact' END AS error FROM m""")
def monthly_sales(spark, sf_dir):
    k = F.col("o_orderkey")
    figure = F.format_string("%.1f", (10 + k % 900) / 10.0)
    month = F.get(F.array(*map(F.lit, text.MONTHS)), (k % 12).cast("int"))
    year = (2000 + k % 30).cast("string")
    said = F.concat(F.lit("Sales rose. Global semiconductor industry sales, it said, were $"), figure, F.lit(" billion during the month of "), month, F.lit(" "), year, F.lit(". More follows."))
    other = F.concat(F.lit("Worldwide sales reached 5,000 billion in May 2020. Worldwide sales totaled "), figure, F.lit(" billion for "), F.upper(month), F.lit(" "), year, F.lit("!"))
    none = F.lit("Worldwide sales were strong in May 2020. Chip sales were $57 billion in May.")
    found = text.monthly_sales(F.when(k % 4 == 3, none).when(k % 4 == 2, other).otherwise(said))
    return table(spark, sf_dir, "orders").select("o_orderkey", found.alias("_s")).select("o_orderkey", "_s.month", "_s.value", "_s.error")


@query("""
SELECT page_id, 'e' || page_id || ',e' || (page_id + 1) AS ids, 2 AS n FROM pages""")
def rendered_ids(spark, sf_dir):
    i = F.col("page_id")
    html = F.concat(F.lit("<ul><li data-event-id=\"e"), i.cast("string"), F.lit("\">a</li><li class='x' data-event-id='e"), (i + 1).cast("string"), F.lit("'>b</li></ul>"))
    ids = text.ids_of_page(html)
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(ids, ",").alias("ids"), F.size(ids).alias("n"))
