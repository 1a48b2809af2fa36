"""Queries of market series and banded disclosures."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.operators import intervals, positioning
from quern.plans.common import BARS_SQL, Registry, bars, events, money
from quern.session import table

REGISTRY = Registry()
query = REGISTRY.query
_BY_USER = (["user_id"], ["ts", "event_id"])
_W = "PARTITION BY user_id ORDER BY ts, event_id"


@query(f"""
SELECT user_id, event_id, round(avg(value) OVER w20, 6) AS mean_20, round(avg(value) OVER w5, 6) AS mean_5 FROM events
WINDOW w20 AS ({_W} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), w5 AS ({_W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def rolling_mean_20(spark, sf_dir):
    mean = lambda n: F.round(positioning.trailing_mean("value", *_BY_USER, n), 6)
    return events(spark, sf_dir).select("user_id", "event_id", mean(20).alias("mean_20"), mean(5).alias("mean_5"))


@query(f"""
SELECT user_id, event_id, round((1 - value / nullif(max(value) OVER ({_W} ROWS BETWEEN 59 PRECEDING AND CURRENT ROW), 0)) * 100, 6) AS drawdown FROM events""")
def drawdown_60(spark, sf_dir):
    fall = positioning.drawdown_percent("value", *_BY_USER, 60)
    return events(spark, sf_dir).select("user_id", "event_id", F.round(fall, 6).alias("drawdown"))


@query(f"""
WITH {BARS_SQL}, p AS (SELECT code, close, max(close) OVER (PARTITION BY code ORDER BY day) AS peak FROM b)
SELECT code, round(min((close / peak - 1) * 100), 6) AS max_drawdown FROM p GROUP BY code""")
def max_drawdown(spark, sf_dir):
    found = positioning.max_drawdown(bars(spark, sf_dir), ["code"], ["day"], "close")
    return found.select("code", F.round("max_drawdown", 6).alias("max_drawdown"))


@query("""
SELECT p.event_id, p.user_id, v.event_id AS asof_view_id, v.value AS asof_view_value
FROM (SELECT * FROM events WHERE event_type = 'purchase') p ASOF LEFT JOIN (SELECT * FROM events WHERE event_type = 'view') v
ON p.user_id = v.user_id AND p.ts >= v.ts""")
def asof_last_view(spark, sf_dir):
    rows = events(spark, sf_dir)
    seen = rows.where("event_type = 'view'").select("user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value"))
    asked = rows.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return positioning.as_of(asked, seen, ["user_id"], "ts", ["view_id", "view_value"], "view_id").drop("ts")


@query("""
WITH d AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS v FROM orders GROUP BY ALL)
SELECT p, day, round(v / first_value(v) OVER (PARTITION BY p, year(day) ORDER BY day) * 100, 6) AS index FROM d""")
def calendar_year_index(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("p"), F.col("o_orderdate").cast("date").alias("day")).agg(
        F.sum(money("o_totalprice")).cast("double").alias("v"))
    return positioning.year_index(rows, ["p"], "day", "v").select("p", "day", F.round("index", 6).alias("index"))


@query(f"""
WITH {BARS_SQL} SELECT code, day, round((close / lag(close) OVER (PARTITION BY code ORDER BY day) - 1) * 100, 6) AS change FROM b""")
def wow_change(spark, sf_dir):
    change = positioning.change_percent("close", ["code"], ["day"])
    return bars(spark, sf_dir).select("code", "day", F.round(change, 6).alias("change"))


@query(f"""
WITH {BARS_SQL}, l AS (SELECT code, CASE WHEN close > 0 AND lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END AS r FROM b WINDOW w AS (PARTITION BY code ORDER BY day))
SELECT code, count(r) AS returns, round(stddev_samp(r) * sqrt(252) * 100, 6) AS volatility FROM l GROUP BY code""")
def log_return_volatility(spark, sf_dir):
    found = positioning.volatility(bars(spark, sf_dir), ["code"], ["day"], "close")
    return found.select("code", "returns", F.round("volatility", 6).alias("volatility"))


@query(f"""
WITH {BARS_SQL}, r AS (SELECT code, day, close, round((close / lag(close, 5) OVER w - 1) * 100, 6) AS return_5, round((close / lag(close, 20) OVER w - 1) * 100, 6) AS return_20,
  round((close / lag(close, 63) OVER w - 1) * 100, 6) AS return_63, row_number() OVER (PARTITION BY code ORDER BY day DESC) AS k FROM b WINDOW w AS (PARTITION BY code ORDER BY day))
SELECT code, day, return_5, return_20, return_63 FROM r WHERE k = 1""")
def trailing_returns(spark, sf_dir):
    found = positioning.trailing_returns(bars(spark, sf_dir), ["code"], ["day"], "close", [5, 20, 63])
    return found.select("code", "day", *(F.round(f"return_{n}", 6).alias(f"return_{n}") for n in (5, 20, 63)))


@query(f"""
WITH {BARS_SQL}, m AS (SELECT code, day, avg(volume) OVER (PARTITION BY code ORDER BY day ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS mean_volume FROM b),
p AS (SELECT code, day, volume * 3 AS shares FROM b WHERE dayofweek(day) = 5)
SELECT p.code, p.day, p.shares, round(p.shares / m.mean_volume, 6) AS days FROM p JOIN m ON p.code = m.code AND p.day = m.day""")
def days_to_cover(spark, sf_dir):
    rows = bars(spark, sf_dir)
    positions = rows.where(F.dayofweek("day") == 6).select("code", "day", (F.col("volume") * 3).alias("shares"))
    found = positioning.days_to_cover(positions, rows.select("code", "day", "volume"), ["code"], "day")
    return found.select("code", "day", "shares", F.round("days", 6).alias("days"))


@query(f"""
WITH {BARS_SQL} SELECT a.day, round(a.close / b.close, 6) AS ratio FROM b a JOIN b ON a.day = b.day AND a.code = 'purchase' AND b.code = 'view'""")
def same_day_ratio(spark, sf_dir):
    rows = bars(spark, sf_dir)
    a = rows.where("code = 'purchase'").select("day", F.col("close").alias("a"))
    b = rows.where("code = 'view'").select("day", F.col("close").alias("b"))
    return a.join(b, "day").select("day", F.round(F.try_divide("a", "b"), 6).alias("ratio"))


_CHANGES = """c AS (
  SELECT o_orderpriority AS p, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS day, CAST(count(*) % 7 AS DOUBLE) / 100 AS low, CAST(count(*) % 7 + 2 AS DOUBLE) / 100 AS high
  FROM orders GROUP BY ALL)"""


def _changes(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(
        F.col("o_orderpriority").alias("p"), F.trunc(F.col("o_orderdate").cast("date"), "quarter").alias("day")
    ).agg((F.count("*") % 7 / 100).alias("low"), ((F.count("*") % 7 + 2) / 100).alias("high"))


@query(f"""
WITH {_CHANGES}, g AS (SELECT *, date_diff('day', lag(day) OVER (PARTITION BY p ORDER BY day), day) AS gap, row_number() OVER (PARTITION BY p ORDER BY day) AS k FROM c),
w AS (SELECT *, min(gap) OVER f AS lo, max(gap) OVER f AS hi, exp(sum(ln(1 + low)) OVER r) - 1 AS cl, exp(sum(ln(1 + high)) OVER r) - 1 AS ch FROM g
  WINDOW f AS (PARTITION BY p ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), r AS (PARTITION BY p ORDER BY day ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
SELECT p, day, CASE WHEN k >= 4 AND lo >= 70 AND hi <= 120 THEN round(cl, 6) END AS compound_low, CASE WHEN k >= 4 AND lo >= 70 AND hi <= 120 THEN round(ch, 6) END AS compound_high FROM w""")
def compound_4(spark, sf_dir):
    found = intervals.compounded(_changes(spark, sf_dir), ["p"], "day", "low", "high")
    return found.select("p", "day", F.round("compound_low", 6).alias("compound_low"), F.round("compound_high", 6).alias("compound_high"))


@query(f"""
WITH {_CHANGES}, i AS (SELECT day, p, CASE WHEN p <> '2-HIGH' THEN low END AS lo, CASE WHEN p <> '2-HIGH' THEN high END AS hi, CASE WHEN p IN ('2-HIGH', '4-NOT SPECIFIED') THEN high END AS v,
  CASE WHEN p IN ('1-URGENT', '2-HIGH') THEN 'actual' WHEN p IN ('4-NOT SPECIFIED', '5-LOW') THEN 'company_guidance' ELSE 'internal_estimate' END AS t FROM c WHERE NOT (p = '5-LOW' AND low = 0)),
j AS (SELECT day, t, coalesce(lo, v) AS low, coalesce(hi, v) AS high FROM i QUALIFY row_number() OVER (PARTITION BY day, t ORDER BY p DESC) = 1),
a AS (SELECT * FROM j WHERE t = 'actual'), b AS (SELECT * FROM j WHERE t = 'company_guidance')
SELECT a.day, CASE WHEN a.low > b.high THEN 'above' WHEN a.high < b.low THEN 'below' ELSE 'overlap' END AS relation,
  round(a.low - b.high, 8) AS difference_low, round(a.high - b.low, 8) AS difference_high FROM a JOIN b ON a.day = b.day""")
def interval_compare(spark, sf_dir):
    p = F.col("p")
    bound = lambda c: F.when(p != "2-HIGH", F.col(c))
    kind = F.when(p.isin("1-URGENT", "2-HIGH"), "actual").when(p.isin("4-NOT SPECIFIED", "5-LOW"), "company_guidance").otherwise("internal_estimate")
    rows = _changes(spark, sf_dir).where(~((p == "5-LOW") & (F.col("low") == 0))).select(
        "day", "p", bound("low").alias("value_low"), bound("high").alias("value_high"), F.when(p.isin("2-HIGH", "4-NOT SPECIFIED"), F.col("high")).alias("value"), kind.alias("value_type"))
    found = intervals.against_guidance(rows, ["day"], "p")
    return found.select("day", "relation", F.round("difference_low", 8).alias("difference_low"), F.round("difference_high", 8).alias("difference_high"))


#: Fixed phrases, their direction, and the interval that each stands for.
PHRASES = (
    ("up a mid-single-digit percentage", "increase", 0.04, 0.06), ("mid single digit", "decline", -0.06, -0.04), ("mid-to-high-single-digit increase", "increase", 0.04, 0.09),
    ("in the mid-teens percent range", "increase", 0.14, 0.16), ("high-70s", "increase", 0.77, 0.79), ("Low–to–mid  80s", "decrease", -0.86, -0.81),
    ("increased 12.5%", "increase", 0.125, 0.125), ("about 3 %", "down", -0.035, -0.025), ("around 0.2%", "increase", 0.0, 0.007),
    ("low-double-digit", "increase", 0.10, 0.13), ("high double-digit percentage", "decline", -0.19, -0.17), ("teens", "increase", None, None),
    ("single digit growth", "increase", None, None), ("no figure here", "decline", None, None),
)


def _number(x: float | None) -> str:
    return "NULL" if x is None else f"CAST({x} AS DOUBLE)"


@query("SELECT o_orderkey, phrase, low, high, low IS NULL AS unread FROM orders JOIN (VALUES " + ", ".join(
    f"({i}, '{p}', {_number(a)}, {_number(b)})" for i, (p, _, a, b) in enumerate(PHRASES)) + f") v(i, phrase, low, high) ON i = o_orderkey % {len(PHRASES)}")
def qualitative_band(spark, sf_dir):
    pick = lambda at: F.get(F.array(*(F.lit(p[at]) for p in PHRASES)), (F.col("o_orderkey") % len(PHRASES)).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", pick(0).alias("phrase"), pick(1).alias("direction"))
    read = rows.select("o_orderkey", "phrase", intervals.phrase_band(F.col("phrase"), F.col("direction")).alias("_b"))
    return read.select("o_orderkey", "phrase", "_b.low", "_b.high", F.col("_b.error").isNotNull().alias("unread"))
