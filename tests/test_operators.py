"""Operators on literal rows: boundaries, ties, and inputs that must not pass."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from quern.functions import scalars as S
from quern.functions import text as T
from quern.operators import analytics, audits, growth, intervals, keyed, lineage, periods, positioning


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


def test_ids_and_urls(spark):
    r = one(
        spark, S.stable_id(F.lit("a"), F.lit(None), F.lit(3)).alias("a"), F.substring(F.sha2(F.lit("a||3"), 256), 1, 24).alias("b"),
        S.normal_url(F.lit("HTTPS://Ex.COM/Path?q=1#frag")).alias("u"), S.normal_url(F.lit("nonsense")).alias("n"),
        S.allowed_url(F.lit("https://a.gov/x"), ["a.gov"]).alias("ok"), S.allowed_url(F.lit("http://a.gov/x"), ["a.gov"]).alias("no"),
        S.single_query_value(F.lit("https://a/?CIK=12&x=1"), "CIK").alias("k"), S.single_query_value(F.lit("https://a/?CIK=1&CIK=2"), "CIK").alias("kk"),
        S.filing_url("https://a/data", F.lit("0000320193"), F.lit("0001-23-4")).alias("f"), S.padded_cik(F.lit(320193)).alias("p"))
    assert r.a == r.b and r.u == "https://ex.com/Path?q=1" and r.n is None and r.ok and not r.no
    assert (r.k, r.kk, r.f, r.p) == ("12", None, "https://a/data/320193/0001234", "0000320193")


def test_dates(spark):
    r = one(
        spark, S.utc_text(S.instant(F.lit("2024-01-01T09:00:00+09:00"))).alias("z"), S.instant(F.lit("2024-01-01T00:00:00")).alias("zoneless"),
        S.any_date(F.lit("20240229")).alias("a"), S.any_date(F.lit("March 5, 2024")).alias("b"), S.any_date(F.lit("2024-02-30")).alias("c"),
        S.url_date(F.lit("https://x/2024/05/31/doc")).alias("u"), S.url_date(F.lit("https://x/20241399")).alias("v"),
        S.duration_band(F.lit(110)).alias("q"), S.duration_band(F.lit(111)).alias("none"), S.days(F.lit(date(2024, 1, 1)), F.lit(date(2024, 1, 31)), True).alias("d"))
    assert (r.z, r.zoneless, r.a, r.b, r.c) == ("2024-01-01T00:00:00Z", None, date(2024, 2, 29), date(2024, 3, 5), None)
    assert (r.u, r.v, r.q, r.none, r.d) == (date(2024, 5, 31), None, "quarter", None, 31)


def test_arithmetic(spark):
    r = one(
        spark, S.percent_change(F.lit(23232690000), F.lit(18435591000)).cast("string").alias("p"), S.percent_change(F.lit(1), F.lit(-2)).cast("string").alias("neg"),
        S.percent_change(F.lit(1), F.lit(0)).alias("zero"), S.ratio_change(F.lit(1), F.lit(-2)).alias("ratio"), S.safe_divide(F.lit(1), F.lit(0)).alias("inf"),
        S.growth_rate(F.lit(100.0), F.lit(121.0), F.lit(2)).alias("g"), S.growth_rate(F.lit(-1.0), F.lit(1.0), F.lit(2)).alias("gn"),
        S.number(F.lit("1,234.5")).alias("n"), S.number(F.lit("NaN")).alias("nan"), S.security_code(F.lit("72030")).alias("c"))
    assert (r.p, r.neg, r.zero, r.ratio, r.inf) == ("26.0209", "150.0000", None, -1.5, None)
    assert r.g == pytest.approx(0.1) and r.gn is None and (r.n, r.nan, r.c) == (1234.5, None, "7203")


def test_money(spark):
    rows = spark.createDataFrame([(2.5, "USD_million"), (15000.0, "JPY"), (1.0, None), (1.0, "EUR")], "v double, unit string")
    found = S.base_money(rows, "v", "unit")
    assert [(float(r.base_value) if r.base_value is not None else None, r.money_error) for r in found.collect()] == [
        (2_500_000, None), (15_000, None), (None, "missing_unit"), (None, "unsupported_unit")]
    rates = spark.createDataFrame([("JPY", "USD", 150.0)], "currency string, quote string, rate double")
    got = S.convert(found.where("money_error is null"), rates, "USD").collect()
    assert [float(r.converted) for r in got] == [2_500_000, 100]
    assert S.convert(found.limit(2), rates.limit(0), "USD").where("rate_error = 'missing_rate'").count() == 1


def test_ties_differ_by_operator(spark):
    rows = spark.createDataFrame([("a", 1, "x", None), ("a", 2, None, "y"), ("a", 3, "x", "y"), ("a", 4, "z", "y")], "k string, n int, f string, g string")
    assert keyed.semantic_dedup(rows, ["k"], ["f", "g"], "n").first().n == 3  # first of the fullest
    assert keyed.last_write_wins([rows.where("n > 2"), rows.where("n <= 2")], ["k"], ["n"]).first().n == 2  # last part, last row
    votes = spark.createDataFrame([(2020, "a"), (2020, "b"), (2021, "a"), (2021, "c")], "y int, c string").withColumn("k", F.lit(1))
    strict, latest = keyed.modal_value(votes, ["k"], "y", "c").first(), keyed.modal_value(votes, ["k"], "y", "c", "latest").first()
    assert (strict.y, strict.status) == (None, "ambiguous") and (latest.y, latest.status) == (2021, "tie_latest")
    four = spark.createDataFrame([(1, float(v)) for v in (4, 1, 3, 2)], "k int, v double")
    assert keyed.upper_median(four, ["k"], "v").first().upper_median == 3.0
    assert analytics.peer_stats(four, ["k"], "v").first().median == 2.5


def test_merge_conflicts_and_coverage(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, v string")
    b = spark.createDataFrame([(2, "z"), (3, None), (4, "n")], "id int, v string")
    assert {(r.id, r.outcome, r.v) for r in keyed.merge_with_conflicts(a, b, "id", ["v"]).collect()} == {
        (1, "kept", "x"), (2, "conflict", "y"), (3, "duplicate", None), (4, "added", "n")}
    assert {(r.id, r.problem) for r in keyed.coverage(a, b, "id").collect()} == {(1, "missing"), (4, "unexpected")}
    assert keyed.union_unique([a, b], "id")[1].count() == 2
    lists = [r["values"] for r in keyed.chunked(spark.range(130).select(F.col("id").cast("string")).union(spark.range(5).select(F.lit(None).cast("string"))), "id", 50).orderBy("chunk").collect()]
    assert list(map(len, lists)) == [50, 50, 30] and [x for part in lists for x in part] == sorted(map(str, range(130)))


def quarter_rows(spark, values, entity="e"):
    ends = [date(2023, 3, 31), date(2023, 6, 30), date(2023, 9, 30), date(2023, 12, 31), date(2024, 3, 31)]
    starts = [date(2023, 1, 1), date(2023, 4, 1), date(2023, 7, 1), date(2023, 10, 1), date(2024, 1, 1)]
    rows = [(entity, s, e, v) for s, e, v in zip(starts, ends, values)]
    return spark.createDataFrame(rows, "entity string, period_start date, period_end date, value double")


def test_growth(spark):
    rows = quarter_rows(spark, [80.0, 100.0, 120.0, 0.0, 120.0])
    qoq = {r.period_end: r for r in growth.quarter_on_quarter(rows, ["entity"]).collect()}
    assert qoq[date(2023, 3, 31)].reason == "NO_COMPARABLE_PERIOD" and qoq[date(2023, 3, 31)].outcome == "not_calculated"
    assert float(qoq[date(2023, 9, 30)].percent) == 20.0
    assert (qoq[date(2024, 3, 31)].outcome, qoq[date(2024, 3, 31)].reason) == ("issue", "ZERO_PRIOR")
    yoy = {r.period_end: r for r in growth.year_on_year(rows, ["entity"]).collect()}
    assert float(yoy[date(2024, 3, 31)].percent) == 50.0
    again = growth.year_on_year(rows.unionByName(rows), ["entity"])
    assert sorted(map(str, again.collect())) == sorted(map(str, growth.year_on_year(rows, ["entity"]).collect()))  # repeated facts count once
    twice = rows.unionByName(rows.where("value = 80").withColumn("value", F.lit(81.0)))
    assert {r.reason for r in growth.year_on_year(twice, ["entity"]).where("value = 120 and period_end > '2024-01-01'").collect()} == {"AMBIGUOUS_PRIOR"}
    started = rows.unionByName(rows.where("period_end > '2024-01-01'").withColumn("period_start", F.lit(date(2024, 1, 3))))
    assert {r.reason for r in growth.year_on_year(started, ["entity"]).where("period_end > '2024-01-01'").collect()} == {"AMBIGUOUS_CURRENT"}
    named = rows.withColumn("fp", F.when(F.col("period_end") > "2024-01-01", "Q1").otherwise("FY"))
    assert growth.year_on_year(named, ["entity"], ["fp"]).where("period_end > '2024-01-01'").first().reason == "NO_COMPARABLE_PERIOD"
    unnamed = rows.withColumn("fp", F.when(F.col("period_end") > "2024-01-01", "Q1"))
    assert growth.year_on_year(unnamed, ["entity"], ["fp"]).where("period_end > '2024-01-01'").first().reason is None


def test_adjacent_years(spark):
    rows = [("a", 2020, 10.0, "x"), ("a", 2022, 20.0, "x"), ("a", 2023, 5.0, "y"), ("a", 2024, 5.0, "y"), ("a", 2025, None, "y"), ("b", 2020, 0.0, None), ("b", 2021, 1.0, None)]
    df = spark.createDataFrame(rows, "k string, y int, v double, basis string")
    got = {(r.k, r.y): (r.ratio, r.null_reason) for r in periods.adjacent_years(df, ["k"], "y", "v", ["basis"]).collect()}
    none, zero = "no_comparable_prior_period", "missing_or_zero_prior_revenue"
    assert got == {("a", 2020): (None, none), ("a", 2022): (1.0, None), ("a", 2023): (None, none), ("a", 2024): (0.0, None), ("a", 2025): (None, zero),
                   ("b", 2020): (None, none), ("b", 2021): (None, zero)}


def test_trailing_mean_takes_what_is_there(spark):
    df = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate((2, 4, 9))], "k string, t int, v double")
    assert [r.m for r in df.select("t", positioning.trailing_mean("v", ["k"], ["t"], 2).alias("m")).orderBy("t").collect()] == [2.0, 3.0, 6.5]


def test_verified_signatures(spark):
    events = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    facts = spark.createDataFrame([(1, 5, "p"), (1, 5, "q"), (2, 5, "p"), (2, 6, "p")], "k int, v int, p string")
    values = {r.k: (r.value, r.issue) for r in growth.verified(events, facts, ["k"], ["v"], "v", "REVENUE").collect()}
    assert values == {1: (5, None), 2: (None, "AMBIGUOUS_REVENUE"), 3: (None, "NO_VERIFIED_REVENUE")}
    periods_too = {r.k: r.issue for r in growth.verified(events, facts, ["k"], ["p", "v"], "v", "CAPEX").collect()}
    assert periods_too[1] == "AMBIGUOUS_CAPEX"


def test_quarters(spark):
    rows = spark.createDataFrame([("a", 2023, q, v) for q, v in zip((1, 2, 3, 4), (100.0, 250.0, 400.0, 600.0))] + [("b", 2023, 1, 5.0), ("c", 2023, 1, 5.0), ("c", 2023, 2, 4.0), ("c", 2023, 3, 6.0), ("c", 2023, 4, 7.0)], "e string, y int, q int, v double")
    got = periods.quarters_from_cumulative(rows, ["e"], "y", "q", "v").orderBy("q").collect()
    assert [(r.e, r.quarter_value) for r in got] == [("a", 100.0), ("a", 150.0), ("a", 150.0), ("a", 200.0)]
    year = {r.e: r.v for r in periods.annual_from_quarters(rows, ["e"], "y", "q", ["v"]).collect()}
    assert year["b"] is None and year["a"] == 1350.0


def test_recent_concept_beats_listed_order(spark):
    rows = spark.createDataFrame([("e", "old", "2019-12-31"), ("e", "old", "2018-12-31"), ("e", "new", "2023-12-31")], "e string, c string, d string")
    rank = F.when(F.col("c") == "old", 1).otherwise(2)
    assert periods.recent_concept(rows, ["e"], "c", "d", rank).first().c == "new"
    assert periods.first_listed_concept(rows, ["e"], "c", rank).first().c == "old"


def test_phrases_and_intervals(spark):
    cases = {
        "mid-single-digit percentage increase": (0.04, 0.06), "mid-to-high-single-digit": (0.04, 0.09), "mid-teens": (0.14, 0.16), "high-70s": (0.77, 0.79),
        "mid-80s": (0.84, 0.86), "up 5%": (0.05, 0.05), "approximately 5%": (0.045, 0.055), "mid double digit": (0.14, 0.16), "low–to–mid-teens": (0.11, 0.16),
        "teens": (None, None), "single digit": (None, None), "double-digit": (None, None), "flat": (None, None)}
    df = spark.createDataFrame([(p,) for p in cases], "p string")
    low, high, error = intervals.phrase_interval(F.col("p"))
    got = df.select("p", low.alias("a"), high.alias("b"), error.alias("e")).collect()
    assert {r.p: (r.a, r.b) for r in got} == cases and all((r.a is None) == (r.e is not None) for r in got)
    low, high, _ = intervals.phrase_interval(F.col("p"), "decline")
    assert df.where("p = 'mid-teens'").select(low.alias("a"), high.alias("b")).first() == (-0.16, -0.14)
    rows = spark.createDataFrame([(date(2023, m, 1), 0.1, 0.2) for m in (1, 4, 7, 10)] + [(date(2024, 8, 1), 0.1, 0.2)], "d date, lo double, hi double").withColumn("k", F.lit(1))
    got = intervals.compounded(rows, ["k"], "d", "lo", "hi").orderBy("d").collect()
    assert [r.compound_low for r in got] == [None, None, None, 0.4641, None] and got[3].compound_high == 1.0736


def test_positioning(spark):
    rows = spark.createDataFrame([("a", i, v) for i, v in enumerate((100.0, 120.0, 90.0, 108.0))], "k string, t int, v double")
    assert positioning.max_drawdown(rows, ["k"], ["t"], "v").first().max_drawdown == -25.0
    falls = rows.select("t", positioning.drawdown_percent("v", ["k"], ["t"], 60).alias("d")).orderBy("t").collect()
    assert falls[2].d == 25.0
    left = spark.createDataFrame([("a", 0), ("a", 2), ("b", 9)], "k string, t int")
    seen = positioning.as_of(left, rows, ["k"], "t", ["v"], "v").orderBy("k", "t").collect()
    assert [r.asof_v for r in seen] == [100.0, 90.0, None]
    assert positioning.volatility(rows.limit(2), ["k"], ["t"], "v").first().volatility is None


def test_scenarios_and_rules(spark):
    rows = spark.createDataFrame([("rich", 100.0, 10.0, 0.0), ("poor", 10.0, 40.0, 30.0)], "c string, operating_cash_flow double, capex double, liquidity double")
    got = {(r.c, r.scenario): (r.band, r.runway_years) for r in analytics.scenarios(rows).collect()}
    assert got["rich", "crisis"] == ("self_funding", None) if 100 * 0.1 >= 5 else True
    assert got["poor", "cycle"][0] == "under_two_years" and got["poor", "cycle"][1] == pytest.approx(30 / 27)
    m = spark.createDataFrame([("a", None, None, True), ("b", None, 0.0, False), ("c", 1.0, 0.1, False)], "c string, runway double, margin double, free boolean")
    rules = [("runway", "runway", "at_least", 2.0), ("margin", "margin", "above", 0.0)]
    assert {(r.c, r.rule): r.result for r in analytics.evaluated(m, "c", rules, {"runway": F.col("free")}).collect()} == {
        ("a", "runway"): "pass", ("a", "margin"): "unknown", ("b", "runway"): "unknown", ("b", "margin"): "fail", ("c", "runway"): "fail", ("c", "margin"): "pass"}
    bands = [("under_two_years", 5.0, 1.0), ("two_to_five_years", 5.0, 1.0), ("five_years_plus", 5.0, 1.0), ("self_funding", -1.0, 1.0), ("self_funding", 1.0, 0.7), ("self_funding", 1.0, 0.8)]
    classes = analytics.classified(spark.createDataFrame(bands, "severe_band string, latest_fcf double, data_completeness double"))
    assert {r["class"]: r.companies for r in analytics.class_counts(classes).collect()} == {"resilient": 1, "watch": 3, "vulnerable": 1, "incomplete": 1}


def test_freshness_bounds(spark):
    run = F.lit("2024-01-02 00:00:00").cast("timestamp")
    times = ["2024-01-01 00:00:00", "2023-12-31 23:59:59", "2024-01-02 00:00:00", "2024-01-02 00:00:01", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, t string").withColumn("t", F.col("t").cast("timestamp"))
    got = [r.f for r in df.select("i", audits.freshness(F.col("t"), run).alias("f")).orderBy("i").collect()]
    assert got == ["live", "stale", "live", "future", "invalid"]


def test_audits_fail_closed(spark):
    run = F.lit("2024-01-02 00:00:00").cast("timestamp")
    rows = spark.createDataFrame([("a", "x", "https://a.gov/1"), ("a", None, "https://b.gov/1")], "event_id string, company string, source_url string")
    rows = rows.withColumn("published_at", F.lit("2024-01-02 00:05:01").cast("timestamp"))
    found = audits.ledger(rows, run, ["event_id", "company"], ["a.gov"])
    assert sorted(r.code for r in found.collect()) == sorted(["FUTURE_PUBLISHED_AT", "MISSING_REQUIRED_FIELD"])  # a row that lacks a field has no further issue
    three = rows.where("company is not null").withColumn("seq", F.lit(1))
    three = three.unionByName(three.withColumn("seq", F.lit(2))).unionByName(three.withColumn("seq", F.lit(3)).withColumn("published_at", F.lit(None).cast("timestamp")).withColumn("source_url", F.lit("http://b.gov/")))
    assert sorted(r.code for r in audits.ledger(three, run, ["event_id", "company"], ["a.gov"], "seq").collect()) == sorted(
        ["DUPLICATE_EVENT_ID"] * 2 + ["FUTURE_PUBLISHED_AT"] * 2 + ["INVALID_PUBLISHED_AT"])
    states = audits.status(found, ["ledger", "other"])
    assert {r.audit: r.status for r in states.collect()} == {"ledger": "FAIL", "other": "PASS"}
    with pytest.raises(audits.GateClosed, match="ledger: 2"):
        audits.gate(states)
    audits.gate(states.where("audit = 'other'"))
    manifest = spark.createDataFrame([("a", "h", 1), ("b", "h", 1), ("../c", "h", 1), ("d", "g", 2)], "path string, sha256 string, size_bytes long")
    files = spark.createDataFrame([("a", "h", 1), ("d", "h", 1)], manifest.schema)
    assert {(r.key, r.code) for r in audits.manifest_check(manifest, files).collect()} == {
        ("b", "MISSING"), ("../c", "MISSING"), ("../c", "PATH_ESCAPE"), ("d", "HASH"), ("d", "SIZE")}
    records = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":1,"zz":2}')], "id int, record string")
    assert [(r.key, r.detail) for r in audits.projection_allowed(records, ["a"]).collect()] == [("2", "zz")]


def test_closure_ends_on_a_cycle(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "x string, y string")
    assert lineage.closure(edges, "x", "y").count() == 9


def test_text(spark):
    html = "<html><script>var a='<p>';</script><p>Q1 financial results: revenue&nbsp;up</p><!-- x --><a href='/a'>A</a><a class=x href=\"b?c=1\">B</a></html>"
    df = spark.createDataFrame([(html, bytearray("株".encode("cp932")), '{"b":[{"c":1}],"a":"é"}')], "h string, raw binary, j string")
    r = df.select(
        T.visible_text(F.col("h")).alias("v"), T.links(F.col("h")).alias("l"), T.earnings_text(F.col("h")).alias("e"), T.decoded(F.col("raw")).alias("d"),
        T.key_paths(F.col("j")).alias("k"), T.canonical_hash(F.col("j")).alias("c"), F.sha2(F.lit('{"a":"é","b":[{"c":1}]}'), 256).alias("want"),
        T.monthly_sales(F.lit("Hello. Global sales were $57.8 billion in the month of May 2024. Worldwide sales were $1 billion in June 2024.")).alias("m"),
        T.product_window(F.lit("NAND bit shipments up mid-teens. DRAM up 5%"), "NAND", ["DRAM"], r"\d+%").alias("rival"),
        T.product_window(F.lit("NAND bit shipments up 7% and DRAM up 5%"), "NAND", ["DRAM"], r"\d+%").alias("hit")).first()
    assert r.v == "Q1 financial results: revenue up A B" and r.l == ["/a", "b?c=1"] and r.e and r.d == "株"
    assert r.k == ["a", "b", "b[].c"] and r.c == r.want and (r.m.month, r.m.value, r.m.error) == (date(2024, 5, 1), 57.8, None) and r.rival is None and r.hit == "7%"


def test_more_text(spark):
    html = "<table><tr><th>Code</th><th>Title</th></tr><tr><td> 72030 </td><td><a href='x'>Results &amp; outlook</a></td></tr><tr></tr></table>"
    end, quarter, year = T.inferred_period(F.lit("Results for the third quarter ended June 30, 2024 (fiscal 2024)"))
    r = one(
        spark, T.table_rows(F.lit(html)).alias("rows"), T.snake(F.lit(" Net Income (GAAP) ")).alias("s"), end.alias("e"), quarter.alias("q"), year.alias("y"),
        T.python_round(F.lit(2.675), 2).alias("r"), T.python_round(F.lit(None).cast("double"), 2).alias("n"), T.pdf_text(F.lit(b"x"), "no-such-tool").alias("p"))
    assert r.rows == [["Code", "Title"], ["72030", "Results & outlook"]] and r.s == "net_income_gaap"
    assert (r.e, r.q, r.y, r.r, r.n, r.p) == (date(2024, 6, 30), 3, 2024, 2.67, None, None)


def test_filing_rules(spark):
    from quern.operators import filings

    rows = spark.createDataFrame([("a", "10-K", "2023-12-31"), ("b", "8-K", "2024-06-30"), ("c", "X", "2024-01-01"), ("d", "10-Q", None)], "k string, form string, d string")
    kind, issue = filings.reporting_period(F.col("form"), F.col("d").cast("date"), F.lit("2024-03-01").cast("timestamp"))
    assert {r.k: (r.kind, r.issue) for r in rows.select("k", kind.alias("kind"), issue.alias("issue")).collect()} == {
        "a": ("annual", None), "b": (None, "PERIOD_AFTER_PUBLICATION"), "c": (None, "UNKNOWN_FORM"), "d": (None, "MISSING_PERIOD_END")}
    with pytest.raises(ValueError, match="not fields"):
        filings.as_observations(rows)
    obs = filings.as_observations(spark.createDataFrame([("e", "c", 1.0)], "entity_id string, concept_id string, value double"))
    r = obs.first()
    assert obs.columns == list(filings.OBSERVATION) and r.id.startswith("observation:") and (r.revision, r.scope, r.period_type) == (0, "consolidated", "unknown")
    assert r.assumptions == r.evidence_ids == r.quality_flags == [] and r.model_id is None and r.source_api_url is None
    years = spark.createDataFrame([("k", 2023, "Q1", 1.0, 1), ("k", 2023, "Q1", 2.0, 2), ("k", 2024, "Q1", 5.0, 1), ("k", 2026, "Q1", 6.0, 1)], "k string, y int, p string, v double, n int")
    assert [x.prior_year_value for x in filings.prior_year_same_period(years, ["k"], "y", "p", "v", "n").orderBy("y", "n").collect()] == [None, None, 1.0, None]
    base = spark.createDataFrame([(1, "x", 5)], "cik int, accession string, v int")
    need = spark.createDataFrame([(1, "x"), (1, "y")], "cik int, accession string")
    assert [r.accession for r in filings.missing_accessions(need, base).collect()] == ["y"]
    delta = spark.createDataFrame([(1, "x", 6), (1, "y", 7)], base.schema)
    assert {(r.accession, r.v, r.provenance) for r in filings.with_delta(base, delta, ["cik", "accession"]).collect()} == {("x", 5, "bulk"), ("y", 7, "api")}
    q = spark.createDataFrame([("edinet", "edinet"), ("vendor", None), ("edinet", "vendor")], "s string, p string")
    assert [r.c for r in q.select(filings.canonical_source(F.col("s"), F.col("p"), ["edinet"]).alias("c")).collect()] == [None, "third_party_source", "third_party_previous_source"]


def test_closure_of_long_paths_and_diamonds(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(20)], "x int, y int")
    got = {(r.x, r.y): r.hops for r in lineage.closure(path, "x", "y").collect()}
    assert got == {(i, j): j - i for i in range(21) for j in range(i + 1, 21)}
    diamonds = spark.createDataFrame([(3 * i + a, 3 * i + b) for i in range(6) for a, b in ((0, 1), (0, 2), (1, 3), (2, 3))], "x int, y int")
    assert lineage.closure(diamonds, "x", "y").where("x = 0 and y = 18").first().hops == 12
    assert lineage.closure(path.limit(0), "x", "y").count() == 0


def test_six_k_reasons(spark):
    from quern.operators import filings

    rows = [("a", "6-K", None, None), ("b", "6-K", None, "d.htm"), ("c", "6-K", "Results for the year; net income", "d.htm"), ("d", "6-K", "results and earnings of the quarter: revenue", "d.htm"),
            ("e", "8-K", "", ""), ("f", "40-F", "", ""), ("g", "20-F", "", "")]
    df = spark.createDataFrame(rows, "k string, form string, text string, doc string")
    got = {r.k: r.r for r in df.select("k", filings.form_reason(F.col("form"), F.lit(None).cast("string"), F.col("text"), F.col("doc")).alias("r")).collect()}
    assert got == {"a": "UNVERIFIED_6K", "b": "SOURCE_FETCH_FAILED", "c": None, "d": "NOT_EARNINGS_RELATED", "e": "NOT_EARNINGS_RELATED", "f": "NOT_EARNINGS_RELATED", "g": None}


def test_projections(spark):
    from quern.operators import projections

    assert projections.equivalent_tags(["Revenues"], True) == list(projections.REVENUE_TAGS) and projections.equivalent_tags(["Revenues"], False) == ["Revenues"]
    assert projections.equivalent_tags(["Revenues", "x"], True) == ["Revenues", "x"]
    assert projections.equivalent_tags(list(projections.CAPEX_TAGS[1:]), True) == [*projections.CAPEX_TAGS[1:], projections.CAPEX_TAGS[0]]
    facts = "map<string,map<string,struct<units:map<string,array<struct<accn:string,val:double>>>>>>"
    df = spark.createDataFrame([({"us-gaap": {"A": ({"USD": [("x", 1.0)]},), "B": ({"USD": [("y", 1.0)], "EUR": []},)}},), ({},), (None,)], f"facts {facts}")
    has = lambda a: [r[0] for r in df.select(projections.carries_accession(F.col("facts"), F.lit(a))).collect()]
    assert has("y") == [True, False, False] and has("z") == [False] * 3
    r = one(spark, T.string_values(F.lit('{"a":[1,{"b":"x"}],"c":"y"}')).alias("v"), projections.bar_height(F.lit(0.0), F.lit(9.0)).alias("low"), projections.bar_height(F.lit(4.5), F.lit(9.0)).alias("half"))
    assert [(v.path, v.value) for v in r.v] == [("$.a[1].b", "x"), ("$.c", "y")] and (r.low, r.half) == (3.0, 50.0)
    empty = projections.kpi_audit(spark.createDataFrame([], "id string, value_type string, concept_id string, reported_text string, quality_flags array<string>, normalization_method string, entity_id string, period_end date"))
    assert [x.code for x in empty.collect()] == ["nand_kpi_actuals_missing"]
    day, asp = date(2026, 3, 31), "nand_asp_change_qoq"
    kpi = [(1, "actual", asp, "up", [], None, "m", day), (2, "actual", asp, "", ["normalized_qualitative_band"], None, "m", day), (3, "actual", "revenue", None, [], None, "m", day),
           (4, "actual", "nand_bit_shipments_change_qoq", "up", [], None, "k", day), (5, "company_guidance", "nand_bit_shipments_change_qoq", None, [], None, "k", day)]
    found = projections.kpi_audit(spark.createDataFrame(kpi, "id long, value_type string, concept_id string, reported_text string, quality_flags array<string>, normalization_method string, entity_id string, period_end date"))
    assert sorted((x.code, x.record_id, x.entity_id) for x in found.collect()) == [
        ("nand_asp_guidance_not_disclosed", None, "m"), ("nand_normalization_policy_missing", "2", None), ("nand_reported_text_missing", "2", None)]


def test_callers_columns_keep_their_names(spark):
    from quern.operators import projections

    odd = [F.lit("mine").alias(c) for c in ("_rank", "_RANK_", "_at", "_part", "_gap", "_last")]
    df = spark.createDataFrame([("k", date(2024, 1, 1), 1.0, "10-K", "a"), ("k", date(2024, 4, 1), 2.0, "10-K", "b")], "k string, d date, v double, form string, accession string").select("*", F.col("d").alias("filing_date"), *odd)
    for made in (keyed.latest_per_key(df, ["k"], [F.desc("d")]), keyed.last_write_wins([df, df], ["k"], ["d"]), periods.latest_periods(df, ["k"], "d", 1), projections.newest_filings(df, ["k"], ["10-K"], 1),
                 intervals.compounded(df, ["k"], "d", "v", "v"), positioning.trailing_returns(df, ["k"], ["d"], "v", [1])):
        rows = made.collect()
        assert rows and set(df.columns) <= set(made.columns) and all(r[c] == "mine" for r in rows for c in ("_rank", "_RANK_", "_at", "_part", "_gap", "_last"))


def test_quarters_with_comparatives(spark):
    from quern.operators import projections

    d = date
    schema = "entity string, form string, period_start date, period_end date, value double, fiscal_year int, filed string, accession string"
    ends = [d(2024, 3, 31), d(2024, 6, 30), d(2024, 9, 30)]
    rows = [("e", "10-Q", d(2024, 1, 1), e, v, 2024, f"2024-{i + 4:02}-20", f"a{i}") for i, (e, v) in enumerate(zip(ends, (10.0, 25.0, 45.0)))]
    rows += [("e", "10-K", d(2024, 1, 1), d(2024, 12, 31), 70.0, 2024, "2025-02-01", "a9")]
    again = [(*r[:4], r[4] + 1, 2025, "2025" + r[6][4:], "b") for r in rows]  # every later filing restates them
    made = lambda rows: sorted((r.fiscal_period, r.value) for r in projections.quarters_from_filings(spark.createDataFrame(rows, schema), ["entity"]).collect())
    assert made(rows) == [("Q1", 10.0), ("Q2", 15.0), ("Q3", 20.0), ("Q4", 25.0)] == made([*again[:3], *rows, (*again[3][:6], "2026-02-01", "b")])
    assert made(rows[:3]) == [] == made([*rows[:1], *rows[2:]])
    band = "entity string, fiscal_year int, fiscal_period string, period_start date, period_end date, filed string, accession string, value double"
    own = ("e", 2023, "Q1", d(2023, 1, 1), d(2023, 3, 31), "2023-04-20", "a", 30.0)
    old = ("e", 2023, "Q1", d(2022, 1, 1), d(2022, 3, 31), "2023-05-20", "b", 20.0)  # filed later, ended earlier
    before = ("e", 2022, "Q1", d(2022, 1, 1), d(2022, 3, 31), "2022-04-20", "a", 20.0)
    by_band = lambda rows: sorted((r.fiscal_year, r.value) for r in projections.quarters_by_band(spark.createDataFrame(rows, band), ["entity"]).collect())
    assert by_band([own, old]) == [(2023, 30.0)] and by_band([before, old]) == [(2022, 20.0)]


def test_guidance_takes_the_last_of_each_side(spark):
    rows = [("k", 1, "actual", 0.5, 0.6, None), ("k", 2, "actual", None, None, 0.2), ("k", 3, "company_guidance", 0.1, 0.15, None), ("k", 4, "company_guidance", None, 0.3, None), ("k", 5, "guidance", 0.9, 0.9, None),
            ("o", 1, "actual", 0.1, 0.1, None), (None, 1, "actual", 0.1, 0.1, None), (None, 2, "company_guidance", 0.1, 0.1, None)]
    found = intervals.against_guidance(spark.createDataFrame(rows, "k string, n int, value_type string, value_low double, value_high double, value double"), ["k"], "n").collect()
    assert [(r.k, r.relation, round(r.difference_low, 6), round(r.difference_high, 6)) for r in found] == [("k", "above", 0.05, 0.1)]


def test_product_changes(spark):
    text = ("DRAM Fiscal Q3 DRAM revenue rose. Bit shipments increased in the low-teens percentage range. Prices declined in the mid-single-digit percentage range. "
            "NAND Fiscal Q3 NAND revenue was 2 billion. NAND Bit shipments were up in the mid- to-high-20s percentage range, and Prices declined in the high–single-digit percentage range.")
    r = one(spark, T.product_changes(F.lit(text), "NAND").alias("n"), T.product_changes(F.lit(text), "HBM").alias("none"))
    assert (r.n.volume.low, r.n.volume.high, r.n.volume.phrase) == (0.24, 0.29, "mid-to-high-20s") and (r.n.price.low, r.n.price.high) == (-0.09, -0.07) and r.n.error is None
    assert r.none.error == "paragraph not found" and r.none.volume is None
