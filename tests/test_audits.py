"""Audits on rows that must fail, each for one reason."""

from datetime import date

from pyspark.sql import functions as F

from quern.operators import analytics, audits, growth
from quern.plans.registry import QUERIES
from quern.sources import sinks


def codes(df):
    return {(r.key, r.code) for r in df.collect()}


def test_evidence_and_times(spark):
    good, scope = "a" * 64, audits.SCOPES[0]
    rows = [("ok", "https://a.gov/x", good, 1, scope, 1), ("hash", "https://a.gov/x", "A" * 64, 1, scope, 2), ("none", "https://a.gov/x", None, 1, scope, 3), ("", None, None, 0, None, 4),
            ("empty", "https://a.gov/x", good, 0, scope, 5), ("host", "https://b.gov/x", good, 1, scope, 6), ("two", "https://a.gov/x", good, 1, scope, 7), ("two", "https://a.gov/x", good, 1, "other", 8)]
    found = audits.evidence(spark.createDataFrame(rows, "event_id string, evidence_url string, source_content_sha256 string, source_content_bytes long, evidence_scope string, seq int"), ["a.gov"], "seq")
    assert codes(found) == {("hash", "INVALID_SOURCE_SHA256"), ("none", "INVALID_SOURCE_SHA256"), ("", "MISSING_EVENT_ID"), ("empty", "EMPTY_SOURCE_CONTENT"), ("host", "NON_PRIMARY_DOMAIN"),
                            ("two", "DUPLICATE_EVIDENCE_EVENT_ID"), ("two", "INVALID_EVIDENCE_SCOPE")}
    files = spark.createDataFrame([("a", "h", 1)], "path string, sha256 string, size_bytes long")
    runs = spark.createDataFrame([("x", "PASS", 0, "r"), ("y", "PASS", 1, "r"), ("z", "FAIL", 0, "q")], "name string, status string, issues int, run_id string")
    made, bad = audits.manifest(files, ["a", "b"], runs, "r")
    assert [tuple(r) for r in made.collect()] == [("a", "h", 1, "r")]
    assert codes(bad) == {("b", "MISSING"), ("y", "DIRTY_AUDIT"), ("z", "DIRTY_AUDIT"), ("z", "RUN_MISMATCH")}
    ts = lambda df, c: df.withColumn(c, F.col(c).cast("timestamp"))
    shown = ts(spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:01"), ("c", "2024-01-01")], "k string, published_at string"), "published_at")
    accepted = ts(spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:00")], "k string, accepted_at string"), "accepted_at")
    assert codes(audits.published_at(shown, accepted, "k")) == {("b", "PUBLISHED_AT_MISMATCH"), ("c", "NO_ACCEPTANCE_TIME")}


def test_row_audits_are_all_four(spark):
    periods = "event_id string, period_start date, period_end date, prior_start date, prior_end date, percent double"
    d = date.fromisoformat
    row = lambda e, now=("2024-01-01", "2024-03-31"), then=("2023-01-01", "2023-03-31"), percent=1.0: (e, *map(d, now), *map(d, then), percent)
    found = audits.comparable_periods(spark.createDataFrame([row("ok"), row("gap", then=("2022-10-01", "2022-12-30")), row("long", then=("2022-12-01", "2023-03-31")), row("none", percent=None)], periods), (350, 380))
    assert codes(found) == {("gap", "BAD_GAP"), ("long", "BAD_DURATION"), ("none", "MISSING_PERCENT")}
    metrics = [("ok", "revenue", "us-gaap", None, None), ("ifrs", "revenue", "ifrs", None, None), ("made", "fcf", None, "derived", ["a", "b"]), ("unsaid", "fcf", None, None, ["a", "b"]), ("one", "fcf", None, "derived", ["a"]), ("what", "x", None, None, None)]
    found = audits.stated_basis(spark.createDataFrame(metrics, "event_id string, metric string, taxonomy string, basis string, inputs array<string>"), ["revenue"], ["fcf"])
    assert codes(found) == {("ifrs", "NON_STANDARD_TAXONOMY"), ("unsaid", "NOT_LABELLED_DERIVED"), ("one", "MISSING_INPUTS"), ("what", "UNKNOWN_METRIC")}
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    by = {r.audit: r["count"] for r in QUERIES["row_audits"](spark, "/root/testdata/sf0.001").groupBy("audit").count().collect()}
    assert set(by) == {"published_at", "growth_durations", "accounting_basis", "projection"} and min(by["growth_durations"], by["accounting_basis"]) > orders // 2


def test_basis(spark):
    names = [*audits.RAW_ARTIFACTS, *audits.DERIVED_ARTIFACTS]
    revenue, capex, inventory, fcf = names
    fact = ("us-gaap", "Revenues")
    inputs = {"operating_cash_flow": ("us-gaap", "A"), "capital_expenditures": ("us-gaap", "B")}
    schema = "artifact string, n int, whole boolean, event_id string, metric string, taxonomy string, concept string, accounting_basis string, derivation string, inputs map<string,struct<taxonomy:string,concept:string>>"
    raw = lambda n, e, metric="revenue", of=fact, basis=None, artifact=revenue: (artifact, n, True, e, metric, *of, basis, None, None)
    made = lambda n, e, basis="derived-non-gaap", how="a - b", of=inputs: (fcf, n, True, e, "free_cash_flow", None, None, basis, how, of)
    rows = [raw(1, "a"), raw(2, "a"), raw(3, "b", basis="us-gaap-xbrl-fact"), raw(4, "c", of=("ifrs", "x")), raw(5, "d", of=("us-gaap", " ")), raw(6, "e", basis="gaap"), raw(7, "f", "other"), raw(8, ""),
            (revenue, 9, False, *[None] * 7), raw(10, "c"), raw(1, "z", "inventory_net", artifact=inventory), made(1, "a"), made(2, "b", basis=None), made(3, "c", of={"operating_cash_flow": ("us-gaap", "A")}),
            made(4, "d", of=inputs | {"capital_expenditures": ("us-gaap", "")}), made(5, "e", how=""), made(6, "f", of=inputs | {"x": ("us-gaap", "A")})]
    documents = [(revenue, "PASS", 0, True, 9), (inventory, "PASS", 1, True, 1), (fcf, "PASS", None, True, 6)]
    items, found = audits.accounting_basis(
        spark.createDataFrame(documents, "artifact string, status string, issues int, listed boolean, verified_metrics_total int"), spark.createDataFrame(rows, schema), "n")
    assert codes(found) == {
        (revenue, "VERIFIED_METRIC_COUNT_MISMATCH"), (capex, "MISSING_VERIFIED_METRIC_ARTIFACT"), (inventory, "UPSTREAM_METRIC_ARTIFACT_NOT_PASS"), ("a", "DUPLICATE_VERIFIED_METRIC"),
        ("c", "RAW_METRIC_NOT_BOUND_TO_US_GAAP_XBRL"), ("d", "RAW_METRIC_NOT_BOUND_TO_US_GAAP_XBRL"), ("e", "RAW_METRIC_ACCOUNTING_BASIS_CONFLICT"), ("f", "INVALID_METRIC_IDENTITY"), ("", "INVALID_METRIC_IDENTITY"),
        ("", "INVALID_METRIC_ROW"), ("c", "DUPLICATE_VERIFIED_METRIC"), ("b", "DERIVED_METRIC_MISSING_NON_GAAP_LABEL"), ("c", "DERIVED_METRIC_INPUT_PROVENANCE_INCOMPLETE"),
        ("d", "DERIVED_METRIC_INPUT_PROVENANCE_INCOMPLETE"), ("f", "DERIVED_METRIC_INPUT_PROVENANCE_INCOMPLETE"), ("e", "DERIVED_METRIC_DERIVATION_MISSING")}
    assert {(r.event_id, r.metric, r.accounting_basis) for r in items.collect()} == {
        ("a", "revenue", "us-gaap-xbrl-fact"), ("b", "revenue", "us-gaap-xbrl-fact"), ("a", "free_cash_flow", "derived-non-gaap")}


def test_growth_durations(spark):
    url = "https://data.sec.gov/api/xbrl/companyfacts/CIK0000000001.json"
    row = lambda e, now=("2026-04-01", "2026-06-30"), then=("2025-04-01", "2025-06-30"), **more: {
        "whole": True, "event_id": e, "growth_type": "YoY", "metric": "revenue", "unit": "USD", "taxonomy": "us-gaap", "document_type": "10-Q", "accession_number": "x", "source_url": url,
        "current_period_start": now[0], "current_period_end": now[1], "prior_period_start": then[0], "prior_period_end": then[1], **more}
    rows = [row("ok"), row("gap", then=("2025-01-01", "2025-03-31")), row("length", then=("2025-03-01", "2025-06-30")), row("url", source_url="https://example.com/api/xbrl/companyfacts/CIK1"),
            row("host", source_url="https://data.sec.gov.evil.org/api/xbrl/companyfacts/CIK1"), row("form", document_type="8-K"), row("date", now=("2026-4-1", "2026-06-30")), row("zero", now=("2026-06-30", "2026-06-30")),
            row("none", whole=False), row("unit", unit=None)]
    schema = "whole boolean, " + ", ".join(f"{c} string" for c in row("x") if c != "whole")
    growth_rows = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    document = lambda *v: spark.createDataFrame([v], "listed boolean, status string, issues int, schema_version string, calculated_yoy_total int")
    silent = spark.createDataFrame([("q", False), ("smuggled", True)], "event_id string, valued boolean")
    found = audits.growth_durations(document(True, "PASS", 0, audits.GROWTH_VERSION, 10), growth_rows, silent)
    assert codes(found) == {
        ("gap", "INVALID_YOY_END_GAP"), ("length", "INVALID_YOY_DURATION_GAP"), ("url", "UNSAFE_GROWTH_PROVENANCE"), ("host", "UNSAFE_GROWTH_PROVENANCE"), ("form", "UNSAFE_GROWTH_PROVENANCE"),
        ("unit", "UNSAFE_GROWTH_PROVENANCE"), ("date", "INVALID_PERIOD_DATE"), ("zero", "NON_POSITIVE_PERIOD_DURATION"), ("none", "GROWTH_ROW_NOT_OBJECT"),
        ("smuggled", "UNCALCULATED_ROW_CONTAINS_GROWTH_VALUE")}
    assert {r.detail for r in found.where("code = 'INVALID_YOY_END_GAP'").collect()} == {"456"}
    assert codes(audits.growth_durations(document(False, "FAIL", 1, "v0", 3), growth_rows.limit(0), silent.limit(0))) == {("<growth>", c) for c in (
        "GROWTH_NOT_LIST", "GROWTH_ARTIFACT_NOT_PASS", "UNEXPECTED_SCHEMA_VERSION", "CALCULATED_COUNT_MISMATCH")}


def test_semantic_duplicates(spark):
    rows = [(1, "a", "sec_edgar", "x", "2026-01-01", "10-Q"), (2, "a", "sec_edgar", "x", "2026-01-01", "10-Q"), (3, "b", "sec_edgar", "x", "2026-01-01", "10-Q"), (4, "c", "tdnet", "x", "2026-01-01", "10-Q"),
            (5, "d", "sec_edgar", "", None, "10-Q"), (6, "e", "sec_edgar", "x", "2026-01-01", "10-K"), (7, "a", "sec_edgar", "x", "2026-01-01", "10-K"), (8, None, "sec_edgar", "x", "2026-01-01", "10-K")]
    found = audits.semantic_duplicates(spark.createDataFrame(rows, "n int, event_id string, source_adapter string, company_id string, report_date string, document_type string"), "n")
    assert {(r.key, r.code, r.detail) for r in found.collect()} == {
        ("b", "DUPLICATE_SEMANTIC_EARNINGS_EVENT", "a"), ("d", "UNKEYABLE_SEC_EARNINGS_EVENT", "company_id,report_date"), ("a", "DUPLICATE_SEMANTIC_EARNINGS_EVENT", "e"), ("", "DUPLICATE_SEMANTIC_EARNINGS_EVENT", "e")}


def test_persisted_growth(spark):
    """A quarter of one filing against the quarter of the filing before it, and the year before of its own."""
    d, own, before = date, "0000000000-26-000010", "0000000000-26-000005"
    actual = lambda accn, s, e, v: ("example", "R", "USD", accn, "10-Q", s, e, v, (e - s).days)
    rows = [actual(own, d(2026, 4, 1), d(2026, 6, 30), 120.0), actual(before, d(2026, 1, 1), d(2026, 3, 31), 100.0), actual(own, d(2025, 4, 1), d(2025, 6, 30), 80.0)]
    metric = spark.createDataFrame([("evt-q2", "example", "R", own, "10-Q", d(2026, 6, 30), 120.0)], "event_id string, company_id string, concept string, accession_number string, document_type string, period_end date, value double")
    schema = "company_id string, concept string, unit string, accession_number string, document_type string, period_start date, period_end date, value double, duration_days int"

    def shown(rows, metric=metric):
        return {(r.growth_type, r.percent, r.reason, r.outcome) for r in growth.persisted(metric, spark.createDataFrame(rows, schema)).collect()}

    assert shown(rows) == {("QoQ", 20.0, None, "growth"), ("YoY", 50.0, None, "growth")} == shown([*rows, *rows])
    assert shown(rows[:1]) == {("QoQ", None, "NO_COMPARABLE_PRIOR_QUARTER_ACTUAL", "not_calculated"), ("YoY", None, "NO_COMPARABLE_PRIOR_YEAR_ACTUAL", "not_calculated")}
    assert shown([*rows, actual("0000000000-26-000006", d(2026, 1, 1), d(2026, 3, 31), 101.0)]) == {("QoQ", None, "AMBIGUOUS_PRIOR_QUARTER_ACTUAL", "issue"), ("YoY", 50.0, None, "growth")}
    assert shown([*rows, actual(own, d(2026, 1, 1), d(2026, 6, 30), 120.0)]) == {(None, None, "AMBIGUOUS_CURRENT_PERSISTED_ACTUAL", "issue")} == shown(rows[1:])
    assert shown([rows[0], rows[1], actual(before, d(2025, 4, 1), d(2025, 6, 30), 80.0)]) == {("QoQ", 20.0, None, "growth"), ("YoY", None, "NO_COMPARABLE_PRIOR_YEAR_ACTUAL", "not_calculated")}
    assert shown([rows[0], actual(before, d(2026, 1, 1), d(2026, 3, 31), 0.0), rows[2]]) == {("QoQ", None, "ZERO_OR_INVALID_PRIOR_VALUE", "issue"), ("YoY", 50.0, None, "growth")}
    half = metric.withColumn("value", F.lit(220.0))
    assert shown([actual(own, d(2026, 1, 1), d(2026, 6, 30), 220.0)], half) == {
        ("QoQ", None, "CURRENT_FACT_NOT_STANDALONE_QUARTER", "not_calculated"), ("YoY", None, "NO_COMPARABLE_PRIOR_YEAR_ACTUAL", "not_calculated")}


def test_run_coherence(spark):
    names = ["audit_latest.json", "a", "b", "c", "d", "e", "f", "publication_latest.json"]
    at, day = "2024-01-01T00:00:00Z", "2024-01-01T00:05:01Z"
    columns = "name string, readable boolean, status string, issues int, schema_version string, run_at string, generated_from_run_at string, accepted_events_total int, ledger_accepted_events_total int, events_total int, expired_events_total int"
    row = lambda name, readable=True, status="PASS", issues=0, version="v", run=at, of=None, n=None, ledger=None, expired=None: (name, readable, status, issues, version, run, of, n, ledger, None, expired)
    rows = [row(names[0], n=5), row("a", run=day), row("b", run="2024-01-01T00:00:00"), row("c", readable=False), row("d", status="FAIL", issues=3), row("e", issues=-1, version=""), row(names[-1], of=at, n=3, ledger=5, expired=2)]
    check = lambda rows: codes(audits.run_coherence(spark.createDataFrame(rows, columns), names, ["a", "b"]))
    base = {("a", "STALE_DERIVED_AUDIT_RUN"), ("b", "INVALID_ARTIFACT_RUN_AT"), ("c", "INVALID_JSON"), ("d", "NON_PASS_STATUS"), ("d", "ARTIFACT_HAS_ISSUES"),
            ("e", "INVALID_ISSUES_FIELD"), ("e", "MISSING_SCHEMA_VERSION"), ("f", "MISSING_ARTIFACT")}
    assert check(rows) == base
    pub = names[-1]
    assert check([*rows[:-1], row(pub, of=day, n=3, ledger=4, expired=1)]) - base == {
        (pub, "PUBLICATION_LEDGER_COUNT_MISMATCH"), (pub, "PUBLICATION_FRESHNESS_COUNT_MISMATCH"), (pub, "STALE_PUBLICATION_RUN")}
    assert check([row(names[0], run="", n=5), *rows[1:-1], row(pub, n=5)]) == base - {("a", "STALE_DERIVED_AUDIT_RUN"), ("b", "INVALID_ARTIFACT_RUN_AT")} | {
        (names[0], "INVALID_LEDGER_RUN_AT"), (pub, "MISSING_LEDGER_RUN_AT"), (pub, "MISSING_PUBLICATION_SOURCE_RUN_AT")}


def test_registry_companies_and_policy(spark):
    company = "struct<id:string,ticker:string,name:string>"
    schema = f"seq int, source_id string, name string, adapter string, enabled boolean, disabled_reason string, official_source string, cik long, ticker string, codes array<string>, companies map<string,{company}>"
    td = lambda seq, sid, codes, companies: (seq, sid, "n", "tdnet_public", True, None, "https://www.release.tdnet.info/inbs/", None, None, codes, companies)
    sec = lambda seq, sid, cik: (seq, sid, "n", "sec_edgar", True, None, f"https://www.sec.gov/edgar/browse/?CIK={cik}", cik, "ABC", None, None)
    rows = [sec(1, "s1", 1), sec(2, "s2", 2), td(3, "t", ["1301", "1332"], {"1301": ("x", "1301", "n"), "1332": ("s1", "9999", " ")}), td(4, "u", ["1333"], {"1334": ("", "1334", "n")}), td(5, "v", ["1335"], {"1335": (None, "1335", "n")})]
    assert codes(audits.source_registry(spark.createDataFrame(rows, schema), "seq")) == {
        ("t", "DUPLICATE_COMPANY_ID"), ("t", "TDNET_TICKER_CODE_MISMATCH"), ("t", "MISSING_REQUIRED_FIELD"), ("u", "TDNET_CODE_COMPANY_MISMATCH"), ("v", "MISSING_TDNET_COMPANY_ID")}
    top = "schema_version string, policy map<string,string>, sources int"
    assert codes(audits.registry_policy(spark.createDataFrame([(audits.REGISTRY_VERSION, audits.POLICY, 2)], top))) == set()
    found = audits.registry_policy(spark.createDataFrame([("v0", {**audits.POLICY, "fail_closed": "false"}, 0)], top))
    assert codes(found) == {("<registry>", c) for c in ("INVALID_SCHEMA_VERSION", "MISSING_SOURCES", "UNSAFE_POLICY")}
    assert [r.detail for r in found.where("code = 'UNSAFE_POLICY'").collect()] == ["fail_closed"]
    assert audits.registry_policy(spark.createDataFrame([(audits.REGISTRY_VERSION, None, 1)], top)).count() == 1 + len(audits.POLICY)


def test_lineage_totals(spark):
    m = spark.range(3)
    assert codes(audits.lineage_totals(m, 3, "PASS", "PASS")) == set()
    assert {c for _, c in codes(audits.lineage_totals(m, 2, "FAIL", "FAIL"))} == {"VERIFIED_METRICS_NOT_PASS", "EVIDENCE_NOT_PASS", "VERIFIED_METRIC_COUNT_MISMATCH"}


def test_snapshot_and_references(spark):
    rows = [("a", "capex", "2023", "USD", 5.0), ("b", "capex", "2023", "USD", 5.5), ("c", "capex", "2023", "EUR", 5.0), ("d", "operating_cash_flow", "2023", "USD", 0.0),
            ("e", "capex", "2023", "USD", 1.0), ("e", "debt", "2022", "USD", 1.0)]
    df = spark.createDataFrame(rows, "company string, tag string, period string, unit string, value double")
    assert codes(audits.snapshot(df)) == {("b", "NOT_WHOLE_USD"), ("c", "NOT_WHOLE_USD"), ("d", "ZERO_CASH_FLOW"), ("e", "SEVERAL_PERIODS")}
    known = spark.createDataFrame([("capex",), ("debt",)], "tag string")
    assert codes(audits.references(df, "company", "tag", known, "UNKNOWN_CONCEPT")) == {("d", "UNKNOWN_CONCEPT")}


def test_balances_and_actuals(spark):
    rows = [("a", 5, 2, 1, 2, 9), ("b", 5, None, None, None, 9), ("c", None, 2, None, None, None)]
    df = spark.createDataFrame(rows, "k string, cash int, investments int, debt_current int, debt_noncurrent int, debt_total int")
    assert {r.k: (r.liquidity, r.debt, r.debt_method) for r in analytics.liquidity_and_debt(df).collect()} == {
        "a": (7, 3, "components"), "b": (5, 9, "reported_total"), "c": (None, None, "missing")}
    facts = spark.createDataFrame([("a", date(2024, 1, 1), date(2024, 3, 31), 1, 1.0), ("a", date(2024, 1, 1), date(2024, 3, 31), 2, 2.0), ("a", date(2024, 1, 1), date(2024, 1, 1), 3, 3.0)],
                                  "k string, period_start date, period_end date, n int, value double")
    got = growth.multi_period_actuals(facts, ["k", "period_start", "period_end"], "n").collect()
    assert [(r.value, r.duration_days) for r in got] == [(2.0, 90)]


def test_export(spark):
    sinks.export_tables({"entity": spark.createDataFrame([(1, "x")], "id int, kind string")}, "quern_test", {"entity": "kind"})
    assert spark.table("quern_test.entity").count() == 1
    spark.sql("DROP DATABASE quern_test CASCADE")
