"""Periods, publication and findings by their codes."""

import pytest
from pyspark.sql import functions as F

from quern.operators import publication
from quern.operators.audits import GateClosed

EVENT = "n int, event_id string, source_adapter string, company_id string, company_name string, document_type string, freshness string, report_date string, published_at string, accession_number string, source_url string"


def event(n, event_id="e", adapter="sec_edgar", form="10-Q", freshness="PASS", report="2026-03-31", published="2026-04-20T10:00:00Z", accession="x"):
    return (n, event_id, adapter, "c", "C", form, freshness, report, published, accession, "https://a.gov")


def test_periods_are_named_never_guessed(spark):
    rows = [event(1, "a"), event(2, "a"), event(3, "b", form="10-K"), event(4, "c", adapter="tdnet"), event(5, "d", form="8-K"), event(6, "f", freshness="STALE"), event(7, "g", report=None), event(8, "h", report="2026-3-1"),
            event(9, "i", published="2026-04-20T10:00:00"), event(10, "j", report="2026-04-21"), event(11, "k", accession=" "), event(12, ""), event(13, "l", published=None), event(14, "m", report="2026-04-20", published="2026-04-19T23:00:00-05:00")]
    items, found = publication.normalized_periods(spark.createDataFrame(rows, EVENT), "n")
    assert {(r.event_id, str(r.period_end), r.period_kind, r.fiscal_year) for r in items.collect()} == {
        ("a", "2026-03-31", "INTERIM_REPORT_PERIOD_END", None), ("b", "2026-03-31", "ANNUAL_REPORT_PERIOD_END", None), ("m", "2026-04-20", "INTERIM_REPORT_PERIOD_END", None)}
    assert {(r.key, r.code, r.detail) for r in found.collect()} == {
        ("a", "DUPLICATE_NORMALIZED_EVENT", ""), ("", "MISSING_EVENT_ID", ""), ("f", "INVALID_PRIMARY_PERIOD", "freshness is not PASS"), ("g", "INVALID_PRIMARY_PERIOD", "missing report_date"),
        ("h", "INVALID_PRIMARY_PERIOD", "invalid report_date"), ("i", "INVALID_PRIMARY_PERIOD", "invalid published_at"), ("l", "INVALID_PRIMARY_PERIOD", "invalid published_at"),
        ("j", "INVALID_PRIMARY_PERIOD", "report_date is after published_at"), ("k", "INVALID_PRIMARY_PERIOD", "missing accession_number")}


def test_publication(spark):
    run_at = F.lit("2026-04-21 10:00:00").cast("timestamp")
    rows = [event(1, "edge"), event(2, "old", published="2026-04-20T09:59:59.999999Z"), event(3, "new", published="2026-04-21T10:00:00Z")]
    audits = spark.createDataFrame([("ledger", "PASS", 0), ("evidence", None, None)], "name string, status string, issues int")
    shown, totals, found = publication.publication(spark.createDataFrame(rows, EVENT), audits, ["ledger", "evidence"], run_at, F.lit(3))
    assert found.count() == 0 and {r.event_id for r in publication.released(shown, found).collect()} == {"edge", "new"} and shown.columns == list(publication.PUBLISHED)
    assert tuple(totals.first()) == (2, 3, 1)
    bad = [*rows, event(4, "later", published="2026-04-21T10:00:01Z"), event(5, "stale", freshness="STALE"), event(6, "untimed", published="2026-04-21")]
    audits = spark.createDataFrame([("ledger", "FAIL", 2)], "name string, status string, issues int")
    shown, _, found = publication.publication(spark.createDataFrame(bad, EVENT), audits, ["ledger", "evidence"], run_at, F.lit(3))
    assert {(r.key, r.code) for r in found.collect()} == {
        ("ledger", "AUDIT_NOT_PASS"), ("ledger", "AUDIT_HAS_ISSUES"), ("evidence", "AUDIT_MISSING"), ("<ledger>", "ACCEPTED_EVENT_COUNT_MISMATCH"), ("later", "FUTURE_EVENT"), ("stale", "NON_PASS_EVENT"), ("untimed", "INVALID_PUBLISHED_AT")}
    with pytest.raises(GateClosed, match="AUDIT_MISSING"):
        publication.released(shown, found)


def test_findings(spark):
    schema = "id string, operating_cash_flow_usd long, capital_expenditures_usd long, capital_expenditures_fact_tag string"
    one, none = publication.snapshot_findings(spark.createDataFrame([("a", 100, 30, "x"), ("b", 100, 20, "x")], schema))
    assert tuple(one.first()) == (200, 1, 50, 0.25, 150, "observed") and none.count() == 0
    two, found = publication.snapshot_findings(spark.createDataFrame([("a", 100, 30, "x"), ("b", 100, 20, "y")], schema))
    assert tuple(two.first()) == (200, 2, None, None, None, "observed_with_limits") and found.first().id == "capital_expenditure_concepts_not_comparable"
