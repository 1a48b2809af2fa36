"""What may be published of the ledger: periods named by primary sources, and events that are fresh, of audits that passed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.scalars import instant
from quern.operators.audits import GateClosed, first_of, issues

#: Fixed forms that name a reporting period, and what kind.
PERIOD_KINDS = {"10-K": "ANNUAL_REPORT_PERIOD_END", "10-Q": "INTERIM_REPORT_PERIOD_END"}
PERIOD_STATUS = "PRIMARY_PERIOD_END_AND_REPORT_KIND_ONLY"
#: Fixed fields of a published event, and how long one is fresh.
PUBLISHED = ("event_id", "company_id", "company_name", "document_type", "published_at", "source_url", "freshness")
FRESH_HOURS = 24


def normalized_periods(events: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(items, issues) of events (event_id, source_adapter, company_id, document_type, freshness, report_date and published_at as text, accession_number).

    Only the regulator's annual and quarterly reports have a period; it is the
    report date, its kind that of the form, and no fiscal year or quarter is ever
    inferred. INVALID_PRIMARY_PERIOD says why in its detail; of an id's sound events
    those after the first, by `order`, are DUPLICATE_NORMALIZED_EVENT.
    """
    kind = F.coalesce(*(F.when(F.col("document_type") == f, F.lit(k)) for f, k in PERIOD_KINDS.items()))
    rows = events.where(F.col("source_adapter") == "sec_edgar").withColumn("period_kind", kind).where(F.col("period_kind").isNotNull())
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    day = F.when(text("report_date").rlike(r"^\d{4}-\d{2}-\d{2}$"), text("report_date").try_cast("date"))
    at = instant(F.col("published_at"))
    why = first_of({
        "freshness is not PASS": ~F.col("freshness").eqNullSafe("PASS"), "missing report_date": text("report_date") == "", "invalid report_date": day.isNull(),
        "invalid published_at": at.isNull(), "report_date is after published_at": day > at.cast("date"), "missing accession_number": text("accession_number") == ""})
    rows = rows.withColumns({"_why": why, "period_end": day, "_id": text("event_id")})
    bad = issues(rows.where(F.col("_why").isNotNull()), "period_normalization", F.col("event_id"), {"INVALID_PRIMARY_PERIOD": F.lit(True)}, F.col("_why"))
    sound = rows.where(F.col("_why").isNull())
    unnamed = issues(sound.where(F.col("_id") == ""), "period_normalization", F.lit(""), {"MISSING_EVENT_ID": F.lit(True)})
    named = sound.where(F.col("_id") != "")
    first = named.groupBy("_id").agg(F.min(order).alias("_first"))
    placed = named.join(first, "_id")
    again = issues(placed.where(F.col(order) != F.col("_first")), "period_normalization", F.col("event_id"), {"DUPLICATE_NORMALIZED_EVENT": F.lit(True)})
    items = placed.where(F.col(order) == F.col("_first")).select(
        "event_id", "company_id", "document_type", text("accession_number").alias("accession_number"), "period_end", "period_kind",
        F.lit(None).cast("int").alias("fiscal_year"), F.lit(None).cast("int").alias("fiscal_quarter"), F.lit(PERIOD_STATUS).alias("normalization_status"))
    return items, bad.unionByName(unnamed).unionByName(again)


def publication(events: DataFrame, audits: DataFrame, required: list[str], run_at: Column, accepted_total: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(published, totals, issues): the fresh events with their public fields, counts, and what forbids publication.

    audits (name, status, issues) must all be there and have passed: an audit that
    is missing, not PASS or has issues, a count that differs from the ledger's, an
    event that is not PASS, has no zoned time or lies in the future are issues, and
    `released` refuses to go on with any. Events over 24 hours old are not
    published, only counted. run_at and accepted_total are constants of the ledger's audit.
    """
    at = instant(F.col("published_at"))
    age = F.unix_micros(run_at) - F.unix_micros(at)
    fresh = F.coalesce(age.between(0, FRESH_HOURS * 3600 * 1_000_000), F.lit(False)) & F.col("freshness").eqNullSafe("PASS")
    counted = events.agg(F.count("*").alias("n"), F.count_if(fresh).alias("published"), F.count_if(F.coalesce(age > FRESH_HOURS * 3600 * 1_000_000, F.lit(False))).alias("expired"))
    totals = counted.select(F.col("published").alias("accepted_events_total"), F.col("n").alias("ledger_accepted_events_total"), F.col("expired").alias("expired_events_total"))
    listed = audits.sparkSession.createDataFrame([(n,) for n in required], "name string").join(audits.withColumn("_there", F.lit(True)), "name", "left")
    of_audits = issues(listed, "publication", F.col("name"), {
        "AUDIT_MISSING": F.col("_there").isNull(), "AUDIT_NOT_PASS": F.col("_there").isNotNull() & F.col("status").isNotNull() & (F.col("status") != "PASS"),
        "AUDIT_HAS_ISSUES": F.coalesce(F.col("issues") != 0, F.lit(False))})
    of_count = issues(counted.withColumn("_of", accepted_total), "publication", F.lit("<ledger>"), {"ACCEPTED_EVENT_COUNT_MISMATCH": ~F.col("n").eqNullSafe(F.col("_of"))})
    code = first_of({"NON_PASS_EVENT": ~F.col("freshness").eqNullSafe("PASS"), "INVALID_PUBLISHED_AT": at.isNull(), "FUTURE_EVENT": age < 0})
    of_events = events.select(F.lit("publication").alias("audit"), code.alias("code"), F.col("event_id").cast("string").alias("key"), F.lit("").alias("detail")).where(F.col("code").isNotNull())
    return events.where(fresh).select(*PUBLISHED), totals, of_audits.unionByName(of_count).unionByName(of_events)


def released(published: DataFrame, found: DataFrame) -> DataFrame:
    """published, if nothing was found that forbids it; else GateClosed, with a few of the codes."""
    if first := sorted({r.code for r in found.select("code").limit(20).collect()}):
        raise GateClosed(f"not published: {', '.join(first)}")
    return published


def snapshot_findings(facts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(normalized, findings) of a valid snapshot's sources (id, operating_cash_flow_usd, capital_expenditures_usd, capital_expenditures_fact_tag).

    normalized is one row: the cash flow, the number of expenditure tags, and, only
    if that is one, the expenditures, their ratio to the cash flow and what is left.
    Several tags are the major finding that they can't be compared; verdict is
    observed or observed_with_limits.
    """
    sums = facts.agg(
        F.sum("operating_cash_flow_usd").alias("operating_cash_flow_total_usd"), F.sum("capital_expenditures_usd").alias("_capex"), F.count_distinct("capital_expenditures_fact_tag").alias("capital_expenditures_fact_tag_count"))
    one = F.col("capital_expenditures_fact_tag_count") == 1
    when = lambda c: F.when(one, c)
    normalized = sums.select(
        "operating_cash_flow_total_usd", "capital_expenditures_fact_tag_count", when(F.col("_capex")).alias("capital_expenditures_total_usd"),
        when(F.try_divide(F.col("_capex"), F.col("operating_cash_flow_total_usd"))).alias("capital_expenditures_to_operating_cash_flow"),
        when(F.col("operating_cash_flow_total_usd") - F.col("_capex")).alias("residual_cash_flow_usd"),
        F.when(F.col("capital_expenditures_fact_tag_count") > 1, "observed_with_limits").otherwise("observed").alias("verdict"))
    findings = normalized.where("verdict <> 'observed'").select(
        F.lit("capital_expenditure_concepts_not_comparable").alias("id"), F.lit("major").alias("severity"), F.lit("open").alias("status"))
    return normalized, findings
