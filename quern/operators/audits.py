"""Fail-closed audits. Each gives issue rows (audit, code, key, detail); an audit passes if it gives none.

All audits of a run are unioned, so one job evaluates them, and one gate raises.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.scalars import allowed_url, days

FUTURE_SLACK_MINUTES = 5


def issues(df: DataFrame, audit: str, key: Column, codes: dict[str, Column], detail: Column | None = None) -> DataFrame:
    """One row for each code that holds for a row of df; one pass over df however many codes."""
    found = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(True)), F.lit(n)) for n, c in codes.items())))
    text = (F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))).alias("detail")
    return df.select(F.lit(audit).alias("audit"), F.explode(found).alias("code"), key.cast("string").alias("key"), text)


def report(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def status(found: DataFrame, audits: Sequence[str]) -> DataFrame:
    """(audit, issues, status) of every audit named, those without issues included."""
    listed = found.sparkSession.createDataFrame([(a,) for a in audits], "audit string")
    counts = found.groupBy("audit").agg(F.count("*").alias("issues"))
    joined = listed.join(counts, "audit", "left").select("audit", F.coalesce("issues", F.lit(0)).alias("issues"))
    return joined.withColumn("status", F.when(F.col("issues") == 0, "PASS").otherwise("FAIL"))


class GateClosed(RuntimeError):
    """An audit failed, so nothing is published."""


def gate(states: DataFrame) -> None:
    failed = [f"{r.audit}: {r.issues}" for r in states.where("status <> 'PASS'").orderBy("audit").collect()]
    if failed:
        raise GateClosed("; ".join(failed))


def missing(c: str) -> Column:
    return F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")


def ledger(events: DataFrame, run_at: Column, required: Sequence[str], hosts: Sequence[str] = (), order: str = "event_id") -> DataFrame:
    """Required fields, repeated ids, times in the future, and, if hosts are given, sources outside them.

    A row that lacks a field has that issue only; of rows that share an id those
    after the first, by `order`, are duplicates; a row without a time has no further issue.
    """
    lacks = reduce(lambda a, b: a | b, map(missing, required))
    at = F.row_number().over(Window.partitionBy("event_id", "_lacks").orderBy(order))
    rows = events.withColumn("_lacks", lacks).withColumn("_at", at)
    whole, timed = ~F.col("_lacks"), F.col("published_at").isNotNull()
    codes = {"MISSING_REQUIRED_FIELD": F.col("_lacks"), "DUPLICATE_EVENT_ID": whole & (F.col("_at") > 1), "INVALID_PUBLISHED_AT": whole & ~timed,
             "FUTURE_PUBLISHED_AT": whole & F.coalesce(F.col("published_at") > run_at + F.expr(f"interval {FUTURE_SLACK_MINUTES} minutes"), F.lit(False))}
    if hosts:
        netloc = F.coalesce(F.regexp_extract("source_url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
        codes["NON_PRIMARY_DOMAIN"] = whole & timed & ~netloc.isin(*hosts)
    return issues(rows, "ledger", F.col("event_id"), codes)


def unverified_sources(registry: DataFrame) -> DataFrame:
    """Enabled sources of the regulator's adapter that name no CIK."""
    lacks = F.coalesce("enabled", F.lit(True)) & (F.col("adapter") == "sec_edgar") & F.col("cik").isNull()
    return issues(registry, "ledger", F.col("source_id"), {"MISSING_VERIFIED_CIK": F.coalesce(lacks, F.lit(False))})


def semantic_duplicates(events: DataFrame, order: str) -> DataFrame:
    """The regulator's events that report one thing twice, or that don't say what they report.

    events: event_id, source_adapter, company_id, report_date, document_type; other
    adapters take no part. An event that lacks part of its identity is
    UNKEYABLE_SEC_EARNINGS_EVENT, with what it lacks; one whose id differs from that
    of the first event of its identity, by `order`, is
    DUPLICATE_SEMANTIC_EARNINGS_EVENT, with the first id. An event that comes again
    under its own id is none. First ids are aggregated before they are joined.
    """
    parts = ["company_id", "report_date", "document_type"]
    own = events.where(F.col("source_adapter") == "sec_edgar").withColumn("event_id", F.coalesce(F.col("event_id").cast("string"), F.lit("")))
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    lacks = F.array_compact(F.array(*(F.when(empty(c), F.lit(c)) for c in parts)))
    unkeyable = issues(own.where(F.size(lacks) > 0), "semantic_duplicates", F.col("event_id"), {"UNKEYABLE_SEC_EARNINGS_EVENT": F.lit(True)}, F.array_join(lacks, ","))
    keyed = own.where(F.size(lacks) == 0)
    first = keyed.groupBy(*parts).agg(F.min_by("event_id", order).alias("_first"))
    again = keyed.join(first, parts).where(F.col("event_id") != F.col("_first"))
    return unkeyable.unionByName(issues(again, "semantic_duplicates", F.col("event_id"), {"DUPLICATE_SEMANTIC_EARNINGS_EVENT": F.lit(True)}, F.col("_first")))


def freshness(published: Column, run_at: Column, hours: int = 24) -> Column:
    """future, live (up to and with `hours`) or stale."""
    return (F.when(published.isNull(), "invalid").when(published > run_at, "future")
            .when(published >= run_at - F.expr(f"interval {hours} hours"), "live").otherwise("stale"))


def source_cursors(registry: DataFrame, events: DataFrame, source: str, time: str, event: str) -> DataFrame:
    """Each registered source with its last event and how many there are; sources without events keep nulls."""
    last = events.groupBy(source).agg(
        F.max_by(F.struct(time, event), F.struct(time, event)).alias("_last"), F.count("*").alias("events"))
    joined = registry.join(last, source, "left")
    return joined.select(*registry.columns, F.coalesce("events", F.lit(0)).alias("events"), F.col("_last")[time].alias(time), F.col("_last")[event].alias(event))


def counters(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(dimension, value, rows): counts by each column on its own, in one pass by grouping sets."""
    view = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns))
    grouped = view.groupingSets([[F.col(c)] for c in columns], *columns).agg(F.grouping_id().alias("_g"), F.count("*").alias("rows"))
    name, value = None, None
    for i, c in enumerate(columns):
        mine = F.col("_g") == ((1 << len(columns)) - 1) ^ (1 << (len(columns) - 1 - i))
        name = F.when(mine, c) if name is None else name.when(mine, c)
        value = F.when(mine, F.col(c)) if value is None else value.when(mine, F.col(c))
    return grouped.select(name.alias("dimension"), value.alias("value"), "rows")


def published_at(events: DataFrame, accepted: DataFrame, key: str) -> DataFrame:
    """Publication times that differ from the regulator's acceptance times, by as much as a second."""
    joined = events.select(key, "published_at").join(accepted.select(key, "accepted_at"), key, "left")
    return issues(joined, "published_at", F.col(key), {
        "NO_ACCEPTANCE_TIME": F.col("accepted_at").isNull(),
        "PUBLISHED_AT_MISMATCH": F.coalesce(F.col("published_at") != F.col("accepted_at"), F.lit(False))})


#: Fixed scopes of evidence.
SCOPES = ("SEC_SUBMISSIONS_JSON", "TDNET_DISCLOSURE_DOCUMENT")


def evidence(rows: DataFrame, hosts: Sequence[str], order: str) -> DataFrame:
    """Evidence records (event_id, evidence_url, evidence_scope, source_content_sha256, source_content_bytes): id, repeats, digest, size, source, scope.

    A record without an id has that issue only; of an id's records those after the first, by `order`, are repeats.
    """
    at = F.row_number().over(Window.partitionBy("event_id").orderBy(order))
    there = ~missing("event_id")
    netloc = F.coalesce(F.regexp_extract("evidence_url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    return issues(rows.withColumn("_at", at), "evidence", F.col("event_id"), {
        "MISSING_EVENT_ID": ~there, "DUPLICATE_EVIDENCE_EVENT_ID": there & (F.col("_at") > 1),
        "INVALID_SOURCE_SHA256": there & ~F.coalesce(F.col("source_content_sha256"), F.lit("")).rlike("^[0-9a-f]{64}$"),
        "EMPTY_SOURCE_CONTENT": there & (F.coalesce("source_content_bytes", F.lit(0)) <= 0), "NON_PRIMARY_DOMAIN": there & ~netloc.isin(*hosts),
        "INVALID_EVIDENCE_SCOPE": there & ~F.coalesce(F.col("evidence_scope").isin(*SCOPES), F.lit(False))})


#: Fixed artifacts of verified metrics and the one metric that each may hold; the last is derived, from the two inputs named.
RAW_ARTIFACTS = {"verified_revenue_latest.json": "revenue", "verified_capex_latest.json": "capital_expenditures", "verified_inventory_latest.json": "inventory_net"}
DERIVED_ARTIFACTS = {"verified_fcf_latest.json": "free_cash_flow"}
DERIVED_INPUTS = ("operating_cash_flow", "capital_expenditures")
RAW_BASIS, DERIVED_BASIS, TAXONOMY = "us-gaap-xbrl-fact", "derived-non-gaap", "us-gaap"


def first_of(codes: dict[str, Column]) -> Column:
    """The name of the first condition that holds, or null."""
    return F.coalesce(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in codes.items()))


def accounting_basis(artifacts: DataFrame, metrics: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(items, issues): verified metrics with their accounting basis, and what forbids one.

    artifacts: artifact, status, issues (their number, null for none), listed (the
    metrics are a list), verified_metrics_total. metrics: artifact, whole (the row is
    an object), event_id, metric, taxonomy, concept, accounting_basis, derivation,
    inputs (a map of name to taxonomy and concept), `order`. An artifact that is
    missing, has not passed or holds no list is one issue and its metrics are not
    looked at; a metric has the first issue that it meets; of an event's metric the
    first sound row by artifact, then `order`, counts and the others are duplicates.
    """
    expected = {**RAW_ARTIFACTS, **DERIVED_ARTIFACTS}
    named = artifacts.sparkSession.createDataFrame(
        [(i, a, m, a in RAW_ARTIFACTS) for i, (a, m) in enumerate(expected.items())], "place int, artifact string, expected string, raw boolean")
    counted = metrics.groupBy("artifact").agg(F.count("*").alias("_n"))
    state = named.join(artifacts.withColumn("_there", F.lit(True)), "artifact", "left").join(counted, "artifact", "left")
    stops = first_of({
        "MISSING_VERIFIED_METRIC_ARTIFACT": F.col("_there").isNull(),
        "UPSTREAM_METRIC_ARTIFACT_NOT_PASS": ~F.col("status").eqNullSafe("PASS") | (F.coalesce("issues", F.lit(0)) != 0),
        "INVALID_METRICS_COLLECTION": ~F.coalesce("listed", F.lit(False))})
    state = state.withColumn("_stops", stops)
    differs = F.col("_stops").isNull() & ~F.col("verified_metrics_total").eqNullSafe(F.coalesce("_n", F.lit(0)))
    of_artifacts = issues(state, "accounting_basis", F.col("artifact"), {
        "VERIFIED_METRIC_COUNT_MISMATCH": differs, **{c: F.col("_stops").eqNullSafe(c) for c in (
            "MISSING_VERIFIED_METRIC_ARTIFACT", "UPSTREAM_METRIC_ARTIFACT_NOT_PASS", "INVALID_METRICS_COLLECTION")}}, F.col("artifact"))

    rows = metrics.join(F.broadcast(state.where("_stops IS NULL").select("place", "artifact", "expected", "raw")), "artifact")  # at most four rows
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    event, raw = text("event_id"), F.col("raw")
    unsound = first_of({"INVALID_METRIC_ROW": ~F.coalesce("whole", F.lit(False)), "INVALID_METRIC_IDENTITY": (event == "") | (text("metric") != F.col("expected"))})
    rows = rows.withColumn("_unsound", unsound)
    firsts = rows.where("_unsound IS NULL").groupBy("event_id", "metric").agg(F.min(F.struct("place", order)).alias("_f"))
    rows = rows.join(firsts, ["event_id", "metric"], "left")
    sound = F.col("_unsound").isNull()
    names = F.map_keys("inputs")
    unbound = F.exists(F.map_values("inputs"), lambda x: x.isNull() | ~x["taxonomy"].eqNullSafe(TAXONOMY) | (F.trim(F.coalesce(x["concept"], F.lit(""))) == ""))
    both = F.col("inputs").isNotNull() & (F.size(names) == len(DERIVED_INPUTS)) & F.array_contains(names, DERIVED_INPUTS[0]) & F.array_contains(names, DERIVED_INPUTS[1])
    code = first_of({
        "INVALID_METRIC_ROW": F.col("_unsound").eqNullSafe("INVALID_METRIC_ROW"), "INVALID_METRIC_IDENTITY": F.col("_unsound").eqNullSafe("INVALID_METRIC_IDENTITY"),
        "DUPLICATE_VERIFIED_METRIC": sound & (F.col("_f") != F.struct("place", order)),
        "RAW_METRIC_NOT_BOUND_TO_US_GAAP_XBRL": raw & (~F.col("taxonomy").eqNullSafe(TAXONOMY) | (F.trim(text("concept")) == "")),
        "RAW_METRIC_ACCOUNTING_BASIS_CONFLICT": raw & F.col("accounting_basis").isNotNull() & (F.col("accounting_basis") != RAW_BASIS),
        "DERIVED_METRIC_MISSING_NON_GAAP_LABEL": ~raw & ~F.col("accounting_basis").eqNullSafe(DERIVED_BASIS),
        "DERIVED_METRIC_INPUT_PROVENANCE_INCOMPLETE": ~raw & (~F.coalesce(both, F.lit(False)) | F.coalesce(unbound, F.lit(True))),
        "DERIVED_METRIC_DERIVATION_MISSING": ~raw & (F.trim(text("derivation")) == "")})
    rows = rows.withColumn("code", code)
    bad = rows.where("code IS NOT NULL").select(F.lit("accounting_basis").alias("audit"), "code", event.alias("key"), F.col("artifact").alias("detail"))
    basis = F.when(raw, RAW_BASIS).otherwise(DERIVED_BASIS)
    items = rows.where("code IS NULL").select("artifact", event.alias("event_id"), "metric", basis.alias("accounting_basis"), F.when(raw, F.col("concept")).alias("concept"))
    return items, of_artifacts.unionByName(bad)


def stated_basis(metrics: DataFrame, raw: Sequence[str], derived: Sequence[str]) -> DataFrame:
    """Metrics (event_id, metric, taxonomy, basis, inputs) outside any artifact: raw ones must come from a standard taxonomy, derived ones must say
    so and name both inputs; other names fail. `accounting_basis` audits those of artifacts."""
    name = F.col("metric")
    return issues(metrics, "accounting_basis", F.col("event_id"), {
        "UNKNOWN_METRIC": ~name.isin(*raw, *derived),
        "NON_STANDARD_TAXONOMY": name.isin(*raw) & ~F.col("taxonomy").eqNullSafe("us-gaap"),
        "NOT_LABELLED_DERIVED": name.isin(*derived) & ~F.col("basis").eqNullSafe("derived"),
        "MISSING_INPUTS": name.isin(*derived) & (F.coalesce(F.size("inputs"), F.lit(0)) < 2)})


def comparable_periods(growth: DataFrame, gap: tuple[int, int], slack: int = 7) -> DataFrame:
    """Growth rows (event_id, period_start, period_end, prior_start, prior_end, percent) whose periods are not comparable after all, or that have no
    percentage; every fault of a row is an issue. `growth_durations` audits a published artifact."""
    between = days(F.col("prior_end"), F.col("period_end")).between(*gap)
    own, other = days(F.col("period_start"), F.col("period_end")), days(F.col("prior_start"), F.col("prior_end"))
    return issues(growth, "growth_durations", F.col("event_id"), {
        "BAD_GAP": ~between, "BAD_DURATION": F.abs(own - other) > slack, "MISSING_PERCENT": F.col("percent").isNull()})


#: Fixed contexts that a filing's form supports by itself.
CONTEXTS = {
    "10-K": "US_GAAP_PRIMARY_FINANCIAL_STATEMENTS_PRESENT", "10-Q": "US_GAAP_PRIMARY_FINANCIAL_STATEMENTS_PRESENT",
    "8-K": "MIXED_OR_UNVERIFIED_EARNINGS_MATERIAL", "6-K": "MIXED_OR_UNVERIFIED_EARNINGS_MATERIAL", "20-F": "ACCOUNTING_BASIS_UNVERIFIED_FROM_FORM",
}
OTHER_CONTEXT = "UNVERIFIED_PRIMARY_SOURCE_BASIS"


def accounting_context(adapter: Column, form: Column) -> Column:
    """What a filing's form says about the basis of its figures, never about a single metric; null for a form that earnings do not use."""
    named = F.coalesce(*(F.when(form == f, F.lit(c)) for f, c in CONTEXTS.items()))
    return F.when(adapter.eqNullSafe("sec_edgar"), named).otherwise(OTHER_CONTEXT)


def accounting_contexts(events: DataFrame, order: str) -> tuple[DataFrame, DataFrame]:
    """(items, issues): each event with its context, and events without one or after the first of an id."""
    named = events.withColumn("context", F.when(~missing("event_id"), accounting_context(F.col("source_adapter"), F.col("document_type"))))
    known = F.col("context").isNotNull()
    at = F.row_number().over(Window.partitionBy("event_id", known).orderBy(order))
    placed = named.withColumn("_at", at)
    items = placed.where(known & (F.col("_at") == 1)).drop("_at")
    return items, issues(placed, "accounting_context", F.col("event_id"), {
        "UNCLASSIFIED_ACCOUNTING_BASIS": ~known, "DUPLICATE_ACCOUNTING_BASIS_EVENT": known & (F.col("_at") > 1)})


#: Fixed version of the growth artifact, and its source.
GROWTH_VERSION = "verified-revenue-growth.v1"
FACTS_URL = r"^https://data\.sec\.gov(?![^/?#])(/api/xbrl/companyfacts/CIK[^?#]*)"


def growth_durations(document: DataFrame, growth: DataFrame, not_calculated: DataFrame, gap: tuple[int, int] = (350, 380), slack: int = 7) -> DataFrame:
    """Issues of a growth artifact: of the document, of rows whose source or periods can't be right, of rows that should carry no value.

    document: listed (growth is a list), status, issues, schema_version,
    calculated_yoy_total; one row. growth: whole (the row is an object), event_id,
    growth_type, metric, unit, taxonomy, document_type, accession_number,
    source_url, current and prior period start and end as text. not_calculated:
    event_id, valued (it holds a value of growth). A row has the first issue that it meets.
    """
    counted = growth.agg(F.count("*").alias("_n"))
    top = document.join(F.broadcast(counted), F.lit(True))  # one row each
    n = F.when(F.coalesce("listed", F.lit(False)), F.col("_n")).otherwise(0)
    of_document = issues(top, "growth_durations", F.lit("<growth>"), {
        "GROWTH_NOT_LIST": ~F.coalesce("listed", F.lit(False)), "GROWTH_ARTIFACT_NOT_PASS": ~F.col("status").eqNullSafe("PASS") | (F.coalesce("issues", F.lit(0)) != 0),
        "UNEXPECTED_SCHEMA_VERSION": ~F.col("schema_version").eqNullSafe(GROWTH_VERSION), "CALCULATED_COUNT_MISMATCH": ~F.col("calculated_yoy_total").eqNullSafe(n)})
    is_ = lambda c, v: F.col(c).eqNullSafe(v)
    safe = (is_("growth_type", "YoY") & is_("metric", "revenue") & is_("unit", "USD") & is_("taxonomy", TAXONOMY) & F.coalesce(F.col("document_type").isin("10-K", "10-Q"), F.lit(False))
            & (F.coalesce("accession_number", F.lit("")) != "") & F.coalesce(F.col("source_url").rlike(FACTS_URL), F.lit(False)))
    day = lambda c: F.when(F.col(c).rlike(r"^\d{4}-\d{2}-\d{2}$"), F.col(c).try_cast("date"))
    a, b, x, y = (day(c) for c in ("current_period_start", "current_period_end", "prior_period_start", "prior_period_end"))
    own, other, between = days(a, b), days(x, y), days(y, b)
    code = first_of({
        "GROWTH_ROW_NOT_OBJECT": ~F.coalesce("whole", F.lit(False)), "UNSAFE_GROWTH_PROVENANCE": ~safe,
        "INVALID_PERIOD_DATE": a.isNull() | b.isNull() | x.isNull() | y.isNull(), "NON_POSITIVE_PERIOD_DURATION": (own <= 0) | (other <= 0),
        "INVALID_YOY_END_GAP": ~between.between(*gap), "INVALID_YOY_DURATION_GAP": F.abs(own - other) > slack})
    number = F.when(code == "INVALID_YOY_END_GAP", between).when(code == "INVALID_YOY_DURATION_GAP", F.abs(own - other))
    rows = growth.select(F.lit("growth_durations").alias("audit"), code.alias("code"), F.col("event_id").cast("string").alias("key"), F.coalesce(number.cast("string"), F.lit("")).alias("detail"))
    smuggled = issues(not_calculated.where("valued"), "growth_durations", F.col("event_id"), {"UNCALCULATED_ROW_CONTAINS_GROWTH_VALUE": F.lit(True)})
    return report([of_document, rows.where("code IS NOT NULL"), smuggled])


def references(rows: DataFrame, key: str, column: str, dimension: DataFrame, code: str) -> DataFrame:
    """Rows whose reference has no row in the dimension: a foreign key as an anti join."""
    unknown = rows.join(dimension.select(F.col(dimension.columns[0]).alias(column)).distinct(), column, "left_anti")
    return issues(unknown, "references", F.col(key), {code: F.lit(True)}, F.col(column))


def entity_coverage(entities: DataFrame, observations: DataFrame, key: str, date: str, as_of: Column, stale_days: int = 550) -> DataFrame:
    """(key, observations, latest, age_days, state) of every entity: missing, stale or fresh."""
    seen = observations.groupBy(key).agg(F.count("*").alias("observations"), F.max(date).alias("latest"))
    out = entities.select(key).distinct().join(seen, key, "left").withColumn("observations", F.coalesce("observations", F.lit(0)))
    out = out.withColumn("age_days", F.datediff(as_of, F.col("latest")))
    return out.withColumn("state", F.when(F.col("latest").isNull(), "missing").when(F.col("age_days") > stale_days, "stale").otherwise("fresh"))


#: Fixed slack of a derived audit's time against its ledger's.
MAX_SKEW_SECONDS = 300


def run_coherence(artifacts: DataFrame, required: Sequence[str], bound: Sequence[str], ledger: str = "audit_latest.json", publication: str = "publication_latest.json") -> DataFrame:
    """artifacts (name, readable, status, issues, schema_version, run_at and generated_from_run_at as text, accepted_events_total,
    ledger_accepted_events_total, events_total, expired_events_total): all required ones there, passed and of one run.

    issues is the number of issues, -1 if the field is no list. The `bound` ones must be near the ledger's time, and the
    publication must be of just that run, with counts that add up to the ledger's.
    """
    from quern.functions.scalars import instant

    listed = artifacts.sparkSession.createDataFrame([(n, n in bound) for n in required], "name string, bound boolean")
    one = artifacts.where(F.col("name") == ledger).select(
        F.col("readable").alias("_l"), F.col("run_at").alias("_lr"), instant(F.col("run_at")).alias("_la"), F.col("accepted_events_total").alias("_ln"))
    joined = listed.join(artifacts, "name", "left").join(F.broadcast(one), F.lit(True), "left")  # the ledger's artifact is one row
    ok, at = F.coalesce("readable", F.lit(False)), instant(F.col("run_at"))
    timed, base = ok & F.col("bound"), F.coalesce("_l", F.lit(False))
    shown = F.coalesce("ledger_accepted_events_total", "events_total", "accepted_events_total")
    mine = ok & base & (F.col("name") == publication)
    differs = lambda a, b: F.coalesce(a != b, F.lit(False))
    return issues(joined, "run_coherence", F.col("name"), {
        "MISSING_ARTIFACT": F.col("readable").isNull(), "INVALID_JSON": F.col("readable").isNotNull() & ~ok, "NON_PASS_STATUS": ok & ~F.col("status").eqNullSafe("PASS"),
        "INVALID_ISSUES_FIELD": ok & F.coalesce(F.col("issues") < 0, F.lit(False)), "ARTIFACT_HAS_ISSUES": ok & F.coalesce(F.col("issues") > 0, F.lit(False)),
        "MISSING_SCHEMA_VERSION": ok & missing("schema_version"), "INVALID_LEDGER_RUN_AT": ok & (F.col("name") == ledger) & at.isNull(),
        "INVALID_ARTIFACT_RUN_AT": timed & F.col("_la").isNotNull() & at.isNull(),
        "STALE_DERIVED_AUDIT_RUN": timed & F.coalesce(F.abs(F.unix_timestamp(at) - F.unix_timestamp("_la")) > MAX_SKEW_SECONDS, F.lit(False)),
        "PUBLICATION_LEDGER_COUNT_MISMATCH": mine & differs(F.col("_ln"), shown),
        "PUBLICATION_FRESHNESS_COUNT_MISMATCH": mine & differs(F.col("_ln"), F.col("accepted_events_total") + F.coalesce("expired_events_total", F.lit(0))),
        "MISSING_LEDGER_RUN_AT": mine & (F.coalesce("_lr", F.lit("")) == ""), "MISSING_PUBLICATION_SOURCE_RUN_AT": mine & (F.coalesce("generated_from_run_at", F.lit("")) == ""),
        "STALE_PUBLICATION_RUN": mine & differs(F.nullif("_lr", F.lit("")), F.nullif("generated_from_run_at", F.lit("")))})


def manifest(files: DataFrame, required: Sequence[str], audits: DataFrame, run_id: str) -> tuple[DataFrame, DataFrame]:
    """(manifest, issues): the required files (path, sha256, size_bytes) of a run, and what forbids it.

    audits (name, status, issues, run_id) must all have passed without an issue, in this run.
    """
    listed = files.sparkSession.createDataFrame([(p,) for p in required], "path string")
    joined = listed.join(files, "path", "left")
    bad = issues(joined, "manifest", F.col("path"), {"MISSING": F.col("sha256").isNull()})
    dirty = issues(audits, "manifest", F.col("name"), {
        "DIRTY_AUDIT": ~F.col("status").eqNullSafe("PASS") | (F.coalesce("issues", F.lit(0)) > 0), "RUN_MISMATCH": ~F.col("run_id").eqNullSafe(run_id)})
    return joined.where(F.col("sha256").isNotNull()).withColumn("run_id", F.lit(run_id)), bad.unionByName(dirty)


def manifest_check(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """manifest (path, sha256, size_bytes) against files of the same shape."""
    f = files.select("path", F.col("sha256").alias("_hash"), F.col("size_bytes").alias("_size"))
    joined = manifest.withColumn("_n", F.count("*").over(Window.partitionBy("path"))).join(f, "path", "left")
    has = F.col("_hash").isNotNull()
    return issues(joined, "manifest", F.col("path"), {
        "MISSING": ~has, "HASH": has & (F.col("sha256") != F.col("_hash")), "SIZE": has & (F.col("size_bytes") != F.col("_size")),
        "PATH_ESCAPE": F.col("path").rlike(r"(^/)|(^|/)\.\.(/|$)"), "DUPLICATE": F.col("_n") > 1})


def quota(usage: DataFrame, daily: int, daily_reserve: int, monthly: int, monthly_reserve: int) -> DataFrame:
    """(day, attempts, month_attempts, within): attempts of each day and month so far against the limits less their reserves."""
    by_day = usage.groupBy("day").agg(F.sum("attempts").alias("attempts"))
    month = Window.partitionBy(F.trunc("day", "month")).orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    out = by_day.withColumn("month_attempts", F.sum("attempts").over(month))
    within = (F.col("attempts") <= daily - daily_reserve) & (F.col("month_attempts") <= monthly - monthly_reserve)
    return out.withColumn("within", within)


def projection_allowed(rows: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """JSON records (id, record) with keys outside the allow-list."""
    extra = F.array_except(F.json_object_keys("record"), F.array(*map(F.lit, allowed)))
    return issues(rows.withColumn("_extra", extra), "projection", F.col("id"), {"UNKNOWN_FIELD": F.size("_extra") > 0}, F.array_join("_extra", ","))


#: Fixed hosts and path beginnings of each adapter's official source.
ADAPTERS = {"sec_edgar": ("www.sec.gov", "/edgar/browse/"), "tdnet_public": ("www.release.tdnet.info", "/inbs/"), "opendart": ("englishdart.fss.or.kr", "/")}
#: Fixed policy of the registry, as text.
POLICY = {
    "primary_only": "true", "freshness_window_hours": "24", "fail_closed": "true", "no_search_snippet_dates": "true", "dedupe_key": "event_id", "require_explicit_sec_cik": "true"}
REGISTRY_VERSION = "earnings-source-registry.v1"


def registry_policy(registry: DataFrame) -> DataFrame:
    """The registry as a whole (schema_version, policy as a map of text or null, sources: their number): version, every policy value, and that there are sources."""
    policy = F.coalesce("policy", F.create_map().cast("map<string,string>"))
    codes = {"INVALID_SCHEMA_VERSION": ~F.col("schema_version").eqNullSafe(REGISTRY_VERSION), "MISSING_POLICY": F.col("policy").isNull(), "MISSING_SOURCES": F.coalesce("sources", F.lit(0)) == 0}
    whole = issues(registry, "source_registry", F.lit("<registry>"), codes)
    wrong = F.array_compact(F.array(*(F.when(~F.coalesce(F.element_at(policy, k) == v, F.lit(False)), k) for k, v in POLICY.items())))
    each = registry.select(F.explode(wrong).alias("_k"))
    return whole.unionByName(issues(each, "source_registry", F.lit("<registry>"), {"UNSAFE_POLICY": F.lit(True)}, F.col("_k")))


def source_registry(sources: DataFrame, order: str) -> DataFrame:
    """Sources of the registry: source_id, name, adapter, enabled, disabled_reason, official_source, cik, ticker, codes (array), companies (map of code
    to id, ticker, name).

    Each adapter has its own keys. Of sources or companies that share an identity those after the first, by `order`, are duplicates.
    """
    from quern.functions.scalars import url_cik

    sec, tdnet = F.col("adapter").eqNullSafe("sec_edgar"), F.col("adapter").eqNullSafe("tdnet_public")
    url = F.col("official_source")
    primary = F.lit(False)
    for name, (host_, path) in ADAPTERS.items():
        primary = primary | (F.col("adapter").eqNullSafe(name) & F.coalesce(allowed_url(url, [host_], path), F.lit(False)))
    cik = F.col("cik").try_cast("long")
    good_cik = F.coalesce(cik.between(1, 9_999_999_999), F.lit(False))
    codes = F.coalesce("codes", F.array().cast("array<string>"))
    four = F.filter(codes, lambda c: F.coalesce(c.rlike("^[0-9]{4}$"), F.lit(False)))
    companies = F.coalesce("companies", F.create_map().cast("map<string,struct<id:string,ticker:string,name:string>>"))
    nth = lambda *by: F.row_number().over(Window.partitionBy(*by).orderBy(order))
    rows = sources.withColumns({"_id": nth("source_id"), "_good": good_cik & sec}).withColumn("_cik", nth("_good", cik.alias("c")))
    whole = issues(rows, "source_registry", F.coalesce(F.nullif("source_id", F.lit("")), F.concat(F.lit("<index:"), F.col(order).cast("string"), F.lit(">"))), {
        "MISSING_SOURCE_ID": missing("source_id"), "DUPLICATE_SOURCE_ID": ~missing("source_id") & (F.col("_id") > 1),
        "UNSUPPORTED_ADAPTER": ~F.coalesce(F.col("adapter").isin(*ADAPTERS), F.lit(False)), "INVALID_ENABLED_FLAG": F.col("enabled").isNull(),
        "MISSING_DISABLED_REASON": ~F.coalesce("enabled", F.lit(False)) & missing("disabled_reason"), "NON_PRIMARY_OFFICIAL_SOURCE": ~primary, "MISSING_REQUIRED_FIELD": missing("name"),
        "INVALID_SEC_CIK": sec & ~good_cik, "DUPLICATE_SEC_CIK": F.col("_good") & (F.col("_cik") > 1), "MISSING_SEC_URL_CIK": sec & url_cik(url).isNull(),
        "SEC_URL_CIK_MISMATCH": sec & F.coalesce(url_cik(url) != cik, F.lit(False)),
        "INVALID_SEC_TICKER": sec & ~F.coalesce(F.col("ticker").rlike(r"^[A-Z][A-Z0-9.\-]{0,9}$"), F.lit(False)),
        "INVALID_TDNET_CODES": tdnet & ((F.size(codes) == 0) | (F.size(four) != F.size(codes)) | (F.size(F.array_distinct(four)) != F.size(four))),
        "INVALID_TDNET_COMPANIES": tdnet & F.col("companies").isNull(),
        "TDNET_CODE_COMPANY_MISMATCH": tdnet & ((F.size(F.array_except(four, F.map_keys(companies))) > 0) | (F.size(F.array_except(F.map_keys(companies), four)) > 0)),
        "OPENDART_ENABLED_WITHOUT_AUTH_CONTRACT": F.col("adapter").eqNullSafe("opendart") & F.coalesce("enabled", F.lit(False))})
    listed = sources.where(tdnet).select("source_id", F.col(order).alias("_o"), F.posexplode(F.array_distinct(four)).alias("_p", "_code"), companies.alias("_all"))
    listed = listed.withColumn("_c", F.element_at("_all", F.col("_code"))).where(F.col("_c").isNotNull())
    mine = issues(listed, "source_registry", F.col("source_id"), {
        "MISSING_TDNET_COMPANY_ID": F.coalesce(F.col("_c.id"), F.lit("")) == "", "TDNET_TICKER_CODE_MISMATCH": ~F.col("_c.ticker").eqNullSafe(F.col("_code")),
        "MISSING_REQUIRED_FIELD": F.trim(F.coalesce(F.col("_c.name"), F.lit(""))) == ""}, F.col("_code"))
    named = sources.where(sec & ~missing("source_id")).select("source_id", F.col("source_id").alias("_company"), F.col(order).alias("_o"), F.lit(-1).alias("_p"), F.lit("").alias("_code"))
    named = named.unionByName(listed.where(F.coalesce(F.col("_c.id"), F.lit("")) != "").select("source_id", F.col("_c.id").alias("_company"), "_o", "_p", "_code"))
    named = named.withColumn("_n", F.row_number().over(Window.partitionBy("_company").orderBy("_o", "_p")))
    return whole.unionByName(mine).unionByName(issues(named, "source_registry", F.col("source_id"), {"DUPLICATE_COMPANY_ID": F.col("_n") > 1}, F.col("_code")))


#: Fixed words that no key of an actual may hold, and texts that no value of one may be.
ESTIMATE_WORDS = ("consensus", "estimate", "estimated", "expected", "forecast", "analyst", "street", "beat", "miss", "surprise")
ESTIMATE_VALUES = (*ESTIMATE_WORDS, "analyst_estimate", "analyst_consensus", "street_estimate", "street_consensus", "consensus_estimate", "consensus_forecast")


def consensus_separation(rows: DataFrame, key: str, keys: str, values: str) -> DataFrame:
    """Records of actuals (arrays of their keys and of their text values) that name an estimate.

    A key may not hold a word of estimates anywhere in it; a value is only an issue
    if it is such a term as a whole, so that a note may say that there is no consensus.
    """
    plain = lambda k: F.replace(F.lower(k), F.lit("-"), F.lit("_"))
    word = lambda k: F.greatest(*(F.contains(plain(k), F.lit(w)) for w in ESTIMATE_WORDS))
    term = lambda v: F.regexp_replace(F.regexp_replace(F.lower(F.trim(v)), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return issues(rows, "consensus_separation", F.col(key), {
        "FORBIDDEN_KEY": F.coalesce(F.exists(keys, word), F.lit(False)),
        "FORBIDDEN_VALUE": F.coalesce(F.exists(values, lambda v: term(v).isin(*ESTIMATE_VALUES)), F.lit(False))})


def snapshot(facts: DataFrame) -> DataFrame:
    """Facts of one snapshot (company, tag, period, unit, value): unique, one period, whole dollars, no zero cash flow."""
    n = F.count("*").over(Window.partitionBy("company", "tag"))
    periods = F.size(F.collect_set("period").over(Window.partitionBy("company")))
    return issues(facts.withColumn("_n", n).withColumn("_p", periods), "snapshot", F.col("company"), {
        "MISSING_FIELD": missing("company") | missing("tag") | missing("period"), "DUPLICATE_FACT": F.col("_n") > 1, "SEVERAL_PERIODS": F.col("_p") > 1,
        "NOT_WHOLE_USD": (F.col("unit") != "USD") | (F.col("value") != F.floor("value")), "ZERO_CASH_FLOW": (F.col("tag") == "operating_cash_flow") & (F.col("value") == 0)}, F.col("tag"))


def money_units(rows: DataFrame, key: str, value: str, unit: str) -> DataFrame:
    """Published amounts must be in base units: a missing, unsupported or scaled unit is an issue."""
    from quern.functions.scalars import MONEY_UNITS

    base = [u for u, _, f in MONEY_UNITS if f == 1]
    scaled = [u for u, _, f in MONEY_UNITS if f != 1]
    u = F.col(unit)
    return issues(rows.where(F.col(value).isNotNull()), "money_units", F.col(key), {
        "MISSING_UNIT": u.isNull(), "UNSUPPORTED_UNIT": ~F.coalesce(u.isin(*base, *scaled), F.lit(True)), "SCALED_UNIT": F.coalesce(u.isin(*scaled), F.lit(False))})


#: Fixed reasons of the two stages, and what each adapter's rejected rows must carry.
DISCOVERY_REASONS = ("NOT_EARNINGS_RELATED", "UNVERIFIED_6K", "SOURCE_FETCH_FAILED")
VALIDATION_REASONS = (
    "OUTSIDE_TIME_WINDOW", "UNKNOWN_PUBLISHED_TIME", "STALE_FISCAL_PERIOD", "DUPLICATE", "NOT_PRIMARY_SOURCE", "FUTURE_EARNINGS_EVENT", "REPOST", "MISMATCHED_COMPANY", "UNVERIFIED_NUMBER")
REJECTED_FIELDS = (
    "schema_version", "event_id", "company_id", "company_name", "document_type", "published_at", "published_timezone", "retrieved_at", "source_adapter", "source_url")
EVENT_VERSION = "earnings-event.v1"
REJECTING = {"sec_edgar": ("www.sec.gov", ("accession_number", "cik"), "UTC"), "tdnet_public": ("www.release.tdnet.info", ("security_code",), "Asia/Tokyo")}


def rejection_stage(reason: Column) -> Column:
    return F.when(reason.isin(*DISCOVERY_REASONS), "DISCOVERY_FILTER").when(reason.isin(*VALIDATION_REASONS), "CANONICAL_VALIDATION").otherwise("UNKNOWN")


def rejections(rejected: DataFrame, accepted: DataFrame) -> DataFrame:
    """Rejected rows (REJECTED_FIELDS and freshness, rejection_reason, accession_number, cik, security_code; times as text): identity, provenance, reason."""
    from quern.functions.scalars import instant

    key, reason = F.coalesce("event_id", F.lit("")), F.coalesce("rejection_reason", F.lit(""))
    ids = rejected.groupBy(key.alias("event_id")).agg(F.count("*").alias("n"))
    both = ids.join(accepted.select("event_id").where(~missing("event_id")).distinct(), "event_id", "left_semi")
    shown, got = instant(F.col("published_at")), instant(F.col("retrieved_at"))
    known, host_, lacks, zone = F.lit(False), F.lit(False), F.lit(False), F.lit(False)
    netloc = F.coalesce(F.regexp_extract("source_url", r"^https://([^/?#]*)", 1), F.lit(""))
    for name, (domain, identity, tz) in REJECTING.items():
        mine = F.col("source_adapter").eqNullSafe(name)
        known, host_ = known | mine, host_ | (mine & (netloc != domain))
        lacks = lacks | (mine & reduce(lambda a, b: a | b, (F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in identity)))
        zone = zone | (mine & ~F.col("published_timezone").eqNullSafe(tz))
    form = F.coalesce("document_type", F.lit(""))
    rows = issues(rejected, "rejections", key, {
        "MISSING_REJECTION_PROVENANCE_FIELD": reduce(lambda a, b: a | b, (F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in REJECTED_FIELDS)),
        "INVALID_REJECTED_SCHEMA_VERSION": ~F.col("schema_version").eqNullSafe(EVENT_VERSION),
        "INVALID_REJECTED_PUBLISHED_AT": shown.isNull(), "INVALID_REJECTED_RETRIEVED_AT": got.isNull(), "REJECTED_RETRIEVED_BEFORE_PUBLISHED": F.coalesce(got < shown, F.lit(False)),
        "UNKNOWN_REJECTION_SOURCE_ADAPTER": ~known, "REJECTION_SOURCE_DOMAIN_MISMATCH": host_, "MISSING_REJECTION_SOURCE_IDENTITY": lacks, "REJECTION_PUBLISHED_TIMEZONE_MISMATCH": zone,
        "REJECTED_ROW_NOT_MARKED_REJECTED": ~F.col("freshness").eqNullSafe("REJECTED"), "MISSING_REJECTION_REASON": reason == "",
        "UNKNOWN_REJECTION_REASON": (reason != "") & (rejection_stage(reason) == "UNKNOWN"),
        "UNVERIFIED_6K_REASON_FORM_MISMATCH": (reason == "UNVERIFIED_6K") & (form != "6-K"), "SOURCE_FETCH_FAILED_REASON_FORM_MISMATCH": (reason == "SOURCE_FETCH_FAILED") & (form != "6-K"),
        "SIX_K_CONTENT_REJECTION_NON_SEC_SOURCE": (reason == "NOT_EARNINGS_RELATED") & (form == "6-K") & ~F.col("source_adapter").eqNullSafe("sec_edgar")})
    return report([
        rows, issues(ids, "rejections", F.col("event_id"), {
            "MISSING_REJECTED_EVENT_ID": F.col("event_id") == "", "DUPLICATE_REJECTED_EVENT_ID": (F.col("event_id") != "") & (F.col("n") > 1)}),
        issues(both, "rejections", F.col("event_id"), {"EVENT_ACCEPTED_AND_REJECTED": F.lit(True)})])


#: Fixed columns that a metric shares with its event.
SHARED = {"company_id": "company_id", "ticker": "ticker", "accession_number": "accession_number", "document_type": "document_type", "period_end": "report_date"}
FACTS_PREFIX = "https://data.sec.gov/api/xbrl/companyfacts/CIK"


def metric_lineage(metrics: DataFrame, events: DataFrame, proofs: DataFrame, order: str) -> DataFrame:
    """Metrics against their accepted events and their evidence by event_id.

    A metric without an id, or after the first of one, has that issue only, as has
    one without an event; the others must agree with a fresh event of the
    regulator's and with evidence that passed. Events and proofs: the last row of an id counts.
    """
    e = events.groupBy("event_id").agg(F.max_by(F.struct("company_id", "ticker", "accession_number", "document_type", "report_date", "freshness", "source_adapter"), order).alias("_e"))
    p = proofs.groupBy("event_id").agg(F.max_by(F.struct("company_id", "document_type", "status"), order).alias("_p"))
    at = F.row_number().over(Window.partitionBy("event_id").orderBy(order))
    j = metrics.withColumn("_at", at).join(e, "event_id", "left").join(p, "event_id", "left")
    lacks = missing("event_id") | (F.col("_at") > 1)
    there = ~lacks & F.col("_e").isNotNull()
    unlike = lambda a, b: ~F.col(a).eqNullSafe(F.col(b))
    passed = F.col("_p.status").eqNullSafe("PASS")
    codes = {
        "DUPLICATE_OR_MISSING_EVENT_ID": lacks, "METRIC_WITHOUT_ACCEPTED_EVENT": ~lacks & F.col("_e").isNull(), "METRIC_EVENT_NOT_FRESH": there & ~F.col("_e.freshness").eqNullSafe("PASS"),
        "METRIC_EVENT_NOT_SEC": there & ~F.col("_e.source_adapter").eqNullSafe("sec_edgar"),
        "METRIC_EVENT_FORM_NOT_ALLOWED": there & ~F.coalesce(F.col("_e.document_type").isin("10-K", "10-Q"), F.lit(False))}
    codes |= {f"METRIC_EVENT_MISMATCH:{m}": there & unlike(m, f"_e.{c}") for m, c in SHARED.items()}
    codes |= {
        "UNSAFE_METRIC_CONTRACT": there & ~(F.col("metric").eqNullSafe("revenue") & F.col("unit").eqNullSafe("USD") & F.col("taxonomy").eqNullSafe("us-gaap")),
        "NON_PRIMARY_METRIC_SOURCE": there & ~F.coalesce(F.col("source_url").startswith(FACTS_PREFIX), F.lit(False)), "MISSING_PASS_EVIDENCE": there & ~passed,
        "EVIDENCE_EVENT_MISMATCH": there & passed & (unlike("_p.company_id", "_e.company_id") | unlike("_p.document_type", "_e.document_type"))}
    return issues(j, "metric_lineage", F.col("event_id"), codes)


def lineage_totals(metrics: DataFrame, claimed: int, metrics_status: str, evidence_status: str) -> DataFrame:
    """The documents as wholes: both passed, and the claimed number of metrics is theirs."""
    n = metrics.agg(F.count("*").alias("n"))
    return issues(n, "metric_lineage", F.lit(""), {
        "VERIFIED_METRICS_NOT_PASS": F.lit(metrics_status != "PASS"), "EVIDENCE_NOT_PASS": F.lit(evidence_status != "PASS"), "VERIFIED_METRIC_COUNT_MISMATCH": F.col("n") != claimed})


def page_boundary(rendered: DataFrame, published: DataFrame, key: str) -> DataFrame:
    """Ids on a page must be just the published ones."""
    from quern.operators.keyed import coverage

    found = coverage(published, rendered, key)
    return found.select(F.lit("page_boundary").alias("audit"), F.when(F.col("problem") == "missing", "NOT_RENDERED").otherwise("STALE_ID").alias("code"),
                        F.col(key).cast("string").alias("key"), F.lit("").alias("detail"))
