"""Filings and their collection: acceptance rules, windows, periods, source choice, request plans, observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.scalars import days, period_type, stable_id
from quern.functions.text import earnings_text

#: Fixed forms that are accepted as they are.
FORMS = ("10-Q", "10-K", "20-F")
#: Fixed fields of an observation with their types; every feed is padded to them.
OBSERVATION = {
    "id": "string", "entity_id": "string", "concept_id": "string", "value_type": "string", "value": "double", "value_low": "double", "value_high": "double",
    "unit": "string", "currency": "string", "period_start": "date", "period_end": "date", "period_type": "string", "fiscal_year": "int", "fiscal_period": "string",
    "scope": "string", "segment": "string", "geography": "string", "as_of": "date", "observed_at": "timestamp", "filed_at": "date", "revision": "int",
    "source_tier": "string", "source_name": "string", "source_url": "string", "document_form": "string", "accession": "string", "source_tag": "string",
    "source_api_url": "string", "model_id": "string", "formula": "string", "assumptions": "array<string>", "evidence_ids": "array<string>", "supersedes_id": "string",
    "quality_flags": "array<string>", "source_id": "string",
}
#: Fixed values of fields that a feed leaves out; all others are null.
DEFAULTS = {"scope": "consolidated", "revision": 0, "assumptions": (), "evidence_ids": (), "quality_flags": ()}


def form_reason(form: Column, items: Column, text: Column, document: Column | None = None) -> Column:
    """Null if a filing is accepted, else why not: 8-K by its item 2.02, 6-K by its text, else by its form.

    document names the filing's main document: without it a 6-K is UNVERIFIED_6K,
    with it but without its text SOURCE_FETCH_FAILED.
    """
    unrelated = "NOT_EARNINGS_RELATED"
    named = F.coalesce(document, F.lit("")) != "" if document is not None else text.isNotNull()
    six = F.when(~named, "UNVERIFIED_6K").when(text.isNull(), "SOURCE_FETCH_FAILED").when(~earnings_text(text), unrelated)
    return (F.when(form == "8-K", F.when(~F.contains(F.coalesce(items, F.lit("")), F.lit("2.02")), unrelated))
            .when(form == "6-K", six).when(form.isin(*FORMS), F.lit(None).cast("string")).otherwise(unrelated))


def screened(filings: DataFrame, start: Column, end: Column) -> DataFrame:
    """filings (form, items, text, document, accepted_at) of the half-open window, with `freshness` PASS or REJECTED and `rejection_reason`.

    Filings without an acceptance time or outside the window are neither accepted nor rejected.
    """
    at = F.col("accepted_at")
    inside = filings.where((at >= start) & (at < end))
    reason = form_reason(F.col("form"), F.col("items"), F.col("text"), F.col("document"))
    return inside.withColumn("rejection_reason", reason).withColumn("freshness", F.when(F.col("rejection_reason").isNull(), "PASS").otherwise("REJECTED"))


def has_keyword(title: Column, words: Sequence[str]) -> Column:
    return F.coalesce(title.rlike("|".join(w.replace("(", r"\(").replace(")", r"\)") for w in words)), F.lit(False))


def local_day_window(day: Column, hour: int = 7, zone: str = "Asia/Tokyo") -> tuple[Column, Column]:
    """The half-open day that ends at `hour` local time of `day`, as instants."""
    end = F.to_utc_timestamp(day.cast("timestamp") + F.expr(f"interval {hour} hours"), zone)
    return end - F.expr("interval 24 hours"), end


def in_local_day(ts: Column, day: Column, hour: int = 7, zone: str = "Asia/Tokyo") -> Column:
    start, end = local_day_window(day, hour, zone)
    return (ts >= start) & (ts < end)


def in_window_or_required(df: DataFrame, time: str, start: Column, end: Column, key: str, required: DataFrame) -> DataFrame:
    """df with `why`: window, required or both; rows with neither go."""
    wanted = required.select(F.col(key).alias("_want")).distinct()
    joined = df.join(wanted, df[key] == F.col("_want"), "left")
    inside, asked = F.coalesce(F.col(time).between(start, end), F.lit(False)), F.col("_want").isNotNull()
    out = joined.withColumn("why", F.when(inside & asked, "both").when(inside, "window").when(asked, "required"))
    return out.where(F.col("why").isNotNull()).drop("_want")


def eligible(unit: Column, form: Column, start: Column, end: Column, forms: Sequence[str], low: int, high: int) -> Column:
    """A fact in dollars, of an accepted form, with a start and a duration in bounds."""
    return F.coalesce((unit == "USD") & form.isin(*forms) & start.isNotNull() & days(start, end).between(low, high), F.lit(False))


def reporting_period(form: Column, report_date: Column, published: Column) -> tuple[Column, Column]:
    """(kind, issue): annual or interim by form only, never a guessed quarter; a period can't end after publication."""
    kind = F.when(form.isin("10-K", "20-F", "40-F"), "annual").when(form.isin("10-Q", "6-K", "8-K"), "interim")
    issue = (F.when(report_date.isNull(), "MISSING_PERIOD_END").when(kind.isNull(), "UNKNOWN_FORM")
             .when(report_date > published.cast("date"), "PERIOD_AFTER_PUBLICATION"))
    return F.when(issue.isNull(), kind), issue


def canonical_source(source_type: Column, previous_type: Column, primary: Sequence[str]) -> Column:
    """Null if both a quarter's source and that of the value before it are primary, else why it is quarantined."""
    return (F.when(~F.coalesce(source_type.isin(*primary), F.lit(False)), "third_party_source")
            .when(previous_type.isNotNull() & ~previous_type.isin(*primary), "third_party_previous_source"))


def prior_year_same_period(df: DataFrame, keys: Sequence[str], year: str, period: str, value: str, order: str) -> DataFrame:
    """df with prior_year_value: that of the same fiscal period a year before, the first by `order` if it was restated; a window, not a self-join."""
    w = Window.partitionBy(*keys, period).orderBy(year).rangeBetween(-1, -1)
    return df.withColumn("prior_year_value", F.min_by(value, order).over(w))


def members(df: DataFrame, roles: str, cohorts: DataFrame) -> DataFrame:
    """df rows in each cohort (cohort, accepted_roles) that takes one of their roles; exploded roles make it an equality join."""
    wanted = cohorts.select("cohort", F.explode("accepted_roles").alias("_role")).distinct()
    mine = df.withColumn("_role", F.explode(F.array_distinct(roles)))
    return mine.join(wanted, "_role").drop("_role").dropDuplicates(["cohort", *[c for c in df.columns if c != roles]])


def request_plan(requests: DataFrame, consumer: str, parts: Sequence[str]) -> DataFrame:
    """(fingerprint, parts, consumers): identical requests of several consumers are one."""
    print_of = stable_id(*(F.col(p) for p in parts), digits=64)
    return requests.groupBy(print_of.alias("fingerprint"), *parts).agg(F.array_sort(F.collect_set(consumer)).alias("consumers"))


def still_to_do(plan: DataFrame, log: DataFrame) -> DataFrame:
    """Requests of a plan without a success in the log (fingerprint, status)."""
    return plan.join(log.where("status = 'success'").select("fingerprint").distinct(), "fingerprint", "left_anti")


def latest_states(log: DataFrame, key: str, at: str, status: str) -> DataFrame:
    """The last state of each reservation of an append-only log; a run reserves first and completes or fails later."""
    return log.groupBy(key).agg(F.max_by(status, F.struct(at, status)).alias(status), F.count("*").alias("steps"))


def resolved_source(events: DataFrame, registry: DataFrame) -> DataFrame:
    """events (company, adapter) with source_id: the enabled source of both, else the adapter's only enabled source, else null."""
    on = registry.where("enabled")
    exact = on.groupBy("company", "adapter").agg(F.min("source_id").alias("_exact"))
    only = on.groupBy("adapter").agg(F.min("source_id").alias("_only"), F.count("*").alias("_n"))
    joined = events.join(exact, ["company", "adapter"], "left").join(only.where("_n = 1").drop("_n"), "adapter", "left")
    return joined.withColumn("source_id", F.coalesce("_exact", "_only")).select(*events.columns, "source_id")


def source_freshness(registry: DataFrame, observations: DataFrame, key: str, date: str, as_of: Column) -> DataFrame:
    """Each source (key, max_age_days or null) as fresh, stale, missing or not_enforced."""
    last = observations.groupBy(key).agg(F.max(date).alias("latest"))
    out = registry.join(last, key, "left").withColumn("age_days", F.datediff(as_of, F.col("latest")))
    state = (F.when(F.col("max_age_days").isNull(), "not_enforced").when(F.col("latest").isNull(), "missing")
             .when(F.col("age_days") > F.col("max_age_days"), "stale").otherwise("fresh"))
    return out.withColumn("state", state)


def coverage_gate(universe: DataFrame, rows: DataFrame, key: str, least: int) -> DataFrame:
    """(key, found) of members of the universe with fewer than `least` rows; empty means the gate is open."""
    counts = rows.groupBy(key).agg(F.count("*").alias("found"))
    out = universe.select(key).distinct().join(counts, key, "left").withColumn("found", F.coalesce("found", F.lit(0)))
    return out.where(F.col("found") < least)


def candidates(df: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """Documents (processed, dated, rank, url) by priority: unprocessed, newest, best rank, url; the remainder kept with a reason."""
    from quern.operators.keyed import top_k_with_remainder

    order = [F.asc("processed"), F.desc_nulls_last("dated"), F.asc_nulls_last("rank"), F.asc("url")]
    return top_k_with_remainder(df, keys, order, k, "per_source_limit")


def latest_unique(df: DataFrame, keys: Sequence[str], end: str, value: str) -> DataFrame:
    """(keys, end, value, status) of the latest period; several rows of it are ambiguous and give no value."""
    last = df.groupBy(*keys, end).agg(F.count("*").alias("_n"), F.min(value).alias(value))
    best = last.groupBy(*keys).agg(F.max_by(F.struct(end, value, "_n"), F.col(end)).alias("_b")).select(*keys, "_b.*")
    one = F.col("_n") == 1
    return best.select(*keys, end, F.when(one, F.col(value)).alias(value), F.when(one, "unique").otherwise("ambiguous").alias("status"))


def company_status(cash: DataFrame, capex: DataFrame, forms: DataFrame, key: str) -> DataFrame:
    """(key, status): which of a company's operating cash flow and capital expenditure facts (key, period_start, period_end) are there.

    forms (key, form) are the recent filings of all companies in question: without any fact, a 10-Q among them decides.
    """
    span = lambda df, name: df.select(key, F.struct("period_start", "period_end").alias(name))
    quarterly = forms.groupBy(key).agg(F.bool_or(F.col("form") == "10-Q").alias("_has"))
    j = quarterly.join(span(cash, "_a"), key, "full_outer").join(span(capex, "_b"), key, "full_outer")
    a, b = F.col("_a"), F.col("_b")
    none = F.when(F.coalesce("_has", F.lit(False)), "public_no_quarterly_10q_facts").otherwise("public_no_10q_facts_yet")
    status = (F.when(a.isNull() & b.isNull(), none).when(b.isNull(), "capital_expenditure_fact_unavailable")
              .when(a.eqNullSafe(b), "reported_facts_same_period").otherwise("reported_facts_period_mismatch"))
    return j.select(key, status.alias("status"))


def long_rows(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "metric", value: str = "value") -> DataFrame:
    """Wide to long, rows without a value left out."""
    return df.unpivot(list(ids), list(values), name, value).where(F.col(value).isNotNull())


def as_observations(df: DataFrame) -> DataFrame:
    """df padded to the observation's fields in their order, with their defaults; unknown columns are refused, the id and period type are derived if absent."""
    if extra := [c for c in df.columns if c not in OBSERVATION]:
        raise ValueError(f"not fields of an observation: {', '.join(extra)}")
    have = set(df.columns)
    out = df.select(*((F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in OBSERVATION.items()))
    parts = [F.col(c) for c in ("entity_id", "concept_id", "value_type", "period_start", "period_end", "source_url")]
    out = out.withColumn("id", F.coalesce("id", stable_id(*parts, prefix="observation")))
    for c, value in DEFAULTS.items():
        out = out.withColumn(c, F.coalesce(c, F.array() if value == () else F.lit(value)).cast(OBSERVATION[c]))
    kind = period_type(F.col("period_start"), F.col("period_end"), F.col("fiscal_period"))
    return out.withColumn("period_type", F.coalesce("period_type", kind))


def edges(facts: DataFrame, relation: str, source: str, targets: str) -> DataFrame:
    """(from_id, relationship, to_id) for each id in an array of evidence."""
    return facts.select(F.col(source).alias("from_id"), F.lit(relation).alias("relationship"), F.explode(targets).alias("to_id"))


def missing_accessions(required: DataFrame, base: DataFrame) -> DataFrame:
    """Required (cik, accession) pairs that the materialised base lacks: what a delta has to fetch."""
    return required.select("cik", "accession").distinct().join(base.select("cik", "accession").distinct(), ["cik", "accession"], "left_anti")


def with_delta(base: DataFrame, delta: DataFrame, key: Sequence[str]) -> DataFrame:
    """Base rows with `provenance` bulk, and delta rows whose key the base lacks with `provenance` api."""
    new = delta.join(base.select(*key).distinct(), list(key), "left_anti").select(*delta.columns)
    return base.withColumn("provenance", F.lit("bulk")).unionByName(new.withColumn("provenance", F.lit("api")), allowMissingColumns=True)
