"""Verified metrics and their growth. Every step gives an outcome: a value, not calculated with a reason, or an issue."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions.scalars import days, percent_change
from quern.operators.bands import banded

#: Fixed day bounds of comparable periods.
YEAR_GAP = (350, 380)
QUARTER = (70, 110)
DURATION_SLACK = 7


def verified(events: DataFrame, facts: DataFrame, key: Sequence[str], signature: Sequence[str], value: str, name: str) -> DataFrame:
    """(event key, value, outcome, issue) of each event whose key a fact matches exactly.

    No fact: NO_VERIFIED_<NAME>; several distinct signatures: AMBIGUOUS_<NAME>. A
    signature of values only lets equal values of several rows pass; one with the
    period takes equal values of different periods for ambiguous.
    """
    found = facts.groupBy(*key).agg(F.count_distinct(F.struct(*signature)).alias("_n"), F.min(value).alias("_v"))
    joined = events.join(found, list(key), "left")
    issue = F.when(F.col("_n").isNull(), f"NO_VERIFIED_{name}").when(F.col("_n") > 1, f"AMBIGUOUS_{name}")
    outcome = F.when(F.col("_n") == 1, "verified").otherwise("issue")
    return joined.select(*events.columns, F.when(F.col("_n") == 1, F.col("_v")).alias("value"), outcome.alias("outcome"), issue.alias("issue"))


def free_cash_flow(cash: DataFrame, capex: DataFrame, key: Sequence[str], magnitude: bool = False) -> DataFrame:
    """Operating cash less capital expenditure of one event; both must be there and cover one period.

    With `magnitude` the expenditure counts by its size, as in series that report outflows with either sign.
    """
    a = cash.select(*key, F.struct("period_start", "period_end").alias("_pa"), F.col("value").alias("_a"))
    b = capex.select(*key, F.struct("period_start", "period_end").alias("_pb"), F.col("value").alias("_b"))
    joined = a.join(b, list(key), "full_outer")
    issue = (F.when(F.col("_a").isNull(), "MISSING_OPERATING_CASH_FLOW").when(F.col("_b").isNull(), "MISSING_CAPITAL_EXPENDITURE")
             .when(F.col("_pa") != F.col("_pb"), "PERIOD_MISMATCH"))
    joined = joined.withColumn("issue", issue)
    return joined.select(*key, F.when(F.col("issue").isNull(), F.col("_a") - (F.abs("_b") if magnitude else F.col("_b"))).alias("value"), "issue")


def compared(
    current: DataFrame, prior: DataFrame, keys: Sequence[str], gap: tuple[int, int], length: tuple[int, int] | None = None, soft: Sequence[str] = ()
) -> DataFrame:
    """Growth of each current row over the prior row of its key whose end lies `gap` days before; durations within a week.

    current and prior: keys, period_start, period_end, value, and the columns
    `soft`, which must agree where both have them. Rows that repeat a period and
    value count once on either side. Priors are reduced to one row for each period
    before a band join in day buckets, so a hot key is neither one task nor pairs.
    Outcome: growth, not_calculated (NO_COMPARABLE_PERIOD, OUTSIDE_LENGTH), or issue
    (AMBIGUOUS_CURRENT if a value of one end has several starts, AMBIGUOUS_PRIOR,
    ZERO_PRIOR).
    """
    columns = [*keys, "period_start", "period_end", "value", *soft]
    period = [*keys, "period_start", "period_end", *soft]
    rows = current.select(*columns).distinct()
    several = rows.groupBy(*keys, "period_end", "value").agg(F.min("period_start").alias("_first"), F.max("period_start").alias("_last"))
    of = prior.where(F.col("value").isNotNull()).groupBy(*period).agg(F.min("value").alias("_least"), F.max("value").alias("_most"))
    joined = banded(rows, of, keys, F.col("period_end"), F.col("period_end"), gap, "_p")
    p = F.col("_p")
    fits = F.abs(days(F.col("period_start"), F.col("period_end")) - days(p["period_start"], p["period_end"])) <= DURATION_SLACK
    for c in soft:
        fits = fits & F.coalesce(p[c] == F.col(c), F.lit(True))
    one = lambda v: F.when(fits, F.struct(p["period_start"].alias("start"), p["period_end"].alias("end"), p[v].alias("value")))
    found = joined.groupBy(*columns).agg(F.min(one("_least")).alias("_p"), F.max(one("_most")).alias("_q"))
    same = several.where(F.col("_first") != F.col("_last")).select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, "period_end", "value"])), F.lit(True).alias("_several"))
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*keys, "period_end", "value"])]
    found = found.join(same, on, "left")
    within = days(F.col("period_start"), F.col("period_end")).between(*length) if length else F.lit(True)
    reason = (F.when(F.col("_several"), "AMBIGUOUS_CURRENT").when(~within, "OUTSIDE_LENGTH").when(F.col("_p").isNull(), "NO_COMPARABLE_PERIOD")
              .when(F.col("_p") != F.col("_q"), "AMBIGUOUS_PRIOR").when(p["value"] == 0, "ZERO_PRIOR"))
    found = found.withColumn("reason", reason)
    outcome = F.when(F.col("reason").isNull(), "growth").when(F.col("reason").isin("OUTSIDE_LENGTH", "NO_COMPARABLE_PERIOD"), "not_calculated").otherwise("issue")
    ok = F.col("reason").isNull()
    return found.select(
        *columns, F.when(ok, p["end"]).alias("prior_end"), F.when(ok, p["value"]).alias("prior_value"),
        F.when(ok, percent_change(F.col("value"), p["value"])).alias("percent"), outcome.alias("outcome"), "reason")


def year_on_year(facts: DataFrame, keys: Sequence[str], soft: Sequence[str] = ()) -> DataFrame:
    """Within one filing if the keys name it (entity, accession, form), with the fiscal period as `soft`."""
    return compared(facts, facts, keys, YEAR_GAP, soft=soft)


def quarter_on_quarter(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return compared(facts, facts, keys, QUARTER, QUARTER)


#: Of each growth: the name of its prior, the days between the ends, and whether the prior must be of the same filing.
SPECS = (("QoQ", "QUARTER", QUARTER, False), ("YoY", "YEAR", YEAR_GAP, True))
NOT_CALCULATED = ("CURRENT_FACT_NOT_STANDALONE_QUARTER", "NO_COMPARABLE_PRIOR_QUARTER_ACTUAL", "NO_COMPARABLE_PRIOR_YEAR_ACTUAL")


def persisted(metrics: DataFrame, actuals: DataFrame) -> DataFrame:
    """Both growths of verified metrics over the persisted actuals, a row for each event and growth, with its outcome and reason.

    metrics: event_id, company_id, concept, accession_number, document_type,
    period_end, value. actuals: company_id, concept, unit, accession_number,
    document_type, period_start, period_end, value, duration_days. A metric's own
    fact agrees in all it names; facts that repeat a period and value count once.
    Priors are facts of its company and concept in dollars: for QoQ of any form and
    filing, for YoY of the same filing. A metric without just one own fact is one
    row without growth_type, AMBIGUOUS_CURRENT_PERSISTED_ACTUAL.
    """
    dollars = actuals.where(F.col("unit") == "USD")
    own = ["company_id", "concept", "accession_number", "document_type", "period_end", "value"]
    fact = lambda: F.struct("period_start", "duration_days")
    facts = dollars.groupBy(*own).agg(F.min(fact()).alias("_first"), F.min("period_start").alias("_s"), F.max("period_start").alias("_t"))
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in own]
    joined = metrics.select("event_id", *own).join(facts.select(*(F.col(k).alias(f"_{k}") for k in own), "_first", "_s", "_t"), same, "left")
    one = F.col("_first").isNotNull() & F.col("_s").eqNullSafe(F.col("_t"))
    placed = joined.withColumn("_one", one).select("event_id", *own, "_one", F.col("_first.period_start").alias("period_start"), F.col("_first.duration_days").alias("duration"))
    bad = placed.where(~F.col("_one")).select(
        "event_id", "company_id", F.lit(None).cast("string").alias("growth_type"), F.lit(None).cast("date").alias("prior_start"), F.lit(None).cast("date").alias("prior_end"),
        F.lit(None).cast("double").alias("prior_value"), F.lit(None).cast("double").alias("percent"), F.lit("AMBIGUOUS_CURRENT_PERSISTED_ACTUAL").alias("reason"))
    good = placed.where("_one").drop("_one")
    parts = [bad]
    for name, word, gap, same_filing in SPECS:
        keys = ["company_id", "concept", *(["accession_number"] if same_filing else [])]
        of = dollars.groupBy(*keys, "period_start", "period_end").agg(
            F.min("value").alias("least"), F.max("value").alias("most"), F.min("duration_days").alias("shortest"), F.max("duration_days").alias("longest"))
        p = F.col("_p")
        near = lambda d: F.abs(F.col("duration") - p[d]) <= DURATION_SLACK
        pick = lambda v: F.when(near("shortest") | near("longest"), F.struct(p["period_start"].alias("start"), p["period_end"].alias("end"), p[v].alias("value")))
        kept = ["event_id", *own, "period_start", "duration"]
        found = banded(good, of, keys, F.col("period_end"), F.col("period_end"), gap, "_p").groupBy(*kept).agg(F.min(pick("least")).alias("_a"), F.max(pick("most")).alias("_b"))
        a = F.col("_a")
        reason = F.when(F.lit(not same_filing) & ~F.col("duration").between(*QUARTER), NOT_CALCULATED[0]) if not same_filing else F.when(F.lit(False), "")
        reason = (reason.when(a.isNull(), f"NO_COMPARABLE_PRIOR_{word}_ACTUAL").when(a != F.col("_b"), f"AMBIGUOUS_PRIOR_{word}_ACTUAL")
                  .when((a["value"] == 0) | a["value"].isNull() | F.col("value").isNull(), "ZERO_OR_INVALID_PRIOR_VALUE"))
        out = found.withColumn("reason", reason)
        ok = F.col("reason").isNull()
        parts.append(out.select(
            "event_id", "company_id", F.lit(name).alias("growth_type"), F.when(ok, a["start"]).alias("prior_start"), F.when(ok, a["end"]).alias("prior_end"),
            F.when(ok, a["value"]).cast("double").alias("prior_value"), F.when(ok, percent_change(F.col("value"), a["value"])).cast("double").alias("percent"), "reason"))
    every = reduce(lambda x, y: x.unionByName(y), parts)
    return every.withColumn("outcome", F.when(F.col("reason").isNull(), "growth").when(F.col("reason").isin(*NOT_CALCULATED), "not_calculated").otherwise("issue"))


def multi_period_actuals(facts: DataFrame, key: Sequence[str], ordinal: str) -> DataFrame:
    """Facts with a positive duration, unique on the key (last wins), with duration_days."""
    from quern.operators.keyed import latest_per_key

    timed = facts.withColumn("duration_days", days(F.col("period_start"), F.col("period_end"))).where("duration_days > 0")
    return latest_per_key(timed, key, [F.desc(ordinal)])
