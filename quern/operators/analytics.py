"""Company analytics: scenarios, rules, classes, peers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators import ranges

#: Fixed scenarios: fall of operating cash flow, cut of capital expenditure.
SCENARIOS = (("cycle", 0.30, 0.15), ("severe", 0.60, 0.35), ("crisis", 0.90, 0.50))


def scenarios(companies: DataFrame, cash_flow: str = "operating_cash_flow", capex: str = "capex", liquidity: str = "liquidity") -> DataFrame:
    """Each company under each scenario: stressed flows, yearly burn, runway in years and its band. Three rows from one, by explode."""
    three = F.array(*(F.struct(F.lit(n).alias("scenario"), F.lit(d).alias("decline"), F.lit(c).alias("cut")) for n, d, c in SCENARIOS))
    out = companies.withColumn("_s", F.explode(three)).select(*companies.columns, "_s.*")
    whole = lambda c, fall: F.bround(F.col(c).cast("double") * (1 - F.col(fall)))  # noqa: E731  halves to even
    out = out.withColumns({"stressed_cash_flow": whole(cash_flow, "decline"), "stressed_capex": whole(capex, "cut")})
    out = out.withColumn("stressed_free_cash_flow", F.col("stressed_cash_flow") - F.col("stressed_capex"))
    out = out.withColumn("burn", F.greatest(-F.col("stressed_free_cash_flow"), F.lit(0.0)))
    out = out.withColumn("runway_years", F.when(F.col("burn") > 0, F.col(liquidity) / F.col("burn")))
    return out.withColumn("band", runway_band(F.col("burn"), F.col("runway_years")))


def runway_band(burn: Column, runway: Column) -> Column:
    return (F.when(burn == 0, "self_funding").when(runway >= 5, "five_years_plus").when(runway >= 2, "two_to_five_years")
            .when(runway.isNotNull(), "under_two_years"))


#: Fixed rules: name, metric, kind and bound.
RULES = (
    ("severe_self_funding", "severe_stressed_fcf_usd", "at_least", 0.0),
    ("minimum_two_year_runway", "severe_runway_years", "at_least", 2.0),
    ("fcf_consistency", "positive_fcf_ratio", "at_least", 0.6),
    ("net_liquidity_nonnegative", "net_liquidity_usd", "at_least", 0.0),
    ("operating_profitability", "operating_margin", "above", 0.0),
    ("minimum_data_quality", "data_completeness", "at_least", 0.8),
)


def evaluated(metrics: DataFrame, key: str, rules: Sequence[tuple[str, str, str, float]] = RULES, exempt: dict[str, Column] | None = None) -> DataFrame:
    """(key, rule, value, result) for rules (name, metric, at_least, at_most or above, bound): pass, fail, or unknown without a value.

    exempt gives for a rule's name when it passes whatever its value: a
    self-funding company has no runway to fall short of, but its other rules stand.
    """
    free = lambda name: F.coalesce((exempt or {}).get(name, F.lit(False)), F.lit(False))
    listed = F.array(*(F.struct(
        F.lit(name).alias("rule"), F.col(metric).cast("double").alias("value"), F.lit(kind).alias("kind"), F.lit(float(bound)).alias("bound"), free(name).alias("free"))
        for name, metric, kind, bound in rules))
    out = metrics.select(key, F.explode(listed).alias("_r")).select(key, "_r.*")
    value, bound = F.col("value"), F.col("bound")
    good = F.when(F.col("kind") == "at_least", value >= bound).when(F.col("kind") == "above", value > bound).otherwise(value <= bound)
    result = F.when(F.col("free"), "pass").when(value.isNull(), "unknown").when(good, "pass").otherwise("fail")
    return out.select(key, "rule", "value", result.alias("result"))


def classified(companies: DataFrame, band: str = "severe_band", cash_flow: str = "latest_fcf", share: str = "data_completeness") -> DataFrame:
    """companies with `class`: vulnerable under two severe years; watch if the severe runway ends at all or cash flow is negative; then by completeness."""
    runs_out = F.coalesce(F.col(band).isin("two_to_five_years", "five_years_plus"), F.lit(False))
    kind = (F.when(F.col(band) == "under_two_years", "vulnerable").when(runs_out | (F.col(cash_flow) < 0), "watch")
            .when(F.col(share) < 0.8, "incomplete").otherwise("resilient"))
    return companies.withColumn("class", kind)


def class_counts(classes: DataFrame, labels: Sequence[str] = ("resilient", "watch", "vulnerable", "incomplete")) -> DataFrame:
    """Counts of every class, zeros included."""
    return classes.groupBy().agg(*(F.count_if(F.col("class") == x).alias(x) for x in labels)).unpivot([], list(labels), "class", "companies")


def mid_rank(df: DataFrame, group: Sequence[str], value: str, places: int = 4) -> DataFrame:
    """df with `percentile`: (below + half of equal) / all within the group, among rows with a value. Ranks are those of distinct values, so no group is one task."""
    ranks = ranges.ranked(df, group, value)
    share = (F.col("below").cast("double") + 0.5 * F.col("ties").cast("double")) / F.col("rows").cast("double")
    named = ranks.select(*(F.col(c).alias(f"_r{i}") for i, c in enumerate([*group, value])), F.round(share, places).alias("percentile"))
    same = [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate([*group, value])]
    return df.where(F.col(value).isNotNull()).join(named, same).select(*df.columns, "percentile")


def peer_stats(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, peers, median, deviation): mean of the middle two; population deviation from two values on."""
    spread = F.when(F.count(value) >= 2, F.stddev_pop(value))
    sums = df.groupBy(*group).agg(F.count(value).alias("peers"), spread.alias("deviation"))
    middle = ranges.medians(df, group, value).select(
        *(F.col(c).alias(f"_r{i}") for i, c in enumerate(group)), ((F.col("lower").cast("double") + F.col("upper").cast("double")) / 2).alias("median"))
    same = [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(group)]
    return sums.join(middle, same, "left").select(*group, "peers", "median", "deviation")


def with_peers(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """df with its group's peers, peer_median and peer_deviation, and how far the value is from the median; rows without a value keep the group's figures."""
    stats = peer_stats(df, group, value)
    named = stats.select(*(F.col(c).alias(f"_r{i}") for i, c in enumerate(group)), "peers", F.col("median").alias("peer_median"), F.col("deviation").alias("peer_deviation"))
    same = [F.col(c).eqNullSafe(F.col(f"_r{i}")) for i, c in enumerate(group)]
    joined = df.join(named, same, "left").select(*df.columns, "peers", "peer_median", "peer_deviation")
    return joined.withColumn("from_median", F.col(value) - F.col("peer_median"))


def liquidity_and_debt(df: DataFrame) -> DataFrame:
    """df with liquidity, debt and debt_method from cash, investments, debt_current, debt_noncurrent, debt_total."""
    parts = F.col("debt_current").isNotNull() | F.col("debt_noncurrent").isNotNull()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    liquid = F.when(F.col("cash").isNotNull(), F.col("cash") + zero("investments"))
    debt = F.when(parts, zero("debt_current") + zero("debt_noncurrent")).otherwise(F.col("debt_total"))
    method = F.when(parts, "components").when(F.col("debt_total").isNotNull(), "reported_total").otherwise("missing")
    return df.withColumn("liquidity", liquid).withColumn("debt", debt).withColumn("debt_method", method)


def completeness(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """df with `present` and `completeness`: how many of the checks hold, and their share."""
    held = sum((F.when(F.coalesce(c, F.lit(False)), 1).otherwise(0) for c in checks.values()), F.lit(0))
    return df.withColumn("present", held).withColumn("completeness", F.col("present") / len(checks))


def margin_delta_bp(now: Column, before: Column) -> Column:
    return F.bround((now - before) * 10_000).cast("long")
