"""Reporting periods: quarters from cumulative values, annual roll-ups, choice of concept, adjacent years."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.scalars import safe_divide
from quern.operators.bands import free_name


def quarters_from_cumulative(df: DataFrame, keys: Sequence[str], year: str, quarter: str, value: str) -> DataFrame:
    """Quarter values from year-to-date values; a year without all four quarters, or with a negative one, gives no rows."""
    whole = Window.partitionBy(*keys, year)
    before = F.lag(value).over(whole.orderBy(quarter))
    out = df.withColumn("_n", F.count(value).over(whole)).withColumn("quarter_value", F.col(value) - F.coalesce(before, F.lit(0)))
    out = out.withColumn("_least", F.min("quarter_value").over(whole))
    return out.where((F.col("_n") == 4) & (F.col("_least") >= 0)).drop("_n", "_least")


def direct_or_derived(df: DataFrame, keys: Sequence[str], year: str, quarter: str, direct: str, cumulative: str) -> DataFrame:
    """df with quarter_value and method: the directly reported quarter, else this less the last cumulative value."""
    before = F.lag(cumulative).over(Window.partitionBy(*keys, year).orderBy(quarter))
    derived = F.when(F.col(quarter) == 1, F.col(cumulative)).otherwise(F.col(cumulative) - before)
    method = F.when(F.col(direct).isNotNull(), "direct").when(derived.isNotNull(), "derived")
    return df.withColumn("quarter_value", F.coalesce(direct, derived)).withColumn("method", method)


def annual_from_quarters(df: DataFrame, keys: Sequence[str], year: str, quarter: str, flows: Sequence[str], stocks: Sequence[str] = ()) -> DataFrame:
    """One row a year: a flow's sum only if all four quarters have it, a stock's fourth-quarter value."""
    four = lambda c: F.when((F.count(c) == 4) & (F.count_distinct(F.when(F.col(c).isNotNull(), F.col(quarter))) == 4), F.sum(c)).alias(c)
    last = lambda c: F.max(F.when(F.col(quarter) == 4, F.col(c))).alias(c)
    return df.groupBy(*keys, year).agg(*map(four, flows), *map(last, stocks), F.count_distinct(quarter).alias("quarters"))


def recent_concept(df: DataFrame, keys: Sequence[str], concept: str, period_end: str, priority: Column) -> DataFrame:
    """(keys, concept, latest_end, periods): the concept with the latest period, then most periods, then least priority number."""
    stats = df.groupBy(*keys, concept).agg(F.max(period_end).alias("latest_end"), F.count_distinct(period_end).alias("periods"))
    order = F.struct("latest_end", "periods", (-priority).alias("p"))
    best = stats.groupBy(*keys).agg(F.max_by(F.struct(concept, "latest_end", "periods"), order).alias("_b"))
    return best.select(*keys, *(F.col("_b")[c].alias(c) for c in (concept, "latest_end", "periods")))


def first_listed_concept(df: DataFrame, keys: Sequence[str], concept: str, priority: Column) -> DataFrame:
    """The older choice: the concept of least priority number that has any row."""
    return df.groupBy(*keys).agg(F.min_by(concept, priority).alias(concept))


def adjacent_years(df: DataFrame, keys: Sequence[str], year: str, value: str, comparable: Sequence[str]) -> DataFrame:
    """df with prior_value, ratio and null_reason: change against the record before, if all `comparable` columns agree (null with null)."""
    w = Window.partitionBy(*keys).orderBy(year)
    same = F.lag(F.lit(True)).over(w).isNotNull()
    for c in comparable:
        same = same & F.lag(c).over(w).eqNullSafe(F.col(c))
    out = df.withColumn("prior_value", F.lag(value).over(w)).withColumn("_same", same)
    ratio = F.when(F.col("_same"), safe_divide(F.col(value), F.col("prior_value")) - 1)
    reason = F.when(~F.col("_same"), "no_comparable_prior_period").when(ratio.isNull(), "missing_or_zero_prior_revenue")
    return out.withColumn("ratio", ratio).withColumn("null_reason", reason).drop("_same")


def aligned(parts: dict[str, DataFrame], optional: dict[str, DataFrame], keys: Sequence[str], end: str) -> DataFrame:
    """Facts on the same (keys, start, end): required ones by inner joins, optional balances by (keys, end)."""
    out = None
    for name, part in parts.items():
        one = part.withColumnRenamed("value", name)
        out = one if out is None else out.join(one, [*keys, "period_start", end])
    for name, part in optional.items():
        out = out.join(part.withColumnRenamed("value", name), [*keys, end], "left")
    return out


def latest_periods(df: DataFrame, keys: Sequence[str], end: str, n: int) -> DataFrame:
    """The n latest periods of each key."""
    w = Window.partitionBy(*keys).orderBy(F.desc(end))
    at = free_name(df.columns, "_at")
    return df.withColumn(at, F.row_number().over(w)).where(F.col(at) <= n).drop(at)
