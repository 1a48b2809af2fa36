"""Market series: trailing windows over observations, as-of lookups, drawdowns, indices, volatility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.bands import free_name


def _series(keys: Sequence[str], order: Sequence[str]):
    return Window.partitionBy(*keys).orderBy(*order)


def trailing_mean(value: str, keys: Sequence[str], order: Sequence[str], rows: int) -> Column:
    """Mean of the last `rows` observations, or of as many as there are. Counts observations, not days."""
    return F.avg(value).over(_series(keys, order).rowsBetween(1 - rows, 0))


def change_percent(value: str, keys: Sequence[str], order: Sequence[str]) -> Column:
    before = F.lag(value).over(_series(keys, order))
    return (F.try_divide(F.col(value), before) - 1) * 100


def drawdown_percent(value: str, keys: Sequence[str], order: Sequence[str], rows: int) -> Column:
    """How far the value is below the highest of the last `rows` observations, in percent (positive)."""
    top = F.max(value).over(_series(keys, order).rowsBetween(1 - rows, 0))
    return (1 - F.try_divide(F.col(value), top)) * 100


def max_drawdown(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """(keys, max_drawdown): the deepest fall below the running peak, in percent (negative or zero)."""
    peak = F.max(value).over(_series(keys, order).rowsBetween(Window.unboundedPreceding, 0))
    fallen = df.withColumn("_fall", (F.try_divide(F.col(value), peak) - 1) * 100)
    return fallen.groupBy(*keys).agg(F.min("_fall").alias("max_drawdown"))


def year_index(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    """df with `index`: the value over the first of its calendar year, times 100."""
    w = Window.partitionBy(*keys, F.year(date)).orderBy(date)
    return df.withColumn("index", F.try_divide(F.col(value), F.first(value).over(w)) * 100)


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, carry: Sequence[str], tie: str) -> DataFrame:
    """left with the `carry` columns of the last right row of the key at or before its time.

    One union, one shuffle by key, and a running last value: linear in the rows,
    where a range join would pair every row with all before it.
    """
    payload = F.struct(F.col(at).alias("_time"), *carry)
    a = left.select(*keys, at, F.lit(1).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), F.struct(*left.columns).alias("_row"))
    b = right.select(*keys, at, F.lit(0).alias("_side"), F.col(tie).alias("_tie"), payload.alias("_seen"))
    both = a.unionByName(b, allowMissingColumns=True)
    w = _series(keys, [at, "_side", "_tie"]).rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_last", F.last("_seen", ignorenulls=True).over(w)).where("_side = 1")
    return out.select("_row.*", *(F.col("_last")[c].alias(f"asof_{c}") for c in carry))


def log_returns(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    before = F.lag(value).over(_series(keys, order))
    return df.withColumn("log_return", F.when((F.col(value) > 0) & (before > 0), F.ln(F.col(value) / before)))


def volatility(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, periods: int = 252) -> DataFrame:
    """(keys, returns, volatility): sample deviation of log returns, for a year, in percent; null under two returns."""
    logs = log_returns(df, keys, order, value)
    spread = F.when(F.count("log_return") >= 2, F.stddev_samp("log_return") * (periods**0.5) * 100)
    return logs.groupBy(*keys).agg(F.count("log_return").alias("returns"), spread.alias("volatility"))


def trailing_returns(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, spans: Sequence[int]) -> DataFrame:
    """The last observation of each key, with its return over each span of observations; null if the series is shorter."""
    w = _series(keys, order)
    out = df
    for n in spans:
        out = out.withColumn(f"return_{n}", (F.try_divide(F.col(value), F.lag(value, n).over(w)) - 1) * 100)
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.desc(c) for c in order)))
    at = free_name(out.columns, "_last")
    return out.withColumn(at, last).where(F.col(at) == 1).drop(at)


def days_to_cover(positions: DataFrame, volumes: DataFrame, keys: Sequence[str], date: str, rows: int = 20) -> DataFrame:
    """positions (shares) over the mean volume of the last `rows` sessions up to the date."""
    mean = volumes.withColumn("mean_volume", F.avg("volume").over(_series(keys, [date]).rowsBetween(1 - rows, 0)))
    found = as_of(positions, mean, keys, date, ["mean_volume"], "mean_volume")
    return found.withColumn("days", F.try_divide(F.col("shares"), F.col("asof_mean_volume")))
