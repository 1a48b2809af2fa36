"""Banded disclosures as intervals: phrases to bounds, compounding, comparison."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.scalars import bound
from quern.operators.bands import free_name

#: Fixed reading of qualifiers: the digits that low, mid and high stand for after a ten, and those of double digits.
DIGITS = {"low": (1, 3), "mid": (4, 6), "high": (7, 9)}
DOUBLE = {"low": (10, 13), "mid": (14, 16), "high": (17, 19)}
ROUGHLY = ("approximately", "about", "around")
POINT_SLACK = 0.005
FALLING = ("decline", "decrease", "down")


def _bound(word: Column, of: dict[str, tuple[int, int]], at: int) -> Column:
    return F.coalesce(*(F.when(word == name, F.lit(pair[at])) for name, pair in of.items()))


#: Endings of a qualified phrase in the order that they are read, what they stand after, and the digits that qualifiers stand for.
ENDINGS = ((r"(\d{2})s\b", None, DIGITS), (r"teens\b", 10, DIGITS), (r"single[- ]digit", 0, DIGITS), (r"double[- ]digit", 0, DOUBLE))


def phrase_band(phrase: Column, direction: Column | str = "increase") -> Column:
    """Struct (low, high, error) of a percentage phrase, as fractions; negative if the direction falls.

    Read in this order: an exact figure (with slack only where it says so), tens,
    teens, single digits, double digits; the qualifier may be a range such as
    low-to-mid. Any other phrase has no bounds and an error. Each pattern is matched
    once, and only if those before it were not found.
    """
    text = F.lower(F.trim(F.regexp_replace(F.regexp_replace(phrase, "[–—]", "-"), r"\s+", " ")))
    pair = lambda low, high: F.struct(F.round(low, 6).alias("low"), F.round(high, 6).alias("high"))

    def figure(t: Column) -> Column:
        slack = F.greatest(*(F.when(t.contains(word), POINT_SLACK).otherwise(0.0) for word in ROUGHLY))
        said = F.regexp_extract(t, r"(\d+(?:\.\d+)?)\s*%", 1).try_cast("double") / 100
        return bound(said, lambda x: F.when(x.isNotNull(), pair(F.greatest(x - slack, F.lit(0.0)), x + slack)))

    def qualified(t: Column, ending: str, base: int | None, of: dict[str, tuple[int, int]]) -> Column:
        pattern = r"\b(low|mid|high)(?:-to-(low|mid|high))?[- ]?" + ending

        def read(m: Column) -> Column:
            first, second = (F.regexp_extract(m, pattern, i) for i in (1, 2))
            start = F.regexp_extract(m, pattern, 3).try_cast("int") if base is None else F.lit(base)
            return F.when(m != "", pair((start + _bound(first, of, 0)) / 100, (start + _bound(F.when(second != "", second).otherwise(first), of, 1)) / 100))

        return bound(F.regexp_extract(t, pattern, 0), read)

    found = bound(text, lambda t: F.coalesce(figure(t), *(qualified(t, *e) for e in ENDINGS)))
    falls = (F.lit(direction) if isinstance(direction, str) else direction).isin(*FALLING)
    error = F.concat(F.lit("Unsupported qualitative percentage phrase: "), F.coalesce(phrase, F.lit("")))
    turned = lambda b: F.struct(
        F.when(falls, -b["high"]).otherwise(b["low"]).alias("low"), F.when(falls, -b["low"]).otherwise(b["high"]).alias("high"), F.when(b["low"].isNull(), error).alias("error"))
    return bound(found, turned)


def phrase_interval(phrase: Column, direction: Column | str = "increase") -> tuple[Column, Column, Column]:
    """(low, high, error) of phrase_band; for many rows select the struct once and then its fields."""
    band = phrase_band(phrase, direction)
    return band["low"], band["high"], band["error"]


def compounded(df: DataFrame, keys: Sequence[str], order: str, low: str, high: str, rows: int = 4, gap: tuple[int, int] = (70, 120)) -> DataFrame:
    """df with compound_low and compound_high over the last `rows` periods, if there are so many and each gap in days is in bounds."""
    w = Window.partitionBy(*keys).orderBy(order)
    step = free_name(df.columns, "_gap")
    out = df.withColumn(step, F.datediff(F.col(order), F.lag(order).over(w)))
    frame, gaps = w.rowsBetween(1 - rows, 0), w.rowsBetween(2 - rows, 0)
    whole = (F.count(F.lit(1)).over(frame) == rows) & F.min(step).over(gaps).between(*gap) & F.max(step).over(gaps).between(*gap)
    total = lambda c: F.when(whole, F.round(F.product(F.lit(1) + F.col(c)).over(frame) - 1, 8))
    return out.withColumn("compound_low", total(low)).withColumn("compound_high", total(high)).drop(step)


def compare(low_a: Column, high_a: Column, low_b: Column, high_b: Column) -> Column:
    """Struct of relation (above, below, overlap) of interval a to b, and the bounds of their difference; null in, null out."""
    known = low_a.isNotNull() & high_a.isNotNull() & low_b.isNotNull() & high_b.isNotNull()
    relation = F.when(low_a > high_b, "above").when(high_a < low_b, "below").otherwise("overlap")
    return F.when(known, F.struct(relation.alias("relation"), (low_a - high_b).alias("difference_low"), (high_a - low_b).alias("difference_high")))


def against_guidance(observations: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """(keys, actual_low, actual_high, guidance_low, guidance_high, relation, difference_low, difference_high) where both sides are there.

    observations: keys, value_type (actual or company_guidance), value_low,
    value_high, value, and `order`. An interval is both bounds, else the value for
    both; rows without one are passed over. Of a key's rows of one kind the last by
    `order` counts, so a key is one row. Null keys take no part.
    """
    both = F.col("value_low").isNotNull() & F.col("value_high").isNotNull()
    interval = F.struct(F.when(both, F.col("value_low")).otherwise(F.col("value")).alias("low"), F.when(both, F.col("value_high")).otherwise(F.col("value")).alias("high"))
    usable = observations.where(both | F.col("value").isNotNull()).withColumn("_i", interval)
    last = lambda kind: F.max_by(F.when(F.col("value_type") == kind, F.col("_i")), F.when(F.col("value_type") == kind, F.col(order)))
    wide = usable.groupBy(*keys).agg(last("actual").alias("_a"), last("company_guidance").alias("_g"))
    wide = wide.where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys), F.col("_a").isNotNull() & F.col("_g").isNotNull()))
    a, g = F.col("_a"), F.col("_g")
    out = wide.withColumn("_c", compare(a["low"], a["high"], g["low"], g["high"]))
    return out.select(
        *keys, a["low"].alias("actual_low"), a["high"].alias("actual_high"), g["low"].alias("guidance_low"), g["high"].alias("guidance_high"),
        "_c.relation", "_c.difference_low", "_c.difference_high")
