"""Keyed primitives: latest per key, semantic dedup, merges, set comparison, top-k with remainder, modes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators import ranges
from quern.operators.bands import free_name


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under a total order; one shuffle on the key, pruned by the window group limit."""
    rank = free_name(df.columns, "_rank")
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank) == 1).drop(rank)


def extreme_per_key(df: DataFrame, keys: Sequence[str], by: Sequence[str], keep: Sequence[str], newest: bool = True) -> DataFrame:
    """As latest_per_key for a few columns, by max_by or min_by: combined before the shuffle, no sort, no window."""
    pick = F.max_by if newest else F.min_by
    chosen = df.groupBy(*keys).agg(pick(F.struct(*keep), F.struct(*by)).alias("_row"))
    return chosen.select(*keys, *(F.col("_row")[c].alias(c) for c in keep))


def filled(columns: Sequence[str]) -> Column:
    """How many of the columns are neither null nor empty text."""
    return reduce(lambda a, b: a + b, (F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", 1).otherwise(0) for c in columns))


def semantic_dedup(df: DataFrame, keys: Sequence[str], fields: Sequence[str], ordinal: str) -> DataFrame:
    """Of rows with equal keys (nulls equal) the one with most filled fields, the first by ordinal on a tie."""
    scored = df.withColumn("completeness", filled(fields))
    return latest_per_key(scored, keys, [F.desc("completeness"), F.asc(ordinal)])


def last_write_wins(parts: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Later parts beat earlier ones, and within a part later rows; columns by name."""
    part = free_name([c for p in parts for c in p.columns], "_part")
    ranked = [p.withColumn(part, F.lit(i)) for i, p in enumerate(parts)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    return latest_per_key(both, keys, [F.desc(part), *(F.desc(c) for c in order)]).drop(part)


def merge_with_conflicts(base: DataFrame, new: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """(key, outcome, fields): new rows are added or, if equal, duplicates; on a conflict the base's fields stay."""
    body = F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
    a = base.select(F.col(key), body.alias("_a"), F.struct(*fields).alias("_base"))
    b = new.select(F.col(key).alias("_key"), body.alias("_b"), F.struct(*fields).alias("_new"))
    outcome = (F.when(F.col("_b").isNull(), "kept").when(F.col("_a").isNull(), "added")
               .when(F.col("_a") == F.col("_b"), "duplicate").otherwise("conflict"))
    joined = a.join(b, F.col(key) == F.col("_key"), "full_outer").withColumn("outcome", outcome)
    row = F.coalesce("_base", "_new")
    return joined.select(F.coalesce(key, "_key").alias(key), "outcome", *(row[c].alias(c) for c in fields))


def coverage(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """(key, problem) of expected keys that are missing and found keys that are unknown; empty means exact coverage."""
    a, b = expected.select(key).distinct(), found.select(key).distinct()
    missing = a.join(b, key, "left_anti").withColumn("problem", F.lit("missing"))
    return missing.unionByName(b.join(a, key, "left_anti").withColumn("problem", F.lit("unexpected")))


def shared_identities(accepted: DataFrame, rejected: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(identity, accepted_rows, rejected_rows) of identity keys of any kind that occur on both sides; pre-aggregated, so no pairs."""
    tagged = F.explode(F.array(*(F.concat(F.lit(k + "="), v.cast("string")) for k, v in keys.items())))

    def count(df: DataFrame, name: str) -> DataFrame:
        return df.select(tagged.alias("identity")).where(F.col("identity").isNotNull()).groupBy("identity").agg(F.count("*").alias(name))

    return count(accepted, "accepted_rows").join(count(rejected, "rejected_rows"), "identity")


def top_k_with_remainder(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, reason: str = "over_limit") -> DataFrame:
    """All rows with position, selected and skip_reason: the first k of each key are selected, the others kept with a reason."""
    placed = df.withColumn("position", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return placed.withColumn("selected", F.col("position") <= k).withColumn(
        "skip_reason", F.when(F.col("position") > k, reason))


def merge_entities(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Full outer merge by key; a non-null field of the right side wins."""
    fields = [c for c in dict.fromkeys([*left.columns, *right.columns]) if c != key]
    a = left.select(F.col(key).alias("_ka"), *(F.col(c).alias(f"_a_{c}") for c in left.columns if c != key))
    b = right.select(F.col(key).alias("_kb"), *(F.col(c).alias(f"_b_{c}") for c in right.columns if c != key))
    joined = a.join(b, F.col("_ka") == F.col("_kb"), "full_outer")
    value = lambda c: F.coalesce(*(F.col(f"_{s}_{c}") for s, d in (("b", right), ("a", left)) if c in d.columns))
    return joined.select(F.coalesce("_kb", "_ka").alias(key), *(value(c).alias(c) for c in fields))


def modal_value(df: DataFrame, keys: Sequence[str], value: str, distinct: str, tie: str = "ambiguous") -> DataFrame:
    """(keys, value, support, status): the value with most distinct members; a tie gives no value, or the latest one."""
    counts = df.groupBy(*keys, value).agg(F.countDistinct(distinct).alias("support"))
    best = Window.partitionBy(*keys).orderBy(F.desc("support"))
    top = counts.withColumn("_rank", F.rank().over(best)).where("_rank = 1")
    summed = top.groupBy(*keys).agg(F.max(value).alias("_latest"), F.count("*").alias("_n"), F.max("support").alias("support"))
    single = F.when((F.col("_n") == 1) | F.lit(tie == "latest"), F.col("_latest"))
    status = F.when(F.col("_n") == 1, "unique").otherwise("tie_latest" if tie == "latest" else "ambiguous")
    return summed.select(*keys, single.alias(value), "support", status.alias("status"))


def tag_totals(df: DataFrame, keys: Sequence[str], tag: str, value: str) -> DataFrame:
    """(keys, tags, tag_list, total): the sum per key, given only if all its rows carry one tag."""
    per_tag = df.groupBy(*keys, tag).agg(F.sum(value).alias("_sum"))
    found = per_tag.groupBy(*keys).agg(F.count("*").alias("tags"), F.array_sort(F.collect_set(tag)).alias("tag_list"), F.sum("_sum").alias("_all"))
    return found.select(*keys, "tags", "tag_list", F.when(F.col("tags") == 1, F.col("_all")).alias("total"))


def upper_median(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """The element at floor(n / 2) of each key's sorted values, by counts over range-sorted parts: a group is neither one array nor one task."""
    return ranges.at_rank(ranges.ranked(df, keys, value), keys, value, F.floor(F.col("rows") / 2), "upper_median")


def max_abs_scaled(df: DataFrame, keys: Sequence[str], value: str, places: int = 1) -> DataFrame:
    """df with `scaled`: the value over the greatest magnitude of its key, times 100."""
    most = F.max(F.abs(F.col(value))).over(Window.partitionBy(*keys))
    return df.withColumn("scaled", F.round(F.try_divide(F.col(value), most) * 100, places))


def distinct_in_order(df: DataFrame, value: str, ordinal: str) -> DataFrame:
    """Distinct values with the place where each first stands."""
    return df.groupBy(value).agg(F.min(ordinal).alias(ordinal))


def union_unique(parts: Sequence[DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """The union, and the keys that occur more than once in it (which callers treat as an error)."""
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return both, both.groupBy(key).count().where("count > 1").select(key)


def chunked(df: DataFrame, value: str, size: int) -> DataFrame:
    """(chunk, values): the distinct values, sorted, in lists of `size`; only the last is shorter.

    Positions come from range-sorted parts and the counts of those before, so no
    task sees all values, whatever their beginnings. Null is left out.
    """
    text = F.col(value).cast("string").alias("_text")
    rows = df.select(value, text).where(F.col(value).isNotNull()).distinct()
    placed = ranges.numbered(rows, ["_text"], "_at")
    return placed.groupBy(F.floor(F.col("_at") / size).alias("chunk")).agg(F.array_sort(F.collect_list(value)).alias("values"))


def accepted_and_rejected(accepted: Sequence[DataFrame], rejected: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both lists after a run, each by last write; earlier parts first. A key that a later part rejects goes only if it is not accepted.

    Rejections that stood before stay as they are, so the audit can show a key that is in both.
    """
    good = last_write_wins(accepted, keys, order)
    new = last_write_wins(rejected[1:], keys, order).join(good.select(*keys).distinct(), list(keys), "left_anti")
    return good, last_write_wins([rejected[0], new.select(*rejected[0].columns)], keys, order)
