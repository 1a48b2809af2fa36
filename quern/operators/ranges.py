"""Order over whole tables without one task for a group: range-sorted parts, and what each part needs from those before it.

A table is dealt into parts by ranges of its order, sorted, and staged, so that a
part's rows and their places are fixed. What a row needs from earlier parts is a
small number for each part (a count, a sum) or for each part and key (a last
value), and the few rows before its slice; so a hot key or group is as many tasks
as it has parts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.bands import free_name
from quern.session import staged

#: Rows of a slice of a trailing window, at least.
SLICE_ROWS = 1 << 16
#: Row digests of a leaf of a hash tree, and children of its nodes.
LEAF, FAN = 1024, 256


def ranged(df: DataFrame, order: Sequence[str], parts: int | None = None) -> tuple[DataFrame, str, str]:
    """(df in range-sorted parts, the names of the columns part and place in it). Rows that tie in the order lie in one part, in any order."""
    part, place = (free_name(df.columns, n) for n in ("part", "place"))
    dealt = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    placed = dealt.sortWithinPartitions(*order).select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias(place))
    return staged(placed), part, place


def _before(rows: DataFrame, part: str, amount: Column, name: str) -> DataFrame:
    """(part, name): the sum of an amount over all earlier parts; a row a part."""
    sums = rows.groupBy(part).agg(amount.alias(name))
    every = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(part, F.coalesce(F.sum(name).over(every), F.lit(0)).alias(name))


def numbered(df: DataFrame, order: Sequence[str], name: str = "position", parts: int | None = None) -> DataFrame:
    """df with each row's place in the whole order, from 0, by the counts of the parts before its own. Rows that tie are numbered in any order."""
    rows, part, place = ranged(df, order, parts)
    first = free_name(rows.columns, "first")
    return rows.join(_before(rows, part, F.count("*"), first), part).select(*df.columns, (F.col(first) + F.col(place)).alias(name))


def cumulative(df: DataFrame, order: Sequence[str], weight: str, name: str, parts: int | None = None) -> DataFrame:
    """df with the sum of the weights of all rows before; the order must be total."""
    rows, part, place = ranged(df, order, parts)
    first = free_name(rows.columns, "first")
    own = F.sum(weight).over(Window.partitionBy(part).orderBy(place).rowsBetween(Window.unboundedPreceding, -1))
    joined = rows.withColumn(name, F.coalesce(own, F.lit(0))).join(_before(rows, part, F.sum(weight), first), part)
    return joined.select(*df.columns, (F.col(name) + F.col(first)).alias(name))


def _same(columns: Sequence[str], mark: str) -> list[Column]:
    return [F.col(c).eqNullSafe(F.col(f"{mark}{i}")) for i, c in enumerate(columns)]


def _marked(df: DataFrame, columns: Sequence[str], mark: str) -> DataFrame:
    """df with the columns renamed for a null-safe join."""
    rest = [c for c in df.columns if c not in columns]
    return df.select(*(F.col(c).alias(f"{mark}{i}") for i, c in enumerate(columns)), *rest)


def ranked(df: DataFrame, group: Sequence[str], value: str, parts: int | None = None) -> DataFrame:
    """(group, value, ties, below, rows): each distinct value of a group, how often it is there, how many of the group are less, and the group's size.

    Values are counted before anything is sorted, so a hot value is one row; a group
    spans as many parts as it needs. Nulls of the value take no part, those of the
    group are a group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("ties"))
    running = cumulative(counts, [*group, value], "ties", "below", parts)
    of = running.groupBy(*group).agg(F.min("below").alias("start"), F.sum("ties").alias("rows"))
    joined = running.join(_marked(of, group, "_g"), _same(group, "_g"))
    return joined.select(*group, value, "ties", (F.col("below") - F.col("start")).alias("below"), "rows")


def at_rank(ranks: DataFrame, group: Sequence[str], value: str, rank: Column, name: str) -> DataFrame:
    """(group, name): the value of each group that holds a rank from 0, an expression over `rows`."""
    holds = (F.col("below") <= rank) & (rank < F.col("below") + F.col("ties"))
    return ranks.where(holds).select(*group, F.col(value).alias(name))


def medians(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """(group, rows, lower, upper): the two middle values, one and the same in a group of odd size."""
    ranks = ranked(df, group, value)
    middle = lambda r: F.max(F.when((F.col("below") <= r) & (r < F.col("below") + F.col("ties")), F.col(value)))
    n = F.col("rows")
    return ranks.groupBy(*group).agg(F.max("rows").alias("rows"), middle(F.floor((n - 1) / 2)).alias("lower"), middle(F.floor(n / 2)).alias("upper"))


def carried(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, parts: int | None = None) -> DataFrame:
    """df with the last non-null `value` of the key up to and with each row, in a total order.

    Each part takes its own last values; what it needs from before is the last value
    of its first key, one small row for each part and key.
    """
    rows, part, place = ranged(df, [*keys, *order], parts)
    own = F.last(value, ignorenulls=True).over(Window.partitionBy(part, *keys).orderBy(place).rowsBetween(Window.unboundedPreceding, 0))
    filled = F.when(F.col(value).isNotNull(), F.col(place))
    edges = rows.groupBy(part, *keys).agg(F.max_by(F.when(F.col(value).isNotNull(), F.col(value)), filled).alias("_edge"))
    into = edges.select(part, *keys, F.last("_edge", ignorenulls=True).over(Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)).alias("_into"))
    joined = rows.withColumn("_own", own).join(_marked(into.where(F.col("_into").isNotNull()), [part, *keys], "_edge_k"), _same([part, *keys], "_edge_k"), "left")
    return joined.select(*df.columns, F.coalesce("_own", "_into").alias(name))


def as_of(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, carry: Sequence[str], tie: str, parts: int | None = None) -> DataFrame:
    """left with the `carry` columns (as asof_...) of the last right row of the key at or before its time; as positioning.as_of, for keys of any size.

    Of right rows at one time the last by `tie` counts. Repeated left rows stay.
    """
    seen = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(carry)))
    a = left.select(*(F.col(k).alias(f"o{i}") for i, k in enumerate([*keys, at])), F.lit(1).alias("_side"), F.lit(None).cast(right.schema[tie].dataType).alias("_tie"), F.struct(*left.columns).alias("_row"))
    b = right.select(*(F.col(k).alias(f"o{i}") for i, k in enumerate([*keys, at])), F.lit(0).alias("_side"), F.col(tie).alias("_tie"), seen.alias("_seen"))
    names = [f"o{i}" for i in range(len(keys) + 1)]
    found = carried(a.unionByName(b, allowMissingColumns=True), names[:-1], [names[-1], "_side", "_tie"], "_seen", "_last", parts).where("_side = 1")
    return found.select("_row.*", *(F.col("_last")[f"c{i}"].alias(f"asof_{c}") for i, c in enumerate(carry)))


def trailing(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int, made: dict[str, Callable[[Window], Column]], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """df with columns over each row and the `rows` - 1 before it of its key, in a total order; made maps a name to an expression over the window.

    A slice is a run of positions; the last rows of each also go to the next, so a
    hot key is many slices and each sees all that its windows reach.
    """
    size = max(slice_rows, 2 * rows)
    at = free_name([*df.columns, *made], "position")
    own, to = free_name([*df.columns, *made, at], "own"), free_name([*df.columns, *made, at], "to")
    placed = numbered(df, [*keys, *order], at)
    slice_ = F.floor(F.col(at) / size)
    tail = F.when(F.pmod(at, F.lit(size)) >= size - rows + 1, F.struct(F.lit(False).alias(own), (slice_ + 1).alias(to)))
    spread = placed.withColumn("_s", F.explode(F.array_compact(F.array(F.struct(F.lit(True).alias(own), slice_.alias(to)), tail)))).select(*placed.columns, "_s.*")
    w = Window.partitionBy(*keys, to).orderBy(at).rowsBetween(1 - rows, 0)
    return spread.select("*", *(f(w).alias(name) for name, f in made.items())).where(own).select(*df.columns, *made)


def tree_hash(df: DataFrame, order: Sequence[str], leaf: int = LEAF, fan: int = FAN, parts: int | None = None, levels: int | None = None) -> str:
    """A digest of a table in its order: the root of a hash tree whose leaves are runs of `leaf` rows, so it depends on the rows and their
    order, not on the parts that they lie in.

    Rows that tie in the order are put in order of their digests. Nulls count as
    such; column names count; an empty table has a digest of its own. With `levels`
    the tree ends at that level at the latest, and of several nodes there the
    greatest digest is the root: rows under the others are then counted, but not told apart.
    """
    names = sorted(df.columns)
    digest = F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`").alias(c) for c in names)), {"ignoreNullFields": "false"}), 256)
    keyed = df.select(*(F.col(f"`{c}`").alias(f"o{i}") for i, c in enumerate(order)), digest.alias("digest"))
    nodes = numbered(keyed, [*(f"o{i}" for i in range(len(order))), "digest"], "at", parts).select("at", "digest")
    size, level = nodes.count(), leaf
    rows, height = size, 0
    while True:
        joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"]), "")
        nodes = staged(nodes.groupBy(F.floor(F.col("at") / level).alias("at")).agg(F.sha2(joined, 256).alias("digest")))
        size, level, height = -(-size // level), fan, height + 1
        if size <= 1 or height == levels:
            break
    root = nodes.agg(F.max("digest").alias("digest")).first()
    head = nodes.sparkSession.range(1).select(F.sha2(F.lit(f"{rows}:{','.join(names)}:{root.digest or ''}"), 256).alias("h"))
    return head.first().h
