"""A run over several sources: what fails keeps its past, strict runs fail, and small views of the result."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.audits import GateClosed
from quern.operators.keyed import extreme_per_key, last_write_wins

#: Fixed fields of a compact record.
COMPACT = ("id", "value", "value_low", "value_high", "unit", "value_type", "reported_text", "source_url", "as_of", "quality_flags", "comparison_result")
#: Fixed source of derived rows, and how sources begin whose rows are not kept.
DERIVED, PRIVATE = "derived_market_positioning", "jquants_v2_"


def compact(record: Column, fields: Sequence[str], wanted: Sequence[str] = COMPACT) -> Column:
    """The wanted fields of a struct that has `fields`, in their order; one it lacks is null, and so is the whole of no record."""
    return F.when(record.isNotNull(), F.struct(*((record[c] if c in fields else F.lit(None).cast("string")).alias(c) for c in wanted)))


def numeric_order(column: Column, descending: bool = True) -> list[Column]:
    """The order of a table sorted by a column's numbers; text that is none goes last either way."""
    number = F.trim(column.cast("string")).try_cast("double")
    return [number.desc_nulls_last() if descending else number.asc_nulls_last()]


def latest_of(rows: DataFrame, key: str, period: str, order: str) -> DataFrame:
    """Of each key the row of its greatest period, of equal periods the first by `order`; null keys are a key."""
    keep = [c for c in rows.columns if c != key]
    newest = rows.groupBy(key).agg(F.max(period).alias("_p"))
    same = rows.join(newest.select(F.col(key).alias("_k"), "_p"), F.col(key).eqNullSafe(F.col("_k")) & F.col(period).eqNullSafe(F.col("_p"))).select(*rows.columns)
    return extreme_per_key(same, [key], [order], keep, newest=False)


def observed(existing: DataFrame, new: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str], derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The observations (keys, source_id, ...) after a run: a source that failed gives no new rows, so its past ones stay.

    New rows beat existing ones of their key. Derived rows are made anew from all
    source rows, private ones included, and beat the derived rows of the past;
    private rows themselves are not kept.
    """
    derived = F.coalesce(F.col("source_id") == DERIVED, F.lit(False))
    sources = last_write_wins([existing.where(~derived), *new], keys, order)
    made = last_write_wins([existing.where(derived), derive(sources)], keys, order)
    kept = sources.where(~F.coalesce(F.col("source_id").startswith(PRIVATE), F.lit(False)))
    return last_write_wins([kept, made], keys, order)


def strict(states: DataFrame, configured: Sequence[str]) -> None:
    """Fails if a source that is public or has its key (`configured`) ended in error; states (source, status) are a row a source."""
    failed = sorted(r.source for r in states.where((F.col("status") == "error") & F.col("source").isin(*configured)).select("source").distinct().collect())
    if failed:
        raise GateClosed(f"sources failed: {', '.join(failed)}")


def company_context(parts: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """(id, ticker, name, peer) of the companies (id, ticker, name, peer, n) of several documents, each with the peer that it gives those without one.

    Documents come in order, rows of one by n. The last ticker and name that are
    there count, else the id; the peer is that of the last row. Rows without an id take no part.
    """
    filled = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    rows = None
    for place, (part, peer) in enumerate(parts):
        one = part.where(filled("id").isNotNull()).select(
            filled("id").alias("id"), filled("ticker").alias("ticker"), filled("name").alias("name"), F.coalesce(filled("peer"), F.lit(peer)).alias("peer"), F.struct(F.lit(place).alias("part"), F.col("n").alias("n")).alias("at"))
        rows = one if rows is None else rows.unionByName(one)
    last = lambda c: F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("at")))
    merged = rows.groupBy("id").agg(last("ticker").alias("ticker"), last("name").alias("name"), last("peer").alias("peer"))
    return merged.select("id", F.coalesce("ticker", "id").alias("ticker"), F.coalesce("name", "id").alias("name"), "peer")
