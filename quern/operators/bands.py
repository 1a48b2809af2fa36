"""Band joins over days: rows of one key whose days lie a range of days apart, without a range join and without one task for a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH = "1970-01-01"


def free_name(taken: Sequence[str], name: str) -> str:
    """name, or with further underscores so that no column of the input has it; case does not tell names apart."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name += "_"
    return name


def banded(current: DataFrame, prior: DataFrame, keys: Sequence[str], end: Column, prior_end: Column, gap: tuple[int, int], found: str) -> DataFrame:
    """current, once for each prior row of equal keys (null equals null) whose day lies gap[0] to gap[1] days before, as a struct `found`; once with null if there is none.

    Prior rows are filed under buckets as wide as the gap's range, so a current row
    probes two of them; key and bucket are the shuffle key, so the facts of one
    hot key are spread over its buckets, and AQE can split what is left. A row
    whose buckets hold no match comes with null from each; callers aggregate.
    """
    width = gap[1] - gap[0] + 1
    day = lambda c: F.datediff(c, F.lit(EPOCH).cast("date"))
    probe, filed, at, mark = (free_name([*current.columns, *prior.columns, found], n) for n in ("_probe", "_filed", "_at", "_day"))
    low, high = (F.floor((F.col(at) - g) / width) for g in (gap[1], gap[0]))
    asks = current.withColumn(at, day(end)).withColumn(probe, F.explode(F.array_distinct(F.array(low, high))))
    of = prior.select(*(F.col(k).alias(f"{mark}{i}") for i, k in enumerate(keys)), F.struct(*prior.columns).alias(found), day(prior_end).alias(mark))
    of = of.withColumn(filed, F.floor(F.col(mark) / width))
    same = F.col(probe) == F.col(filed)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"{mark}{i}"))
    near = (F.col(at) - F.col(mark)).between(*gap)
    return asks.join(of, same & near, "left").select(*current.columns, found)
