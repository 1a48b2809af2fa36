"""Hot keys and groups: range-sorted parts, carried values, slices, day buckets, hash trees."""

import statistics
from datetime import date, timedelta

import duckdb
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quern.operators import analytics, bands, growth, keyed, positioning, ranges
from quern.plans.registry import ORACLES, QUERIES


def test_numbers_and_sums_over_parts(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.lit(2).alias("w"), F.lit("x").alias("part"))
    got = ranges.numbered(df, ["v"], parts=7).collect()
    assert all(r.v == r.position and r.part == "x" for r in got) and len(got) == 1000  # a caller's column keeps its name
    assert all(r.s == 2 * r.v for r in ranges.cumulative(df, ["v"], "w", "s", parts=7).collect())
    assert ranges.numbered(df.where("v < 0"), ["v"]).count() == 0


@pytest.mark.parametrize("parts", [1, 9])
def test_ranks_of_hot_groups(spark, parts):
    rows = [(None if i % 5 == 4 else f"g{i % 2}", float(i * 31 % 97) if i % 3 else 7.0) for i in range(600)] + [("one", 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    for r in ranges.ranked(df, ["g"], "v", parts).collect():
        assert (r.ties, r.below, r.rows) == (by[r.g].count(r.v), sum(x < r.v for x in by[r.g]), len(by[r.g]))
    assert {r.g: r.upper_median for r in keyed.upper_median(df, ["g"], "v").collect()} == {g: sorted(v)[len(v) // 2] for g, v in by.items()}
    stats = {r.g: r for r in analytics.peer_stats(df, ["g"], "v").collect()}
    assert {g: stats[g].median for g in by} == {g: statistics.median(v) for g, v in by.items()} and stats["none"].median is None and stats["one"].deviation is None
    attached = analytics.with_peers(df, ["g"], "v").collect()
    assert len(attached) == len(rows) and all(r.from_median is None or r.from_median == r.v - statistics.median(by[r.g]) for r in attached)
    shares = analytics.mid_rank(df, ["g"], "v").collect()
    assert len(shares) == sum(map(len, by.values())) and all(
        abs(r.percentile - (sum(x < r.v for x in by[r.g]) + by[r.g].count(r.v) / 2) / len(by[r.g])) <= 5.001e-5 for r in shares)


def test_one_group_is_many_tasks(spark):
    df = spark.range(0, 200_000, 1, 8).select(F.lit("hot").alias("k"), "id", F.rand(1).alias("v"))
    parts = ranges.ranged(df, ["k", "v"], 6)[0]
    sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    assert len(sizes) == 6 and max(sizes) < 2 * 200_000 / 6


def test_as_of_and_trailing_windows_of_a_hot_key(spark):
    """One key of a million rows: as the plain window has it, in more than one task."""
    n = 1_000_000
    base = spark.range(0, n, 1, 8).select(F.when(F.col("id") % 1000 == 0, "cold").otherwise("hot").alias("k"), (F.col("id") * 7919 % n).alias("t"), (F.col("id") % 101).cast("double").alias("v"))
    right = base.where(F.pmod(F.xxhash64("t"), F.lit(50)) == 0).select("k", "t", F.col("t").alias("n"), "v")
    left = base.select("k", "t")
    total = lambda df, *c: df.agg(F.sum(F.xxhash64(*c).cast("decimal(38,0)")), F.count("*")).first()
    sliced = ranges.as_of(left, right, ["k"], "t", ["n", "v"], "n", parts=8)
    assert total(sliced, "k", "t", "asof_n", "asof_v") == total(positioning.as_of(left, right, ["k"], "t", ["n", "v"], "n"), "k", "t", "asof_n", "asof_v")
    window = Window.partitionBy("k").orderBy("t").rowsBetween(-19, 0)
    plain = base.withColumn("m", F.max("v").over(window)).withColumn("c", F.count("v").over(window))
    made = {"m": lambda w: F.max("v").over(w), "c": lambda w: F.count("v").over(w)}
    found = ranges.trailing(base, ["k"], ["t"], 20, made, slice_rows=50_000)
    assert total(found, "k", "t", "m", "c") == total(plain, "k", "t", "m", "c")


def test_carried_values_cross_empty_parts(spark):
    rows = [("a", i, float(i) if i in (3, 40) else None) for i in range(60)] + [("b", i, None) for i in range(30)] + [(None, 1, 5.0), (None, 2, None)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = {(r.k, r.t): r.last for r in ranges.carried(df, ["k"], ["t"], "v", "last", parts=9).collect()}
    assert got == {("a", i): None if i < 3 else 3.0 if i < 40 else 40.0 for i in range(60)} | {("b", i): None for i in range(30)} | {(None, 1): 5.0, (None, 2): 5.0}


def test_bands_in_day_buckets(spark):
    start = date(2020, 1, 1)
    rows = [("k" if i % 7 else None, start + timedelta(days=i * 13 % 900), i) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, d date, n int")
    got = {(r.n, r.f.n if r.f else None) for r in bands.banded(df, df, ["k"], F.col("d"), F.col("d"), (70, 110), "f").collect()}
    want = {(a[2], b[2]) for a in rows for b in rows if a[0] == b[0] and 70 <= (a[1] - b[1]).days <= 110}
    assert {g for g in got if g[1] is not None} == want and {g[0] for g in got} == set(range(400))


def test_growth_of_a_hot_entity_has_no_hot_task(spark):
    """One entity with a fact for each of many days and lengths: as many as the days, not as their square."""
    days = spark.range(4000).select(F.lit("e").alias("entity"), F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("period_end"), (F.col("id") + 1).cast("double").alias("value"))
    facts = days.withColumn("period_start", F.date_sub("period_end", 90))
    found = growth.year_on_year(facts.unionByName(facts), ["entity"])
    assert {r.reason: r["count"] for r in found.groupBy("reason").count().collect()} == {"AMBIGUOUS_PRIOR": 4000 - 351, "NO_COMPARABLE_PERIOD": 350, None: 1}


def test_tree_hash_depends_on_order_only(spark):
    df = spark.range(5000).select(F.col("id").alias("n"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"), F.when(F.col("id") % 3 == 0, F.col("id")).alias("maybe"))
    h = lambda df, parts: ranges.tree_hash(df, ["n"], leaf=16, fan=8, parts=parts)
    root = h(df, 1)
    assert root == h(df.repartition(5), 7) == h(df, 200)
    swapped = df.withColumn("n", F.when(F.col("n") == 17, 18).when(F.col("n") == 18, 17).otherwise(F.col("n")))
    swap = df.withColumn("v", F.when(F.col("n") == 17, "v18").when(F.col("n") == 18, "v17").otherwise(F.col("v")))
    assert len({root, h(swapped, 3), h(swap, 3), h(df.where("n < 4999"), 3), h(df.withColumnRenamed("v", "w"), 3), h(df.where("n < 0"), 3)}) == 6
    twice = df.where("n < 40").unionByName(df.where("n < 40"))
    assert h(twice, 1) == h(twice.repartition(3), 4)


def test_content_hash_of_a_table_of_several_second_level_nodes_equals_its_sql(spark, tmp_path):
    for rows in (0, 3, ranges.LEAF + 1, ranges.LEAF * ranges.FAN + 1, 3 * ranges.LEAF * ranges.FAN):
        path = f"{tmp_path}/{rows}"
        spark.range(rows).select((F.col("id") * 7 + 1).alias("c_custkey"), F.concat(F.lit("n"), "id").alias("c_name"), (F.col("id") % 1000 / 4).alias("c_acctbal")).write.parquet(f"{path}/customer.parquet")
        c = duckdb.connect()
        c.execute(f"create view customer as select * from read_parquet('{path}/customer.parquet/*.parquet')")
        assert [tuple(r) for r in QUERIES["ordered_content_hash"](spark, path).collect()] == c.execute(ORACLES["ordered_content_hash"]).fetchall()


def test_chunks_of_values_with_one_beginning(spark):
    df = spark.range(2000).select(F.format_string("00%05d", F.col("id")).alias("v"))
    got = keyed.chunked(df, "v", 30).collect()
    assert sorted(len(r["values"]) for r in got) == [20] + [30] * 66 and all(r["values"] == sorted(r["values"]) for r in got)
