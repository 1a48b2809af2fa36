"""Registration of queries, and the stand-in series that several of them share."""

from __future__ import annotations

from pyspark.sql import functions as F

from quern.session import table

#: Fixed instant that freshness and audit queries take for the run's time.
RUN_AT = "2024-01-30 12:00:00"


class Registry:
    def __init__(self):
        self.queries: dict = {}
        self.oracles: dict = {}

    def query(self, sql: str | None = None):
        """Registers the decorated function under its name, with its oracle if there is one."""

        def put(f):
            self.queries[f.__name__] = f
            if sql:
                self.oracles[f.__name__] = sql
            return f

        return put


def money(column: str):
    return F.col(column).cast("decimal(18,2)")


def events(spark, sf_dir):
    """events with ts as an instant."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


#: One row for each supplier and calendar quarter; periods as dates, exact decimal values.
QUARTERS_SQL = """q AS (
  SELECT l_suppkey AS entity, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period_start,
    CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH AS DATE) - 1 AS period_end,
    CAST(year(l_shipdate) AS INTEGER) AS fy, CAST(quarter(l_shipdate) AS INTEGER) AS fq,
    sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS value
  FROM lineitem GROUP BY ALL)"""


def quarters(spark, sf_dir):
    day = F.col("l_shipdate").cast("date")
    start = F.trunc(day, "quarter")
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"), start.alias("period_start"), F.date_sub(F.add_months(start, 3), 1).alias("period_end"),
        F.year(day).alias("fy"), F.quarter(day).alias("fq"), money("l_extendedprice").alias("value"))
    return rows.groupBy("entity", "period_start", "period_end", "fy", "fq").agg(F.sum("value").cast("decimal(28,2)").alias("value"))


#: Daily purchase value by event type: the stand-in for price bars.
BARS_SQL = """b AS (
  SELECT event_type AS code, CAST(ts AS DATE) AS day, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS close, count(*) AS volume
  FROM events GROUP BY ALL)"""


def bars(spark, sf_dir):
    rows = events(spark, sf_dir).select(F.col("event_type").alias("code"), F.col("ts").cast("date").alias("day"), money("value").alias("v"))
    return rows.groupBy("code", "day").agg(F.sum("v").cast("double").alias("close"), F.count("*").alias("volume"))
