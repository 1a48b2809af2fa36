"""The event ledger as a stream: last writes over all runs, a side output for late events, per-document state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quern.operators.audits import freshness
from quern.session import shared_path


def _is_folder(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory()


def stream(spark: SparkSession, path: str, name: str, schema, time: str, files: int = 64) -> DataFrame:
    """The table `name`.parquet of a folder as a stream, its time column as an instant so that watermarks accept it.

    A table that is itself a folder of part files is read as such; a single file is found by its name in the folder that holds it.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    whole = f"{path.rstrip('/')}/{name}.parquet"
    source = reader.parquet(whole) if _is_folder(spark, whole) else reader.option("pathGlobFilter", f"{name}.parquet").parquet(path)
    return source.withColumn(time, F.col(time).cast("timestamp"))


def deduplicated(events: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Each id once, with state bounded by the watermark; rows behind it are DROPPED by Spark, so give the stream that `upsert` keeps whole to audits."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def gated(events: DataFrame, time: str, run_at: Column, hours: int = 24) -> DataFrame:
    """events with `disposition` (live, stale, future, invalid): nothing is dropped, late and future events stay visible."""
    return events.withColumn("disposition", freshness(F.col(time), run_at, hours))


def upsert(path: str, key: str, order: str, time: str | None = None, late: str = "1 hour") -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer: each epoch's last row of every id goes to `path`/rows, one folder an epoch, so replaying an epoch overwrites its own files.

    Nothing is read back but, if `time` is given, the latest time of earlier epochs
    (`path`/marks, one row an epoch): rows more than `late` behind it go to
    `path`/late as well, so they are seen and never lost. `latest` gives the state.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        try:
            one = batch.groupBy(key).agg(F.max_by(F.struct(*batch.columns), F.col(order)).alias("_r")).select("_r.*")
            one.write.mode("overwrite").parquet(f"{path}/rows/epoch={epoch}")
            if time:
                spark = batch.sparkSession
                batch.agg(F.max(time).alias("high")).write.mode("overwrite").parquet(f"{path}/marks/epoch={epoch}")
                marks = spark.read.schema("high timestamp, epoch long").parquet(f"{path}/marks").where(F.col("epoch") < epoch)
                high = marks.agg(F.max("high")).first()[0]
                behind = F.lit(False) if high is None else F.col(time) < F.lit(high) - F.expr(f"interval {late}")
                batch.where(behind).write.mode("overwrite").parquet(f"{path}/late/epoch={epoch}")
        finally:
            batch.unpersist()

    return write


def latest(spark: SparkSession, path: str, schema, key: str) -> DataFrame:
    """The ledger that `upsert` has written: of each id the row of its last epoch."""
    names = schema.fieldNames()
    rows = spark.read.schema(schema.add("epoch", "long") if "epoch" not in names else schema).parquet(f"{path}/rows")
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), "epoch").alias("_r")).select("_r.*")


def run_available(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Processes what is there and stops."""
    query = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(events: DataFrame, time: str, by: str, width: str, late: str) -> DataFrame:
    """Counts by event-time window and column, final when the watermark passes."""
    return events.withWatermark(time, late).groupBy(F.window(time, width), by).agg(F.count("*").alias("events"))


def document_state(previous: DataFrame, seen: DataFrame, run_at: Column) -> DataFrame:
    """State of each document (url, sha256, status, first_seen, last_checked, retries) after a run that saw (url, sha256, ok).

    Unchanged content keeps its status `unchanged` and is not parsed again; a failed fetch keeps the old hash and counts a retry.
    """
    a = previous.select(F.col("url").alias("_u"), F.col("sha256").alias("_h"), "first_seen", F.col("last_checked").alias("_l"), F.col("retries").alias("_r"), F.col("status").alias("_s"))
    j = seen.join(a, F.col("url") == F.col("_u"), "full_outer")
    state = (F.when(F.col("url").isNull(), F.col("_s")).when(~F.col("ok"), "failed").when(F.col("sha256") == F.col("_h"), "unchanged").otherwise("changed"))
    retries = F.when(F.col("url").isNull(), F.col("_r")).when(F.col("ok"), F.lit(0)).otherwise(F.coalesce("_r", F.lit(0)) + 1)
    return j.select(
        F.coalesce("url", "_u").alias("url"), F.coalesce(F.when(F.col("ok"), F.col("sha256")), "_h").alias("sha256"), state.alias("status"),
        F.coalesce("first_seen", run_at).alias("first_seen"), F.when(F.col("url").isNotNull(), run_at).otherwise(F.col("_l")).alias("last_checked"),
        retries.cast("int").alias("retries"))


def collected(df: DataFrame, key: str, order: str) -> DataFrame:
    """The ledger of the data that is there: the stream run to its end into the shared folder, and its last writes read back."""
    from copy import deepcopy

    path = shared_path(df.sparkSession, "stream")
    run_available(df, upsert(f"{path}/ledger", key, order), f"{path}/state")
    return latest(df.sparkSession, f"{path}/ledger", deepcopy(df.schema), key)
