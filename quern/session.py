"""Session defaults and table loading."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def build_session(app: str = "quern", cpus: int | None = None, **conf: str) -> SparkSession:
    """A local session with the engine's settings; on a cluster, spark-submit supplies the master."""
    cpus = cpus or os.cpu_count() or 4
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.driver.host": "127.0.0.1",
    } | conf
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=settings)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables; the path may be any that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@lru_cache(1)
def _own_folder(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="quern-")


def shared_path(spark: SparkSession, kind: str = "table") -> str:
    """A new path in the folder that the driver and all executors share (spark.checkpoint.dir); unset, it is an error but on one machine."""
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _own_folder(context.applicationId)
    return f"{shared.rstrip('/')}/quern-{context.applicationId}/{kind}-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read back, so that its lineage ends here."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
