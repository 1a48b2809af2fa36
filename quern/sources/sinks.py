"""Sinks: canonical line-delimited JSON, small documents, per-entity folders, table exports, manifests."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SMALL = 100_000


def json_rows(df: DataFrame) -> DataFrame:
    """One column `value`: each row as JSON with its columns in name order, nulls kept."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def canonical_lines(df: DataFrame, path: str, order: Sequence[str]) -> str:
    """Sorted line-delimited JSON in range-sorted files, so that a task's size stays bounded; returns a hash of the lines, whatever their files."""
    json_rows(df.orderBy(*order)).write.mode("overwrite").text(path)
    return content_hash(df.sparkSession.read.text(path))


def document(df: DataFrame, order: Sequence[str], limit: int = SMALL) -> str:
    """A small table as one JSON text; larger ones are refused, not cut."""
    rows = json_rows(df.orderBy(*order)).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"over {limit} rows: write files instead")
    return "[\n" + ",\n".join(r.value for r in rows) + "\n]\n"


def by_entity(df: DataFrame, path: str, key: str) -> None:
    df.write.mode("overwrite").partitionBy(key).json(path)


def content_hash(df: DataFrame) -> str:
    """A hash of the rows whatever their order: counts and sums of row hashes, combined before the shuffle."""
    row = F.xxhash64(*(F.col(c) for c in sorted(df.columns)))
    s = df.agg(F.count("*").alias("n"), F.sum(row.cast("decimal(38,0)")).alias("s"), F.bit_xor(row).alias("x")).first()
    return f"{s.n}-{s.s}-{s.x}"


def write_if_changed(df: DataFrame, path: str, previous: str | None) -> str:
    """Writes Parquet unless the content hash is the previous one; returns the hash."""
    now = content_hash(df)
    if now != previous:
        df.write.mode("overwrite").parquet(path)
    return now


def export_tables(tables: dict[str, DataFrame], database: str, partitions: dict[str, str] | None = None) -> None:
    """Managed tables of a database, partitioned where asked; keys are checked by audits, not by the store."""
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, df in tables.items():
        writer = df.write.mode("overwrite").format("parquet")
        if partitions and name in partitions:
            writer = writer.partitionBy(partitions[name])
        writer.saveAsTable(f"{database}.{name}")


def markdown(df: DataFrame, order: Sequence[str], limit: int = 500) -> str:
    """A small table as Markdown; larger ones are refused."""
    rows = df.orderBy(*order).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"over {limit} rows: not a report")
    line = lambda cells: "| " + " | ".join("" if c is None else str(c).replace("|", "\\|") for c in cells) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *map(line, rows)]) + "\n"
