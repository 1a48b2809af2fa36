"""The financial database: eight tables with keys and references, checked in one plan and published by views."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Table:
    """Columns in order, the key (none: rows may repeat), the columns that must have a value, and the tables that columns refer to by key."""

    columns: str
    key: str | None
    needed: tuple[str, ...] = ()
    references: tuple[tuple[str, str], ...] = ()


#: Fixed tables, their columns with kinds, keys and references.
TABLES = {
    "entities": Table("id string, name string, ticker string, cik string, class string, role string, peer_group_id string, availability string, raw_json string", "id", ("raw_json",)),
    "concepts": Table("id string, statement string, default_unit string, aggregation string, status string, formula string, raw_json string", "id", ("raw_json",)),
    "sources": Table("id string, name string, tier string, url string, api_url string, document_form string, accession string, raw_json string", "id", ("url", "raw_json")),
    "observations": Table(
        "id string, entity_id string, concept_id string, value_type string, value double, value_low double, value_high double, unit string, currency string, period_start string, period_end string, "
        "period_type string, fiscal_year int, fiscal_period string, scope string, segment string, geography string, as_of string, observed_at string, filed_at string, revision int, source_id string, "
        "source_url string, raw_json string", "id", ("entity_id", "concept_id", "value_type", "revision", "source_url", "raw_json"), (("entity_id", "entities"), ("source_id", "sources"))),
    "metrics": Table("id string, entity_id string, metric_id string, value double, unit string, period_end string, formula string, raw_json string", "id", ("raw_json",)),
    "evaluations": Table("id string, entity_id string, rule_id string, value double, result string, raw_json string", "id", ("raw_json",)),
    "evidence_edges": Table("from_id string, relationship string, to_id string, raw_json string", None, ("from_id", "relationship", "to_id", "raw_json")),
    "audit_issues": Table("sequence long, severity string, code string, entity_id string, record_id string, raw_json string", "sequence", ("raw_json",)),
}


class Refused(RuntimeError):
    """A table breaks its constraints, so nothing was published."""


def shaped(name: str, rows: DataFrame) -> DataFrame:
    """rows with just the declared columns and kinds; a declared column that is not there is null."""
    declared = [c.split() for c in TABLES[name].columns.split(", ")]
    return rows.select(*((F.col(c) if c in rows.columns else F.lit(None)).cast(kind).alias(c) for c, kind in declared))


def _issue(rows: DataFrame, name: str, code: str, column: str, key) -> DataFrame:
    return rows.select(F.lit(name).alias("table_name"), F.lit(code).alias("code"), F.lit(column).alias("column_name"), key.cast("string").alias("key"))


def violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, code, column_name, key): keys that are missing (MISSING_KEY) or repeat (DUPLICATE_KEY, one row each), columns without a needed
    value (MISSING_VALUE) and references without a row (DANGLING_REFERENCE), a row for each row concerned. A table that is not given is empty.

    Needed values are one pass over each table, references anti-joins, so one job checks all.
    """
    if unknown := set(tables) - set(TABLES):
        raise KeyError(f"no such tables: {', '.join(sorted(unknown))}")
    parts = []
    for name, rows in tables.items():
        of, rows = TABLES[name], shaped(name, rows)
        key = F.col(of.key) if of.key else F.lit(None)
        lacks = F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in of.needed)))
        bare = rows.select(F.explode(lacks).alias("_c"), key.cast("string").alias("_k"))
        parts.append(bare.select(F.lit(name).alias("table_name"), F.lit("MISSING_VALUE").alias("code"), F.col("_c").alias("column_name"), F.col("_k").alias("key")))
        if of.key:
            parts.append(_issue(rows.where(key.isNull()), name, "MISSING_KEY", of.key, key))
            parts.append(_issue(rows.where(key.isNotNull()).groupBy(of.key).count().where("count > 1"), name, "DUPLICATE_KEY", of.key, key))
        for column, to in of.references:
            asked = rows.where(F.col(column).isNotNull())
            if to in tables:
                asked = asked.join(tables[to].select(F.col(TABLES[to].key).cast("string").alias(column)).distinct(), column, "left_anti")
            parts.append(_issue(asked, name, "DANGLING_REFERENCE", column, key))
    return reduce(lambda a, b: a.unionByName(b), parts)


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], database: str, path: str) -> str:
    """Writes all eight tables as a new version under `path` and points the database's views at it; returns the version.

    Constraints are checked on what was written, before any view moves, so readers
    see the old version whole or the new one. Refused leaves the views as they were.
    """
    version = uuid4().hex
    where = lambda name: f"{path.rstrip('/')}/version={version}/{name}"
    for name in TABLES:
        rows = shaped(name, tables[name]) if name in tables else spark.createDataFrame([], TABLES[name].columns)
        rows.write.parquet(where(name))
    stored = {name: spark.read.schema(of.columns).parquet(where(name)) for name, of in TABLES.items()}
    if (first := violations(stored).limit(5).collect()):
        raise Refused("; ".join(f"{r.table_name}.{r.column_name} {r.code} {r.key}" for r in first))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in TABLES:
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM parquet.`{where(name)}`")
    return version
