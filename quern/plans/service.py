"""The read service: eight operations over published tables, each a DataFrame of envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.keyed import latest_per_key

MAX_QUERY = 128


class ReadService:
    """events: event_id, company_id, company_name, ticker, report_date, published_at; audits, manifest, files, evidence as in operators.audits."""

    def __init__(self, events: DataFrame, audits: DataFrame, manifest: DataFrame, files: DataFrame, evidence: DataFrame, source: str = "ledger"):
        self.events, self.audits, self.manifest, self.files, self.evidence, self.source = events, audits, manifest, files, evidence, source

    def _envelope(self, df: DataFrame, kind: str, key: Column) -> DataFrame:
        return df.select(F.lit(kind).alias("kind"), F.lit("public/gold").alias("layer"), F.lit(self.source).alias("source"), key.cast("string").alias("id"), F.struct(*df.columns).alias("record"))

    def companies(self) -> DataFrame:
        """The latest identity of each company."""
        return latest_per_key(self.events, ["company_id"], [F.desc("published_at"), F.desc("event_id")]).select("company_id", "company_name", "ticker")

    def search_companies(self, text: str) -> DataFrame:
        wanted = text.strip().lower()
        if len(wanted) > MAX_QUERY:
            raise ValueError(f"a query has {MAX_QUERY} characters at most")
        found = self.companies().where(F.contains(F.lower(F.concat_ws(" ", "company_id", "company_name", "ticker")), F.lit(wanted)))
        return self._envelope(found, "company", F.col("company_id")).orderBy(F.lower("record.company_name"), "id")

    def _of(self, company: str) -> DataFrame:
        return self.events.where(F.lower("company_id") == company.strip().lower())

    def company_earnings(self, company: str) -> DataFrame:
        """The latest event, or no row (NOT_FOUND)."""
        last = self._of(company).orderBy(F.desc("report_date"), F.desc("published_at"), "event_id").limit(1)
        return self._envelope(last, "earnings", F.col("event_id"))

    def earnings_history(self, company: str) -> DataFrame:
        rows = self._envelope(self._of(company), "earnings", F.col("event_id"))
        return rows.orderBy("record.report_date", "record.published_at", "id")

    def evidence_of(self, event_id: str) -> DataFrame:
        return self._envelope(self.evidence.where(F.col("event_id") == event_id), "evidence", F.col("event_id"))

    def lineage(self) -> DataFrame:
        return self._envelope(self.manifest, "lineage", F.col("path"))

    def audit_status(self) -> DataFrame:
        """(status, audits): BLOCKED if any audit is neither PASS nor SUCCESS, or there is none."""
        clean = F.coalesce(F.bool_and(F.col("status").isin("PASS", "SUCCESS")), F.lit(False))
        return self.audits.agg(F.when(clean, "PASS").otherwise("BLOCKED").alias("status"), F.count("*").alias("audits"))

    def publication_snapshot(self) -> DataFrame:
        """(events, companies, latest, null_reason)."""
        out = self.events.agg(F.count("*").alias("events"), F.count_distinct("company_id").alias("companies"), F.max("published_at").alias("latest"))
        return out.withColumn("null_reason", F.when(F.col("events") == 0, "no_published_events"))

    def data_quality(self) -> DataFrame:
        """(path, state): MATCH, REVISION_CHANGED or MISSING of each manifest entry."""
        f = self.files.select("path", F.col("sha256").alias("_h"))
        state = F.when(F.col("_h").isNull(), "MISSING").when(F.col("_h") == F.col("sha256"), "MATCH").otherwise("REVISION_CHANGED")
        return self.manifest.join(f, "path", "left").select("path", state.alias("state"))
