"""Sources: strict JSON and line-delimited JSON, filing documents, archives, paged services, file trees."""

from __future__ import annotations

import io
import time
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FACT = (
    "struct<start:date,end:date,val:decimal(38,6),accn:string,fy:int,fp:string,form:string,filed:date,frame:string>")
COMPANY_FACTS = (
    f"cik long, entityName string, facts map<string,map<string,struct<label:string,description:string,units:map<string,array<{FACT}>>>>>")
_STRINGS = "accessionNumber filingDate reportDate acceptanceDateTime act form fileNumber filmNumber items primaryDocument".split()
SUBMISSIONS = "cik long, name string, filings struct<recent:struct<" + ",".join(f"{c}:array<string>" for c in _STRINGS) + ",size:array<bigint>>>"


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Whole-file JSON objects with an explicit schema; a malformed one fails the read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Line-delimited JSON with an explicit schema; blank lines are skipped, a malformed one fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def typed_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """By suffix: .ndjson and .jsonl as lines, others as documents."""
    return json_lines(spark, path, schema) if path.endswith((".ndjson", ".jsonl")) else json_documents(spark, path, schema)


def company_facts(documents: DataFrame) -> DataFrame:
    """Flat facts of nested company documents: taxonomy x concept x unit x observation."""
    t = documents.select("cik", "entityName", F.explode("facts").alias("taxonomy", "_c"))
    c = t.select("cik", "entityName", "taxonomy", F.explode("_c").alias("concept", "_b"))
    u = c.select("cik", "entityName", "taxonomy", "concept", "_b.label", "_b.description", F.explode("_b.units").alias("unit", "_o"))
    return u.select(
        "cik", F.col("entityName").alias("entity_name"), "taxonomy", "concept", "label", "description", "unit", F.explode("_o").alias("_f")
    ).select(
        "cik", "entity_name", "taxonomy", "concept", "label", "description", "unit", F.col("_f.val").alias("value"), F.col("_f.start").alias("period_start"),
        F.col("_f.end").alias("period_end"), F.col("_f.accn").alias("accession"), F.col("_f.fy").alias("fiscal_year"),
        F.col("_f.fp").alias("fiscal_period"), "_f.form", "_f.filed", "_f.frame")


def filings(documents: DataFrame) -> DataFrame:
    """Rows from the parallel arrays of submissions; shorter arrays give nulls, rows without an accession go."""
    array = lambda c, kind: F.coalesce(f"filings.recent.{c}", F.array().cast(f"array<{kind}>")).alias(c)
    zipped = F.arrays_zip(*(array(c, "string") for c in _STRINGS), array("size", "bigint"))
    rows = documents.select("cik", "name", F.explode(zipped).alias("_r")).select("cik", "name", "_r.*")
    return rows.where(F.coalesce("accessionNumber", F.lit("")) != "")


def archive_members(spark: SparkSession, path: str, wanted: list[str] | None = None) -> DataFrame:
    """(archive, member, content) of ZIP files; with `wanted` only those members are unpacked, by the tasks. Each archive is read by one task."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    names = None if wanted is None else frozenset(wanted)

    def unzip(batches):
        for batch in batches:
            for at, raw in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                with zipfile.ZipFile(io.BytesIO(raw)) as z:
                    for name in z.namelist():
                        if names is None or name in names:
                            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([name]), pa.array([z.read(name)], pa.binary())], ["archive", "member", "content"])

    return files.mapInArrow(unzip, "archive string, member string, content binary")


def member_name(cik: int) -> str:
    """A company's member of the bulk archive."""
    return f"CIK{cik:010d}.json"


def company_members(spark: SparkSession, path: str, ciks: list[int]) -> DataFrame:
    """(cik, member, content) of the companies asked for; a company without a member, or whose document names another, fails the read."""
    asked = spark.createDataFrame([(c, member_name(c)) for c in ciks], "cik long, member string")
    found = archive_members(spark, path, [member_name(c) for c in ciks])
    inside = F.get_json_object(F.col("content").cast("string"), "$.cik").try_cast("long")
    joined = asked.join(found, "member", "left")
    wrong = F.when(F.col("content").isNull(), "missing member").when(~inside.eqNullSafe(F.col("cik")), "document of another company in")
    content = F.when(wrong.isNull(), F.col("content")).otherwise(F.raise_error(F.concat_ws(" ", wrong, "member")).cast("binary"))
    return joined.select("cik", "member", content.alias("content"))


def file_hashes(spark: SparkSession, path: str, pattern: str = "*", exclude: str | None = None) -> DataFrame:
    """(path, sha256, size_bytes) of the files of a tree that match a glob, but for those whose path matches the regular expression `exclude`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    files = files if exclude is None else files.where(~F.col("path").rlike(exclude))
    return files.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("size_bytes"))


def audit_documents(spark: SparkSession, path: str, schema: str, pattern: str = "*audit_latest.json") -> DataFrame:
    """Documents whose names match a glob, with the file that each came from."""
    rows = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", pattern).json(path)
    return rows.select("*", F.col("_metadata.file_path").alias("file_path"))


LISTS = ("companies", "financials", "items", "results")


def unwrapped(rows: DataFrame, column: str, element: str) -> DataFrame:
    """Records of response envelopes: what is under `data` if it is there; of that the list itself, or one named in LISTS, else the whole as one."""
    at = lambda text, key: F.get_json_object(text, f"$.{key}")
    body = F.coalesce(at(F.col(column), "data"), F.col(column))
    as_list = lambda text: F.when(F.ltrim(text).startswith("["), F.from_json(text, f"array<{element}>"))
    lists = F.coalesce(as_list(body), *(as_list(at(body, k)) for k in LISTS), F.array(F.from_json(body, element)))
    return rows.select(*(c for c in rows.columns if c != column), F.explode(lists).alias("record"))


@dataclass
class Pacer:
    """At most one call in `gap` seconds; clock and sleep can be replaced."""

    gap: float = 0.1
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    last: float = field(default=float("-inf"))

    def wait(self) -> None:
        if (left := self.last + self.gap - self.clock()) > 0:
            self.sleep(left)
        self.last = self.clock()


class RetryLater(Exception):
    """The service asks to come back after some seconds."""

    def __init__(self, seconds: float):
        self.seconds = seconds


def pages(fetch: Callable[[str | None], tuple[list[dict], str | None]], pacer: Pacer, attempts: int = 3) -> Iterator[dict]:
    """Records of a paged service: fetch(key) gives records and the next key; a key seen before is an error."""
    key, seen = None, set()
    while True:
        for attempt in range(attempts):
            pacer.wait()
            try:
                rows, following = fetch(key)
                break
            except RetryLater as later:
                if attempt + 1 == attempts:
                    raise
                pacer.sleep(later.seconds)
        yield from rows
        if not following:
            return
        if following in seen:
            raise ValueError(f"page key {following!r} came twice")
        seen.add(following)
        key = following


class PagedSource(DataSource):
    """spark.read.format("paged"): options url, records (name of the list) and key (of the next page); one paced reader."""

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "record string"

    def reader(self, schema) -> DataSourceReader:
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # one caller, so that the service's rate limit holds

    def read(self, partition):
        import json
        from urllib.error import HTTPError
        from urllib.parse import quote
        from urllib.request import urlopen

        url, records, key = self.options["url"], self.options.get("records", "data"), self.options.get("key", "pagination_key")

        def fetch(at):
            target = url if at is None else f"{url}{'&' if '?' in url else '?'}{key}={quote(at)}"
            try:
                with urlopen(target, timeout=60) as answer:
                    body = json.load(answer)
            except HTTPError as e:
                if e.code == 429 or e.code >= 500:
                    raise RetryLater(float(e.headers.get("Retry-After", 1))) from e
                raise
            return body.get(records, []), body.get(key)

        for row in pages(fetch, Pacer(float(self.options.get("gap", 0.1)))):
            yield (json.dumps(row, sort_keys=True),)
