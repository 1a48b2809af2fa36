"""ZIP archives read by members: spark.read.format("zip_members").

The driver reads an archive's central directory, which lies at its end; each input
partition is a run of members that lie side by side, and its task reads just their
bytes. No task and no memory holds a whole archive, which may be larger than 2 GB.
"""

from __future__ import annotations

import fnmatch
import json
import zipfile
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql import functions as F

#: Compressed bytes of a partition's members, about; a larger member is a partition of its own.
PARTITION_BYTES = 32 << 20
SCHEMA = "archive string, member string, size long, crc32 long, content binary"


class MissingMember(ValueError):
    """A member that was asked for is not in the archive."""


def opened(path: str):
    """A seekable file of any file system that pyarrow knows: local, hdfs, s3, gs; read by ranges."""
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}") if not path.startswith("file:/") or path.startswith("file:///") else fs.FileSystem.from_uri("file://" + path[5:])
    return system.open_input_file(at)


@dataclass
class Members(InputPartition):
    """Names of members of one archive."""

    archive: str
    names: tuple[str, ...]

    def __init__(self, archive: str, names: tuple[str, ...]):
        super().__init__((archive, names))
        self.archive, self.names = archive, names


class ZipMembers(DataSource):
    """Options: path; partition_bytes; members, a list of names as JSON, each of which must be there; pattern, a glob of names."""

    @classmethod
    def name(cls) -> str:
        return "zip_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.most = options["path"], int(options.get("partition_bytes", PARTITION_BYTES))
        self.wanted = json.loads(options["members"]) if "members" in options else None
        self.pattern = options.get("pattern", "*")

    def partitions(self) -> list[Members]:
        """Runs of members by place in the archive; a name that is there twice counts once, by its last entry, as archives are read."""
        with opened(self.path) as f, zipfile.ZipFile(f) as z:
            entries = {e.filename: e for e in z.infolist() if not e.is_dir()}
        if self.wanted is not None:
            if lacking := sorted(set(self.wanted) - set(entries)):
                raise MissingMember(f"missing member {', '.join(lacking)} in {self.path}")
            entries = {n: entries[n] for n in self.wanted}
        parts, held, size = [], [], 0
        for entry in sorted((e for e in entries.values() if fnmatch.fnmatchcase(e.filename, self.pattern)), key=lambda e: e.header_offset):
            if held and size + entry.compress_size > self.most:
                parts, held, size = [*parts, Members(self.path, tuple(held))], [], 0
            held.append(entry.filename)
            size += entry.compress_size
        return [*parts, Members(self.path, tuple(held))] if held else []

    def read(self, partition: Members):
        if partition is None:
            return
        with opened(partition.archive) as f, zipfile.ZipFile(f) as z:
            for name in partition.names:
                entry = z.getinfo(name)
                content = z.read(entry)  # its checksum is verified
                yield pa.RecordBatch.from_arrays(
                    [pa.array([partition.archive]), pa.array([name]), pa.array([entry.file_size]), pa.array([entry.CRC], pa.int64()), pa.array([content], pa.binary())],
                    ["archive", "member", "size", "crc32", "content"])


def members(spark: SparkSession, path: str, wanted: list[str] | None = None, pattern: str = "*", partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(archive, member, size, crc32, content) of the members asked for, or all; a missing one fails before anything is read.

    An archive without members gives no rows; an empty member has empty content; a
    damaged one fails its task.
    """
    spark.dataSource.register(ZipMembers)
    reader = spark.read.format("zip_members").option("pattern", pattern).option("partition_bytes", partition_bytes)
    return (reader if wanted is None else reader.option("members", json.dumps(wanted))).load(path)


def company_members(spark: SparkSession, path: str, ciks: list[int], partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """(cik, member, content) of companies' documents in a bulk archive; a document that names another company fails its task."""
    found = members(spark, path, [f"CIK{c:010d}.json" for c in ciks], partition_bytes=partition_bytes)
    cik = F.regexp_extract("member", r"CIK(\d{10})\.json$", 1).cast("long")
    inside = F.get_json_object(F.col("content").cast("string"), "$.cik").try_cast("long")
    content = F.when(inside.eqNullSafe(cik), F.col("content")).otherwise(F.raise_error(F.concat(F.lit("document of another company in member "), F.col("member"))).cast("binary"))
    return found.select(cik.alias("cik"), "member", content.alias("content"))
