"""What the training-data operators share: scratch tables, Arrow batches, text columns."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of a batch that goes to a Python worker; a larger row goes alone.
BATCH_BYTES = 4 << 20


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all executors share (spark.checkpoint.dir).

    Without that setting a master on one machine gets a temporary folder of its
    own; a cluster is an error, as its executors would not see each other's files.
    """
    context = spark.sparkContext
    shared = context.getConf().get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = _own_folder(context.applicationId)
    return f"{shared.rstrip('/')}/quern-{context.applicationId}/{uuid.uuid4().hex}"


@lru_cache(1)
def _own_folder(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="quern-")


def stage(df: DataFrame) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends here, and a lost executor loses nothing.

    Results are lazy, so staged tables stay until the caller is done with them:
    all lie in the folder quern-<application id>, which can then be deleted.
    """
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds the bytes of a batch that goes to Python, so that a worker's memory is bounded whatever the texts weigh.

    The plans that need it run after the operator has returned, so it stays set; a lower bound of the caller's stays too.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", spark.conf.get(key))
    if not now or not 0 < int(now[1]) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


_REMEMBERS: list[tuple[str, Callable[[], None]]] = []


def owned(operator: str, forget: Callable[[], None] = lambda: None) -> None:
    """Called by an operator's tasks: a Python worker outlives them, so what another operator's tasks remember in it is forgotten first."""
    if _REMEMBERS and _REMEMBERS[0][0] == operator:
        return
    for _, other in _REMEMBERS:
        other()
    _REMEMBERS[:] = [(operator, forget)]
    pa.default_memory_pool().release_unused()


def own_name(taken: list[str], name: str) -> str:
    """name, or with further underscores so that no column of the input has it; case does not tell names apart."""
    held = {t.lower() for t in taken}
    while name.lower() in held:
        name += "_"
    return name


def as_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a text column; null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of equal neighbours."""
    if len(keys):
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        yield from zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True)


def whole_runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroups sorted batches so that no run of equal keys is cut; holds one batch and the open run."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key)
        first, last = keys[0].as_py(), keys[-1].as_py()
        if held and held[-1].column(key)[-1].as_py() != first:
            yield pa.Table.from_batches(held)
            held = []
        if first == last:
            held.append(batch)
            continue
        values = keys.to_numpy(zero_copy_only=False)
        cut = int(np.flatnonzero(values != last)[-1]) + 1
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)
