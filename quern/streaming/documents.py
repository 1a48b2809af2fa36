"""State of crawled documents as a stream: keyed state of the living documents, with a timeout that ends a document's when it is gone."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Statuses after which content of the same digest need not be parsed again.
PARSED = ("parsed", "no_kpi", "unchanged")
#: Documents of a bucket by url, as JSON: digest, first_seen and last_checked in microseconds, retries.
STATE = "documents string"
OUTPUT = "url string, sha256 string, status string, first_seen timestamp, last_checked timestamp, retries int, parse boolean"
MICROS = OUTPUT.replace("timestamp", "long")
COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Keys that the documents are dealt over by their urls: a call into Python and a state are for a bucket, not for a document.
BUCKETS = 4096


def bucket(gone_after: float) -> Callable[[tuple, Iterator[pd.DataFrame], GroupState], Iterator[pd.DataFrame]]:
    """Visits (url, sha256, ok, us) of a bucket's documents, of each in order of time, to the document's state after each.

    A first or different digest is `changed` and must be parsed; the same one is
    `unchanged` and need not; a failed visit keeps the digest and counts a retry,
    which the next good one clears. first_seen stays. A document not visited for
    `gone_after` seconds of event time is `gone`: it is put out once more and its
    state ends, so the store holds living documents only; a later visit finds it anew.
    """
    lives = int(gone_after * 1_000_000)

    def gone(url: str, held: list) -> tuple:
        return (url, held[0], "gone", *held[1:], False)

    def follow(key: tuple, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        documents, out = json.loads(state.get[0]) if state.exists else {}, []
        visits = [] if state.hasTimedOut else [v for r in rows for v in zip(r["us"].tolist(), r["url"], r["sha256"], r["ok"].tolist(), strict=True)]
        for at, url, sha256, ok in sorted(visits, key=lambda v: v[0]):
            held = documents.get(url)
            if held and at - held[2] > lives:  # its timeout has not come yet
                out.append(gone(url, held))
                held = None
            digest, first, _, retries = held or (None, at, None, 0)
            if ok:
                status, held = "unchanged" if sha256 == digest else "changed", [sha256, first, at, 0]
            else:
                status, held = "failed", [digest, first, at, retries + 1]
            documents[url] = held
            out.append((url, held[0], status, *held[1:], status == "changed"))
        now, ends = state.getCurrentWatermarkMs(), lambda held: (held[2] + lives) // 1000
        for url in [u for u, held in documents.items() if ends(held) <= now]:
            out.append(gone(url, documents.pop(url)))
        if documents:
            state.update((json.dumps(documents, separators=(",", ":")),))
            state.setTimeoutTimestamp(max(1, min(map(ends, documents.values())) - 1))  # fires once the watermark is past it
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=COLUMNS)

    return follow


def tracked(visits: DataFrame, gone_after: float = 90 * 86400, late: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """The stream of states (OUTPUT) of a stream of visits (url, sha256, ok, at); null urls take no part.

    State lives in RocksDB, keyed by buckets of urls, so it is as large as the
    documents alive and a restart goes on from the checkpoint; a stream keeps its
    number of buckets, as a batch rewrites those that it touches. The states of one
    visit more than `late` behind the stream's time are dropped by the watermark.
    """
    visits.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = visits.where(F.col("url").isNotNull()).select("url", "sha256", F.coalesce("ok", F.lit(False)).alias("ok"), "at").withWatermark("at", late)
    dealt = rows.select(F.pmod(F.xxhash64("url"), F.lit(buckets)).alias("bucket"), "*", F.unix_micros("at").alias("us"))
    states = dealt.groupBy("bucket").applyInPandasWithState(bucket(gone_after), MICROS, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return states.withColumns({c: F.timestamp_micros(c) for c in ("first_seen", "last_checked")})
