"""Streams with state and cursors, archives by members, the tiered store, the crawl frontier."""

import json
import threading
import zipfile
from datetime import datetime
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from quern.operators import crawl
from quern.sources import archives, paging, readers
from quern.streaming import documents, ledger, tiers

VISITS = "url string, sha256 string, ok boolean, at timestamp"


def visit(url, digest, day, ok=True):
    return (url, digest, ok, datetime(2024, 1, day))


def put(spark, path, name, rows):
    spark.createDataFrame(rows, VISITS).coalesce(1).write.parquet(f"{path}/{name}")


def run(spark, tmp_path, gone_after=20 * 86400):
    """Everything that is there, a folder a batch, to the checkpoint of the test."""
    stream = spark.readStream.schema(VISITS).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    sink = ledger.upsert(f"{tmp_path}/out", "url", "last_checked")
    ledger.run_available(documents.tracked(stream, gone_after), sink, f"{tmp_path}/state")
    return {r.url: (r.sha256, r.status, r.first_seen.day, r.last_checked.day, r.retries) for r in ledger.latest(
        spark, f"{tmp_path}/out", spark.createDataFrame([], documents.OUTPUT).schema, "url").collect()}


def test_document_states_over_restarts_equal_the_batch_merge(spark, tmp_path):
    days = {
        1: [visit("a", "h1", 1), visit("b", "h1", 1), visit("c", None, 1, False)],
        2: [visit("a", "h1", 2), visit("b", None, 2, False), visit("c", None, 2, False)],
        3: [visit("a", "h2", 3), visit("b", None, 3, False), visit("c", "h9", 3), visit(None, "x", 3)],
        4: [visit("b", "h1", 4), visit("d", "h4", 4)]}
    batch = spark.createDataFrame([], "url string, sha256 string, status string, first_seen timestamp, last_checked timestamp, retries int")
    for day, rows in days.items():
        put(spark, f"{tmp_path}/in", f"{day}.parquet", rows)
        got = run(spark, tmp_path)  # started anew for each day
        seen = spark.createDataFrame(rows, VISITS).where("url is not null").select("url", "sha256", "ok")
        batch = spark.createDataFrame(ledger.document_state(batch, seen, F.lit(f"2024-01-0{day}").cast("timestamp")).collect(), batch.schema)
        assert got == {r.url: (r.sha256, r.status, r.first_seen.day, r.last_checked.day, r.retries) for r in batch.collect()}
    assert got["b"] == ("h1", "unchanged", 1, 4, 0) and got["c"] == ("h9", "changed", 1, 3, 0)
    assert run(spark, tmp_path) == got  # nothing new
    put(spark, f"{tmp_path}/in", "5.parquet", [visit("e", "h", 30)])
    put(spark, f"{tmp_path}/in", "6.parquet", [visit("a", "h2", 31)])  # a's state has ended, so it is found anew
    got = run(spark, tmp_path)
    assert got["d"][1] == "gone" and got["c"][1] == "gone" and got["e"][1] == "changed" and got["a"] == ("h2", "changed", 31, 31, 0)


def test_documents_of_one_bucket_share_a_state_and_end_on_their_own(spark, tmp_path):
    many = [visit(f"u{i}", f"h{i}", 1 + i % 3) for i in range(200)]
    days = [many, [visit("u0", "h0", 10), visit("u1", None, 10, False), visit("u0", "h0", 9)], [visit("u2", "h2", 25)], [visit("u3", "x", 27), visit("u0", "h9", 27)]]
    found = {}
    for buckets in (1, 7, 4096):
        at = tmp_path / str(buckets)
        for i, rows in enumerate(days):
            put(spark, f"{at}/in", f"{i}.parquet", rows)
        stream = spark.readStream.schema(VISITS).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{at}/in")
        query = ledger.run_available(documents.tracked(stream, 15 * 86400, "2 days", buckets), ledger.upsert(f"{at}/out", "url", "last_checked"), f"{at}/state")
        held = query.lastProgress.stateOperators[0].numRowsTotal
        rows = ledger.latest(spark, f"{at}/out", spark.createDataFrame([], documents.OUTPUT).schema, "url").collect()
        found[buckets] = {r.url: (r.sha256, r.status, r.first_seen.day, r.last_checked.day, r.retries) for r in rows}
        assert held <= min(buckets, 4) and len(rows) == 200  # u0, u2 and u3 live, u1 may
    assert found[1] == found[7] == found[4096]
    assert found[1]["u0"] == ("h9", "changed", 27, 27, 0) and found[1]["u2"] == ("h2", "changed", 25, 25, 0) and found[1]["u3"] == ("x", "changed", 27, 27, 0)
    assert found[1]["u7"] == ("h7", "gone", 2, 2, 0) and found[1]["u199"][1] == "gone"


class Service:
    """Pages 0 to n - 1 by cursor; counts what is asked for, and fails as told."""

    def __init__(self, pages, follow=lambda i, n: f"c{i + 1}" if i + 1 < n else None, fail=()):
        self.asked, self.fail = [], list(fail)
        service = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                at = parse_qs(urlparse(self.path).query).get("pagination_key", ["c0"])[0]
                service.asked.append(at)
                if service.fail and service.fail[0][0] == at:
                    _, code, wait = service.fail.pop(0)
                    self.send_response(code)
                    self.send_header("Retry-After", wait)
                    self.end_headers()
                    return
                i = int(at[1:])
                body = {"data": pages[i % len(pages)], "code": "0"} | ({"pagination_key": k} if (k := follow(i, len(pages))) else {})
                self.send_response(200)
                self.end_headers()
                self.wfile.write(json.dumps(body).encode())

            def log_message(self, *_):
                pass

        self.server = HTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}/bars?code=1"


def test_a_stopped_stream_asks_for_each_page_once(spark, tmp_path):
    pages = [[{"d": "2024-01-01", "c": "x", "v": 1}], [{"d": "2024-01-02", "c": "x", "v": 2}, {"d": "2024-01-01", "c": "x", "v": 3}], [], [{"d": "2024-01-03", "c": "x", "v": 4}]]
    service = Service(pages, fail=[("c1", 429, "0"), ("c3", 503, "0")])
    out = f"{tmp_path}/out"

    def go(batches):
        left = [batches]

        def sink(df, epoch):
            df.write.mode("overwrite").parquet(f"{out}/epoch={epoch}")
            left[0] -= 1
            if not left[0]:
                raise RuntimeError("stopped")

        query = paging.paged(spark, service.url, gap="0", code="code").writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/c").start()
        try:
            query.processAllAvailable()
        except Exception as e:
            assert "stopped" in str(e)
        finally:
            query.stop()

    go(2)
    first = list(service.asked)
    go(99)
    service.server.shutdown()
    assert first[:3] == ["c0", "c1", "c1"]
    again = service.asked[len(first):]
    assert set(first) | set(again) == {"c0", "c1", "c2", "c3"} and "c0" not in again  # what is committed is not asked for again
    rows = spark.read.parquet(out).select("page", "position", F.get_json_object("record", "$.d").alias("d"), F.get_json_object("record", "$.c").alias("c"), F.get_json_object("record", "$.v").alias("v"))
    assert rows.count() == 4
    assert sorted((r.d, r.v) for r in paging.last_of_keys(rows, ["d", "c"]).collect()) == [("2024-01-01", "3"), ("2024-01-02", "2"), ("2024-01-03", "4")]


def test_offsets_find_cycles_and_stay_small():
    at = {"cursor": None, "page": 0, "done": False, "mark": None}
    for i in range(1000):
        at = paging.advanced(at, f"c{i}")
        assert len(json.dumps(at)) < 90
    cycle = {"cursor": None, "page": 0, "done": False, "mark": None}
    with pytest.raises(paging.ServiceError, match="twice"):
        for i in range(300):
            cycle = paging.advanced(cycle, f"c{i if i < 40 else 40 + (i - 40) % 7}")
    assert paging.advanced(at, None)["done"]


def test_answers_that_are_no_pages():
    service = Service([[{"a": 1}]])
    client = paging.Client({"url": service.url, "gap": "0"})
    assert client.page(None) == ([{"a": 1}], None)
    for options in ({"records": "rows"}, {"code": "pagination_key"}):
        with pytest.raises(paging.ServiceError):
            paging.Client({"url": service.url, "gap": "0", **options}).page(None)
    service.fail = [("c0", 429, "7")] * 2
    slept = []
    with pytest.raises(readers.RetryLater):
        paging.Client({"url": service.url, "attempts": "2"}, readers.Pacer(0, sleep=slept.append)).page(None)
    assert slept == [7.0]
    service.server.shutdown()


def test_members_come_from_several_tasks(spark, tmp_path):
    path = f"{tmp_path}/bulk.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for cik in (1, 2, 3):
            z.writestr(f"CIK{cik:010d}.json", json.dumps({"cik": cik, "x": "y" * 1000}))
        z.writestr("folder/", "")
        z.writestr("empty.json", "")
    found = archives.members(spark, path, partition_bytes=1)
    assert found.rdd.getNumPartitions() == 4 and {r.member: len(r.content) for r in found.collect()}["empty.json"] == 0
    placed = archives.members(spark, path, pattern="CIK*", partition_bytes=1).select("member", F.spark_partition_id().alias("p"), "size", F.crc32("content").alias("crc"), "crc32").collect()
    assert len({r.p for r in placed}) == 3 and all(r.crc == r.crc32 for r in placed)
    assert archives.members(spark, path).rdd.getNumPartitions() == 1
    assert {(r.cik, json.loads(bytes(r.content))["cik"]) for r in archives.company_members(spark, path, [3, 1], 1).collect()} == {(1, 1), (3, 3)}
    with pytest.raises(Exception, match="missing member CIK0000000009"):
        archives.company_members(spark, path, [1, 9]).collect()
    with zipfile.ZipFile(f"{tmp_path}/wrong.zip", "w") as z:
        z.writestr("CIK0000000001.json", '{"cik": 2}')
    with pytest.raises(Exception, match="another company"):
        archives.company_members(spark, f"file://{tmp_path}/wrong.zip", [1]).collect()
    raw = bytearray(open(path, "rb").read())
    raw[60:70] = b"0123456789"
    open(f"{tmp_path}/bad.zip", "wb").write(raw)
    with pytest.raises(Exception):
        archives.members(spark, f"{tmp_path}/bad.zip", ["CIK0000000001.json"]).collect()
    assert archives.members(spark, f"{tmp_path}/bad.zip", ["CIK0000000003.json"]).count() == 1  # only its own bytes are read


def test_tiers_keep_reads_small_and_survive_crashes(spark, tmp_path, monkeypatch):
    schema = spark.createDataFrame([], "k int, v int").schema
    store = tiers.TieredStore(spark, f"{tmp_path}/s", schema, ["k"], "v", tier=3)
    assert store.latest().count() == 0
    batch = lambda e: spark.createDataFrame([(e % 4, e), (100 + e, 0), (e % 4, e - 50)], schema)
    for e in range(10):
        store.append(batch(e), e)
        assert len(store.manifest().runs) <= 2 * 3  # two a level, three levels
    want = {0: 8, 1: 9, 2: 6, 3: 7} | {100 + e: 0 for e in range(10)}
    shown = lambda: {r.k: r.v for r in store.latest().collect()}
    assert shown() == want and [r[1] for r in store.manifest().runs].count(2) == 1
    before = store.manifest()
    assert store.append(batch(3), 3) == before and shown() == want  # a replay
    monkeypatch.setattr(store, "_publish", lambda m: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        store.append(batch(10), 10)
    monkeypatch.undo()
    assert shown() == want and store.manifest() == before
    (tmp_path / "s" / "manifests" / f"{before.version + 1:012d}.json").write_text('{"version": 9')  # torn
    assert store.manifest() == before
    with pytest.raises(tiers.Overtaken):
        store.append(batch(10), 10)
    (tmp_path / "s" / "manifests" / f"{before.version + 1:012d}.json").unlink()
    crc = tmp_path / "s" / "manifests" / f".{before.version + 1:012d}.json.crc"
    crc.unlink(missing_ok=True)
    store.append(batch(10), 10)
    assert shown() == want | {2: 10, 110: 0}
    gone = store.vacuum()
    assert gone and shown() == want | {2: 10, 110: 0}


def test_crawl(spark):
    u = lambda h, p: f"https://{h}/{p}"
    a, b = "a.gov", "sub.a.gov"
    rows = [(u(a, 1), [u(a, 2), u(b, 1), u("evil.org", 1), u(a, 2), None]), (u(a, 2), [u(a, 1), u(a, 3), u("nota.gov", 1)]), (u(b, 1), [u(b, 2), u(b, 3), u(b, 4)]), (u(b, 2), [u(a, 9)]), (u(a, 9), []), (u(a, 3), None),
            (u(b, 3), []), (u(b, 4), []), (u(a, 77), [u(a, 78)])]
    pages = spark.createDataFrame(rows, "url string, links array<string>")
    seeds = spark.createDataFrame([(u(a, 1),), (None,)], "url string")
    show = lambda df: {r.url: (r.depth, r.outcome) for r in df.collect()}
    whole = show(crawl.crawl(pages, seeds, ["a.gov"]))
    assert whole == {u(a, 1): (0, "fetched"), u(a, 2): (1, "fetched"), u(b, 1): (1, "fetched"), u("evil.org", 1): (1, "domain_not_allowed"), u(a, 3): (2, "fetched"), u("nota.gov", 1): (2, "domain_not_allowed"),
                     u(b, 2): (2, "fetched"), u(b, 3): (2, "fetched"), u(b, 4): (2, "fetched"), u(a, 9): (3, "fetched")}
    few = show(crawl.crawl(pages.where(F.col("url") != u(b, 2)), seeds, ["a.gov"], per_host=2))
    assert few[u(b, 2)] == (2, "missing") and few[u(b, 3)] == few[u(b, 4)] == (2, "host_budget") and few[u(a, 3)] == (2, "host_budget") and u(a, 9) not in few
    assert show(crawl.crawl(pages, seeds, ["a.gov"], rounds=1))[u(a, 2)] == (1, "rounds") and crawl.crawl(pages, seeds.limit(0), ["a.gov"]).count() == 0
