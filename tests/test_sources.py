"""Sources, sinks, streams and the read service on small files."""

import json
import threading
import zipfile
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from quern.plans.service import ReadService
from quern.sources import readers, sinks
from quern.streaming import ledger


def test_json_reads_are_strict(spark, tmp_path):
    (tmp_path / "a.ndjson").write_text('{"a":1}\n\n{"a":2}\n')
    (tmp_path / "b.json").write_text('{\n"a": 3\n}')
    (tmp_path / "bad.ndjson").write_text('{"a":1}\nnot json\n')
    assert sorted(r.a for r in readers.typed_documents(spark, f"{tmp_path}/a.ndjson", "a int").collect()) == [1, 2]
    assert [r.a for r in readers.typed_documents(spark, f"{tmp_path}/b.json", "a int").collect()] == [3]
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.json_lines(spark, f"{tmp_path}/bad.ndjson", "a int").collect()


def test_company_documents(spark, tmp_path):
    fact = {"end": "2023-12-31", "val": 5, "accn": "a-1", "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2024-02-01"}
    doc = {"cik": 7, "entityName": "E", "facts": {"us-gaap": {"Cash": {"label": "l", "description": "d", "units": {"USD": [fact, fact | {"start": "2023-01-01"}]}}}}}
    (tmp_path / "f.json").write_text(json.dumps(doc))
    rows = readers.company_facts(readers.json_documents(spark, f"{tmp_path}/f.json", readers.COMPANY_FACTS)).collect()
    assert len(rows) == 2 and {r.period_start for r in rows} != {None} and float(rows[0].value) == 5 and rows[0].concept == "Cash"
    recent = {"accessionNumber": ["x", "", "y"], "form": ["10-K", "8-K"], "size": [1, 2, 3]}
    (tmp_path / "s.json").write_text(json.dumps({"cik": 7, "name": "E", "filings": {"recent": recent}}))
    got = readers.filings(readers.json_documents(spark, f"{tmp_path}/s.json", readers.SUBMISSIONS)).collect()
    assert [(r.accessionNumber, r.form, r.size) for r in got] == [("x", "10-K", 1), ("y", None, 3)]


def test_archives_and_hashes(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("one.json", "1")
        z.writestr("two.json", "22")
    wanted = ["two.json"]
    assert [(r.member, bytes(r.content)) for r in readers.archive_members(spark, f"{tmp_path}/z.zip", wanted).collect()] == [("two.json", b"22")]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "x.txt").write_text("abc")
    assert readers.file_hashes(spark, f"{tmp_path}/t", "*.txt", r"\.txt$").count() == 0
    r = readers.file_hashes(spark, f"{tmp_path}/t", "*.txt").first()
    assert r.size_bytes == 3 and r.sha256.startswith("ba7816bf")
    env = spark.createDataFrame([('{"data":[{"a":1},{"a":2}]}',), ('{"a":3}',)], "body string")
    assert sorted(r.record.a for r in readers.unwrapped(env, "body", "struct<a:int>").collect()) == [1, 2, 3]
    deep = spark.createDataFrame([('{"data":{"items":[{"a":4},{"a":5}]}}',), ('{"data":{"a":6}}',), ('{"data":[{"a":7}]}',), ('{"results":[]}',)], "body string")
    assert sorted(r.record.a for r in readers.unwrapped(deep, "body", "struct<a:int>").collect()) == [4, 5, 6, 7]


def test_company_members(spark, tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "bulk.zip", "w") as z:
        z.writestr(readers.member_name(1), '{"cik": 1}')
        z.writestr(readers.member_name(2), '{"cik": "0000000003"}')
    read = lambda ciks: readers.company_members(spark, f"{tmp_path}/bulk.zip", ciks).collect()
    assert [(r.cik, bytes(r.content)) for r in read([1])] == [(1, b'{"cik": 1}')]
    with pytest.raises(Exception, match="another company"):
        read([2])
    with pytest.raises(Exception, match="missing member"):
        read([1, 9])


def test_pages():
    now, slept = [0.0], []
    pacer = readers.Pacer(1.0, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    answers = {None: ([{"a": 1}], "k"), "k": ([{"a": 2}], None)}
    failed = []

    def fetch(key):
        if key == "k" and not failed:
            failed.append(1)
            raise readers.RetryLater(5)
        return answers[key]

    assert list(readers.pages(fetch, pacer)) == [{"a": 1}, {"a": 2}] and 5 in slept and slept.count(1.0) >= 1
    with pytest.raises(ValueError, match="twice"):
        list(readers.pages(lambda key: ([], "same"), pacer))


def test_paged_source(spark):
    class Stub(BaseHTTPRequestHandler):
        def do_GET(self):
            body = {"data": [{"n": 2}]} if "pagination_key=b" in self.path else {"data": [{"n": 1}], "pagination_key": "b"}
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps(body).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    spark.dataSource.register(readers.PagedSource)
    rows = spark.read.format("paged").option("url", f"http://127.0.0.1:{server.server_port}/x").option("gap", "0").load().collect()
    server.shutdown()
    assert [r.record for r in rows] == ['{"n": 1}', '{"n": 2}']


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, None), (1, "é")], "id int, v string")
    assert sinks.document(df, ["id"]) == '[\n{"id":1,"v":"é"},\n{"id":2,"v":null}\n]\n'
    with pytest.raises(ValueError):
        sinks.document(df, ["id"], 1)
    once = sinks.canonical_lines(df, f"{tmp_path}/l", ["id"])
    assert once == sinks.canonical_lines(df.repartition(3), f"{tmp_path}/l2", ["id"]) != sinks.canonical_lines(df.limit(1), f"{tmp_path}/l3", ["id"])
    assert [r.value for r in spark.read.text(f"{tmp_path}/l").collect()] == ['{"id":1,"v":"é"}', '{"id":2,"v":null}']
    h = sinks.write_if_changed(df, f"{tmp_path}/p", None)
    assert sinks.content_hash(df.repartition(3)) == h and sinks.write_if_changed(df, f"{tmp_path}/never", h) == h
    assert not (tmp_path / "never").exists()
    sinks.by_entity(df, f"{tmp_path}/e", "id")
    assert (tmp_path / "e" / "id=1").exists()
    assert sinks.markdown(df, ["id"]).splitlines()[2] == "| 1 | é |"


def test_stream_replay_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"2024-01-0{1 + i % 3} 00:00:00", i % 2) for i in range(9)], "id int, t string, v int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    rows.coalesce(1).write.parquet(f"{tmp_path}/in/a.parquet")
    rows.coalesce(1).withColumn("v", F.lit(9)).write.parquet(f"{tmp_path}/in/b.parquet")
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in").withColumn("t", F.col("t").cast("timestamp"))
    sink = ledger.upsert(f"{tmp_path}/out", "id", "v")
    ledger.run_available(stream, sink, f"{tmp_path}/c1")
    out = ledger.latest(spark, f"{tmp_path}/out", stream.schema, "id")
    assert out.count() == 9 and [r.v for r in out.select("v").distinct().collect()] == [9]  # the later write wins
    ledger.run_available(stream, sink, f"{tmp_path}/c2")
    assert ledger.latest(spark, f"{tmp_path}/out", stream.schema, "id").count() == 9
    gated = ledger.gated(stream, "t", F.lit("2024-01-02 12:00:00").cast("timestamp"))
    got = ledger.collected(gated.select("id", "disposition", "t"), "id", "t")
    assert got.count() == 9 and got.where("disposition = 'future'").count() == 3


def test_stream_of_a_folder_table_and_late_rows(spark, tmp_path):
    times = ["2024-01-05 00:00:00", "2024-01-01 00:00:00", "2024-01-04 23:30:00"]
    for i, t in enumerate(times):
        spark.createDataFrame([(i, t)], "id int, t string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/events.parquet")
    schema = spark.read.parquet(f"{tmp_path}/in/events.parquet").schema
    rows = ledger.stream(spark, f"{tmp_path}/in", "events", schema, "t", files=1)
    ledger.run_available(rows, ledger.upsert(f"{tmp_path}/out", "id", "t", "t", "1 hour"), f"{tmp_path}/c")
    assert ledger.latest(spark, f"{tmp_path}/out", rows.schema, "id").count() == 3  # none is lost
    assert [r.id for r in spark.read.parquet(f"{tmp_path}/out/late").collect()] in ([1], [])
    seen = spark.read.parquet(f"{tmp_path}/out/rows")
    assert seen.select("epoch").distinct().count() == 3
    order = [r.id for r in seen.orderBy("epoch").collect()]
    late = {i for n, i in enumerate(order) if any(times[j][:10] > times[i][:10] and i == 1 for j in order[:n])}
    assert {r.id for r in spark.read.parquet(f"{tmp_path}/out/late").collect()} == late


def test_document_state(spark):
    t = F.lit("2024-01-02").cast("timestamp")
    old = spark.createDataFrame([("a", "h", "changed", 0), ("b", "h", "changed", 1), ("c", "h", "unchanged", 0)], "url string, sha256 string, status string, retries int")
    old = old.withColumn("first_seen", F.lit("2024-01-01").cast("timestamp")).withColumn("last_checked", F.col("first_seen"))
    seen = spark.createDataFrame([("a", "h", True), ("b", None, False), ("d", "n", True)], "url string, sha256 string, ok boolean")
    got = {r.url: (r.sha256, r.status, r.retries) for r in ledger.document_state(old, seen, t).collect()}
    assert got == {"a": ("h", "unchanged", 0), "b": ("h", "failed", 2), "c": ("h", "unchanged", 0), "d": ("n", "changed", 0)}


def test_read_service(spark):
    rows = [("e1", "c1", "Old Name", "T", "2024-01-01", "2024-01-02"), ("e2", "c1", "Acme", "T", "2024-04-01", "2024-04-02"), ("e3", "c2", "beta", None, "2024-02-01", "2024-02-02")]
    events = spark.createDataFrame(rows, "event_id string, company_id string, company_name string, ticker string, report_date string, published_at string")
    audits = spark.createDataFrame([("a", "PASS"), ("b", "SUCCESS")], "audit string, status string")
    manifest = spark.createDataFrame([("p", "h", 1), ("q", "h", 1), ("r", "h", 1)], "path string, sha256 string, size_bytes long")
    files = spark.createDataFrame([("p", "h", 1), ("q", "i", 1)], manifest.schema)
    evidence = spark.createDataFrame([("e1", "u")], "event_id string, source_url string")
    s = ReadService(events, audits, manifest, files, evidence)
    assert [r.record.company_name for r in s.search_companies(" c ").collect()] == ["Acme", "beta"]
    assert s.search_companies("old").count() == 0
    with pytest.raises(ValueError):
        s.search_companies("x" * 129)
    assert [r.id for r in s.company_earnings("C1").collect()] == ["e2"] and s.company_earnings("none").count() == 0
    assert [r.id for r in s.earnings_history("c1").collect()] == ["e1", "e2"]
    assert s.evidence_of("e1").count() == 1 and s.lineage().count() == 3
    assert s.audit_status().first().status == "PASS"
    assert ReadService(events, audits.limit(0), manifest, files, evidence).audit_status().first().status == "BLOCKED"
    assert {r.path: r.state for r in s.data_quality().collect()} == {"p": "MATCH", "q": "REVISION_CHANGED", "r": "MISSING"}
    assert s.publication_snapshot().first().events == 3


def test_landing(tmp_path):
    from urllib.error import HTTPError

    from quern.sources import landing

    (tmp_path / "src.txt").write_text("abc")
    url = f"file://{tmp_path}/src.txt"
    first = landing.land(url, f"{tmp_path}/out")
    assert first.changed and first.size_bytes == 3
    assert not landing.land(url, f"{tmp_path}/out", first.sha256).changed
    with pytest.raises(ValueError, match="not a ZIP"):
        landing.land(url, f"{tmp_path}/zip", archive=True)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["out", "src.txt"]

    def fails(code):
        def f():
            raise HTTPError("u", code, "", {}, None)
        return f

    assert landing.bulk_or_each(fails(403), lambda k: k + "!", ["a", "b"]) == ["a!", "b!"]
    with pytest.raises(HTTPError):
        landing.bulk_or_each(fails(500), str, ["a"])
    assert landing.safe_path(str(tmp_path), "out").endswith("out")
    with pytest.raises(ValueError):
        landing.safe_path(str(tmp_path), "../x")


def test_markdown_refuses_larger_tables(spark):
    assert len(sinks.markdown(spark.range(3), ["id"], limit=3).splitlines()) == 5
    with pytest.raises(ValueError):
        sinks.markdown(spark.range(4), ["id"], limit=3)
