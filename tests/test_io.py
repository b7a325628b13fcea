import json
import zipfile

from tarnloom.sources import readers, writers
from tarnloom.streaming import queue


def test_jsonl(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id":"x","v":1}\n\nnot json\n{"id":"x","v":2}\n')
    rows = readers.read_jsonl(spark, str(tmp_path / "*.jsonl"), "id string, v int").cache()
    assert rows.where("_corrupt is not null").count() == 1
    assert readers.first_of_files(rows.where("_corrupt is null"), "id").first()["v"] == 1


def test_tree(spark, tmp_path):
    for p in ("a", "raw"):
        (tmp_path / p).mkdir()
        (tmp_path / p / "x.json").write_text('{"id": 1}')
    assert readers.read_json_tree(spark, str(tmp_path), "id int").count() == 1


def test_envelopes(spark):
    one = lambda s: spark.createDataFrame([(s,)], "value string")
    assert [r["url"] for r in readers.load_records(one('[{"url":"u"}]')).collect()] == ["u"]
    assert [r["url"] for r in readers.load_records(one('{"records":[{"url":"v"}]}')).collect()] == ["v"]
    assert [(r["query"], r["title"]) for r in readers.search_cache(one('{"q":[{"title":"t"}],"z":3}')).collect()] == [("q", "t")]
    roles = json.dumps({"user_roles": [{"scenarios": [{"scenario": "a"}, {"scenario": "b"}]}, {"scenarios": [{"scenario": "c"}]}]})
    assert [r["category"] for r in readers.categories(one(roles), start=1, n=1).collect()] == ["b"]
    assert [r["category"] for r in readers.categories(one('{"domains":["d"]}')).collect()] == ["d"]


def test_office(spark, tmp_path):
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(tmp_path / "d.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>T</w:t></w:r></w:p><w:p><w:r><w:t>a &lt; b</w:t></w:r></w:p></w:body></w:document>')
    s = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "s.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {s}><sheets><sheet name="S"/></sheets></workbook>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {s}><sheetData><row><c r="B1"><v>1</v></c></row></sheetData></worksheet>')
    (tmp_path / "x.xlsx").write_bytes(b"broken")
    blocks = readers.office_blocks(spark.read.format("binaryFile").load(str(tmp_path))).cache()
    kinds = {(r["path"].rsplit("/", 1)[1], r["kind"]): r["cells"] for r in blocks.collect()}
    assert kinds[("d.docx", "heading1")] == ["T"] and kinds[("s.xlsx", "S")] == ["", "1"] and ("x.xlsx", "error") in kinds
    html = {r["path"].rsplit("/", 1)[1]: r["html"] for r in readers.blocks_to_html(blocks).collect()}
    assert html["d.docx"] == "<h1>T</h1><p>a &lt; b</p>"


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2")], "k string, v string")
    sink = writers.idempotent_batches(str(tmp_path / "o"), "k")
    sink(df, 0)
    sink(df, 0)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
    u = "6193cbbe-d3cb-4848-a797-000000000001"
    keys = spark.createDataFrame([(u,), (u,), ("bad",)], "k string")
    assert writers.new_keys(keys, keys.limit(0), "k").count() == 1 and writers.new_keys(keys, keys, "k").count() == 0


def test_job_events():
    f = queue.apply_job_events
    assert f(None, [("add", 0), ("take", 1), ("done", 30)])[0][0] == "completed"
    assert f(None, [("take", 1), ("take", 100)])[0] == ("active", 100, 1)
    assert f(("active", 0.0, 9), [("tick", 61.5)])[0][0] == "failed" and f(("active", 0.0, 8), [("tick", 61.5)])[0] == ("queued", 0.0, 9)
    assert f(None, [("take", 1), ("renew", 50), ("done", 100)])[0][0] == "completed"


def _run(spark, tmp_path, stream, name, mode):
    q = stream.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start()
    q.processAllAvailable()
    q.stop()
    return spark.sql(f"select * from {name}")


def test_streams(spark, tmp_path, sf):
    src = tmp_path / "in"
    spark.read.parquet(f"{sf}/events.parquet").repartition(2).write.parquet(str(src))
    read = lambda: spark.readStream.schema(spark.read.parquet(str(src)).schema).parquet(str(src))
    users = spark.read.parquet(str(src)).select("user_id").distinct().count()
    assert _run(spark, tmp_path, queue.running_frequency(read(), "user_id"), "freq", "complete").count() == users
    once = _run(spark, tmp_path, queue.visited_once(read(), "user_id", "365 days"), "once", "append")
    assert once.count() == users
    assert _run(spark, tmp_path, queue.window_counts(read(), "user_id", "1 hour"), "win", "update").count() > 0
    assert _run(spark, tmp_path, queue.sessions(read(), "user_id", "6 hours"), "sess", "append").columns == ["user_id", "start", "end", "n"]


def test_stateful_streams(spark, tmp_path):
    src = tmp_path / "log"
    rows = [("a", "add", "2024-01-01 00:00:00"), ("a", "take", "2024-01-01 00:00:01"), ("a", "done", "2024-01-01 00:00:09"), ("b", "take", "2024-01-01 00:00:00"), ("b", "take", "2024-01-01 00:05:00")]
    spark.createDataFrame(rows, "job_id string, kind string, ts string").selectExpr("job_id", "kind", "to_timestamp(ts) ts").write.parquet(str(src))
    stream = spark.readStream.schema("job_id string, kind string, ts timestamp").parquet(str(src))
    got = {r["job_id"]: (r["status"], r["stalls"]) for r in _run(spark, tmp_path, queue.job_states(stream), "jobs", "update").collect()}
    assert got["a"] == ("completed", 0) and got["b"][1] >= 1
    limited = queue.admitted(stream.selectExpr("job_id key", "ts"), 2, 60)
    allowed = _run(spark, tmp_path, limited, "adm", "append").groupBy("key").count().collect()
    assert {r["key"]: r["count"] for r in allowed} == {"a": 3, "b": 2}
