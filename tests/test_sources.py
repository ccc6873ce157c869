"""Sources, sinks and streams on temporary folders."""

import hashlib
import json
import struct
import zlib
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tessera.operators import telemetry
from tessera.sources import files
from tessera.streaming import telemetry as live

DATA = "/root/testdata/sf0.001"


def test_labels_and_malformed_lines(spark, tmp_path):
    good = {"roi_id": "r", "dataset_id": "d", "hand_presence": {"present": True}, "landmarks_crop_norm": []}
    (tmp_path / "a.jsonl").write_text(json.dumps(good) + "\nnot json\n[1]\n")
    rows, bad = files.read_labels(spark, str(tmp_path / "a.jsonl"))
    assert rows.count() == 1 and rows.first().hand_presence.present and bad.count() == 2


def test_line_numbers(spark, tmp_path):
    (tmp_path / "a.txt").write_text("x\ny\n\nz\n")
    (tmp_path / "b.txt").write_text("q\n")
    rows = files.read_text_with_line_no(spark, str(tmp_path / "*.txt"))
    assert sorted((r.file.rpartition("/")[2], r.line_no, r.line) for r in rows.collect()) == [("a.txt", 1, "x"), ("a.txt", 2, "y"), ("a.txt", 3, ""), ("a.txt", 4, "z"), ("b.txt", 1, "q")]


def test_manifests_sources_and_releases(spark, tmp_path):
    manifest = {"schema_version": "1", "dataset_id": "d", "scope": "main", "capture_sources": [{"capture_source_id": "c", "split": "train", "published_variants": [{"proposal_variant": "v1", "published_labels": 1, "labels_relpath": "l.jsonl"}, {"proposal_variant": "v2", "published_labels": 1, "labels_relpath": "none.jsonl"}]}]}
    (tmp_path / "m.json").write_text(json.dumps(manifest, indent=1))
    (tmp_path / "l.jsonl").write_text(json.dumps({"roi_id": "r", "dataset_id": "d", "capture_source_id": "c", "proposal_variant": "v1"}) + "\n")
    catalog = files.read_manifests(spark, str(tmp_path / "m.json"))
    assert catalog.count() == 2
    rows = files.read_listed_rows(spark, catalog, str(tmp_path), variant="v1", split="train")  # the file of v2 is not there and not opened
    assert [r.roi_id for r in rows.collect()] == ["r"] and files.read_listed_rows(spark, catalog, str(tmp_path), variant="v9").count() == 0
    releases = spark.createDataFrame([("a", 1), ("b", 5)], "release_id string, records int")
    kept, wrong = files.read_releases(spark, releases, spark.createDataFrame([("a", "x"), ("z", "y")], "release_id string, roi_id string"), {"sample_type": "NEG"})
    assert kept.first().sample_type == "NEG" and kept.count() == 1 and [r.release_id for r in wrong.collect()] == ["b"]


def test_source_rows_are_pruned(spark, tmp_path):
    rows = spark.createDataFrame([(f"r{i}", f"d{i % 3}", f"c{i % 2}", f"v{i % 2}", "train" if i % 5 else "val") for i in range(60)], "roi_id string, dataset_id string, capture_source_id string, proposal_variant string, split string")
    folders = ["dataset_id", "proposal_variant", "split"]
    rows.write.partitionBy(*folders).json(str(tmp_path / "labels"))
    catalog = rows.drop("roi_id").distinct().withColumn("scope", F.when(F.col("dataset_id") == "d2", "private").otherwise("public"))
    got = files.read_source_rows(spark, catalog, str(tmp_path / "labels"), "roi_id string, capture_source_id string, dataset_id string, proposal_variant string, split string", scope="public", split="train", captures=["c1"])
    assert {r.roi_id for r in got.collect()} == {f"r{i}" for i in range(60) if i % 3 < 2 and i % 5 and i % 2}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "split" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_image_heads_are_read_in_part(spark, tmp_path):
    head = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sIIBBBBB", 13, b"IHDR", 300, 200, 8, 6, 0, 0, 0)
    with open(tmp_path / "large.png", "wb") as f:
        f.write(head)
        f.truncate(3 << 30)  # more than a row can hold
    (tmp_path / "short.png").write_bytes(head[:20])
    sizes = {r.path.rpartition("/")[2]: (r.width, r.height, r.channels, r.problem) for r in files.image_size_audit(spark, str(tmp_path)).collect()}
    assert sizes == {"large.png": (300, 200, 4, None), "short.png": (None, None, None, "not_png")}


def test_inventory_digests_and_images(spark, tmp_path):
    head = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sIIBBBBB", 13, b"IHDR", 30, 20, 8, 2, 0, 0, 0)
    (tmp_path / "a.png").write_bytes(head + struct.pack(">I", zlib.crc32(head[12:])))
    (tmp_path / "A.PNG").write_bytes(b"no image")
    found = files.file_inventory(spark, str(tmp_path))
    assert found.count() == 2 and found.first().n_same_path == 2
    sizes = {r.path.rpartition("/")[2]: (r.width, r.height, r.channels, r.problem) for r in files.image_size_audit(spark, str(tmp_path)).collect()}
    assert sizes == {"a.png": (30, 20, 3, None), "A.PNG": (None, None, None, "not_png")}
    assert {r.digest for r in files.content_digest(spark, str(tmp_path)).collect()} == {hashlib.sha256(f.read_bytes()).hexdigest() for f in tmp_path.iterdir()}


def test_registry_detections_and_sinks(spark, tmp_path):
    spark.createDataFrame([("n", "published")], "id string, status string").write.parquet(str(tmp_path / "selections.parquet"))
    assert files.read_registry(spark, str(tmp_path), "selections").first().status == "published"
    with pytest.raises(ValueError):
        files.read_registry(spark, str(tmp_path), "other")
    (tmp_path / "d.json").write_text('{"image": "i", "detections": [{"score": 0.5, "box": [1.0], "hand_flag_score": 0.7}]}\n{"image": "j", "detections": []}\n')
    assert sorted((r.image, r.position, r.score) for r in files.read_detections(spark, str(tmp_path / "d.json")).collect()) == [("i", 0, 0.5), ("j", None, None)]
    rows = spark.createDataFrame([("a", "train"), ("b", "val")], "id string, split string")
    report = files.write_snapshot(rows, str(tmp_path / "snap"))
    assert dict(report.collect()) == {"train": 1, "val": 1}
    with pytest.raises(Exception, match="already exists"):
        files.write_snapshot(rows, str(tmp_path / "snap"))


def test_live_windows_equal_batch_windows(spark, tmp_path):
    rows = [(run, i, 1.0, 0.5, *[0.125] * 10, 0.0, 1.0, 5.0 + (i * run) % 7, 4.0) for run in (1, 2) for i in range(25)]
    table = spark.createDataFrame(rows, files.FRAME_SCHEMA)
    for k, part in enumerate((table.where("frame_index < 8"), table.where("frame_index between 8 and 17 and frame_index <> 9"), table.where("frame_index = 9 or frame_index > 17"))):
        part.coalesce(1).write.json(str(tmp_path / f"in{k}"))
    (tmp_path / "in").mkdir()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    frames = files.frame_stream(spark, str(tmp_path / "in"))
    run = live.frame_windows_stream(frames, 10).writeStream.format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        for k in range(3):
            for f in (tmp_path / f"in{k}").glob("*.json"):
                f.rename(tmp_path / "in" / f"{k}-{f.name}")
            run.processAllAvailable()
    finally:
        run.stop()
    batch = telemetry.frame_windows(table, 10)
    got = spark.table("windows")
    names = [c for c in got.columns if c in batch.columns]
    near = lambda df: sorted(tuple(round(v, 9) for v in r) for r in df.select(names).collect())
    assert near(got) == near(batch) and got.count() == 4 and {"fps_avg", "fps_p95"} <= set(names)


def test_a_missing_frame_does_not_stop_a_run(spark, tmp_path):
    rows = [(1, i, 1.0, 0.5, *[0.125] * 10, 0.0, 1.0, 5.0 + i % 7, 4.0) for i in range(60)]
    table = spark.createDataFrame(rows, files.FRAME_SCHEMA).where("frame_index <> 13")
    late = spark.createDataFrame([rows[13]], files.FRAME_SCHEMA)
    parts = [table.where("frame_index < 30 and frame_index <> 5"), table.where("frame_index = 5 or frame_index between 30 and 44"), table.where("frame_index >= 45"), late.unionByName(table.where("frame_index in (31, 59)"))]
    for k, part in enumerate(parts):
        part.coalesce(1).write.json(str(tmp_path / f"in{k}"))
    (tmp_path / "in").mkdir()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    frames, runs = files.frame_stream(spark, str(tmp_path / "in")), []
    try:
        for name, stream in (("gap_windows", live.frame_windows_stream(frames, 10, 2)), ("gap_violations", live.frame_violations_stream(frames, 10, 2))):
            runs.append(stream.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).start())
        for k in range(len(parts)):
            for f in (tmp_path / f"in{k}").glob("*.json"):
                f.rename(tmp_path / "in" / f"{k}-{f.name}")
            for run in runs:
                run.processAllAvailable()
    finally:
        for run in runs:
            run.stop()
    batch = telemetry.frame_windows(table, 10)
    got = spark.table("gap_windows")
    names = [c for c in got.columns if c in batch.columns]
    near = lambda df: sorted(tuple(round(v, 9) for v in r) for r in df.select(names).collect())
    assert near(got) == near(batch) and sorted(r.window for r in got.collect()) == [0, 2, 3, 4, 5]
    bad = [(r.problem, r.frame_index) for r in spark.table("gap_violations").collect()]
    assert sorted(bad) == [("incomplete", i) for i in range(10, 20) if i != 13] + [("late", i) for i in (13, 31, 59)]


class Messages:
    """A state that counts what is asked of it."""

    def __init__(self):
        self.asked, self.value = 0, None

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked, self.value = self.asked + 1, value


def test_a_run_asks_its_state_twice():
    def frame(i):
        return Row(run_id=1, frame_index=i, timings=[float(i), None, *[0.5] * (len(telemetry.TIMINGS) - 2)])

    state, windows = Messages(), live.FrameWindows(4, 1)
    windows.init(state)
    first = list(windows.handleInputRows((1,), iter([frame(i) for i in (0, 1, 2, 4, 5, 5)]), None))
    assert state.asked == 2 and [(r.problem, r.frame_index) for r in first] == [("repeated", 5)]
    full = list(windows.handleInputRows((1,), iter([frame(i) for i in (7, 6, 3)]), None))
    assert state.asked == 4 and [(r.window, r.frames, r.frame_index, r.stats[:8]) for r in full] == [(0, 4, 3, [1.5, 1.0, 3.0, 3.0] + [None] * 4), (1, 4, 7, [5.5, 5.0, 7.0, 7.0] + [None] * 4)]
    again = list(windows.handleInputRows((1,), iter([frame(0), frame(8), frame(12)]), None))
    assert [(r.problem, r.frame_index) for r in again] == [("late", 0)] and state.value[0] == 1 and state.value[2] == [8, 12]


def test_live_log_metrics(spark, tmp_path):
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "a.log").write_text("[PERF][stage_ms] a=1\n[PERF][summary] frame=9\n00:01 [PERF][stage_ms] a=2 a=3 b=x\n[PERF][stage_ms] c=4\n")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    run = live.perf_log_stream(files.line_stream(spark, str(tmp_path / "logs"))).writeStream.format("memory").queryName("log").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    assert sorted((r.window, r.metric, r.value) for r in spark.table("log").collect()) == [(0, "stage_ms.a", 1.0), (1, "stage_ms.a", 3.0), (1, "stage_ms.c", 4.0), (1, "summary.frame", 9.0)]
    assert sorted((r.window, r.metric, r.value) for r in live.latest_sections(spark.table("log")).collect()) == [(1, "stage_ms.c", 4.0), (1, "summary.frame", 9.0)]


def test_collected_logs_hold_many_runs(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "a.log").write_text("1\t[PERF][stage_ms] a=1\n2\t[PERF][summary] frame=9\n1\t[PERF][summary] frame=8\n2\t00:01 [PERF][stage_ms] a=2\n1\t[PERF][stage_ms] a=3\n[PERF][summary] frame=7\n2\t[PERF][stage_ms] a=5 b=x\n")
    (logs / "b.log").write_text("1\t[PERF][stage_ms] a=4\n")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    run = live.perf_log_stream(files.line_stream(spark, str(logs), collected=True)).writeStream.format("memory").queryName("collected").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    name = lambda file: file.rpartition("/")[2]
    assert sorted((name(r.file), r.run, r.window, r.metric, r.value) for r in spark.table("collected").collect()) == [
        ("a.log", "", 1, "summary.frame", 7.0), ("a.log", "1", 0, "stage_ms.a", 1.0), ("a.log", "1", 1, "stage_ms.a", 3.0), ("a.log", "1", 1, "summary.frame", 8.0),
        ("a.log", "2", 1, "stage_ms.a", 2.0), ("a.log", "2", 1, "stage_ms.a", 5.0), ("a.log", "2", 1, "summary.frame", 9.0), ("b.log", "1", 0, "stage_ms.a", 4.0),
    ]
    parsed = telemetry.parse_lines(files.read_perf_log(spark, str(logs), collected=True))
    batch = sorted((name(r.run_id), r.window, r.metric, r.value) for r in telemetry.log_metrics(parsed).collect())
    assert batch == sorted((f"{name(r.file)}#{r.run}", r.window, r.metric, r.value) for r in live.latest_sections(spark.table("collected")).collect())
    assert sorted(name(r.run_id) for r in telemetry.orphans(parsed).collect()) == ["a.log#1", "b.log#1"]


def test_a_log_file_asks_its_state_twice_for_all_its_runs():
    def lines(*rows):
        return iter([pd.DataFrame(rows, columns=["run", "line_no", "line"])])

    state, log = Messages(), live.LogMetrics()
    log.init(state)
    rows = [(str(k % 50), k, f"[PERF][summary] frame={k}") for k in range(100)]
    first = pd.concat(log.handleInputRows(("f",), lines(*reversed(rows)), None))
    assert state.asked == 2 and list(zip(first.run, first.window, first.value)) == [(str(k % 50), k // 50 + 1, float(k)) for k in range(100)]
    again = pd.concat(log.handleInputRows(("f",), lines(("7", 100, "[PERF][stage_ms] a=1"), ("x", 101, "[PERF][stage_ms] a=2")), None))
    assert state.asked == 4 and list(zip(again.run, again.window, again.value)) == [("7", 2, 1.0), ("x", 0, 2.0)]


@pytest.mark.parametrize("name", ["live_log_metrics", "perf_log_files"])
def test_log_files_are_fewer_than_runs(spark, tmp_path, monkeypatch, name):
    import __spark_entry__ as entry
    from tessera.plans import reports

    rows = spark.range(40 * 21).selectExpr("id event_id", "timestamp_seconds(id) ts", "id % 40 user_id", "'click' event_type", "id % 7 / 3 value")
    rows.write.parquet(str(tmp_path / "events.parquet"))
    folders, folder = [], reports._folder
    monkeypatch.setattr(reports, "_folder", lambda *a: folders.append(folder(*a)) or folders[-1])
    got = {r.metric: r.n for r in entry.queries()[name](spark, str(tmp_path)).collect()}
    assert {got.pop("orphans", 20)} == {20} and set(got.values()) == {40} and len(got) == 6
    written = list(Path(folders[0]).rglob("part-*"))
    assert 0 < len(written) <= 8
    named = {line.partition("\t")[0] for f in written for line in f.read_text().splitlines()}
    assert named == {str(k) for k in range(40)}


def test_mining_rounds_as_micro_batches(spark, tmp_path):
    schema = "roi_id string, difficulty double, error_px double"
    ledger = str(tmp_path / "ledger")
    spark.createDataFrame([], schema + ", round_id int").write.parquet(ledger)
    (tmp_path / "in").mkdir()
    stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    read = lambda: spark.read.schema(schema + ", round_id int").parquet(ledger)
    run = live.mining_rounds(stream, ledger, 2, str(tmp_path / "cp"), read)
    try:
        for batch in ([("a", 0.9), ("b", 0.8), ("c", 0.1)], [("a", 0.9), ("d", 0.05), ("e", 0.01)]):
            (tmp_path / "in" / f"{len(batch)}{batch[1][0]}.json").write_text("".join(json.dumps({"roi_id": i, "difficulty": d, "error_px": 1.0}) + "\n" for i, d in batch))
            run.processAllAvailable()
    finally:
        run.stop()
    assert sorted((r.round_id, r.roi_id) for r in read().collect()) == [(0, "a"), (0, "b"), (1, "c"), (1, "d")]
    # what a round took has left the pool
    waiting = spark.read.schema(schema).parquet(f"{ledger}-pool/version=1").collect()
    assert sorted(r.roi_id for r in waiting) == ["c", "d", "e"]


def test_queries_without_the_text_subpackage():
    import __spark_entry__ as entry

    found = entry.queries()
    assert "eval_grouped" in found and set(entry.oracle_sql()) <= set(found)


@pytest.mark.parametrize("name", ["row_contract", "source_tree_fingerprints"])
def test_query_equals_its_sql(spark, name):
    import __spark_entry__ as entry

    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("embeddings", "documents"):
        con.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    want = con.execute(entry.oracle_sql()[name])
    names = [c[0] for c in want.description]
    got = entry.queries()[name](spark, DATA)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(tuple, got.select(names).collect())) == sorted(want.fetchall())
