import json
import os

from pyspark.sql import functions as F

from stormgrid.streaming import intake, jobs

BODIES = [
    ("2024-01-01 00:00:00", '{"jobId": 1, "status": "running", "event": "start"}'),
    ("2024-01-01 00:00:10", '{"job_id": "2", "status": {"text": "", "state": "queued"}}'),
    ("2024-01-01 00:01:00", '{"data": {"id": 1, "status": "complete"}}'),
    ("2024-01-01 00:02:00", '{"id": "", "data": {"jobId": 3}, "status": 5, "type": 7, "action": "x"}'),
    ("2024-01-01 00:03:00", "not json"),
    ("2024-01-01 00:20:00", '{"jobId": 4, "status": "complete"}'),
]


def land(folder, split):
    folder.mkdir()
    for i in range(0, len(BODIES), split):
        with open(folder / f"f{i:03d}.txt", "w") as f:
            for t, b in BODIES[i:i + split]:
                f.write(json.dumps({"received_at": t, "headers": {"h": "v"}, "body": b}) + "\n")
        os.utime(folder / f"f{i:03d}.txt", (1_700_000_000 + i, 1_700_000_000 + i))    # arrival order
    return str(folder)


def test_intake_once_per_file_and_fallback(spark, tmp_path):
    src = land(tmp_path / "in", 2)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for _ in range(2):      # the second run finds nothing new
        intake.store_events(intake.parsed_events(intake.read_events(spark, src)), out, ck).awaitTermination()
    got = spark.read.parquet(out).orderBy("received_at").collect()
    assert [r.job_id for r in got] == ["1", "2", "1", "3", None, "4"]
    assert [r.status for r in got] == ["running", "queued", "complete", "5", None, "complete"]
    assert [r.event_type for r in got] == ["start", None, None, "x", None, None]
    assert json.loads(got[4].payload) == {"raw": "not json"} and got[0].headers == {"h": "v"}


def test_latest_status_does_not_depend_on_batches(spark, tmp_path):
    seen = []
    for split, per in ((6, None), (1, 1)):
        src = land(tmp_path / f"in{split}", split)
        out = str(tmp_path / f"st{split}")
        intake.keep_latest_status(intake.parsed_events(intake.read_events(spark, src, per)), out,
                                  str(tmp_path / f"ck{split}")).awaitTermination()
        seen.append({r.job_id: r.status for r in intake.current_status(spark, out).collect()})
    assert seen[0] == seen[1] == {"1": "complete", "2": "queued", "3": "5", "4": "complete"}


def test_overdue_stream_matches_batch(spark, tmp_path):
    src = land(tmp_path / "in", 1)
    ev = intake.parsed_events(intake.read_events(spark, src, 1))
    q = (intake.overdue_stream(ev).writeStream.format("memory").queryName("late")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    late = {r.job_id for r in spark.table("late").collect()}
    rows = spark.createDataFrame(BODIES, "received_at string, body string").withColumn("received_at", F.col("received_at").cast("timestamp_ntz"))
    batch = {r.job_id for r in jobs.overdue(jobs.parse_events(rows), "2024-01-01 00:19:00").collect()}
    assert late == batch == {"2", "3"}


def test_repeats_dropped(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    rec = json.dumps({"received_at": "2024-01-01 00:00:00", "headers": {}, "body": "{}"})
    (src / "a.txt").write_text(rec + "\n" + rec + "\n")
    out = str(tmp_path / "o")
    intake.store_events(intake.without_repeats(intake.parsed_events(intake.read_events(spark, str(src)))), out,
                        str(tmp_path / "c")).awaitTermination()
    assert spark.read.parquet(out).count() == 1


def test_address_files_once(spark, tmp_path):
    src = tmp_path / "in" / "deep"
    src.mkdir(parents=True)
    feat = '{"type":"Feature","properties":{"number":"1","street":" Oak "},"geometry":{"type":"Point","coordinates":[1,2]}}'
    (src / "a.geojson").write_text(feat + "\nbroken\n")
    (src / "b.txt").write_text(feat + "\n")
    run = lambda: intake.ingest_addresses(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    run()
    (src / "c.json").write_text(feat.replace('"1"', '"2"') + "\n")
    run()
    run()
    got = spark.read.parquet(str(tmp_path / "t")).collect()
    assert sorted(r.address for r in got) == ["1 Oak", "2 Oak"]


def test_overdue_with_late_and_repeated_events(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    at = lambda m, s=0: f"2024-01-01 00:{m:02d}:{s:02d}"
    landed = [[(at(1), '{"jobId": 1, "status": "complete"}'), (at(0), '{"jobId": 2, "status": "running"}')],
              [(at(0), '{"jobId": 1, "status": "running"}')],           # older than what ended the job
              [(at(10), '{"jobId": 9, "status": "complete"}')],
              [(at(20), '{"jobId": 2, "status": "running"}')],          # again after the report
              [(at(40), '{"jobId": 9, "status": "complete"}')], [(at(50), '{"jobId": 9, "status": "complete"}')]]
    for i, part in enumerate(landed):
        f = src / f"{i}.txt"
        f.write_text("".join(json.dumps({"received_at": t, "headers": {}, "body": b}) + "\n" for t, b in part))
        os.utime(f, (1000 + i, 1000 + i))
    ev = intake.parsed_events(intake.read_events(spark, str(src), 1))
    q = (intake.overdue_stream(ev).writeStream.format("memory").queryName("shuffled")
         .outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).start())
    q.processAllAvailable()
    q.stop()
    assert [r.job_id for r in spark.table("shuffled").collect()] == ["2"]


def test_whole_documents_and_import_log(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    feat = '{"type":"Feature","properties":{"number":"%s","street":"Oak"},"geometry":{"type":"Point","coordinates":[1,2]}}'
    (src / "A.GEOJSON").write_text('{"type": "FeatureCollection",\n "features": [\n' + ",\n".join(feat % n for n in "12") + "\n]}")
    (src / "b.Json").write_text(feat % 3 + "\n")
    (src / "bad.json").write_text("{not json\n")
    intake.ingest_addresses(spark, str(src), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    assert sorted(r.address for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["1 Oak", "2 Oak", "3 Oak"]
    (src / "c.json").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {}, "geometry": null},\n'
                                + feat % 4 + ",\n" + feat % 5 + "]}\n")                       # a line of it is a feature
    intake.ingest_addresses(spark, str(src), str(tmp_path / "t"), str(tmp_path / "c")).awaitTermination()
    log = {r.file_path.rsplit("/", 1)[1]: (r.num_features, r.num_rows) for r in spark.read.parquet(str(tmp_path / "t_log")).collect()}
    assert log == {"A.GEOJSON": (2, 2), "b.Json": (1, 1), "bad.json": (0, 0), "c.json": (3, 2)}
