import glob
import json

import pytest
from pyspark.sql import functions as F

from stormgrid.functions import geo
from stormgrid.functions.sql import register
from stormgrid.operators import rows
from stormgrid.sinks import files, tables
from stormgrid.sources import tables as named


def lines(path):
    return [ln.rstrip("\n") for f in sorted(glob.glob(f"{path}/part-*")) for ln in open(f)]


def test_append_counts_and_replace(spark, tmp_path):
    p = str(tmp_path / "t")
    assert tables.append_counted(spark.range(7), p) == 7
    assert tables.append_counted(spark.range(5).where("id > 9"), p) == 0
    assert spark.read.parquet(p).count() == 7
    tables.replace(spark.range(2), p)
    assert spark.read.parquet(p).count() == 2


def test_publish_keeps_columns_and_casts(spark, tmp_path):
    p = str(tmp_path / "t")
    tables.publish(spark.sql("select 1 id, timestamp_ntz'2024-01-01 00:00:00' start_time, 'a' note"), p)
    out = tables.publish(spark.sql("select 2L id, '2024-02-01 00:00:00' start_time, 5 extra"), p)
    assert out.dtypes == [("id", "int"), ("start_time", "timestamp_ntz"), ("note", "string"), ("extra", "int")]
    r = out.collect()
    assert len(r) == 1 and (r[0].id, r[0].note, r[0].extra) == (2, None, 5) and r[0].start_time.month == 2


def test_publish_replaces_only_touched_partitions(spark, tmp_path):
    p = str(tmp_path / "t")
    tables.publish(spark.sql("select * from values (1, 'GA'), (2, 'KY') t(id, state)"), p, ["state"])
    tables.publish(spark.sql("select 9 id, 'KY' state"), p, ["state"])
    assert sorted((r.id, r.state) for r in spark.read.parquet(p).collect()) == [(1, "GA"), (9, "KY")]


def test_upsert_twice_is_once(spark, tmp_path):
    p = str(tmp_path / "t")
    at = lambda s: F.lit(s).cast("timestamp_ntz")
    first = spark.sql("select * from values ('a', 1, 1, 'GA'), ('b', 2, 1, 'GA'), ('b', 3, 2, 'GA'), ('z', 0, 1, 'KY') t(k, v, seq, state)")
    tables.upsert_into(p, first, ["k"], F.col("seq"), at("2024-01-01"), part="state")
    new = spark.sql("select * from values ('b', cast(null as int), 5, 'GA'), ('c', 7, 1, 'GA') t(k, v, seq, state)")
    for _ in range(2):
        tables.upsert_into(p, new, ["k"], F.col("seq"), at("2024-03-01"), part="state")
    got = {r.k: (r.v, r.created_at.month, r.updated_at.month) for r in spark.read.parquet(p).collect()}
    assert got == {"a": (1, 1, 1), "b": (None, 1, 3), "c": (7, 3, 3), "z": (0, 1, 1)}


def test_insert_absent_is_null_safe(spark, tmp_path):
    p = str(tmp_path / "t")
    new = spark.sql("select * from values ('p', 'e', null, 1), ('p', 'e', null, 2), ('p', null, '5', 3) t(pid, email, phone, n)")
    keys = ["pid", "email", "phone"]
    assert tables.insert_absent(p, new, keys, F.col("n")) == 2
    assert tables.insert_absent(p, new, keys, F.col("n")) == 0
    assert {r.n for r in spark.read.parquet(p).collect()} == {1, 3}


def test_runs_export_update_and_log(spark, tmp_path):
    out, runs, log = (str(tmp_path / n) for n in ("x.csv", "runs", "log"))
    targets = spark.sql("select 1 id, array('a') tags, named_struct('k', 2) s, '' blank")
    files.export_targets(targets, out, runs, {"run_id": 3, "state": "KY", "created_at": "2024-01-01 00:00:00"})
    head, row = lines(out)
    assert head == "id,tags,s,blank" and '[\\"a\\"]' in row and '{\\"k\\":2}' in row
    up = lambda job: spark.createDataFrame([(3, job, "w", None)], "run_id long, batch_job_id string, webhook_url string, api_base string")
    tables.update_runs(runs, up("J1"), F.lit("2024-01-02").cast("timestamp_ntz"))
    tables.update_runs(runs, up(""), F.lit("2024-01-05").cast("timestamp_ntz"))
    r = spark.read.parquet(runs).first()
    assert (r.batch_job_id, r.webhook_url, r.submitted_at.day, r.output_path) == ("J1", "w", 2, out)
    tables.log_step(spark, log, "2024-01-01 00:00:00", "KY", "cluster", "ok", "x" * 3000)
    assert len(spark.read.parquet(log).first().note) == 2000


def test_csv_header_without_rows(spark, tmp_path):
    p = str(tmp_path / "e.csv")
    files.write_csv(spark.range(0).select("id", F.lit("x").alias("b")), p, at_most=5)
    assert lines(p) == ["id,b"]
    q = str(tmp_path / "f.csv")
    with pytest.raises(ValueError):
        files.write_csv(spark.range(9), str(tmp_path / "more"), at_most=5)
    files.write_csv(spark.sql("select 1 id, 'x' b").where("id > 5").orderBy("id").limit(3), q, at_most=5)
    assert lines(q) == ["id,b"]


def test_feature_lines(spark, tmp_path):
    p = str(tmp_path / "f")
    files.write_features(spark.sql("select 5 id, 1D lon, 2D lat"), p, geo.geojson_point("lon", "lat"), ["id"])
    assert [json.loads(x) for x in lines(p)] == [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [1.0, 2.0]}, "properties": {"id": 5}}]


def test_batches_number_across_partitions(spark):
    df = spark.range(0, 1003).repartition(7).select("id", (F.col("id") * 2).alias("v"))
    got = rows.batches(df, ["id"], 50, F.struct("v")).orderBy("batch_id").collect()
    assert [b.num_rows for b in got] == [50] * 20 + [3]
    assert [e.v for b in got for e in b.entries] == [2 * i for i in range(1003)]


def test_named_tables_and_sql_functions(spark):
    spark.range(4).createOrReplaceTempView("tt_a")
    assert named.existing(spark, ["tt_a", "tt_zz", "tt_a"]) == ["tt_a"]
    assert named.scan(spark, "tt_a", ["id"], "id > 1").count() == 2
    with pytest.raises(LookupError):
        named.run_row(spark.range(3).withColumnRenamed("id", "run_id"), 8)
    assert "sg_contains" in register(spark)
    sq = "array(named_struct('x', 0D, 'y', 0D), named_struct('x', 2D, 'y', 0D), named_struct('x', 2D, 'y', 2D), named_struct('x', 0D, 'y', 2D), named_struct('x', 0D, 'y', 0D))"
    r = spark.sql(f"select sg_contains({sq}, 1, 1) a, sg_contains({sq}, 2, 1) b, sg_intersects({sq}, 2, 1) c, sg_area({sq}) d, "
                  "sg_title(\"o'brien mc-donald 3rd\") e, sg_color(7) f, sg_in_buffer(1, 0, 0, 0, 1) g, sg_in_envelope(1, 1, 0, 0, 1, 1) h").first()
    assert tuple(r)[:5] == (True, False, True, 4.0, "O'Brien Mc-Donald 3Rd") and r.f == "#%06x" % ((7 * 2654435761) & 0xFFFFFF) and r.g and r.h


def test_traces_of_finished_jobs_once(spark, tmp_path):
    events = spark.createDataFrame([("1", "running", "{}", "2024-01-01 00:00:00"), ("1", "complete", "{}", "2024-01-01 00:01:00"),
                                    ("1", "complete", "{}", "2024-01-01 00:02:00"), ("2", "running", "{}", "2024-01-01 00:00:00")],
                                   "job_id string, status string, payload string, at string").selectExpr(
        "job_id", "status", "payload", "cast(at as timestamp_ntz) as received_at")
    jobs = spark.createDataFrame([("1", 10), ("1", 11), ("2", 12)], "job_id string, address_id long")
    path = str(tmp_path / "traces")
    assert tables.store_traces(events, jobs, path) == 2 and tables.store_traces(events, jobs, path) == 0
    assert sorted((r.address_id, r.status, str(r.completed_at)) for r in spark.read.parquet(path).collect()) == [
        (10, "complete", "2024-01-01 00:01:00"), (11, "complete", "2024-01-01 00:01:00")]


def test_upsert_keeps_new_columns(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c", 7, 1), (3, "d", 8, 1)], "k long, v string, w long, ver long")
    got = rows.upsert(old, new, ["k"], F.col("ver")).collect()
    assert sorted((r.k, r.v, r.w) for r in got) == [(1, "a", None), (2, "c", 7), (3, "d", 8)]
