"""Idempotent loads, JSON batch/stream ingest, replay from a fresh checkpoint, console sink."""

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.operators.load import append_new
from strata.session import local_path, scratch_path
from strata.sources import feeds
from strata.streaming import ingest


def test_load_twice_adds_nothing_and_keys_continue(spark):
    path = scratch_path(spark, "t_load")
    a = spark.createDataFrame([("x", 1), ("y", 2), ("y", 2)], "k string, v int")
    assert append_new(a, path, ["k"], key_name="sk") == 2
    assert append_new(a, path, ["k"], key_name="sk") == 0
    b = spark.createDataFrame([("z", 3), ("x", 1)], "k string, v int")
    assert append_new(b, path, ["k"], key_name="sk") == 1
    got = sorted((r.k, r.sk) for r in spark.read.parquet(path).collect())
    assert got == [("x", 1), ("y", 2), ("z", 3)]


def _write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _event(i, t="2024-01-01T00:00:00+00:00"):
    return json.dumps({"event_id": f"e{i}", "user_id": "u1", "session_id": "s1", "event_time": t,
                       "event_type": "page_view", "product_id": "p1", "category": "c", "device": "mobile",
                       "country": "DE", "price": 1.5, "quantity": None})


def test_batch_json_stamps_and_malformed_line(spark):
    landing = scratch_path(spark, "t_land")
    _write_lines(local_path(landing), "a.json", [_event(1), "{not json", _event(2)])
    df = feeds.stamp(feeds.read_json(spark, landing))
    rows = df.collect()
    assert len(rows) == 3
    assert sum(r.event_id is None for r in rows) == 1  # malformed -> all-null row
    assert all(r.ingestion_ts is not None and r.ip_file_name.endswith("a.json") for r in rows)


def test_stream_ingest_and_idempotent_replay(spark):
    landing = scratch_path(spark, "t_sland")
    _write_lines(local_path(landing), "a.json", [_event(i) for i in range(5)])
    _write_lines(local_path(landing), "b.json", [_event(i) for i in range(3, 8)])  # 3,4 repeated
    bronze = ingest.ingest_stream(spark, landing, scratch_path(spark, "t_sbronze"), scratch_path(spark, "t_ck"))
    assert bronze.count() == 10
    assert bronze.filter(F.col("ingestion_ts").isNull()).count() == 0
    target = scratch_path(spark, "t_idem")
    ingest.replay_stream(spark, landing, target, scratch_path(spark, "t_ck1"), ["event_id"])
    ingest.replay_stream(spark, landing, target, scratch_path(spark, "t_ck2"), ["event_id"])
    assert spark.read.parquet(target).count() == 8


def test_kept_checkpoint_processes_only_new_files(spark):
    landing, out, ck = scratch_path(spark, "t_l2"), scratch_path(spark, "t_o2"), scratch_path(spark, "t_c2")
    _write_lines(local_path(landing), "a.json", [_event(1)])
    ingest.ingest_stream(spark, landing, out, ck)
    _write_lines(local_path(landing), "b.json", [_event(2)])
    assert ingest.ingest_stream(spark, landing, out, ck).count() == 2


def test_console_sink_runs(spark):
    landing = scratch_path(spark, "t_l3")
    _write_lines(local_path(landing), "a.json", [_event(1)])
    q = ingest.console_preview(ingest.read_stream(spark, landing), scratch_path(spark, "t_c3"))
    ingest.run_to_completion(q, 120)


def test_feed_json_roundtrip_keeps_microseconds(spark, sf_dir):
    from strata.sources import testdata

    ev = testdata.events_view(spark, sf_dir)
    landing = scratch_path(spark, "t_rt")
    feeds.write_json(ev, landing)
    back = feeds.read_json(spark, landing).withColumn("event_time", F.try_to_timestamp("event_time"))
    assert back.exceptAll(ev.select(*back.columns)).count() == 0
    assert ev.count() == back.count()


def test_partitioned_idempotent_replay(spark):
    landing = scratch_path(spark, "t_pland")
    _write_lines(local_path(landing), "a.json", [_event(i) for i in range(4)]
                 + [_event(i, "2024-01-02T00:00:00+00:00") for i in range(4, 6)])
    target = scratch_path(spark, "t_pidem")

    def with_date(df):
        return df.withColumn("event_date", F.to_date(F.try_to_timestamp("event_time")))

    for ck in ("t_pc1", "t_pc2"):
        ingest.replay_stream(spark, landing, target, scratch_path(spark, ck), ["event_id"],
                             partition_by=["event_date"], derive=with_date)
    out = spark.read.parquet(target)
    assert out.count() == 6
    assert out.select("event_date").distinct().count() == 2


def test_null_partitions_stay_idempotent(spark):
    path = scratch_path(spark, "null-part")
    batch = spark.createDataFrame([("a", "2024-01-01", 1), ("b", None, 2), (None, None, 3)], "id string, day string, v int")
    assert append_new(batch, path, ["id"], partition_by=["day"]) == 3
    assert append_new(batch, path, ["id"], partition_by=["day"]) == 0
    assert spark.read.parquet(path).count() == 3


def test_only_null_partitions(spark):
    path = scratch_path(spark, "only-null")
    batch = spark.createDataFrame([("b", None)], "id string, day date")
    assert [append_new(batch, path, ["id"], partition_by=["day"]) for _ in range(3)] == [1, 0, 0]


def test_empty_first_load(spark):
    path = scratch_path(spark, "empty-first")
    batch = spark.createDataFrame([("a", 1)], "id string, v int")
    assert append_new(batch.limit(0), path, ["id"], key_name="sk") == 0
    assert append_new(batch, path, ["id"], key_name="sk") == 1
    assert append_new(batch, path, ["id"], key_name="sk") == 0


def test_target_that_cannot_be_listed_raises(spark):
    with pytest.raises(Exception):
        append_new(spark.range(1), "nosuchfs://x/y", ["id"])


def test_load_reads_touched_partitions_only(spark):
    from strata.operators.load import new_rows

    path = scratch_path(spark, "pruned")
    old = spark.createDataFrame([(i, f"2024-01-{i:02d}") for i in range(1, 10)], "id long, day string")
    append_new(old, path, ["id"], partition_by=["day"])
    target = spark.read.schema(old.schema).parquet(path)
    batch = old.where("id in (3, 4)")
    plan = new_rows(batch, target, ["id"], "day")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day#" in plan and "2024-01-03" in plan.split("PartitionFilters")[1]


def test_replay_of_malformed_and_null_date_rows_adds_nothing(spark):
    landing, target = scratch_path(spark, "landing"), scratch_path(spark, "target")
    _write_lines(local_path(landing), "a.json", [_event(1), "{not json", _event(2, "x")])
    counts = []
    for _ in range(3):
        ingest.replay_stream(spark, landing, target, scratch_path(spark, "ck"), ["event_id"], partition_by=["event_date"],
                             derive=lambda df: df.withColumn("event_date", F.to_date(F.try_to_timestamp("event_time"))))
        counts.append(spark.read.parquet(target).count())
    assert counts[0] == counts[1] == counts[2]


def test_ledger_gives_the_next_key_without_the_target(spark):
    """The data files are gone but for the ledger: keys still go on, so no scan of the target gave them."""
    import glob

    from strata.operators.ledger import batches

    path = scratch_path(spark, "t_ledger")
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, v int")
    assert append_new(a, path, ["k"], key_name="sk", batch_id="a") == 2
    for f in glob.glob(f"{local_path(path)}/part-*") + glob.glob(f"{local_path(path)}/.part-*"):
        os.truncate(f, 0) if f.endswith("crc") else os.remove(f)
    assert append_new(a, path, ["k"], key_name="sk", batch_id="a") == 0
    b = spark.createDataFrame([("z", 3)], "k string, v int")
    assert append_new(b, path, ["k"], key_name="sk", batch_id="b") == 1
    assert [r.sk for r in spark.read.parquet(path).collect()] == [3]
    assert sorted((r.batch_id, r.rows, r.greatest_key) for r in batches(spark, path).collect()) == [("a", 2, 2), ("b", 1, 3)]


def test_ledger_after_a_load_that_broke_off(spark):
    from strata.operators.ledger import Ledger

    path = scratch_path(spark, "t_broken_load")
    append_new(spark.createDataFrame([("x", 1)], "k string, v int"), path, ["k"], key_name="sk", batch_id="a")
    Ledger(spark, path).begin("b", 1)  # batch b wrote its rows, but its note is missing
    spark.createDataFrame([("y", 2, 2)], "k string, v int, sk long").write.mode("append").parquet(path)
    assert Ledger(spark, path).greatest_key() is None
    rows = spark.createDataFrame([("y", 2), ("z", 3)], "k string, v int")
    assert append_new(rows, path, ["k"], key_name="sk", batch_id="b") == 1
    assert sorted((r.k, r.sk) for r in spark.read.parquet(path).collect()) == [("x", 1), ("y", 2), ("z", 3)]


def test_ledger_notes_partitions(spark):
    from strata.operators.ledger import batches

    path = scratch_path(spark, "t_ledger_parts")
    rows = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, None)], "k int, d string").withColumn("d", F.col("d").cast("date"))
    assert append_new(rows, path, ["k"], partition_by=["d"], batch_id="x") == 3
    assert batches(spark, path).first().partitions == ["2024-01-01", "2024-01-02"]


@pytest.mark.parametrize("stream", [False, True])
def test_broken_lines_are_kept(spark, stream):
    landing, bronze = scratch_path(spark, "t_broken"), scratch_path(spark, "t_broken_bronze")
    lines = [_event(1), "{not json", "", "{}", '{"unknown": 1}', '{"event_id": "e9", "price": "x"}', "[]", "null", _event(2)]
    _write_lines(local_path(landing), "a.json", lines)
    if stream:
        events = ingest.ingest_stream_checked(spark, landing, bronze, scratch_path(spark, "t_broken_ck"))
    else:
        events = feeds.ingest_checked(spark, landing, bronze)
    assert sorted(r.event_id for r in events.collect()) == ["e1", "e2"]
    rejected = feeds.rejected_lines(spark, bronze)
    assert all(r.ip_file_name.endswith("a.json") and r.ingestion_ts for r in rejected.collect())
    got = {(r.raw_line, r.reject_reason) for r in rejected.collect()}
    assert ("{not json", "malformed") in got and ('{"event_id": "e9", "price": "x"}', "bad_field") in got and (None, "empty") in got
    assert "rejected" in events._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1][:80]
