import datetime as dt
import shutil

import numpy as np

from conftest import IMAGES, rows_of
from lumagrid.plans.queries import QUERIES
from lumagrid.sources import table
from lumagrid.streaming.ingest import ingest_stream
from lumagrid.streaming.monitor import open_task_alerts


def test_ingest_again_changes_nothing(spark, pack, tmp_path):
    arrivals, where = str(tmp_path / "in"), str(tmp_path / "table")
    stream = lambda: spark.readStream.schema(IMAGES).parquet(arrivals)
    run = lambda progress: ingest_stream(stream(), where, str(tmp_path / progress), 4).awaitTermination()
    pack({1: np.zeros((2, 2)), 2: np.ones((2, 2))}).write.parquet(arrivals)
    run("p")
    first = rows_of(table.scan(spark, where).select("image_id", "width"))
    run("p")  # nothing new
    run("other")  # everything once more
    assert rows_of(table.scan(spark, where).select("image_id", "width")) == first == [(1, 2), (2, 2)]
    pack({2: np.zeros((3, 3)), 5: np.zeros((1, 1))}).write.mode("append").parquet(arrivals)
    run("p")
    assert rows_of(table.scan(spark, where).select("image_id", "width")) == [(1, 2), (2, 3), (5, 1)]


def at(minute):
    return dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=minute)


def test_open_task_alerts(spark, tmp_path):
    folder, out, progress = (str(tmp_path / n) for n in ("in", "out", "progress"))
    schema = "task_id string, ts timestamp, status string"

    def feed(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(folder)
        log = spark.readStream.schema(schema).parquet(folder)
        query = (
            open_task_alerts(log)
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", progress)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return rows_of(spark.read.parquet(out).select("task_id"))

    assert feed(("open", at(0), "STARTED"), ("done", at(0), "STARTED"), ("done", at(5), "COMPLETED")) == []
    # The end of this task arrives before its start; it is never reported.
    assert feed(("swapped", at(40), "COMPLETED"), ("new", at(50), "STARTED")) == []
    assert feed(("swapped", at(30), "STARTED")) == []
    # The watermark passes the deadline of the first task only.
    assert feed(("clock", at(100), "COMPLETED")) == [("open",)]
    # Too late: behind the watermark, so it opens nothing.
    assert feed(("late", at(1), "STARTED"), ("clock", at(145), "COMPLETED")) == [("new",), ("open",)]
    assert feed(("clock", at(400), "COMPLETED")) == [("new",), ("open",)]


def test_a_replayed_batch_writes_no_version(spark, pack, tmp_path):
    where = str(tmp_path / "table")
    first, second = pack({1: np.zeros((2, 2)), 2: np.ones((2, 2))}), pack({2: np.zeros((3, 3))})
    for batch, mark in ((first, "q.0"), (second, "q.1"), (first, "q.0"), (second, "q.1")):
        table.ingest(spark, where, batch, 4, batch=mark)
    assert table.versions(spark, where)[0] == [1, 2]
    # The older batch did not come back over the newer one.
    assert rows_of(table.scan(spark, where).select("image_id", "width")) == [(1, 2), (2, 3)]
    table.compact(spark, where)
    table.ingest(spark, where, first, 4, batch="q.0")
    assert table.versions(spark, where)[0] == [3]
    assert table.has_batch(spark, where, "q.1") and not table.has_batch(spark, where, "q.2")


def test_a_stream_whose_commit_was_lost_does_not_write_again(spark, pack, tmp_path):
    arrivals, where, progress = (str(tmp_path / n) for n in ("in", "table", "progress"))
    pack({1: np.zeros((2, 2))}).write.parquet(arrivals)
    run = lambda: ingest_stream(spark.readStream.schema(IMAGES).parquet(arrivals), where, progress, 4).awaitTermination()
    run()
    assert table.versions(spark, where)[0] == [1]
    for name in ("0", ".0.crc"):  # as if the job had failed after the write and before the commit
        (tmp_path / "progress" / "commits" / name).unlink(missing_ok=True)
    run()
    assert table.versions(spark, where)[0] == [1]


def test_records_of_one_time_are_ordered_by_their_number(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "task_id string, ts timestamp, status string, seq bigint"
    rows = [("a", at(0), "COMPLETED", 2), ("a", at(0), "STARTED", 1), ("b", at(0), "STARTED", 9), ("b", at(0), "COMPLETED", 8)]
    spark.createDataFrame([*rows, ("clock", at(300), "COMPLETED", 10)], schema).coalesce(1).write.parquet(folder)
    alerts = open_task_alerts(spark.readStream.schema(schema).parquet(folder), order="seq")
    query = alerts.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "p"))
    query.trigger(availableNow=True).start().awaitTermination()
    assert rows_of(spark.read.parquet(out)) == [("b", at(0), at(30))]


def test_a_table_of_many_files_streams_like_one_of_a_single_file(spark, tmp_path):
    docs = spark.createDataFrame([(i, "word " * (i + 1)) for i in range(20)], "doc_id bigint, text string")
    rows = [(i, at(i), i, "view", 1.0, "{}") for i in range(200)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string")
    for name, df in (("documents", docs), ("events", events)):
        df.repartition(3).write.parquet(str(tmp_path / "many" / f"{name}.parquet"))
        df.coalesce(1).write.parquet(str(tmp_path / "one" / "parts"), mode="overwrite")
        (part,) = (tmp_path / "one" / "parts").glob("part-*.parquet")
        shutil.copy(part, tmp_path / "one" / f"{name}.parquet")
    for name, many in (("stream_ingest", 20), ("stream_open_tasks", 100)):
        got, want = (rows_of(QUERIES[name](spark, str(tmp_path / kind))) for kind in ("many", "one"))
        assert got == want and len(got) >= many
    assert rows_of(QUERIES["stream_ingest"](spark, str(tmp_path / "many")))[3] == (3, 32, 1, 32)


def test_state_is_kept_by_shard_and_not_by_task(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "task_id string, ts timestamp, status string, seq bigint"
    rows = [(f"t{i}", at(i % 90), "STARTED", i) for i in range(300)]
    rows += [(f"t{i}", at(95 + i % 7), "COMPLETED", 300 + i) for i in range(0, 300, 3)]
    rows += [(None, at(2), "STARTED", 900), ("timeless", None, "STARTED", 901), ("clock", at(150), "COMPLETED", 902)]
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(folder)
    alerts = open_task_alerts(spark.readStream.schema(schema).parquet(folder), order="seq", shards=3)
    query = alerts.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "p"))
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    # The watermark is at minute 90: what started until minute 60 and was not completed is overdue.
    want = {(f"t{i}", at(i % 90), at(i % 90 + 30)) for i in range(300) if i % 3 and i % 90 <= 60}
    assert {tuple(r) for r in spark.read.parquet(out).collect()} == want | {(None, at(2), at(32))}
    kept = [s["numRowsTotal"] for p in query.recentProgress for s in p["stateOperators"]]
    assert kept and max(kept) <= 3
