import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from lumagrid.operators import recency, tasklog

LINES = [
    (1, "2024-01-01 10:00:00|T1|search|STARTED|a|b"),
    (2, "2024-01-01 10:00:01|T2|local|STARTED|x"),
    (3, "2024-01-01 10:00:02|T1|search|COMPLETED|done"),
    (4, "2024-01-01 10:00:03|T3|tamper"),
    (5, "2024-01-01 10:00:04|T3|tamper|PAUSED|p"),
    (6, "2024-01-01 10:00:05|T4|tamper|FAILED|"),
    (7, ""),
]


@pytest.fixture()
def lines(spark):
    return spark.createDataFrame(LINES, "seq bigint, line string")


def test_parse(lines):
    got = {r.seq: (r.task_id, r.status, r.details) for r in tasklog.parse_lines(lines).collect()}
    assert got == {
        1: ("T1", "STARTED", "a|b"),
        2: ("T2", "STARTED", "x"),
        3: ("T1", "COMPLETED", "done"),
        6: ("T4", "FAILED", ""),
    }
    reasons = {r.seq: r.reason for r in tasklog.rejected_lines(lines).collect()}
    assert reasons == {4: "too few parts", 5: "unknown status", 7: "too few parts"}


def test_unknown_status_can_stop_the_query(lines):
    with pytest.raises(Exception, match="unknown status PAUSED"):
        tasklog.parse_lines(lines, "raise").collect()
    with pytest.raises(ValueError):
        tasklog.parse_lines(lines, "skip")


def test_states(lines):
    records = tasklog.parse_lines(lines)
    assert rows_of(tasklog.latest(records).select("task_id", "status")) == [
        ("T1", "COMPLETED"),
        ("T2", "STARTED"),
        ("T4", "FAILED"),
    ]
    assert rows_of(tasklog.incomplete(records).select("task_id", "task_type", "details")) == [("T2", "local", "x")]
    assert rows_of(tasklog.summary(records)) == [(4, 2, 1, 1, 1)]
    assert [(r.seq, r.earlier) for r in tasklog.tail(records, 2).collect()] == [(3, 2), (6, 2)]
    assert [r.earlier for r in tasklog.tail(records, 20).collect()] == [0] * 4


def test_append_and_read(spark, lines, tmp_path):
    records = tasklog.parse_lines(lines)
    path = str(tmp_path / "log")
    tasklog.append(records.filter("seq < 3"), path)
    tasklog.append(records.filter("seq >= 3"), path)
    assert rows_of(tasklog.parse_lines(tasklog.read_log(spark, path))) == rows_of(records)


def test_plain_lines_are_the_records(spark, lines, tmp_path):
    records = tasklog.parse_lines(lines)
    tasklog.append(records, str(tmp_path / "log"), numbered=False)
    assert rows_of(spark.read.text(str(tmp_path / "log"))) == rows_of(tasklog.to_lines(records).select("line"))


def test_log_without_numbers_keeps_the_order_of_its_lines(spark, tmp_path):
    """The later line wins, also within a second and where the time cannot be read."""
    (tmp_path / "plain.log").write_text(
        "2024-01-01 10:00:00|T1|s|COMPLETED|same second\n2024-01-01 10:00:00|T1|s|STARTED|again\n"
        "2024-01-01 10:00:01|T2|s|STARTED|d\nnot a time|T3|s|STARTED|d\nnot a time|T3|s|FAILED|d\n\n"
    )
    records = tasklog.parse_lines(tasklog.read_plain_log(spark, str(tmp_path / "plain.log")))
    assert rows_of(tasklog.incomplete(records).select("task_id", "details")) == [("T1", "again"), ("T2", "d")]
    assert rows_of(tasklog.latest(records).filter("task_id = 'T3'").select("status")) == [("FAILED",)]


def test_plain_log_over_many_splits(spark, tmp_path):
    lines = [f"t|T{i % 7}|s|{'STARTED' if i % 2 else 'FAILED'}|{i}" for i in range(3000)]
    (tmp_path / "plain.log").write_text("\n".join(lines))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = tasklog.read_plain_log(spark, str(tmp_path / "plain.log")).orderBy("seq").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert [r.line for r in rows] == lines and [r.seq for r in rows] == list(range(3000))


def test_missing_log_is_empty(spark, tmp_path):
    assert tasklog.read_log(spark, str(tmp_path / "none")).count() == 0
    assert tasklog.read_plain_log(spark, str(tmp_path / "none")).count() == 0


def at(minute):
    return dt.datetime(2024, 1, 1, 10, 0) + dt.timedelta(minutes=minute)


def test_recency(spark):
    log = spark.createDataFrame(
        [
            (1, at(0), "A", "put"),
            (2, at(10), "B", "put"),
            (3, at(59), "A", "get"),
            (4, at(60), "C", "get"),
            (5, at(60), "B", "get"),
        ],
        "seq bigint, ts timestamp_ntz, result_key string, op string",
    )
    recent = [(r.result_key, r.accesses) for r in recency.recent_results(log, 2).collect()]
    assert recent == [("B", 2), ("C", 1)]
    live = {r.result_key: r.expired for r in recency.recent_live(log).collect()}
    assert live == {"A": True, "B": False, "C": True}  # A written an hour ago, C never
    early = recency.recent_live(log, F.lit(at(59)).cast("timestamp_ntz"))
    assert {r.result_key: r.expired for r in early.collect()}["A"] is False
    more = spark.createDataFrame(
        [(0, at(-5), "A", "get"), (6, at(61), "A", "get"), (7, at(62), "C", "put"), (8, at(63), "C", "get")], log.schema
    )
    both = log.unionByName(more)
    reused = recency.reuse(both.filter("op = 'get'"), both.filter("op = 'put'"))
    hits = {r.seq: r.hit for r in reused.collect()}
    assert hits == {0: False, 3: True, 4: False, 5: True, 6: False, 8: True}
    assert rows_of(recency.misses(reused)) == [("A", 2), ("C", 1)]
    for piece in (1, 2, 3, 100):
        cut = recency.reuse(both.filter("op = 'get'"), both.filter("op = 'put'"), piece)
        assert {r.seq: r.hit for r in cut.collect()} == hits
