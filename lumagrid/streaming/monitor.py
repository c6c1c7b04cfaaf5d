"""Watching the task log for tasks that were started and not finished in time.

Tasks are dealt into shards by a hash. The state of a shard holds the newest record of each of its tasks in one packed
table, so that a batch costs one call for each shard it touches and not one for each task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SHARDS = 2048
ALERT = "task_id string, started bigint, deadline bigint"
STATE = "tasks binary"
RECORD = pa.schema([("task_id", pa.string()), ("at", pa.int64()), ("seq", pa.int64()), ("open", pa.bool_())])


def _packed(tasks: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, RECORD) as out:
        out.write_table(pa.Table.from_pandas(tasks, RECORD, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(data).read_pandas()


def _newest(records: pd.DataFrame) -> pd.DataFrame:
    """The last record of each task by time and number; of equal ones the last to arrive."""
    order = np.lexsort((records["seq"].to_numpy(), records["at"].to_numpy()))
    return records.iloc[order].drop_duplicates("task_id", keep="last")


def open_task_alerts(
    log: DataFrame,
    patience: str = "30 minutes",
    lateness: str = "1 hour",
    order: str | None = None,
    shards: int = SHARDS,
) -> DataFrame:
    """One alert per task still STARTED when the watermark reaches its deadline.

    ``log`` is a stream of (task_id, ts TIMESTAMP, status). ``order`` names a whole number that decides between
    records of one task and time; without it the last to arrive counts. State is the newest record of a task:
    an open one waits for its deadline, a finished one stays as long as older records may still
    arrive. Records behind the watermark are dropped, and so are records without a time. Choose ``shards`` so that the
    tasks waiting in one of them fit a task easily; it stays fixed for the life of a checkpoint.
    """
    wait, late = (pd.Timedelta(x) // pd.Timedelta("1us") for x in (patience, lateness))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tasks = _unpacked(state.get[0]) if state.exists else None
        if not state.hasTimedOut:
            for part in parts:
                part = part[RECORD.names]
                tasks = _newest(part if tasks is None else pd.concat([tasks, part], ignore_index=True))
        if tasks is None:
            return
        due = (tasks["at"] + np.where(tasks["open"], wait, late)) // 1000
        over = due <= state.getCurrentWatermarkMs()
        if not over.all():
            state.update((_packed(tasks[~over]),))
            state.setTimeoutTimestamp(int(due[~over].min()) - 1)  # a time-out comes when the watermark is past this
        elif state.exists:
            state.remove()
        overdue = tasks[over & tasks["open"]]
        if len(overdue):
            yield pd.DataFrame(
                {"task_id": overdue["task_id"], "started": overdue["at"], "deadline": overdue["at"] + wait}
            )

    seq = F.coalesce(F.col(order).cast("bigint"), F.lit(0).cast("bigint")) if order else F.lit(0).cast("bigint")
    is_open = F.coalesce(F.col("status") == "STARTED", F.lit(False))
    alerts = (
        log.filter(F.col("ts").isNotNull())
        .select("task_id", "ts", is_open.alias("open"), seq.alias("seq"), F.unix_micros("ts").alias("at"))
        .withColumn("shard", F.pmod(F.xxhash64("task_id"), F.lit(shards)).cast("int"))
        .withWatermark("ts", lateness)
        .groupBy("shard")
        .applyInPandasWithState(step, ALERT, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    )
    moment = lambda name: F.timestamp_micros(name).alias(name)
    return alerts.select("task_id", moment("started"), moment("deadline"))
