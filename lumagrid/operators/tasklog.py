"""The task log: pipe-delimited lines `time|task|type|status|details`."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The states, fields and time format of a log line.
STATUSES = ("STARTED", "COMPLETED", "FAILED")
FIELDS = ("ts", "task_id", "task_type", "status", "details")
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def to_lines(records: DataFrame) -> DataFrame:
    """(seq, line) from log records."""
    return records.select("seq", F.concat_ws("|", *FIELDS).alias("line"))


def _parts(lines: DataFrame) -> DataFrame:
    parts = lines.withColumn("p", F.split("line", r"\|", 5)).filter(F.size("p") == 5)
    return parts.select("seq", *[F.col("p")[i].alias(name) for i, name in enumerate(FIELDS)])


def parse_lines(lines: DataFrame, on_error: str = "reject") -> DataFrame:
    """Log records; lines of fewer than five parts are skipped, later bars stay in the details.

    A status outside the known three rejects the line, or fails the query with ``on_error="raise"``.
    """
    known = F.col("status").isin(*STATUSES)
    records = _parts(lines)
    if on_error == "raise":
        bad = F.raise_error(F.concat(F.lit("unknown status "), F.col("status")))
        return records.withColumn("status", F.when(known, F.col("status")).otherwise(bad))
    if on_error != "reject":
        raise ValueError("on_error must be 'reject' or 'raise'")
    return records.filter(known)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """(seq, line, reason) of the lines that :func:`parse_lines` leaves out."""
    parts = F.split("line", r"\|", 5)
    reason = F.when(F.size(parts) < 5, "too few parts").when(
        ~parts[3].isin(*STATUSES), "unknown status"
    )
    return lines.withColumn("reason", reason).filter(F.col("reason").isNotNull()).select(
        "seq", "line", "reason"
    )


def latest(records: DataFrame) -> DataFrame:
    """The last record of each task, by sequence number; combined before the shuffle."""
    last = F.max_by(F.struct("seq", "ts", "task_type", "status", "details"), "seq")
    return records.groupBy("task_id").agg(last.alias("r")).select("task_id", "r.*")


def incomplete(records: DataFrame) -> DataFrame:
    """Tasks whose last record says STARTED; with type and details, the list to run again."""
    return latest(records).filter(F.col("status") == "STARTED")


def summary(records: DataFrame) -> DataFrame:
    """One row: all records, records by status, and open tasks."""
    count = lambda s: F.count_if(F.col("status") == s).alias(s.lower())
    last = records.groupBy("task_id").agg(F.max_by("status", "seq").alias("status"))
    still_open = last.agg(F.count_if(F.col("status") == "STARTED")).scalar()
    return records.agg(F.count("*").alias("total"), *[count(s) for s in STATUSES]).select(
        "*", still_open.alias("open")
    )


def tail(records: DataFrame, n: int = 20) -> DataFrame:
    """The last ``n`` records in order, each with the number of records left out."""
    earlier = F.greatest(records.agg(F.count("*")).scalar() - n, F.lit(0).cast("bigint"))
    return records.orderBy(F.desc("seq")).limit(n).orderBy("seq").withColumn("earlier", earlier)


def append(records: DataFrame, path: str, numbered: bool = True) -> None:
    """Add records to a text log.

    Text files read in parallel have no line order, so the sequence number is written in front
    unless ``numbered`` is off.
    """
    number = [F.col("seq").cast("string")] if numbered else []
    records.select(F.concat_ws("|", *number, *FIELDS).alias("value")).write.mode("append").text(path)


def _text(spark, path: str) -> DataFrame:
    """Lines with the place they stand at; a log that does not exist yet is empty."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], "value string, file string, start bigint, place bigint")
    placed = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    return placed


def read_log(spark, path: str) -> DataFrame:
    """(seq, line) from a log written by :func:`append`."""
    parts = F.split("value", r"\|", 2)
    return _text(spark, path).select(
        parts[0].try_cast("bigint").alias("seq"), F.coalesce(F.get(parts, 1), F.lit("")).alias("line")
    )


def read_plain_log(spark, path: str) -> DataFrame:
    """(seq, line) from a log without numbers, in the order of its lines; several files by name.

    A split of a file is read in order by one task, so lines are numbered within their split, and the splits'
    line counts, one row each, are added up before it.
    """
    lines = _text(spark, path)
    split = ["file", "start"]
    within = lines.withColumn("task", F.shiftright("place", 33)).withColumn("line_no", F.col("place").bitwiseAND((1 << 33) - 1))
    sizes = within.groupBy(*split, "task").agg(F.count("*").alias("n"), F.min("line_no").alias("first"))
    before = F.sum("n").over(Window.orderBy(*split)) - F.col("n")
    offsets = sizes.select(*split, (before - F.col("first")).alias("offset"))
    return within.join(offsets, split).select((F.col("line_no") + F.col("offset")).alias("seq"), F.col("value").alias("line"))
