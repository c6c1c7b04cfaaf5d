"""Recent results from an access log (seq, ts, result_key, op) with op 'put' or 'get'."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Results kept, and how long each lasts.
KEPT = 20
LIFETIME_SECONDS = 3600
# Numbers of ``seq`` in one piece of a key's log.
PIECE = 1 << 20


def access_stats(log: DataFrame) -> DataFrame:
    """Per key: last access, accesses, and last time the value was written."""
    return log.groupBy("result_key").agg(
        F.max("ts").alias("last_access"),
        F.count("*").alias("accesses"),
        F.max(F.when(F.col("op") == "put", F.col("ts"))).alias("last_put"),
    )


def recent_results(log: DataFrame, n: int = KEPT) -> DataFrame:
    """The ``n`` keys touched last."""
    return access_stats(log).orderBy(F.desc("last_access"), "result_key").limit(n)


def recent_live(log: DataFrame, as_of: Column | None = None, n: int = KEPT) -> DataFrame:
    """Recent keys with a flag: the value is gone an hour after it was written.

    Reads do not prolong it, and an expired key still takes one of the places. ``as_of``
    defaults to the last time in the log.
    """
    now = as_of if as_of is not None else log.agg(F.max("ts")).scalar()
    age = F.timestamp_diff("SECOND", F.col("last_put"), F.col("as_of"))
    gone = F.col("last_put").isNull() | (age >= LIFETIME_SECONDS)
    return recent_results(log, n).withColumn("as_of", now).withColumn("expired", gone).drop("as_of")


def reuse(requests: DataFrame, results: DataFrame, piece: int = PIECE) -> DataFrame:
    """(seq, result_key, ts, hit): for each request whether its value was there.

    It was if the key was written before, by ``seq``, and last less than an hour before the request. Both sides
    (seq, ts, result_key). A key's rows are cut into pieces of ``piece`` numbers of ``seq``, so a key that holds most of
    the log is many tasks: the last write of each piece, one row, is handed to the next pieces by a small window,
    and the last write before a request is found within its piece, which begins with the one handed on.
    """
    sides = results.select("seq", "ts", "result_key", F.lit(True).alias("put")).unionByName(
        requests.select("seq", "ts", "result_key", F.lit(False).alias("put"))
    )
    sides = sides.withColumn("piece", F.floor(F.col("seq") / F.lit(piece))).withColumn("own", F.lit(1))
    write = F.col("put") & F.col("ts").isNotNull()
    pieces = sides.groupBy("result_key", "piece").agg(
        F.max_by(F.when(write, F.col("ts")), F.when(write, F.col("seq"))).alias("last_put")
    )
    before = Window.partitionBy("result_key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    handed = pieces.select(
        F.lit(None).cast(sides.schema["seq"].dataType).alias("seq"),
        F.last("last_put", ignorenulls=True).over(before).alias("ts"),
        "result_key",
        F.lit(True).alias("put"),
        "piece",
        F.lit(0).alias("own"),
    ).filter(F.col("ts").isNotNull())
    written = F.last(F.when(F.col("put"), F.col("ts")), ignorenulls=True)
    earlier = (
        Window.partitionBy("result_key", "piece").orderBy("own", "seq").rowsBetween(Window.unboundedPreceding, -1)
    )
    age = F.timestamp_diff("SECOND", F.col("written"), F.col("ts"))
    asked = sides.unionByName(handed).withColumn("written", written.over(earlier)).filter(~F.col("put"))
    return asked.select("seq", "result_key", "ts", F.coalesce(age < LIFETIME_SECONDS, F.lit(False)).alias("hit"))


def misses(reused: DataFrame) -> DataFrame:
    """(result_key, requests): the work left to run, each key once."""
    return reused.filter(~F.col("hit")).groupBy("result_key").agg(F.count("*").alias("requests"))
