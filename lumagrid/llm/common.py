"""What the operators of this subpackage share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.session import materialise, tune

__all__ = ["apart", "bitmap", "free", "hash_of", "materialise", "read", "ready"]


def ready(spark: SparkSession) -> SparkSession:
    """Bound Arrow batches by bytes: documents differ in length by five orders of magnitude."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def free(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name += "_"
        out.append(name)
    return out


def hash_of(text: str) -> Column:
    """Tells documents of one key apart; stable over scans, so that a document can be met again by a join."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def apart(df: DataFrame) -> DataFrame:
    """``df`` for a join by shuffle, whatever size Spark takes it for.

    Spark sizes a table by its files and the types of its columns. It knows neither how many rows an explode makes of
    one nor how well a file is encoded, so it may broadcast a table that is a hundred times as large as it thinks.
    Sides that end in a group by or distinct need no such mark: their size is measured before the join is planned.
    """
    return df.hint("merge")


#: A membership bitmap never has more bits than this (8 MB), however many keys it stands for.
MOST_BITS = 1 << 26


def bitmap(keys: DataFrame, column: str):
    """A function from a 64-bit hash column to a test that is true for every hash in ``keys``, and for few others.

    The bitmap (a Bloom filter) is built by a grouped sum and is of bounded size, so it may be broadcast; beyond
    its room it only lets more rows pass. Used to shuffle few rows before an exact join, never instead of one.
    """
    spark = keys.sparkSession
    count = keys.count()
    bits = 1 << 16
    while bits < MOST_BITS and bits < 12 * count:
        bits *= 2

    def places(hashed: Column) -> list[Column]:
        return [F.pmod(F.hash(hashed, F.lit(j)), F.lit(bits)) for j in range(3)]

    set_ = keys.select(F.explode(F.array(*places(F.col(column)))).alias("p")).groupBy((F.col("p") / 64).cast("int").alias("w"))
    set_ = set_.agg(F.expr("bit_or(shiftleft(1L, p % 64))").alias("b")).toPandas()
    words = np.zeros(bits // 64, np.uint64)
    words[set_["w"].to_numpy(np.int64)] = set_["b"].to_numpy(np.int64).view(np.uint64)
    sent = spark.sparkContext.broadcast(words)

    @F.arrow_udf("boolean")
    def known(a: pa.Array, b: pa.Array, c: pa.Array) -> pa.Array:
        hit = np.ones(len(a), bool)
        for column in (a, b, c):
            p = column.to_numpy()
            hit &= (sent.value[p >> 6] >> (p & 63).astype(np.uint64)) & np.uint64(1) == 1
        return pa.array(hit)

    return lambda hashed: known(*places(hashed))
