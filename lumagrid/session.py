"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def tune(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on; all are run-time settings, safe on a live session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Packed images are large cells: bound an Arrow batch by bytes, not only by rows.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for tables between jobs: ``spark.checkpoint.dir``.

    Where the session names none, a folder below the warehouse, which all executors reach as well.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch").rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> None:
    """Remove what the operators have written so far; no DataFrame over it may be read later."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(folder) if system.exists(folder) else []:
        system.delete(status.getPath(), True)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether an existing path is a folder rather than a file, in any store Spark reaches."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isDirectory()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Ask for even partitions of an input whose rows unfold into many; AQE settles their number."""
    return df.hint("rebalance", *keys)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Cut lineage by writing to the shared folder and reading back (survives lost executors)."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
