"""The image table: one Parquet row per image, keyed by image_id.

A change never touches what is stored. It writes the changed rows, a deleted image as a row without data, to a
version folder of its own and then publishes the version by an empty file; readers take published versions
only, the newest row of each key counts. What an interrupted change leaves behind is never read. ``compact``
writes all living rows as a new base when the changes have grown; it may also change the number of buckets.

Rows are spread over ``bucket`` partitions by a hash of the key, so that a lookup reads one bucket of each version; the
number of buckets is itself a partition value, so readers need not be told.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.functions import histograms as H
from lumagrid.operators.histogram import with_histogram
from lumagrid.session import materialise
from lumagrid.sizing import within_broadcast

BUCKETS = 64
COLUMNS = ("image_id", "width", "height", "hist", "gray")
LAYOUT = ("buckets", "bucket")
HIDDEN = ("deleted", "version", *LAYOUT)
PUBLISHED = "_published"


def bucket_of(key: Column) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.col("buckets")).cast("int")


# ------------------------------------------------- on DataFrames, no storage


def last_per_key(rows: DataFrame, order: str = "seq") -> DataFrame:
    """The last written row of each image_id."""
    kept = [c for c in rows.columns if c != "image_id"]
    last = F.max_by(F.struct(*kept), order)
    return rows.groupBy("image_id").agg(last.alias("r")).select("image_id", "r.*")


def upsert_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    """``new`` (one row per key) replaces or adds to ``existing``."""
    return existing.join(new.select("image_id"), "image_id", "left_anti").unionByName(new)


def delete_rows(existing: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is not listed; unknown keys are no error."""
    return existing.join(keys.select("image_id"), "image_id", "left_anti")


def library_union(table: DataFrame, files: DataFrame) -> DataFrame:
    """Both sources as one library; a table row wins over a file of the same name."""
    rest = files.join(table.select("image_id"), "image_id", "left_anti")
    return table.withColumn("source", F.lit("table")).unionByName(
        rest.withColumn("source", F.lit("files"))
    )


def library_join(table: DataFrame, files: DataFrame) -> DataFrame:
    """Files that have a table row; table rows without a file drop out."""
    return files.join(table.select("image_id"), "image_id")


def choose_library(kind: str, table: DataFrame | None, files: DataFrame | None) -> DataFrame:
    """The table, the files, or with ``auto`` the table unless it is missing or empty."""
    if kind not in ("table", "files", "auto"):
        raise ValueError("library source must be 'table', 'files' or 'auto'")
    options = {"table": [table], "files": [files], "auto": [table, files]}[kind]
    for option in options:
        if option is not None and not option.isEmpty():
            return option
    raise ValueError("the image library is empty")


def library_status(union: DataFrame) -> DataFrame:
    return union.groupBy("source").agg(F.count("*").alias("images"))


def library_list(library: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` images by id and how many more there are."""
    more = F.greatest(library.agg(F.count("*")).scalar() - n, F.lit(0).cast("bigint"))
    return (
        library.select("image_id", "width", "height").orderBy("image_id").limit(n).withColumn("more", more)
    )


def processed_images(rows: DataFrame) -> DataFrame:
    return rows.select("image_id").distinct()


def outcome_counters(rows: DataFrame) -> DataFrame:
    """Images per outcome; ``status`` as set by :func:`with_status`."""
    return rows.groupBy("status").agg(F.count("*").alias("images"))


def with_status(scanned: DataFrame) -> DataFrame:
    return scanned.withColumn(
        "status", F.when(F.col("width") > 0, "processed").otherwise("failed to read")
    )


# --------------------------------------------------------------- stored table


def _placed(rows: DataFrame, buckets: int) -> DataFrame:
    return rows.withColumn("buckets", F.lit(buckets)).withColumn("bucket", bucket_of(F.col("image_id")))


def _clustered(rows: DataFrame) -> DataFrame:
    """Rows of a bucket together, by key; a bucket larger than one task's share is cut."""
    return rows.hint("rebalance", *[F.col(c) for c in LAYOUT]).sortWithinPartitions(*LAYOUT, "image_id")


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, path: str) -> list[str]:
    system, where = _folder(spark, path)
    return [s.getPath().getName() for s in system.listStatus(where)] if system.exists(where) else []


def versions(spark: SparkSession, path: str) -> tuple[list[int], int]:
    """Published versions from the newest base on, and the number of buckets; none for a table without a write."""
    names = (x.split("-")[:3] for x in _names(spark, f"{path}/{PUBLISHED}"))
    found = sorted((int(n), kind, int(b)) for n, kind, b in names)
    bases = [i for i, (_, kind, _) in enumerate(found) if kind == "base"]
    if not bases:
        return [], 0
    return [n for n, _, _ in found[bases[-1] :]], found[bases[-1]][2]


def has_batch(spark: SparkSession, path: str, batch: str) -> bool:
    """Whether the write marked ``batch`` is published."""
    return any(x.split("-")[3:] == [batch] for x in _names(spark, f"{path}/{PUBLISHED}"))


def _publish(spark: SparkSession, path: str, rows: DataFrame, kind: str, buckets: int, batch: str | None = None) -> None:
    """Write a version and make it known, under the mark of its batch if it has one.

    Several writers at once need a lock of their own.
    """
    used = [int(x.partition("=")[2]) for x in _names(spark, path) if x.startswith("version=")]
    number = max(used, default=0) + 1
    _clustered(_placed(rows, buckets)).write.partitionBy(*LAYOUT).parquet(f"{path}/version={number}")
    system, where = _folder(spark, f"{path}/{PUBLISHED}/{number}-{kind}-{buckets}{f'-{batch}' if batch else ''}")
    system.create(where).close()


def _one_per_key(rows: DataFrame, order: str | None) -> DataFrame:
    if order:
        return last_per_key(rows, order).drop(order)
    if not rows.groupBy("image_id").count().filter("count > 1").isEmpty():
        raise ValueError("several rows of one image; name the column that orders them")
    return rows


def create(
    rows: DataFrame, path: str, buckets: int = BUCKETS, order: str | None = None, batch: str | None = None
) -> None:
    """First write; nothing is written without rows. Choose ``buckets`` so that one of them holds a few GB."""
    rows = _one_per_key(rows, order)
    if not rows.isEmpty():
        _publish(rows.sparkSession, path, rows.withColumn("deleted", F.lit(False)), "base", buckets, batch)


def _stored(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the published versions."""
    numbers, _ = versions(spark, path)
    if not numbers:
        raise FileNotFoundError(f"no image table at {path}")
    return spark.read.option("basePath", path).parquet(*(f"{path}/version={n}" for n in numbers))


def _living(stored: DataFrame, base: int) -> DataFrame:
    """The newest row of each key unless it is deleted. Only keys of the changes are compared, no pixels."""
    changed = stored.filter(F.col("version") > base).groupBy("image_id").agg(F.max("version").alias("newest"))
    rows = stored.join(changed, "image_id", "left").filter(F.col("newest").isNull() | (F.col("version") == F.col("newest")))
    return rows.filter(~F.col("deleted")).drop("newest")


def _rows(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    stored, (numbers, _) = _stored(spark, path), versions(spark, path)
    stored = stored if where is None else stored.filter(where)
    return _living(stored, numbers[0]) if len(numbers) > 1 else stored.filter(~F.col("deleted"))


def put(
    spark: SparkSession, path: str, rows: DataFrame, order: str | None = None, batch: str | None = None
) -> None:
    """Insert or replace images. The last row per key by ``order`` counts; without it a key may not repeat."""
    rows = _one_per_key(rows, order)
    stored = _stored(spark, path)
    rows = rows.withColumn("deleted", F.lit(False))
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in stored.schema if f.name not in (*LAYOUT, "version")])
    if not rows.isEmpty():
        _publish(spark, path, rows, "change", versions(spark, path)[1], batch)


def delete(spark: SparkSession, path: str, keys: DataFrame) -> None:
    """Remove images; keys the table does not hold are ignored."""
    living = _rows(spark, path)
    gone = living.select("image_id").join(keys.select("image_id").distinct(), "image_id", "left_semi")
    empty = [
        F.lit(None).cast(f.dataType).alias(f.name)
        for f in living.schema
        if f.name not in ("image_id", *HIDDEN)
    ]
    gone = gone.select("image_id", *empty, F.lit(True).alias("deleted"))
    if not gone.isEmpty():
        _publish(spark, path, gone, "change", versions(spark, path)[1])


def compact(spark: SparkSession, path: str, buckets: int | None = None) -> None:
    """Write all living images as a new base, with another number of buckets if one is given."""
    rows = _rows(spark, path).drop("version", *LAYOUT)
    _publish(spark, path, rows, "base", buckets or versions(spark, path)[1])


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All images; select the columns needed, the others are not read."""
    return _rows(spark, path).drop(*HIDDEN)


def hist_scan(spark: SparkSession, path: str) -> DataFrame:
    """Ids, sizes and histograms, without pixels; rows without a histogram are skipped."""
    return scan(spark, path).select("image_id", "width", "height", "hist").filter(
        F.size("hist") == H.BINS
    )


def get(spark: SparkSession, path: str, image_id) -> DataFrame:
    """The image with this key: one bucket, and within it the row groups whose range holds it."""
    key = F.lit(image_id).cast(_stored(spark, path).schema["image_id"].dataType)
    return _rows(spark, path, (F.col("bucket") == bucket_of(key)) & (F.col("image_id") == key)).drop(*HIDDEN)


def get_many(spark: SparkSession, path: str, keys: DataFrame, **sizes) -> DataFrame:
    """(image_id, found, width, height, hist, gray) for each distinct key asked for, also for those not in the table.

    Only buckets that some key falls into are read, and only rows of the keys reach a join by version; keys are
    sent to the tasks when few. No more bucket numbers than the table has buckets reach the driver.
    """
    stored, (numbers, buckets) = _stored(spark, path), versions(spark, path)
    asked = keys.select(F.col("image_id").cast(stored.schema["image_id"].dataType)).filter("image_id is not null")
    asked = materialise(_placed(asked.distinct(), buckets).select("image_id", "bucket"), "asked-keys")
    touched = [r["bucket"] for r in asked.select("bucket").distinct().collect()]
    wanted = asked.select("image_id")
    wanted = F.broadcast(wanted) if within_broadcast(wanted, **sizes) else wanted
    rows = _living(stored.filter(F.col("bucket").isin(touched)).join(wanted, "image_id", "left_semi"), numbers[0])
    rows = rows.drop("version", *LAYOUT).withColumn("found", ~F.col("deleted")).drop("deleted")
    told = asked.select("image_id").join(rows, "image_id", "left")
    return told.select("image_id", F.coalesce("found", F.lit(False)).alias("found"), *COLUMNS[1:])


def exists(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path)[0]) and not scan(spark, path).isEmpty()


def count(spark: SparkSession, path: str) -> DataFrame:
    return scan(spark, path).agg(F.count("*").alias("images"))


def ingest(
    spark: SparkSession,
    path: str,
    images: DataFrame,
    buckets: int = BUCKETS,
    order: str | None = None,
    batch: str | None = None,
) -> None:
    """Packed images into the table with their histograms, creating it on first use.

    ``buckets`` counts only when the table is created. The last image per key by ``order`` counts; without it
    a key may not repeat. ``batch`` marks the write: one whose mark is published already does nothing.
    """
    if batch and has_batch(spark, path, batch):
        return
    ordered = [order] if order else []
    rows = with_histogram(images).select(*COLUMNS, *ordered)
    if versions(spark, path)[0]:
        put(spark, path, rows, order, batch)
    else:
        create(rows, path, buckets, order, batch)


def upload(
    spark: SparkSession, path: str, scanned: DataFrame, grays: DataFrame, buckets: int = BUCKETS, order: str | None = None
) -> DataFrame:
    """Scanned files into the table; (status, images) counts what was stored and what could not be read.

    scanned: files with their size, -1 where they are broken; grays: the packed images of the others.
    """
    ingest(spark, path, grays, buckets, order)
    return outcome_counters(with_status(scanned))
