"""Images and logs derived, inside each query, from the tables at hand.

The bytes of a text are taken as gray values: a whole text is one image, the last row filled
with zeros. Nothing is cut off and no row is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.operators.pixels import byte_values, pack_values
from lumagrid.session import spread

TEXT_WIDTH = 32
PLATE = 512
TEXTS_PER_PLATE = 100


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_images(rows: DataFrame, width: int) -> DataFrame:
    """Packed images from (image_id, data)."""
    height = F.expr(f"cast((length(data) + {width - 1}) div {width} as int)")
    return (
        rows.filter(F.length("data") > 0)
        .withColumn("height", height)
        .select(
            "image_id",
            F.lit(width).alias("width"),
            "height",
            F.expr(f"rpad(data, {width} * height, X'00')").alias("gray"),
        )
    )


def doc_images(spark: SparkSession, folder: str) -> DataFrame:
    """One image per document, 32 wide."""
    docs = spread(read(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    return as_images(docs.select(F.col("doc_id").alias("image_id"), F.col("text").cast("binary").alias("data")), TEXT_WIDTH)


def benchmark_images(spark: SparkSession, folder: str) -> DataFrame:
    """One image per benchmark item, 32 wide."""
    items = read(spark, folder, "benchmark")
    return as_images(items.select(F.col("item_id").alias("image_id"), F.col("text").cast("binary").alias("data")), TEXT_WIDTH)


def vec_values(spark: SparkSession, folder: str) -> DataFrame:
    """(image_id, label, values): 64 gray values per embedding."""
    gray = F.transform(
        "embedding",
        lambda v: F.greatest(
            F.lit(0), F.least(F.lit(255), F.floor((v.cast("double") + 0.5) * 255.0).cast("int"))
        ),
    )
    return spread(read(spark, folder, "embeddings"), "vec_id").select(
        F.col("vec_id").alias("image_id"), "label", gray.alias("values")
    )


def vec_images(spark: SparkSession, folder: str) -> DataFrame:
    """One 8 x 8 image per embedding."""
    return vec_values(spark, folder).select(
        "image_id", F.lit(8).alias("width"), F.lit(8).alias("height"), pack_values("values").alias("gray")
    )


def plate_images(spark: SparkSession, folder: str) -> DataFrame:
    """512 x 512 images: the texts of a hundred neighbouring documents in a row, cut into plates."""
    text = F.expr("listagg(text, '') within group (order by doc_id)")
    sheets = (
        read(spark, folder, "documents")
        .groupBy(F.expr(f"doc_id div {TEXTS_PER_PLATE}").alias("sheet"))
        .agg(text.cast("binary").alias("data"))
    )
    area = PLATE * PLATE
    last = F.expr(f"cast((length(data) - 1) div {area} as int)")
    return sheets.select("sheet", "data", F.explode(F.sequence(F.lit(0), last)).alias("n")).select(
        (F.col("sheet") * 1000000 + F.col("n")).alias("image_id"),
        F.lit(PLATE).alias("width"),
        F.lit(PLATE).alias("height"),
        F.expr(f"rpad(substring(data, n * {area} + 1, {area}), {area}, X'00')").alias("gray"),
    )


def crop(images: DataFrame, image_id: int, feature_id: int, x: int, y: int, w: int, h: int) -> DataFrame:
    """A feature cut from one image."""
    rows = F.transform(
        F.sequence(F.lit(y), F.lit(y + h - 1)),
        lambda r: F.hex(F.substring("gray", r * F.col("width") + x + 1, F.lit(w))),
    )
    cut = images.filter(F.col("image_id") == image_id).select(F.unhex(F.array_join(rows, "")).alias("gray"))
    return cut.select(
        F.lit(feature_id).cast("bigint").alias("feature_id"),
        F.lit(w).alias("width"),
        F.lit(h).alias("height"),
        "gray",
    )


def doc_features(spark: SparkSession, folder: str) -> DataFrame:
    """Two templates cut from document 0."""
    images = doc_images(spark, folder)
    return crop(images, 0, 0, 8, 4, 6, 4).unionByName(crop(images, 0, 1, 0, 0, 8, 3))


def doc_suspects(spark: SparkSession, folder: str) -> DataFrame:
    """Document 0 as it is (id 0) and with a planted patch (id -1)."""
    plain = doc_images(spark, folder).filter(F.col("image_id") == 0)
    at = lambda i: (i % F.col("width"), F.floor(i / F.col("width")))

    def planted(sample, i):
        x, y = at(i)
        return F.when(
            x.between(4, 11) & y.between(16, 27), (F.ascii(sample) + 128) % 256
        ).otherwise(F.ascii(sample))

    patched = plain.withColumn("gray", pack_values(F.transform(byte_values("gray"), planted)))
    return plain.unionByName(patched.withColumn("image_id", F.lit(-1).cast("bigint"))).withColumnRenamed(
        "image_id", "suspect_id"
    )


def rgb_pixels(spark: SparkSession, folder: str) -> DataFrame:
    """(image_id, rgb): three text bytes in a row as one 24-bit colour."""
    data = F.col("text").cast("binary")
    docs = spread(read(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    docs = docs.select(F.col("doc_id").alias("image_id"), data.alias("data"))
    docs = docs.withColumn("pixels", F.expr("cast((length(data) + 2) div 3 as int)")).filter("pixels > 0")
    docs = docs.select("image_id", F.expr("rpad(data, 3 * pixels, X'00')").alias("data"))
    samples = docs.select("image_id", byte_values("data").alias("s"))
    at = lambda i, c: F.ascii(F.get("s", i * 3 + c))
    colours = F.transform(
        F.sequence(F.lit(0), (F.size("s") / 3).cast("int") - 1),
        lambda i: F.shiftleft(at(i, 0), 16) + F.shiftleft(at(i, 1), 8) + at(i, 2),
    )
    return samples.select("image_id", F.explode(colours).alias("rgb"))


def event_records(events: DataFrame) -> DataFrame:
    """Task records from events, with the exact time ``at`` and the event's value."""
    status = (
        F.when(F.col("event_type").isin("view", "click"), "STARTED")
        .when(F.col("event_type") == "error", "FAILED")
        .otherwise("COMPLETED")
    )
    task = F.concat_ws("_", F.lit("TASK"), F.col("user_id").cast("string"), F.dayofmonth("ts").cast("string"))
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("ts").alias("at"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        task.alias("task_id"),
        F.col("event_type").alias("task_type"),
        status.alias("status"),
        F.col("props").alias("details"),
        "value",
    )


def task_log(spark: SparkSession, folder: str) -> DataFrame:
    """Task records from events."""
    return event_records(read(spark, folder, "events")).drop("at", "value")


def task_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Log lines from events, among them faulty ones: errors of large value lack their details,
    signups carry an unknown status, and views have a bar in their details."""
    head = F.concat_ws("|", "ts", "task_id", "task_type")
    line = (
        F.when((F.col("task_type") == "error") & (F.col("value") > 50), head)
        .when(F.col("task_type") == "signup", F.concat_ws("|", head, F.lit("PAUSED"), "details"))
        .when(F.col("task_type") == "view", F.concat_ws("|", head, "status", F.lit("a"), "details"))
        .otherwise(F.concat_ws("|", head, "status", "details"))
    )
    return event_records(read(spark, folder, "events")).select("seq", line.alias("line"))


def access_log(spark: SparkSession, folder: str) -> DataFrame:
    """(seq, ts, result_key, op) from events; purchases and signups write, the rest reads."""
    return read(spark, folder, "events").select(
        F.col("event_id").alias("seq"),
        "ts",
        F.concat(F.lit("SEARCH_"), F.col("user_id").cast("string")).alias("result_key"),
        F.when(F.col("event_type").isin("purchase", "signup"), "put").otherwise("get").alias("op"),
    )
