"""Every operator as a query over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.functions import gray as G
from lumagrid.functions import histograms as H
from lumagrid.functions import text as X
from lumagrid.operators import (
    clusters,
    duplicates,
    families,
    feature,
    histogram,
    recency,
    search,
    summary,
    tamper,
    tasklog,
)
from lumagrid.operators.pixels import pixel_table
from lumagrid.plans import inputs, jobs
from lumagrid.session import fresh_dir, is_folder, materialise, tune
from lumagrid.sources import files, table
from lumagrid.streaming.ingest import ingest_stream
from lumagrid.streaming.monitor import open_task_alerts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(tune(spark), folder)

    run.__name__, run.__doc__ = function.__name__, function.__doc__
    QUERIES[function.__name__] = run
    return function


# ------------------------------------------------------------------ pixels


@query
def pixels(spark, folder):
    """The pixel table of all documents, told by sums per image that any moved pixel would change."""
    spot = (F.col("x") + 1) * (F.col("y") + 1)
    return (
        pixel_table(inputs.doc_images(spark, folder))
        .groupBy("image_id", "width", "height")
        .agg(
            F.count("*").alias("pixels"),
            F.sum("gray").alias("gray_sum"),
            F.sum(F.col("x") * F.col("gray")).alias("x_sum"),
            F.sum(F.col("y") * F.col("gray")).alias("y_sum"),
            F.sum(spot.cast("bigint") * F.col("gray") * F.col("gray")).alias("spot_sum"),
        )
    )


@query
def gray_from_rgb(spark, folder):
    colours = inputs.rgb_pixels(spark, folder)
    gray = G.luma(*G.unpack_rgb(F.col("rgb")))
    return histogram.histogram_bins(colours.select("image_id", gray.alias("gray")))


@query
def gray_lut(spark, folder):
    bins = histogram.histogram_bins(pixel_table(inputs.doc_images(spark, folder)))
    shown = G.one_channel_gray(F.col("gray"))
    return bins.groupBy("image_id", shown.alias("shown")).agg(F.sum("n").alias("n"))


# -------------------------------------------------------------- histograms


@query
def histogram_bins(spark, folder):
    return histogram.histogram_bins(pixel_table(inputs.doc_images(spark, folder)))


@query
def histogram_dense(spark, folder):
    library = jobs.generate_histograms(inputs.doc_images(spark, folder))
    return library.select("image_id", "width", "height", H.to_csv(F.col("hist")).alias("csv"))


@query
def histogram_dense_from_bins(spark, folder):
    dense = histogram.dense_histogram(histogram.histogram_bins(pixel_table(inputs.vec_images(spark, folder))))
    return dense.select("image_id", H.to_csv(F.col("hist")).alias("csv"))


@query
def histogram_summary(spark, folder):
    return histogram.histogram_summary(jobs.generate_histograms(inputs.doc_images(spark, folder)))


@query
def histogram_detail(spark, folder):
    library = jobs.generate_histograms(inputs.vec_images(spark, folder))
    detail = H.detail_text(F.col("image_id"), F.col("width"), F.col("height"), F.col("hist"))
    return library.select("image_id", detail.alias("detail"))


@query
def histogram_clusters(spark, folder):
    library = jobs.generate_histograms(inputs.doc_images(spark, folder))
    return clusters.histogram_clusters(materialise(library, "histograms"))


@query
def content_clusters(spark, folder):
    return clusters.content_clusters(jobs.generate_histograms(inputs.doc_images(spark, folder)))


@query
def hist_parse(spark, folder):
    """Document texts read as histogram text, and embeddings as numbers with blanks around."""
    docs = inputs.read(spark, folder, "documents").select(
        F.col("doc_id").alias("id"), F.lit("text").alias("kind"), F.col("text").alias("csv")
    )
    spaced = F.array_join(F.transform("values", lambda v: F.concat(F.lit(" "), v.cast("string"))), ",")
    vecs = inputs.vec_values(spark, folder)
    short = vecs.select(F.col("image_id").alias("id"), F.lit("short").alias("kind"), spaced.alias("csv"))
    long = vecs.select(
        F.col("image_id").alias("id"), F.lit("long").alias("kind"), F.array_join(F.array_repeat(spaced, 5), ",").alias("csv")
    )
    rows = docs.unionByName(short).unionByName(long)
    parsed = rows.select("id", "kind", H.from_csv(F.col("csv")).alias("hist"))
    return parsed.filter(F.col("hist").isNotNull()).select("id", "kind", H.to_csv(F.col("hist")).alias("csv"))


@query
def hist_text_roundtrip(spark, folder):
    path = fresh_dir(spark, "hist-text")
    files.write_hist_text(jobs.generate_histograms(inputs.doc_images(spark, folder)), path)
    back = files.read_hist_text(spark, path)
    return back.select(F.col("name").cast("bigint").alias("image_id"), H.to_csv(F.col("hist")).alias("csv"))


# ------------------------------------------------------------------ search


def _query_image(images: DataFrame) -> DataFrame:
    return images.filter(F.col("image_id") == 0)


@query
def hist_search(spark, folder):
    bins = histogram.histogram_bins(pixel_table(inputs.vec_images(spark, folder)))
    probe = histogram.histogram_bins(pixel_table(_query_image(inputs.vec_images(spark, folder))))
    return search.search_bins(bins, probe)


@query
def hist_search_dense(spark, folder):
    images = inputs.doc_images(spark, folder)
    return jobs.search_images(_query_image(images), images)


@query
def hist_search_stored(spark, folder):
    """The same search in stored histograms that are ordered by their summaries."""
    library = jobs.generate_histograms(inputs.doc_images(spark, folder))
    path = fresh_dir(spark, "summaries")
    summary.write(library, path)
    return summary.search_stored(spark, path, _query_image(spark.read.parquet(path)))


@query
def hist_search_multi(spark, folder):
    library = jobs.generate_histograms(inputs.doc_images(spark, folder))
    queries = jobs.generate_histograms(inputs.benchmark_images(spark, folder))
    return search.search_many(library, queries.withColumnRenamed("image_id", "query_id"))


@query
def histogram_plates(spark, folder):
    """Histograms of 512 x 512 images."""
    library = jobs.generate_histograms(inputs.plate_images(spark, folder))
    return library.select("image_id", H.to_csv(F.col("hist")).alias("csv"))


@query
def search_plates(spark, folder):
    """Whole-image search among 512 x 512 images."""
    plates = materialise(inputs.plate_images(spark, folder), "plates")
    return jobs.search_images(_query_image(plates), plates)


@query
def duplicate_pairs(spark, folder):
    return duplicates.duplicate_pairs(jobs.generate_histograms(inputs.doc_images(spark, folder)))


@query
def duplicate_families(spark, folder):
    return families.duplicate_families(jobs.generate_histograms(inputs.doc_images(spark, folder)))


@query
def duplicate_copies(spark, folder):
    library = jobs.generate_histograms(inputs.doc_images(spark, folder))
    return duplicates.copies(library)


# ----------------------------------------------------------------- feature


def _hits(spark, folder, threshold=0.95, mode="score"):
    return feature.feature_search(
        inputs.doc_images(spark, folder), inputs.doc_features(spark, folder), threshold, mode
    )


@query
def feature_search(spark, folder):
    return _hits(spark, folder).drop("matching")


@query
def feature_images(spark, folder):
    return feature.feature_images(_hits(spark, folder))


@query
def feature_images_all(spark, folder):
    features = inputs.doc_features(spark, folder)
    return feature.feature_images(_hits(spark, folder), inputs.doc_images(spark, folder), features=features)


@query
def feature_locations(spark, folder):
    return feature.location_text(_hits(spark, folder))


@query
def feature_first(spark, folder):
    return jobs.first_hits(feature.feature_images(_hits(spark, folder)))


@query
def feature_search_count(spark, folder):
    hits = _hits(spark, folder, 0.9, "count")
    return hits.groupBy("feature_id", "image_id").agg(F.count("*").alias("match_count"))


@query
def watermark_images(spark, folder):
    return feature.feature_images(_hits(spark, folder, 0.98)).select("feature_id", "image_id", "match_count")


@query
def feature_search_many(spark, folder):
    """The first 30 bytes of each benchmark item as a template; small batches, so that they go block by block."""
    features = inputs.benchmark_images(spark, folder).select(
        F.col("image_id").alias("feature_id"),
        F.lit(30).alias("width"),
        F.lit(1).alias("height"),
        F.substring("gray", 1, 30).alias("gray"),
    )
    return feature.feature_search(inputs.doc_images(spark, folder), features, max_batch=64, block_bytes=600)


@query
def feature_plates(spark, folder):
    """A 64 x 64 template over 512 x 512 images, the sizes of the published timings."""
    plates = materialise(inputs.plate_images(spark, folder), "plates")
    return feature.feature_search(plates, inputs.crop(plates, 0, 0, 100, 200, 64, 64)).drop("matching")


# ------------------------------------------------------------------ tamper


def _compared(spark, folder):
    return tamper.tamper_pixels(inputs.doc_images(spark, folder), inputs.doc_suspects(spark, folder))


@query
def tamper_pixels(spark, folder):
    return _compared(spark, folder).select("suspect_id", "image_id", "x", "y", "differs")


@query
def tamper_blocks(spark, folder):
    return tamper.tamper_blocks(_compared(spark, folder)).select("suspect_id", "image_id", "bx", "by", "diff", "pixels")


@query
def tamper_regions(spark, folder):
    return tamper.regions(tamper.detect(inputs.doc_images(spark, folder), inputs.doc_suspects(spark, folder)))


@query
def tamper_rank(spark, folder):
    """A 512 x 512 suspect against all plates, which share its size."""
    plates = materialise(inputs.plate_images(spark, folder), "plates")
    suspect = _query_image(plates).withColumnRenamed("image_id", "suspect_id")
    return tamper.ranking(tamper.detect(plates, suspect)).drop("suspect_id")


@query
def tamper_rank_pixels(spark, folder):
    """The same ranking from pixel rows, for 8 x 8 images."""
    images = inputs.vec_images(spark, folder)
    suspect = _query_image(images).withColumnRenamed("image_id", "suspect_id")
    compared = tamper.tamper_pixels(images, suspect)
    return tamper.block_ranking(tamper.tamper_blocks(compared)).drop("suspect_id")


def _item_suspects(spark, folder):
    return inputs.benchmark_images(spark, folder).withColumnRenamed("image_id", "suspect_id")


@query
def tamper_rank_many(spark, folder):
    """Every benchmark item against all documents of its size, in cells of eight images on either side."""
    images, suspects = inputs.doc_images(spark, folder), _item_suspects(spark, folder)
    found = tamper.detect(images, suspects, exclude_self=False, max_rows=1, rows_per_slice=8)
    return found.withColumn("region_count", F.size("regions")).drop("regions")


@query
def tamper_regions_banded(spark, folder):
    """Merged regions of images in bands of two block rows, which the regions cross."""
    images, suspects = inputs.doc_images(spark, folder), _item_suspects(spark, folder)
    found = tamper.detect(images, suspects, exclude_self=False, merge=True, band_pixels=32 * 32)
    return tamper.regions(found)


@query
def tamper_report(spark, folder):
    verdicts = tamper.detect(
        inputs.doc_images(spark, folder), inputs.doc_suspects(spark, folder), exclude_self=False
    )
    boxes = F.transform(
        "regions_top",
        lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start_x", "start_y", "end_x", "end_y", "pixel_count")]),
    )
    return tamper.report(verdicts).select(
        "suspect_id",
        "image_id",
        "rank",
        "matching_pixels",
        "total_pixels",
        "similarity",
        "region_count",
        "regions_more",
        F.array_join(boxes, ";").alias("regions_top"),
    )


@query
def tamper_best_per_key(spark, folder):
    verdicts = tamper.detect(inputs.doc_images(spark, folder), inputs.doc_suspects(spark, folder))
    return tamper.best_per_image(verdicts)


@query
def tamper_regions_merged(spark, folder):
    verdicts = tamper.detect(
        inputs.doc_images(spark, folder), inputs.doc_suspects(spark, folder), exclude_self=False, merge=True
    )
    return tamper.regions(verdicts)


@query
def tamper_percent(spark, folder):
    """Shares as text, beside the suspect's own row."""
    verdicts = tamper.detect(
        inputs.doc_images(spark, folder), inputs.doc_suspects(spark, folder), exclude_self=False
    )
    return verdicts.select("suspect_id", "image_id", X.percent(F.col("similarity")).alias("share"))


# ------------------------------------------------------------- image table


BUCKETS = 8  # few, for tables of test size


def _stored(spark, folder) -> str:
    path = fresh_dir(spark, "image-table")
    table.ingest(spark, path, inputs.doc_images(spark, folder), BUCKETS)
    return path


def _sizes(rows: DataFrame) -> DataFrame:
    return rows.select("image_id", "width", "height", H.total(F.col("hist")).alias("pixels"))


@query
def batch_ingest(spark, folder):
    return _sizes(table.scan(spark, _stored(spark, folder)))


@query
def hist_scan(spark, folder):
    rows = table.hist_scan(spark, _stored(spark, folder))
    return rows.select("image_id", "width", "height", H.to_csv(F.col("hist")).alias("csv"))


@query
def image_upsert(spark, folder):
    path = _stored(spark, folder)
    table.ingest(spark, path, inputs.vec_images(spark, folder))
    return _sizes(table.scan(spark, path))


@query
def image_last_write(spark, folder):
    """Keys that repeat within a batch and across two batches: the last row of the last batch counts."""
    rows = inputs.doc_images(spark, folder).withColumn("seq", F.col("image_id"))
    path = fresh_dir(spark, "image-table")
    for per_key in (2, 3):  # both batches hold all rows; the second has fewer keys
        batch = rows.withColumn("image_id", F.expr(f"seq div {per_key}"))
        table.ingest(spark, path, batch, BUCKETS, order="seq")
    table.compact(spark, path, BUCKETS * 2)
    return _sizes(table.scan(spark, path))


@query
def image_last_write_all(spark, folder):
    """As ``image_last_write``, with every row in one of the batches at least, and as many keys as half the rows."""
    rows = inputs.doc_images(spark, folder).withColumn("seq", F.col("image_id"))
    rows = rows.withColumn("image_id", F.expr("seq div 2"))
    path = fresh_dir(spark, "image-table")
    for batch in (rows.filter("seq % 3 <> 2"), rows.filter("seq % 3 <> 0")):
        table.ingest(spark, path, batch, BUCKETS, order="seq")
    table.compact(spark, path, BUCKETS * 2)
    return _sizes(table.scan(spark, path))


@query
def batch_upload(spark, folder):
    scanned = materialise(_image_files(spark, folder), "scanned-files")  # each file is opened once
    path = fresh_dir(spark, "image-table")
    return table.upload(spark, path, scanned, files.gray_images(scanned), BUCKETS)


@query
def image_delete(spark, folder):
    path = _stored(spark, folder)
    keys = inputs.read(spark, folder, "labels").select(F.col("doc_id").alias("image_id"))
    table.delete(spark, path, keys)
    return _sizes(table.scan(spark, path))


@query
def image_get(spark, folder):
    return table.get(spark, _stored(spark, folder), 7).select("image_id", "width", "height", F.hex("gray").alias("gray"))


@query
def image_get_many(spark, folder):
    """All labelled documents after some were deleted, and keys past the end of the table."""
    path = _stored(spark, folder)
    labels = inputs.read(spark, folder, "labels")
    table.delete(spark, path, labels.filter("quality = 0").select(F.col("doc_id").alias("image_id")))
    past = labels.select((-F.col("doc_id") - 1).alias("image_id"))
    found = table.get_many(spark, path, labels.select(F.col("doc_id").alias("image_id")).unionByName(past))
    return found.select("image_id", "found", "width", "height", H.total(F.col("hist")).alias("pixels"))


@query
def image_exists(spark, folder):
    return spark.range(1).select(F.lit(table.exists(spark, _stored(spark, folder))).alias("has_images"))


@query
def image_count(spark, folder):
    return table.count(spark, _stored(spark, folder))


@query
def pack_images(spark, folder):
    path = fresh_dir(spark, "packed")
    files.write_packed(inputs.doc_images(spark, folder), path)
    back = files.read_packed(spark, path)
    return back.select("image_id", "width", "height", F.md5("gray").alias("digest"))


def _two_sources(spark, folder):
    sizes = lambda images: images.select("image_id", "width", "height")
    return sizes(inputs.doc_images(spark, folder)), sizes(inputs.vec_images(spark, folder))


@query
def library_union(spark, folder):
    return table.library_union(*reversed(_two_sources(spark, folder)))


@query
def library_join(spark, folder):
    stored, found = _two_sources(spark, folder)
    return table.library_join(found, stored)


@query
def library_status(spark, folder):
    return table.library_status(table.library_union(*reversed(_two_sources(spark, folder))))


@query
def library_list(spark, folder):
    return table.library_list(inputs.doc_images(spark, folder))


@query
def processed_images(spark, folder):
    turns = inputs.read(spark, folder, "conversations").select(F.col("conv_id").alias("image_id"))
    return table.processed_images(turns)


# ------------------------------------------------------------- image files


def _image_files(spark, folder) -> DataFrame:
    """Embedding images written as bitmaps; those of label 0 are broken files."""
    path = fresh_dir(spark, "image-files")
    vecs = inputs.vec_values(spark, folder)
    ending = F.when(F.col("label") > 4, ".BMP").otherwise(".bmp")
    whole = files.bitmap(8, 8, F.col("values"))
    content = F.when(F.col("label") == 0, F.substring(whole, 1, 20)).otherwise(whole)
    name = F.concat(F.col("image_id").cast("string"), ending)
    files.write_files(vecs.select(name.alias("name"), content.alias("content")), path)
    return files.scan_images(spark, path)


def _file_id():
    return F.split("image_id", r"\.")[0].cast("bigint").alias("image_id")


@query
def scan_images(spark, folder):
    grays = files.gray_images(_image_files(spark, folder))
    return pixel_table(grays.withColumn("image_id", _file_id()))


@query
def decode_rejects(spark, folder):
    return files.rejects(_image_files(spark, folder)).select(_file_id())


@query
def ingest_counters(spark, folder):
    return table.outcome_counters(table.with_status(_image_files(spark, folder)))


@query
def export_results(spark, folder):
    path = fresh_dir(spark, "export")
    verdicts = tamper.detect(inputs.doc_images(spark, folder), inputs.doc_suspects(spark, folder))
    files.export_results(verdicts, path)
    back = spark.read.schema(verdicts.schema).json(path)
    return back.select("suspect_id", "image_id", "matching_pixels", "similarity", F.size("regions").alias("region_count"))


# ---------------------------------------------------------------- task log


@query
def log_roundtrip(spark, folder):
    path = fresh_dir(spark, "task-log")
    tasklog.append(inputs.task_log(spark, folder), path)
    return tasklog.parse_lines(tasklog.read_log(spark, path))


@query
def log_parse(spark, folder):
    return tasklog.parse_lines(inputs.task_lines(spark, folder))


@query
def log_rejects(spark, folder):
    return tasklog.rejected_lines(inputs.task_lines(spark, folder))


@query
def log_plain_latest(spark, folder):
    """From a log without numbers, in which tasks have several records per second."""
    path = fresh_dir(spark, "plain-log")
    ordered = inputs.task_log(spark, folder).withColumn("ts", F.substring("ts", 1, 10)).orderBy("seq")
    tasklog.append(ordered.withColumn("ts", F.concat("ts", F.lit(" 00:00:00"))), path, numbered=False)
    records = tasklog.parse_lines(tasklog.read_plain_log(spark, path))
    return tasklog.latest(records).select("task_id", "task_type", "status", "details")


@query
def log_latest(spark, folder):
    return tasklog.latest(inputs.task_log(spark, folder)).select("task_id", "status")


@query
def log_incomplete(spark, folder):
    return tasklog.incomplete(inputs.task_log(spark, folder)).select("task_id", "status")


@query
def log_redo(spark, folder):
    return tasklog.incomplete(inputs.task_log(spark, folder)).select("task_id", "task_type", "details")


@query
def log_summary(spark, folder):
    return tasklog.summary(inputs.task_log(spark, folder))


@query
def log_tail(spark, folder):
    return tasklog.tail(inputs.task_log(spark, folder))


# ----------------------------------------------------------------- recency


@query
def recent_results(spark, folder):
    recent = recency.recent_results(inputs.access_log(spark, folder))
    return recent.select("result_key", "last_access", "accesses")


@query
def recent_results_live(spark, folder):
    recent = recency.recent_live(inputs.access_log(spark, folder))
    return recent.select("result_key", "last_access", "expired")


@query
def access_stats(spark, folder):
    return recency.access_stats(inputs.access_log(spark, folder))


@query
def result_reuse(spark, folder):
    log = inputs.access_log(spark, folder)
    return recency.reuse(log.filter(F.col("op") == "get"), log.filter(F.col("op") == "put"))


@query
def result_reuse_pieces(spark, folder):
    """The same in pieces of 256 numbers, whose writes are handed on."""
    log = inputs.access_log(spark, folder)
    return recency.reuse(log.filter(F.col("op") == "get"), log.filter(F.col("op") == "put"), piece=256)


@query
def result_misses(spark, folder):
    return recency.misses(result_reuse(spark, folder))


@query
def result_preview(spark, folder):
    docs = inputs.read(spark, folder, "documents")
    return docs.select("doc_id", X.preview(F.col("text")).alias("preview"))


@query
def result_keys(spark, folder):
    labels = inputs.read(spark, folder, "documents")
    name = F.col("doc_id")
    return labels.select(
        "doc_id",
        X.search_key(name).alias("search_key"),
        X.local_key(name, F.lit(0.95)).alias("local_key"),
        X.tamper_key(name, F.lit(20)).alias("tamper_key"),
    )


# --------------------------------------------------------------- streaming


def _stream_of(spark, folder, name):
    """A stream of the files of a table, which is one file or a folder of them."""
    reader = spark.readStream.schema(inputs.read(spark, folder, name).schema)
    path = f"{folder}/{name}.parquet"
    if is_folder(spark, path):
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


@query
def stream_ingest(spark, folder):
    path = fresh_dir(spark, "streamed-table")
    docs = _stream_of(spark, folder, "documents")
    images = inputs.as_images(
        docs.select(F.col("doc_id").alias("image_id"), F.col("text").cast("binary").alias("data")), inputs.TEXT_WIDTH
    )
    ingest_stream(images, path, fresh_dir(spark, "stream-progress"), BUCKETS).awaitTermination()
    return _sizes(table.scan(spark, path))


@query
def stream_open_tasks(spark, folder):
    path = fresh_dir(spark, "alerts")
    events = _stream_of(spark, folder, "events")
    log = inputs.event_records(events).select("task_id", "seq", F.col("at").cast("timestamp").alias("ts"), "status")
    alerts = open_task_alerts(log, order="seq")
    (
        alerts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", fresh_dir(spark, "stream-progress"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(alerts.schema).parquet(path)
