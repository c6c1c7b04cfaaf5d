"""Image files, packed images, histogram text and result files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.functions import histograms as H
from lumagrid.functions.gray import srgb_of_linear
from lumagrid.functions.text import file_name
from lumagrid.operators.cells import binary_cells

# Fixed value: the extensions counted as images, in any case.
IMAGE_GLOB = "*.{[jJ][pP][gG],[jJ][pP][eE][gG],[pP][nN][gG],[bB][mM][pP]}"


IMAGE_SCHEMA = (
    "image struct<origin: string, height: int, width: int, nChannels: int, mode: int, data: binary>"
)


def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    """(image_id, width, height, channels, data) of one folder level; width -1 marks a bad file."""
    reader = spark.read.format("image").option("pathGlobFilter", IMAGE_GLOB)
    try:
        return _decoded(reader.load(folder))
    except Exception as failure:
        if "PATH_NOT_FOUND" not in str(failure):
            raise
        return _decoded(spark.createDataFrame([], IMAGE_SCHEMA))


def stream_images(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream of the files that arrive."""
    reader = spark.readStream.format("image").schema(IMAGE_SCHEMA)
    return _decoded(reader.option("pathGlobFilter", IMAGE_GLOB).load(folder))


def _decoded(raw: DataFrame) -> DataFrame:
    return raw.select(
        file_name(F.col("image.origin")).alias("image_id"),
        F.col("image.width").alias("width"),
        F.col("image.height").alias("height"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    )


def readable(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col("width") > 0)


def rejects(scanned: DataFrame) -> DataFrame:
    """Names of files that could not be decoded."""
    return scanned.filter(F.col("width") <= 0).select("image_id")


def _gray_kernel(mode: str):
    table = srgb_of_linear() if mode == "srgb" else None

    @F.arrow_udf("binary")
    def to_gray(data: pa.Array, channels: pa.Array) -> pa.Array:
        out = []
        for cell, many in zip(binary_cells(data), channels.to_pylist()):
            if many == 1 and table is None:
                out.append(cell.tobytes())
                continue
            if many == 1:
                r = g = b = table[cell]
            else:
                b, g, r = (cell.reshape(-1, many)[:, c] for c in range(3))
            out.append((0.299 * r + 0.587 * g + 0.114 * b).astype("uint8").tobytes())
        return pa.array(out, pa.binary())

    return to_gray.asNondeterministic()


def gray_images(scanned: DataFrame, mode: str = "srgb") -> DataFrame:
    """Packed images (image_id, width, height, gray) from decoded files; alpha is ignored."""
    if mode not in ("srgb", "raw"):
        raise ValueError("gray mode must be 'srgb' or 'raw'")
    return readable(scanned).select(
        "image_id", "width", "height", _gray_kernel(mode)("data", "channels").alias("gray")
    )


def write_files(files: DataFrame, folder: str) -> None:
    """Write (name, content) rows as files of a shared folder, each from the task that holds it."""

    def put(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        target, root = fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        target.create_dir(root)
        for part in parts:
            names = part.column("name").to_pylist()
            for name, content in zip(names, part.column("content").to_pylist()):
                with target.open_output_stream(f"{root}/{name}") as sink:
                    sink.write(content)
            yield pa.RecordBatch.from_pydict({"files": pa.array([len(names)], pa.int64())})

    files.select("name", "content").mapInArrow(put, "files bigint").agg(F.sum("files")).collect()


def bitmap(width: int, height: int, gray: Column) -> Column:
    """Uncompressed 24-bit bitmap of array-of-int gray values; size is fixed per call."""
    pad = -(3 * width) % 4
    size = 54 + height * (3 * width + pad)
    head = b"BM" + size.to_bytes(4, "little") + bytes(4) + (54).to_bytes(4, "little")
    head += (40).to_bytes(4, "little") + width.to_bytes(4, "little") + height.to_bytes(4, "little")
    head += (1).to_bytes(2, "little") + (24).to_bytes(2, "little") + bytes(24)
    row = lambda y: F.concat(
        F.array_join(
            F.transform(
                F.slice(gray, y * width + 1, width), lambda v: F.repeat(F.lpad(F.hex(v), 2, "0"), F.lit(3))
            ),
            "",
        ),
        F.lit("00" * pad),
    )
    rows = F.transform(F.sequence(F.lit(height - 1), F.lit(0), F.lit(-1)), row)
    return F.unhex(F.concat(F.lit(head.hex()), F.array_join(rows, "")))


def write_packed(images: DataFrame, path: str, files: int | None = None) -> None:
    """Many small images into few Parquet files: ``files`` of them, or as many as their size asks for."""
    packed = images.repartition(files) if files else images.hint("rebalance")
    packed.sortWithinPartitions("image_id").write.parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_sequence_files(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of packed files in the older key/bytes format."""
    pairs = spark.sparkContext.sequenceFile(path)
    return spark.createDataFrame(
        pairs.map(lambda kv: (kv[0], bytes(kv[1]))), "name string, content binary"
    )


def write_hist_text(library: DataFrame, path: str) -> None:
    """``name <tab> n0,n1,...`` lines."""
    library.select(
        F.col("image_id").cast("string").alias("name"), H.to_csv(F.col("hist")).alias("csv")
    ).write.option("sep", "\t").option("quote", "").csv(path)


def read_hist_text(spark: SparkSession, path: str, trim: bool = True) -> DataFrame:
    """(name, hist); hist is null where the text is no histogram."""
    lines = (
        spark.read.schema("name string, csv string")
        .option("sep", "\t")
        .option("quote", "")
        .option("maxCharsPerColumn", "-1")
        .csv(path)
    )
    return lines.select("name", H.from_csv(F.col("csv"), trim).alias("hist"))


def write_results_text(results: DataFrame, path: str) -> None:
    """Key and value columns as tab-separated text."""
    results.write.option("sep", "\t").csv(path)


def export_results(results: DataFrame, path: str, form: str = "json") -> None:
    """Results as JSON (nested columns keep their shape) or CSV (flat columns only)."""
    if form == "json":
        results.write.json(path)
    elif form == "csv":
        results.write.option("header", True).csv(path)
    else:
        raise ValueError("form must be 'json' or 'csv'")
