"""Gray histograms: from the pixel table by aggregation, from packed images by an Arrow kernel."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumagrid.functions import histograms as H
from lumagrid.operators.cells import binary_cells


def histogram_bins(pixels: DataFrame) -> DataFrame:
    """(image_id, gray, n): pixel count per gray value that occurs."""
    return pixels.groupBy("image_id", "gray").agg(F.count("*").alias("n"))


def dense_histogram(bins: DataFrame) -> DataFrame:
    """(image_id, hist): 256 counts, zero where a gray value does not occur."""
    grays = F.sequence(F.lit(0), F.lit(H.BINS - 1))
    # Repeating the map by reference has it built once per image, not once per gray value.
    counts = F.array_repeat(F.map_from_entries(F.collect_list(F.struct("gray", "n"))), H.BINS)
    zero = F.lit(0).cast("bigint")
    return bins.groupBy("image_id").agg(
        F.zip_with(grays, counts, lambda g, m: F.coalesce(F.try_element_at(m, g), zero)).alias("hist")
    )


@F.arrow_udf(T.ArrayType(T.LongType()))
def gray_histogram(gray: pa.Array) -> pa.Array:
    """256 counts per packed image."""
    cells = list(binary_cells(gray))
    counts = np.zeros((len(cells), 256), np.int64)
    for row, cell in enumerate(cells):
        counts[row] = np.bincount(cell, minlength=256)
    offsets = np.arange(0, 256 * len(cells) + 1, 256, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(counts.ravel()))


def with_histogram(images: DataFrame) -> DataFrame:
    """Packed images with a ``hist`` column; one pass, no shuffle."""
    return images.withColumn("hist", gray_histogram("gray"))


def histogram_summary(library: DataFrame) -> DataFrame:
    """Size, pixel count and number of gray values in use."""
    return library.select(
        "image_id",
        "width",
        "height",
        (F.col("width").cast("bigint") * F.col("height")).alias("total_pixels"),
        F.size(F.filter("hist", lambda n: n > 0)).alias("used_grays"),
    )
