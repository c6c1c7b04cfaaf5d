"""Tamper detection: a suspect image against every library image of the same size.

Two forms with equal results. The pixel form unfolds pairs of images into pixel rows and
aggregates them. The packed form compares whole images in an Arrow kernel and is the one for
large libraries; a batch of suspects beyond the broadcast bound, and images larger than a band, take the paths of
``tamper_cells``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumagrid import checks
from lumagrid.operators.cells import binary_cells
from lumagrid.operators import tamper_cells as cells
from lumagrid.operators.pixels import byte_values, image_lines
from lumagrid.sizing import BROADCAST_ROWS, pair_up, within_broadcast

BLOCK = 16
BLOCK_SHARE = 0.3
REGION = "start_x int, start_y int, end_x int, end_y int, pixel_count bigint"
VERDICT = f"struct<matching_pixels: bigint, regions: array<struct<{REGION.replace(' int', ': int').replace(' bigint', ': bigint')}>>>"


# ---------------------------------------------------------------- pixel form


def _same_size(library: DataFrame, suspects: DataFrame, exclude_self: bool, sizes: dict) -> DataFrame:
    """Packed library images beside the packed suspects of their size."""
    probes = suspects.select("suspect_id", "width", "height", F.col("gray").alias("suspect_gray"))
    return pair_up(
        library.select("image_id", "width", "height", "gray"),
        probes,
        ["width", "height"],
        "suspect_gray",
        F.col("image_id"),
        F.col("image_id") != F.col("suspect_id") if exclude_self else None,
        **sizes,
    )


def tamper_pixels(
    library: DataFrame,
    suspects: DataFrame,
    threshold: int = checks.TAMPER_THRESHOLD,
    exclude_self: bool = True,
    **sizes,
) -> DataFrame:
    """One row per compared pixel with a difference flag.

    Images meet by size while still packed; only pairs of one size are unfolded, both images in
    step, so pixels are never joined or shuffled.
    """
    checks.gray_step(threshold)
    samples = F.arrays_zip(byte_values("gray").alias("a"), byte_values("suspect_gray").alias("b"))
    pairs = _same_size(library, suspects, exclude_self, sizes)
    head = ["suspect_id", "image_id", "width", "height"]
    unfolded = image_lines(pairs.select(*head, "gray", "suspect_gray"), "gray", "suspect_gray").select(
        *head, "y", F.posexplode(samples).alias("x", "s")
    )
    gray, suspect_gray = F.ascii("s.a"), F.ascii("s.b")
    return unfolded.select(
        *head,
        "x",
        "y",
        gray.alias("gray"),
        suspect_gray.alias("suspect_gray"),
        (F.abs(gray - suspect_gray) > threshold).alias("differs"),
    )


def tamper_blocks(compared: DataFrame) -> DataFrame:
    """Differing pixels per 16 x 16 block; edge blocks keep their true size."""
    return compared.groupBy(
        "suspect_id",
        "image_id",
        "width",
        "height",
        F.expr(f"cast(x div {BLOCK} as int)").alias("bx"),
        F.expr(f"cast(y div {BLOCK} as int)").alias("by"),
    ).agg(F.sum(F.col("differs").cast("bigint")).alias("diff"), F.count("*").alias("pixels"))


def block_regions(blocks: DataFrame) -> DataFrame:
    """Blocks with more than 30 % differing pixels, as inclusive boxes."""
    end = lambda at, size: F.least(at * BLOCK + BLOCK, size) - 1
    return blocks.filter(F.col("diff") > F.lit(BLOCK_SHARE) * F.col("pixels")).select(
        "suspect_id",
        "image_id",
        (F.col("bx") * BLOCK).alias("start_x"),
        (F.col("by") * BLOCK).alias("start_y"),
        end(F.col("bx"), F.col("width")).alias("end_x"),
        end(F.col("by"), F.col("height")).alias("end_y"),
        F.col("diff").alias("pixel_count"),
    )


def block_ranking(blocks: DataFrame) -> DataFrame:
    """Matching pixels and share per image; the blocks partition the pixels."""
    matching = F.sum(F.col("pixels") - F.col("diff"))
    return (
        blocks.groupBy("suspect_id", "image_id")
        .agg(matching.alias("matching_pixels"), F.sum("pixels").alias("total_pixels"))
        .withColumn("similarity", F.col("matching_pixels") / F.col("total_pixels"))
    )


# --------------------------------------------------------------- packed form


def _block_sums(flags: np.ndarray) -> np.ndarray:
    h, w = flags.shape
    rows = np.add.reduceat(flags, np.arange(0, h, BLOCK), axis=0, dtype=np.int64)
    return np.add.reduceat(rows, np.arange(0, w, BLOCK), axis=1)


def _label_blocks(bad: np.ndarray) -> np.ndarray:
    """Number the 4-connected groups of marked blocks of one image (0 = not marked)."""
    labels = np.zeros(bad.shape, np.int64)
    found = 0
    for start in zip(*np.nonzero(bad)):
        if labels[start]:
            continue
        found += 1
        labels[start] = found
        front = [start]
        while front:
            y, x = front.pop()
            for ny, nx in ((y - 1, x), (y + 1, x), (y, x - 1), (y, x + 1)):
                inside = 0 <= ny < bad.shape[0] and 0 <= nx < bad.shape[1]
                if inside and bad[ny, nx] and not labels[ny, nx]:
                    labels[ny, nx] = found
                    front.append((ny, nx))
    return labels


def _bad_blocks(diff: np.ndarray, w: int, h: int) -> np.ndarray:
    """Blocks with more than the share of differing pixels; edge blocks have their true size."""
    bh, bw = diff.shape
    tall = np.minimum(np.arange(1, bh + 1) * BLOCK, h) - np.arange(bh) * BLOCK
    wide = np.minimum(np.arange(1, bw + 1) * BLOCK, w) - np.arange(bw) * BLOCK
    return diff > BLOCK_SHARE * np.outer(tall, wide)


def _boxes(diff: np.ndarray, w: int, h: int, top: int = 0, labels: np.ndarray | None = None) -> np.ndarray:
    """(start_x, start_y, end_x, end_y, pixel_count) of the marked blocks, or of the groups that ``labels`` makes of them."""
    by, bx = np.nonzero(_bad_blocks(diff, w, h) if labels is None else labels)
    count = diff[by, bx]
    low_y, low_x, top_y, top_x = by, bx, by, bx
    if labels is not None and len(by):
        group = labels[by, bx] - 1
        many = group.max() + 1
        low_y, low_x = np.full(many, diff.shape[0]), np.full(many, diff.shape[1])
        top_y, top_x = np.zeros(many, np.int64), np.zeros(many, np.int64)
        np.minimum.at(low_y, group, by), np.minimum.at(low_x, group, bx)
        np.maximum.at(top_y, group, by), np.maximum.at(top_x, group, bx)
        count = np.bincount(group, weights=count).astype(np.int64)
    ends = np.minimum(top_x * BLOCK + BLOCK, w) - 1, np.minimum(top_y * BLOCK + BLOCK, h) - 1
    return np.stack((low_x * BLOCK, low_y * BLOCK + top, ends[0], ends[1] + top, count), axis=1).astype(np.int64)


def _largest_first(boxes: np.ndarray) -> np.ndarray:
    """Regions by size, then in row order."""
    return boxes[np.lexsort((boxes[:, 0], boxes[:, 1], -boxes[:, 4]))]


def _differences(a: np.ndarray, b: np.ndarray, w: int, h: int, threshold: int) -> np.ndarray:
    """Differing pixels per block."""
    return _block_sums((np.where(a > b, a - b, b - a) > threshold).reshape(h, w))


def _compare_kernel(threshold: int, merge: bool):
    @F.arrow_udf(VERDICT)
    def compare(gray: pa.Array, suspect: pa.Array, width: pa.Array, height: pa.Array) -> pa.Array:
        matching, regions = [], []
        sizes = zip(width.to_pylist(), height.to_pylist())
        for a, b, (w, h) in zip(binary_cells(gray), binary_cells(suspect), sizes):
            diff = _differences(a, b, w, h, threshold)
            matching.append(w * h - int(diff.sum()))
            labels = _label_blocks(_bad_blocks(diff, w, h)) if merge else None
            regions.append(_largest_first(_boxes(diff, w, h, labels=labels)))
        return pa.StructArray.from_arrays(
            [pa.array(matching, pa.int64()), cells.region_lists(regions)], names=["matching_pixels", "regions"]
        )

    # Kept from being planned twice by filters inferred from its result.
    return compare.asNondeterministic()


def _in_cells(library, suspects, threshold, exclude_self, merge, cell_rows, band_pixels) -> DataFrame:
    """Verdicts by the two-sided grid; with ``band_pixels`` for images that are cut into bands."""
    regions = T.StructField("regions", T._parse_datatype_string(cells.REGIONS))
    matching = T.StructField("matching", T.LongType())
    total = F.col("width").cast("bigint") * F.col("height")
    if band_pixels is None:

        def whole(a, b, w, h, top):
            diff = _differences(a, b, w, h, threshold)
            labels = _label_blocks(_bad_blocks(diff, w, h)) if merge else None
            return w * h - int(diff.sum()), _largest_first(_boxes(diff, w, h, labels=labels))

        uncut = [df.withColumns({"top": F.lit(0), "rows": F.col("height")}) for df in (library, suspects)]
        found = cells.compared_in_cells(*uncut, exclude_self, whole, [matching, regions], cell_rows)
        return found.select("suspect_id", "image_id", F.col("matching").alias("matching_pixels"), total.alias("total_pixels"), "regions")

    def band(a, b, w, h, top):
        diff = _differences(a, b, w, h, threshold)
        labels = _label_blocks(_bad_blocks(diff, w, h)) if merge else None
        edges = (labels[0].tolist(), labels[-1].tolist()) if merge else ([], [])
        return w * h - int(diff.sum()), _boxes(diff, w, h, top, labels), *edges

    edges = [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("first", "last")]
    cut = [cells.bands(df, band_pixels) for df in (library, suspects)]
    return cells.joined_bands(
        cells.compared_in_cells(*cut, exclude_self, band, [matching, regions, *edges], cell_rows)
    )


def detect(
    library: DataFrame,
    suspects: DataFrame,
    threshold: int = checks.TAMPER_THRESHOLD,
    exclude_self: bool = True,
    merge: bool = False,
    max_rows: int = BROADCAST_ROWS,
    rows_per_slice: int = cells.CELL_ROWS,
    band_pixels: int = cells.BAND_PIXELS,
) -> DataFrame:
    """(suspect_id, image_id, matching_pixels, total_pixels, similarity, regions) per same-size pair.

    ``suspects`` holds packed images with ``suspect_id``. A small batch of them is broadcast, so
    the library is read once and not shuffled; a larger one meets it in cells of at most about ``rows_per_slice``
    images on either side. ``merge`` joins adjoining blocks into one region. Images above ``band_pixels`` are compared
    in bands by many tasks.
    """
    checks.gray_step(threshold)
    library = library.select("image_id", "width", "height", "gray")
    suspects = suspects.select("suspect_id", "width", "height", "gray")
    large = F.col("width").cast("bigint") * F.col("height") > band_pixels
    tall = not suspects.filter(large).select(F.lit(1)).isEmpty()
    every = (library, suspects)
    if tall:
        library, suspects = library.filter(~large), suspects.filter(~large)
    if within_broadcast(suspects, "gray", max_rows):
        paired = _same_size(library, suspects, exclude_self, {"max_rows": max_rows})
        verdict = _compare_kernel(threshold, merge)("gray", "suspect_gray", "width", "height")
        total = F.col("width").cast("bigint") * F.col("height")
        found = paired.select("suspect_id", "image_id", total.alias("total_pixels"), verdict.alias("v"))
        found = found.select("suspect_id", "image_id", F.col("v.matching_pixels"), "total_pixels", F.col("v.regions"))
    else:
        found = _in_cells(library, suspects, threshold, exclude_self, merge, rows_per_slice, None)
    if tall:
        cut = (df.filter(large) for df in every)
        found = found.unionByName(_in_cells(*cut, threshold, exclude_self, merge, rows_per_slice, band_pixels))
    return found.select(
        "suspect_id",
        "image_id",
        "matching_pixels",
        "total_pixels",
        (F.col("matching_pixels") / F.col("total_pixels")).alias("similarity"),
        "regions",
    )


def ranking(verdicts: DataFrame) -> DataFrame:
    """All compared images, most matching pixels first."""
    return verdicts.drop("regions").orderBy(
        "suspect_id", F.desc("matching_pixels"), "image_id"
    )


def regions(verdicts: DataFrame) -> DataFrame:
    """One row per region."""
    return verdicts.select("suspect_id", "image_id", F.explode("regions").alias("r")).select(
        "suspect_id", "image_id", "r.*"
    )


def best_per_image(verdicts: DataFrame) -> DataFrame:
    """Highest matching count an image reaches against any suspect."""
    return verdicts.groupBy("image_id").agg(F.max("matching_pixels").alias("matching_pixels"))


def report(verdicts: DataFrame, images: int = 3, top: int = 5) -> DataFrame:
    """The best images per suspect with their largest regions and the number left out."""
    best_first = Window.partitionBy("suspect_id").orderBy(F.desc("matching_pixels"), "image_id")
    return (
        verdicts.withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= images)
        .withColumn("region_count", F.size("regions"))
        .withColumn("regions_more", F.greatest(F.col("region_count") - top, F.lit(0)))
        .withColumn("regions_top", F.slice("regions", 1, top))
        .drop("regions")
    )
