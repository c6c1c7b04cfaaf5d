"""Tamper detection beyond a broadcast: many suspects as a two-sided grid, images larger than a task as row bands.

Grid: images and suspects of one size are cut into cells, bounded in bytes and rows, on both sides; each pair of cells is
one group of a co-grouped kernel. A group holds each image once, and compares all its pairs there, so pixels are shuffled
once per cell of the other side and never repeated per pair.

Bands: an image above the band size is cut into runs of whole block rows. Bands at the same height of images of one
size meet like images do; counts add up, and blocks never cross a band. Where adjoining blocks are to be merged, each band
numbers its own groups of blocks and hands on the numbers along its first and last block row; a union of those that
touch across a seam joins the groups. Only these small tables, without pixels, meet per pair of images.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumagrid.operators.cells import binary_cells
from lumagrid.session import materialise
from lumagrid.sizing import within_broadcast

CELL_BYTES = 8 << 20
CELL_ROWS = 256
BAND_PIXELS = 4 << 20
BLOCK = 16

BOX = ("start_x", "start_y", "end_x", "end_y", "pixel_count")
REGIONS = "array<struct<start_x: int, start_y: int, end_x: int, end_y: int, pixel_count: bigint>>"


def region_lists(boxes: list[np.ndarray]) -> pa.ListArray:
    """One list of regions per (regions, 5) array."""
    ends = np.concatenate(([0], np.cumsum([len(b) for b in boxes]))).astype(np.int32)
    flat = np.concatenate([*boxes, np.zeros((0, 5), np.int64)])
    columns = [pa.array(flat[:, k], pa.int64()).cast(pa.int64() if k == 4 else pa.int32()) for k in range(5)]
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(columns, list(BOX)))


def bands(images: DataFrame, band_pixels: int) -> DataFrame:
    """Images with ``top`` and ``rows``: cut into runs of whole block rows where larger than ``band_pixels``."""
    width, height = F.col("width"), F.col("height")
    step = F.greatest(F.floor(F.lit(band_pixels) / width / BLOCK).cast("int"), F.lit(1)) * BLOCK
    cut = images.withColumn("top", F.explode(F.sequence(F.lit(0), height - 1, step)))
    cut = cut.withColumn("rows", F.least(step, height - F.col("top")))
    return cut.withColumn("gray", F.substring("gray", F.col("top") * width + 1, F.col("rows") * width))


def compared_in_cells(
    library: DataFrame, suspects: DataFrame, exclude_self: bool, compare: Callable, extra: list[T.StructField], cell_rows: int
) -> DataFrame:
    """(suspect_id, image_id, width, height, top, rows, *extra) of all pairs that agree in size and top.

    compare: (gray, suspect's gray, width, rows, top) -> a tuple of the extra columns; lists of regions as arrays.
    """
    keys = ["width", "height", "top"]

    def cells(df: DataFrame, name: str) -> DataFrame:
        size = F.sum(F.col("width").cast("bigint") * F.col("rows"))
        count = F.greatest(F.ceil(F.count("*") / F.lit(cell_rows)), F.ceil(size / F.lit(CELL_BYTES)))
        return df.groupBy(*keys).agg(count.cast("int").alias(name))

    grid = materialise(cells(library, "ones").join(cells(suspects, "twos"), keys), "tamper-cells")
    grid = F.broadcast(grid) if within_broadcast(grid) else grid

    def side(df: DataFrame, key: str, own: str, cell: str, other: str, to: str) -> DataFrame:
        placed = df.join(grid, keys).withColumn(cell, F.pmod(F.xxhash64(key), F.col(own)).cast("int"))
        return placed.withColumn(to, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("ones", "twos")

    left = side(library, "image_id", "ones", "one", "twos", "two")
    right = side(suspects, "suspect_id", "twos", "two", "ones", "one")
    out = T.StructType(
        [suspects.schema["suspect_id"], library.schema["image_id"]]
        + [T.StructField(c, T.IntegerType()) for c in ("width", "height", "top", "rows")]
        + extra
    )
    schema = to_arrow_schema(out)
    lists = [isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType) for f in extra]

    def meet(images: pa.Table, probes: pa.Table) -> pa.Table:
        if not images.num_rows or not probes.num_rows:
            return schema.empty_table()
        width, height, top, rows = (images.column(c)[0].as_py() for c in ("width", "height", "top", "rows"))
        ids, names = images.column("image_id").to_pylist(), probes.column("suspect_id").to_pylist()
        own = [[x for chunk in t.column("gray").chunks for x in binary_cells(chunk)] for t in (images, probes)]
        at, found = [], []
        for i, a in enumerate(own[0]):
            for j, b in enumerate(own[1]):
                if exclude_self and (ids[i] is None or names[j] is None or ids[i] == names[j]):
                    continue
                at.append((j, i))
                found.append(compare(a, b, width, rows, top))
        fixed = [np.full(len(at), x) for x in (width, height, top, rows)]
        columns = [
            probes.column("suspect_id").take(pa.array([j for j, _ in at], pa.int64())),
            images.column("image_id").take(pa.array([i for _, i in at], pa.int64())),
            *map(pa.array, fixed),
        ]
        for k, is_list in enumerate(lists):
            values = [f[k] for f in found]
            columns.append(region_lists(values) if is_list else pa.array(values, schema.field(6 + k).type))
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    group = [*keys, "one", "two"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(meet, out)


def joined_bands(parts: DataFrame) -> DataFrame:
    """(suspect_id, image_id, matching_pixels, total_pixels, regions) of pairs whose bands were compared apart.

    parts: (suspect_id, image_id, width, height, top, rows, matching, regions, first, last); first and last are the
    numbers (from 1, 0 for none) of the band's regions along its first and last block row, empty if not to be merged.
    """
    out = T.StructType(
        [parts.schema["suspect_id"], parts.schema["image_id"]]
        + [T.StructField(c, T.LongType()) for c in ("matching_pixels", "total_pixels")]
        + [T.StructField("regions", T._parse_datatype_string(REGIONS))]
    )
    schema = to_arrow_schema(out)

    def join(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("top").to_numpy())
        table = table.take(pa.array(order))
        boxes, above, offset = [], None, 0
        parent: dict[int, int] = {}

        def root(k: int) -> int:
            while parent.get(k, k) != k:
                k = parent[k]
            return k

        for regions, first, last in zip(*(table.column(c).to_pylist() for c in ("regions", "first", "last"))):
            boxes += [[r[c] for c in BOX] for r in regions]
            if first:
                if above is not None:
                    for a, b in {(a, b + offset) for a, b in zip(above, first) if a and b}:
                        one, two = root(a), root(b)
                        parent[max(one, two)] = min(one, two)
                above = [x + offset if x else 0 for x in last]
            offset += len(regions)
        flat = np.array(boxes, np.int64).reshape(-1, 5)
        group = np.array([root(k + 1) for k in range(len(flat))], np.int64)
        _, first_of, group = np.unique(group, return_index=True, return_inverse=True)
        merged = flat[first_of].copy()
        for column, into in ((0, np.minimum), (1, np.minimum), (2, np.maximum), (3, np.maximum)):
            into.at(merged[:, column], group, flat[:, column])
        merged[:, 4] = np.bincount(group, weights=flat[:, 4], minlength=len(merged)).astype(np.int64)
        merged = merged[np.lexsort((merged[:, 0], merged[:, 1], -merged[:, 4]))]
        matching = sum(table.column("matching").to_pylist())
        total = table.column("width")[0].as_py() * table.column("height")[0].as_py()
        columns = [table.column(c).slice(0, 1) for c in ("suspect_id", "image_id")]
        columns += [pa.array([matching], pa.int64()), pa.array([total], pa.int64()), region_lists([merged])]
        return pa.table([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return parts.groupBy("suspect_id", "image_id").applyInArrow(join, out)
