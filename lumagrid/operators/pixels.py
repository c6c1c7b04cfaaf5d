"""Packed images (`gray BINARY`, row by row) and the pixel table (one row per pixel)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def byte_values(data: str) -> Column:
    """Array of one-character strings, one per byte; ``ascii`` of each is the byte."""
    return F.split(F.decode(F.col(data), "ISO-8859-1"), "")


def image_lines(images: DataFrame, *grays: str) -> DataFrame:
    """One row per image row: ``y``, and the bytes of that row in place of each packed column.

    Unfolding rows first keeps the arrays of the pixel step as short as an image is wide.
    """
    others = [c for c in images.columns if c not in grays]
    line = lambda g: F.substring(g, F.col("y") * F.col("width") + 1, F.col("width"))
    return images.withColumn("y", F.explode(F.sequence(F.lit(0), F.col("height") - 1))).select(
        *others, "y", *[line(g).alias(g) for g in grays]
    )


def pixel_table(images: DataFrame) -> DataFrame:
    """(image_id, width, height, x, y, gray) from packed images; other columns are dropped."""
    lines = image_lines(images.select("image_id", "width", "height", "gray"), "gray")
    return lines.select(
        "image_id", "width", "height", "y", F.posexplode(byte_values("gray")).alias("x", "sample")
    ).select("image_id", "width", "height", "x", "y", F.ascii("sample").alias("gray"))


def pack_values(values: Column | str) -> Column:
    """Binary from an array of byte values."""
    return F.unhex(F.array_join(F.transform(values, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
