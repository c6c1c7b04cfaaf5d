"""Gray values: colour unpacking, luma and the table for one-channel files."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def unpack_rgb(rgb: Column) -> tuple[Column, Column, Column]:
    """Red, green and blue of a 24-bit integer."""
    return (
        F.shiftright(rgb, 16).bitwiseAND(255),
        F.shiftright(rgb, 8).bitwiseAND(255),
        rgb.bitwiseAND(255),
    )


def luma(r: Column, g: Column, b: Column) -> Column:
    """Weighted gray, truncated. The weights are doubles: decimals would round differently."""
    return (F.lit(0.299) * r + F.lit(0.587) * g + F.lit(0.114) * b).cast("int")


def srgb_of_linear() -> np.ndarray:
    """sRGB value of each linear 8-bit gray sample, from the standard transfer curve."""
    x = np.arange(256, dtype=np.float32) / np.float32(255)
    curve = np.where(
        x <= np.float32(0.0031308),
        np.float32(12.92) * x,
        np.float32(1.055) * np.power(x, np.float32(1 / 2.4)) - np.float32(0.055),
    )
    return np.rint(curve * np.float32(255)).astype(np.int32)


def one_channel_gray(sample: Column, mode: str = "srgb") -> Column:
    """Gray of a sample from a one-channel file: through sRGB and luma, or as it is."""
    if mode == "raw":
        return sample
    if mode != "srgb":
        raise ValueError("gray mode must be 'srgb' or 'raw'")
    table = F.array(*[F.lit(int(v)) for v in srgb_of_linear()])
    value = F.element_at(table, sample + 1)
    return luma(value, value, value)
