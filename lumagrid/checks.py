"""Argument checks made before any plan is built."""

from __future__ import annotations

from pyspark.sql import DataFrame

LOCAL_THRESHOLD = 0.95
TAMPER_THRESHOLD = 20


def share(value: float) -> float:
    if not 0 <= value <= 1:
        raise ValueError("threshold must lie between 0 and 1")
    return float(value)


def gray_step(value: int) -> int:
    if not 0 <= value <= 255:
        raise ValueError("threshold must lie between 0 and 255")
    return int(value)


def count_of(value: int) -> int:
    if value < 1:
        raise ValueError("the number of results must be at least 1")
    return int(value)


def not_empty(library: DataFrame) -> DataFrame:
    """Raise when the library has no rows; reads at most one row."""
    if library.isEmpty():
        raise ValueError("the image library is empty")
    return library
