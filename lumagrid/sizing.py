"""Joins that broadcast only after a size check and split hot keys otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.session import materialise

BROADCAST_ROWS = 4096
BROADCAST_BYTES = 64 << 20
SLICE_ROWS = 100_000


def within_broadcast(
    df: DataFrame,
    payload: str | None = None,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> bool:
    """True when ``df`` is proven small; reads at most ``max_rows + 1`` rows."""
    width = F.length(payload) if payload else F.lit(0)
    rows, size = (
        df.select(width.cast("bigint").alias("n"))
        .limit(max_rows + 1)
        .agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)))
        .first()
    )
    return rows <= max_rows and size <= max_bytes


def split_hot_keys(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    spread: Column,
    rows_per_slice: int = SLICE_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """Add an ``int`` column ``slice`` to both sides so that no (keys, slice) holds too many left rows.

    A key with more than ``rows_per_slice`` left rows is cut into slices by a hash of ``spread``
    and its right rows are repeated once per slice; joining on keys + slice gives exactly the
    pairs of a join on the keys alone.
    """
    if not keys:
        slices = F.lit(max(1, -(-left.count() // rows_per_slice)))
        return (
            left.withColumn("slice", F.pmod(F.xxhash64(spread), slices).cast("int")),
            right.withColumn("slice", F.explode(F.sequence(F.lit(0), (slices - 1).cast("int")))),
        )
    hot = materialise(
        left.groupBy(*keys)
        .count()
        .filter(F.col("count") > rows_per_slice)
        .select(*keys, F.ceil(F.col("count") / rows_per_slice).cast("int").alias("slices")),
        "hot-keys",
    )
    if hot.isEmpty():
        return left.withColumn("slice", F.lit(0)), right.withColumn("slice", F.lit(0))
    if within_broadcast(hot):
        hot = F.broadcast(hot)
    slices = F.coalesce(F.col("slices"), F.lit(1))
    return (
        left.join(hot, keys, "left")
        .withColumn("slice", F.pmod(F.xxhash64(spread), slices).cast("int"))
        .drop("slices"),
        right.join(hot, keys, "left")
        .withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("slices"),
    )


def pair_up(
    library: DataFrame,
    probes: DataFrame,
    keys: list[str],
    payload: str,
    spread: Column,
    condition: Column | None = None,
    max_rows: int = BROADCAST_ROWS,
    rows_per_slice: int = SLICE_ROWS,
) -> DataFrame:
    """Each library row beside each probe row that agrees on ``keys`` and meets ``condition``.

    A small batch of probes is broadcast, so the library is not shuffled. A larger one is joined
    by shuffle on the keys with hot keys split.
    """
    if within_broadcast(probes, payload, max_rows):
        joined = library.join(F.broadcast(probes), keys)
    else:
        library, probes = split_hot_keys(library, probes, keys, spread, rows_per_slice)
        joined = library.join(probes, [*keys, "slice"]).drop("slice")
    return joined.filter(condition) if condition is not None else joined
