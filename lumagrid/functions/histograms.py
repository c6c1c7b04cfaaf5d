"""Dense 256-bin histograms as array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BINS = 256


def total(hist: Column) -> Column:
    return F.aggregate(hist, F.lit(0).cast("bigint"), lambda a, n: a + n)


def intersection(a: Column, b: Column) -> Column:
    both = F.zip_with(a, b, lambda x, y: F.least(x, y).cast("bigint"))
    return F.aggregate(both, F.lit(0).cast("bigint"), lambda s, n: s + n)


def overlap(inter: Column, total_a: Column, total_b: Column) -> Column:
    """Sum of minima over sum of maxima; the latter is both totals less the former."""
    union = total_a + total_b - inter
    return F.when(union > 0, inter.cast("double") / union.cast("double")).otherwise(F.lit(0.0))


def similarity(a: Column, b: Column) -> Column:
    return overlap(intersection(a, b), total(a), total(b))


def to_csv(hist: Column) -> Column:
    return F.array_join(F.transform(hist, lambda n: n.cast("string")), ",")


def from_csv(csv: Column, trim: bool = True) -> Column:
    """256 counts from comma-separated text; null when one of the first 256 tokens is no integer.

    Short text is filled with zeros, tokens after the 256th are ignored, and empty tokens at the
    very end do not count.
    """
    tokens = F.slice(F.split(F.regexp_replace(csv, ",+$", ""), ","), 1, BINS)
    if trim:
        tokens = F.transform(tokens, lambda s: F.regexp_replace(s, r"^[\x00-\x20]+|[\x00-\x20]+$", ""))
    values = F.transform(
        tokens, lambda s: F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))
    )
    padded = F.slice(F.concat(values, F.array_repeat(F.lit(0), BINS)), 1, BINS)
    return (
        F.when(csv.rlike("^,+$"), F.array_repeat(F.lit(0), BINS))
        .when(F.forall(values, lambda v: v.isNotNull()), padded)
    )


def detail_text(name: Column, width: Column, height: Column, hist: Column) -> Column:
    return F.concat_ws(
        "\n",
        F.concat(F.lit("Filename:"), name.cast("string")),
        F.concat(F.lit("Size:"), width.cast("string"), F.lit("x"), height.cast("string")),
        F.concat(F.lit("Histogram:"), to_csv(hist)),
    )
