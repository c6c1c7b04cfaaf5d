"""Search in a stored library whose files are ordered by a summary of the histograms.

The summary of an image is its total and, for three bits of the gray value, how many pixels have the bit unset. An
image whose similarity to the query is at least ``t`` has a total between ``t`` and ``1 / t`` times the query's, and each of its
sums differs from the query's by no more than ``(1 - t) / t`` times the query's total. Rows are sorted by their
summaries, so these ranges rule out row groups by their statistics before a histogram is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid import checks
from lumagrid.functions import histograms as H
from lumagrid.operators.search import search

BITS = (7, 6, 5)
FIRST, LEAST = 0.9, 0.05
ROW_GROUP = 8 << 20


def _summary(hist):
    """total, then for each bit the sum of the bins without it."""
    unset = lambda bit: H.total(F.filter(hist, lambda _, gray: F.lit(2**bit).bitwiseAND(gray) == 0))
    return [H.total(hist).alias("total"), *(unset(bit).alias(f"half{bit}") for bit in BITS)]


def write(library: DataFrame, path: str, row_group: int = ROW_GROUP) -> None:
    """Store (image_id, hist) with summaries: ranges of (total, halves) as files, sorted within, in small row groups."""
    order = ["total", *(f"half{bit}" for bit in BITS)]
    rows = library.select("image_id", "hist", *_summary(F.col("hist")))
    rows = rows.repartitionByRange(*order, "image_id").sortWithinPartitions(*order, "image_id")
    rows.write.option("parquet.block.size", str(row_group)).parquet(path)


def within(stored: DataFrame, sums: dict[str, int], least: float) -> DataFrame:
    """The stored rows whose summaries allow a similarity of ``least``; all of them for 0."""
    if least <= 0:
        return stored
    total = sums["total"]
    slack = 1 + 1e-9
    kept = stored.filter(F.col("total").between(int(total * least / slack), int(total / least * slack) + 1))
    reach = int(total * (1 - least) / least * slack) + 1
    for bit in BITS:
        at = sums[f"half{bit}"]
        kept = kept.filter(F.col(f"half{bit}").between(at - reach, at + reach))
    return kept


def search_stored(spark: SparkSession, path: str, query: DataFrame, n: int = 5, first: float = FIRST) -> DataFrame:
    """Top ``n`` images of the library at ``path`` for one query row with a dense ``hist``; the same rows as :func:`search`.

    Rows that may reach a similarity of ``first`` are searched first. If the n-th best reaches it, no other row
    can come before it; else its similarity is the next bound, or half the last one while fewer than ``n`` rows
    were found. Only the query's summary and, each time, the count and the n-th similarity reach the driver.
    """
    checks.count_of(n)
    if not 0 <= first < 1:
        raise ValueError("the first bound must lie between 0 and 1")
    stored = spark.read.parquet(path)
    asked = query.select(*_summary(F.col("hist"))).head(2)
    # With no query row or several, search tells what is wrong.
    least = first if len(asked) == 1 and asked[0]["total"] is not None else 0.0
    while least > 0:
        rows = search(within(stored, asked[0].asDict(), least), query, n)
        found, last = rows.agg(F.count("similarity"), F.min("similarity")).first()
        if found == n:
            least = last if last >= LEAST else 0.0
            break
        least = least / 2 if least / 2 >= LEAST else 0.0
    return search(within(stored, asked[0].asDict(), least) if least > 0 else stored, query, n)
