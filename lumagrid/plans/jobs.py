"""The four analyses as composed jobs over packed images."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumagrid import checks
from lumagrid.operators import feature, search, tamper
from lumagrid.operators.histogram import with_histogram


def generate_histograms(images: DataFrame) -> DataFrame:
    """(image_id, width, height, hist) of a library of packed images."""
    return with_histogram(images).select("image_id", "width", "height", "hist")


def search_images(query: DataFrame, library: DataFrame, n: int = 5, strict: bool = True) -> DataFrame:
    """The ``n`` library images most like one query image; both are packed images.

    An empty library is an error, found by a look at one row; ``strict=False`` leaves that out.
    """
    if strict:
        checks.not_empty(library)
    probe = with_histogram(query)
    return search.search(generate_histograms(library), probe, n)


def search_features(
    features: DataFrame,
    library: DataFrame,
    threshold: float = checks.LOCAL_THRESHOLD,
    mode: str = "score",
    strict: bool = True,
) -> DataFrame:
    """Images that contain a feature, with the number of places and the best score."""
    if strict:
        checks.not_empty(library)
    return feature.feature_images(feature.feature_search(library, features, threshold, mode))


def detect_tampering(
    suspects: DataFrame,
    library: DataFrame,
    threshold: int = checks.TAMPER_THRESHOLD,
    strict: bool = True,
    **options,
) -> DataFrame:
    """The report on suspect images: best originals and regions that differ."""
    if strict:
        checks.not_empty(library)
    return tamper.report(tamper.detect(library, suspects, threshold, **options))


def first_hits(found: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` images with hits of each feature, by id, and how many more there are.

    Counts come from a grouped sum and the first rows from a ranked window, which keeps ``n`` per task.
    """
    hits = found.filter(F.col("match_count") > 0)
    first = Window.partitionBy("feature_id").orderBy("image_id")
    ranked = hits.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= n).drop("place")
    more = hits.groupBy("feature_id").agg(F.greatest(F.count("*") - n, F.lit(0).cast("bigint")).alias("more"))
    return ranked.join(more, "feature_id")
