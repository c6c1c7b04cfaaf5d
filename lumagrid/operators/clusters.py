"""Clustering images by their normalised histograms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumagrid.functions import histograms as H
from lumagrid.operators.cells import hist_matrix
from lumagrid.session import materialise

SCALE = 1 << 16
ROWS_PER_TASK = 10_000  # points of 256 doubles: about 20 MB


def histogram_clusters(
    library: DataFrame, k: int = 8, seed: int = 17, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """(image_id, cluster) by k-means on histograms scaled to sum 1.

    Stored histograms are far smaller than their points, so a task's share of files may hold very many: the model is
    fitted on points dealt out by their number if there are more than ``rows_per_task``.
    """
    counts = F.transform("hist", lambda n: n.cast("double"))
    points = Normalizer(p=1.0, inputCol="counts", outputCol="features").transform(
        library.select("image_id", array_to_vector(counts).alias("counts"))
    ).select("image_id", "features")
    shares = _shares(points, library.count(), rows_per_task)
    return KMeans(k=k, seed=seed, predictionCol="cluster").fit(shares).transform(points).select("image_id", "cluster")


def _shares(points: DataFrame, rows: int, rows_per_task: int) -> DataFrame:
    """``points`` in partitions of about ``rows_per_task`` rows; as they are if there are no more than that."""
    return points.repartition(-(-rows // rows_per_task)) if rows > rows_per_task else points


def _assign(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centre of each point, the first of equally near ones, and the squared distance.

    The parts of a point add up to ``SCALE`` at most, so every sum below is a whole number that doubles hold exactly.
    """
    points, centres = points.astype(np.float64), centres.astype(np.float64)
    gap = (points**2).sum(axis=1)[:, None] - 2 * (points @ centres.T) + (centres**2).sum(axis=1)
    nearest = gap.argmin(axis=1)
    return nearest, gap[np.arange(len(points)), nearest].astype(np.int64)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _scaled(hist: pa.Array) -> pa.Array:
    """Histograms in ``SCALE`` parts, rounded down."""
    counts = hist_matrix(hist)
    parts = counts * SCALE // np.maximum(counts.sum(axis=1), 1)[:, None]
    ends = np.arange(0, H.BINS * len(hist) + 1, H.BINS, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(parts.ravel()))


def _first_centres(points: DataFrame, k: int) -> list:
    """The ``k`` distinct points with the smallest digests: digests are compared alone, then only their points are read."""
    digests = [r["digest"] for r in points.select("digest").distinct().orderBy("digest").limit(k).collect()]
    rows = points.filter(F.col("digest").isin(digests)).select("digest", "point").distinct().collect()
    return [r["point"] for r in sorted(rows)[:k]]


def content_clusters(library: DataFrame, k: int = 8, rounds: int = 4) -> DataFrame:
    """(image_id, cluster, distance) by ``rounds`` rounds of k-means in whole numbers.

    Histograms are scaled to 65,536 parts, rounded down. The first centres are the ``k`` distinct ones with the
    smallest MD5 of their text, fewer if there are not as many, and each round replaces a centre by the mean of its
    points, rounded down; one without points stays. Nothing depends on the order of rows, and images with equal scaled
    histograms share a cluster. distance is the squared distance from the last centre. Only centres, k times
    256 numbers, reach the driver.
    """
    if k < 1 or rounds < 0:
        raise ValueError("k must be positive and rounds not negative")
    points = library.select("image_id", _scaled("hist").alias("point"))
    points = materialise(points.withColumn("digest", F.md5(H.to_csv(F.col("point")))), "cluster-points")
    seeds = _first_centres(points, k)
    if not seeds:
        return points.select("image_id", F.lit(0).alias("cluster"), F.lit(0).cast("bigint").alias("distance"))
    centres = np.array(seeds, np.int64)
    many = len(centres)
    for _ in range(rounds):

        def sums(batches: Iterator[pa.RecordBatch], centres: np.ndarray = centres) -> Iterator[pa.RecordBatch]:
            total, count = np.zeros((many, H.BINS), np.int64), np.zeros(many, np.int64)
            for batch in batches:
                own = hist_matrix(batch.column("point"))
                nearest, _ = _assign(own, centres)
                for cluster in np.unique(nearest):
                    total[cluster] += own[nearest == cluster].sum(axis=0)
                count += np.bincount(nearest, minlength=many)
            cluster, bin = np.divmod(np.arange(total.size), H.BINS)
            columns = [cluster, bin, total.ravel(), np.repeat(count, H.BINS)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "bin", "s", "n"])

        parts = points.select("point").mapInArrow(sums, "cluster bigint, bin bigint, s bigint, n bigint")
        moved = parts.groupBy("cluster", "bin").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).filter("n > 0")
        rows = moved.select("cluster", "bin", F.expr("s div n").alias("v")).collect()
        centres = centres.copy()
        for row in rows:
            centres[row["cluster"], row["bin"]] = row["v"]

    @F.arrow_udf("struct<cluster: int, distance: bigint>")
    def told(point: pa.Array) -> pa.Array:
        nearest, gap = _assign(hist_matrix(point), centres)
        return pa.StructArray.from_arrays([pa.array(nearest, pa.int32()), pa.array(gap, pa.int64())], ["cluster", "distance"])

    return points.withColumn("told", told("point")).select("image_id", "told.cluster", "told.distance")
