import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from lumagrid.operators import histogram, search
from lumagrid.operators.pixels import pixel_table
from lumagrid.plans import jobs


def overlap(a, b):
    low, high = np.minimum(a, b).sum(), np.maximum(a, b).sum()
    return low / high if high else 0.0


def some_images(rng, many):
    return {
        i: rng.integers(0, rng.integers(2, 256), (rng.integers(1, 9), rng.integers(1, 9)))
        for i in range(many)
    }


def hist_of(array):
    return np.bincount(np.asarray(array, np.int64).ravel(), minlength=256)


def test_kernel_equals_aggregation(spark, rng, pack):
    images = pack(some_images(rng, 30))
    dense = histogram.dense_histogram(histogram.histogram_bins(pixel_table(images)))
    kernel = histogram.with_histogram(images).select("image_id", "hist")
    assert rows_of(dense.select("image_id", F.to_json("hist"))) == rows_of(
        kernel.select("image_id", F.to_json("hist"))
    )


def test_pixels_cover_the_image(spark, pack):
    got = rows_of(pixel_table(pack({1: np.array([[0, 10, 13], [127, 128, 255]])})).select("x", "y", "gray"))
    assert got == [(0, 0, 0), (0, 1, 127), (1, 0, 10), (1, 1, 128), (2, 0, 13), (2, 1, 255)]


def test_single_query_forms_agree_with_brute_force(spark, rng, pack):
    arrays = some_images(rng, 25)
    arrays[25] = np.full((3, 3), 254)  # shares no gray value with the query below
    query = np.full((2, 2), 1)
    want = sorted((-overlap(hist_of(query), hist_of(a)), i) for i, a in arrays.items())
    want = [(i, -s) for s, i in want]
    images = pack(arrays)
    bins = histogram.histogram_bins(pixel_table(images))
    probe = pack({0: query})
    sparse = search.search_bins(bins, histogram.histogram_bins(pixel_table(probe)), 26)
    dense = jobs.search_images(probe, images, 26)
    assert [tuple(r) for r in sparse.collect()] == want
    assert [tuple(r) for r in dense.collect()] == want
    assert (25, 0.0) in want
    assert [tuple(r) for r in jobs.search_images(probe, images, 4).collect()] == want[:4]


def many(spark, arrays, key):
    rows = [(i, hist_of(a).tolist()) for i, a in arrays.items()]
    return spark.createDataFrame(rows, f"{key} bigint, hist array<bigint>")


def test_many_queries_batch_and_grid_agree(spark, rng, monkeypatch):
    arrays, asked = some_images(rng, 60), some_images(rng, 9)
    library, queries = many(spark, arrays, "image_id"), many(spark, asked, "query_id")
    want = []
    for q, a in asked.items():
        order = sorted((-overlap(hist_of(a), hist_of(b)), i) for i, b in arrays.items())[:4]
        want += [(q, i, -s, k + 1) for k, (s, i) in enumerate(order)]
    assert rows_of(search.search_many(library, queries, 4)) == sorted(want)
    monkeypatch.setattr(search, "LIBRARY_CELL", 10)
    assert rows_of(search.search_many(library, queries, 4, max_batch=2)) == sorted(want)


def test_ties_go_to_the_smaller_id_and_empty_histograms_score_zero(spark):
    one = np.full((1, 1), 5)
    library = many(spark, {9: one, 3: one, 7: one}, "image_id").unionByName(
        spark.createDataFrame([(1, [0] * 256)], "image_id bigint, hist array<bigint>")
    )
    queries = many(spark, {0: one}, "query_id")
    got = rows_of(search.search_many(library, queries, 2))
    assert got == [(0, 3, 1.0, 1), (0, 7, 1.0, 2)]
    assert sorted(rows_of(search.search_many(library, queries, 9)), key=lambda r: r[3]) == [
        (0, 3, 1.0, 1),
        (0, 7, 1.0, 2),
        (0, 9, 1.0, 3),
        (0, 1, 0.0, 4),
    ]


def test_text_ids(spark):
    library = spark.createDataFrame([("b.png", [1] + [0] * 255), ("a.png", [1] + [0] * 255)], "image_id string, hist array<bigint>")
    queries = library.select(F.col("image_id").alias("query_id"), "hist")
    assert rows_of(search.search_many(library, queries, 1)) == [("a.png", "a.png", 1.0, 1), ("b.png", "a.png", 1.0, 1)]


def test_summary(spark, pack):
    library = jobs.generate_histograms(pack({4: np.array([[1, 1, 2]])}))
    assert rows_of(histogram.histogram_summary(library)) == [(4, 3, 1, 3, 2)]


def test_missing_query_and_empty_library_fail(spark, pack):
    images = pack({1: np.zeros((2, 2))})
    with pytest.raises(Exception, match="the query image is missing"):
        jobs.search_images(images.filter("image_id = 9"), images).collect()
    nothing = images.filter("image_id = 9")
    suspects, features = (images.withColumnRenamed("image_id", k) for k in ("suspect_id", "feature_id"))
    for job, probe in (
        (jobs.search_images, images),
        (jobs.search_features, features),
        (jobs.detect_tampering, suspects),
    ):
        with pytest.raises(ValueError, match="empty"):
            job(probe, nothing)
        job(probe, nothing, strict=False)
    assert jobs.search_features(features, images).count() == 1
    assert jobs.detect_tampering(suspects, images, exclude_self=False).count() == 1
