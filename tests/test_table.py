import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from lumagrid.functions import histograms as H
from lumagrid.operators.histogram import with_histogram
from lumagrid.plans.queries import QUERIES
from lumagrid.sources import table

B = 4


def seen(spark, path):
    rows = table.scan(spark, path).select("image_id", "width", "height", H.total(F.col("hist")).alias("n"))
    return rows_of(rows)


@pytest.fixture()
def path(spark, pack, tmp_path):
    where = str(tmp_path / "table")
    table.ingest(spark, where, pack({i: np.zeros((2, 3)) for i in range(20)}), B)
    return where


def test_ingest_scan_get_count(spark, path):
    assert seen(spark, path) == [(i, 3, 2, 6) for i in range(20)]
    assert table.count(spark, path).first()[0] == 20
    got = table.get(spark, path, 7)
    assert [(r.image_id, bytes(r.gray)) for r in got.collect()] == [(7, bytes(6))]
    assert table.get(spark, path, 99).count() == 0
    assert table.exists(spark, path) and not table.exists(spark, path + "-none")


def test_lookup_reads_one_bucket_and_pushes_the_key(spark, path):
    plan = table.get(spark, path, 7)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan
    assert "EqualTo(image_id,7)" in plan
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "bucket#" in filters and "pmod" in filters


def test_histogram_scan_leaves_the_pixels_alone(spark, path):
    plan = table.hist_scan(spark, path)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :]
    assert "hist" in read and "gray" not in read


def test_put_replaces_and_adds(spark, pack, path):
    table.ingest(spark, path, pack({3: np.zeros((5, 5)), 77: np.zeros((1, 1))}), B)
    want = [(i, 3, 2, 6) for i in range(20) if i != 3] + [(3, 5, 5, 25), (77, 1, 1, 1)]
    assert seen(spark, path) == sorted(want)
    table.ingest(spark, path, pack({3: np.zeros((5, 5)), 77: np.zeros((1, 1))}), B)
    assert seen(spark, path) == sorted(want)


def test_last_write_of_a_key_counts(spark, pack, path):
    one = with_histogram(pack({3: np.zeros((1, 1))})).withColumn("seq", F.lit(1))
    two = with_histogram(pack({3: np.zeros((2, 2))})).withColumn("seq", F.lit(2))
    table.put(spark, path, two.unionByName(one), order="seq")
    assert (3, 2, 2, 4) in seen(spark, path) and len(seen(spark, path)) == 20


def test_repeated_keys_need_an_order(spark, pack, path, tmp_path):
    two = pack({3: np.zeros((2, 2))}).unionByName(pack({3: np.zeros((4, 4))}))
    with pytest.raises(ValueError, match="several rows"):
        table.ingest(spark, path, two, B)
    with pytest.raises(ValueError, match="several rows"):
        table.ingest(spark, str(tmp_path / "new"), two, B)
    table.ingest(spark, path, two.withColumn("seq", F.col("width")), B, order="seq")
    assert (3, 4, 4, 16) in seen(spark, path) and len(seen(spark, path)) == 20
    table.ingest(spark, str(tmp_path / "new"), two.withColumn("seq", -F.col("width")), B, order="seq")
    assert seen(spark, str(tmp_path / "new")) == [(3, 2, 2, 4)]


def test_empty_first_batch(spark, pack, tmp_path):
    where, images = str(tmp_path / "late"), pack({3: np.zeros((2, 2))})
    table.ingest(spark, where, images.limit(0), B)
    assert not table.exists(spark, where)
    table.ingest(spark, where, images, B)
    table.ingest(spark, where, images.limit(0), B)
    assert seen(spark, where) == [(3, 2, 2, 4)]


def test_interrupted_change_is_not_seen(spark, pack, path, monkeypatch):
    before = seen(spark, path)

    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as m:
        m.setattr(table, "_clustered", fail)
        with pytest.raises(OSError):
            table.ingest(spark, path, pack({3: np.zeros((9, 9))}), B)
    spark.read.parquet(f"{path}/version=1").write.parquet(f"{path}/version=2")  # written, not published
    assert seen(spark, path) == before
    table.ingest(spark, path, pack({3: np.zeros((5, 5))}), B)
    assert (3, 5, 5, 25) in seen(spark, path) and len(seen(spark, path)) == 20


def test_readers_keep_their_rows_and_changes_read_no_pixels(spark, pack, path):
    old = table.scan(spark, path)
    table.ingest(spark, path, pack({3: np.zeros((5, 5))}), B)
    assert old.filter("width = 5").count() == 0 and old.count() == 20
    plan = table.scan(spark, path).select("image_id")._jdf.queryExecution().executedPlan().toString()
    assert "gray" not in plan
    table.compact(spark, path, 2)
    assert len(table.versions(spark, path)[0]) == 1 and table.versions(spark, path)[1] == 2
    assert len(seen(spark, path)) == 20 and table.get(spark, path, 3).first().width == 5


def test_delete_then_put_again(spark, pack, path):
    keys = spark.createDataFrame([(i,) for i in (*range(15), 500)], "image_id bigint")
    table.delete(spark, path, keys)
    assert seen(spark, path) == [(i, 3, 2, 6) for i in range(15, 20)]
    assert table.get(spark, path, 3).count() == 0
    table.delete(spark, path, spark.createDataFrame([(i,) for i in range(20)], "image_id bigint"))
    assert seen(spark, path) == [] and not table.exists(spark, path)
    table.ingest(spark, path, pack({3: np.zeros((5, 5))}), B)
    assert seen(spark, path) == [(3, 5, 5, 25)]


def test_frames(spark):
    make = lambda ids, w: spark.createDataFrame([(i, w) for i in ids], "image_id bigint, width int")
    old, new = make([1, 2, 3], 10), make([3, 4], 20)
    assert rows_of(table.upsert_rows(old, new)) == [(1, 10), (2, 10), (3, 20), (4, 20)]
    assert rows_of(table.delete_rows(old, new)) == [(1, 10), (2, 10)]
    union = table.library_union(old, new)
    assert rows_of(union) == [(1, 10, "table"), (2, 10, "table"), (3, 10, "table"), (4, 20, "files")]
    assert rows_of(table.library_status(union)) == [("files", 1), ("table", 3)]
    assert rows_of(table.library_join(old, new)) == [(3, 20)]
    assert rows_of(table.processed_images(old.unionByName(new))) == [(1,), (2,), (3,), (4,)]


def test_choice_of_source(spark):
    make = lambda ids: spark.createDataFrame([(i,) for i in ids], "image_id bigint")
    assert rows_of(table.choose_library("auto", make([]), make([5]))) == [(5,)]
    assert rows_of(table.choose_library("auto", make([4]), make([5]))) == [(4,)]
    assert rows_of(table.choose_library("files", make([4]), make([5]))) == [(5,)]
    for kind, stored, found in (("auto", None, make([])), ("table", make([]), make([5])), ("odd", None, None)):
        with pytest.raises(ValueError):
            table.choose_library(kind, stored, found)


def test_outcomes_and_listing(spark):
    scanned = spark.createDataFrame([(1, 3), (2, -1), (3, 4)], "image_id bigint, width int")
    counted = table.outcome_counters(table.with_status(scanned))
    assert rows_of(counted) == [("failed to read", 1), ("processed", 2)]
    listed = table.library_list(scanned.withColumn("height", F.lit(1)), 2)
    assert rows_of(listed) == [(1, 3, 1, 1), (2, -1, 1, 1)]


def test_many_keys_at_once(spark, pack, tmp_path):
    where = str(tmp_path / "many")
    table.ingest(spark, where, pack({i: np.full((2, i + 1), i) for i in range(30)}), 8)
    table.ingest(spark, where, pack({4: np.zeros((5, 5))}), 8)
    table.delete(spark, where, spark.createDataFrame([(7,)], "image_id bigint"))
    keys = spark.createDataFrame([(k,) for k in (4, 4, 7, 9, 99, None)], "image_id bigint")
    want = [(4, True, 5), (7, False, None), (9, True, 10), (99, False, None)]
    for sizes in ({}, {"max_rows": 1}):
        got = table.get_many(spark, where, keys, **sizes)
        assert rows_of(got.select("image_id", "found", "width")) == want
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = table.get_many(spark, where, keys)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    filters = [part.split("]")[0] for part in plan.split("PartitionFilters: [")[1:]]
    assert any("bucket#" in part for part in filters)
    assert table.get_many(spark, where, keys.limit(0)).isEmpty()


def test_an_upload_opens_each_file_once(spark, tmp_path):
    rows = [(i, [((i * j) % 9) / 9 - 0.5 for j in range(64)], i % 4) for i in range(12)]
    vecs = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    vecs.coalesce(1).write.parquet(str(tmp_path / "embeddings.parquet"))
    told = QUERIES["batch_upload"](spark, str(tmp_path))
    assert "scan image" not in told._jdf.queryExecution().executedPlan().toString().lower()
    assert rows_of(told) == [("failed to read", 3), ("processed", 9)]
