import numpy as np
import pyarrow.parquet as pq
import pytest

from lumagrid.operators import search, summary
from test_duplicates import library


def skewed(rng, many):
    """Histograms of many sizes and of many mean brightnesses."""
    centres = rng.integers(0, 256, many)
    sizes = rng.integers(50, 50_000, many)
    gray = np.arange(256)
    shapes = np.exp(-(((gray - centres[:, None]) / 12.0) ** 2))
    return [rng.multinomial(int(n), s / s.sum()) for n, s in zip(sizes, shapes)]


@pytest.mark.parametrize("first", [0.9, 0.5, 0.0])
@pytest.mark.parametrize("n", [1, 5, 1000])
def test_stored_search_equals_plain_search(spark, rng, tmp_path, first, n):
    hists = skewed(rng, 300)
    hists += [hists[3] + np.eye(256, dtype=np.int64)[k] for k in range(8)] + [hists[3], np.zeros(256, np.int64)]
    images, path = library(spark, hists), str(tmp_path / "s")
    summary.write(images, path)
    for asked in (3, 17, 309):
        query = images.filter(f"image_id = {asked}")
        want = [tuple(r) for r in search.search(images, query, n).collect()]
        assert [tuple(r) for r in summary.search_stored(spark, path, query, n, first).collect()] == want


def test_bounds_reach_the_scan_and_rule_out_row_groups(spark, rng, tmp_path):
    hists, path = skewed(rng, 2000), str(tmp_path / "s")
    images = library(spark, hists)
    summary.write(images, path, row_group=64 << 10)
    row = images.filter("image_id = 5").select(*summary._summary(images["hist"])).first().asDict()
    kept = summary.within(spark.read.parquet(path), row, 0.9)
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(total," in plan and "LessThanOrEqual(half7," in plan
    ids = {r.image_id for r in kept.select("image_id").collect()}
    query = np.array(hists[5])
    near = {i for i, h in enumerate(hists) if np.minimum(h, query).sum() / np.maximum(h, query).sum() >= 0.9}
    assert near <= ids and len(ids) < 100
    low, high = int(row["total"] * 0.9), int(row["total"] / 0.9) + 1
    groups = [f.metadata.row_group(g) for f in map(pq.ParquetFile, (tmp_path / "s").glob("*.parquet")) for g in range(f.num_row_groups)]
    at = [c for c in range(groups[0].num_columns) if groups[0].column(c).path_in_schema == "total"][0]
    read = [g for g in groups if g.column(at).statistics.max >= low and g.column(at).statistics.min <= high]
    assert len(groups) >= 8 and len(read) <= len(groups) / 3


def test_query_must_be_one_row(spark, rng, tmp_path):
    images, path = library(spark, skewed(rng, 5)), str(tmp_path / "s")
    summary.write(images, path)
    for query in (images.limit(0), images):
        with pytest.raises(Exception):
            summary.search_stored(spark, path, query).collect()
