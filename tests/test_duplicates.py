import numpy as np
import pytest

from conftest import rows_of
from lumagrid.operators import duplicates


def library(spark, hists):
    rows = [(i, h.tolist()) for i, h in enumerate(hists)]
    return spark.createDataFrame(rows, "image_id bigint, hist array<bigint>")


def brute(hists, threshold):
    first, copies = {}, {}
    for i, h in enumerate(hists):
        first.setdefault(tuple(h), i)
        copies[tuple(h)] = copies.get(tuple(h), 0) + 1
    kept = sorted(first.values())
    out = []
    for n, a in enumerate(kept):
        for b in kept[n + 1 :]:
            low, high = np.minimum(hists[a], hists[b]).sum(), np.maximum(hists[a], hists[b]).sum()
            if high and low / high > threshold:
                out.append((a, b, low / high, copies[tuple(hists[a])], copies[tuple(hists[b])]))
    return out


def near_copies(rng, many):
    """Families of histograms that differ by little, at many sizes, with exact copies."""
    hists = []
    for _ in range(many):
        base = rng.multinomial(int(rng.integers(40, 4000)), rng.dirichlet(np.ones(256) * 0.2))
        hists.append(base)
        for _ in range(int(rng.integers(0, 6))):
            other = base.copy()
            moves = int(rng.integers(0, max(2, base.sum() // 60)))
            for bin in rng.integers(0, 256, moves):
                other[bin] = max(0, other[bin] + int(rng.integers(-1, 2)))
            hists.append(other)
    return hists


@pytest.mark.parametrize("threshold", [0.98, 0.9, 0.75])
def test_pairs_equal_brute_force(spark, rng, threshold):
    hists = near_copies(rng, 25)
    hists.append(np.zeros(256, np.int64))
    want = brute(hists, threshold)
    assert len(want) > 3
    assert rows_of(duplicates.duplicate_pairs(library(spark, hists), threshold)) == want


def test_hot_cells_are_split_without_loss(spark, rng):
    base = rng.multinomial(3000, rng.dirichlet(np.ones(256)))
    hists = []
    for k in range(40):  # all in one cell
        other = base.copy()
        other[k] += 1
        hists.append(other)
    want = brute(hists, 0.98)
    assert len(want) == 40 * 39 // 2
    got = rows_of(duplicates.duplicate_pairs(library(spark, hists), 0.98, rows_per_slice=7))
    assert got == want


def test_only_pairs_above_the_threshold_leave_a_cell(spark, rng):
    """Pairs that may be alike were written with a histogram each: they grow with the square of the library."""
    found = duplicates.duplicate_pairs(library(spark, near_copies(rng, 25)))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    above, compared, below = plan.partition("FlatMapCoGroupsInArrow")
    assert compared and "Join" not in above
    assert "packed" in below and "hist" not in below


@pytest.mark.parametrize("axes", [0, 3, 8])
@pytest.mark.parametrize("grown", [1, 2**25, 2**40])
def test_kernel_equals_brute_force(rng, monkeypatch, axes, grown):
    monkeypatch.setattr(duplicates, "PAIRS", 5)
    hists = [*{tuple((h * grown).tolist()): h * grown for h in near_copies(rng, 12) if h.sum()}.values()]
    want = {(i, j, s) for i, j, s, _, _ in brute(hists, 0.9)}
    codec = duplicates.pa.Codec("zstd")
    packed = duplicates.pa.chunked_array([[codec.compress(np.asarray(h, np.int64).tobytes(), asbytes=True) for h in hists]])
    rows = duplicates.unpacked(packed)
    assert rows.dtype == (np.int32 if max(h.sum() for h in hists) < 1 << 31 else np.int64)
    assert np.array_equal(rows, np.array(hists))
    i, j, alike = duplicates.similar(rows, rows, lambda i, at: at > i, 0.9, axes)
    assert len(want) > 3 and set(zip(i.tolist(), j.tolist(), alike.tolist())) == want and len(i) == len(want)


def test_pairs_of_named_images_and_large_counts(spark, rng):
    hists = near_copies(rng, 8)
    hists = [h * 2**33 for h in hists]
    rows = [(f"n{i:03d}", h.tolist()) for i, h in enumerate(hists)] + [(None, (hists[0] + 1).tolist())]
    images = spark.createDataFrame(rows, "image_id string, hist array<bigint>")
    want = [(f"n{a:03d}", f"n{b:03d}", *rest) for a, b, *rest in brute(hists, 0.98)]
    assert len(want) > 3
    assert rows_of(duplicates.duplicate_pairs(images)) == want
    assert rows_of(duplicates.duplicate_pairs(images, rows_per_slice=2)) == want


def test_copies_point_to_the_first(spark):
    a, b = np.eye(256, dtype=np.int64)[:2]
    images = library(spark, [a, b, a, a, b])
    want = [(2, 0), (3, 0), (4, 1)]
    assert rows_of(duplicates.copies(images)) == want
    assert rows_of(duplicates.copies(images, rows_per_slice=1, max_rows=1)) == want


def test_threshold_is_checked(spark):
    with pytest.raises(ValueError):
        duplicates.duplicate_pairs(library(spark, []), 1.0)
