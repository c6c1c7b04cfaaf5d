import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from lumagrid.operators import tamper


def forms(library, suspects, threshold=20, **options):
    """Ranking and regions from the packed form, after checking that the pixel form agrees."""
    packed = tamper.detect(library, suspects, threshold, **options)
    blocks = tamper.tamper_blocks(tamper.tamper_pixels(library, suspects, threshold, **options))
    rank = rows_of(tamper.ranking(packed).select("suspect_id", "image_id", "matching_pixels", "total_pixels", "similarity"))
    boxes = rows_of(tamper.regions(packed))
    assert rows_of(tamper.block_ranking(blocks)) == rank
    assert rows_of(tamper.block_regions(blocks)) == boxes
    return rank, boxes


def test_ragged_edges(spark, pack):
    plain = np.zeros((17, 17))
    marked = plain.copy()
    marked[16, 16] = 255
    rank, boxes = forms(pack({1: plain}), pack({2: marked}, "suspect_id"))
    assert rank == [(2, 1, 288, 289, 288 / 289)]
    assert boxes == [(2, 1, 16, 16, 16, 16, 1)]


def test_exactly_thirty_percent_is_no_region(spark, pack):
    plain = np.zeros((10, 10))
    edge, over = plain.copy(), plain.copy()
    edge.flat[:30], over.flat[:31] = 255, 255
    _, boxes = forms(pack({1: plain}), pack({2: edge, 3: over}, "suspect_id"))
    assert boxes == [(3, 1, 0, 0, 9, 9, 31)]


def test_difference_at_the_threshold_matches(spark, pack):
    rank, _ = forms(pack({1: np.array([[100, 100, 100, 0]])}), pack({2: np.array([[120, 121, 80, 255]])}, "suspect_id"))
    assert rank[0][2:4] == (2, 4)


def test_sizes_and_self(spark, pack):
    a, b = np.zeros((4, 5)), np.zeros((5, 4))
    library = pack({1: a, 2: a, 3: b})
    rank, _ = forms(library, pack({1: a}, "suspect_id"))
    assert [r[1] for r in rank] == [2]
    rank, _ = forms(library, pack({1: a}, "suspect_id"), exclude_self=False)
    assert [r[1] for r in rank] == [1, 2]


def test_random_pairs_both_forms_and_split_join(spark, rng, pack):
    shapes = [(33, 20), (20, 33), (16, 16)]
    library = pack({i: rng.integers(0, 60, shapes[i % 3]) for i in range(18)})
    suspects = pack({100 + i: rng.integers(0, 60, shapes[i % 3]) for i in range(4)}, "suspect_id")
    small = forms(library, suspects)
    assert len(small[0]) == 24
    assert forms(library, suspects, max_rows=1, rows_per_slice=2) == small


def verdicts_of(found):
    return sorted((r.suspect_id, r.image_id, r.matching_pixels, r.total_pixels, [tuple(x) for x in r.regions]) for r in found.collect())


@pytest.mark.parametrize("merge", [False, True])
def test_bands_and_cells_give_the_uncut_verdicts(spark, rng, pack, merge):
    """Images over several bands and cells, with regions across the seams, against whole images."""
    shapes = [(150, 70), (40, 300), (16, 16), (33, 17)]
    images, suspects = {}, {}
    for i in range(16):
        base = rng.integers(0, 10, shapes[i % 4])
        if i % 3:
            base[20:120, 10:40] = 255  # one tall region over all seams
        images[i] = base
        suspects[i + 100 if i % 2 else i] = np.where(rng.random(base.shape) < 0.29, 200, rng.integers(0, 10, base.shape))
    library, probes = pack(images), pack(suspects, "suspect_id")
    whole = verdicts_of(tamper.detect(library, probes, merge=merge))
    assert len(whole) == 4 * 16 - 8 and any(len(v[4]) > 1 for v in whole)
    for pixels in (1, 1200, 5000):
        assert verdicts_of(tamper.detect(library, probes, merge=merge, band_pixels=pixels)) == whole
    assert verdicts_of(tamper.detect(library, probes, merge=merge, max_rows=1, rows_per_slice=3, band_pixels=1200)) == whole


def test_a_large_image_goes_to_many_tasks(spark, pack):
    """A region down the whole image, over 25 bands, is one region; a spiral across seams is joined as well."""
    plain = np.zeros((1600, 64), np.uint8)
    marked = plain.copy()
    marked[:, :16] = 255
    marked[8:, 48:64] = 255  # the first block of this column is marked by half
    marked[1584:, :] = 255  # joins both at the bottom
    found = tamper.detect(pack({1: plain}), pack({2: marked}, "suspect_id"), merge=True, band_pixels=64 * 64)
    row = found.collect()[0]
    assert [tuple(r) for r in row.regions] == [(0, 0, 63, 1599, int((marked > 0).sum()))]
    assert row.matching_pixels == int((marked == 0).sum()) and row.total_pixels == 1600 * 64


def test_ten_thousand_suspects_of_one_size(spark, rng, pack, monkeypatch):
    library = {i: rng.integers(0, 60, (4, 8)) for i in range(30)}
    many = {i: rng.integers(0, 60, (4, 8)) for i in range(10_000)}
    groups = []
    real = tamper.cells.compared_in_cells

    def watched(left, right, *rest):
        found = real(left, right, *rest)
        groups.append(rest[-1])
        return found

    monkeypatch.setattr(tamper.cells, "compared_in_cells", watched)
    found = tamper.detect(pack(library), pack(many, "suspect_id"), exclude_self=False)
    got = {(r.suspect_id, r.image_id): r.matching_pixels for r in found.drop("regions").collect()}
    assert groups == [tamper.cells.CELL_ROWS]
    left, right = (np.stack([v.ravel() for v in d.values()]) for d in (library, many))
    want = (np.abs(right[:, None, :] - left[None, :, :]) <= 20).sum(axis=2)
    assert len(got) == want.size and all(got[j, i] == want[j, i] for j in range(0, 10_000, 7) for i in range(30))


def test_changed_pixels_are_missing_from_the_matches(spark, rng, pack):
    plain = rng.integers(0, 256, (40, 40))
    changed = plain.copy()
    spots = rng.choice(1600, 37, replace=False)
    changed.flat[spots] = (changed.flat[spots] + 128) % 256
    rank, _ = forms(pack({1: plain}), pack({2: changed}, "suspect_id"))
    assert rank[0][2] == 1600 - 37


def test_merged_regions(spark, pack):
    plain, marked = np.zeros((64, 64)), np.zeros((64, 64))
    marked[0:32, 0:16] = 255  # two blocks, one above the other
    marked[32:48, 16:32] = 255  # touches them at a corner only
    marked[48:64, 48:64] = 255
    verdicts = tamper.detect(pack({1: plain}), pack({2: marked}, "suspect_id"), merge=True)
    got = [tuple(r)[2:] for r in tamper.regions(verdicts).collect()]
    assert got == [(0, 0, 15, 31, 512), (16, 32, 31, 47, 256), (48, 48, 63, 63, 256)]


def test_report_and_best(spark, pack):
    plain, marked = np.zeros((16, 16 * 7)), np.full((16, 16 * 7), 255)
    library = pack({1: plain, 2: plain, 3: plain, 4: marked})
    verdicts = tamper.detect(library, pack({9: marked, 8: plain}, "suspect_id"))
    report = tamper.report(verdicts).filter("suspect_id = 9").orderBy("rank").collect()
    assert [r.image_id for r in report] == [4, 1, 2]
    assert [r.region_count for r in report] == [0, 7, 7]
    assert [r.regions_more for r in report] == [0, 2, 2]
    assert [len(r.regions_top) for r in report] == [0, 5, 5]
    assert report[1].regions_top[0].start_x == 0
    assert rows_of(tamper.best_per_image(verdicts)) == [(i, 16 * 16 * 7) for i in (1, 2, 3, 4)]


def test_threshold_is_checked(spark, pack):
    library = pack({1: np.zeros((2, 2))})
    with pytest.raises(ValueError):
        tamper.detect(library, library.withColumn("suspect_id", F.lit(1)), 256)
