import numpy as np
import pytest

from conftest import rows_of
from lumagrid.operators import clusters, families
from lumagrid.operators.duplicates import sketch_weights
from test_duplicates import brute, library, near_copies


def told(hists, threshold):
    """Family, links and copies of each keeper from all pairs."""
    pairs = [(a, b) for a, b, *_ in brute(hists, threshold)]
    first, copies = {}, {}
    for i, h in enumerate(hists):
        first.setdefault(tuple(h), i)
        copies[first[tuple(h)]] = copies.get(first[tuple(h)], 0) + 1
    family = {k: k for k in copies}
    links = dict.fromkeys(copies, 0)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(family[a], family[b])
            changed |= family[a] != low or family[b] != low
            family[a] = family[b] = low
    return sorted((k, copies[k], family[k], links[k]) for k in copies)


@pytest.mark.parametrize("threshold", [0.98, 0.8])
def test_families_equal_brute_force(spark, rng, threshold):
    hists = [*near_copies(rng, 20), np.zeros(256, np.int64)]
    want = told(hists, threshold)
    assert any(r[3] > 1 for r in want) and any(r[3] == 0 for r in want)
    assert rows_of(families.duplicate_families(library(spark, hists), threshold)) == want


def test_a_dense_family_is_linear_in_pieces(spark, rng):
    base = rng.multinomial(3000, rng.dirichlet(np.ones(256)))
    hists = [base + np.eye(256, dtype=np.int64)[k] for k in range(60)]
    images = library(spark, hists)
    want = [(i, 1, 0, 59) for i in range(60)]
    assert rows_of(families.duplicate_families(images, 0.98)) == want
    assert rows_of(families.duplicate_families(images, 0.98, cell_rows=7, rows_per_slice=5)) == want
    # What leaves the cells grows with the keepers: a count and a star's edge for each, not a row per link.
    keepers, homes, guests, keys, _ = families._grid(images, 0.98, 3)
    assert families._compared(homes, guests, keepers, keys, 0.98, 1024).count() < 60 * 59 / 2 / 4


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(101, 100)], "u bigint, v bigint")
    want = [(i, 0) for i in range(1, 41)] + [(101, 100)]
    assert rows_of(families.components(edges)) == want
    assert rows_of(families.components(edges, rows_per_slice=1)) == want
    assert families.components(edges.limit(0)).isEmpty()


def test_clusters_do_not_depend_on_row_order(spark, rng):
    hists = [rng.multinomial(500, rng.dirichlet(np.ones(256) * 0.1)) for _ in range(40)]
    hists += [hists[0], hists[0] * 2, np.zeros(256, np.int64)]
    images = library(spark, hists)
    rows = rows_of(clusters.content_clusters(images, 5, 3))
    assert rows == rows_of(clusters.content_clusters(images.orderBy("image_id", ascending=False).repartition(7), 5, 3))
    assert rows[0][1:] == rows[40][1:] == rows[41][1:] and all(r[2] >= 0 for r in rows)
    # A round never raises the sum of distances but for rounding of the centres.
    assert sum(r[2] for r in rows) < sum(r[2] for r in rows_of(clusters.content_clusters(images, 5, 0)))
    assert clusters.content_clusters(images.limit(0)).isEmpty()
    assert {r[1] for r in rows_of(clusters.content_clusters(library(spark, hists[:1] * 3), 5))} == {0}


def test_points_are_scaled_and_assigned_in_whole_numbers(spark, rng):
    hists = [rng.multinomial(70_001, rng.dirichlet(np.ones(256) * 0.05)) for _ in range(30)] + [np.zeros(256, np.int64)]
    rows = library(spark, hists).select("image_id", clusters._scaled("hist").alias("point")).collect()
    points = {r.image_id: r.point for r in rows}
    assert points == {i: [int(n) * 65536 // max(int(h.sum()), 1) for n in h] for i, h in enumerate(hists)}
    own = np.array([points[i] for i in range(len(hists))])
    nearest, gap = clusters._assign(own, own[:7])
    plain = ((own[:, None] - own[None, :7]) ** 2).sum(axis=2)
    assert nearest.tolist() == plain.argmin(axis=1).tolist() and gap.tolist() == plain.min(axis=1).tolist()


def test_points_of_many_rows_are_dealt_out_by_their_number(spark, rng):
    hists = [rng.multinomial(50, rng.dirichlet(np.ones(256))) for _ in range(40)]
    images = library(spark, hists).coalesce(1)
    shares = clusters._shares(images, 40, 10).rdd.glom().map(len).collect()
    assert len(shares) == 4 and sum(shares) == 40 and max(shares) <= 14
    assert clusters._shares(images, 40, 40).rdd.getNumPartitions() == 1
    assert len(rows_of(clusters.histogram_clusters(images, 3, rows_per_task=10))) == 40


def test_cells_of_a_level_meet_once(spark, rng):
    hists = near_copies(rng, 20)
    _, homes, guests, _, _ = families._grid(library(spark, hists), 0.98, 3)
    visits = guests.groupBy("image_id", "level", "home").count().collect()
    assert visits and all(r["count"] == (14 if r.level == r.home else 27) for r in visits)
    assert guests.filter("level = home and not cross").count() == homes.count()


def test_signed_sums_leave_no_link_out(rng):
    hists = np.array(near_copies(rng, 20))
    allowed = np.arange(len(hists))[:, None] < np.arange(len(hists))
    found = families.linked(hists, hists, allowed, 0.9)
    assert {tuple(x) for x in np.argwhere(found).tolist()} == {
        (i, j) for i in range(len(hists)) for j in range(i + 1, len(hists))
        if np.minimum(hists[i], hists[j]).sum() / max(np.maximum(hists[i], hists[j]).sum(), 1) > 0.9
    }
    weights = sketch_weights()[:, :8]
    assert (weights[:, 0].tolist(), weights[:, 7].sum()) == ([1, -1] * 128, 0)
