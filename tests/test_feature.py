import numpy as np
import pyarrow as pa
import pytest

from conftest import rows_of
from lumagrid.operators import feature


def brute(images, features, threshold, mode):
    out = []
    for f, small in features.items():
        fh, fw = small.shape
        for i, big in images.items():
            for y in range(big.shape[0] - fh + 1):
                for x in range(big.shape[1] - fw + 1):
                    gap = np.abs(big[y : y + fh, x : x + fw].astype(int) - small.astype(int))
                    n = fh * fw
                    if mode == "score":
                        matching = int((gap < 5).sum())
                        score = (matching / n + (1.0 - int(gap.sum()) / n / 255.0)) / 2.0
                        hit = score >= threshold
                    else:
                        matching = int((gap <= 5).sum())
                        score = (matching / n + (1.0 - int(gap.sum()) / n / 255.0)) / 2.0
                        hit = matching >= int(n * threshold)
                    if hit:
                        out.append((f, i, x, y, score, matching))
    return sorted(out)


def scene(rng):
    images = {
        1: rng.integers(0, 256, (40, 33)),
        2: rng.integers(100, 140, (17, 50)),
        3: rng.integers(0, 256, (2, 2)),
        4: np.full((12, 12), 90),
        5: np.clip(np.add.outer(np.arange(30), np.arange(30)) * 4, 0, 255),
    }
    images = {k: v.astype(np.uint8) for k, v in images.items()}
    features = {
        10: images[1][5:9, 7:13],
        11: np.clip(images[2][3:8, 20:27].astype(int) + 3, 0, 255).astype(np.uint8),
        12: images[5][4:9, 4:9],
        13: np.zeros((60, 60), np.uint8),
    }
    return images, features


@pytest.mark.parametrize("mode", ["score", "count"])
@pytest.mark.parametrize("threshold", [0.0, 0.4, 0.75, 0.95, 1.0])
def test_equals_brute_force(spark, rng, pack, mode, threshold):
    images, features = scene(rng)
    want = brute(images, features, threshold, mode)
    found = feature.feature_search(pack(images), pack(features, "feature_id"), threshold, mode)
    assert rows_of(found) == want


def test_large_template_equals_brute_force(spark, rng, pack):
    big = rng.integers(60, 90, (70, 60)).astype(np.uint8)
    small = np.clip(big[20:50, 11:41].astype(int) + rng.integers(-3, 4, (30, 30)), 0, 255).astype(np.uint8)
    images, features = {1: big}, {0: small}
    for threshold in (0.6, 0.9, 0.95):
        found = feature.feature_search(pack(images), pack(features, "feature_id"), threshold)
        want = brute(images, features, threshold, "score")
        assert rows_of(found) == want and (0, 1, 11, 20) in [w[:4] for w in want]


def test_bands_cover_every_window_once(spark, rng, pack):
    images, features = scene(rng)
    want = brute(images, features, 0.4, "score")
    for pixels in (1, 100, 500):
        found = feature.feature_search(pack(images), pack(features, "feature_id"), 0.4, band_pixels=pixels)
        assert rows_of(found) == want


@pytest.mark.parametrize(("rows", "size"), [(1, 1 << 20), (100, 40), (3, 100)])
def test_many_features_go_block_by_block(spark, rng, pack, rows, size):
    images, features = scene(rng)
    for mode, threshold in (("score", 0.75), ("count", 0.6), ("score", 0.0)):
        want = brute(images, features, threshold, mode)
        for pixels in (feature.BAND_PIXELS, 200):
            found = feature.feature_search(
                pack(images), pack(features, "feature_id"), threshold, mode, band_pixels=pixels, max_batch=rows, block_bytes=size
            )
            assert rows_of(found) == want


def test_blocks_are_bounded_and_pixels_are_not_joined(spark, rng, pack):
    features = {k: rng.integers(0, 256, (3, 5 + k % 4)).astype(np.uint8) for k in range(50)}
    blocks = list(feature._blocks(pack(features, "feature_id"), 8, 100))
    assert sorted(f.feature_id for b in blocks for f in b) == list(range(50))
    assert all(len(b) <= 8 and (len(b) == 1 or sum(len(f.gray) for f in b) <= 100) for b in blocks)
    images = pack({1: rng.integers(0, 256, (40, 40)).astype(np.uint8)})
    plan = feature.feature_search(images, pack(features, "feature_id"), 0.9, max_batch=8)._jdf.queryExecution().toString()
    assert "Join" not in plan and plan.count("Scan") <= 2  # the hits of all blocks are one table


@pytest.mark.parametrize("mode", ["score", "count"])
def test_summed_areas_rule_out_windows_and_never_a_hit(rng, mode):
    smooth = np.add.outer(np.arange(120) * 2, np.sin(np.arange(150) / 9) * 60).astype(int) % 256
    scenes = [smooth.astype(np.uint8), rng.integers(0, 256, (60, 70)).astype(np.uint8), np.full((30, 30), 255, np.uint8)]
    for image in scenes:
        small = np.clip(image[7:19, 5:16].astype(int) + rng.integers(-3, 4, (12, 11)), 0, 255).astype(np.uint8)
        left = feature.possible_windows(feature.summed_areas(image), small, mode, 0.95)
        hits = {y * image.shape[1] + x for _, _, x, y, *_ in brute({0: image}, {0: small}, 0.95, mode)}
        assert hits and hits <= set(left.tolist())
    # A picture with shades: nine of ten windows need no look at their pixels.
    image, small = scenes[0], scenes[0][30:46, 40:56]
    left = feature.possible_windows(feature.summed_areas(image), small, mode, 0.95)
    assert len(left) < 0.1 * (120 - 15) * (150 - 15)


def test_no_features_no_hits(spark, rng, pack):
    images, features = scene(rng)
    none = pack(features, "feature_id").filter("feature_id < 0")
    assert feature.feature_search(pack(images), none).count() == 0


def test_threshold_edge_of_a_single_pixel(spark, pack):
    image, near, far = np.array([[100]]), np.array([[104]]), np.array([[105]])
    library = pack({1: image})
    features = pack({4: near, 5: far}, "feature_id")
    score = lambda df: {r.feature_id: r.matching for r in df.collect()}
    assert score(feature.feature_search(library, features, 0.0)) == {4: 1, 5: 0}
    assert score(feature.feature_search(library, features, 0.0, "count")) == {4: 1, 5: 1}


def test_images_with_and_without_hits(spark, rng, pack):
    images, features = scene(rng)
    library = pack(images)
    hits = feature.feature_search(library, pack({10: features[10]}, "feature_id"), 0.95)
    counted = feature.feature_images(hits, locations=True).collect()
    assert [(r.feature_id, r.image_id, r.match_count, r.best) for r in counted] == [(10, 1, 1, 1.0)]
    assert [(p.y, p.x, p.similarity) for p in counted[0].locations] == [(5, 7, 1.0)]
    both = pack({10: features[10], 11: features[10][:2]}, "feature_id")
    every = feature.feature_images(hits, library, features=both)
    counts = {(r.feature_id, r.image_id): r.match_count for r in every.collect()}
    assert counts == {(f, i): int((f, i) == (10, 1)) for f in (10, 11) for i in (1, 2, 3, 4, 5)}
    with pytest.raises(ValueError):
        feature.feature_images(hits, library)


def test_arguments(spark, pack):
    library = pack({1: np.zeros((2, 2))})
    with pytest.raises(ValueError):
        feature.feature_search(library, library.withColumnRenamed("image_id", "feature_id"), 1.5)
    with pytest.raises(ValueError):
        feature.feature_search(library, library.withColumnRenamed("image_id", "feature_id"), 0.5, "best")


@pytest.mark.parametrize(("mode", "threshold"), [("score", 0.95), ("score", 0.9), ("count", 0.9), ("score", 1.0)])
def test_templates_by_word_find_what_each_alone_finds(rng, mode, threshold):
    """70 templates of one shape are more than a word holds; bands of two images lie one above the other."""
    images = [rng.integers(97, 123, (40, 32)).astype(np.uint8), rng.integers(97, 123, (25, 32)).astype(np.uint8)]
    features = {}
    for k in range(70):
        y, x = int(rng.integers(0, 25)), int(rng.integers(0, 3))
        other = images[k % 2][y : y + 1, x : x + 30].copy()
        other[0, rng.integers(0, 30, k % 4)] = 250  # up to three pixels miss
        features[k] = other
    bands = [image.ravel() for image in images]
    column = {"gray": pa.array([b.tobytes() for b in bands], pa.binary())}
    column |= {n: pa.array(v) for n, v in (("width", [32, 32]), ("top", [0, 0]), ("starts", [40, 25]))}
    shipped = [(k, f.shape[1], f.tobytes()) for k, f in features.items()]
    together, singles = feature._in_words(shipped, mode, threshold)
    assert [len(t[0]) for t in together] == [64, 6] and not singles
    got = []
    for key, size, rows, x, y, matching, diff in feature._stacked(column, shipped, mode, threshold):
        score = (matching / size + (1.0 - diff / size / 255.0)) / 2.0
        got += zip([key] * len(rows), rows.tolist(), x.tolist(), y.tolist(), score.tolist(), matching.tolist())
    want = brute(dict(enumerate(images)), features, threshold, mode)
    assert want and sorted(got) == want


def test_images_are_made_once_for_all_blocks(spark, rng, pack, tmp_path):
    """Each block reads the images that were written once, instead of making and dealing them out again."""
    images, features = scene(rng)
    pack(images).write.parquet(str(tmp_path / "in"))
    many = {k: features[10] for k in range(6)}
    source = spark.read.parquet(str(tmp_path / "in"))
    made = spark.sparkContext.accumulator(0)

    def counted(parts):
        for part in parts:
            made.add(part.num_rows)
            yield part

    found = feature.feature_search(source.mapInArrow(counted, source.schema), pack(many, "feature_id"), 0.95, max_batch=2)
    assert rows_of(found) == brute(images, many, 0.95, "score")
    assert made.value <= 2 * len(images)  # once to look for tall ones, once to write them
