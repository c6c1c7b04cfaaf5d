"""Local-feature search: a small template slid over every library image.

A batch of templates within the broadcast bound is sent to the tasks once. More templates than that are dealt into
blocks of bounded bytes, and the images are read once for each block: no pixel is joined or shuffled. There each image
band has a summed-area table, from which the sums of the pixels under any part of any window come by four look-ups.
The difference between such a sum and the template's own bounds the summed differences of the pixels from below, and
through them the number of misses, so most windows are ruled out before a pixel is compared.

Where a hit may miss in few pixels only, templates of one shape are tried 64 at a time: their pixels are cut into one part
more than may miss, so a hit matches all pixels of some part. For each pixel of the template and each gray value one word
tells which of the 64 would match, and the words that a window picks out are combined part by part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumagrid import checks
from lumagrid.operators.cells import binary_cells
from lumagrid.session import fresh_dir, materialise
from lumagrid.sizing import BROADCAST_BYTES, BROADCAST_ROWS, within_broadcast

NEAR = 5  # gray steps within which a template pixel counts as matching
BAND_PIXELS = 4 << 20
STACK_PIXELS = 1 << 20
FLUSH = 1 << 20  # hits handed on at a time

SOON = 1 << 15  # pixels that are compared at once rather than ruled out
FEW = 16  # a sixteenth of the windows left is few enough to look at them one by one
WORD = 64  # templates tried at once
PART = 4  # least pixels of a part that must match as a whole


def _most_misses(mode: str, threshold: float, n: int) -> float:
    """The most pixels that may miss in a window of ``n`` pixels that is still a hit.

    In score mode the score is (1 - misses/n + 1 - diff/(255 n)) / 2 and every difference is at
    least 0, so misses <= 2 n (1 - t); in count mode misses <= n - int(n t).
    """
    if mode == "score":
        return 2.0 * n * (1.0 - threshold) + 1e-6
    return float(n - int(n * threshold))


def _missed(gap: np.ndarray, mode: str) -> np.ndarray:
    return gap >= NEAR if mode == "score" else gap > NEAR


def _gap(image: np.ndarray, value: int) -> np.ndarray:
    value = np.uint8(value)
    return np.where(image > value, image - value, value - image)


def _by_value(feature: np.ndarray, image: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Template pixels grouped by gray value, those rarest in the image first.

    Rare values miss in most windows, so they rule windows out soonest.
    """
    near = np.convolve(np.bincount(image.ravel(), minlength=256), np.ones(2 * NEAR - 1), "same")
    flat = feature.ravel()
    values = np.unique(flat)
    return [(int(v), np.flatnonzero(flat == v)) for v in values[np.argsort(near[values], kind="stable")]]


def _dense_sum(groups, image, shape, width, of, kind, most, stop=None):
    """Sum over template pixels of a per-pixel map, for all windows at once.

    ``of`` maps (image, value) to the cost of every image pixel against one template value, in the
    small integer type ``kind`` that ``most`` additions cannot overflow. With ``stop``, returns
    early once ``stop(sums)`` says that few windows are left.
    """
    rows, cols = shape
    sums = np.zeros(shape, np.int64)
    part, added = np.zeros(shape, kind), 0
    for value, places in groups:
        cost = of(image, value)
        for k in places:
            fy, fx = divmod(int(k), width)
            part += cost[fy : fy + rows, fx : fx + cols]
            added += 1
            if added == most:
                sums += part
                part[...], added = 0, 0
                if stop and stop(sums):
                    return sums
        if stop and added >= 4:
            sums += part
            part[...], added = 0, 0
            if stop(sums):
                return sums
    return sums + part


def _exact(image, feature, at, mode, most):
    """Misses and summed differences of the windows that start at flat positions ``at``.

    Windows leave as soon as they have missed too often.
    """
    w, fw = image.shape[1], feature.shape[1]
    flat, wanted = image.ravel().astype(np.int16), feature.ravel().astype(np.int16)
    ky, kx = np.divmod(np.arange(len(wanted)), fw)
    offsets = ky * w + kx
    chunk = max(1, (1 << 22) // max(len(at), 1))
    misses, diff = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    for first in range(0, len(wanted), chunk):
        if not len(at):
            break
        part = slice(first, first + chunk)
        gap = np.abs(flat[at[:, None] + offsets[part]] - wanted[part])
        misses += _missed(gap, mode).sum(axis=1)
        diff += gap.sum(axis=1, dtype=np.int64)
        fine = misses <= most
        if not fine.all():
            at, misses, diff = at[fine], misses[fine], diff[fine]
    return at, misses, diff


def summed_areas(image: np.ndarray) -> np.ndarray:
    """Sums of all pixels above and left of each corner, one row and column more than the image."""
    table = np.zeros((image.shape[0] + 1, image.shape[1] + 1), np.int64)
    np.cumsum(np.cumsum(image, axis=0, dtype=np.int64), axis=1, out=table[1:, 1:])
    return table


def _parts(feature: np.ndarray, count: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(top, left, bottom, right, sum) of a template cut into about ``count`` x ``count`` parts."""
    rows, cols = (np.unique(np.linspace(0, size, count + 1).astype(int)) for size in feature.shape)
    for top, bottom in zip(rows[:-1].tolist(), rows[1:].tolist()):
        for left, right in zip(cols[:-1].tolist(), cols[1:].tolist()):
            yield top, left, bottom, right, int(feature[top:bottom, left:right].sum(dtype=np.int64))


def possible_windows(
    table: np.ndarray, feature: np.ndarray, mode: str, threshold: float, starts: np.ndarray | None = None
) -> np.ndarray:
    """Flat positions (y * width + x) of the windows that sums of parts do not rule out; no hit is among the others.

    In a part of n pixels whose differences add up to d at least, pixels that match are off by ``near`` at most and
    the others by 255, hence at least (d - near * n) / (255 - near) pixels miss. Ever finer parts are tried on the windows
    left, until there are so few that comparing them is quicker. starts: the rows where windows may start, if not all.
    """
    (th, tw), (fh, fw) = table.shape, feature.shape
    n, near, flat = fh * fw, NEAR - 1 if mode == "score" else NEAR, table.ravel()
    rows, cols = th - fh, tw - fw
    first = np.arange(rows) if starts is None else starts
    at = (first[:, None] * tw + np.arange(cols)).ravel()
    count = 1
    while len(at) * n > SOON:
        misses, diff = np.zeros(len(at)), np.zeros(len(at), np.int64)
        for top, left, bottom, right, own in _parts(feature, count):
            corner = at + top * tw + left
            down, over = (bottom - top) * tw, right - left
            gap = np.abs(flat[corner + down + over] - flat[corner + down] - flat[corner + over] + flat[corner] - own)
            diff += gap
            misses += np.maximum(0.0, (gap - near * (bottom - top) * over) / (255.0 - near))
        if mode == "score":
            fine = misses / n + diff / (255.0 * n) <= 2.0 * (1.0 - threshold) + 1e-9
        else:
            fine = misses <= _most_misses(mode, threshold, n) + 1e-9
        at = at[fine]
        if count >= min(8, max(fh, fw)):
            break
        count *= 2
    y, x = np.divmod(at, tw)
    return y * (tw - 1) + x


def _scan(image: np.ndarray, feature: np.ndarray, mode: str, threshold: float):
    """(x, y, matching, summed difference) of the windows of one image that are hits.

    Misses only add up, so template pixels are charged to all windows at once until few windows can
    still be hits; only those are compared in full.
    """
    (h, w), (fh, fw) = image.shape, feature.shape
    n, shape = fh * fw, (h - fh + 1, w - fw + 1)
    most = _most_misses(mode, threshold, n)
    few = shape[0] * shape[1] // FEW
    groups = _by_value(feature, image)
    misses = _dense_sum(
        groups,
        image,
        shape,
        fw,
        lambda i, v: _missed(_gap(i, v), mode).view(np.uint8),
        np.uint8,
        255,
        lambda sums: np.count_nonzero(sums <= most) <= few,
    )
    y, x = np.nonzero(misses <= most)
    if len(y) <= few:
        at, missed, diff = _exact(image, feature, y * w + x, mode, most)
        y, x = np.divmod(at, w)
    else:
        sums = _dense_sum(
            groups, image, shape, fw, lambda i, v: _gap(i, v).astype(np.uint16), np.uint16, 257
        )
        missed, diff = misses[y, x], sums[y, x]
    return _kept(x, y, missed, diff, n, mode, threshold)


def _kept(x, y, missed, diff, n: int, mode: str, threshold: float):
    """The hits among compared windows."""
    matching = n - missed
    if mode == "score":
        keep = (matching / n + (1.0 - diff / n / 255.0)) / 2.0 >= threshold
    else:
        keep = matching >= int(n * threshold)
    return x[keep], y[keep], matching[keep], diff[keep]


def _parts_to_match(mode: str, threshold: float, n: int) -> int:
    """Into how many parts a template of ``n`` pixels is cut so that a hit matches one of them as a whole; 0 if too small.

    In score mode a miss also adds ``NEAR`` at least to the summed differences.
    """
    cost = 1.0 + NEAR / 255.0 if mode == "score" else 1.0
    parts = int(_most_misses(mode, threshold, n) / cost + 1e-6) + 1
    return parts if n >= PART * parts else 0


def near_words(features: list[np.ndarray], mode: str) -> np.ndarray:
    """(pixel, gray value): a word whose bit i tells whether the value matches that pixel of template i."""
    flat = np.stack([f.ravel() for f in features]).astype(np.int16)
    bits = np.uint64(1) << np.arange(len(flat), dtype=np.uint64)
    words = np.zeros((flat.shape[1], 256), np.uint64)
    for own, bit in zip(flat, bits):
        near = ~_missed(np.abs(own[:, None] - np.arange(256)), mode)
        words |= np.where(near, bit, np.uint64(0))
    return words


def _dealt(words: np.ndarray, image: np.ndarray, parts: int) -> list[np.ndarray]:
    """The pixels of the templates in ``parts`` parts, each with its share of those that few places in the image match."""
    seen = np.bincount(image.ravel(), minlength=256)
    order = np.argsort(np.bitwise_count(words) @ seen, kind="stable")
    return [order[part::parts] for part in range(parts)]


def windows_by_word(
    image: np.ndarray, shape: tuple[int, int], words: np.ndarray, parts: int, starts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """(flat positions, words): windows that match all pixels of some part, with a bit for each such template."""
    (h, w), (fh, fw) = image.shape, shape
    flat, rows, cols = image.ravel(), h - fh + 1, w - fw + 1
    allowed = np.zeros(rows, bool)
    allowed[starts] = True
    found_at, found = [], []
    for part in _dealt(words, image, parts):
        (y, x), rest = divmod(int(part[0]), fw), part[1:]
        left = words[part[0]][image[y : y + rows, x : x + cols]]
        left[~allowed] = 0
        y, x = np.nonzero(left)
        at, left = y * w + x, left[y, x]
        for k in rest.tolist():
            left &= words[k][flat[at + (k // fw * w + k % fw)]]
            fine = np.flatnonzero(left)
            if 2 * len(fine) <= len(at):
                at, left = at[fine], left[fine]
        fine = np.flatnonzero(left)
        found_at.append(at[fine])
        found.append(left[fine])
    at, where = np.unique(np.concatenate(found_at), return_inverse=True)
    all_words = np.zeros(len(at), np.uint64)
    np.bitwise_or.at(all_words, where, np.concatenate(found))
    return at, all_words


class _Stack:
    """Image bands of one width one above the other, so that many small images are handled like one large one."""

    def __init__(self, width: int, rows: list[int], bands: list[np.ndarray], tops: list[int], starts: list[int]):
        self.image = np.concatenate([b.reshape(-1, width) for b in bands])
        self._table: np.ndarray | None = None
        self.rows, self.tops, self.starts = (np.array(x, np.int64) for x in (rows, tops, starts))
        heights = np.array([b.size // width for b in bands], np.int64)
        self.own = np.repeat(np.arange(len(bands)), heights)
        self.begin = np.cumsum(heights) - heights
        self.heights = heights

    @property
    def table(self) -> np.ndarray:
        if self._table is None:
            self._table = summed_areas(self.image)
        return self._table

    def scan(self, feature: np.ndarray, mode: str, threshold: float):
        """(row of the batch, x, y, matching, summed difference) of the windows that are hits."""
        (fh, fw), (h, w) = feature.shape, self.image.shape
        place = np.arange(h) - self.begin[self.own]
        starts = np.flatnonzero(place < np.minimum(self.starts, self.heights - fh + 1)[self.own])
        if fw > w or not len(starts):
            return None
        at = possible_windows(self.table, feature, mode, threshold, starts)
        n = feature.size
        if 2 * len(at) <= len(starts) * (w - fw + 1) or len(at) * n <= SOON:
            at, missed, diff = _exact(self.image, feature, at, mode, _most_misses(mode, threshold, n))
            y, x = np.divmod(at, w)
            x, y, matching, diff = _kept(x, y, missed, diff, n, mode, threshold)
        else:
            x, y, matching, diff = _scan(self.image, feature, mode, threshold)
            fine = np.isin(y, starts)
            x, y, matching, diff = x[fine], y[fine], matching[fine], diff[fine]
        return self._placed(x, y, matching, diff)

    def scan_word(self, features: list[np.ndarray], words: np.ndarray, parts: int, mode: str, threshold: float):
        """The same for templates of one shape at once: yields (place in ``features``, hits) where there are any."""
        (fh, fw), (h, w) = features[0].shape, self.image.shape
        place = np.arange(h) - self.begin[self.own]
        starts = np.flatnonzero(place < np.minimum(self.starts, self.heights - fh + 1)[self.own])
        if fw > w or not len(starts):
            return
        at, found = windows_by_word(self.image, (fh, fw), words, parts, starts)
        most = _most_misses(mode, threshold, features[0].size)
        for i, feature in enumerate(features):
            own, missed, diff = _exact(self.image, feature, at[found >> np.uint64(i) & np.uint64(1) > 0], mode, most)
            y, x = np.divmod(own, w)
            x, y, matching, diff = _kept(x, y, missed, diff, feature.size, mode, threshold)
            if len(x):
                yield i, self._placed(x, y, matching, diff)

    def _placed(self, x, y, matching, diff):
        own = self.own[y]
        return self.rows[own], x, y - self.begin[own] + self.tops[own], matching, diff


def _stacks(column: dict[str, pa.Array]) -> Iterator[_Stack]:
    """The image bands of a batch by width, in stacks of bounded size."""
    shape = zip(*(column[c].to_pylist() for c in ("width", "top", "starts")))
    by_width: dict[int, list] = {}
    for row, (cell, (w, top, starts)) in enumerate(zip(binary_cells(column["gray"]), shape)):
        if cell.size:
            by_width.setdefault(w, []).append((row, cell, top, starts))
    for w, bands in by_width.items():
        held, size = [], 0
        for band in bands:
            if held and size + band[1].size > STACK_PIXELS:
                yield _Stack(w, *zip(*held))
                held, size = [], 0
            held.append(band)
            size += band[1].size
        yield _Stack(w, *zip(*held))


def _singles(column: dict[str, pa.Array], shipped, mode: str, threshold: float) -> Iterator[tuple]:
    """(feature, row, x, y, matching, summed difference) of each image band and template with hits."""
    shape = zip(*(column[c].to_pylist() for c in ("width", "top", "starts")))
    for row, (cell, (w, top, starts)) in enumerate(zip(binary_cells(column["gray"]), shape)):
        image = cell.reshape(-1, w)
        for feature_id, fw, data in shipped:
            feature = np.frombuffer(data, np.uint8).reshape(-1, fw)
            band = image[: starts + len(feature) - 1]
            if len(feature) > len(band) or fw > w:
                continue
            x, y, matching, diff = _scan(band, feature, mode, threshold)
            if len(x):
                yield feature_id, feature.size, np.full(len(x), row), x, y + top, matching, diff


def _in_words(shipped, mode: str, threshold: float) -> tuple[list, list]:
    """Templates of one shape, 64 at a time, with their words and parts; and those whose hits may miss too often."""
    by_shape: dict[tuple[int, int], list] = {}
    singles = []
    for feature_id, fw, data in shipped:
        feature = np.frombuffer(data, np.uint8).reshape(-1, fw)
        many = by_shape.setdefault(feature.shape, []) if _parts_to_match(mode, threshold, feature.size) else singles
        many.append((feature_id, feature))
    together = []
    for same in by_shape.values():
        for first in range(0, len(same), WORD):
            ids, features = zip(*same[first : first + WORD])
            parts = _parts_to_match(mode, threshold, features[0].size)
            together.append((ids, features, near_words(features, mode), parts))
    return together, singles


def _stacked(column: dict[str, pa.Array], shipped, mode: str, threshold: float) -> Iterator[tuple]:
    """The same by stacks of bands, for many templates at once or by the summed areas of the stack."""
    together, singles = _in_words(shipped, mode, threshold)
    for stack in _stacks(column):
        for ids, features, words, parts in together:
            for i, hits in stack.scan_word(features, words, parts, mode, threshold):
                yield ids[i], features[i].size, *hits
        for feature_id, feature in singles:
            hits = stack.scan(feature, mode, threshold)
            if hits is not None and len(hits[0]):
                yield feature_id, feature.size, *hits


def _scanner(out: pa.Schema, mode: str, threshold: float, shipped, prune: bool):
    """Kernel for ``mapInArrow``: hits of each image band for all shipped templates."""

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            column = {name: part.column(name) for name in part.schema.names}
            found, ids, rows, waiting = [], [], [], 0
            for feature_id, size, row, *hits in (_stacked if prune else _singles)(column, shipped.value, mode, threshold):
                found.append((*hits, np.full(len(row), size)))
                ids += [feature_id] * len(row)
                rows.append(row)
                waiting += len(row)
                if waiting > FLUSH:
                    yield _hits(out, found, ids, rows, column)
                    found, ids, rows, waiting = [], [], [], 0
            if waiting:
                yield _hits(out, found, ids, rows, column)

    return scan


def _hits(out: pa.Schema, found, ids, rows, column) -> pa.RecordBatch:
    numbers = [np.concatenate(c) for c in zip(*found)]
    arrays = [pa.array(ids), column["image_id"].take(pa.array(np.concatenate(rows))), *map(pa.array, numbers)]
    return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, out)], schema=out)


def row_bands(
    images: DataFrame, overlap: Column, keys: list[str], spread: bool, band_pixels: int = BAND_PIXELS
) -> DataFrame:
    """Cut each image into bands of rows that overlap by ``overlap`` rows.

    Adds ``top``, the first row of the band, and ``starts``, the number of rows at which a window
    may start in it; every window lies in exactly one band. With ``spread`` the bands of an image
    that needs more than one go to different tasks; the other images are never shuffled.
    """
    height, width = F.col("height"), F.col("width")
    uncut = lambda df: df.withColumn("top", F.lit(0)).withColumn("starts", height)
    if not spread:
        return uncut(images)
    step = F.greatest(F.floor(F.lit(band_pixels) / width).cast("int"), F.lit(1))
    tall = (
        images.filter(height > step)
        .withColumn("starts", step)
        .withColumn("top", F.explode(F.sequence(F.lit(0), height - 1, F.col("starts"))))
        .withColumn("gray", F.substring("gray", F.col("top") * width + 1, (F.col("starts") + overlap) * width))
        .repartition(*keys, "top")
    )
    return uncut(images.filter(height <= step)).unionByName(tall)


def _any_tall(images: DataFrame, band_pixels: int) -> bool:
    """Whether some image exceeds a band; reads the two size columns only."""
    pixels = F.col("width").cast("bigint") * F.col("height")
    return not images.filter(pixels > band_pixels).select(F.lit(1)).isEmpty()


def _blocks(features: DataFrame, max_rows: int, max_bytes: int) -> Iterator[list]:
    """The features, block by block: dealt by a hash, then cut where a block has too many rows or bytes all the same."""
    rows, size = features.agg(F.count("*"), F.coalesce(F.sum(F.length("gray")), F.lit(0))).first()
    blocks = max(-(-rows // max_rows), -(-size // max_bytes), 1)
    dealt = features.withColumn("block", F.pmod(F.xxhash64("feature_id"), F.lit(blocks)).cast("int"))
    folder = fresh_dir(features.sparkSession, "feature-blocks")
    dealt.repartition("block").write.partitionBy("block").parquet(folder)
    stored = features.sparkSession.read.schema(dealt.schema).parquet(folder)
    for block in range(blocks):
        held, held_bytes = [], 0
        for feature in stored.filter(F.col("block") == block).drop("block").toLocalIterator():
            if held and (len(held) == max_rows or held_bytes + len(feature.gray) > max_bytes):
                yield held
                held, held_bytes = [], 0
            held.append(feature)
            held_bytes += len(feature.gray)
        if held:
            yield held


def feature_search(
    images: DataFrame,
    features: DataFrame,
    threshold: float = checks.LOCAL_THRESHOLD,
    mode: str = "score",
    band_pixels: int = BAND_PIXELS,
    max_batch: int = BROADCAST_ROWS,
    block_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(feature_id, image_id, x, y, similarity, matching): every window that matches a feature.

    ``mode="score"`` averages the share of pixels closer than 5 and one less the mean difference,
    keeping scores of at least ``threshold``. ``mode="count"`` keeps windows with at least
    ``int(n * threshold)`` pixels within 5. Features that do not fit an image are skipped.

    A batch of features within the broadcast bound is sent to the tasks once, and each image is read
    once for all of them. Beyond it features are dealt into blocks of about ``max_batch`` rows or ``block_bytes`` at most;
    each block is a job of its own, whose hits are written before the next block is read, so neither the driver nor
    the plan grows with the features. The images are written once before and read for each block.
    """
    checks.share(threshold)
    if mode not in ("score", "count"):
        raise ValueError("mode must be 'score' or 'count'")
    spark = images.sparkSession
    out = T.StructType(
        [
            T.StructField("feature_id", features.schema["feature_id"].dataType),
            T.StructField("image_id", images.schema["image_id"].dataType),
            *[T.StructField(name, T.IntegerType()) for name in ("x", "y")],
            *[T.StructField(name, T.LongType()) for name in ("matching", "abs_diff", "size")],
        ]
    )
    images = images.select("image_id", "width", "height", "gray")
    spread = _any_tall(images, band_pixels)

    def hits(batch: list, prune: bool) -> DataFrame:
        shipped = spark.sparkContext.broadcast([(f.feature_id, f.width, bytes(f.gray)) for f in batch])
        overlap = max((f.height for f in batch), default=1) - 1
        bands = row_bands(images, F.lit(overlap), ["image_id"], spread, band_pixels)
        return bands.mapInArrow(_scanner(to_arrow_schema(out), mode, threshold, shipped, prune), out)

    features = features.select("feature_id", "width", "height", "gray")
    if within_broadcast(features, "gray", max_batch, block_bytes):
        found = hits(features.collect(), prune=False)
    else:
        images = materialise(images, "feature-images")  # read once for each block, made and dealt out once
        folder = fresh_dir(spark, "feature-hits")
        for batch in _blocks(features, max_batch, block_bytes):
            hits(batch, prune=True).write.mode("append").parquet(folder)
        found = spark.read.schema(out).parquet(folder)
    size = F.col("size").cast("double")
    share = F.col("matching") / size
    closeness = F.lit(1.0) - F.col("abs_diff") / size / F.lit(255.0)
    return found.select(
        "feature_id",
        "image_id",
        "x",
        "y",
        ((share + closeness) / F.lit(2.0)).alias("similarity"),
        "matching",
    )


def feature_images(
    hits: DataFrame, library: DataFrame | None = None, locations: bool = False, features: DataFrame | None = None
) -> DataFrame:
    """(feature_id, image_id, match_count, best) per image with hits.

    ``locations`` adds the list of places in row order, as long as the image has hits; the flat
    form is :func:`feature_search`. With ``library`` and ``features``, every image appears for every feature,
    with count 0 where it has no hit; the result then is as long as both together ask for.
    """
    found = [F.count("*").alias("match_count"), F.max("similarity").alias("best")]
    if locations:
        places = F.sort_array(F.collect_list(F.struct("y", "x", "similarity")))
        found.append(places.alias("locations"))
    counted = hits.groupBy("feature_id", "image_id").agg(*found)
    if library is None:
        return counted
    if features is None:
        raise ValueError("images without hits are counted per feature: give the features, too")
    ids = F.sort_array(features.agg(F.collect_set("feature_id")).scalar())
    every = library.select("image_id", F.explode(ids).alias("feature_id"))
    return every.join(counted, ["feature_id", "image_id"], "left").withColumn(
        "match_count", F.coalesce("match_count", F.lit(0).cast("bigint"))
    )


def location_text(hits: DataFrame) -> DataFrame:
    """(feature_id, image_id, locations): the places of each image as text, in row order."""
    found = feature_images(hits, locations=True)
    place = lambda p: F.concat(F.lit("("), p["x"].cast("string"), F.lit(","), p["y"].cast("string"), F.lit(")"))
    return found.select("feature_id", "image_id", F.array_join(F.transform("locations", place), " ").alias("locations"))
