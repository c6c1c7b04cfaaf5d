"""Finding images whose histograms are alike beyond a threshold.

Images with one and the same histogram are first folded into one keeper, however many there are,
so a large group of copies costs one row. Keepers are then joined by similarity: two histograms
with overlap above ``t`` differ by an L1 distance of at most (1 - t)/t of the smaller total, so any
signed sum of their bins differs by no more than that. A grid over a few signed sums with
that distance as cell width meets every such pair in the same or a neighbouring cell. Pairs are compared where they
meet, on packed histograms, so that disk grows with the keepers and with the result, not with the pairs that may be alike.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumagrid.functions import histograms as H
from lumagrid.operators.cells import hist_matrix
from lumagrid.session import materialise
from lumagrid.sizing import SLICE_ROWS, split_hot_keys, within_broadcast

LEVEL = 1.25  # least ratio between two size levels
SIGNS = 8
COARSE = 16
#: Keepers of a cell that are compared with each other in one group, and pairs that are compared at once.
PIECE_ROWS, PAIRS = 16_384, 4096


def fold_copies(library: DataFrame) -> DataFrame:
    """(image_id, hist, copies): the smallest id of each distinct histogram and how many share it."""
    return library.groupBy("hist").agg(
        F.min("image_id").alias("image_id"), F.count("*").alias("copies")
    )


def copies(library: DataFrame, rows_per_slice: int = SLICE_ROWS, **sizes) -> DataFrame:
    """(image_id, keeper): each image beyond the first with the same histogram.

    Only histograms that repeat reach the join. They are broadcast when few; otherwise the join
    shuffles, with the images of a histogram shared by very many spread over slices.
    """
    library = library.select("image_id", "hist")
    grouped = library.groupBy("hist").agg(F.min("image_id").alias("keeper"), F.count("*").alias("n"))
    shared = materialise(grouped.filter(F.col("n") > 1).select("hist", "keeper"), "shared-histograms")
    if within_broadcast(shared, **sizes):
        joined = library.join(F.broadcast(shared), "hist")
    else:
        left, right = split_hot_keys(library, shared, ["hist"], F.col("image_id"), rows_per_slice)
        joined = left.join(right, ["hist", "slice"])
    return joined.filter(F.col("image_id") != F.col("keeper")).select("image_id", "keeper")


def sketch_weights() -> np.ndarray:
    """Signed sums (minus where the gray value has one bit set), then sums of 16 bins each, as columns."""
    gray = np.arange(H.BINS)
    signed = np.where(gray[:, None] >> np.arange(SIGNS) & 1, -1, 1)
    coarse = (gray[:, None] // (H.BINS // COARSE) == np.arange(COARSE)).astype(np.int64)
    return np.hstack([signed, coarse])


def _sketch_kernel():
    weights = sketch_weights()
    many = weights.shape[1]

    @F.arrow_udf("array<bigint>")
    def sketch(hist: pa.Array) -> pa.Array:
        sums = hist_matrix(hist) @ weights
        ends = np.arange(0, many * len(hist) + 1, many, dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(sums.ravel()))

    return sketch


_CODEC = "zstd"


def _pack_kernel():
    @F.arrow_udf("binary")
    def pack(hist: pa.Array) -> pa.Array:
        codec = pa.Codec(_CODEC)
        return pa.array([codec.compress(row.tobytes(), asbytes=True) for row in hist_matrix(hist)], pa.binary())

    return pack


def unpacked(column: pa.ChunkedArray) -> np.ndarray:
    """Rows x 256 counts from packed histograms, as narrow as their sums allow."""
    codec, size = pa.Codec(_CODEC), 8 * H.BINS
    rows, wide = np.empty((len(column), H.BINS), np.int32), False
    for i, cell in enumerate(column.to_pylist()):
        row = np.frombuffer(codec.decompress(cell, size, asbytes=True), np.int64)
        if not wide and row.sum() >= 1 << 31:
            rows, wide = rows.astype(np.int64), True
        rows[i] = row
    return rows


def _widest(signed: DataFrame, axes: int) -> list[int]:
    """The signed sums that spread the library most, relative to image size: one row to the driver."""
    spread = signed.agg(
        *[F.coalesce(F.stddev(F.col(f"s{b}") / F.col("total")), F.lit(0.0)) for b in range(SIGNS)]
    ).first()
    return sorted(range(SIGNS), key=lambda b: -spread[b])[:axes]


def _grid(
    library: DataFrame, threshold: float, axes: int, packed: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame, list[str], float]:
    """Keepers, their home cells, the cells they visit, the columns of a cell, and the reach of the threshold.

    Of two similar keepers one visits the home of the other: exactly one if ``cross``, else both do, being in one cell.
    packed: histograms are compressed one by one and travel with the keepers.
    """
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie strictly between 0 and 1")
    keepers = fold_copies(library.select("image_id", F.col("hist").cast("array<bigint>").alias("hist")))
    keepers = keepers.withColumn("sketch", _sketch_kernel()("hist"))
    if packed:
        keepers = keepers.withColumn("packed", _pack_kernel()("hist")).drop("hist")
    keepers = materialise(keepers, "keepers")
    coarse = F.slice("sketch", SIGNS + 1, COARSE)
    signed = keepers.select(
        "image_id",
        "copies",
        coarse.alias("coarse"),
        H.total(coarse).alias("total"),
        *[F.get("sketch", b).alias(f"s{b}") for b in range(SIGNS)],
        *(["packed"] if packed else []),
    ).filter(F.col("total") > 0)
    picked = _widest(signed, axes)
    reach = (1.0 - threshold) / threshold * (1 + 1e-9)
    ratio = max(LEVEL, 1.0 / threshold)
    level = F.floor(F.log(F.col("total").cast("double")) / F.lit(math.log(ratio))).cast("int")

    def cells(df: DataFrame) -> DataFrame:
        """Grid cell on the chosen axes; the width is the reach of the level's largest total."""
        width = F.pow(F.lit(ratio), F.col("level") + 1) * reach * (1 + 1e-9)
        return df.select(
            "*", *[F.floor(F.col(f"s{b}") / width).alias(f"c{b}") for b in picked]
        )

    keys = ["level", *[f"c{b}" for b in picked]]
    homes = cells(signed.withColumn("level", level).withColumn("cross", F.lit(False)))
    # An image also meets the level below when a slightly smaller one may lie there.
    floor_total = F.pow(F.lit(ratio), level) * (1 + 1e-9)
    guests = signed.withColumn(
        "levels",
        F.when(F.col("total") * threshold <= floor_total, F.array(level, level - 1)).otherwise(
            F.array(level)
        ),
    ).withColumn("home", level)
    guests = cells(
        guests.withColumn("level", F.explode("levels")).withColumn(
            "cross", F.col("level") != F.col("home")
        )
    )
    # Within a level a keeper visits one of each two opposite neighbours, so two cells meet once.
    steps = [dict(zip(picked, step)) for step in itertools.product((-1, 0, 1), repeat=axes)]
    ahead = [s for s in steps if tuple(s.values()) >= (0,) * axes]
    places = lambda some: F.array(*[F.struct(*[F.lit(s[b]).alias(f"d{b}") for b in picked]) for s in some])
    guests = guests.withColumn("step", F.explode(F.when(F.col("cross"), places(steps)).otherwise(places(ahead))))
    for b in picked:
        guests = guests.withColumn(f"c{b}", F.col(f"c{b}") + F.col(f"step.d{b}"))
        guests = guests.withColumn("cross", F.col("cross") | (F.col(f"step.d{b}") != 0))
    guests = guests.drop("step")
    return keepers, homes, guests, keys, reach


def similar(
    left: np.ndarray, right: np.ndarray, allowed: Callable[[int, np.ndarray], np.ndarray], threshold: float, axes: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows i, rows j, similarity) of the allowed pairs above ``threshold``.

    A row meets those whose totals allow it. The ``axes`` signed sums that spread these rows most are held against all of
    them, the other sums and the coarse ones against the rest, and what is left is compared bin by bin.
    """
    weights = sketch_weights().astype(np.float64)
    sums, others = left @ weights, right @ weights
    sizes, other_sizes = (x[:, SIGNS:].sum(axis=1) for x in (sums, others))
    rank = np.argsort(other_sizes, kind="stable")
    others, other_sizes = others[rank], other_sizes[rank]
    widest = np.argsort(-(sums[:, :SIGNS] / sizes[:, None]).std(axis=0), kind="stable")[:axes]
    columns = [(b, np.ascontiguousarray(others[:, b])) for b in widest]
    reach = (1.0 - threshold) / threshold * (1 + 1e-9)
    begin = np.searchsorted(other_sizes, sizes * threshold - 1e-6)
    end = np.searchsorted(other_sizes, (sizes + 1e-6) / threshold, side="right")
    totals, other_totals = (x.sum(axis=1, dtype=np.int64) for x in (left, right))
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]

    def compare() -> None:
        i, j = (np.concatenate(x) for x in zip(*waiting))
        waiting.clear()
        for at in range(0, len(i), PAIRS):
            one, two = i[at : at + PAIRS], j[at : at + PAIRS]
            inter = np.minimum(left[one], right[two]).sum(axis=1, dtype=np.int64)
            alike = inter / (totals[one] + other_totals[two] - inter)
            some = alike > threshold
            found.append((one[some], two[some], alike[some]))

    many = 0
    for i, (a, b) in enumerate(zip(begin.tolist(), end.tolist())):
        most = np.minimum(other_sizes[a:b], sizes[i]) * reach + 1e-6
        near = np.ones(b - a, bool)
        for k, column in columns:
            near &= np.abs(column[a:b] - sums[i, k]) <= most
        at = np.flatnonzero(near)
        if not len(at):
            continue
        most, at = most[at], at + a
        apart = np.abs(others[at] - sums[i])
        at = at[(apart[:, :SIGNS] <= most[:, None]).all(axis=1) & (apart[:, SIGNS:].sum(axis=1) <= most)]
        at = rank[at]
        at = at[allowed(i, at)]
        waiting.append((np.full(len(at), i), at))
        many += len(at)
        if many >= PAIRS:
            compare()
            many = 0
    if waiting:
        compare()
    i, j, alike = (np.concatenate(x) for x in zip(*found))
    return i, j, alike


def _pieces(homes: DataFrame, guests: DataFrame, keys: list[str], piece_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with columns one and two: a cell is cut into pieces on both sides, and each pair of pieces is a group."""
    counted = lambda df, name: df.groupBy(*keys).agg(
        F.count("*").alias(f"{name}_rows"), F.ceil(F.count("*") / F.lit(piece_rows)).cast("int").alias(f"{name}_pieces")
    )
    # A keeper visits its own home too: cells that nobody else visits are left out.
    grid = counted(homes, "one").join(counted(guests, "two"), keys).filter("one_rows * two_rows > 1")
    grid = materialise(grid.drop("one_rows", "two_rows"), "pair-cells")
    grid = F.broadcast(grid) if within_broadcast(grid) else grid

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        placed = df.join(grid, keys).withColumn(own, F.pmod(F.xxhash64("image_id"), F.col(f"{own}_pieces")).cast("int"))
        every = F.sequence(F.lit(0), F.col(f"{other}_pieces") - 1)
        placed = placed.withColumn(other, F.explode(every)).drop("one_pieces", "two_pieces")
        return placed.select(*[F.col(c).alias(c) for c in placed.columns])  # so that the sides can be told apart

    return side(homes, "one", "two"), side(guests, "two", "one")


def duplicate_pairs(
    library: DataFrame, threshold: float = 0.98, axes: int = 3, rows_per_slice: int = SLICE_ROWS
) -> DataFrame:
    """(a, b, similarity, a_copies, b_copies) for keepers ``a < b`` with similarity above ``threshold``.

    Keepers are dealt out by the signed sum that spreads them most alone, so that each moves to a cell or two with its
    packed histogram; a kernel compares the keepers of a cell there, and only pairs above the threshold leave it.
    ``axes``: by how many of the widest sums a kernel compares all rows whose totals allow it, before all else.

    Together with :func:`copies` this holds every pair of similar images. A dense family gives all its
    pairs; :func:`lumagrid.operators.families.duplicate_families` tells them in one row per keeper.
    """
    _, homes, guests, keys, _ = _grid(library, threshold, 1, packed=True)
    columns = [*keys, "image_id", "copies", "cross", "packed"]
    homes, guests = (df.select(*columns).filter(F.col("image_id").isNotNull()) for df in (homes, guests))
    left, right = _pieces(homes, guests, keys, min(rows_per_slice, PIECE_ROWS))
    key = homes.schema["image_id"].dataType
    kinds = {"x": key, "y": key, "similarity": T.DoubleType(), "x_copies": T.LongType(), "y_copies": T.LongType()}
    out = T.StructType([T.StructField(c, kind) for c, kind in kinds.items()])
    schema = to_arrow_schema(out)

    def meet(ones: pa.Table, twos: pa.Table) -> pa.Table:
        if not ones.num_rows or not twos.num_rows:
            return schema.empty_table()
        ids, names = ones.column("image_id").to_pylist(), twos.column("image_id").to_pylist()
        order = {x: i for i, x in enumerate(sorted({*ids, *names}))}
        first, second = (np.array([order[x] for x in own]) for own in (ids, names))
        cross = twos.column("cross").to_numpy()
        allowed = lambda i, at: cross[at] | (first[i] < second[at])
        i, j, alike = similar(*(unpacked(t.column("packed")) for t in (ones, twos)), allowed, threshold, axes)
        i, j = pa.array(i), pa.array(j)
        found = [t.column(c).take(at) for c in ("image_id", "copies") for t, at in ((ones, i), (twos, j))]
        return pa.table([found[0], found[1], pa.array(alike), found[2], found[3]], names=schema.names).cast(schema)

    group = [*keys, "one", "two"]
    pairs = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(meet, out)
    of = lambda own, other: F.when(F.col("x") < F.col("y"), F.col(own)).otherwise(F.col(other))
    return pairs.select(
        F.least("x", "y").alias("a"),
        F.greatest("x", "y").alias("b"),
        "similarity",
        of("x_copies", "y_copies").alias("a_copies"),
        of("y_copies", "x_copies").alias("b_copies"),
    ).filter("a < b")
