"""Families of similar images: one row per distinct histogram in place of all similar pairs.

Keepers meet in the grid of :mod:`lumagrid.operators.duplicates`. Each cell is cut into pieces of bounded size on both
sides, and a kernel compares every pair of pieces exactly. It returns how many links each of its keepers has there and
a spanning star of each group that its links connect, so what leaves a cell grows with its keepers and not with their
pairs. The stars of all cells connect exactly what all links connect; alternating large and small stars join them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumagrid.operators.cells import hist_matrix
from lumagrid.operators.duplicates import SIGNS, _grid, sketch_weights
from lumagrid.session import materialise
from lumagrid.sizing import SLICE_ROWS, split_hot_keys, within_broadcast

CELL_ROWS = 1024


def linked(left: np.ndarray, right: np.ndarray, allowed: np.ndarray, threshold: float) -> np.ndarray:
    """(left, right) whether the similarity of an allowed pair of histograms exceeds ``threshold``."""
    sizes, others = left.sum(axis=1), right.sum(axis=1)
    # Signed sums differ by no more than the histograms do, see the grid: they spare most comparisons bin by bin.
    weights = sketch_weights()[:, :SIGNS].astype(np.float64)
    sums, other_sums = left @ weights, right @ weights
    reach = (1.0 - threshold) / threshold * (1 + 1e-9)
    found = np.zeros((len(left), len(right)), bool)
    for i, (own, size) in enumerate(zip(left, sizes)):
        low, high = np.minimum(size, others), np.maximum(size, others)
        at = np.flatnonzero(allowed[i] & (low >= high * threshold - 1e-6))
        at = at[(np.abs(other_sums[at] - sums[i]) <= (low[at] * reach + 1e-6)[:, None]).all(axis=1)]
        inter = np.minimum(own, right[at]).sum(axis=1)
        found[i, at] = inter / (size + others[at] - inter) > threshold
    return found


def stars(found: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """The groups of rows and columns that the marked cells of a matrix connect."""
    groups, open_rows = [], found.any(axis=1)
    while open_rows.any():
        rows, columns = np.zeros(found.shape[0], bool), np.zeros(found.shape[1], bool)
        edge = np.array([open_rows.argmax()])
        while len(edge):
            rows[edge] = True
            new = found[edge].any(axis=0) & ~columns
            columns |= new
            edge = np.flatnonzero(found[:, new].any(axis=1) & ~rows)
        open_rows &= ~rows
        groups.append((np.flatnonzero(rows), np.flatnonzero(columns)))
    return groups


def _compared(homes: DataFrame, guests: DataFrame, keepers: DataFrame, keys: list[str], threshold: float, cell_rows: int):
    """(u, v, links): how many links ``u`` has in a pair of pieces (v null), or that ``u`` and ``v`` are connected."""
    pieces = lambda df, name: df.groupBy(*keys).agg(
        F.count("*").alias(f"{name}_rows"), F.ceil(F.count("*") / F.lit(cell_rows)).cast("int").alias(name)
    )
    # A keeper visits its own home too: cells that nobody else visits are left out.
    grid = pieces(homes, "ones").join(pieces(guests, "twos"), keys).filter("ones_rows * twos_rows > 1")
    grid = materialise(grid.drop("ones_rows", "twos_rows"), "family-cells")
    grid = F.broadcast(grid) if within_broadcast(grid) else grid

    def side(df: DataFrame, own: str, piece: str, other: str, to: str) -> DataFrame:
        placed = df.select(*keys, "image_id", "cross").join(grid, keys)
        placed = placed.withColumn(piece, F.pmod(F.xxhash64("image_id"), F.col(own)).cast("int"))
        placed = placed.withColumn(to, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop("ones", "twos")
        placed = placed.join(keepers.select("image_id", "hist"), "image_id")
        return placed.select(*[F.col(c).alias(c) for c in (*keys, "one", "two", "image_id", "cross", "hist")])

    left = side(homes, "ones", "one", "twos", "two")
    right = side(guests, "twos", "two", "ones", "one")
    key = keepers.schema["image_id"].dataType
    out = T.StructType([T.StructField("u", key), T.StructField("v", key), T.StructField("links", T.LongType())])
    schema = to_arrow_schema(out)

    def meet(ones: pa.Table, twos: pa.Table) -> pa.Table:
        if not ones.num_rows or not twos.num_rows:
            return schema.empty_table()
        ids, names = ones.column("image_id").to_pylist(), twos.column("image_id").to_pylist()
        order = {x: i for i, x in enumerate(sorted({*ids, *names}))}
        a, b = (np.array([order[x] for x in own]) for own in (ids, names))
        allowed = (a[:, None] < b) | twos.column("cross").to_numpy()
        first, second = (hist_matrix(t.column("hist").combine_chunks()) for t in (ones, twos))
        found = linked(first, second, allowed, threshold)
        rows = [(x, None, int(n)) for own, sums in ((ids, found.sum(axis=1)), (names, found.sum(axis=0)))
                for x, n in zip(own, sums) if n]
        for i, j in stars(found):
            members = sorted({*(ids[k] for k in i), *(names[k] for k in j)})
            rows += [(x, members[0], 0) for x in members[1:]]
        return pa.table([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    group = [*keys, "one", "two"]
    return left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(meet, out)


def _star(edges: DataFrame, large: bool, rows_per_slice: int) -> DataFrame:
    """Neighbours of each node move to its smallest one: the larger neighbours, or the smaller ones with the node."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    left, right = split_hot_keys(both, least, ["u"], F.col("v"), rows_per_slice)
    moved = left.join(right, ["u", "slice"])
    if large:
        moved = moved.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        kept = moved.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        moved = kept.unionByName(least.select("u", F.col("m").alias("v")))
    return moved.distinct()


def components(edges: DataFrame, rows_per_slice: int = SLICE_ROWS) -> DataFrame:
    """(u, v) with v the smallest node connected with u, for all nodes but the smallest ones; edges have ``u > v``."""
    told = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 2**32)).first()
    edges = materialise(edges.select("u", "v").distinct(), "family-edges")
    before = told(edges)
    while True:
        edges = materialise(_star(_star(edges, True, rows_per_slice), False, rows_per_slice), "family-edges")
        after = told(edges)
        if after == before:
            return edges
        before = after


def duplicate_families(
    library: DataFrame,
    threshold: float = 0.98,
    axes: int = 3,
    cell_rows: int = CELL_ROWS,
    rows_per_slice: int = SLICE_ROWS,
) -> DataFrame:
    """(image_id, copies, family, links) for each distinct histogram, told by its smallest image.

    links: how many other distinct histograms are similar to it beyond ``threshold``; family: the smallest image
    that a chain of such links reaches. Histograms without counts are families of their own.
    """
    keepers, homes, guests, keys, _ = _grid(library, threshold, axes)
    met = materialise(_compared(homes, guests, keepers, keys, threshold, cell_rows), "family-links")
    counts = met.filter(F.col("v").isNull()).groupBy(F.col("u").alias("image_id")).agg(F.sum("links").alias("links"))
    family = components(met.filter(F.col("v").isNotNull()), rows_per_slice)
    return (
        keepers.select("image_id", "copies")
        .join(family.select(F.col("u").alias("image_id"), F.col("v").alias("family")), "image_id", "left")
        .join(counts, "image_id", "left")
        .select(
            "image_id",
            "copies",
            F.coalesce("family", "image_id").alias("family"),
            F.coalesce("links", F.lit(0).cast("bigint")).alias("links"),
        )
    )
