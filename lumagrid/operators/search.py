"""Whole-image search by histogram intersection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumagrid import checks
from lumagrid.functions import histograms as H
from lumagrid.operators.cells import hist_matrix
from lumagrid.sizing import within_broadcast

QUERY_BATCH = 4096
LIBRARY_CELL = 50_000


def search_bins(bins: DataFrame, query: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` images for one query, both sides as (.., gray, n) rows.

    The query has at most 256 rows (one per gray value), which bounds the broadcast. The left
    join keeps images that share no gray value with it; they score 0.
    """
    checks.count_of(n)
    probe = query.groupBy("gray").agg(F.sum("n").alias("qn"))
    missing = F.raise_error(F.lit("the query image is missing")).cast("bigint")
    query_total = F.coalesce(query.agg(F.sum("n")).scalar(), missing)
    shared = F.least("n", F.coalesce("qn", F.lit(0)))
    return (
        bins.join(F.broadcast(probe), "gray", "left")
        .groupBy("image_id")
        .agg(F.sum(shared).alias("inter"), F.sum("n").alias("total"))
        .select("image_id", H.overlap(F.col("inter"), F.col("total"), query_total).alias("similarity"))
        .orderBy(F.desc("similarity"), "image_id")
        .limit(n)
    )


def search(library: DataFrame, query: DataFrame, n: int = 5) -> DataFrame:
    """Top ``n`` images of a stored library for one query row, both with a dense ``hist``.

    The query enters as a scalar subquery: the library is scanned once (id and histogram only)
    and reduced by a top-n per partition; nothing is shuffled but the winners. The search fails
    when the query has no row or more than one.
    """
    checks.count_of(n)
    missing = F.raise_error(F.lit("the query image is missing")).cast(query.schema["hist"].dataType)
    return (
        library.select("image_id", "hist")
        .withColumn("q", F.coalesce(query.select("hist").scalar(), missing))
        .select("image_id", H.similarity(F.col("hist"), F.col("q")).alias("similarity"))
        .orderBy(F.desc("similarity"), "image_id")
        .limit(n)
    )


class _Best:
    """The best ``n`` rows seen so far, per query; ties go to the smaller image id."""

    def __init__(self, query_ids: list, hists: np.ndarray, n: int):
        self.query_ids, self.hists, self.n = query_ids, hists, n
        self.totals = hists.sum(axis=1)
        self.rows: list[list[tuple]] = [[] for _ in query_ids]

    def see(self, image_ids: list, hists: np.ndarray) -> None:
        totals = hists.sum(axis=1)
        # Half the memory traffic where the counts allow it.
        fits = max(hists.max(initial=0), self.hists.max(initial=0)) * 256 < 2**31
        kind = np.int32 if fits else np.int64
        hists, probes = hists.astype(kind), self.hists.astype(kind)
        for q, probe in enumerate(probes):
            rows, size = self.rows[q], self.totals[q]
            floor = -rows[-1][0] if len(rows) == self.n else -1.0
            # Similarity cannot exceed smaller total / larger total.
            bound = np.minimum(totals, size) / np.maximum(np.maximum(totals, size), 1)
            near = np.flatnonzero(bound >= floor)
            if not len(near):
                continue
            rows_near = hists if len(near) == len(hists) else hists[near]
            inter = np.minimum(rows_near, probe).sum(axis=1, dtype=kind).astype(np.int64)
            union = totals[near] + size - inter
            score = np.where(union > 0, inter / np.maximum(union, 1), 0.0)
            if len(score) > self.n:
                floor = max(floor, np.partition(score, -self.n)[-self.n])
            keep = np.flatnonzero(score >= floor)
            rows.extend((-float(score[k]), image_ids[near[k]]) for k in keep)
            rows.sort()
            del rows[self.n :]

    def table(self, schema: pa.Schema) -> pa.Table:
        flat = [(q, i, -s) for q, rows in zip(self.query_ids, self.rows) for s, i in rows]
        columns = list(zip(*flat)) if flat else [(), (), ()]
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def search_many(
    library: DataFrame, queries: DataFrame, n: int = 5, max_batch: int = QUERY_BATCH
) -> DataFrame:
    """(query_id, image_id, similarity, rank): top ``n`` images for each query row.

    Every task keeps only the best ``n`` per query of what it has read, so the shuffle carries
    winners, never pairs. A batch of at most ``max_batch`` queries (about 1 KB each) travels with
    the task; a larger table of queries is laid out as a grid of library cells by query cells,
    each cell pair being one bounded group.
    """
    checks.count_of(n)
    out = T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("image_id", library.schema["image_id"].dataType),
            T.StructField("similarity", T.DoubleType()),
        ]
    )
    library = library.select("image_id", F.col("hist").cast("array<bigint>").alias("hist"))
    queries = queries.select("query_id", F.col("hist").cast("array<bigint>").alias("hist"))
    if within_broadcast(queries, max_rows=max_batch):
        partial = _search_batch(library, queries, n, out)
    else:
        partial = _search_grid(library, queries, n, out, max_batch)
    best_first = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "image_id")
    return partial.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= n)


def _search_batch(library, queries, n, out):
    batch: pd.DataFrame = queries.toPandas()
    ids = batch["query_id"].tolist()
    probes = np.array(batch["hist"].tolist(), np.int64).reshape(len(ids), 256)
    schema = to_arrow_schema(out)

    def scan(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(ids, probes, n)
        for part in parts:
            best.see(part.column("image_id").to_pylist(), hist_matrix(part.column("hist")))
        yield from best.table(schema).to_batches()

    return library.mapInArrow(scan, out)


def _search_grid(library, queries, n, out, max_batch):
    rows = -(-library.count() // LIBRARY_CELL) or 1
    cols = -(-queries.count() // max_batch) or 1
    cell = lambda key, many: F.pmod(F.xxhash64(key), F.lit(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    left = library.withColumn("row", cell("image_id", rows)).withColumn("col", every(cols))
    right = queries.withColumn("col", cell("query_id", cols)).withColumn("row", every(rows))
    schema = to_arrow_schema(out)

    def compare(images: pa.Table, probes: pa.Table) -> pa.Table:
        best = _Best(
            probes.column("query_id").to_pylist(), hist_matrix(probes.column("hist").combine_chunks()), n
        )
        if images.num_rows:
            best.see(
                images.column("image_id").to_pylist(), hist_matrix(images.column("hist").combine_chunks())
            )
        return best.table(schema)

    return (
        left.groupBy("row", "col").cogroup(right.groupBy("row", "col")).applyInArrow(compare, out)
    )
