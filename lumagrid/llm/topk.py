"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Components become whole numbers, floor(scale * x). Queries are sparse rows: for each term (dimension) the
queries with a weight other than zero. A task turns each batch of candidates into postings, one list of
(row, weight) per term, takes the terms one after another, and scatters query weight times posting
weights into a dense array of scores, queries by candidates. A partition by the k-th score then selects;
batches, tasks and at last a window merge the selections.

Queries travel to the tasks in blocks of bounded size; each block is one pass over the candidates, whose selection
is written before the next block is fetched, so the driver holds one block and the plan does not grow with them.

Edge cases: a vector that is null or holds null or non-finite components takes no part; vectors may differ
in length (a missing component is zero); equal scores go to the smaller id; a null id is never a query and
comes last among candidates; rows of the query's own id are no candidates for it; rows that agree in id
and score count once; no candidates, no rows. Scores beyond 64 bits are held at the limit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumagrid.llm.common import materialise, ready
from lumagrid.session import fresh_dir

#: Components of the queries of one block, together.
BLOCK_COMPONENTS = 4 << 20
QUERIES_AT_ONCE, ROWS_AT_ONCE = 32, 8192
_LIMIT = 2**63 - 1
_SCHEMA = "query int, query_id bigint, vec_id bigint, score bigint"


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return vector.isNotNull() & ~F.coalesce(F.exists(vector, bad), F.lit(False))


def whole(values: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): as doubles while that is exact, else as Python integers."""
    scaled = np.floor(values.astype(np.float64) * scale)
    if len(scaled) and np.abs(scaled).max() >= 2**53:
        return np.array([int(x) * scale if abs(x) >= 2**53 else math.floor(x * scale) for x in values.tolist()], object)
    return scaled


class Terms:
    """Rows by term: for each dimension the rows with a weight other than zero, and the weights."""

    def __init__(self, ends: np.ndarray, values: np.ndarray):
        sizes = np.diff(ends)
        row = np.repeat(np.arange(len(sizes)), sizes)
        term = np.arange(len(values)) - np.repeat(ends[:-1] - ends[0], sizes)
        used = values != 0
        row, term, values = row[used], term[used], values[used]
        order = np.argsort(term, kind="stable")
        self.rows, self.weights, term = row[order], values[order], term[order]
        self.edges = np.searchsorted(term, np.arange((term[-1] if len(term) else -1) + 2))
        self.heaviest = max(abs(values.max()), abs(values.min())) if len(values) else 0

    def posting(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.edges[term], self.edges[term + 1])
        return self.rows[own], self.weights[own]

    @property
    def count(self) -> int:
        return len(self.edges) - 1


def scores(queries: Terms, n_queries: int, rows: Terms, n_rows: int) -> np.ndarray:
    """The dense array of inner products, accumulated term after term."""
    terms = min(queries.count, rows.count)
    exact = int(queries.heaviest) * int(rows.heaviest) * max(terms, 1) < 2**53
    total = np.zeros((n_queries, n_rows), np.float64 if exact else object)
    for term in range(terms):
        (q, weight), (r, posting) = queries.posting(term), rows.posting(term)
        if not exact:
            weight, posting = (np.array([int(x) for x in w], object) for w in (weight, posting))
        if len(q) == n_queries and len(r) == n_rows:
            total += weight[:, None] * posting[None, :]
        elif len(r) == n_rows:
            total[q] += weight[:, None] * posting[None, :]
        else:
            for i, w in zip(q.tolist(), weight):
                total[i, r] += w * posting
    return total if exact else np.minimum(np.maximum(total, -_LIMIT - 1), _LIMIT)


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best per query, equal (query, id, score) once; a null id is the largest number here."""
    order = np.lexsort((ids, -score, query))
    query, ids, score = query[order], ids[order], score[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (ids[1:] != ids[:-1]) | (score[1:] != score[:-1])
    query, ids, score = query[new], ids[new], score[new]
    rank = np.arange(len(query)) - np.searchsorted(query, query)
    keep = rank < k
    return query[keep], ids[keep], score[keep]


def _search(batches: Iterator[pa.RecordBatch], block: list[tuple[int, list]], k: int, scale: int) -> Iterator[pa.RecordBatch]:
    own_ids = np.array([i for i, _ in block], np.int64)
    flat = whole(np.array([x for _, v in block for x in v], np.float64), scale)
    ends = np.concatenate(([0], np.cumsum([len(v) for _, v in block])))
    parts = []
    for lo in range(0, len(block), QUERIES_AT_ONCE):
        hi = min(lo + QUERIES_AT_ONCE, len(block))
        parts.append((lo, hi, Terms(ends[lo : hi + 1] - ends[lo], flat[ends[lo] : ends[hi]])))
    best = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            piece = batch.slice(at, ROWS_AT_ONCE)
            vectors = piece.column(1)
            values, edges = vectors.values.to_numpy(zero_copy_only=False), vectors.offsets.to_numpy()
            ids = piece.column(0).fill_null(_LIMIT).to_numpy()
            rows = Terms(edges, whole(values[edges[0] : edges[-1]], scale))
            if len(np.unique(ids)) < len(ids):
                seen: dict[tuple, int] = {}
                for i, name in enumerate(ids.tolist()):
                    seen.setdefault((name, values[edges[i] : edges[i + 1]].tobytes()), i)
                first = np.array(sorted(seen.values()))
            else:
                first = np.arange(len(ids))
            by_id = np.argsort(ids, kind="stable")
            found = [best]
            for lo, hi, queries in parts:
                total = scores(queries, hi - lo, rows, len(ids))
                low, high = (np.searchsorted(ids[by_id], own_ids[lo:hi], side=s) for s in ("left", "right"))
                for q in np.flatnonzero(high > low).tolist():
                    total[q, by_id[low[q] : high[q]]] = -np.inf
                total = total[:, first] if len(first) < len(ids) else total
                cut = np.partition(total, total.shape[1] - k, axis=1)[:, -k] if total.shape[1] > k else np.full(hi - lo, -np.inf)
                q, r = np.nonzero((total >= cut[:, None]) & (total != -np.inf))
                found.append((q + lo, ids[first][r], total[q, r]))
            best = _best(*(np.concatenate([f[j] for f in found]) for j in range(3)), k)
    query, ids, score = best
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(query, pa.int32()),
            pa.array(own_ids[query], pa.int64()),
            pa.array(ids, pa.int64(), mask=ids == _LIMIT),
            pa.array([max(-_LIMIT - 1, min(_LIMIT, int(s))) for s in score.tolist()], pa.int64()),
        ],
        ["query", "query_id", "vec_id", "score"],
    )


def search(
    queries: DataFrame,
    rows: DataFrame,
    k: int = 5,
    key: str = "vec_id",
    vector: str = "embedding",
    scale: int = 256,
    block_components: int = BLOCK_COMPONENTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the highest inner product for each query."""
    spark = ready(rows.sparkSession)
    wanted = queries.filter(usable(F.col(vector)) & F.col(key).isNotNull())
    wanted = wanted.select(F.col(key).alias("id"), F.col(vector).alias("v")).distinct()
    size = wanted.agg(F.sum(F.size("v") + F.lit(1))).first()[0] or 0
    blocks = max(1, -(-int(size) // block_components))
    candidates = rows.filter(usable(F.col(vector))).select(F.col(key).cast("bigint"), F.col(vector))
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))

    def one_pass(block: list) -> tuple[Broadcast, DataFrame]:
        sent = spark.sparkContext.broadcast(sorted((int(r["id"]), list(r["v"])) for r in block))
        found = candidates.mapInArrow(lambda it: _search(it, sent.value, k, scale), _SCHEMA)
        ranked = found.distinct().withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return sent, ranked.select("query_id", "rank", "vec_id", "score")

    if blocks == 1:
        return one_pass(wanted.collect())[1]
    wanted = materialise(wanted.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks))), "queries")
    folder = fresh_dir(spark, "selections")
    for number in range(blocks):
        own = wanted.filter(F.col("block") == number).select("id", "v").collect()
        if own:
            sent, ranked = one_pass(own)
            ranked.write.parquet(f"{folder}/block={number}")
            sent.destroy()
    result = "query_id bigint, rank int, vec_id bigint, score bigint"
    return spark.read.schema(f"{result}, block int").parquet(folder).drop("block")
