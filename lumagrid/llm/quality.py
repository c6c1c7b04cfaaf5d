"""Quality classifier: document evidence combined with host and path posteriors, shrunk by empirical Bayes.

1. Each text becomes a few numbers about its bytes, words and lines (``FEATURES``).
2. A logistic regression learns from all labelled documents; each Newton step is one grouped sum over
   the labelled rows, so only its coefficients reach the driver. A document's evidence is its log odds
   beyond the labelled base rate.
3. Documents are summed by host and by (host, path). The spread of host means around the global mean beyond
   what chance explains gives the strength of the global prior (method of moments); likewise for the
   paths of a host around their host. A host's posterior is its documents' mean shrunk towards the global
   mean; a path's is shrunk towards its host's. Both leave the document itself out.
4. Posterior log odds = log odds of the path's posterior + the document's evidence.

Edge cases: a text that is null, empty or without words has posterior 0 and is rejected; a null host or path is
the empty one; null labels are ignored and repeated ones count each; without labels of both kinds there
is no evidence and every document that has words is kept; repeated rows are rows of their own; an empty
table gives an empty result; an input column with the name of the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.llm import words as W
from lumagrid.llm.common import apart, materialise, ready

STEPS = 12
RIDGE = 1.0
#: Least posterior of a document that is kept.
THRESHOLD = 0.5

_LETTER = W.byte_class([*range(65, 91), *range(97, 123), *range(128, 256)])
_UPPER = W.byte_class(range(65, 91))
_DIGIT = W.byte_class(range(48, 58))
_SPACE = W.byte_class([0x20, *range(0x09, 0x0E)])
_STOP = W.byte_class(list(b".,;:!?"))
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _STOP | W.byte_class(list(b"'\"()-")))
_WORD = ~_SPACE
FEATURES = (
    "log_words", "letters", "upper", "digits", "space", "stops", "symbols", "word_length", "symbol_words", "capital_words",
    "distinct_words", "repeats", "commonest", "log_line_length", "distinct_lines", "lines_ended",
)
_RESULT = "struct<words: bigint, x: array<float>>"


def _row_sums(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[edges[1:]] - total[edges[:-1]]


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of words and features of each text."""
    size = np.maximum(np.diff(offsets), 1)
    starts, ends, first = W.words(data, offsets, _WORD)
    words = np.diff(first)
    n = np.maximum(words, 1)
    hashes = W.Prefix(data).hashes(starts, ends)
    row = np.repeat(np.arange(len(words)), words)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    order = np.lexsort((hashes, row))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (row[order][1:] != row[order][:-1])
    at = np.flatnonzero(new)
    times = np.diff(np.concatenate((at, [len(order)])))
    commonest = np.zeros(len(words), np.int64)
    np.maximum.at(commonest, row[order][at], times)
    bare = W.byte_class([0x0A], invert=True)
    line_starts, line_ends, first_line = W.words(data, offsets, bare)
    lines = np.diff(first_line)
    line_hash = W.Prefix(data).hashes(line_starts, line_ends)
    distinct = np.diff(W.distinct_per_row(line_hash, first_line)[1])
    last = data[ends - 1] if len(ends) else data
    head = data[starts] if len(starts) else data
    lengths = np.concatenate(([0], np.cumsum(ends - starts)))
    columns = [
        np.log1p(words),
        *(_row_sums(c[data], offsets) / size for c in (_LETTER, _UPPER, _DIGIT, _SPACE, _STOP, _SYMBOL)),
        np.log1p((lengths[first[1:]] - lengths[first[:-1]]) / n),
        _row_sums(_SYMBOL[last], first) / n,
        _row_sums(_UPPER[head], first) / n,
        np.diff(W.distinct_per_row(hashes, first)[1]) / n,
        _row_sums(same, first) / n,
        commonest / n,
        np.log1p(words / np.maximum(lines, 1)),
        distinct / np.maximum(lines, 1),
        _row_sums(_STOP[data[line_ends - 1]] if len(line_ends) else data, first_line) / np.maximum(lines, 1),
    ]
    return words, np.stack(columns, axis=1).astype(np.float32)


def _features_column(text: Column) -> Column:
    @F.arrow_udf(_RESULT)
    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, offsets = W.text_buffer(texts)
            parts = [
                features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]) for a, b in W.runs(offsets)
            ]
            words = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
            x = np.concatenate([p[1] for p in parts]) if parts else np.zeros((0, len(FEATURES)), np.float32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.reshape(-1))
            )
            yield pa.StructArray.from_arrays([pa.array(words, pa.int64()), lists], ["words", "x"])

    return measured(text)


def _sums(rows: DataFrame, weights: np.ndarray | None) -> np.ndarray:
    """Grouped sums over (x, label): moments at first, then gradient and curvature at ``weights``."""
    d = len(FEATURES) + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * d if weights is None else d * d + d + 2)
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().astype(np.float64).reshape(-1, d - 1)
            y = batch.column("label").to_numpy().astype(np.float64)
            if weights is None:
                total += np.concatenate((x.sum(0), [len(x)], (x * x).sum(0), [y.sum()]))
                continue
            x = np.concatenate((x, np.ones((len(x), 1))), axis=1) * weights[1] - weights[2]
            p = 1 / (1 + np.exp(-np.clip(x @ weights[0], -30, 30)))
            curve = (x * (p * (1 - p))[:, None]).T @ x
            total += np.concatenate((curve.reshape(-1), x.T @ (y - p), [len(x), y.sum()]))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], ["i", "v"])

    summed = rows.select("x", "label").mapInArrow(partial, "i int, v double").groupBy("i").agg(F.sum("v").alias("v"))
    found = {r["i"]: r["v"] for r in summed.collect()}
    return np.array([found[i] for i in range(len(found))])


def fit(rows: DataFrame) -> tuple[np.ndarray, float, float] | None:
    """(coefficients of x, intercept, log odds of the base rate) from rows (x, label 0/1); None without both labels."""
    d = len(FEATURES)
    moments = _sums(rows, None)
    if not len(moments) or not 0 < moments[-1] < moments[d]:
        return None
    count, good = moments[d], moments[-1]
    mean = moments[:d] / count
    spread = np.sqrt(np.maximum(moments[d + 1 : -1] / count - mean**2, 1e-12))
    scale, shift = np.append(1 / spread, 1.0), np.append(mean / spread, 0.0)
    base = float(np.log(good / (count - good)))
    w = np.append(np.zeros(d), base)
    for _ in range(STEPS):
        sums = _sums(rows, np.stack((w, scale, shift)))
        curve, slope = sums[: (d + 1) ** 2].reshape(d + 1, d + 1), sums[(d + 1) ** 2 : -2]
        penalty = np.append(np.full(d, RIDGE), 1e-9)
        step = np.linalg.solve(curve + np.diag(penalty + 1e-6), slope - penalty * w)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    return w[:d] * scale[:d], float(w[d] - (w[:d] * shift[:d]).sum()), base


def _strength(mean: Column, between: Column) -> Column:
    """Pseudo-observations of a beta prior whose means spread with variance ``between``."""
    spread = F.greatest(between, mean * (1 - mean) * 1e-4)
    return F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0))


def sites(scored: DataFrame) -> DataFrame:
    """(host, path, n_path, p_path, n_host, p_host, prior, strength, path_strength) from (host, path, p)."""
    paths = scored.groupBy("host", "path").agg(
        F.count("*").alias("n_path"), F.sum("p").alias("p_path"), F.sum(F.col("p") ** 2).alias("q_path")
    )
    paths = materialise(paths, "paths")
    hosts = paths.groupBy("host").agg(
        F.sum("n_path").alias("n_host"),
        F.sum("p_path").alias("p_host"),
        F.sum("q_path").alias("q_host"),
        F.count("*").alias("paths"),
        F.sum(F.col("p_path") ** 2 / F.col("n_path")).alias("s_path"),
        F.sum(F.col("q_path") - F.col("p_path") ** 2 / F.col("n_path")).alias("within_path"),
        F.sum(F.col("n_path") ** 2).alias("n2_path"),
    )
    hosts = materialise(hosts, "hosts")
    # Sums of squares between and within groups give the variance of the groups' true means.
    total = hosts.agg(
        F.sum("n_host").alias("n"),
        F.count("*").alias("h"),
        (F.sum("p_host") / F.sum("n_host")).alias("prior"),
        F.sum(F.col("p_host") ** 2 / F.col("n_host")).alias("s_host"),
        F.sum(F.col("q_host") - F.col("p_host") ** 2 / F.col("n_host")).alias("within_host"),
        (F.sum(F.col("n_host") ** 2) / F.sum("n_host")).alias("n2_host"),
        F.sum("paths").alias("paths"),
        F.sum(F.col("s_path") - F.col("p_host") ** 2 / F.col("n_host")).alias("between_path"),
        F.sum("within_path").alias("within_path"),
        F.sum(F.col("n2_path") / F.col("n_host")).alias("n2_path"),
    )
    one = F.lit(1)
    noise = F.col("within_host") / F.greatest(F.col("n") - F.col("h"), one)
    host_spread = (F.col("s_host") - F.col("n") * F.col("prior") ** 2 - (F.col("h") - 1) * noise) / F.greatest(
        F.col("n") - F.col("n2_host"), one
    )
    noise = F.col("within_path") / F.greatest(F.col("n") - F.col("paths"), one)
    path_spread = (F.col("between_path") - (F.col("paths") - F.col("h")) * noise) / F.greatest(
        F.col("n") - F.col("n2_path"), one
    )
    row = total.select(
        "prior",
        _strength(F.col("prior"), host_spread).alias("strength"),
        _strength(F.col("prior"), path_spread).alias("path_strength"),
    ).first()
    values = [F.lit(float(row[c] if row[c] is not None else 0.5)).alias(c) for c in row.asDict()]
    named = paths.join(hosts.select("host", "n_host", "p_host"), "host")
    return materialise(named.select("host", "path", "n_path", "p_path", "n_host", "p_host", *values), "sites")


def host_of(source: Column) -> Column:
    return F.coalesce(F.regexp_extract(source, r"^(?:[A-Za-z]+://)?([^/?#]*)", 1), F.lit(""))


def path_of(source: Column) -> Column:
    """First path segment; empty if there is none."""
    return F.coalesce(F.regexp_extract(source, r"^(?:[A-Za-z]+://)?[^/?#]*/([^/?#]*)", 1), F.lit(""))


def score(
    docs: DataFrame,
    labels: DataFrame,
    host: Column,
    path: Column,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = THRESHOLD,
    into: str = "quality",
) -> DataFrame:
    """``docs`` with a struct: n_words, evidence (log odds), site (posterior of its path), posterior, kept."""
    ready(docs.sparkSession)
    hosted, pathed = F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))
    # The columns of docs travel in a struct, where no name of theirs can meet one used here; texts are read once.
    given = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != into))
    known = docs.select(
        given.alias("row"), F.col(key).alias("key"), hosted.alias("host"), pathed.alias("path"), _features_column(F.col(text)).alias("f")
    )
    known = materialise(known, "features")
    features = known.select("key", "host", "path", "f.words", "f.x").filter("words > 0")
    told = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    labelled = features.join(apart(told), "key").select("x", "label")
    model = fit(materialise(labelled, "labelled"))
    coefficients, intercept, base = model or (np.zeros(len(FEATURES)), 0.0, 0.0)

    def odds(x: Column) -> Column:
        total = F.lit(intercept)
        for i, c in enumerate(coefficients.tolist()):
            total = total + x[i] * F.lit(c)
        return total

    chance = lambda z: 1 / (1 + F.exp(-z))
    found = sites(features.select("host", "path", chance(odds(F.col("x"))).alias("p")))
    found = found.withColumnRenamed("host", "of_host").withColumnRenamed("path", "of_path")
    rows = known.withColumn("z", odds(F.col("f.x")))
    rows = rows.join(found, (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path")), "left")
    p, c = chance(F.col("z")), F.col
    of_host = (c("strength") * c("prior") + c("p_host") - p) / (c("strength") + c("n_host") - 1)
    of_path = (c("path_strength") * of_host + c("p_path") - p) / (c("path_strength") + c("n_path") - 1)
    of_path = F.greatest(F.least(of_path, F.lit(1 - 1e-6)), F.lit(1e-6))
    evidence = c("z") - F.lit(base)
    posterior = F.when(c("f.words") > 0, chance(F.log(of_path / (1 - of_path)) + evidence)).otherwise(F.lit(0.0))
    posterior = F.coalesce(posterior, F.lit(0.0))
    if model is None:
        posterior, evidence = F.when(c("f.words") > 0, F.lit(1.0)).otherwise(F.lit(0.0)), F.lit(0.0)
    result = F.struct(
        c("f.words").alias("n_words"),
        evidence.alias("evidence"),
        of_path.alias("site"),
        posterior.alias("posterior"),
        (posterior >= threshold).alias("kept"),
    )
    return rows.select("row.*", result.alias(into))


def keep(docs: DataFrame, labels: DataFrame, host: Column, path: Column, **options) -> DataFrame:
    """The documents that are not rejected, with the columns they came with."""
    into = "_quality"
    while into in docs.columns:
        into += "_"
    return score(docs, labels, host, path, into=into, **options).filter(F.col(into)["kept"]).drop(into)
