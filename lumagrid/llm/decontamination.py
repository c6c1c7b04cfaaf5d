"""Benchmark decontamination: Wu-Manber search for the word windows of benchmark items.

Words are stretches of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z are lower-cased. The windows of
an item are its runs of ten consecutive words (an item of fewer words is one window). All windows
of one length are searched together: a table over hashed blocks of up to three words tells how far
the search may move on from a block; a block that ends a window leads to the bucket of windows that
end so; their first block and then their words themselves are compared. Many stretches of documents
move in step, so that each step is a few numpy calls.

Edge cases: a null or empty text, or one without words, has no words and no hits; an item without words has
no window; a null item id counts as the empty string; items of the same id count once; repeated documents
are rows of their own; an empty item table leaves all documents clean; an input column with the name of
the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.llm import words as W
from lumagrid.llm.common import materialise

WINDOW = 10
BLOCK = 3
#: Items searched for in one pass have at most this many bytes of text; more take several passes.
PASS_BYTES = 32 << 20
#: Window positions that one lane searches before it ends.
LANE = 512

WORD_BYTES = W.byte_class([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])
RESULT = "struct<n_words: bigint, spans: array<struct<start: int, stop: int>>, items: array<string>>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


def _words_of(text: str) -> list[bytes]:
    data = W.LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = W.words(data, np.array([0, len(data)]), WORD_BYTES)
    raw = data.tobytes()
    return [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]


def windows(items: list[tuple[str, str]], window: int = WINDOW) -> dict[tuple[bytes, ...], set[str]]:
    """All windows of the items, and the ids of the items that have each."""
    found: dict[tuple[bytes, ...], set[str]] = {}
    for name, text in items:
        own = _words_of(text or "")
        for i in range(max(len(own) - window + 1, min(len(own), 1))):
            found.setdefault(tuple(own[i : i + window]), set()).add(name or "")
    return found


class Searcher:
    """Windows of one length, ready for search."""

    def __init__(self, length: int, found: list[tuple[tuple[bytes, ...], set[str]]]):
        self.length, self.block = length, min(BLOCK, length)
        self.windows = [b" ".join(w) for w, _ in found]
        self.names = [sorted(names) for _, names in found]
        raw = b" ".join(self.windows)
        data = np.frombuffer(raw, np.uint8)
        starts, ends, _ = W.words(data, np.array([0, len(data)]), WORD_BYTES)
        hashes = W.Prefix(data).hashes(starts, ends).reshape(len(found), length)
        bits = max(16, int(np.ceil(np.log2(len(found) * length + 1))) + 4)
        self.mask = np.uint64((1 << min(bits, 26)) - 1)
        farthest = length - self.block + 1
        self.shift = np.full(int(self.mask) + 1, farthest, np.uint8)
        for j in range(self.block, length + 1):
            blocks = self._blocks([hashes[:, j - self.block + k] for k in range(self.block)])
            np.minimum.at(self.shift, (blocks & self.mask).astype(np.int64), length - j)
        suffix = self._blocks([hashes[:, length - self.block + k] for k in range(self.block)])
        prefix = self._blocks([hashes[:, k] for k in range(self.block)])
        order = np.argsort(suffix, kind="stable")
        self.suffix, self.prefix, self.order = suffix[order], prefix[order], order

    @staticmethod
    def _blocks(parts: list[np.ndarray]) -> np.ndarray:
        value = parts[0]
        for part in parts[1:]:
            value = W.mix(value) + part
        return W.mix(value)

    def search(self, raw: bytes, starts, ends, hashes, first) -> list[tuple[int, int]]:
        """(first word, window number) of all occurrences; no window crosses rows."""
        counts = np.diff(first)
        rows = np.flatnonzero(counts >= self.length)
        places = counts[rows] - self.length + 1
        lanes = -(-places // LANE)
        row = np.repeat(np.arange(len(rows)), lanes)
        part = np.arange(len(row)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = first[:-1][rows][row] + self.length - 1 + part * LANE
        stop = np.minimum(at + LANE, first[:-1][rows][row] + self.length - 1 + places[row])
        ended = []
        while len(at):
            block = self._blocks([hashes[at - self.block + 1 + k] for k in range(self.block)])
            shift = self.shift[(block & self.mask).astype(np.int64)]
            hit = shift == 0
            if hit.any():
                ended.append((at[hit], block[hit]))
            at = at + np.maximum(shift, 1)
            on = at < stop
            at, stop = at[on], stop[on]
        if not ended:
            return []
        at = np.concatenate([a for a, _ in ended])
        block = np.concatenate([b for _, b in ended])
        low, high = np.searchsorted(self.suffix, block), np.searchsorted(self.suffix, block, side="right")
        sizes = high - low
        bucket = np.repeat(low - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        begin = np.repeat(at, sizes) - self.length + 1
        head = self._blocks([hashes[begin + k] for k in range(self.block)])
        same = head == self.prefix[bucket]
        found = []
        for i, w in zip(begin[same].tolist(), self.order[bucket[same]].tolist()):
            own = [raw[s:e] for s, e in zip(starts[i : i + self.length].tolist(), ends[i : i + self.length].tolist())]
            if b" ".join(own) == self.windows[w]:
                found.append((i, w))
        return found


def searchers(found: dict[tuple[bytes, ...], set[str]]) -> list[Searcher]:
    by_length: dict[int, list] = {}
    for window, names in sorted(found.items()):
        by_length.setdefault(len(window), []).append((window, names))
    return [Searcher(length, found) for length, found in sorted(by_length.items())]


def _merged(spans: list[tuple[int, int]]) -> list[dict[str, int]]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [{"start": a, "stop": b} for a, b in out]


def search_batch(texts: pa.Array, known: list[Searcher], before: list | None = None) -> pa.Array:
    """The result struct of each text; ``before`` holds what earlier passes found."""
    data, offsets = W.text_buffer(texts)
    n_words, spans, items = [], [], []
    for start, stop in W.runs(offsets):
        own = offsets[start : stop + 1] - offsets[start]
        lower = W.LOWER[data[offsets[start] : offsets[stop]]]
        starts, ends, first = W.words(lower, own, WORD_BYTES)
        hashes = W.Prefix(lower).hashes(starts, ends)
        raw = lower.tobytes()
        hits: dict[int, tuple[list, set]] = {}
        for one in known:
            found = one.search(raw, starts, ends, hashes, first)
            rows = np.searchsorted(first, [i for i, _ in found], side="right") - 1
            for row, (i, w) in zip(rows.tolist(), found):
                places, names = hits.setdefault(row, ([], set()))
                base = int(first[row])
                places.append((i - base, i - base + one.length))
                names.update(one.names[w])
        for row in range(stop - start):
            places, names = hits.get(row, ([], set()))
            if before is not None and before[start + row] is not None:
                places = places + [(s["start"], s["stop"]) for s in before[start + row]["spans"]]
                names = names | set(before[start + row]["items"])
            spans.append(_merged(places))
            items.append(sorted(names))
        n_words += np.diff(first).tolist()
    return pa.StructArray.from_arrays(
        [pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))],
        ["n_words", "spans", "items"],
    )


def find(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    into: str = "contamination",
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """``docs`` with a struct: number of words, merged hit word ranges, ids of the items that occur.

    The items travel to the tasks in blocks of at most about ``pass_bytes``; each block is one pass over
    the documents, and what a pass has found is written to the shared folder before the next one.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).alias("text"))
    size = named.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    passes = max(1, -(-int(size) // pass_bytes))
    for number in range(passes):
        block = named.filter(F.pmod(F.xxhash64("name", "text"), F.lit(passes)) == number) if passes > 1 else named
        sent = spark.sparkContext.broadcast([(r["name"], r["text"]) for r in block.collect()])
        docs = docs.withColumn(into, _search_column(sent, window, F.col(text), F.col(into) if number else None))
        if number + 1 < passes:
            docs = materialise(docs, "decontamination-pass")
    return docs


def _search_column(sent, window: int, text: Column, before: Column | None) -> Column:
    if before is None:

        @F.arrow_udf(RESULT)
        def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            known = searchers(windows(sent.value, window))
            for texts in batches:
                yield search_batch(texts, known)

        return scan(text)

    @F.arrow_udf(RESULT)
    def scan_on(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        known = searchers(windows(sent.value, window))
        for texts, found in batches:
            yield search_batch(texts, known, found.to_pylist())

    return scan_on(text, before)


def clean(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """Documents without any window of an item, with the columns they came with."""
    into = "_contamination"
    while into in docs.columns:
        into += "_"
    found = find(docs, items, text, into=into, **options)
    return found.filter(F.size(F.col(into)["spans"]) == 0).drop(into)
