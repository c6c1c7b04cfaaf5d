"""Removal of repeated passages with suffix arrays built by linear grouping.

A byte goes when a string of ``size`` bytes that covers it also starts earlier: in a document of smaller key, or
before in the same one. A suffix array of a whole corpus fits no task, so strings that may be equal are first
brought together:

1. Every window of ``size`` bytes picks the rightmost least of its grams (half its length); equal windows pick the
   same gram at the same place. An occurrence of a picked gram stands for the windows around it, its context.
   Each task sends the first of equal contexts it meets; the rest repeat it, whichever is the first of all.
2. Occurrences meet by gram. Those whose context is repeated are settled: all their windows start earlier elsewhere.
   Only grams in several different contexts go on.
3. Two contexts that share a window also share three quarters of one, on the left or the right of the gram; such
   contexts meet again with their bytes, cut into blocks aligned to the gram. The suffix array of the blocks
   (``suffix_array``) puts all places with nine equal blocks next to each other; the bytes before and after
   those blocks then tell the equal windows, the first of which stays.
4. A gram with more contexts than one suffix array takes (the edge of a passage that many documents share) is left
   out of step 3. Its windows meet one by one, by a hash of all their bytes, after each task has settled the
   repeats among its own; so no group grows with the number of documents that share the passage.

Edge cases: texts are UTF-8 bytes, null and empty ones have none; a text shorter than ``size`` loses nothing; documents
of one key are told apart, and ordered, by a hash of their text, and rows that agree in both are one document; a
null key comes first; an empty table gives an empty result. The input must give the same rows each time it is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumagrid.llm import words as W
from lumagrid.llm.common import bitmap, materialise, ready

SIZE = 100
#: Contexts that share one suffix array, at most; a gram with more of them is solved window by window.
TOGETHER = 4096
_TIE = 26

SPANS = "array<struct<start: bigint, stop: bigint>>"
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def suffix_array(text: list[int]) -> list[int]:
    """Start places of all suffixes in order.

    text: whole numbers; the last one smaller than all others. First the suffixes are grouped by their Lyndon
    prefix: groups are taken from the largest down, and each suffix of a group moves the nearest earlier suffix
    of a smaller group up behind its own group, the farther the more often it is pointed at. Then one sweep
    from the smallest suffix puts, along the same pointers, every group in order.
    """
    n = len(text)
    place = np.argsort(np.asarray(text), kind="stable")
    symbols = np.asarray(text)[place]
    starts = np.flatnonzero(np.concatenate(([True], symbols[1:] != symbols[:-1])))
    sizes = np.diff(np.concatenate((starts, [n])))
    group_of = np.empty(n, np.int64)
    group_of[place] = np.repeat(starts, sizes)
    at = np.empty(n, np.int64)
    at[place] = np.arange(n)
    length = np.zeros(n, np.int64)
    length[starts] = sizes
    order, group, at, length = place.tolist(), group_of.tolist(), at.tolist(), length.tolist()
    before = [-1] * n

    def lift(j: int) -> int:
        """Moves a suffix to the end of its group and returns the group's start."""
        g = group[j]
        end = g + length[g] - 1
        other, here = order[end], at[j]
        order[here], order[end], at[other], at[j] = other, j, here, end
        return g

    end = n - 1
    while end >= 0:
        first = group[order[end]]
        if first == end:
            i = order[end]
            p = i - 1
            while p >= 0 and group[p] >= first:
                p = before[p]
            before[i] = p
            if p >= 0 and length[group[p]] > 1:
                g = lift(p)
                length[g] -= 1
                new = g + length[g]
                group[p], length[new] = new, 1
            end -= 1
            continue
        pointed: dict[int, int] = {}
        for i in sorted(order[first : end + 1]):
            p = i - 1
            while p >= 0 and group[p] >= first:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        levels: dict[int, list[int]] = {}
        for p, times in pointed.items():
            levels.setdefault(times, []).append(p)
        for times in sorted(levels, reverse=True):
            moved: dict[int, list[int]] = {}
            for p in levels[times]:
                moved.setdefault(group[p], []).append(p)
            for g, own in moved.items():
                if len(own) == length[g]:
                    continue
                for p in own:
                    lift(p)
                    length[g] -= 1
                new = g + length[g]
                length[new] = len(own)
                for p in own:
                    group[p] = new
        end = first - 1

    out = [-1] * n
    placed = [False] * n
    following = list(range(n))
    out[0] = n - 1
    placed[n - 1] = True
    following[group[n - 1]] += 1
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[following[g]] = j
            following[g] += 1
            placed[j] = True
            j = before[j]
    return out


class Shape:
    """The lengths that follow from the length of a repeated string."""

    def __init__(self, size: int):
        self.size = size
        self.block = max(1, size // 10)
        self.gram = size // 2
        self.left = size - self.gram
        self.context = self.left + size
        self.half = self.left - self.left // 2


def picked(data: np.ndarray, offsets: np.ndarray, shape: Shape) -> tuple[np.ndarray, ...]:
    """Occurrences of picked grams: place, gram hash, context hash, bytes of context before it and from it on."""
    size, k = shape.size, shape.gram
    none = np.zeros(0, np.int64)
    if len(data) < size:
        return none, none.view(np.uint64), none.view(np.uint64), none, none
    prefix = W.Prefix(data)
    grams = prefix.rolling(k)
    last = np.uint64((1 << _TIE) - 1)
    # Hash above, place below: the least value is the rightmost of the least hashes.
    least = (grams | last) ^ (np.arange(len(grams), dtype=np.uint64) & last)
    wide, span = size - k + 1, 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        least = np.minimum(least[: len(least) - (wide - span)], least[wide - span :])
    long = np.flatnonzero(np.diff(offsets) >= size)
    step = np.zeros(len(least) + 1, np.int8)
    np.add.at(step, offsets[long], 1)
    np.add.at(step, offsets[long + 1] - size + 1, -1)
    window = np.flatnonzero(np.cumsum(step[:-1], dtype=np.int8))
    least = least[window]
    new = np.ones(len(window), bool)
    new[1:] = least[1:] != least[:-1]
    window, low = window[new], (last - (least[new] & last)).astype(np.int64)
    p = window + ((low - window) & int(last))
    row = np.searchsorted(offsets, p, side="right") - 1
    begin, end = np.maximum(offsets[row], p - shape.left), np.minimum(offsets[row + 1], p + size)
    context = W.mix(prefix.hashes(begin, end) + (p - begin).astype(np.uint64))
    return p, grams[p], context, p - begin, end - p


def _merged(starts: np.ndarray, stops: np.ndarray) -> list[dict[str, int]]:
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order])
    new = np.concatenate(([True], starts[1:] > stops[:-1]))
    last = np.concatenate((np.flatnonzero(new)[1:] - 1, [len(starts) - 1]))
    return [{"start": a, "stop": b} for a, b in zip(starts[new].tolist(), stops[last].tolist())]


def _occurrences(batch: pa.RecordBatch, shape: Shape) -> dict[str, np.ndarray]:
    """All occurrences of a batch, equal contexts side by side in order, and which is the first of its kind."""
    data, offsets = W.text_buffer(batch.column("text"))
    named = batch.column("key").is_valid().to_numpy(zero_copy_only=False)
    keys, hashes = batch.column("key").fill_null(0).to_numpy(), batch.column("text_hash").to_numpy()
    parts = []
    for a, b in W.runs(offsets):
        own = offsets[a : b + 1] - offsets[a]
        p, gram, context, left, right = picked(data[offsets[a] : offsets[b]], own, shape)
        row = np.searchsorted(own, p, side="right") - 1
        parts.append((row + a, p - own[row], gram, context, left, right))
    row, p, gram, context, left, right = (np.concatenate([x[j] for x in parts]) for j in range(6))
    by_key = np.lexsort((hashes, keys, named))
    same = np.ones(len(by_key), bool)
    same[:1] = False
    for column in (hashes, keys, named):
        same[1:] &= column[by_key][1:] == column[by_key][:-1]
    rank = np.empty(len(by_key), np.int64)
    rank[by_key] = np.cumsum(~same)
    # Equal contexts side by side, in order of document and place.
    order = np.argsort(rank[row], kind="stable")
    order = order[np.argsort(W.mix(gram[order]) + context[order], kind="stable")]
    row, p, gram, context, left, right = (x[order] for x in (row, p, gram, context, left, right))
    head = np.ones(len(p), bool)
    head[1:] = (gram[1:] != gram[:-1]) | (context[1:] != context[:-1])
    of = np.maximum.accumulate(np.where(head, np.arange(len(p)), 0))
    repeated = (rank[row] != rank[row[of]]) | (p != p[of])
    return {"row": row, "p": p, "gram": gram, "context": context, "left": left, "right": right, "head": head, "repeated": repeated}


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    text_hash = F.hash(F.coalesce(F.col(text), F.lit("")))
    return docs.select(F.col(key).cast("bigint").alias("key"), text_hash.alias("text_hash"), F.col(text).alias("text"))


def _equal(left: DataFrame, right: DataFrame) -> Column:
    return left["key"].eqNullSafe(right["key"]) & (left["text_hash"] == right["text_hash"])


def _first_pass(known: DataFrame, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """(key, text_hash, spans) repeated within a task; (gram, context, key, text_hash, at) the first of each context."""

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            o = _occurrences(batch, shape)
            own = np.flatnonzero(o["repeated"])
            own = own[np.argsort(o["row"][own], kind="stable")]
            rows, at = np.unique(o["row"][own], return_index=True)
            spans = [
                _merged((o["p"] - o["left"])[i], (o["p"] + o["right"])[i]) for i in (np.split(own, at[1:]) if len(rows) else [])
            ]
            found = batch.select(["key", "text_hash"]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*found.columns, pa.array(spans, _SPAN)], ["key", "text_hash", "spans"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            o = _occurrences(batch, shape)
            own = np.flatnonzero(o["head"])
            found = batch.select(["key", "text_hash"]).take(pa.array(o["row"][own]))
            at = (o["p"][own] << 20) | (o["left"][own] << 10) | o["right"][own]
            hashes = [pa.array(o[c][own].view(np.int64)) for c in ("gram", "context")]
            yield pa.RecordBatch.from_arrays([*hashes, *found.columns, pa.array(at)], ["gram", "context", "key", "text_hash", "at"])

    return (
        known.mapInArrow(settled, f"key bigint, text_hash int, spans {SPANS}"),
        known.mapInArrow(first, "gram bigint, context bigint, key bigint, text_hash int, at bigint"),
    )


def _met(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, text_hash, text, at, far): documents beside their wanted contexts, those of large grams in ``far``."""
    lists = wanted.groupBy("key", "text_hash").agg(
        F.collect_list(F.when(~F.col("large"), F.col("at"))).alias("at"),
        F.collect_list(F.when(F.col("large"), F.col("at"))).alias("far"),
    )
    lists = materialise(lists, "wanted-contexts")
    maybe = bitmap(lists.select(F.xxhash64("key", "text_hash").alias("h")), "h")
    own = known.filter(maybe(F.xxhash64("key", "text_hash"))).dropDuplicates(["key", "text_hash"])
    return own.join(lists, _equal(own, lists)).select(own["key"], own["text_hash"], "text", "at", "far")


def _contexts(met: DataFrame, shape: Shape) -> DataFrame:
    """(meet, key, text_hash, p, left, right, bytes): contexts, once for each three quarters they may share."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            data, offsets = W.text_buffer(batch.column("text"))
            raw = data.tobytes()
            rows = zip(batch.column("key").to_pylist(), batch.column("text_hash").to_pylist(), batch.column("at").to_pylist())
            for i, (key, text_hash, places) in enumerate(rows):
                for at in places:
                    p, left, right = at >> 20, (at >> 10) & 1023, at & 1023
                    q = int(offsets[i]) + p
                    body = raw[q - left : q + right]
                    cuts = []
                    if left >= shape.half:
                        cuts.append(b"l" + raw[q - shape.half : q + shape.gram])
                    if right >= shape.gram + shape.left // 2:
                        cuts.append(b"r" + raw[q : q + shape.gram + shape.left // 2])
                    for c in cuts:
                        meet = int.from_bytes(hashlib.blake2b(c, digest_size=8).digest(), "little", signed=True)
                        for column, value in zip(columns, (meet, key, text_hash, p, left, right, body)):
                            column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            names = ["meet", "key", "text_hash", "p", "left", "right", "body"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return met.mapInArrow(cut, "meet bigint, key bigint, text_hash int, p bigint, left int, right int, body binary")


def _window_spans(met: DataFrame, shape: Shape) -> DataFrame:
    """(key, text_hash, spans) of the repeated windows in contexts of large grams."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = W.text_buffer(batch.column("text"))
            raw = data.tobytes()
            named = batch.column("key").is_valid().to_numpy(zero_copy_only=False)
            key, text_hash = batch.column("key").fill_null(0).to_numpy(), batch.column("text_hash").to_numpy()
            by_doc = np.lexsort((text_hash, key, named))
            far = batch.column("far")
            doc = np.repeat(np.arange(len(batch)), far.value_lengths().to_numpy(zero_copy_only=False))
            at = far.flatten().to_numpy()
            # Documents in order, so that the repeats of a slice are settled by its first places.
            rank = np.empty(len(batch), np.int64)
            rank[by_doc] = np.arange(len(batch))
            by = np.argsort(rank[doc], kind="stable")
            doc, at = doc[by], at[by]
            for a in range(0, len(at), TOGETHER):
                own, p, left, right = doc[a : a + TOGETHER], *((x[a : a + TOGETHER]) for x in (at >> 20, (at >> 10) & 1023, at & 1023))
                many = left + right - shape.size + 1
                start = np.repeat(p - left, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                # Neighbouring contexts share windows: each place once, in order.
                when = np.unique((np.repeat(rank[own], many) << 36) + start)
                row, start = by_doc[when >> 36], when & ((1 << 36) - 1)
                q = (offsets[row] + start).tolist()
                digests = b"".join(hashlib.blake2b(raw[i : i + shape.size], digest_size=16).digest() for i in q)
                w, v = np.frombuffer(digests, np.int64).reshape(-1, 2).T
                order = np.lexsort((np.arange(len(w)), v, w))
                head = np.ones(len(w), bool)
                head[1:] = (w[order][1:] != w[order][:-1]) | (v[order][1:] != v[order][:-1])
                first, later = np.sort(order[head]), np.sort(order[~head])
                docs, edges = np.unique(rank[row[later]], return_index=True)
                merged = [_merged(x, x + shape.size) for x in (np.split(start[later], edges[1:]) if len(docs) else [])]
                spans = [(i, x["start"], x["stop"]) for i, own_spans in zip(by_doc[docs].tolist(), merged) for x in own_spans]
                row_, start_, stop_ = np.array(spans, np.int64).reshape(-1, 3).T
                # Settled spans need no meeting: any even deal does.
                deal = W.mix((text_hash[row_].astype(np.int64) << 32 ^ start_).view(np.uint64)).view(np.int64)
                rows = pa.array(np.concatenate((row[first], row_)))
                found = batch.select(["key", "text_hash"]).take(rows)
                columns = [
                    np.concatenate((np.zeros(len(first), bool), np.ones(len(row_), bool))),
                    np.concatenate((w[first], deal)),
                    np.concatenate((v[first], start_)),
                    np.concatenate((start[first], start_)),
                    np.concatenate((start[first] + shape.size, stop_)),
                ]
                names = ["key", "text_hash", "settled", "w", "v", "start", "stop"]
                yield pa.RecordBatch.from_arrays([*found.columns, *map(pa.array, columns)], names)

    schema = "key bigint, text_hash int, settled boolean, w bigint, v bigint, start bigint, stop bigint"
    rows = met.filter(F.size("far") > 0).mapInArrow(windows, schema)
    place = F.rank().over(Window.partitionBy("w", "v", "settled").orderBy("key", "text_hash", "start"))
    rows = rows.withColumn("place", place).filter("settled or place > 1")
    return rows.select("key", "text_hash", F.array(F.struct("start", "stop")).alias("spans"))


def repeats(bodies: list[bytes], left: np.ndarray, right: np.ndarray, rank: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(context, start in the context's frame) of windows that a context of smaller (rank, start) has too.

    The frame puts the gram at ``shape.left``. rank: number that orders documents and places: rank + start orders windows.
    """
    m, block, width = len(bodies), shape.block, shape.context
    frame = np.zeros((m, width), np.uint8)
    begin, end = shape.left - left, shape.left + right
    sizes = left + right
    row = np.repeat(np.arange(m), sizes)
    column = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[row]
    frame[row, column] = np.frombuffer(b"".join(bodies), np.uint8)
    blocks = width // block
    cells = np.ascontiguousarray(frame[:, : blocks * block].reshape(m * blocks, block))
    _, symbols = np.unique(cells.view(f"V{block}").reshape(-1), return_inverse=True)
    symbols = symbols.reshape(m, blocks).astype(np.int64)
    edge = np.arange(blocks) * block
    whole = (edge[None, :] >= begin[:, None]) & (edge[None, :] + block <= end[:, None])
    top = int(symbols.max()) + 2
    lone = top + np.arange(m * (blocks + 1)).reshape(m, blocks + 1)
    text = np.concatenate((np.where(whole, symbols + 1, lone[:, :-1]), lone[:, -1:]), axis=1).reshape(-1)
    order = np.array(suffix_array([*text.tolist(), 0]))
    # Places with enough blocks after them for a window less one block, in the order of their suffixes.
    inner = shape.size // block - 1
    offset = order % (blocks + 1)
    order = order[(order < len(text)) & (offset <= blocks - inner)]
    equal = np.ones(len(order) - 1, bool)
    for k in range(inner):
        equal &= text[order[1:] + k] == text[order[:-1] + k]
    cluster = np.concatenate(([0], np.cumsum(~equal)))
    several = np.bincount(cluster)[cluster] > 1
    order, cluster = order[several], cluster[several]
    owner, start = order // (blocks + 1), order % (blocks + 1) * block
    found = []
    for t in range(block):
        first = start - t
        ok = (first >= begin[owner]) & (first + shape.size <= end[owner])
        c, x, s = cluster[ok], owner[ok], first[ok]
        if not len(c):
            continue
        around = np.concatenate([frame[x, s + j][:, None] for j in range(t)] + [frame[x, s + shape.size - 1 - j][:, None] for j in range(block - t)], axis=1)
        packed = np.ascontiguousarray(around).view(f"V{block}").reshape(-1)
        _, packed = np.unique(packed, return_inverse=True)
        when = rank[x] + s
        by = np.lexsort((when, packed, c))
        head = np.ones(len(by), bool)
        head[1:] = (c[by][1:] != c[by][:-1]) | (packed[by][1:] != packed[by][:-1])
        of = np.maximum.accumulate(np.where(head, np.arange(len(by)), 0))
        later = when[by] > when[by][of]
        found.append((x[by][later], s[by][later]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _array_spans(contexts: DataFrame, shape: Shape) -> DataFrame:
    """(key, text_hash, spans) of the windows that suffix arrays find repeated."""

    def solve(tables: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(tables).combine_chunks()
        key = table.column("key").fill_null(0).to_numpy()
        named = table.column("key").is_valid().to_numpy()
        text_hash, p = table.column("text_hash").to_numpy(), table.column("p").to_numpy()
        left, right = (table.column(c).to_numpy().astype(np.int64) for c in ("left", "right"))
        # One number per context that orders windows by document and place, once the window's start is added.
        by_doc = np.lexsort((text_hash, key, named))
        new = np.ones(len(by_doc), bool)
        for column in (text_hash, key, named):
            new[1:] &= column[by_doc][1:] == column[by_doc][:-1]
        new[1:] = ~new[1:]
        doc = np.empty(len(by_doc), np.int64)
        doc[by_doc] = np.cumsum(new)
        rank = (doc << 36) + p + shape.context
        x, s = repeats(table.column("body").to_pylist(), left, right, rank, shape)
        start = p[x] - shape.left + s
        by = np.argsort(doc[x], kind="stable")
        x, start = x[by], start[by]
        docs, at = np.unique(doc[x], return_index=True)
        spans = [_merged(i, i + shape.size) for i in (np.split(start, at[1:]) if len(docs) else [])]
        found = table.select(["key", "text_hash"]).take(pa.array(x[at] if len(docs) else [], pa.int64())).combine_chunks()
        columns = [found.column(c).combine_chunks() for c in ("key", "text_hash")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(spans, _SPAN)], ["key", "text_hash", "spans"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        waiting: list[pa.Table] = []
        count = 0

        def several(table: pa.Table) -> pa.Table:
            meet = table.column("meet").to_numpy()
            same = np.zeros(len(meet), bool)
            same[1:] = meet[1:] == meet[:-1]
            same[:-1] |= same[1:]
            return table.filter(pa.array(same))

        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            meet = held.column("meet").to_numpy()
            open_from = int(np.searchsorted(meet, meet[-1]))
            done = several(held.slice(0, open_from).combine_chunks())
            held = held.slice(open_from).combine_chunks()
            meet = done.column("meet").to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], meet[1:] != meet[:-1]))) if len(meet) else np.zeros(0, int)
            at = 0
            while at < len(meet):
                # Whole groups, as many as fit.
                room = at + max(1, TOGETHER - count)
                i = int(np.searchsorted(edges, room, side="left"))
                stop = int(edges[i]) if i < len(edges) else len(meet)
                waiting.append(done.slice(at, stop - at))
                count += stop - at
                at = stop
                if count >= TOGETHER:
                    yield solve(waiting)
                    waiting, count = [], 0
        if held is not None and held.num_rows:
            last = several(held)
            if last.num_rows:
                waiting.append(last)
        if waiting:
            yield solve(waiting)

    rows = contexts.repartition("meet").sortWithinPartitions("meet")
    return rows.mapInArrow(search, f"key bigint, text_hash int, spans {SPANS}")


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(key, text_hash, spans): the byte ranges to remove of every document that loses any."""
    ready(docs.sparkSession)
    if size < 20 or size % 10 or size > 1000:
        raise ValueError("size must be a multiple of ten from 20 to 1000")
    shape = Shape(size)
    known = _identified(docs, key, text)
    settled, first = _first_pass(known.filter(F.octet_length("text") >= size), shape)
    order = ["key", "text_hash", F.shiftright("at", 20)]
    gram, context = Window.partitionBy("gram"), Window.partitionBy("gram", "context").orderBy(*order)
    # Dealt by gram once, which serves both windows.
    ranked = first.repartition("gram").withColumn("rank", F.rank().over(context))
    several = F.sum(F.when(F.col("rank") == 1, 1)).over(gram)
    ranked = ranked.withColumns({"x": F.min("context").over(gram), "y": F.max("context").over(gram), "n": several})
    large = (F.col("n") > TOGETHER).alias("large")
    ranked = ranked.filter("rank > 1 or x <> y").select("key", "text_hash", "at", "rank", large)
    ranked = materialise(ranked, "gram-occurrences")
    p, left, right = F.shiftright("at", 20), F.shiftright("at", 10).bitwiseAND(1023), F.col("at").bitwiseAND(1023)
    copies = ranked.filter("rank > 1").select(
        "key", "text_hash", F.array(F.struct((p - left).alias("start"), (p + right).alias("stop"))).alias("spans")
    )
    met = _met(known, ranked.filter("rank = 1"))
    contexts = _contexts(met.filter(F.size("at") > 0), shape)
    spans = settled.union(copies).union(_array_spans(contexts, shape)).union(_window_spans(met, shape))
    return spans.groupBy("key", "text_hash").agg(F.flatten(F.collect_list("spans")).alias("spans"))


def _kept(raw: bytes, spans: list[dict] | None) -> tuple[list[bytes], int, int]:
    if not spans:
        return [raw], 0, 0
    merged = _merged(np.array([s["start"] for s in spans]), np.array([s["stop"] for s in spans]))
    parts, at = [], 0
    for s in merged:
        parts.append(raw[at : s["start"]])
        at = s["stop"]
    return [*parts, raw[at:]], sum(s["stop"] - s["start"] for s in merged), len(merged)


def remove(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """(key, kept binary, n_bytes, n_removed, n_spans) of every document.

    What is kept is bytes: a cut may fall inside a character.
    """
    found = materialise(find(docs, key, text, size), "repeated-spans")
    maybe = bitmap(found.select(F.xxhash64("key", "text_hash").alias("h")), "h")
    known = _identified(docs, key, text).withColumn("maybe", maybe(F.xxhash64("key", "text_hash")))
    plain = known.filter(~F.col("maybe")).select("key", "text", F.lit(None).cast(SPANS).alias("spans"))
    rest = known.filter("maybe")
    rest = rest.join(found, _equal(rest, found), "left").select(rest["key"], "text", "spans")

    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = [_kept((t or "").encode(), s) + (len((t or "").encode()),) for t, s in zip(texts.to_pylist(), spans.to_pylist())]
        return pa.StructArray.from_arrays(
            [
                pa.array([b"".join(parts) for parts, *_ in rows], pa.binary()),
                *(pa.array([r[j] for r in rows], pa.int64()) for j in (3, 1, 2)),
            ],
            ["kept", "n_bytes", "n_removed", "n_spans"],
        )

    cutter = F.arrow_udf(cut, "struct<kept: binary, n_bytes: bigint, n_removed: bigint, n_spans: bigint>")
    return rest.union(plain).select("key", cutter("text", "spans").alias("r")).select(F.col("key").alias(key), "r.*")
