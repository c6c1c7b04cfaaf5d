"""MinHash near-duplicates: banded universal-hash minima, verified links, alternating star components.

Words are stretches of non-white-space bytes after A-Z are lower-cased; a document's set is its distinct
five-word shingles (fewer words: one shingle of all). Two documents are linked when their sets' similarity
reaches the threshold; a component's id is its smallest document key.

1. One pass gives each document 128 minima of universal hashes (16 bits each are kept) and a digest of its
   set. Documents with one set are a class; from here on only classes are handled, so a text copied into a
   third of all rows is one node.
2. 32 bands of 4 minima put classes into buckets. A similarity of 0.8 is missed by all bands with a
   probability below 1e-7. In buckets of more than two, each class is first held against the smallest members of
   two of its buckets; those links merge most of a large group. Then every pair of members that are still in
   different components is compared, in cells bounded in members and bytes that hold signatures and texts: the
   most alike first, passing over pairs that links found before have joined, so that a cell gives a forest of links.
3. Pairs whose signatures come within 4.5 standard deviations of the threshold are confirmed on
   the full sets of both texts.
4. Components: large-star and small-star in turn until the edges stay the same; each round is a
   table in the shared folder. The stars of the first links are kept; links of the cells only join their roots.

Edge cases: columns of the documents may have any names; null, empty or wordless texts have an empty set and are components of their own; rows that
agree in key and text are equal rows and share a result; a null key never becomes a component id unless
all keys of the component are null; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.llm import words as W
from lumagrid.llm.common import apart, bitmap, free, hash_of, materialise, ready

WIDTH = 5
MINIMA, ROWS = 128, 4
BANDS = MINIMA // ROWS
#: Members of a bucket, and shingles of theirs, that are compared with each other in one piece.
CELL, CELL_SHINGLES = 512, 1 << 20

WORD_BYTES = W.byte_class([0x20, *range(0x09, 0x0E)], invert=True)

_draw = np.random.default_rng(7)
_MULTIPLY = _draw.integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _draw.integers(0, 2**63, MINIMA, dtype=np.uint64)


def sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes in rising order, and each text's first one."""
    lower = W.LOWER[data]
    starts, ends, first = W.words(lower, offsets, WORD_BYTES)
    return W.distinct_per_row(*W.shingles(W.Prefix(lower).hashes(starts, ends), first, width))


def minima(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Per set the minima of all hashes, 16 bits of each; a row of zeros for an empty set."""
    out = np.zeros((len(begin) - 1, MINIMA), np.uint16)
    full = np.flatnonzero(np.diff(begin))
    if len(full):
        for k in range(MINIMA):
            least = np.minimum.reduceat(values * _MULTIPLY[k] + _ADD[k], begin[:-1][full])
            out[full, k] = (W.mix(least) >> np.uint64(48)).astype(np.uint16)
    return out


def signatures(docs: DataFrame, key: str, text: str, width: int = WIDTH) -> DataFrame:
    """(key, text_hash, n, node, sig): set size, digest of the set and minima; node and sig null if empty."""

    @F.arrow_udf("struct<n: bigint, node: binary, sig: binary>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            data, offsets = W.text_buffer(texts)
            n, nodes, sigs = [], [], []
            for start, stop in W.runs(offsets):
                own = offsets[start : stop + 1] - offsets[start]
                values, begin = sets(data[offsets[start] : offsets[stop]], own, width)
                least = minima(values, begin)
                for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
                    n.append(b - a)
                    some = b > a
                    nodes.append(hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if some else None)
                    sigs.append(least[i].tobytes() if some else None)
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())],
                ["n", "node", "sig"],
            )

    return docs.select(F.col(key).alias("key"), hash_of(text).alias("text_hash"), sign(F.col(text)).alias("s")).select(
        "key", "text_hash", "s.n", "s.node", "s.sig"
    )


def _band_rows(classes: DataFrame) -> DataFrame:
    """(band, id, n): one row per class and band. An id stands for a node until its signature is fetched."""

    @F.arrow_udf("array<bigint>")
    def keys(sigs: pa.Array) -> pa.Array:
        quads = np.frombuffer(W.text_buffer(sigs)[0].tobytes(), np.uint64).reshape(-1, BANDS)
        return pa.ListArray.from_arrays(
            pa.array(np.arange(len(quads) + 1) * BANDS, pa.int32()), pa.array(_band_keys(quads).reshape(-1).view(np.int64))
        )

    return classes.select(F.explode(keys("sig")).alias("band"), F.xxhash64("node").alias("id"), "n")


def _band_keys(quads: np.ndarray) -> np.ndarray:
    return W.mix(quads + np.arange(BANDS, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15))


def _least_matches(threshold: int) -> int:
    t = threshold / 100
    return int(MINIMA * (t - 4.5 * (t * (1 - t) / MINIMA) ** 0.5))


def _signed_pairs(pairs: DataFrame, classes: DataFrame, threshold: int) -> DataFrame:
    """(a, b): nodes of the id pairs that neither their sizes nor their signatures rule out."""
    least = _least_matches(threshold)

    @F.arrow_udf("int")
    def matches(left: pa.Array, right: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(W.text_buffer(x)[0].tobytes(), np.uint16).reshape(-1, MINIMA) for x in (left, right))
        return pa.array((a == b).sum(axis=1), pa.int32())

    def side(name: str) -> DataFrame:
        return classes.select(
            F.xxhash64("node").alias(name),
            F.struct("node", "n", "sig").alias(f"of_{name}"),
        )

    both = pairs.join(side("b"), "b").join(side("a"), "a")
    x, y = F.col("of_a"), F.col("of_b")
    both = both.filter(F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * threshold)
    return both.filter(matches(x["sig"], y["sig"]) >= least).select(x["node"].alias("a"), y["node"].alias("b"))


def _confirmed(pairs: DataFrame, texts: DataFrame, threshold: int, width: int) -> DataFrame:
    """The pairs whose full sets reach the threshold. texts: (node, packed) of all nodes in the pairs."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for name in ("a", "b"):
                at = batch.column(name).dictionary_encode().indices.to_numpy(zero_copy_only=False)
                _, one = np.unique(at, return_index=True)
                own = _unpacked(batch.column(f"packed_{name}").take(pa.array(one)).to_pylist(), width)
                found.append((at, own))
            keep = []
            for i, j in zip(found[0][0].tolist(), found[1][0].tolist()):
                x, y = found[0][1][i], found[1][1][j]
                shared = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(100 * shared >= threshold * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda name: texts.select(F.col("node").alias(name), F.col("packed").alias(f"packed_{name}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.mapInArrow(confirm, "a binary, b binary")


def _texts(docs: DataFrame, key: str, text: str, classes: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, packed): the text of one document of each class in ``nodes``."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        return pa.array([zstandard.compress(t.encode(), 3) for t in texts.to_pylist()], pa.binary())

    wanted = classes.join(nodes.select("node").distinct(), "node", "left_semi").select("node", "first.key", "first.text_hash")
    wanted = materialise(wanted, "wanted")
    maybe = bitmap(wanted, "text_hash")
    own = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"), hash_of(text).alias("_hash"))
    own = own.filter(maybe(F.col("_hash"))).select("_key", "_hash", pack("_text").alias("packed"))
    joined = own.join(wanted, own["_key"].eqNullSafe(wanted["key"]) & (own["_hash"] == wanted["text_hash"]))
    return materialise(joined.select("node", "packed").dropDuplicates(["node"]), "texts")


def _unpacked(packed: list[bytes], width: int) -> list[np.ndarray]:
    """The shingle sets of packed texts."""
    own: list[np.ndarray] = []
    for at in range(0, len(packed), 64):
        part = [zstandard.decompress(p) for p in packed[at : at + 64]]
        data, offsets = W.text_buffer(pa.array(part, pa.large_binary()))
        for start, stop in W.runs(offsets):
            values, begin = sets(data[offsets[start] : offsets[stop]], offsets[start : stop + 1] - offsets[start], width)
            own += np.split(values, begin[1:-1])
    return own


def _candidates(group: dict[str, np.ndarray], band: int, threshold: int) -> np.ndarray:
    """(members i, members j, equal minima) of the pairs to confirm, most alike first; members rise by set size.

    Pairs of one root are left out, those of one cell if the group holds two, those that sizes or signatures
    rule out, and those that meet in an earlier band.
    """
    least, n, roots, cells, sigs = _least_matches(threshold), group["n"], group["root"], group["cell"], group["sig"]
    split, quads, found = (cells != cells[0]).any(), np.ascontiguousarray(sigs).view(np.uint64), []
    for i in range(len(n) - 1):
        rest = np.arange(i + 1, np.searchsorted(n, n[i] * 100 / threshold, side="right"))
        rest = rest[(roots[rest] != roots[i]) & (not split or cells[rest] != cells[i])]
        alike = (sigs[rest] == sigs[i]).sum(axis=1) if len(rest) else rest
        rest, alike = rest[alike >= least], alike[alike >= least]
        if len(rest):
            first = (quads[rest] == quads[i]).argmax(axis=1)
            own = _band_keys(quads[i : i + 1])[0].view(np.int64)[first] == band
            found.append(np.stack((np.full(own.sum(), i), rest[own], alike[own])))
    if not found:
        return np.zeros((3, 0), np.int64)
    pairs = np.concatenate(found, axis=1)
    return pairs[:, np.argsort(-pairs[2], kind="stable")]


def _forest(group: dict[str, np.ndarray], band: int, threshold: int, width: int) -> Iterator[tuple[int, int]]:
    """Confirmed pairs of members that join all members of one cell, or of two, that links join."""
    pairs, labels, at, step = _candidates(group, band, threshold), group["root"].copy(), 0, 64
    sets_of: dict[int, np.ndarray] = {}
    while at < pairs.shape[1]:
        part = pairs[:2, at : at + step]
        at, step = at + step, min(2 * step, 8192)
        part = part[:, labels[part[0]] != labels[part[1]]]
        new = [k for k in np.unique(part).tolist() if k not in sets_of]
        sets_of.update(zip(new, _unpacked(group["packed"].take(pa.array(new, pa.int64())).to_pylist(), width)))
        part = part[:, np.argsort(part[0], kind="stable")]
        edges = np.flatnonzero(np.diff(part[0], prepend=-1, append=-1))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            i, rest = int(part[0, a]), part[1, a:b]
            rest = rest[labels[rest] != labels[i]]
            if len(rest):
                own, sizes = sets_of[i], group["n"][rest]
                values = np.concatenate([sets_of[j] for j in rest.tolist()])
                place = np.minimum(np.searchsorted(own, values), len(own) - 1)
                shared = np.add.reduceat(own[place] == values, np.cumsum(sizes) - sizes)
                for j in rest[100 * shared >= threshold * (len(own) + sizes - shared)].tolist():
                    if labels[j] != labels[i]:
                        labels[labels == labels[j]] = labels[i]
                        yield i, j


def _cell_links(rows: DataFrame, threshold: int, width: int) -> DataFrame:
    """Links (a, b) of all groups. rows: (band, one, two, cell, node, root, n, sig, packed), grouped by the first three.

    A group has two cells at most. Groups follow each other in sorted partitions and are cut from the stream, one
    at a time.
    """
    rows = rows.repartition("band", "one", "two").sortWithinPartitions("band", "one", "two", "n")

    def linked(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        group = {c: table.column(c).to_numpy() for c in ("root", "cell", "n")}
        sigs = b"".join(table.column("sig").to_pylist())
        group["sig"] = np.frombuffer(sigs, np.uint16).reshape(-1, MINIMA)
        group["packed"] = table.column("packed")
        found = list(_forest(group, table.column("band")[0].as_py(), threshold, width))
        nodes = table.column("node")
        sides = (nodes.take(pa.array([x[k] for x in found], pa.int64())).combine_chunks() for k in (0, 1))
        return pa.RecordBatch.from_arrays([x.cast(pa.binary()) for x in sides], ["a", "b"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("band", "one", "two")])
            edges = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
                own = tuple(keys[:, a].tolist()) if b > a else last
                if held and own != last:
                    yield linked(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
                last = own
        if held:
            yield linked(pa.Table.from_batches(held))

    return rows.mapInArrow(cut, "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b): root is the smallest node of its component."""
    stars = _stars(edges)
    return stars.union(stars.select("root", "root").distinct())


def _stars(edges: DataFrame) -> DataFrame:
    """(node, root) of every node in ``edges`` (a, b) but the roots themselves.

    Large-star hangs a node's larger neighbours on the smallest one it knows, small-star the smaller
    ones; both in turn until nothing changes, which leaves one star per component. Edges point from the larger
    node to the smaller one, so large-star looks up the smallest neighbour of each edge's end. No step makes more
    edges than it was given, and repeated ones vanish in small-star.
    """
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b")
    state = None
    while True:
        least = edges.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "b")
        large = edges.join(least, "b", "left").select("a", F.coalesce("m", "b").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.union(least.select("a", F.col("m").alias("b"))), "stars")
        now = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))"), F.expr("sum(xxhash64(b, a) % 1000003)"))
        now = tuple(now.first())
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _mixed(placed: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows (band, id, m, size) of buckets that span several roots, with root, cell and signature.

    The buckets are told by a bitmap, which needs no shuffle by band; one that passes it by chance gives no pair.
    """
    named = roots.select(F.xxhash64("node").alias("id"), F.xxhash64("root").alias("root"))
    placed = placed.join(apart(named), "id", "left").withColumn("root", F.coalesce("root", "id"))
    placed = materialise(placed.select("band", "id", "m", "size", "root"), "placed")
    mixed = placed.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x != y")
    some = bitmap(materialise(mixed.select("band"), "mixed-buckets"), "band")
    cells = F.greatest(F.ceil(F.col("m") / F.lit(CELL)), F.ceil(F.col("size") / F.lit(CELL_SHINGLES))).cast("int")
    rows = placed.filter(some(F.col("band"))).withColumn("cells", cells)
    rows = rows.withColumn("cell", F.pmod(F.hash("id"), F.col("cells")))
    return apart(rows).join(classes.select(F.xxhash64("node").alias("id"), "node", "n", "sig"), "id")


def _merged(stars: DataFrame, more: DataFrame) -> DataFrame:
    """``stars`` (node, root) with the components joined that ``more`` (a, b) links."""
    end = lambda name: stars.select(F.col("node").alias(name), F.col("root").alias(f"of_{name}"))
    between = more.join(end("a"), "a", "left").join(end("b"), "b", "left")
    between = between.select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).distinct()
    between = materialise(between, "rest-links")
    if between.isEmpty():
        return stars
    joined = _stars(between)
    new = joined.select(F.col("node").alias("root"), F.col("root").alias("new"))
    return stars.join(new, "root", "left").select("node", F.coalesce("new", "root").alias("root")).union(joined)


def _linked_roots(docs: DataFrame, classes: DataFrame, key: str, text: str, threshold: int, width: int = WIDTH) -> DataFrame:
    """(node, root) of every class that confirmed links join to a smaller one."""
    bands = _band_rows(classes)
    buckets = bands.groupBy("band").agg(F.count("*").alias("m"), F.min("id").alias("hub"), F.sum("n").alias("size"))
    members = materialise(apart(bands.drop("n")).join(buckets.filter("m > 1"), "band"), "members")
    large = members.filter("m > 2")

    # All pairs of buckets of two; in larger ones two pairs per class, with its least and its most frequent hub.
    hubs = large.groupBy("id").agg(F.min("hub").alias("a"), F.max_by("hub", "m").alias("c"))
    pairs = members.filter("m = 2 and id != hub").select(F.col("hub").alias("a"), F.col("id").alias("b"))
    hubs = hubs.select("id", F.explode(F.array("a", "c")).alias("a")).select("a", F.col("id").alias("b"))
    pairs = pairs.union(hubs).filter("a != b").distinct()
    pairs = materialise(_signed_pairs(pairs, classes, threshold), "pairs")
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    stars = _stars(materialise(_confirmed(pairs, _texts(docs, key, text, classes, nodes), threshold, width), "links"))

    # Whatever is still in different components: all pairs, confirmed where they meet.
    rows = materialise(_mixed(large.select("band", "id", "m", "size"), classes, stars), "mixed")
    rows = apart(rows).join(_texts(docs, key, text, classes, rows), "node")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
    rows = rows.withColumn("one", F.least("cell", "other")).withColumn("two", F.greatest("cell", "other"))
    columns = ("band", "one", "two", "cell", "node", "root", "n", "sig", "packed")
    return _merged(stars, _cell_links(rows.select(*columns), threshold, width))


def _grouped(docs: DataFrame, key: str, text: str, threshold: int, width: int) -> DataFrame:
    """(key, text_hash, n, node, root, component_id) of every document."""
    ready(docs.sparkSession)
    signed = materialise(signatures(docs, key, text, width), "signatures")
    classes = signed.filter("node is not null").groupBy("node")
    classes = materialise(
        classes.agg(
            F.min(F.struct(F.col("key").isNull().alias("unnamed"), "key", "text_hash")).alias("first"),
            F.first("n").alias("n"),
            F.first("sig").alias("sig"),
        ),
        "classes",
    )
    roots = _linked_roots(docs, classes, key, text, threshold, width)
    members = classes.select("node", F.col("first.key").alias("first_key")).join(roots, "node", "left")
    members = members.withColumn("root", F.coalesce("root", "node"))
    least = members.groupBy("root").agg(F.min("first_key").alias("component_id"))
    named = materialise(members.join(least, "root").select("node", "root", "component_id"), "components")
    result = signed.drop("sig").join(named, "node", "left")
    return result.withColumn("component_id", F.when(F.col("node").isNull(), F.col("key")).otherwise(F.col("component_id")))


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 80, width: int = WIDTH
) -> DataFrame:
    """One row per document: (key, text_hash, n_shingles, component_id, kept).

    threshold: hundredths of similarity from which documents are linked.
    """
    return _grouped(docs, key, text, threshold, width).select(
        "key",
        "text_hash",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"),
    )


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest key, with the columns it came with.

    Rows that agree in key and text are one document, of which one row stays.
    """
    found = materialise(_grouped(docs, key, text, threshold, WIDTH), "grouped")
    order = F.struct(F.col("key").isNull().alias("unnamed"), "key", "text_hash")
    first = found.filter("node is not null").groupBy("root").agg(F.min(order).alias("first"))
    first = first.select("root", F.col("first.key").alias("first_key"), F.col("first.text_hash").alias("first_hash"))
    same = F.col("key").eqNullSafe(F.col("first_key")) & (F.col("text_hash") == F.col("first_hash"))
    gone_key, gone_hash, marked_as = free(docs, "_key", "_hash", "_maybe")
    gone = found.filter("node is not null").join(first, "root").filter(~same)
    gone = materialise(gone.select(F.col("key").alias(gone_key), F.col("text_hash").alias(gone_hash)).distinct(), "gone")
    maybe = bitmap(gone, gone_hash)
    # Documents outside the bitmap stay where they are; only the others meet the rejected ones in a join.
    marked = docs.withColumn(marked_as, maybe(hash_of(text)))
    rest = marked.filter(marked_as).join(
        gone, F.col(key).eqNullSafe(F.col(gone_key)) & (hash_of(text) == F.col(gone_hash)), "left_anti"
    )
    kept = marked.filter(~F.col(marked_as)).union(rest).drop(marked_as)
    repeated = found.groupBy("key", "text_hash").count().filter("count > 1")
    return kept if repeated.isEmpty() else kept.dropDuplicates([key, text])
