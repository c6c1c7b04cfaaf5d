"""Byte-level BPE over a table: every distinct pre-token is merged once, ids come back by position.

Encoding:

1. ``pretokens`` explodes texts into pre-tokens with their positions, block by block (about 6 MB of
   text): per block a number for each distinct pre-token, the numbers in order of position, and the
   distinct pre-tokens themselves in packets, one for each hash bucket.
2. ``encoded_packets`` shuffles the packets by bucket, so that all appearances of a pre-token meet in
   one task, and merges each distinct one once. A pre-token that is a third of all text is one entry per
   block here, never a row per appearance.
3. ``encode`` joins the ids back to the block and reads them out by position, document by document.

Decoding joins the token-byte table (as large as the vocabulary, so its size is bounded) to the ids inside
the tasks.

Edge cases: a null or empty text has no tokens; repeated rows are rows of their own, and null keys stay
null; an empty table gives an empty result; other columns are left out, so their names cannot clash. A
single text must fit into a task's memory a few times.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumagrid.llm.common import ready

BLOCK_BYTES = 6 << 20
#: The documents of a block travel in pieces of about this many token numbers.
PIECE = 1 << 18
#: Bytes of a block's digest.
MARK = 16
#: A task remembers the ids of this many bytes of pre-tokens, then forgets them all and merges anew.
REMEMBERED_BYTES = 32 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one pre-token: the pair of lowest rank (leftmost first) is merged until none is left.

    Neighbours are linked lists and pairs wait in a heap, so long pre-tokens take n log n steps.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    if n <= 40:
        return _merge_short(word, ranks)
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    end = list(range(1, n + 1))
    alive = [True] * n
    pairs = [(ranks[word[i : i + 2]], i, i + 2) for i in range(n - 1) if word[i : i + 2] in ranks]
    heapq.heapify(pairs)
    while pairs:
        _, i, stop = heapq.heappop(pairs)
        j = after[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue
        alive[j] = False
        end[i], after[i] = stop, after[j]
        if after[j] < n:
            before[after[j]] = i
            following = end[after[j]]
            if (rank := ranks.get(word[i:following])) is not None:
                heapq.heappush(pairs, (rank, i, following))
        if (h := before[i]) >= 0 and (rank := ranks.get(word[h:stop])) is not None:
            heapq.heappush(pairs, (rank, h, stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def _merge_short(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    none = 1 << 60
    cuts = list(range(len(word) + 1))
    pair = [ranks.get(word[i : i + 2], none) for i in range(len(word) - 1)]
    while pair and (least := min(pair)) < none:
        i = pair.index(least)
        del cuts[i + 1], pair[i]
        if i < len(pair):
            pair[i] = ranks.get(word[cuts[i] : cuts[i + 2]], none)
        if i:
            pair[i - 1] = ranks.get(word[cuts[i - 1] : cuts[i + 1]], none)
    return [ranks[word[a:b]] for a, b in zip(cuts, cuts[1:])]


def _pack_numbers(values: np.ndarray) -> bytes:
    """Small numbers short: one byte below 128, two below 32768, else four; streams apart, compressed."""
    values = values.astype(np.uint32)
    short, middle = values < 0x80, (values >= 0x80) & (values < 0x8000)
    tags = np.where(short, values, np.where(middle, 0x80 | (values >> 8), 0)).astype(np.uint8)
    tags[~short & ~middle] = 0xFF
    middle &= tags != 0xFF
    wide = ~short & ~middle
    parts = [tags.tobytes(), (values[middle] & 0xFF).astype(np.uint8).tobytes(), values[wide].tobytes()]
    parts = [zstandard.compress(p, 3) for p in parts]
    return struct.pack("<3I", *map(len, parts)) + b"".join(parts)


def _unpack_numbers(packed: bytes) -> np.ndarray:
    sizes = struct.unpack_from("<3I", packed)
    parts, at = [], 12
    for size in sizes:
        parts.append(zstandard.decompress(packed[at : at + size]))
        at += size
    tags = np.frombuffer(parts[0], np.uint8)
    values = tags.astype(np.uint32)
    middle, wide = (tags >= 0x80) & (tags != 0xFF), tags == 0xFF
    values[middle] = ((values[middle] & 0x7F) << 8) | np.frombuffer(parts[1], np.uint8)
    values[wide] = np.frombuffer(parts[2], np.uint32)
    return values


def _pack_bytes(items: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, items), np.uint32, len(items))
    return struct.pack("<I", len(items)) + zstandard.compress(sizes.tobytes() + b"".join(items), 3)


def _unpack_bytes(packed: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<I", packed)
    data = zstandard.decompress(packed[4:])
    ends = np.cumsum(np.frombuffer(data, np.uint32, n), dtype=np.int64) + 4 * n
    starts = np.concatenate(([4 * n], ends[:-1])) if n else ends
    return [data[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


class _Block:
    """Documents of one task that are numbered together."""

    def __init__(self, buckets: int):
        self.buckets, self.size = buckets, 0
        self.numbers: defaultdict[str, int] = defaultdict(count().__next__)
        self.seen: list[np.ndarray] = []
        self.keys: list[int | None] = []

    def add(self, key: int | None, tokens: list[str], size: int) -> None:
        self.seen.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.uint32, len(tokens)))
        self.keys.append(key)
        self.size += size

    def packets(self, block: int, of_words: bool) -> Iterator[tuple[int, int, bytes, bytes]]:
        """(block, bucket, numbers, pre-tokens), or pieces of documents: (block, -1 - piece, numbers, keys).

        Numbers of pre-tokens and keys of pieces start with a digest of the whole block, against which they are checked.
        """
        words = [w.encode() for w in self.numbers]
        mark = self.digest(words)
        use = np.bincount(np.concatenate(self.seen), minlength=len(words))
        number = np.empty(len(words), np.uint32)
        number[np.argsort(-use, kind="stable")] = np.arange(len(words), dtype=np.uint32)
        if of_words:
            bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(self.buckets)
            by_bucket = np.lexsort((number, bucket))
            edges = np.searchsorted(bucket[by_bucket], np.arange(self.buckets + 1))
            for b in np.flatnonzero(np.diff(edges)).tolist():
                own = by_bucket[edges[b] : edges[b + 1]]
                steps = np.diff(number[own].astype(np.int64), prepend=0)
                yield block, b, mark + _pack_numbers(steps), _pack_bytes([words[i] for i in own.tolist()])
            return
        counts = np.array([len(x) for x in self.seen])
        for piece, (lo, hi) in enumerate(_slices(counts, PIECE)):
            tokens = number[np.concatenate(self.seen[lo:hi])]
            keys = mark + _pack_keys(self.keys[lo:hi], counts[lo:hi])
            yield block, -1 - piece, _pack_numbers(tokens), keys

    def digest(self, words: list[bytes]) -> bytes:
        """Tells blocks of other documents, or of the same in another order, apart."""
        told = hashlib.blake2b(digest_size=MARK)
        for part in (self.keys, [len(w) for w in words], [len(x) for x in self.seen]):
            told.update(repr(part).encode())
        for data in (*words, *self.seen):
            told.update(data)
        return told.digest()


def _pack_keys(keys: list[int | None], counts: np.ndarray) -> bytes:
    named = np.array([k is not None for k in keys], np.uint8).tobytes()
    values = np.array([k or 0 for k in keys], np.int64).tobytes()
    return _pack_bytes([named, values, _pack_numbers(counts)])


def _unpack_keys(packed: bytes) -> tuple[pa.Array, np.ndarray]:
    named, values, counts = _unpack_bytes(packed)
    missing = np.frombuffer(named, np.uint8) == 0
    return pa.array(np.frombuffer(values, np.int64), pa.int64(), mask=missing), _unpack_numbers(counts)


def _rows_out(rows: list[tuple[int, int, bytes, bytes]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["block", "bucket", "numbers", "data"]
    )


_PACKET = "block bigint, bucket int, numbers binary, data binary"


def pretokens(docs: DataFrame, text: str, key: str, pattern: str, buckets: int, of_words: bool) -> DataFrame:
    """Blocks of numbered pre-tokens: packets of the distinct ones, or the numbers of each document in order.

    Both come from the same blocks, so ``docs`` must give the same partitions each time, as a table scan does; blocks
    carry a digest of their keys, words and positions, and ``encode`` fails where the two readings differ.
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        task, made, block = TaskContext.get().partitionId(), 0, _Block(buckets)
        for batch in batches:
            for name, own in zip(batch.column("key").to_pylist(), batch.column("text")):
                own = own.as_py() or ""
                block.add(name, split(own), len(own))
                if block.size >= BLOCK_BYTES:
                    yield _rows_out(list(block.packets(task << 32 | made, of_words)))
                    made, block = made + 1, _Block(buckets)
        if block.keys:
            yield _rows_out(list(block.packets(task << 32 | made, of_words)))

    return docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).mapInArrow(explode, _PACKET)


def encoded_packets(packets: DataFrame, ranks) -> DataFrame:
    """The packets with ids in place of pre-tokens; each distinct pre-token is merged once, where it meets."""

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known, held = ranks.value, {}, 0
        for batch in batches:
            rows = []
            if held > REMEMBERED_BYTES:
                known, held = {}, 0
            for block, bucket, numbers, data in zip(*(c.to_pylist() for c in batch.columns)):
                made = []
                for word in _unpack_bytes(data):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = np.array(merge(word, table), np.uint32).tobytes()
                        held += len(word) + len(ids)
                    made.append(ids)
                rows.append((block, bucket, numbers, _pack_bytes(made)))
            yield _rows_out(rows)

    return packets.repartition(F.col("bucket")).mapInArrow(encode_words, _PACKET)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: (key bigint, ids array<int>).

    path: rank file. pattern: regular expression of the pre-tokens.
    """
    spark = ready(docs.sparkSession)
    buckets = 2 * max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranks = spark.sparkContext.broadcast(read_ranks(path))
    words = encoded_packets(pretokens(docs, text, key, pattern, buckets, of_words=True), ranks)
    pieces = pretokens(docs, text, key, pattern, buckets, of_words=False)

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        marks = {x[:MARK] for x in (*left.column("numbers").to_pylist(), *right.column("data").to_pylist())}
        if len(marks) != 1 or not right.num_rows:
            raise ValueError("the documents came in other partitions when they were read again")
        packets = zip(left.column("numbers").to_pylist(), left.column("data").to_pylist())
        flat, starts, sizes = _by_number([(np.cumsum(_unpack_numbers(n[MARK:])), _unpack_bytes(d)) for n, d in packets])
        found = []
        for numbers, data in zip(right.column("numbers").to_pylist(), right.column("data").to_pylist()):
            keys, counts = _unpack_keys(data[MARK:])
            tokens = _unpack_numbers(numbers)
            n = sizes[tokens]
            stops = np.cumsum(n)
            ids = flat[np.repeat(starts[tokens] - stops + n, n) + np.arange(n.sum())].astype(np.int32)
            bounds = np.concatenate(([0], stops))[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids))
            found.append(pa.Table.from_arrays([keys, lists], [key, "ids"]))
        return pa.concat_tables(found)

    both = words.groupBy("block").cogroup(pieces.groupBy("block"))
    return both.applyInArrow(assemble, f"`{key}` bigint, ids array<int>")


def _slices(counts: np.ndarray, most: int = 1 << 17) -> Iterator[tuple[int, int]]:
    start, held = 0, 0
    for i, n in enumerate(counts.tolist()):
        if held and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(counts):
        yield start, len(counts)


def _by_number(packets: list[tuple[np.ndarray, list[bytes]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a block's pre-tokens in a row, and where those of each number start and how many they are."""
    if not packets:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    number = np.concatenate([n for n, _ in packets]).astype(np.int64)
    ids = [i for _, own in packets for i in own]
    flat = np.frombuffer(b"".join(ids), np.uint32)
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    start = np.cumsum(size) - size
    starts, sizes = np.empty(len(ids), np.int64), np.empty(len(ids), np.int64)
    starts[number], sizes[number] = start, size
    return flat, starts, sizes


def token_bytes(spark: SparkSession, path: str):
    """The token-byte table of a rank file, for ``decode_batch`` inside tasks."""
    ranks = read_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return spark.sparkContext.broadcast(table)


def decode(encoded: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``encoded`` with the bytes of its ids joined from the token-byte table; null ids: null."""
    table = token_bytes(ready(encoded.sparkSession), path)

    @F.arrow_udf("binary")
    def joined(column: pa.Array) -> pa.Array:
        find = table.value.__getitem__
        values = column.values.to_numpy(zero_copy_only=False)
        ends = column.offsets.to_numpy().tolist()
        rows = zip(ends[:-1], ends[1:], column.is_valid().to_pylist())
        return pa.array([b"".join(map(find, values[a:b].tolist())) if some else None for a, b, some in rows], pa.binary())

    return encoded.withColumn(into, joined(F.col(ids)))


def fingerprint(encoded: DataFrame, ids: str = "ids") -> DataFrame:
    """``encoded`` with n_tokens and ids_sha256, the digest of the decimal ids joined by one space."""

    @F.arrow_udf("string")
    def digest(column: pa.Array) -> pa.Array:
        values = column.values.to_numpy(zero_copy_only=False)
        ends = column.offsets.to_numpy().tolist()
        return pa.array(
            [hashlib.sha256(" ".join(map(str, values[a:b].tolist())).encode()).hexdigest() for a, b in zip(ends, ends[1:])]
        )

    return encoded.withColumn("n_tokens", F.size(ids).cast("bigint")).withColumn("ids_sha256", digest(F.col(ids)))
