"""Vector codes: each part of a vector becomes the number of its nearest codebook entry, in whole numbers.

A component x is the integer floor(4096 * x); a vector is cut into equal consecutive parts, and each part position
has a codebook that starts as that part of the vectors with the smallest keys. A round assigns every part to its
nearest entry and replaces each entry by the floored mean of its parts; entries without parts stay.

Vectors are kept in blocks of bounded size, one row per block, in a table that every round reads: per dimension
the distinct integers of the block in rising order (its dictionary) and a code for each vector. Squared differences are
tabulated for every distinct integer and entry once per block, and distances of parts are made by gathers from these
tables over the codes, and additions. A round sends to the driver one grouped sum and count per entry, whose number is
that of the codebook's components; nothing else is collected, and vectors are shuffled in no round. A label that
holds a third of all rows costs nothing more: its errors are summed before the shuffle.

Edge cases: vectors that are null or hold null, NaN or infinite components (also after scaling) are dropped; equal keys are rows of
their own and are told apart by their vectors where the first entries are chosen; null keys come last there;
fewer vectors than entries give smaller codebooks, none an empty result; a vector whose length differs from that of the
first entry cannot be cut alike: it is returned with null code and error and teaches nothing; lengths that
the parts do not divide give parts that differ by one component at most; integers of any size are exact, while an
error or sum of errors beyond the range of a long is given as the largest long; other columns are neither
read nor returned, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumagrid.llm.common import materialise, ready

#: Components in a block at most, but one vector at least.
BLOCK_VALUES = 1 << 21
#: Squared differences of components below this fit 64 bits, summed over 32 components; larger ones are Python integers.
PLAIN = float(1 << 28)
LARGEST = (1 << 63) - 1
#: Sums travel in digits of so many bits, whose own sums fit a bigint.
DIGIT = 40


def cut_at(length: int, parts: int) -> list[int]:
    """Where the parts of a vector begin, and its end."""
    return [length * p // parts for p in range(parts + 1)]


def _in_blocks(rows: DataFrame, length: int) -> DataFrame:
    """(keys, labels, n, sizes, dictionary, codes) per block of n vectors; codes are 32-bit numbers, dimension by dimension."""
    key, label = (rows.schema[c].dataType for c in ("key", "label"))
    out = T.StructType(
        [
            T.StructField("keys", T.ArrayType(key)),
            T.StructField("labels", T.ArrayType(label)),
            T.StructField("n", T.IntegerType()),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("dictionary", T.ArrayType(T.DoubleType())),
            T.StructField("codes", T.BinaryType()),
        ]
    )
    schema, most = to_arrow_schema(out), max(1, BLOCK_VALUES // max(length, 1))

    def block(table: pa.Table) -> pa.RecordBatch:
        flat = pa.concat_arrays([c.flatten() for c in table.column("scaled").chunks]).to_numpy(zero_copy_only=False)
        values = np.floor(flat).reshape(table.num_rows, length) + 0.0
        found = [np.unique(values[:, d], return_inverse=True) for d in range(length)]
        codes = np.array([code for _, code in found], np.uint32).tobytes()
        columns = [
            [table.column("key").to_pylist()],
            [table.column("label").to_pylist()],
            [table.num_rows],
            [[len(own) for own, _ in found]],
            [np.concatenate([own for own, _ in found]) if found else []],
            [codes],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                if rows and rows + part.num_rows > most:
                    yield block(pa.Table.from_batches(held))
                    held, rows = [], 0
                held.append(part)
                rows += part.num_rows
        if rows:
            yield block(pa.Table.from_batches(held))

    return rows.mapInArrow(blocks, out)


def nearest(sizes: list[int], dictionary: np.ndarray, codes: np.ndarray, book: list[np.ndarray], starts: list[int]):
    """Per part: (number of the nearest entry, its squared distance) of every vector of a block.

    dictionary: the distinct integers of all dimensions in a row; codes: (dimensions, vectors); book: (entries,
    components) per part.
    """
    begin = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    for entries, first, end in zip(book, starts, starts[1:]):
        distance = np.zeros((codes.shape[1], len(entries)), dictionary.dtype)
        for d in range(first, end):
            squares = (dictionary[begin[d] : begin[d + 1], None] - entries[None, :, d - first]) ** 2
            distance += squares[codes[d]]
        best = distance.argmin(axis=1)
        yield best, distance[np.arange(len(best)), best]


def _opened(batch: pa.RecordBatch, book: list[np.ndarray]) -> Iterator[tuple]:
    """(row, sizes, dictionary, codes, book) of each block, in 64-bit integers where these cannot overflow."""
    high = max((abs(int(x)) for entries in book for x in entries.ravel()), default=0)
    for row in range(batch.num_rows):
        sizes = batch.column("sizes")[row].as_py()
        values = batch.column("dictionary").slice(row, 1).flatten().to_numpy(zero_copy_only=False)
        codes = np.frombuffer(batch.column("codes")[row].as_py(), np.uint32)
        codes = codes.reshape(len(sizes), batch.column("n")[row].as_py())
        wide = max((len(e[0]) for e in book if len(e)), default=0)
        if max(np.abs(values).max(initial=0), high) < PLAIN and wide <= 32:
            kind = np.int64
            values = values.astype(np.int64)
        else:
            kind = object
            values = np.array([int(v) for v in values], object)
        yield row, sizes, values, codes, [e.astype(kind) for e in book]


def _round(blocks: DataFrame, book: list[np.ndarray], starts: list[int]) -> list[np.ndarray]:
    """The codebook after one round."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((len(e), e.shape[1] + 1), object) for e in book]
        some = False
        for batch in batches:
            for _, sizes, values, codes, own in _opened(batch, book):
                some = True
                begin = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
                for p, (best, _) in enumerate(nearest(sizes, values, codes, own, starts)):
                    total[p][:, -1] += np.bincount(best, minlength=len(own[p])).astype(object)
                    for d in range(starts[p], starts[p + 1]):
                        column = np.zeros(len(own[p]), values.dtype)
                        np.add.at(column, best, values[begin[d] : begin[d + 1]][codes[d]])
                        total[p][:, d - starts[p]] += column.astype(object)
        rows = []
        for p, sums_of in enumerate(total if some else []):
            for (entry, at), value in np.ndenumerate(sums_of):
                place, rest = 0, int(value)
                while rest:
                    last = abs(rest) < 1 << DIGIT
                    low = rest if last else rest & ((1 << DIGIT) - 1)
                    rows.append((p, entry, at, place, low))
                    place, rest = place + 1, 0 if last else rest >> DIGIT
        if rows:
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays(arrays, ["part", "entry", "at", "place", "amount"])

    made = blocks.select("n", "sizes", "dictionary", "codes").mapInArrow(
        sums, "part int, entry int, at int, place int, amount bigint"
    )
    total = [np.zeros((len(e), e.shape[1] + 1), object) for e in book]
    # As many rows as the codebook has components, for each digit of the sums.
    for part, entry, at, place, amount in made.groupBy("part", "entry", "at", "place").agg(F.sum("amount")).collect():
        total[part][entry, at] += amount << (DIGIT * place)
    out = []
    for entries, own in zip(book, total):
        moved = entries.copy()
        for k in range(len(entries)):
            if own[k, -1]:
                moved[k] = [int(v) // int(own[k, -1]) for v in own[k, :-1]]
        out.append(moved)
    return out


def _coded(blocks: DataFrame, rows: DataFrame, book: list[np.ndarray], starts: list[int]) -> DataFrame:
    """(key, label, code, error) of every vector."""
    out = T.StructType(
        [
            T.StructField("key", rows.schema["key"].dataType),
            T.StructField("label", rows.schema["label"].dataType),
            T.StructField("code", T.StringType()),
            T.StructField("error", T.LongType()),
        ]
    )
    schema = to_arrow_schema(out)
    digits = np.array([f"{i:02x}" for i in range(max(map(len, book), default=0))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, sizes, values, codes, own in _opened(batch, book):
                keys, labels = (batch.column(c).slice(row, 1).flatten() for c in ("keys", "labels"))
                text, error = np.full(len(keys), "", object), np.zeros(len(keys), object)
                for best, distance in nearest(sizes, values, codes, own, starts):
                    text = text + digits[best].astype(object)
                    error = error + distance.astype(object)
                error = [min(int(e), LARGEST) for e in error]
                columns = [keys, labels, pa.array(text.tolist(), pa.string()), pa.array(error, pa.int64())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return blocks.mapInArrow(code, out)


def compress(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    scale: int = 4096,
) -> tuple[DataFrame, list[np.ndarray]]:
    """(key, label, code, error, label_error) of every vector, and the codebooks: (entries, components) per part.

    code: entry numbers in the order of the parts, two hexadecimal digits each; error: squared distance between the vector
    and its entries; label_error: errors summed over the vectors of the same label, null being one.
    """
    if not 1 <= entries <= 256:
        raise ValueError("an entry number has two hexadecimal digits: there are 1 to 256 entries")
    spark: SparkSession = ready(vectors.sparkSession)
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double") * float(scale)) < float("inf"), F.lit(False)))
    # Exact in doubles for a power of two; floored in the tasks, as the built-in floor gives a long.
    scaled = F.transform(vector, lambda x: x.cast("double") * float(scale))
    rows = vectors.filter(F.col(vector).isNotNull() & finite).select(
        F.col(key).alias("key"), F.col(label).alias("label"), scaled.alias("scaled")
    )
    first = rows.select("key", "scaled").orderBy(F.col("key").asc_nulls_last(), "scaled").limit(entries).collect()
    length = len(first[0].scaled) if first else 0
    first = [[math.floor(x) for x in r.scaled] for r in first if len(r.scaled) == length]
    starts = cut_at(length, parts)
    book = [
        np.array([v[a:b] for v in first], object).reshape(len(first), b - a) for a, b in zip(starts, starts[1:])
    ]
    blocks = materialise(_in_blocks(rows.filter(F.size("scaled") == length), length), "vector-blocks")
    for _ in range(rounds):
        book = _round(blocks, book, starts)
    coded = materialise(_coded(blocks, rows, book, starts), "vector-codes")
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    errors = coded.groupBy("label").agg(F.least(total, F.lit(LARGEST).cast("decimal(38,0)")).cast("bigint").alias("label_error"))
    errors = errors.withColumnRenamed("label", "of_label")
    # Vectors that cannot be cut like the first entry keep their row.
    others = rows.filter(F.size("scaled") != length).select("key", "label", F.lit(None).cast("string").alias("code"))
    coded = coded.unionByName(others.withColumn("error", F.lit(None).cast("bigint")))
    found = coded.join(errors, F.col("label").eqNullSafe(F.col("of_label")), "left").drop("of_label")
    return found.select(F.col("key").alias(key), F.col("label").alias(label), "code", "error", "label_error"), book


def digest(book: list[np.ndarray]) -> str:
    """A digest of all components in the order of parts, entries and places."""
    text = ",".join(str(int(x)) for entries in book for x in entries.ravel())
    return hashlib.sha256(text.encode()).hexdigest()
