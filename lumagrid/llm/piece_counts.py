"""Token counts of texts by byte-pair merging, without making token ids.

The rules are those of a sentencepiece BPE model with identity normalisation: a text gets a mark in front, each
space becomes a mark, and each character is a symbol. The adjacent pair of symbols with the best score, the
leftmost of equals, is merged until no pair is a piece. The symbols are a doubly linked list and the pairs a heap, whose
outdated entries are passed over when they come up. The count is the number of first symbols less the number
of merges; a symbol left over that is no piece counts as its UTF-8 bytes where the model falls back to bytes.

No merge crosses a place between two characters that stand side by side in no piece, so a text is cut at such places
(before marks, around characters of no longer piece, and in long stretches wherever a pair of characters is
unknown) and the counts of the stretches add up. A task remembers the counts of a bounded number of short stretches. The
work is one pass without a shuffle; the vocabulary, whose size is the model's, is sent to the tasks once.

Edge cases: a null or empty text has no bytes and no tokens; texts are taken whole, whatever their length; names of
pieces inside a text ("<s>", "<0x0A>") are ordinary characters; repeated rows give repeated rows; other columns are
neither read nor returned, so their names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import add

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import ready

MARK = "▁"
#: Stretches up to this length are remembered, so many of them in a task.
SHORT, REMEMBERED = 48, 300_000
#: Longer stretches are looked through for further places to cut.
LONG = 512


@dataclass
class Pieces:
    """The pieces of a model with their ranks (the best is the smallest), and what follows from them."""

    ranks: dict[str, float]
    byte_fallback: bool = True
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        joined = [p for p in self.ranks if len(p) > 1]
        self.pairs = {p[i : i + 2] for p in joined for i in range(len(p) - 1)}
        met = {c for p in joined for c in p} - {MARK}
        inside = "".join(map(re.escape, sorted(met))) or r"^\s\S"
        # A mark opens a stretch only if no piece has one behind another character.
        opens = not any(b == MARK != a for a, b in self.pairs)
        self.stretch = re.compile(f"{MARK}+[{inside}]*|[{inside}]+|[\\s\\S]" if opens else f"[{inside}{MARK}]+|[\\s\\S]")

    def merges(self, text: str) -> tuple[int, list[str | None]]:
        """The number of merges in a stretch, and the symbols left (None where one was merged away)."""
        ranks, symbols, n = self.ranks, list(text), len(text)
        heap = [(ranks[p], i, 2) for i, p in enumerate(map(add, symbols, symbols[1:])) if p in ranks]
        heapq.heapify(heap)
        after, before, made = list(range(1, n + 1)), list(range(-1, n - 1)), 0
        while heap:
            _, i, size = heapq.heappop(heap)
            left, j = symbols[i], after[i]
            if left is None or j == n or len(left) + len(symbols[j]) != size:
                continue
            made += 1
            symbols[i] = whole = left + symbols[j]
            symbols[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                pair = whole + symbols[k]
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], i, len(pair)))
            h = before[i]
            if h >= 0:
                pair = symbols[h] + whole
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], h, len(pair)))
        return made, symbols

    def tokens(self, stretch: str) -> int:
        """Tokens of a stretch of text."""
        made, symbols = self.merges(stretch)
        count = len(stretch) - made
        if self.byte_fallback and not all(c in self.ranks for c in stretch):
            count += sum(len(s.encode()) - 1 for s in symbols if s is not None and s not in self.ranks)
        return count

    def cuts(self, stretch: str) -> Iterator[str]:
        """A long stretch in parts that no merge can join."""
        start = 0
        for i in range(1, len(stretch)):
            if stretch[i - 1 : i + 1] not in self.pairs:
                yield stretch[start:i]
                start = i
        yield stretch[start:]

    def count(self, text: str | None) -> int:
        """Tokens of a text."""
        if not text:
            return 0
        known, total = self.known, 0
        for found in self.stretch.finditer(MARK + text.replace(" ", MARK)):
            stretch = found[0]
            own = known.get(stretch)
            if own is None:
                if len(stretch) > SHORT:
                    own = sum(map(self.tokens, self.cuts(stretch) if len(stretch) > LONG else [stretch]))
                else:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    own = known[stretch] = self.tokens(stretch)
            total += own
        return total


def read_pieces(path: str) -> Pieces:
    """The pieces of a sentencepiece BPE model file; other kinds of models are refused."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    rules, trained, kind = model.normalizer_spec, model.trainer_spec, sentencepiece_model_pb2.ModelProto.SentencePiece
    plain = rules.add_dummy_prefix and rules.escape_whitespaces and not rules.remove_extra_whitespaces
    if trained.model_type != trained.BPE or trained.treat_whitespace_as_suffix or rules.precompiled_charsmap or not plain:
        raise ValueError("only BPE models with a mark in front and without normalisation are counted")
    if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
        raise ValueError("models with unused or user-defined pieces are not counted")
    ranks = {p.piece: -p.score for p in model.pieces if p.type == kind.NORMAL}
    return Pieces(ranks, trained.byte_fallback)


def count(docs: DataFrame, pieces: Pieces, key: str = "doc_id", text: str = "text", limit: int = 4096) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row: UTF-8 bytes, tokens, and whether these exceed the limit."""
    spark = ready(docs.sparkSession)
    sent = spark.sparkContext.broadcast((pieces.ranks, pieces.byte_fallback))

    @F.arrow_udf("bigint")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Pieces(*sent.value)
        for texts in batches:
            yield pa.array([own.count(t) for t in texts.to_pylist()], pa.int64())

    n_bytes = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint")
    counted = docs.select(F.col(key), n_bytes.alias("n_bytes"), tokens(F.col(text)).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
