"""Language identification by unigram pieces with all segmentations summed.

A word is a stretch of letters in lower case with a mark before it. Each language has a probability for
every piece of a fixed public vocabulary; a word's probability is the sum over all ways to cut it into
pieces, by the forward algorithm; a text's is the product over its words. Words of one length go through the
recursion together as arrays, and a task scores each distinct word once.

Training is expectation-maximisation over a bounded sample of labelled texts: each round is one pass over
(language, word, count) rows, whose expected piece counts are summed by language and piece. Only these sums,
languages times vocabulary, reach the driver. Language priors come from all labelled rows.

Edge cases: a text that is null or has no letter is ``und`` with score 0, and so is every text if nothing was
learned; characters outside the vocabulary are pieces of a small probability; words of any length are scored
whole, in a window of the longest piece; characters that are no letters, such as fractions, separate words; equal scores go to the first language in alphabetical order; null
labels teach nothing; repeated rows are rows of their own; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumagrid.llm.common import materialise, ready

#: Labelled texts per language that the pieces are learned from (expected number of a sample by hash).
SAMPLE = 600
ROUNDS = 3
SMOOTHING, UNKNOWN = 0.02, 1e-7
MARK = "▁"
#: Distinct words whose scores a task remembers, and their letters.
REMEMBERED, REMEMBERED_LETTERS = 400_000, 16 << 20
#: Cells of one batch of words, and positions between two scalings of the recursion.
BATCH_CELLS, SCALED_EVERY = 1 << 18, 8

LETTERS = re.compile(r"[^\W\d_]+")


def read_pieces(path: str) -> list[str]:
    """Pieces of a sentencepiece model, without control, byte and unused ones."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    plain = (i for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return sorted({model.id_to_piece(i).lower() for i in plain} - {""})


def words_of(text: str | None) -> list[str]:
    """Stretches of letters, in lower case."""
    found = LETTERS.findall(text.lower()) if text else []
    if all(map(str.isalpha, found)):
        return found
    return "".join(c if c.isalpha() else " " for c in " ".join(found)).split()


def longest_of(vocabulary: dict[str, int]) -> int:
    return max(map(len, vocabulary), default=1)


class Lattice:
    """Words of one length and the vocabulary numbers of all their substrings of up to ``longest`` characters."""

    def __init__(self, words: list[str], vocabulary: dict[str, int], longest: int):
        self.n, self.longest, self.words = len(words[0]), longest, len(words)
        unknown, none = len(vocabulary), len(vocabulary) + 1
        get = vocabulary.get
        #: For each end, (start, numbers) of the pieces that end there.
        self.ends: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(self.n + 1)]
        for i in range(self.n):
            for j in range(i + 1, min(self.n, i + longest) + 1):
                missing = unknown if j == i + 1 else none
                ids = [get(w[i:j], missing) for w in words]
                if j == i + 1 or any(x != none for x in ids):
                    self.ends[j].append((i, np.array(ids, np.int64)))

    def forward(self, chance: np.ndarray) -> np.ndarray:
        """(languages, words): log of the summed probability of all segmentations. chance: (languages, vocabulary + 2).

        Only the sums at the last ``longest`` positions are held; they are scaled together as they shrink.
        """
        held = self.longest + 1
        ring = np.zeros((held, chance.shape[0], self.words))
        ring[0], scale = 1, np.zeros(ring.shape[1:])
        for j in range(1, self.n + 1):
            ring[j % held] = sum(ring[i % held] * chance[:, ids] for i, ids in self.ends[j])
            if j % SCALED_EVERY == 0:
                top = ring.max(axis=0)
                ring /= top
                scale += np.log(top)
        return np.log(ring[self.n % held]) + scale

    def expected(self, chance: np.ndarray, weight: np.ndarray, total: np.ndarray) -> None:
        """Adds the expected piece counts of the words, each ``weight`` times, to ``total``; sums are held as logs."""
        with np.errstate(divide="ignore"):
            logs = np.log(chance)
        ahead, behind = (np.full((self.n + 1, self.words), -np.inf) for _ in range(2))
        ahead[0] = behind[self.n] = 0
        for j in range(1, self.n + 1):
            for i, ids in self.ends[j]:
                ahead[j] = np.logaddexp(ahead[j], ahead[i] + logs[ids])
        for j in range(self.n, 0, -1):
            for i, ids in self.ends[j]:
                behind[i] = np.logaddexp(behind[i], logs[ids] + behind[j])
        for j in range(1, self.n + 1):
            for i, ids in self.ends[j]:
                share = np.exp(ahead[i] + logs[ids] + behind[j] - ahead[self.n])
                total += np.bincount(ids, share * weight, len(total))


def by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Places of the words of each length, as many at a time as a bounded array holds."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        many = max(1, min(8192, BATCH_CELLS // max(int(size), 1)))
        for at in range(0, len(own), many):
            yield own[at : at + many]


def log_chances(words: list[str], vocabulary: dict[str, int], chance: np.ndarray) -> np.ndarray:
    """(words, languages): log probability of each word with its mark."""
    marked, longest = [MARK + w for w in words], longest_of(vocabulary)
    out = np.zeros((len(words), chance.shape[0]))
    for own in by_length(marked):
        out[own] = Lattice([marked[i] for i in own.tolist()], vocabulary, longest).forward(chance).T
    return out


def _with_unknown(counts: np.ndarray) -> np.ndarray:
    """Smoothed probabilities of the pieces, then of an unknown character and of no piece."""
    chance = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * counts.shape[1])
    extra = np.tile([UNKNOWN, 0.0], (len(counts), 1))
    return np.concatenate((chance, extra), axis=1)


class Model:
    def __init__(self, languages: list[str], priors: np.ndarray, pieces: list[str], chance: np.ndarray):
        self.languages, self.priors, self.chance = languages, priors, chance
        self.vocabulary = {p: i for i, p in enumerate(pieces)}


def train(
    labelled: DataFrame, pieces: list[str], text: str, lang: str, chosen: Column, sample: int = SAMPLE
) -> Model | None:
    """A model from rows with a label; None without any. chosen: a hash that decides which rows are sampled."""
    spark = labelled.sparkSession
    labelled = labelled.filter(F.col(lang).isNotNull())
    seen = sorted((r[lang], r["count"]) for r in labelled.groupBy(lang).count().collect())
    if not seen:
        return None
    languages = [name for name, _ in seen]
    number = F.create_map(*(F.lit(x) for i, name in enumerate(languages) for x in (name, i)))
    # The sample's share of a language's rows, in 2**-20: at least the bound's, so at most 2**-20 too many.
    share = F.create_map(*(F.lit(x) for name, n in seen for x in (name, -(-sample * 2**20 // n))))
    taken = labelled.filter(F.pmod(chosen, F.lit(2**20)) < share[F.col(lang)])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter[tuple[int, str]] = Counter()
            for own, body in zip(batch.column("l").to_pylist(), batch.column("t").to_pylist()):
                found.update((own, MARK + word) for word in words_of(body))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in found], pa.int32()),
                    pa.array([k[1] for k in found], pa.string()),
                    pa.array(list(found.values()), pa.int64()),
                ],
                ["l", "word", "n"],
            )

    rows = taken.select(number[F.col(lang)].cast("int").alias("l"), F.col(text).alias("t"))
    rows = rows.mapInArrow(count, "l int, word string, n bigint").groupBy("l", "word").agg(F.sum("n").alias("n"))
    rows = materialise(rows, "language-words")
    counts = np.ones((len(languages), len(pieces)))
    for _ in range(ROUNDS):
        sent = spark.sparkContext.broadcast((pieces, _with_unknown(counts)))

        def expect(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            names, chance = sent.value
            vocabulary = {p: i for i, p in enumerate(names)}
            longest = longest_of(vocabulary)
            total = np.zeros(chance.shape)
            for batch in batches:
                own = batch.column("l").to_numpy()
                words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy().astype(float)
                for language in np.unique(own).tolist():
                    mine = np.flatnonzero(own == language)
                    for at in by_length([words[i] for i in mine.tolist()]):
                        picked = mine[at]
                        lattice = Lattice([words[i] for i in picked.tolist()], vocabulary, longest)
                        lattice.expected(chance[language], n[picked], total[language])
            language, piece = np.nonzero(total[:, : len(names)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(language, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[language, piece])],
                ["l", "piece", "n"],
            )

        summed = rows.mapInArrow(expect, "l int, piece int, n double").groupBy("l", "piece").agg(F.sum("n").alias("n"))
        summed = summed.toPandas()
        counts = np.zeros_like(counts)
        counts[summed["l"].to_numpy(int), summed["piece"].to_numpy(int)] = summed["n"].to_numpy(float)
    priors = np.log(np.array([n for _, n in seen], float) / sum(n for _, n in seen))
    return Model(languages, priors, pieces, _with_unknown(counts))


def predict(docs: DataFrame, model: Model | None, text: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with a struct: lang and score, the posterior probability of that language."""
    ready(docs.sparkSession)
    if model is None:
        nothing = F.struct(F.lit("und").alias("lang"), F.lit(0.0).alias("score"))
        return docs.withColumn(into, nothing)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang: string, score: double>")
    def told(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = sent.value
        width = len(own.languages)
        known: dict[str, int] = {}
        scores, letters = np.zeros((0, width)), 0
        for texts in batches:
            if len(known) > REMEMBERED or letters > REMEMBERED_LETTERS:
                known, scores, letters = {}, np.zeros((0, width)), 0
            rows = [words_of(t) for t in texts.to_pylist()]
            new = list({w for row in rows for w in row if w not in known})
            letters += sum(map(len, new))
            known.update(zip(new, range(len(known), len(known) + len(new))))
            scores = np.concatenate((scores, log_chances(new, own.vocabulary, own.chance))) if new else scores
            names, values = [], []
            for row in rows:
                if not row:
                    names.append("und")
                    values.append(0.0)
                    continue
                at = np.fromiter(map(known.__getitem__, row), np.int64, len(row))
                total = own.priors + scores[at].sum(axis=0)
                best = int(total.argmax())
                names.append(own.languages[best])
                values.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(values, pa.float64())], ["lang", "score"])

    return docs.withColumn(into, told(F.col(text)))
