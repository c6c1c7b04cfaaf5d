"""Token counts against the tokenizer's library, vector codes and repaired conversations against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import zlib
from fractions import Fraction

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from lumagrid.llm import codes, conversations, piece_counts, queries

SF = "/root/testdata/sf0.001"

# ---------------------------------------------------------------- token counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "", None, " ", "  ", "a", " a", "a ", "\n", "a\n\nb\tc", "<s>a</s><unk><0x0A>", "▁", "a▁b ▁▁ c", " " * 999 + "x" + " " * 7,
    "aaaa" * 4000, "漢字かな交じり文" * 300, "\x00a\x00", "🙂🙂 👩‍👩‍👧", "ｆｕｌｌ ﬁ é́ x\xa0y", "ab" * 600 + "\n" + "qx" * 700,
]


def texts_of(seed):
    rng = random.Random(seed)
    letters = "ab ▁\n<0x>éß漢🙂tTheing  "
    return HARD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(400)]


def test_counts_are_those_of_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = texts_of(1)
    # A column that clashes with a result column is neither read nor returned.
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("n_tokens", F.lit("x"))
    found = piece_counts.count(rows, piece_counts.read_pieces(MODEL), limit=100)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    got = {r.doc_id: tuple(r)[1:] for r in found.collect()}
    for i, text in enumerate(texts):
        n = len(library.encode(text or ""))
        assert got[i] == (len((text or "").encode()), n, n > 100), text
    assert piece_counts.count(rows.limit(0), piece_counts.read_pieces(MODEL)).count() == 0


def plain_count(text, ranks):
    symbols = list(text)
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in ranks]
        if not pairs:
            return sum(1 if s in ranks else len(s.encode()) for s in symbols)
        i = min(pairs)[1]
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


def test_counts_of_any_pieces():
    """Pieces with marks inside, single characters that are no pieces, equal ranks."""
    rng = random.Random(2)
    for _ in range(60):
        letters = "ab▁é"
        ranks = {"".join(rng.choices(letters, k=rng.randint(1, 4))): float(rng.randint(1, 9)) for _ in range(12)}
        pieces = piece_counts.Pieces(ranks)
        for _ in range(10):
            text = "".join(rng.choices("ab é", k=rng.randint(1, 20)))
            assert pieces.count(text) == plain_count("▁" + text.replace(" ", "▁"), ranks)
            long = text * 30
            assert pieces.count(long) == plain_count("▁" + long.replace(" ", "▁"), ranks)


def test_models_of_another_kind_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        model.ParseFromString(file.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        piece_counts.read_pieces(str(tmp_path / "other.model"))


# ---------------------------------------------------------------- vector codes


def plain_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (key, vector, label). Returns {(key, code, error, label_error)} and the digest."""
    kept = []
    for key, vector, label in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((key, [math.floor(4096 * Fraction(x)) for x in vector], label))
    kept.sort(key=lambda r: r[:2])
    if not kept:
        return set()
    n = len(kept[0][1])
    at = [n * p // parts for p in range(parts + 1)]
    cut = [[v[a:b] for a, b in zip(at, at[1:])] for _, v, _ in kept]
    book = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for vector in cut:
            own = [
                min((sum((x - y) ** 2 for x, y in zip(vector[p], e)), i) for i, e in enumerate(book[p])) for p in range(parts)
            ]
            out.append(own)
        return out

    for _ in range(rounds):
        picked = assign()
        for p in range(parts):
            for i in range(len(book[p])):
                own = [c[p] for c, k in zip(cut, picked) if k[p][1] == i]
                if own:
                    book[p][i] = [sum(x) // len(own) for x in zip(*own)]
    picked = assign()
    error = [sum(d for d, _ in k) for k in picked]
    total = {}
    for (_, _, label), e in zip(kept, error):
        total[label] = total.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(x) for b in book for e in b for x in e).encode()).hexdigest()
    most = (1 << 63) - 1
    return {
        (key, "".join(f"{i:02x}" for _, i in k), min(e, most), min(total[label], most), digest)
        for (key, _, label), k, e in zip(kept, picked, error)
    }


def run_codes(rows):
    found, book = codes.compress(rows)
    return {(r.vec_id, r.code, r.error, r.label_error, codes.digest(book)) for r in found.collect()}


VECTORS = "vec_id bigint, embedding array<double>, label int"


def test_codes_equal_the_plain_version(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(20)], rng.choice([None, 0, 1, 1, 1])) for i in range(-40, 260)]
    rows += [(500, None, 1), (501, [None] + [0.1] * 19, 1), (502, [math.nan] + [0.1] * 19, 0), (503, [-math.inf] * 20, 0)]
    rows += [(600, [0.25] * 20, 1), (600, [0.25] * 20, 1)]
    rng.shuffle(rows)
    # Columns with the operator's inner names do no harm.
    table = spark.createDataFrame(rows, VECTORS).withColumns({"key": F.lit(1), "code": F.lit("x"), "n": F.lit(2)})
    assert run_codes(table.repartition(5)) == plain_codes(rows)


def test_large_numbers_few_rows_and_other_lengths(spark):
    rows = [(i, [1e20 * i, -3.5, 7e30, 0.0, 1.0, 2.0, 3.0, 4.0, 5.0], 1) for i in range(5)]
    assert run_codes(spark.createDataFrame(rows, VECTORS)) == plain_codes(rows)
    others = [(7, [1.0, 2.0], 1), (8, [], None)]
    found, _ = codes.compress(spark.createDataFrame(rows + others, VECTORS))
    assert {r.vec_id: (r.code, r.error) for r in found.filter("vec_id > 5").collect()} == {7: (None, None), 8: (None, None)}
    found, book = codes.compress(spark.createDataFrame([(1, None, 1)], VECTORS))
    assert found.count() == 0 and codes.digest(book) == hashlib.sha256(b"").hexdigest()
    found, _ = codes.compress(spark.createDataFrame([(1, [], 1), (None, [], 2)], VECTORS))
    assert sorted((r.code, r.error) for r in found.collect()) == [("00" * 8, 0)] * 2


def test_blocks_of_any_size_give_the_same_codes(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16)], i % 3) for i in range(200)]
    table = spark.createDataFrame(rows, VECTORS).coalesce(1)
    want = run_codes(table)
    monkeypatch.setattr(codes, "BLOCK_VALUES", 16 * 7)
    assert run_codes(table) == want


# --------------------------------------------------------------- conversations


def plain_best(turns, flags):
    """All lists of edits with up to six insertions; flags: (must go, truncated) of each turn."""
    best = None
    for done in itertools.product("DKR", repeat=len(turns)):
        if any(letter != "D" and must for letter, (must, _) in zip(done, flags)):
            continue
        for inserts in itertools.product(range(3), repeat=len(turns) + 1):
            letters, row = "", 0
            for k, n in enumerate(inserts):
                letters += "I" * n + (done[k] if k < len(done) else "")
            cost, out, state, fine = 0, [], "", True
            for letter in letters:
                if letter == "I":
                    cost += 2
                    role, text = ("assistant" if state == "u" else "user"), ""
                else:
                    role, text = turns[row]
                    cost += {"D": 3, "K": 0, "R": 2}[letter] + (letter != "D" and flags[row][1])
                    row += 1
                    if letter == "D":
                        continue
                    if letter == "R":
                        role = "assistant" if state == "u" else "user"
                initial = role[:1]
                if initial not in {"": ("s", "u"), "s": "u", "u": "a", "a": "u"}[state] or not initial:
                    fine = False
                    break
                state = initial
                out.append(f"{role}:{text}")
            if fine and state in ("", "a"):
                best = min(best or (cost, letters, out), (cost, letters, out))
    return best


def plain_repair(turns):
    """turns: (turn, role, text) after damage; returns the summary and the digest."""
    rows = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
    seen, counts, flags = set(), [0, 0, 0], []
    for _, role, text in rows:
        shown = text.strip(" \t\n\v\f\r")
        fault = 0 if not shown else 1 if (role, text) in seen else 2 if shown[-1] not in ".!?" else 3
        seen.add((role, text))
        if fault < 3:
            counts[fault] += 1
        flags.append((fault < 2, fault == 2))
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    pairs = [r[1:] for r in rows]
    cost, letters, out = plain_best(pairs, flags)
    return (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(out).encode()).hexdigest())


def some_turns(rng, n):
    out = []
    for i in range(n):
        text = rng.choice(["Yes.", "No", "", " \n", "Ok!", "Well. ", "\xa0", "a."]) + rng.choice(["", str(rng.randint(0, 3)) + "."])
        turn = rng.choice([None, *[i] * 6, i + 1, i - 1])
        out.append((turn, rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", " ", "agent"]), text))
    return out


@pytest.mark.parametrize("block", [1, 2, 1024])
def test_repairs_are_the_cheapest_ones(spark, block):
    rng = random.Random(5)
    given = {k: some_turns(rng, rng.randint(0, 4)) for k in range(120)}
    rows = [(k if k else None, *t, "x", 1) for k, turns in given.items() for t in turns]
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id int, turn bigint, role string, text string, key string, part int")
    found = conversations.repair(table.repartition(3), block_turns=block)
    got = {r.key or 0: tuple(r)[1:] for r in found.digests().collect()}
    assert got == {k: plain_repair(turns) for k, turns in given.items() if turns}
    # The turns themselves are those of the digests.
    lines = {}
    for r in sorted(found.turns().collect(), key=lambda r: (r.part, r.block, r.position)):
        lines.setdefault(r.key or 0, []).append(f"{r.role}:{r.text}")
    assert {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in lines.items()} == {
        k: v[-1] for k, v in got.items() if k in lines
    }


def test_search_equals_enumeration():
    rng = random.Random(6)
    for _ in range(150):
        turns = [(rng.choice(["system", "user", "assistant", "x"]), "") for _ in range(rng.randint(0, 4))]
        flags = [rng.choice([(False, False), (False, True), (True, False)]) for _ in turns]
        code = bytes(
            conversations.INITIALS.get(r[0], 0) | (conversations.BLANK if must else conversations.TRUNCATED if cut else 0)
            for (r, _), (must, cut) in zip(turns, flags)
        )
        assert conversations.search(code) == plain_best(turns, flags)[:2]


def test_a_conversation_over_many_tasks_and_blocks(spark):
    """Half of all turns in one conversation, ranges over several partitions: the same as in one block."""
    rng = random.Random(7)
    rows = [(1, i // 2, rng.choice(["user", "assistant"]), f"text {rng.randint(0, 300)}" + rng.choice([".", ""])) for i in range(3000)]
    rows += [(k, i, "user" if i % 2 == 0 else "assistant", "Fine.") for k in range(2, 300) for i in range(10)]
    table = spark.createDataFrame(rows, "conv_id int, turn bigint, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        split = conversations.repair(table.repartition(4), block_turns=64)
        assert split.pieces.filter("key = 1").select("part").distinct().count() > 1
        split = {r.key: tuple(r)[1:] for r in split.digests().collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    whole = {r.key: tuple(r)[1:] for r in conversations.repair(table.coalesce(1), block_turns=10**6).digests().collect()}
    assert split == whole and len(whole) == 299
    # Linear work: a long conversation is searched in about as many steps as it has turns.
    conversations.search(bytes([2, 3] * 50_000))


def test_empty_tables(spark):
    schema = "conv_id int, turn bigint, role string, text string"
    assert conversations.repair(spark.createDataFrame([], schema)).digests().count() == 0


def test_damage_and_query(spark, tmp_path):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in (0, 1, 2, 3, None) for r, x in [("user", "Hi. There!"), (None, None)]]
    rows += [(c, t, "assistant", f"Answer {t}?") for c in range(3, 40) for t in range(3)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    want = {}
    for c, t, role, text in rows:
        own = want.setdefault(c, [])
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(c)}:{name(t)}".encode()) % 20
        role, text = name(role), name(text)
        text = "" if kind == 1 else text.translate({46: None, 33: None, 63: None}) if kind == 2 else text
        if kind:
            own += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    found = {r.conv_id: tuple(r)[1:] for r in queries.op11_conversations(spark, str(tmp_path)).collect()}
    assert set(found) == set(want)
    for c, turns in want.items():
        if len(turns) <= 4:
            assert found[c] == plain_repair(turns), c
    assert sum(len(t) <= 4 for t in want.values()) > 30
