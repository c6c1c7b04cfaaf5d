"""Repair of conversations: the cheapest edits that give roles the order system?, (user, assistant)+, or nothing.

Turns of a conversation are taken by turn, nulls first, then role and text. Each has at most one fault: blank (no
character but white space), duplicate (its role and text came earlier), truncated (its last character that is not
white space is none of ``.!?``). Edits, with their letters: Keep, Rerole to user or assistant, Delete
(required for blank and duplicate turns), Insert an empty turn of user or assistant. A kept or reroled
truncated turn costs extra. Of the cheapest lists of edits the one whose letters come first is taken; the
letters settle all roles, since after a system turn the roles alternate.

Search: depth-first over (turns done, last role) with an explicit stack, edits in the order of their letters, so
that prefixes are met in that order. The least cost of each suffix from each role is a lower bound; a
prefix is left if cost and bound exceed the incumbent's cost, or if its node was reached before at no greater
cost (the dominance table: the earlier prefix also has the smaller letters). Two prefixes of one node
and cost never begin with one another, since letters determine cost, so the order of prefixes is that of the
whole lists. The search ends when the stack is empty, which proves the incumbent.

Scale: turns are sorted by ranges of (conversation, turn, role, text), so one conversation may span many tasks. A
conversation inside one task and one block of bounded size is repaired at once. Of the others (first
and last ones of a task, and long ones) each block is searched from every role to every role, duplicates are found by
a grouped minimum over digests, and a pass over these small tables, without texts, joins the blocks' edits;
texts are then edited block by block. Only the letters of a conversation, one byte a turn, are ever together.

Edge cases: null ids are one conversation; null roles and texts are one space; roles count by their first character,
and an empty or unknown one cannot be kept; turns that agree in everything are duplicates but for the first; a
conversation of deleted turns only is repaired to nothing; turns outside the range of a long are null; an empty table gives
an empty result; other columns are neither read nor returned.
"""

from __future__ import annotations

import hashlib
import os.path
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lumagrid.llm.common import materialise, ready

REROLE, DELETE, INSERT, CUT_OFF = 2, 3, 2, 1
SPACE = " \t\n\v\f\r"
#: Turns and characters of a block.
BLOCK_TURNS, BLOCK_CHARS = 1024, 1 << 20

# What came last: nothing, system, user, assistant. A conversation may end after nothing or assistant.
STATES = range(4)
ENDS = (0, 3)
ROLES = ("", "system", "user", "assistant")
INITIALS = {"s": 1, "u": 2, "a": 3}
LEGAL = {(1, 2), (2, 3), (3, 2)}
NEXT = (2, 2, 3, 2)  # the role that may be given after each state
# A turn as one byte: its initial (0: another), and faults.
BLANK, TRUNCATED, DUPLICATE = 4, 8, 16
NEVER = float("inf")


def turn_code(role: str, text: str) -> int:
    shown = text.rstrip(SPACE)
    fault = BLANK if not shown else 0 if shown[-1] in ".!?" else TRUNCATED
    return INITIALS.get(role[:1], 0) | fault


def steps(code: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of what may be done with a turn, in the order of letters; Insert is not among them."""
    found = [("D", DELETE, state)]
    if not code & (BLANK | DUPLICATE):
        extra, own = CUT_OFF if code & TRUNCATED else 0, code & 3
        if own and (own == NEXT[state] or (own == 1 and state == 0)):
            found.append(("K", extra, own))
        found.append(("R", REROLE + extra, NEXT[state]))
    return found


#: All of it is settled by the byte and the state.
STEPS = [[steps(code, state) for state in STATES] for code in range(32)]


def suffix_bounds(codes: bytes, ends: tuple[int, ...]) -> list[list[float]]:
    """Per number of turns done, the least cost of the rest from each state."""

    def with_inserts(base: list[float]) -> list[float]:
        once = [min(base[q], INSERT + base[NEXT[q]]) for q in STATES]
        return [min(base[q], INSERT + once[NEXT[q]]) for q in STATES]

    bounds = [with_inserts([0 if q in ends else NEVER for q in STATES])]
    for code in reversed(codes):
        after, own = bounds[-1], STEPS[code]
        bounds.append(with_inserts([min(cost + after[to] for _, cost, to in own[q]) for q in STATES]))
    bounds.reverse()
    return bounds


def choices(codes: bytes, done: int, state: int) -> list[tuple[str, int, int, int]]:
    """(letter, cost, turns done, state) of the edits possible at a node, in the order of letters."""
    insert = ("I", INSERT, done, NEXT[state])
    if done == len(codes):
        return [insert]
    first, *rest = [(name, cost, done + 1, to) for name, cost, to in STEPS[codes[done]][state]]
    return [first, insert, *rest]


def dive(codes: bytes, start: int, ends: tuple[int, ...], bounds: list[list[float]]) -> tuple[int, str]:
    """The first incumbent: always the edit of the least bound, the first letter of equals."""
    done, state, cost, letters = 0, start, 0, []
    while done < len(codes) or state not in ends:
        letter, more, done, state = min(choices(codes, done, state), key=lambda c: c[1] + bounds[c[2]][c[3]])
        letters.append(letter)
        cost += more
    return cost, "".join(letters)


def search(codes: bytes, start: int = 0, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """The least (cost, letters) that lead from a state over all turns to one of ``ends``; None if nothing does."""
    n, bounds = len(codes), suffix_bounds(codes, ends)
    if bounds[0][start] == NEVER:
        return None
    best = dive(codes, start, ends, bounds)
    reached = [[NEVER] * len(STATES) for _ in range(n + 1)]
    letters: list[str] = []
    stack = [(0, start, 0, 0, "")]
    while stack:
        done, state, cost, depth, letter = stack.pop()
        if cost >= reached[done][state] or cost + bounds[done][state] > best[0]:
            continue
        if letter:
            letters[depth - 1 :] = letter
        reached[done][state] = cost
        if done == n and state in ends:
            best = min(best, (cost, "".join(letters[:depth])))
        # The stack gives back the last one first.
        for name, more, to_done, to in reversed(choices(codes, done, state)):
            stack.append((to_done, to, cost + more, depth + 1, name))
    return best


@lru_cache(maxsize=1 << 15)
def _remembered(codes: bytes, start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    return search(codes, start, ends)


def cheapest(codes: bytes, start: int = 0, ends: tuple[int, ...] = ENDS) -> tuple[int, str] | None:
    """``search``, remembering short conversations, whose codes are often the same."""
    return (_remembered if len(codes) <= 16 else search)(codes, start, ends)


def edited(turns: list[tuple[str, str]], letters: str, start: int = 0) -> list[tuple[str, str, str]]:
    """(letter, role, text) of the turns that stay."""
    out, state, at = [], start, 0
    for letter in letters:
        role, text = ("", "") if letter == "I" else turns[at]
        at += letter != "I"
        if letter == "D":
            continue
        state = INITIALS[role[0]] if letter == "K" else NEXT[state]
        out.append((letter, role if letter == "K" else ROLES[state], text))
    return out


def faults(codes: bytes) -> tuple[int, int, int]:
    """Blank, duplicate and truncated turns."""
    blank = sum(c & BLANK > 0 for c in codes)
    duplicate = sum(c & (BLANK | DUPLICATE) == DUPLICATE for c in codes)
    return blank, duplicate, sum(c & (BLANK | DUPLICATE | TRUNCATED) == TRUNCATED for c in codes)


def illegal(codes: bytes) -> int:
    return sum((a & 3, b & 3) not in LEGAL for a, b in zip(codes, codes[1:]))


def spread_of(turns: list[int | None]) -> tuple[int | None, int | None, int]:
    """Least, greatest and number of distinct turns."""
    known = {t for t in turns if t is not None}
    return (min(known), max(known), len(known)) if known else (None, None, 0)


def gaps_of(low: int | None, high: int | None, distinct: int) -> int:
    return 0 if low is None else high - low + 1 - distinct


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
TURNS = "array<struct<edit: string, role: string, text: string>>"


def _fields(text: str) -> list[T.StructField]:
    return T._parse_datatype_string(text).fields


def _summary_fields() -> list[T.StructField]:
    return [T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("audit", T.StringType())]


def _blocks(rows: DataFrame, block_turns: int) -> DataFrame:
    """One row per block of sorted turns: repaired if the conversation is known to be whole, or else as it is."""
    key = rows.schema["key"].dataType
    out = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("key", key)]
        + [T.StructField("whole", T.BooleanType()), *_summary_fields()]
        + _fields(
            f"repaired {TURNS}, turns array<bigint>, roles array<string>, texts array<string>, digests array<binary>, codes binary"
        )
    )
    schema = to_arrow_schema(out)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, block, ready_rows = context.partitionId() if context else 0, 0, []
        name, first, pieces, size = None, True, 0, 0
        turns: list[int | None] = []
        roles: list[str] = []
        texts: list[str] = []

        def flush(whole: bool) -> None:
            nonlocal block, size, turns, roles, texts
            codes = bytearray(map(turn_code, roles, texts))
            if whole:
                seen: set[tuple[str, str]] = set()
                for i, pair in enumerate(zip(roles, texts)):
                    if pair in seen and not codes[i] & BLANK:
                        codes[i] |= DUPLICATE
                    seen.add(pair)
                own = bytes(codes)
                cost, letters = cheapest(own)
                summary = (gaps_of(*spread_of(turns)), *faults(own), illegal(own), cost, letters)
                fixed = [dict(zip(("edit", "role", "text"), t)) for t in edited(list(zip(roles, texts)), letters)]
                row = (part, block, name, True, *summary, fixed, None, None, None, None, None)
            else:
                digests = [hashlib.blake2b(f"{len(r)}:{r}{t}".encode(), digest_size=16).digest() for r, t in zip(roles, texts)]
                row = (part, block, name, False, *[None] * 7, None, turns, roles, texts, digests, bytes(codes))
            ready_rows.append(row)
            block, size, turns, roles, texts = block + 1, 0, [], [], []

        def batch_of() -> pa.RecordBatch:
            arrays = [pa.array(c, f.type) for c, f in zip(zip(*ready_rows), schema)]
            ready_rows.clear()
            return pa.RecordBatch.from_arrays(arrays, schema=schema)

        waiting = 0
        for batch in batches:
            for own, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "turn", "role", "text"))):
                if turns or pieces:
                    if own != name:
                        if turns:
                            flush(not first and not pieces)
                        first, pieces = False, 0
                    elif len(turns) >= block_turns or size >= BLOCK_CHARS:
                        flush(False)
                        pieces += 1
                name = own
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                size += len(text)
                waiting += len(text) + 64
                if waiting > BLOCK_CHARS and ready_rows:
                    yield batch_of()
                    waiting = 0
        if turns:
            flush(False)
        if ready_rows:
            yield batch_of()

    return rows.mapInArrow(cut, out)


def _paths(cut: DataFrame) -> DataFrame:
    """Blocks without texts: codes with duplicates marked, and the edits from every state to every other."""
    at = cut.select("part", "block", "key", F.posexplode("digests").alias("pos", "digest"))
    first = at.groupBy("key", "digest").agg(F.min(F.struct("part", "block", "pos")).alias("x"))
    first = first.groupBy("x.part", "x.block").agg(F.collect_list("x.pos").alias("new"))
    rows = cut.select("part", "block", "key", "turns", "codes").join(first, ["part", "block"], "left")
    out = T.StructType(
        [T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()), rows.schema["key"]]
        + _fields("turns array<bigint>, codes binary, paths array<struct<start: int, stop: int, cost: bigint, audit: string>>")
    )
    schema = to_arrow_schema(out)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked, paths = [], []
            for codes, new in zip(batch.column("codes").to_pylist(), batch.column("new").to_pylist()):
                fresh = set(new or ())
                own = bytes(c if i in fresh or c & BLANK else c | DUPLICATE for i, c in enumerate(codes))
                found = ((a, b, cheapest(own, a, (b,))) for a in STATES for b in STATES)
                marked.append(own)
                paths.append([{"start": a, "stop": b, "cost": x[0], "audit": x[1]} for a, b, x in found if x])
            columns = [*(batch.column(c) for c in ("part", "block", "key", "turns")), marked, paths]
            arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(arrays, schema)], schema=schema)

    return rows.mapInArrow(measure, out)


class Join:
    """Joins the blocks of one conversation, in order."""

    def __init__(self) -> None:
        # (cost, letters after the common ones) per state; the states that each block was left in, with those before.
        self.best: dict[int, tuple[int, str]] = {0: (0, "")}
        self.common: list[str] = []
        self.back: list[dict[int, int]] = []
        self.blocks: list[tuple[int, int]] = []
        self.counts = [0, 0, 0, 0]
        self.low = self.high = self.last_turn = None
        self.distinct, self.last_code = 0, b""

    def add(self, at: tuple[int, int], turns: list[int | None], codes: bytes, paths: list[dict]) -> None:
        made: dict[int, tuple[int, str, int]] = {}
        for p in paths:
            if p["start"] in self.best:
                cost, letters = self.best[p["start"]]
                new = (cost + p["cost"], letters + p["audit"], p["start"])
                made[p["stop"]] = min(made.get(p["stop"], new), new)
        shared = os.path.commonprefix([x[1] for x in made.values()])
        self.common.append(shared)
        self.best = {q: (cost, letters[len(shared) :]) for q, (cost, letters, _) in made.items()}
        self.back.append({q: x[2] for q, x in made.items()})
        self.blocks.append(at)
        low, high, distinct = spread_of(turns)
        if low is not None:
            self.low = low if self.low is None else self.low
            self.distinct += distinct - (self.high == low)
            self.high = high
        for i, n in enumerate((*faults(codes), illegal(self.last_code + codes))):
            self.counts[i] += n
        self.last_code = codes[-1:]

    def done(self) -> tuple[list[tuple[int, int, int, int]], tuple]:
        """(part, block, state before, state after) of the blocks, and the summary."""
        cost, letters, state = min((*self.best[q], q) for q in ENDS if q in self.best)
        plan = []
        for at, back in zip(reversed(self.blocks), reversed(self.back)):
            plan.append((*at, back[state], state))
            state = back[state]
        gaps = gaps_of(self.low, self.high, self.distinct)
        return plan, (gaps, *self.counts, cost, "".join(self.common) + letters)


def _joined(paths: DataFrame) -> DataFrame:
    """(part, block, start, stop) of all blocks, with key and summary in one row of each conversation."""
    out = T.StructType(
        _fields("part int, block int, start int, stop int") + [paths.schema["key"]] + [T.StructField("whole", T.BooleanType())]
        + _summary_fields()
    )
    schema = to_arrow_schema(out)
    nothing = (None,) * (len(COUNTS) + 1)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Join | None = None
        name = None

        def result() -> Iterator[pa.RecordBatch]:
            plan, summary = own.done()
            for at in range(0, len(plan), 4096):
                rows = [
                    (*p, name, True, *summary) if at + i == 0 else (*p, None, False, *nothing)
                    for i, p in enumerate(plan[at : at + 4096])
                ]
                arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                if own is not None and row["key"] != name:
                    yield from result()
                    own = None
                own = own or Join()
                name = row["key"]
                own.add((row["part"], row["block"]), row["turns"], row["codes"], row["paths"])
        if own is not None:
            yield from result()

    return paths.repartition("key").sortWithinPartitions("key", "part", "block").mapInArrow(join, out)


def _pieces(cut: DataFrame, paths: DataFrame, joined: DataFrame) -> DataFrame:
    """(key, part, block, repaired) of the blocks of cut conversations."""
    rows = cut.select("part", "block", "key", "roles", "texts").join(paths.select("part", "block", "codes"), ["part", "block"])
    rows = rows.join(joined.select("part", "block", "start", "stop"), ["part", "block"])
    out = T.StructType(
        [rows.schema["key"], *_fields(f"part int, block int, repaired {TURNS}")]
    )
    schema = to_arrow_schema(out)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fixed = []
            for row in batch.select(["roles", "texts", "codes", "start", "stop"]).to_pylist():
                _, letters = cheapest(row["codes"], row["start"], (row["stop"],))
                turns = edited(list(zip(row["roles"], row["texts"])), letters, row["start"])
                fixed.append([dict(zip(("edit", "role", "text"), t)) for t in turns])
            columns = [*(batch.column(c) for c in ("key", "part", "block")), pa.array(fixed, schema.field("repaired").type)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, schema)], schema=schema)

    return rows.mapInArrow(edit, out)


@dataclass
class Repaired:
    """Results of a repair: conversations in one piece, and those that were joined from blocks.

    whole: (key, counts, cost, audit, repaired); cut: the same without ``repaired``; pieces: (key, part, block,
    repaired) of the latter, in the order of part and block. repaired: (edit, role, text) of the turns that stay.
    """

    whole: DataFrame
    cut: DataFrame
    pieces: DataFrame

    def summaries(self) -> DataFrame:
        """(key, gaps, blank, duplicate, truncated, illegal, cost, audit) of every conversation."""
        return self.whole.drop("repaired").unionByName(self.cut)

    def turns(self) -> DataFrame:
        """(key, part, block, position, edit, role, text) of every turn of the repaired conversations."""
        first = self.whole.select("key", F.lit(0).alias("part"), F.lit(0).alias("block"), "repaired")
        rows = first.unionByName(self.pieces).select("key", "part", "block", F.posexplode("repaired").alias("position", "t"))
        return rows.select("key", "part", "block", "position", "t.*")

    def digests(self) -> DataFrame:
        """The summaries with ``repaired_sha256``: of the lines ``role:text`` of the repaired conversation."""
        whole = self.whole.withColumn("repaired_sha256", F.sha2(lines("repaired"), 256)).drop("repaired")
        streamed = _streamed_digests(self.pieces.select("key", "part", "block", lines("repaired").alias("lines"), F.size("repaired").alias("n")))
        both = self.cut.join(streamed, self.cut["key"].eqNullSafe(streamed["of_key"]))
        return whole.unionByName(both.drop("of_key"))


def lines(repaired: str) -> Column:
    return F.array_join(F.transform(repaired, lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")


def _streamed_digests(pieces: DataFrame) -> DataFrame:
    """(of_key, repaired_sha256): the digest of each key's lines, piece after piece, holding one piece at a time."""
    out = T.StructType([T.StructField("of_key", pieces.schema["key"].dataType), T.StructField("repaired_sha256", T.StringType())])
    schema = to_arrow_schema(out)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, name, found = None, None, []
        for batch in batches:
            for own, text, n in zip(*(batch.column(c).to_pylist() for c in ("key", "lines", "n"))):
                if made is not None and own != name:
                    found.append((name, made.hexdigest()))
                    made = None
                if made is None:
                    made, some = hashlib.sha256(), False
                name = own
                if n:
                    made.update((("\n" if some else "") + text).encode())
                    some = True
        if made is not None:
            found.append((name, made.hexdigest()))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return pieces.repartition("key").sortWithinPartitions("key", "part", "block").mapInArrow(stream, out)


def repair(
    rows: DataFrame,
    key: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    block_turns: int = BLOCK_TURNS,
) -> Repaired:
    """Repairs all conversations of a table of turns. block_turns: turns of a block; the result is the same for any."""
    ready(rows.sparkSession)
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = rows.select(
        F.col(key).alias("key"), F.expr(f"try_cast(`{turn}` as bigint)").alias("turn"), plain(role).alias("role"), plain(text).alias("text")
    )
    # Bounds of the ranges reach the driver, hence not the whole text; the order inside a range is that of whole texts.
    dealt = rows.repartitionByRange("key", "turn", "role", F.substring("text", 1, 64))
    blocks = materialise(_blocks(dealt.sortWithinPartitions("key", "turn", "role", "text"), block_turns), "conversation-blocks")
    whole = blocks.filter("whole").select("key", *COUNTS, "audit", "repaired")
    cut = blocks.filter("not whole")
    paths = materialise(_paths(cut), "conversation-paths")
    joined = materialise(_joined(paths), "conversation-joins")
    summaries = joined.filter("whole").select("key", *COUNTS, "audit")
    return Repaired(whole, summaries, _pieces(cut, paths, joined))


def damage(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with planted faults, by a checksum of conversation and turn: one twentieth each is dropped, emptied, robbed
    of its stops, repeated, or given to the user. Nulls are one space."""
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(plain(key), F.lit(":"), plain(turn))) % 20
    new_text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(plain(text), "[.!?]", "")).otherwise(plain(text))
    copies = F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1)))
    return rows.filter(kind != 0).select(
        F.col(key).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.when(kind == 4, "user").otherwise(plain(role)).alias("role"),
        new_text.alias("text"),
        copies.alias("copy"),
    )
