"""Conversation structure repair: the cheapest edits that give a well-formed conversation, by streaming.

Rows are dealt out by conversation and sorted by turn; ``mapInPandas`` carries the state of a dynamic programme from one
Arrow batch to the next. The language ``(s?(ua)+)?`` of role initials has four states. For each the stream keeps the least
cost, the order of the best edit strings so far (ties go to the ASCII-least) and the running SHA-256 of the repaired
rows, so that no text is kept. Each row leaves four bytes of backpointers; those of a giant conversation leave the task
as rows of a written table, and a second stream walks them backwards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from boxloom.cluster import cut
from boxloom.llm.catalog import query, table
from boxloom.llm.words import BLANKS

SPILL_ROWS = 65_536
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
LETTERS = "DIKR"
#: states: nothing yet, after a system row, after a user row, after an assistant row; what a user or assistant row leads to
NEXT = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
#: inserts that end a conversation in each state
ENDING = ("", "II", "I", "")
FAR = 1 << 60

STAGED = ("key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string, part int, pointers binary, last int")


@lru_cache(maxsize=None)
def _moves(initial: str, must_go: bool, cut_short: bool) -> tuple[tuple[tuple[int, int, str], ...], ...]:
    """For each state after a row: (state before, cost, edits), the edits being inserts and then one letter for the row."""
    out: list[list] = [[], [], [], []]
    for before in range(4):
        at, inserts = before, ""
        while len(inserts) <= 2:  # a third insert would lead to where the first did
            cost = INSERT * len(inserts)
            out[at].append((before, cost + DELETE, inserts + "D"))
            if not must_go:
                to, role = NEXT[at]
                if at == 0 and initial == "s":
                    out[1].append((before, cost + KEEP + TRUNCATED * cut_short, inserts + "K"))
                if initial == role[0]:
                    out[to].append((before, cost + KEEP + TRUNCATED * cut_short, inserts + "K"))
                out[to].append((before, cost + REROLE + TRUNCATED * cut_short, inserts + "R"))
            at, inserts = NEXT[at][0], inserts + "I"
    return tuple(map(tuple, out))


@lru_cache(maxsize=1 << 16)
def _step(costs: tuple, ranks: tuple, initial: str, must_go: bool, cut_short: bool) -> tuple:
    """One row: (added to all costs, costs above that, ranks of the best edit strings, (before, edits) for each state)."""
    best: list = [None] * 4
    for after, moves in enumerate(_moves(initial, must_go, cut_short)):
        for before, cost, edits in moves:
            if costs[before] < FAR:
                one = (costs[before] + cost, ranks[before], edits, before)
                best[after] = one if best[after] is None else min(best[after], one)
    low = min(b[0] for b in best if b)
    order = sorted((b[1:3], s) for s, b in enumerate(best) if b)
    place = [0] * 4
    for i, (_, s) in enumerate(order):
        place[s] = i
    return (low, tuple(b[0] - low if b else FAR for b in best), tuple(place), tuple((b[3], b[2]) if b else None for b in best))


def _code(move: tuple | None) -> int:
    """Backpointer in six bits: state before, number of inserts, letter."""
    return 0 if move is None else move[0] << 4 | (len(move[1]) - 1) << 2 | LETTERS.index(move[1][-1])


def _walk(pointers: bytes, state: int) -> tuple[str, int]:
    """Edits of consecutive rows from their backpointers, and the state before them."""
    out = []
    for row in range(len(pointers) // 4 - 1, -1, -1):
        code = pointers[4 * row + state]
        out.append("I" * (code >> 2 & 3) + LETTERS[code & 3])
        state = code >> 4
    return "".join(reversed(out)), state


class _Conversation:
    """What the stream carries for the conversation that is open."""

    def __init__(self, key: str):
        self.key, self.base, self.costs, self.ranks = key, 0, (0, FAR, FAR, FAR), (0, 0, 0, 0)
        self.hashes = [hashlib.sha256(), None, None, None]
        self.pointers, self.part = bytearray(), 0
        self.gaps = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = self.turn = None

    def row(self, turn: str | None, role: str, text: str, seen: bool) -> None:
        initial, worded = role[:1], text.rstrip(BLANKS)
        blank = not worded
        cut_short = not blank and not seen and worded[-1] not in ".!?"
        self.blank += blank
        self.duplicate += seen and not blank
        self.truncated += cut_short
        if self.initial is not None:
            self.illegal += self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        if turn is not None:
            if self.turn is not None and int(turn) != self.turn:
                self.gaps += int(turn) - self.turn - 1
            self.turn = int(turn)
        added, self.costs, self.ranks, moves = _step(self.costs, self.ranks, initial, blank or seen, cut_short)
        self.base += added
        made: list = [None] * 4
        for after, move in enumerate(moves):
            if move is not None:
                made[after] = self._hashed(move[0], move[1], role, text)
        self.hashes = made
        self.pointers += bytes(map(_code, moves))

    def _hashed(self, state: int, edits: str, role: str, text: str):
        h = self.hashes[state]
        if edits != "D":
            h = h.copy()
            for edit in edits:
                if edit == "D":
                    continue
                to, forced = NEXT[state]
                line = f"{role}:{text}" if edit == "K" else f"{forced}:{text if edit == 'R' else ''}"
                h.update((line if state == 0 else "\n" + line).encode("utf-8", "surrogatepass"))
                state = 1 if edit == "K" and state == 0 and role[:1] == "s" else to
        return h

    def spilled(self) -> tuple:
        """The backpointers so far, as a row."""
        out = (self.key, *[None] * 8, self.part, bytes(self.pointers), None)
        self.pointers, self.part = bytearray(), self.part + 1
        return out

    def closed(self) -> Iterator[tuple]:
        ends = [(self.costs[s] + INSERT * len(tail), self.ranks[s], tail, s) for s, tail in enumerate(ENDING) if self.costs[s] < FAR]
        cost, _, tail, state = min(ends)
        h = self._hashed(state, tail, "", "") if tail else self.hashes[state]
        audit = None
        if self.part == 0:
            audit = _walk(bytes(self.pointers), state)[0] + tail
        else:
            yield (self.key, *[None] * 6, tail, None, self.part, bytes(self.pointers), state)
        yield (self.key, self.gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.base + cost, audit, h.hexdigest(), None, None, None)


def _staged(frames: Iterator[pd.DataFrame], spill_rows: int) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in STAGED.split(", ")]
    one: _Conversation | None = None
    for frame in frames:
        out = []
        for key, turn, role, text, seen, gone in frame.itertuples(index=False, name=None):
            if one is None or key != one.key:
                if one is not None:
                    out += one.closed()
                one = _Conversation(key)
            if not gone:
                one.row(turn, role, text, seen)
                if len(one.pointers) >= 4 * spill_rows:
                    out.append(one.spilled())
        yield pd.DataFrame(out, columns=names, dtype=object)
    if one is not None:
        yield pd.DataFrame(list(one.closed()), columns=names, dtype=object)


def _walked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Parts of a conversation come last first; the state is carried from each to the one before it."""
    state = 0
    for frame in frames:
        pieces = []
        for tail, pointers, last in zip(frame["audit"], frame["pointers"], frame["last"]):
            ends = not pd.isna(last)
            piece, state = _walk(bytes(pointers), int(last) if ends else state)
            pieces.append(piece + (tail if ends else ""))
        yield pd.DataFrame({"key": frame["key"], "part": frame["part"].astype("int64"), "piece": pieces})


def _sorted_rows(rows: DataFrame, conv: str, turn: str, role: str, text: str, gone: str | None) -> DataFrame:
    """(key, turn, role, text, seen, gone): one shuffle by conversation; whether a row repeats an earlier one comes from it too."""
    key = F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("-"))
    narrow = rows.select(
        key.alias("key"), F.col(turn).cast("long").alias("turn"), F.coalesce(role, F.lit(" ")).alias("role"),
        F.coalesce(text, F.lit(" ")).alias("text"), (F.coalesce(gone, F.lit(False)) if gone else F.lit(False)).alias("gone"))
    same = F.md5(F.concat(F.col("gone").cast("string"), F.lit("\n"), F.length("role").cast("string"), F.lit("\n"), "role", "text"))
    earlier = F.row_number().over(W.partitionBy("key", "same").orderBy("turn"))
    return (
        narrow.repartition("key").withColumn("same", same).withColumn("seen", earlier > 1)
        .sortWithinPartitions("key", F.asc_nulls_first("turn"), "role", "text")
        .select("key", F.col("turn").cast("string").alias("turn"), "role", "text", "seen", "gone")
    )


def _pieces(staged: DataFrame) -> DataFrame:
    """(key, part, piece) of the audits whose backpointers were written out."""
    parts = staged.where(F.col("part").isNotNull()).select("key", "audit", "part", "pointers", "last")
    return parts.repartition("key").sortWithinPartitions("key", F.desc("part")).mapInPandas(_walked, "key string, part long, piece string")


def _original(key: str, kind: str):
    return F.when(F.col(key).startswith("="), F.substring(key, 2, 1 << 30)).cast(kind)


def repairs(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            gone: str | None = None, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``, one row for each conversation.

    Rows go by turn (nulls first), then role and text. A null role or text counts as one space, a null ``conv`` is a
    conversation of its own. Rows of which ``gone`` is true only name their conversation. Each row's first fault counts:
    blank, repeated, cut short. A row with an empty role has no initial and cannot be kept as it is. ``audit`` is the cheapest edit string (Keep, Rerole, Delete, Insert) that gives roles with
    initials ``(s?(ua)+)?``, the ASCII-least of equals. An empty table gives no rows; columns not named do not matter.

    A conversation is read by one task, row by row; what the task keeps of it has a fixed size.
    """
    kind = rows.schema[conv].dataType.simpleString()
    staged = cut(_sorted_rows(rows, conv, turn, role, text, gone).mapInPandas(lambda frames: _staged(frames, spill_rows), STAGED))
    facts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    done = staged.where(F.col("part").isNull())
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "piece"))), lambda x: x["piece"]), "")
    long_ones = _pieces(staged).groupBy("key").agg(joined.alias("whole"))  # one cell of the result each
    giants = done.where(F.col("audit").isNull()).join(long_ones, "key")
    return done.where(F.col("audit").isNotNull()).unionByName(giants.withColumn("audit", F.col("whole")).drop("whole")).select(
        _original("key", kind).alias("conv_id"), *facts, "audit", "repaired_sha256")


def _applied(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edits come before the rows of their conversation. Inserts stand before the row that their letter follows, or at the end."""
    names = ["key", "position", "edit", "turn", "role", "text"]
    key, edits, at, position, state = None, "", 0, 0, 0
    out: list = []

    def inserted() -> None:
        nonlocal at, position, state
        while at < len(edits) and edits[at] == "I":
            state, role = NEXT[state]
            out.append((key, position, "I", None, role, ""))
            at, position = at + 1, position + 1

    for frame in frames:
        out = []
        for k, piece, turn, role, text, gone in frame[["key", "piece", "turn", "role", "text", "gone"]].itertuples(index=False, name=None):
            if k != key:
                inserted()
                key, edits, at, position, state = k, "", 0, 0, 0
            if piece is not None:
                edits += piece
                continue
            if gone:
                continue
            inserted()
            edit, at = edits[at], at + 1
            if edit != "D":
                to, forced = NEXT[state]
                state = 1 if edit == "K" and state == 0 and role[:1] == "s" else to
                out.append((key, position, edit, turn, role if edit == "K" else forced, text))
                position += 1
        yield pd.DataFrame(out, columns=names, dtype=object)
    out = []
    inserted()
    yield pd.DataFrame(out, columns=names, dtype=object)


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             gone: str | None = None, spill_rows: int = SPILL_ROWS) -> DataFrame:
    """``conv_id, position, edit, turn, role, text``: the rows of the repaired conversations, inserted ones with a null turn.

    The edits of a conversation reach its task ahead of the rows, one byte for each row.
    """
    kind, turn_kind = rows.schema[conv].dataType.simpleString(), rows.schema[turn].dataType.simpleString()
    ordered = _sorted_rows(rows, conv, turn, role, text, gone)
    staged = cut(ordered.mapInPandas(lambda frames: _staged(frames, spill_rows), STAGED))
    whole = staged.where(F.col("audit").isNotNull() & F.col("part").isNull()).select("key", F.lit(0).cast("long").alias("part"), F.col("audit").alias("piece"))
    none = F.lit(None)
    edits = whole.unionByName(_pieces(staged)).select(
        "key", F.lit(0).alias("kind"), "part", "piece", none.cast("long").alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("text"), F.lit(False).alias("gone"))
    lines = ordered.select(
        "key", F.lit(1).alias("kind"), none.cast("long").alias("part"), none.cast("string").alias("piece"), F.col("turn").cast("long").alias("turn"),
        "role", "text", "gone")
    both = edits.unionByName(lines).repartition("key").sortWithinPartitions("key", "kind", "part", F.asc_nulls_first("turn"), "role", "text")
    made = both.select("key", "piece", F.col("turn").cast("string").alias("turn"), "role", "text", "gone").mapInPandas(
        _applied, "key string, position long, edit string, turn string, role string, text string")
    return made.select(_original("key", kind).alias("conv_id"), "position", "edit", F.col("turn").cast(turn_kind).alias("turn"), "role", "text")


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): faults planted by the CRC of ``conv_id:turn``; dropped rows stay as ``gone`` without a text."""
    space = F.lit(" ")
    lot = F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    hurt = rows.select(
        "conv_id", "turn", F.when(lot == 4, "user").otherwise(role).alias("role"),
        F.when(lot.isin(0, 1), "").when(lot == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (lot == 0).alias("gone"),
        F.explode(F.when(lot == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return hurt.drop("copy")


@query("op11_repair")
def op11_repair(spark, folder):
    return repairs(damaged(table(spark, folder, "conversations")), gone="gone")
