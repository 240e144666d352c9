"""Conversation structure repair: cheapest edits by block tables (the method of the Four Russians).

A conversation is good if its roles, by their first letters, are nothing or an optional system row and then user and
assistant in turns. Edits keep a row (0), change its role (2), delete it (3) or insert an empty row (2); a row that is
kept or changed though its text is cut off adds 1. Blank and repeated rows have to go.

What the rest of a conversation costs depends on which of four states the roles so far are in: four numbers, which
differ by little, so up to a common summand there are few such vectors. For every vector and every block of four rows
(each one of nine symbols) a table says which vector stands before the block and what is added. A conversation is read
from its end by blocks; then the blocks are opened again from the start, each one backward from the vector behind it,
and of the edits that reach the cheapest cost the first in the alphabet is taken, so ties are settled for the whole text
of edits. What a block yields is remembered.

Rows are put in order by slices, and only one character a row is gathered for a conversation, as long as its audit.
Texts are sorted by conversation and stream past their edits; no conversation's texts are held at once.

Cases: null ids, turns, roles and texts read as one space in hashes, roles and texts; null turns come first; rows that
share a turn go by role, then by the digest of their text; repeated rows are rows; a conversation whose rows are all
dropped has zeros, an empty audit and the digest of nothing; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.operators.ordered import POS, SLICE, slice_rows
from quaymark.session import stage

from .common import Memo, slices

SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
RECAST_COST, DELETE_COST, INSERT_COST, CUT_COST = 2, 3, 2, 1
#: Rows of a block, and rows whose symbols are gathered at a time.
BLOCK, SEGMENT = 4, 4_096
#: States: nothing yet, a system row, a user row last, an assistant row last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: What a user or assistant row that is made or inserted leads to from each state.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Where a row with an initial leads to from each state; other rows can't be kept there.
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
#: Symbols: a row that must go, then each initial (s, u, a, any other) with a whole and with a cut-off text.
SYMBOLS = 9
MEMO_ENTRIES = 500_000


def _kept(symbol: int, state: int) -> int | None:
    """The state behind a kept row, if it can be kept."""
    return STEPS.get("sua "[(symbol - 1) // 2], {}).get(state) if symbol else None


def _cut(symbol: int) -> int:
    return CUT_COST if symbol and symbol % 2 == 0 else 0


def _inserted(costs: list[float]) -> tuple[float, ...]:
    """The least costs if rows may be inserted first."""
    user = min(costs[USER], INSERT_COST + costs[ASSISTANT])
    assistant = min(costs[ASSISTANT], INSERT_COST + costs[USER])
    return min(costs[START], INSERT_COST + user), min(costs[SYSTEM], INSERT_COST + user), user, assistant


def before(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """What the rest costs in each state before a row, from what it costs behind the row."""
    costs = []
    for state in range(4):
        best = DELETE_COST + behind[state]
        if symbol:
            best = min(best, RECAST_COST + _cut(symbol) + behind[NEXT[state]])
            kept = _kept(symbol, state)
            if kept is not None:
                best = min(best, _cut(symbol) + behind[kept])
        costs.append(best)
    return _inserted(costs)


@lru_cache(maxsize=1)
class Tables:
    """The vectors, and for each of them and each row or block the vector before it and what is added."""

    def __init__(self):
        end = _inserted([0, float("inf"), float("inf"), 0])
        self.vectors: list[tuple[int, ...]] = [end]
        number, steps, added = {end: 0}, [], []
        for vector in self.vectors:  # grows while it is read
            for symbol in range(SYMBOLS):
                found = before(symbol, vector)
                least = min(found)
                normal = tuple(int(c - least) for c in found)
                if normal not in number:
                    number[normal] = len(self.vectors)
                    self.vectors.append(normal)
                steps.append(number[normal])
                added.append(int(least))
        self.step = np.array(steps, dtype=np.int32).reshape(-1, SYMBOLS)
        self.plus = np.array(added, dtype=np.int32).reshape(-1, SYMBOLS)
        # a block is a number of base 9 whose lowest digit is its last row
        self.block, self.more = self.step, self.plus
        for _ in range(BLOCK - 1):
            # rows are added in front, as higher digits
            moved = self.step[self.block]
            summed = self.plus[self.block] + self.more[:, :, None]
            self.block = moved.transpose(0, 2, 1).reshape(len(self.vectors), -1)
            self.more = summed.transpose(0, 2, 1).reshape(len(self.vectors), -1)
        self.traces: Memo = Memo(MEMO_ENTRIES)

    def trace(self, state: int, rows: tuple[int, ...], behind: int) -> tuple[str, int]:
        """The first of the cheapest edits of some rows from a state, and the state behind them."""
        key = (state, rows, behind)
        if key not in self.traces:
            self.traces.trim()
            costs = [self.vectors[behind]]
            for symbol in reversed(rows):
                costs.append(before(symbol, costs[-1]))
            costs.reverse()
            edits = []
            for at, symbol in enumerate(rows):
                here, then = costs[at], costs[at + 1]
                while True:
                    cost, made = here[state], NEXT[state]
                    if cost == DELETE_COST + then[state]:
                        edits.append(DELETE)
                        break
                    if cost == INSERT_COST + here[made]:
                        edits.append(INSERT)
                        state = made
                        continue
                    kept = _kept(symbol, state)
                    keeps = kept is not None and cost == _cut(symbol) + then[kept]
                    edits.append(KEEP if keeps else REROLE)
                    state = kept if keeps else made
                    break
            self.traces[key] = "".join(edits), state
        return self.traces[key]


def audit(symbols: list[int]) -> tuple[int, str]:
    """The least cost of a conversation's rows, and the first of the cheapest texts of edits."""
    tables = Tables()
    whole = len(symbols) - len(symbols) % BLOCK
    at, cost = 0, 0
    # the rows behind the last whole block, one by one, then block by block towards the start
    for symbol in reversed(symbols[whole:]):
        cost += int(tables.plus[at, symbol])
        at = int(tables.step[at, symbol])
    behind = [at]
    blocks = np.array(symbols[:whole], dtype=np.int64).reshape(-1, BLOCK) @ (SYMBOLS ** np.arange(BLOCK - 1, -1, -1))
    for block in blocks[::-1].tolist():
        cost += int(tables.more[at, block])
        at = int(tables.block[at, block])
        behind.append(at)
    cost += tables.vectors[at][START]
    parts, state = [], START
    for i, vector in enumerate(reversed(behind[:-1])):
        part, state = tables.trace(state, tuple(symbols[i * BLOCK : (i + 1) * BLOCK]), vector)
        parts.append(part)
    part, state = tables.trace(state, tuple(symbols[whole:]), 0)
    parts.append(part)
    while tables.vectors[0][state]:
        parts.append(INSERT)
        state = NEXT[state]
    return cost, "".join(parts)


# ---------------------------------------------------------------- rows


def narrow(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with nulls of role and text as one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults, chosen by a hash of id and turn; `there` is false for those that are dropped."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows = narrow(conversations).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        (fault != 0).alias("there"), F.explode(copies).alias("_copy"),
    )
    return rows.drop("_copy")


def _same_conversation(a: DataFrame, b: DataFrame) -> Column:
    return a["conv_id"].eqNullSafe(b["conv_id"])


def _classed(rows: DataFrame) -> DataFrame:
    """Each row's place (slice, position), initial and symbol, without its text; `there` rows only have a symbol."""
    bare = F.rtrim("text", F.lit(SPACE))
    digest = F.unhex(F.sha2("text", 256))
    marked = rows.select(
        "conv_id", "turn", "role", digest.alias("digest"), "there", F.substring("role", 1, 1).alias("initial"),
        (bare == "").alias("blank"), F.substring(bare, -1, 1).isin(".", "!", "?").alias("whole"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest", F.monotonically_increasing_id()]
    placed = slice_rows(marked, order)
    place = F.struct(SLICE, POS)
    first = placed.where("there AND NOT blank").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    # only texts that occur again; null ids match
    first = first.where("n > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    joined = placed.join(first, same, "left")
    repeated = F.coalesce(place > F.col("first"), F.lit(False)) & ~F.col("blank")
    kind = F.when(F.col("blank"), "b").when(repeated, "d").when(~F.col("whole"), "t").otherwise("o")
    return joined.select("conv_id", "there", SLICE, POS, "initial", kind.alias("kind"))


def _gathered(classed: DataFrame) -> DataFrame:
    """conv_id, initials, kinds: one character a row, in order; of bounded segments first."""
    row = F.when(F.col("there"), F.struct(F.col(POS).alias("at"), F.rpad("initial", 1, "?").alias("initial"), "kind"))
    segment = F.floor(F.col(POS) / SEGMENT).alias("_segment")
    rows = F.array_sort(F.collect_list(row))
    text = lambda c: F.array_join(F.transform("_rows", lambda r: r[c]), "").alias(c)
    parts = classed.groupBy("conv_id", SLICE, segment).agg(rows.alias("_rows")).select("conv_id", SLICE, "_segment", text("initial"), text("kind"))
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(SLICE, "_segment", "initial", "kind"))).alias("_rows"))
    return whole.select("conv_id", text("initial").alias("initials"), text("kind").alias("kinds"))


def _gaps(rows: DataFrame) -> DataFrame:
    """conv_id, gaps: turns that lack between the first and the last one. Turns are made distinct before they are counted."""
    turns = rows.select("conv_id", F.when(F.col("there"), F.col("turn")).alias("turn")).distinct()
    lacking = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return turns.groupBy("conv_id").agg(F.coalesce(lacking, F.lit(0)).cast("long").alias("gaps"))


_JUDGED = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def judged(rows: DataFrame) -> DataFrame:
    """One row per conversation: counts of faults, the cost of its repair and the edits."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _JUDGED.split(", ")]
        types = [*[pa.int64()] * 7, pa.string()]
        for batch in slices(batches):
            out = []
            for row in batch.to_pylist():
                initials, kinds = row["initials"], row["kinds"]
                symbols = [0 if k in "bd" else 1 + 2 * max("sua".find(i), 3 * (i not in "sua")) + (k == "t") for i, k in zip(initials, kinds)]
                cost, edits = audit(symbols)
                illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
                out.append((row["conv_id"], row["gaps"], kinds.count("b"), kinds.count("d"), kinds.count("t"), illegal, cost, edits))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 8, types)], names)

    gathered, gaps = _gathered(_classed(rows)), _gaps(rows)
    joined = gathered.join(gaps, _same_conversation(gathered, gaps)).select(gathered["conv_id"], "initials", "kinds", "gaps")
    return joined.mapInArrow(work, _JUDGED)


def _streamed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation's edits, and behind them its rows in order, in one partition."""
    texts = rows.where("there").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text",
        F.lit(None).cast(found.schema.simpleString()).alias("found"),
    )
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"), F.struct(*found.columns).alias("found"),
    )
    order = ["conv_id", "kind", F.asc_nulls_first("turn"), "role", "digest"]
    return heads.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order).select("kind", "role", "text", "found")


class _Editor:
    """Follows a conversation's edits while its rows stream past."""

    def __init__(self, edits: str):
        self.edits, self.at, self.state = edits, 0, START

    def _made(self) -> str:
        self.state = NEXT[self.state]
        return NAMES[self.state]

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """The rows inserted before the next row."""
        while self.edits[self.at : self.at + 1] == INSERT:
            self.at += 1
            yield INSERT, self._made(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == KEEP:
            self.state = STEPS[role[0]][self.state]
            yield edit, role, text
        elif edit == REROLE:
            yield edit, self._made(), text


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, place, edit, role, text: the rows of every conversation after its edits, places from 0."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv_id, editor, place = None, None, 0
        names = ["conv_id", "place", "edit", "role", "text"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]

        def placed(new: Iterable[tuple[str, str, str]]) -> Iterator[tuple]:
            nonlocal place
            for row in new:
                yield conv_id, place, *row
                place += 1

        for batch in slices(batches):
            out: list[tuple] = []
            for kind, role, text, head in zip(*(batch[c].to_pylist() for c in ("kind", "role", "text", "found"))):
                if kind == 0:
                    out += placed(editor.inserted() if editor else ())
                    conv_id, editor, place = head["conv_id"], _Editor(head["audit"]), 0
                else:
                    out += placed(editor.row(role, text))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], names)
        if editor:
            out = list(placed(editor.inserted()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, types)], names)

    return _streamed(rows, found).mapInArrow(work, "conv_id long, place long, edit string, role string, text string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The judged conversations with repaired_sha256: the digest of the repaired rows as role:text, joined by newlines.

    A digest reads its rows in order, so one task streams a conversation; it never holds more than a slice of rows.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _JUDGED.split(", ")]
        types = [*[pa.int64()] * 7, pa.string(), pa.string()]
        current, editor, digest, glue = None, None, None, ""
        done: list[tuple] = []

        def add(new: Iterable[tuple[str, str, str]]) -> None:
            nonlocal glue
            for _, role, text in new:
                digest.update(f"{glue}{role}:{text}".encode())
                glue = "\n"

        def finish() -> None:
            if editor:
                add(editor.inserted())
                done.append((*(current[n] for n in names), digest.hexdigest()))

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*done)) if done else [[]] * 9
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*names, "repaired_sha256"])

        for batch in slices(batches):
            for kind, role, text, head in zip(*(batch[c].to_pylist() for c in ("kind", "role", "text", "found"))):
                if kind == 0:
                    finish()
                    current, editor, digest, glue = head, _Editor(head["audit"]), hashlib.sha256(), ""
                else:
                    add(editor.row(role, text))
            yield flushed()
        finish()
        yield flushed()

    return _streamed(rows, found).mapInArrow(work, _JUDGED + ", repaired_sha256 string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Judged conversations and their repaired rows, for rows (conv_id, turn, role, text, there)."""
    found = stage(judged(rows), "judged")
    return found, repaired(rows, found)


def audited(conversations: DataFrame) -> DataFrame:
    """Every conversation after planted faults: counts, cost, audit and the digest of the repaired rows."""
    rows = damaged(conversations)
    return digests(rows, stage(judged(rows), "judged"))
