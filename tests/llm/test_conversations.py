from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict
from functools import lru_cache
from itertools import product

import pytest

from quaymark.llm import conversations, queries
from tests.conftest import SMALL
from tools.check import compare, connect

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"


def brute_audit(symbols):
    """Least cost and first text of edits by trying every edit at every row; symbols are (initial or None, cut off)."""

    @lru_cache(maxsize=None)
    def best(at, state, left):
        options = []
        if at == len(symbols) and state in "0a":
            options.append((0, ""))
        if left:
            new = "a" if state == "u" else "u"
            cost, rest = best(at, new, left - 1)
            options.append((2 + cost, "I" + rest))
        if at < len(symbols):
            initial, cut = symbols[at]
            cost, rest = best(at + 1, state, 2)
            options.append((3 + cost, "D" + rest))
            if initial is not None:
                for made in "ua":
                    if (state == "u") == (made == "a"):
                        cost, rest = best(at + 1, made, 2)
                        options.append((2 + cut + cost, "R" + rest))
                if initial + state in ("s0", "u0", "us", "ua", "au"):
                    cost, rest = best(at + 1, initial, 2)
                    options.append((cut + cost, "K" + rest))
        return min(options, default=(10**9, ""))

    for at in range(len(symbols), -1, -1):  # from the end, so that no call goes deep
        for state in "0sua":
            best(at, state, 0), best(at, state, 1), best(at, state, 2)
    return best(0, "0", 2)


def as_symbol(initial, cut):
    return 0 if initial is None else 1 + 2 * "sua?".index(initial if initial in "sua" else "?") + cut


def test_every_short_conversation_has_the_first_of_the_cheapest_audits():
    kinds = [(None, 0), *product("suax", (0, 1))]
    for n in range(4):
        for rows in product(kinds, repeat=n):
            assert conversations.audit([as_symbol(*r) for r in rows]) == brute_audit(rows), rows


def test_long_conversations_agree_with_the_plain_search():
    draw = random.Random(5)
    kinds = [(None, 0), *product("suax", (0, 1))]
    for n in (4, 5, 7, 8, 9, 40, 101, 200):
        for _ in range(30):
            rows = tuple(draw.choice(kinds) for _ in range(n))
            assert conversations.audit([as_symbol(*r) for r in rows]) == brute_audit(rows), rows


def test_block_tables_hold_what_single_steps_give():
    tables = conversations.Tables()
    draw = random.Random(6)
    for _ in range(500):
        rows = [draw.randrange(conversations.SYMBOLS) for _ in range(conversations.BLOCK)]
        start = draw.randrange(len(tables.vectors))
        costs = tables.vectors[start]
        for symbol in reversed(rows):
            costs = conversations.before(symbol, costs)
        number = 0
        for symbol in rows:
            number = number * conversations.SYMBOLS + symbol
        found = tables.vectors[tables.block[start, number]]
        assert [c + tables.more[start, number] for c in found] == list(costs)


def brute(rows):
    """The contract, conversation by conversation."""
    whole = defaultdict(list)
    for conv_id, turn, role, text in rows:
        own = whole[conv_id]
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        fault = zlib.crc32(name.encode()) % 20
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        role = "user" if fault == 4 else role
        own += [(turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    out = {}
    for conv_id, own in whole.items():
        own.sort(key=lambda r: (r[0] is not None, r[0], r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, symbols, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
        for _, role, text in own:
            bare = text.rstrip(SPACE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            symbols.append((None, 0) if fault in ("blank", "duplicate") else (role[:1] or "?", int(fault == "truncated")))
        cost, audit = brute_audit(tuple(symbols))
        brute_audit_rows, state, left = [], "0", iter(own)
        for edit in audit:
            if edit != "I":
                _, role, text = next(left)
            if edit == "K":
                state = role[0]
                brute_audit_rows.append(f"{role}:{text}")
            elif edit != "D":
                state = "a" if state == "u" else "u"
                brute_audit_rows.append({"u": "user", "a": "assistant"}[state] + ":" + ("" if edit == "I" else text))
        turns = {t for t, _, _ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        initials = [r[:1] for _, r, _ in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        digest = hashlib.sha256("\n".join(brute_audit_rows).encode()).hexdigest()
        out[conv_id] = (gaps, *counts.values(), illegal, cost, audit, digest)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found(frame):
    rows = frame.collect()
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def odd_rows():
    draw = random.Random(11)
    texts = ["Yes.", "No!", "cut off", "", " \t\n", None, "What?\n", "Ende. ", "x" * 60_000 + ".", "日本。", "a "]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ursula"]
    rows = [(c, t, roles[(c + t) % 2], f"Text {c} {t}.") for c in range(40) for t in range(8)]
    rows += [(100 + c, draw.choice([None, 0, 1, 2, 5, 9]), draw.choice(roles), draw.choice(texts)) for c in range(60) for _ in range(9)]
    rows += [(None, t, "user", "no id.") for t in (None, 3, 4)]
    rows += [(7, 1, "user", "Same.")] * 25 + [(500, t, "user", "Again and again.") for t in range(700)]
    rows += [(501, t, draw.choice(roles), f"Row {t}{draw.choice('.!? x')}") for t in range(1_500)]
    # a conversation that loses its only row
    gone = next(c for c in range(1_000, 9_999) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    return rows + [(gone, 1, "user", "Gone.")]


def test_odd_conversations_match_the_plain_search(spark, odd_rows):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame(odd_rows, SCHEMA).withColumns({c: F.lit("other") for c in ("kind", "found", "audit", "there", "digest", "_slice")})
    want = brute(odd_rows)
    assert found(conversations.audited(frame.repartition(5))) == want
    assert ("", hashlib.sha256(b"").hexdigest()) in {w[-2:] for w in want.values()}


def test_small_segments_give_the_same(spark, odd_rows, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT", 3)
    assert found(conversations.audited(spark.createDataFrame(odd_rows, SCHEMA))) == brute(odd_rows)


def test_given_conversations_match_the_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(queries.op11_conversation_repair(spark, SMALL)) == brute(rows)


def test_repaired_rows_are_those_of_the_digest(spark, odd_rows):
    rows = conversations.damaged(spark.createDataFrame(odd_rows, SCHEMA))
    judged, rows_after = conversations.repair(rows)
    texts = defaultdict(list)
    for r in rows_after.orderBy("conv_id", "place").collect():
        assert r.place == len(texts[r.conv_id])
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    want = brute(odd_rows)
    assert {r.conv_id: hashlib.sha256("\n".join(texts[r.conv_id]).encode()).hexdigest() for r in judged.collect()} == {k: v[-1] for k, v in want.items()}


def test_no_conversations_give_no_rows(spark):
    assert conversations.audited(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equal_to_its_sql(spark):
    assert compare(spark, connect(SMALL), "op11_conversation_repair", SMALL) == ""
