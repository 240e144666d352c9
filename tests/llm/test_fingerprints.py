from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymark.llm import fingerprints, queries
from tests.conftest import SMALL


def plain_simhash(text):
    """One term and one bit at a time."""
    votes = [0] * 64
    for term, count in Counter(fingerprints.terms(text).tolist()).items():
        for bit in range(64):
            votes[bit] += (1 + int(math.log2(count))) * (1 if term >> bit & 1 else -1)
    return sum(1 << bit for bit in range(64) if votes[bit] > 0)


def brute_edits(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for (doc_id, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        k = len(text) // 3
        changed = text[: len(text) - k] + following[:k]
        one, two, three = (plain_simhash(t) for t in (text, changed, following))
        like = lambda a, b: 1 - bin(a ^ b).count("1") / 64
        out.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), f"{one:016x}", f"{two:016x}", like(one, two), like(one, three)))
    return sorted(out, key=str)


NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def test_given_documents_match_the_plain_way(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op13_document_fingerprints(spark, SMALL).collect()
    assert sorted((tuple(r[n] for n in NAMES) for r in got), key=str) == brute_edits(rows)
    # what the fingerprint is for: an edited text is nearer than another one
    near, other = (np.array([r[n] for r in got if r.n_chars > 200]) for n in ("near_edited", "near_next"))
    assert (near > other).mean() > 0.95 and near.mean() > 0.7 and abs(other.mean() - 0.5) < 0.05


def test_within_counts_every_row_in_the_radius(spark):
    got = queries.op13_document_fingerprints(spark, SMALL).collect()
    marks = np.array([int(r.fingerprint, 16) for r in got], dtype=np.uint64)
    want = (np.bitwise_count(marks[:, None] ^ marks[None, :]) <= 3).sum(axis=1) - 1
    assert [r.n_near for r in got] == want.tolist()


def test_odd_texts(spark, odd, none):
    rows = {(r.doc_id, r.text) for r in odd.collect()}
    once = odd.select("doc_id", "text").distinct()
    frame = fingerprints.edited(once.withColumn("slice", F.lit("other")).repartition(4))
    got = {(r.doc_id, r.n_chars, r.edited_sha256) for r in frame.collect()}
    assert got == {r[:3] for r in brute_edits(rows)}
    assert fingerprints.edited(odd).count() == odd.count()
    assert fingerprints.with_near(fingerprints.edited(none)).count() == 0
    single = fingerprints.edited(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")).collect()
    assert [(r.fingerprint == r.next_fingerprint, r.n_chars) for r in single] == [(True, 11)]
    marks = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(odd).collect()}
    assert marks[4] == marks[5] == marks[6] == 0


def test_equal_texts_have_equal_fingerprints_however_they_are_cut(monkeypatch):
    draw = random.Random(1)
    text = " ".join(draw.choice(["Aa", "bÉ", "c", "longer" * 9, "日本"]) for _ in range(5_000))
    whole = fingerprints.simhash(text)
    monkeypatch.setattr(fingerprints, "CHUNK", 100)
    assert fingerprints.simhash(text) == whole == fingerprints.simhash(text.replace(" ", "\n ")) == plain_simhash(text)


@pytest.mark.parametrize("radius,tile,share", [(3, 2_048, 64), (3, 4, 1), (1, 16, 1), (6, 8, 2), (0, 8, 1)])
def test_near_marks_match_all_pairs(spark, radius, tile, share):
    """Dense groups around a few marks, repeated marks, and marks that share blocks, in one tile and in many."""
    draw = random.Random(radius)
    marks = [draw.getrandbits(64) for _ in range(150)]
    for centre in marks[:3]:
        marks += [centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))) for _ in range(200)]
    marks += [0, 0, 1, (1 << 64) - 1, (1 << 64) - 2]
    frame = spark.createDataFrame([(fingerprints._signed(m),) for m in marks], "fingerprint long")
    got = {r.fingerprint: r.n_near for r in fingerprints.near(frame, radius, tile, share).collect()}
    all_marks = np.array(marks, dtype=np.uint64)
    want = {}
    for m in set(marks):
        apart = np.bitwise_count(all_marks ^ np.uint64(m))
        n = int(((apart <= radius) & (apart > 0)).sum())
        if n:
            want[fingerprints._signed(m)] = n
    assert got == want


def test_no_mark_is_met_twice_across_tables():
    blocks, tables = fingerprints._masks(3)
    assert len(tables) == 20 and sum(blocks) == 2**64 - 1
