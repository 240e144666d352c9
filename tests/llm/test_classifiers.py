from __future__ import annotations

import itertools
import math
import re

import numpy as np
import pytest

from quaymark.llm import language_id, quality, queries, secrets
from tests.conftest import SMALL


def naive_phrases(text, sample):
    at = count = 0
    while at < len(text):
        n = 1
        while at + n < len(text) and any(text[at : at + n + 1] in s for s in sample):
            n += 1
        count, at = count + 1, at + n
    return count


def test_the_automaton_parses_like_a_search():
    random = np.random.default_rng(1)
    word = lambda n: "".join(random.choice(list("abc "), n))
    sample = (("x", tuple(word(30) for _ in range(4))), ("y", tuple(word(25) for _ in range(3))))
    parser = language_id.Parser(sample)
    texts = [word(n).replace("  ", " ") + "q" * (n % 3) for n in (1, 2, 40, 900, 2_500)]
    found = [parser.symbols(t) for t in texts]
    for text, symbols, row in zip(texts, found, parser.phrases(found)):
        bare = re.sub(" +", " ", text)
        assert len(bare) == len(symbols)
        parts = [bare[i : i + language_id.SEGMENT] for i in range(0, len(bare), language_id.SEGMENT)]
        assert row.tolist() == [sum(naive_phrases(p, s) for p in parts) for _, s in sample]


def test_language_of_held_out_rows(spark):
    rows = queries.op2_language_id(spark, SMALL).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and held
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_a_shared_opening_does_not_hide_the_language(spark):
    """A line of over a thousand letters in front of every text that may be learned from, and none of the others."""
    from pyspark.sql import functions as F

    licence = "Permission is hereby granted free of charge to any person obtaining a copy of this work. " * 14
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    shared = docs.withColumn("text", F.when(language_id.held_out(), F.col("text")).otherwise(F.concat(F.lit(licence), "text")))
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in language_id.language_id(shared).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_the_sample_is_of_different_texts_and_of_all_of_a_text(spark):
    from pyspark.sql import functions as F

    long = " ".join(f"{chr(97 + i % 26) * 3}{chr(97 + i // 26 % 26)}" for i in range(2_000))
    rows = [(i, "copied text here", "en") for i in range(500)] + [(1_000, long, "en"), (1_001, "1 2 3", "en"), (1_002, " ", "en"), (1_003, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    ((_, parts),) = language_id.training_sample(docs, F.lit(True))
    bare = [p for p in parts if p != "copied text here"]
    assert len(parts) - len(bare) == 1 and len(bare) == language_id.SPANS
    assert sum(map(len, bare)) <= language_id.SAMPLE_LETTERS
    assert bare[0].startswith(long[:20]) and long.rfind(bare[-1][4:20]) > 0.98 * len(long)


def test_language_of_odd_rows(spark, odd, none):
    rows = language_id.language_id(odd).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    blank = {r.doc_id: r.lang_pred for r in rows}
    assert all(blank[i] == "und" for i in (4, 5, 6))
    assert language_id.language_id(none).count() == 0
    unlabelled = odd.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in language_id.language_id(unlabelled).collect()} == {"und"}


def test_quality_keeps_good_and_drops_bad(spark):
    kept = {r.doc_id: r.kept for r in queries.op4_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    good, bad = ([kept[r.doc_id] for r in labels if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.05 * len(bad)


def test_quality_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, None), (9, 0), (9, 1), (None, 1)], "doc_id long, quality int")
    rows = quality.importance(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(not r.kept for r in rows if r.doc_id in (4, 5, 6))
    assert {r.kept for r in rows if r.doc_id == 9} == {False}
    drawn = quality.drawn(odd, labels)
    assert drawn.columns == odd.columns and drawn.where("doc_id = 3").count() == 2
    unlabelled = quality.importance(odd, labels.where("false")).where("NOT kept").select("doc_id").collect()
    assert {r.doc_id for r in unlabelled} == {4, 5, 6}
    assert quality.importance(none, labels).count() == 0 and quality.drawn(none, labels).count() == 0


@pytest.mark.parametrize("k", [1, 2, 50, 99, 100])
def test_kth_largest(spark, k):
    keys = [float(x) for x in np.random.default_rng(k).normal(size=97)] + [3.25, 3.25, -1e9]
    frame = spark.createDataFrame([(x,) for x in [*keys, None]], "sample_key double")
    assert quality.kth_largest(frame, k) == sorted(keys, reverse=True)[k - 1]


def test_spans_are_those_of_plain_searches(spark, odd, none):
    rows = secrets.scan(odd, queries.VOCABULARY).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    for r in rows:
        text = texts[r.doc_id]
        want = {("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16}
        want |= {("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18}
        assert {tuple(s) for s in r.spans if s.kind in ("hex", "access")} == want
    twelve = next(r.spans for r in rows if r.doc_id == 12)
    assert [s.kind for s in twelve] == ["guess", "access", "hex"]  # the value has a sign the assign pattern lacks
    assert secrets.scan(none, queries.VOCABULARY).count() == 0


def test_only_costly_values_are_guesses():
    words = secrets.words_of(queries.VOCABULARY)
    cheap = ("password", "P@ssw0rd2023", "qwertyuiop", "aaaaaaaaaaaa", "1234567890", "summer2019-05-17", "abcabcabcabc", "")
    dear = ("Zk4$w9!pQ7xx", "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda", "h8#Lq2vN!t0Zr")
    assert all(secrets.log10_guesses(v, words) < secrets.MIN_LOG10_GUESSES for v in cheap)
    assert all(secrets.log10_guesses(v, words) >= secrets.MIN_LOG10_GUESSES for v in dear)
    assert secrets.log10_guesses("x9" * 20_000, words) < 10


def test_short_random_passwords_are_guesses():
    words = secrets.words_of(queries.VOCABULARY)
    dear = ("K9$mQ2!v", "xK9$mQ2!v", "k3v9x2q7", "kvxq3927", "R7tPz4Wq", "R7tPz4WqLm", "Zk4$w9!pQ7x")
    cheap = ("Password1", "summer2023", "Welcome1!", "letmein123", "qwerty12", "abc12345", "Monkey99", "config.value")
    spans = lambda text: [text[a:b] for a, k, b in secrets.spans_of(text, words) if k == 3]
    for value in dear:
        assert spans(f"password: {value} and more") == [value]
    for value in cheap:
        assert spans(f"password: {value} and more") == []


@pytest.mark.parametrize("before", [
    "secret_key = ", "signing_key: ", "Authorization: Bearer ", "bearer ", "auth: Basic ", "bearer token: ", "SECRET_ACCESS_KEY=", "client-secret: "
])
def test_contexts_of_guesses(before):
    words = secrets.words_of(queries.VOCABULARY)
    value = "R7tPz4WqLm"
    found = [s for s in secrets.spans_of(f"x {before}{value} y", words) if s[1] == 3]
    assert found == [(2 + len(before), 3, 2 + len(before) + len(value))]
    assert not secrets.spans_of("the bearer of good news, a signing_key: none", words)


def test_the_search_finds_the_cheapest_cut():
    words = {"cat": 0.5, "catnip": 2.0, "nip": 1.0, "dog": 0.7}

    def exhaust(value):
        best = math.inf
        for cuts in itertools.product([0, 1], repeat=len(value) - 1):
            parts, last = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(value[last:i])
                    last = i
            parts.append(value[last:])
            cost, brute = 0.0, False
            for p in parts:
                if p in words:
                    cost, brute = cost + words[p] + 0.0 + secrets.LOG_SEGMENT, False
                elif len(p) == 1:
                    cost += secrets.LOG_BRUTE + (0 if brute else secrets.LOG_SEGMENT)
                    brute = True
                else:
                    cost = math.inf
            best = min(best, cost)
        return best

    for value in ("catnip", "catdog", "xcat", "dogzcat", "nipk"):
        assert secrets.log10_guesses(value, words) == pytest.approx(exhaust(value))
