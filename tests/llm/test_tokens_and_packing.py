from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quaymark.llm import packing, queries
from quaymark.llm.token_counts import count_text, merged_length, token_counts
from quaymark.llm.word_bpe import WordFile
from tests.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def file():
    return WordFile(PATH)


def library_ids(file, text):
    return file.library.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"], max_codepoint=0x2FFF), st.sampled_from("aA's <|endoftext|>\x1c\x85́İΣ")), max_size=60))
def test_counts_and_ids_are_the_librarys(text):
    file = WordFile(PATH)
    want = library_ids(file, text)
    assert count_text(file, text) == len(want)
    assert np.frombuffer(file.encode([text])[0], "<u4").tolist() == want


def test_the_plain_engine_finds_the_same_words_in_latin_texts(file):
    for a in map(chr, range(0x250)):
        for text in (f"a{a}b {a}1{a}{a}' {a}{a}x", f"{a}\u00e9{a}2'{a}s it's{a}"):
            assert file.find_latin(text) == file.find_words(text), repr(a)


def test_merging_takes_the_leftmost_of_equal_ranks():
    assert merged_length(list("aaaaa"), {("a", "a"): 0, ("aa", "aa"): 1}) == 2
    assert merged_length(list("abc"), {}) == 3
    assert merged_length(["x"], {}) == 1


def test_counts_of_odd_rows(spark, odd, none, file):
    rows = token_counts(odd, PATH).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    assert len(rows) == odd.count()
    for r in rows:
        text = texts[r.doc_id] or ""
        assert (r.n_bytes, r.n_tokens) == (len(text.encode()), len(library_ids(file, text)))
        assert r.over_limit == (r.n_tokens > 2048)
    assert token_counts(none, PATH).count() == 0


def packed_right(rows, texts, file, limit):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert len(by_doc) == len(texts)
    for key, text in texts.items():
        ids, at = [*library_ids(file, text or ""), 0], 0
        for r in sorted(by_doc[key], key=lambda r: r.piece):
            assert r.start == at and r.length == min(limit, len(ids) - at)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], dtype="<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= limit
    return len(by_sequence)


def test_packing_of_odd_rows(spark, odd, none, file):
    alone = odd.dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in alone.collect()}
    packed_right(packing.pack(alone, PATH, 256).collect(), texts, file, 256)
    assert packing.pack(odd, PATH, 256).where("doc_id = 3").select("sequence_id", "offset").distinct().count() >= 2
    assert packing.pack(none, PATH).count() == 0


def test_query_packs_close_to_the_bound(spark, file):
    rows = queries.op1_best_fit_packing(spark, SMALL).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    used = packed_right(rows, texts, file, 2048)
    assert used <= 1.02 * sum(r.length for r in rows) / 2048 + 1


@settings(max_examples=30, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 300), max_size=40))
def test_a_layout_places_every_rank_once(counts):
    rows = packing.layout(counts, 64)
    ranks, room = defaultdict(list), defaultdict(list)
    for length, first, stop, each, number, offset in rows:
        for rank in range(first, stop):
            ranks[length].append(rank)
            room[number + (rank - first) // each].append((offset + (rank - first) % each * length, length))
    assert {s: sorted(r) for s, r in ranks.items()} == {s: list(range(n)) for s, n in counts.items()}
    for pieces in room.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 64


def test_the_plan_stays_bounded_and_good():
    random = np.random.default_rng(3)
    lengths, n = np.unique(np.clip(random.lognormal(6.6, 1, 200_000), 1, 2048).astype(int), return_counts=True)
    rows = packing.layout(dict(zip(lengths.tolist(), n.tolist())), 2048)
    used = max(number + (stop - first) // each for _, first, stop, each, number, _ in rows)
    assert used <= 1.003 * (lengths * n).sum() / 2048 and len(rows) < 60_000


def test_knapsack_is_the_best_of_all():
    random = np.random.default_rng(5)
    for _ in range(20):
        values = np.where(random.random(13) < 0.5, random.random(13), 0.0)
        values[0] = 0
        best, _ = packing.price(values, 12)

        def exhaust(room):
            return max([0.0] + [values[s] + exhaust(room - s) for s in range(1, room + 1) if values[s]])

        assert best[12] == pytest.approx(exhaust(12))
