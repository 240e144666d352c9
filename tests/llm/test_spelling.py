from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

from quaymark.llm import queries, spelling
from tests.conftest import SMALL
from tools.check import compare, connect


def brute_words(rows):
    """The contract's words with their counts."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def brute_variants(n):
    """Near words by comparing each word with all words that lose the same letter."""
    met = defaultdict(set)
    for word in n:
        met[word].add(word)
        for i in range(len(word)):
            met[word[:i] + word[i + 1 :]].add(word)

    def one_edit(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        long, short = (a, b) if len(a) > len(b) else (b, a)
        return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))

    near = defaultdict(set)
    for members in met.values():
        for a in members:
            near[a].update(b for b in members if one_edit(a, b))
    form = {}
    for word, count in n.items():
        best = min(near[word], key=lambda w: (-n[w], w), default=None)
        form[word] = best if best is not None and n[best] >= 2 * count else None
    out = {}
    for word in n:
        root = word
        while form[root] is not None:
            root = form[root]
        out[word] = (form[word], root, n[word], len(near[word]), n[form[word]] if form[word] else None)
    return out


def found(frame):
    rows = frame.select("word", "form", "root", "n", "n_near", "form_n").collect()
    got = {r.word: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def counted(spark, n):
    return spark.createDataFrame(list(n.items()), "word string, n long")


def test_given_documents_match_the_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.op12_spelling_variants(spark, SMALL)) == brute_variants(brute_words(rows))


def test_random_words_of_few_letters_match_the_plain_search(spark):
    """Runs of equal letters, words that start others, ties of counts, chains of forms, many words to a slice."""
    draw = random.Random(3)
    n = {"".join(draw.choice("abé") for _ in range(draw.randint(1, 8))): 3 * 2 ** draw.randint(0, 12) for _ in range(2_500)}
    n |= {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "z" * 3_000: 5, "z" * 2_999: 50, "z" * 1_500 + "y" + "z" * 1_499: 5}
    assert found(spelling.variants(counted(spark, n).repartition(7))) == brute_variants(n)


def test_a_slice_may_hold_a_single_word(spark):
    n = {w: 3 for w in ("abcde", "abcdef", "abcdefg", "abcdx", "bcdef", "b", "bb", "bbb")}
    assert found(spelling.variants(counted(spark, n))) == brute_variants(n)


def test_nodes_are_those_of_a_trie(spark):
    n = {w: 1 for w in ("to", "tea", "ten", "i", "in", "inn", "net", "aet")}
    forward, backward = defaultdict(set), defaultdict(set)
    words = {}
    for r in spelling.numbered(counted(spark, n)).collect():
        words[r.word] = r.prefixes[-1]
        for k in range(len(r.word) + 1):
            forward[r.word[:k]].add(r.prefixes[k])
            backward[r.word[len(r.word) - k :]].add(r.suffixes[k])
    for nodes in (forward, backward):
        assert all(len(s) == 1 for s in nodes.values())
        assert len({min(s) for s in nodes.values()}) == len(nodes)
    assert sorted(words, key=words.get) == sorted(words)


def test_odd_texts(spark, odd, none):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    words = spelling.vocabulary(spelling.with_slips(spelling.runs(odd)))
    assert {r.word: r.n for r in words.collect()} == brute_words(rows)
    assert found(spelling.variants(words)) == brute_variants(brute_words(rows))
    nothing = spelling.vocabulary(spelling.with_slips(spelling.runs(none)))
    assert spelling.variants(nothing).count() == 0


def test_equal_to_its_sql(spark):
    assert compare(spark, connect(SMALL), "op12_spelling_variants", SMALL) == ""
