"""Language identification by cross-parsing entropy.

Per language, a suffix automaton of a sample of labelled text knows every substring of it. A text is parsed
against each automaton: take the longest match, count one phrase, go on behind it. A phrase is a pointer into
the sample, so it costs the logarithm of the sample's length; the language whose parse costs least wins.

All texts of a slice and all languages are parsed in step: the automata are tables, and one gather moves every
parse by one letter. A text is parsed in segments of `SEGMENT` letters, all of them; no phrase crosses a
segment's end, which costs every language one phrase at most.

The sample is bounded: `SAMPLE_TEXTS` different labelled texts of each language, `SAMPLE_LETTERS` letters of each, in
`SPANS` parts spread over the whole text. Labels serve nothing else. Cases: null texts and texts without letters are `und` with score 0; letters that no sample
has are phrases of their own in every language; ties go to the language that sorts first; repeated rows give a
row each; without labelled rows every text is `und`.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import key_and_text, slices

SAMPLE_TEXTS, SAMPLE_LETTERS = 64, 500
#: Parts that a longer text of the sample is taken in.
SPANS = 10
SEGMENT = 1024
UNKNOWN = "und"


def folded(text: str) -> str:
    """Lower case, every run of other characters one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def automaton(texts: list[str], symbols: dict[str, int]) -> np.ndarray:
    """The suffix automaton of the texts as a table (state, symbol) -> state; 0 is the start and means no move.

    The last column is for letters without a symbol and is always 0.
    """
    moves: list[dict[int, int]] = [{}]
    links, lengths = [-1], [0]
    for text in texts:
        last = 0
        for symbol in (symbols[c] for c in text):
            if symbol in moves[last]:  # this prefix of the text is known from an earlier one
                known = moves[last][symbol]
                if lengths[known] == lengths[last] + 1:
                    last = known
                    continue
                new = len(moves)
                moves.append(dict(moves[known]))
                links.append(links[known])
                lengths.append(lengths[last] + 1)
                links[known] = new
                at = last
                while at != -1 and moves[at].get(symbol) == known:
                    moves[at][symbol] = new
                    at = links[at]
                last = new
                continue
            state = len(moves)
            moves.append({})
            links.append(0)
            lengths.append(lengths[last] + 1)
            at = last
            while at != -1 and symbol not in moves[at]:
                moves[at][symbol] = state
                at = links[at]
            if at != -1:
                known = moves[at][symbol]
                if lengths[known] == lengths[at] + 1:
                    links[state] = known
                else:
                    copy = len(moves)
                    moves.append(dict(moves[known]))
                    links.append(links[known])
                    lengths.append(lengths[at] + 1)
                    links[known] = links[state] = copy
                    while at != -1 and moves[at].get(symbol) == known:
                        moves[at][symbol] = copy
                        at = links[at]
            last = state
    table = np.zeros((len(moves), len(symbols) + 1), dtype=np.int32)
    for state, out in enumerate(moves):
        for symbol, to in out.items():
            table[state, symbol] = to
    return table


@lru_cache(maxsize=1)
class Parser:
    """The automata of all languages in one worker; `sample` holds (language, texts) in order."""

    def __init__(self, sample: tuple[tuple[str, tuple[str, ...]], ...]):
        self.languages = [lang for lang, _ in sample]
        letters = sorted({c for _, texts in sample for t in texts for c in t} | {" "})
        symbols = {c: i for i, c in enumerate(letters)}
        tables = [automaton(list(texts), symbols) for _, texts in sample]
        self.width = len(letters) + 1
        self.moves = np.concatenate([t.ravel() for t in tables]) if tables else np.zeros(0, np.int32)
        self.starts = np.cumsum([0, *(t.size for t in tables)])[:-1].astype(np.int64)
        self.bits = np.array([math.log2(max(2, sum(map(len, texts)))) for _, texts in sample])
        self.space, other = symbols[" "], len(letters)
        self.symbol_of = np.full(0x110000, self.space, dtype=np.int32)
        for code in range(0x110000):
            if chr(code).isalpha():
                self.symbol_of[code] = symbols.get(chr(code), other)

    def symbols(self, text: str) -> np.ndarray:
        """The symbols of a text; runs of other characters are one space."""
        codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype="<u4")
        found = self.symbol_of[codes]
        keep = np.ones(len(found), dtype=bool)
        keep[1:] = (found[1:] != self.space) | (found[:-1] != self.space)
        return found[keep]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (row) in each language (column)."""
        owner, parts = [], []
        for n, found in enumerate(texts):
            for at in range(0, len(found), SEGMENT):
                owner.append(n)
                parts.append(found[at : at + SEGMENT])
        total = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        if not parts or not self.languages:
            return total
        order = sorted(range(len(parts)), key=lambda i: -len(parts[i]))
        lengths = np.array([len(parts[i]) for i in order])
        letters = np.zeros((lengths[0], len(parts)), dtype=np.int64)
        for column, i in enumerate(order):
            letters[: len(parts[i]), column] = parts[i]
        active = len(parts) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")
        starts = self.starts[:, None]
        state = np.zeros((len(self.languages), len(parts)), dtype=np.int64)
        count = np.zeros_like(state)
        for step in range(lengths[0]):
            n = active[step]
            fresh = starts + letters[step, :n]
            old = state[:, :n]
            to = self.moves[fresh + old * self.width].astype(np.int64)
            miss = to == 0
            again = self.moves[fresh].astype(np.int64)
            count[:, :n] += (miss & (old != 0)).view(np.int8)
            count[:, :n] += (miss & (again == 0)).view(np.int8)
            state[:, :n] = np.where(miss, again, to)
        count += state != 0
        np.add.at(total, np.array(owner)[order], count.T)
        return total


def _spans(text: Column) -> Column:
    """Parts of a text at even distances from its first to its last letter; all of it if it is short."""
    fetched = 2 * SAMPLE_LETTERS // SPANS  # folding can shorten a part, so more is fetched
    step = (F.length(text) - fetched) / (SPANS - 1)
    parts = F.array(*[F.substring(text, (F.floor(step * i) + 1).cast("int"), F.lit(fetched)) for i in range(SPANS)])
    return F.when(F.length(text) > 2 * SAMPLE_LETTERS, parts).otherwise(F.array(text))


def training_sample(docs: DataFrame, usable: Column, key: str = "doc_id", text: str = "text", lang: str = "lang"):
    """(language, parts of texts) of the bounded sample, in a fixed order; `usable` tells the rows to learn from.

    Different texts with letters are drawn, copies count once. A text gives parts spread over all of it, so an opening
    that many texts share is only some of what is learned.
    """
    whole = F.col(f"`{text}`").cast("string")
    narrow = docs.where(usable & F.col(f"`{lang}`").isNotNull() & whole.rlike(r"\p{L}")).select(
        F.col(f"`{lang}`").cast("string").alias("lang"), F.md5(whole).alias("digest"), F.col(f"`{key}`").cast("long").alias("doc_id")
    )
    each = narrow.groupBy("lang", "digest").agg(F.min("doc_id").alias("doc_id"))
    first = Window.partitionBy("lang").orderBy("digest")
    chosen = each.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= SAMPLE_TEXTS).drop("_n")
    texts = docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{lang}`").cast("string").alias("lang"), F.md5(whole).alias("digest"),
        whole.alias("whole"),
    )
    # at most SAMPLE_TEXTS ids per language
    same = texts["doc_id"].eqNullSafe(chosen["doc_id"]) & (texts["lang"] == chosen["lang"]) & (texts["digest"] == chosen["digest"])
    rows = texts.join(F.broadcast(chosen), same, "left_semi").select("lang", "digest", _spans(F.col("whole")).alias("parts")).distinct().collect()
    sample: dict[str, list[str]] = {}
    for language, _, parts in sorted(map(tuple, rows)):
        most = SAMPLE_LETTERS // len(parts)
        sample.setdefault(language, []).extend(part for part in (folded(p)[:most] for p in parts) if part)
    return tuple((language, tuple(parts)) for language, parts in sorted(sample.items()))


def identify(docs: DataFrame, sample, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row; the score is the share of 2^-cost, so it is 1 when all others cost more."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(sample)
        for batch in slices(batches):
            texts = [parser.symbols(t or "") for t in batch["text"].to_pylist()]
            blank = [not (t != parser.space).any() for t in texts]
            cost = parser.phrases(texts) * parser.bits
            if parser.languages:
                best = cost.argmin(axis=1)
                share = 1 / np.exp2(np.clip(cost.min(axis=1)[:, None] - cost, -1000, 0)).sum(axis=1)
                found = [(UNKNOWN, 0.0) if b else (parser.languages[i], float(s)) for b, i, s in zip(blank, best, share)]
            else:
                found = [(UNKNOWN, 0.0)] * len(texts)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return key_and_text(docs, key, text).mapInArrow(work, "doc_id long, lang_pred string, score double")


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the labelled rows that are not held out."""
    sample = training_sample(docs, ~held_out(key), key, text, lang)
    return identify(docs, sample, key, text).select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")
