"""Repeated passages: found by phrases, confirmed by windows, located by Aho-Corasick automata.

A word goes when it lies in a window of `WINDOW` words that also starts in a document with a smaller id.

1. Each window names its least hashed phrase. Equal windows name equal phrases, so only windows whose phrase
   is named by two documents can repeat; they are a small part of all windows.
2. Those windows are counted by a digest of their words. The confirmed ones give passages: runs of windows in the
   document of least id that holds them.
3. Documents are dealt into shards of bounded size, and a shard gets the passages its documents need. It compiles
   them into one automaton, as tiles of half a window; every window holds a whole tile of its passage. All the
   shard's documents stream through it, and each hit is extended, word by word, to the longest common run. Runs of a
   window or more are covered. So what goes is decided on words, not on hashes.

Documents equal in all words need no windows: those of larger id go whole. Cases: null texts and texts without
words have nothing to remove; texts shorter than a window never repeat; windows that repeat within one
document only stay; repeated rows have one id, so none has the smaller one and both stay; an empty table gives none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaymark.session import stage, unstage

from .common import key_and_text, slices

WINDOW, PHRASE = 50, 8
TILE = WINDOW // 2
#: Bytes of candidate texts in a shard, on average.
SHARD_BYTES = 2_000_000


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), dtype=np.uint64, count=len(words))


def _joined(left: np.ndarray, right: np.ndarray, seed: int) -> np.ndarray:
    mixed = (left ^ np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15) + right
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return mixed


def runs_of(hashes: np.ndarray, length: int, seed: int) -> np.ndarray:
    """A digest of every run of `length` hashes, from runs of powers of two."""
    power, size, done, out = hashes, 1, 0, None
    n = len(hashes) - length + 1
    while True:
        if length & size:
            part = power[done : done + n]
            out = part if out is None else _joined(out, part, seed + 1)
            done += size
        if done == length:
            return out
        power = _joined(power[:-size], power[size:], seed)
        size *= 2


def named_phrases(hashes: np.ndarray) -> np.ndarray:
    """The least phrase digest of every window."""
    least, size, width = runs_of(hashes, PHRASE, 11), 1, WINDOW - PHRASE + 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    return least if size == width else np.minimum(least[: len(least) - (width - size)], least[width - size :])


def described(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, sha (of the words joined by a space), and the phrases the windows name."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            counts, shas, phrases = [], [], []
            for text in batch["text"].to_pylist():
                words = (text or "").encode().split()
                counts.append(len(words))
                shas.append(hashlib.sha256(b" ".join(words)).digest())
                phrases.append(np.unique(named_phrases(word_hashes(words))).view(np.int64) if len(words) >= WINDOW else [])
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, k) for c, k in zip((counts, shas, phrases), kinds))],
                ["doc_id", "n_words", "sha", "phrases"],
            )

    return docs.mapInArrow(work, "doc_id long, n_words long, sha binary, phrases array<long>")


def chosen(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, sha, size, text, phrases: the texts of a window or more whose id is in `wanted` (doc_id, phrases), each
    text of an id once. The digest comes before the join, so that the join's own shuffle brings equal texts together."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = []
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                words = text.encode().split()
                if len(words) >= WINDOW:
                    joined = b" ".join(words)
                    found.append((doc_id, hashlib.sha256(joined).digest(), len(joined), text))
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.string())
            columns = zip(*found) if found else ((),) * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["doc_id", "sha", "size", "text"])

    digested = docs.where("text IS NOT NULL").mapInArrow(work, "doc_id long, sha binary, size long, text string")
    return digested.join(wanted, "doc_id").dropDuplicates(["doc_id", "sha"])


def windows(candidates: DataFrame) -> DataFrame:
    """doc_id, start and 128-bit digest of every window whose phrase recurs."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            for doc_id, text, phrases in zip(*(batch[c].to_pylist() for c in ("doc_id", "text", "phrases"))):
                hashes = word_hashes(text.encode().split())
                starts = np.flatnonzero(np.isin(named_phrases(hashes), np.array(phrases, np.int64).view(np.uint64)))
                high, low = runs_of(hashes, WINDOW, 23)[starts], runs_of(hashes, WINDOW, 47)[starts]
                # a window that occurs again in its own document is named once, at its first place
                _, first = np.unique(np.stack([high, low], axis=1), axis=0, return_index=True)
                first.sort()  # neighbours differ in few bytes beside their digests, which shuffles compress
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(first), doc_id, np.int64)), pa.array(starts[first].astype(np.int32)),
                        pa.array(high[first].view(np.int64)), pa.array(low[first].view(np.int64)),
                    ],
                    ["doc_id", "start", "high", "low"],
                )

    return candidates.select("doc_id", "text", "phrases").mapInArrow(work, "doc_id long, start int, high long, low long")


def shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard")


def passages(found: DataFrame, shards: int) -> DataFrame:
    """shard, source, low, high: runs of window starts in the least document that holds them, for each shard with a
    later document that holds them too. Windows move once, to their equals; there a window has one row per shard."""
    met = found.repartition("high", "low").select("*", shard_of(shards))
    own = met.groupBy("high", "low", "shard").agg(F.min(F.struct("doc_id", "start")).alias("_first"), F.max("doc_id").alias("_last"))
    first = F.min("_first").over(Window.partitionBy("high", "low"))
    needed = own.withColumn("_source", first).where(F.col("_source.doc_id") < F.col("_last")).select(
        "shard", F.col("_source.doc_id").alias("source"), F.col("_source.start").alias("start")
    )
    row = F.row_number().over(Window.partitionBy("source", "shard").orderBy("start"))
    return needed.withColumn("_run", F.col("start") - row).groupBy("source", "shard", "_run").agg(
        F.min("start").alias("low"), F.max("start").alias("high")
    ).drop("_run")


def cut(needed: DataFrame, texts: DataFrame) -> DataFrame:
    """shard, source, passage (its words, joined): the passages' words from their source."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            cuts = [
                b" ".join(text.encode().split()[low : high + WINDOW])
                for text, low, high in zip(*(batch[c].to_pylist() for c in ("text", "low", "high")))
            ]
            yield pa.RecordBatch.from_arrays([batch["shard"], batch["source"], pa.array(cuts, pa.binary())], ["shard", "source", "passage"])

    joined = needed.join(texts.select(F.col("doc_id").alias("source"), "text"), "source")
    return joined.select("shard", "source", "low", "high", "text").mapInArrow(work, "shard long, source long, passage binary")


def compiled(sequences: list[np.ndarray]):
    """The automaton of all tiles of some passages, and where each tile stands: (passage, offset)."""
    places: dict[tuple[int, ...], list[tuple[int, int]]] = {}
    for number, ids in enumerate(sequences):
        whole = ids.tolist()
        for at in range(0, len(whole) - TILE + 1, TILE):
            places.setdefault(tuple(whole[at : at + TILE]), []).append((number, at))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    stands = list(places.values())
    for number, tile in enumerate(places):
        automaton.add_word(tile, number)
    automaton.make_automaton()
    return automaton, stands


def _agree(left: np.ndarray, right: np.ndarray) -> int:
    """How many items two sequences share from their start."""
    n, done, step = min(len(left), len(right)), 0, 64
    while done < n:
        stop = min(n, done + step)
        apart = np.flatnonzero(left[done:stop] != right[done:stop])
        if len(apart):
            return done + int(apart[0])
        done, step = stop, 2 * step
    return n


def covered(ids: np.ndarray, doc_id: int, automaton, stands, sequences: list[np.ndarray], sources: list[int]) -> np.ndarray:
    """Which words of a document lie in a run of a window or more that a passage of a smaller document shares."""
    mask = np.zeros(len(ids), dtype=bool)
    reached: dict[tuple[int, int], int] = {}  # passage and diagonal -> end of the last run there
    for last, number in automaton.iter(tuple(ids.tolist())):
        at = last - TILE + 1
        for passage, offset in stands[number]:
            if sources[passage] >= doc_id or reached.get((passage, at - offset), -1) > at:
                continue
            other = sequences[passage]
            ahead = _agree(ids[at:], other[offset:])
            back = _agree(ids[:at][::-1], other[:offset][::-1])
            reached[passage, at - offset] = at + ahead
            if ahead + back >= WINDOW:
                mask[at - back : at + ahead] = True
    return mask


def _locate(docs: pd.DataFrame, needed: pd.DataFrame) -> pd.DataFrame:
    """One shard: its documents against the automaton of its passages."""
    numbers: dict[bytes, int] = {}
    as_ids = lambda words: np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    rows = []
    if len(needed) and len(docs):
        sequences = [as_ids(p.split(b" ")) for p in needed["passage"]]
        automaton, stands = compiled(sequences)
        sources = needed["source"].tolist()
        for doc_id, sha, text in zip(docs["doc_id"], docs["sha"], docs["text"]):
            words = text.encode().split()
            mask = covered(as_ids(words), doc_id, automaton, stands, sequences, sources)
            if n := int(mask.sum()):
                kept = b" ".join(w for w, gone in zip(words, mask.tolist()) if not gone)
                rows.append((doc_id, sha, n, kept.decode()))
    return pd.DataFrame(rows, columns=["doc_id", "sha", "n_removed", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept for every row; `kept` is the text that is left (null: all words stay)
    and `sha` the SHA-256 of all its words."""
    narrow = key_and_text(docs, key, text)
    rows = stage(described(narrow), "described")
    first = rows.groupBy("sha").agg(F.min("doc_id").alias("_first"))
    heads = rows.join(first, "sha").where(F.col("doc_id") == F.col("_first")).where(F.col("n_words") >= WINDOW)
    named = stage(heads.select("doc_id", F.explode("phrases").alias("phrase")), "phrases")
    recurring = named.groupBy("phrase").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b")).where("_a < _b")
    # unlike texts of one id share their phrases: each may name windows in vain, but loses none
    wanted = named.join(recurring.select("phrase"), "phrase", "left_semi").groupBy("doc_id").agg(F.collect_list("phrase").alias("phrases"))
    candidates = stage(chosen(narrow, wanted), "candidates")
    unstage(named)
    shards = int((candidates.agg(F.sum("size")).first()[0] or 0) // SHARD_BYTES + 1)
    candidates = candidates.withColumn("shard", shard_of(shards))
    needed = stage(passages(windows(candidates), shards), "passages")
    pieces = cut(needed, candidates)
    left = candidates.select("shard", "doc_id", "sha", "text").groupBy("shard")
    removed = left.cogroup(pieces.groupBy("shard")).applyInPandas(_locate, "doc_id long, sha binary, n_removed long, kept string")
    whole = (F.col("_first") < F.col("doc_id")) & (F.col("n_words") >= WINDOW)
    return (
        rows.drop("phrases").join(first, "sha").join(removed, ["doc_id", "sha"], "left")
        .select(
            "doc_id", "n_words", "sha",
            F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(whole, F.lit("")).otherwise(F.col("kept")).alias("kept"),
        )
    )
