"""Near-duplicate documents: minima of many universal hashes, banded, verified, joined into components.

A document is its set of distinct word shingles. Equal sets are one from the start. The least value of each hash
function over the set makes the signature; documents that agree on all values of a band meet in a bucket. A pair
from a bucket is a link if the signatures allow it and the full sets confirm it.

No bucket emits all its pairs. In each of a few rounds every document outside its buckets' components is checked
against one pivot, the one most of its buckets name. Documents whose buckets still hold several components
then go the exact way: two sets can only reach the similarity if they share one of their rarest shingles, a
fifth of the set and one more, so those that do, across components, are checked, all of them. Links within a component
change nothing and are never sought. At a similarity of 0.8, a pair misses all 40 bands of 5 with a probability of 1e-7.

Cases: texts that are null or without words have an empty set and link with nothing; with fewer words than a
shingle has, the whole sequence is the one shingle; repeated rows share a set, unlike rows of one id have their own
and each counts for itself; an empty table gives none; rows with a null id stay alone.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaymark.session import stage

from .common import key_and_text, semi_joined, slices
from .components import components

BANDS, ROWS = 40, 5
#: Rounds of one pivot for each document before the exact way.
ROUNDS = 3
#: Shingles hashed by all functions at once.
CHUNK = 4_096

_random = np.random.Generator(np.random.PCG64(20_240_607))
# multiply-add-shift: a random odd factor and a random summand of 64 bits, the high half of the result
_FACTOR = _random.integers(0, 2**63, (BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SUMMAND = _random.integers(0, 2**63, (BANDS * ROWS, 1), dtype=np.uint64)


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit digests."""
    words = [xxhash.xxh3_64_intdigest(w) for w in text.encode().lower().split()]  # bytes lower A-Z only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    flat = np.array(words, dtype=np.uint64)
    size = min(width, len(flat))
    n = len(flat) - size + 1
    mixed = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        mixed = (mixed ^ flat[i : i + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
    return np.unique(mixed)


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of every hash function over a set."""
    keys = found >> np.uint64(32)
    least = np.full(len(_FACTOR), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(keys), CHUNK):
        np.minimum(least, (keys[at : at + CHUNK] * _FACTOR + _SUMMAND).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def bands(values: np.ndarray) -> list[int]:
    raw = values.tobytes()
    size = 4 * ROWS
    return [xxhash.xxh3_64_intdigest(raw[i * size : (i + 1) * size], seed=i) - 2**63 for i in range(BANDS)]


def described(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, digest of the set, band keys, for every row; no digest or keys for empty sets."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, digests, keys = [], [], []
            for text in batch["text"].to_pylist():
                found = shingles(text or "", width)
                sizes.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                keys.append(bands(signature(found)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "digest", "keys"],
            )

    return docs.mapInArrow(work, "doc_id long, n_shingles long, digest binary, keys array<long>")


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """rep, signature (one byte of each value) and set of the given documents (rep, digest, text).

    A text that doesn't have the set of the digest is another one of the same id and left out.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            reps, short, members = [], [], []
            for rep, digest, text in zip(*(batch[c].to_pylist() for c in ("rep", "digest", "text"))):
                found = shingles(text or "", width)
                raw = found.tobytes()
                if xxhash.xxh3_128_digest(raw) == digest:
                    reps.append(rep)
                    short.append(signature(found).astype(np.uint8).tobytes())
                    members.append(raw)
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps, pa.int64()), pa.array(short, pa.binary()), pa.array(members, pa.binary())], ["rep", "signature", "members"]
            )

    return docs.mapInArrow(work, "rep long, signature binary, members binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity; signatures rule out hopeless ones first.

    An agreement of signatures six standard deviations below the threshold means less than 1e-8 of a chance.
    """
    share = percent / 100
    least = BANDS * ROWS * share - 6 * (BANDS * ROWS * share * (1 - share)) ** 0.5

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept = []
            for sa, sb, ma, mb in zip(*(batch[c].to_pylist() for c in ("signature_a", "signature_b", "members_a", "members_b"))):
                agree = np.count_nonzero(np.frombuffer(sa, np.uint8) == np.frombuffer(sb, np.uint8))
                good = agree >= least
                if good:
                    a, b = np.frombuffer(ma, "<u8"), np.frombuffer(mb, "<u8")
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    good = 100 * common >= percent * (len(a) + len(b) - common)
                kept.append(good)
            mask = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch["a"].filter(mask), batch["b"].filter(mask)], ["a", "b"])

    for side in ("b", "a"):  # the pivot comes last: it may be in many pairs
        named = sets.select(F.col("rep").alias(side), F.col("signature").alias(f"signature_{side}"), F.col("members").alias(f"members_{side}"))
        pairs = pairs.join(named, side)
    return pairs.mapInArrow(work, "a long, b long")


def _located(buckets: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets that hold several components."""
    placed = buckets.join(found, buckets["rep"] == found["node"], "left").select(
        "band", "rep", "first_id", "n_shingles", F.coalesce("component", "rep").alias("component")
    )
    mixed = placed.groupBy("band").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low <> _high")
    return placed.join(mixed.select("band"), "band", "left_semi")


def _pivots(members: DataFrame, percent: int, number: int) -> DataFrame:
    """Pairs (a: pivot, b: member outside its component) of every bucket, with how many buckets name them.

    The first pivots are the documents of least id: copies often come after what they were copied from.
    """
    rank = F.col("first_id") if number == 0 else F.xxhash64("rep", "band", F.lit(number))
    first = members.groupBy("band").agg(F.min(F.struct(rank.alias("_rank"), "rep", "component", "n_shingles")).alias("_p"))
    paired = members.join(first, "band").where((F.col("_p.component") != F.col("component")) & _near("n_shingles", "_p.n_shingles", percent))
    return paired.groupBy(F.col("_p.rep").alias("a"), F.col("rep").alias("b")).agg(F.count("*").alias("named"))


def _near(a: str, b: str, percent: int) -> Column:
    """Sets whose sizes alone don't rule a link out."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _untried(pairs: DataFrame, tried: list[DataFrame]) -> DataFrame:
    pairs = pairs.select(F.least("a", "b").alias("_low"), F.greatest("a", "b").alias("_high"), "*")
    for old in tried:
        done = old.select(F.least("a", "b").alias("_low"), F.greatest("a", "b").alias("_high"))
        pairs = pairs.join(done, ["_low", "_high"], "left_anti")
    return pairs.drop("_low", "_high")


def _rare(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """rep, component, n_shingles, shingle, _place: the rarest shingles of each set, as many as it may miss and one more.

    Rarity is the number of these sets that hold a shingle; those that one set alone holds match nothing.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            raws = batch["members"].to_pylist()
            sizes = [len(r) // 8 for r in raws]
            repeated = pa.array(np.repeat(np.arange(len(raws)), sizes))
            taken = [batch[c].take(repeated) for c in ("rep", "component", "n_shingles")]
            yield pa.RecordBatch.from_arrays(
                [*taken, pa.array(np.frombuffer(b"".join(raws), "<i8"))], ["rep", "component", "n_shingles", "shingle"]
            )

    placed = members.select("rep", "component", "n_shingles").distinct().join(sets.select("rep", "members"), "rep")
    each = placed.select("rep", "component", "n_shingles", "members").mapInArrow(
        work, "rep long, component long, n_shingles long, shingle long"
    )
    held = each.groupBy("shingle").agg(F.count("*").alias("_sets"))
    place = F.row_number().over(Window.partitionBy("rep").orderBy("_sets", "shingle"))
    most = F.col("n_shingles") - F.ceil(F.col("n_shingles") * percent / 100) + 1
    return each.join(held, "shingle").withColumn("_place", place).where((F.col("_place") <= most) & (F.col("_sets") > 1)).drop("_sets")


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of different components that share one of their rarest shingles, early enough.

    The first shingle that two sets share, in order of rarity, stands at a place of each; behind it they can share as many
    as the shorter rest holds. A pair is named only where that suffices for the similarity, which leaves out most
    documents that have a passage in common and parts of their own.
    """
    rare = stage(_rare(members, sets, percent), "rare")
    mixed = rare.groupBy("shingle").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).where("_low <> _high")
    rare = rare.join(mixed.select("shingle"), "shingle", "left_semi")
    side = lambda name: rare.select(
        "shingle", F.col("rep").alias(name), F.col("component").alias(f"_c{name}"), F.col("n_shingles").alias(f"_n{name}"),
        (F.col("n_shingles") - F.col("_place") + 1).alias(f"_left{name}"),
    )
    apart = (F.col("a") < F.col("b")) & (F.col("_ca") != F.col("_cb")) & _near("_na", "_nb", percent)
    enough = F.least("_lefta", "_leftb") * (100 + percent) >= percent * (F.col("_na") + F.col("_nb"))
    return side("a").join(side("b"), "shingle").where(apart & enough).select("a", "b").distinct()


def classes(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row."""
    narrow = key_and_text(docs, key, text)
    rows = stage(described(narrow, width), "described")
    whole = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    least = F.min(F.struct("doc_id", "n_shingles", "keys")).alias("_f")
    # one id may have unlike texts, so the written sets get numbers of their own
    reps = stage(
        whole.groupBy("digest").agg(least).select(
            "digest", F.monotonically_increasing_id().alias("rep"), F.col("_f.doc_id").alias("first_id"),
            F.col("_f.n_shingles").alias("n_shingles"), F.col("_f.keys").alias("keys"),
        ),
        "sets",
    )
    every = reps.select(F.explode("keys").alias("band"), "rep", "first_id", "n_shingles")
    shared = every.groupBy("band").agg(F.min("rep").alias("_low"), F.max("rep").alias("_high")).where("_low <> _high")
    buckets = stage(every.join(shared.select("band"), "band", "left_semi"), "buckets")
    met = reps.join(buckets.select("rep").distinct(), "rep", "left_semi").select("rep", "digest", F.col("first_id").alias("doc_id"))
    texts = narrow.join(met, "doc_id").select("rep", "digest", "text")
    sets = stage(full_sets(texts, width).dropDuplicates(["rep"]), "members")
    tried: list[DataFrame] = []
    found = None
    members = stage(buckets.withColumn("component", F.col("rep")), "located")
    for number in range(ROUNDS + 1):
        if number < ROUNDS:
            named = _untried(_pivots(members, percent, number), tried)
            best = named.groupBy("b").agg(F.max(F.struct("named", (-F.col("a")).alias("_a"))).alias("_best"))
            pairs = best.select((-F.col("_best._a")).alias("a"), "b")
        else:
            pairs = _untried(_rest(members, sets, percent), tried)
        pairs = stage(pairs, "pairs")
        tried.append(pairs)
        links = verified(pairs, sets, percent)
        if found is not None:
            links = links.unionByName(found.select(F.col("node").alias("a"), F.col("component").alias("b")))
        found = components(links)
        if number < ROUNDS:
            members = stage(_located(members.drop("component"), found), "located")
            if members.isEmpty():
                break
    placed = reps.join(found, reps["rep"] == found["node"], "left").select("digest", "first_id", F.coalesce("component", "rep").alias("_group"))
    placed = stage(placed, "placed")
    names = placed.groupBy("_group").agg(F.min("first_id").alias("_class"))
    placed = placed.join(names, "_group").select("digest", "_class")
    return rows.join(placed, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("_class", "doc_id").alias("component_id")
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def distinct(docs: DataFrame, width: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each class, with all its columns."""
    return semi_joined(docs, classes(docs, width, percent, key, text).where("kept").select("doc_id"), key)
