"""Exact deduplication against a history held as minimal perfect hashes.

Texts are equal when they are the same after white space is deleted; the SHA-256 of what is left stands for
the text. The distinct digests of the history are dealt into shards, and each shard becomes a minimal perfect
hash: levels of bits, in which a digest that shares its bit with none is placed and the others go one level
down; the rank of its bit is its slot. A slot holds the whole digest, the winner so far (points, document) and
how many rows it stands for. Incoming digests, grouped before they travel, are looked up by slot and compared
byte by byte: members join the slot's class, the others form classes of their own.

Of equal texts the row with the most code points stays, then the smallest id. Cases: a null text counts as
empty, and all blank texts are equal; rows repeated with their id count each and stay or go together in
`classes`, while `distinct` keeps one of them; an empty history or table gives an empty index or result; rows
with a null id lose to those with one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.session import stage

#: Distinct digests that one shard holds on average.
SHARD_DIGESTS = 8_192
#: Bits per digest on each level.
SPARSE = 2
SPACE = " \t\n\x0b\x0c\r"

CLASS = "digest binary, keep_id long, points int, group_size long"
INDEX = "shard long, bits array<binary>, digests binary, keep_ids array<long>, points array<int>, sizes array<long>"


def digest_of(text: str) -> Column:
    """The SHA-256 of a text column without its white space."""
    bare = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    for space in SPACE:
        bare = F.replace(bare, F.lit(space), F.lit(""))
    return F.unhex(F.sha2(bare, 256))


def digests(docs: DataFrame, history: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, points (code points of the whole text), digest, history, for every row."""
    return docs.select(
        F.col(f"`{key}`").cast("long").alias("doc_id"),
        F.length(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("points"),
        digest_of(text).alias("digest"),
        F.coalesce(history, F.lit(False)).alias("history"),
    )


def grouped(rows: DataFrame) -> DataFrame:
    """One row per digest; the maximum is partly taken before the shuffle, so a hot digest is no hot task."""
    best = F.max(F.struct("points", (-F.col("doc_id")).alias("_id")))
    return rows.groupBy("digest").agg(best.alias("_best"), F.count("*").alias("group_size")).select(
        "digest", (-F.col("_best._id")).alias("keep_id"), F.col("_best.points").alias("points"), "group_size"
    )


def _matrix(digest: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digest), dtype="<u8").reshape(-1, 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each digest on a level of `size` bits."""
    mixed = np.full(len(words), (level * 0x9E3779B97F4A7C15 + 1) % 2**64, dtype=np.uint64)
    for column in range(words.shape[1]):
        mixed ^= words[:, column]
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        mixed ^= mixed >> np.uint64(29)
    return (mixed % np.uint64(size)).astype(np.int64)


def build(words: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Levels of bits for distinct digests, and the slot of each."""
    levels, slots = [], np.empty(len(words), dtype=np.int64)
    left, used = np.arange(len(words)), 0
    while len(left):
        at = _place(words[left], len(levels), size := max(SPARSE * len(left), 8))
        once = np.bincount(at, minlength=size) == 1
        alone = once[at]
        slots[left[alone]] = used + (np.cumsum(once) - 1)[at[alone]]
        used += int(alone.sum())
        levels.append(once)
        left = left[~alone]
    return levels, slots


def look_up(levels: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    """The slot each digest would have; -1 where no level has its bit. Others' digests may get a slot too."""
    slots, left, used = np.full(len(words), -1, dtype=np.int64), np.arange(len(words)), 0
    for level, once in enumerate(levels):
        at = _place(words[left], level, len(once))
        hit = once[at]
        slots[left[hit]] = used + (np.cumsum(once) - 1)[at[hit]]
        used += int(once.sum())
        left = left[~hit]
    return slots


def _build_shard(rows: pd.DataFrame) -> pd.DataFrame:
    levels, slots = build(_matrix(rows["digest"].tolist()))
    rows = rows.iloc[np.argsort(slots)]
    return pd.DataFrame(
        {
            "shard": [rows["shard"].iloc[0]],
            "bits": [[np.packbits(b).tobytes() + len(b).to_bytes(8, "little") for b in levels]],
            "digests": [b"".join(rows["digest"].tolist())],
            "keep_ids": [rows["keep_id"].tolist()],
            "points": [rows["points"].tolist()],
            "sizes": [rows["group_size"].tolist()],
        }
    )


def _levels(bits: list[bytes]) -> list[np.ndarray]:
    return [
        np.unpackbits(np.frombuffer(b[:-8], dtype=np.uint8))[: int.from_bytes(b[-8:], "little")].astype(bool) for b in bits
    ]


_NO_ID = np.iinfo(np.int64).min  # stands for a null id in the arrays; it loses every tie


def _merge_shard(new: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """The classes of one shard: the history's, joined by members, and those of nonmembers."""
    columns = ["digest", "keep_id", "points", "group_size"]
    if index.empty:
        return new[columns]
    row = index.iloc[0]
    held = _matrix([row["digests"]])
    ids, points, sizes = (np.array(row[c], dtype=np.int64) for c in ("keep_ids", "points", "sizes"))
    rest = new[columns]
    if len(new):
        words = _matrix(new["digest"].tolist())
        slots = look_up(_levels(row["bits"]), words)
        member = slots >= 0
        member[member] = (held[slots[member]] == words[member]).all(axis=1)  # every byte
        rest, joined, at = new[columns][~member], new[member], slots[member]
        their_ids, their_points = (joined[c].to_numpy(np.int64) for c in ("keep_id", "points"))
        wins = (their_points > points[at]) | (
            (their_points == points[at]) & (their_ids != _NO_ID) & ((ids[at] == _NO_ID) | (their_ids < ids[at]))
        )
        sizes[at] += joined["group_size"].to_numpy(np.int64)
        ids[at[wins]], points[at[wins]] = their_ids[wins], their_points[wins]
    raw = held.tobytes()
    old = pd.DataFrame(
        {"digest": [raw[i : i + 32] for i in range(0, len(raw), 32)], "keep_id": ids, "points": points, "group_size": sizes}
    )
    return pd.concat([old, rest], ignore_index=True)


def _sharded(classes: DataFrame, shards: int) -> DataFrame:
    number = F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long")
    return classes.withColumn("shard", F.pmod(number, F.lit(shards))).withColumn("keep_id", F.coalesce("keep_id", F.lit(_NO_ID)))


def index(history: DataFrame, shards: int) -> DataFrame:
    """The index of grouped history digests, one row per shard; it can be written and used by later runs."""
    return _sharded(history, shards).groupBy("shard").applyInPandas(_build_shard, INDEX)


def merge(incoming: DataFrame, held: DataFrame, shards: int) -> DataFrame:
    """All classes of an index and of grouped incoming digests."""
    left, right = _sharded(incoming, shards).groupBy("shard"), held.groupBy("shard")
    merged = left.cogroup(right).applyInPandas(_merge_shard, CLASS)
    return merged.withColumn("keep_id", F.when(F.col("keep_id") != _NO_ID, F.col("keep_id")))


def classes(docs: DataFrame, history: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row; `history` tells the rows that came earlier."""
    rows = stage(digests(docs, history, key, text), "digests")
    old = stage(grouped(rows.where("history")), "history")
    new = stage(grouped(rows.where("NOT history")), "incoming")
    shards = (old.count() + new.count()) // SHARD_DIGESTS + 1
    held = stage(index(old, shards), "index")
    found = stage(merge(new, held, shards), "classes")
    return rows.join(found.select("digest", "keep_id", "group_size"), "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def earlier_half(docs: DataFrame, key: str = "doc_id") -> Column:
    """A mark for the lower half of the id range: ids grow with time, so these came first."""
    low, high = docs.agg(F.min(key), F.max(key)).first()
    return F.lit(False) if low is None else F.col(key) <= (low + high) // 2


def distinct(docs: DataFrame, history: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, one of each class, with all their columns."""
    kept = classes(docs, history, key, text).where("kept").select(F.col("doc_id").alias("kept_key"), F.unhex("text_sha256").alias("kept_digest"))
    rows = docs.select(F.struct("*").alias("row"), F.col(f"`{key}`").cast("long").alias("row_key"), digest_of(text).alias("row_digest"))
    same = rows["row_key"].eqNullSafe(kept["kept_key"]) & (rows["row_digest"] == kept["kept_digest"])
    return rows.join(kept, same, "left_semi").dropDuplicates(["row_digest"]).select("row.*")
