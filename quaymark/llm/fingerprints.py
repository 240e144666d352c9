"""Document fingerprints: SimHash, its likeness, and all fingerprints within a Hamming radius.

The terms of a text are its runs of three words (a text of fewer words is one term); a term's weight grows with the
logarithm of its count. Each bit of a term's 64-bit hash votes for or against that bit of the fingerprint with the
weight. Letters A-Z count as small ones; a word of more than 24 bytes is cut into pieces of that length.

Fingerprints within a radius r agree on all but r of r + 3 blocks of bits, so on some three of them. There is a table for
every three blocks, in which those blocks are put first and fingerprints that agree on them meet; a pair counts in the
first table it meets in. Equal fingerprints are one entry. Keys with many fingerprints, found from a fixed share of all of
them, are cut into tiles of two chunks each, so a task never holds such a key; pairs are counted in a tile, never written.

Cases: null text is empty, the fingerprint of which is zero, as is that of a text without words; the order of rows for
the next document is descending ids, null ids last, rows of one id by a hash of the text; one row's next is itself;
an empty table gives no rows; other columns are not read; texts of any length are read whole, a megabyte at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaymark.session import stage

from .common import key_and_text, slices

BITS, WIDTH, PIECE = 64, 3, 24
RADIUS = 3
#: Bytes of a text hashed at a time.
CHUNK = 1 << 20
#: Fingerprints of a key that are compared at a time, and the share of fingerprints that tells which keys have more.
TILE, SHARE = 2_048, 64
#: One row in so many has to share a fingerprint for it to be sent to all tasks; so there are no more of them than that.
HOT_SHARE = 1_000

_random = np.random.Generator(np.random.PCG64(20_250_311))
_VALUES = _random.integers(0, 2**64 - 1, (PIECE, 256), dtype=np.uint64, endpoint=True)
_VALUES[:, 65:91] = _VALUES[:, 97:123]
_VALUES = _VALUES.reshape(-1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
#: For each value of a byte, +1 or -1 for each of its bits.
_SIGNS = 2.0 * ((np.arange(256)[:, None] >> np.arange(8)) & 1) - 1


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(32))


def _words(raw: bytes) -> np.ndarray:
    """One hash for each word, or piece of a long word, of a chunk that ends at a word's end."""
    data = np.frombuffer(raw, dtype=np.uint8)
    at = np.flatnonzero(~_SPACE[data])
    if not len(at):
        return np.zeros(0, dtype=np.uint64)
    opens = np.empty(len(at), dtype=bool)
    opens[0] = True
    np.not_equal(at[1:], at[:-1] + 1, out=opens[1:])
    starts = np.flatnonzero(opens)
    place = np.arange(len(at)) - np.repeat(starts, np.diff(starts, append=len(at)))
    if place.max() >= PIECE:
        place %= PIECE
        starts = np.flatnonzero(place == 0)
    return _mix(np.add.reduceat(_VALUES[place * 256 + data[at]], starts))


def _chunks(raw: bytes) -> Iterator[bytes]:
    """Parts of about CHUNK bytes, cut behind white space."""
    began = 0
    while len(raw) - began > CHUNK:
        stop = next((i for i in range(began + CHUNK, len(raw)) if _SPACE[raw[i]]), len(raw))
        yield raw[began:stop]
        began = stop
    yield raw[began:]


def terms(text: str) -> np.ndarray:
    """Hashes of the runs of WIDTH words; repeated ones stay."""
    words = np.concatenate([_words(part) for part in _chunks(text.encode())])
    size = min(WIDTH, len(words))
    n = len(words) - size + 1 if size else 0
    mixed = np.full(n, size, dtype=np.uint64)
    for i in range(size):
        mixed = _mix(mixed ^ words[i : i + n])
    return mixed


def simhash(text: str) -> int:
    """The fingerprint of a text, as an unsigned number."""
    found, counts = np.unique(terms(text), return_counts=True)
    if not len(found):
        return 0
    weights = 1.0 + np.floor(np.log2(counts))  # whole numbers: sums don't depend on their order
    columns = found.astype("<u8").view(np.uint8).reshape(-1, 8)
    votes = [np.bincount(columns[:, i], weights, 256) @ _SIGNS for i in range(8)]
    return int.from_bytes(np.packbits(np.concatenate(votes) > 0, bitorder="little").tobytes(), "little")


def likeness(a: int, b: int) -> float:
    """The share of equal bits."""
    return 1 - (a ^ b).bit_count() / BITS


def _signed(x: int) -> int:
    """The long with these 64 bits."""
    x &= (1 << BITS) - 1
    return x - (x >> 63 << 64)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (long) of every row."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            marks = [_signed(simhash(t or "")) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(marks, pa.int64())], ["doc_id", "fingerprint"])

    return key_and_text(docs, key, text).mapInArrow(work, "doc_id long, fingerprint long")


# ---------------------------------------------------------------- texts edited with the next document

_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint long, edited_fingerprint long, next_fingerprint long"
_WHOLE, _LAST, _FIRST = 0, 1, 2


def edit(text: str, following: str) -> str:
    """The last third of a text's code points replaced by as many of the following text's first."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _record(doc_id: int | None, text: str, mark: int, following: str, next_mark: int) -> tuple:
    changed = edit(text, following)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return doc_id, len(text), digest, _signed(mark), _signed(simhash(changed)), _signed(next_mark)


def _in_order(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row of a sorted slice with the row behind it; the first and last row leave with their texts."""
    part, before = TaskContext.get().partitionId(), None
    names = [*(f.split()[0] for f in _EDITED.split(", ")), "slice", "kind", "text"]
    types = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.int32(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    end = lambda row, kind: (row[0], None, None, _signed(row[2]), None, None, part, kind, row[1])
    for batch in slices(batches):
        rows = []
        for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
            row = (doc_id, text or "", simhash(text or ""))
            if before is None:
                rows.append(end(row, _FIRST))
            else:
                rows.append((*_record(*before, *row[1:]), part, _WHOLE, None))
            before = row
        yield batch_of(rows)
    if before is not None:
        yield batch_of([end(before, _LAST)])


def edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, and the fingerprints of the text, of the edited text, and of the next text.

    Rows are range partitioned, so texts move once. A slice's last row meets the next slice's first row afterwards: two
    rows a slice, joined by the slice.
    """
    rows = key_and_text(docs, key, text)
    order = [F.desc_nulls_last("doc_id"), F.xxhash64("text"), F.monotonically_increasing_id()]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    done = stage(laid.mapInArrow(_in_order, f"{_EDITED}, slice long, kind int, text string"), "edited")
    heads = done.where(F.col("kind") == _FIRST)
    # one row per slice, so the window without keys is over a bounded summary
    whole = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    behind = F.coalesce(F.lead("slice").over(Window.orderBy("slice")), F.min("slice").over(whole))
    follows = heads.select("slice", behind.alias("behind"))
    head = heads.select(F.col("slice").alias("behind"), F.col("text").alias("following"), F.col("fingerprint").alias("next_mark"))
    open_rows = (
        done.where(F.col("kind") == _LAST).select("doc_id", "slice", "text", "fingerprint")
        .join(follows, "slice").join(head, "behind").select("doc_id", "text", "fingerprint", "following", "next_mark")
    )

    def close(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [_record(r["doc_id"], r["text"], r["fingerprint"], r["following"], r["next_mark"]) for r in batch.to_pylist()]
            names = [f.split()[0] for f in _EDITED.split(", ")]
            types = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)

    names = [f.split()[0] for f in _EDITED.split(", ")]
    return done.where(F.col("kind") == _WHOLE).select(*names).unionByName(open_rows.mapInArrow(close, _EDITED))


# ---------------------------------------------------------------- all within a radius


def _masks(radius: int) -> tuple[list[int], list[tuple[int, ...]]]:
    """The masks of radius + 3 blocks of bits, and the tables: every three blocks."""
    edges = [round(i * BITS / (radius + 3)) for i in range(radius + 4)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return blocks, list(combinations(range(radius + 3), 3))


def _counts(a: np.ndarray, b: np.ndarray, weights: np.ndarray, table: int, radius: int) -> np.ndarray:
    """For each of `a` the summed weights of those of `b` within the radius whose first table this is; not itself."""
    blocks, tables = _masks(radius)
    earlier = [np.uint64(sum(blocks[i] for i in t)) for t in tables[:table]]
    out = np.zeros(len(a), dtype=np.int64)
    for at in range(0, len(a), 256):
        apart = a[at : at + 256, None] ^ b[None, :]
        close = (np.bitwise_count(apart) <= radius) & (apart != 0)
        rows, cols = np.nonzero(close)
        for mask in earlier:
            fresh = (apart[rows, cols] & mask) != 0
            rows, cols = rows[fresh], cols[fresh]
        out[at : at + 256] = np.bincount(rows, weights[cols], min(256, len(a) - at))
    return out


def _tile(members: tuple[np.ndarray, ...], table: int, i: int, j: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of a tile and the documents near them: within one chunk, or between its two chunks."""
    marks, weights, chunks = members
    if i == j:
        return marks, _counts(marks, marks, weights, table, radius)
    a, b = chunks == i, chunks == j
    first, second = (_counts(marks[x], marks[y], weights[y], table, radius) for x, y in ((a, b), (b, a)))
    return np.concatenate([marks[a], marks[b]]), np.concatenate([first, second])


def near(marks: DataFrame, radius: int = RADIUS, tile: int = TILE, share: int = SHARE) -> DataFrame:
    """fingerprint, n_near: how many rows have another fingerprint within the radius; none without such a row."""
    blocks, tables = _masks(radius)
    distinct = stage(marks.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows")), "marks")
    keys = F.array(*[
        F.struct(F.lit(t).alias("table"), F.col("fingerprint").bitwiseAND(_signed(sum(blocks[i] for i in chosen))).alias("key"))
        for t, chosen in enumerate(tables)
    ])
    entries = distinct.select("fingerprint", "rows", F.explode(keys).alias("k")).select("fingerprint", "rows", "k.*")
    seen = entries.where(F.pmod(F.xxhash64("fingerprint"), F.lit(share)) == 0).groupBy("table", "key").agg(F.count(F.lit(1)).alias("seen"))
    heavy = seen.select("table", "key", F.ceil(F.col("seen") * share / tile).cast("int").alias("chunks")).where("chunks > 1")
    placed = entries.join(heavy, ["table", "key"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("fingerprint", F.lit("chunk")), F.col("chunks")).cast("int"))
    other = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tiled = other.select(
        "table", "key", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "fingerprint", "rows", "chunk"
    )
    group = ["table", "key", "i", "j"]

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        current = None

        def result() -> Iterator[pa.RecordBatch]:
            members = tuple(np.concatenate([h[c] for h in held]) for c in range(3))
            if len(members[0]) > 1:
                found, n = _tile(members, current[0], current[2], current[3], radius)
                some = n > 0
                yield pa.RecordBatch.from_arrays([pa.array(found[some].view(np.int64)), pa.array(n[some])], ["fingerprint", "near"])

        for batch in batches:
            columns = [batch[c].to_numpy(zero_copy_only=False) for c in group]
            changes = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            bounds = [0, *changes.tolist(), batch.num_rows]
            values = [batch[c].to_numpy(zero_copy_only=False) for c in ("fingerprint", "rows", "chunk")]
            values[0] = values[0].view(np.uint64)
            for began, stop in zip(bounds, bounds[1:]):
                if began == stop:
                    continue
                tile_key = tuple(int(c[began]) for c in columns)
                if tile_key != current:
                    if held:
                        yield from result()
                    held, current = [], tile_key
                held.append([v[began:stop] for v in values])
        if held:
            yield from result()

    sorted_tiles = tiled.repartition(*group).sortWithinPartitions(*group)
    found = sorted_tiles.mapInArrow(work, "fingerprint long, near long")
    return found.groupBy("fingerprint").agg(F.sum("near").alias("n_near"))


def with_near(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows with n_near: how many other rows have a fingerprint within the radius, equal ones included.

    A fingerprint that more than one row in HOT_SHARE has is one of HOT_SHARE at most; those are sent to all tasks, so
    their rows stay where they are. The others are joined by the fingerprint.
    """
    equal = rows.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("rows"))
    found = near(rows.select("fingerprint"), radius)
    n_near = F.col("rows") - 1 + F.coalesce("n_near", F.lit(0))
    counts = stage(equal.join(found, "fingerprint", "left").select("fingerprint", n_near.alias("n_near"), "rows"), "near")
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    hot = F.broadcast(counts.where(F.col("rows") * HOT_SHARE > total).drop("rows"))
    others = rows.join(hot, "fingerprint", "left_anti").join(counts.drop("rows"), "fingerprint")
    return others.unionByName(rows.join(hot, "fingerprint"))
