"""Near-duplicate vectors: int8 tile products with error bounds, and full precision where they can't decide.

Vectors are compared only within a label. Equal vectors are first counted as one. Each unit vector u is held as
int8 codes q and a scale s with u = s q + e, and its own bounds |e|, |s q|. For two vectors the quantised cosine
differs from the true one by at most |e1| |s2 q2| + |e2| |s1 q1| + |e1| |e2|, so a tile of code products tells
rigorously which pairs may reach the threshold. Only those are recomputed in double precision, and only pairs
found at or above the threshold are links.

The vectors of a label are dealt into blocks of one size, and one task takes one pair of blocks, so its memory doesn't grow
with the label; how often a vector is sent does, as the comparisons themselves do. It returns, per vector, how many
links it found and a spanning forest of them, never the pairs, so a dense group costs no more rows than a sparse
one. Components come from alternating large-star and small-star over the forests.

Cases: vectors that are null, empty, zero or hold null or non-finite components, and those without a label, link
with nothing, not even their copies; vectors of different lengths are not compared; finite components of any size are
compared; each row of a repeated id counts by its own vector; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymark.session import stage

from .components import components

#: Vectors in a block on average, however many a label has.
BLOCK_ROWS = 2_048
#: Rows of a block that are multiplied at once.
TILE = 512
#: Pairs recomputed at once.
RECHECK = 65_536
#: Rounding of the bounds' own arithmetic.
SLACK = 1e-9


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, error norms and norms of what the codes stand for, per row of unit vectors."""
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    held = codes * scale[:, None]
    return codes, scale, np.linalg.norm(unit - held, axis=1), np.linalg.norm(held, axis=1)


class Forest:
    """Links between places that joined two trees; links within a tree are not kept."""

    def __init__(self, places: int):
        self.parent = np.arange(places)
        self.links: list[tuple[int, int]] = []

    def add(self, left: np.ndarray, right: np.ndarray) -> None:
        parent = self.parent
        while True:
            roots_l, roots_r = parent[left], parent[right]
            apart = roots_l != roots_r
            if not apart.any():
                return
            left, right = left[apart], right[apart]
            low, high = np.minimum(roots_l, roots_r)[apart], np.maximum(roots_l, roots_r)[apart]
            # each upper root is hung on a lower one by one of its links
            tops, first = np.unique(high, return_index=True)
            self.links += zip(left[first].tolist(), right[first].tolist())
            parent[tops] = low[first]
            while not (parent[parent] == parent).all():  # until every place points at its root
                parent[:] = parent[parent]


def levelled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times the power of two that brings its largest component below one; no digit changes, no norm overflows."""
    _, exponents = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponents[:, None])


def link_block(left: np.ndarray, right: np.ndarray, same: bool, threshold: float):
    """Link pairs of two blocks of vectors in double precision; yields (places left, places right).

    Cosine in full precision is the dot product over the product of the norms.
    """
    left, right = levelled(left), levelled(right)
    norm_l, norm_r = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    codes_l, scale_l, error_l, held_l = quantised(left / norm_l[:, None])
    codes_r, scale_r, error_r, held_r = quantised(right / norm_r[:, None])
    wide_r = codes_r.astype(np.float32).T  # products of codes are exact in single precision below 2^24
    exact = np.float32 if left.shape[1] * 127 * 127 < 2**24 else np.float64
    for at in range(0, len(left), TILE):
        rows = slice(at, at + TILE)
        product = codes_l[rows].astype(exact) @ wide_r.astype(exact, copy=False)
        estimate = product * scale_l[rows, None] * scale_r[None, :]
        error = error_l[rows, None] * held_r[None, :] + held_l[rows, None] * error_r[None, :] + error_l[rows, None] * error_r[None, :]
        a, b = np.nonzero(estimate + error + SLACK >= threshold)
        a += at
        if same:
            a, b = a[a < b], b[a < b]
        for i in range(0, len(a), RECHECK):
            x, y = a[i : i + RECHECK], b[i : i + RECHECK]
            cosine = np.einsum("ij,ij->i", left[x], right[y]) / (norm_l[x] * norm_r[y])
            linked = cosine >= threshold
            if linked.any():
                yield x[linked], y[linked]


def _pair_task(threshold: float):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        first, second = int(rows["first"].iloc[0]), int(rows["second"].iloc[0])
        same = first == second
        sides = [rows[rows["block"] == first]] + ([] if same else [rows[rows["block"] == second]])
        left, right = sides[0], sides[-1]
        both = pd.concat(sides)
        ids, copies = both["node"].to_numpy(np.int64), both["copies"].to_numpy(np.int64)
        links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        if len(left) and len(right):
            x, y = (np.frombuffer(b"".join(s["raw"]), "<f8").reshape(len(s), -1) for s in (left, right))
            for a, b in link_block(x, y, same, threshold):
                b = b + (0 if same else len(left))
                links += np.bincount(a, weights=copies[b], minlength=len(ids)).astype(np.int64)
                links += np.bincount(b, weights=copies[a], minlength=len(ids)).astype(np.int64)
                forest.add(a, b)
        met = np.flatnonzero(links)
        a = np.array([t[0] for t in forest.links], dtype=np.int64)
        b = np.array([t[1] for t in forest.links], dtype=np.int64)
        return pd.DataFrame(
            {
                "node": np.concatenate([ids[met], ids[a]]),
                "links": np.concatenate([links[met], np.zeros(len(a), np.int64)]),
                "other": pd.array([*[None] * len(met), *ids[b].tolist()], dtype="Int64"),
            }
        )

    return work


def _read(rows: DataFrame) -> DataFrame:
    """Every row, its id not null: vec_id, label, raw (doubles as bytes), digest of label and vector; no raw and digest if it can't link."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            raw = []
            for label, vector in zip(batch["label"], batch["embedding"]):
                v = np.array([np.nan if x is None else x for x in (() if vector is None else vector)], dtype="<f8")
                fine = label is not None and v.size and np.isfinite(v).all() and v.any()
                # 0.0 and -0.0 are the same component
                raw.append((v + 0.0).tobytes() if fine else None)
            yield batch[["vec_id", "label"]].assign(raw=raw)

    packed = rows.mapInPandas(work, "vec_id long, label string, raw binary")
    return packed.withColumn("digest", F.sha2(F.concat("raw", F.lit("|").cast("binary"), F.col("label").cast("binary")), 256))


def near_duplicates(
    rows: DataFrame, threshold: float = 0.93, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row."""
    narrow = rows.select(
        F.col(f"`{key}`").cast("long").alias("vec_id"), F.col(f"`{vector}`").cast("array<double>").alias("embedding"),
        F.col(f"`{label}`").cast("string").alias("label"),
    )
    read = stage(_read(narrow.where("vec_id IS NOT NULL")), "usable")
    usable = read.where("digest IS NOT NULL")
    first = F.min(F.struct("vec_id", "label", "raw"))
    reps = usable.groupBy("digest").agg(first.alias("_first"), F.count("*").alias("copies")).select(
        "digest", F.col("_first.vec_id").alias("rep"), F.col("_first.label").alias("label"), F.col("_first.raw").alias("raw"),
        F.octet_length("_first.raw").alias("width"), "copies",
    )
    # one id may have unlike vectors, so the written rows get numbers of their own
    reps = stage(reps.withColumn("node", F.monotonically_increasing_id()), "vectors")
    blocks = F.ceil(F.count("*") / BLOCK_ROWS).cast("int")
    dealt = reps.join(reps.groupBy("label", "width").agg(blocks.alias("blocks")), ["label", "width"])
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    pairs = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "label", "width", F.least("block", "_other").alias("first"), F.greatest("block", "_other").alias("second"),
        "block", "node", "copies", "raw",
    )
    links = pairs.groupBy("label", "width", "first", "second").applyInPandas(_pair_task(threshold), "node long, links long, other long")
    found = stage(links, "found")
    joined = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counted = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    groups = joined.withColumnRenamed("component", "group")
    placed = reps.select("digest", "rep", "node", "copies").join(counted, "node", "left").join(groups, "node", "left")
    placed = stage(placed.withColumn("group", F.coalesce("group", "node")), "placed")
    least = placed.groupBy("group").agg(F.min("rep").alias("component_id"))
    classes = placed.join(least, "group").select("digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    members = usable.select("vec_id", "digest").join(classes, "digest").drop("digest")
    unusable = read.where("digest IS NULL").select("vec_id").unionByName(narrow.where("vec_id IS NULL").select("vec_id"))
    alone = unusable.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return members.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
