"""Quality by importance resampling: hashed n-gram models of target and raw text, sampled by Gumbel top-k.

The target model is fitted on documents labelled good, the raw model on all documents. Both are distributions
over `BUCKETS` hashed unigrams and bigrams. Tokens are runs of word bytes or of punctuation; a token equal to
the one before it counts as a repeat sign, so that repetition is an n-gram too. A document's log weight is the
sum over its n-grams of log(target / raw) - offset; the offset is set on the labelled documents so that zero
separates good from bad best. As many documents are drawn as have a positive weight, without replacement, by
the largest weight plus Gumbel noise from a digest of id and seed. The weights of whole documents are far apart
against the noise, so it decides near the cut only.

Labels are a bounded sample: the `MAX_LABELS` labelled documents of smallest hash. A document with several
labels counts as bad if one says so. Cases: a null or blank text has no n-gram and is never drawn; without labels
of both kinds all others are drawn; rows that tie at the cut are drawn together; repeated rows give a row each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaymark.session import stage

from .common import key_and_text, semi_joined, slices, unit_hash

BUCKETS = 16_384
MAX_LABELS = 50_000
#: Ranges that are counted at once on the way to the k-th largest key.
RANGES = 4_096
_TOKENS = re.compile(rb"[A-Za-z0-9_\x80-\xff]+|[^\sA-Za-z0-9_\x80-\xff]+").findall
_REPEAT = np.uint64(zlib.crc32(b"same again"))


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of all unigrams and bigrams of some texts, and the text each belongs to."""
    tokens = [[zlib.crc32(t) for t in _TOKENS(text.encode())] for text in texts]
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in tokens])
    flat = np.array([h for t in tokens for h in t], dtype=np.uint64)
    if not len(flat):
        return np.zeros(0, dtype=np.int64), owner
    joined = owner[1:] == owner[:-1]
    same = joined & (flat[1:] == flat[:-1])
    flat[1:][same] = _REPEAT
    pairs = ((flat[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ flat[1:])[joined]
    both = np.concatenate([flat, pairs ^ np.uint64(0xA5A5A5A5)])
    both *= np.uint64(0xFF51AFD7ED558CCD)
    both ^= both >> np.uint64(33)
    return (both % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([owner, owner[1:][joined]])


def label_sample(labels: DataFrame, key: str = "doc_id", quality: str = "quality") -> DataFrame:
    """doc_id, good for at most MAX_LABELS labelled documents."""
    named = labels.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{quality}`").alias("quality")).dropna()
    return (
        named.groupBy("doc_id").agg((F.min("quality") >= 1).alias("good"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELS)
    )


def fit(docs: DataFrame) -> np.ndarray:
    """log(target / raw) per bucket; docs have text and good (null where no label is)."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in slices(batches):
            found, owner = ngrams([t or "" for t in batch["text"].to_pylist()])
            good = np.array([g is True for g in batch["good"].to_pylist()], dtype=bool)
            raw += np.bincount(found, minlength=BUCKETS)
            target += np.bincount(found[good[owner]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(raw), pa.array(target)], ["bucket", "raw", "target"])

    counted = docs.select("text", "good").mapInArrow(work, "bucket long, raw long, target long")
    rows = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # BUCKETS rows
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for row in rows:
        raw[row["bucket"]] += row["raw"]
        target[row["bucket"]] += row["target"]
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def score(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id, good, n_grams, log_ratio (their sum) for every row."""
    packed = ratios.tobytes()

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(packed)
        for batch in slices(batches):
            found, owner = ngrams([t or "" for t in batch["text"].to_pylist()])
            n = batch.num_rows
            sums = np.bincount(owner, weights=table[found], minlength=n)
            counts = np.bincount(owner, minlength=n).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["good"], pa.array(counts), pa.array(sums)], ["doc_id", "good", "n_grams", "log_ratio"]
            )

    return docs.select("doc_id", "text", "good").mapInArrow(work, "doc_id long, good boolean, n_grams long, log_ratio double")


def offset(labelled: list[tuple[bool, float]]) -> float:
    """The mean log ratio that best separates good from bad: least sum of both error rates, in the widest gap."""
    good = np.sort([m for g, m in labelled if g])
    bad = np.sort([m for g, m in labelled if not g])
    if not len(good) or not len(bad):
        return -np.inf
    cuts = np.unique(np.concatenate([good, bad]))
    middles = (cuts[1:] + cuts[:-1]) / 2
    if not len(middles):
        return -np.inf
    errors = np.searchsorted(good, middles) / len(good) + 1 - np.searchsorted(bad, middles) / len(bad)
    least = np.flatnonzero(errors <= errors.min() + 1e-12)
    return float(middles[least[np.argmax((cuts[1:] - cuts[:-1])[least])]])


def kth_largest(keyed: DataFrame, k: int) -> float | None:
    """The k-th largest `sample_key`, by counting keys in ever finer ranges; no sort, no task with all rows."""
    bounds = keyed.agg(F.min("sample_key"), F.max("sample_key")).first()
    if k <= 0 or bounds[0] is None:
        return None
    low, high = bounds
    while low < high:
        step = (high - low) / RANGES
        if not low < low + step < high:  # neighbouring numbers
            above = keyed.where(F.col("sample_key") >= high).count()
            return high if above >= k else low
        number = F.least(F.floor((F.col("sample_key") - low) / step), F.lit(RANGES - 1))
        inside = keyed.where((F.col("sample_key") >= low) & (F.col("sample_key") <= high))
        rows = inside.groupBy(number.alias("number")).agg(
            F.count("*").alias("n"), F.min("sample_key").alias("low"), F.max("sample_key").alias("high")
        ).orderBy(F.desc("number")).collect()  # at most RANGES rows
        for row in rows:
            if k <= row["n"]:
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
        else:
            return low
    return low


def importance(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7) -> DataFrame:
    """doc_id, log_weight, sample_key, kept for every row."""
    marks = label_sample(labels)
    marked = key_and_text(docs, key, text).join(F.broadcast(marks), "doc_id", "left")  # at most MAX_LABELS rows
    scored = stage(score(marked, fit(marked)), "scored")
    means = scored.where(F.col("good").isNotNull() & (F.col("n_grams") > 0)).select("good", (F.col("log_ratio") / F.col("n_grams")).alias("mean"))
    cut = offset([(r["good"], r["mean"]) for r in means.limit(2 * MAX_LABELS).collect()])
    weight = F.when(F.col("n_grams") > 0, F.col("log_ratio") - F.col("n_grams") * cut if np.isfinite(cut) else F.lit(1e9))
    noise = -F.log(-F.log(unit_hash(F.col("doc_id"), F.lit(seed))))
    keyed = scored.select("doc_id", weight.alias("log_weight")).withColumn("sample_key", F.col("log_weight") + noise)
    k = keyed.where("log_weight > 0").count()
    least = kth_largest(keyed, k)
    kept = F.coalesce(F.col("sample_key") >= F.lit(least), F.lit(False)) if least is not None else F.lit(False)
    return keyed.withColumn("kept", kept)


def drawn(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 7) -> DataFrame:
    """The documents drawn, with all their columns; an id that several rows have is drawn if one of them is."""
    return semi_joined(docs, importance(docs, labels, key, text, seed).where("kept").select("doc_id"), key)
