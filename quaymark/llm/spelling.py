"""Spelling variants: words one edit apart, by the nodes of two tries.

Every word is a path in a trie of the words and, read backwards, in a trie of the reversed words; each node has a
number. A place in a word splits it into a prefix node and a suffix node, a pair of integers. Two words of equal length
that differ in one letter have the same pair around that letter; a word that lacks one letter of another has, between
two of its letters, the pair the other has around that letter. So words are joined on pairs, never compared.

The numbers come from sorted words: a word adds nodes only behind what it shares with the word before it. Words are
range partitioned, each slice numbers its own nodes, and one word per slice (its last) tells the next slices which
nodes are known. Around one letter at most as many words can meet as there are letters, and between two letters one
word stands, so a group on a pair is bounded by the alphabet.

Cases: null or empty texts have no words; repeated rows and repeated words of a document all count; a null id is the
empty text in a hash; an empty table gives no rows; other columns are not read. Equal counts go by code-point order.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.session import stage

from .common import key_and_text, slices

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: A form has at least this many times the occurrences of its variant.
RATIO = 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Kinds of pairs: between two letters, around a letter that repeats the one before it, around any other letter.
BETWEEN, AROUND_REPEAT, AROUND = 0, 1, 2
#: More doublings than any chain of counts that at least double can need.
MOST_ROUNDS = 8


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, run: every maximal run of letters of every whole text, with only A-Z lower-cased."""
    found = F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0)))
    return key_and_text(docs, key, text).select("doc_id", found.alias("run")).withColumn("run", F.translate("run", _UPPER, _LOWER))


def with_slips(found: DataFrame, every: int = 97) -> DataFrame:
    """The runs as words, of which one in `every` lost a letter, chosen by a hash of document and run."""
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")))
    at = F.pmod(h, F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return found.select(F.when(h % every == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, letters: int = LEAST_LETTERS, count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words that are long and frequent enough. Repeats are counted before the shuffle."""
    long = words.where(F.length("word") >= letters)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= count)


def _shared(a: str, b: str) -> int:
    return len(commonprefix((a, b)))


def _local(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the nodes of a sorted slice from 1; the root is 0 everywhere."""
    part, place, last, nodes, free = TaskContext.get().partitionId(), 0, "", [0], 1
    for batch in slices(batches, 4_096):
        out = []
        for path in batch["path"].to_pylist():
            known = _shared(last, path)
            new = len(path) - known
            nodes = [*nodes[: known + 1], *range(free, free + new)]
            free, last = free + new, path
            out.append(nodes)
        n = batch.num_rows
        added = [pa.array(np.full(n, part)), pa.array(np.arange(place, place + n)), pa.array(np.full(n, free)), pa.array(out, pa.list_(pa.int64()))]
        place += n
        yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "slice", "place", "free", "nodes"])


def _carried(placed: DataFrame) -> dict[int, tuple[int, str, list[int]]]:
    """For each slice: the nodes of all slices before it, and the last word before it with its nodes.

    One row per slice comes to the driver.
    """
    last = F.max_by(F.struct("path", "nodes"), "place")
    ends = placed.groupBy("slice").agg(last.alias("last"), F.max("free").alias("free")).orderBy("slice").collect()
    offsets = accumulate((r.free - 1 for r in ends), initial=0)
    carried, path, nodes = {}, "", [0]
    for row, offset in zip(ends, offsets):
        carried[row.slice] = (offset, path, nodes)
        path, nodes = row.last.path, _settled(row.last.path, row.last.nodes, *carried[row.slice])
    return carried


def _settled(path: str, own: list[int], offset: int, before: str, known: list[int]) -> list[int]:
    """Nodes of a word over all slices: those shared with the last word before the slice, then its slice's own."""
    shared = _shared(before, path)
    return [*known[: shared + 1], *(x + offset for x in own[shared + 1 :])]


def _numbered(words: DataFrame, path: Column, kept: str, name: str) -> DataFrame:
    """The columns `kept` of the words with the nodes of their paths, from the root on, as `name`."""
    fields = kept + ", path string"
    spread = words.withColumn("path", path).repartitionByRange("path").sortWithinPartitions("path")
    placed = stage(spread.mapInArrow(_local, f"{fields}, slice long, place long, free long, nodes array<long>"), name)
    carried = _carried(placed)

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4_096):
            rows = zip(batch["path"].to_pylist(), batch["nodes"].to_pylist(), batch["slice"].to_pylist())
            nodes = [_settled(p, own, *carried[s]) for p, own, s in rows]
            left = batch.select([x for x in batch.schema.names if x not in ("path", "slice", "place", "free", "nodes")])
            yield pa.RecordBatch.from_arrays([*left.columns, pa.array(nodes, pa.list_(pa.int64()))], [*left.schema.names, name])

    return placed.mapInArrow(work, f"{kept}, {name} array<long>")


def numbered(words: DataFrame) -> DataFrame:
    """word, n, prefixes, suffixes: the node of the first 0, 1, 2 ... letters and of the last 0, 1, 2 ... letters.

    The node of a whole word is greater the later the word stands in code-point order.
    """
    forward = _numbered(words.select("word", "n"), F.col("word"), "word string, n long", "prefixes")
    return _numbered(forward, F.reverse("word"), "word string, n long, prefixes array<long>", "suffixes")


def pairs(numbered_words: DataFrame) -> DataFrame:
    """prefix, suffix, kind, n, id: the pairs of nodes between and around the letters of each word.

    Of equal letters in a row only the first is marked as one to leave out, since each gives the same word.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1_024):
            prefix, suffix, kind, size = [], [], [], []
            for word, before, after in zip(*(batch[c].to_pylist() for c in ("word", "prefixes", "suffixes"))):
                prefix += before[:-1] + before
                suffix += after[-2::-1] + after[::-1]
                kind += [AROUND_REPEAT if a == b else AROUND for a, b in zip(word, " " + word)]
                kind += [BETWEEN] * len(before)
                size.append(2 * len(before) - 1)
            at = pa.array(np.repeat(np.arange(batch.num_rows), size))
            own = pa.array([p[-1] for p in batch["prefixes"].to_pylist()], pa.int64())
            columns = [pa.array(prefix, pa.int64()), pa.array(suffix, pa.int64()), pa.array(kind, pa.int32()), batch["n"].take(at), own.take(at)]
            yield pa.RecordBatch.from_arrays(columns, ["prefix", "suffix", "kind", "n", "id"])

    return numbered_words.mapInArrow(work, "prefix long, suffix long, kind int, n long, id long")


def near(found: DataFrame) -> DataFrame:
    """id, n_near, best (less: minus the count, id: the word) for the words that have a near word.

    A replaced letter is met at one pair only, a lacking letter likewise, so counts add up without duplicates.
    """
    ranked = F.struct((-F.col("n")).alias("less"), "id", "kind")
    met = found.groupBy("prefix", "suffix").agg(F.array_sort(F.collect_list(ranked)).alias("all")).where(F.size("all") > 1)
    met = met.select(
        F.filter("all", lambda m: m["kind"] != BETWEEN).alias("around"),
        F.filter("all", lambda m: m["kind"] == AROUND).alias("lacking"),
        F.get(F.filter("all", lambda m: m["kind"] == BETWEEN), F.lit(0)).alias("whole"),
    )
    bare = lambda m: F.when(m.isNotNull(), F.struct(m["less"].alias("less"), m["id"].alias("id")))
    first, second = (F.get("around", F.lit(i)) for i in (0, 1))
    shorter = lambda m: F.when(m["kind"] == AROUND, F.col("whole"))

    def of_longer(m: Column) -> Column:
        replaced = F.when(m["id"] == first["id"], bare(second)).otherwise(bare(first))
        count = F.size("around") - 1 + F.when(shorter(m).isNotNull(), 1).otherwise(0)
        return F.struct(m["id"].alias("id"), count.cast("long").alias("near"), F.least(replaced, bare(shorter(m))).alias("best"))

    longest = F.get("lacking", F.lit(0))
    of_whole = F.struct(F.col("whole.id").alias("id"), F.size("lacking").cast("long").alias("near"), bare(longest).alias("best"))
    each = F.concat(F.transform("around", of_longer), F.when(F.col("whole").isNotNull(), F.array(of_whole)).otherwise(F.array()))
    rows = met.select(F.explode(each).alias("m")).select("m.*").where("near > 0")
    return rows.groupBy("id").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """id, root for (id, up): chains are halved in each written round."""
    up = stage(forms, "forms")
    for _ in range(MOST_ROUNDS):
        beyond = up.select(F.col("id").alias("up"), F.col("up").alias("top"))
        up = stage(up.join(beyond, "up", "left").select("id", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "roots")
        if up.where("moved").isEmpty():
            return up.select("id", F.col("up").alias("root"))
        up = up.drop("moved")
    raise RuntimeError("forms did not settle")


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root for distinct words with their counts (word, n).

    A word's form is its most frequent near word, if that is `ratio` times as frequent; its root is the end of the
    chain of forms.
    """
    spelt = stage(numbered(words), "nodes")
    found = near(pairs(spelt))
    own = F.element_at("prefixes", -1).alias("id")
    joined = spelt.select("word", "n", own).join(found, "id", "left")
    good = -F.col("best.less") >= ratio * F.col("n")
    judged = stage(
        joined.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(good, F.col("best.id")).alias("up"), F.when(good, -F.col("best.less")).alias("form_n"),
        ),
        "judged",
    )
    roots = _roots(judged.where("up IS NOT NULL").select("id", "up"))
    form = judged.select(F.col("id").alias("up"), F.col("word").alias("form"))
    top = judged.select(F.col("id").alias("root"), F.col("word").alias("top"))
    return (
        judged.join(form, "up", "left").join(roots, "id", "left").join(top, "root", "left")
        .select("word", "form", F.coalesce("top", "word").alias("root"), "n", "n_near", "form_n")
    )
