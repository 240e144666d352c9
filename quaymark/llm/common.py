"""What the operators of this folder share: slices of Arrow batches, scratch tables, bounded memos."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows held as Python objects at a time; a batch from Spark may hold many more.
SLICE_ROWS = 256


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Short runs of rows, so that few texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def key_and_text(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; other columns can't clash."""
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def unit_hash(*columns: Column) -> Column:
    """A number in (0, 1) that is the same in every run, from 52 bits of a digest."""
    digest = F.md5(F.concat_ws("|", *(c.cast("string") for c in columns)))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def semi_joined(docs: DataFrame, kept: DataFrame, key: str) -> DataFrame:
    """The rows of `docs` whose key is in the one column of `kept`, with all their columns, whatever their names."""
    whole = docs.select(F.struct("*").alias("row"), F.col(f"`{key}`").cast("long").alias("row_key"))
    ids = kept.toDF("kept_key").distinct()
    return whole.join(ids, whole["row_key"].eqNullSafe(ids["kept_key"]), "left_semi").select("row.*")


class Memo(dict):
    """A dictionary that is emptied when it is full, so that a long-lived worker stays bounded."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most

    def trim(self) -> None:
        if len(self) > self.most:
            self.clear()
