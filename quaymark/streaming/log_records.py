"""Log records, fields and classes on a stream of lines.

A file's lines arrive in order but cut into micro-batches anywhere, so the record a line belongs to may have begun in an
earlier one. A stateful processor per file carries the open record: its number and how many lines it has so far, or, to
join a record's text, its lines. A record ends where the next one starts, or when the watermark has moved on by the idle
time since its last line came. Lines follow each other by number: one whose time lies behind the watermark counts too.

Fields and classes are plain expressions; they are the batch operators, run on the stream. Each micro-batch is written
once, split into folders by route and batch, and replaces what an earlier try of the same batch left there.

Arrow and pandas carry the rows of a micro-batch to the processors: built-in operators have no state over batches that
keeps the order of lines. A file's lines of one micro-batch are sorted in memory; the trigger's limits bound them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import logs
from ..session import new_folder, stage, unstage

#: How long after its last line a record counts as ended, by the lines' times.
IDLE_SECONDS = 600
LINES = "path string, line_no long, line string, record_no long, line_in_record long"
RECORDS = "path string, record_no long, first_line long, lines long, message string"
RECORD_COLUMNS = ["path", "record_no", "first_line", "lines", "message"]
#: Ended records and letters of them that one frame holds; a frame's texts have to stay below Arrow's 2 GB.
FRAME_RECORDS, FRAME_LETTERS = 10_000, 1 << 24


def _sorted(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    found = pd.concat(list(rows), ignore_index=True)
    return found.sort_values("line_no", kind="stable", ignore_index=True)


def _starts(lines: pd.DataFrame) -> pd.Series:
    return lines["line"].fillna("").str.match(logs.RECORD_START).astype("int64")


def _joined(texts: list[str | None]) -> str:
    return "\n".join(text for text in texts if text is not None)


class LineNumbering(StatefulProcessor):
    """Gives each line its record and its place there, from where the last micro-batch ended."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.place = handle.getValueState("place", "record_no long, lines long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        record_no, lines = self.place.get() if self.place.exists() else (0, 0)
        if key[0] is None:  # the row that closes a run
            return
        found = _sorted(rows)
        found["record_no"] = _starts(found).cumsum() + record_no
        within = found.groupby("record_no").cumcount() + 1
        found["line_in_record"] = within + lines * (found["record_no"] == record_no)
        last = found.iloc[-1]
        self.place.update((int(last["record_no"]), int(last["line_in_record"])))
        found["path"] = key[0]
        yield found[["path", "line_no", "line", "record_no", "line_in_record"]]

    def close(self) -> None:
        pass


class RecordGathering(StatefulProcessor):
    """Joins the lines of records. The open record's lines are state, one entry a line, appended as they come.

    Records that begin and end in one micro-batch never touch the state, which costs a call to the JVM each time: a file's
    micro-batch reads the open record once, writes the next one once, and gives out many ended records in a frame.
    """

    def __init__(self, idle_seconds: int):
        self.idle_seconds = idle_seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.number = handle.getValueState("number", "record_no long")
        self.open = handle.getListState("open", "line_no long, line string")
        self.timer = handle.getValueState("timer", "at long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is None:
            return
        found = _sorted(rows)
        (record_no,) = self.number.get() if self.number.exists() else (0,)
        line_nos, texts = found["line_no"].astype(int).tolist(), found["line"].tolist()
        starts = _starts(found).to_numpy().nonzero()[0].tolist()
        if starts:
            # the first start ends the record that was open, the last one opens the next
            head = list(zip(line_nos[: starts[0]], texts[: starts[0]]))
            before = [tuple(x) for x in self.open.get()] + head
            ended = [(key[0], record_no, before[0][0], len(before), _joined([text for _, text in before]))] if before else []
            size = len(ended[0][-1]) if ended else 0
            for i, (began, stop) in enumerate(zip(starts, starts[1:]), record_no + 1):
                ended.append((key[0], i, line_nos[began], stop - began, _joined(texts[began:stop])))
                size += len(ended[-1][-1])
                if len(ended) >= FRAME_RECORDS or size >= FRAME_LETTERS:
                    yield pd.DataFrame(ended, columns=RECORD_COLUMNS)
                    ended, size = [], 0
            if ended:
                yield pd.DataFrame(ended, columns=RECORD_COLUMNS)
            self.open.put(list(zip(line_nos[starts[-1] :], texts[starts[-1] :])))
            self.number.update((record_no + len(starts),))
        else:
            self.open.appendList(list(zip(line_nos, texts)))
            self.number.update((record_no,))
        # a file whose times lie behind the watermark is not silent: its wait begins at the watermark
        last = max(int(found["read_at"].max().timestamp() * 1000), timerValues.getCurrentWatermarkInMs())
        self._wait_until(last + self.idle_seconds * 1000)

    def _wait_until(self, millis: int) -> None:
        if self.timer.exists():
            self.handle.deleteTimer(self.timer.get()[0])
        self.handle.registerTimer(millis)
        self.timer.update((millis,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """The open record ends. Lines that still come are a record's later part and count as a record of that number."""
        (record_no,) = self.number.get()
        lines = [tuple(x) for x in self.open.get()]
        self.open.clear()
        self.timer.clear()
        if lines:
            ended = (key[0], record_no, lines[0][0], len(lines), _joined([text for _, text in lines]))
            yield pd.DataFrame([ended], columns=RECORD_COLUMNS)

    def close(self) -> None:
        pass


def number_lines(lines: DataFrame) -> DataFrame:
    """The streaming form of `logs.assemble_records`, for lines (path, line_no, line)."""
    keyed = lines.select("path", "line_no", "line").groupBy("path")
    return keyed.transformWithStateInPandas(LineNumbering(), LINES, "Append", "None")


def gather_records(lines: DataFrame, lateness: str, idle_seconds: int = IDLE_SECONDS) -> DataFrame:
    """The streaming form of `logs.record_texts`, for lines (path, line_no, line, read_at)."""
    timed = lines.select("path", "line_no", "line", "read_at").withWatermark("read_at", lateness)
    # rows later than the watermark are dropped by the mark on its column; the sum has none, so no line is lost
    timed = timed.withColumn("read_at", F.col("read_at") + F.expr("INTERVAL 0 SECONDS"))
    return timed.groupBy("path").transformWithStateInPandas(RecordGathering(idle_seconds), RECORDS, "Append", "EventTime")


PARSED, FAILED = "parsed", "failed"


def routed(lines: DataFrame, message: str = "line") -> DataFrame:
    """Fields and classes of lines, batch or stream, with the route of each: parsed, or failed if a pattern didn't match."""
    found = logs.classify(logs.structure(lines, message=message), message=message)
    return found.withColumn("route", F.when(F.size("tags") > 0, FAILED).otherwise(PARSED))


def write_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Write a micro-batch's rows below out/route=.../batch=..., in place of what an earlier try left."""
    folder = batch.withColumn("batch", F.lit(batch_id)).write.partitionBy("route", "batch")
    folder.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(out)


def run_routed(stream: DataFrame, out: str, checkpoint: str, write: Callable[[DataFrame, int, str], None] = write_batch) -> None:
    """Process everything that is there now, each micro-batch to the folders of its routes."""
    query = (
        stream.writeStream.foreachBatch(lambda batch, batch_id: write(batch, batch_id, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_route(spark, out: str, route: str, schema) -> DataFrame:
    """The rows of one route, which lie in a folder of their own."""
    kept = [f for f in schema if f.name not in ("route", "batch")]
    return spark.read.schema(type(schema)(kept)).parquet(f"{out}/route={route}").drop("batch")


def cut(lines: DataFrame, order: Column, cuts: int) -> Iterator[str]:
    """Lines written in consecutive parts by ranges of a number, one more part each time the folder is yielded.

    A part is written by all tasks and may have many files, so a stream takes it as one micro-batch: it is run on what is
    there now before the next part is written.
    """
    spark, folder = lines.sparkSession, new_folder(lines.sparkSession, "lines")
    held = stage(lines, "uncut")
    low, high = held.agg(F.min(order), F.max(order)).first()
    if low is None:
        lines.write.parquet(folder)
        yield folder
        return
    width = (high - low) // cuts + 1
    for i in range(cuts):
        within = (order >= low + i * width) & (order < low + (i + 1) * width)
        held.where(within).write.mode("append").parquet(folder)
        yield folder
    unstage(held)
