"""Log analytics: records from lines, fields from records, classes from fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rules import first_match
from ..functions.times import parse_time
from .ordered import ordered

# The record pattern, the path pattern and the words that mean trouble.
RECORD = r"\[(\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}[.,]\d{3})\] \{([^}]*)\} ([A-Za-z]+) - (.*)"
PATH = r".*/([^/]+)/([^/]+)/([^/]+)/(\d+)\.log$"
TROUBLE = r"(?i)(error|exception|failed|traceback|fatal)"
RECORD_START = r"^\["
LAYERS = (("bronze", "bronze"), ("silver", "silver"), ("gold", "gold"), ("master", "orchestration"))


def assemble_records(lines: DataFrame, path: str = "path", line_no: str = "line_no", line: str = "line") -> DataFrame:
    """Give every line the number of its record and its place there.

    A record starts at a line that opens with a bracket; record 0 holds the lines above the first start of a file.
    Lines stay rows, so a record or a file of any size is split over tasks.
    """
    rows = ordered(lines, [path], [line_no])
    starts = F.when(F.col(line).rlike(RECORD_START), 1).otherwise(0)
    marked = rows.done(rows.running_sum(rows.frame, starts, "record_no"))
    # the marked lines are computed, so they are sliced at once and not counted first
    places = ordered(marked, [path, "record_no"], [line_no])
    return places.done(places.number(places.frame, "line_in_record"))


def record_texts(assembled: DataFrame, path: str = "path", line_no: str = "line_no", line: str = "line") -> DataFrame:
    """One row per record with its joined text: path, record_no, first_line, lines, message.

    A text is one value and has to fit into memory, as any value has.
    """
    parts = F.array_sort(F.collect_list(F.struct(F.col(line_no).alias("at"), F.col(line).alias("text"))))
    grouped = assembled.groupBy(path, "record_no").agg(
        F.min(line_no).alias("first_line"), F.count(F.lit(1)).alias("lines"), parts.alias("_parts")
    )
    return grouped.withColumn("message", F.array_join(F.transform("_parts", lambda p: p["text"]), "\n")).drop("_parts")


def structure(records: DataFrame, message: str = "message", path: str = "path") -> DataFrame:
    """Split a record and its path into fields; what does not match is tagged and kept."""
    text, file = F.col(message), F.col(path)
    matched = text.rlike(RECORD)
    placed = file.rlike(PATH)

    def part(i: int):
        return F.when(matched, F.regexp_extract(text, RECORD, i))

    def place(i: int):
        return F.when(placed, F.regexp_extract(file, PATH, i))

    stamp = F.translate(part(1), "T,", " .")
    tags = F.array(
        F.when(~matched, F.lit("record_parse_failure")), F.when(~placed, F.lit("path_parse_failure"))
    )
    return records.withColumns(
        {
            "logged_at": parse_time(stamp, "yyyy-MM-dd HH:mm:ss.SSS"),
            "source_file": part(2),
            "log_level": F.lower(part(3)),
            "log_message": part(4),
            "dag_id": place(1),
            "task_id": place(2),
            "execution_date": place(3),
            "try_number": place(4).try_cast("int"),
            "tags": F.array_compact(tags),
        }
    )


def classify(logs: DataFrame, message: str = "message") -> DataFrame:
    """Add layer and severity; drop debug heartbeats and the shipper's own debug lines."""
    dag, body, severity = F.col("dag_id"), F.col("log_message"), F.col("log_level")
    noise = F.coalesce(body.contains("Heartbeat") & (severity == "debug"), F.lit(False))
    noise = noise | F.coalesce(F.col(message).startswith("DBG"), F.lit(False))
    return logs.filter(~noise).withColumns(
        {
            "layer": first_match([(dag.contains(word), name) for word, name in LAYERS], None),
            "severity": first_match([(body.rlike(TROUBLE), "high"), (severity == "warning", "medium")], "low"),
        }
    )
