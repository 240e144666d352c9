"""Log records, fields and routes on streams, however the lines are cut into micro-batches."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quaymark.operators import logs
from quaymark.session import new_folder
from quaymark.sources import files
from quaymark.streaming import flows, log_records

SCHEMA = "path string, line_no long, line string, read_at timestamp"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module", autouse=True)
def few_states(spark):
    """A state store per partition and micro-batch is opened, so two are enough here."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 2)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture(scope="module")
def lines():
    """Files whose records span lines: lines above the first start, long records, null and empty lines, one hot file."""
    draw = random.Random(2)
    rows = []
    for path, n in (("/logs/a_bronze/t/2024/1.log", 60), ("/logs/b/t/2024/2.log", 45), ("odd", 30), ("/logs/hot_gold/t/2024/1.log", 500)):
        for i in range(n):
            kind = draw.random()
            if kind < 0.3:
                text = f"[2024-01-01 00:00:{i % 60:02d},001] {{f.py:{i}}} ERROR - Task FAILED {i}"
            else:
                text = draw.choice(["Traceback:", "  at x", "", None, f"[broken {i}"]) if kind < 0.95 else f"[2024-01-01 00:00:01,002] {{g.py:1}} DEBUG - Heartbeat {i}"
            rows.append((path, i * 3 + 1, text, START + timedelta(seconds=len(rows))))
    return rows


def feed(spark, rows, cuts):
    """Files of consecutive lines, cut at the given places."""
    folder = new_folder(spark, "lines")
    for began, stop in zip([0, *cuts], [*cuts, len(rows)]):
        if began < stop:
            spark.createDataFrame(rows[began:stop], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return flows.file_stream(spark, folder, spark.createDataFrame([], SCHEMA).schema, files_per_batch=1)


def mixed(rows):
    """The files' lines in the order they are read: interleaved, each file in order."""
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    return [(*r[:3], START + timedelta(seconds=i)) for i, r in enumerate(order)]


CUTS = ([300], [1, 2, 400, 401])


@pytest.mark.parametrize("cuts", CUTS)
def test_line_numbers_equal_the_batch(spark, lines, cuts):
    rows = mixed(lines)
    stream, out = log_records.number_lines(feed(spark, rows, cuts)), new_folder(spark, "out")
    flows.run_available(stream, out, new_folder(spark, "offsets"))
    have = spark.read.parquet(out)
    want = logs.assemble_records(spark.createDataFrame(rows, SCHEMA).drop("read_at")).select(*have.columns)
    assert have.exceptAll(want).isEmpty() and want.exceptAll(have).isEmpty()


def gathered(spark, rows, cuts, lateness="10 minutes", idle=600):
    out, offsets, end = (new_folder(spark, n) for n in ("out", "offsets", "closing"))
    schema = spark.createDataFrame([], SCHEMA).schema
    source = feed(spark, rows, cuts).unionByName(flows.closing_stream(spark, end, schema))
    stream = log_records.gather_records(source, lateness, idle)
    flows.run_available(stream, out, offsets)
    before = spark.read.schema(stream.schema).parquet(out).count()
    flows.close(spark, end, schema, "read_at", F.lit(rows[-1][3]))
    flows.run_available(stream, out, offsets)
    return spark.read.schema(stream.schema).parquet(out), before


@pytest.mark.parametrize("cuts", CUTS)
def test_record_texts_equal_the_batch(spark, lines, cuts):
    rows = mixed(lines)
    have, before = gathered(spark, rows, cuts)
    want = logs.record_texts(logs.assemble_records(spark.createDataFrame(rows, SCHEMA).drop("read_at"))).select(*have.columns)
    assert have.exceptAll(want).isEmpty() and want.exceptAll(have).isEmpty()
    # the last record of each file is open until the timer ends it
    assert have.count() - before == 4


def test_an_idle_record_is_closed_by_its_timer(spark):
    """A silent file's record ends while other files go on, without a closing row."""
    at = lambda s: START + timedelta(seconds=s)
    rows = [("quiet", 1, "[one", at(0)), ("quiet", 2, "more", at(1))]
    rows += [("busy", i, f"[{i}", at(10 + i * 30)) for i in range(40)]
    source = feed(spark, rows, [2, 22, 40])
    stream, out = log_records.gather_records(source, "0 seconds", 60), new_folder(spark, "out")
    flows.run_available(stream, out, new_folder(spark, "offsets"))
    quiet = spark.read.parquet(out).where("path = 'quiet'").collect()
    assert [(r.record_no, r.first_line, r.lines, r.message) for r in quiet] == [(1, 1, 2, "[one\nmore")]


@pytest.mark.parametrize("cuts", CUTS)
def test_routes_equal_the_batch(spark, lines, cuts):
    rows = mixed(lines)
    stream, out = log_records.routed(feed(spark, rows, cuts).drop("read_at")), new_folder(spark, "routes")
    log_records.run_routed(stream, out, new_folder(spark, "offsets"))
    want = log_records.routed(spark.createDataFrame(rows, SCHEMA).drop("read_at"))
    for route in (log_records.PARSED, log_records.FAILED):
        have = log_records.read_route(spark, out, route, stream.schema)
        mine = want.where(F.col("route") == route).select(*have.columns)
        assert have.count() > 0 and have.exceptAll(mine).isEmpty() and mine.exceptAll(have).isEmpty()


def test_a_replayed_batch_adds_nothing(spark, lines):
    rows = mixed(lines)
    stream = log_records.routed(feed(spark, rows, [100, 200, 300]).drop("read_at"))
    out, offsets = new_folder(spark, "routes"), new_folder(spark, "offsets")

    def total():
        return {r: log_records.read_route(spark, out, r, stream.schema).count() for r in (log_records.PARSED, log_records.FAILED)}

    log_records.run_routed(stream, out, offsets)
    before = total()
    # the last micro-batch was written, but its commit is lost: it runs again
    commits = [n for n in files.children(spark, f"{offsets}/commits") if n.isdigit()]
    files.remove(spark, f"{offsets}/commits/{max(commits, key=int)}")
    again = []

    def write(batch, batch_id, folder):
        again.append(batch_id)
        log_records.write_batch(batch, batch_id, folder)

    log_records.run_routed(stream, out, offsets, write)
    assert max(map(int, commits)) in again and total() == before


def test_a_stream_goes_on_where_it_ended(spark, lines):
    """State outlives the query: the second start numbers on from the first."""
    rows = mixed(lines)
    folder, out, offsets = (new_folder(spark, n) for n in ("lines", "out", "offsets"))
    schema = spark.createDataFrame([], SCHEMA).schema
    for part in (rows[:333], rows[333:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        stream = log_records.number_lines(flows.file_stream(spark, folder, schema, files_per_batch=1))
        flows.run_available(stream, out, offsets)
    want = logs.assemble_records(spark.createDataFrame(rows, SCHEMA).drop("read_at"))
    assert spark.read.parquet(out).select(*want.columns).exceptAll(want).isEmpty() and spark.read.parquet(out).count() == len(rows)


def test_records_need_no_setting_of_the_session(spark, lines):
    """Spark's default state provider has no column families; a session that kept it could not start these streams."""
    rows, before = mixed(lines), spark.conf.get(flows.PROVIDER)
    spark.conf.set(flows.PROVIDER, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")
    try:
        stream, out = log_records.number_lines(feed(spark, rows, [300])), new_folder(spark, "out")
        flows.run_available(stream, out, new_folder(spark, "offsets"))
        have, _ = gathered(spark, rows, [300])
        assert spark.read.parquet(out).count() == len(rows) and have.count() > 0
        assert spark.conf.get(flows.PROVIDER).endswith("HDFSBackedStateStoreProvider")
    finally:
        spark.conf.set(flows.PROVIDER, before)


def test_lines_behind_the_watermark_are_kept(spark):
    """A file whose times start again, as copied ones do, loses no line, and its open record is not cut."""
    at = lambda s: START + timedelta(seconds=s)
    rows = [("a", 1, "[one", at(50_000)), ("a", 2, "[two", at(50_001)), ("a", 3, "more", at(5)), ("a", 4, "still", at(6)), ("a", 5, "[x", at(7))]
    have, _ = gathered(spark, rows[:4] + [(*rows[4][:3], at(50_002))], [2, 3, 4])
    assert sorted((r.record_no, r.first_line, r.lines, r.message) for r in have.collect()) == [(1, 1, 1, "[one"), (2, 2, 3, "[two\nmore\nstill"), (3, 5, 1, "[x")]


def test_parts_are_written_by_many_tasks(spark):
    rows = spark.range(1000).withColumn("line_no", F.col("id")).repartition(4)
    sizes = []
    for folder in log_records.cut(rows, F.col("line_no"), 3):
        sizes.append((spark.read.parquet(folder).count(), len(spark.read.parquet(folder).inputFiles())))
    assert [n for n, _ in sizes] == [334, 668, 1000] and all(f > i for i, (_, f) in enumerate(sizes, 1))


class Counted:
    """A state value or list in memory that counts its calls."""

    def __init__(self, calls):
        self.calls, self.kept = calls, None

    def exists(self):
        return self.kept is not None

    def get(self):
        self.calls.append("get")
        return iter(()) if self.kept is None else self.kept

    def update(self, value):
        self.calls.append("update")
        self.kept = value

    def put(self, rows):
        self.calls.append("put")
        self.kept = list(rows)

    def appendList(self, rows):
        self.calls.append("append")
        self.kept = [*(self.kept or []), *rows]

    def clear(self):
        self.calls.append("clear")
        self.kept = None


class Handle:
    """What a processor asks Spark for, without Spark."""

    def __init__(self):
        self.calls = []

    def getValueState(self, name, schema):
        return Counted(self.calls)

    getListState = getValueState

    def registerTimer(self, at):
        self.calls.append("timer")

    deleteTimer = registerTimer

    def getCurrentWatermarkInMs(self):
        return 0


def test_records_within_a_batch_cost_no_state(monkeypatch):
    """Calls to the state and frames given out per file and micro-batch don't grow with the records, and frames are bounded."""
    for records, bound in ((10, 1), (3000, 1), (3000, 4)):
        monkeypatch.setattr(log_records, "FRAME_RECORDS", 10_000 if bound == 1 else 1000)
        handle, processor = Handle(), log_records.RecordGathering(600)
        processor.init(handle)
        lines = [(i, f"[{i}" if i % 2 else f"more {i}", START) for i in range(1, 2 * records + 1)]
        found = pd.DataFrame(lines, columns=["line_no", "line", "read_at"])
        out = list(processor.handleInputRows(("a",), iter([found[5:], found[:5]]), handle))
        assert len(out) <= bound and len(handle.calls) < 10
        have = [tuple(r) for r in pd.concat(out).itertuples(index=False)]
        # the last record is open
        assert have == [("a", n, 2 * n - 1, 2, f"[{2 * n - 1}\nmore {2 * n}") for n in range(1, records)]


def test_records_cut_anywhere_equal_whole_ones():
    draw = random.Random(5)
    texts = [draw.choice(["[a", "[b", "more", "", None]) for _ in range(200)]
    lines = pd.DataFrame([(i, text, START) for i, text in enumerate(texts)], columns=["line_no", "line", "read_at"])
    want, number = {}, 0
    for i, text in enumerate(texts):
        number += (text or "").startswith("[")
        want.setdefault(number, []).append((i, text))
    want = [("a", n, x[0][0], len(x), "\n".join(t for _, t in x if t is not None)) for n, x in want.items()]
    for _ in range(50):
        cuts = sorted({0, len(texts), *draw.choices(range(len(texts)), k=draw.randrange(30))})
        handle, processor = Handle(), log_records.RecordGathering(600)
        processor.init(handle)
        out = [f for a, b in zip(cuts, cuts[1:]) for f in processor.handleInputRows(("a",), iter([lines[a:b]]), handle)]
        out += processor.handleExpiredTimer(("a",), handle, None)
        assert [tuple(r) for r in pd.concat(out).itertuples(index=False)] == want
