"""One run over whole layers: every table built once from the tables committed before it.

A table names the tables it needs. Tables that need nothing unfinished run side by side, each in a fair pool of its own. A
table is committed by a small manifest that is put in place after its files are written, so a run that is started again
under the same name keeps what is committed and builds the rest. Rows a table rejects go to its quarantine folder with
their reasons. What a failure does is the layer's rule: bronze and gold go on with the tables that don't need the failed
one, silver starts nothing more; after a layer with a failure no later layer runs.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from contextlib import contextmanager
from dataclasses import asdict, dataclass, replace

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import scratch
from ..sources import files, readers
from .layers import LayerFailed

CONTINUE, STOP = "continue", "stop"
RULES = {"bronze": CONTINUE, "silver": STOP, "gold": CONTINUE}
WORKERS = 4

SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("quarantined", T.LongType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("error", T.StringType()),
        T.StructField("resumed", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Commit:
    """Where a committed table is and what it holds."""

    path: str
    schema: str
    row_count: int
    fmt: str = "parquet"
    options: Mapping[str, str] | None = None
    quarantine: str | None = None
    quarantined: int = 0


@dataclass(frozen=True)
class Table:
    """A table of a layer. `build` gets a reader of committed tables.

    It returns the table's rows, or (rows, rejected rows), or a Commit if it has written the table itself.
    """

    layer: str
    name: str
    build: Callable[["Run"], DataFrame | tuple[DataFrame, DataFrame] | Commit]
    needs: tuple[str, ...] = ()

    @property
    def full_name(self) -> str:
        return f"{self.layer}.{self.name}"


class Run:
    """A run's folder: reads committed tables, commits new ones.

    With a database, committed tables are registered there as external tables, under `layer_name`.
    """

    def __init__(self, spark: SparkSession, base: str, run_id: str, catalog: str = "spark_catalog", database: str | None = None):
        readers.require_text(base=base, run_id=run_id)
        self.spark, self.base, self.run_id = spark, base.rstrip("/"), run_id
        self.catalog, self.database = catalog, database

    def _manifest(self, full_name: str) -> str:
        return f"{self.base}/commits/{self.run_id}/{full_name}.json"

    def committed(self, full_name: str) -> Commit | None:
        text = files.read_text(self.spark, self._manifest(full_name))
        return Commit(**json.loads(text)) if text else None

    def _frame(self, commit: Commit, path: str | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(commit.schema))
        return readers.read_path(self.spark, path or commit.path, commit.fmt, schema, **(commit.options or {}))

    def read(self, full_name: str) -> DataFrame:
        found = self.committed(full_name)
        if found is None:
            raise LookupError(f"{full_name} is not committed in run {self.run_id}")
        return self._frame(found)

    def quarantine(self, full_name: str) -> DataFrame | None:
        found = self.committed(full_name)
        return self.spark.read.parquet(found.quarantine) if found and found.quarantine else None

    def existing(self, full_name: str) -> DataFrame | None:
        """The table in the catalog, from whichever run, or None if there is none yet."""
        name = full_name.replace(".", "_")
        if self.database is None or not readers.table_exists(self.spark, self.catalog, self.database, name):
            return None
        return readers.read_table(self.spark, self.catalog, self.database, name)

    def commit(self, full_name: str, made: DataFrame | tuple[DataFrame, DataFrame] | Commit) -> Commit:
        """Write a table's rows and what it rejects, then its manifest: the manifest makes the table."""
        if isinstance(made, Commit):
            done = made
        else:
            rows, rejected = made if isinstance(made, tuple) else (made, None)
            path = f"{self.base}/{full_name.replace('.', '/')}/{self.run_id}-{time.time_ns():x}"
            rows.write.parquet(path)
            done = Commit(path, rows.schema.json(), 0)
            done = replace(done, row_count=self._frame(done).count())
            if rejected is not None:
                aside = f"{self.base}/quarantine/{full_name.replace('.', '/')}/{self.run_id}-{time.time_ns():x}"
                rejected.write.parquet(aside)
                done = replace(done, quarantine=aside, quarantined=self.spark.read.parquet(aside).count())
        files.replace_text(self.spark, self._manifest(full_name), json.dumps(asdict(done)))
        return done

    def register(self, full_name: str) -> None:
        """Name a committed table in the catalog, in place of an older one."""
        found = self.committed(full_name)
        if self.database is None or found.fmt != "parquet":
            return
        name = readers.table_name(self.catalog, self.database, full_name.replace(".", "_"))
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        # the path is a text in SQL
        self.spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{found.path.replace(chr(39), chr(92) + chr(39))}'")

    def listed(self) -> list[str]:
        return readers.list_tables(self.spark, self.catalog, self.database) if self.database else []


def in_order(tables: Sequence[Table]) -> None:
    """Raise unless every needed table is there, no layer needs a later one, and needs make no circle."""
    by_name = {t.full_name: t for t in tables}
    if len(by_name) != len(tables):
        raise ValueError("a table is named twice")
    layers = list(dict.fromkeys(t.layer for t in tables))
    done: set[str] = set()
    for layer in layers:
        left = [t for t in tables if t.layer == layer]
        while left:
            ready = [t for t in left if set(t.needs) <= done]
            if not ready:
                lacking = {t.full_name: sorted(set(t.needs) - done) for t in left}
                raise ValueError(f"tables need each other or tables that are not there: {lacking}")
            done.update(t.full_name for t in ready)
            left = [t for t in left if t.full_name not in done]


@contextmanager
def _brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files are deleted as soon as their query has ended, not when the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _made(run: Run, table: Table) -> tuple[Commit, float]:
    began = time.perf_counter()
    run.spark.sparkContext.setLocalProperty("spark.scheduler.pool", table.full_name)
    with scratch(run.spark):
        done = run.commit(table.full_name, table.build(run))
    return done, time.perf_counter() - began


def run_layers(
    run: Run, tables: Sequence[Table], rules: Mapping[str, str] | None = None, workers: int = WORKERS,
    raise_at_end: bool = True,
) -> DataFrame:
    """Build every table that isn't committed yet; the summary has one row per table, in the given order.

    SUCCESS: committed, now or by an earlier start of this run. FAILED: with its error. SKIPPED: a table it needs has no
    rows to offer. NOT RUN: the run had stopped.
    """
    in_order(tables)
    rules = {**RULES, **(rules or {})}
    rows: dict[str, tuple] = {}
    stopped = False
    for layer in dict.fromkeys(t.layer for t in tables):
        own = [t for t in tables if t.layer == layer]
        if stopped:
            rows |= {t.full_name: (layer, t.name, "NOT RUN", None, None, None, None, False) for t in own}
            continue
        with _brief_shuffles(run.spark):
            rows |= _run_layer(run, own, {n for n, r in rows.items() if r[2] == "SUCCESS"}, rules.get(layer, CONTINUE), workers)
        stopped = any(rows[t.full_name][2] == "FAILED" for t in own)
    summary = run.spark.createDataFrame([rows[t.full_name] for t in tables], SUMMARY_SCHEMA)
    failed = [n for n, r in rows.items() if r[2] == "FAILED"]
    if failed and raise_at_end:
        raise LayerFailed(f"{len(failed)} of {len(tables)} tables failed: {', '.join(failed)}", summary)
    return summary


def _run_layer(run: Run, tables: list[Table], done: set[str], rule: str, workers: int) -> dict[str, tuple]:
    rows: dict[str, tuple] = {}
    waiting = {t.full_name: t for t in tables}
    running: dict[Future, Table] = {}
    halted = False

    def finish(table: Table, commit: Commit, seconds: float | None) -> None:
        run.register(table.full_name)
        done.add(table.full_name)
        rows[table.full_name] = (
            table.layer, table.name, "SUCCESS", commit.row_count, commit.quarantined, seconds, None, seconds is None
        )

    with ThreadPoolExecutor(workers) as pool:
        while waiting or running:
            for name, table in list(waiting.items()):
                lost = [n for n in table.needs if n in rows and rows[n][2] != "SUCCESS"]
                if halted or lost:
                    status = "NOT RUN" if halted else "SKIPPED"
                    rows[name] = (table.layer, table.name, status, None, None, None, f"needs {', '.join(lost)}" if lost else None, False)
                elif set(table.needs) <= done:
                    before = run.committed(name)
                    if before is None:
                        if len(running) == workers:
                            break
                        target = inheritable_thread_target(run.spark)(_made)
                        running[pool.submit(target, run, table)] = table
                    else:
                        finish(table, before, None)
                else:
                    continue
                del waiting[name]
            if not running:
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                table = running.pop(future)
                problem = future.exception()
                if problem is None:
                    finish(table, *future.result())
                else:
                    rows[table.full_name] = (table.layer, table.name, "FAILED", None, None, None, str(problem), False)
                    halted = halted or rule == STOP
    return rows
