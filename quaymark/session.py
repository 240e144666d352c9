"""Session defaults and the shared work folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}
_shared_folders: set[str] = set()
_scratch = threading.local()


def build_session(app: str = "quaymark", **conf: object) -> SparkSession:
    """A session with the settings the operators assume; any of them can be overridden."""
    settings: dict[str, object] = {
        "spark.sql.adaptive.enabled": True,
        "spark.sql.adaptive.skewJoin.enabled": True,
        "spark.sql.adaptive.forceOptimizeSkewedJoin": True,
        "spark.sql.session.timeZone": "UTC",
        # tables that are built side by side share the cluster
        "spark.scheduler.mode": "FAIR",
        # streaming state on disk, not on the heap
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    for key, value in settings.items():
        text = str(value).lower() if isinstance(value, bool) else str(value)
        builder = builder.config(key, text)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """Folder for written intermediates: the cluster's checkpoint folder.

    Only a local-mode session may fall back to a temporary folder, because there the driver and the
    executors are one machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    app_id = spark.sparkContext.applicationId
    if shared:
        folder = f"{shared.rstrip('/')}/quaymark/{app_id}"
        if folder not in _shared_folders:
            _shared_folders.add(folder)
            atexit.register(remove_folder, spark, folder)
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    if app_id not in _local_folders:
        folder = tempfile.mkdtemp(prefix="quaymark-")
        _local_folders[app_id] = folder
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return _local_folders[app_id]


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete an application's own scratch folder through the file system that holds it.

    Runs when the driver's Python ends; a session that was stopped before leaves the folder behind.
    """
    if spark.sparkContext._jsc is None or spark.sparkContext._jsc.sc().isStopped():
        return
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{workspace(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    The copy survives the loss of executors, and later steps see exactly the rows that were written.
    """
    path = new_folder(df.sparkSession, label)
    if getattr(_scratch, "paths", None) is not None:
        _scratch.paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what `stage` writes inside, in this thread: for steps that have written their result by then."""
    outer = getattr(_scratch, "paths", None)
    _scratch.paths = []
    try:
        yield
    finally:
        made, _scratch.paths = _scratch.paths, outer
        for path in made:
            remove_folder(spark, path)


def unstage(df: DataFrame) -> None:
    """Delete the copy behind a frame that `stage` returned, once nothing reads it any more."""
    spark = df.sparkSession
    found = df.inputFiles()
    if found:
        folder = found[0].rsplit("/", 1)[0]
        if f"/{workspace(spark).rstrip('/').rsplit('/', 1)[-1]}/" not in folder:
            raise ValueError(f"{folder} is not a staged copy")
        remove_folder(spark, folder)
