"""Session settings and the few helpers that depend on the running session."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark import SparkContext
from pyspark.sql import SparkSession

# AQE does three jobs here: it coalesces small shuffle partitions, turns joins
# into broadcasts once a side is measured to be small, and splits the partition
# of a hot join key.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

REMEMBERED = "folioflow.shared.dir"


def build_session(app: str = "folioflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` adds to or overrides them.

    On a cluster leave ``master`` unset, so that spark-submit decides it.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, a local
    master, whose tasks all run on this machine, gets a temporary folder that is
    remembered in the session; any other master is refused, as executors would
    each write to a disk of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(REMEMBERED, None)
    if folder:
        return folder
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    folder = tempfile.mkdtemp(prefix="folioflow-")
    spark.conf.set(REMEMBERED, folder)
    return folder


def new_run_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; nothing is created yet.

    Results may be read from it as long as this process runs. When it ends in
    order, the folder is removed, unless ``folioflow.keep.runs`` is true.
    """
    if not _RUNS:
        atexit.register(remove_run_folders)
    folder = f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if spark.conf.get("folioflow.keep.runs", "false") != "true":
        _RUNS.append(folder)
    return folder


_RUNS: list[str] = []


def remove_run_folders() -> None:
    """Remove the folders of this process's runs; nothing may read them any more."""
    context = SparkContext._active_spark_context
    while context is not None and _RUNS:
        path = context._jvm.org.apache.hadoop.fs.Path(_RUNS.pop())
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
