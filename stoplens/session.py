"""Session settings and scratch locations shared by every job."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Keyed state grows with the passages seen, beyond the heap; RocksDB keeps it on disk.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings every job relies on. Times in the feed carry no zone, so the session
# zone decides what they mean; it is fixed here instead of left to the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    STATE_STORE: ROCKSDB,
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "stoplens",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    time_zone: str = "UTC",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session with the settings above; ``conf`` adds to or overrides them.

    ``shuffle_partitions`` should be well above the number of cores on a large
    cluster (AQE merges small partitions in batch). A stream keeps the number
    it was first started with for the life of its checkpoint.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF, **{"spark.sql.session.timeZone": time_zone})
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    Executors must all see it, so a machine-local folder is used only when the
    setting is missing and the master is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/stoplens-{label}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Give this package to Python workers that would not find it, once per application.

    They find it where the driver runs in its folder or has it on PYTHONPATH.
    """
    package = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package)
    found = {os.path.abspath(x) for x in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if x}
    context = spark.sparkContext
    if root in found or getattr(context, "_has_stoplens", False):
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/stoplens", "zip", root, os.path.basename(package))
    context.addPyFile(archive)
    context._has_stoplens = True
