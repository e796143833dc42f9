"""Session defaults, the shared work folder, and what keeps the disk clear."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}

#: How feeds and stored tables are written: images and rows in JSON and Parquet take about half of what they take by default.
COMPRESSED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1"}

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleared: dict[str, tuple[int, str | None]] = {}  # by session: how many are inside, and the setting before
_lock = threading.Lock()


def build_session(app: str = "rowflow", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the defaults above; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder: on a cluster the
    executors would each write their own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="rowflow-")
        atexit.register(shutil.rmtree, shared, ignore_errors=True)
    return f"{shared.rstrip('/')}/rowflow-{purpose}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of work files, wherever it lies; none is fine."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Inside, an action's shuffle files go when it ends, where else they stay until the driver collects garbage.

    It holds for frames put together inside; one that is used for a second action shuffles anew.
    """
    session = spark._jsparkSession.sessionUUID()
    with _lock:
        inside, before = _cleared.get(session) or (0, spark.conf.get(_CLEANUP, None))
        _cleared[session] = inside + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _lock:
            inside, before = _cleared.pop(session)
            if inside > 1:
                _cleared[session] = inside - 1, before
            elif before is None:
                spark.conf.unset(_CLEANUP)
            else:
                spark.conf.set(_CLEANUP, before)
