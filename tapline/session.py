"""Session helpers: a sane local session for tests and a shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

from .errors import TaplineError

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # wide exports (hundreds of columns) stay in whole-stage codegen; Spark still falls back
    # by itself if a generated method grows too large
    "spark.sql.codegen.maxFields": "1000",
}


def build_session(master: str | None = None, app_name: str = "tapline",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """Return a session with the defaults the library expects.

    On a cluster, pass ``master=None`` and let spark-submit decide; in tests use ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session's configuration, else from the context's checkpoint folder. Only when
    neither is set and the master is local (tests) a folder under the system temp dir is made and
    registered as the context's checkpoint folder, so every later call agrees on it. On a cluster a
    machine's own folder is not shared, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise TaplineError("Set spark.checkpoint.dir to a folder that the driver and all executors share.")
    local = tempfile.mkdtemp(prefix="tapline-")
    spark.sparkContext.setCheckpointDir(local)
    return (spark.sparkContext.getCheckpointDir() or local).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below :func:`shared_dir` (not created)."""
    return f"{shared_dir(spark)}/tapline-{label}-{uuid.uuid4().hex[:12]}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete what is at a path of :func:`scratch_path`; other paths are refused."""
    if not path.startswith(f"{shared_dir(spark)}/tapline-") or "/" in path.removeprefix(f"{shared_dir(spark)}/"):
        raise TaplineError(f"Not a scratch path of this session: {path}.")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


_held_lock = threading.Lock()
_held: dict[tuple[int, str], tuple[int, str | None]] = {}


@contextmanager
def held_setting(spark: SparkSession, key: str, value: str):
    """A setting while any thread of the session needs it: the setting is the session's, so the first to come sets it
    and the last to go restores it."""
    own = (id(spark), key)
    with _held_lock:
        users, before = _held.get(own, (0, None))
        if not users:
            before = spark.conf.get(key, None)
            spark.conf.set(key, value)
        _held[own] = (users + 1, before)
    try:
        yield
    finally:
        with _held_lock:
            users, before = _held.pop(own)
            if users > 1:
                _held[own] = (users - 1, before)
            elif before is not None:
                spark.conf.set(key, before)
            else:
                spark.conf.unset(key)


def shuffles_freed(spark: SparkSession):
    """Shuffle files of the queries planned and run here go when their query ends, not when the driver next collects
    its garbage. Frames that run here should not be run again later."""
    return held_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
