"""Publish-on-success: write into a hidden sibling folder, then move it onto the target.

A failed job leaves the old target untouched and removes the staging folder. Between the two renames of an
overwrite the target is missing for a moment; a publisher that dies there leaves the old output aside, and the
next one puts it back first (``versions`` has no such moment). Moves go through
the Hadoop ``FileSystem`` of the target path, so the same code works on HDFS, on a local disk and
on object stores (where a folder rename is a copy and not atomic; documented in the README).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..errors import OutputError


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and holds anything."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target) and len(fs.listStatus(target)) > 0


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def part_names(spark: SparkSession, path: str) -> set[str]:
    """Names of the part files in a folder; none if it does not exist."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listStatus(target) if fs.exists(target) else []
    return {s.getPath().getName() for s in found if s.getPath().getName().startswith("part-")}


def drop_empty_parts(spark: SparkSession, path: str, old: set[str] = frozenset()) -> bool:
    """Delete the part files of 0 bytes that tasks without rows leave; whether other part files, not among ``old``,
    are there. A listing of the folder on the driver: names and sizes, never rows.
    """
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    filled = False
    for status in fs.listStatus(target):
        if status.getPath().getName().startswith("part-") and status.getPath().getName() not in old:
            if status.getLen():
                filled = True
            else:
                fs.delete(status.getPath(), False)
    return filled


def move_over(spark: SparkSession, source, target) -> None:
    """Rename a file over another in one step, as HDFS and local disks do; on other file systems the old one goes first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    try:
        where = fs.makeQualified(target)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), conf).rename(fs.makeQualified(source), where, options)
    except Py4JJavaError as exc:
        if "UnsupportedFileSystemException" not in str(exc.java_exception):
            raise
        fs.delete(target, False)
        if not fs.rename(source, target):
            raise OutputError(f"Could not publish the file {target.toString()}.") from None


class ReplacedInPlace:
    """``with ReplacedInPlace(spark, target): append to target``: overwriting without a staging folder.

    The job adds its files beside the old ones through Spark's commit protocol; the old ones go only after
    the job has committed. A failing job leaves the old output as it was.
    """

    def __init__(self, spark: SparkSession, target: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
        self._fs = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def __enter__(self):
        self._old = [s.getPath() for s in self._fs.listStatus(self._path)] if self._fs.exists(self._path) else []

    def __exit__(self, exc_type, exc, tb) -> bool:
        if exc_type is None:
            for path in self._old:
                if path.getName() != "_SUCCESS":
                    self._fs.delete(path, True)
        return False


class StagedOutput:
    """``with StagedOutput(spark, target, overwrite) as stage: write to stage``; one publisher of a target at a time."""

    def __init__(self, spark: SparkSession, target: str, overwrite: bool = False):
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._Path = jvm.org.apache.hadoop.fs.Path
        self.target = self._Path(target)
        self.fs = self.target.getFileSystem(conf)
        self.overwrite = overwrite
        parent = self.target.getParent()
        token = uuid.uuid4().hex[:12]
        self.stage = self._Path(parent, f".{self.target.getName()}.{token}.tmp")
        self.retired = self._Path(parent, f".{self.target.getName()}.{token}.old")

    def check(self) -> None:
        """The overwrite guard: an existing target is an error unless overwrite is on."""
        if self.fs.exists(self.target) and not self.overwrite:
            raise OutputError(f"Output already exists: {self.target.toString()} (use overwrite).")

    @property
    def stage_path(self) -> str:
        return self.stage.toString()

    def recover(self) -> None:
        """Put back an old output that a publisher left aside when it died between its two renames."""
        parent, name = self.target.getParent(), self.target.getName()
        if parent is None or not self.fs.exists(parent):
            return
        aside = [s.getPath() for s in self.fs.listStatus(parent)
                 if s.getPath().getName().startswith(f".{name}.") and s.getPath().getName().endswith(".old")]
        if aside and not self.fs.exists(self.target):
            newest = max(aside, key=lambda p: self.fs.getFileStatus(p).getModificationTime())
            self.fs.rename(newest, self.target)
            aside.remove(newest)
        for path in aside:                                   # the new output stands: its publisher died before this
            self._delete(path)

    def __enter__(self) -> str:
        self.recover()
        self.check()
        parent = self.target.getParent()
        if parent is not None and not self.fs.exists(parent):
            self.fs.mkdirs(parent)
        return self.stage_path

    def __exit__(self, exc_type, exc, tb) -> bool:
        if exc_type is not None:
            self._delete(self.stage)
            return False
        self.publish()
        return False

    def publish(self) -> None:
        if not self.fs.exists(self.stage):
            raise OutputError("Nothing was written to the staging folder.")
        moved_old = False
        if self.fs.exists(self.target):
            if not self.overwrite:
                self._delete(self.stage)
                raise OutputError(f"Output already exists: {self.target.toString()} (use overwrite).")
            if not self.fs.rename(self.target, self.retired):
                self._delete(self.stage)
                raise OutputError(f"Could not move the old output aside: {self.target.toString()}.")
            moved_old = True
        if not self.fs.rename(self.stage, self.target):
            if moved_old:
                self.fs.rename(self.retired, self.target)
            self._delete(self.stage)
            raise OutputError(f"Could not publish the output to {self.target.toString()}.")
        if moved_old:
            self._delete(self.retired)

    def _delete(self, path) -> None:
        try:
            if self.fs.exists(path):
                self.fs.delete(path, True)
        except Exception:  # best effort cleanup
            pass
