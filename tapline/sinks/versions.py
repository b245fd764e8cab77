"""Versioned publish: immutable version folders, a pointer made by create-if-absent, and a journal.

Below the target:

- ``_versions/<token>/`` holds one version's files; they are never changed once a pointer names them;
- ``_current/<number>`` are the pointers: a small text with the version's token and an end mark. The highest readable
  one is the current version. A pointer is made with create-if-absent, so two publishers never share a number;
- ``_journal/<token>`` is written before a version's data and goes when its pointer stands. What a crash leaves is found
  there: a version that no pointer names is removed with its entry once it is older than the grace time.

A reader follows the pointer once and then reads files that nothing changes. Whatever step a publisher dies at, the
current version is the old one or the whole new one; there is no moment without one.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from ..errors import OutputError

END = "complete"
#: Seconds after which a journal entry without a pointer counts as left by a crash.
GRACE_S = 24 * 3600


@dataclass(frozen=True)
class Version:
    """A published version: its number, its token and the folder that holds its files."""

    number: int
    token: str
    path: str


class _Store:
    """The folders of a versioned output, through the Hadoop ``FileSystem``."""

    def __init__(self, spark: SparkSession, target: str):
        self.spark = spark
        self._Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.target = target.rstrip("/")
        self.fs = self._Path(self.target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, *parts: str):
        return self._Path("/".join([self.target, *parts]))

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def create(self, text: str, *parts: str) -> bool:
        """Make a file with ``text`` if there is none of that name."""
        try:
            stream = self.fs.create(self.path(*parts), False)
        except Py4JJavaError as exc:
            if "AlreadyExists" in str(exc.java_exception) or "already exists" in str(exc.java_exception):
                return False
            raise
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        return True

    def read(self, *parts: str) -> str:
        """A small file's text; empty if it has gone."""
        try:
            stream = self.fs.open(self.path(*parts))
        except Py4JJavaError as exc:
            if "FileNotFound" in str(exc.java_exception):
                return ""
            raise
        try:
            return str(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def pointers(self) -> list[Version]:
        """All readable pointers, the current one first."""
        found = []
        for name in sorted((n for n in self.names("_current") if n.isdigit()), reverse=True):
            lines = self.read("_current", name).split("\n")
            if len(lines) >= 2 and lines[1] == END:          # a pointer whose writer died is none
                found.append(Version(int(name), lines[0], self.path("_versions", lines[0]).toString()))
        return found

    def age(self, *parts: str) -> float | None:
        """Seconds since a file was written; None if it has gone."""
        path = self.path(*parts)
        return time.time() - self.fs.getFileStatus(path).getModificationTime() / 1000 if self.fs.exists(path) else None

    def delete(self, *parts: str) -> None:
        self.fs.delete(self.path(*parts), True)


def current_version(spark: SparkSession, target: str) -> Version | None:
    """The version a reader should read, or None before the first is published."""
    found = _Store(spark, target).pointers()
    return found[0] if found else None


def published_versions(spark: SparkSession, target: str) -> list[Version]:
    """All versions that are kept, the current one first."""
    return _Store(spark, target).pointers()


def read_current(spark: SparkSession, target: str, fmt: str = "parquet", **options):
    """A DataFrame of the current version; it stays on that version while it is read."""
    version = current_version(spark, target)
    if version is None:
        raise OutputError(f"Nothing has been published in {target}.")
    return spark.read.format(fmt).options(**options).load(version.path)


def clean_versions(spark: SparkSession, target: str, keep: int = 2, grace_s: float = GRACE_S) -> list[str]:
    """Remove versions behind the newest ``keep`` and what crashed publishers left; the tokens removed.

    Entries of the journal younger than ``grace_s`` belong to publishers that may still run. Versions are listed
    first, then the journal, then the pointers: a version that was there and whose journal entry has gone since then has
    its pointer by then. A version's pointer goes before its files, so none ever names files that are gone.
    """
    store, removed = _Store(spark, target), []
    tokens, journal = store.names("_versions"), store.names("_journal")
    running = {t for t in journal if (store.age("_journal", t) or 0) < grace_s}
    pointers = store.pointers()
    named, kept = {v.token for v in pointers}, {v.token for v in pointers[:max(1, keep)]}
    for version in pointers[max(1, keep):]:
        store.delete("_current", f"{version.number:012d}")
    for token in tokens:
        if token not in kept and (token in named or token not in running):
            store.delete("_versions", token)
            removed.append(token)
    for token in journal:
        if token in named or token not in running:
            store.delete("_journal", token)
    known, newest = {v.number for v in pointers}, pointers[0].number if pointers else 0
    for name in store.names("_current"):                     # pointers whose writers died, below the current one
        if name.isdigit() and int(name) < newest and int(name) not in known:
            store.delete("_current", name)
    return removed


class VersionedOutput:
    """``with VersionedOutput(spark, target) as folder: write to folder``; ``version`` is set when it is published.

    ``expected`` is the number of the version the new one is made from: if another has been published meanwhile,
    nothing is published and an error raised. Without it the last publisher wins.
    """

    def __init__(self, spark: SparkSession, target: str, keep: int = 2, expected: int | None = None,
                 grace_s: float = GRACE_S):
        self.spark, self.target, self.keep, self.expected, self.grace_s = spark, target, keep, expected, grace_s
        self.store, self.token = _Store(spark, target), uuid.uuid4().hex
        self.version: Version | None = None

    def reached(self, step: str) -> None:
        """Called behind each step of a publish; tests stop a publisher here."""

    def __enter__(self) -> str:
        self.store.create("publishing", "_journal", self.token)
        self.reached("journal")
        return self.store.path("_versions", self.token).toString()

    def __exit__(self, exc_type, exc, tb) -> bool:
        if exc_type is not None:
            if isinstance(exc, Exception):
                self.store.delete("_versions", self.token)
                self.store.delete("_journal", self.token)
            return False
        self.publish()
        return False

    def publish(self) -> None:
        store = self.store
        if not store.fs.exists(store.path("_versions", self.token)):
            raise OutputError("Nothing was written to the version's folder.")
        self.reached("written")
        while True:
            numbers = [int(n) for n in store.names("_current") if n.isdigit()]
            now = store.pointers()
            number = now[0].number if now else 0
            if self.expected is not None and number != self.expected:
                store.delete("_versions", self.token)
                store.delete("_journal", self.token)
                raise OutputError(f"Version {number} of {self.target} was published meanwhile; expected {self.expected}.")
            number = max(numbers, default=0) + 1
            if store.create(f"{self.token}\n{END}\n", "_current", f"{number:012d}"):
                break
        self.version = Version(number, self.token, store.path("_versions", self.token).toString())
        self.reached("pointer")
        store.delete("_journal", self.token)
        self.reached("journal removed")
        clean_versions(self.spark, self.target, self.keep, self.grace_s)
