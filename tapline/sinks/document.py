"""One ordered file, written by many tasks.

Tasks write pieces: the finished lines of their part of the rows, each with its separator behind it and none with the
document's head. The pieces, in the order of their parts, are then joined as bytes; no row passes through the driver or
through one task. A file system that can join files (``concat``) does it without reading them; elsewhere their bytes
are streamed into the file. Lengths decide the rest: empty pieces are left out, and the last piece loses the
separator behind its last line when the document closes with something else.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from ..errors import OutputError


@dataclass(frozen=True)
class Layout:
    """What stands around the lines of a document."""

    separator: str                    # behind each line
    head: str = ""
    tail: str = ""                    # behind the last line
    closing: bool = False             # whether ``tail`` takes the place of the last separator
    empty: str | None = ""            # a document without lines; None: no file


def write_document(lines: DataFrame, path: str, layout: Layout, mode: str = "errorifexists",
                   compression: str | None = None) -> None:
    """Write a one-column frame of lines as one file in the folder ``path``, in the order of the frame's partitions."""
    spark = lines.sparkSession
    folder, fs, jvm = _open(spark, path)
    if mode == "errorifexists" and fs.exists(folder):
        raise OutputError(f"Output already exists: {path} (use overwrite).")
    token = uuid.uuid4().hex[:12]
    pieces = f"{path.rstrip('/')}/_pieces-{token}"          # hidden from readers of the folder
    try:
        writer = lines.write.option("lineSep", layout.separator).option("maxRecordsPerFile", 0)
        if compression:
            if layout.head or layout.tail:
                raise OutputError("A document with a head or an end is not compressed piece by piece.")
            writer = writer.option("compression", compression)
        writer.text(pieces)
        found = list_pieces(fs, jvm.org.apache.hadoop.fs.Path(pieces))
        ending = re.search(r"(\.[a-z0-9.]+)?$", found[0][0].getName().split("-c000")[-1]).group(0) if found else ".txt"
        target = jvm.org.apache.hadoop.fs.Path(f"{pieces}/document")
        join_pieces(spark, fs, [p for p in found if p[1]], target, layout)
        if fs.exists(target) and not fs.rename(target, jvm.org.apache.hadoop.fs.Path(folder, f"part-00000-{token}{ending}")):
            raise OutputError(f"Could not publish the document in {path}.")
    finally:
        fs.delete(jvm.org.apache.hadoop.fs.Path(pieces), True)


def list_pieces(fs, folder) -> list[tuple]:
    """(path, length) of the part files of a folder in the order of their parts."""
    found = [s for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    number = lambda s: int(re.match(r"part-(\d+)", s.getPath().getName()).group(1))
    return [(s.getPath(), int(s.getLen())) for s in sorted(found, key=number)]


def join_pieces(spark: SparkSession, fs, pieces: list[tuple], target, layout: Layout) -> None:
    """Make ``target`` of the head, the pieces (none of them empty) and the tail."""
    if not pieces:
        if layout.empty is not None:
            _write(fs, target, [layout.empty.encode("utf-8")])
        return
    drop = len(layout.separator.encode("utf-8")) if layout.closing else 0
    head, tail = layout.head.encode("utf-8"), layout.tail.encode("utf-8")
    if not _concatenated(spark, fs, pieces, target, head, tail, drop):
        _write(fs, target, [head, *pieces[:-1], (pieces[-1][0], pieces[-1][1] - drop), tail])


def _concatenated(spark: SparkSession, fs, pieces: list[tuple], target, head: bytes, tail: bytes, drop: int) -> bool:
    """Join by the file system, which moves blocks and no bytes; only the head, and a last piece that loses its
    separator, are written anew. False if it cannot join files."""
    jvm, folder = spark.sparkContext._jvm, target.getParent()
    rest = list(pieces)
    if head:
        _write(fs, target, [head])
    else:
        first = rest.pop(0) if len(rest) > 1 else None
        if first is None:
            return False
        if not fs.rename(first[0], target):
            raise OutputError(f"Could not move the first piece to {target.toString()}.")
    if drop or tail:
        last = rest.pop()
        end = jvm.org.apache.hadoop.fs.Path(folder, "end")
        _write(fs, end, [(last[0], last[1] - drop), tail])
        rest.append((end, 0))
    sources = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(rest))
    for k, (path, _) in enumerate(rest):
        sources[k] = path
    try:
        fs.concat(target, sources)
        return True
    except (Py4JJavaError, PySparkException) as exc:         # PySpark has a class of its own for some of the JVM's
        if "UnsupportedOperation" not in f"{type(exc).__name__}: {exc}":
            raise
    if not head:
        fs.rename(target, first[0])                          # back to where it was
    return False


def _write(fs, target, parts: list) -> None:
    """Write bytes, and the first bytes of files given as (path, length), one after the other."""
    stream = fs.create(target, True)
    try:
        for part in parts:
            if isinstance(part, bytes):
                if part:
                    stream.write(bytearray(part))
            elif part[1] > 0:
                source = fs.open(part[0])
                try:
                    _copy(source, stream, part[1])
                finally:
                    source.close()
    finally:
        stream.close()


def _copy(source, stream, length: int) -> None:
    """Copy ``length`` bytes between two streams, in the JVM."""
    jvm = SparkSession.active().sparkContext._jvm
    done = jvm.org.apache.commons.io.IOUtils.copyLarge(source, stream, 0, length)
    if done != length:
        raise OutputError(f"A piece of the document has {done} bytes instead of {length}.")


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm
