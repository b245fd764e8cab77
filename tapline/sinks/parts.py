"""A sink whose manifest comes from the write itself.

Each task writes one part and reports its name, rows, bytes and CRC-32 in its commit message; the commit moves the parts
of the attempts that count into place and writes ``_parts.json``. So the manifest needs no second look at the data, a
retried or speculative attempt counts once, and a reader can tell a damaged, a missing or a foreign part.

Parts are written through ``pyarrow``'s file systems (local, HDFS and the common object stores) by Python workers:
Arrow batches in, files out.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..errors import OutputError
from .formats import by_position, delimited_lines, ndjson_lines, normalize_format, parquet_values

MANIFEST = "_parts.json"
FORMAT = "tapline_parts"
#: Bytes of a part that are looked at together when it is verified.
BLOCK_BYTES = 1 << 22


@dataclass
class Part(WriterCommitMessage):
    """One part as its task wrote it; ``staged`` is where, and empty for a task without rows."""

    name: str
    rows: int
    bytes: int
    crc32: int
    staged: str


def _file_system(path: str):
    """The file system of a path and the path within it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


class _Checked:
    """A file that counts and sums the bytes written to it."""

    def __init__(self, stream):
        self.stream, self.bytes, self.crc32, self.closed = stream, 0, 0, False

    def write(self, data) -> int:
        data = bytes(data)
        self.bytes += len(data)
        self.crc32 = zlib.crc32(data, self.crc32)
        self.stream.write(data)
        return len(data)

    def flush(self) -> None:
        self.stream.flush()

    def close(self) -> None:
        if not self.closed:
            self.closed = True
            self.stream.close()


class PartsWriter(DataSourceArrowWriter):
    """Writes Arrow batches as Parquet, or the texts of a single column as lines with ``head`` before the first."""

    def __init__(self, options: dict):
        self.path, self.kind = options["path"].rstrip("/"), options["kind"]
        self.separator, self.head = options.get("separator", "\n"), options.get("head", "")
        self.codec, self.token = options.get("codec", "snappy"), options["token"]
        self.stage = f"{self.path}/_stage-{self.token}"

    def write(self, iterator) -> Part:
        from pyspark import TaskContext

        task = TaskContext.get()
        ending = "parquet" if self.kind == "parquet" else "txt"
        name = f"part-{task.partitionId():05d}-{self.token}.{ending}"
        staged = f"{self.stage}/{name}.{task.taskAttemptId()}"
        fs, where = _file_system(staged)
        out, rows, writer = None, 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                fs.create_dir(where.rpartition("/")[0], recursive=True)
                out = _Checked(fs.open_output_stream(where))
                if self.kind != "parquet" and self.head:
                    out.write(self.head.encode("utf-8"))
            rows += batch.num_rows
            writer = self._rows(batch, out, writer)
        if writer is not None:
            writer.close()
        if out is None:
            return Part(name, 0, 0, 0, "")
        out.close()
        return Part(name, rows, out.bytes, out.crc32, staged)

    def _rows(self, batch, out: _Checked, writer):
        import pyarrow as pa
        import pyarrow.compute as pc

        if self.kind == "parquet":
            import pyarrow.parquet as pq

            writer = writer or pq.ParquetWriter(pa.PythonFile(out, mode="w"), batch.schema, compression=self.codec)
            writer.write_batch(batch)
            return writer
        column = batch.column(0).cast(pa.large_string())
        none, separator = (pa.scalar(x, pa.large_string()) for x in ("", self.separator))
        lines = pc.binary_join_element_wise(column, none, separator)         # each line with its separator
        _, offsets, data = lines.buffers()
        begin, end = (int.from_bytes(offsets.slice(8 * (lines.offset + k), 8).to_pybytes(), "little") for k in (0, len(lines)))
        out.write(data.slice(begin, end - begin))
        return None

    def commit(self, messages) -> None:
        """Move the parts of the attempts that count into place; what other attempts left goes with the stage."""
        fs, where = _file_system(self.path)
        parts = sorted((m for m in messages if m is not None and m.rows), key=lambda m: m.name)
        fs.create_dir(where, recursive=True)
        for part in parts:
            fs.move(_file_system(part.staged)[1], f"{where}/{part.name}")
        listed = [{k: v for k, v in asdict(p).items() if k != "staged"} for p in parts]
        with fs.open_output_stream(f"{where}/{MANIFEST}") as out:
            out.write(json.dumps({"rows": sum(p.rows for p in parts), "bytes": sum(p.bytes for p in parts), "parts": listed},
                                 indent=1).encode("utf-8"))
        self._drop_stage()

    def abort(self, messages) -> None:
        self._drop_stage()

    def _drop_stage(self) -> None:
        from pyarrow import fs as arrow_fs

        fs, where = _file_system(self.stage)
        if fs.get_file_info(where).type != arrow_fs.FileType.NotFound:
            fs.delete_dir(where)


class PartsSource(DataSource):
    """The data source that :func:`write_parts` writes with."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return "value string"

    def writer(self, schema, overwrite: bool) -> PartsWriter:
        return PartsWriter(dict(self.options))


def write_parts(df: DataFrame, path: str, fmt: str, header: bool = True, null_value: str = "",
                compression: str = "snappy", canonical_types: bool = False) -> dict:
    """Write ``df`` as NDJSON, CSV, TSV or Parquet parts with the sink's value rules; the manifest of its parts.

    The folder must not hold a manifest already. Empty partitions make no part.
    """
    fmt, spark = normalize_format(fmt), df.sparkSession
    if fmt == "json":
        raise OutputError("A JSON array is not written in parts with a manifest; use ndjson.")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, MANIFEST)):
        raise OutputError(f"Output already exists: {path}.")
    options = {"path": path, "kind": fmt, "token": uuid.uuid4().hex[:12]}
    if fmt == "parquet":
        out, options["codec"] = parquet_values(df, canonical_types), compression.lower().replace("uncompressed", "none")
    elif fmt == "ndjson":
        out = ndjson_lines(df)
    else:
        sep = "," if fmt == "csv" else "\t"
        out, head = delimited_lines(df, sep, header, null_value, pieces=True)
        options |= {"separator": "\r\n", "head": head + "\r\n" if header else ""}
    spark.dataSource.register(PartsSource)
    stage = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target, f"_stage-{options['token']}")
    try:
        out.write.format(FORMAT).options(**options).mode("append").save()
    except Exception:
        for _ in range(10):                                  # tasks that are being stopped may still write a little
            fs.delete(stage, True)
            time.sleep(0.2)
        raise
    return read_manifest(spark, path)


def read_manifest(spark: SparkSession, path: str) -> dict:
    """The manifest that a write left: rows and bytes of all parts, and each part's name, rows, bytes and crc32."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path, MANIFEST)   # Spark's readers pass over names that begin with "_"
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        raise OutputError(f"There is no manifest of parts in {path}.")
    stream = fs.open(target)
    try:
        return json.loads(str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
    finally:
        stream.close()


def part_frame(spark: SparkSession, manifest: dict) -> DataFrame:
    """One row a part."""
    return spark.createDataFrame([(p["name"], p["rows"], p["bytes"], p["crc32"]) for p in manifest["parts"]],
                                 "name string, rows long, bytes long, crc32 long")


def _sums(files: DataFrame, path: str) -> DataFrame:
    """(``path``, ``length``, ``sum``): the CRC-32 of each of the listed files."""
    import pyarrow as pa

    try:
        _file_system(path)
    except (pa.ArrowInvalid, OSError):                       # a store that only Spark's reader opens: whole files, to 2 GB
        return files.select("path", "length", F.crc32("content").alias("sum"))

    def run(batches):
        for batch in batches:
            sums = []
            for name in batch.column(0).to_pylist():
                fs, where = _file_system(name)
                crc32 = 0
                with fs.open_input_stream(where) as stream:
                    while data := stream.read(BLOCK_BYTES):
                        crc32 = zlib.crc32(data, crc32)
                sums.append(crc32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=["path", "length", "sum"])

    return files.select("path", "length").mapInArrow(run, "path string, length long, sum long")


def damaged_parts(spark: SparkSession, path: str) -> DataFrame:
    """(``name``, ``problem``): parts whose bytes differ from the manifest, that are missing, or that it does not know.

    Spark lists the parts and deals them to tasks, which read them in blocks, as they were written; rows are not
    decoded. In a store that only Spark's reader opens a part is read whole (2 GB at the most).
    """
    listed = part_frame(spark, read_manifest(spark, path))
    files = _sums(spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path), path).select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("found_bytes"),
        F.col("sum").alias("found_crc32"))
    both = listed.join(files, "name", "full")
    problem = (F.when(F.col("found_bytes").isNull(), "missing").when(F.col("bytes").isNull(), "not in the manifest")
               .when(F.col("bytes") != F.col("found_bytes"), "length").when(F.col("crc32") != F.col("found_crc32"), "bytes"))
    return both.select("name", problem.alias("problem")).filter("problem is not null")
