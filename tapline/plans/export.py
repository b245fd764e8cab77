"""One-shot export: query -> (pipeline) -> sink, published only when complete.

Plan-building (config, schema, contract) happens on the driver before any row is read; the rows
are read, transformed and written by one Spark job across the executors; the metrics come back
from an ``observe`` on that same job.
"""

from __future__ import annotations

import re
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import OutputError, TaplineError, TransformError
from ..functions.values import redact_text
from ..sinks.formats import (
    write_json_array,
    ndjson_lines,
    normalize_format,
    write_delimited,
    write_parquet,
    write_text_lines,
)
from ..sinks.parts import write_parts
from ..sinks.publish import ReplacedInPlace, StagedOutput, move_over, path_exists
from ..sinks.versions import VersionedOutput
from ..sources.query import cap_rows, jdbc_source, normalize_columns, query_source
from .config import TransformConfig, load_config
from .pipeline import FAIL_MARKER, Pipeline, observed

TOOL = "tapline"


@dataclass
class ExportResult:
    """What an export wrote: rows, columns, timings, pipeline counters and the manifest."""

    output: str
    format: str
    row_count: int
    columns: list[dict]
    started_at: str
    completed_at: str
    duration_ms: int
    metrics: dict = field(default_factory=dict)
    sensitive_columns: list[str] = field(default_factory=list)
    manifest: dict = field(default_factory=dict)
    dry_run: bool = False

    def summary(self) -> str:
        """One line, no row values: rows in/out/dropped and failures per step."""
        m = self.metrics
        if not m:
            return f"{self.row_count} rows written"
        text = f"transforms: {m['rows_in']} in, {m['rows_out']} out, {m['rows_dropped']} dropped"
        for step in m.get("steps", []):
            text += f"; {step['name']}"
            if step["failures"]:
                text += f" ({step['failures']} failed)"
        return text


def _pipeline_from(transforms, inline, error_strategy, registry) -> Pipeline:
    from ..operators.registry import default_registry

    if isinstance(transforms, Pipeline):
        if error_strategy is not None:
            transforms = Pipeline(transforms.steps, error_strategy, transforms.contract)
        return transforms
    if isinstance(transforms, TransformConfig):
        config = transforms
        if inline:
            config = TransformConfig(config.specs + load_config(None, inline).specs, config.error_strategy,
                                     config.contract)
        if error_strategy is not None:
            config = TransformConfig(config.specs, error_strategy, config.contract)
    else:
        config = load_config(transforms, inline, error_strategy)
    return (registry or default_registry()).build(config)


def column_manifest(schema: T.StructType, sensitive: list[str] | None = None) -> list[dict]:
    """Per output column: index, label, output name, type, nullable, precision, scale."""
    out = []
    for i, sf in enumerate(schema.fields, start=1):
        dtype = sf.dataType
        precision = getattr(dtype, "precision", 0) if isinstance(dtype, T.DecimalType) else 0
        scale = getattr(dtype, "scale", 0) if isinstance(dtype, T.DecimalType) else 0
        meta = sf.metadata or {}
        out.append({"index": i, "label": meta.get("label", sf.name), "output_name": sf.name,
                    "type": dtype.simpleString(), "nullable": bool(sf.nullable),
                    "precision": int(precision), "scale": int(scale),
                    "sensitive": bool(meta.get("sensitive")) or sf.name in (sensitive or [])})
    return out


def export(spark: SparkSession, *, output: str, fmt: str, sql: str | None = None, sql_file: str | None = None,
           df: DataFrame | None = None, jdbc: dict | None = None, transforms=None, inline=(),
           error_strategy: str | None = None, registry=None, max_rows: int | None = None,
           overwrite: bool = False, header: bool = True, null_value: str = "", escape_formulas: bool = False,
           bom: bool = False, pretty: bool = False, compression: str = "snappy",
           metadata_path: str | None = None, single_file: bool = False,
           rebalance: bool = False,
           parquet_decimals: dict[str, tuple[int, int]] | None = None,
           dry_run: bool = False, staged: bool = True, versions: int | None = None,
           checked_parts: bool = False) -> ExportResult:
    """Export one query's result to ``output`` in ``fmt`` (json, ndjson, csv, tsv, parquet).

    ``staged``: write into a hidden sibling and rename it onto ``output`` when complete (the
    default; a folder rename is cheap on HDFS and local disks). On an object store, where a
    rename copies every object, pass ``staged=False`` to write straight to ``output`` through
    Spark's commit protocol (use a committer made for the store).

    ``versions``: publish as a new version below ``output`` and keep so many (see ``sinks.versions``); readers follow
    the pointer with ``read_current``. Nothing is ever replaced, so ``overwrite`` is not needed.

    ``checked_parts``: the tasks that write report rows, bytes and CRC-32 of their parts (see ``sinks.parts``); the
    manifest lists them, the rows counted are theirs, and ``damaged_parts`` compares them with what is there. For
    NDJSON, CSV, TSV and Parquet.

    ``rebalance``: ``True`` spreads the source over the cluster before the per-row work (one
    shuffle, partitions sized by AQE; the order of an ORDER BY result is lost). The default ``False``
    keeps the scan's own splits, which at scale already give one task per file block.
    """
    fmt = normalize_format(fmt)
    # Configuration and pipeline are checked before the source is touched.
    pipeline = _pipeline_from(transforms, inline, error_strategy, registry)
    if max_rows is not None and max_rows <= 0:
        raise TaplineError(f"max_rows must be greater than 0, not {max_rows}.")
    if checked_parts and (fmt == "json" or single_file or bom or escape_formulas or pretty or parquet_decimals or not staged):
        raise TaplineError("Checked parts are for staged NDJSON, CSV, TSV and Parquet without further options.")
    if versions is not None:
        if versions < 1 or not staged:
            raise TaplineError("versions must be 1 or more, and is not used with staged=False.")
        publisher = VersionedOutput(spark, output, versions)
    else:
        publisher = StagedOutput(spark, output, overwrite)
        publisher.check()
    if metadata_path and not overwrite and path_exists(spark, metadata_path):
        raise OutputError(f"Metadata file already exists: {metadata_path} (use overwrite).")

    _check_sources(sql, sql_file, df, jdbc)
    if dry_run:  # options, configuration and paths are valid; the source is not touched
        now = datetime.now(timezone.utc).isoformat()
        return ExportResult(output, fmt, 0, [], now, now, 0, dry_run=True)
    source, source_label = _resolve_source(spark, sql, sql_file, df, jdbc)
    source = cap_rows(source, max_rows)
    if rebalance:
        # AQE sizes the partitions (at least 1 MB each, up to one per shuffle partition)
        source = source.hint("rebalance")

    planned = None if pipeline.is_empty() else pipeline.plan(source, observe="stops")
    data = source if planned is None else planned.df
    schema = data.schema
    # where no step can stop a row, the sink counts: rendered lines, or the footers of written Parquet files
    counted = None if planned is not None and planned.stops else Observation()  # (checked parts count themselves)
    replaces = not staged and overwrite
    if counted is not None and fmt == "parquet" and replaces:  # the folder then holds old files too
        data = data.observe(counted, F.count(F.lit(1)).alias("rows_out"))

    started = datetime.now(timezone.utc)
    t0 = time.monotonic()
    rows_written = parts = None
    try:
        if checked_parts:
            with publisher as stage:
                parts = write_parts(data, stage, fmt, header, null_value, compression, canonical_types=planned is not None)
            rows_written = parts["rows"]
        elif staged:
            with publisher as stage:
                write_output(data, stage, fmt, transformed=planned is not None, header=header, null_value=null_value,
                       escape_formulas=escape_formulas, bom=bom, pretty=pretty, compression=compression,
                       single_file=single_file, decimals=parquet_decimals, counted=counted)
                if counted is not None and fmt == "parquet":
                    rows_written = spark.read.parquet(stage).count()  # from the footers
        else:
            with ReplacedInPlace(spark, output):  # the old files go only after the job has committed
                write_output(data, output, fmt, transformed=planned is not None, header=header, null_value=null_value,
                       escape_formulas=escape_formulas, bom=bom, pretty=pretty, compression=compression,
                       single_file=single_file, decimals=parquet_decimals, counted=counted,
                       mode="append" if overwrite else "errorifexists")
            if counted is not None and fmt == "parquet" and not replaces:
                rows_written = spark.read.parquet(output).count()
    except PySparkException as exc:
        raise _numbered(_job_error(exc), planned, jdbc) from None
    except Exception as exc:  # py4j errors from the JVM
        if exc.__class__.__name__ == "Py4JJavaError":
            raise _numbered(_job_error(exc), planned, jdbc) from None
        raise
    duration = int((time.monotonic() - t0) * 1000)
    completed = datetime.now(timezone.utc)

    if counted is not None and rows_written is None:
        rows_written = int(observed(counted).get("rows_out", 0) or 0)
    metrics = {} if planned is None else planned.metrics(rows_written if counted is not None else None)
    rows = rows_written if counted is not None else metrics["rows_out"]
    sensitive = [] if planned is None else planned.sensitive
    columns = column_manifest(schema, sensitive)
    result = ExportResult(output, fmt, rows, columns, started.isoformat(), completed.isoformat(), duration,
                          metrics, sensitive)
    result.manifest = {"tool": TOOL, "format": fmt, "source": source_label, "output": output,
                       "row_count": rows, "started_at": result.started_at,
                       "completed_at": result.completed_at, "duration_ms": duration, "columns": columns,
                       "jdbc_url": source_label if jdbc is not None else None,
                       "sql_source": sql_file if sql_file else ("<inline>" if sql is not None else source_label)}
    if parts is not None:
        result.manifest["parts"] = parts["parts"]
    if metadata_path:
        write_manifest(spark, result.manifest, metadata_path)
    return result


def _check_sources(sql, sql_file, df, jdbc) -> None:
    if jdbc is not None:
        if (sql is None) == (sql_file is None) or df is not None:
            raise TaplineError("A JDBC source needs exactly one of sql or sql_file.")
    elif sum(x is not None for x in (sql, sql_file, df)) != 1:
        raise TaplineError("Provide exactly one source: sql, sql_file, df or jdbc.")


def _resolve_source(spark: SparkSession, sql, sql_file, df, jdbc) -> tuple[DataFrame, str]:
    _check_sources(sql, sql_file, df, jdbc)
    if jdbc is not None:
        return jdbc_source(spark, sql=sql, sql_file=sql_file, **jdbc), redact_text(jdbc.get("url"))
    if df is not None:
        return normalize_columns(df), "dataframe"
    return query_source(spark, sql, sql_file), ("sql-file" if sql_file else "sql")


def describe(spark: SparkSession, *, sql: str | None = None, sql_file: str | None = None,
             df: DataFrame | None = None, jdbc: dict | None = None, transforms=None, inline=(),
             error_strategy: str | None = None, registry=None) -> DataFrame:
    """The output columns of a query (after the pipeline, if any), without running it.

    One row per column: index, label, output name, type, nullable, precision, scale, sensitive.
    Only the schema is resolved (a JDBC source is asked for its result metadata); no row is read.
    """
    pipeline = _pipeline_from(transforms, inline, error_strategy, registry)
    source, _ = _resolve_source(spark, sql, sql_file, df, jdbc)
    schema = source.schema if pipeline.is_empty() else pipeline.output_schema(source)
    columns = column_manifest(schema, pipeline.sensitive_columns())
    return spark.createDataFrame(columns, _COLUMN_TYPE)


def write_output(data: DataFrame, path: str, fmt: str, *, transformed: bool, header: bool, null_value: str,
           escape_formulas: bool, bom: bool, pretty: bool, compression: str, single_file: bool,
           decimals: dict | None = None, mode: str = "errorifexists", counted: Observation | None = None) -> None:
    """Write finished rows with one format's sink."""
    if fmt == "parquet":
        write_parquet(data, path, compression, canonical_types=transformed, single_file=single_file,
                      decimals=decimals, mode=mode)
    elif fmt == "ndjson":
        write_text_lines(ndjson_lines(data), path, single_file, mode=mode, counted=counted)
    elif fmt == "json":
        write_json_array(data, path, pretty, single_file, mode=mode, counted=counted)
    else:
        write_delimited(data, path, sep="," if fmt == "csv" else "\t", header=header, null_value=null_value,
                        escape_formulas=escape_formulas, bom=bom, single_file=single_file, mode=mode, counted=counted)


_MARKER = re.compile(FAIL_MARKER + r": (Transform \"[^\"]*\" failed[^\n]*?\.)(?=\s|$|\")")


def _job_error(exc: Exception) -> TaplineError:
    """A value-free error for a failed job. A row failure under ``fail`` keeps its step text;
    any other message (which may quote row values) is reduced to its error class."""
    text = str(exc)
    found = _MARKER.search(text)
    if found:
        return TransformError(found.group(1))
    cls = None
    if isinstance(exc, PySparkException):
        cls = exc.getCondition() if hasattr(exc, "getCondition") else None
    if cls is None:
        m = re.search(r"\[([A-Z_][A-Z0-9_.]+)\]", text)
        cls = m.group(1) if m else type(exc).__name__
    return OutputError(f"Export job failed ({cls}); no output was published.")


def _numbered(error: TaplineError, planned, jdbc: dict | None) -> TaplineError:
    """A row failure with its row number among all rows, found by a second job. A database is not asked again, since
    it may give its rows in another order: the position in the part has to do there."""
    if not isinstance(error, TransformError) or planned is None or jdbc is not None:
        return error
    try:
        found = planned.first_failure()
    except Exception:  # noqa: BLE001 - the first error is the one to tell of
        return error
    return error if found is None else TransformError(str(found))


_COLUMN_TYPE = T.StructType([
    T.StructField("index", T.IntegerType()), T.StructField("label", T.StringType()),
    T.StructField("output_name", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("nullable", T.BooleanType()), T.StructField("precision", T.IntegerType()),
    T.StructField("scale", T.IntegerType()), T.StructField("sensitive", T.BooleanType())])


def manifest_frame(spark: SparkSession, manifest: dict) -> DataFrame:
    """The manifest as a one-row DataFrame with an array-of-struct ``columns`` field."""
    col_type = _COLUMN_TYPE
    schema = T.StructType([
        T.StructField("tool", T.StringType()), T.StructField("format", T.StringType()),
        T.StructField("source", T.StringType()), T.StructField("output", T.StringType()),
        T.StructField("row_count", T.LongType()), T.StructField("started_at", T.StringType()),
        T.StructField("completed_at", T.StringType()), T.StructField("duration_ms", T.LongType()),
        T.StructField("columns", T.ArrayType(col_type))])
    row = dict(manifest)
    row["source"] = redact_text(row.get("source"))
    row.pop("parts", None)
    return spark.createDataFrame([row], schema)


def sidecar_document(manifest: dict) -> dict:
    """The manifest in the sidecar's JSON layout (field names as the reference writes them)."""
    checked = {"parts": manifest["parts"]} if "parts" in manifest else {}
    return {
        "tool": manifest.get("tool"),
        "format": manifest.get("format"),
        "jdbcUrl": redact_text(manifest.get("jdbc_url")),
        "sqlSource": manifest.get("sql_source"),
        "output": manifest.get("output"),
        "rowCount": manifest.get("row_count"),
        "startedAt": manifest.get("started_at"),
        "completedAt": manifest.get("completed_at"),
        "durationMillis": manifest.get("duration_ms"),
        "columns": [{"index": c["index"], "jdbcLabel": c["label"], "outputName": c["output_name"],
                     "jdbcType": c["type"], "nullable": c["nullable"], "precision": c["precision"],
                     "scale": c["scale"], "sensitive": c["sensitive"]} for c in manifest.get("columns", [])],
        **checked,
    }


def write_manifest(spark: SparkSession, manifest: dict, path: str) -> None:
    """The sidecar: one small pretty-printed JSON file (a few lines per column, never rows).

    Written from the driver through the target's Hadoop ``FileSystem`` into a hidden sibling and
    renamed over ``path``, so a reader sees the old sidecar or the complete new one.
    """
    import json
    import uuid

    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    temporary = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex[:12]}.tmp")
    data = bytearray(json.dumps(sidecar_document(manifest), indent=2, ensure_ascii=False).encode("utf-8"))
    stream = fs.create(temporary, True)
    try:
        stream.write(data)
    finally:
        stream.close()
    try:
        move_over(spark, temporary, target)
    finally:
        if fs.exists(temporary):
            fs.delete(temporary, False)
