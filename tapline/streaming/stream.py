"""The same pipeline over a stream: ``readStream`` -> steps -> ``writeStream``.

Every step is row-level, so the plan is valid in append mode with no state. Progress is kept in
the checkpoint folder, by default a hidden folder beside the output: it belongs to that output, so a
restarted query resumes where it stopped and an executor loss only replays the open micro-batch.
An output that holds data without its checkpoint is refused: starting at batch 0 again would skip or
replace what is there.

With a *ledger*, each micro-batch is written by the batch sinks into a folder of its own (so any format goes, JSON
arrays too), and its counters are written beside it, under the batch's number. Both replace what an earlier attempt at
the batch left: a batch that is run again after a crash is there once and counted once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..errors import OutputError
from ..plans.export import write_output
from ..plans.pipeline import Pipeline, observed
from ..sinks.formats import ndjson_lines, normalize_format, parquet_values, write_delimited
from ..sinks.publish import has_files
from ..sources.query import normalize_columns

METRICS_NAME = "tapline_pipeline"


def read_stream(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
                max_files_per_trigger: int | None = None, glob_filter: str | None = None) -> DataFrame:
    """A file stream over the folder ``path`` (new files are picked up as they land)."""
    reader = spark.readStream.schema(schema).format(file_format)
    if glob_filter:
        reader = reader.option("pathGlobFilter", glob_filter)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return normalize_columns(reader.load(path))


def transform_stream(stream: DataFrame, pipeline: Pipeline) -> DataFrame:
    """Apply the pipeline to a streaming DataFrame; metrics are reported per micro-batch under
    ``observedMetrics['tapline_pipeline']`` of the query progress."""
    if pipeline.is_empty():
        return stream
    return pipeline.plan(stream, observe=False, stream_metrics=METRICS_NAME).df


def start_stream_export(stream: DataFrame, pipeline: Pipeline, fmt: str, output: str,
                        checkpoint: str | None = None, available_now: bool = True,
                        processing_time: str | None = None, header: bool = True,
                        null_value: str = "", escape_formulas: bool = False,
                        ledger: str | None = None) -> StreamingQuery:
    """Start the export stream. JSON arrays need a closing bracket per file, so without a ledger a stream writes
    NDJSON, CSV, TSV or Parquet. CSV/TSV, and every format with a ``ledger`` folder, land in one ``batch_id=N``
    folder per micro-batch."""
    fmt = normalize_format(fmt)
    spark = stream.sparkSession
    checkpoint = checkpoint or default_checkpoint(output)
    if has_files(spark, output) and not has_files(spark, checkpoint):
        raise OutputError(f"{output} holds data, but {checkpoint} has no progress of a stream that wrote it.")
    if ledger:
        pipeline.output_schema(stream) if not pipeline.is_empty() else None  # a wrong pipeline fails here, not in a batch
        entered = _ledger_batch(pipeline, fmt, output, ledger, header, null_value, escape_formulas)
        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(entered)
        return _trigger(writer, available_now, processing_time).start()
    transformed = transform_stream(stream, pipeline)
    if fmt == "parquet":
        out, writer_format, options = parquet_values(transformed, not pipeline.is_empty()), "parquet", {}
    elif fmt == "ndjson":
        out, writer_format, options = ndjson_lines(transformed), "text", {}
    elif fmt in ("csv", "tsv"):
        # Delimited files put a header on the first row of each part, which needs batch
        # DataFrames: each micro-batch is written by the batch writer into its own folder.
        # Overwriting that folder makes a replayed batch idempotent (exactly-once output).
        sep = "," if fmt == "csv" else "\t"

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            write_delimited(batch, f"{output.rstrip('/')}/batch_id={batch_id}", sep=sep, header=header,
                            null_value=null_value, escape_formulas=escape_formulas, mode="overwrite")

        writer = transformed.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
        return _trigger(writer, available_now, processing_time).start()
    else:
        raise OutputError("A stream cannot write a JSON array; use ndjson.")
    writer = (out.writeStream.format(writer_format).outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", output))
    for key, value in options.items():
        writer = writer.option(key, value)
    return _trigger(writer, available_now, processing_time).start()


LEDGER_TYPE = ("rows_in long, rows_out long, rows_dropped long, rows_dropped_by_error long, rows_dropped_by_filter long, "
               "steps array<struct<name: string, type: string, invocations: long, failures: long>>")


def _ledger_batch(pipeline: Pipeline, fmt: str, output: str, ledger: str, header: bool, null_value: str,
                  escape_formulas: bool):
    """What each micro-batch does: write its rows, then its line of the ledger, each in the place of its number."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if pipeline.is_empty():
            counted = Observation()
            data, planned = batch.observe(counted, F.count(F.lit(1)).alias("rows")), None
        else:
            planned = pipeline.plan(batch)
            data = planned.df
        write_output(data, f"{output.rstrip('/')}/batch_id={batch_id}", fmt, transformed=planned is not None, header=header,
                     null_value=null_value, escape_formulas=escape_formulas, bom=False, pretty=False, compression="snappy",
                     single_file=False, mode="overwrite")
        if planned is not None:
            metrics = planned.metrics()
        else:
            rows = int(observed(counted).get("rows", 0) or 0)
            metrics = {"rows_in": rows, "rows_out": rows, "rows_dropped": 0, "rows_dropped_by_error": 0,
                       "rows_dropped_by_filter": 0, "steps": []}
        line = batch.sparkSession.createDataFrame([metrics], LEDGER_TYPE).coalesce(1)
        line.write.mode("overwrite").json(f"{ledger.rstrip('/')}/batch_id={batch_id}")

    return run


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """One row a micro-batch: its number and counters. Sums over it count every batch once."""
    return spark.read.schema(f"{LEDGER_TYPE}, batch_id long").json(ledger)


def default_checkpoint(output: str) -> str:
    """The checkpoint of an output: always the same hidden folder beside it, on the same storage."""
    parent, _, name = output.rstrip("/").rpartition("/")
    return f"{parent}/.{name}.checkpoint" if parent else f".{name}.checkpoint"


def _trigger(writer, available_now: bool, processing_time: str | None):
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    if available_now:
        return writer.trigger(availableNow=True)
    return writer
