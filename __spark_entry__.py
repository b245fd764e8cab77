"""

Every query reads the given tables (whole tables, whole texts) and runs one of the library's
operators on them; ``oracle_sql`` gives the same result as DuckDB SQL over the same tables.
Queries that write files (sinks, streams, JDBC) write under the session's shared folder
(``spark.checkpoint.dir``) and read the result back.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from pyspark import cloudpickle  # noqa: E402

from tapline import (  # noqa: E402
    OutputError, TransformError, build_pipeline, drop_scratch, export, scratch_path, shuffles_freed)
from tapline.functions import formula_guard, non_finite_to_null, redact_credentials  # noqa: E402
from tapline.operators import (  # noqa: E402
    COLUMN_CHANGING, Capabilities, ColumnStep, MapTableStep, PandasStep, StepOutput, StepRegistry)
from tapline.operators.custom import filter_provider, uppercase_provider  # noqa: E402
from tapline.ordinals import in_order  # noqa: E402
from tapline.plans import Pipeline, column_manifest, describe  # noqa: E402
from tapline.plans.pipeline import pipeline_counters  # noqa: E402
from tapline.plans.runs import latest_runs, run_kpis, step_summary, with_throughput  # noqa: E402
from tapline.sinks import (  # noqa: E402
    current_version, damaged_parts, parquet_values, part_frame, published_versions, read_current, write_parts)
from tapline.sources import cap_rows, jdbc_source, query_source, register_tables  # noqa: E402
from tapline.streaming import read_ledger, read_stream, start_stream_export  # noqa: E402

try:  # the training-data operators and their pipeline are an optional part, which may be left out as a whole
    import corpus_pipeline
    from tapline.llm import queries as _llm
except ModuleNotFoundError as exc:
    if exc.name not in ("corpus_pipeline", "tapline.llm", "public_tokenizers", "sentencepiece", "xxhash", "ahocorasick", "regex"):
        raise
    corpus_pipeline = _llm = None

# Functions defined here run in Python workers (the pandas step); they travel with the task by
# value, so workers need not find this file on their path.
if __name__ in sys.modules:  # loaded without a module entry, functions are pickled by value anyway
    cloudpickle.register_pickle_by_value(sys.modules[__name__])

SMOKE_DIR = "/root/testdata/sf0.001"


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    register_tables(spark, sf_dir, list(names))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ----------------------------------------------------------------------------- flagship

FLAGSHIP_SQL = """
SELECT o.o_orderkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate, c.c_name, c.c_mktsegment
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""

FLAGSHIP_TRANSFORMS = {
    "errorStrategy": "fail",
    "validateOutput": {"requiredFields": ["o_orderkey", "order_date", "label"]},
    "transforms": [
        {"type": "map", "column": "o_orderstatus", "mapping": {"F": "FINISHED", "O": "OPEN", "P": "PARTIAL"}},
        {"type": "mask", "column": "c_name"},
        {"type": "template", "name": "label", "template": "{o_orderkey}/{c_mktsegment}"},
        {"type": "expression", "outputField": "priority_band",
         "expression": "CASE WHEN o_totalprice >= 100000 THEN 'LARGE' ELSE 'SMALL' END"},
        {"type": "rename", "from": "o_orderdate", "to": "order_date"},
        {"type": "drop", "columns": "o_totalprice"},
    ],
}


def q_flagship(spark, sf_dir):
    _views(spark, sf_dir, "orders", "customer")
    return build_pipeline(FLAGSHIP_TRANSFORMS).apply(query_source(spark, FLAGSHIP_SQL))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: orders joined to customers, mapped, masked, templated, computed."""
    return q_flagship(spark, SMOKE_DIR)


# ----------------------------------------------------------------------------- projections

def q_rename_drop_keep(spark, sf_dir):
    _views(spark, sf_dir, "customer")
    p = build_pipeline(inline=["rename:c_custkey=customer_id", "drop:c_acctbal",
                               "keep:customer_id,c_name,c_mktsegment,c_nationkey"])
    return p.apply(query_source(spark, "SELECT * FROM customer"))


def q_add_static(spark, sf_dir):
    _views(spark, sf_dir, "nation")
    p = build_pipeline({"transforms": [{"type": "addStatic", "fields": {"source": "erp", "version": "1"}}]})
    return p.apply(query_source(spark, "SELECT * FROM nation"))


def q_default_string(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    src = query_source(spark, "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders")
    return build_pipeline(inline=["default:o_orderpriority=NONE"]).apply(src)


def q_default_int(spark, sf_dir):
    _views(spark, sf_dir, "part")
    src = query_source(spark, "SELECT p_partkey, nullif(p_size, 1) AS p_size FROM part")
    return build_pipeline(inline=["default:p_size= 0"]).apply(src)


def _status_source(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return query_source(spark, "SELECT o_orderkey, o_orderstatus FROM orders")


def q_map_keep(spark, sf_dir):
    return build_pipeline(inline=["map:o_orderstatus=F>Finished,O>Open"]).apply(_status_source(spark, sf_dir))


def q_map_default(spark, sf_dir):
    p = build_pipeline({"transforms": [{"type": "map", "column": "o_orderstatus",
                                        "mapping": {"F": "Finished", "O": "Open"},
                                        "unmatched": "default", "default": "Other"}]})
    return p.apply(_status_source(spark, sf_dir))


def q_map_skip_row(spark, sf_dir):
    p = build_pipeline({"errorStrategy": "skipRow",
                        "transforms": [{"type": "map", "column": "o_orderstatus",
                                        "mapping": {"F": "Finished", "O": "Open"}, "unmatched": "fail"}]})
    return p.apply(_status_source(spark, sf_dir))


def q_map_keep_original(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    src = query_source(spark, "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
    p = build_pipeline({"errorStrategy": "keepOriginal", "transforms": [
        {"type": "map", "column": "o_orderpriority", "mapping": {"1-URGENT": "U", "2-HIGH": "H"}},
        {"type": "map", "column": "o_orderstatus", "mapping": {"F": "Finished", "O": "Open"},
         "unmatched": "fail"}]})
    return p.apply(src)


def _customer_names(spark, sf_dir):
    """Orders, and the names of most customers as a mapping table."""
    _views(spark, sf_dir, "orders", "customer")
    query_source(spark, "SELECT c_custkey, c_name FROM customer WHERE c_nationkey < 15").createOrReplaceTempView("names_by_key")
    return query_source(spark, "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")


def q_map_from_table(spark, sf_dir):
    """A map whose mapping is a table: small enough here to be broadcast."""
    src = _customer_names(spark, sf_dir)
    return build_pipeline({"transforms": [{"type": "map", "column": "o_custkey", "table": "names_by_key", "key": "c_custkey",
                                           "value": "c_name"}]}).apply(src)


def q_map_from_table_default(spark, sf_dir):
    """The same, with the mapping taken to be too large to broadcast: a merge join with hot keys split."""
    src = _customer_names(spark, sf_dir)
    step = MapTableStep("o_custkey", spark.table("names_by_key"), "c_custkey", "c_name", unmatched="default", default="unknown",
                        broadcast_bytes=0)
    return Pipeline.of(step).apply(src)


def q_map_from_table_skip_row(spark, sf_dir):
    src = _customer_names(spark, sf_dir)
    step = MapTableStep("o_custkey", spark.table("names_by_key"), "c_custkey", "c_name", unmatched="fail", broadcast_bytes=0)
    return Pipeline.of(step, error_strategy="skipRow").apply(src)


def q_mask(spark, sf_dir):
    _views(spark, sf_dir, "customer")
    src = query_source(spark, "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
    p = build_pipeline({"transforms": [{"type": "mask", "columns": ["c_name", "c_acctbal"]},
                                       {"type": "mask", "column": "c_mktsegment", "mask": "#"}]})
    return p.apply(src)


def q_template(spark, sf_dir):
    _views(spark, sf_dir, "nation")
    p = build_pipeline(inline=["template:label={n_nationkey}: {n_name} (region {n_regionkey})"])
    return p.apply(query_source(spark, "SELECT * FROM nation"))


def q_expression(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    src = query_source(spark, "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
    p = build_pipeline({"transforms": [
        {"type": "expression", "outputField": "summary",
         "expression": "concat(o_orderpriority, ' / ', o_orderstatus)"},
        {"type": "expression", "outputField": "state",
         "expression": "CASE WHEN o_orderstatus = 'F' THEN 'settled' ELSE 'due' END"},
        {"type": "expression", "outputField": "key_text", "expression": "o_orderkey * 10"}]})
    return p.apply(src)


def q_expression_skip_row(spark, sf_dir):
    """An expression that raises for some rows: those rows fail and are skipped."""
    _views(spark, sf_dir, "orders")
    src = query_source(spark, "SELECT o_orderkey, o_orderstatus FROM orders")
    return build_pipeline({"errorStrategy": "skipRow", "transforms": [
        {"type": "expression", "outputField": "share",
         "expression": "o_orderkey div (o_orderkey % 7) + o_orderkey div (o_orderkey % 7)"}]}).apply(src)


def q_labels_join_map(spark, sf_dir):
    """A join in the user's SQL (documents with their labels), then map + template + drop."""
    _views(spark, sf_dir, "documents", "labels")
    src = query_source(spark, "SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic "
                              "FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
    p = build_pipeline({"transforms": [
        {"type": "map", "column": "quality", "mapping": {"0": "low", "1": "high"}, "unmatched": "fail"},
        {"type": "map", "column": "toxic", "mapping": {"1": "flagged"}, "unmatched": "default", "default": "clean"},
        {"type": "template", "name": "tag", "template": "{lang}:{quality}:{toxic}"},
        {"type": "drop", "columns": ["source"]}]})
    return p.apply(src)


def q_embeddings_keep(spark, sf_dir):
    """Embedding vectors: their size from SQL, then keep/rename/addStatic/template."""
    _views(spark, sf_dir, "embeddings")
    src = query_source(spark, "SELECT vec_id, label, size(embedding) AS dims, embedding FROM embeddings")
    p = build_pipeline(inline=["keep:vec_id,label,dims", "rename:label=class_id", "addStatic:model=v1",
                               "template:key={vec_id}#{class_id}"])
    return p.apply(src)


def q_canonical_events(spark, sf_dir):
    _views(spark, sf_dir, "events")
    src = query_source(spark, "SELECT event_id, ts, event_type FROM events")
    return build_pipeline(inline=["keep:event_id,ts,event_type"]).apply(src)


def q_canonical_orders(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    src = query_source(spark, "SELECT o_orderkey, o_orderdate, CAST(o_orderdate AS DATE) AS order_day FROM orders")
    return build_pipeline(inline=["rename:o_orderdate=order_ts"]).apply(src)


def q_redact(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", redact_credentials(F.col("text")).alias("text"))


def q_formula_guard(spark, sf_dir):
    customer = _table(spark, sf_dir, "customer")
    balance = F.floor(F.col("c_acctbal")).cast("long").cast("string")
    return customer.select("c_custkey", formula_guard(balance).alias("balance_text"),
                           formula_guard(F.concat(F.lit("="), F.col("c_mktsegment"))).alias("segment_text"))


def q_non_finite(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    value = (F.when(F.col("event_type") == "error", F.lit(float("nan")))
             .when(F.col("event_type") == "signup", F.lit(float("inf")))
             .otherwise(F.col("value")))
    return events.select("event_id", non_finite_to_null(value).alias("value"))


def q_sanitize_names(spark, sf_dir):
    _views(spark, sf_dir, "nation")
    src = query_source(spark, "SELECT n_nationkey AS `1st key`, n_name AS `café`, n_regionkey AS `region-key` "
                              "FROM nation")
    return parquet_values(src)


def q_output_names(spark, sf_dir):
    _views(spark, sf_dir, "nation")
    return query_source(spark, "SELECT n_nationkey AS `  NationKey `, n_name AS `NAME` FROM nation")


def q_row_cap(spark, sf_dir):
    """The row cap itself (max rows read, before transforms) is the operator under test: the
    first 100 orders of an ORDERED query, then a map."""
    _views(spark, sf_dir, "orders")
    src = query_source(spark, "SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey")
    return build_pipeline(inline=["map:o_orderstatus=F>Finished"]).apply(cap_rows(src, 100))


def q_row_cap_half(spark, sf_dir):
    """A cap of half the table: the first half of lineitem in order, from partitions' quotas."""
    _views(spark, sf_dir, "lineitem")
    src = query_source(spark, "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem "
                              "ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice")
    return cap_rows(src, _table(spark, sf_dir, "lineitem").count() // 2)


def q_first_failing_row(spark, sf_dir):
    """The number of the first row without a mapping, in key order, for two pipelines."""
    _views(spark, sf_dir, "orders")
    src = query_source(spark, "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey")
    pipelines = {
        "status": build_pipeline([{"type": "map", "column": "o_orderstatus", "mapping": {"F": "Finished", "O": "Open"},
                                   "unmatched": "fail"}]),
        "share": build_pipeline(inline=["default:o_custkey=0", "expression:share=1 / (o_custkey % 97 - 5)"])}
    found = []
    for name, pipeline in pipelines.items():
        failure = pipeline.plan(src, observe=False).first_failure()
        found.append((name, failure.row, failure.step) if failure else (name, None, None))
    return spark.createDataFrame(found, "pipeline string, row long, step string")


def _custom_registry() -> StepRegistry:
    return StepRegistry({"uppercase": uppercase_provider, "filter": filter_provider})


def q_pipeline_counters(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    src = query_source(spark, "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
    config = {"errorStrategy": "skipRow", "transforms": [
        {"type": "filter", "name": "not-low", "condition": "o_orderpriority <> '5-LOW'"},
        {"type": "map", "column": "o_orderstatus", "mapping": {"F": "Finished", "O": "Open"}, "unmatched": "fail"}]}
    from tapline.plans.config import load_config

    pipeline = _custom_registry().build(load_config(config))
    return pipeline_counters(pipeline.plan(src, observe=False), pipeline.error_strategy)


def q_custom_uppercase(spark, sf_dir):
    _views(spark, sf_dir, "documents")
    from tapline.plans.config import load_config

    pipeline = _custom_registry().build(load_config([{"type": "uppercase", "column": "source"}]))
    return pipeline.apply(query_source(spark, "SELECT doc_id, source, lang FROM documents"))


def _char_count(batch):
    import pandas as pd

    return pd.DataFrame({"doc_id": batch["doc_id"], "char_count": batch["text"].str.len().astype("int64"),
                         "__keep__": batch["text"].str.len() > 0})


def q_custom_pandas(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    step = PandasStep("char-count", _char_count,
                      T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("char_count", T.LongType())]))
    from tapline.plans.pipeline import Pipeline

    return Pipeline.of(step, error_strategy="skipRow").apply(docs)


def _thousandths(batch):
    out = batch[["doc_id"]].copy()
    out["share"] = [1000 // (int(i) % 13) for i in batch["doc_id"]]  # raises for every thirteenth id
    return out


def q_custom_skip_row(spark, sf_dir):
    """A custom step that raises for some rows of a batch: only those rows fail and are skipped."""
    from tapline.plans.pipeline import Pipeline

    step = PandasStep("share", _thousandths, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("share", T.LongType())]))
    return Pipeline.of(step, error_strategy="skipRow").apply(_table(spark, sf_dir, "documents").select("doc_id", "source"))


# ----------------------------------------------------------------------------- runs

# event type -> run status, for the run table derived from events
_RUN_STATUS = ("view", "completed", "purchase", "completed", "click", "running", "signup", "queued",
               "error", "failed")


def _runs(spark, sf_dir) -> DataFrame:
    """A table of export runs derived from ``events`` (one run per event)."""
    e = _table(spark, sf_dir, "events")
    status = F.element_at(F.create_map(*[F.lit(x) for x in _RUN_STATUS]), F.col("event_type"))
    finished = status.isin("completed", "failed")
    completed = F.when(finished, F.col("ts") + F.make_dt_interval(secs=F.col("user_id").cast("int")))
    return e.select(F.col("event_id").alias("id"), status.alias("status"),
                    (F.col("user_id") * 10).cast("long").alias("row_count"),
                    F.col("ts").alias("started_at"), completed.alias("completed_at"))


def q_run_kpis(spark, sf_dir):
    return run_kpis(_runs(spark, sf_dir))


def q_latest_runs(spark, sf_dir):
    return latest_runs(_runs(spark, sf_dir), 200).select("id", "status")


def q_throughput(spark, sf_dir):
    """All runs; a run that has not ended counts up to a fixed time."""
    now = F.lit("2031-01-01 00:00:00").cast("timestamp_ntz")
    return with_throughput(_runs(spark, sf_dir), now).select("id", "duration_ms", "elapsed_ms", "rows_per_second")


def q_step_summary(spark, sf_dir):
    e = _table(spark, sf_dir, "events")
    steps = e.select(F.col("event_type").alias("step"), F.lit("map").alias("type"),
                     F.lit(1).cast("long").alias("invocations"),
                     F.when(F.col("value") > 20, 1).otherwise(0).cast("long").alias("failures"),
                     F.round(F.col("value") * 1_000_000).cast("long").alias("total_nanos"))
    return step_summary(steps, 50)


def _column_rows(spark, df: DataFrame, columns: list[dict], extra) -> DataFrame:
    """One row per described column, with counts taken over all rows of ``df``."""
    listed = F.array(*[F.struct(*[F.lit(c[k]).alias(k) for k in ("index", "output_name", "type", "precision", "scale")],
                                F.count(F.col(f"`{c['label']}`")).alias("filled")) for c in columns])
    return df.agg(F.count(F.lit(1)).alias("row_count"), listed.alias("columns")).select(
        *extra, "row_count", F.inline("columns"))


def q_describe(spark, sf_dir):
    """The output columns of a query, with how many of its rows fill each."""
    _views(spark, sf_dir, "lineitem")
    sql = ("SELECT l_orderkey, l_shipdate, CAST(l_extendedprice AS DECIMAL(15,2)) AS l_price, l_returnflag FROM lineitem")
    columns = [r.asDict() for r in describe(spark, sql=sql).collect()]  # one row per column
    return _column_rows(spark, query_source(spark, sql), columns, []).drop("row_count")


def q_manifest(spark, sf_dir):
    """The manifest's columns and row count of an export of ``orders``."""
    orders = _table(spark, sf_dir, "orders")
    return _column_rows(spark, orders, column_manifest(orders.schema), [F.lit("tapline").alias("tool"), F.lit("parquet").alias("format")])


# ----------------------------------------------------------------------------- sinks (write, read back)

def _roundtrip(spark, sf_dir, table: str, fmt: str, **options) -> DataFrame:
    df = _table(spark, sf_dir, table)
    out = scratch_path(spark, f"sink-{fmt}")
    export(spark, df=df, fmt=fmt, output=out, **options)
    reader = spark.read.schema(df.schema)
    if fmt == "parquet":
        return spark.read.parquet(out)
    if fmt == "ndjson":
        return reader.json(out)
    if fmt == "json":
        return reader.option("multiLine", "true").json(out)
    sep = "," if fmt == "csv" else "\t"
    return (reader.option("header", "true").option("sep", sep).option("quote", '"').option("escape", '"')
            .option("multiLine", "true").option("lineSep", "\r\n").csv(out))


def q_sink_parquet(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "part", "parquet", compression="zstd")


def q_sink_csv(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "part", "csv")


def q_sink_tsv(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "supplier", "tsv")


def q_sink_ndjson(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "customer", "ndjson")


def q_sink_json_array(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "nation", "json", pretty=True)


def _ordered_lines(spark, sf_dir) -> DataFrame:
    """lineitem in order, in eight parts whatever its size."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    df = _table(spark, sf_dir, "lineitem").select(*order, "l_returnflag")
    return df.repartitionByRange(8, *order).sortWithinPartitions(*order)


def _file_lines(spark, path: str) -> DataFrame:
    """The lines of the one file in a folder with their numbers from 1."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"),
                                         F.col("_metadata.file_block_start").alias("block"),
                                         F.monotonically_increasing_id().alias("place"))
    return in_order(lines, ["file", "block", "place"], "line")[0]


def q_sink_single_csv(spark, sf_dir):
    """One ordered CSV file written by eight tasks, read back line by line."""
    out = scratch_path(spark, "single-csv")
    export(spark, df=_ordered_lines(spark, sf_dir), fmt="csv", output=out, single_file=True)
    cells = F.split(F.regexp_replace("value", "\r$", ""), ",")
    types = ["long", "int", "long", "long", "double", "string"]
    names = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag"]
    return _file_lines(spark, out).filter("line > 1").select(
        (F.col("line") - 1).alias("place"), *[F.get(cells, F.lit(k)).cast(t).alias(n) for k, (n, t) in enumerate(zip(names, types))])


def q_sink_single_json(spark, sf_dir):
    """One ordered JSON array in one file written by eight tasks, read back line by line."""
    out = scratch_path(spark, "single-json")
    df = _ordered_lines(spark, sf_dir)
    export(spark, df=df, fmt="json", output=out, single_file=True)
    row = F.from_json(F.regexp_replace("value", r"^\[|[,\]]$", ""), df.schema)
    return _file_lines(spark, out).select(F.col("line").alias("place"), row.alias("row")).select("place", "row.*")


def q_publish_versions(spark, sf_dir):
    """Three versions of a table and a failed fourth: a reader gets the third, whole; two versions are kept."""
    out = scratch_path(spark, "versions")
    _views(spark, sf_dir, "orders")
    sql = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
    for status in ("F", "O", "P"):
        export(spark, sql=f"{sql} WHERE o_orderstatus = '{status}'", fmt="parquet", output=out, versions=2)
    try:
        export(spark, sql=sql, fmt="parquet", output=out, versions=2, transforms=[
            {"type": "map", "column": "o_orderstatus", "mapping": {"F": "f"}, "unmatched": "fail"}])
    except TransformError:
        pass
    kept = len(published_versions(spark, out))
    number = current_version(spark, out).number
    return read_current(spark, out).withColumns({"version": F.lit(number), "kept": F.lit(kept)})


def q_manifest_parts(spark, sf_dir):
    """lineitem in six parts of each kind: the sums of the manifests' parts, what reads back, and damage found (none).

    The parts are scratch: those of a kind go when they have been read back and verified, their shuffle when they are
    written."""
    lines = _table(spark, sf_dir, "lineitem").repartition(6, "l_orderkey")
    found = []
    for fmt in ("parquet", "ndjson", "csv"):
        out = scratch_path(spark, f"parts-{fmt}")
        with shuffles_freed(spark):
            manifest = write_parts(lines, out, fmt)
        back = spark.read.format({"ndjson": "json"}.get(fmt, fmt)).options(header=True).load(out)
        sums = part_frame(spark, manifest).agg(F.sum("rows").alias("rows"), F.count("*").alias("parts"))
        found.append(sums.select(
            F.lit(fmt).alias("format"), "parts", "rows", F.lit(back.count()).alias("read"),
            F.lit(damaged_parts(spark, out).count()).alias("damaged")))
        drop_scratch(spark, out)
    return found[0].unionByName(found[1]).unionByName(found[2])


def q_empty_result(spark, sf_dir):
    """No rows in each format: what is in the files, and what they read as."""
    found = []
    for fmt in ("csv", "tsv", "json", "ndjson", "parquet"):
        for single in (False, True):
            out = scratch_path(spark, f"empty-{fmt}")
            export(spark, df=_table(spark, sf_dir, "region").filter("r_regionkey < 0"), fmt=fmt, output=out, single_file=single)
            if fmt == "parquet":
                text = ",".join(spark.read.parquet(out).columns)
            else:
                text = "".join(r["value"] for r in spark.read.text(out, wholetext=True).collect())
            found.append((fmt, single, text))
    return spark.createDataFrame(found, "format string, single boolean, content string")


def q_overwrite_guard(spark, sf_dir):
    """A second export to the same place: refused, then allowed; what is there after each."""
    out = scratch_path(spark, "guard")
    _views(spark, sf_dir, "supplier")
    found = []
    for step, overwrite, where in (("first", False, "s_suppkey > 0"), ("refused", False, "s_suppkey < 0"), ("allowed", True, "s_suppkey > 5")):
        try:
            export(spark, sql=f"SELECT s_suppkey, s_name FROM supplier WHERE {where}", fmt="parquet", output=out, overwrite=overwrite)
            outcome = "written"
        except OutputError:
            outcome = "refused"
        found.append((step, outcome, spark.read.parquet(out).count()))
    return spark.createDataFrame(found, "step string, outcome string, rows long")


def q_capability_flags(spark, sf_dir):
    """Custom steps against what they declare: one that changes columns unannounced, and one that is not row by row."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    steps = {"changing, declared": (Capabilities(schema_changing=True), True), "changing, not declared": (Capabilities(), True),
             "unchanged": (Capabilities(), False), "not row by row": (Capabilities(row_level=False), False)}
    found = []
    for name, (flags, adds) in steps.items():
        step = ColumnStep("flagged", lambda row, adds=adds: StepOutput(
            row.passthrough() + ([("size", F.length(row["o_orderstatus"]))] if adds else [])), capabilities=flags)
        for kind in ("batch", "stream"):
            source = orders if kind == "batch" else read_stream(spark, sf_dir, _table(spark, sf_dir, "orders").schema,
                                                                glob_filter="orders.parquet").select(*orders.columns)
            try:
                planned = Pipeline.of(step).plan(source, observe=False).df
                found.append((name, kind, planned.count() if kind == "batch" else len(planned.columns)))
            except TransformError:
                found.append((name, kind, None))
    return spark.createDataFrame(found, "step string, kind string, found long")


def q_declared_shape(spark, sf_dir):
    """Custom steps that keep, or break, the columns they declare: found when the plan is built."""
    region = _table(spark, sf_dir, "region")
    shapes = {"as declared": ["r_regionkey", "r_name", "size"], "missing": ["r_regionkey", "size"],
              "other order": ["r_name", "r_regionkey", "size"], "undeclared": ["r_regionkey", "r_name", "size", "more"]}
    found = []
    for name, made in shapes.items():
        step = ColumnStep("shape", lambda row, made=made: StepOutput(
            [(c, row[c] if row.has(c) else F.lit(1)) for c in made]), declare=lambda names: names + ["size"],
            capabilities=COLUMN_CHANGING)
        try:
            rows = Pipeline.of(step).apply(region).count()
            found.append((name, rows))
        except TransformError:
            found.append((name, None))
    return spark.createDataFrame(found, "shape string, rows long")


def q_sink_csv_texts(spark, sf_dir):
    """Whole conversation texts (multi-line, accented) through CSV and back."""
    return _roundtrip(spark, sf_dir, "conversations", "csv", escape_formulas=False)


def q_sink_tsv_documents(spark, sf_dir):
    """Whole documents (prose, junk, secrets, tabs) through TSV and back."""
    return _roundtrip(spark, sf_dir, "documents", "tsv")


def q_sink_json_pages(spark, sf_dir):
    """Raw HTML pages (quotes, markup, newlines) through pretty JSON arrays and back."""
    return _roundtrip(spark, sf_dir, "pages", "json", pretty=True)


def q_sink_parquet_decimals(spark, sf_dir):
    """Parquet with declared decimal columns: exact rescale, a value needing rounding would fail."""
    _views(spark, sf_dir, "lineitem")
    out = scratch_path(spark, "sink-decimals")
    export(spark, sql="SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_quantity FROM lineitem",
           fmt="parquet", output=out,
           parquet_decimals={"l_extendedprice": (15, 2), "l_discount": (4, 2), "l_quantity": (10, 0)})
    return spark.read.parquet(out)


def q_sink_ndjson_transformed(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    out = scratch_path(spark, "sink-ndjson-t")
    export(spark, sql="SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders", fmt="ndjson", output=out,
           inline=["rename:o_orderdate=order_date", "mask:o_orderstatus"])
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("order_date", T.StringType()),
                           T.StructField("o_orderstatus", T.StringType())])
    return spark.read.schema(schema).json(out)


def q_sink_empty_parts(spark, sf_dir):
    """JSON arrays from a table most of whose partitions are empty: each part file is a whole document."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    out = scratch_path(spark, "sink-empty-parts")
    export(spark, df=orders.repartition(16, "o_orderstatus"), fmt="json", output=out)
    return spark.read.schema(orders.schema).option("multiLine", "true").option("mode", "FAILFAST").json(out)


def q_sink_csv_bom(spark, sf_dir):
    """CSV with a byte-order mark at the start of every part."""
    part = _table(spark, sf_dir, "part")
    out = scratch_path(spark, "sink-bom")
    export(spark, df=part.repartition(3), fmt="csv", output=out, bom=True)
    heads = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(out)
             .agg(F.bool_and(F.hex(F.substring("content", 1, 3)) == "EFBBBF").alias("marked")))
    rows = (spark.read.schema(part.schema).option("header", "true").option("escape", '"').option("lineSep", "\r\n").csv(out)
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("p_partkey").alias("keys")))
    return rows.select("rows", "keys", heads.scalar().alias("marked"))


# ----------------------------------------------------------------------------- JDBC and streams

def q_jdbc_roundtrip(spark, sf_dir):
    """Nation through a JDBC database and back, read with four parallel range queries.

    The database is an embedded in-memory Derby inside the Spark JVM (no server, no port), so
    this check only runs where driver and executors share one JVM (local mode)."""
    import uuid

    url = f"jdbc:derby:memory:tl{uuid.uuid4().hex[:8]};create=true"
    nation = _table(spark, sf_dir, "nation")
    nation = nation.toDF(*[c.upper() for c in nation.columns])  # unquoted identifiers in the SQL below
    nation.write.format("jdbc").option("url", url).option("dbtable", "NATION_COPY").mode("overwrite").save()
    back = jdbc_source(spark, url, "SELECT N_NATIONKEY, N_NAME, N_REGIONKEY FROM NATION_COPY",
                       partition_column="N_NATIONKEY", lower_bound=0, upper_bound=25, num_partitions=4)
    return back.select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name",
                       F.col("n_regionkey").cast("int").alias("n_regionkey"))


def q_jdbc_equi_depth(spark, sf_dir):
    """Orders through a database and back in equi-depth splits of their customers, a third of them one customer's.

    The same embedded database as in ``jdbc_roundtrip``: local mode only."""
    import uuid

    url = f"jdbc:derby:memory:tl{uuid.uuid4().hex[:8]};create=true"
    hot = F.when(F.col("o_orderkey") % 3 == 0, F.lit(7)).otherwise(F.col("o_custkey"))
    orders = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("O_ORDERKEY"), hot.alias("O_CUSTKEY"))
    orders.write.format("jdbc").option("url", url).option("dbtable", "ORDERS_COPY").mode("overwrite").save()
    return jdbc_source(spark, url, "SELECT O_ORDERKEY, O_CUSTKEY FROM ORDERS_COPY", partition_column="O_CUSTKEY", num_partitions=6,
                       equi_depth=True, spread_by="O_ORDERKEY")


def q_stream_pipeline(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    stream = read_stream(spark, sf_dir, orders.schema, glob_filter="orders.parquet")
    pipeline = build_pipeline(inline=["keep:o_orderkey,o_orderstatus,o_orderdate",
                                      "map:o_orderstatus=F>Finished,O>Open,P>Partial",
                                      "rename:o_orderdate=order_date"])
    out = scratch_path(spark, "stream-out")
    query = start_stream_export(stream, pipeline, "parquet", out, checkpoint=scratch_path(spark, "stream-ckpt"))
    query.awaitTermination()
    return spark.read.parquet(out)


def q_stream_restart(spark, sf_dir):
    """A stream that ends, gets more files and starts again with its own checkpoint: every row once."""
    orders = _table(spark, sf_dir, "orders")
    source, out = scratch_path(spark, "restart-in"), scratch_path(spark, "restart-out")
    pipeline = build_pipeline(inline=["keep:o_orderkey,o_orderstatus", "map:o_orderstatus=F>Finished,O>Open,P>Partial"])
    for odd in (0, 1):
        orders.filter(F.col("o_orderkey") % 2 == odd).write.mode("append").parquet(source)
        stream = read_stream(spark, source, orders.schema, glob_filter="*.parquet")
        start_stream_export(stream, pipeline, "parquet", out).awaitTermination()
    return spark.read.parquet(out)


def q_stream_ledger(spark, sf_dir):
    """The counters of a stream of three batches, the last of them run again after its commit was lost, as JSON arrays."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    source, out, ledger = (scratch_path(spark, f"ledger-{x}") for x in ("in", "out", "book"))
    checkpoint = scratch_path(spark, "ledger-progress")
    pipeline = build_pipeline({"errorStrategy": "skipRow", "transforms": [
        {"type": "map", "column": "o_orderstatus", "mapping": {"F": "Finished", "O": "Open"}, "unmatched": "fail"}]})

    def run():
        stream = read_stream(spark, source, orders.schema, glob_filter="*.parquet")
        start_stream_export(stream, pipeline, "json", out, checkpoint=checkpoint, ledger=ledger).awaitTermination()

    for third in range(3):
        orders.filter(F.col("o_orderkey") % 3 == third).write.mode("append").parquet(source)
        run()
    lost = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/2")
    lost.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(lost, False)
    run()                                                    # the third batch again
    written = spark.read.option("multiLine", True).schema("o_orderkey long, o_orderstatus string").json(out)
    return read_ledger(spark, ledger).select(
        "batch_id", "rows_in", "rows_out", "rows_dropped_by_error", F.get("steps", F.lit(0))["failures"].alias("failures")).join(
        written.groupBy((F.col("o_orderkey") % 3).alias("batch_id")).agg(F.count("*").alias("written")), "batch_id")


# ----------------------------------------------------------------------------- registry

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "flagship": q_flagship,
    "rename_drop_keep": q_rename_drop_keep,
    "add_static": q_add_static,
    "default_string": q_default_string,
    "default_int": q_default_int,
    "map_keep": q_map_keep,
    "map_default": q_map_default,
    "map_skip_row": q_map_skip_row,
    "map_keep_original": q_map_keep_original,
    "map_from_table": q_map_from_table,
    "map_from_table_default": q_map_from_table_default,
    "map_from_table_skip_row": q_map_from_table_skip_row,
    "mask": q_mask,
    "template": q_template,
    "expression": q_expression,
    "labels_join_map": q_labels_join_map,
    "embeddings_keep": q_embeddings_keep,
    "canonical_events": q_canonical_events,
    "canonical_orders": q_canonical_orders,
    "redact": q_redact,
    "formula_guard": q_formula_guard,
    "non_finite": q_non_finite,
    "sanitize_names": q_sanitize_names,
    "output_names": q_output_names,
    "row_cap": q_row_cap,
    "row_cap_half": q_row_cap_half,
    "first_failing_row": q_first_failing_row,
    "pipeline_counters": q_pipeline_counters,
    "custom_uppercase": q_custom_uppercase,
    "custom_pandas": q_custom_pandas,
    "run_kpis": q_run_kpis,
    "latest_runs": q_latest_runs,
    "throughput": q_throughput,
    "step_summary": q_step_summary,
    "manifest": q_manifest,
    "describe": q_describe,
    "sink_parquet": q_sink_parquet,
    "sink_csv": q_sink_csv,
    "sink_tsv": q_sink_tsv,
    "sink_ndjson": q_sink_ndjson,
    "sink_json_array": q_sink_json_array,
    "sink_single_csv": q_sink_single_csv,
    "sink_single_json": q_sink_single_json,
    "publish_versions": q_publish_versions,
    "manifest_parts": q_manifest_parts,
    "stream_ledger": q_stream_ledger,
    "empty_result": q_empty_result,
    "overwrite_guard": q_overwrite_guard,
    "capability_flags": q_capability_flags,
    "declared_shape": q_declared_shape,
    "sink_csv_texts": q_sink_csv_texts,
    "sink_tsv_documents": q_sink_tsv_documents,
    "sink_json_pages": q_sink_json_pages,
    "sink_parquet_decimals": q_sink_parquet_decimals,
    "sink_ndjson_transformed": q_sink_ndjson_transformed,
    "jdbc_roundtrip": q_jdbc_roundtrip,
    "jdbc_equi_depth": q_jdbc_equi_depth,
    "stream_pipeline": q_stream_pipeline,
    "expression_skip_row": q_expression_skip_row,
    "custom_skip_row": q_custom_skip_row,
    "sink_empty_parts": q_sink_empty_parts,
    "sink_csv_bom": q_sink_csv_bom,
    "stream_restart": q_stream_restart,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = {} if _llm is None else _llm.queries() | {"pipeline": corpus_pipeline.run}
    return dict(_QUERIES) | more


# ----------------------------------------------------------------------------- oracle SQL (DuckDB)

def _iso(ts: str) -> str:
    """Java LocalDateTime.toString of a DuckDB timestamp: seconds only when non-zero, fraction in
    3 or 6 digits."""
    micros = f"(microsecond({ts}) % 1000000)"
    return (f"(strftime({ts}, '%Y-%m-%dT%H:%M') || "
            f"CASE WHEN second({ts}) <> 0 OR {micros} <> 0 THEN ':' || strftime({ts}, '%S') ELSE '' END || "
            f"CASE WHEN {micros} = 0 THEN '' "
            f"WHEN {micros} % 1000 = 0 THEN '.' || lpad(CAST({micros} // 1000 AS VARCHAR), 3, '0') "
            f"ELSE '.' || strftime({ts}, '%f') END)")


_RUNS_SQL = """(SELECT event_id AS id,
   CASE event_type WHEN 'view' THEN 'completed' WHEN 'purchase' THEN 'completed' WHEN 'click' THEN 'running'
                   WHEN 'signup' THEN 'queued' WHEN 'error' THEN 'failed' END AS status,
   CAST(user_id * 10 AS BIGINT) AS row_count, ts AS started_at,
   CASE WHEN event_type IN ('view', 'purchase', 'error') THEN ts + to_seconds(CAST(user_id AS BIGINT)) END
     AS completed_at
 FROM events)"""

_ORACLE = {
    "flagship": f"""
SELECT o.o_orderkey,
  CASE o.o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'OPEN' WHEN 'P' THEN 'PARTIAL' ELSE o.o_orderstatus END
    AS o_orderstatus,
  {_iso('o.o_orderdate')} AS order_date,
  CASE WHEN c.c_name IS NOT NULL THEN '***' END AS c_name,
  c.c_mktsegment,
  coalesce(CAST(o.o_orderkey AS VARCHAR), '') || '/' || coalesce(c.c_mktsegment, '') AS label,
  CASE WHEN o.o_totalprice >= 100000 THEN 'LARGE' ELSE 'SMALL' END AS priority_band
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
    "rename_drop_keep": "SELECT c_custkey AS customer_id, c_name, c_mktsegment, c_nationkey FROM customer",
    "add_static": "SELECT *, 'erp' AS source, '1' AS version FROM nation",
    "default_string": "SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), 'NONE') AS o_orderpriority "
                      "FROM orders",
    "default_int": "SELECT p_partkey, coalesce(nullif(p_size, 1), 0) AS p_size FROM part",
    "map_keep": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' "
                "ELSE o_orderstatus END AS o_orderstatus FROM orders",
    "map_default": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' "
                   "ELSE 'Other' END AS o_orderstatus FROM orders",
    "map_skip_row": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' ELSE 'Open' END AS o_orderstatus "
                    "FROM orders WHERE o_orderstatus IN ('F', 'O')",
    "map_keep_original": """
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderstatus IN ('F', 'O')
       THEN CASE o_orderpriority WHEN '1-URGENT' THEN 'U' WHEN '2-HIGH' THEN 'H' ELSE o_orderpriority END
       ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
    **{name: f"""
SELECT o_orderkey, {value} AS o_custkey, o_orderstatus
FROM orders {kind} JOIN (SELECT * FROM customer WHERE c_nationkey < 15) c ON o_custkey = c_custkey"""
       for name, value, kind in [
           ("map_from_table", "CASE WHEN c_custkey IS NULL THEN CAST(o_custkey AS VARCHAR) ELSE c_name END", "LEFT"),
           ("map_from_table_default", "CASE WHEN c_custkey IS NULL THEN 'unknown' ELSE c_name END", "LEFT"),
           ("map_from_table_skip_row", "c_name", "INNER")]},
    "mask": "SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN '***' END AS c_name, "
            "CASE WHEN c_acctbal IS NOT NULL THEN '***' END AS c_acctbal, "
            "CASE WHEN c_mktsegment IS NOT NULL THEN '#' END AS c_mktsegment FROM customer",
    "template": "SELECT *, coalesce(CAST(n_nationkey AS VARCHAR), '') || ': ' || coalesce(n_name, '') || ' (region ' "
                "|| coalesce(CAST(n_regionkey AS VARCHAR), '') || ')' AS label FROM nation",
    "expression": "SELECT o_orderkey, o_orderstatus, o_orderpriority, "
                  "o_orderpriority || ' / ' || o_orderstatus AS summary, "
                  "CASE WHEN o_orderstatus = 'F' THEN 'settled' ELSE 'due' END AS state, "
                  "CAST(o_orderkey * 10 AS VARCHAR) AS key_text FROM orders",
    "labels_join_map": """
SELECT d.doc_id, d.lang,
  CASE CAST(l.quality AS VARCHAR) WHEN '0' THEN 'low' WHEN '1' THEN 'high' END AS quality,
  CASE WHEN l.toxic IS NULL THEN NULL WHEN CAST(l.toxic AS VARCHAR) = '1' THEN 'flagged' ELSE 'clean' END AS toxic,
  coalesce(d.lang, '') || ':' || coalesce(CASE CAST(l.quality AS VARCHAR) WHEN '0' THEN 'low' WHEN '1' THEN 'high' END, '')
    || ':' || coalesce(CASE WHEN l.toxic IS NULL THEN NULL WHEN CAST(l.toxic AS VARCHAR) = '1' THEN 'flagged'
                            ELSE 'clean' END, '') AS tag
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "embeddings_keep": "SELECT vec_id, label AS class_id, CAST(len(embedding) AS INTEGER) AS dims, 'v1' AS model, "
                       "CAST(vec_id AS VARCHAR) || '#' || coalesce(CAST(label AS VARCHAR), '') AS key FROM embeddings",
    "canonical_events": f"SELECT event_id, {_iso('ts')} AS ts, event_type FROM events",
    "canonical_orders": f"SELECT o_orderkey, {_iso('o_orderdate')} AS order_ts, "
                        "strftime(o_orderdate, '%Y-%m-%d') AS order_day FROM orders",
    "redact": r"""SELECT doc_id,
  regexp_replace(regexp_replace(text, '(//[^/@:\s]+:)[^@\s]+(@)', '\1*****\2', 'g'),
                 '(?i)\b(password|pwd)=[^&;\s]*', '\1=*****', 'g') AS text
FROM documents""",
    "formula_guard": r"""SELECT c_custkey,
  CASE WHEN regexp_matches(b, '^[=+\-@\t\r]') THEN '''' || b ELSE b END AS balance_text,
  '''=' || c_mktsegment AS segment_text
FROM (SELECT c_custkey, c_mktsegment, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS b FROM customer)""",
    "non_finite": "SELECT event_id, CASE WHEN event_type IN ('error', 'signup') THEN NULL ELSE value END AS value "
                  "FROM events",
    "sanitize_names": 'SELECT n_nationkey AS "_1st_key", n_name AS "caf_", n_regionkey AS region_key FROM nation',
    "output_names": "SELECT n_nationkey AS nationkey, n_name AS name FROM nation",
    "row_cap": "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' ELSE o_orderstatus END AS o_orderstatus "
               "FROM orders ORDER BY o_orderkey LIMIT 100",
    "row_cap_half": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem "
                    "ORDER BY 1, 2, 3, 4, 5 LIMIT (SELECT count(*) // 2 FROM lineitem)",
    "first_failing_row": """
WITH n AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS row FROM orders)
SELECT 'status' AS pipeline, min(row) AS row, CASE WHEN min(row) IS NOT NULL THEN 'map' END AS step
FROM n WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'share', min(row), CASE WHEN min(row) IS NOT NULL THEN 'expression' END
FROM n WHERE coalesce(o_custkey, 0) % 97 = 5""",
    **dict.fromkeys(("sink_single_csv", "sink_single_json"), """
SELECT row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS place,
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag FROM lineitem"""),
    "publish_versions": "SELECT o_orderkey, o_orderstatus, o_totalprice, 3 AS version, 2 AS kept FROM orders "
                        "WHERE o_orderstatus = 'P'",
    "empty_result": """
SELECT format, single, CASE format WHEN 'csv' THEN 'r_regionkey,r_name' || chr(13) || chr(10)
  WHEN 'tsv' THEN 'r_regionkey' || chr(9) || 'r_name' || chr(13) || chr(10) WHEN 'json' THEN '[]' || chr(10) WHEN 'ndjson' THEN ''
  ELSE 'r_regionkey,r_name' END || repeat('?', (SELECT count(*) FROM region WHERE r_regionkey < 0)) AS content
FROM (SELECT unnest(['csv', 'tsv', 'json', 'ndjson', 'parquet']) AS format), (SELECT unnest([true, false]) AS single)""",
    "jdbc_equi_depth": "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey FROM orders",
    "manifest_parts": "SELECT format, 6 AS parts, n AS rows, n AS read, 0 AS damaged FROM (SELECT count(*) AS n FROM lineitem), "
                      "(SELECT unnest(['parquet', 'ndjson', 'csv']) AS format)",
    "stream_ledger": """
SELECT o_orderkey % 3 AS batch_id, count(*) AS rows_in, count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS rows_out,
  count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS rows_dropped_by_error,
  count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS failures,
  count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) AS written
FROM orders GROUP BY 1""",
    "overwrite_guard": """
SELECT 'first' AS step, 'written' AS outcome, (SELECT count(*) FROM supplier WHERE s_suppkey > 0) AS rows
UNION ALL SELECT 'refused', 'refused', (SELECT count(*) FROM supplier WHERE s_suppkey > 0)
UNION ALL SELECT 'allowed', 'written', (SELECT count(*) FROM supplier WHERE s_suppkey > 5)""",
    "capability_flags": """
SELECT step, kind, CASE WHEN step = 'changing, not declared' OR (step = 'not row by row' AND kind = 'stream') THEN NULL
  WHEN kind = 'batch' THEN (SELECT count(*) FROM orders) WHEN step = 'unchanged' THEN 2 ELSE 3 END AS found
FROM (SELECT unnest(['changing, declared', 'changing, not declared', 'unchanged', 'not row by row']) AS step),
  (SELECT unnest(['batch', 'stream']) AS kind)""",
    "declared_shape": "SELECT shape, CASE shape WHEN 'as declared' THEN (SELECT count(*) FROM region) END AS rows "
                      "FROM (SELECT unnest(['as declared', 'missing', 'other order', 'undeclared']) AS shape)",
    "pipeline_counters": """
SELECT CAST(count(*) AS BIGINT) AS rows_in,
  CAST(count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderstatus IN ('F', 'O')) AS BIGINT) AS rows_out,
  CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW' OR o_orderstatus NOT IN ('F', 'O')) AS BIGINT) AS rows_dropped,
  CAST(count(*) FILTER (WHERE o_orderpriority <> '5-LOW' AND o_orderstatus NOT IN ('F', 'O')) AS BIGINT)
    AS rows_dropped_by_error,
  CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS BIGINT) AS rows_dropped_by_filter
FROM orders""",
    "custom_uppercase": "SELECT doc_id, upper(source) AS source, lang FROM documents",
    "custom_pandas": "SELECT doc_id, CAST(length(text) AS BIGINT) AS char_count FROM documents WHERE length(text) > 0",
    "run_kpis": f"""
SELECT CAST(count(*) AS BIGINT) AS jobs_total,
  CAST(count(*) FILTER (WHERE status = 'running') AS BIGINT) AS running,
  CAST(count(*) FILTER (WHERE status = 'queued') AS BIGINT) AS queued,
  CAST(count(*) FILTER (WHERE status = 'completed') AS BIGINT) AS completed,
  CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS failed,
  CAST(coalesce(sum(row_count), 0) AS BIGINT) AS rows_total
FROM {_RUNS_SQL}""",
    "latest_runs": f"""
SELECT * FROM (SELECT id, status FROM {_RUNS_SQL} WHERE status IN ('completed', 'failed') ORDER BY id DESC LIMIT 200)
UNION ALL
SELECT id, status FROM {_RUNS_SQL} WHERE status NOT IN ('completed', 'failed')""",
    "throughput": f"""
SELECT id, d AS duration_ms, e AS elapsed_ms,
  CASE WHEN e > 0 THEN CAST(row_count AS DOUBLE) * 1000.0::DOUBLE / CAST(e AS DOUBLE) ELSE 0.0::DOUBLE END AS rows_per_second
FROM (SELECT id, row_count, (epoch_us(completed_at) - epoch_us(started_at)) // 1000 AS d,
        greatest((epoch_us(coalesce(completed_at, TIMESTAMP '2031-01-01')) - epoch_us(started_at)) // 1000, 0) AS e
      FROM {_RUNS_SQL})""",
    "step_summary": """
SELECT step, type, invocations AS rows, failures AS errors,
  CAST(floor(total_nanos / 1000000.0) AS BIGINT) AS duration_ms,
  CASE WHEN invocations = 0 THEN 0.0::DOUBLE
       ELSE floor((total_nanos / 1000000.0::DOUBLE) / invocations * 1000.0 + 0.5) / 1000.0 END AS avg_per_row_ms,
  CAST(floor(total_nanos / 1000000.0) AS BIGINT) >= 50 AS slow
FROM (SELECT event_type AS step, 'map' AS type, CAST(count(*) AS BIGINT) AS invocations,
        CAST(sum(CASE WHEN value > 20 THEN 1 ELSE 0 END) AS BIGINT) AS failures,
        CAST(sum(CAST(round(value * 1000000) AS BIGINT)) AS BIGINT) AS total_nanos
      FROM events GROUP BY event_type)""",
    "sink_parquet": "SELECT * FROM part",
    "sink_csv": "SELECT * FROM part",
    "sink_tsv": "SELECT * FROM supplier",
    "sink_ndjson": "SELECT * FROM customer",
    "sink_json_array": "SELECT * FROM nation",
    "sink_csv_texts": "SELECT * FROM conversations",
    "sink_tsv_documents": "SELECT * FROM documents",
    "sink_json_pages": "SELECT * FROM pages",
    "sink_parquet_decimals": "SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(15, 2)) AS l_extendedprice, "
                             "CAST(l_discount AS DECIMAL(4, 2)) AS l_discount, "
                             "CAST(l_quantity AS DECIMAL(10, 0)) AS l_quantity FROM lineitem",
    "sink_ndjson_transformed": f"SELECT o_orderkey, {_iso('o_orderdate')} AS order_date, "
                               "CASE WHEN o_orderstatus IS NOT NULL THEN '***' END AS o_orderstatus FROM orders",
    "jdbc_roundtrip": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "expression_skip_row": "SELECT o_orderkey, o_orderstatus, CAST(2 * (o_orderkey // (o_orderkey % 7)) AS VARCHAR) AS share "
                           "FROM orders WHERE o_orderkey % 7 <> 0",
    "custom_skip_row": "SELECT doc_id, 1000 // (doc_id % 13) AS share FROM documents WHERE doc_id % 13 <> 0",
    "sink_empty_parts": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "sink_csv_bom": 'SELECT count(*) AS "rows", CAST(sum(p_partkey) AS BIGINT) AS keys, true AS marked FROM part',
    "stream_restart": """SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial' ELSE o_orderstatus END
    AS o_orderstatus FROM orders""",
    "manifest": """
SELECT 'tapline' AS tool, 'parquet' AS format, n AS row_count, i AS "index", c AS output_name, t AS type, 0 AS precision,
  0 AS scale, f AS filled
FROM (SELECT count(*) AS n, unnest([1, 2, 3, 4, 5, 6]) AS i,
    unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority']) AS c,
    unnest(['bigint', 'bigint', 'string', 'double', 'timestamp_ntz', 'string']) AS t,
    unnest([count(o_orderkey), count(o_custkey), count(o_orderstatus), count(o_totalprice), count(o_orderdate),
            count(o_orderpriority)]) AS f FROM orders)""",
    "describe": """
SELECT unnest([1, 2, 3, 4]) AS "index", unnest(['l_orderkey', 'l_shipdate', 'l_price', 'l_returnflag']) AS output_name,
  unnest(['bigint', 'timestamp_ntz', 'decimal(15,2)', 'string']) AS type, unnest([0, 0, 15, 0]) AS precision,
  unnest([0, 0, 2, 0]) AS scale,
  unnest([count(l_orderkey), count(l_shipdate), count(l_extendedprice), count(l_returnflag)]) AS filled
FROM lineitem""",
    "stream_pipeline": f"""
SELECT o_orderkey,
  CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial' ELSE o_orderstatus END
    AS o_orderstatus,
  {_iso('o_orderdate')} AS order_date
FROM orders""",
}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query; queries that learn a model or iterate have none."""
    more = {} if _llm is None else _llm.oracle_sql()
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL:
        more["pipeline"] = corpus_pipeline.ORACLE_SQL
    return dict(_ORACLE) | more
