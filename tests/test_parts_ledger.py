"""Manifests made by the write itself, and the ledger of a stream."""

import json
import os
import time
import zlib

import pytest
from pyspark.sql import functions as F

from tapline import (
    OutputError, TaplineError, TransformError, build_pipeline, drop_scratch, export, shared_dir, shuffles_freed)
from tapline.plans import Pipeline
from tapline.sinks import current_version, damaged_parts, read_manifest, write_parts
from tapline.streaming import read_ledger, read_stream, start_stream_export


def rows(spark, n=1000):
    """Some partitions without rows, texts that need quotes."""
    return spark.range(0, n, 1, 8).filter("id < 300 or id > 700").select(
        "id", F.concat(F.lit('é, "'), F.col("id").cast("string")).alias("t"), (F.col("id") / 4).alias("x"))


def local(path):
    return path.removeprefix("file:")


@pytest.mark.parametrize("fmt", ["parquet", "ndjson", "csv", "tsv"])
def test_the_manifest_tells_what_is_there(spark, out, fmt):
    path, df = out(), rows(spark)
    manifest = write_parts(df, path, fmt)
    assert manifest == read_manifest(spark, path) and manifest["rows"] == df.count()
    parts = [n for n in os.listdir(local(path)) if n.startswith("part-")]
    assert sorted(parts) == [p["name"] for p in manifest["parts"]] and 4 <= len(parts) < 8
    for part in manifest["parts"]:
        data = open(f"{local(path)}/{part['name']}", "rb").read()
        assert (len(data), zlib.crc32(data)) == (part["bytes"], part["crc32"])
    assert not any(n.startswith("_stage") for n in os.listdir(local(path)))
    reader = spark.read.schema(df.schema)
    if fmt == "parquet":
        back = spark.read.parquet(path)
    elif fmt == "ndjson":
        back = reader.json(path)
    else:
        back = reader.options(header=True, sep="," if fmt == "csv" else "\t", escape='"').csv(path)
    assert back.exceptAll(df).count() == 0 and back.count() == df.count()
    assert damaged_parts(spark, path).count() == 0


def test_damage_is_found(spark, out):
    path = out()
    names = [p["name"] for p in write_parts(rows(spark), path, "ndjson")["parts"]]
    flipped = f"{local(path)}/{names[0]}"
    data = bytearray(open(flipped, "rb").read())
    data[10] ^= 1
    open(flipped, "wb").write(data)
    open(f"{local(path)}/{names[1]}", "ab").write(b"more")
    os.remove(f"{local(path)}/{names[2]}")
    open(f"{local(path)}/part-99999-foreign.txt", "w").write("x")
    found = {r["name"]: r["problem"] for r in damaged_parts(spark, path).collect()}
    assert found == {names[0]: "bytes", names[1]: "length", names[2]: "missing", "part-99999-foreign.txt": "not in the manifest"}


def test_parts_are_verified_in_blocks(spark, out, monkeypatch):
    """A part of any size: none is ever held whole."""
    from tapline.sinks import parts as module

    path, key = out(), "spark.sql.sources.binaryFile.maxLength"
    names = [p["name"] for p in write_parts(rows(spark), path, "ndjson")["parts"]]
    monkeypatch.setattr(module, "BLOCK_BYTES", 64, raising=False)
    spark.conf.set(key, 100)
    try:
        assert damaged_parts(spark, path).count() == 0
        flipped = f"{local(path)}/{names[0]}"
        data = bytearray(open(flipped, "rb").read())
        data[-2] ^= 1
        open(flipped, "wb").write(data)
        assert [tuple(r) for r in damaged_parts(spark, path).collect()] == [(names[0], "bytes")]
    finally:
        spark.conf.unset(key)


def test_failing_retried_and_empty_writes(spark, out):
    path = out()
    with pytest.raises(Exception):
        write_parts(rows(spark).withColumn("id", F.expr("1 / (id - 800)")), path, "ndjson")
    assert not os.path.exists(local(path)) or not [n for n in os.listdir(local(path)) if not n.startswith(".")]
    assert write_parts(rows(spark).limit(0), path, "csv") == {"rows": 0, "bytes": 0, "parts": []}
    with pytest.raises(OutputError, match="already exists"):
        write_parts(rows(spark), path, "csv")
    with pytest.raises(OutputError, match="not written in parts"):
        write_parts(rows(spark), out(), "json")
    with pytest.raises(OutputError, match="no manifest"):
        read_manifest(spark, out())


def test_an_export_lists_its_parts(spark, out):
    path, sidecar = out(), out("sidecar") + ".json"
    result = export(spark, df=rows(spark), fmt="parquet", output=path, checked_parts=True, metadata_path=sidecar,
                    transforms={"errorStrategy": "skipRow", "transforms": [
                        {"type": "expression", "outputField": "y", "expression": "1 / (id - 200)"}]})
    assert result.row_count == rows(spark).count() - 1 == sum(p["rows"] for p in result.manifest["parts"])
    assert result.metrics["rows_dropped_by_error"] == 1
    written = json.load(open(local(sidecar)))
    assert written["parts"] == read_manifest(spark, path)["parts"] and damaged_parts(spark, path).count() == 0
    assert spark.read.parquet(path).count() == result.row_count
    os.remove(local(sidecar))
    versioned = out()
    assert export(spark, df=rows(spark), fmt="csv", output=versioned, checked_parts=True, versions=2).row_count == rows(spark).count()
    assert damaged_parts(spark, current_version(spark, versioned).path).count() == 0
    with pytest.raises(TaplineError, match="Checked parts are for"):
        export(spark, df=rows(spark), fmt="json", output=out(), checked_parts=True)


PIPE = {"errorStrategy": "skipRow", "transforms": [
    {"type": "map", "column": "s", "mapping": {"a": "A", "b": "B"}, "unmatched": "fail"}, {"type": "filter", "condition": "k <> 5"}]}


def batch(spark, source, low, high):
    s = F.when(F.col("id") % 4 == 0, "a").when(F.col("id") % 4 == 1, "b").otherwise("c")
    spark.range(low, high, 1, 2).select(F.col("id").alias("k"), s.alias("s")).write.mode("append").parquet(source)


def run(spark, source, target, ledger, checkpoint, pipeline, fmt="json"):
    stream = read_stream(spark, source, spark.read.parquet(source).schema, glob_filter="*.parquet")
    start_stream_export(stream, pipeline, fmt, target, checkpoint=checkpoint, ledger=ledger).awaitTermination()


def totals(spark, ledger):
    return tuple(read_ledger(spark, ledger).agg(*[F.sum(c) for c in (
        "rows_in", "rows_out", "rows_dropped_by_error", "rows_dropped_by_filter")]).first())


def pipeline_with_filter():
    from tapline.operators import StepRegistry
    from tapline.operators.custom import filter_provider

    return build_pipeline(PIPE, registry=StepRegistry({"filter": filter_provider}))


@pytest.mark.parametrize("fmt", ["json", "ndjson", "csv", "parquet"])
def test_a_batch_run_again_counts_once(spark, out, fmt):
    source, target, ledger, checkpoint = out(), out(), out(), out()
    for k in range(3):
        batch(spark, source, 100 * k, 100 * (k + 1))
        run(spark, source, target, ledger, checkpoint, pipeline_with_filter(), fmt)
    assert totals(spark, ledger) == (300, 149, 150, 1)
    before = sorted(map(str, read_ledger(spark, ledger).collect()))
    for lost in (2, 2):                                      # its commit is lost, twice
        commit = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits/{lost}")
        commit.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(commit, False)
        run(spark, source, target, ledger, checkpoint, pipeline_with_filter(), fmt)
    assert sorted(map(str, read_ledger(spark, ledger).collect())) == before
    assert sorted(r["batch_id"] for r in read_ledger(spark, ledger).collect()) == [0, 1, 2]
    schema = "k string, s string" if fmt == "csv" else "k long, s string"
    reader = spark.read.schema(schema).options(header=True, multiLine=fmt == "json")
    back = spark.read.parquet(target) if fmt == "parquet" else reader.format({"ndjson": "json"}.get(fmt, fmt)).load(target)
    assert back.count() == 149


def test_a_crash_between_the_rows_and_the_ledger(spark, out, monkeypatch):
    """The rows are written, the ledger is not: the batch runs again, and is there and counted once."""
    from tapline.streaming import stream as module

    source, target, ledger, checkpoint = out(), out(), out(), out()
    batch(spark, source, 0, 100)
    real = module.write_output

    def dying(*args, **kwargs):
        real(*args, **kwargs)
        raise RuntimeError("died")

    monkeypatch.setattr(module, "write_output", dying)
    with pytest.raises(Exception, match="died"):
        run(spark, source, target, ledger, checkpoint, pipeline_with_filter())
    assert not os.path.exists(local(ledger))
    monkeypatch.setattr(module, "write_output", real)
    run(spark, source, target, ledger, checkpoint, pipeline_with_filter())
    assert totals(spark, ledger) == (100, 49, 50, 1)
    written = [json.load(open(os.path.join(d, n))) for d, _, names in os.walk(local(target)) for n in names if n.startswith("part-")]
    assert sum(map(len, written)) == 49


def test_a_ledger_without_steps_and_a_wrong_pipeline(spark, out):
    source, target, ledger = out(), out(), out()
    batch(spark, source, 0, 40)
    run(spark, source, target, ledger, out(), Pipeline())
    assert totals(spark, ledger) == (40, 40, 0, 0)
    with pytest.raises(TransformError, match='unknown column "nope"'):
        run(spark, source, out(), out(), out(), build_pipeline(inline=["mask:nope"]))


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {n for top in dirs for _, _, names in os.walk(top) for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def soon(condition):
    """Spark deletes shuffle files a moment after the query."""
    for _ in range(100):
        if condition():
            return True
        time.sleep(0.1)
    return False


def test_the_query_of_parts_holds_one_kind_at_a_time(spark, tmp_path, monkeypatch):
    """The shuffle of a kind goes when it is written, its parts before the next kind is written."""
    import __spark_entry__ as entry

    made = spark.range(0, 500, 1, 4).select(
        F.when(F.col("id") % 7 > 0, F.col("id") % 90).alias("l_orderkey"), F.concat(F.lit('é, "'), F.col("id")).alias("l_comment"),
        F.when(F.col("id") % 5 > 0, F.col("id") / 3).alias("l_tax"))
    made.union(made.filter("id < 50")).write.parquet(f"{tmp_path}/lineitem.parquet")
    seen = []
    folders = lambda: {n for n in os.listdir(local(shared_dir(spark)).replace("///", "/")) if n.startswith("tapline-parts-")}
    there, real = folders(), write_parts

    def watched(df, path, fmt):
        earlier, before = folders() - there, shuffle_files(spark)
        manifest = real(df, path, fmt)
        seen.append((fmt, earlier, soon(lambda: not shuffle_files(spark) - before)))
        return manifest

    monkeypatch.setattr(entry, "write_parts", watched)
    found = [tuple(r) for r in entry.q_manifest_parts(spark, str(tmp_path)).collect()]
    assert found == [(fmt, 6, 550, 550, 0) for fmt in ("parquet", "ndjson", "csv")]
    assert seen == [(fmt, set(), True) for fmt in ("parquet", "ndjson", "csv")]
    assert folders() == there


def test_shuffles_are_freed_where_asked_for(spark, out):
    key, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", shuffle_files(spark)
    was, dealt = spark.conf.get(key, None), rows(spark).repartition(3, "id")
    with shuffles_freed(spark):
        write_parts(dealt, out(), "ndjson")
        assert soon(lambda: not shuffle_files(spark) - before)
    assert spark.conf.get(key, None) == was
    with pytest.raises(RuntimeError), shuffles_freed(spark):
        raise RuntimeError
    assert spark.conf.get(key, None) == was
    assert dealt.count() == dealt.count() == rows(spark).count()


def test_only_scratch_is_dropped(spark, out, tmp_path):
    path, other = out(), out()
    for p in (path, other):
        write_parts(rows(spark), p, "csv")
    drop_scratch(spark, path)
    drop_scratch(spark, path)                                # nothing there: nothing to do
    assert not os.path.exists(local(path)) and damaged_parts(spark, other).count() == 0
    for wrong in (str(tmp_path), shared_dir(spark), f"{other}/..", f"{other}/part", f"{shared_dir(spark)}/other"):
        with pytest.raises(TaplineError, match="Not a scratch path"):
            drop_scratch(spark, wrong)
    assert damaged_parts(spark, other).count() == 0
