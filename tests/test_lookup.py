"""Maps from a mapping table: all modes, both joins, awkward keys, skew; and what the plan of an expression guards."""

import random

import pytest
from pyspark.sql import functions as F

from tapline import TransformError, build_pipeline
from tapline.operators import ExpressionStep, MapTableStep
from tapline.operators.lookup import hot_keys
from tapline.plans import Pipeline
from tapline.plans.pipeline import _expression_nodes, can_raise

BOTH = pytest.mark.parametrize("limit", [None, 0], ids=["broadcast", "merge"])


@pytest.fixture
def mapping(spark):
    rows = [("a", "Alpha"), ("a", "Alpha"), ("b", None), (None, "nothing"), ("10", "ten"), ("", "empty"), ("x'\"\\", "odd")]
    return spark.createDataFrame(rows, "k string, v string")


def mapped(df, mapping, limit, **options):
    strategy = options.pop("error_strategy", "fail")
    step = MapTableStep("c", mapping, "k", "v", broadcast_bytes=limit, **options)
    return Pipeline.of(step, error_strategy=strategy).plan(df)


@BOTH
def test_modes(spark, mapping, limit):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "zz"), (5, ""), (6, "x'\"\\"), (6, "x'\"\\")], "id int, c string")
    keep = sorted(tuple(r) for r in mapped(df, mapping, limit).df.collect())
    assert keep == sorted([(1, "Alpha"), (2, None), (3, None), (4, "zz"), (5, "empty"), (6, "odd"), (6, "odd")], key=lambda r: r[0])
    default = {r["id"]: r["c"] for r in mapped(df, mapping, limit, unmatched="default", default="?").df.collect()}
    assert default == {1: "Alpha", 2: None, 3: None, 4: "?", 5: "empty", 6: "odd"}
    skipped = mapped(df, mapping, limit, unmatched="fail", error_strategy="skipRow")
    assert sorted(r["id"] for r in skipped.df.collect()) == [1, 2, 3, 5, 6, 6]
    assert skipped.metrics()["rows_dropped_by_error"] == 1
    original = {r["id"]: r["c"] for r in mapped(df, mapping, limit, unmatched="fail", error_strategy="keepOriginal").df.collect()}
    assert original[4] == "zz" and original[1] == "Alpha"
    with pytest.raises(Exception, match="no mapping for a value in column"):
        mapped(df, mapping, limit, unmatched="fail").df.collect()


@BOTH
def test_numbers_are_matched_as_text(spark, mapping, limit):
    df = spark.createDataFrame([(10,), (11,), (None,)], "c int")
    assert sorted(str(r["c"]) for r in mapped(df, mapping, limit).df.collect()) == ["11", "None", "ten"]


@BOTH
def test_a_key_with_two_values_is_an_error(spark, mapping, limit):
    twice = mapping.unionByName(spark.createDataFrame([("a", "Other"), ("b", "Beta")], "k string, v string"))
    with pytest.raises(TransformError, match="2 keys of the mapping table have more than one value"):
        mapped(spark.createDataFrame([("a",)], "c string"), twice, limit)


@BOTH
def test_empty_tables(spark, mapping, limit):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert sorted(str(r["c"]) for r in mapped(df, mapping.limit(0), limit).df.collect()) == ["None", "a"]
    assert mapped(df.limit(0), mapping, limit).df.count() == 0


def test_unknown_names(spark, mapping):
    df = spark.createDataFrame([("a",)], "c string")
    with pytest.raises(TransformError, match='one column "nope"'):
        Pipeline.of(MapTableStep("c", mapping, "nope", "v")).plan(df)
    with pytest.raises(TransformError, match='there is no table "no_such_view"'):
        build_pipeline({"transforms": [{"type": "map", "column": "c", "table": "no_such_view", "key": "k", "value": "v"}]}).plan(df)
    with pytest.raises(TransformError, match='either "mapping" or "table"'):
        build_pipeline({"transforms": [{"type": "map", "column": "c", "table": "t", "mapping": {"a": "b"}, "key": "k", "value": "v"}]})
    with pytest.raises(TransformError, match='"key" is missing'):
        build_pipeline({"transforms": [{"type": "map", "column": "c", "table": "t", "value": "v"}]})


def test_the_schema_is_known_without_reading_a_table(spark, mapping):
    bad = mapping.withColumn("v", F.raise_error(F.lit("read")).cast("string"))
    df = spark.createDataFrame([("a",)], "c string")
    assert Pipeline.of(MapTableStep("c", bad, "k", "v")).output_schema(df).fieldNames() == ["c"]


def test_two_table_maps_and_later_steps(spark, mapping):
    mapping.createOrReplaceTempView("codes")
    df = spark.createDataFrame([("a", "zz", 1), ("zz", "a", 2)], "c string, d string, id int")
    spec = {"type": "map", "table": "codes", "key": "k", "value": "v"}
    out = build_pipeline({"errorStrategy": "skipRow", "transforms": [
        {**spec, "column": "c", "unmatched": "fail"}, {**spec, "column": "d"}, {"type": "rename", "from": "c", "to": "k"}]}).apply(df)
    assert [tuple(r) for r in out.collect()] == [("Alpha", "zz", 1)]


def test_hot_keys_are_split_over_partitions(spark):
    """One key with 40 % of the rows, and null keys with 20 %: no task of the merge join gets much more than its share."""
    rng = random.Random(3)
    rows = [(i, rng.choice(["hot", "hot", None, str(i % 500), str(i % 499)])) for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, c string").repartition(6)
    table = spark.createDataFrame([("hot", "Hot")] + [(str(k), f"n{k}") for k in range(0, 500, 2)], "k string, v string")
    names = dict(table.collect())
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = hot_keys(df, "c", 8)
        assert set(hot) == {"hot"} and hot["hot"] >= 6
        out = mapped(df, table, 0).df
        got = {r["id"]: r["c"] for r in out.collect()}
        assert got == {i: names.get(c, c) for i, c in rows}
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 2.2 * len(rows) / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


@pytest.mark.parametrize("text,raises", [
    ("s || ' / ' || t", False), ("CASE WHEN s = 'F' THEN 'x' ELSE t END", False), ("cast(i as string)", False),
    ("concat(s, i)", False), ("upper(trim(coalesce(s, 'x')))", False), ("if(i > 1 AND d < 2.5, left(s, 2), t)", False),
    ("nullif(s, t)", False), ("s IN ('a', 'b')", False), ("i / 0", True), ("cast(s AS int)", True), ("i + 1", True),
    ("raise_error('x')", True), ("element_at(split(s, ','), 3)", True), ("i > s", True), ("regexp_replace(s, t, '')", True),
    ("CASE WHEN i = 0 THEN s ELSE cast(1 / i AS string) END", True), ("cast(d AS int)", True), ("cast(l AS double) > 1", False)])
def test_only_what_can_raise_is_guarded(spark, text, raises):
    df = spark.createDataFrame([("a", "b", 1, 2, 2.0)], "s string, t string, i int, l long, d double")
    assert can_raise(_expression_nodes(df.select(F.expr(text).alias("o")))[0]) is raises
    planned = Pipeline.of(ExpressionStep("o", text), error_strategy="skipRow").plan(df)
    assert planned.stops is raises
    assert ("lambda" in planned.df._jdf.queryExecution().executedPlan().toString()) is raises


def test_guarded_and_plain_expressions_agree(spark):
    df = spark.createDataFrame([("a", 1, 2.5, True), (None, None, None, None), ("", 0, float("nan"), False)], "s string, i int, d double, b boolean")
    for text in ["s", "i", "d", "b", "concat(s, i)", "i = 1", "coalesce(d, 1.5)"]:
        plain = [r["o"] for r in Pipeline.of(ExpressionStep("o", text)).apply(df).collect()]
        guarded = [r["o"] for r in Pipeline.of(ExpressionStep("o", f"if(1 / 1 = 1, {text}, NULL)")).apply(df).collect()]
        assert plain == guarded, text


def test_registered_expressions_stay_in_generated_code(spark):
    import __spark_entry__ as entry

    plans = {name: entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
             for name in ("flagship", "expression")}
    assert "lambda" not in plans["flagship"] and "tryeval" not in plans["flagship"].lower()
    assert plans["expression"].lower().count("lambda ") == 1     # a product of whole numbers may overflow; the others cannot
