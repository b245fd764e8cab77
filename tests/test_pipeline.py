"""Pipeline rules: order, drops, error strategies, keepOriginal limits, shape checks, metrics."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapline import Pipeline, StepRegistry, TransformError, build_pipeline, export, load_config
from tapline.operators import COLUMN_CHANGING, ColumnStep, PandasStep, StepOutput
from tapline.operators.custom import filter_provider, uppercase_provider

FAIL_ON_B202 = {"type": "map", "column": "room_code", "mapping": {"A-101": "A-101"}, "unmatched": "fail"}


def test_empty_pipeline_is_untouched(bookings):
    p = build_pipeline()
    assert p.is_empty()
    assert p.apply(bookings) is bookings


def test_steps_run_in_order(bookings):
    # rename first, then the template must use the new name
    out = build_pipeline(inline=["rename:room_code=room", "template:t={room}"]).apply(bookings)
    assert out.columns[-1] == "t"
    with pytest.raises(TransformError, match='unknown column "room_code"'):
        build_pipeline(inline=["rename:room_code=room", "template:t={room_code}"]).apply(bookings)


def test_skip_row_counts_error_drops(bookings):
    p = build_pipeline({"errorStrategy": "skipRow", "transforms": [{"type": "mask", "column": "booking_id"},
                                                                  FAIL_ON_B202]})
    planned = p.plan(bookings)
    got = sorted((r.booking_id, r.room_code) for r in planned.df.collect())
    assert got == [("***", "A-101"), ("***", "A-101")]
    m = planned.metrics()
    assert (m["rows_in"], m["rows_out"], m["rows_dropped"], m["rows_dropped_by_error"]) == (3, 2, 1, 1)
    assert [s["failures"] for s in m["steps"]] == [0, 1]


def test_fail_aborts_without_row_values(bookings):
    p = build_pipeline({"transforms": [FAIL_ON_B202]})
    with pytest.raises(Exception) as info:
        p.apply(bookings).collect()
    text = str(info.value)
    assert 'Transform "map" failed at row ' in text and " of part " in text
    assert "B-202" not in text.split("Transform")[1].split("\n")[0]


def test_fail_strategy_is_not_pruned(bookings):
    # the failing column is dropped later; the row failure must still abort
    p = build_pipeline({"transforms": [FAIL_ON_B202, {"type": "drop", "columns": "room_code"}]})
    with pytest.raises(Exception, match='Transform "map" failed'):
        p.apply(bookings).collect()


def test_keep_original_emits_input_row(bookings):
    p = build_pipeline({"errorStrategy": "keepOriginal", "transforms": [
        {"type": "map", "column": "booking_id", "mapping": {"B001": "one", "B003": "three"}},
        FAIL_ON_B202]})
    got = sorted((r.booking_id, r.room_code) for r in p.apply(bookings).collect())
    assert got == [("B002", "A-101"), ("B003", "B-202"), ("one", "A-101")]


@pytest.mark.parametrize("step,reason", [("mask:booking_id", "masks columns"),
                                         ("rename:room_code=room", "renames or adds"),
                                         ("addStatic:x=1", "renames or adds")])
def test_keep_original_is_refused(bookings, step, reason):
    p = build_pipeline(inline=[step], error_strategy="keepOriginal")
    with pytest.raises(TransformError, match=reason):
        p.apply(bookings)


def test_keep_original_allows_drop_and_reorder(bookings):
    p = build_pipeline(inline=["drop:cancelled", "keep:amount,booking_id"], error_strategy="keepOriginal")
    assert p.apply(bookings).columns == ["amount", "booking_id"]


def test_filter_step_drops_rows_as_filtered(bookings):
    registry = StepRegistry({"filter": filter_provider})
    p = registry.build(load_config([{"type": "filter", "condition": "attendees > 5"}, FAIL_ON_B202],
                                   error_strategy="skipRow"))
    planned = p.plan(bookings)
    assert sorted(r.booking_id for r in planned.df.collect()) == ["B001", "B002"]
    m = planned.metrics()
    # B003 is dropped by the filter first; the later failing step never sees it
    assert (m["rows_dropped"], m["rows_dropped_by_error"], m["rows_dropped_by_filter"]) == (1, 0, 1)
    assert [s["invocations"] for s in m["steps"]] == [3, 2]
    assert [s["failures"] for s in m["steps"]] == [0, 0]


def test_custom_provider_and_registry_rules(bookings):
    registry = StepRegistry({"uppercase": uppercase_provider})
    out = registry.build(load_config([{"type": "uppercase", "column": "booking_id"}])).apply(bookings)
    assert sorted(r.booking_id for r in out.collect()) == ["B001", "B002", "B003"]
    with pytest.raises(TransformError, match='type "uppercase" is registered already'):
        registry.register("uppercase", uppercase_provider)
    with pytest.raises(TransformError, match='type "rename" is registered already'):
        StepRegistry({"rename": uppercase_provider})
    with pytest.raises(TransformError, match="there are addStatic, default, drop"):
        registry.build(load_config([{"type": "nope"}]))


def test_declared_shape_is_checked(bookings):
    def fn(row):
        return StepOutput(row.passthrough() + [("extra", F.lit("x"))])

    step = ColumnStep("shaper", fn, declare=lambda names: names + ["promised"])
    with pytest.raises(TransformError, match="breaks its declaration"):
        Pipeline.of(step).apply(bookings)


def test_pandas_step_keep_and_fail(bookings):
    def fn(batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"booking_id": batch["booking_id"], "size": batch["attendees"] * 2,
                             "__keep__": batch["attendees"] > 4, "__fail__": batch["booking_id"] == "B002"})

    step = PandasStep("sizer", fn, T.StructType([T.StructField("booking_id", T.StringType()),
                                                  T.StructField("size", T.LongType())]))
    planned = Pipeline.of(step, error_strategy="skipRow").plan(bookings)
    assert [(r.booking_id, r.size) for r in planned.df.collect()] == [("B001", 20)]
    m = planned.metrics()
    assert (m["rows_dropped_by_error"], m["rows_dropped_by_filter"]) == (1, 1)


def test_output_contract(bookings):
    doc = {"validateOutput": {"requiredFields": ["room"]}, "transforms": [{"type": "drop", "columns": "cancelled"}]}
    with pytest.raises(TransformError, match='it lacks room'):
        build_pipeline(doc).apply(bookings)
    doc = {"validateOutput": {"requiredFields": ["booking_id"], "optionalFields": ["amount"],
                              "failOnUnknownFields": True},
           "transforms": [{"type": "keep", "columns": ["booking_id", "amount", "attendees"]}]}
    with pytest.raises(TransformError, match='must not hold attendees'):
        build_pipeline(doc).apply(bookings)
    doc["validateOutput"]["enabled"] = False
    assert build_pipeline(doc).apply(bookings).columns == ["booking_id", "amount", "attendees"]


def test_stop_code_skips_later_steps(spark):
    # a row that failed must not be evaluated by a later expression that would raise on it
    df = spark.createDataFrame([("1",), ("x",)], "v string")
    p = build_pipeline({"errorStrategy": "skipRow", "transforms": [
        {"type": "map", "column": "v", "mapping": {"1": "1"}, "unmatched": "fail"},
        {"type": "expression", "outputField": "n", "expression": "CAST(v AS INT) + 1"}]})
    assert [(r.v, r.n) for r in p.apply(df).collect()] == [("1", "2")]


def test_fixtures(spark):
    """Data-driven fixtures: {transforms, input, expected} (subset match) or dropped."""
    here = os.path.join(os.path.dirname(__file__), "fixtures")
    for name in sorted(os.listdir(here)):
        with open(os.path.join(here, name)) as handle:
            fixture = json.load(handle)
        df = spark.createDataFrame([fixture["input"]])
        df = df.select(*fixture["input"].keys())
        out = build_pipeline(fixture).apply(df).collect()
        if fixture.get("dropped"):
            assert out == [], name
        else:
            got = out[0].asDict()
            for key, value in fixture["expected"].items():
                assert got[key] == value, (name, key)


def test_transforms_file_and_export(spark, bookings, out, tmp_path):
    cfg = tmp_path / "t.json"
    cfg.write_text(json.dumps({"errorStrategy": "skipRow", "transforms": [FAIL_ON_B202]}))
    from tapline.plans import load_config_file

    config = load_config_file(str(cfg), inline=["mask:booking_id"])
    assert [s.type for s in config.specs] == ["map", "mask"]
    result = export(spark, df=bookings, fmt="csv", output=out(), transforms=config)
    assert result.row_count == 2
    assert result.metrics["rows_dropped_by_error"] == 1
    assert result.sensitive_columns == ["booking_id"]
    assert "2 out, 1 dropped" in result.summary()


def test_custom_step_may_copy_a_column(bookings):
    def fn(row):
        return StepOutput(row.passthrough() + [("booking_copy", row["booking_id"])])

    out = Pipeline.of(ColumnStep("copy", fn, capabilities=COLUMN_CHANGING)).apply(bookings)
    assert out.columns[-1] == "booking_copy"
    assert all(r.booking_id == r.booking_copy for r in out.collect())


def test_example_configuration_end_to_end(spark, out):
    from tapline.plans import load_config_file

    here = os.path.join(os.path.dirname(os.path.dirname(__file__)), "examples", "bookings.transforms.json")
    df = spark.sql("SELECT * FROM VALUES ('B001', 'A-101', 10, false, CAST(123.45 AS DECIMAL(12,2))), "
                   "('B002', 'C-303', 15, false, NULL), ('B003', 'B-202', 4, true, NULL) "
                   "AS t(booking_id, room_code, attendees, cancelled, amount)")
    result = export(spark, df=df, fmt="ndjson", output=out("example"), transforms=load_config_file(here))
    assert result.row_count == 2 and result.metrics["rows_dropped_by_error"] == 1
    assert [s["name"] for s in result.metrics["steps"]][:2] == ["room-name", "drop"]
    back = {r["summary"]: r for r in spark.read.json(result.output).collect()}
    assert set(back) == {"Atrium for 10", "Boardroom for 4"}
    atrium = back["Atrium for 10"]
    assert (atrium.booking_id, atrium.band, atrium.origin, atrium.schema_version, atrium.amount) == \
        ("###", "LARGE", "bookings-db", "2", 123.45)
    assert back["Boardroom for 4"].amount == 0
