"""Each built-in step: its schema effect, its row effect and its error text."""

from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tapline import TransformError, build_pipeline


def run(df, *inline, doc=None):
    return build_pipeline(doc, inline).apply(df)


def rows(df):
    return [r.asDict() for r in df.orderBy(df.columns[0]).collect()]


def test_rename_keeps_position(bookings):
    out = run(bookings, "rename:room_code=room")
    assert out.columns == ["booking_id", "room", "attendees", "cancelled", "amount"]


def test_rename_to_itself_is_allowed(bookings):
    assert run(bookings, "rename:room_code=room_code").columns == bookings.columns


def test_rename_rejects_existing_target(bookings):
    with pytest.raises(TransformError, match='column "attendees"'):
        run(bookings, "rename:room_code=attendees")


def test_names_are_case_sensitive(bookings):
    with pytest.raises(TransformError, match='unknown column "Room_Code"'):
        run(bookings, "rename:Room_Code=room")
    # a rename that differs only in case creates a new, distinct name
    assert run(bookings, "rename:room_code=Room_Code").columns[1] == "Room_Code"


def test_drop_requires_every_column(bookings):
    assert run(bookings, "drop:cancelled,amount").columns == ["booking_id", "room_code", "attendees"]
    with pytest.raises(TransformError, match='unknown column "nope"'):
        run(bookings, "drop:cancelled,nope")


def test_drop_everything_is_refused(bookings):
    with pytest.raises(TransformError, match="leaves no column"):
        run(bookings, "drop:booking_id,room_code,attendees,cancelled,amount")


def test_keep_restricts_and_reorders(bookings):
    assert run(bookings, "keep:amount,booking_id").columns == ["amount", "booking_id"]


def test_keep_rejects_duplicates(bookings):
    with pytest.raises(TransformError, match='column "amount"'):
        run(bookings, "keep:amount,amount")


def test_add_static_appends_strings_and_nulls(bookings):
    out = run(bookings, doc=[{"type": "addStatic", "fields": {"source": "erp", "empty": None}}])
    assert out.columns[-2:] == ["source", "empty"]
    assert out.schema["empty"].dataType == T.StringType()
    assert {(r.source, r.empty) for r in out.collect()} == {("erp", None)}


def test_add_static_rejects_clash(bookings):
    with pytest.raises(TransformError, match='column "amount"'):
        run(bookings, "addStatic:amount=1")


def test_default_keeps_type(bookings):
    out = run(bookings, "default:amount=0")
    assert out.schema["amount"].dataType == T.DecimalType(12, 2)
    assert [r["amount"] for r in rows(out)] == [Decimal("123.45"), Decimal("456.78"), Decimal("0.00")]


@pytest.mark.parametrize("column,value", [("attendees", "x"), ("attendees", "1.5"), ("cancelled", "yes"),
                                          ("cancelled", "1"), ("amount", "abc"), ("amount", "1.234")])
def test_default_rejects_bad_literal_before_rows(bookings, column, value):
    with pytest.raises(TransformError, match=f'"{value}" .*column "{column}"'):
        run(bookings, f"default:{column}={value}")


def test_default_boolean_any_case(spark):
    df = spark.sql("SELECT CAST(NULL AS BOOLEAN) AS flag")
    assert run(df, "default:flag= TRUE ").collect()[0].flag is True


def test_map_keep_default_fail(bookings):
    keep = run(bookings, "map:room_code=A-101>Alpha")
    assert [r["room_code"] for r in rows(keep)] == ["Alpha", "Alpha", "B-202"]
    default = run(bookings, doc=[{"type": "map", "column": "room_code", "mapping": {"A-101": "Alpha"},
                                  "unmatched": "default", "default": "Other"}])
    assert [r["room_code"] for r in rows(default)] == ["Alpha", "Alpha", "Other"]
    with pytest.raises(Exception, match='no mapping for a value in column "room_code"'):
        run(bookings, doc=[{"type": "map", "column": "room_code", "mapping": {"A-101": "Alpha"},
                            "unmatched": "fail"}]).collect()


def test_map_matches_text_form_and_nulls_stay_null(bookings):
    out = run(bookings, "map:attendees=10>ten", "map:amount=123.45>cheap")
    assert out.schema["attendees"].dataType == T.StringType()
    got = rows(out)
    assert [r["attendees"] for r in got] == ["ten", "15", "4"]
    assert [r["amount"] for r in got] == ["cheap", "456.78", None]


def test_map_value_may_be_null(bookings):
    out = run(bookings, doc=[{"type": "map", "column": "room_code", "mapping": {"B-202": None}}])
    assert [r["room_code"] for r in rows(out)] == ["A-101", "A-101", None]


def test_map_config_errors():
    with pytest.raises(TransformError, match='"unmatched" needs one of keep, default, fail'):
        build_pipeline([{"type": "map", "column": "a", "mapping": {"x": "y"}, "unmatched": "drop"}])
    with pytest.raises(TransformError, match='"default" is missing'):
        build_pipeline([{"type": "map", "column": "a", "mapping": {"x": "y"}, "unmatched": "default"}])
    with pytest.raises(TransformError, match='"mapping" needs at least one entry'):
        build_pipeline([{"type": "map", "column": "a", "mapping": {}}])


def test_mask_tokens_and_nulls(bookings):
    out = run(bookings, doc=[{"type": "mask", "columns": "booking_id, amount", "mask": "###"}])
    got = rows(out.withColumnRenamed("booking_id", "b"))
    assert [r["b"] for r in got] == ["###", "###", "###"]
    assert sorted(r["amount"] or "" for r in got) == ["", "###", "###"]
    assert out.schema["amount"].metadata.get("sensitive") is True


def test_mask_unknown_column(bookings):
    with pytest.raises(TransformError, match='Transform "mask" references unknown column "email"'):
        run(bookings, "mask:email")


def test_template_renders_nulls_as_empty(bookings):
    out = run(bookings, "template:summary={room_code} x{attendees} ({amount})")
    assert [r["summary"] for r in rows(out)] == ["A-101 x10 (123.45)", "A-101 x15 (456.78)", "B-202 x4 ()"]


def test_template_validates_placeholders_and_name(bookings):
    with pytest.raises(TransformError, match='unknown column "room"'):
        run(bookings, "template:summary={room}")
    with pytest.raises(TransformError, match='column "amount"'):
        run(bookings, "template:amount=x")


def test_expression_concat_and_conditional(spark):
    df = spark.createDataFrame([("Jane", "Citizen", "Y"), ("Joe", "Bloggs", "N")],
                               "firstName string, lastName string, activeFlag string")
    out = run(df, doc=[{"type": "expression", "outputField": "displayName",
                        "expression": "concat(lastName, ', ', firstName)"},
                       {"type": "expression", "outputField": "status",
                        "expression": "CASE WHEN activeFlag = 'Y' THEN 'ACTIVE' ELSE 'INACTIVE' END"}])
    got = {r.firstName: (r.displayName, r.status) for r in out.collect()}
    assert got == {"Jane": ("Citizen, Jane", "ACTIVE"), "Joe": ("Bloggs, Joe", "INACTIVE")}
    assert out.schema["displayName"].dataType == T.StringType()


def test_expression_result_is_text(bookings):
    out = run(bookings, "expression:double=attendees * 2")
    assert sorted(r.double for r in out.collect()) == ["20", "30", "8"]


def test_expression_errors_fail_before_rows(bookings):
    with pytest.raises(TransformError, match="invalid expression"):
        build_pipeline(inline=["expression:x=attendees +"])
    with pytest.raises(TransformError, match='unknown column "attendeez"'):
        run(bookings, "expression:x=attendeez + 1")
    with pytest.raises(TransformError, match="calls into the JVM"):
        run(bookings, "expression:x=reflect('java.lang.System', 'exit', 1)")
    with pytest.raises(TransformError, match='column "amount"'):
        run(bookings, "expression:amount=1")


def test_expression_sees_previous_steps(bookings):
    out = run(bookings, "rename:room_code=room", "expression:tag=concat(room, '!')")
    assert sorted(r.tag for r in out.collect()) == ["A-101!", "A-101!", "B-202!"]


def test_large_mapping_uses_buckets_and_matches(spark):
    df = spark.range(0, 3000).selectExpr("id", "CAST(id AS STRING) AS code")
    mapping = {str(i): (None if i % 97 == 0 else f"v{i}") for i in range(0, 2500)}
    out = build_pipeline([{"type": "map", "column": "code", "mapping": mapping, "unmatched": "default",
                           "default": "other"}]).apply(df)
    got = {r.id: r.code for r in out.collect()}
    for i in range(3000):
        expected = "other" if i >= 2500 else mapping[str(i)]
        assert got[i] == expected, i
    failing = build_pipeline({"errorStrategy": "skipRow", "transforms": [
        {"type": "map", "column": "code", "mapping": mapping, "unmatched": "fail"}]}).apply(df)
    assert failing.count() == 2500


def test_builtins_declare_capabilities():
    from tapline import default_registry
    from tapline.operators import StepSpec

    registry = default_registry()
    changing = [("rename", {"from": "a", "to": "b"}), ("drop", {"columns": ["a"]}), ("keep", {"columns": ["a"]}),
                ("addStatic", {"fields": {"s": "1"}}), ("template", {"name": "f", "template": "{a}"}),
                ("expression", {"outputField": "f", "expression": "a"})]
    for kind, config in changing:
        assert registry.create(StepSpec(kind, config)).capabilities.schema_changing, kind
    in_place = [("mask", {"column": "a"}), ("default", {"column": "a", "value": "x"}),
                ("map", {"column": "a", "mapping": {"A": "B"}})]
    for kind, config in in_place:
        caps = registry.create(StepSpec(kind, config)).capabilities
        assert (caps.schema_changing, caps.row_level, caps.deterministic) == (False, True, True), kind
