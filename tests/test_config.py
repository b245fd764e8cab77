"""Configuration: JSON documents, inline shorthand, precedence and names."""

import json
from datetime import datetime, timezone

import pytest

from tapline import TransformError, build_pipeline, load_config
from tapline.plans import load_config_file, parse_inline, render_output

SHORTHANDS = {
    "rename: o_orderkey =key": {"from": "o_orderkey", "to": "key"},
    "drop:c_acctbal,c_comment": {"columns": "c_acctbal,c_comment"},
    "keep:n_name": {"columns": "n_name"},
    "addStatic:origin=warehouse 7,grade=": {"fields": "origin=warehouse 7,grade="},
    "default:p_size=0": {"column": "p_size", "value": "0"},
    "mask:c_name": {"column": "c_name"},
    "mask:c_name=[hidden]": {"column": "c_name", "mask": "[hidden]"},
    "map:r_name=ASIA>east,EUROPE>west": {"column": "r_name", "mapping": "ASIA>east,EUROPE>west"},
    "template:tag={n_name}={n_regionkey}": {"name": "tag", "template": "{n_name}={n_regionkey}"},
    "expression:big=l_quantity >= 30": {"outputField": "big", "expression": "l_quantity >= 30"},
}


@pytest.mark.parametrize("raw", SHORTHANDS)
def test_shorthand_gives_the_same_step_as_a_document(raw):
    spec = parse_inline(raw)
    assert spec.config == SHORTHANDS[raw]
    step = build_pipeline(inline=[raw]).steps[0].step
    again = build_pipeline([{"type": spec.type, **spec.config}]).steps[0].step
    assert {k: v for k, v in vars(step).items()} == {k: v for k, v in vars(again).items()}


def test_lists_and_entries_of_shorthands():
    keep, static, mapped = (p.step for p in build_pipeline(inline=["keep: a, b ,", "addStatic:x= 1 ,y=", "map:k= A > 1 ,B>2"]).steps)
    assert keep.columns == ["a", "b"]
    assert static.fields == {"x": " 1 ", "y": ""}
    assert mapped.mapping == {"A": "1", "B": "2"}


@pytest.mark.parametrize("raw", ["rename", "rename:ab", "default:x", "template:t", "addStatic:nothing"])
def test_unreadable_shorthands_tell_the_form(raw):
    with pytest.raises(TransformError, match=f"write {raw.partition(':')[0]}:<"):
        parse_inline(raw)


def test_unknown_shorthands_and_entries_without_a_sign():
    with pytest.raises(TransformError, match="No transform has a shorthand"):
        parse_inline("shuffle:a")
    with pytest.raises(TransformError, match='"mapping" needs entries of the form key>value'):
        build_pipeline(inline=["map:c=A-1"])


def test_document_forms_and_precedence():
    steps = [{"type": "drop", "columns": ["n_comment"]}]
    full = {"transforms": steps, "errorStrategy": "KEEPoriginal", "validateOutput": {"requiredFields": ["n_name"]}}
    for document in (steps, json.dumps(steps), full, json.dumps(full)):
        assert [s.type for s in load_config(document, inline=["mask:n_name", "keep:n_name"]).specs] == ["drop", "mask", "keep"]
    assert load_config(full).error_strategy == "keepOriginal"
    assert load_config(full, error_strategy="skiprow").error_strategy == "skipRow"
    assert load_config(full).contract.required == {"n_name"}
    assert load_config({**full, "validateOutput": {"enabled": False, "requiredFields": ["x"]}}).contract is None
    assert load_config().specs == []


@pytest.mark.parametrize("document,match", [
    ({"pipeline": []}, "expected an array"), ("7", "expected an array"), ([{"columns": "a"}], 'object with a "type"'),
    ([3], 'object with a "type"'), ({"transforms": [], "errorStrategy": "ignore"}, "Unknown errorStrategy")])
def test_wrong_documents(document, match):
    with pytest.raises(TransformError, match=match):
        load_config(document)


def test_all_problems_of_a_step_are_told_at_once():
    with pytest.raises(TransformError, match='Transform "rename": "from" needs a text that is not blank; "to" is missing'):
        build_pipeline([{"type": "rename", "from": " "}])
    with pytest.raises(TransformError, match='"columns" needs at least one column name'):
        build_pipeline(inline=["drop: , "])
    with pytest.raises(TransformError, match="it lacks a, b; it must not hold c"):
        load_config({"transforms": [], "validateOutput": {"requiredFields": ["b", "a"], "failOnUnknownFields": "TRUE"}}
                    ).contract.validate(["c"])


def test_names_of_steps():
    twice = [{"type": "mask", "name": "cover", "column": c} for c in "xy"]
    with pytest.raises(TransformError, match='named "cover"'):
        build_pipeline(twice)
    pipeline = build_pipeline([{"type": "mask", "name": " ", "column": "x"}, {"type": "mask", "column": "y"}])
    assert [s.name for s in pipeline.steps] == ["mask", "mask"]
    assert pipeline.sensitive_columns() == ["x", "y"]


def test_files_that_cannot_be_read(tmp_path):
    broken = tmp_path / "broken.json"
    broken.write_text("[{]")
    for path in (broken, tmp_path / "absent.json"):
        with pytest.raises(TransformError, match="Failed to read transforms file"):
            load_config_file(str(path))


def test_render_output_pattern():
    when = datetime(2026, 6, 14, 9, 5, 7, tzinfo=timezone.utc)
    got = render_output("exports/orders_{date}/{time}/{datetime}-{ts}-{timestamp}.parquet", when, timezone.utc)
    assert got == "exports/orders_2026-06-14/090507/2026-06-14_090507-1781427907000-1781427907000.parquet"
    assert render_output(None) is None
