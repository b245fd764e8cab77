"""Property check: any text survives CSV, TSV and NDJSON unchanged when parsed back."""

import csv
import glob
import io
import json
import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tapline import export

TEXT = st.text(alphabet=st.characters(blacklist_categories=("Cs",), max_codepoint=0x2FFF)
               | st.sampled_from(['"', ",", "\t", "\r", "\n", " ", "#", "=", "-", "'"]),
               max_size=12)


def _read(path):
    return "".join(open(p, encoding="utf-8", newline="").read()
                   for p in sorted(glob.glob(os.path.join(path.replace("file:", ""), "part-*"))))


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(TEXT, st.one_of(st.none(), TEXT)), min_size=1, max_size=40))
def test_text_round_trips(spark, out, rows):
    data = [(i, a, b) for i, (a, b) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, a string, b string").coalesce(1)
    for fmt, sep in (("csv", ","), ("tsv", "\t")):
        path = out(fmt)
        export(spark, df=df, fmt=fmt, output=path, null_value="<null>")
        parsed = list(csv.reader(io.StringIO(_read(path)), delimiter=sep))
        assert parsed[0] == ["id", "a", "b"]
        got = {int(r[0]): (r[1], r[2]) for r in parsed[1:]}
        assert got == {i: (a, "<null>" if b is None else b) for i, a, b in data}
    path = out("ndjson")
    export(spark, df=df, fmt="ndjson", output=path)
    lines = [json.loads(line) for line in _read(path).split("\n") if line]
    assert {r["id"]: (r["a"], r["b"]) for r in lines} == {i: (a, b) for i, a, b in data}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(TEXT, min_size=1, max_size=60))
def test_header_and_data_cells_quote_alike(spark, values):
    from tapline.sinks.formats import delimited_lines, quote_cell

    for sep in (",", "\t"):
        df = spark.createDataFrame([(v, v) for v in values], "a string, b string")
        lines, _ = delimited_lines(df, sep=sep, header=False)
        got = [r.value for r in lines.collect()]
        assert got == [quote_cell(v, True, sep) + sep + quote_cell(v, False, sep) for v in values]
