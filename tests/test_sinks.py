"""Sinks: exact value rules per format, empty results, overwrite guard and staged publish."""

import csv
import glob
import io
import json
import os

import pyarrow.parquet as pq
import pytest

from tapline import OutputError, TransformError, export
from tapline.sinks import json_objects, json_values

EXPECTED_CSV_FIRST = "***,A-101,10,A-101 x10"


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def parts(path, pattern="part-*"):
    return sorted(glob.glob(os.path.join(local(path), pattern)))


def read_text(path):
    return "".join(open(p, encoding="utf-8", newline="").read() for p in parts(path))


def test_csv_with_transforms(spark, bookings, out):
    path = out("csv")
    export(spark, df=bookings, fmt="csv", output=path, single_file=True,
           inline=["rename:room_code=room", "drop:cancelled", "template:summary={room} x{attendees}",
                   "mask:booking_id", "drop:amount"])
    lines = read_text(path).split("\r\n")
    assert lines[0] == "booking_id,room,attendees,summary"
    assert EXPECTED_CSV_FIRST in lines


def test_csv_quoting_and_null_placeholder(spark, out):
    df = spark.createDataFrame([("a,b", 'say "hi"', "line\nbreak", "tab\there", None, "present")],
                               "a string, b string, c string, d string, e string, f string")
    path = out("csvq")
    export(spark, df=df, fmt="csv", output=path, null_value="NULL", single_file=True)
    text = read_text(path)
    assert '"a,b","say ""hi""","line\nbreak",tab\there,NULL,present' in text
    parsed = list(csv.reader(io.StringIO(text)))
    assert parsed[1] == ["a,b", 'say "hi"', "line\nbreak", "tab\there", "NULL", "present"]


def test_tsv_quotes_tabs(spark, out):
    df = spark.createDataFrame([("tab\there", "x")], "a string, b string")
    path = out("tsv")
    export(spark, df=df, fmt="tsv", output=path, single_file=True)
    assert read_text(path) == 'a\tb\r\n"tab\there"\tx\r\n'


def test_formula_guard_only_when_asked(spark, out):
    df = spark.createDataFrame([('=HYPERLINK("http://evil")', "-beta")], "a string, b string")
    plain, guarded = out("plain"), out("guarded")
    export(spark, df=df, fmt="csv", output=plain, single_file=True)
    export(spark, df=df, fmt="csv", output=guarded, escape_formulas=True, single_file=True)
    assert list(csv.reader(io.StringIO(read_text(plain))))[1] == ['=HYPERLINK("http://evil")', "-beta"]
    assert list(csv.reader(io.StringIO(read_text(guarded))))[1] == ['\'=HYPERLINK("http://evil")', "'-beta"]


def test_bom(spark, out):
    df = spark.createDataFrame([("café",)], "name string")
    path = out("bom")
    export(spark, df=df, fmt="csv", output=path, bom=True, single_file=True)
    raw = open(parts(path)[0], "rb").read()
    assert raw.startswith(b"\xef\xbb\xbfname\r\n")
    assert "café" in raw.decode("utf-8")
    # without a header the mark leads the first data line of each part file
    path2 = out("bom2")
    export(spark, df=df, fmt="csv", output=path2, bom=True, header=False, single_file=True)
    assert open(parts(path2)[0], "rb").read() == "\ufeffcafé\r\n".encode("utf-8")


def test_json_values_nulls_numbers_booleans(spark, out):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS missing, 42 AS answer, true AS flag, CAST(1.5 AS DOUBLE) AS ratio")
    path = out("json")
    export(spark, df=df, fmt="json", output=path, single_file=True)
    row = json.loads(read_text(path))[0]
    assert row == {"missing": None, "answer": 42, "flag": True, "ratio": 1.5}
    assert list(row) == ["missing", "answer", "flag", "ratio"]


def test_non_finite_becomes_null(spark, out):
    df = spark.sql("SELECT CAST('NaN' AS DOUBLE) AS nan_col, CAST('Infinity' AS DOUBLE) AS pos_inf, "
                   "CAST('-Infinity' AS DOUBLE) AS neg_inf, CAST('NaN' AS FLOAT) AS f, 1.25 AS finite_col")
    for fmt in ("json", "ndjson"):
        path = out(fmt)
        export(spark, df=df, fmt=fmt, output=path, single_file=True)
        text = read_text(path)
        row = json.loads(text)[0] if fmt == "json" else json.loads(text.splitlines()[0])
        assert (row["nan_col"], row["pos_inf"], row["neg_inf"], row["f"]) == (None, None, None, None)
        assert row["finite_col"] == 1.25


def test_decimals_are_plain(spark):
    df = spark.sql("SELECT CAST(100 AS DECIMAL(10, 0)) AS amount, CAST(0.00000001 AS DECIMAL(20, 8)) AS tiny, "
                   "CAST(0 AS DECIMAL(20, 8)) AS zero, CAST(NULL AS DECIMAL(20, 8)) AS none, 'x' AS s")
    line = json_objects(json_values(df)).collect()[0].value
    assert line == '{"amount":100,"tiny":0.00000001,"zero":0.00000000,"none":null,"s":"x"}'
    pretty = json_objects(json_values(df), pretty=True).collect()[0].value
    assert json.loads(pretty) == json.loads(line)
    assert pretty.startswith('{\n  "amount" : 100,\n  "tiny" : 0.00000001')


def test_json_array_pretty_layout(spark, out):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string").coalesce(1)
    path = out("pretty")
    export(spark, df=df, fmt="json", output=path, pretty=True)
    assert read_text(path) == ('[\n  {\n    "a" : 1,\n    "b" : "x"\n  },\n  {\n    "a" : 2,\n'
                               '    "b" : null\n  }\n]\n')


def test_json_array_each_part_is_an_array(spark, out):
    df = spark.range(0, 1000).withColumnRenamed("id", "n").repartition(4)
    path = out("arrays")
    result = export(spark, df=df, fmt="json", output=path)
    assert result.row_count == 1000
    values = []
    for p in parts(path):
        doc = json.load(open(p))
        assert isinstance(doc, list)
        values += [r["n"] for r in doc]
    assert sorted(values) == list(range(1000))


def test_empty_results(spark, out):
    empty = spark.sql("SELECT 1 AS value WHERE 1 = 0")
    j, c, n, p = out("ej"), out("ec"), out("en"), out("ep")
    assert export(spark, df=empty, fmt="json", output=j).row_count == 0
    assert read_text(j).strip() == "[]"
    export(spark, df=empty, fmt="csv", output=c)
    assert read_text(c) == "value\r\n"
    export(spark, df=empty, fmt="ndjson", output=n)
    assert read_text(n) == ""
    export(spark, df=empty, fmt="parquet", output=p)
    assert spark.read.parquet(p).count() == 0
    assert spark.read.parquet(p).columns == ["value"]


def test_parquet_native_and_transform_mode(spark, out):
    df = spark.sql("SELECT CAST(123.45 AS DECIMAL(12, 2)) AS amount, TIMESTAMP_NTZ'2024-01-01 12:00:00.123456' AS ts, "
                   "DATE'2024-06-01' AS d, X'68656c6c6f' AS bin, 1 AS `café`")
    native, transformed = out("pn"), out("pt")
    export(spark, df=df, fmt="parquet", output=native)
    back = spark.read.parquet(native)
    assert back.columns == ["amount", "ts", "d", "bin", "caf_"]
    row = back.collect()[0]
    assert str(row.amount) == "123.45" and row.bin == bytearray(b"hello")
    assert str(row.ts) == "2024-01-01 12:00:00.123456"
    export(spark, df=df, fmt="parquet", output=transformed, inline=["rename:d=day"])
    row = spark.read.parquet(transformed).collect()[0]
    assert (row.amount, row.ts, row.day, row.bin) == ("123.45", "2024-01-01T12:00:00.123456", "2024-06-01", "aGVsbG8=")


@pytest.mark.parametrize("codec,expected", [("SNAPPY", "SNAPPY"), ("gzip", "GZIP"), ("Zstd", "ZSTD"),
                                            ("UNCOMPRESSED", "UNCOMPRESSED")])
def test_parquet_compression(spark, out, codec, expected):
    path = out("codec")
    export(spark, df=spark.range(10), fmt="parquet", output=path, compression=codec, single_file=True)
    meta = pq.ParquetFile(parts(path, "part-*.parquet")[0]).metadata
    assert meta.row_group(0).column(0).compression == expected


def test_parquet_rejects_case_duplicates(spark, out):
    # renames may produce names that differ only in case; Parquet output refuses them clearly
    df = spark.sql("SELECT 1 AS staffid, 2 AS other")
    with pytest.raises(OutputError, match="differ only in case"):
        export(spark, df=df, fmt="parquet", output=out("case"), inline=["rename:other=staffId"])


def test_overwrite_guard_and_atomic_publish(spark, bookings, out):
    path = out("atomic")
    export(spark, df=bookings, fmt="ndjson", output=path)
    before = read_text(path)
    with pytest.raises(OutputError, match="already exists"):
        export(spark, df=bookings, fmt="ndjson", output=path)
    # a job that fails mid-write leaves the old output untouched and no staging folder behind
    failing = {"transforms": [{"type": "map", "column": "room_code", "mapping": {"A-101": "x"}, "unmatched": "fail"}]}
    with pytest.raises(TransformError, match=r'Transform "map" failed at row \d+: no mapping'):
        export(spark, df=bookings, fmt="ndjson", output=path, overwrite=True, transforms=failing)
    assert read_text(path) == before
    parent = os.path.dirname(local(path))
    assert not [n for n in os.listdir(parent) if n.startswith("." + os.path.basename(path))]
    # overwrite replaces it
    export(spark, df=bookings.limit(1), fmt="ndjson", output=path, overwrite=True)
    assert len(read_text(path).splitlines()) == 1


def test_manifest_sidecar(spark, bookings, out):
    path, meta = out("m"), out("meta")
    result = export(spark, df=bookings, fmt="csv", output=path, metadata_path=meta, inline=["mask:booking_id"])
    doc = json.load(open(local(meta)))
    assert doc["rowCount"] == 3 and doc["format"] == "csv" and doc["sqlSource"] == "dataframe"
    assert [c["outputName"] for c in doc["columns"]] == bookings.columns
    assert doc["columns"][0]["sensitive"] is True and doc["columns"][4]["jdbcType"] == "decimal(12,2)"
    assert result.manifest["row_count"] == 3
    # a JDBC URL in the sidecar never carries its password
    from tapline.plans.export import sidecar_document

    redacted = sidecar_document({"jdbc_url": "jdbc:postgresql://u:secret@h/db", "columns": []})
    assert redacted["jdbcUrl"] == "jdbc:postgresql://u:*****@h/db"


def test_row_cap_counts_rows_written(spark, out):
    spark.range(100).createOrReplaceTempView("hundred")
    result = export(spark, sql="SELECT id FROM hundred ORDER BY id", fmt="ndjson", output=out("cap"), max_rows=7)
    assert result.row_count == 7


def test_declared_decimal_scale_fails_instead_of_rounding(spark, out):
    df = spark.sql("SELECT CAST(1.23 AS DECIMAL(10, 3)) AS amount UNION ALL SELECT CAST(4.5 AS DECIMAL(10, 3))")
    path = out("dec")
    export(spark, df=df, fmt="parquet", output=path, parquet_decimals={"amount": (12, 2)})
    back = spark.read.parquet(path)
    assert back.schema["amount"].dataType.simpleString() == "decimal(12,2)"
    assert sorted(str(r.amount) for r in back.collect()) == ["1.23", "4.50"]
    bad = spark.sql("SELECT CAST(1.239 AS DECIMAL(10, 3)) AS amount")
    with pytest.raises(OutputError, match="Export job failed"):
        export(spark, df=bad, fmt="parquet", output=out("dec2"), parquet_decimals={"amount": (12, 2)})


def test_json_array_spans_arrow_batches(spark, out):
    # more rows than one Arrow batch (10,000 by default) in one partition: one array per part
    df = spark.range(0, 25_000, numPartitions=1).withColumnRenamed("id", "n")
    for pretty in (False, True):
        path = out("batches")
        export(spark, df=df, fmt="json", output=path, pretty=pretty)
        files = parts(path)
        assert len(files) == 1
        doc = json.load(open(files[0]))
        assert [r["n"] for r in doc] == list(range(25_000))


def test_rebalance_spreads_the_source(spark, out):
    one = spark.range(0, 1000, numPartitions=1)
    assert export(spark, df=one, fmt="ndjson", output=out("rb"), rebalance=True).row_count == 1000


def test_parquet_types_seen_by_another_reader(spark, out):
    import duckdb

    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Australia/Brisbane")
    try:
        df = spark.sql("SELECT TIMESTAMP_NTZ'2024-06-01 12:34:56' AS ts, CAST(580.23 AS DECIMAL(12,2)) AS amount, "
                       "DATE'2024-06-01' AS d, X'68656c6c6f' AS bin")
        native, transformed = out("dn"), out("dt")
        export(spark, df=df, fmt="parquet", output=native)
        export(spark, df=df, fmt="parquet", output=transformed, inline=["rename:amount=amount2"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    con = duckdb.connect()
    rel = con.execute(f"SELECT typeof(ts), ts::VARCHAR, typeof(amount), amount::VARCHAR, d::VARCHAR, bin "
                      f"FROM read_parquet('{local(native)}/*.parquet')").fetchone()
    assert rel[:5] == ("TIMESTAMP", "2024-06-01 12:34:56", "DECIMAL(12,2)", "580.23", "2024-06-01")
    assert bytes(rel[5]) == b"hello"
    rel = con.execute(f"SELECT typeof(ts), ts, typeof(amount2), amount2 FROM read_parquet('{local(transformed)}/*.parquet')"
                      ).fetchone()
    assert rel == ("VARCHAR", "2024-06-01T12:34:56", "VARCHAR", "580.23")


def test_fast_and_transform_paths_give_the_same_json_values(spark, bookings, out):
    fast, transformed = out("fast"), out("tr")
    export(spark, df=bookings, fmt="json", output=fast, single_file=True)
    export(spark, df=bookings, fmt="json", output=transformed, single_file=True,
           inline=["rename:attendees=attendee_count"])
    a = {r["booking_id"]: r for r in json.loads(read_text(fast))}
    b = {r["booking_id"]: r for r in json.loads(read_text(transformed))}
    for key, row in a.items():
        other = dict(b[key])
        other["attendees"] = other.pop("attendee_count")
        assert other == row


def test_odd_column_names_through_pipeline_and_sinks(spark, out):
    df = spark.sql("SELECT 1 AS `a.b`, 'x' AS `we``ird`, 'y' AS `with space`, 'z' AS `naïve`")
    pipe = ["rename:a.b=a.c", "template:t={with space}-{naïve}", "mask:we`ird"]
    for fmt in ("csv", "ndjson", "json", "parquet"):
        path = out("odd")
        result = export(spark, df=df, fmt=fmt, output=path, inline=pipe, single_file=True)
        assert result.row_count == 1
    path = out("odd-nd")
    export(spark, df=df, fmt="ndjson", output=path, inline=pipe)
    row = json.loads(read_text(path).splitlines()[0])
    assert row == {"a.c": 1, "we`ird": "***", "with space": "y", "naïve": "z", "t": "y-z"}


def test_empty_result_with_transforms(spark, bookings, out):
    empty = bookings.where("attendees > 1000")
    c = out("ect")
    result = export(spark, df=empty, fmt="csv", output=c, inline=["rename:room_code=room", "mask:booking_id"])
    assert result.row_count == 0 and result.metrics["rows_in"] == 0
    assert read_text(c) == "booking_id,room,attendees,cancelled,amount\r\n"


def test_names_differing_only_in_case(spark, out):
    # the pipeline matches names exactly; text sinks keep both columns, Parquet refuses them
    df = spark.sql("SELECT 1 AS staffid, 2 AS other")
    for fmt in ("csv", "ndjson", "json"):
        path = out("case-" + fmt)
        export(spark, df=df, fmt=fmt, output=path, inline=["rename:other=staffId"], single_file=True)
    text = read_text(path)
    assert json.loads(text) == [{"staffid": 1, "staffId": 2}]
    from tapline import build_pipeline

    raw = spark.sql("SELECT 1 AS a, 2 AS A")
    assert build_pipeline(inline=["rename:a=b"]).apply(raw).columns == ["b", "A"]


def test_direct_write_without_staging(spark, bookings, out):
    path = out("direct")
    assert export(spark, df=bookings, fmt="ndjson", output=path, staged=False).row_count == 3
    with pytest.raises(OutputError, match="already exists"):
        export(spark, df=bookings, fmt="ndjson", output=path, staged=False)
    export(spark, df=bookings.limit(1), fmt="csv", output=path, staged=False, overwrite=True)
    assert len(read_text(path).splitlines()) == 2


def test_empty_result_without_header_writes_no_lines(spark, out):
    empty = spark.sql("SELECT 'x' AS a WHERE 1 = 0")
    path = out("nohdr")
    export(spark, df=empty, fmt="csv", output=path, header=False, bom=True)
    assert read_text(path) == ""
