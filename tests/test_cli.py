"""The command-line driver: options, describe, dry run and exit codes."""

import glob
import os

from tapline.cli import (
    EXIT_INVALID_ARGUMENTS,
    EXIT_OK,
    EXIT_SCHEMA,
    EXIT_SQL_INPUT,
    EXIT_TRANSFORM,
    EXIT_UNSUPPORTED_FORMAT,
    main,
)

SF = "/root/testdata/sf0.001"


def test_cli_export_and_describe(spark, out, capsys):
    path = out("cli")
    code = main(["--tables", SF, "--sql", "SELECT n_nationkey, n_name FROM nation", "--format", "csv",
                 "--output", path, "--transform", "rename:n_name=name", "--transform", "mask:name",
                 "--single-file"])
    assert code == EXIT_OK
    text = open(glob.glob(os.path.join(path.replace("file:", ""), "part-*"))[0], newline="").read()
    assert text.startswith("n_nationkey,name\r\n0,***\r\n")
    code = main(["--tables", SF, "--sql", "SELECT n_nationkey FROM nation", "--describe"])
    assert code == EXIT_OK
    printed = capsys.readouterr().out
    assert "Columns:\n  1. n_nationkey          type int             nullable=true  output=n_nationkey" in printed


def test_cli_exit_codes(spark, out):
    assert main(["--sql", "SELECT 1"]) == EXIT_INVALID_ARGUMENTS              # no format / output
    assert main(["--format", "csv", "--output", "x"]) == EXIT_SQL_INPUT  # no SQL
    assert main(["--sql", "SELECT 1", "--sql-file", "q.sql", "--format", "csv", "--output", "x"]) == EXIT_SQL_INPUT
    assert main(["--sql", "SELECT 1 AS a", "--format", "xml", "--output", out("f")]) == EXIT_UNSUPPORTED_FORMAT
    assert main(["--sql", "SELECT 1 AS a, 2 AS A", "--format", "csv", "--output", out("d")]) == EXIT_SCHEMA
    assert main(["--sql", "SELECT 1 AS a", "--format", "csv", "--output", out("m"), "--max-rows", "0"]) == \
        EXIT_INVALID_ARGUMENTS
    assert main(["--tables", SF, "--sql", "DROP VIEW nation", "--format", "csv",
                 "--output", out("c1")]) == EXIT_SQL_INPUT
    assert main(["--tables", SF, "--sql", "SELECT * FROM nation", "--format", "csv", "--output", out("c2"),
                 "--transform", "map:n_name=ALGERIA>A", "--on-transform-error", "fail",
                 "--transforms-file", os.devnull]) == EXIT_TRANSFORM
    assert main(["--tables", SF, "--sql", "SELECT * FROM nation", "--format", "csv", "--output", out("c3"),
                 "--transform", "drop:nope"]) == EXIT_TRANSFORM
    assert main(["--sql", "SELECT 1 AS a", "--format", "csv", "--output", out("c4"), "--dry-run"]) == EXIT_OK


def test_cli_table_paths(spark, out):
    path = out("cli-table")
    code = main(["--table", f"n2={SF}/nation.parquet", "--sql", "SELECT count(*) AS n FROM n2",
                 "--format", "ndjson", "--output", path, "--single-file"])
    assert code == EXIT_OK
    text = open(glob.glob(os.path.join(path.replace("file:", ""), "part-*"))[0]).read()
    assert text == '{"n":25}\n'
    assert main(["--table", "oops", "--sql", "SELECT 1", "--format", "csv", "--output", out("x")]) == \
        EXIT_INVALID_ARGUMENTS


def test_cli_jdbc_partitioned(spark, out):
    import uuid

    url = f"jdbc:derby:memory:c{uuid.uuid4().hex[:8]};create=true"
    spark.range(0, 50).selectExpr("id AS ID").write.format("jdbc").option("url", url).option("dbtable", "T").save()
    path = out("cli-jdbc")
    assert main(["--url", url, "--sql", "SELECT ID FROM T", "--partition-column", "ID", "--num-partitions", "3",
                 "--format", "ndjson", "--output", path]) == EXIT_OK
    assert spark.read.json(path).count() == 50


def test_cli_sql_file_and_metadata(spark, out, tmp_path):
    import json

    sql = tmp_path / "q.sql"
    sql.write_text("SELECT n_nationkey, n_name FROM nation WHERE n_regionkey = 1;\n")
    path, meta = out("cli-file"), out("cli-meta")
    assert main(["--tables", SF, "--sql-file", str(sql), "--format", "tsv", "--output", path,
                 "--metadata", meta, "--no-include-header"]) == EXIT_OK
    doc = json.load(open(meta.replace("file:", "")))
    assert doc["sqlSource"] == str(sql) and doc["rowCount"] == 5 and doc["format"] == "tsv"
    text = "".join(open(p, newline="").read() for p in glob.glob(os.path.join(path.replace("file:", ""), "part-*")))
    assert text.count("\r\n") == 5 and not text.startswith("n_nationkey")


def test_cli_messages(spark, out, capsys):
    path = out("cli-msg")
    assert main(["--tables", SF, "--sql", "SELECT * FROM region", "--format", "csv", "--output", path,
                 "--transform", "mask:r_name", "--verbose"]) == EXIT_OK
    lines = capsys.readouterr().out.splitlines()
    assert lines[0].startswith("Exported 5 rows in ") and lines[1] == f"Export complete: 5 rows -> {path}"
    assert lines[2].startswith("transforms: 5 in, 5 out, 0 dropped; mask")
    assert main(["--sql", "SELECT 1 AS a", "--format", "csv", "--output", out("d"), "--dry-run"]) == EXIT_OK
    assert capsys.readouterr().out.strip() == "Dry run complete. All options are valid."
    assert main(["--tables", SF, "--sql", "SELECT * FROM region", "--format", "csv", "--output", out("e"),
                 "--transform", "drop:nope"]) == EXIT_TRANSFORM
    assert capsys.readouterr().err.startswith('ERROR: Transform "drop" references unknown column')
