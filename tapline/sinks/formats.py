"""File sinks: NDJSON, JSON array, CSV, TSV and Parquet, with fixed value rules.

Each sink is split into a pure preparation step (``DataFrame -> DataFrame``, all native column
expressions) and a Spark writer call. Output is a directory of part files written in parallel by
the executors; nothing is collected on the driver. With ``single_file=True`` the directory holds one file in
the order of the rows: text formats are still written in parallel and joined as bytes (see ``document``), Parquet
rows are gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import FormatError, OutputError
from ..functions.names import sanitized_names
from ..functions.values import canonical, formula_guard, non_finite_to_null
from ..session import held_setting
from .document import Layout, write_document
from .publish import drop_empty_parts, part_names

FORMATS = ("json", "ndjson", "csv", "tsv", "parquet")
COMPRESSIONS = {"snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "uncompressed": "none"}
BOM = "\ufeff"


def normalize_format(fmt: str) -> str:
    """The format name in lower case; unknown formats are an error."""
    value = str(fmt).strip().lower()
    if value not in FORMATS:
        raise FormatError(f'Unknown format "{fmt}". Valid formats: {", ".join(FORMATS)}.')
    return value


def by_position(df: DataFrame) -> tuple[DataFrame, list[T.StructField]]:
    """The frame with columns renamed ``_p0 .. _pN`` by position, and the original fields.

    Output names may differ only in case (renames can produce ``staffid`` next to ``staffId``);
    addressing columns by position keeps that legal under case-insensitive name resolution.
    """
    fields = list(df.schema.fields)
    return df.toDF(*[f"_p{i}" for i in range(len(fields))]), fields


# ---------------------------------------------------------------------------- JSON

def json_values(df: DataFrame) -> DataFrame:
    """Canonical values for JSON: ISO text for temporals, Base64 for binary, NaN/Inf as null."""
    work, fields = by_position(df)
    cols = []
    for i, sf in enumerate(fields):
        value, ctype = canonical(F.col(f"_p{i}"), sf.dataType)
        if isinstance(ctype, (T.FloatType, T.DoubleType)):
            value = non_finite_to_null(value)
        cols.append(value.alias(sf.name))
    return work.select(*cols)


def _needs_plain_decimals(df: DataFrame) -> bool:
    # Spark's JSON generator prints a decimal with Java's BigDecimal.toString, which turns to
    # scientific notation (1E-8, 0E-8) only when the scale exceeds 6.
    return any(isinstance(sf.dataType, T.DecimalType) and sf.dataType.scale > 6 for sf in df.schema.fields)


_JSON_OPTS = {"ignoreNullFields": "false"}
_PRETTY_OPTS = {"ignoreNullFields": "false", "pretty": "true"}


def json_objects(df: DataFrame, pretty: bool = False) -> DataFrame:
    """One JSON object text per row (column ``value``): columns in order, nulls written,
    decimals in plain notation. ``df`` must already hold JSON values (:func:`json_values`)."""
    opts = _PRETTY_OPTS if pretty else _JSON_OPTS
    work, fields = by_position(df)
    if not _needs_plain_decimals(df):
        obj = F.to_json(F.struct(*[F.col(f"_p{i}").alias(sf.name) for i, sf in enumerate(fields)]), opts)
        return work.select(obj.alias("value"))
    # Per-column fragments, so high-scale decimals can be printed as plain text.
    frags: list[Column] = []
    sep = ",\n  " if pretty else ","
    for i, sf in enumerate(fields):
        col = F.col(f"_p{i}")
        if isinstance(sf.dataType, T.DecimalType):
            name_text = F.to_json(F.struct(F.lit(None).cast("string").alias(sf.name)), opts)
            # '{"name":null}' -> '"name":'   /  pretty: '{\n  "name" : null\n}' -> '"name" : '
            head = F.regexp_replace(name_text, r"^\{\s*|null\s*\}$", "")
            frag = F.concat(head, F.coalesce(col.cast("string"), F.lit("null")))
        else:
            whole = F.to_json(F.struct(col.alias(sf.name)), opts)
            frag = F.regexp_replace(whole, r"^\{\s*|\s*\}$", "")
        frags.append(frag)
    body = F.concat_ws(sep, *frags)
    obj = F.concat(F.lit("{\n  "), body, F.lit("\n}")) if pretty else F.concat(F.lit("{"), body, F.lit("}"))
    return work.select(obj.alias("value"))


def _frame_arrays(pretty: bool):
    """mapInArrow body: each partition becomes one JSON array (one part file).

    One batch of look-ahead tells the last batch of the partition; the text work is Arrow
    compute (vectorised, no per-row Python)."""

    def frame(batches):
        pending = None
        first = True
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if pending is not None:
                yield _render(pending, first, False, pretty)
                first = False
            pending = batch.column(0)
        if pending is not None:
            yield _render(pending, first, True, pretty)

    return frame


def _render(values, first: bool, last: bool, pretty: bool):
    """Row i: prefix + object + suffix. The partition's first row opens the array, its last row
    closes it, every other row ends with a comma."""
    import pyarrow as pa
    import pyarrow.compute as pc

    if pretty:
        body = pc.replace_substring(values, "\n", "\n  ")
        head, middle, tail = "[\n  ", "  ", "\n]"
    else:
        body, head, middle, tail = values, "[", "", "]"
    n = len(body)
    lines = pc.binary_join_element_wise(middle, body, ",", "")
    if first or last:
        pieces = []
        lo, hi = (1 if first else 0), (n - 1 if last else n)
        if first:
            end = tail if (last and n == 1) else ","
            pieces.append(pa.array([head + body[0].as_py() + end], pa.string()))
        if hi > lo:
            pieces.append(lines.slice(lo, hi - lo))
        if last and not (first and n == 1):
            pieces.append(pa.array([middle + body[n - 1].as_py() + tail], pa.string()))
        lines = pa.concat_arrays([p.cast(pa.string()) for p in pieces])
    return pa.RecordBatch.from_arrays([lines], ["value"])


def counting(lines: DataFrame, counted: Observation | None) -> DataFrame:
    """Count the rendered rows (one text column, so the metrics node is cheap), if asked to."""
    return lines if counted is None else lines.observe(counted, F.count(F.lit(1)).alias("rows_out"))


def json_array_lines(df: DataFrame, pretty: bool = False, counted: Observation | None = None) -> DataFrame:
    """Lines that make each non-empty partition one JSON array (``[`` ... ``]``).

    Framing is per partition, so the partitioning must be final before it.
    """
    return counting(json_objects(json_values(df), pretty), counted).mapInArrow(_frame_arrays(pretty), "value string")


def write_json_array(df: DataFrame, path: str, pretty: bool = False, single_file: bool = False,
                     mode: str = "errorifexists", counted: Observation | None = None) -> None:
    """Each part file is one JSON array; an empty result is one ``[]`` file. ``single_file``: one array in one file."""
    if single_file:
        lines = counting(json_objects(json_values(df), pretty), counted)
        if pretty:
            lines = lines.select(F.replace("value", F.lit("\n"), F.lit("\n  ")).alias("value"))
        layout = Layout(",\n  ", "[\n  ", "\n]\n", True, "[ ]\n") if pretty else Layout(",\n", "[", "]\n", True, "[]\n")
        write_document(lines, path, layout, mode)
        return
    old = part_names(df.sparkSession, path)
    # one file per task: a file split by maxRecordsPerFile would leave arrays unclosed
    json_array_lines(df, pretty, counted).write.mode(mode).option("maxRecordsPerFile", 0).text(path)
    if not drop_empty_parts(df.sparkSession, path, old):
        df.sparkSession.createDataFrame([("[ ]" if pretty else "[]",)], "value string").coalesce(1) \
            .write.mode("append").text(path)
        drop_empty_parts(df.sparkSession, path, old)


def in_one_part(df: DataFrame) -> DataFrame:
    """All rows in one partition, in their order: one shuffle of the finished rows, so that only the last write is a
    single task and what comes before stays parallel."""
    work, fields = by_position(df)
    placed = work.withColumn("_order", F.monotonically_increasing_id()).repartition(1).sortWithinPartitions("_order")
    return placed.select(*[F.col(f"_p{i}").alias(sf.name, metadata=sf.metadata) for i, sf in enumerate(fields)])


def ndjson_lines(df: DataFrame) -> DataFrame:
    """One JSON object text per row (column ``value``) with JSON value rules applied."""
    return json_objects(json_values(df), pretty=False)


# ---------------------------------------------------------------------------- CSV / TSV

def delimited_values(df: DataFrame, escape_formulas: bool = False) -> DataFrame:
    """Every column as its canonical text (decimals plain, Java number text, ISO temporals),
    optionally with the spreadsheet formula guard. Nulls stay null for the writer's placeholder."""
    work, fields = by_position(df)
    cols = []
    for i, sf in enumerate(fields):
        value, _ = canonical(F.col(f"_p{i}"), sf.dataType)
        text = value.cast("string")
        if escape_formulas:
            text = formula_guard(text)
        cols.append(text.alias(sf.name))
    return work.select(*cols)


# Fixed rules, equal to the reference's CSV library in minimal-quote mode: a cell is quoted when
# it is empty and first in its line, starts with a character at or below "#", contains CR, LF,
# the quote or the delimiter, or ends with a character at or below space. Quotes are doubled.
QUOTE = '"'


def _needs_quotes_pattern(sep: str) -> str:
    delim = "\\t" if sep == "\t" else sep
    return f"^[\\x00-\\x23]|[\\r\\n\"{delim}\\x00]|[\\x00-\\x20]\\z"


def quote_cell(value: str, first: bool, sep: str) -> str:
    """Driver-side twin of the cell rule, for the header line (column names only)."""
    import re

    if value == "":
        return '""' if first else ""
    if re.search(_needs_quotes_pattern(sep).replace(r"\z", r"\Z"), value):
        return QUOTE + value.replace(QUOTE, QUOTE * 2) + QUOTE
    return value


def delimited_lines(df: DataFrame, sep: str = ",", header: bool = True, null_value: str = "",
                    escape_formulas: bool = False, bom: bool = False, pieces: bool = False) -> tuple[DataFrame, str]:
    """One text line per row (column ``value``), and the header line.

    The first row of every partition carries the header (and BOM) in front of it, so each part
    file is a complete delimited file; no row is moved between tasks. With ``pieces`` none does.
    """
    text, _ = by_position(delimited_values(df, escape_formulas))
    pattern = _needs_quotes_pattern(sep)
    cells = []
    for i, source in enumerate(df.schema.fields):
        value = F.col(f"_p{i}")
        null_cell = F.lit(quote_cell(null_value, i == 0, sep))
        _, ctype = canonical(value, source.dataType)
        if isinstance(ctype, T.StringType):
            quoted = F.concat(F.lit(QUOTE), F.replace(value, F.lit(QUOTE), F.lit(QUOTE * 2)), F.lit(QUOTE))
            needs = value.rlike(pattern)
            if i == 0:
                needs = needs | (value == F.lit(""))
            cell = F.when(needs, quoted).otherwise(value)
        else:
            # number and boolean text never needs quotes: skip the scan
            cell = value
        cells.append(F.when(value.isNull(), null_cell).otherwise(cell))
    line = F.concat_ws(sep, *cells)
    head = sep.join(quote_cell(n, i == 0, sep) for i, n in enumerate(df.columns)) if header else None
    lead = ((BOM if bom else "") + (head + "\r\n" if head is not None else ""))
    if lead and not pieces:
        # the lower 33 bits of the id count rows within the partition
        first_in_part = (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))) == F.lit(0)
        line = F.when(first_in_part, F.concat(F.lit(lead), line)).otherwise(line)
    return text.select(line.alias("value")), ((BOM if bom else "") + head if head is not None else "")


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True, null_value: str = "",
                    escape_formulas: bool = False, bom: bool = False, single_file: bool = False,
                    mode: str = "errorifexists", counted: Observation | None = None) -> None:
    """CSV (``sep=","``) or TSV (``sep="\\t"``) with CRLF line ends. Returns after the write."""
    lines, head = delimited_lines(df, sep, header, null_value, escape_formulas, bom, pieces=single_file)
    spark = df.sparkSession
    if single_file:
        lead = head + "\r\n" if header else BOM if bom else ""
        write_document(counting(lines, counted), path, Layout("\r\n", lead, empty=lead if header else None), mode)
        return
    old = part_names(spark, path)
    # one file per task, so every file starts with the header row
    counting(lines, counted).write.mode(mode).option("lineSep", "\r\n").option("maxRecordsPerFile", 0).text(path)
    if not drop_empty_parts(spark, path, old) and head:
        # an empty result still gets its header line (a tiny one-row write into the same folder)
        spark.createDataFrame([(head,)], "value string").coalesce(1) \
            .write.mode("append").option("lineSep", "\r\n").text(path)
        drop_empty_parts(spark, path, old)


# ---------------------------------------------------------------------------- Parquet

def parquet_values(df: DataFrame, canonical_types: bool = False) -> DataFrame:
    """Field names sanitised; with ``canonical_types`` (transform mode) temporals, binary and
    decimals are written as strings."""
    names = sanitized_names(df.columns)
    lowered = [n.lower() for n in names]
    if len(set(lowered)) != len(lowered):
        dup = next(n for n in names if lowered.count(n.lower()) > 1)
        raise OutputError(f'Parquet output would hold two fields that differ only in case ("{dup}"); rename one.')
    work, fields = by_position(df)
    cols = []
    for i, (sf, name) in enumerate(zip(fields, names)):
        col = F.col(f"_p{i}")
        if canonical_types:
            col, ctype = canonical(col, sf.dataType)
            if isinstance(ctype, T.DecimalType):
                col = col.cast("string")
        elif isinstance(sf.dataType, (T.ByteType, T.ShortType)):
            col = col.cast("int")
        cols.append(col.alias(name))
    return work.select(*cols)


def exact_decimal(col: Column, precision: int, scale: int, name: str) -> Column:
    """Rescale to ``decimal(precision, scale)``; a value that would be rounded fails instead."""
    target = col.try_cast(T.DecimalType(precision, scale))
    lossy = col.isNotNull() & (target.isNull() | (target != col))
    return F.when(lossy, F.raise_error(F.lit(f'Value in column "{name}" does not fit decimal({precision},{scale}).'))) \
        .otherwise(target)


def with_declared_decimals(df: DataFrame, decimals: dict[str, tuple[int, int]] | None) -> DataFrame:
    """Give columns a declared ``decimal(p, s)``; a value that would need rounding fails the job."""
    if not decimals:
        return df
    missing = [name for name in decimals if name not in df.columns]
    if missing:
        raise OutputError(f"Declared decimal columns not in the output: {missing}.")
    work, fields = by_position(df)
    cols = []
    for i, sf in enumerate(fields):
        col = F.col(f"_p{i}")
        if sf.name in decimals:
            precision, scale = decimals[sf.name]
            col = exact_decimal(col, precision, scale, sf.name)
        cols.append(col.alias(sf.name))
    return work.select(*cols)


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", canonical_types: bool = False,
                  single_file: bool = False, mode: str = "errorifexists",
                  decimals: dict[str, tuple[int, int]] | None = None) -> None:
    """Parquet with sanitised field names, micro-second timestamps and the chosen codec."""
    codec = COMPRESSIONS.get(str(compression).strip().lower())
    if codec is None:
        raise OutputError(f'Unknown compression "{compression}". Valid: SNAPPY, GZIP, ZSTD, UNCOMPRESSED.')
    out = parquet_values(with_declared_decimals(df, decimals), canonical_types)
    if single_file:
        out = in_one_part(out)
    with held_setting(df.sparkSession, "spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS"):
        out.write.mode(mode).option("compression", codec).parquet(path)


def write_text_lines(lines: DataFrame, path: str, single_file: bool = False, mode: str = "errorifexists",
                     compression: str | None = None, counted: Observation | None = None) -> None:
    """Write a one-string-column DataFrame as text lines."""
    lines = counting(lines, counted)
    if single_file:
        write_document(lines, path, Layout("\n"), mode, compression)
        return
    writer = lines.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.text(path)
