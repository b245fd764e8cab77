"""Canonical values and their text form, as Spark column expressions.

Everything here is a pure ``Column -> Column`` function: it stays inside whole-stage codegen and
runs on the executors, never on the driver.

Canonical kinds (the value shape a transform sees): boolean, int, long, float, double, decimal and
string. Dates, times and timestamps become ISO-8601 text, binary becomes Base64 text, and every
other Spark type (arrays, maps, structs, intervals) becomes its string form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

CANONICAL_TYPES = (T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                   T.DecimalType, T.StringType)

try:  # TimeType is new in Spark 4.1
    _TIME_TYPE = T.TimeType  # type: ignore[attr-defined]
except AttributeError:  # pragma: no cover - older Spark
    _TIME_TYPE = None


def kind_of(dtype: T.DataType) -> str:
    """Canonical kind name of a Spark type: BOOLEAN, INT, LONG, FLOAT, DOUBLE, DECIMAL or STRING."""
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return "INT"
    if isinstance(dtype, T.LongType):
        return "LONG"
    if isinstance(dtype, T.FloatType):
        return "FLOAT"
    if isinstance(dtype, T.DoubleType):
        return "DOUBLE"
    if isinstance(dtype, T.DecimalType):
        return "DECIMAL"
    return "STRING"


def _strip_iso_tail(text: Column) -> Column:
    """Turn ``...HH:mm:ss.SSSSSS`` into Java's shortest ISO form.

    Java prints the fraction with 3 digits when it is a whole number of milliseconds, 6 digits
    otherwise, and leaves out ``:ss`` when both seconds and fraction are zero.
    """
    text = F.regexp_replace(text, r"(\.\d{3})000$", "$1")
    text = F.regexp_replace(text, r"\.000$", "")
    return F.regexp_replace(text, r"(T|^)(\d{2}:\d{2}):00$", "$1$2")


def iso_timestamp_ntz(col: Column, text: Column | None = None) -> Column:
    """Zone-free timestamp as ``2024-06-01T12:34:56`` (Java ``LocalDateTime.toString``).

    Built from ``CAST(ts AS STRING)`` (``yyyy-MM-dd HH:mm:ss`` plus the fraction with trailing
    zeros trimmed), which involves no time zone. For four-digit years the fraction is padded to
    3 or 6 digits with substring arithmetic; other widths take the regular-expression form.
    """
    text = col.cast("string") if text is None else text
    size = F.length(text)
    base = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
    fraction = F.substring(text, 21, 6)
    fast = (F.when(size == F.lit(19), F.when(text.endswith(":00"), F.substring(base, 1, 16)).otherwise(base))
            .when(size <= F.lit(23), F.concat(base, F.lit("."), F.rpad(fraction, 3, "0")))
            .otherwise(F.concat(base, F.lit("."), F.rpad(fraction, 6, "0"))))
    # signed or five-digit years (outside 0000-9999): same rule on the text after the space
    other = F.regexp_replace(F.regexp_replace(text, " (\\d\\d:\\d\\d):00$", "T$1"), " ", "T")
    return F.when(F.substring(text, 11, 1) == F.lit(" "), fast).otherwise(other)


_EPOCH_NTZ = "1970-01-01 00:00:00"


def utc_wall_clock(col: Column) -> Column:
    """An instant's UTC wall clock as a zone-free timestamp."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def timestamp_text(col: Column, dtype: T.DataType) -> Column | None:
    """The cast from which a timestamp's ISO text is built, or None for other types. A projection that computes it
    below :func:`canonical` makes it once a row; the ISO rules read it several times."""
    if isinstance(dtype, T.TimestampNTZType):
        return col.cast("string")
    return utc_wall_clock(col).cast("string") if isinstance(dtype, T.TimestampType) else None


def iso_timestamp_utc(col: Column, text: Column | None = None) -> Column:
    """Instant as UTC ``2024-06-01T02:34:56Z`` (Java ``OffsetDateTime.toString`` at offset zero).

    The UTC wall clock is the epoch plus the instant's microseconds, as a zone-free timestamp,
    so neither the session time zone nor its DST transitions play a part.
    """
    return F.concat(iso_timestamp_ntz(utc_wall_clock(col), text), F.lit("Z"))


def iso_date(col: Column) -> Column:
    """``DATE`` as ``yyyy-MM-dd`` (a zone-free cast; no timestamp is involved)."""
    return col.cast("string")


def iso_time(col: Column) -> Column:
    """``TIME`` as Java ``LocalTime.toString``: ``12:34``, ``12:34:56``, ``12:34:56.500``."""
    text = col.cast("string")
    # Spark trims trailing fraction zeros; pad to 6 digits, then shorten the Java way.
    padded = F.when(text.contains("."), F.rpad(text, 15, "0")).otherwise(F.concat(text, F.lit(".000000")))
    return _strip_iso_tail(padded)


def base64_text(col: Column) -> Column:
    """Unchunked Base64 (Spark may break lines every 76 chars; Base64 never contains CR/LF)."""
    return F.regexp_replace(F.base64(col), r"[\r\n]", "")


def canonical(col: Column, dtype: T.DataType, text: Column | None = None) -> tuple[Column, T.DataType]:
    """The canonical value of a column, with its canonical type; ``text`` is its :func:`timestamp_text`, if at hand."""
    if isinstance(dtype, (T.ByteType, T.ShortType)):
        return col.cast("int"), T.IntegerType()
    if isinstance(dtype, CANONICAL_TYPES):
        return col, dtype
    if isinstance(dtype, T.DateType):
        return iso_date(col), T.StringType()
    if isinstance(dtype, T.TimestampNTZType):
        return iso_timestamp_ntz(col, text), T.StringType()
    if isinstance(dtype, T.TimestampType):
        return iso_timestamp_utc(col, text), T.StringType()
    if _TIME_TYPE is not None and isinstance(dtype, _TIME_TYPE):
        return iso_time(col), T.StringType()
    if isinstance(dtype, T.BinaryType):
        return base64_text(col), T.StringType()
    if isinstance(dtype, T.NullType):
        return col.cast("string"), T.StringType()
    return col.cast("string"), T.StringType()


def stringify(col: Column, dtype: T.DataType) -> Column:
    """Text form of a canonical value: decimals plain, everything else Java ``toString``.

    Spark's cast already prints decimals in plain notation, doubles as ``1.0E10`` and booleans
    as ``true``/``false``.
    """
    value, _ = canonical(col, dtype)
    return value.cast("string")


def non_finite_to_null(col: Column) -> Column:
    """NaN and +/-Infinity become null (JSON has no literal for them)."""
    bad = F.isnan(col) | (col == F.lit(float("inf"))) | (col == F.lit(float("-inf")))
    return F.when(bad, F.lit(None)).otherwise(col)


# Fixed values, equal to the reference's: a cell starting with one of these characters is
# treated as a spreadsheet formula and gets a leading single quote.
FORMULA_LEAD_CHARS = "=+-@\t\r"
_FORMULA_PATTERN = r"^[=+\-@\t\r]"


def formula_guard(col: Column) -> Column:
    """Prefix ``'`` to a text cell that a spreadsheet would read as a formula. Null stays null."""
    return F.when(col.rlike(_FORMULA_PATTERN), F.concat(F.lit("'"), col)).otherwise(col)


# Fixed values, equal to the reference's credential redaction: the mask, the URL authority
# pattern (//user:secret@) and the password/pwd property pattern.
REDACTION_MASK = "*****"
URL_CREDENTIALS_PATTERN = r"(//[^/@:\s]+:)[^@\s]+(@)"
PASSWORD_PROPERTY_PATTERN = r"(?i)\b(password|pwd)=[^&;\s]*"


def redact_credentials(col: Column) -> Column:
    """Mask credentials in URLs and ``password=``/``pwd=`` properties. Null-safe."""
    first = F.regexp_replace(col, URL_CREDENTIALS_PATTERN, "$1" + REDACTION_MASK + "$2")
    return F.regexp_replace(first, PASSWORD_PROPERTY_PATTERN, "$1=" + REDACTION_MASK)


def redact_text(text: str | None) -> str | None:
    """Driver-side twin of :func:`redact_credentials` for one metadata string (URLs, messages)."""
    import re

    if text is None:
        return None
    first = re.sub(URL_CREDENTIALS_PATTERN, r"\1" + REDACTION_MASK + r"\2", text)
    return re.sub(PASSWORD_PROPERTY_PATTERN, r"\1=" + REDACTION_MASK, first)
