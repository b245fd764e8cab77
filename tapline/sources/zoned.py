"""Zoned times with the offset they have in the database.

Spark keeps an instant and forgets the offset it was written with. Where the result's metadata says that a column
is a time with zone, and the database keeps each value's own offset, the column's text is asked for instead: the cast
is pushed into the query, and the text brought into the ISO form the other times have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: JDBC type codes (fixed values): TIME and TIMESTAMP WITH TIME ZONE, and the database's own code for the latter.
TIME_ZONED, TIMESTAMP_ZONED, ORACLE_TIMESTAMP_ZONED = 2013, 2014, -101
#: How each database writes such a value with its offset, by JDBC sub-protocol and type. PostgreSQL's timestamps with
#: zone are instants and have no offset of their own; its times with zone do.
TEXT_OF = {
    ("oracle", ORACLE_TIMESTAMP_ZONED): """TO_CHAR({c}, 'SYYYY-MM-DD"T"HH24:MI:SS.FF6TZH:TZM')""",
    ("oracle", TIMESTAMP_ZONED): """TO_CHAR({c}, 'SYYYY-MM-DD"T"HH24:MI:SS.FF6TZH:TZM')""",
    ("postgresql", TIME_ZONED): "CAST({c} AS VARCHAR)",
    ("h2", TIMESTAMP_ZONED): "CAST({c} AS VARCHAR)",
    ("h2", TIME_ZONED): "CAST({c} AS VARCHAR)",
    ("hsqldb", TIMESTAMP_ZONED): "CAST({c} AS VARCHAR(40))",
    ("hsqldb", TIME_ZONED): "CAST({c} AS VARCHAR(30))",
}


def zoned_columns(columns: list[tuple[str, int]], database: str) -> dict[str, str]:
    """The text expression of each column (name, JDBC type) whose offset Spark would lose, by name."""
    found = {}
    for name, kind in columns:
        pattern = TEXT_OF.get((database, kind))
        if pattern:
            found[name] = pattern.format(c=quoted(name))
    return found


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def with_text(text: str, columns: list[tuple[str, int]], zoned: dict[str, str]) -> str:
    """The query with the zoned columns as text, all columns in their order and under their names."""
    if not zoned:
        return text
    chosen = ", ".join(f"{zoned[n]} AS {quoted(n)}" if n in zoned else quoted(n) for n, _ in columns)
    return f"SELECT {chosen} FROM (\n{text}\n) tapline_z"


def result_columns(spark: SparkSession, url: str, text: str, user: str | None, password: str | None,
                   driver: str | None) -> list[tuple[str, int]]:
    """Label and JDBC type of a query's columns, from the prepared statement: nothing is executed."""
    jvm = spark.sparkContext._jvm
    if driver:
        jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
    properties = jvm.java.util.Properties()
    for key, value in (("user", user), ("password", password)):
        if value is not None:
            properties.setProperty(key, value)
    connection = jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        statement = connection.prepareStatement(text)
        try:
            found = statement.getMetaData()
            if found is None:
                return []
            return [(found.getColumnLabel(k), found.getColumnType(k)) for k in range(1, found.getColumnCount() + 1)]
        finally:
            statement.close()
    finally:
        connection.close()


def offset_text(col: Column) -> Column:
    """A database's text of a zoned time as Java prints it: ``T`` between date and time, seconds left out if zero, a
    fraction of 3, 6 or 9 digits, and the offset as ``Z``, ``+hh:mm`` or ``+hh:mm:ss``."""
    # blanks around, a blank for T, a blank or nothing before the offset
    text = F.regexp_replace(F.trim(col), r"^(\S+-\d\d) +", "$1T")
    text = F.regexp_replace(text, r" +(?=[+-]\d\d|Z)", "")
    offset = F.regexp_extract(text, r"(Z|[+-]\d{1,2}(?::?\d\d){0,2})$", 1)
    body = F.substring(text, F.lit(1), F.length(text) - F.length(offset))
    sign, digits = F.substring(offset, 1, 1), F.regexp_replace(F.substring(offset, 2, 8), ":", "")
    digits = F.when(F.length(digits) % 2 == 1, F.concat(F.lit("0"), digits)).otherwise(digits)
    digits = F.regexp_replace(F.rpad(digits, 6, "0"), r"^(\d\d)(\d\d)(\d\d)$", "$1:$2:$3")
    zone = F.when((offset == "Z") | digits.startswith("00:00:00"), F.lit("Z")).otherwise(
        F.concat(sign, F.regexp_replace(digits, r":00$", "")))
    whole = F.regexp_extract(body, r"^([^.]*)", 1)
    fraction = F.regexp_replace(F.regexp_extract(body, r"\.(\d+)$", 1), "0+$", "")
    size = F.ceil(F.length(fraction) / 3) * 3
    whole = F.when((fraction == "") & whole.rlike(r":\d\d:00$"), F.regexp_replace(whole, ":00$", "")).otherwise(whole)
    moment = F.when(fraction == "", whole).otherwise(F.concat(whole, F.lit("."), F.rpad(fraction, size.cast("int"), "0")))
    return F.when(offset == "", col).otherwise(F.concat(moment, zone))


def as_iso(df: DataFrame, zoned: dict[str, str]) -> DataFrame:
    """``df`` with the text of the zoned columns in ISO form."""
    plain = df.toDF(*[f"_z{k}" for k in range(len(df.columns))])
    return plain.select(*[(offset_text(F.col(f"_z{k}")) if f.name in zoned else F.col(f"_z{k}")).alias(f.name, metadata=f.metadata)
                          for k, f in enumerate(df.schema.fields)])
