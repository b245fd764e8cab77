"""Sources: a SQL query over registered tables, or a query pushed to a database over JDBC.

Every source returns a DataFrame whose column names are the normalised output names (trimmed,
lower-cased) with the original label kept in the field metadata.
"""

from __future__ import annotations

import math
import os
import re
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import SourceError, TaplineError
from ..functions.names import normalized_names
from ..ordinals import by_partition, row_of, rows_per_partition, starts
from ..session import scratch_path
from .split import conditions, histogram
from .zoned import TEXT_OF, as_iso, result_columns, with_text, zoned_columns

DEFAULT_FETCH_SIZE = 1000
# Statements that make each reading connection read-only, per JDBC sub-protocol; the database
# then refuses any write the query text might attempt.
READ_ONLY_SESSION = {
    "postgresql": "SET SESSION CHARACTERISTICS AS TRANSACTION READ ONLY",
}


def register_tables(spark: SparkSession, directory: str, names: list[str] | None = None) -> list[str]:
    """Register each ``<name>.parquet`` under ``directory`` as a temp view named ``<name>``.

    Registration is lazy: only the footer schema is read, and a query that uses two columns of a
    table still scans only those two (column pruning and filter pushdown reach the scan).
    """
    if names is None:
        names = sorted(f[:-len(".parquet")] for f in _list_names(spark, directory) if f.endswith(".parquet"))
    for name in names:
        spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet").createOrReplaceTempView(name)
    return list(names)


def _list_names(spark: SparkSession, directory: str) -> list[str]:
    """Entry names in a folder: local listing, or the Hadoop FileSystem for hdfs://, s3a://, ..."""
    if "://" not in directory and not directory.startswith("file:"):
        return os.listdir(directory)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(directory)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(path)]


def register_paths(spark: SparkSession, tables: dict[str, str], fmt: str = "parquet",
                   options: dict | None = None) -> list[str]:
    """Register each ``name -> path`` (a file or a folder of parts, any Spark file format) as a
    temp view. Partitioned folders keep their partition columns, so filters on them prune files."""
    for name, path in tables.items():
        reader = spark.read.format(fmt)
        for key, value in (options or {}).items():
            reader = reader.option(key, str(value))
        reader.load(path).createOrReplaceTempView(name)
    return list(tables)


def sql_text(sql: str | None = None, sql_file: str | None = None) -> str:
    """Exactly one of inline SQL or a SQL file, stripped."""
    if (sql is None) == (sql_file is None):
        raise SourceError("Provide exactly one of sql or sql_file.")
    if sql_file is not None:
        try:
            with open(sql_file, encoding="utf-8") as handle:
                sql = handle.read()
        except OSError as exc:
            raise SourceError(f"Failed to read SQL file {sql_file}: {exc}") from None
    text = sql.strip()
    if not text:
        raise SourceError("SQL text is empty.")
    return text


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename columns to their output names (trim + lower case); duplicates are an error.

    The original label and, when known, the source type name stay in the field metadata.
    """
    labels = df.columns
    names = normalized_names(labels)
    if names == labels:
        return df
    cols = []
    for sf, name in zip(df.schema.fields, names):
        meta = dict(sf.metadata or {})
        meta.setdefault("label", sf.name)
        quoted = "`" + sf.name.replace("`", "``") + "`"
        cols.append(F.col(quoted).alias(name, metadata=meta))
    return df.select(*cols)


def query_source(spark: SparkSession, sql: str | None = None, sql_file: str | None = None) -> DataFrame:
    """``spark.sql`` over the registered views, with output names normalised.

    Read-only by construction: the text is placed inside ``SELECT * FROM ( ... )``, where only a
    query (SELECT, WITH ... SELECT, VALUES, set operations) can parse. A command such as
    ``DROP VIEW`` or ``INSERT`` is refused before anything runs, without a SQL scanner of our own.
    """
    from pyspark.errors import AnalysisException, ParseException

    text = sql_text(sql, sql_file).rstrip().rstrip(";").rstrip()
    try:
        df = spark.sql(f"SELECT * FROM (\n{text}\n) AS tapline_query")
    except ParseException as exc:
        first = str(exc).strip().splitlines()[0] if str(exc) else "syntax error"
        raise SourceError(f"Only a read-only query (SELECT, WITH, VALUES) can be exported: {first}") from None
    except AnalysisException as exc:
        first = str(exc).strip().splitlines()[0] if str(exc) else "analysis error"
        raise SourceError(f"The query cannot be resolved: {first}") from None
    return normalize_columns(df)


def jdbc_source(spark: SparkSession, url: str, sql: str | None = None, sql_file: str | None = None, *,
                user: str | None = None, password: str | None = None, driver: str | None = None,
                fetch_size: int = DEFAULT_FETCH_SIZE, partition_column: str | None = None,
                lower_bound=None, upper_bound=None, num_partitions: int | None = None,
                predicates: list[str] | None = None, session_init: str | None = None,
                read_only: bool = True, options: dict | None = None, equi_depth: bool = False,
                spread_by: str | None = None, own_offsets: bool = True) -> DataFrame:
    """Read a query's result over JDBC.

    Without a partition column this is one streaming cursor (``fetchsize`` rows per round trip),
    like the reference. With ``partition_column``/bounds/``num_partitions`` the query is wrapped as
    a derived table and read by ``num_partitions`` parallel range queries: the way to scale a
    large extract out across executors. A skewed key makes range splits uneven; ``predicates``
    instead gives one WHERE condition per partition (for example a database-side hash bucket,
    ``MOD(ABS(hash_fn(id)), 64) = i``), so a hot key's rows can be spread evenly.

    ``equi_depth`` has the database make such conditions from the key's own distribution, for keys of any type (see
    :mod:`tapline.sources.split`): about ``num_partitions`` of like size, a hot key split by the numeric expression
    ``spread_by``. It costs the database two passes over the query, one of them a sort of the keys.

    ``own_offsets``: zoned times keep the offset they have in the database, as text, where it keeps one (see
    :mod:`tapline.sources.zoned`); the prepared statement's metadata is asked for, on such databases only.
    """
    if fetch_size <= 0:
        raise TaplineError(f"fetch_size must be greater than 0, not {fetch_size}.")
    text = sql_text(sql, sql_file).rstrip().rstrip(";").rstrip()
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", str(fetch_size))
    if session_init is None and read_only:
        session_init = READ_ONLY_SESSION.get(url.split(":")[1] if url.count(":") >= 2 else "")
    if session_init:
        reader = reader.option("sessionInitStatement", session_init)
    database = url.split(":")[1] if url.count(":") >= 2 else ""
    zoned: dict[str, str] = {}
    if own_offsets and any(database == name for name, _ in TEXT_OF):
        columns = result_columns(spark, url, text, user, password, driver)
        zoned = zoned_columns(columns, database)
        text = with_text(text, columns, zoned)
    if equi_depth:
        if not partition_column or not num_partitions or predicates:
            raise SourceError("An equi-depth read needs partition_column and num_partitions, and takes no predicates.")

        def rows_of(query: str) -> list:
            asked = spark.read.format("jdbc").option("url", url).option("query", query).option("fetchsize", str(fetch_size))
            for key, value in (("user", user), ("password", password), ("driver", driver),
                               ("sessionInitStatement", session_init), *(options or {}).items()):
                if value is not None:
                    asked = asked.option(key, str(value))
            return _load(asked, url).collect()               # POINTS rows a partition at the most

        found = histogram(rows_of, text, partition_column, num_partitions, database)
        predicates = conditions(found, partition_column, num_partitions, spread_by)
    if predicates:
        props = {"fetchsize": str(fetch_size)}
        for key, value in (("user", user), ("password", password), ("driver", driver),
                           ("sessionInitStatement", session_init)):
            if value is not None:
                props[key] = value
        props.update({k: str(v) for k, v in (options or {}).items()})
        read = spark.read.jdbc(url, f"({text}) tapline_q", predicates=list(predicates), properties=props)
        return normalize_columns(as_iso(read, zoned) if zoned else read)
    if partition_column:
        if not num_partitions:
            raise SourceError("A partitioned JDBC read needs num_partitions.")
        if lower_bound is None or upper_bound is None:
            # one small query on the database: the column's range (a single row)
            bounds = (spark.read.format("jdbc").option("url", url)
                      .option("query", f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi "
                                       f"FROM ({text}) tapline_bounds"))
            for key, value in (("user", user), ("password", password), ("driver", driver),
                               ("sessionInitStatement", session_init), *(options or {}).items()):
                if value is not None:
                    bounds = bounds.option(key, str(value))
            lo, hi = _load(bounds, url).collect()[0]
            if lo is None:  # empty result, or only nulls: the first range reads them
                lo, hi = 0, 1
            lower_bound = lower_bound if lower_bound is not None else whole_bound(lo, math.floor)
            if upper_bound is None:  # the upper bound is exclusive for numbers
                top = whole_bound(hi, math.floor)
                upper_bound = top + 1 if isinstance(top, int) else top
        reader = (reader.option("dbtable", f"({text}) tapline_q")
                  .option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions)))
    else:
        reader = reader.option("query", text)
    if user is not None:
        reader = reader.option("user", user)
    if password is not None:
        reader = reader.option("password", password)
    if driver is not None:
        reader = reader.option("driver", driver)
    for key, value in (options or {}).items():
        reader = reader.option(key, str(value))
    read = _load(reader, url)
    return normalize_columns(as_iso(read, zoned) if zoned else read)


def whole_bound(value, rounding):
    """A range bound that Spark accepts: numbers of every type as whole numbers, dates and times as they are.

    Bounds only place the ranges' borders; rows outside them are read by the first and last range.
    """
    return rounding(value) if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool) else value


def _load(reader, url: str) -> DataFrame:
    """Load, turning a driver failure into a :class:`SourceError` with credentials redacted."""
    from ..functions.values import redact_text

    try:
        return reader.load()
    except Exception as exc:  # noqa: BLE001 - py4j wraps the driver's SQLException
        first = str(exc).strip().splitlines()[0] if str(exc) else type(exc).__name__
        raise SourceError(f"JDBC query failed on {redact_text(url)}: {redact_text(first)}") from None


def cap_rows(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Cap the rows read (before any transform); ``None`` means no cap, and a cap must be positive.

    No task sees all capped rows: partitions count their rows, the sums of the partitions before give each its quota, and
    each keeps its first rows up to it. The first rows of an ordered query are its first in order, part by part.

    Where partitions are file splits, or parts of a range, and rows only pass through projections and filters, a second
    read gives the same rows in the same places: the table is read twice, the first time without columns if nothing
    filters. Any other source (a shuffle, a sort, a database) is written once below the scratch folder, no partition more
    rows than the cap, and read from there. A stream cannot be counted first and is capped by Spark's own limit.
    """
    if max_rows is None:
        return df
    if max_rows <= 0:
        raise TaplineError(f"max_rows must be greater than 0, not {max_rows}.")
    names, metadata = df.columns, [sf.metadata for sf in df.schema.fields]
    plain = df.toDF(*[f"_c{k}" for k in range(len(names))])
    if df.isStreaming:
        return df.limit(int(max_rows))
    place = F.col("_place")
    placed = plain.withColumn("_place", F.monotonically_increasing_id())
    written = not _reads_alike(plain)
    if written:
        path = scratch_path(df.sparkSession, "capped")
        placed.filter(row_of(place) < int(max_rows)).write.parquet(path)
        placed = df.sparkSession.read.schema(placed.schema).parquet(path)
    before, _ = starts(rows_per_partition(placed, "_place"))
    capped = by_partition(placed, "_place", {p: int(max_rows) - n for p, n in before.items() if n < max_rows}, "_quota")
    capped = capped.filter(row_of(place) < F.col("_quota"))
    if written:  # files are read in any order: neighbouring places go to one partition again
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        capped = capped.repartitionByRange(parts, "_place").sortWithinPartitions("_place")
    return capped.select(*[F.col(f"_c{k}").alias(name, metadata=m) for k, (name, m) in enumerate(zip(names, metadata))])


#: Physical operators under which a second read of a table finds each row in the same partition and place.
_STEADY = re.compile(r"(Project|Filter|ColumnarToRow|WholeStageCodegen.*|InputAdapter|Scan parquet.*|Scan orc.*|"
                     r"Scan text.*|Scan csv.*|Scan json.*|LocalTableScan|Range|Generate|Expand|Union)\b")


def _reads_alike(df: DataFrame) -> bool:
    """Whether every operator of the plan is one of ``_STEADY``, with no random expression."""
    plan = df._jdf.queryExecution().executedPlan()
    if "Bucketed: " in plan.toString():  # whether buckets are read as partitions depends on what the rows are used for
        return False
    pending = [plan]
    while pending:
        node = pending.pop()
        if not _STEADY.match(node.nodeName()):
            return False
        children = node.children()
        pending += [children.apply(k) for k in range(children.size())]
    return df._jdf.queryExecution().optimizedPlan().deterministic()
