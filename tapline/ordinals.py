"""Global row numbers without a single task: rows per partition, prefix sums over partitions, place in the partition.

A sorted table is written once with each row's partition and place in it, so its numbers hold however often it
is read again; the sums are one number a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.names import spare_names
from .session import scratch_path

#: ``monotonically_increasing_id`` holds the partition above these bits and the row's place below them.
PLACE_BITS = 33


def partition_of(place: Column) -> Column:
    return F.shiftrightunsigned(place, PLACE_BITS)


def row_of(place: Column) -> Column:
    return place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def rows_per_partition(placed: DataFrame, place: str) -> dict[int, int]:
    """Rows of each partition that has some; one number a partition reaches the driver."""
    counts = placed.groupBy(partition_of(F.col(place)).alias("p")).agg(F.count("*").alias("n"))
    return {int(r["p"]): int(r["n"]) for r in counts.collect()}


def starts(counts: dict[int, int]) -> tuple[dict[int, int], int]:
    """Rows before each partition, and all rows."""
    before, total = {}, 0
    for p in sorted(counts):
        before[p] = total
        total += counts[p]
    return before, total


def by_partition(df: DataFrame, place: str, values: dict[int, int], name: str) -> DataFrame:
    """``df`` with ``name``: its partition's value, 0 if it has none.

    The values are one row a partition: they are joined by broadcast, whose size the number of partitions bounds.
    """
    part, value = spare_names(df, "part", "value")
    rows = df.sparkSession.createDataFrame(sorted(values.items()) or [(-1, 0)], f"`{part}` long, `{value}` long")
    joined = df.join(F.broadcast(rows), partition_of(F.col(place)) == F.col(part), "left")
    return joined.withColumn(name, F.coalesce(value, F.lit(0))).drop(part, value)


def in_order(df: DataFrame, order: list, name: str = "ordinal") -> tuple[DataFrame, int]:
    """``df`` with its row number from 1 in the given order as the column ``name``, and the number of rows.

    Rows that tie in all of ``order`` are neighbours in no fixed order: name enough columns. A range partition, a
    sort within each and one written table; an empty table gives no rows and 0.
    """
    place, = spare_names(df, "place")
    path = scratch_path(df.sparkSession, "ordered")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id())
    placed.write.parquet(path)
    placed = df.sparkSession.read.schema(placed.schema).parquet(path)
    before, total = starts(rows_per_partition(placed, place))
    numbered = by_partition(placed, place, before, name)
    return numbered.withColumn(name, F.col(name) + row_of(F.col(place)) + 1).drop(place), total
