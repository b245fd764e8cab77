"""Lookups in a mapping that is a table: its size picks the join, and hot keys of the data are split.

The mapping is grouped by key once (a key with two values is an error) and written, so its size is known: one that
fits the broadcast limit is broadcast, any other is joined by sort and merge. For that join the data's most
frequent keys are found with a sketch; their rows are dealt over as many parts as their share of the rows asks for, and
their mapping rows are repeated once a part. Rows without a key are dealt over all parts. Which keys are hot decides
only where rows go, never what they get.
"""

from __future__ import annotations

import json
import uuid
import zlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import TransformError
from ..session import scratch_path

#: Keys that the sketch of the data's keys tracks at the most, for each key it reports.
TRACKED = 20


@dataclass
class TableLookup:
    """A lookup of a text key in ``table`` (``key``, ``value``); the step reads its result from two columns."""

    key: Column
    table: DataFrame
    key_column: str
    value_column: str
    broadcast_bytes: int | None = None
    found: str = field(default_factory=lambda: f"__tl_found_{uuid.uuid4().hex[:8]}")
    value: str = field(default_factory=lambda: f"__tl_value_{uuid.uuid4().hex[:8]}")

    def entries(self) -> DataFrame:
        """The mapping as text, each key once: (key, value, clash). Null keys match nothing."""
        names = self.table.columns
        for name in (self.key_column, self.value_column):
            if names.count(name) != 1:
                raise TransformError(f'Transform "map": the mapping table needs one column "{name}".')
        plain = self.table.toDF(*[f"_m{k}" for k in range(len(names))])
        rows = plain.select(F.col(f"_m{names.index(self.key_column)}").cast("string").alias("key"),
                            F.col(f"_m{names.index(self.value_column)}").cast("string").alias("value"))
        one, other = F.min(F.struct("value")), F.max(F.struct("value"))
        return rows.filter("key is not null").groupBy("key").agg(
            one["value"].alias("value"), (~one.eqNullSafe(other)).alias("clash"))

    def attach(self, frame: DataFrame, live: Column, probe: bool = True) -> DataFrame:
        """``frame`` with the columns ``found`` and ``value``; null for rows that are no longer ``live``.

        Without ``probe`` nothing is read (the schema alone is asked for).
        """
        entries = self.entries()
        own = f"{self.value}_key"
        keyed = frame.withColumn(own, F.when(live, self.key))
        spark = frame.sparkSession
        small = not probe
        if probe:
            path = scratch_path(spark, "mapping")
            entries.write.parquet(path)
            entries = spark.read.schema(entries.schema).parquet(path)
            size = entries.agg(F.sum(F.octet_length("key") + F.coalesce(F.octet_length("value"), F.lit(0)) + 16).alias("bytes"),
                               F.count_if("clash").alias("clashes")).first()
            if size["clashes"]:
                raise TransformError(f'Transform "map": {size["clashes"]} keys of the mapping table have more than one value.')
            limit = broadcast_limit(spark) if self.broadcast_bytes is None else self.broadcast_bytes
            small = (size["bytes"] or 0) <= limit
        right = entries.select(F.col("key").alias(f"{self.value}_k"), F.col("value").alias(self.value),
                               F.lit(True).alias(self.found))
        match = F.col(own) == F.col(f"{self.value}_k")
        if small:
            return keyed.join(F.broadcast(right), match, "left").drop(own, f"{self.value}_k")
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        hot = {} if frame.isStreaming else hot_keys(keyed, own, parts)
        salt = f"{self.value}_salt"
        spread = F.xxhash64(*[F.col(f.name) for f in keyed.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
        share = salts_of(F.col(own), hot)
        keyed = keyed.withColumn(salt, F.when(F.col(own).isNull(), F.pmod(spread, F.lit(parts))).when(
            share > 1, F.pmod(spread, share)).otherwise(F.lit(0)).cast("int"))
        right = right.withColumn(f"{salt}_r", F.explode(F.sequence(F.lit(0), salts_of(F.col(f"{self.value}_k"), hot) - 1)))
        joined = keyed.join(right.hint("merge"), match & (F.col(salt) == F.col(f"{salt}_r")), "left")
        return joined.drop(own, salt, f"{self.value}_k", f"{salt}_r")


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes that the session lets Spark broadcast."""
    return int(spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def hot_keys(rows: DataFrame, key: str, parts: int) -> dict[str, int]:
    """Keys with more than half a partition's fair share of the rows, and the parts their rows are dealt over.

    At most ``2 * parts`` keys can have that many, so that is all the sketch reports and the driver sees.
    """
    most = 2 * parts
    found = rows.select(F.col(key).alias("k")).filter("k is not null").agg(
        F.expr(f"approx_top_k(k, {most}, {most * TRACKED})").alias("top"), F.count("*").alias("n")).first()
    hot = {}
    for item, count in found["top"] or []:
        salts = -(-2 * parts * count // max(found["n"], 1))
        if count * most > found["n"]:
            hot[item] = max(2, min(salts, 2 * parts))
    return hot


def salts_of(key: Column, hot: dict[str, int]) -> Column:
    """The number of parts of each key, 1 if it is not hot."""
    return F.coalesce(F.try_element_at(literal_lookup(hot, key, "int"), key), F.lit(1)) if hot else F.lit(1)


# A map lookup scans its keys, so a mapping is split into hash buckets of about this many keys each.
MAP_BUCKET_SIZE = 16


def literal_lookup(mapping: dict, key: Column, value_type: str = "string") -> Column:
    """The literal map holding ``key``'s entry, if any.

    The mapping is split into buckets by CRC-32 of the key's UTF-8 text; Python places each entry at plan
    time and Spark's ``crc32`` picks the bucket per row, so a row scans one small map instead of the whole
    mapping. All buckets travel as one JSON literal that the optimizer folds into an array of maps, so planning
    takes one call however many entries there are.
    """
    buckets = -(-len(mapping) // MAP_BUCKET_SIZE)
    grouped: list[dict] = [{} for _ in range(buckets)]
    for k, v in mapping.items():
        grouped[zlib.crc32(k.encode("utf-8")) % buckets][k] = v
    maps = F.from_json(F.lit(json.dumps(grouped)), f"array<map<string,{value_type}>>")
    return F.element_at(maps, F.pmod(F.crc32(key.cast("binary")), F.lit(buckets)).cast("int") + F.lit(1))
