"""Exact URL lists as a cascade of Bloom filters, in DataFrame functions only.

Level 1 encodes the listed keys; level 2 the unlisted keys of the corpus that level 1 lets through; level 3
the listed keys that level 2 lets through; and so on until a level lets nothing wrong through. The corpus's
complete key universe is known, so the answer for each of its keys is exact, and a lookup needs no join: the
filters are constants of the plan.

Size: the first level's false-positive rate is the share of listed keys in the universe and every later one's
is a half, so all levels together hold a few bits times log2(universe / listed) for each *listed* key. That
is checked against ``MAX_BITS`` before a filter leaves the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Bits of one level at the most (16 MB).
MAX_BITS = 1 << 27



UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.substr(url, at + 3)
    host = F.regexp_extract(rest, "^([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^([^?#]*)", 1)
    known = F.coalesce(at > 0, F.lit(False))
    return F.when(known, F.translate(host, UPPER, LOWER)).otherwise(""), F.when(known, path).otherwise("")


def rule_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys (host suffix + path prefix) under which a rule of one of ``shapes`` (labels, path length) would fit."""
    labels = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1
    return F.array_compact(F.array(*[
        F.when((labels >= n) & (F.length(path) >= k), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, k)))
        for n, k in shapes]))


def _positions(key: Column, level: int, hashes: int, bits: int) -> list[Column]:
    h = F.xxhash64(key, F.lit(level))
    a, b = F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1)).bitwiseOR(F.lit(1).cast("long"))
    return [(a + b * i) % bits for i in range(hashes)]


def _holds(key: Column, level: int, bits: int, hashes: int, data: bytes) -> Column:
    """Whether one level's filter lets ``key`` through."""
    held = F.lit(True)
    for p in _positions(key, level, hashes, bits):
        byte = F.hex(F.substr(F.lit(bytearray(data)), F.shiftright(p, 3).cast("int") + 1, F.lit(1)))
        held = held & (F.getbit(F.conv(byte, 16, 10).cast("int"), p.bitwiseAND(F.lit(7)).cast("int")) == 1)
    return held


class Cascade:
    """Levels of (bits, hashes, filter bytes); ``contains`` is a column expression."""

    def __init__(self, levels: list[tuple[int, int, bytes]]):
        self.levels = levels

    def contains(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels), 0, -1):
            answer = F.when(_holds(key, level, *self.levels[level - 1]), answer).otherwise(F.lit(level % 2 == 0))
        return answer


def _filter_bytes(keys: DataFrame, level: int, hashes: int, bits: int) -> bytes:
    """The level's filter: bit positions are combined per byte before and after the shuffle."""
    spread = keys.select(F.explode(F.array(*_positions(F.col("key"), level, hashes, bits))).alias("p"))
    marked = spread.select(F.shiftright("p", 3).alias("byte"),
                           F.expr("shiftleft(1, cast(p & 7 as int))").alias("bit"))
    packed = marked.groupBy("byte").agg(F.bit_or("bit").alias("value"))
    data = bytearray(-(-bits // 8))
    for row in packed.toLocalIterator():
        data[row["byte"]] = row["value"]
    return bytes(data)


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade over the string column ``key`` of ``listed``; exact for all keys of ``universe`` and ``listed``.

    Null keys are never listed; repeated keys count once; an empty list gives a cascade that holds nothing.
    ValueError if a level would take more than ``MAX_BITS``: a list of that size has to be split.
    """
    flagged = listed.select("key", F.lit(1).alias("l")).unionByName(universe.select("key", F.lit(0).alias("l")))
    keys = cut(flagged.filter("key is not null").groupBy("key").agg((F.max("l") == 1).alias("listed")), "keys")
    sides = [keys.filter("listed").select("key"), keys.filter("not listed").select("key")]
    sizes = {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}
    encode, against = sizes.get(True, 0), sizes.get(False, 0)
    levels: list[tuple[int, int, bytes]] = []
    while encode:
        rate = min(0.5, encode / max(against, 1)) if not levels else 0.5
        hashes = max(1, math.ceil(-math.log2(rate)))
        bits = max(64, math.ceil(encode * hashes / math.log(2)))
        if bits > MAX_BITS:
            raise ValueError(f"level {len(levels) + 1} of the cascade needs {bits} bits; the bound is {MAX_BITS}")
        level = len(levels) + 1
        levels.append((bits, hashes, _filter_bytes(sides[0], level, hashes, bits)))
        wrong = cut(sides[1].filter(_holds(F.col("key"), level, *levels[-1])), "through")
        sides = [wrong, sides[0]]
        encode, against = wrong.count(), encode
    return Cascade(levels)


def judge_urls(df: DataFrame, rules: list[tuple[str, str, str]], url_col: str = "url", default: str = "allow") -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` are (verdict, host, path); a rule fits its host and all subdomains if the url's path starts with
    the rule's, and the longest fitting one (host and path together) wins. A url under no rule is not listed
    and gets ``default``. Null urls and urls without ``://`` have empty host and path. Columns of ``df`` with
    the new names are replaced.
    """
    spark = df.sparkSession
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules})
    host, path = split_url(F.col(url_col))
    split = df.withColumns({"host": host, "path": path}).withColumn("__url_keys", rule_keys(F.col("host"), F.col("path"), shapes))
    universe = split.select(F.explode("__url_keys").alias("key")).distinct()
    verdicts = sorted({v for v, _, _ in rules})
    lists = {}
    for verdict in verdicts:
        own = [h + p for v, h, p in rules if v == verdict]
        lists[verdict] = build_cascade(spark.range(1).select(F.explode(F.array(*map(F.lit, own))).alias("key")), universe)
    verdict_of = F.lit(None).cast("string")
    for verdict in verdicts:
        verdict_of = F.when(lists[verdict].contains(F.col("rule")), F.lit(verdict)).otherwise(verdict_of)

    def fits(key):
        hit = F.lit(False)
        for verdict in verdicts:
            hit = hit | lists[verdict].contains(key)
        return hit

    longest = F.get(F.array_sort(F.filter("__url_keys", fits), lambda a, b: F.length(b) - F.length(a)), F.lit(0))
    return split.withColumn("rule", longest).withColumn(
        "verdict", F.when(F.col("rule").isNull(), F.lit(default)).otherwise(verdict_of)).drop("__url_keys")
