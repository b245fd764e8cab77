"""SimHash near-duplicates: segment-popcount embedding, grid range-join, exact check.

1. A fingerprint of 64 bits per text: the majority of every bit over the hashes of its word shingles.
2. Every distinct fingerprint is mapped to the bit counts of its 16 four-bit segments. The Manhattan
   distance of two such points never exceeds the Hamming distance of the fingerprints, so it is a
   lower bound that loses no pair.
3. Grid range-join: two lattice points within distance 2r share a lattice point within r of both; r is 1
   here (links at two bits), so each fingerprint is dealt to its own cell and the at most 32 around it.
   A fingerprint that shares no cell with another has no partner.
4. Exact check of those that do. The few members of an ordinary cell are compared by their bits where they
   stand, which clears chance neighbours; members of a full cell all go on. Then, for any number of members:
   fingerprints within 2r bits share a bit string within r bits of both. Each candidate emits the strings
   within r bits of itself; the group of a string is linked to its smallest member. Members of one group
   differ by 2r bits at the most, so every link is true, and any two fingerprints within 2r bits meet in some
   group, so none is lost. A group costs one row per member and string, never a pair of members.
5. Connected components of the links, with alternating star steps.

Fingerprints, links and components are joined by shuffles only: a broadcast would pass them through the driver.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, text_or_empty

SEGMENTS = 16
HASH_SEED = 42
#: Members of a cell up to which they are compared at once; a fuller cell leaves its check to the strings.
FULL_CELL = 32
#: Texts are cut into words in pieces of about this many bytes, so a text of any length needs little memory.
PIECE_BYTES = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _word_pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text in lists; words are cut at white space only."""
    at = 0
    while at < len(raw):
        end = at + PIECE_BYTES
        if end < len(raw):
            gap = _SPACE.search(raw, end)
            end = gap.start() if gap else len(raw)
        yield raw[at:end].lower().split()
        at = end


def fingerprint_text(raw: bytes, width: int = 3) -> int:
    """Fingerprint of one UTF-8 text as an unsigned 64-bit number; 0 if it has no word."""
    digest, seed = xxhash.xxh64_digest, HASH_SEED
    bits, total, carry = np.zeros(64, np.int64), 0, []
    for words in _word_pieces(raw):
        words = carry + words
        if len(words) >= width:
            joined = b"".join([digest(b" ".join(s), seed) for s in zip(*(words[k:] for k in range(width)))])
            hashes = np.frombuffer(joined, np.uint8).reshape(-1, 8)
            for block in range(0, len(hashes), 1 << 15):
                bits += np.unpackbits(hashes[block:block + (1 << 15)], axis=1).sum(axis=0, dtype=np.int64)
            total += len(hashes)
        carry = words[len(words) - width + 1:] if len(words) >= width else words
    if total == 0:
        if not carry:
            return 0
        return int.from_bytes(digest(b" ".join(carry), seed), "big")
    return int.from_bytes(np.packbits(2 * bits > total).tobytes(), "big")


def with_fingerprints(df: DataFrame, text_col: str = "text", width: int = 3, out_col: str = "_simhash") -> DataFrame:
    """``df`` with a long column ``out_col``: the fingerprint's 64 bits. Null text counts as empty."""
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.LongType(), False)])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint_text((t or "").encode("utf-8", "surrogatepass"), width) for t in batch.column(at).to_pylist()]
            signed = pa.array(np.array(prints, np.uint64).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, signed], names=[*batch.schema.names, out_col])

    return df.mapInArrow(run, schema)


def _segment_counts(fp: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(fp, 4 * s).bitwiseAND(F.lit(15).cast("long"))) for s in range(SEGMENTS)]


def _cells(prints: DataFrame) -> DataFrame:
    """(``fp``, ``cell``): the fingerprint's lattice point and the points one step away, packed into a long (4 bits a
    segment). The point is a column of its own, else the plan, which the driver holds, has it 33 times."""
    names = [f"s{s}" for s in range(SEGMENTS)]
    counts = prints.select("fp", *[c.alias(n) for c, n in zip(_segment_counts(F.col("fp")), names)])
    home = None
    for s, n in enumerate(names):
        part = F.shiftleft(F.col(n).cast("long"), 4 * s)
        home = part if home is None else home + part
    steps = [F.col("home")]
    for s, n in enumerate(names):
        unit = F.lit(1 << (4 * s)).cast("long")
        steps += [F.when(F.col(n) < 4, F.col("home") + unit), F.when(F.col(n) > 0, F.col("home") - unit)]
    return counts.withColumn("home", home).select("fp", F.explode(F.array_compact(F.array(*steps))).alias("cell"))


def _near_strings(fp: Column) -> Column:
    """The fingerprint and the 64 strings one bit away from it."""
    masks = [0] + [1 << b for b in range(63)] + [-(1 << 63)]
    return F.array(*[fp.bitwiseXOR(F.lit(m).cast("long")) for m in masks])


def _links(prints: DataFrame) -> DataFrame:
    """Links (a, b), a > b, between distinct fingerprints ``fp`` that connect all pairs within two bits."""
    # a small table in few files becomes many rows here: deal it out first
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = _cells(prints.repartition(parts, "fp"))
    shared = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    met = cells.join(shared.hint("merge"), "cell")
    near = F.filter("fps", lambda x: F.exists("fps", lambda y: (x != y) & (F.bit_count(x.bitwiseXOR(y)) <= 2)))
    few = met.filter(F.col("n") <= FULL_CELL).groupBy("cell").agg(F.collect_list("fp").alias("fps"))
    candidates = cut(few.select(F.explode(near).alias("fp")).unionByName(
        met.filter(F.col("n") > FULL_CELL).select("fp")).distinct(), "near")   # used twice: one plan, not two copies
    strings = candidates.select("fp", F.explode(_near_strings(F.col("fp"))).alias("z"))
    heads = strings.groupBy("z").agg(F.min("fp").alias("b"), F.max("fp").alias("high")).filter("b <> high").select("z", "b")
    return strings.join(heads.hint("merge"), "z").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; the root is the component's smallest node.

    Alternating large-star and small-star steps; each round is written to the shared folder. A star
    step sends every link once to each end, with partial minima, so a node of any degree costs one
    row per link; the joins may be split by adaptive execution.
    """
    edges, before = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "star"), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low.hint("merge"), "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(down.hint("merge"), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(down.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        edges = cut(small, "star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
        before = tuple(now)


def classes(prints: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per distinct fingerprint of ``prints`` (``_simhash``, ``id_col``): its component's smallest id and the
    fingerprint of the document that has it. Columns ``fp``, ``component_id``, ``keep_fp``."""
    distinct = cut(prints.groupBy(F.col("_simhash").alias("fp")).agg(F.min(F.col(id_col)).alias("low")), "prints")
    linked = components(_links(distinct))
    rooted = distinct.join(linked.hint("merge"), distinct["fp"] == linked["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    heads = rooted.groupBy("root").agg(F.min(F.struct(F.col("low").isNull().alias("n"), "low", "fp")).alias("h"))
    return rooted.join(heads.hint("merge"), "root").select("fp", F.col("h.low").alias("component_id"), F.col("h.fp").alias("keep_fp"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``id_col``, ``fingerprint`` (16 hex digits) and ``component_id`` per row of ``df``; links at two bits or fewer.

    Null or empty texts, and texts without a word, have fingerprint zero and link like any other. A null id
    never becomes a component id unless all ids of a component are null. Repeated rows stay repeated.
    Other columns are ignored; an empty table gives an empty result.
    """
    texts = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    prints = cut(with_fingerprints(texts, "text", width).select(F.col("id").alias(id_col), "_simhash"), "simhash")
    found = classes(prints, id_col)
    return prints.join(found.hint("merge"), prints["_simhash"] == found["fp"]).select(
        prints[id_col], F.lower(F.lpad(F.hex("_simhash"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row of ``df`` per component: a row with the component's smallest id. All columns are kept.

    The first row of each fingerprint is chosen before the shuffle (a rank limit of one), so a group of
    copies of any size sends one row per task.
    """
    safe = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    ids, texts = (safe.columns[df.columns.index(c)] for c in (id_col, text_col))
    marked = cut(with_fingerprints(safe, texts, width), "marked")
    reps = classes(marked.select(ids, "_simhash"), ids).filter("fp = keep_fp").select(F.col("fp").alias("_simhash"))
    order = Window.partitionBy("_simhash").orderBy(F.col(ids).asc_nulls_last(), F.xxhash64(*safe.columns))
    first = marked.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1")
    return first.join(reps.hint("merge"), "_simhash", "left_semi").select(*safe.columns).toDF(*df.columns)
