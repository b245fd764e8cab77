"""Importance resampling towards a target distribution, with hashed word and word-pair features.

The texts of a batch are joined with separator sentinels, one regex pass finds all words, and ``searchsorted`` over
the documents' offsets tells each word's document, which masks the pairs that would cross documents before
``bincount``. A joined batch is gone through in windows of about a megabyte, each carrying its last word to the
next, so a very long text takes no more memory than its own bytes.

Two passes over the texts, both narrow: one sums feature counts per bucket (a task sends one number a bucket), one
adds up gains per document with the gains (one number a bucket) broadcast. The draw ranks small rows: a range
partition and prefix sums over partitions give every document its place, without a task that sees them all.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapline.ordinals import in_order

from .common import cut, slices, spare_names

BUCKETS = 10_000
#: Bytes of joined text that are looked at at once; a longer word is looked at whole.
WINDOW_BYTES = 1 << 20
#: Bytes of text joined at once (one text at least).
JOINED_BYTES = 1 << 23
#: Words of lower-cased UTF-8 bytes: everything but the ASCII characters that are no digit and no letter.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")
SENTINEL = b"\x00"


def word_features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Windows of (document of each word, CRC of each word, CRC of it with the word before it, or -1).

    A pair is -1 where the word before belongs to another document or to none.
    """
    data = SENTINEL.join(texts).lower()                      # bytes.lower(): A-Z only
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)   # each with its sentinel
    at, last_word, last_doc = 0, 0, -1
    while at < len(data):
        stop = _BREAK.search(data, min(at + WINDOW_BYTES, len(data)))
        stop = stop.start() if stop else len(data)
        found = list(_WORD.finditer(data, at, stop))
        at = stop + 1
        if not found:
            continue
        n = len(found)
        words = [m.group() for m in found]
        doc = np.searchsorted(ends, np.fromiter((m.start() for m in found), np.int64, n), side="right")
        single = np.fromiter(map(zlib.crc32, words), np.int64, n)
        # CRC-32 runs on: that of "a b" is that of " b" started from that of "a"
        before = [last_word, *single[:-1].tolist()]
        spaced = map(zlib.crc32, repeat(b" "), before)
        pair = np.fromiter(map(zlib.crc32, words, spaced), np.int64, n)
        same = np.empty(n, bool)
        same[0] = doc[0] == last_doc
        np.equal(doc[1:], doc[:-1], out=same[1:])
        pair[~same] = -1
        last_word, last_doc = int(single[-1]), int(doc[-1])
        yield doc, single, pair


def _bytes_of(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of (first row, texts), null as empty, of bounded size together."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)])
    for first, last in slices(offsets, JOINED_BYTES):
        yield first, column.slice(first, last - first).to_pylist()


def count_features(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts of ``df`` fall in each bucket: one row a bucket and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, texts in _bytes_of(batch.column(0)):
                for _, single, pair in word_features(texts):
                    total += np.bincount(single % buckets, minlength=buckets)
                    total += np.bincount(pair[pair >= 0] % buckets, minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(total[hit], pa.int64())], names=["b", "n"])

    counts = np.zeros(buckets, np.int64)
    parts = df.select(F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "b long, n long")
    for row in parts.groupBy("b").agg(F.sum("n").alias("n")).collect():      # at most ``buckets`` rows
        counts[row["b"]] = row["n"]
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of target to source) per bucket, as integers."""
    n = len(source)
    s_all, t_all = float(source.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def document_weights(df: DataFrame, gains: np.ndarray, text_col: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and ``weight`` (floored mean gain, 0 without features): a narrow map.

    Columns of ``df`` with these names are replaced; the text is not among the columns returned.
    """
    base = df.drop("n_words", "n_features", "weight")
    buckets = len(gains)
    values = df.sparkSession.sparkContext.broadcast(gains)
    others = [c for c in base.columns if c != text_col]
    text, = spare_names(base.select(*[f"`{c}`" for c in others]), "text")
    schema = base.select(*[f"`{c}`" for c in others]).schema.add("n_words", "long").add("n_features", "long").add("weight", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = values.value
        for batch in batches:
            words, pairs, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, texts in _bytes_of(batch.column(batch.num_columns - 1)):
                for doc, single, pair in word_features(texts):
                    doc = doc + first
                    low, size = int(doc[0]), int(doc[-1] - doc[0]) + 1
                    real = pair >= 0
                    got = gain[single % buckets] + np.where(real, gain[pair % buckets], 0)
                    here = np.bincount(doc - low, minlength=size)
                    words[low:low + size] += here
                    pairs[low:low + size] += np.bincount((doc - low)[real], minlength=size)
                    np.add.at(total, doc, got)
            n = words + pairs
            mean = np.where(n > 0, total // np.maximum(n, 1), 0)             # floors go down
            kept = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(words), pa.array(n), pa.array(mean)], names=schema.names)

    columns = [F.col(f"`{c}`") for c in others] + [F.col(f"`{text_col}`").cast("string").alias(text)]
    return base.select(*columns).mapInArrow(run, schema)


def gumbel(ident: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 8 hex digits of SHA-256 of ``seed:ident`` (a null id: empty)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u)))


def resample(df: DataFrame, target: DataFrame, text_col: str = "text", id_col: str = "doc_id", percent: int = 25,
             min_words: int = 20, seed: int = 7, buckets: int = BUCKETS) -> DataFrame:
    """Every row of ``df`` without its text, with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Words are runs of digits, letters and non-ASCII characters, A-Z in lower case; features are words and pairs of
    neighbouring words, repeats counted, in ``buckets`` buckets by CRC-32. ``target`` is a table with a column of
    the same name as ``text_col``. ``score`` is the weight plus Gumbel noise fixed by ``seed`` and the id, so the highest
    scores are a draw without replacement. Of the N rows with at least ``min_words`` words, floor(percent * N / 100)
    are drawn; ``rank`` is their place (ties in score go to the smaller id, null ids first) and null for all others.

    A null or empty text has no features and weight 0. Equal rows are drawn one by one, in no fixed order among
    themselves. An empty table gives no rows; an empty target is a uniform one. Columns of ``df`` with the new
    names are replaced.
    """
    gains = bucket_gains(count_features(df, text_col, buckets), count_features(target, text_col, buckets))
    base = df.drop("score", "rank")
    weighed = document_weights(base, gains, text_col)
    scored = cut(weighed.withColumn("score", F.col("weight") + gumbel(F.col(f"`{id_col}`"), seed)), "scores")
    fit = F.col("n_words") >= min_words
    numbered, n = in_order(scored.filter(fit), [F.col("score").desc(), F.col(f"`{id_col}`").asc_nulls_first()], "rank")
    drawn = numbered.withColumn("rank", F.when(F.col("rank") <= percent * n // 100, F.col("rank")))
    return drawn.unionByName(scored.filter(~fit).withColumn("rank", F.lit(None).cast("long")))
