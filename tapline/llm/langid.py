"""Language identification: words first, then ever shorter character n-grams.

A known word adds its log frequency in each language. An unseen word falls back to its 4-grams (with the
word's edges); if none of them is known, to its 3-grams, and so on. The model is learned from a bounded number of
labelled rows a language (``MAX_ROWS`` different texts of smallest hash), and holds all their words seen at least twice and
all their n-grams; the size of what is broadcast is checked (``MAX_ENTRIES``). Scoring is a narrow map over whole
texts.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, text_or_empty

MAX_ROWS = 2000
#: Words and n-grams of all languages that a model may hold.
MAX_ENTRIES = 4_000_000
LONGEST_GRAM = 4
#: Words a worker remembers; beyond it the memory starts afresh.
REMEMBERED = 400_000
#: Words that count fully towards certainty; more do not raise it.
FULL_WORDS = 20
PIECE_CHARS = 1 << 20

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Iterator[list[str]]:
    """Lower-cased letter runs, in lists of about a megabyte of text."""
    at = 0
    while at < len(text):
        end = at + PIECE_CHARS
        while end < len(text) and text[end].isalpha():
            end += 1
        yield _WORD.findall(text[at:end].lower())
        at = end


def grams_of(word: str, n: int) -> list[str]:
    edged = f"\x02{word}\x03"
    return [edged[k:k + n] for k in range(len(edged) - n + 1)] if n > 1 else list(word)


def count_grams(labelled: DataFrame) -> DataFrame:
    """``n`` (0 for words), ``lang``, ``gram`` and ``count`` over rows of ``lang`` and ``text``, all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                words: dict[str, Counter] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    for some in words_of(text or ""):
                        words.setdefault(lang, Counter()).update(some)
                rows: Counter = Counter()
                for lang, counts in words.items():
                    for word, c in counts.items():
                        rows[0, lang, word] += c
                        for n in range(1, LONGEST_GRAM + 1):
                            for g in grams_of(word, n):
                                rows[n, lang, g] += c
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in rows], pa.int32()), pa.array([k[1] for k in rows], pa.string()),
                     pa.array([k[2] for k in rows], pa.string()), pa.array(list(rows.values()), pa.int64())],
                    names=["n", "lang", "gram", "count"])

    parts = labelled.select("lang", "text").mapInArrow(run, "n int, lang string, gram string, count long")
    return parts.groupBy("n", "lang", "gram").agg(F.sum("count").alias("count"))


def sample_rows(rows: DataFrame, max_rows: int) -> DataFrame:
    """About ``max_rows`` different texts of each language at the most (``lang``, ``text``), those of smallest hash.

    A language's rows are counted first; hashes are even, so the share of the hash range that holds so many is known, and
    rows outside it go where they are read. Copies of a text are one row, combined before the shuffle.
    """
    rows = rows.withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 11))
    share = F.least(F.lit(float(max_rows)) / F.col("rows"), F.lit(1.0))
    bounds = rows.groupBy("lang").agg(F.count("*").alias("rows")).select(
        F.col("lang").alias("bound_lang"), (share * float(1 << 53)).alias("bound"))
    bound = {r["bound_lang"]: r["bound"] for r in bounds.collect()}     # a number a language
    limit = F.lit(-1.0)
    for lang, value in bound.items():
        limit = F.when(F.col("lang") == lang, F.lit(value)).otherwise(limit)
    return rows.filter(F.col("h") < limit).groupBy("lang", "h").agg(F.min("text").alias("text")).select("lang", "text")


def fit(df: DataFrame, text_col: str = "text", lang_col: str = "lang", max_rows: int = MAX_ROWS) -> dict:
    """Model of the rows of ``df`` with text and language: about ``max_rows`` different texts of each language at the
    most (:func:`sample_rows`), words seen at least twice in them, and all their n-grams. Without rows no language is
    learned. ValueError if that is over ``MAX_ENTRIES``; nothing is dropped to stay below it."""
    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    counts = count_grams(sample_rows(rows.filter("lang is not null and text is not null"), max_rows))
    kept = cut(counts.filter((F.col("n") > 0) | (F.col("count") > 1)), "grams")
    size = kept.count()
    if size > MAX_ENTRIES:
        raise ValueError(f"{size} words and n-grams were learned; the bound is {MAX_ENTRIES}. Lower max_rows.")
    found = kept.toPandas()
    langs = sorted(found["lang"].unique())
    tables = []
    for n in range(LONGEST_GRAM + 1):
        part = found[found["n"] == n]
        wide = part.pivot_table(index="gram", columns="lang", values="count", fill_value=0).reindex(columns=langs, fill_value=0)
        counts_of = wide.to_numpy(float)
        logs = np.log((counts_of + 0.1) / (counts_of.sum(axis=0) + 0.1 * max(len(wide), 1)))
        tables.append(({g: k for k, g in enumerate(wide.index)}, logs))
    return {"langs": langs, "tables": tables}


class Scorer:
    """Scores texts with a model of :func:`fit`."""

    def __init__(self, model: dict):
        self.langs, tables = model["langs"], model["tables"]
        known, self.logs = tables[0]
        self.grams = tables[1:]
        self.first = len(known)
        self.known = known
        self.rows = np.vstack([self.logs, np.zeros((REMEMBERED, len(self.langs)))]) if self.langs else np.zeros((0, 0))
        self.ids = dict(known)

    def _unseen(self, word: str) -> np.ndarray:
        for n in range(LONGEST_GRAM, 0, -1):
            index, logs = self.grams[n - 1]
            found = [index[g] for g in grams_of(word, n) if g in index]
            if found:
                return logs[found].mean(axis=0)
        return np.zeros(len(self.langs))

    def _sum(self, words: list[str]) -> np.ndarray:
        ids = list(map(self.ids.get, words))
        if None in ids:
            for k, i in enumerate(ids):
                if i is None:
                    i = self.ids.get(words[k])
                    if i is None:
                        i = len(self.ids)
                        if i == len(self.rows):
                            done = self.rows[ids[:k]].sum(axis=0)
                            self.ids = dict(self.known)
                            return done + self._sum(words[k:])
                        self.rows[i] = self._unseen(words[k])
                        self.ids[words[k]] = i
                    ids[k] = i
        return self.rows[ids].sum(axis=0)

    def predict(self, text: str) -> tuple[str, float]:
        """Language and certainty; ``und`` and 0 without letters."""
        if not any(c.isalpha() for c in text):
            return "und", 0.0
        total, count = np.zeros(len(self.langs)), 0
        for words in words_of(text):
            if words and self.langs:
                for k in range(0, len(words), 1000):
                    total += self._sum(words[k:k + 1000])
            count += len(words)
        if not count or not self.langs:
            return "und", 0.0
        scaled = total * (min(count, FULL_WORDS) / count)
        odds = np.exp(scaled - scaled.max())
        best = int(np.argmax(odds))  # ties: the first language by name
        return self.langs[best], float(odds[best] / odds.sum())


def predict(df: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` per row of ``df``; null text and texts without a letter are ``und``."""
    shared = df.sparkSession.sparkContext.broadcast({"model": model})
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        if "scorer" not in state:  # the broadcast's value lives as long as the worker
            state["scorer"] = Scorer(state["model"])
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                part = batch.slice(first, 512)
                answers = [state["scorer"].predict(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([a[0] for a in answers], pa.string()),
                     pa.array([a[1] for a in answers], pa.float64())], names=schema.names)

    texts = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(run, schema).withColumnRenamed("id", id_col)
