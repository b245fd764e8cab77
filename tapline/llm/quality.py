"""Quality scores: random Fourier features of document statistics, ridge regression, isotonic calibration.

1. Statistics of each whole text (lengths, shares of kinds of characters, repetition), scaled by the training
   rows' means and deviations.
2. Random Fourier features: ``sqrt(2/D) cos(Wx + b)`` with Gaussian ``W`` approximates a Gaussian kernel.
3. Ridge regression from the normal equations. Every partition adds up its own D x D sums; a few tasks add
   those; the driver solves one D x D system, whatever the number of rows.
4. Isotonic calibration: labels are summed per score step of 1/2000 in Spark; pooling adjacent violators over
   those steps gives a rising map from raw score to probability.

All labelled training rows are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, slices, string_buffers, text_or_empty

FEATURES = 192
BANDWIDTH = 3.0
RIDGE = 1e-4
SEED = 7
STEPS = 2000
#: Texts are counted in runs of about this many bytes.
BLOCK_BYTES = 1 << 22
WORDS_A_BLOCK = 256

STATISTICS = ("bytes", "words", "word_bytes", "upper", "digits", "marks", "symbols", "feeds", "other_bytes", "bars",
              "shouts", "distinct", "again", "odd_ends", "same_lines")


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros((9, 256), np.uint8)
    at = lambda chars: [ord(c) for c in chars]
    kinds[0, at("ABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 1
    kinds[1, at("0123456789")] = 1
    kinds[2, at(".,;:?")] = 1
    kinds[3, at("#$%&*@<>=+{}[]^~/\\_`\"")] = 1
    kinds[4, at("\n")] = 1
    kinds[5, 128:] = 1
    kinds[6, at("|")] = 1
    kinds[7, at("!")] = 1
    kinds[8, at("abcdefghijklmnopqrstuvwxyz")] = 1
    return kinds


def _word_shares(raw: bytes) -> tuple[int, float, float, float, float]:
    """Words; share of different words (mean over blocks), of words equal to the one before, of words that end
    with a sign other than ``.,;:?``, and of lines seen before in the text."""
    count = again = odd = blocks = 0
    distinct, before, at = 0.0, None, 0
    while at < len(raw):  # pieces of a few megabytes, cut at a space
        end = at + BLOCK_BYTES
        if end < len(raw):
            gap = raw.find(b" ", end)
            end = gap if gap >= 0 else len(raw)
        words = raw[at:end].split()
        at = end
        count += len(words)
        for k in range(0, len(words), WORDS_A_BLOCK):
            part = words[k:k + WORDS_A_BLOCK]
            distinct += len(set(part))
            blocks += len(part)
        again += sum(map(bytes.__eq__, words, words[1:])) + (bool(words) and words[0] == before)
        odd += sum(map(b"#$%&*!|".__contains__, [w[-1] for w in words]))
        before = words[-1] if words else before
    lines = [x for x in raw.split(b"\n") if x]
    same = 1 - len(set(lines)) / len(lines) if lines else 0.0
    most = max(count, 1)
    return count, distinct / max(blocks, 1), again / most, odd / most, same


def statistics(column: pa.Array) -> np.ndarray:
    """One row of :data:`STATISTICS` per text."""
    raw, offsets = string_buffers(column)
    kinds, out = _byte_kinds(), np.zeros((len(offsets) - 1, len(STATISTICS)))
    for first, last in slices(offsets, BLOCK_BYTES):
        off = offsets[first:last + 1]
        size = np.diff(off)
        data, sums = raw[off[0]:off[-1]], np.zeros((9, last - first))
        for k in range(9):
            flags = np.concatenate([np.zeros(1, np.int64), np.cumsum(kinds[k][data], dtype=np.int64)])
            sums[k] = flags[off[1:] - off[0]] - flags[off[:-1] - off[0]]
        shares = np.array([_word_shares(raw[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])])
        most = np.maximum(size, 1)
        letters = np.maximum(sums[0] + sums[8] + sums[5], 1)
        out[first:last] = np.stack([
            np.log1p(size), np.log1p(shares[:, 0]), np.minimum(size / np.maximum(shares[:, 0], 1), 100), sums[0] / letters,
            sums[1] / most, sums[2] / most, sums[3] / most, sums[4] / most, sums[5] / most, sums[6] / most, sums[7] / most,
            shares[:, 1], shares[:, 2], shares[:, 3], shares[:, 4]], axis=1)
    return out


@dataclass
class QualityModel:
    """A fitted model; ``score`` maps statistics to probabilities."""

    mean: np.ndarray
    scale: np.ndarray
    offset: float = 0.5
    weights: np.ndarray = field(default_factory=lambda: np.zeros(FEATURES))
    knots: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    values: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(SEED)
        w = rng.normal(0.0, 1.0 / BANDWIDTH, (stats.shape[1], FEATURES))
        b = rng.uniform(0.0, 2 * np.pi, FEATURES)
        x = np.clip((stats - self.mean) / self.scale, -5, 5)
        return np.sqrt(2.0 / FEATURES) * np.cos(x @ w + b)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.offset + self.fourier(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def with_statistics(df: DataFrame, text_col: str, out_col: str = "_stats") -> DataFrame:
    """``df`` with an array of doubles, one per :data:`STATISTICS`; null text counts as empty. No shuffle."""
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.ArrayType(T.DoubleType()))])
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = statistics(batch.column(at))
            flat = pa.array(stats.ravel(), pa.float64())
            ends = pa.array(np.arange(len(stats) + 1, dtype=np.int32) * stats.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(ends, flat)],
                                             names=[*batch.schema.names, out_col])

    return df.mapInArrow(run, schema)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _summed(rows: DataFrame, model: QualityModel) -> np.ndarray:
    """Sum of (z, y)(z, y)' over rows with ``_stats`` and ``_label``: per partition, then in eight tasks."""
    side = FEATURES + 2

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((side, side))
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                z = model.fourier(_matrix(part.column(0)))
                y = part.column(1).to_numpy(zero_copy_only=False)
                z = np.column_stack([z, np.ones(len(y)), y])
                total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(side * side)
        for batch in batches:
            for one in batch.column(0):
                total += np.frombuffer(one.as_py())
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    parts = rows.select("_stats", F.col("_label").cast("double")).mapInArrow(partition, "sums binary")
    few = parts.repartition(8).mapInArrow(add, "sums binary")
    return sum((np.frombuffer(r["sums"]) for r in few.collect()), np.zeros(side * side)).reshape(side, side)


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The rising sequence nearest to ``values`` (weighted least squares)."""
    blocks: list[list[float]] = []  # mean, weight, length
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v1, w1, n1 = blocks.pop()
            v0, w0, n0 = blocks.pop()
            blocks.append([(v0 * w0 + v1 * w1) / (w0 + w1), w0 + w1, n0 + n1])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks])


def fit(rows: DataFrame) -> QualityModel:
    """Model of rows with ``_stats`` (array) and ``_label`` (0 or 1). Without rows every score is a half; with
    one label every score is near that label."""
    kept = rows.filter("_label is not null")
    pieces = [F.col("_stats")[k] for k in range(len(STATISTICS))]
    head = kept.agg(F.count("*"), *map(F.mean, pieces), *map(F.stddev_pop, pieces)).first()
    d = len(STATISTICS)
    if not head[0]:
        return QualityModel(np.zeros(d), np.ones(d), values=np.array([0.5, 0.5]))
    spread = np.array(head[1 + d:], float)
    model = QualityModel(np.array(head[1:1 + d], float), np.where(spread > 1e-9, spread, 1.0))
    sums, n = _summed(kept, model), float(head[0])
    z_mean, model.offset = sums[:FEATURES, FEATURES] / n, sums[FEATURES, FEATURES + 1] / n
    normal = sums[:FEATURES, :FEATURES] / n - np.outer(z_mean, z_mean) + RIDGE * np.eye(FEATURES)
    model.weights = np.linalg.solve(normal, sums[:FEATURES, FEATURES + 1] / n - z_mean * model.offset)
    model.offset -= float(z_mean @ model.weights)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = model.raw(_matrix(batch.column(0)))
            step = np.clip(np.rint(raw * STEPS), -STEPS, 2 * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(step), batch.column(1)], names=["step", "label"])

    seen = kept.select("_stats", F.col("_label").cast("long").alias("label")).mapInArrow(steps, "step long, label long")
    found = sorted(seen.groupBy("step").agg(F.count("*"), F.sum("label")).collect())
    weights = np.array([r[1] for r in found], float)
    model.knots = np.array([r[0] for r in found], float) / STEPS
    model.values = pool_adjacent(np.array([r[2] for r in found], float) / weights, weights)
    return model


def with_scores(df: DataFrame, model: QualityModel, column: str, from_stats: bool, out_col: str = "_score") -> DataFrame:
    """``df`` with a double ``out_col`` in 0 to 1, from its statistics or straight from its texts. No shuffle."""
    schema = T.StructType([*df.schema.fields, T.StructField(out_col, T.DoubleType())])
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = _matrix(batch.column(at)) if from_stats else statistics(batch.column(at))
            scores = model.score(stats) if len(stats) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                             names=[*batch.schema.names, out_col])

    return df.mapInArrow(run, schema)


def held_out(column, folds: int, fold: int):
    """Whether crc32 of the id as text leaves ``fold`` modulo ``folds``; a null id is never held out."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds == fold, F.lit(False))


def training_rows(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """``_stats`` and ``_label`` of the rows of ``stats`` that are not held out and have a label; a document with
    several labels counts once for each."""
    known = labels.filter(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
    return stats.filter(~held_out(F.col(id_col), 5, 0)).join(known, F.col(id_col) == F.col("_id")).select("_stats", "_label")


def score_documents(stats: DataFrame, model: QualityModel, id_col: str = "doc_id", threshold: float = 0.3) -> DataFrame:
    """``id_col``, ``held_out``, ``score`` and ``predicted`` per row of ``stats``; equal statistics get equal scores, a null
    id is not held out, an empty table gives no rows."""
    scored = with_scores(stats.select(id_col, "_stats"), model, "_stats", from_stats=True, out_col="score")
    return scored.select(id_col, held_out(F.col(id_col), 5, 0).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def document_statistics(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``_stats`` per row of ``df``; null texts count as empty, repeated rows stay, an empty table gives none."""
    texts = df.select(F.col(id_col).alias(id_col), text_or_empty(text_col).alias("_text"))
    return with_statistics(texts, "_text").drop("_text")


def learn_and_accept(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     threshold: float = 0.3) -> DataFrame:
    """The rows of ``df`` that score ``threshold`` or more, with all their columns as they were; learned from the labels of
    its rows that are not held out.

    Texts are looked at once: rows are written with their statistics, from which the model is learned and the scores
    come. Null and empty texts are scored like any other, equal texts alike; without labels every row scores a half; an
    empty table comes back empty.
    """
    safe = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    own, text = (safe.columns[df.columns.index(c)] for c in (id_col, text_col))
    marked = cut(with_statistics(safe, text), "stats")
    model = fit(training_rows(marked.select(F.col(own).alias(id_col), "_stats"), labels, id_col))
    scored = with_scores(marked, model, "_stats", from_stats=True)
    return scored.filter(F.col("_score") >= threshold).select(*safe.columns).toDF(*df.columns)


def accepted(df: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """The rows of ``df`` whose text scores ``threshold`` or more, with all their columns as they were. No shuffle; null texts
    count as empty, repeated rows stay or go together, an empty table stays empty."""
    safe = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    scored = with_scores(safe, model, safe.columns[df.columns.index(text_col)], from_stats=False)
    return scored.filter(F.col("_score") >= threshold).drop("_score").toDF(*df.columns)
