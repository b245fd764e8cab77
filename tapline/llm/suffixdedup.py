"""Removal of byte strings that occur more than once, by hash-compared suffix sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else in the corpus. Strings are
judged on the input; they never cross documents.

1. Equal texts form one class; the texts of a class of two or more are repeated from end to end. Of the copies in
   one batch of rows only one goes through the next steps.
2. Only suffixes that can meet are brought together. Each window of ``LENGTH`` bytes has an anchor: the place in
   it whose ``GRAM`` bytes hash lowest (leftmost of equals). Equal windows have equal anchors at equal offsets, so
   windows are dealt by the anchor's hash. Neighbouring windows share anchors: one row (a span) stands for about
   85 windows, with a hash of all their bytes.
3. Spans of one anchor with the same hash repeat each other whole. Where an anchor has different spans, the bytes
   of one span of each kind are fetched, and the suffixes that start at their windows are sorted by a mergesort
   that compares two suffixes by prefix polynomial hashes: a binary search finds their common extension in 8 steps.
   Neighbours in that order with 200 common bytes are compared byte by byte (a collision is thereby found out, and
   the pair compared anew from its bytes). Repeated windows end up next to each other.
4. An anchor whose different spans have more than ``MANY`` windows is not gathered in a task: its windows are counted
   by a hash of 128 bits each, with partial sums before the shuffle.
5. The repeated windows of each class are united into spans of bytes and cut out.

Texts are shuffled once, by a key of their content, for the steps 3 to 5 together; step 2 reads the table in place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, mix64, slices, string_buffers, text_or_empty

LENGTH, GRAM = 200, 32
REACH = LENGTH - GRAM + 1
#: Bytes of text that are hashed at a time.
BLOCK_BYTES = 1 << 20
#: Suffixes that a task sorts at a time.
SUFFIXES = 1 << 20
#: Suffixes that are compared in one vector operation.
STEP = 1 << 15
#: Windows of one anchor's different spans up to which they are sorted together.
MANY = SUFFIXES // 2

_BASE = 0x9E3779B97F4A7C15 | 1


class _Polynomial:
    """Prefix polynomial hashes modulo 2^64: equal strings have equal hashes wherever they start."""

    up = down = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(_Polynomial.up) < n:
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                powers = np.full(n, base, np.uint64)
                powers[0] = 1
                setattr(_Polynomial, name, np.cumprod(powers, dtype=np.uint64))
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((data + np.uint64(1)) * _Polynomial.up[:n - 1], dtype=np.uint64, out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * _Polynomial.down[start]


def _lowest(keys: np.ndarray, reach: int) -> np.ndarray:
    """Minimum of ``reach`` keys from each place on, with running minima from both ends of blocks."""
    n = len(keys) - reach + 1
    if n <= 0:
        return np.zeros(0, keys.dtype)
    full = np.full(-(-len(keys) // reach) * reach, np.iinfo(np.uint64).max, np.uint64)
    full[:len(keys)] = keys
    blocks = full.reshape(-1, reach)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[reach - 1:reach - 1 + n])


def find_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of the texts in ``data``: row, anchor's hash, span's hash, first window, anchor's offset, windows, and the
    windows from the first one to the last one of a run of equal spans.

    A text that repeats itself with a short period has the same span again and again, one right after the other;
    such a run is one row.
    """
    if len(data) < LENGTH:
        return tuple(np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64, np.int64, np.int64))
    poly = _Polynomial(data)
    grams = mix64(poly.of(np.arange(len(data) - GRAM + 1), GRAM))
    place = np.uint64(max(len(data), 2)).item().bit_length()
    mask = np.uint64((1 << place) - 1)
    low = _lowest((grams & ~mask) | np.arange(len(grams), dtype=np.uint64), REACH) & mask
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(low)]
    first = np.flatnonzero(np.arange(len(low)) + LENGTH <= ends)
    if not len(first):
        return find_spans(data[:0], np.zeros(1, np.int64))
    anchor = low[first].astype(np.int64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(first) != 1)]))
    start, anchor = first[new], anchor[new]
    count = np.diff(np.append(new, len(first)))
    offset = anchor - start
    span = mix64(mix64(poly.of(start, LENGTH + count - 1)) + (offset * 256 + count).astype(np.uint64))
    row, gram = np.searchsorted(offsets, start, side="right") - 1, grams[anchor]
    again = np.concatenate([[False], (gram[1:] == gram[:-1]) & (span[1:] == span[:-1]) & (start[1:] == start[:-1] + count[:-1])])
    head = np.flatnonzero(~again)
    tail = np.append(head[1:], len(start)) - 1
    run = start[tail] + count[tail] - start[head]
    row, start = row[head], start[head]
    return row, gram[head], span[head], start - offsets[row], offset[head], count[head], run


def _pieces(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, offsets, first row, bytes before) of about a megabyte; a longer text comes in overlapping pieces."""
    for first, last in slices(offsets, BLOCK_BYTES):
        begin, end = int(offsets[first]), int(offsets[last])
        if last > first + 1 or end - begin <= 2 * BLOCK_BYTES:
            yield raw[begin:end], offsets[first:last + 1] - begin, first, 0
            continue
        for at in range(begin, max(end - LENGTH + 1, begin + 1), BLOCK_BYTES):
            stop = min(at + BLOCK_BYTES + LENGTH - 1, end)
            yield raw[at:stop], np.array([0, stop - at]), first, at - begin


# --------------------------------------------------------------------------------- suffix sorting

class _Suffixes:
    """Comparison of suffixes of one buffer, up to ``LENGTH`` bytes."""

    def __init__(self, data: np.ndarray):
        self.data = np.concatenate([data, np.zeros(LENGTH + 8, np.uint8)])
        self.poly = _Polynomial(self.data)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common extension of the suffixes at ``i`` and ``j`` by binary search over prefix hashes."""
        answer = np.full(len(i), LENGTH, np.int64)
        differ = np.flatnonzero(self.poly.of(i, LENGTH) != self.poly.of(j, LENGTH))
        i, j = i[differ], j[differ]
        low, high = np.zeros(len(i), np.int64), np.full(len(i), LENGTH - 1, np.int64)
        for _ in range((LENGTH - 1).bit_length()):
            middle = (low + high + 1) >> 1
            same = self.poly.of(i, middle) == self.poly.of(j, middle)
            low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
        answer[differ] = low
        return answer

    def common_by_bytes(self, i: int, j: int) -> int:
        differ = np.flatnonzero(self.data[i:i + LENGTH] != self.data[j:j + LENGTH])
        return int(differ[0]) if len(differ) else LENGTH

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether suffix ``i`` is before ``j``; not if they are equal."""
        n = self.common(i, j)
        a, b = self.data[i + np.minimum(n, LENGTH - 1)], self.data[j + np.minimum(n, LENGTH - 1)]
        wrong = (n < LENGTH) & (a == b)  # a hash collision: decided by the bytes
        for k in np.flatnonzero(wrong):
            n[k] = self.common_by_bytes(int(i[k]), int(j[k]))
            m = min(n[k], LENGTH - 1)
            a[k], b[k] = self.data[i[k] + m], self.data[j[k] + m]
        return (n < LENGTH) & (a < b)

    def equal(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether ``LENGTH`` bytes agree: by hash, then verified byte by byte."""
        same, steps = np.zeros(len(i), bool), np.arange(LENGTH)
        for k in range(0, len(i), STEP):
            some = k + np.flatnonzero(self.common(i[k:k + STEP], j[k:k + STEP]) == LENGTH)
            for at in np.array_split(some, max(1, len(some) >> 13)):
                same[at] = (self.data[i[at][:, None] + steps] == self.data[j[at][:, None] + steps]).all(axis=1)
        return same

    def sort(self, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes by group and text, and the run that each belongs to: suffixes of different runs
        differ in group or in their first 8 bytes."""
        head = np.zeros(len(starts), np.uint64)
        for k in range(8):
            head = (head << np.uint64(8)) | self.data[starts + k]
        order = np.lexsort((head, group))
        new = np.concatenate([[True], (np.diff(group[order]) != 0) | (np.diff(head[order]) != 0)]) if len(order) else np.zeros(0, bool)
        run = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(order)))
        width = 1
        while len(size) and width < size.max():  # merge neighbouring sorted blocks of every longer run
            longer, moved = np.flatnonzero((size > width)[run]), order.copy()
            for k in range(0, len(longer), STEP):
                at = longer[k:k + STEP]
                moved[self._merged_place(starts, order, at, begin[run[at]], size[run[at]], width)] = order[at]
            order = moved
            width *= 2
        return order, run

    def _merged_place(self, starts, order, at, begin, size, width) -> np.ndarray:
        """Where the elements at places ``at`` go when the sorted blocks of ``width`` of their runs are merged in pairs:
        their place in their own block, after the elements of the other block that a binary search puts before them."""
        inner = at - begin
        base, limit = begin + inner // (2 * width) * (2 * width), begin + size
        right = inner // width % 2 == 1
        low = np.where(right, base, np.minimum(base + width, limit))
        high = np.where(right, base + width, np.minimum(base + 2 * width, limit))
        other, mine = low.copy(), starts[order[at]]
        while (todo := np.flatnonzero(low < high)).size:
            middle = (low[todo] + high[todo]) // 2
            theirs = starts[order[middle]]
            # from the left block: go past smaller ones; from the right block: past smaller and equal ones
            past = np.where(right[todo], ~self.less(mine[todo], theirs), self.less(theirs, mine[todo]))
            low[todo], high[todo] = np.where(past, middle + 1, low[todo]), np.where(past, high[todo], middle)
        return base + inner % width + (low - other)


def repeated_windows(buffers: list[bytes], group: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """For each span (its bytes, anchor and number of windows): which of its windows stand in another span too."""
    sizes = np.array([len(b) for b in buffers], np.int64)
    begin = np.cumsum(sizes) - sizes
    suffixes = _Suffixes(np.frombuffer(b"".join(buffers), np.uint8))
    inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = np.repeat(begin, counts) + inner
    order, run = suffixes.sort(starts, np.repeat(group, counts))
    flags = np.zeros(len(starts), bool)
    pair = np.flatnonzero(run[1:] == run[:-1])
    same = pair[suffixes.equal(starts[order[pair]], starts[order[pair + 1]])]
    flags[order[same]] = flags[order[same + 1]] = True
    return np.split(flags, np.cumsum(counts)[:-1])


def _runs_of(flags: np.ndarray) -> list[int]:
    """First and last place of each run of true flags, in one list."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    edges[1::2] -= 1
    return edges.tolist()


# ------------------------------------------------------------------------------------- Spark steps

def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k1, k2, text -> k1, k2, anchor's hash g, span's hash s, p (first window, anchor's offset and windows, packed) and
    run (windows of a run of equal spans)."""
    for batch in batches:
        _, one = np.unique(np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()]), axis=0, return_index=True)
        if len(one) < batch.num_rows:
            batch = batch.take(pa.array(np.sort(one)))
        raw, offsets = string_buffers(batch.column(2))
        for data, off, first, before in _pieces(raw, offsets):
            row, gram, span, start, offset, count, run = find_spans(data, off)
            at = pa.array(row + first)
            packed = ((start + before) << 16) | (offset << 8) | count
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), batch.column(1).take(at), pa.array(gram.astype(np.int64)),
                 pa.array(span.astype(np.int64)), pa.array(packed), pa.array(run)], names=["k1", "k2", "g", "s", "p", "run"])


def _requests(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[dict, bytes]]]:
    """Requested spans with their bytes from rows (id, k1, k2, text, requests), some texts at a time; copies of a
    text stand together and are read once."""
    last = None
    for batch in batches:
        for first in range(0, batch.num_rows, 200):
            part, found = batch.slice(first, 200), []
            raw, offsets = string_buffers(part.column(3))
            for k, key in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                if key != last:
                    for one in part.column(4)[k].as_py():
                        at = int(offsets[k]) + (one["p"] >> 16)
                        found.append((one, raw[at:at + LENGTH + (one["p"] & 255) - 1].tobytes()))
                last = key
            yield found


def _span_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found in _requests(batches):
        yield pa.RecordBatch.from_arrays(
            [pa.array([x["g"] for x, _ in found], pa.int64()), pa.array([x["s"] for x, _ in found], pa.int64()),
             pa.array([x["p"] & 255 for x, _ in found], pa.int32()), pa.array([b for _, b in found], pa.binary())],
            names=["g", "s", "windows", "bytes"])


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for found in _requests(batches):
        rows = [(x["g"], x["s"], j, hashlib.blake2b(data[j:j + LENGTH], digest_size=16).digest())
                for x, data in found for j in range(x["p"] & 255)]
        digests = np.frombuffer(b"".join(r[3] for r in rows), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([r[2] for r in rows], pa.int32()), pa.array(digests[:, 0]), pa.array(digests[:, 1])],
            names=["g", "s", "j", "w1", "w2"])


def _sorted_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by g and s (all rows of an anchor in one partition) -> g, s and the runs of repeated windows."""
    def judge(rows: list[tuple]) -> pa.RecordBatch:
        _, group = np.unique(np.array([r[0] for r in rows], np.int64), return_inverse=True)
        flags = repeated_windows([r[3] for r in rows], group, np.array([r[2] for r in rows], np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
             pa.array([_runs_of(f) for f in flags], pa.list_(pa.int32()))], names=["g", "s", "runs"])

    held: list[tuple] = []
    suffixes = 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and row[:2] == held[-1][:2]:
                continue  # the same span, read from another copy of its text
            if held and suffixes >= SUFFIXES and row[0] != held[-1][0]:
                yield judge(held)
                held, suffixes = [], 0
            held.append(row)
            suffixes += row[2]
    if held:
        yield judge(held)


def _merge(intervals: np.ndarray) -> np.ndarray:
    """The union of (start, end) rows, as rows in order; touching ones are joined."""
    intervals = intervals[np.argsort(intervals[:, 0], kind="stable")]
    reach = np.maximum.accumulate(intervals[:, 1])
    new = np.concatenate([[True], intervals[1:, 0] > reach[:-1]])
    return np.column_stack([intervals[new, 0], reach[np.append(np.flatnonzero(new)[1:] - 1, len(reach) - 1)]])


def _cut_out(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[pa.RecordBatch]:
    """Rows that end with the intervals to cut (lists of starts and ends; a start below 0: all) -> the other columns,
    n_bytes, n_removed, n_spans, kept_sha256 and what is left of the text."""
    for batch in batches:
        raw, offsets = string_buffers(batch.column(text))
        out: list[tuple] = []
        for k, lists in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
            data = raw[offsets[k]:offsets[k + 1]]
            spans = _merge(np.array([x for one in lists for x in one], np.int64).reshape(-1, 2)) if lists else ()
            if len(spans) and spans[0, 0] < 0:
                spans = np.array([[0, len(data)]])
            kept = np.ones(len(data), bool)
            for a, b in spans:
                kept[a:b] = False
            left = data[kept].tobytes()
            out.append((len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest(),
                        left.decode("utf-8", "ignore")))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *(pa.array([x[k] for x in out], pa.int64()) for k in range(3)),
             *(pa.array([x[k] for x in out], pa.string()) for k in (3, 4))],
            names=[*batch.schema.names[:-1], "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def cut_texts(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``kept_text`` (a character that was cut
    in two goes); ``text_col`` holds no nulls and no other column is named ``k1`` or ``k2``."""
    text = F.col(text_col)
    keyed = rows.withColumns({"k1": F.xxhash64(text), "k2": F.xxhash64(F.lit("second"), text, F.length(text))})
    spans = keyed.filter(F.octet_length(text) >= LENGTH).select("k1", "k2", text_col).mapInArrow(
        _anchor_rows, "k1 long, k2 long, g long, s long, p long, run long")
    kind, anchor = Window.partitionBy("g", "s"), Window.partitionBy("g")
    seen = F.when(F.col("run") > F.col("p").bitwiseAND(255), 2).otherwise(1)  # a run has its span twice or more
    # one shuffle by anchor serves all three windows
    met = cut(spans.repartition("g").withColumn("same", F.sum(seen).over(kind))
              .withColumn("nth", F.row_number().over(kind.orderBy("k1", "k2", "p")))
              .withColumn("kinds", F.sum(F.when(F.col("nth") == 1, 1).otherwise(0)).over(anchor))
              .withColumn("load", F.sum(F.when(F.col("nth") == 1, F.col("p").bitwiseAND(255)).otherwise(0)).over(anchor))
              .withColumn("all", F.sum(seen).over(anchor)).filter("all > 1").drop("all"), "met")
    copied = keyed.filter(F.octet_length(text) >= LENGTH).groupBy("k1", "k2").agg(F.count("*").alias("n")).filter("n > 1")

    asked = met.filter("kinds > 1 and nth = 1")
    ours = [c for c in keyed.columns if c != text_col and c not in ("k1", "k2")]
    all_columns = [F.struct(*ours).alias("row"), "k1", "k2", text_col]  # all, so that both joins read one shuffle

    def fetched(condition, reader, schema):
        wanted = asked.filter(condition).groupBy("k1", "k2").agg(F.collect_list(F.struct("g", "s", "p")).alias("wanted"))
        return keyed.join(wanted, ["k1", "k2"]).select(*all_columns, "wanted").mapInArrow(reader, schema)

    judged = fetched(F.col("load") <= MANY, _span_bytes, "g long, s long, windows int, bytes binary").repartition(
        "g").sortWithinPartitions("g", "s").mapInArrow(_sorted_spans, "g long, s long, runs array<int>")
    windows = fetched(F.col("load") > MANY, _window_hashes, "g long, s long, j int, w1 long, w2 long")
    span = F.struct("g", "s")
    twice = windows.groupBy("w1", "w2").agg(F.min(span).alias("a"), F.max(span).alias("b")).filter("a <> b").select("w1", "w2")
    counted = windows.join(twice, ["w1", "w2"]).groupBy("g", "s").agg(F.flatten(F.collect_list(F.array("j", "j"))).alias("runs"))
    partly = judged.unionByName(counted).filter(F.size("runs") > 0)

    start = F.shiftright("p", 16)
    whole = F.array(start, start + F.col("run") - 1 + LENGTH)
    pieces = F.flatten(F.transform(F.sequence(F.lit(0), F.shiftright(F.size("runs"), 1) - 1), lambda k: F.array(
        start + F.get("runs", 2 * k), start + F.get("runs", 2 * k + 1) + LENGTH)))
    found = (met.filter("same > 1").select("k1", "k2", whole.alias("x"))
             .unionByName(met.filter("same = 1").join(partly, ["g", "s"]).select("k1", "k2", pieces.alias("x")))
             .join(copied, ["k1", "k2"], "left_anti")
             .unionByName(copied.select("k1", "k2", F.array(F.lit(-1).cast("long"), F.lit(-1).cast("long")).alias("x"))))
    lists = found.groupBy("k1", "k2").agg(F.collect_list("x").alias("lists"))
    joined = keyed.join(lists, ["k1", "k2"], "left").select(*all_columns, "lists")
    schema = T.StructType([*joined.schema.fields[:-1], *(T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")),
                           T.StructField("kept_sha256", T.StringType()), T.StructField("kept_text", T.StringType())])
    done = joined.mapInArrow(lambda batches: _cut_out(batches, 3), schema)
    return done.select("row.*", text_col, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256`` per row of ``df``.

    Null text counts as empty; texts shorter than ``LENGTH`` bytes keep all; repeated rows are copies of each other,
    whatever their ids; null ids need no care; other columns are ignored; an empty table gives an empty result.
    """
    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return cut_texts(rows, "text").select(F.col("id").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def without_repeats(df: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``df`` with its texts cut; ``chars_col``, if it is there, gets the new length. Rows of which nothing is left
    go, unless their text was empty before. Columns keep their order; a null text stays null."""
    safe = df.toDF(*[f"c{k}" for k in range(len(df.columns))])
    own = safe.columns[df.columns.index(text_col)]
    rows = safe.withColumns({"_null": F.col(own).isNull(), own: text_or_empty(own)})
    left = cut_texts(rows, own).filter("n_removed < n_bytes or n_bytes = 0").withColumn(
        own, F.when(~F.col("_null"), F.col("kept_text")))
    if chars_col in df.columns:
        chars = safe.columns[df.columns.index(chars_col)]
        left = left.withColumn(chars, F.when(F.col("n_removed") > 0, F.length("kept_text").cast(df.schema[chars_col].dataType))
                               .otherwise(F.col(chars)))
    return left.select(*safe.columns).toDF(*df.columns)
