"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

1. Texts are lower-cased and cut into words (runs of ASCII letters, digits, ``_`` and all other characters
   above ASCII). A shingle is ``WIDTH`` words, or the whole item if it is shorter.
2. Windows as long as an item slide over the text wherever they hold at least one of the item's shingles: a
   window without one has similarity 0. Their SimHashes come from running sums of the shingles' bits.
3. The items of that length stand in one table per block of the fingerprint. ``RADIUS`` differing bits cannot touch
   all ``RADIUS + 1`` blocks, so looking up every block finds all items within the radius. Texts of different
   shingles and similarity 0.8 differ by 10 bits of 64 on average (deviation 3); where one shingle is repeated, the
   fingerprints may lie further apart.
4. So every window is also looked at whose running count of the item's shingles allows the similarity: no smaller
   count can reach it, whatever the fingerprints are.
5. Candidates are verified: similarity is the sum of the smaller shingle counts over the sum of the larger.

A narrow map over whole texts; no shuffle. Items are broadcast in buckets of at most ``BUCKET_BYTES`` of text,
one pass over the texts for each bucket, so a benchmark of any size can be taken.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import mix64, slices, string_buffers, text_or_empty

WIDTH = 5
RADIUS = 23
THRESHOLD = 0.8
BUCKET_BYTES = 32 << 20
BLOCK_BYTES = 1 << 20
PAIRS = 1 << 22

_ODD = 0x9E3779B97F4A7C15 | 1
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[ord(c) for c in "0123456789_abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = True
_WORD_BYTE[128:] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """Words of a block of texts: places, rows and 64-bit hashes."""

    up = _powers(_ODD, 0)
    down = _powers(_ODD, 0)

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        n = len(raw)
        if len(Words.up) < n:
            Words.up, Words.down = _powers(_ODD, n), _powers(pow(_ODD, -1, 1 << 64), n)
        inside = _WORD_BYTE[raw]
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        begin = inside.copy()
        begin[1:] &= ~inside[:-1] | first[1:n]
        end = inside.copy()
        end[:-1] &= ~inside[1:] | first[1:n]
        self.raw, self.start, self.end = raw, np.flatnonzero(begin), np.flatnonzero(end) + 1
        self.row = np.searchsorted(offsets, self.start, side="right") - 1
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw + np.uint64(1)) * Words.up[:n], dtype=np.uint64, out=sums[1:])
        self.hash = mix64((sums[self.end] - sums[self.start]) * Words.down[self.start])

    def shingles(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``width`` words from each word on, and whether they are in one text."""
        n = max(len(self.hash) - width + 1, 0)
        out = np.zeros(n, np.uint64)
        for k, c in enumerate(_powers(0xD6E8FEB86659FD93, width)):
            out += self.hash[k:k + n] * c
        return mix64(out), self.row[:n] == self.row[width - 1:width - 1 + n]

    def tokens(self, first: int, last: int) -> list[bytes]:
        return [self.raw[a:b].tobytes() for a, b in zip(self.start[first:last], self.end[first:last])]


def _shingle_counts(tokens: list[bytes], width: int) -> Counter:
    return Counter(b" ".join(tokens[k:k + width]) for k in range(len(tokens) - width + 1))


def _prints(hashes: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SimHash of ``count`` shingles from each start on."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    sums = np.vstack([np.zeros((1, 64), np.int32), np.cumsum(2 * bits - 1, axis=0)])
    return np.packbits(sums[starts + count] - sums[starts] > 0, axis=1).view(">u8").ravel().astype(np.uint64)


def _portions(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of places whose lengths add up to about ``most``."""
    portion = (np.cumsum(lengths) - lengths) // most
    edges = np.append(np.flatnonzero(np.diff(portion, prepend=-1)), len(lengths)).tolist()
    yield from zip(edges[:-1], edges[1:])


def _padded(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.zeros(max(len(a), len(b)), np.int64)
    out[:len(a)] += a
    out[:len(b)] += b
    return out


def _piece_end(raw: np.ndarray, at: int, end: int, words: int) -> int:
    """Where a piece of a long text ends: between words, after about ``BLOCK_BYTES`` and at least so many words."""
    cut, held = at, 0
    while end - cut > 2 * BLOCK_BYTES:
        gap = np.flatnonzero(~_WORD_BYTE[raw[cut + BLOCK_BYTES:cut + 2 * BLOCK_BYTES]])
        if not len(gap):
            return end
        inside = _WORD_BYTE[raw[cut:cut + BLOCK_BYTES + int(gap[0])]]
        held += int(inside[0]) + int((inside[1:] & ~inside[:-1]).sum())
        cut += len(inside)
        if held >= words:
            return cut
    return end


class _Blocks:
    """Multi-index over fingerprints: a sorted table per block; finds all within ``radius``."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius, self.tables = prints, radius, []
        edges = np.linspace(0, 64, min(radius + 1, 64) + 1).astype(int)
        for a, b in zip(edges[:-1], edges[1:]):
            values = self._block(prints, a, b)
            order = np.argsort(values, kind="stable")
            self.tables.append((a, b, order, values[order]))

    @staticmethod
    def _block(prints: np.ndarray, a: int, b: int) -> np.ndarray:
        return (prints >> np.uint64(a)) & np.uint64((1 << int(b - a)) - 1)

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in ``prints``, item, distance) of all pairs within the radius."""
        found = []
        for a, b, order, values in self.tables:
            own = self._block(prints, a, b)
            left, right = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            count = right - left
            place = np.repeat(np.arange(len(own)), count)
            item = order[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(left, count)]
            found.append(place * len(self.prints) + item)
        pairs = np.unique(np.concatenate(found))
        place, item = pairs // len(self.prints), pairs % len(self.prints)
        distance = np.bitwise_count(prints[place] ^ self.prints[item])
        kept = distance <= self.radius
        return place[kept], item[kept], distance[kept]


class Matcher:
    """Finds benchmark items ``(id, text)`` in texts."""

    def __init__(self, items: list[tuple], width: int = WIDTH, radius: int = RADIUS, threshold: float = THRESHOLD):
        self.threshold, self.most = threshold, 0
        self.ids, self.counts = [], []
        by_size, postings = defaultdict(list), defaultdict(lambda: defaultdict(set))
        holders, own_keys = defaultdict(lambda: defaultdict(list)), []
        for item_id, text in items:
            raw = np.frombuffer(pc.utf8_lower(pa.scalar(text or "")).as_py().encode(), np.uint8)
            words = Words(raw, np.array([0, len(raw)]))
            n = len(words.hash)
            if n == 0:
                continue
            w, k = min(width, n), len(self.ids)
            hashes, _ = words.shingles(w)
            self.ids.append(item_id)
            self.counts.append(_shingle_counts(words.tokens(0, n), w))
            by_size[n].append((k, _prints(hashes, np.array([0]), len(hashes))[0]))
            for h in hashes:
                postings[w][int(h)].add(n)
            own_keys.append(np.unique(hashes))
            for h in own_keys[-1].tolist():
                holders[w][h].append(k)
            self.most = max(self.most, n)
        self.indexes = {n: (np.array([k for k, _ in own]), _Blocks(np.array([p for _, p in own], np.uint64), radius))
                        for n, own in by_size.items()}
        self.widths = {}
        for w, sizes in postings.items():
            keys = np.array(sorted(sizes), np.uint64)
            seen = np.zeros(1 << 20, bool)
            seen[(keys >> np.uint64(44)).astype(np.int64)] = True
            self.widths[w] = (seen, keys, sizes)
        self.totals = np.array([c.total() for c in self.counts], np.int64)
        self.own = own_keys
        self.holders = {}
        for w, held in holders.items():
            lists = [held[h] for h in self.widths[w][1].tolist()]
            self.holders[w] = (np.concatenate([[0], np.cumsum([len(x) for x in lists])]), np.array([k for x in lists for k in x], np.int64))

    def _block(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[Words, list[tuple[int, int, float, int, int]]]:
        words, out = Words(raw, offsets), []
        edges = np.searchsorted(words.row, np.arange(len(offsets)))
        for width, (seen, keys, sizes) in self.widths.items():
            hashes, whole = words.shingles(width)
            at = np.flatnonzero(seen[(hashes >> np.uint64(44)).astype(np.int64)] & whole)
            at = at[np.isin(hashes[at], keys)]
            out += self._counted(words, hashes, at, width, edges)
            spots = defaultdict(list)
            for i in at.tolist():
                for n in sizes[int(hashes[i])]:
                    spots[int(words.row[i]), n].append(i)
            for (row, n), hits in spots.items():
                first, last = int(edges[row]), int(edges[row + 1])
                size = min(n, last - first)
                starts = np.unique(np.concatenate([
                    np.arange(max(first, i + width - size), min(i, last - size) + 1) for i in hits]))
                out += [(row, *x) for x in self._windows(words, hashes, starts, size, width, n, first)]
        return words, out

    def _counted(self, words, hashes, at, width, edges) -> Iterator[tuple[int, int, float, int, int]]:
        """Best window of each text and item among those with enough of the item's shingles for the threshold."""
        keys, (begins, items) = self.widths[width][1], self.holders[width]
        key = np.searchsorted(keys, hashes[at])
        rows = words.row[at]
        bounds = np.append(np.flatnonzero(np.diff(rows, prepend=-1)), len(rows)).tolist()
        for a, b in zip(bounds[:-1], bounds[1:]):
            row = int(rows[a])
            first, last = int(edges[row]), int(edges[row + 1])
            total = np.zeros(0, np.int64)
            kinds, times = np.unique(key[a:b], return_counts=True)
            lengths = begins[kinds + 1] - begins[kinds]
            for c, d in _portions(lengths, PAIRS):
                count, n = lengths[c:d], int(lengths[c:d].sum())
                place = np.arange(n) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begins[kinds[c:d]], count)
                more = np.bincount(items[place], np.repeat(times[c:d], count)).astype(np.int64)
                total = _padded(total, more)
            some = np.flatnonzero(total)
            windows = np.minimum(self.totals[some], last - first - width + 1)  # shingles of a window
            need = np.ceil(self.threshold * (self.totals[some] + windows) / (1 + self.threshold) - 1e-9).astype(np.int64)
            fit = total[some] >= need
            for i, size, least in zip(some[fit].tolist(), windows[fit].tolist(), need[fit].tolist()):
                mine = np.isin(key[a:b], np.searchsorted(keys, self.own[i]))
                sums = np.zeros(last - first + 1, np.int32)
                sums[at[a:b][mine] - first + 1] = 1
                np.cumsum(sums, out=sums)
                starts = np.flatnonzero(sums[size:last - first - width + 2] - sums[:last - first - width + 2 - size] >= least)
                found = self._slide(i, words, first, starts.tolist(), width, size) if len(starts) else None
                if found:
                    yield (row, i, *found, size + width - 1)

    def _slide(self, item, words, first, starts, width, size) -> tuple[float, int] | None:
        """The best of the windows of ``size`` shingles at ``starts``, and the first of equals; counts go on from one to the next."""
        own, best, at = self.counts[item], None, 0
        whole = own.total() + size
        while at < len(starts):
            end = at + 1
            while end < len(starts) and starts[end] - starts[end - 1] <= size:
                end += 1
            low = starts[at]
            tokens = words.tokens(first + low, first + starts[end - 1] + size + width - 1)
            shingles = [b" ".join(tokens[k:k + width]) for k in range(len(tokens) - width + 1)]
            held, shared, wanted = Counter(), 0, set(starts[at:end])
            for k, shingle in enumerate(shingles):
                if shingle in own:
                    held[shingle] += 1
                    shared += held[shingle] <= own[shingle]
                if k >= size and shingles[k - size] in own:
                    gone = shingles[k - size]
                    shared -= held[gone] <= own[gone]
                    held[gone] -= 1
                s = low + k - size + 1
                if s in wanted:
                    similarity = shared / (whole - shared)
                    if similarity >= self.threshold and (best is None or similarity > best[0]):
                        best = (similarity, s)
                        if similarity == 1.0:
                            return best
            at = end
        return best

    def _windows(self, words, hashes, starts, size, width, n, row_start) -> Iterator[tuple[int, float, int, int]]:
        """Best window of each item of ``n`` words: (item, similarity, first word, words)."""
        count, own, index = size - width + 1, *self.indexes[n]
        runs = np.split(starts, np.flatnonzero(np.diff(starts) > count) + 1)
        best: dict[int, tuple[float, int]] = {}
        for run in runs:
            low, high = int(run[0]), int(run[-1]) + size
            prints = _prints(hashes[low:high - width + 1], run - low, count)
            place, item, distance = index.near(prints)
            tokens = words.tokens(low, high) if len(place) else []
            for k in np.argsort(distance, kind="stable"):
                i, s = int(own[item[k]]), int(run[place[k]])
                if i in best and best[i][0] == 1.0 and best[i][1] <= s:
                    continue
                a, b = self.counts[i], _shingle_counts(tokens[s - low:s - low + size], width)
                shared = (a & b).total()
                similarity = shared / (a.total() + b.total() - shared)
                if similarity >= self.threshold and (i not in best or (-similarity, s) < (-best[i][0], best[i][1])):
                    best[i] = (similarity, s)
        for i, (similarity, s) in best.items():
            yield i, similarity, s - row_start, size

    def find(self, column: pa.Array) -> list[tuple[int, object, float, int, int]]:
        """(row, item id, similarity, first word, words) for each text and item: its best window."""
        raw, offsets = string_buffers(pc.utf8_lower(column))
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for first, last in slices(offsets, BLOCK_BYTES):
            at, base = offsets[first], 0
            while True:  # a longer text is cut between words, in pieces that hold two items and share one
                end = offsets[last]
                if last == first + 1:
                    end = _piece_end(raw, at, end, 2 * (self.most + WIDTH))
                off = np.minimum(offsets[first:last + 1], end) - at
                off[0] = 0
                words, found = self._block(raw[at:end], off)
                for row, item, similarity, start, size in found:
                    key = (first + row, item)
                    if key not in best or similarity > best[key][0]:
                        best[key] = (similarity, start + base, size)
                if end == offsets[last]:
                    break
                keep = len(words.start) - self.most - WIDTH  # at least as many as are looked at again
                at += int(words.start[keep])
                base += keep
        return [(row, self.ids[item], *x) for (row, item), x in sorted(best.items())]


def _buckets(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple]]:
    """The items, in buckets whose texts fit the bound for a broadcast."""
    items = benchmark.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")).filter("text <> ''")
    size = items.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    buckets = -(-(size[0] or 0) // BUCKET_BYTES)
    for k in range(buckets):
        own = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(buckets)) == k) if buckets > 1 else items
        yield [tuple(r) for r in own.collect()]


def _matcher(state: dict) -> Matcher:
    """The matcher of a broadcast bucket of items: made once a worker, as the broadcast's value lives as long as that."""
    if "matcher" not in state:
        state["matcher"] = Matcher(state["items"])
    return state["matcher"]


def matches(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``id_col``, ``item_id_col``, ``similarity``, ``start_word`` and ``n_words`` of the best window for each row of
    ``df`` and item with similarity ``THRESHOLD`` or more; the earliest of equals.

    Null and empty texts and items match nothing; repeated rows give repeated results; items with the same text
    are all reported; an empty table gives an empty result. A text shorter than the item is one window.
    """
    spark = df.sparkSession
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType),
                           T.StructField("item", benchmark.schema[item_id_col].dataType),
                           T.StructField("similarity", T.DoubleType()), T.StructField("start_word", T.LongType()),
                           T.StructField("n_words", T.LongType())])
    texts = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    arrow = [to_arrow_type(f.dataType) for f in schema.fields[1:]]
    result = spark.createDataFrame([], schema)
    for items in _buckets(benchmark, item_id_col, item_text_col):
        shared = spark.sparkContext.broadcast({"items": items})

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value)
            for batch in batches:
                found = matcher.find(batch.column(1))
                rows = pa.array([x[0] for x in found], pa.int64())
                more = [pa.array([x[k] for x in found], arrow[k - 1]) for k in range(1, 5)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), *more], names=schema.names)

        result = result.unionByName(texts.mapInArrow(run, schema))
    return result.withColumnsRenamed({"id": id_col, "item": item_id_col})


def clean(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that match no item, with all their columns as they were.

    Null and empty texts and items match nothing, so such rows stay; of repeated rows all stay or all go; an empty
    table, or one without items, comes back as it is.
    """
    spark, at, names = df.sparkSession, df.columns.index(text_col), df.columns
    df = df.toDF(*[f"c{k}" for k in range(len(names))])
    for items in _buckets(benchmark, item_id_col, item_text_col):
        shared = spark.sparkContext.broadcast({"items": items})

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value)
            for batch in batches:
                kept = np.ones(batch.num_rows, bool)
                kept[[x[0] for x in matcher.find(batch.column(at))]] = False
                yield batch.filter(pa.array(kept))

        df = df.mapInArrow(run, df.schema)
    return df.toDF(*names)
