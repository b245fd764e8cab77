"""Collocations: phrases of up to four words that stand together more often than their parts.

Counting is by a HAT-trie in every task: a shallow trie over word ids whose leaves are hash containers of the
rest of the phrase; a container that grows past ``BURST`` bursts into containers one word deeper. When a task's
trie holds ``MOST`` phrases, its largest subtrees are spilled whole, as sorted runs; runs are dealt by prefix (and
a part of it, since a frequent first word may begin very many phrases) and merged there.

Most phrases of a corpus are rare, and a phrase is frequent only if its words and word pairs are. So two narrow passes
come first: one sums counts of word hashes, one of the hashes of pairs of frequent words. Either gives a Bloom filter of
bounded size (``MAX_BITS``) with which the trie's pass leaves most phrases out. Neither hash collisions nor a full filter
can hide a frequent phrase; what they let through is counted exactly, by its words, so they cost time, never results.

Everything after the counts is joins of frequent phrases with their parts, salted where a part is in many phrases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from heapq import nlargest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, mix64, slices

LONGEST = 4
#: Phrases a container holds before it bursts, and phrases a task's trie holds before subtrees are spilled.
BURST, MOST = 4096, 1_000_000
#: Words a task knows by an id of 21 bits; the trie is spilled and ids start afresh beyond.
MOST_WORDS = 1 << 20
ID_BITS = 21
#: Different hashes that a task sums before it hands them on.
MOST_HASHES = 2_000_000
#: Bits of a filter at the most (16 MB), and bits a frequent phrase.
MAX_BITS, KEY_BITS, HASHES = 1 << 27, 16, 4
#: Parts that the phrases of one prefix are dealt into, and copies of a part's count in joins.
PARTS, SALTS = 16, 8
#: Rows of spilled subtrees that are handed to Spark together.
RUN_ROWS = 50_000
#: Languages that a task counts side by side.
MOST_LANGS = 256
#: Bytes of joined text that are looked at at once (a longer word is looked at whole), and that are joined.
WINDOW_BYTES = 1 << 20
JOINED_BYTES = 1 << 23
#: Fixed by the definition of pieces and words: what ends a piece, and what else ends a word.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_BREAK = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(PIECE_ENDS)] = 2

RUN = "lang string, prefix string, phrase string, n long"
#: An odd multiplier and its inverse modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15
UNBASE = pow(BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class WordReader:
    """Words of the joined texts of one language, window by window, as arrays."""

    #: Powers of ``BASE`` and ``UNBASE``: one table of each for the readers of all languages.
    powers = (np.zeros(0, np.uint64), np.zeros(0, np.uint64))

    def __init__(self, lang: str):
        self.seed = np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass")))

    def windows(self, texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(bytes, starts, ends, hashes, joined): ``joined`` tells of each word whether it follows on the one before
        it, in its window or in the one before, with no piece end between them."""
        data = b"\n".join(texts).lower()                     # a line feed ends a piece; bytes.lower(): A-Z only
        at, ended = 0, True
        while at < len(data):
            stop = _BREAK.search(data, min(at + WINDOW_BYTES, len(data)))
            stop = stop.start() if stop else len(data)
            window = data[at:stop]
            at = stop                                        # the break belongs to the next window: it may end a piece
            raw = np.frombuffer(window, np.uint8)
            kind = _KIND[raw]
            edge = np.diff(np.concatenate([[False], kind == 0, [False]]).astype(np.int8))
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            piece = np.cumsum(kind == 2, dtype=np.int64)
            if not len(starts):
                ended = ended or bool(piece[-1])
                continue
            joined = np.empty(len(starts), bool)
            joined[0] = not ended and piece[starts[0]] == 0
            np.equal(piece[starts[1:]], piece[starts[:-1]], out=joined[1:])
            ended = bool(piece[-1] > piece[starts[-1]])
            yield window, starts, ends, self._hash(raw, starts, ends), joined

    def _hash(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Polynomial hash of each word: a difference of prefix sums, moved to the front."""
        if len(raw) > len(WordReader.powers[0]):
            WordReader.powers = _powers(BASE, len(raw) + 1024), _powers(UNBASE, len(raw) + 1024)
        up, down = WordReader.powers
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.add(raw, np.uint64(1), out=sums[1:], dtype=np.uint64)
        sums[1:] *= up[:len(raw)]
        np.cumsum(sums, out=sums)
        own = (sums[ends] - sums[starts]) * down[starts]
        return mix64(own ^ mix64(self.seed + (ends - starts).astype(np.uint64)))


def join_hash(left: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all its words but the last and that of the last."""
    return mix64(left * np.uint64(BASE) + word)


class PhraseFilter:
    """A Bloom filter of phrase hashes; lets everything through if it has no bits."""

    def __init__(self, bits: int = 0, data: np.ndarray | None = None):
        self.bits, self.data = bits, data

    @staticmethod
    def positions(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
        low, step = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
        for k in range(HASHES):
            yield (low + np.uint64(k) * step) & np.uint64(bits - 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        held = np.ones(len(hashes), bool)
        if self.bits:
            for p in self.positions(hashes, self.bits):
                held &= (self.data[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return held


class WordIds(dict):
    """Ids of words in order of appearance, from 1."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = [b""]

    def __missing__(self, word: bytes) -> int:
        self.words.append(word)
        self[word] = len(self.words) - 1
        return len(self.words) - 1


class PhraseTrie:
    """Counts of one language's phrases: word id -> container of the rest, or, once burst, a node one word deeper."""

    def __init__(self, width: int):
        self.width, self.root, self.size = width, {}, 0

    def add(self, first: np.ndarray, rest: np.ndarray, counts: np.ndarray) -> None:
        """Add phrases sorted by first word: the other ids are packed into ``rest``, 21 bits each."""
        cuts = np.flatnonzero(np.diff(first)) + 1
        bounds = [0, *cuts.tolist(), len(first)]
        for lo, hi in zip(bounds, bounds[1:]):
            if hi > lo:
                self.size += self._put(self.root, int(first[lo]), rest[lo:hi].tolist(), counts[lo:hi].tolist(), self.width - 1)

    def _put(self, node: dict, word: int, rest: list[int], counts: list[int], depth: int) -> int:
        """Put the rests (``depth`` words each) under ``word`` of ``node``; the number of new phrases."""
        child = node.setdefault(word, ("hash", {}))
        kind, held = child
        if kind == "hash":
            before = len(held)
            for key, n in zip(rest, counts):
                held[key] = held.get(key, 0) + n
            if len(held) > BURST and depth > 1:
                node[word] = ("node", self._burst(held, depth))
            return len(held) - before
        shift = ID_BITS * (depth - 1)
        below: dict[int, tuple[list[int], list[int]]] = {}
        for key, n in zip(rest, counts):
            keys, numbers = below.setdefault(key >> shift, ([], []))
            keys.append(key & ((1 << shift) - 1))
            numbers.append(n)
        return sum(self._put(held, w, k, n, depth - 1) for w, (k, n) in below.items())

    @staticmethod
    def _burst(held: dict[int, int], depth: int) -> dict:
        shift, node = ID_BITS * (depth - 1), {}
        for key, n in held.items():
            node.setdefault(key >> shift, ("hash", {}))[1][key & ((1 << shift) - 1)] = n
        return node

    def _phrases(self, child: tuple, depth: int) -> Iterator[tuple[int, int]]:
        kind, held = child
        if kind == "hash":
            yield from held.items()
        else:
            shift = ID_BITS * (depth - 1)
            for word, below in held.items():
                for key, n in self._phrases(below, depth - 1):
                    yield word << shift | key, n

    def _weight(self, child: tuple) -> int:
        return len(child[1]) if child[0] == "hash" else sum(map(self._weight, child[1].values()))

    def spill(self, words: list[bytes], share: float = 1.0) -> Iterator[tuple[bytes, list[bytes], list[int]]]:
        """Take out the largest subtrees that hold ``share`` of all phrases: (prefix, sorted phrases, counts) each."""
        sizes = {w: self._weight(c) for w, c in self.root.items()}
        most, taken = self.size * share, 0
        mask = (1 << ID_BITS) - 1
        for word in nlargest(len(sizes), sizes, key=sizes.get):
            if taken >= most:
                break
            taken += sizes[word]
            rows = []
            for key, n in self._phrases(self.root.pop(word), self.width - 1):
                ids = [key >> ID_BITS * k & mask for k in range(self.width - 2, -1, -1)]
                rows.append((b" ".join([words[word], *(words[i] for i in ids)]), n))
            rows.sort()
            yield words[word], [p for p, _ in rows], [n for _, n in rows]
        self.size -= taken


class Counter:
    """Counts the phrases of one language's texts that are handed to it, in bounded memory: a trie for each length.

    Single words are a trie's first level alone: an array by word id. ``words`` and ``pairs`` are the filters.
    """

    def __init__(self, lang: str, longest: int, words: PhraseFilter, pairs: PhraseFilter):
        self.lang, self.longest, self.known_words, self.known_pairs = lang, longest, words, pairs
        self.reader, self.all_words = WordReader(lang), 0
        self._fresh()

    def _fresh(self) -> None:
        self.ids, self.single = WordIds(), np.zeros(1024, np.int64)
        self.tries = [PhraseTrie(width) for width in range(2, self.longest + 1)]

    @property
    def size(self) -> int:
        return sum(trie.size for trie in self.tries)

    def _subtrees(self, share: float) -> Iterator[tuple[list[bytes], list[bytes], list[int]]]:
        if share >= 1:
            rows = sorted((w, n) for w, n in zip(self.ids.words, self.single.tolist()) if n)
            words = [w for w, _ in rows]
            yield words, words, [n for _, n in rows]
            if self.all_words:
                yield [b""], [b""], [self.all_words]
        for trie in self.tries:
            for prefix, phrases, counts in trie.spill(self.ids.words, share):
                yield [prefix] * len(phrases), phrases, counts

    def spill(self, share: float = 1.0) -> Iterator[pa.RecordBatch]:
        """Sorted runs of whole subtrees; with all of them, words start afresh too."""
        rows: tuple[list, list, list] = ([], [], [])
        for subtree in self._subtrees(share):
            for column, values in zip(rows, subtree):
                column += values
            if len(rows[2]) >= RUN_ROWS:
                yield run_rows(self.lang, *rows)
                rows = ([], [], [])
        if rows[2]:
            yield run_rows(self.lang, *rows)
        if share >= 1:
            self.all_words = 0
            self._fresh()

    def read(self, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
        keep = self.longest - 1
        tail = (np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool))
        for window, starts, ends, hashes, joined in self.reader.windows(texts):
            self.all_words += len(starts)
            held = np.flatnonzero(self.known_words(hashes))
            own = map(window.__getitem__, map(slice, starts[held].tolist(), ends[held].tolist()))
            ids = np.zeros(len(starts), np.int64)            # 0: a word that is in no frequent phrase
            ids[held] = np.fromiter(map(self.ids.__getitem__, own), np.int64, len(held))
            counts = np.bincount(ids, minlength=len(self.single))
            counts[:len(self.single)] += self.single
            counts[0] = 0
            self.single = counts
            hashes, ids, joined = (np.concatenate([t, x]) for t, x in zip(tail, (hashes, ids, joined)))
            self._count(hashes, ids, joined, len(tail[0]))
            tail = tuple(x[max(0, len(x) - keep):] for x in (hashes, ids, joined))
            if len(self.ids.words) > MOST_WORDS:
                kept = [self.ids.words[i] for i in tail[1]]
                yield from self.spill()
                tail = (tail[0], np.array([self.ids[w] if w else 0 for w in kept], np.int64), tail[2])
            elif self.size > MOST:
                yield from self.spill(0.5)

    def _count(self, hashes: np.ndarray, ids: np.ndarray, joined: np.ndarray, old: int) -> None:
        """Count the phrases that end behind the first ``old`` words, which have been counted."""
        if len(ids) < 2:
            return
        pair = joined[1:] & (ids[:-1] > 0) & (ids[1:] > 0)
        at = np.flatnonzero(pair)
        pair[at] = self.known_pairs(join_hash(hashes[at], hashes[at + 1]))
        whole = np.ones(len(ids), bool)                      # of the phrase that starts at each word
        for trie in self.tries:
            k = trie.width
            n = len(ids) - k + 1
            if n <= 0:
                return
            whole = whole[:n] & pair[k - 2:]
            start = np.flatnonzero(whole)
            start = start[start + k > old]
            first, rest = ids[start], np.zeros(len(start), np.int64)
            for j in range(1, k):
                rest = rest << ID_BITS | ids[start + j]
            order = np.lexsort((rest, first))
            first, rest = first[order], rest[order]
            new = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (rest[1:] != rest[:-1])])[:len(first)])
            trie.add(first[new], rest[new], np.diff(np.append(new, len(first))))


def run_rows(lang: str, prefixes: list, phrases: list, counts: list) -> pa.RecordBatch:
    text = [pa.array(x, pa.binary()).cast(pa.string()) for x in (prefixes, phrases)]
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), *text, pa.array(counts, pa.int64())],
                                      names=["lang", "prefix", "phrase", "n"])


def _texts_by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """The texts of each language of a batch of (lang, text), in lists of bounded size together."""
    langs, column = batch.column(0), pc.fill_null(batch.column(1).cast(pa.large_binary()), b"")
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
    for lang in langs.unique().to_pylist():
        own = pc.indices_nonzero(pc.equal(langs, lang)).to_numpy()
        for first, last in slices(np.concatenate([[0], np.cumsum(sizes[own], dtype=np.int64)]), JOINED_BYTES):
            yield lang, column.take(pa.array(own[first:last])).to_pylist()


def frequent_hashes(texts: DataFrame, min_count: int, words: PhraseFilter | None = None) -> DataFrame:
    """(``h``): hashes that at least ``min_count`` words have, or, given the filter of ``words``, pairs of such words."""
    held = texts.sparkSession.sparkContext.broadcast((words.bits, words.data) if words else None)

    def sums(parts: list) -> tuple[np.ndarray, np.ndarray]:
        hashes, counts = (np.concatenate(x) for x in zip(*parts))
        parts.clear()                                        # else all of it is held twice while it is sorted
        order = np.argsort(hashes, kind="stable")
        hashes, counts = hashes[order], counts[order]
        new = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])[:len(hashes)])
        return hashes[new], np.add.reduceat(counts, new) if len(new) else counts

    def rows(hashes: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(hashes), 1 << 18):
            yield pa.RecordBatch.from_arrays([pa.array(hashes[k:k + (1 << 18)].view(np.int64)),
                                              pa.array(counts[k:k + (1 << 18)])], names=["h", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = PhraseFilter(*held.value) if held.value else None
        readers: dict[str, WordReader] = {}
        parts, pending = [], 0
        for batch in batches:
            for lang, some in _texts_by_lang(batch):
                reader = readers.get(lang) or WordReader(lang)
                if len(readers) < MOST_LANGS:
                    readers[lang] = reader
                last, last_known = np.zeros(0, np.uint64), np.zeros(0, bool)
                for _, _, _, hashes, joined in reader.windows(some):
                    if known:
                        both, inside = np.concatenate([last, hashes]), np.concatenate([last_known, known(hashes)])
                        joined = joined[1 - len(last):]
                        last, last_known = both[-1:], inside[-1:]
                        at = np.flatnonzero(inside[:-1] & inside[1:] & joined)
                        hashes = join_hash(both[at], both[at + 1])
                    hashes, counts = np.unique(hashes, return_counts=True)
                    parts.append((hashes, counts))
                    pending += len(hashes)
                    if pending > 2 * MOST_HASHES:
                        parts = [sums(parts)]
                        pending = len(parts[0][0])
                        if pending > MOST_HASHES:
                            yield from rows(*parts[0])
                            parts, pending = [], 0
        if parts:
            yield from rows(*sums(parts))

    counted = texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= min_count).select("h")


def phrase_filter(hashes: DataFrame, n: int) -> PhraseFilter:
    """Filter of the ``n`` hashes of ``hashes``."""
    bits = 1 << 10
    while bits < min(n * KEY_BITS, MAX_BITS):
        bits <<= 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate(list(PhraseFilter.positions(own, bits)))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).view(np.int64)), pa.array(
                (np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["w", "b"])

    marks = hashes.mapInArrow(run, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b"))
    data = np.zeros(bits // 64, np.int64)
    for row in marks.toLocalIterator():                      # at most bits / 64 rows
        data[row["w"]] = row["b"]
    return PhraseFilter(bits, data.view(np.uint8))


def count_phrases(texts: DataFrame, longest: int, words: PhraseFilter, pairs: PhraseFilter) -> DataFrame:
    """(``lang``, ``phrase``, ``n``): phrases of up to ``longest`` words that the filters let through, counted exactly.

    ``texts`` has the columns lang and text. The phrase '' holds a language's number of words.
    """
    held = texts.sparkSession.sparkContext.broadcast([(f.bits, f.data) for f in (words, pairs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters: dict[str, Counter] = {}
        filters = [PhraseFilter(*f) for f in held.value]
        for batch in batches:
            for lang, some in _texts_by_lang(batch):
                if lang not in counters:
                    counters[lang] = Counter(lang, longest, *filters)
                yield from counters[lang].read(some)
                if sum(c.size for c in counters.values()) > MOST:
                    yield from max(counters.values(), key=lambda c: c.size).spill()
                if len(counters) > MOST_LANGS or sum(len(c.ids.words) for c in counters.values()) > MOST_WORDS:
                    for counter in counters.values():
                        yield from counter.spill()
                    counters.clear()
        for counter in counters.values():
            yield from counter.spill()

    runs = texts.mapInArrow(run, RUN)
    part = F.pmod(F.xxhash64("phrase"), F.lit(PARTS)).alias("part")
    dealt = runs.select("lang", "prefix", part, "phrase", "n").repartition("lang", "prefix", "part")
    merged = dealt.groupBy("lang", "prefix", "part", "phrase").agg(F.sum("n").alias("n"))
    return merged.select("lang", "phrase", "n")


def frequent_phrases(texts: DataFrame, min_count: int, longest: int = LONGEST) -> DataFrame:
    """A written table (lang, phrase, n) of all phrases found at least ``min_count`` times; '' counts all words."""
    filters = []
    for _ in range(2):
        hashes = cut(frequent_hashes(texts, min_count, *filters), "hashes")
        filters.append(phrase_filter(hashes, hashes.count()))
    counted = count_phrases(texts, longest, *filters)
    return cut(counted.filter((F.col("n") >= min_count) | (F.col("phrase") == "")), "phrases")


def score_of(a: str, left: str, right: str) -> Column:
    """floor(2000000 a / (left + right)) in decimals, as the product may pass 64 bits; it is 1,000,000 at the most."""
    return F.expr(f"cast((cast({a} as decimal(20, 0)) * 2000000bd) div (cast({left} as decimal(20, 0)) + {right}) as long)")


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = 30, top: int = 2000,
                 longest: int = LONGEST) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts in lower case (A-Z only) are split into pieces at ``. , ; : ! ?`` and line ends, pieces into words at blanks and
    tabs. A candidate is a phrase of 2 to ``longest`` words found a >= ``min_count`` times within pieces, overlaps
    included; cut after its first words it gives l and r, the counts of both parts, and floor(2000000 a / (l + r));
    the lowest score of its cuts counts, ties to the shortest first part. Candidates that stand in a longer
    candidate found at least 0.8 times as often are left out. Order: score, a (both descending), phrase (bytes).

    A null text is empty; a null language is ``und``. Repeated rows count each. Texts without words and empty
    tables give no rows. Columns of ``df`` other than the two are ignored.
    """
    texts = df.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
                      F.col(f"`{text_col}`").cast("string").alias("text"))
    counts = frequent_phrases(texts, min_count, longest)
    longer = counts.filter(F.contains("phrase", F.lit(" ")))
    words = F.split("phrase", " ")
    size = F.size("words")

    def part(start, length):
        return F.array_join(F.slice("words", start, length), " ")

    phrases = longer.withColumn("words", words)
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), "words",
                          F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                       part(F.col("k") + 1, size - F.col("k")).alias("right"),
                       F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int").alias("salt"))
    table = counts.select(F.col("lang").alias("c_lang"), F.col("phrase").alias("c_phrase"), F.col("n").alias("c_n"),
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("c_salt"))

    def with_count(rows, side, name):
        on = (F.col("lang") == F.col("c_lang")) & (F.col(side) == F.col("c_phrase")) & (F.col("salt") == F.col("c_salt"))
        return rows.join(table, on).withColumn(name, F.col("c_n")).drop("c_lang", "c_phrase", "c_n", "c_salt", side)

    counted = with_count(with_count(cuts, "left", "l"), "right", "r")
    best = counted.withColumn("score", score_of("a", "l", "r")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "a", "l", "r")).alias("best")).select("lang", "phrase", "best.*")
    inner = phrases.filter(size > 2).select(
        "lang", F.col("n").alias("f"), "words", F.explode(F.sequence(F.lit(2), size - 1)).alias("m"))
    inner = inner.select("lang", "f", "words", "m", F.explode(F.sequence(F.lit(1), size - F.col("m") + 1)).alias("at"))
    inner = inner.select("lang", "f", part(F.col("at"), F.col("m")).alias("phrase"))
    around = inner.groupBy("lang", "phrase").agg(F.max("f").alias("f"))
    kept = best.join(around, ["lang", "phrase"], "left").filter("f is null or 5bd * f < 4bd * a").drop("f", "k")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    spread = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", spread).orderBy(*order))).filter(
        F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    n = counts.filter("phrase = ''").select("lang", "n")
    return ranked.filter(F.col("rank") <= top).join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
