"""SentencePiece encoding and decoding of merge-type models with a table of last tokens.

The merges of a greedy merge-type tokenizer never depend on what follows a token boundary, so every prefix of
a text has one last token, and the ids of a text can be read backwards from a table of them:

- An automaton over all pieces gives the pieces that end at each place, longest first.
- Of those, the last token of the prefix is the one that the last token before it allows: two tokens may stand
  next to each other if the merges of their joined characters give just these two. Such answers are kept.
- The ids are recovered from the end of the table.

A space is written as the mark U+2581 and a mark is put before a text. No piece holds a mark after another
character, none holds a character outside the vocabulary, and some characters follow a letter in no piece; so
the table is built between those places, and recurring stretches are looked up in a bounded memory. Characters outside the vocabulary
become the ids of their UTF-8 bytes, or the unknown id in a model without byte pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_or_empty

MARK = "▁"
LETTERS = "".join(c for c in map(chr, range(65, 592)) if c.isalpha())
#: Stretches and pairs that a worker remembers; beyond it a memory starts afresh.
REMEMBERED = 1_000_000
#: Longer stretches are not remembered.
REMEMBERED_CHARS = 48


def read_vocabulary(model: bytes) -> dict:
    """Pieces with ids and scores, byte ids and the unknown id of a model, as plain values.

    ValueError for a model that this method does not fit: one whose normaliser changes characters, or with a
    piece that holds a mark after another character.
    """
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    probe = "  Aéé ﬁ　\t\nz  "
    if sp.normalize(probe).lstrip(MARK) != probe.replace(" ", MARK).lstrip(MARK) or sp.encode(" ") == []:
        raise ValueError("only models that keep all characters and spaces are supported")
    merged, byte_ids, single = {}, {}, []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (sp.is_control(i) or sp.is_unknown(i)):
            merged[piece] = (i, sp.get_score(i))
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"piece {piece!r} holds a mark inside")
    return {"pieces": merged, "bytes": [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else [],
            "unknown": sp.unk_id(), "model": model}


def merge_pieces(chars: list[str], scores: dict) -> list[str]:
    """The merges themselves: best score first, leftmost of equals. Used on two tokens at a time."""
    parts = list(chars)
    while len(parts) > 1:
        best, at = None, -1
        for k in range(len(parts) - 1):
            found = scores.get(parts[k] + parts[k + 1])
            if found is not None and (best is None or found[1] > best):
                best, at = found[1], k
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Encoder:
    """Encodes and decodes with a vocabulary of :func:`read_vocabulary`."""

    def __init__(self, vocabulary: dict):
        self.scores = vocabulary["pieces"]
        self.byte_ids, self.unknown = vocabulary["bytes"], vocabulary["unknown"]
        self.library = sentencepiece.SentencePieceProcessor(model_proto=vocabulary["model"])
        self.automaton = ahocorasick.Automaton()
        for piece in self.scores:
            self.automaton.add_word(piece, piece)
        self.automaton.make_automaton()
        self.singles = {p for p in self.scores if len(p) == 1}
        feed = "" if "\n" in self.singles else "\n"
        # where a letter is followed by a character that follows a letter in no piece, no token crosses
        after = {b for p in self.scores for a, b in zip(p, p[1:]) if a in LETTERS}
        stops = re.escape("".join(c for c in map(chr, range(33, 127)) if c not in after and c not in LETTERS))
        word = f" *[^ {feed}{LETTERS}]*[{LETTERS}]++(?![^ {feed}{stops}])|" if stops else ""
        self.split = re.compile(f"{word} *[^ {feed}]+| +|\n").findall
        self.decimal = [str(i) for i in range(self.library.get_piece_size())]
        self.pairs: dict[tuple[str, str], bool] = {}
        self.stretches: dict[str, tuple[int, ...]] = {}

    def _may_follow(self, left: str, right: str) -> bool:
        if len(self.pairs) >= REMEMBERED:
            self.pairs.clear()
        answer = self.pairs[left, right] = merge_pieces(list(left + right), self.scores) == [left, right]
        return answer

    def _known_ids(self, text: str) -> list[int]:
        """Ids of a stretch whose characters are all in the vocabulary, from its table of last tokens."""
        last: list[str] = [""] * (len(text) + 1)
        filled = 0  # places are filled in order; matches come by place, longest first
        pairs, scores = self.pairs, self.scores
        for end, piece in self.automaton.iter(text):
            if end < filled:
                continue
            left = last[end + 1 - len(piece)]
            if left:
                allowed = pairs.get((left, piece))
                if allowed is None:
                    allowed = self._may_follow(left, piece)
                if not allowed:
                    continue
            filled = end + 1
            last[filled] = piece
        ids, at = [], len(text)
        while at:
            piece = last[at]
            ids.append(scores[piece][0])
            at -= len(piece)
        ids.reverse()
        return ids

    def _stretch_ids(self, stretch: str) -> tuple[int, ...]:
        stretch = stretch.replace(" ", MARK)
        if self.singles.issuperset(stretch):
            return tuple(self._known_ids(stretch))
        ids: list[int] = []
        known = 0
        for k, c in enumerate(stretch):
            if c not in self.singles:
                if known < k:
                    ids += self._known_ids(stretch[known:k])
                known = k + 1
                ids += [self.byte_ids[b] for b in c.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]
        if known < len(stretch):
            ids += self._known_ids(stretch[known:])
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if len(self.stretches) >= REMEMBERED:
            self.stretches.clear()
        if MARK in text:  # the same to the model
            text = text.replace(MARK, " ")
        stretches = self.split(" " + text)
        found = list(map(self.stretches.get, stretches))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = ids = self._stretch_ids(stretches[k])
                    if len(stretches[k]) <= REMEMBERED_CHARS:
                        self.stretches[stretches[k]] = ids
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


def encode_documents(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """``id_col``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids`` per row of ``df``.

    Whole texts, no begin or end ids. Null text counts as empty and gives no id. Rows are independent of each
    other: repeated rows, null ids and an empty table need no care; other columns are ignored. A narrow
    map: no shuffle. The vocabulary is broadcast (the model file's size); its tables are built once a worker.
    """
    spark = df.sparkSession
    with open(model_path, "rb") as f:
        shared = spark.sparkContext.broadcast({"vocabulary": read_vocabulary(f.read())})
    fields = [T.StructField("id", df.schema[id_col].dataType), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = shared.value
        if "encoder" not in state:  # the broadcast's value lives as long as the worker
            state["encoder"] = Encoder(state["vocabulary"])
        encoder, digest = state["encoder"], hashlib.sha256
        decimal = encoder.decimal.__getitem__
        for batch in batches:
            texts, first = batch.column(1), 0
            while first < len(texts):  # ids of a few megabytes of text at a time
                last, size = first, 0
                while last < len(texts) and (last == first or size < 1 << 22):
                    size += len(texts[last].as_buffer() or b"") if texts[last].is_valid else 0
                    last += 1
                counts, id_hashes, text_hashes, lists = [], [], [], []
                for text in texts.slice(first, last - first).to_pylist():
                    ids = encoder.encode(text or "")
                    counts.append(len(ids))
                    id_hashes.append(digest(",".join(map(decimal, ids)).encode()).hexdigest())
                    text_hashes.append(digest(encoder.decode(ids).encode("utf-8", "surrogatepass")).hexdigest() if ids
                                       else digest(b"").hexdigest())
                    if with_ids:
                        lists.append(np.array(ids, np.int32))
                arrays = [batch.column(0).slice(first, last - first), pa.array(counts, pa.int64()),
                          pa.array(id_hashes, pa.string()), pa.array(text_hashes, pa.string())]
                if with_ids:
                    arrays.append(pa.array(lists, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in fields])
                first = last

    texts = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return texts.mapInArrow(run, T.StructType(fields)).withColumnRenamed("id", id_col)
