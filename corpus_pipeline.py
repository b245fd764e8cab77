"""A training-data pipeline over ``documents``: STAGES, run() and ORACLE_SQL.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet below the shared
checkpoint folder and reads it back as the next stage's ``docs``. All stages but the last keep the columns of
``documents``. Extra columns pass through; nulls, empty texts, ties, repeated rows and an empty table have the
results that the operators' docstrings give.
"""

from __future__ import annotations

import public_tokenizers

from tapline.llm import decontam, pieces, quality, simhash, suffixdedup
from tapline.llm.common import cut, table


def quality_filter(spark, docs, sf_dir):
    """Documents with a quality score of 0.3 or more stay. Learned from the labels of ``docs`` that are not held
    out; without any label every document stays."""
    return quality.learn_and_accept(docs, table(spark, sf_dir, "labels"), threshold=0.3)


def near_dedup(spark, docs, sf_dir):
    """One document of each SimHash group stays (three-word shingles, two bits): the one with the smallest id."""
    return simhash.keep_one(docs, "doc_id", "text", width=3)


def suffix_dedup(spark, docs, sf_dir):
    """Bytes of strings of 200 that start twice or more are cut out of the texts; ``n_chars`` follows. A document of
    which nothing is left goes."""
    return suffixdedup.without_repeats(docs, "text", "n_chars")


def decontaminate(spark, docs, sf_dir):
    """Documents that hold a benchmark item (similarity 0.8 or more over shingles of five words) go."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark, docs, sf_dir):
    """``doc_id``, token counts, digests and ids of each document that is left."""
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality_classifier", quality_filter),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", tokenize),
]


def run(spark, sf_dir):
    """The stages, one after the other, over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs


#: A trained classifier and SimHash have no SQL; the stages are tested against brute-force versions instead.
ORACLE_SQL = None
