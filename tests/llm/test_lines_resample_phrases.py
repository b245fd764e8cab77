"""Line dedup, importance resampling and phrase mining against brute force, on small and on awkward tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapline.llm import linededup, phrases, resample
from tapline.ordinals import in_order

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHING = ["h", "docs", "r", "keys", "gone", "gone_a", "lines", "kept", "n_lines", "rank", "score", "weight", "n_words",
            "phrase", "prefix", "part", "n", "ordinal", "__rank_place", "rank_p"]
ROWS = ([(1, None), (2, ""), (None, "Same line\nother"), (3, "same LINE  \n\nthird"), (3, "same LINE  \n\nthird"),
         (4, "\n\n"), (5, "word " * 40_000), (6, "\t Same line\x0b\r\nÉtude über 日本語 🙂 \x00 nul\n"), (None, None),
         (7, "x" * 300_000), (8, "a-b a-b, c. d! e? f; g: h\ni\rj\x0ck l"), (9, "12 34\t56  78"), (10, "SAME LINE")]
        + [(100 + k, f"copy of all\nSame line\nown {k} line") for k in range(12)])


def awkward(spark, rows=ROWS):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    langs = F.when(F.col("doc_id") % 3 == 0, F.lit(None)).otherwise(F.lit("en"))
    return frame.withColumns({c: F.lit("clash") for c in CLASHING}).withColumn("lang", langs.cast("string"))


# ------------------------------------------------------------------------------------------ line dedup

def plain_lines(rows, least, chars):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    split = [(text or "").split("\n") for _, text in rows]
    found = Counter(k for lines in split for k in {key(x) for x in lines})
    gone = {k for k, n in found.items() if n >= least and len(k) >= chars}
    return sorted((i is None, i, len(lines), sum(key(x) in gone for x in lines), "\n".join(x for x in lines if key(x) not in gone))
                  for (i, _), lines in zip(rows, split))


@pytest.mark.parametrize("least,chars,batches", [(2, 1, 3), (10, 1, 6), (3, 10, 1)])
def test_lines_match_brute_force(spark, least, chars, batches):
    out = linededup.drop_repeated_lines(awkward(spark), min_docs=least, min_chars=chars, batches=batches)
    got = [(r["doc_id"] is None, r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted(plain_lines(ROWS, least, chars), key=str)
    assert {"h", "docs", "keys", "gone", "lines", "lang"} <= set(out.columns)


def test_lines_of_empty_tables(spark):
    assert linededup.drop_repeated_lines(awkward(spark).limit(0)).count() == 0
    only = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [(r["kept"], r["n_lines"], r["n_dropped"]) for r in linededup.drop_repeated_lines(only, min_docs=1).collect()] == [("", 1, 0)] * 2


def test_runs_are_compacted_and_settled_keys_stay_out(spark):
    """Ten batches with one key of every batch: levels stay short, and the key is not added again once settled."""
    index = linededup.LineRuns(spark, min_docs=3, fanout=3)
    for k in range(10):
        index.add(spark.sql(f"SELECT unhex(md5(x)) AS h, 1L AS docs FROM VALUES ('all'), ('own {k}') AS t(x)"))
        assert all(len(level) < 3 for level in index.levels)
    assert [r["h"] for r in index.settled().collect()] == [hashlib.md5(b"all").digest()]
    assert sum(run.filter("h = unhex(md5('all'))").agg(F.coalesce(F.sum("docs"), F.lit(0)).alias("n")).first()["n"]
               for run in index.runs()) == 3
    again = linededup.LineRuns(spark, 3, path=index.path, levels=index.levels)     # an index that was kept
    assert again.settled().count() == 1
    assert len(index.levels) >= 2


def test_batches_do_not_change_what_goes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    one, many = (linededup.drop_repeated_lines(docs, min_docs=4, batches=b).select("doc_id", "kept") for b in (1, 7))
    assert one.exceptAll(many).count() == 0


def test_line_dedup_plan_is_native(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    plan = linededup.drop_repeated_lines(docs)._jdf.queryExecution().toString()
    assert not re.search(r"Python|MapInArrow|MapInPandas|ExistingRDD", plan)


# ------------------------------------------------------------------------------------------ resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def plain_resample(rows, target, percent, least, seed, buckets):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(bucket(f) for _, t in rows for f in plain_features(t)[1])
    t = Counter(bucket(f) for x in target for f in plain_features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        words, features = plain_features(text)
        weight = sum(gain[bucket(f)] for f in features) // len(features) if features else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for place, row in enumerate(fit[:percent * len(fit) // 100], start=1):
        row[5] = place
    return out


@pytest.mark.parametrize("percent,least", [(25, 20), (60, 1), (100, 0), (0, 0)])
def test_resample_matches_brute_force(spark, percent, least):
    target = ["one two three", None, "same line same line étude", ""]
    out = resample.resample(awkward(spark), spark.createDataFrame([(x,) for x in target], "text string"), percent=percent,
                            min_words=least, seed=7, buckets=97)
    assert "text" not in out.columns and {"h", "docs", "prefix", "lang"} <= set(out.columns)
    got = [[r[c] for c in ("doc_id", "n_words", "n_features", "weight", "score", "rank")] for r in out.collect()]
    assert sorted(got, key=str) == sorted(plain_resample(ROWS, target, percent, least, 7, 97), key=str)


def test_resample_windows_cut_no_word_and_no_pair(spark, monkeypatch):
    texts = ["a bb ccc " * 50, "", "dddddddddddddddddddd e", "f"]
    whole = list(resample.word_features([t.encode() for t in texts]))
    monkeypatch.setattr(resample, "WINDOW_BYTES", 7)
    parts = list(resample.word_features([t.encode() for t in texts]))
    assert len(parts) > 20
    for k in range(3):
        assert np.concatenate([p[k] for p in parts]).tolist() == np.concatenate([p[k] for p in whole]).tolist()


def test_resample_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample.resample(none, none).count() == 0
    some = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert resample.resample(some, none, min_words=1, percent=100).filter("rank = 1 and doc_id = 1").count() == 1


def test_ordinals_count_through_partitions(spark):
    df = spark.range(0, 10_000, 1, 16).withColumn("v", (F.col("id") * 7919) % 1000)
    numbered, n = in_order(df, [F.col("v").desc(), F.col("id")])
    rows = numbered.collect()
    assert n == len(rows) == 10_000
    assert [r["id"] for r in sorted(rows, key=lambda r: r["ordinal"])] == sorted(range(10_000), key=lambda i: (-(i * 7919 % 1000), i))
    assert in_order(df.limit(0), ["id"])[1] == 0


# ------------------------------------------------------------------------------------------ phrases

def plain_phrases(rows, least, top):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = Counter()
        for p, a in found.items():
            for i in range(len(p)):
                for j in range(i + 2, len(p) + 1):
                    if j - i < len(p):
                        around[p[i:j]] = max(around[p[i:j]], a)
        kept = []
        for p, a in found.items():
            if 100 * around[p] >= 80 * a:
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, place, p.decode(), -a, left, right, total[lang], -score)
                for place, (score, a, p, left, right) in enumerate(sorted(kept)[:top], start=1)]
    return sorted(out)


def phrase_rows(seed=5, n=250):
    rng, words = random.Random(seed), ["of", "the", "Of", "day", "n'est", "été", "new", "York", "state", "日本", "🙂", "x.y", "a\x00b"]
    texts = ["".join(rng.choice(words[:rng.randrange(3, 13)]) + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r", " new york state ", "!?"])
                     for _ in range(rng.randrange(0, 60))) for _ in range(n)]
    return [(rng.choice(["en", "en", "fr", None]), rng.choice([t, t, t, None])) for t in texts] + [("en", "word of the day " * 20_000)]


@pytest.mark.parametrize("least,top", [(5, 2000), (30, 12)])
def test_phrases_match_brute_force(spark, least, top):
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "lang string, text string").withColumns({c: F.lit("clash") for c in CLASHING})
    got = sorted(tuple(r) for r in phrases.collocations(df.repartition(5), min_count=least, top=top).collect())
    assert got == plain_phrases(rows, least, top)


def counted(texts, filters=None, **limits):
    """All phrases that one task's counter hands on, summed."""
    counter = phrases.Counter("en", 4, *(filters or [phrases.PhraseFilter()] * 2))
    sums, runs = Counter(), 0
    for batch in [*counter.read([t.encode() for t in texts]), *counter.spill()]:
        runs += 1
        for phrase, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            sums[phrase] += n
    return sums, runs


@pytest.mark.parametrize("limits", [{"WINDOW_BYTES": 11}, {"BURST": 3}, {"MOST": 40}, {"MOST_WORDS": 4}, {"RUN_ROWS": 5},
                                    {"WINDOW_BYTES": 64, "BURST": 2, "MOST": 25, "MOST_WORDS": 6}])
def test_windows_bursts_and_spills_lose_no_count(monkeypatch, limits):
    texts = [t for _, t in phrase_rows(n=60)[:-1] if t]
    whole, _ = counted(texts)
    for name, value in limits.items():
        monkeypatch.setattr(phrases, name, value)
    parts, _ = counted(texts)
    assert parts == whole and whole["new york state"] > 5


def test_languages_share_what_a_reader_needs(monkeypatch):
    """A worker that reads many languages side by side needs little more than for one; a batch's texts are not copied whole."""
    import tracemalloc

    import pyarrow as pa

    text = b"some words of a text " * 5000
    tracemalloc.start()
    try:
        readers = [phrases.WordReader(f"l{k}") for k in range(30)]
        found = [[h.tolist()[:5] for _, _, _, h, _ in r.windows([text])] for r in readers]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len({str(f) for f in found}) == 30 and peak < 100 * len(text), peak
    monkeypatch.setattr(phrases, "JOINED_BYTES", 4)
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b", "a", "b", "a"]), pa.array(["xx", None, "y", "zzzzzz", "ww"])], names=["lang", "text"])
    assert list(phrases._texts_by_lang(batch)) == [("a", [b"xx", b"y"]), ("a", [b"ww"]), ("b", [b""]), ("b", [b"zzzzzz"])]


def test_spilled_subtrees_are_whole_and_sorted(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 2)
    trie, ids = phrases.PhraseTrie(3), phrases.WordIds()
    rows = sorted((ids[a], ids[b] << 21 | ids[c]) for a in (b"a", b"b") for b in (b"c", b"d", b"e") for c in (b"f", b"g"))
    first, rest = (np.array(x) for x in zip(*rows))
    trie.add(first, rest, np.ones(len(rows), np.int64))
    assert trie.root[1][0] == "node" and trie.size == 12
    taken = list(trie.spill(ids.words, 0.5))
    assert len(taken) == 1 and taken[0][1] == sorted(taken[0][1]) and len(taken[0][1]) == 6 and trie.size == 6


def test_full_filters_cost_no_result(spark, monkeypatch):
    monkeypatch.setattr(phrases, "MAX_BITS", 64)
    monkeypatch.setattr(phrases, "MOST_HASHES", 50)
    rows = phrase_rows(seed=9)
    df = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in phrases.collocations(df, min_count=20, top=50).collect())
    assert got == plain_phrases(rows, 20, 50)


def test_phrases_of_empty_tables(spark):
    none = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(none).count() == 0
    blank = spark.createDataFrame([(None, None), ("en", ""), ("en", " \t\n.")], "lang string, text string")
    assert phrases.collocations(blank, min_count=1).count() == 0


def test_exact_scores_beyond_64_bits(spark):
    """The score's product, not its quotient, passes 64 bits."""
    a = 9 * 10**15
    row = spark.sql(f"SELECT {a}L AS a, {a}L AS l, {a + 1}L AS r").select(phrases.score_of("a", "l", "r").alias("s")).first()
    assert row["s"] == 2000000 * a // (2 * a + 1)
