"""Document operators against brute force, on the smallest table and on awkward rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from tapline.llm import decontam, langid, pieces, quality, queries, simhash, suffixdedup

SF = "/root/testdata/sf0.001"
CLASHING = ["k1", "fp", "_simhash", "id", "row", "wanted", "root", "_stats", "_score", "lists", "_label", "c0"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}


def awkward(spark, rows=None):
    """Nulls, empty and very long texts, repeated rows, and extra columns with names that operators use inside."""
    passage = "Once more the river turned and the old mill stood silent in the grey light of the valley below. "
    rows = [(1, None), (2, ""), (None, "short text of a few words"), (3, "short text of a few words"), (3, "short text of a few words"),
            (4, passage * 3), (5, "Prelude. " + passage * 3), (6, "word " * 60_000), (7, "\n\t  "), (8, "ÉÈ ünïcode – “quotes” 日本語 🙂\x00"),
            (None, None), (9, "x" * 5000), (10, "1234 5678 !!!")] if rows is None else rows
    extra = {c: "clash" for c in CLASHING}
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    from pyspark.sql import functions as F

    return frame.withColumns({"lang": F.lit("en"), "source": F.lit(None).cast("string"), "n_chars": F.length("text").cast("long"),
                              **{c: F.lit(v) for c, v in extra.items()}})


# ------------------------------------------------------------------------------------------ SimHash

def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_simhash_matches_brute_force(spark, texts):
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    ids = sorted(prints)
    linked = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2]
    roots = plain_roots(ids, linked)
    got = {r["doc_id"]: r for r in queries.op10_simhash(spark, SF).collect()}
    assert {i: got[i]["fingerprint"] for i in ids} == {i: f"{prints[i]:016x}" for i in ids}
    assert {i: got[i]["component_id"] for i in ids} == roots


@pytest.mark.parametrize("full_cell", [32, 1])
def test_links_connect_all_pairs_within_two_bits(spark, full_cell, monkeypatch):
    monkeypatch.setattr(simhash, "FULL_CELL", full_cell)
    rng = np.random.default_rng(3)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 40)}
    base = int(rng.integers(0, 1 << 63))
    for _ in range(150):
        x = base
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            x ^= 1 << int(b)
        prints.add(x - (1 << 64) if x >= 1 << 63 else x)
    prints = sorted(prints)
    linked = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2]
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    got = {r["node"]: r["root"] for r in simhash.components(simhash._links(frame)).collect()}
    assert {p: got.get(p, p) for p in prints} == plain_roots(prints, linked)


def test_the_plan_of_the_links_stays_small(spark):
    """The driver holds each plan and its copies; the lattice point is in it once, the candidates are not in it twice."""
    frame = spark.createDataFrame([(1, 1), (2, 2)], "fp long, low long")
    plan = simhash._links(frame)._jdf.queryExecution().analyzed().toJSON()
    assert plan.count("BitwiseCount") <= 2 * simhash.SEGMENTS, plan.count("BitwiseCount")


def test_simhash_of_a_text_cut_into_pieces(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(3000))
    whole = simhash.fingerprint_text(text.encode())
    monkeypatch.setattr(simhash, "PIECE_BYTES", 50)
    assert simhash.fingerprint_text(text.encode()) == whole == plain_fingerprint(text)


def test_simhash_of_awkward_rows(spark):
    got = simhash.near_duplicates(awkward(spark)).collect()
    assert len(got) == 13
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert {r["doc_id"] for r in zero} == {1, 2, 7, None} and {r["component_id"] for r in zero} == {1}
    same = [r["component_id"] for r in got if r["doc_id"] in (3,)]
    assert same == [3, 3]
    kept = simhash.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({r["component_id"] for r in got})
    assert simhash.near_duplicates(awkward(spark, [])).collect() == []


# ------------------------------------------------------------------------------------ suffix dedup

def plain_cut(rows, length=200):
    seen = collections.Counter(b[k:k + length] for b in rows for k in range(len(b) - length + 1))
    out = []
    for b in rows:
        gone = np.zeros(len(b) + 2, bool)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k + 1:k + 1 + length] = True
        spans = int(np.count_nonzero(np.diff(gone.astype(int)) == 1))
        kept = bytes(c for c, g in zip(b, gone[1:]) if not g)
        out.append((len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeats(spark, texts):
    some = [t for _, t in sorted(texts.items())][:60]
    a = some[0] if len(some[0]) > 600 else some[1] * 3
    return some + ["a" * 900, "ab" * 700, "abc" * 300, a[50:249], a[50:250] + "tail", "q" + a[60:300] + "r" + a[100:420], a[:450], a[:450],
                   "z" * 199, "z" * 199, "y" * 200]


@pytest.mark.parametrize("many,block", [(2000, 1 << 20), (1, 1 << 20), (2000, 700)])
def test_suffix_dedup_matches_brute_force(spark, texts, many, block, monkeypatch):
    monkeypatch.setattr(suffixdedup, "MANY", many)
    monkeypatch.setattr(suffixdedup, "BLOCK_BYTES", block)
    rows = repeats(spark, texts)
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: tuple(r)[1:] for r in suffixdedup.remove_repeats(frame).collect()}
    assert [got[k] for k in range(len(rows))] == plain_cut([t.encode() for t in rows])


def test_suffix_order_is_the_order_of_the_bytes():
    rng = np.random.default_rng(5)
    data = rng.choice([97, 98], 3000).astype(np.uint8)
    data[1000:1600] = data[:600]
    data[2000:2400] = 97
    suffixes = suffixdedup._Suffixes(data)
    starts = rng.permutation(2700)
    order, _ = suffixes.sort(starts, np.zeros(len(starts), np.int64))
    found = [data[s:s + 200].tobytes() for s in starts[order]]
    assert found == sorted(found)


def test_colliding_hashes_are_found_out(monkeypatch):
    """With a hash that calls everything equal, order and equality still come from the bytes."""
    data = np.random.default_rng(2).integers(97, 99, 2000).astype(np.uint8)
    data[900:1200] = data[:300]
    monkeypatch.setattr(suffixdedup._Polynomial, "of", lambda self, start, length: np.zeros(len(start), np.uint64))
    suffixes = suffixdedup._Suffixes(data)
    assert suffixes.equal(np.array([0, 0, 50]), np.array([900, 901, 950])).tolist() == [True, False, True]


def test_suffix_dedup_of_awkward_rows(spark):
    rows = awkward(spark)
    got = suffixdedup.remove_repeats(rows).collect()
    want = plain_cut([(r["text"] or "").encode() for r in rows.collect() if r["doc_id"] != 6])
    assert sorted(tuple(r)[1:] for r in got if r["doc_id"] != 6) == sorted(want)
    assert [r["n_removed"] for r in got if r["doc_id"] == 6] == [300_000]
    left = suffixdedup.without_repeats(rows)
    assert left.columns == rows.columns
    kept = left.collect()
    assert {r["doc_id"] for r in kept} == {None, 1, 2, 3, 5, 7, 8, 10}
    assert {r["k1"] for r in kept} == {"clash"} and all(r["n_chars"] == (len(r["text"]) if r["text"] is not None else None) for r in kept)
    assert suffixdedup.remove_repeats(awkward(spark, [])).collect() == []


# ------------------------------------------------------------------------------- decontamination

def plain_matches(texts, items, threshold=0.8):
    words = lambda t: [w.encode() for w in re.findall(r"(?:[0-9a-z_]|[^\x00-\x7f])+", (t or "").lower())]
    out = {}
    for row, text in enumerate(texts):
        w = words(text)
        for item, other in items:
            o = words(other)
            if not o or not w:
                continue
            k, size = min(5, len(o)), min(len(o), len(w))
            a = collections.Counter(b" ".join(o[j:j + k]) for j in range(len(o) - k + 1))
            for s in range(len(w) - size + 1):
                b = collections.Counter(b" ".join(w[s + j:s + j + k]) for j in range(size - k + 1))
                shared = (a & b).total()
                score = shared / (a.total() + b.total() - shared)
                if score >= threshold and score > out.get((row, item), (0,))[0]:
                    out[row, item] = (score, s, size)
    return out


def test_decontamination_matches_brute_force(spark, texts, monkeypatch):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    items += [(900, "to the"), (901, ""), (902, None), (903, items[0][1])]
    rows = [t for _, t in sorted(texts.items())][:40]
    rows += ["Before. " + items[0][1].upper() + " after", " ".join(items[5][1].split()[1:]), "x " + items[7][1].replace(" ", "  "), ""]
    w = items[3][1].split() * 2
    rows.append(" ".join(w[:20] + ["other"] + w[21:]))
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = plain_matches(rows, items)
    for block in (1 << 20, 400):
        monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
        got = {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in decontam.matches(frame, bench).collect()}
        assert got == want
    monkeypatch.setattr(decontam, "BUCKET_BYTES", 2000)
    got = {(r["doc_id"], r["item_id"]): tuple(r)[2:] for r in decontam.matches(frame, bench).collect()}
    assert got == want
    kept = {r["doc_id"] for r in decontam.clean(frame, bench).collect()}
    assert kept == set(range(len(rows))) - {row for row, _ in want}


def found_in(rows, items):
    matcher = decontam.Matcher(items)
    import pyarrow as pa

    return {(r[0], r[1]): r[2:] for r in matcher.find(pa.array(rows))}


def test_windows_beside_repeated_words_are_found(monkeypatch):
    rng = np.random.default_rng(8)
    items, rows = [], []
    for k, (n, cut) in enumerate([(64, 6), (64, 6), (104, 11), (104, 11), (204, 22), (30, 2), (12, 1)]):
        words = [f"w{x}" for x in rng.integers(0, 10_000, n)]
        items.append((k, " ".join(words)))
        run = ["junk"] * (n + 20)
        rows += [" ".join(["start"] + words[:n - cut] + run), " ".join(run + words[cut:] + ["end"]), " ".join(words[:n - 2 * cut] + run)]
        rows += [" ".join(words[:n - cut] + ["junk"] * cut), " ".join((words[:n - cut] + run) * 2), " ".join(run)]
    items += [(50, "junk " * 40), (51, "a b c d e f g " + "junk " * 40), (52, "junk")]
    want = plain_matches(rows, items)
    assert found_in(rows, items) == want and sum(i < 50 for _, i in want) >= 10
    monkeypatch.setattr(decontam, "PAIRS", 3)
    assert found_in(rows, items) == want


@pytest.mark.parametrize("block", [20, 45, 300])
def test_items_longer_than_a_piece_are_found(block, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    words = [f"word{k}" for k in range(90)]
    items = [(1, " ".join(words)), (2, " ".join(words[:12])), (3, "one two")]
    other = [f"other{k}" for k in range(300)]
    rows = [" ".join(other[:n] + words[:85] + ["changed"] + words[86:] + other[n:]) for n in (0, 1, 7, 40, 150, 300)] + [" ; ".join(words), " " * 500, ""]
    rows += ["y" * 1000 + " " + " ".join(words[:12]), " ".join(other[:50]) + "  " * 200 + " ".join(words)]
    calls, block_of = [], decontam.Matcher._block
    monkeypatch.setattr(decontam.Matcher, "_block", lambda self, raw, offsets: calls.append(len(raw)) or block_of(self, raw, offsets))
    want = plain_matches(rows, items)
    assert found_in(rows, items) == want and len(want) >= 14
    assert len(calls) < 60  # a step is a piece, not a word


def test_blocks_find_all_fingerprints_within_the_radius():
    rng = np.random.default_rng(1)
    items = rng.integers(0, 1 << 63, 60).astype(np.uint64)
    probes = np.concatenate([items ^ np.uint64(sum(1 << int(b) for b in rng.choice(63, 23, replace=False))), items])
    place, item, distance = decontam._Blocks(items, 23).near(probes)
    want = {(p, i) for p in range(len(probes)) for i in range(len(items)) if int(probes[p] ^ items[i]).bit_count() <= 23}
    assert set(zip(place.tolist(), item.tolist())) == want


def test_decontamination_of_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "short text of a few words"), (2, None)], "item_id long, text string")
    got = decontam.matches(awkward(spark), bench).collect()
    assert sorted((r["doc_id"] or -1) for r in got) == [-1, 3, 3]
    left = decontam.clean(awkward(spark), bench)
    assert left.columns == awkward(spark).columns and left.count() == 10
    assert decontam.matches(awkward(spark), bench.limit(0)).collect() == []
    assert decontam.matches(awkward(spark, []), bench).collect() == []


# --------------------------------------------------------------------------- quality and language

def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op7_quality(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got["doc_id"]]).all()
    assert got["score"].between(0, 1).all() and ((got["score"] >= 0.3) == (got["predicted"] == 1)).all()
    held = got.merge(labels, on="doc_id").query("held_out")
    assert (held["predicted"] == held["quality"]).mean() > 0.95


def test_quality_without_labels_and_of_awkward_rows(spark):
    stats = quality.document_statistics(awkward(spark))
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(quality.training_rows(stats, none))
    assert [r["score"] for r in quality.score_documents(stats, model).collect()] == [0.5] * 13
    one = spark.createDataFrame([(3, 1), (3, None), (5, 1), (None, 0), (6, 7)], "doc_id long, quality int")
    model = quality.fit(quality.training_rows(stats, one))
    assert all(r["score"] > 0.9 for r in quality.score_documents(stats, model).collect())
    kept = quality.accepted(awkward(spark), model)
    assert kept.columns == awkward(spark).columns and kept.count() == 13
    empty = quality.document_statistics(awkward(spark, []))
    assert quality.score_documents(empty, quality.fit(quality.training_rows(empty, one))).collect() == []


def test_normal_equations_equal_a_direct_solution(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, len(quality.STATISTICS)))
    y = (x[:, 0] + x[:, 1] ** 2 > 0.5).astype(int)
    rows = spark.createDataFrame([(a.tolist(), int(b)) for a, b in zip(x, y)], "_stats array<double>, _label int")
    model = quality.fit(rows)
    z = quality.QualityModel(x.mean(axis=0), x.std(axis=0)).fourier(x)
    centred = z - z.mean(axis=0)
    want = np.linalg.solve(centred.T @ centred / 400 + quality.RIDGE * np.eye(quality.FEATURES), centred.T @ (y - y.mean()) / 400)
    assert np.allclose(model.weights, want, atol=1e-6)
    assert (np.diff(model.values) >= 0).all()
    assert ((model.score(x) >= 0.5) == y).mean() > 0.9


def test_isotonic_values_are_the_nearest_rising_sequence():
    assert quality.pool_adjacent(np.array([1.0, 3.0, 2.0, 2.0, 5.0]), np.ones(5)).tolist() == [1.0, 7 / 3, 7 / 3, 7 / 3, 5.0]


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op4_language(spark, sf).toPandas()
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").toPandas()
    assert (got["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got["doc_id"]]).all()
    assert got["score"].between(0, 1).all()
    held = got.merge(docs[docs["lang"].notna()], on="doc_id").query("held_out and lang_pred != 'und'")
    assert (held["lang_pred"] == held["lang"]).mean() > 0.98


def test_language_of_awkward_rows(spark):
    rows = spark.createDataFrame([("hello the and of world " * 3, "en"), ("der die und nicht welt " * 3, "de"), ("nothing", None), (None, "fr")],
                                 "text string, lang string")
    model = langid.fit(rows)
    assert model["langs"] == ["de", "en"]
    got = {r["doc_id"]: r for r in langid.predict(awkward(spark), model).collect() if r["doc_id"] is not None}
    assert [got[k]["lang_pred"] for k in (1, 2, 7, 10)] == ["und"] * 4 and got[1]["score"] == 0.0
    assert got[4]["lang_pred"] == "en"  # "the", "and", "of"
    unseen = spark.createDataFrame([(1, "helloo worldly"), (2, "nichts weltlich")], "doc_id long, text string")
    assert [r["lang_pred"] for r in langid.predict(unseen, model).orderBy("doc_id").collect()] == ["en", "de"]
    nothing = langid.fit(rows.limit(0))
    assert {r["lang_pred"] for r in langid.predict(awkward(spark), nothing).collect()} == {"und"}


def test_language_memory_starts_afresh(spark, monkeypatch):
    rows = spark.createDataFrame([("hello the and of world " * 3, "en"), ("der die und nicht welt " * 3, "de")], "text string, lang string")
    model = langid.fit(rows)
    text = " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}hello" for k in range(300))
    want = langid.Scorer(model).predict(text)
    monkeypatch.setattr(langid, "REMEMBERED", 7)
    got = langid.Scorer(model).predict(text)
    assert got[0] == want[0] and got[1] == pytest.approx(want[1])


# ---------------------------------------------------------------------------------- SentencePiece

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
        model = f.read()
    return sentencepiece.SentencePieceProcessor(model_proto=model), pieces.Encoder(pieces.read_vocabulary(model))


def test_encoding_equals_the_library(library):
    sp, encoder = library
    rng = np.random.default_rng(8)
    alphabet = list(" ab  \n\t▁éxthein<>0123.,日本語 \x00ﬁае́🙂 -=_\"'!")
    for _ in range(4000):
        text = "".join(rng.choice(alphabet, rng.integers(0, 40)))
        assert encoder.encode(text) == sp.encode(text), text
    for text in [" " * n + "x" for n in range(70)] + ["a" * 3000, " a" * 2000, "=" * 333 + " " * 77, "ha" * 999, "1,000.50", "don't"]:
        assert encoder.encode(text) == sp.encode(text)


def test_encoding_with_a_small_memory(library, monkeypatch):
    sp, encoder = library
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    for text in ("one two three four five one two", "six seven one two eight nine"):
        assert encoder.encode(text) == sp.encode(text)


def test_encoded_documents(spark, texts, library):
    sp, _ = library

    def row(text):
        ids = sp.encode(text)
        return (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(sp.decode(ids).encode()).hexdigest())

    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op2_sentencepiece(spark, SF).collect()}
    assert got == {i: row(t) for i, t in texts.items()}
    import public_tokenizers

    rows = awkward(spark)
    odd = pieces.encode_documents(rows, public_tokenizers.path("piece_bpe_32k.model")).collect()
    want = sorted((r["doc_id"] or -1, *row(r["text"] or ""), sp.encode(r["text"] or "")) for r in rows.collect())
    assert sorted((r["doc_id"] or -1, *tuple(r)[1:]) for r in odd) == want


# --------------------------------------------------------------------------------------- pipeline

def test_pipeline_equals_brute_force_stages(spark, docs):
    """Each stage against a plain version on what its predecessor kept; the last stage's rows are run()'s."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_classifier", "simhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "sentencepiece"]

    good = stages["quality_classifier"](spark, docs, SF).cache()
    assert good.columns == docs.columns
    stats = quality.document_statistics(docs)
    scores = quality.score_documents(stats, quality.fit(quality.training_rows(stats, labels)))
    assert {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in scores.filter("predicted = 1").collect()}

    one = stages["simhash_near_dedup"](spark, good, SF).cache()
    prints = {r["doc_id"]: plain_fingerprint(r["text"] or "") for r in good.collect()}
    ids = sorted(prints)
    roots = plain_roots(ids, [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 2])
    assert sorted(r["doc_id"] for r in one.collect()) == sorted(set(roots.values()))

    cut = stages["suffix_array_dedup"](spark, one, SF).cache()
    rows = sorted((r["doc_id"], r["text"] or "") for r in one.collect())
    plain = plain_cut([t.encode() for _, t in rows])
    want = {i: p[3] for (i, t), p in zip(rows, plain) if p[1] < p[0] or p[0] == 0}
    got = {r["doc_id"]: r for r in cut.collect()}
    assert set(got) == set(want)
    for i, r in got.items():
        assert r["n_chars"] == len(r["text"])
        if dict(zip((x for x, _ in rows), plain))[i][1] == 0:
            assert hashlib.sha256(r["text"].encode()).hexdigest() == want[i]

    clean = stages["benchmark_decontamination"](spark, cut, SF).cache()
    rows = sorted((r["doc_id"], r["text"]) for r in cut.collect())
    dirty = {rows[k][0] for k, _ in plain_matches([t for _, t in rows], items)}
    assert {r["doc_id"] for r in clean.collect()} == set(got) - dirty

    last = sorted(map(tuple, stages["sentencepiece"](spark, clean, SF).select("doc_id", "n_tokens", "ids_sha256").collect()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "n_tokens", "ids_sha256").collect())) == last


def test_pipeline_of_awkward_rows(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF).cache()
        assert name == "sentencepiece" or docs.columns == before.columns
        docs.count()
    empty = awkward(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


# ------------------------------------------------------------------------------------------ language: plain scorer

def plain_language(rows, texts):
    """(language, score) of each text, learned from (lang, text) rows: one dictionary a language and length."""
    import math

    rows = sorted({(lang, t) for lang, t in rows if lang is not None and t is not None})
    langs = sorted({lang for lang, _ in rows})
    grams = lambda w, n: [f"\x02{w}\x03"[k:k + n] for k in range(len(w) + 3 - n)] if n > 1 else list(w)
    split = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    counts = [collections.defaultdict(lambda: collections.Counter()) for _ in range(5)]
    for lang, text in rows:
        for word in split(text):
            counts[0][lang][word] += 1
            for n in range(1, 5):
                counts[n][lang].update(grams(word, n))
    for lang in langs:
        counts[0][lang] = collections.Counter({w: c for w, c in counts[0][lang].items() if c > 1})
    known = [set().union(*(counts[n][lang] for lang in langs)) for n in range(5)]
    total = [{lang: sum(counts[n][lang].values()) for lang in langs} for n in range(5)]

    def log(n, key, lang):
        return math.log((counts[n][lang][key] + 0.1) / (total[n][lang] + 0.1 * max(len(known[n]), 1)))

    def word_score(word, lang):
        if word in known[0]:
            return log(0, word, lang)
        for n in range(4, 0, -1):
            found = [g for g in grams(word, n) if g in known[n]]
            if found:
                return sum(log(n, g, lang) for g in found) / len(found)
        return 0.0

    out = []
    for text in texts:
        words = split(text or "")
        if not words or not any(c.isalpha() for c in text):
            out.append(("und", 0.0))
            continue
        sums = [sum(word_score(w, lang) for w in words) * min(len(words), 20) / len(words) for lang in langs]
        odds = [math.exp(s - max(sums)) for s in sums]
        best = odds.index(max(odds))
        out.append((langs[best], odds[best] / sum(odds)))
    return out


def test_language_matches_a_plain_scorer(spark, docs):
    rows = docs.filter("doc_id % 4 <> 0").select("lang", "text")
    learned = [tuple(r) for r in rows.collect()]
    asked = docs.filter("doc_id % 4 = 0").select("doc_id", "text").unionByName(spark.createDataFrame(
        [(-1, "la the"), (-2, "x"), (-3, None), (-4, "Zyxw qqq 42 überall"), (-5, "??? 12"), (-6, "de la el der the")], "doc_id long, text string"))
    texts = {r["doc_id"]: r["text"] for r in asked.collect()}
    want = dict(zip(texts, plain_language(learned, texts.values())))
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.predict(asked, langid.fit(rows)).collect()}
    assert {i: g[0] for i, g in got.items()} == {i: w[0] for i, w in want.items()}
    assert all(got[i][1] == pytest.approx(want[i][1], abs=1e-9) for i in want)


def test_language_sample_is_bounded_and_copies_count_once(spark):
    rows = spark.range(30_000).selectExpr("if(id % 3 = 0, 'xx', 'yy') AS lang",
                                          "if(id % 2 = 0, 'the same text in a third of all rows', concat('text ', id)) AS text")
    found = {}
    for r in langid.sample_rows(rows, 200).collect():
        found.setdefault(r["lang"], []).append(r["text"])
    assert set(found) == {"xx", "yy"}
    assert all(len(set(t)) == len(t) and 60 <= len(t) <= 260 for t in found.values())
    few = langid.sample_rows(rows.limit(50), 200).collect()
    assert len(few) == rows.limit(50).distinct().count()


def test_language_model_over_its_bound_is_refused(spark, docs, monkeypatch):
    monkeypatch.setattr(langid, "MAX_ENTRIES", 100)
    with pytest.raises(ValueError, match="Lower max_rows"):
        langid.fit(docs.select("lang", "text"))


def test_quality_learned_and_applied_in_one_look(spark, docs):
    """The same rows as learning from statistics and scoring texts apart, whatever other columns there are."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(quality.training_rows(quality.document_statistics(docs), labels))
    want = sorted(r["doc_id"] for r in quality.accepted(docs, model).collect())
    got = quality.learn_and_accept(docs, labels)
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == want and 0 < len(want) < docs.count()
    assert got.exceptAll(docs).count() == 0
    odd = awkward(spark)
    kept = quality.learn_and_accept(odd, labels.limit(0))          # nothing to learn from: every row scores a half
    assert kept.columns == odd.columns and kept.count() == odd.count()
    assert quality.learn_and_accept(odd.limit(0), labels).count() == 0


def test_a_matcher_is_made_once_a_worker(monkeypatch):
    made = []
    monkeypatch.setattr(decontam, "Matcher", lambda items: made.append(items) or "matcher")
    state = {"items": [(1, "some words of an item here")]}
    assert [decontam._matcher(state) for _ in range(3)] == ["matcher"] * 3 and len(made) == 1
