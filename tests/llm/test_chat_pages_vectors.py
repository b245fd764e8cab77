"""Chat, URL, page and vector operators against brute force, on small tables and awkward rows."""

import hashlib
import html as entities
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tapline.llm import ann, chat, queries, urlfilter
from tapline.llm import html as pages

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------------------------------------- chat

def plain_conversation(turns):
    """Digests of (turn, role, text) rows."""
    turns = sorted(((t is not None, t or 0, r or "", x or "") for t, r, x in turns))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(x for _, _, r, x in turns if r == "assistant")
    return len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss)


def test_digests_match_the_turns(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet").collect()
    want = {}
    for r in rows:
        want.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    want[-1] = [(k, role, "<|im_end|><|im_start|>assistant ok") for k, role in enumerate(("user", "assistant"))]
    got = {r["conv_id"]: tuple(r)[1:5] for r in queries.op1_chat(spark, SF).collect()}
    assert got == {k: plain_conversation(v) for k, v in want.items()}


AWKWARD = [(1, 0, "user", "a"), (1, 1, "assistant", "<|im_end|>\n<|im_start|>user\nx"), (1, 2, "assistant", None), (1, 3, "user", "<||nl||> <|nl|> <"),
           (2, None, None, None), (2, 5, "assistant", "é🙂\n"), (2, 5, "assistant", "é🙂\n"), (2, 5, "assistant", "a tie"),
           (None, 1, "sys\ntem<|", "|>"), (None, 2, "assistant", "<" * 5 + "|" * 3), (3, 1, "user", "x" * 200_000), (4, 1, "assistant", "")]


def test_awkward_conversations(spark):
    frame = spark.createDataFrame(AWKWARD, "conv_id long, turn long, role string, text string").withColumns(
        {"turns": F.lit("clash"), "example": F.lit(7), "formatted": F.lit("clash"), "hit": F.lit(True)})
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.conversation_digests(chat.expand(frame, tail=True)).collect()}
    want = {}
    for c, t, r, x in AWKWARD:
        want.setdefault(c, []).append((t, r, x))
    assert got == {k: plain_conversation(v) for k, v in want.items()}
    assert chat.conversation_digests(chat.expand(frame.limit(0), tail=True)).collect() == []


def test_every_reply_is_an_example_with_its_prefix(spark):
    frame = spark.createDataFrame([(1, k, "user" if k % 2 == 0 else "assistant", f"t{k}<|") for k in range(7)],
                                  "conv_id long, turn long, role string, text string")
    rows = chat.expand(frame).orderBy("example").collect()
    assert [r["example"] for r in rows] == [2, 4, 6] and not any(r["last"] for r in rows)
    for r in rows:
        text = "".join(f"<|im_start|>{'user' if k % 2 == 0 else 'assistant'}\nt{k}<||<|im_end|>\n" for k in range(r["example"]))
        assert r["formatted"] == text
        start = r["loss_start"] - 1
        assert text[start:start + r["loss_chars"]] == f"t{r['example'] - 1}<||" and text[start + r["loss_chars"]:] == "<|im_end|>\n"


# ---------------------------------------------------------------------------------------------- urls

def plain_verdict(url):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


URLS = ["http://a.example.org/en/12", "https://EXAMPLE.org/es/x?y#z", "x://org/", "x://org", "http://forg/x", "http://a.com/fr/", "http://com/de/1",
        "http://b.com/deutsch", None, "", "no scheme/", "http://", "http:///p", "a://b://c.com/fr/x", "http://É.com/fr/É", "http://x.org?/y",
        "http://" + "a." * 5000 + "org/" + "p" * 50_000, "http://example.org/en/", "http://notexample.org/es/"]


def test_verdicts_match_the_rules(spark):
    frame = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)] + [(None, URLS[0])], "page_id long, url string").withColumns(
        {"host": F.lit("clash"), "key": F.lit("clash"), "_keys": F.lit(1)})
    got = urlfilter.judge_urls(frame, queries.URL_RULES)
    assert set(frame.columns) <= set(got.columns)
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_verdict(r["url"])
    assert urlfilter.judge_urls(frame.limit(0), queries.URL_RULES).collect() == []


def test_cascade_is_exact_for_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("key"), "id").alias("key"))
    listed = universe.filter("crc32(cast(key as binary)) % 50 = 0").union(spark.sql("SELECT 'elsewhere' UNION ALL SELECT NULL"))
    cascade = urlfilter.build_cascade(listed, universe)
    assert len(cascade.levels) > 1
    want = {r["key"] for r in listed.collect()} - {None}
    got = {r["key"] for r in universe.union(listed).filter(cascade.contains(F.col("key"))).collect()}
    assert got == want
    size = sum(len(data) for _, _, data in cascade.levels)
    assert size < 3 * len(want)  # a few bytes a listed key, not a key of the universe
    none = urlfilter.build_cascade(listed.limit(0), universe)
    assert universe.filter(none.contains(F.col("key"))).count() == 0
    all_ = urlfilter.build_cascade(universe, universe)
    assert universe.filter(all_.contains(F.col("key"))).count() == 20_000


def test_cascade_refuses_a_list_beyond_its_bound(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "MAX_BITS", 100)
    keys = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    with pytest.raises(ValueError, match="the bound is 100"):
        urlfilter.build_cascade(keys, keys)


# --------------------------------------------------------------------------------------------- pages

def test_article_text_of_all_pages(spark):
    html = {r["page_id"]: r["html"] or "" for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op5_html(spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", html[r["page_id"]], re.S)
        plain = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|h1|br)>", " ", inner[1])) if inner else ""
        assert r["text"] == " ".join(entities.unescape(plain).split()) and r["n_chars"] == len(r["text"])


PAGE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><a href="/">Site name</a></header>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><div id="cookieNotice">This site uses cookies to do many things for you and others.</div>
%s<aside><p>Read also this and that, which is long enough to look like text.</p></aside><form><p>Write to us about everything you like</p><input></form>
<section class="comments"><article><p>I think this is a very good article, and I want to say so at length.</p></article></section>
<div class="ad-box ads"><p>Buy this now because it is cheap and good and you need it</p></div><footer>&copy; us</footer><script>var x="<p>no</p>"</script></body></html>"""
ARTICLE = "<h1>Title &amp; more</h1><p>First <b>bold</b>text\n of the  article, long enough to be found.<p>Two.<ul><li>x<li>y</ul><blockquote>Quoted &eacute;</blockquote>"
TEXT = "Title & more First boldtext of the article, long enough to be found. Two. x y Quoted é"


@pytest.mark.parametrize("frame", ["<article>%s</article>", "<main>%s</main>", "<div class='content'>%s</div>", "<main><div><article><header>%s</header></article></div></main>"])
def test_boilerplate_goes_and_the_article_stays(frame):
    assert pages.main_text(PAGE % (frame % ARTICLE)) == TEXT


@pytest.mark.parametrize("wrapper", ["class='site-content has-sidebar'", "class='no-sidebar'", "class='layout-sidebar-right'", "id='post-tags-layout'",
                                     "class='content-sidebar-wrap'", "class='comments-open with-widgets'"])
@pytest.mark.parametrize("frame", ["<article>%s</article>", "<article class='post comments-open'>%s</article>", "<div class='content'>%s</div>"])
def test_layout_names_hide_nothing(wrapper, frame):
    assert pages.main_text(PAGE % f"<div {wrapper}>{frame % ARTICLE}</div>") == TEXT


@pytest.mark.parametrize("name", ["sidebar-right", "widget-area", "search", "tags", "banner header"])
@pytest.mark.parametrize("tag", ["article", "main"])
def test_an_article_in_a_block_hidden_by_name_is_content(name, tag):
    inner = f"<div class='{name}'><p>Some words that are not of the text, but long enough.</p><{tag}>{ARTICLE}</{tag}></div>"
    assert pages.main_text(PAGE % inner) == TEXT
    assert pages.main_text(PAGE % f"<main>{inner}</main>") == TEXT


def test_inline_parts_are_not_hidden_by_name():
    text = "Take <span class='alert'>great care</span> with <b class='search-term'>every</b> <em id='tags'>word</em> of a sentence."
    for frame in ("<article><p>%s</p></article>", "<div><p>%s</p></div>"):
        assert pages.main_text(frame % text) == "Take great care with every word of a sentence."
    assert pages.main_text("<p>Seen <span hidden>not</span> <span style='display: none'>this</span>words</p>").split() == ["Seen", "words"]


@pytest.mark.parametrize("name", ["sidebar", "left-sidebar", "sidebar-1", "cookieNotice", "ad-box", "div-gpt-ad-12-0", "site-footer", "social-share-buttons",
                                  "related-posts", "related-content", "post-tags", "comment-body"])
def test_blocks_of_that_name_still_go(name):
    for kind in ("class", "id"):
        inner = f"<div {kind}='{name}'><p>Some words that are not of the text, but long enough.</p></div>"
        assert pages.main_text(PAGE % f"<article>{ARTICLE}{inner}</article>") == TEXT


def test_sections_of_an_unmarked_article_stay_together():
    body = "".join(f"<section><h2>Part {k}</h2><p>{'A long enough sentence of the text. ' * (6 if k != 2 else 1)}</p></section>" for k in range(4))
    got = pages.main_text(f"<body><div class='top'><a href='/'>Home</a> <a href='/x'>News</a></div><div id='post'>{body}</div></body>")
    assert [f"Part {k}" in got for k in range(4)] == [True] * 4 and "Home" not in got


@pytest.mark.parametrize("between", ["", "<div class='ad'>Buy</div>", "<div><a href='/x'>Link</a></div>", "<div hidden>no</div>" * 4])
@pytest.mark.parametrize("place", [0, 2, 5])
@pytest.mark.parametrize("nested", ["%s", "<div>%s</div>", "<table><tr><td>%s</td></tr></table>"])
def test_short_paragraphs_in_their_own_divs_stay(between, place, nested):
    short = [f"Short {k} " + "w" * 52 for k in range(6)]
    paragraphs = [*short[:place], "long text " * 200, *short[place:]]
    post = between.join(f"<div>{nested % x}</div>" for x in paragraphs)
    top = "<div class='top'><a href='/'>Home</a> <a href='/x'>News</a></div>"
    end = "<div class='end'><a href='/about'>About</a><br><a href='/legal'>Legal</a></div>"
    for page in (f"<body>{top}<div id='post'>{post}</div>{end}</body>", f"<body>{post}</body>"):
        got = pages.main_text(page)
        assert got.count("long text") == 200 and [x in got for x in short] == [True] * 6
        assert not any(x in got for x in ("Legal", "Buy", "no")) and ("Home" not in got or place == 0)


def test_a_block_beside_the_paragraphs_stays_out():
    post = "".join(f"<div>{'long text ' * 30}{k}</div><div>Short {k}.</div>" for k in range(6))
    other = "<div class='x'>" + "<div>Call us.</div><div>Open daily.</div>" * 3 + "</div>"
    got = pages.main_text(f"<body>{other}<div id='post'>{post}</div>{other}</body>")
    assert all(f"Short {k}." in got for k in range(6)) and got.count("Open daily.") < 6


@pytest.mark.parametrize("text,want", [("", ""), ("plain words", "plain words"), ("<p>a<br>b</p>", "a b"), ("<p>a", "a"), ("</p></div>x</i>", "x"),
                                       ("<script>only()</script>", ""), ("<nav><a href=x>only menu</a></nav>", ""), ("<!-- c -->", ""), ("a &lt;b&gt; &#x41;", "a <b> A")])
def test_small_and_broken_pages(text, want):
    assert pages.main_text(text) == want


@pytest.mark.parametrize("mark", ["<![ endif]-->", "<![x>", "<![endif]-->", "<![>", "<![ if !IE]>", "<![CDATA[x]]>", "<![if gte mso 9]>", "<![broken<!x>", "<![é>"])
def test_text_after_a_marked_section_stays(mark):
    assert pages.main_text(f"<p>aaa</p>{mark}<p>bbb</p><p>ccc</p>") == "aaa bbb ccc"
    assert pages.main_text(f"<article><p>aaa</p>{mark}<p>bbb</p></article><![") == "aaa bbb"


def test_awkward_pages(spark):
    frame = spark.createDataFrame([(1, None, None), (None, "u", ""), (2, "u", "<p>" + "long text " * 50_000 + "</p>"), (2, "u", "<![broken<!x>y")],
                                  "page_id long, url string, html string").withColumns({"id": F.lit("clash"), "text": F.lit("clash")})
    got = pages.extract(frame).collect()
    assert [r["n_chars"] for r in got][:3] == [0, 0, 499_999] and len(got) == 4
    assert pages.extract(frame.limit(0)).collect() == []


# ------------------------------------------------------------------------------------------- vectors

def plain_nearest(vectors, k=20):
    ids, x = np.array([i for i, _ in vectors]), np.array([v for _, v in vectors], float)
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            s = (x * q).sum(axis=1)
            s[ids == i] = -np.inf
            out[int(i)] = [int(j) for j in ids[np.lexsort((ids, -s))][:min(k, len(ids) - 1)]]
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r["query_id"], set()).add(r["vec_id"])
    return sum(len(found[q] & set(w)) for q, w in want.items()) / sum(map(len, want.values()))


def test_recall_against_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    vectors = [(r["vec_id"], r["embedding"]) for r in rows if r["embedding"] is not None]
    got = queries.op6_ann(spark, "/root/testdata/sf0.1").collect()
    want = plain_nearest(vectors)
    assert recall(got, want) >= 0.95
    by_id = dict(vectors)
    for r in got:
        assert r["score"] == pytest.approx(float(np.dot(np.array(by_id[r["query_id"]], float), np.array(by_id[r["vec_id"]], float))), abs=1e-12)
    for q in want:
        mine = sorted((r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_blocks_give_the_same_as_one(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(900, 8))
    x[::3] = x[0]  # a third of the rows hold one vector
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(ann, "PER_PARTITION", 10_000)  # one partition: the search is exact
    want = {}
    for r in ann.nearest(frame, F.col("id") % 20 == 0).collect():
        want.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert {q: [v[0] for _, v in sorted(r.items())] for q, r in want.items()} == plain_nearest([(k, np.float32(v)) for k, v in enumerate(x)])
    monkeypatch.setattr(ann, "BLOCK", 70)
    monkeypatch.setattr(ann, "QUERIES", 9)
    got = {}
    for r in ann.nearest(frame, F.col("id") % 20 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert got == want


def test_partitions_are_balanced():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(500, 6)) * 0.1 + rng.normal(size=6) * s for s in (1, 3, 5)])
    label = ann.balanced_partitions(x, ann.neighbour_graph(x, 10), 8)
    sizes = np.bincount(label, minlength=8)
    assert sizes.max() <= np.ceil(1.1 * len(x) / 8) + 1 and len(sizes) == 8


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, [None, 1.0]), (7, [1.0]), (8, []), (None, [1.0, 2.0]), (-20, [2.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"id": F.lit("clash"), "v": F.lit("clash"), "p": F.lit(3)})
    got = sorted(map(tuple, ann.nearest(frame, F.col("id") % 20 == 0).collect()))
    assert got == sorted([(0, 1, -20, 2.0), (0, 2, 1, 1.0), (0, 3, 20, 0.0), (20, 1, -20, 2.0), (20, 2, 1, 1.0), (20, 3, 0, 0.0),
                          (-20, 1, 1, 4.0), (-20, 2, 0, 2.0), (-20, 3, 20, 2.0)])
    assert ann.nearest(frame.limit(0), F.col("id") % 20 == 0).collect() == []
    one = frame.filter("vec_id = 0")
    assert ann.nearest(one, F.col("id") % 20 == 0).collect() == []


def uneven_clusters(seed=3, n=5730, d=16):
    """Clusters of very uneven size, the smallest of a few vectors."""
    rng = np.random.default_rng(seed)
    sizes = np.maximum(3, (n * 0.75 ** np.arange(40) / 4).astype(int))
    x = np.concatenate([rng.normal(size=(s, d)) * 0.05 + rng.normal(size=d) * (1 + k % 5) for k, s in enumerate(sizes)])
    return np.float32(x[rng.permutation(len(x))])


@pytest.mark.parametrize("leaf", [100_000, 400])
def test_every_query_gets_all_its_neighbours_in_uneven_clusters(spark, monkeypatch, leaf):
    x = uneven_clusters()
    monkeypatch.setattr(ann, "LEAF", leaf)                   # the smaller one makes a second level
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = ann.nearest(frame, F.col("id") % 20 == 0).collect()
    want = plain_nearest(list(enumerate(x)))
    counts = {}
    for r in got:
        counts[r["query_id"]] = counts.get(r["query_id"], 0) + 1
    assert set(counts) == set(want) and set(counts.values()) == {20}
    assert recall(got, want) >= 0.97


def test_levels_split_large_partitions_and_visit_a_smaller_share(spark, monkeypatch):
    x = uneven_clusters(9, 9000)
    vectors = spark.createDataFrame([(k, [float(e) for e in v]) for k, v in enumerate(x)], "id long, v array<double>")
    share, leaves = {}, {}
    for leaf in (100_000, 150):
        monkeypatch.setattr(ann, "LEAF", leaf)
        tree, placed, rows = ann.fit_tree(vectors, x.shape[1])
        assert sum(rows.values()) == len(x) == placed.count()
        visits = tree.visits(np.float64(x[::20]))
        share[leaf] = np.mean([sum(rows.get(p, 0) for p in v) for v in visits]) / len(x)
        leaves[leaf] = len(rows)
        assert all(sorted(tree.by_probability(np.float64(x[0]))) == sorted(set(tree.by_probability(np.float64(v)))) for v in x[:5])
    assert leaves[150] > leaves[100_000] and share[150] <= share[100_000] * 1.1


def test_ids_of_several_rows_and_vectors_of_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [3.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 2.0]), (40, [1.0, 2.0, 3.0]), (3, [1.0, 0.0, 0.0]),
            (60, [5.0]), (2, [1.0, 3.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in sorted(ann.nearest(frame, F.col("id") % 20 == 0).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {0: [(1, 3.0), (1, 1.0), (2, 1.0), (20, 0.0), (20, 0.0)], 20: [(2, 3.0), (1, 1.0), (0, 0.0), (1, 0.0)], 40: [(3, 1.0)]}


# ------------------------------------------------------------------------------------------ pages: forms, comments, titles

TELL = "A long enough paragraph of the article that tells of the river, the mill and the people who lived there for years."
MARKED = f"<article><h1>Title</h1><p>{TELL}</p><p>{TELL} More.</p><p>Short.</p></article>"
MARKED_TEXT = f"Title {TELL} {TELL} More. Short."
LETTER = "<form action='/x'><p>Write to us and never miss a story</p><input name=mail><button>Send</button></form>"


@pytest.mark.parametrize("page,text", [
    (f"<body><form id='aspnetForm'><input type=hidden name=state><input name=q>{MARKED}<button>Go</button></form></body>", MARKED_TEXT),
    (f"<body><form id='f'><input name=q><div><p>{TELL}</p><p>{TELL}</p><p>{TELL}</p></div></form></body>", " ".join([TELL] * 3)),
    (f"<body>{MARKED}{LETTER}</body>", MARKED_TEXT), (f"<body><div>{LETTER}</div><div><p>{TELL}</p><p>{TELL}</p></div></body>", f"{TELL} {TELL}"),
    (f"<body><article><p>{TELL}</p>{LETTER}<p>{TELL}</p></article></body>", f"{TELL} {TELL}"),
    (f"<body><form>{MARKED}<footer><p>{TELL}</p></footer></form></body>", MARKED_TEXT)])
def test_forms_are_judged_by_what_is_in_them(page, text):
    assert pages.main_text(page) == text


READERS = "".join(f"<div class='c'><p>I think that {TELL} Says reader {k}.</p></div>" for k in range(3))
READER_LIST = f"<ul>{READERS.replace('div', 'li')}</ul>"


@pytest.mark.parametrize("name", ["reader-comments", "user-comments", "comment-thread", "discussion-thread", "all-public-comments", "repliesPane"])
@pytest.mark.parametrize("items", [READERS, READER_LIST], ids=["blocks", "list"])
def test_reader_comments_under_any_name(name, items):
    assert pages.main_text(f"<body><article><h1>T</h1><p>{TELL}</p><p>{TELL}</p><div class='{name}'>{items}</div></article></body>") == f"T {TELL} {TELL}"
    assert pages.main_text(f"<body>{MARKED}<section id='{name}'>{items}</section></body>") == MARKED_TEXT
    assert pages.main_text(f"<body><div><h1>T</h1><p>{TELL}</p><p>{TELL}</p><div id='{name}'>{items}</div></div></body>") == f"T {TELL} {TELL}"


@pytest.mark.parametrize("name", ["related-stories", "sidebar-content", "cookie-law-info", "ad-leaderboard"])
def test_more_names_of_what_is_beside_the_article(name):
    page = f"<body><div class='wrap'><div><p>{TELL}</p><p>{TELL}</p></div><div class='%s'><p>{TELL} Beside.</p></div></div></body>"
    assert pages.main_text(page % name) == f"{TELL} {TELL}"
    assert pages.main_text(page % "content-sidebar") == f"{TELL} {TELL} {TELL} Beside."


def test_a_section_about_comments_is_no_thread():
    page = f"<article><p>{TELL}</p><section id='discussion-of-results'><h2>Discussion</h2><p>{TELL}</p><p>{TELL}</p></section></article>"
    assert pages.main_text(page) == f"{TELL} Discussion {TELL} {TELL}"


@pytest.mark.parametrize("title", ["<h1>Title here</h1>", "<h1>Title here</h1><p class='by'>By A. Writer</p>", "<div><h1>Title here</h1></div><p>12 May</p>"])
def test_title_and_byline_before_the_article_in_main(title):
    page = f"<body><main>{title}<article>{f'<p>{TELL}</p>' * 8}</article></main></body>"
    words = " ".join(re.sub("<[^>]*>", " ", title).split())
    assert pages.main_text(page) == f"{words} {' '.join([TELL] * 8)}"
    links = f"<body><main><p><a href=/>All news</a></p>{title}<article>{f'<p>{TELL}</p>' * 8}</article></main></body>"
    assert pages.main_text(links) == f"{words} {' '.join([TELL] * 8)}"
