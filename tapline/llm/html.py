"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clusters.

1. The standard library's parser streams events. A line is the text between two block-level tags (inline tags do
   not end it); it has a container (the nearest ``article`` or ``main``, else the nearest block that groups others)
   and may stand in a part that is never content (menus, headers, footers, sidebars, notices, adverts, forms,
   scripts, styles, comments), known by tag, role, or the class or id of a block. An article in a block known by its
   name alone counts again, unless it stands among comments or links to other articles. Forms are judged by what is in
   them: a page that stands in a form has much text for each control, or an article. A part whose name has a word for
   comments among other words is one if it repeats items of one shape.
2. The ratio of a line is its characters outside links over its tags; parts that are never content have ratio 0.
   Ratios are smoothed with a Gaussian kernel, and lines over a threshold (a deviation, at most half of
   the highest value) form the clusters of content.
3. A cluster selects its container, so short lines between long ones (headings, one-word paragraphs) stay with it. If
   the page marks an ``article`` or ``main``, only those can be selected (an article in a main with what stands before
   it there, its title and byline); else a cluster selects the nearest block around
   the lines that are over the threshold by themselves, and more than one line: a paragraph in its own block brings
   the paragraphs beside it, however short.

A narrow map over whole pages; no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_or_empty

SIGMA, REACH = 1.0, 2

_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = set("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
section summary table tbody td textarea tfoot th thead title tr ul br""".split())
_GROUP = set("body div section td html center".split())
_MAIN = {"article", "main"}
_NEVER_TAG = set("""head script style noscript template nav footer aside button select option textarea input iframe object
svg math canvas audio video menu dialog search label fieldset title""".split())
_NEVER_ROLE = set("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words in a class or id that mark parts outside the article; fixed values.
_NEVER_NAME = set("""ad ads adv advert adverts advertisement advertising adsense adslot banner sponsor sponsored sponsors promo
promotion promoted cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription
signup login sidebar sidebars sidenav rail aside widget widgets menu menus nav navbar navigation navi breadcrumb breadcrumbs topbar
masthead footer foot footers colophon copyright alert alerts announcement announcements paywall disclaimer toast teaser
teasers trending comment comments commentlist discussion disqus replies respond share
sharing social related recommended recommendations pagination pager toolbar search searchbox form skip skiplink tags""".split())
_HEADER_NAME = {"header", "headers", "siteheader", "pageheader"}
_COMMENT_NAME = {"comment", "comments", "commentlist", "reply", "replies", "discussion", "respond"}
#: Names of blocks whose articles are other people's or other pages' texts.
_OTHER_NAME = _COMMENT_NAME | set("disqus related recommended recommendations teaser teasers trending".split())
#: Words that may stand beside a name in one class or id (place, shape, what it belongs to): ``left-sidebar``, ``ad-box``.
#: Any other word makes it tell of something else: ``has-sidebar``, ``no-sidebar``, ``layout-sidebar-right``, ``search-term``.
_BESIDE = set("""left right top bottom upper lower side main primary secondary tertiary first last site page post posts article articles
entry story stories blog reader readers user users visitor visitors guest member thread threads law info leaderboard box block blocks area areas zone slot slots unit container containers wrap wrapper wrappers inner outer holder
panel bar list lists item items section group row column col button buttons icon icons link links title heading text message
policy image label cloud trail mobile desktop sticky fixed floating global local div gpt google dfp wp js id count author body""".split())
#: Names that stay names beside ``content``, which else tells of the article: ``related-content`` but not ``content-sidebar``.
_CONTENT_TOO = _OTHER_NAME | set("ad ads advert sponsored promoted footer modal popup".split())
#: Controls of a form. A form with so many characters of text for each control and one more, or with an article in it,
#: is a page that stands in a form; others are forms.
_CONTROLS = {"input", "select", "textarea", "button"}
FORM_CHARS = 120
#: Parts that may hold reader comments, and what one comment stands in.
_THREADS, _ITEMS = set("div section ul ol table".split()), set("div li article section tr".split())
_CLOSED_BY = {"p": _BLOCK - {"br"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
              "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "head": {"body"}}
_ALL_NAMES = _NEVER_NAME | _HEADER_NAME | _COMMENT_NAME
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class _Lines(HTMLParser):
    """Collects the lines of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, bool]] = []  # text, link characters, tags, container, in article or main
        # tag, never content, container, in main, form, thread
        self.open: list[tuple[str, int, int, bool, int, int]] = [("", 0, 0, False, 0, 0)]
        self.mains: set[int] = set()  # containers that are a main
        self.within: list[tuple[int, int]] = []  # form and thread of each line; 0 is none
        self.forms = [[0, 0, False]]  # characters, controls, whether an article stands in it
        self.starts = [0]  # where in ``open`` each such part stands
        self.threads: list[dict[str, int]] = [{}]  # blocks of each shape right in a part whose name may tell of comments
        self.parts: list[str] = []
        self.around = [0]  # the container around each container
        self.link_chars = self.tags = self.links = 0

    def _names(self, attrs) -> set[str]:
        """Names among the classes and the id; one counts only if no other word stands beside it than a place or a shape."""
        names = set()
        for token in " ".join(v for k, v in attrs if k in ("class", "id") and v).split():
            words = {x.lower() for x in _NAME.findall(token)}
            own = words & _ALL_NAMES
            ends = own & _CONTENT_TOO or token.lower().endswith("content")  # sidebar-content, but not content-sidebar
            others = words - own - _BESIDE - ({"content"} if ends else set())
            if not any(len(x) > 1 and not x.isdigit() for x in others):
                names |= own
        return names

    def _never(self, tag, attrs, in_main: bool) -> int:
        """0 for content; an article counts again in what is hidden by name (1), a main also among other texts (2), none in the rest (3)."""
        if tag in _NEVER_TAG or (tag == "header" and not in_main):
            return 3
        if not attrs or tag in ("html", "body"):
            return 0
        if tag in _MAIN:
            return 2 if self._names(attrs) & _COMMENT_NAME else 0
        if any(k == "hidden" or (k == "aria-hidden" and v == "true") or (k == "role" and (v or "").lower() in _NEVER_ROLE)
               or (k == "style" and v and "display:none" in v.replace(" ", "").lower()) for k, v in attrs):
            return 3
        names = self._names(attrs) if tag in _BLOCK else ()  # inline parts of a sentence are never known by name alone
        if not names:
            return 0
        if names & _NEVER_NAME or (not in_main and names & _HEADER_NAME):
            return 2 if names & _OTHER_NAME else 1
        return 0

    def _end_line(self):
        _, never, container, in_main, form, thread = self.open[-1]
        text = " ".join("".join(self.parts).split()) if self.parts else ""
        if text:
            self.lines.append(("" if never else text, self.link_chars, self.tags, container, in_main))
            self.within.append((form, thread))
            self.forms[form][0] += 0 if never else len(text)
            self.tags = 0
        self.parts, self.link_chars = [], 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        if tag in _BLOCK:
            self._end_line()
        if tag in _CONTROLS and dict(attrs).get("type") != "hidden":
            self.forms[self.open[-1][4]][1] += 1
        if tag == "br" or tag in _VOID:
            return
        while len(self.open) > 1 and tag in _CLOSED_BY.get(self._top_block(), ()):
            self._close(self._top_block())
        _, never, container, in_main, form, thread = self.open[-1]
        hidden = self._never(tag, attrs, in_main)
        if not (tag == "main" and never < 3 or tag == "article" and never == 1 and all(t[0] != "article" for t in self.open)):
            hidden = max(hidden, never)
        if bool(hidden) != bool(never) and self.parts:
            self.parts, kept = [], self.parts
            if not never:  # text before an inline part that is never content stays in its line
                self.parts = kept
                self._end_line()
        if tag in _MAIN:
            container, in_main = self._container(container), True
            self.forms[form][2] = True
            if tag == "main":
                self.mains.add(container)
        elif tag in _GROUP and not in_main and (tag != "section" or self._top_block() in ("body", "html", "")):
            container = self._container(container)
        if tag == "form":
            self.forms.append([0, 0, False])
            form = len(self.forms) - 1
        self.open.append((tag, hidden, container, in_main, form, self._thread(tag, attrs, thread)))
        self.links += tag == "a"

    def _thread(self, tag, attrs, thread: int) -> int:
        """The part a new element belongs to whose name has a word for comments among others; its items are counted."""
        if thread:
            depth = len(self.open) - self.starts[thread]      # 1: right in the part; 2: in a list right in it
            if tag in _ITEMS and (depth == 1 or depth == 2 and self.open[-1][0] in ("ul", "ol", "table")):
                shape = f"{tag} {dict(attrs).get('class')}"
                self.threads[thread][shape] = self.threads[thread].get(shape, 0) + 1
            return thread
        if tag in _THREADS and any({x.lower() for x in _NAME.findall(v)} & _COMMENT_NAME for k, v in attrs if k in ("class", "id") and v):
            self.threads.append({})
            self.starts.append(len(self.open))
            return len(self.threads) - 1
        return 0

    def _container(self, around: int) -> int:
        self.around.append(around)
        return len(self.around) - 1

    def _top_block(self) -> str:
        for tag, *_ in reversed(self.open):
            if tag in _BLOCK or not tag:
                return tag
        return ""

    def _close(self, tag):
        self._end_line()
        while True:
            gone = self.open.pop()[0]
            self.links -= gone == "a"
            if gone == tag:
                return

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in _VOID:
            return
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] == tag:
                if tag in _BLOCK or any(t in _BLOCK for t, *_ in self.open[k:]) or bool(self.open[k][1]) != bool(self.open[k - 1][1]):
                    self._close(tag)
                else:
                    del self.open[k]
                    self.links -= tag == "a"
                return
            if self.open[k][0] in _BLOCK and tag not in _BLOCK:
                return  # an inline end tag closes nothing outside its block

    def handle_data(self, data):
        if not self.open[-1][1]:
            self.parts.append(data)
            if self.links:
                self.link_chars += len(data)
        elif not self.parts and not data.isspace():
            self.parts.append("x")  # a line that is never content still counts as a line

    def parse_html_declaration(self, i):
        """``<![...`` is a comment up to the next ``>``, as in browsers: the library's parser raises at most of them."""
        if not self.rawdata.startswith("<![", i):
            return super().parse_html_declaration(i)
        return self.rawdata.find(">", i) + 1 or len(self.rawdata)

    def finish(self):
        """The lines; those in forms, and in parts that hold comments by their name and their repeated items, without text."""
        self.close()
        self._end_line()
        forms = {k for k, (chars, controls, article) in enumerate(self.forms)
                 if k and not article and chars < FORM_CHARS * (controls + 1)}
        threads = {k for k, shapes in enumerate(self.threads) if max(shapes.values(), default=0) > 1}
        return [("", *x[1:]) if form in forms or thread in threads else x for x, (form, thread) in zip(self.lines, self.within)]


def smoothed(ratios: np.ndarray) -> np.ndarray:
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    return np.convolve(ratios, kernel / kernel.sum(), mode="full")[REACH:-REACH] if len(ratios) else ratios


def _held(lines, around: list[int], over: np.ndarray, ratios: np.ndarray, threshold: float) -> set[int]:
    """Lines in the blocks that clusters (runs of lines ``over`` the threshold) select on a page without marked parts.

    The lines that are over it by themselves lie inside; one that is so by its neighbours alone may belong to the next
    block. Blocks of mere links (menus) come along only between such lines.
    """
    inside, count = [False] * len(around), [0] * len(around)
    talking = {x[3] for x in lines if 2 * x[1] < len(x[0])}
    for x in lines:
        count[x[3]] += bool(x[0])
    for c in range(len(around) - 1, 0, -1):  # a container is opened after the one around it
        count[around[c]] += count[c]
    between: set[int] = set()
    edges = np.flatnonzero(np.diff(np.concatenate([[False], over, [False]])))
    for first, last in zip(edges[::2].tolist(), edges[1::2].tolist()):
        strong = [k for k in range(first, last) if ratios[k] > 0 and ratios[k] >= threshold]
        if not strong:
            continue
        low, high = min(lines[k][3] for k in strong), max(lines[k][3] for k in strong)
        while low != high:  # containers are numbered as they open: what holds the first and the last holds all
            if low > high:
                low = around[low]
            else:
                high = around[high]
        while low and count[low] == 1:
            low = around[low]
        inside[low] = True
        between.update(range(strong[0], strong[-1]))
    for c in range(1, len(around)):
        inside[c] |= inside[around[c]]
    return {k for k, x in enumerate(lines) if inside[x[3]] and (x[3] in talking or k in between)}


def main_text(html: str) -> str:
    """The article of one page; empty if it has none. Broken markup never fails: what the parser gives is used. Of lines
    that tie for the highest value where none is over the threshold, the first is taken."""
    parser = _Lines()
    parser.feed(html)
    lines = parser.finish()
    if not any(x[0] for x in lines):
        return ""
    ratios = np.array([max(len(t) - a, 0) / max(tags, 1) if t else 0.0 for t, a, tags, _, _ in lines])
    smooth = smoothed(ratios)
    threshold = min(float(smooth.std()), float(smooth.max()) / 2)
    usable = [k for k, x in enumerate(lines) if x[0]]
    marked = [k for k in usable if lines[k][4]]
    over = [k for k in marked or usable if smooth[k] >= threshold and ratios[k] > 0]
    chosen = {lines[k][3] for k in over or [max(marked or usable, key=lambda k: (smooth[k], -k))]}
    if marked:
        # what stands before an article right in its main (title, byline) belongs to it
        first = {c: next(k for k in marked if lines[k][3] == c) for c in chosen}
        mains = {parser.around[c]: k for c, k in sorted(first.items(), key=lambda x: -x[1]) if parser.around[c] in parser.mains}
        return " ".join(lines[k][0] for k in marked if lines[k][3] in chosen
                        or k < mains.get(lines[k][3], 0) and 2 * lines[k][1] < len(lines[k][0]))
    held = _held(lines, parser.around, smooth >= threshold, ratios, threshold)
    return " ".join(lines[k][0] for k in usable if lines[k][3] in chosen or k in held)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, ``text`` and ``n_chars`` (code points) per row of ``df``.

    Null or empty html, and pages without content, give an empty text; other columns are ignored; repeated rows
    stay; an empty table gives an empty result.
    """
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("url", df.schema[url_col].dataType),
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                texts = [main_text(h or "") for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()),
                                                  pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html"))
    return pages.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, "url": url_col})
