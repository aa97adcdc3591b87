"""Main text of web pages (operator 6): flat text blocks, their word counts and
link densities and those of their neighbours, classified by a decision tree.

A page is cut at block-level tags into flat blocks of text. Each has features: its
words and link density, those of the block before and after, whether it is a
heading, and how it stands in the page (inside an article or main element; inside
a menu, header, footer, sidebar, form or an element with a class, id or role that names
such a thing, unless an article or main element begins nearer; all words of such a name
are names of these or neutral, so ``cookie-notice`` and ``main-nav`` count, states of
a wrapper such as ``nav-open`` or ``has-sidebar`` do not; paragraphs and list
items have such names too, inline elements have not). A tree trained on ``LABELLED``, a small table of labelled pages, decides
which blocks are main text. Scripts, styles, markup and comments never are.

Character references are decoded, white space inside a block becomes one space,
blocks are joined in page order by two line feeds; nothing else is cut. One narrow
pass over the pages, page by page; nothing is shuffled.

Defined cases: null or empty html, or a page without main text, gives an empty
text; unclosed and stray tags are tolerated (script, style, title, textarea and comments run
to the end of the page then, other elements without text end at the next block), a tag
cut off at the end of the page is dropped; very long pages are handled whole, one at a
time; repeated rows are treated alike.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyload.llm import common as C

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|title|textarea)\b[^>]*>.*?(?:</(?P=raw)\b[^>]*(?:>|\Z)|\Z)"
    r"|<(?P<part>noscript|template|iframe|object|svg|select|button)\b(?P<inside>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?/a-z][^>]*(?:>|\Z)", re.I | re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
TOKEN = re.compile(r"[a-z]+")
# Elements that hold no markup of the page's text end at the next block tag if they are not closed before; the others may hold any.
PLAIN_PARTS = frozenset("svg select button".split())
BLOCK_TAGS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th
thead tr ul""".split())
NESTED = frozenset("article aside blockquote details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split())
AROUND_TAGS = frozenset("nav header footer aside form menu dialog".split())
AROUND_NAMES = frozenset("""ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus
footer header login masthead menu modal nav navbar navigation newsletter notice pagination popup promo related reply
share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split())
NEUTRAL_NAMES = frozenset("""area bar block bottom box buttons column container group inner item items left links list main panel post posts primary
right secondary section site top wrap wrapper""".split())
MAIN_TAGS = frozenset(["article", "main"])
BLOCK_EDGE = re.compile(r"</?(?:" + "|".join(sorted(BLOCK_TAGS - {"option"})) + r")(?=[\s/>])", re.I)
FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "heading", "main", "around")


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    main: bool
    around: bool

    @property
    def words(self) -> int:
        return self.text.count(" ") + 1


def _role(tag: str, rest: str) -> str:
    if tag in AROUND_TAGS:
        return "around"
    for found in NAMES.findall(rest.lower()) if rest else ():
        for name in " ".join(found).split():
            words = set(TOKEN.findall(name))
            if words & AROUND_NAMES and words <= AROUND_NAMES | NEUTRAL_NAMES:
                return "around"
    return "main" if tag in MAIN_TAGS else ""


class Parts:
    """Where the elements end whose content is no text of the page: at their end tag;
    of the plain ones, at a block tag if one comes first. Of the others, one without
    an end tag of its own is its start tag alone."""

    def __init__(self, html: str):
        self.html = html
        self.known: dict[str, re.Match | None] = {}

    def tag(self, name: str, at: int) -> re.Match | None:
        """The next start or end tag of this name; looked for once between two finds."""
        held = self.known.get(name, False)
        if held is False or held is not None and held.start() < at:
            self.known[name] = held = re.compile(rf"<(/?){name}\b[^>]*(?:>|\Z)", re.I).search(self.html, at)
        return held

    def end(self, name: str, at: int) -> int:
        nearest = self.tag(name, at)
        closed = nearest is not None and nearest[1] == "/"
        if name not in PLAIN_PARTS:
            return nearest.end() if closed else at
        edge = BLOCK_EDGE.search(self.html, at, nearest.start() if closed else len(self.html))
        if edge is not None:
            return edge.start()
        return nearest.end() if closed else len(self.html)


def blocks(html: str) -> list[Block]:
    """The flat text blocks of a page, in page order."""
    out: list[Block] = []
    pieces: list[tuple[str, bool]] = []
    stack: list[tuple[str, str]] = []
    at, link, heading, role = 0, False, False, ""

    def close() -> None:
        if pieces:
            text = " ".join(unescape("".join(p for p, _ in pieces)).split())
            if text:
                linked = len(" ".join(unescape("".join(p for p, is_link in pieces if is_link)).split()))
                roles = [r for r in (*(r for _, r in stack), role) if r]
                out.append(Block(text, linked, heading, "main" in roles, roles[-1:] == ["around"]))
            pieces.clear()

    parts = Parts(html)
    while found := MARKUP.search(html, at):
        if found.start() > at:
            pieces.append((html[at: found.start()], link))
        at = found.end()
        if found["part"]:
            if not found["inside"].endswith("/"):
                at = parts.end(found["part"].lower(), at)
            continue
        tag = (found["tag"] or "").lower()
        if tag == "a":
            link = not found["end"]
        elif tag == "br":
            pieces.append((" ", False))
        elif tag in BLOCK_TAGS:
            close()
            # a paragraph's role ends with it, an item's at the next one or the end of the list
            role = _role(tag, found["rest"]) if tag == "p" and not found["end"] else ""
            if tag == "li":
                inner = [t for t, _ in stack]
                last = max((k for k, t in enumerate(inner) if t in NESTED), default=-1)
                if "li" in inner[last + 1:]:
                    del stack[last + 1 + inner[last + 1:].index("li"):]
                if not found["end"]:
                    stack.append((tag, _role(tag, found["rest"])))
            elif tag in NESTED:
                if not found["end"]:
                    stack.append((tag, _role(tag, found["rest"])))
                elif any(t == tag for t, _ in stack):
                    while stack.pop()[0] != tag:
                        pass
                link = False
            heading = not found["end"] and tag[0] == "h" and tag[1:].isdigit()
    if at < len(html):
        pieces.append((html[at:], link))
    close()
    return out


def features(page: list[Block]) -> np.ndarray:
    own = np.array([(b.words, b.linked / len(b.text)) for b in page], np.float64).reshape(-1, 2)
    edge = np.zeros((1, 2))
    flags = np.array([(b.heading, b.main, b.around) for b in page], np.float64).reshape(-1, 3)
    return np.hstack([own, np.vstack([edge, own])[:-1], np.vstack([own, edge])[1:], flags])


class Tree:
    """A binary decision tree by Gini impurity, grown until leaves are pure."""

    def __init__(self, x: np.ndarray, y: np.ndarray, depth: int = 6):
        self.share = float(y.mean())
        self.split: tuple[int, float, Tree, Tree] | None = None
        if depth == 0 or self.share in (0.0, 1.0):
            return
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for limit in (values[1:] + values[:-1]) / 2:
                low = x[:, f] <= limit
                impurity = sum(s.sum() * (p := y[s].mean()) * (1 - p) for s in (low, ~low))
                if best is None or impurity < best[0] - 1e-12:
                    best = (impurity, f, float(limit))
        if best is None or best[0] >= len(y) * self.share * (1 - self.share) - 1e-12:
            return
        _, f, limit = best
        low = x[:, f] <= limit
        self.split = (f, limit, Tree(x[low], y[low], depth - 1), Tree(x[~low], y[~low], depth - 1))

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.split is None:
            return np.full(len(x), self.share)
        f, limit, below, above = self.split
        low = x[:, f] <= limit
        out = np.empty(len(x))
        out[low], out[~low] = below.predict(x[low]), above.predict(x[~low])
        return out


# Labelled pages: (mark, html) in page order; the mark tells main text (1) from the rest (0) for each block of the html.
LABELLED = [
    [("000", "<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a><li><a href=/a>About us</a></ul></nav>"),
     ("0", "<div class='ad'>Buy now and save a lot on all garden tools this week.</div>"),
     ("111", "<article><h1>Rain in the north</h1><p>It rained for three days in the north and rivers rose above their banks.</p><p>All was well.</p>"),
     ("1", "<p>People were told to stay at home until the water falls, which may take some days, officials of the county said today.</p>"),
     ("1", "<p>All rights reserved.</p></article>"),
     ("0", "<footer>&copy; news.example &middot; All about us and more of what we do here.</footer>")],
    [("00", "<header><a href=/>Daily paper</a><p>The paper for all of the city and the land around it.</p></header>"),
     ("111", "<main><h2>Market</h2><p>Prices rose again.</p><p>Bread costs more than a year ago, and so do milk, eggs and most fruit in the shops.</p>"),
     ("0", "<aside>Read also what our readers liked most in the past month.</aside>"),
     ("1", "<p>See <a href=/x>the table</a> for more.</p>"),
     ("1", "<p><a href=/r>The full report of the county on the floods of the spring</a></p></main>"),
     ("00", "<div id='comments'><p>I do not think so at all, prices were higher in the past than they are now.</p><p>Nice.</p></div>"),
     ("0", "<form><p>Enter your mail to get our letter each day for free.</p></form>")],
    [("00", "<div><a href=/1>Start</a></div><div><a href=/2>Contact</a> <a href=/3>Imprint</a></div>"),
     ("1", "<h1>The old mill</h1>"),
     ("1", "<div><p>The old mill at the end of the valley was built by two brothers who came over the hills with little more than tools.</p>"),
     ("1", "<p>They cut the wood for it in one winter and set the wheel in the next spring, when the stream ran high and cold.</p>"),
     ("1", "<p>It still turns today, though no corn has been ground there for more than sixty years, as the keeper told <a href=/k>us</a>.</p></div>"),
     ("0", "<div><a href=/4>More</a></div>"),
     ("0", "<div class='cookie-notice'>We use cookies to make this site better for you and for us, and you may say no at any time.</div>")],
    [("00", "<ul class='menu'><li><a href=/a>One</a><li><a href=/b>Two</a></ul>"),
     ("0", "<div><a href=/z>Overview of all our towns and the land around them</a></div>"),
     ("11", "<article><h1>Short</h1><p>Yes.</p>"),
     ("0", "<div class='share'><a href=/s>Share</a></div>"),
     ("11", "<p>A list of what you need: flour, salt, water and some time to let the dough rest in a warm place.</p><ul><li>Flour</li></ul>"),
     ("0", "<nav><a href=/p>Next page</a></nav></article>"),
     ("0", "<div class='sidebar'>The most read stories of the week are here for you to see, from all parts of the land.</div>"),
     ("0", "<footer>Made here.</footer>")],
    [("0", "<div class='content has-sidebar'><div class='sidebar'>What others read here this week, and what they said about it.</div>"),
     ("11", "<article><h1>Snow</h1><p>It snowed all night on the hills and roads were shut until the plough came at noon.</p>"),
     ("0", "<p class='ad'>Buy warm boots now and save a lot of money on all of them this week.</p>"),
     ("1", "<p>No one was hurt.</p></article></div>")],
    [("00", "<nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul>"),
     ("11", "<main><h1>Bridge</h1><p>The new bridge opens in May, a year later than the town had planned at first.</p></main>")],
]


def trained() -> Tree:
    rows, marks = [], []
    for page in LABELLED:
        found = blocks("".join(html for _, html in page))
        wanted = "".join(mark for mark, _ in page)
        if len(found) != len(wanted):
            raise ValueError("a labelled page has other blocks than marks")
        rows.append(features(found))
        marks += [m == "1" for m in wanted]
    return Tree(np.vstack(rows), np.array(marks, np.float64))


def main_text(html: str | None, tree: Tree) -> str:
    page = blocks(html or "")
    if not page:
        return ""
    return "\n\n".join(b.text for b, share in zip(page, tree.predict(features(page))) if share > 0.5)


def extract(pages: DataFrame, html_col: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``doc`` (a struct of the columns in ``keep``, all by default), ``text`` and
    ``n_chars`` (code points) of every row."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    C.ship(pages.sparkSession)
    own = pages.select(C.whole(pages, keep), C.as_bytes(html_col).alias("bytes"))
    out = StructType([own.schema["doc"], StructField("text", StringType()), StructField("n_chars", LongType())])
    arrow, tree = to_arrow_schema(out), trained()

    def run(batches):
        for batch in batches:
            texts = [main_text(raw.decode("utf-8", "replace"), tree) for raw in batch.column("bytes").to_pylist()]
            yield C.appended(batch, arrow, text=texts, n_chars=[len(t) for t in texts])

    return own.mapInArrow(run, out)
