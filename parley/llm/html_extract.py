"""Main text of web pages by maximum-scoring subsequence.

A page is a sequence of words and tags, read in one pass. Both have scores,
logarithms of odds counted on labelled pages (``LABELLED``: templates of pages
of many makes, each part marked as content or not): a word's is positive, a
tag's never is, so words join a region and tags part it: a list of short links
costs more than its words are worth, a paragraph with a link does not. Where
the names of enclosing elements (tag, class, id, role) speak for content, words
count more; where they speak against it, words count against it. One linear
scan (Kadane's) finds the contiguous region of the highest score.

Two rules keep the article whole and clean, since one region alone can't: a
block whose elements speak against content (an advert between two paragraphs)
costs the region nothing if it stands between two parts of one content parent,
and is left out of its text. Nothing else is dropped and nothing is capped.

Every step is linear in the page, also for markup that never closes.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from parley.llm.session import ship

#: Elements whose inside is no markup, and never text of the page.
RAW = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)[^>]*+>?", re.I) for t in "script style noscript template textarea iframe svg select title".split()}
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: One attribute, or the end of the tag; a page that ends before is cut off inside the tag.
ATTRIBUTE = re.compile(r"[\s/]*+(?:(>)|(?:([^\s/>=][^\s/>=]*+)|=)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>]*+)))?+)")
NAMES = frozenset("class id role itemprop aria-label".split())
#: A reference to a character by a number beyond any; it is no character.
BEYOND = re.compile(r"&#[0-9]{1000,}+;?")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SPACE = re.compile(r"\s+")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag closes by itself when it is still open.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
P_CLOSERS = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Where implied ends do not reach beyond.
SCOPE = frozenset("article aside blockquote body div dl footer form header main nav ol section table ul".split())

_ARTICLE = "<h1>{w}</h1><p>{w} {w} {w}</p><p>{w} <b>{w}</b> {w} <a href=x>{w}</a> {w}</p><h2>{w}</h2><ul>{l}{l}{l}</ul><blockquote><p>{w} {w}</p></blockquote><ol>{l}{l}</ol><ul><li>{w}</li><li>{w}</li></ul><pre>{w}</pre><p>{w} {w}<br>{w}</p><div>{w} {w}</div><div>{s}</div><table><tr><td>{s}</td><td>{s}</td></tr><tr><td>{s}</td><td>{s}</td></tr></table>"
_MENU = "<ul><li><a href=x>{w}</a></li><li><a href=x>{w}</a></li><li><a href=x>{w}</a></li><li><a href=x>{w}</a></li><li><a href=x>{w}</a></li></ul>"
_BARE = ("{m}", "<div>{m}</div>", "<div><a href=x>{w}</a><a href=x>{w}</a><a href=x>{w}</a></div>", "<table><tr><td><a href=x>{w}</a></td><td><a href=x>{w}</a></td></tr></table>", "<p><a href=x>{w}</a> | <a href=x>{w}</a></p>")
_AROUND = (
    "<nav>{m}</nav>", "<nav class=menu>{m}</nav>", "<header><a href=x>{w}</a>{m}</header>", "<header class='site header top'><p>{w}</p></header>", "<div class='menu navbar nav navigation'>{m}</div>",
    "<div id=sidebar class='sidebar side widget'>{m}<p>{w}</p></div>", "<aside>{m}<p>{w}</p></aside>", "<aside class='related recommended'><h3>{w}</h3>{m}</aside>", "<div class='ad'>{w} {w}</div>", "<div class='ads advert advertisement sponsored sponsor promo promotion'><p>{w} {w}</p></div>",
    "<div class='cookie consent notice banner gdpr alert popup modal overlay'><p>{w} {w}</p><button>{w}</button></div>", "<div role=alert class=notice>{w}</div>", "<form><label>{w}</label><input><button>{w}</button></form>", "<div class='newsletter subscribe signup'><form>{w}<input></form></div>",
    "<div class='share social sharing'>{m}</div>", "<div class='breadcrumb breadcrumbs'><a href=x>{w}</a></div>", "<section id=comments class='comments comment discussion replies reply disqus'><h3>{w}</h3><div class=comment><p>{w} {w}</p></div></section>",
    "<ol class='comment list'><li class=comment><p>{w} {w}</p></li></ol>", "<footer>{w} {w}</footer>", "<footer class='site footer copyright legal'><p>{w}</p>{m}</footer>", "<div id=footer class='footer bottom'>{w}</div>", "<div class='pagination pager'><a href=x>{w}</a></div>",
    "<div class='login search toolbar'><form><input>{w}</form></div>", "<menu><li>{w}</li></menu>", "<dialog>{w}</dialog>", "<div role='navigation complementary contentinfo search'>{m}</div>",
)
_INNER = ("<article>{a}</article>", "<main>{a}</main>", "<main><article class='post entry content'>{a}</article></main>", "<div id=content class='content main article body text'>{a}</div>", "<div class='post body'>{a}</div>", "<section class=story>{a}</section>", "<div>{a}</div>", "{a}", "<article><div itemprop='article body'>{a}</div></article>", "<div role=main>{a}</div>", "<div class='site content page top bottom side list wrapper container legal'>{a}</div>", "<section class='text'><h3>{w}</h3><ol><li>{w} {w}</li></ol>{a}</section>")


def LABELLED() -> list[list[tuple[str, bool]]]:
    """Labelled pages: lists of (markup, whether it is content), in page order."""
    fill = lambda s: s.format(w="word word", m=_MENU.format(w="word"), a=_ARTICLE.format(w="word word word word word", s="word", l="<li>word</li>" * 3))
    pages = []
    for i, inner in enumerate(_INNER):
        for k in range(len(_AROUND)):
            a, b, c, d = (_AROUND[x % len(_AROUND)] for x in (k, k + i + 1, k + 2 * i + 3, k + 5))
            pages.append([(fill(a), False), (fill(_BARE[k % len(_BARE)]), False), (fill(b), False), (fill(inner), True), (fill(c), False), (fill(d), False)])
    return pages


def marks(tag: str, names: list[str]) -> tuple[str, ...]:
    """What an element tells about its inside: its name, and the parts of its class, id and role names."""
    return (f"<{tag}>", *(p.lower() for x in names for p in PART.findall(x)))


class Node:
    """An element that makes blocks, and what its names and those around it say."""

    __slots__ = ("tag", "what", "parent", "depth", "start", "end", "best", "worst", "good", "against", "apart")

    def __init__(self, tag: str, what: tuple[str, ...], parent: Node | None, start: int, odds: dict[str, float]) -> None:
        self.tag, self.what, self.parent, self.start, self.end = tag, what, parent, start, 0
        self.depth = parent.depth + 1 if parent else 0
        self.best = self.worst = 0.0
        for x in what:
            if x not in STRUCTURE and (v := odds.get(x, 0.0)):
                self.best, self.worst = max(self.best, v), min(self.worst, v)
        self.good, self.against, self.apart = what[:1] in GOOD, None, None if tag in TEXTUAL else self
        if tag in ("body", "html"):  # their names are the whole page's
            self.best = self.worst = 0.0
        if parent:
            self.best, self.worst, self.good = max(self.best, parent.best), min(self.worst, parent.worst), self.good or parent.good
            # The outermost element that speaks against content, and the innermost one that is no part of running text.
            self.against, self.apart = parent.against, self.apart or parent.apart
        if self.against is None and self.worst < AGAINST:
            self.against = self

    def holds(self, other: Node) -> bool:
        """Whether the other is this element or inside it; both are closed."""
        return self.start <= other.start and other.end <= self.end


def scan(page: str, odds: dict[str, float]) -> Iterator[tuple[str, object, Node]]:
    """The page as ("text", run of text, its node), ("open", tag, its node or the one around) and ("close", tag, the one around).

    The stack has (tag, node or None for elements inside a line); ``scopes``
    counts the tags that are open since the last element that implied ends do
    not cross, so no end tag looks through the stack in vain.
    """
    root = Node("html", (), None, 0, odds)
    stack: list[tuple[str, Node | None]] = []
    scopes, total = [Counter()], Counter()
    node, clock, at, n = root, 0, 0, len(page)

    def pop() -> str:
        nonlocal node, clock
        tag, made = stack.pop()
        total[tag] -= 1
        if tag in SCOPE:
            scopes.pop()
        scopes[-1][tag] -= 1
        if made is not None:
            clock += 1
            made.end, node = clock, made.parent
        return tag

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            yield "text", page[at:lt], node
        at = lt
        if at >= n:
            break
        m = TAG.match(page, at)
        if m is None:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                at = n if end < 0 else end + 3
            elif page[at + 1 : at + 2] in ("!", "?", "/"):
                end = page.find(">", at)
                at = n if end < 0 else end + 1
            else:
                yield "text", "<", node
                at += 1
            continue
        at, names, closed, own = m.end(), [], False, False
        tag = m[2].lower()
        while at < n:
            a = ATTRIBUTE.match(page, at)
            if a is None:  # only white space and strokes up to the end of the page
                break
            own, at = page.startswith("/", a.start(1) - 1) if a[1] else False, a.end()
            if a[1]:
                closed = True
                break
            if a[2] and a[2].lower() in NAMES:
                names.append(a[3] or a[4] or a[5] or "")
        if not closed:
            break  # the page ends inside a tag, which then is none
        if m[1]:
            if (scopes[-1] if tag in INLINE or tag in ("p", "li") else total)[tag] > 0:
                while pop() != tag:
                    pass
            yield "close", tag, node
            continue
        if tag in RAW:
            end = RAW[tag].search(page, at)
            at = n if end is None else end.end()
            yield "open", tag, node
            continue
        if tag in P_CLOSERS and scopes[-1]["p"] > 0:
            while pop() != "p":
                pass
        for t in CLOSES.get(tag, ()):
            while scopes[-1][t] > 0:
                while pop() != t:
                    pass
        if tag in VOID or own:
            yield "open", tag, node
            continue
        made = None
        if tag not in INLINE:
            clock += 1
            made = node = Node(tag, marks(tag, names), node, clock, odds)
        stack.append((tag, made))
        total[tag] += 1
        scopes[-1][tag] += 1
        if tag in SCOPE:
            scopes.append(Counter())
        yield "open", tag, node
    while stack:
        pop()
    root.end = clock + 1


def fit(pages: list[list[tuple[str, bool]]]) -> tuple[dict[str, float], dict[str, float], float]:
    """Log odds of the marks around words, scores of tags, and of a word, from labelled pages.

    Scores are fitted on what the names say nothing against: there they decide.
    """
    inside, outside, tags_in, tags_out = Counter(), Counter(), Counter(), Counter()
    for page in pages:
        for markup, content in page:
            for kind, value, node in scan(markup, {}):
                if kind == "text":
                    seen: set[str] = set()
                    while node is not None:
                        seen.update(node.what)
                        node = node.parent
                    for mark in seen:
                        (inside if content else outside)[mark] += len(value.split())
    odds = {x: math.log((inside[x] + 0.5) / (outside[x] + 0.5)) for x in inside | outside}
    words_in = words_out = 0
    for page in pages:
        for markup, content in page:
            for kind, value, node in scan(markup, odds):
                if kind == "text" and not node.against:
                    n = len(value.split())
                    words_in, words_out = words_in + n * content, words_out + n * (not content)
                elif kind == "open" and not node.against:
                    (tags_in if content else tags_out)[value] += 1
    share = math.log((words_out + tags_out.total() + 0.5) / (words_in + tags_in.total() + 0.5))
    tags = {x: min(LEAST, math.log((tags_in[x] + 0.5) / (tags_out[x] + 0.5)) + share) for x in tags_in | tags_out}
    return odds, tags, max(-LEAST, math.log((words_in + 0.5) / (words_out + 0.5)) + share)


_model: list[tuple[dict[str, float], dict[str, float], float]] = []


def model() -> tuple[dict[str, float], dict[str, float], float]:
    """Weights of the labelled pages, fitted once per process."""
    if not _model:
        _model.append(fit(LABELLED()))
    return _model[0]


#: Scores of tags at most: they always part regions, if only a little.
LEAST = -0.01
#: Log odds from which an element's names speak against content.
AGAINST = -1.0
#: Elements of any page's structure: they score as tags, and say nothing about the words inside.
STRUCTURE = frozenset(f"<{t}>" for t in "p div ul ol li table tr td th tbody thead h1 h2 h3 h4 h5 h6 section body html blockquote pre dl dt dd figure figcaption".split())
GOOD = frozenset({("<article>",), ("<main>",)})
#: Elements that a part of running text may be in without being apart from its neighbours.
TEXTUAL = frozenset("p ul ol li table tr td th tbody thead h1 h2 h3 h4 h5 h6 blockquote pre dl dt dd figure figcaption code".split())


def weight(node: Node, word: float) -> float:
    """Score of a word in this element: the strongest voice against, else a word's with the strongest for content."""
    return node.worst if node.against else word + node.best


def _beside(block: Node, left: Node, right: Node) -> bool:
    """Whether a block against content stands between two parts of one content parent."""
    parent = block.against.parent
    if not (parent.holds(left) and parent.holds(right)):
        return False
    if all(x.apart is None or x.apart.depth <= parent.depth for x in (left, right)):
        return True
    return parent.good or parent.best > 0 and left.best == right.best


def blocks_of(page: str, fitted: tuple[dict[str, float], dict[str, float], float]) -> list[list]:
    """Blocks in page order: text (empty for a tag that speaks against content), node, score of the tags before it, its own.

    A block is a run of text between tags that are not inside a line.
    """
    odds, tags, word = fitted
    out: list[list] = []
    text: list[str] = []
    around, cost, before = None, 0.0, 0.0

    def flush() -> None:
        nonlocal before, cost
        if text:
            joined = SPACE.sub(" ", "".join(text)).strip()
            if joined:
                out.append([joined, around, before, cost + weight(around, word) * (joined.count(" ") + 1)])
                before = 0.0
            text.clear()
        cost = 0.0

    for kind, value, node in scan(page, odds):
        if kind == "text":
            if text or not value.isspace():
                if not text:
                    around = node
                text.append(html.unescape(BEYOND.sub("\ufffd", value)))
        elif value in INLINE:
            if kind == "open" and not node.against:
                cost += tags.get(value, LEAST)
        else:
            flush()
            if kind == "open" and value not in VOID and not node.against:
                before += tags.get(value, LEAST)
            elif kind == "open" and node.against is node and node.tag == value:
                out.append(["", node, 0.0, node.worst])
    flush()
    return out


def region(blocks: list[list]) -> tuple[int, int]:
    """First and last (exclusive) of the contiguous blocks with the highest score; the first of equal ones."""
    scores = [(tags, own) for _, _, tags, own in blocks]
    left = None
    for k, (_, node, _, _) in enumerate(blocks):
        if not node.against:
            if left is not None and left + 1 < k and all(_beside(x[1], blocks[left][1], node) for x in blocks[left + 1 : k]):
                scores[left + 1 : k] = [(0.0, 0.0)] * (k - left - 1)
            left = k
    best, found, total, start = 0.0, (0, 0), 0.0, 0
    for k, (tags, own) in enumerate(scores):
        total += tags
        if total <= 0:  # a region starts with a word
            total, start = 0.0, k
        total += own
        if total > best:
            best, found = total, (start, k + 1)
    return found


def extract(page: str | None) -> str:
    """Main text of a page; empty for a null or empty page and one without content."""
    blocks = blocks_of(page or "", model())
    return " ".join(t for t, node, _, _ in blocks[slice(*region(blocks))] if not node.against)


def main_text(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``page_id, url, html``.

    Null and empty pages have an empty text. Repeated rows are read each; other
    columns are ignored. Markup that is cut off ends with the page; of regions
    with equal scores the first is taken. Pages of any length are read whole.
    """
    ship(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(h) for at in range(0, b.num_rows, 256) for h in b.column("html").slice(at, 256).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
