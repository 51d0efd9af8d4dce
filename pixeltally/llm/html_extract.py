"""Main text of web pages by tag-path ratios.

Each block of text has a path of block tags from the root. Per path the text length and the
punctuation for each block are aggregated, smoothed over the page's blocks in order, fused,
and compared with a threshold: the blocks over it are content nodes. The article is the smallest
element that holds nearly all of their weight, but for the parts of it that hold none of them.
Tags and names are a prior: tags for menus and the like, and names that say nothing else, leave a block out
before paths are scored, but names do so only where an article stays.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# HTML's elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var nobr br wbr img area map picture".split())
RAW = "script|style|noscript|template|iframe|object|svg|textarea|title|head"
BOILERPLATE = frozenset("nav header footer aside form button select option label dialog menu fieldset legend".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# What text flows in; other elements are boxes that parts of a page are put in.
FLOW = HEADINGS | frozenset(
    "p ul ol dl li dt dd blockquote pre figure figcaption address details summary table caption colgroup thead tbody "
    "tfoot tr td th".split())
# Words of class, id and role attributes that name parts other than the article, and words that tell
# where or how such a part is. A name of words of both kinds alone is a part's; any other word makes it something else.
OTHER_PARTS = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments complementary "
    "consent contentinfo cookie cookies copyright dialog disqus footer gdpr header login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification overlay pagination paywall popup promo promotion promoted related "
    "replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget".split())
READERS = frozenset("comment comments disqus replies reply respond".split())
PLACES = frozenset(
    "area bar block bottom box button buttons container content entry first footer icons inner item items left link links list "
    "main module outer page panel post posts primary right row secondary section site top wrap wrapper".split())
ARTICLE_PARTS = frozenset("article articlebody".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>" + RAW + r")(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*+)(?P<attributes>(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-z][^>]*+>|<[!?][^>]*+>|(?P<text>[^<]++|<)", re.I | re.S)
_NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_PART = re.compile(r"[a-z]+|[A-Z][a-z]*")
_SPACE = re.compile(r"\s+")
_PUNCTUATION = re.compile(r"[.,;:!?…。、，！？]")


class Element:
    """An element of the page; it knows its parent, so that what blocks have in common is held once."""

    __slots__ = ("tag", "parent", "path", "box", "out", "outside", "article", "main", "named", "weight", "held")

    def __init__(self, tag: str, parent: Element | None, path: int):
        self.tag, self.parent, self.path = tag, parent, path
        self.box = parent.box if parent and tag in FLOW else self
        self.out = bool(parent and parent.out)          # left out by a tag, or hidden
        self.outside = None                             # for an article's header: the article
        self.article: Element | None = parent.article if parent else None   # the outermost marked article it is in
        self.main: Element | None = parent.main if parent else None
        self.named: tuple[tuple, ...] = parent.named if parent else ()      # names of other parts on the path
        self.weight = 0.0                               # of the content nodes below
        self.held = 0                                   # their number whose box it is


def element(tag: str, attributes: str, parent: Element | None, path: int) -> Element:
    found = Element(tag, parent, path)
    if tag in ("html", "body"):  # what the whole page is called says which parts it has, not that it is one
        return found
    names, marked = set(), tag == "article"
    for kind, *values in _NAMES.findall(attributes):
        for value in "".join(values).split():
            words = {word.lower() for word in _PART.findall(value)}
            if words & OTHER_PARTS and words <= OTHER_PARTS | PLACES:
                names |= words & OTHER_PARTS
            marked = marked or value.lower().replace("-", "") in ARTICLE_PARTS
    header = tag == "header" or names == {"header"}
    if header and found.article and not found.out:
        found.out, found.outside = True, found.article  # but for its headings
    elif tag in HEADINGS and parent and parent.outside:
        found.out = False
    elif tag in BOILERPLATE or _HIDDEN.search(attributes):
        found.out = True
    elif names:
        found.named = (*found.named, (tag, frozenset(names))) if (tag, frozenset(names)) not in found.named else found.named
    if parent and parent.outside and tag not in BOILERPLATE and not found.outside:
        found.outside = parent.outside
    if marked and not found.out:
        found.article = found.article or found
    if tag == "main" and not found.out:
        found.main = found.main or found
    return found


class Block:
    """A block of text: its element, and whether all of it is in links."""

    __slots__ = ("at", "text", "linked")

    def __init__(self, at: Element, text: str, linked: bool):
        self.at, self.text, self.linked = at, text, linked


def parse(page: str) -> tuple[list[Block], list[Element]]:
    """The page's blocks of text in order, white space as one space, character references decoded; and its elements."""
    top = Element("", None, 0)
    found: list[Block] = []
    elements, stack = [top], [top]
    paths: dict[tuple[int, str], int] = {}
    opened: Counter[str] = Counter()
    held: list[str] = []
    link = plain = False

    def flush() -> None:
        nonlocal link, plain
        if held:
            text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
            held.clear()
            if text:
                found.append(Block(stack[-1], text, not plain))
        link = plain = False

    def close() -> None:
        opened[stack.pop().tag] -= 1

    for token in _TOKEN.finditer(page):
        if (text := token["text"]) is not None:
            held.append(text)
            plain = plain or not link and not text.isspace()
            continue
        tag = token["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in INLINE:
            if tag == "br":
                held.append(" ")
            elif tag == "a":
                link = not token["end"]
            continue
        flush()
        if tag in VOID:
            continue
        if token["end"]:
            if opened[tag]:
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        # A block ends an open paragraph, and an item or cell ends its open neighbour.
        for closed in ("p",) + ((tag,) if tag in ("li", "dt", "dd", "tr", "td", "th", "option") else ()):
            if stack[-1].tag == closed:
                close()
        if token["attributes"].rstrip().endswith("/") and tag not in ("p", "div", "section", "article", "main", "body"):
            continue
        parent = stack[-1]
        path = paths.setdefault((parent.path, tag), len(paths) + 1)
        stack.append(element(tag, token["attributes"], parent, path))
        elements.append(stack[-1])
        opened[tag] += 1
    flush()
    return found, elements


def path_scores(page: list[Block], radius: int = 1) -> np.ndarray:
    """For each block its fused score: smoothed length and punctuation ratios of its path.

    Text that is in links counts for no path: menus are links, and an article's links stand in other text.
    """
    count: dict = defaultdict(int)
    length: dict = defaultdict(int)
    marks: dict = defaultdict(int)
    for block in page:
        count[block.at.path] += 1
        if not block.linked:
            length[block.at.path] += len(block.text)
            marks[block.at.path] += len(_PUNCTUATION.findall(block.text))
    ratios = np.array([(length[p] / count[p], (1 + marks[p]) / count[p]) for p in (block.at.path for block in page)])
    kernel = np.exp(-0.5 * np.arange(-radius, radius + 1) ** 2)
    kernel /= kernel.sum()
    padded = np.pad(ratios, ((radius, radius), (0, 0)), mode="edge")
    smooth = sum(k * padded[i:i + len(page)] for i, k in enumerate(kernel))
    # Own ratio and smoothed ratio together, so that a neighbour alone lifts nothing.
    return np.sqrt(ratios * smooth).prod(axis=1)


def over_threshold(page: list[Block], share: float) -> tuple[np.ndarray, np.ndarray]:
    """Scores, and which of them reach a share of the mean that the page's text has, character by character."""
    scores = path_scores(page)
    lengths = np.array([len(block.text) for block in page])
    return scores, scores >= share * np.average(scores, weights=lengths)


# Rounds in which names are taken back as those of wrappers; after them no name on the page counts.
WRAPPERS = 8


def without_named(page: list[Block], share: float) -> list[Block]:
    """The blocks that are in no part with another part's name, where such parts leave the article.

    They do if an article stays that the best block left out is not in, or if what stays has a path over the
    threshold and a tenth of the text or more. Else the names on the best block's path are those of
    wrappers and say nothing on this page; but a part of readers' comments is no wrapper where any other
    text stays, however long it is. On a page that marks articles only blocks in them count.
    """
    if not any(block.at.named for block in page):
        return page
    scores, over = over_threshold(page, share)
    marked = any(block.at.article for block in page)
    counted = [at for at, block in enumerate(page) if block.at.article or not marked]
    everything = sum(len(page[at].text) for at in counted)
    wrappers: set = set()
    for _ in range(WRAPPERS):
        stays = [wrappers.issuperset(block.at.named) for block in page]
        rest = [at for at in counted if stays[at] and page[at].at.tag not in HEADINGS]
        out = [at for at in counted if not stays[at]]
        if not out:
            break
        best = page[max(out, key=scores.__getitem__)].at
        apart = any(page[at].at.article and page[at].at.article is not best.article for at in rest)
        inside = best.article and any(page[at].at.article is best.article and over[at] for at in rest)
        enough = 10 * sum(len(page[at].text) for at in rest) >= everything and any(over[at] for at in rest)
        readers = rest and all(words <= READERS for _, words in set(best.named) - wrappers)
        if apart or enough and (inside or not best.article) or readers:
            break
        wrappers.update(best.named)
    else:
        return page
    return [block for block, held in zip(page, stays) if held]


def article(page: list[Block], elements: list[Element], share: float = 0.25) -> list[str]:
    """The texts of the article's blocks, in order."""
    page = without_named([block for block in page if not block.at.out], share)
    if any(block.at.article for block in page):
        return _marked([block for block in page if block.at.article], share)
    if any(block.at.main for block in page):
        page = [block for block in page if block.at.main]
    if not page:
        return []  # menus and the like only
    scores, over = over_threshold(page, share)
    for block, score, content in zip(page, scores, over):
        if content:
            block.at.weight += score * len(block.text)
            block.at.box.held += 1
    heaviest: dict[int, Element] = {}
    for node in reversed(elements):  # children come after their parents
        if node.parent:
            node.parent.weight += node.weight
            if node.weight > 0 and (id(node.parent) not in heaviest or node.weight > heaviest[id(node.parent)].weight):
                heaviest[id(node.parent)] = node
    root = elements[0]
    while id(root) in heaviest and heaviest[id(root)].weight >= 0.9 * root.weight and heaviest[id(root)].box is heaviest[id(root)]:
        root = heaviest[id(root)]
    inside = _below(root, elements)
    first, last = np.flatnonzero(over)[[0, -1]]
    spoken = {id(block.at.box) for block in page if not block.linked}
    kept = []
    for at, (block, content) in enumerate(zip(page, over)):
        if id(block.at) not in inside:
            continue
        # Beside the content nodes: what stands between them, and what shares a box with one; but no lists of links.
        between = first < at < last and (id(block.at.box) in spoken or block.at.box is root)
        beside = block.at.box.held and (not block.linked or block.at.tag in HEADINGS)
        if content or between or beside:
            kept.append(block.text)
    return kept


def _below(root: Element, elements: list[Element]) -> set[int]:
    """The elements in ``root``, itself included."""
    inside = {id(root)}
    for node in elements:
        if node.parent and id(node.parent) in inside:
            inside.add(id(node))
    return inside


def _marked(page: list[Block], share: float) -> list[str]:
    """All of the marked articles that have a path over the threshold, and of those beside them."""
    _, over = over_threshold(page, share)
    beside = {id(block.at.article.parent) for block, content in zip(page, over) if content}
    return [block.text for block in page if id(block.at.article.parent) in beside]


def main_text(page: str | None) -> str:
    return "\n\n".join(article(*parse(page or "")))


def extract(pages: DataFrame, page_html: str = "html", carry: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """The columns in ``carry``, ``text`` and ``n_chars``, one row per page.

    The whole page is read; nothing of the article is cut. A null or empty page, and one that
    has nothing but menus and the like, gives an empty text. Repeated rows give equal texts.
    Other columns are ignored. An empty table gives an empty result.
    """
    rows = pages.select(F.struct(F.lit(0).alias("no_column"), *carry).alias("carry"), F.col(page_html).alias("html"))

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py()) for value in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["carry", "text", "n_chars"])

    kind = rows.schema["carry"].dataType.simpleString()
    found = rows.mapInArrow(extracted, f"carry {kind}, text string, n_chars long")
    return found.select(*[F.col("carry")[name].alias(name) for name in carry], "text", "n_chars")
