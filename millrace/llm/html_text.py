"""Main text of HTML pages by tag-path ratios.

A page is read into text leaves, each with its root-to-leaf path of tags (and classes; inline tags are transparent).
Per path, text length and punctuation are summed and divided by the number of leaves; the two ratios are fused by
their product. Along the page, each leaf's value is smoothed with its neighbours', weighted by how much of the path
they share. Paths whose smoothed values reach the mean less a part of the spread are content. How far a leaf's smoothed
and own values lie above or below that threshold speaks for or against the elements around it: the article is the element
with the greatest sum, or the article and main elements with chosen leaves, where a page has such. There everything between
chosen leaves is kept, and what stands before or behind them unless its container has a poor sum; so are blocks from a
heading of the first level on where none lies inside. Link lists whose surroundings have no content are left out.

Names are a weight beside that: elements that say what they are (menus, page headers and footers, sidebars, adverts, notices,
forms, comments, scripts, styles) take no part. A name or form doesn't count where the element holds the article or main
element with the most text or, on pages without any, more than half of the page's text outside links and a heading of the
first level, if the page has one.

Inside an article or main element text blocks (paragraphs, headings, items, cells) are dropped only for names that are
adverts, comments or the like as a whole, and containers only where the name as a whole, its end, or its start before a
word for a container says so.

Null and empty pages, and pages with no text outside such elements, give the empty string. White space (also from
references and line breaks) inside a block becomes one space; blocks are joined in page order by one newline. Pages are
read in time linear in their length, whatever their markup: open tags, quotes and raw elements may never end, elements may
nest as deep as they like. Very long texts are kept whole. Rows are read one by one, so page_ids may be null or repeated;
an empty table gives no rows, and columns other than page_id, url and html are not looked at.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Leaves to each side that smooth a leaf; share of the spread that content must exceed; share of content that article elements need.
REACH, SPREAD, MOST = 2, 0.25, 0.8
#: A block with at least this share of its text in links may be part of a link list.
LINKS = 0.6

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
STOP = re.compile(r"[>\"']")
#: A name and its value; a match takes a whole name, so no character is tried twice.
ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
PUNCTUATION = re.compile(r"[.,;:!?…。，、！？；：]")

# HTML element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
NEVER = frozenset("aside button canvas dialog footer head menu nav object select audio video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search toolbar".split())
#: Parts of an article that aren't the whole of it, and those of them that make lists.
PARTS = frozenset("p li h1 h2 h3 h4 h5 h6 pre blockquote section ul ol dl dt dd table caption thead tbody tfoot tr td th figure figcaption".split())
LISTS = frozenset("li ul ol dl dt dd table thead tbody tfoot tr td th".split())
#: Words of class and id names that say an element isn't the article.
NAMES = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup paywall"
    " sidebar aside widget widgets rail menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toc masthead topbar header footer copyright legal disclaimer"
    " comment comments comentarios kommentare commentaires disqus reply replies respond discussion related recommended recommendations share sharing social login search form toolbar tags hidden".split()
)
#: Those of them that mark a text block inside an article as none of its own, where they are the whole name.
STRONG = frozenset("ad ads advert adverts advertisement adsense sponsor sponsored promo cookie cookies newsletter subscribe signup comment comments comentarios kommentare commentaires reply replies share sharing related recommended".split())
#: Names that say nothing at the start of a longer one inside an article, and words for containers that may follow the others.
WEAK = frozenset("header form tags hidden legal copyright notice search login".split())
HOLDERS = frozenset("area banner bar block box button buttons container content form group holder inner item items link links list module nav outer panel posts row section slot unit widget wrap wrapper".split())
#: Elements whose content is no markup.
RAW = {name: re.compile(f"</{name}(?=[\\s/>])", re.I) for name in "script style noscript template svg iframe textarea title xmp".split()}
TEXTS = frozenset("p li h1 h2 h3 h4 h5 h6 pre blockquote dt dd td th caption figcaption span a b i em strong".split())
#: Words before a name that say the element is only marked by it, and those whose headers belong to the article.
MODIFIERS = frozenset("has have no non not with without".split())
OWN_HEADERS = frozenset("article content entry page post story".split())
#: Opening one of these closes an open one of the others first, up to the nearest of the third.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}


class Element:
    """named: unwanted by class, id or as a form; size: characters outside links; owner: the nearest block; article: the
    outermost article or main element around; base: the nearest element that makes no list; n: chosen leaves inside."""

    __slots__ = ("tag", "parent", "path", "depth", "dropped", "named", "link", "block", "size", "owner", "article", "listed", "base", "n", "prose", "boxed", "titles", "score", "poor")

    def __init__(self, tag: str, parent: "Element | None", path: int, dropped: bool, named: bool, link: bool, block: bool):
        self.tag, self.parent, self.path, self.dropped, self.link, self.block = tag, parent, path, dropped, link, block
        self.named, self.size, self.n, self.prose, self.boxed = named, 0, 0, False, False
        self.titles, self.score, self.poor = int(tag == "h1"), 0.0, False
        self.depth = parent.depth + 1 if parent else 0
        self.owner = self if block else parent.owner
        self.article = (parent.article if parent else None) or (self if tag in ("article", "main") else None)
        self.listed = tag in LISTS or bool(parent and parent.listed)
        self.base = parent.base if tag in LISTS and parent else self


class Leaf:
    __slots__ = ("element", "text", "linked", "path")

    def __init__(self, element: Element, text: str, linked: int):
        self.element, self.text, self.linked, self.path = element, text, linked, element.path


def _up(e: Element | None) -> Iterator[Element]:
    """The element and those around it, inside out."""
    while e is not None:
        yield e
        e = e.parent


def _named(names: str, inside: bool, tag: str) -> bool:
    """Does one of the names say that the element isn't article text? inside: within an article or main element."""
    for name in names.split():
        words = [w for w in re.split(r"[^a-z]+", name) if w]
        if not words:
            continue
        if inside and tag in TEXTS:
            if len(words) == 1 and words[0] in STRONG:
                return True
            continue
        for k, word in enumerate(words):
            before = words[k - 1] if k else ""
            if word not in NAMES or before in MODIFIERS or word == "header" and (inside or before in OWN_HEADERS):
                continue
            if not inside or k == len(words) - 1 or k == 0 and word not in WEAK and words[-1] in HOLDERS:
                return True
    return False


def _unwanted(tag: str, attributes: str, inside: bool) -> tuple[bool, bool, str]:
    """(is the element none of the article's, does it only call itself so, its class)."""
    names, drop, named = "", tag in NEVER or tag == "header" and not inside, tag == "form"
    if attributes:
        for name, a, b, c in ATTRIBUTE.findall(attributes):
            name, value = name.lower(), (a or b or c).lower()
            if name in ("class", "id"):
                names += " " + value
            elif name == "role":
                drop |= value in ROLES
                named |= value == "form"
            elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                drop = True
    named = named or _named(names, inside, tag)
    return drop and tag not in ("html", "body", "article", "main"), named, names


def _settle(elements: list[Element]) -> None:
    """Drops what only calls itself unwanted, unless it holds the article; elements in page order."""
    if not any(e.named for e in elements):
        return
    for e in reversed(elements):
        if e.parent:
            e.parent.size += e.size
            e.parent.titles += e.titles
    titled = elements[0].titles
    articles = [e for e in elements if e.tag in ("article", "main") and not e.dropped and not e.named and e.size]
    kept = {id(e) for e in _up(max(articles, key=lambda e: e.size, default=None))}
    for e in elements:
        if e.parent and not e.dropped:
            own = e.named and e.tag not in ("html", "body", "article", "main") and id(e) not in kept
            e.dropped = e.parent.dropped or own and (bool(articles) or 2 * e.size <= elements[0].size or titled and not e.titles)


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, tag or text, attributes): kind is "" for text, "<" and "/" for tags. Every character is passed a bounded number of times."""
    at, quotes = 0, True
    while (start := page.find("<", at)) >= 0:
        if start > at:
            yield "", page[at:start], ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            if end < 0:
                return
            at = end + 3
            continue
        kind = page[start + 1 : start + 2]
        name = NAME.match(page, start + 1 + (kind == "/"))
        if not name and kind not in ("!", "?", "/"):
            yield "", "<", ""
            at = start + 1
            continue
        end = page.find(">", start)
        if end < 0:  # nothing behind is text
            return
        if name and quotes and kind != "/":
            far = _tag_end(page, name.end())
            if far is None:  # a quote that never ends: from here on quotes hide nothing
                quotes = False
            else:
                end = far
        at = end + 1
        if not name:
            continue
        tag = name[0].lower()
        yield ("/" if kind == "/" else "<"), tag, page[name.end() : end]
        if kind != "/" and tag in RAW:
            close = RAW[tag].search(page, at)
            at = page.find(">", close.start()) + 1 if close else 0
            if not at:
                return
            yield "/", tag, ""
    if at < len(page):
        yield "", page[at:], ""


def _tag_end(page: str, at: int) -> int | None:
    """The ">" that ends a tag, beyond quoted values."""
    while (found := STOP.search(page, at)) and found[0] != ">":
        at = found.start()
        before = at - 1
        while page[before].isspace():
            before -= 1
        if page[before] == "=":
            at = page.find(found[0], at + 1)
            if at < 0:
                return None
        at += 1
    return found.start() if found else None


def leaves(page: str) -> tuple[list[Leaf], list[Element]]:
    """Text blocks outside unwanted elements, and all elements, both in page order. Paths are numbered; an element knows its parent."""
    numbers: dict[tuple, int] = {}
    root = Element("", None, -1, False, False, False, True)
    top, found, buffer, elements = root, [], [], [root]
    opened: Counter[str] = Counter()

    def flush() -> None:
        if buffer:
            found.append((top.owner, buffer[:]))
            buffer.clear()

    def close(e: Element) -> None:
        """Ends ``e`` and what is open inside it."""
        nonlocal top
        while True:
            last, top = top, top.parent
            opened[last.tag] -= 1
            if last is e:
                return

    def nearest(tags: set[str], until: set[str]) -> Element | None:
        """The outermost open element of ``tags`` inside the nearest of ``until``."""
        if not any(opened[t] for t in tags):
            return None
        e, out = top, None
        while e is not root and e.tag not in until:
            out = e if e.tag in tags else out
            e = e.parent
        return out

    for kind, tag, more in tokens(page):
        if not kind:
            if not top.dropped:
                text = entities.unescape(tag) if "&" in tag else tag
                buffer.append((top, text))
                if not top.link:
                    top.size += len(text) if not text.isspace() else 0
            continue
        if kind == "/":
            if not opened[tag]:
                if tag == "p":
                    flush()
                continue
            if tag in BLOCKS:
                flush()
            e = top
            while e.tag != tag:
                e = e.parent
            close(e)
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            elif tag == "br" and not top.dropped:
                buffer.append((top, " "))
            continue
        block = tag in BLOCKS
        if block:
            flush()
            # A paragraph ends where a block begins; items and cells end where the next one does.
            if top.owner.tag == "p":
                close(top.owner)
        if tag in CLOSES and (e := nearest(*CLOSES[tag])) is not None:
            flush()
            close(e)
        drop, named, names = _unwanted(tag, more, top.article is not None)
        if tag in RAW:
            drop = True
        path = numbers.setdefault((top.path, tag, names), len(numbers)) if block else top.path
        top = Element(tag, top, path, top.dropped or drop, named, top.link or tag == "a", block)
        elements.append(top)
        opened[tag] += 1
        if more.endswith("/") and not block and tag not in RAW:
            close(top)
    flush()
    _settle(elements)
    out = []
    for e, pieces in found:
        pieces = [(x, text) for x, text in pieces if not x.dropped]
        text = " ".join("".join(text for _, text in pieces).split())
        if text:
            out.append(Leaf(e, text, sum(len(text) for x, text in pieces if x.link)))
    return out, elements


def _shared(a: Element, b: Element) -> float:
    """How much of two paths is common, 0 to 1."""
    if a.path == b.path:
        return 1.0
    deep = max(a.depth, b.depth)
    while a is not b and a.path != b.path:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
    return (a.depth + 1) / (deep + 1)


def _fused(text: float, marks: float, n: int) -> float:
    """Text and punctuation for each leaf, fused by the product; the logarithm keeps one long path from setting the scale."""
    return math.log1p(text / n * (1 + marks / n))


def content(found: list[Leaf]) -> tuple[list[bool], list[float]]:
    """Of each leaf: does its path stand out, and by how much the leaf itself does; what is below 0 speaks against what holds it."""
    sums: dict[int, list[int]] = {}
    own = []
    for leaf in found:
        s = sums.setdefault(leaf.path, [0, 0, 0])
        free, marks = len(leaf.text) - min(leaf.linked, len(leaf.text)), len(PUNCTUATION.findall(leaf.text))
        own.append(_fused(free, marks if free else 0, 1))
        s[0] += free
        s[1] += marks
        s[2] += 1
    ratio = {p: _fused(*s) for p, s in sums.items()}
    plain = [ratio[leaf.path] for leaf in found]
    smooth = []
    for k, leaf in enumerate(found):
        total = weight = 0.0
        for j in range(max(0, k - REACH), min(len(found), k + REACH + 1)):
            w = math.exp(-((k - j) ** 2) / 2) * _shared(leaf.element, found[j].element)
            total, weight = total + w * plain[j], weight + w
        smooth.append(total / weight)
    mean = sum(smooth) / len(smooth)
    spread = math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    limit = mean - SPREAD * spread - 1e-9
    paths: dict[int, float] = {}
    for leaf, x in zip(found, smooth, strict=True):
        paths[leaf.path] = paths.get(leaf.path, 0.0) + x
    chosen = [paths[leaf.path] >= limit * sums[leaf.path][2] for leaf in found]
    return chosen, [(x + y) / 2 - limit for x, y in zip(smooth, own, strict=True)]


def _linked(leaf: Leaf) -> bool:
    return leaf.linked >= LINKS * max(1, len(leaf.text))


def _listed(leaf: Leaf) -> bool:
    """Does the leaf stand in a list (or a bare container) whose surroundings hold no prose?"""
    e = leaf.element
    if e.tag in PARTS and not e.listed:
        return False
    return not (e.parent or e).base.prose


def _box(elements: list[Element], found: list[Leaf], chosen: list[bool]) -> list[Element]:
    """The containers of the article: the article and main elements with chosen leaves, or else the element whose leaves speak for it most."""
    stated = {id(leaf.element.article): leaf.element.article for leaf, c in zip(found, chosen, strict=True) if c and leaf.element.article and not _linked(leaf)}
    if stated:
        return list(stated.values())
    # Of equals the innermost, which comes last in page order; a part of an article isn't the whole of it.
    best = max(enumerate(elements), key=lambda x: (round(x[1].score, 9), x[0]))[1]
    while best.tag in PARTS and best.parent is not None:
        best = best.parent
    return [best]


def extract(page: str | None) -> str:
    found, elements = leaves(page) if page else ([], [])
    if not found:
        return ""
    chosen, scores = content(found)
    for leaf, c, x in zip(found, chosen, scores, strict=True):
        leaf.element.prose |= c and not _linked(leaf)
        leaf.element.score += x
    for e in reversed(elements):
        if e.parent:
            e.parent.prose |= e.prose
            e.parent.score += e.score
    for e in _box(elements, found, chosen):
        e.boxed = True
    for e in elements:
        # A container inside that has a poor score is none of the article's, but for what stands between its chosen leaves.
        e.poor = not e.boxed and bool(e.parent) and (e.parent.poor or e.block and e.tag not in PARTS and e.score < 0)
        e.boxed |= bool(e.parent and e.parent.boxed)
    picked = [k for k, leaf in enumerate(found) if chosen[k] and leaf.element.boxed]
    if not picked:
        return ""
    first, last = picked[0], picked[-1]
    # Between chosen leaves everything in the box is the article's; before and behind them what no poor container holds.
    keep = [leaf.element.boxed and (first <= k <= last or leaf.element.article is not None or not leaf.element.poor) for k, leaf in enumerate(found)]
    if not any(k and leaf.element.tag == "h1" for k, leaf in zip(keep, found, strict=True)):
        first = keep.index(True)
        title = max((k for k in range(first) if found[k].element.tag == "h1"), default=first)
        keep[title:first] = [True] * (first - title)
    return "\n".join(leaf.text for k, leaf in zip(keep, found, strict=True) if k and not (_linked(leaf) and _listed(leaf)))


def extract_pages(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, url, text); every page by itself, so there is no shuffle."""
    from .common import map_rows, text_batches

    text_batches(pages.sparkSession)

    def make():
        return lambda x: {"page_id": x["page_id"], "url": x["url"], "text": [extract(h) for h in x["html"]]}

    return map_rows(pages.select(F.col(key).cast("long").alias("page_id"), "url", F.col(html).alias("html")), "page_id long, url string, text string", make)


def query(spark, sf_dir: str) -> DataFrame:
    from .common import table

    return extract_pages(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
