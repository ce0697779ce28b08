"""Main text of web pages by tag-path ratios.

A page is read as a stream of tags and text.  Each text block stands on a path
of block tags, with their classes and ids, from the root (inline tags do not
count; implied ends of p, li and the like are honoured, unclosed tags end with
their parent).  Per path, text length, punctuation and link text are summed;
length and punctuation per node are fused, less the share of links; the series
over the page's blocks is smoothed, and paths over the threshold are content.

Blocks on content paths are selected, and what stands between them: headings,
short paragraphs, lists; blocks that are links for the most part are not.  The
text runs from the first selected block, or the heading above it, to the last
one and what follows it in its container; inside an article or main element
that holds most of it, it spans the element.

Names are evidence beside the ratios.  A class or id speaks against an element
if it is made of such words alone ("site-footer", not "social-history"), as a
role, a form tag, a hidden or aria-hidden attribute or a style of display:none
does; the element goes if it holds at most half of the text of article and
main (of the page, if it has neither), so that wrappers of whole pages stay.
Elements for which the tag itself speaks (nav, footer, script ...) and the
readers' comments (by the names of comment lists) go whatever their size.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlab.llm.common import col, slices

# fixed values: element names of HTML
_RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "plaintext"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
           "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
           "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img", "br"}
_DROP = {"script", "style", "noscript", "template", "nav", "menu", "header", "footer", "aside", "form", "button",
         "select", "option", "textarea", "input", "iframe", "object", "embed", "svg", "canvas", "title", "head",
         "audio", "video", "dialog", "xmp", "noembed", "noframes", "fieldset"}
_CLOSES_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset",
             "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
             "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul", "li", "dd", "dt"}
_IMPLIED = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
_FENCE = {"ul", "ol", "dl", "table", "menu", "article", "main", "section", "body", "html", "div", "nav", "footer", "aside"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
# fixed values: words of names that speak against an element, words that say
# nothing beside them, and names of readers' comments
_AGAINST = set("""nav navbar navigation menu submenu header footer sidebar sidenav aside widget widgets cookie cookies
consent gdpr notice notices banner ad ads advert adverts advertisement sponsor sponsored promo promotion share sharing
social related recommended breadcrumb breadcrumbs newsletter subscribe login signup popup modal overlay pagination pager
toolbar skiplink masthead copyright legal""".split())
_NEUTRAL = set("""site main page global top bottom left right upper lower primary secondary box block bar wrap wrapper container
inner outer list links link item items section area region group row col column button buttons icon icons media mobile desktop
sticky fixed js the my side skip tool bread crumb crumbs policy text content posts articles""".split())
_COMMENTS = re.compile(r"(?:(?:user|reader|post|article|page|fb|facebook|blog|all|the)[-_]?)?comments?"
                       r"(?:[-_]?(?:list|area|section|thread|wrap|wrapper|box|block|container|body|content|text|item|form|replies))*"
                       r"|comment-?list|disqus(?:[-_]thread)?|respond|replies", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s\"'>]+)))?")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_SENTENCE = re.compile(r"[.!?。]")
#: Characters beside links that are still a label ("Tags:").
LABEL = 24
_PUNCTUATION = re.compile(r"[.,;:!?。，…]")


class _Element:
    __slots__ = ("tag", "parent", "path", "dropped", "doubtful", "article", "size")

    def __init__(self, tag, parent, noise, name=""):
        self.tag, self.parent, self.size = tag, parent, 0
        self.path = f"{parent.path}/{tag}{name}" if parent else ""
        self.dropped = noise == _SURE or bool(parent and parent.dropped)
        self.doubtful = noise == _DOUBTFUL
        self.article = tag in ("article", "main") or bool(parent and parent.article)


class _Block:
    """Text of one block; ``links``: characters inside links, and their number."""
    __slots__ = ("element", "text", "linked", "links")

    def __init__(self, element, text, linked, links):
        self.element, self.text, self.linked, self.links = element, text, linked, links

    def __iter__(self):
        return iter((self.element, self.text))


_SURE, _DOUBTFUL = 2, 1


def attributes_of(text: str) -> dict[str, str]:
    """Attributes of a tag, names in lower case; the first of a name counts."""
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def speaks_against(name: str) -> bool:
    words = {w.lower() for w in _WORDS.findall(name)}
    return bool(words & _AGAINST) and words <= _AGAINST | _NEUTRAL


def _noise(tag: str, attributes: dict[str, str]) -> int:
    if tag in _DROP and tag not in ("form", "fieldset"):
        return _SURE
    if tag in ("html", "body", "main"):
        return 0
    names = [n for a in ("class", "id") for n in attributes.get(a, "").split()]
    if any(_COMMENTS.fullmatch(n) for n in names):
        return _SURE
    if tag == "article":
        return 0
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" \
            or _NOT_SHOWN.search(attributes.get("style", "")):
        return _DOUBTFUL
    if tag in ("form", "fieldset") or attributes.get("role", "").lower() in _ROLES:
        return _DOUBTFUL
    return _DOUBTFUL if any(map(speaks_against, names)) else 0


def _without_noise(found: list[_Block]) -> list[_Block]:
    """Blocks outside doubtful elements that hold at most half of the text."""
    content = [b for b in found if b.element.article] or found
    total = sum(len(b.text) for b in content)
    for b in content:
        e = b.element
        while e is not None:
            e.size += len(b.text)
            e = e.parent

    def stays(e):
        while e is not None:
            if e.doubtful and 2 * e.size <= total:
                return False
            e = e.parent
        return True

    return [b for b in found if stays(b.element)]


def blocks(html: str) -> list[_Block]:
    """Text blocks in page order with their block element."""
    root = _Element("", None, 0)
    stack = [root]
    inline: list[tuple[str, bool]] = []        # open inline tags, and whether they drop their text
    out: list[_Block] = []
    held: list[str] = []
    linked: list[str] = []
    links = 0

    def flush():
        nonlocal links
        if held:
            text = " ".join(unescape("".join(held)).split())
            if text and not stack[-1].dropped:
                out.append(_Block(stack[-1], text, len(" ".join(unescape("".join(linked)).split())), links))
            held.clear()
        linked.clear()
        links = 0

    def close(depth: int):
        flush()
        del stack[depth:]
        inline.clear()

    at = 0
    n = len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        text = html[at:m.start()] if m else html[at:]
        if text and not any(d for _, d in inline):
            held.append(text)
            if any(t == "a" for t, _ in inline):
                linked.append(text)
        if not m:
            break
        at = m.end()
        tag = m.group(2)
        if tag is None:
            if m.group().startswith("<![CDATA["):
                held.append(m.group()[9:].removesuffix("]]>"))
            continue
        tag, written = tag.lower(), m.group(3)
        if m.group(1):
            if tag in _INLINE:
                for i in range(len(inline) - 1, -1, -1):
                    if inline[i][0] == tag:
                        del inline[i]
                        break
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in _RAW and tag != "plaintext":
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(html, at)
            at = end.start() if end else n
        attributes = attributes_of(written) if written.strip(" /") else {}
        noise = _noise(tag, attributes)
        if tag in _VOID:
            if tag == "hr":
                flush()
            continue
        if tag in _INLINE:
            if not written.rstrip().endswith("/"):
                links += tag == "a" and "href" in attributes
                inline.append((tag, bool(noise)))
            continue
        if tag in _RAW:
            continue                           # its text was skipped above
        flush()
        if tag in _CLOSES_P:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == "p":
                    close(i)
                    break
                if stack[i].tag in _FENCE:
                    break
        if tag in _IMPLIED:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in _IMPLIED[tag]:
                    close(i)
                    break
                if stack[i].tag in _FENCE and stack[i].tag != tag:
                    break
        inline.clear()
        name = "".join(f".{c}" for c in sorted(attributes.get("class", "").split())) + "".join(f"#{c}" for c in attributes.get("id", "").split())
        stack.append(_Element(tag, stack[-1], noise, name))
    flush()
    return _without_noise(out)


def content_paths(found: list[_Block]) -> set[str]:
    """Paths whose fused, smoothed text and punctuation ratio, less the share
    of link text, is over the threshold (the standard deviation of the series,
    at most its mean)."""
    length, points, linked, nodes = defaultdict(int), defaultdict(int), defaultdict(int), defaultdict(int)
    for b in found:
        path = b.element.path
        length[path] += len(b.text)
        points[path] += len(_PUNCTUATION.findall(b.text))
        linked[path] += min(b.linked, len(b.text))
        nodes[path] += 1
    fused = {p: (length[p] - linked[p]) / nodes[p] * (1 + points[p] / nodes[p]) for p in nodes}
    series = [fused[b.element.path] for b in found]
    kernel = (0.25, 0.5, 0.25)
    smooth = [sum(w * series[min(max(i + d, 0), len(series) - 1)] for d, w in zip((-1, 0, 1), kernel))
              for i in range(len(series))]
    mean = sum(smooth) / len(smooth)
    spread = (sum((x - mean) ** 2 for x in smooth) / len(smooth)) ** 0.5
    threshold = min(mean, spread)
    total = defaultdict(float)
    for b, x in zip(found, smooth):
        total[b.element.path] += min(x, 2 * fused[b.element.path])       # a long neighbour alone makes no content
    return {p for p in total if total[p] / nodes[p] >= threshold}


def _of_links(b: _Block) -> bool:
    """Two links or more that make up most of the block, or all but a label."""
    if b.links < 2:
        return False
    return 2 * b.linked >= len(b.text) or (len(b.text) - b.linked <= LABEL and not _SENTENCE.search(b.text))


_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_TEXTS = _HEADINGS | {"p", "li", "dt", "dd", "td", "th", "blockquote", "pre", "figcaption"}
_OUTER = {"", "html", "body"}
_PLAIN = _TEXTS | {"ul", "ol", "dl", "table", "tbody", "tr", "figure"}


def _container(e: _Element) -> _Element:
    while e.parent is not None and e.tag in _PLAIN:
        e = e.parent
    return e


def _inside(e: _Element, around: _Element) -> bool:
    """Whether ``e`` is part of ``around``; of the page's own body only plain
    text elements are."""
    while e is not None:
        if e is around:
            return True
        if around.tag in _OUTER and e.tag not in _PLAIN:
            return False
        e = e.parent
    return False


def main_text(html: str) -> str:
    found = blocks(html)
    if not found:
        return ""
    chosen = content_paths(found)
    selected = [i for i, b in enumerate(found) if b.element.path in chosen and not _of_links(b)]
    if not selected:
        return ""
    # an article or main that holds most of what is selected is the text's extent
    weight, inside = defaultdict(int), {}
    for i in selected:
        for e in _chain(found[i].element):
            if e.tag in ("article", "main"):
                weight[id(e)] += len(found[i].text)
                inside[id(e)] = e
    total = sum(len(found[i].text) for i in selected)
    most = [k for k in weight if 2 * weight[k] >= total]
    if most:
        best = inside[most[-1]]
        for k in most:                       # the innermost of them
            if any(e is best for e in _chain(inside[k])):
                best = inside[k]
        extent = [i for i, b in enumerate(found) if any(e is best for e in _chain(b.element))]
    else:
        first, last = selected[0], selected[-1]
        top, bottom = _container(found[first].element), _container(found[last].element)
        start = i = first
        while i > 0 and _inside(found[i - 1].element, top) and not _of_links(found[i - 1]):
            i -= 1
            if found[i].element.tag in _HEADINGS:
                start = i
        if start == first and first > 0 and found[first - 1].element.tag in _HEADINGS:
            start = first - 1
        while last + 1 < len(found) and _inside(found[last + 1].element, bottom) and not _of_links(found[last + 1]):
            last += 1
        extent = range(start, last + 1)
    return "\n".join(found[i].text for i in extent if not _of_links(found[i]))


def _chain(e: _Element) -> list[_Element]:
    """The element and those around it, from the root."""
    out = []
    while e is not None:
        out.append(e)
        e = e.parent
    return out[::-1]


def _extract(batches: Iterator[pa.RecordBatch]):
    for part in slices(batches, 1 << 23, "html"):
        texts = [main_text(h) for h in part.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, id_col="page_id", url_col="url", html_col="html") -> DataFrame:
    """(page_id, url, text, n_chars) per row.  Null and empty html and pages
    without text give the empty text; a page that is only readers' comments or
    menus is empty too, however long; of paths that tie at the threshold all
    are content; null ids and urls stay null; repeated rows come back each;
    html is read whole; other columns are not read."""
    return (pages.select(col(pages, id_col).cast("long").alias("page_id"), col(pages, url_col).cast("string").alias("url"),
                         F.coalesce(col(pages, html_col).cast("string"), F.lit("")).alias("html"))
            .mapInArrow(_extract, "page_id long, url string, text string, n_chars long"))
