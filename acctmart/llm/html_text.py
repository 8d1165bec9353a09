"""Main text of web pages by scoring the tree of elements.

Paragraphs pass points to their ancestors: for being one, for their commas and for their
length, in full to the parent, half to the grandparent and less further up. An element's
points are discounted by the share of its text that is in links. The best container is kept
with those siblings that look like parts of the same article. Elements whose name, class,
id or role marks them as menu, notice, advert, form or reader comment are left out before;
by class or id alone only if the page's text is not in them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from acctmart.llm.common import slices

# Element names of the HTML standard.
_WORDS = lambda names: frozenset(names.split())
VOID = _WORDS("area base br col embed hr img input link meta param source track wbr")
RAW = _WORDS("script style template noscript textarea title iframe noembed noframes xmp svg math")
LEFT_OUT = RAW | _WORDS(
    "head nav header footer aside form button select option dialog menu fieldset canvas object "
    "audio video map label datalist"
)
BLOCKS = _WORDS(
    "html body address article blockquote center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main nav ol p pre section summary table "
    "tbody td tfoot th thead tr ul aside dir menu"
)
#: An opening block ends an open paragraph; these end an open element of the same kind.
_SIBLINGS = {
    "li": _WORDS("li"),
    "dt": _WORDS("dt dd"),
    "dd": _WORDS("dt dd"),
    "tr": _WORDS("tr td th"),
    "td": _WORDS("td th"),
    "th": _WORDS("td th"),
    "option": _WORDS("option"),
}
#: Elements that siblings do not end from inside.
_HOLDS = _WORDS("ul ol table dl body html article section div")
PARAGRAPHS = _WORDS("p pre td blockquote li dd h1 h2 h3 h4 h5 h6")
_MARKS = (
    r"(?:ad|ads|adv|advert[a-z]*|banner|sponsor[a-z]*|promo[a-z]*|nav[a-z]*|menu[a-z]*|breadcrumbs?|"
    r"sidebar|side|footer|masthead|cookies?|consent|gdpr|notice|alert|popup|modal|newsletter|"
    r"subscri[a-z]*|sign-?up|login|share|sharing|social|related|recommend[a-z]*|comments?|commentlist|"
    r"replies|reply|disqus|discussion|respond|pager|pagination|toolbar|widget|hidden|skip[a-z]*|"
    r"copyright|legal|disclaimer|paywall|teaser|outbrain|taboola)"
)
#: A whole class or id made of marks only, with a place before or a form after them. Not a
#: layout class with a mark somewhere in it, such as "overflow-hidden" or "with-sidebar".
_MARKED = re.compile(
    rf"(?:(?:site|page|main|post|entry|top|bottom|left|right)[_-])?{_MARKS}(?:[_-]{_MARKS})*"
    r"(?:[_-](?:area|bar|box|buttons?|items?|left|links?|list|posts?|right|section|slot|\d+))*",
    re.I,
)
#: Of these, the marks of reader comments.
_COMMENTS = re.compile(r"(?:^|[_-])(?:comments?|commentlist|replies|reply|disqus|discussion|respond)(?:$|[_-])", re.I)
_ROLES = _WORDS("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Comments, declarations and tags. A tag whose quotes do not match ends at the next ">".
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.S,
)
#: Foreign elements may end themselves; a tag of theirs, where comments, scripts and styles are stepped over.
_FOREIGN = _WORDS("svg math")
_FOREIGN_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)(?=[\s/>]).*?(?:</\1\s*>|\Z)"
    r"|<(/?)(svg|math)(?=[\s/>])((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+|[^>]*+)>",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_SPACE = re.compile(r"\s+")


@dataclass
class Element:
    name: str
    parent: Element | None
    children: list[Element | str] = field(default_factory=list)
    left_out: bool = False
    #: By class or id alone: by comments' or other marks.
    marked: str = ""
    points: float = 0.0
    text_length: int = 0
    link_length: int = 0


def _attributes(source: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


def _judge(name: str, source: str) -> tuple[bool, str]:
    """Whether an element is left out in any case, and what its class or id marks it as."""
    if name in LEFT_OUT:
        return True, ""
    if not source or name in ("html", "body", "article", "main"):
        return False, ""
    a = _attributes(source)
    if (
        "hidden" in a
        or a.get("aria-hidden") == "true"
        or a.get("role", "").lower() in _ROLES
        or _HIDDEN.search(a.get("style", ""))
    ):
        return True, ""
    names = f"{a.get('class', '')} {a.get('id', '')}".split()
    marks = [n for n in names if _MARKED.fullmatch(n)]
    return False, marks and ("comments" if any(map(_COMMENTS.search, marks)) else "other") or ""


def _foreign_ends(source: str) -> dict[int, int]:
    """Where the elements svg and math end, by where their start tags end; unclosed ones have no end."""
    ends: dict[int, int] = {}
    opened: dict[str, list[int]] = {name: [] for name in _FOREIGN}
    for m in _FOREIGN_TAG.finditer(source):
        if not m[3]:
            continue
        waiting = opened[m[3].lower()]
        if not m[2]:
            if not m[4].endswith("/"):
                waiting.append(m.end())
        elif waiting:
            ends[waiting.pop()] = m.end()
    return ends


def parse(source: str) -> Element:
    """The tree of a page. Unclosed elements end as browsers end them, roughly."""
    root = Element("#root", None)
    here, at = root, 0
    foreign_ends: dict[int, int] | None = None
    while True:
        m = _TOKEN.search(source, at)
        text = source[at : m.start() if m else len(source)]
        if text:
            here.children.append(html.unescape(text))
        if not m:
            return root
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            here = _close(here, name)
            continue
        attributes = m[3]
        here = _make_room(here, name)
        left_out, marked = _judge(name, attributes)
        element = Element(name, here, left_out=left_out, marked=marked)
        here.children.append(element)
        if name in _FOREIGN:
            # One that ends itself or is never closed has no content to leave out.
            if not attributes.endswith("/"):
                if foreign_ends is None:
                    foreign_ends = _foreign_ends(source)
                at = foreign_ends.get(at, at)
        elif name in RAW:
            # The content is not markup; it ends at the closing tag.
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
        elif name not in VOID and not attributes.endswith("/"):
            here = element


def _close(here: Element, name: str) -> Element:
    e = here
    while e.parent is not None and e.name != name:
        if name not in BLOCKS and e.name in BLOCKS:
            return here  # an inline end tag does not close blocks
        e = e.parent
    return e.parent if e.parent is not None else here


def _make_room(here: Element, name: str) -> Element:
    """Where a new element goes, once those that it ends are closed."""
    if name in BLOCKS:
        e = here
        while e is not None and e.name not in _HOLDS:
            if e.name == "p":
                here = e.parent
            e = e.parent
    ends = _SIBLINGS.get(name)
    if ends:
        e = here
        while e is not None and (e.name in ends or e.name not in _HOLDS):
            if e.name in ends:
                here = e.parent
            e = e.parent
    return here


def _measure(e: Element, in_link: bool = False) -> None:
    """Lengths of text and of link text below each element, without what is left out."""
    todo, order = [(e, in_link)], []
    while todo:
        e, in_link = todo.pop()
        order.append(e)
        in_link = in_link or e.name == "a"
        for c in e.children:
            if isinstance(c, str):
                n = len(_SPACE.sub(" ", c).strip())
                e.text_length += n
                e.link_length += n * in_link
            elif not c.left_out:
                todo.append((c, in_link))
    for e in reversed(order):
        if e.parent is not None and not e.left_out:
            e.parent.text_length += e.text_length
            e.parent.link_length += e.link_length


def _walk(e: Element) -> Iterator[Element]:
    todo = [e]
    while todo:
        e = todo.pop()
        yield e
        todo += [c for c in reversed(e.children) if isinstance(c, Element) and not c.left_out]


def _link_density(e: Element) -> float:
    return e.link_length / e.text_length if e.text_length else 0.0


def _own_text(e: Element) -> str:
    """Text of a block without that of blocks in it."""
    out, todo = [], list(reversed(e.children))
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            out.append(c)
        elif c.name == "br":
            out.append(" ")
        elif not c.left_out and c.name not in BLOCKS:
            todo += reversed(c.children)
    return _SPACE.sub(" ", "".join(out)).strip()


def _own_points(e: Element) -> float:
    if e.name not in PARAGRAPHS and e.name not in ("div", "section"):
        return 0.0
    text = _own_text(e)
    if not text:
        return 0.0
    return (1 + text.count(",") + text.count("、") + min(len(text) / 100, 3)) * (1 - _link_density(e))


def _leave_out_marked(root: Element) -> None:
    """Leave out what a class or id marks, but not what the page's text is in.

    A marked element stays if the article or main element of most points is in it, or most
    points of the page; one marked as comments only if next to nothing is outside of it.
    """
    order = list(_walk(root))
    if not any(e.marked for e in order):
        return
    _measure(root)
    held: dict[int, float] = {}
    in_comments: dict[int, bool] = {}
    for e in order:
        in_comments[id(e)] = e.marked == "comments" or (e.parent is not None and in_comments[id(e.parent)])
    for e in reversed(order):
        held[id(e)] = held.get(id(e), 0.0) + _own_points(e)
        if e.parent is not None:
            held[id(e.parent)] = held.get(id(e.parent), 0.0) + held[id(e)]
    for e in order:
        e.text_length = e.link_length = 0
    total = held[id(root)]
    articles = [e for e in order if e.name in ("article", "main") and held[id(e)] and not in_comments[id(e)]]
    around: set[int] = set()
    e = max(articles, key=lambda e: held[id(e)], default=None)
    while e is not None:
        around.add(id(e))
        e = e.parent
    for e in order:
        if e.marked and id(e) not in around:
            e.left_out = held[id(e)] <= total * (0.9 if e.marked == "comments" else 0.5)


def _score(root: Element) -> None:
    for e in _walk(root):
        points = _own_points(e)
        if points:
            if e.name not in PARAGRAPHS:
                e.points += points  # text that stands in a container without a paragraph
                continue
            share, up = 1.0, e.parent
            for level in range(1, 6):
                if up is None or up.name == "#root":
                    break
                up.points += points * share
                up, share = up.parent, 1 / (2 * level) if level < 2 else 1 / (3 * level)


def main_elements(root: Element) -> list[Element]:
    """The best container, with those siblings that belong to it, in page order."""
    _leave_out_marked(root)
    _measure(root)
    _score(root)
    best, most = None, 0.0
    for e in _walk(root):
        value = e.points * (1 - _link_density(e))
        if e.name == "article":
            value *= 1.5
        if value > most:
            best, most = e, value
    if best is None:
        # No paragraph with text: the page's text as it stands, if there is any.
        body = next((e for e in _walk(root) if e.name == "body"), root)
        return [body] if body.text_length else []
    parent = best.parent
    if parent is None or best.name in ("body", "html"):
        return [best]
    kept = []
    for c in parent.children:
        if c is best:
            kept.append(c)
        elif isinstance(c, Element) and not c.left_out and c.text_length:
            density = _link_density(c)
            alike = c.points * (1 - density) >= max(2.0, most * 0.2)
            text = c.name in PARAGRAPHS and (
                density < 0.25 if c.text_length > 80 else density == 0 and c.name != "li"
            )
            if alike or text:
                kept.append(c)
    return kept


def block_texts(elements: list[Element]) -> list[str]:
    """Texts of the blocks in page order, white space made single, empty ones left out."""
    out: list[list[str]] = [[]]
    for top in elements:
        out.append([])
        todo: list[Element | str | None] = [top]
        while todo:
            c = todo.pop()
            if c is None:
                out.append([])
            elif isinstance(c, str):
                out[-1].append(c)
            elif c.name == "br":
                out[-1].append(" ")
            elif not c.left_out:
                if c.name in BLOCKS:
                    out.append([])
                    todo.append(None)
                todo += reversed(c.children)
    texts = (_SPACE.sub(" ", "".join(parts)).strip() for parts in out)
    return [t for t in texts if t]


def main_text(source: str | None) -> str:
    """The main text of a page, its blocks joined by an empty line; empty if there is none."""
    return "\n\n".join(block_texts(main_elements(parse(source or ""))))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``, from the whole html.

    A null or empty html, and one without text outside of what is left out, gives an empty
    text. Repeated rows are each extracted; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(h) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("page_id"),
                        part.column("url"),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                    ],
                    ["page_id", "url", "text", "n_chars"],
                )

    rows = pages.select("page_id", "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
