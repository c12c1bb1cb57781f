"""Main text of web pages by consensus host paths.

Each page is read into blocks of text, every block under the path of its enclosing elements; a path step is the tag
and its class names with digits generalised. On each page the container is the element that encloses the main text,
which is all text but menus, notices and the like, or that of the page's ``main`` or ``article`` elements where these
hold at least half of it; the page votes for the container's path. Votes are
summed per (host, path) in Spark with map-side combining, every host's winning path is joined back, and the page is
extracted again from the elements on that path. A page on which that path does not hold all the text of the page's own
container, as with a second layout of the host, falls back to its own container.

Asides are told by tags and by whole names of classes, ids and roles: the last word of a name decides ("main-menu" is a
menu, "share-price" is none), some words also at its head; names that state something ("has-sidebar") count for nothing,
and those of headings, paragraphs and inline elements for little. What is an aside by its name alone and yet holds most
of the page's text outside of links is a wrapper, so a page with text comes out empty only if all of it is menus, notices
or comments by other signs.

A host of any size is folded by partial sums. The table of winners has one row per host; the join with the pages is
planned by its measured size, and a hot host is split by adaptive execution.

Defined results: a null or empty page, or one without text, gives an empty text. A script or style that is not closed
reaches to the page's end, as in browsers. A url without host forms the host "".
Repeated rows vote and are extracted each. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

_TOKEN = re.compile(r"""<!--(?:.*?-->|.*)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)>|<[/!?a-zA-Z][^>]*+\Z""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_SPACE = re.compile(r"\s+")
#: elements without content
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: elements whose content is no markup
RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes template".split())
#: elements that end the text block around them
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot
    th thead tr ul""".split())
#: opening tags that end a drawing left open, unless they stand in a part of it that holds HTML
BREAKOUT = BLOCKS | frozenset("b big br code em embed i img meta nobr ruby s small span strong strike sub sup tt u var".split())
HTML_PARTS = frozenset({"foreignobject", "desc", "title"})
_UNQUOTED = re.compile(r"""=\s*[^\s"'>]+\Z""")
#: an opening tag of the first kind ends an open element of the second, up to a limit
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
          "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
#: elements and names (of classes, ids and roles) that hold no main text
ASIDE_TAGS = frozenset("nav aside footer form button select dialog menu".split()) | RAW
ASIDE_NAMES = frozenset("""ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu
    breadcrumb breadcrumbs sidebar side header masthead footer cookie cookies consent gdpr notice notices alert popup modal overlay
    newsletter subscribe subscription signup login share sharing social comment comments reply replies respond disqus discussion
    related recommended recommendations widget toolbar pagination pager copyright complementary contentinfo search hidden
    skip""".split())
#: names of them that say so at the head of a class name too, as in "sidebar-left"
LEADING = frozenset("""ad ads advert advertisement banner sponsored promo nav navbar navigation menu breadcrumb breadcrumbs sidebar masthead
    footer cookie cookies consent gdpr popup modal newsletter subscribe signup social comment comments disqus related recommended widget
    pagination""".split())
#: last words that make an aside even of a name such as "main-menu"
STRONG = frozenset("""menu sidebar nav navbar navigation footer share sharing breadcrumb breadcrumbs pagination pager comments comment
    newsletter advertisement related""".split())
COMMENTS = frozenset("comment comments reply replies respond disqus discussion".split())
#: first words of names that state something about an element, as in "has-sidebar"
STATES = frozenset("has no with without is not show hide".split())
#: words before "header" of a part of the article
ARTICLE_PARTS = frozenset("article entry post story hero content section title chapter".split())
#: names that make an aside of a heading, a paragraph or an inline element; other names say how it looks
SMALL_NAMES = frozenset("ad ads advert advertisement sponsored copyright cookie cookies comment comments hidden".split())
TEXT_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd figcaption".split())
#: an aside by its name that holds this share of the text outside of links is a wrapper, and none
WRAPPER = 0.75
#: elements that are main text by their meaning, and names that say so
MAIN_TAGS, MAIN_NAMES = frozenset({"article", "main"}), frozenset({"article", "articlebody", "post", "entry", "story", "content", "main", "body", "maincontent"})
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: elements too small for a container, unless there is no other
LEAVES = frozenset({"p", "li", "td", "tr", "h1", "h2"})
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)"


class Block:
    """Text of one block, the ids, paths and tags of its enclosing elements, which of these are asides (number, kind), and
    how much of it is links."""

    __slots__ = ("chain", "parts", "linked", "aside", "asides")

    def __init__(self, chain: tuple, asides: list):
        self.chain, self.asides, self.aside, self.parts, self.linked = chain, asides, bool(asides), [], 0

    def plain(self) -> int:
        """Characters outside of links, counted against those inside."""
        return max(0, sum(map(len, self.parts)) - 2 * self.linked)


#: kinds of asides: by an element's meaning, or by its name
MEANT, NAMED = 2, 1


def judge(names: list[str], tag: str) -> tuple[int, bool]:
    """(0, ``NAMED`` or ``MEANT`` for an aside, whether it is main text) by the whole names of class, id and role. A name
    counts by its last word, or its first if that is one of ``LEADING``; reader comments are asides of any size."""
    aside = strong = main = comments = False
    for name in names:
        words = [w for w in (x.lower() for x in _WORD.findall(name)) if not w.isdigit()]
        if not words or (words[0] in STATES and len(words) > 1):
            continue
        last, whole = words[-1], name.lower()
        if tag in TEXT_TAGS or tag not in BLOCKS:
            aside = aside or whole in SMALL_NAMES
            comments = comments or whole in COMMENTS
            continue
        of_article = last in ("header", "side") and not ARTICLE_PARTS.isdisjoint(words[:-1])
        bad = (last in ASIDE_NAMES or whole in ASIDE_NAMES or words[0] in LEADING) and not of_article
        aside, strong = aside or bad, strong or (bad and last in STRONG)
        comments = comments or (bad and not COMMENTS.isdisjoint(words))
        main = main or (not bad and (whole in MAIN_NAMES or not MAIN_NAMES.isdisjoint(words)))
    main = main and tag in ("div", "section", "td")
    if not aside or (main and not strong and not comments):
        return 0, main
    return MEANT if comments else NAMED, False


def _names(attributes: str) -> tuple[str, list[str], bool]:
    """(classes for the path, names in class, id, role and itemprop, hidden)."""
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    classes = sorted(found.get("class", "").split())
    words = [x for key in ("class", "id", "role", "itemprop") for x in found.get(key, "").split()]
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in found.get("style", "").replace(" ", "").lower()
    return ".".join(re.sub(r"\d+", "#", c) for c in classes), words, hidden


def read_page(page: str) -> list[Block]:
    """The text blocks of a page in page order."""
    blocks: list[Block] = []
    stack: list[tuple] = []  # (tag, path, number, kind of aside, main, block around an inline aside)
    drawing: list[str] = []  # tags of the open svg and of the elements open in it, whose text is none
    number, at, links = 0, 0, 0
    current: Block | None = None

    def text(raw: str) -> None:
        nonlocal current
        if drawing or not raw or (current is None and not raw.strip()):
            return
        if current is None:
            inside = [e for e in stack if e[0] in BLOCKS]
            current = Block(tuple((e[2], e[1], e[0]) for e in inside), [(e[2], e[3]) for e in stack if e[3]])
            blocks.append(current)
        current.parts.append(raw)
        if links:
            current.linked += len(raw)

    def close(depth: int) -> None:
        nonlocal current, links
        for e in stack[depth:]:
            links -= e[0] == "a"
        if any(e[0] in BLOCKS for e in stack[depth:]):
            current = None
        else:
            for e in stack[depth:]:
                if e[3]:  # an inline aside: the block around it goes on
                    current = e[5]
                    break
        del stack[depth:]

    while True:
        m = _TOKEN.search(page, at)
        text(page[at:m.start() if m else len(page)])
        if not m:
            return without_wrappers(blocks)
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1] and tag in drawing:
            del drawing[len(drawing) - 1 - drawing[::-1].index(tag):]
            continue
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    drawing.clear()  # an open drawing ends with its parent
                    close(k)
                    break
                if stack[k][0] in ("td", "th", "table") and tag not in BLOCKS:
                    break
            continue
        if m[3].endswith("/") and (drawing or tag in ("svg", "math") or tag not in VOID and any(e[0] == "math" for e in stack)) \
                and not (tag in BREAKOUT and drawing) and not _UNQUOTED.search(m[3]):
            continue  # empty
        if drawing and tag in BREAKOUT and HTML_PARTS.isdisjoint(drawing):
            drawing.clear()
        if drawing or tag == "svg":
            if tag not in VOID:
                drawing.append(tag)
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if tag == "br":
            text(" ")
            continue
        if tag in VOID:
            if tag in BLOCKS:
                current = None
            continue
        if tag in BLOCKS:
            current = None
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in BLOCKS:
                    break
        if tag in CLOSES:
            ends, limit = CLOSES[tag]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in ends:
                    close(k)
                    break
                if stack[k][0] in limit:
                    break
        classes, names, hidden = _names(m[3]) if m[3] else ("", [], False)
        in_main = any(e[4] for e in stack)
        kind, main = judge(names, tag) if names and tag not in ("html", "body") else (0, False)
        main = main or tag in MAIN_TAGS
        if hidden or (tag in ASIDE_TAGS and tag != "form") or (tag == "header" and not in_main):
            kind = MEANT
        elif tag == "form":
            kind = kind or NAMED
        elif tag in MAIN_TAGS and kind == NAMED:
            kind = 0
        around = current
        if kind and tag not in BLOCKS or tag in BLOCKS:
            current = None
        number += 1
        stack.append((tag, (stack[-1][1] + ">" if stack else "") + tag + ("." + classes if classes else ""), number, kind, main, around))
        links += tag == "a"


def without_wrappers(blocks: list[Block]) -> list[Block]:
    """Lifts the asides by name alone that hold most of what else would be text: a page's wrapper, or a form around it."""
    free = [b for b in blocks if all(kind == NAMED for _, kind in b.asides)]
    total = sum(b.plain() for b in free)
    held: dict[int, int] = {}
    for b in free:
        for number, _ in b.asides:
            held[number] = held.get(number, 0) + b.plain()
    wrappers = {number for number, n in held.items() if n and n >= WRAPPER * total}
    for b in blocks if wrappers else ():
        b.aside = any(number not in wrappers for number, _ in b.asides)
    return blocks


def _shown(block: Block) -> str:
    return _SPACE.sub(" ", html.unescape("".join(block.parts))).strip()


def container(blocks: list[Block]) -> tuple[str, int]:
    """(path, score) of the element that holds a page's main text. Where ``main`` elements, or else ``article`` elements,
    hold half of the text outside of links, it is the outermost of them; otherwise all text that is no aside is meant.
    Of several places, it is the deepest element, or path of elements, that leaves none of the meant text outside."""
    shown = [(b, b.plain()) for b in blocks if not b.aside and _shown(b)]
    total = sum(w for _, w in shown)
    chains = [b.chain for b, _ in shown]
    for kind in ("main", "article"):
        inside = [(b, w) for b, w in shown if any(tag == kind for _, _, tag in b.chain)]
        if inside and 2 * sum(w for _, w in inside) >= total:
            chains = [b.chain[:1 + next(k for k, e in enumerate(b.chain) if e[2] in MAIN_TAGS)] for b, _ in inside]
            break
    common = list(chains[0]) if chains else []
    for chain in chains:
        same = 0
        while same < min(len(common), len(chain)) and common[same][1] == chain[same][1]:
            same += 1
        del common[same:]
    while len(common) > 1 and common[-1][2] in LEAVES:
        common.pop()
    if not common:
        return "", total  # no text, or text outside of all elements
    path = common[-1][1]
    return path, sum(w for b, w in shown if any(p == path for _, p, _ in b.chain))


def _inside(block: Block, path: str) -> bool:
    return not path or any(p == path for _, p, _ in block.chain)


def holds(blocks: list[Block], path: str, own: str) -> bool:
    """Whether the elements on ``path`` hold all main text of those on ``own``, and any at all."""
    shown = [b for b in blocks if not b.aside and _shown(b)]
    return any(_inside(b, path) for b in shown) and all(_inside(b, path) for b in shown if _inside(b, own))


def main_text(blocks: list[Block], path: str) -> str:
    """Blocks inside elements on ``path``, without asides, joined by empty lines; without a path, of the whole page."""
    out = [_shown(b) for b in blocks if not b.aside and _inside(b, path)]
    return "\n\n".join(t for t in out if t)


def host(url: str | None) -> str:
    m = re.match(HOST, url or "")
    return m[1].lower() if m else ""


def votes(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, votes, score: summed over all pages."""

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple, list] = {}
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                path, score = container(read_page(page or ""))
                if path:
                    sums = found.setdefault((host(url), path), [0, 0])
                    sums[0] += 1
                    sums[1] += score
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.string()),
                                              pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
                                             ["host", "path", "votes", "score"])

    each = C.map_arrow(pages.select(url_col, html_col), read, "host string, path string, votes long, score long")
    return each.groupBy("host", "path").agg(F.sum("votes").alias("votes"), F.sum("score").alias("score"))


def winners(counted: DataFrame) -> DataFrame:
    """host, path: the path with most votes, then the highest score, then the first by name."""
    return counted.groupBy("host").agg(F.min(F.struct(-F.col("votes"), -F.col("score"), "path")).alias("best")).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """id, url, text, n_chars, path of every page."""
    best = C.cut_lineage(winners(votes(pages, url_col, html_col)), "hosts")
    named = F.lower(F.regexp_extract(F.coalesce(F.col(url_col), F.lit("")), HOST, 1))
    keyed = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), named.alias("host"))
    rows = keyed.join(best, "host", "left").select("id", "url", "html", "path")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, paths = [], []
            for page, path in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                blocks = read_page(page or "")
                own = container(blocks)[0]
                if not (path and holds(blocks, path, own)):
                    path = own
                text = main_text(blocks, path)
                texts.append(text)
                paths.append(path)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64()), pa.array(paths, pa.string())],
                                             [id_col, "url", "text", "n_chars", "path"])

    kind = pages.schema[id_col].dataType.simpleString()
    return C.map_arrow(rows, read, f"{id_col} {kind}, url string, text string, n_chars long, path string")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(C.table(spark, sf_dir, "pages"))
