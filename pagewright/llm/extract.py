"""Main text of web pages by composite text density.

A page becomes a tree of elements without the parts that markup names as furniture (menus, headers,
footers, sidebars, notices, adverts, forms, scripts, styles, reader comments). Each node gets its
characters per tag, adjusted for characters and tags inside links; a node's density sum is that of
its children. The subtree with the largest sum is the article; the least density on its path to the
body is the threshold for the blocks beside it. Where markup names an article (article, main, or a
main role), the name is a prior only: if the largest sum lies inside such an element, all of it is
taken, an element around such ones has to have over twice their sum, and other named elements need only the
threshold's density to be kept as well.

Names settle only what says nothing else. An element whose name may also be that of a part of the story (`related-work`, `promo-effects`,
`discussion`) stays if it is prose: `PROSE` characters outside links, less than a third of all in links, and no furniture inside.
A form that holds an article or such prose is a wrapper: its controls go, its content stays.

Defined cases: a null or empty html gives an empty text; broken and cut-off markup is read as far as
it goes; repeated rows are separate rows; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches

TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*'|["'])*)(?:>|\Z)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
#: Elements whose content is not markup.
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that are never part of an article.
DROPPED = frozenset(
    "head script style noscript template nav footer aside button select textarea input iframe object embed svg canvas dialog menu "
    "audio video map noembed noframes title".split()
)
#: A start tag of the key ends an open element of the value, up to the nearest barrier.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"), "option": ("option",),
}
BARRIERS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",)}
#: Words of class, id or role that name furniture.
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertisements adsense adslot adbox banner promo promos promotion sponsor sponsors sponsored "
    "cookie cookies consent gdpr notice notices notification notifications alert popup popover modal overlay interstitial newsletter "
    "subscribe subscription signup signin login register paywall nav navbar navigation menu menus submenu breadcrumb breadcrumbs sidebar "
    "sidebars widget widgets footer footnav masthead topbar toolbar comment comments commentlist disqus respond reply replies discussion "
    "related recommended recommendations share sharing social search searchform pagination pager contentinfo complementary dialog copyright "
    "disclaimer skip".split()
)
#: Such words that open an article's own header, where it may stand.
HEADER = frozenset(["header", "banner"])
#: Of those, words that also name parts of a story: inside an article they count only in a name that says nothing else,
AMBIGUOUS = frozenset("search share social related notice notices respond reply replies discussion alert menu promotion register recommendations".split())
#: for which these say nothing.
PLAIN = frozenset("bar block box btn button buttons container content div entries entry form group icons inner item items link links list main more nav news "
                  "panel post posts row section stories story title top bottom left right wrap wrapper article articles area page site".split())
#: Words that count only for what is not prose, in a name that says something else too.
DOUBTFUL = AMBIGUOUS | frozenset("promo promos login signup overlay modal popup dialog subscription consent recommended disclaimer".split())
#: These may name a part of a story by themselves; the second one inside an article only.
SECTIONS = ("discussion", "disclaimer")
#: Characters outside links from which a block is prose.
PROSE = 80
NEGATED = frozenset(["no", "not", "has", "with", "without"])
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


class Node:
    __slots__ = ("chars", "children", "density", "doubtful", "link_chars", "link_tags", "parent", "sum", "tag", "tags")

    def __init__(self, tag: str, parent: Node | None):
        self.tag, self.parent, self.children = tag, parent, []
        self.chars = self.link_chars = self.tags = self.link_tags = 0
        self.density = self.sum = 0.0
        #: Furniture by name, unless it is prose.
        self.doubtful = False


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(text)}


def _names(attributes: dict[str, str], inside: bool) -> tuple[set[str], set[str]]:
    """Words of an element's names; and those that may stand for a part of the story."""
    sure: set[str] = set()
    doubtful: set[str] = set()
    for name in " ".join(attributes.get(k, "") for k in ("class", "id", "role")).split():
        words = {w.lower() for w in WORD.findall(name)}
        if NEGATED.intersection(words):  # with-sidebar says what stands beside an element
            continue
        if any(not w.isdigit() for w in words - FURNITURE - PLAIN):
            if inside:
                words -= AMBIGUOUS  # related-work is part of a story, related-posts is not
            doubtful |= words & DOUBTFUL
            words -= DOUBTFUL
        elif len(words) == 1 and words & set(SECTIONS[: 1 + inside]):
            doubtful |= words
            words = set()
        sure |= words
    return sure, doubtful


def _furniture(tag: str, attributes: dict[str, str], inside: bool) -> bool | None:
    """Whether an element is furniture; None if that depends on its content."""
    if tag in DROPPED or "hidden" in attributes or attributes.get("aria-hidden") == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attributes.get("style", "")):
        return True
    if tag in ("body", "html", "article", "main"):
        return False
    sure, doubtful = _names(attributes, inside)
    if (tag == "header" or sure & HEADER) and not inside:
        return True
    if sure & FURNITURE - (HEADER if inside else frozenset()):
        return True
    return None if doubtful or tag == "form" else False


def settle(root: Node, broken: set[int]) -> None:
    """Drop doubtful elements that are not prose; broken: those with furniture inside. A form stays with an article in it too."""
    order = list(_nodes(root))
    found: dict[int, tuple[int, int, bool]] = {}
    linked = {id(n) for n in order if n.tag == "a"}
    for node in order:
        if node.parent is not None and id(node.parent) in linked:
            linked.add(id(node))
    for node in reversed(order):
        plain = links = 0
        story = node.tag in ("article", "main")
        kept = []
        for c in node.children:
            if isinstance(c, str):
                n = len(" ".join(c.split()))
                plain, links = (plain, links + n) if id(node) in linked else (plain + n, links)
            else:
                p, x, y = found.pop(id(c))
                form = c.tag == "form"
                if c.doubtful and not (form and y) and (p < PROSE or 2 * x > p or (not form and id(c) in broken)):
                    continue
                plain, links, story = plain + p, links + x, story or y
            kept.append(c)
        node.children = kept
        found[id(node)] = plain, links, story


def parse(page: str) -> Node:
    """The tree of a page without its furniture; text stands among the children."""
    root = Node("html", None)
    open_, skipping, depth, at = [root], None, 0, 0
    mains: list[bool] = [False]
    broken: set[int] = set()

    def text(part: str) -> None:
        if part and skipping is None:
            open_[-1].children.append(html.unescape(part))

    def close(n: int) -> None:
        del open_[n:], mains[n:]

    while True:
        found = TOKEN.search(page, at)
        text(page[at : found.start() if found else len(page)])
        if found is None:
            settle(root, broken)
            return root
        at = found.end()
        if found[2] is None:
            continue
        tag, end = found[2].lower(), found[1]
        if skipping is not None:
            if tag == skipping and tag not in VOID:
                depth += -1 if end else 1
                if depth == 0:
                    skipping = None
            elif end and tag in ("body", "html"):
                skipping = None
            if tag in RAW and not end and skipping is not None:
                stop = re.compile(f"</{re.escape(tag)}", re.IGNORECASE).search(page, at)
                at = stop.start() if stop else len(page)
            continue
        if end:
            for n in range(len(open_) - 1, 0, -1):
                if open_[n].tag == tag:
                    close(n)
                    break
                if open_[n].tag in ("td", "th", "table") and tag not in BLOCK:
                    break
            continue
        if tag == "html":
            continue
        if tag in CLOSES:
            for n in range(len(open_) - 1, 0, -1):
                if open_[n].tag in BARRIERS.get(tag, ("table",)):
                    break
                if open_[n].tag in CLOSES[tag]:
                    close(n)
        elif tag in BLOCK and tag not in ("hr",):
            for n in range(len(open_) - 1, 0, -1):  # a block ends an open paragraph
                if open_[n].tag == "p":
                    close(n)
                    break
                if open_[n].tag in BLOCK:
                    break
        attributes = _attributes(found[3]) if found[3] and found[3] != "/" else {}
        if tag in VOID:
            if tag not in DROPPED:
                open_[-1].children.append(Node(tag, open_[-1]))
            continue
        furniture = _furniture(tag, attributes, mains[-1])
        if furniture:
            if tag not in DROPPED:
                broken |= {id(n) for n in open_ if n.doubtful}
            if tag in RAW:
                stop = re.compile(f"</{re.escape(tag)}[^>]*(?:>|$)", re.IGNORECASE).search(page, at)
                at = stop.end() if stop else len(page)
            elif not found[3].endswith("/") or tag not in ("svg", "canvas", "object"):
                skipping, depth = tag, 1
            continue
        node = Node(tag, open_[-1])
        node.doubtful = furniture is None
        open_[-1].children.append(node)
        open_.append(node)
        mains.append(mains[-1] or tag in ("article", "main") or attributes.get("role", "").lower() in ("main", "article"))
        if mains[-1] and not mains[-2] and tag not in ("article", "main"):
            node.tag = "main"  # named by its role


def weigh(root: Node) -> None:
    """Counts, densities and density sums of every node, children first."""
    order, stack = [], [(root, False)]
    while stack:
        node, linked = stack.pop()
        linked = linked or node.tag == "a"
        order.append((node, linked))
        stack += [(c, linked) for c in node.children if isinstance(c, Node)]
    for node, linked in reversed(order):
        for c in node.children:
            if isinstance(c, Node):
                node.chars += c.chars
                node.link_chars += c.link_chars
                node.tags += c.tags + 1
                node.link_tags += c.link_tags + (c.tag == "a" or linked)
            else:
                n = len(" ".join(c.split()))
                node.chars += n
                node.link_chars += n if linked else 0
    share = root.link_chars / max(1, root.chars)
    for node, _ in order:
        node.density = density(node, share)
    for node, _ in order:
        node.sum = sum(c.density for c in node.children if isinstance(c, Node))


def density(node: Node, body_share: float) -> float:
    """Composite text density: characters per tag, on a logarithmic scale of how little of it is linked."""
    c, lc, t, lt = node.chars, node.link_chars, max(1, node.tags), max(1, node.link_tags)
    if not c:
        return 0.0
    base = math.log(c / max(1, c - lc) * lc + body_share * c + math.e)
    return c / t * max(0.0, math.log(c / max(1, lc) * t / lt) / math.log(base) if base > 1.0001 else math.log(c / max(1, lc) * t / lt) / 1e-4)


def _nodes(root: Node) -> Iterator[Node]:
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]


def choose(root: Node) -> list[Node]:
    """The subtrees that hold the article, in page order."""
    body = next((n for n in _nodes(root) if n.tag == "body"), root)
    holders = [n for n in _nodes(body) if n.tag in BLOCK or n is body]
    top = max(holders, key=lambda n: n.sum)
    if top.tag == "p" or not top.sum:
        top = top.parent if top.tag == "p" and top.parent is not None else body
    named = [n for n in holders if n.tag in ("article", "main") and n.chars]
    best = top
    if named:
        scores = {id(n): max(n.density, *(x.sum for x in _nodes(n))) for n in named}
        # of equal ones the innermost
        likely = max(enumerate(named), key=lambda x: (scores[id(x[1])], x[0]))[1]
        if top in _above(likely, body):
            outer = [n for n in named if not any(id(x) in scores for x in _above(n, body)[1:]) and top in _above(n, body)]
            best = likely if 2 * max(scores[id(likely)], sum(scores[id(n)] for n in outer)) >= top.sum else top
        else:
            best = next((n for n in _above(top, body) if id(n) in scores), top)
    path = _above(best, body)
    threshold = min(n.density for n in path)
    chosen = {id(best)}
    for node, above in zip(path, path[1:], strict=False):
        for c in above.children:
            if isinstance(c, Node) and c is not node and c.tag in BLOCK and c.density >= threshold and max(c.sum, c.density) >= best.sum / 2 and 2 * c.link_chars <= c.chars:
                chosen.add(id(c))
    chosen |= {id(n) for n in named if n not in path and n.density >= threshold and 2 * n.link_chars <= n.chars}
    kept = [n for n in _nodes(body) if id(n) in chosen]
    return [n for n in kept if not any(id(x) in chosen for x in _above(n, body)[1:])]


def _above(node: Node, body: Node) -> list[Node]:
    """A node and those around it, up to the body."""
    path = [node]
    while path[-1] is not body and path[-1].parent is not None:
        path.append(path[-1].parent)
    return path


def blocks(node: Node) -> list[str]:
    """Texts of a subtree's blocks in page order: white space inside one is one space."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append(text)

    stack: list = [node]
    while stack:
        x = stack.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            held.append(x)
        elif x.tag == "br":
            held.append(" ")
        else:
            if x.tag in BLOCK:
                flush()
                stack.append(None)
            stack += reversed(x.children)
    flush()
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    weigh(root)
    return "\n\n".join(b for n in choose(root) for b in blocks(n))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(p) for p in batch["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row: a map over pages, nothing is shuffled."""
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(_extracted, "page_id long, url string, text string, n_chars long")
