"""HTML extraction: composite text density.

A page is cut into tags, comments and text, and built into a tree with the implied ends of
HTML (an open ``p`` ends at the next block, ``li`` at ``li``, cells at cells, unclosed
inline tags with their block; script, style and the like are raw text). Parts that are no
article by their tag, role or name (``CHROME``, ``ROLES``, ``NAMES``) leave the tree. Then
every node gets its composite text density

    C / T * log_b(C / LC * T / LT),   b = ln(C * LC / NC + C * LC_body / C_body + e)

with C its characters without white space, T its tags, LC and LT those in links and NC the
characters outside links (each 1 at least). Among the nodes of the page's articles (else of
``main``, else of ``body``) the one whose children's densities have the greatest sum is the
core. The least density on the path from the core up to the body is the threshold:

* the subtree is the core's article (or ``main``), or the core itself where there is none;
* without one, every other part of the body whose density reaches the threshold gives its
  own subtree of the greatest sum too, in page order;
* within a subtree, a list or box in which every character is linked, with two links or
  more and a density below the threshold, is a menu and left out. Nothing else is.

A block is the text between two starts or ends of block tags; ``br`` counts as white space.
Character references are decoded as browsers do (``&amp`` without a semicolon too), runs of
white space become one space, blocks are trimmed and joined by two line feeds.

Defined results: null or empty html, and a page without an article text, give an empty text
of 0 characters; text outside any tag belongs to the body; tags cut off by the page's end
are dropped, raw text without its end runs to the page's end; depth and length have no
limit (nothing recurses); rows that repeat are each extracted; an empty table gives an
empty result; other columns pass through whatever their names.
"""

from __future__ import annotations

import html as entities
import math
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import common as C

TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"                                                   # comment
    r"|<[!?][^>]*(?:>|\Z)"                                                            # doctype, bogus comment
    r"|</?(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[\"'=])*+)(?P<end>>|\Z)"
    r"|</[^>]*(?:>|\Z)", re.S)
ATTR = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")

# Names of HTML and of the usual parts of pages.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead "
    "title tr ul".split())
#: Start tags that end an open p.
ENDS_P = BLOCK - frozenset("body caption col colgroup head html legend option optgroup tbody td tfoot th thead title tr".split())
#: Start tag -> open tags that it ends, and the tags beyond which it does not reach.
_TABLE = frozenset("table html".split())
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split())),
    "dt": (frozenset("dt dd".split()), frozenset(["dl"])),
    "dd": (frozenset("dt dd".split()), frozenset(["dl"])),
    "option": (frozenset(["option"]), frozenset("select optgroup datalist".split())),
    "tr": (frozenset("tr td th caption colgroup".split()), _TABLE),
    "td": (frozenset("td th".split()), _TABLE | {"tr"}),
    "th": (frozenset("td th".split()), _TABLE | {"tr"}),
    "tbody": (frozenset("tbody thead tfoot tr td th caption colgroup".split()), _TABLE),
    "thead": (frozenset("tbody thead tfoot tr td th caption colgroup".split()), _TABLE),
    "tfoot": (frozenset("tbody thead tfoot tr td th caption colgroup".split()), _TABLE),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
#: An end tag or an implied end does not reach beyond these.
BARRIER = frozenset("table td th caption button object applet marquee template html".split())
CHROME = frozenset(
    "head script style noscript template nav footer aside form dialog menu search button select option optgroup datalist input textarea iframe object embed "
    "applet svg math canvas audio video map noembed noframes xmp".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar tablist status tooltip".split())
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot banner sponsor sponsored sponsors promo promos promotion promoted "
    "nav navbar navigation navi menu menus submenu breadcrumb breadcrumbs pager pagination topbar masthead "
    "header footer sidebar sidebars aside widget widgets "
    "notice notices cookie cookies consent gdpr alert alerts popup modal overlay "
    "comment comments commentlist disqus respond replies "
    "form login signup subscribe subscription newsletter search searchbox searchform "
    "share sharing social related recommended recommendations skip".split())
#: Before such a word a name says what else is there (``has-sidebar``).
NOT_OWN = frozenset("has no with without hide non".split())
BOXES = frozenset("ul ol dl div section table p span".split())


class Node:
    __slots__ = ("tag", "parent", "kids", "attrs", "chars", "tags", "linked", "links", "density", "total")

    def __init__(self, tag: str, parent: Node | None, attrs: str = ""):
        self.tag, self.parent, self.attrs, self.kids = tag, parent, attrs, []


def parse(page: str) -> Node:
    """The tree of a page: kids are nodes and decoded pieces of text."""
    root = Node("html", None)
    stack, held = [root], {"html": 1}
    at, n = 0, len(page)

    def pop() -> None:
        held[stack.pop().tag] -= 1

    def close(names: frozenset[str] | set[str], stop: frozenset[str]) -> None:
        """End the innermost open tag of ``names``, with all in it, if none of ``stop`` is before it."""
        if not any(held.get(x) for x in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in names:
                while len(stack) > k:
                    pop()
                return
            if stack[k].tag in stop:
                return

    def text(piece: str) -> None:
        if piece:
            stack[-1].kids.append(entities.unescape(piece) if "&" in piece else piece)

    while at < n:
        found = page.find("<", at)
        if found < 0:
            text(page[at:])
            break
        m = TOKEN.match(page, found)
        if m is None:  # a plain < in the text
            nxt = page.find("<", found + 1)
            nxt = n if nxt < 0 else nxt
            text(page[at:nxt])
            at = nxt
            continue
        text(page[at:found])
        at = m.end()
        tag = m["tag"]
        if tag is None or not m["end"]:
            continue
        tag = tag.lower()
        if page[found + 1] == "/":
            if tag in BLOCK:
                close({tag}, BARRIER - {tag})
            elif held.get(tag):
                close({tag}, (BLOCK | BARRIER) - {tag})
            continue
        if tag == "html" or (tag == "body" and held.get("body")):
            root.attrs += m["attrs"] if tag == "html" else ""
            continue
        if tag in ENDS_P:
            close({"p"}, BARRIER)
        if tag in ENDS:
            names, stop = ENDS[tag]
            close(names, stop | ({"table"} if "table" not in names else set()))
            if tag in ("tbody", "thead", "tfoot", "tr"):
                while stack[-1].tag in names and stack[-1].tag != tag and (tag != "tr" or stack[-1].tag in ("td", "th", "tr", "caption", "colgroup")):
                    pop()
        if tag == "a" and held.get("a"):
            close({"a"}, BLOCK | BARRIER)
        node = Node(tag, stack[-1], m["attrs"])
        stack[-1].kids.append(node)
        if tag in RAW:
            end = _raw_end(tag).search(page, at)
            piece = page[at:end.start() if end else n]
            if tag in ("title", "textarea") and piece:
                node.kids.append(entities.unescape(piece))
            at = end.end() if end else n
        elif tag not in VOID and not (m["attrs"].endswith("/") and tag not in BLOCK and tag in ("svg", "path", "use", "math")):
            stack.append(node)
            held[tag] = held.get(tag, 0) + 1
    return root


@lru_cache(maxsize=None)
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)|</{tag}\Z", re.I)


@lru_cache(maxsize=4096)
def _named(words: str) -> bool:
    for name in words.lower().split():
        parts = [x for x in re.split(r"[-_:]+", name) if x]
        if any(x in NAMES and (i == 0 or parts[i - 1] not in NOT_OWN) for i, x in enumerate(parts)):
            return True
    return False


def _attributes(node: Node) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in ATTR.findall(node.attrs):
        out.setdefault(name.lower(), entities.unescape(a or b or c))
    return out


def _chrome(node: Node, inside: bool) -> bool:
    """Whether a node is no part of an article; ``inside``: it is within one."""
    if node.tag in CHROME or (node.tag == "header" and not inside):
        return True
    if not node.attrs or node.tag in ("html", "body", "main"):
        return False
    got = _attributes(node)
    if "hidden" in got or got.get("aria-hidden", "").lower() == "true" or got.get("role", "").lower() in ROLES:
        return True
    if node.tag == "header" or re.fullmatch("h[1-6]", node.tag):
        return False
    name = f"{got.get('class', '')} {got.get('id', '')}"
    if node.tag == "article" and not inside:  # an article of its own, unless it is a reader's comment
        return any(x.startswith(("comment", "repl")) for x in re.split(r"[-_:\s]+", name.lower()))
    return _named(name)


def prune(root: Node) -> tuple[Node, list[Node]]:
    """Take away what is no article; the body (the root if there is none) and its nodes,
    parents first. A part by name alone stays if the page's article is in it, a form if it
    holds an ``article`` or ``main`` (some sites wrap the whole page in one)."""
    holds: set[int] = set()
    strong: set[int] = set()
    todo = [root]
    while todo:
        node = todo.pop()
        kids = [x for x in node.kids if not isinstance(x, str)]
        todo += kids
        if node.tag in ("article", "main", "h1"):
            for found in (holds,) if node.tag == "h1" else (holds, strong):
                up = node.parent
                while up is not None and id(up) not in found:
                    found.add(id(up))
                    up = up.parent
    body, order, todo = root, [], [(root, False)]
    while todo:
        node, inside = todo.pop()
        if node.tag == "body":
            body = node
        inside = inside or node.tag in ("article", "main")
        keep = []
        for x in node.kids:
            if isinstance(x, str) or not _chrome(x, inside):
                keep.append(x)
            elif not inside and id(x) in (strong if x.tag == "form" else holds) and (x.tag == "form" or x.tag not in CHROME and x.tag != "header"):
                keep.append(x)
        node.kids = keep
        order.append(node)
        todo += [(x, inside) for x in reversed(keep) if not isinstance(x, str)]
    if body is not root:
        loose = [x for x in root.kids if x is not body]
        if any(not isinstance(x, str) or x.strip() for x in loose):
            body = root
        else:
            order = order[next(i for i, x in enumerate(order) if x is body):]
    return body, order


def weigh(body: Node, order: list[Node]) -> None:
    """Characters, tags, links, density and the children's sum of every node."""
    for node in reversed(order):
        own = sum(len(x) - sum(map(x.count, C.WS)) for x in node.kids if isinstance(x, str))
        kids = [x for x in node.kids if not isinstance(x, str)]
        node.chars = own + sum(x.chars for x in kids)
        node.tags = sum(x.tags + 1 for x in kids)
        if node.tag == "a":
            node.linked, node.links = node.chars, 1
        else:
            node.linked, node.links = sum(x.linked for x in kids), sum(x.links for x in kids)
    share = body.linked / max(1, body.chars)
    for node in reversed(order):
        if node.chars:
            c, t, lc, lt = node.chars, max(1, node.tags), max(1, node.linked), max(1, node.links)
            base = math.log(c * lc / max(1, c - node.linked) + c * share + math.e)
            node.density = c / t * math.log(c / lc * t / lt) / math.log(base)
        else:
            node.density = 0.0
        node.total = sum(x.density for x in node.kids if not isinstance(x, str))


def _score(node: Node) -> float:
    """The sum of the children's densities; without a child that has text, its own."""
    return node.total if any(not isinstance(k, str) and k.chars for k in node.kids) else node.density


def _best(nodes: list[Node]) -> Node | None:
    """The node with text of the greatest score; ties go to the first."""
    return max((x for x in nodes if x.chars), key=_score, default=None)


def select(body: Node, order: list[Node]) -> tuple[list[Node], float]:
    """Subtrees to keep, in page order, and the threshold."""
    for tag in ("article", "main"):
        within, todo = [], [(body, body.tag == tag)]
        while todo:  # all nodes inside of one, parents first
            node, inside = todo.pop()
            if inside:
                within.append(node)
            todo += [(k, inside or k.tag == tag) for k in reversed(node.kids) if not isinstance(k, str)]
        core = _best(within)
        if core is not None:
            threshold, home, up = core.density, core, core
            while up is not None and up is not body.parent:
                threshold = min(threshold, up.density)
                if up.tag == tag:
                    home = up
                up = up.parent
            return [home], threshold
    core = _best(order)
    if core is None:
        return [], 0.0
    threshold, up = core.density, core
    while up is not None and up is not body.parent:
        threshold = min(threshold, up.density)
        up = up.parent
    # each node's subtree of the greatest sum, children first; then the marks, parents first
    best: dict[int, Node] = {}
    for node in reversed(order):
        top = node
        for k in node.kids:
            if not isinstance(k, str) and k.chars and (_score(best[id(k)]) > _score(top) or not top.chars):
                top = best[id(k)]
        best[id(node)] = top
    marked: set[int] = set()
    todo = [body]
    while todo:
        node = todo.pop()
        if node.chars and node.density >= threshold:
            marked.add(id(best[id(node)]))
            todo += [k for k in node.kids if not isinstance(k, str)]
    out, todo = [], [body]
    while todo:
        node = todo.pop()
        if id(node) in marked:
            out.append(node)
        else:
            todo += [k for k in reversed(node.kids) if not isinstance(k, str)]
    return out, threshold


def _menu(node: Node, threshold: float) -> bool:
    return node.tag in BOXES and node.links > 1 and node.linked == node.chars > 0 and node.density < threshold


def blocks_of(top: Node, threshold: float) -> list[str]:
    """Texts of the blocks of a subtree."""
    out, now = [], []

    def cut() -> None:
        line = " ".join("".join(now).split())
        if line:
            out.append(line)
        now.clear()

    todo: list = [top]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            now.append(x)
        elif x is None:
            cut()
        elif x.tag in ("br", "hr") or x.tag in VOID:
            now.append(" ") if x.tag == "br" else (cut() if x.tag == "hr" else None)
        elif x is top or not _menu(x, threshold):
            if x.tag in BLOCK:
                cut()
                todo.append(None)
            todo += reversed(x.kids)
    cut()
    return out


def extract(page: str | None) -> str:
    """Main text of one page."""
    if not page:
        return ""
    body, order = prune(parse(page))
    weigh(body, order)
    tops, threshold = select(body, order)
    return "\n\n".join(line for top in tops for line in blocks_of(top, threshold))


def extract_text(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> tuple[DataFrame, dict[str, str]]:
    """The columns ``keep`` (all but the html if None) plus text and number of characters;
    the new columns' names by role."""
    keep = [c for c in pages.columns if c != html] if keep is None else keep
    names = {x: C.internal(pages, x) for x in ("html", "text", "n_chars")}
    src = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{html}`").cast("string").alias(names["html"]))
    schema = StructType([*src.schema.fields[:-1], StructField(names["text"], StringType()), StructField(names["n_chars"], LongType())])

    def run(batches):
        for batch in batches:
            for a, b in C.blocks(batch, names["html"]):
                part = batch.slice(a, b - a)
                texts = [extract(x.as_py()) for x in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=schema.names)

    return src.mapInArrow(run, schema), names


def op13_html_extraction(spark, sf_dir: str) -> DataFrame:
    """Query: main text of every page."""
    out, n = extract_text(C.table(spark, sf_dir, "pages").select("page_id", "url", "html"), keep=["page_id", "url"])
    return out.select("page_id", "url", F.col(n["text"]).alias("text"), F.col(n["n_chars"]).alias("n_chars"))
