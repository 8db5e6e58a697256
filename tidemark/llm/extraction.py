"""Main text of web pages by composite text density.

Every node of a page's tree gets its characters per tag, lowered for links. The
densities of a node's children are summed. The subtree of the greatest sum holds the
article; other subtrees join in where densities on the path from it to the body, the
threshold, are reached. What page elements and their names mark as furniture is taken
out before.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)>""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search "
    "section summary table tbody td tfoot th thead tr ul".split()
)
STRUCTURE = BLOCKS - {"br", "hr"}
# A start tag ends these open elements; the second set keeps outer ones open.
CLOSES_P = BLOCKS - {"br", "option", "body", "html"}
CELLS = frozenset(("td", "th", "table", "button"))
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}

# Elements that hold no article text, wherever they stand.
FURNITURE = frozenset(
    "head script style noscript template iframe object embed svg canvas audio video map nav aside footer form button "
    "select input textarea datalist dialog menu search".split()
)
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split())
# Parts of a class or id that name furniture.
FURNITURE_NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promos promoted promotion "
    "banner banners sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer masthead topbar toolbar "
    "comment comments commentlist disqus reply replies respond cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription signup login signin share sharing social related recommended recommendations "
    "widget widgets pagination pager copyright disclaimer header".split()
)
# Beside these, a header is an article's own.
ARTICLE_NAMES = frozenset("article post entry content story".split())


@dataclass(slots=True, eq=False)
class Node:
    tag: str
    parent: Node | None
    hidden: bool = False
    named: bool = False
    #: Texts and nodes in page order.
    inside: list = field(default_factory=list)
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    density_sum: float = 0.0
    #: The node of greatest density sum at or below this one, the first of equals.
    best: Node | None = None


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)}


def judged(node: Node, text: str) -> None:
    """Mark a node hidden or named as furniture by its attributes."""
    if "=" not in text and "hidden" not in text.lower():
        return
    found = attributes(text)
    style = found.get("style", "").replace(" ", "").lower()
    node.hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style
    names = {p.lower() for p in NAME_PART.findall(f"{found.get('class', '')} {found.get('id', '')}")}
    furniture = names & FURNITURE_NAMES
    if names & ARTICLE_NAMES:
        furniture -= {"header"}
    node.named = bool(furniture) or found.get("role", "").lower() in FURNITURE_ROLES


class Open:
    """The open elements of a page being read, innermost last."""

    def __init__(self, root: Node):
        self.path = [root]
        self.counts: Counter = Counter()

    def push(self, node: Node) -> None:
        self.path.append(node)
        self.counts[node.tag] += 1

    def close(self, tags: frozenset | set, until: frozenset | set = frozenset()) -> bool:
        """End the innermost element of `tags` inside the nearest of `until`, if any is open."""
        if not any(self.counts[tag] for tag in tags):
            return False
        for at in range(len(self.path) - 1, 0, -1):
            tag = self.path[at].tag
            if tag in tags:
                for node in self.path[at:]:
                    self.counts[node.tag] -= 1
                del self.path[at:]
                return True
            if tag in until:
                return False
        return False


def parse(page: str) -> Node:
    """The tree of a page. Elements that are never closed end where their parent does."""
    root = Node("html", None)
    opened = Open(root)
    at = 0
    while at < len(page):
        node = opened.path[-1]
        found = MARKUP.search(page, at)
        start = found.start() if found else len(page)
        if start > at:
            node.inside.append(page[at:start])
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            opened.close({tag}, frozenset() if tag in BLOCKS else CELLS)
            continue
        if tag == "html":
            continue
        if tag in CLOSES_P:
            opened.close({"p"}, CELLS)
        if tag in CLOSED_BY:
            while opened.close(*CLOSED_BY[tag]):
                pass
        new = Node(tag, opened.path[-1])
        judged(new, found[3])
        new.parent.inside.append(new)
        if tag in RAW_TEXT:
            end = re.compile(f"</{tag}", re.IGNORECASE).search(page, at)
            after = page.find(">", end.end()) if end else -1
            at = after + 1 if after >= 0 else len(page)
        elif tag not in VOID and not found[3].endswith("/"):
            opened.push(new)
    return root


def in_page_order(root: Node) -> list[Node]:
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting += [x for x in reversed(node.inside) if isinstance(x, Node)]
    return order


def without_furniture(root: Node) -> None:
    """Take out furniture; what holds the page's heading or article is none by its name."""
    order = in_page_order(root)
    holders = set()
    for node in order:
        if node.tag in ("h1", "article", "main") and not node.named:
            up = node.parent
            while up is not None and up not in holders:
                holders.add(up)
                up = up.parent
    articles = {root: False}
    for node in order:
        articles[node] = node.tag in ("article", "main") or bool(node.parent and articles[node.parent])
    for node in order:
        kept = []
        for x in node.inside:
            if isinstance(x, Node):
                header = x.tag == "header" and not articles[node]
                named = x.named and x not in holders and x.tag not in ("body", "main")
                if x.tag in FURNITURE or header or named or x.hidden:
                    kept.append("")
                    continue
            kept.append(x)
        node.inside = kept


def collapsed(text: str) -> int:
    return len(" ".join(text.split()))


def measure(root: Node) -> None:
    """Densities of all nodes, and sums of their children's.

    Tags within a line, as those that make text bold, count as the text they hold.
    """
    order = in_page_order(root)
    for node in reversed(order):
        inner = [x for x in node.inside if isinstance(x, Node)]
        node.chars = sum(collapsed(x) for x in node.inside if isinstance(x, str)) + sum(x.chars for x in inner)
        node.tags = sum((x.tag in STRUCTURE) + x.tags for x in inner)
        node.link_chars = node.chars if node.tag == "a" else sum(x.link_chars for x in inner)
        node.link_tags = sum((x.tag == "a") + x.link_tags for x in inner)
    body_share = root.link_chars / max(1, root.chars)
    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, body_share)
    for node in reversed(order):
        if node.tag in STRUCTURE or node is root:
            for x in node.inside:
                if isinstance(x, Node):
                    node.density_sum += x.density
                elif chars := collapsed(x):
                    node.density_sum += density(chars, 0, 0, 0, body_share)
        below = [x.best for x in node.inside if isinstance(x, Node)]
        node.best = max([node, *below], key=lambda x: x.density_sum)


def density(chars: int, tags: int, link_chars: int, link_tags: int, body_share: float) -> float:
    """Characters per tag times a logarithm that falls as links take up the text.

    Its base grows with the share of link text; it is e where that is small, so that
    text without links has a density.
    """
    if not chars:
        return 0.0
    per_tag = chars / max(1, tags)
    ratio = chars / max(1, link_chars) * max(1, tags) / max(1, link_tags)
    linked = chars / max(1, chars - link_chars) * link_chars + body_share * chars
    return per_tag * math.log(max(1.0, ratio)) / max(1.0, math.log(math.log(linked + math.e)))


def chosen(root: Node) -> set[Node]:
    """The roots of the subtrees that are the article.

    Density sums and the thresholds along the path decide on every page. A page's only
    article or main element bounds the search where the densest subtree lies inside it,
    and as a tie-break where that subtree holds it and it has the page's h1 headings.
    Headings beside the path to the densest subtree belong to it.
    """
    order = in_page_order(root)
    best = root.best
    headings = [node for node in order if node.tag == "h1" and node.chars]
    for tag in ("main", "article"):
        found = outermost(order, tag)
        if len(found) == 1:
            only = found[0]
            tied = holds(best, only) and headings and all(holds(only, node) for node in headings)
            if holds(only, best) or tied:
                root = only
    best = root.best
    path = {best}
    while best not in (root, None) and (best := best.parent) is not None:
        path.add(best)
    threshold = min(node.density for node in path)
    picked, waiting = set(), [root]
    while waiting:
        node = waiting.pop()
        if node.chars and node.density >= threshold:
            picked.add(node.best)
            waiting += [x for x in node.inside if isinstance(x, Node) and x.tag in STRUCTURE]
    return picked | {node for node in in_page_order(root) if node.tag == "h1" and node.parent in path}


def holds(outer: Node, node: Node | None) -> bool:
    while node is not None and node is not outer:
        node = node.parent
    return node is outer


def outermost(order: list[Node], tag: str) -> list[Node]:
    """Nodes of a tag that hold text and are in no other of that tag; `order` is the page's."""
    inside: set[Node] = set()
    found = []
    for node in order:
        if node.parent in inside:
            inside.add(node)
        elif node.tag == tag and node.chars:
            inside.add(node)
            found.append(node)
    return found


def blocks(root: Node, picked: set[Node]) -> list[str]:
    """White-space-collapsed texts of the blocks in the picked subtrees, in page order."""
    done: list[str] = []
    held: list[str] = []

    def end_block() -> None:
        if text := " ".join(html.unescape("".join(held)).split()):
            done.append(text)
        held.clear()

    waiting: list[tuple[object, bool]] = [(root, False)]
    while waiting:
        item, inside = waiting.pop()
        if isinstance(item, Node):
            inside = inside or item in picked
            block = item.tag in BLOCKS
            if block:
                end_block()
                waiting.append((None, inside))
            waiting += [(x, inside) for x in reversed(item.inside)]
        elif item is None:
            end_block()
        elif inside:
            held.append(item)
    end_block()
    return done


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = parse(page)
    without_furniture(root)
    measure(root)
    return "\n".join(blocks(root, chosen(root)))


def extract(pages: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """The rows of `pages` with the main `text` of their `html` and its length `n_chars`.

    NULL and empty pages, and pages without text, give an empty text. Broken markup is
    read as browsers do in the main: unclosed elements end with their parents. Pages
    are read whole. Input columns named as an output are replaced.
    """
    keep = [c for c in keep or pages.columns if c not in ("text", "n_chars")]

    def make():
        def many(found: list[str | None]):
            texts = [main_text(page) for page in found]
            return texts, [len(text) for text in texts]

        return many

    return map_rows(pages, ["html"], keep, "text string, n_chars long", make)
