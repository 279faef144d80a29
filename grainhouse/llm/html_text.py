"""Main text of web pages by tree scoring.

Paragraphs pass points for length and commas to their ancestors, in full to the parent and in halves from there on, and every
container's points are discounted by its link density. The best container is kept together with siblings that score near it or
are paragraphs of text. Navigation, headers, footers, sidebars, adverts, forms, notices and reader comments never take part.
Blocks of what is kept are joined by an empty line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from grainhouse.llm.common import batch_of, values

# Elements by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
SKIPPED = RAW | frozenset(
    "head nav header footer aside form button select option input label dialog menu object applet audio video canvas fieldset".split()
)
BLOCKS = frozenset(
    "address article blockquote body center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main ol p pre "
    "section summary table tbody td tfoot th thead tr ul caption hgroup".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6".split())
ENDS_PARAGRAPH = BLOCKS | frozenset("nav header footer aside form fieldset menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
UNWANTED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|nav\w*|menu|breadcrumbs?|side-?bar|foot(?:er)?|"
    r"header|masthead|comments?|disqus|replies|respond|cookies?|consent|gdpr|notices?|popup|modal|newsletter|subscribe|"
    r"share|sharing|social|related|recommend\w*|login|signup|search|pagination|pager|widget|hidden|skip-link)(?:$|[\s_-])",
    re.I,
)
# A tag opened while the other is open closes it.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}

_MARKUP = re.compile(r"<(?:!--|([a-zA-Z][^\s/>]*)|/([a-zA-Z][^\s/>]*)|[!?/])")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_TAG_END = re.compile(r"""(?:[^"'>]|"[^"]*"|'[^']*')*>""")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "children", "skipped", "score", "size", "linked")

    def __init__(self, tag: str, parent: Node | None, skipped: bool = False):
        self.tag, self.parent, self.skipped = tag, parent, skipped
        self.children: list[Node | str] = []
        self.score = 0.0
        self.size = self.linked = 0  # characters of text, and of those in links


def _unwanted(tag: str, attributes: str) -> bool:
    if tag in SKIPPED:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or found.get("role", "").lower() in ROLES:
        return True
    if "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    return any(UNWANTED.search(found.get(name, "")) for name in ("class", "id"))


def parse(html: str) -> Node:
    """A tree of elements and texts; tags that are left open are closed where the next block asks for it."""
    root = now = Node("html", None)
    at, size = 0, len(html)
    while at < size:
        m = _MARKUP.search(html, at)
        stop = m.start() if m else size
        if stop > at:
            now.children.append(html[at:stop])
        if not m:
            break
        opened, closed = (m[1] or "").lower(), (m[2] or "").lower()
        if html.startswith("<!--", stop):
            end = html.find("-->", stop + 2)
            at = end + 3 if end >= 0 else size
            continue
        if not opened and not closed:
            end = html.find(">", stop)
            at = end + 1 if end >= 0 else size
            continue
        tail = _TAG_END.match(html, m.end())
        end = tail.end() if tail else html.find(">", m.end()) + 1 or size
        attributes = html[m.end() : end - 1]
        at = end
        if closed:
            above = now
            while above is not root and above.tag != closed:
                above = above.parent
            # a closing tag that opens nothing here is ignored; one of an inline element does not close blocks
            if above is not root and (closed in ENDS_PARAGRAPH or not _crosses_block(now, above)):
                now = above.parent
            continue
        if opened == "body" or opened == "html":
            continue
        if opened in ENDS_PARAGRAPH:
            now = _close(now, {"p"}, {"td", "th", "table", "button", "object"}) or now
        if opened in CLOSES:
            now = _close(now, *CLOSES[opened]) or now
        node = Node(opened, now, now.skipped or _unwanted(opened, attributes))
        now.children.append(node)
        if opened in RAW and not attributes.endswith("/"):
            finish = re.compile(f"</{re.escape(opened)}[\\s/>]", re.I).search(html, at)
            if finish:
                at = html.find(">", finish.start()) + 1 or size
            elif opened in ("script", "style"):
                at = size
        elif opened not in VOID and not attributes.endswith("/"):
            now = node
        if opened == "br":
            node.children.append("\n")
    return root


def _crosses_block(node: Node, above: Node) -> bool:
    while node is not above:
        if node.tag in ENDS_PARAGRAPH:
            return True
        node = node.parent
    return False


def _close(node: Node, tags: set[str], scope: set[str]) -> Node | None:
    """The parent of the nearest open element of ``tags`` that no element of ``scope`` hides."""
    while node.parent is not None and node.tag not in scope:
        if node.tag in tags:
            return node.parent
        node = node.parent
    return None


def _walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """(node, leaving) depth first, without recursion: pages can nest deeply."""
    stack = [(root, False)]
    while stack:
        node, leaving = stack.pop()
        yield node, leaving
        if not leaving:
            stack.append((node, True))
            stack += [(c, False) for c in reversed(node.children) if isinstance(c, Node)]


def _measure(root: Node) -> list[Node]:
    """Sizes of all elements and scores of containers; the containers that got points."""
    in_link = 0
    for node, leaving in _walk(root):
        if not leaving:
            in_link += node.tag == "a"
            continue
        if not node.skipped:
            own = sum(len(" ".join(unescape(c).split())) for c in node.children if isinstance(c, str))
            node.size += own
            node.linked += own if in_link else 0
            if node.parent is not None:
                node.parent.size += node.size
                node.parent.linked += node.linked
        in_link -= node.tag == "a"
    scored: list[Node] = []
    for node, leaving in _walk(root):
        if leaving or node.skipped:
            continue
        loose = node.tag in BLOCKS and node.tag not in PARAGRAPHS and any(isinstance(c, str) and c.strip() for c in node.children)
        if (node.tag in PARAGRAPHS or loose) and (text := " ".join(_own_text(node).split())):
            points = 1 + text.count(",") + min(len(text) // 100, 3) + len(text) / 1000
            points *= 1 - node.linked / max(node.size, 1)
            above, share = (node if loose else node.parent), 1.0
            while above is not None:
                if above.score == 0.0:
                    scored.append(above)
                above.score += points * share
                above, share = above.parent, share / 2
    return scored


def _own_text(node: Node) -> str:
    """Text of an element outside blocks within it."""
    out: list[str] = []
    stack: list[Node | str] = list(reversed(node.children))
    while stack:
        child = stack.pop()
        if isinstance(child, str):
            out.append(unescape(child))
        elif not child.skipped and child.tag not in BLOCKS:
            stack += reversed(child.children)
    return "".join(out)


def _kept(root: Node) -> list[Node]:
    scored = _measure(root)
    if not scored:
        return [root]
    value = lambda n: n.score * (1 - n.linked / max(n.size, 1))
    best = max(scored, key=value)
    # an article or main element around the best container is the whole article
    above = best
    while above is not None:
        if above.tag in ("article", "main"):
            best = above
            break
        above = above.parent
    if best.parent is None:
        return [best]
    least = max(10.0, value(best) / 5)
    out = []
    for child in best.parent.children:
        if not isinstance(child, Node) or child.skipped:
            continue
        density = child.linked / max(child.size, 1)
        text = child.tag in ("p", "h1", "h2", "blockquote", "pre") and child.size and density < 0.25
        if child is best or (child.score and value(child) >= least) or text:
            out.append(child)
    return out


def _blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks of some elements, white space within each made one space."""
    out: list[str] = []
    held: list[str] = []

    def flush() -> None:
        if text := _SPACE.sub(" ", unescape("".join(held))).strip():
            out.append(text)
        held.clear()

    for top in nodes:
        stack: list[Node | str | None] = [top]
        while stack:
            node = stack.pop()
            if node is None:
                flush()
            elif isinstance(node, str):
                held.append(node)
            elif not node.skipped:
                block = node.tag in BLOCKS
                if block:
                    flush()
                    stack.append(None)
                stack += reversed(node.children)
        flush()
    return out


def main_text(html: str) -> str:
    """The blocks of the main text of a whole page, joined by an empty line; empty if there is none."""
    return "\n\n".join(_blocks(_kept(parse(html)))) if html else ""


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html); null and empty pages have an empty text.

    Null ids and urls stay null; repeated rows give repeated results; other columns are ignored.
    """
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(h or "") for h in values(batch, "html")]
            yield batch_of(schema, batch.column(0), batch.column(1), found, [*map(len, found)])

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
