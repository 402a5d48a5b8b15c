"""A small HTML tree: blocks, their text, and simple tree matching of two trees."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

# One piece of markup; text is what lies between two. Quoted attribute values may hold ">".
_MARK = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*+)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_NAMES = re.compile(r"[a-z]+|[A-Z][a-z]*|[0-9]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RAW_TEXT = frozenset("title textarea".split())
BLOCKS = frozenset(
    "html body p h1 h2 h3 h4 h5 h6 div section article main header footer nav aside ul ol li dl dt dd "
    "table caption thead tbody tfoot tr td th blockquote pre figure figcaption form fieldset address "
    "details summary dialog center hr menu legend hgroup search".split()
)
# An opening tag ends these open elements, unless a bound stands between.
_CLOSES = {
    **dict.fromkeys(BLOCKS - {"html", "body"}, frozenset(["p"])),
    "li": frozenset(["li", "p"]), "dt": frozenset(["dt", "dd", "p"]), "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]), "td": frozenset(["td", "th", "p"]), "th": frozenset(["td", "th", "p"]),
    "option": frozenset(["option"]),
}
_BOUNDS = frozenset("html body div section article main aside nav header footer ul ol dl table td th blockquote form".split())
_LIST_BOUNDS = {"li": frozenset(["ul", "ol", "menu"]), "dt": frozenset(["dl"]), "dd": frozenset(["dl"]),
                "tr": frozenset(["table", "thead", "tbody", "tfoot"]), "td": frozenset(["tr", "table"]),
                "th": frozenset(["tr", "table"])}
# Block elements nested deeper than this take no part in alignment, which goes down by recursion.
MAX_ALIGNED = 100


@dataclass(slots=True)
class Node:
    tag: str
    attrs: str = ""
    children: list = field(default_factory=list)  # nodes and strings
    index: int = 0

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(self.attrs)}


def parse(text: str) -> Node:
    """The tree of a page. Unclosed and stray tags are mended, comments left out."""
    root = Node("#root")
    stack, at, end = [root], 0, len(text)
    opened: Counter[str] = Counter()  # by tag, of the elements on the stack

    def say(piece: str, decode: bool = True) -> None:
        if piece:
            stack[-1].children.append(html.unescape(piece) if decode and "&" in piece else piece)

    def close(first: int) -> None:
        for node in stack[first:]:
            opened[node.tag] -= 1
        del stack[first:]

    while at < end:
        mark = _MARK.search(text, at)
        if mark is None:
            say(text[at:])
            break
        say(text[at: mark.start()])
        at = mark.end()
        tag = mark["tag"] or mark["tag2"]
        if tag is None:
            continue
        tag = tag.lower()
        if mark["end"] or mark["end2"]:
            if opened[tag]:
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        closes = _CLOSES.get(tag)
        if closes and any(opened[t] for t in closes):
            bounds, cut = _LIST_BOUNDS.get(tag, _BOUNDS), len(stack)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in bounds:
                    break
                if stack[k].tag in closes:
                    cut = k
            close(cut)
        attrs = mark["attrs"] or mark["attrs2"] or ""
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in RAW or tag in RAW_TEXT:
            ended = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(text, at)
            stop = ended.start() if ended else end
            if tag in RAW_TEXT:
                node.children.append(html.unescape(text[at:stop]))
            at = stop
        elif tag not in VOID and not (attrs.endswith("/") and tag not in BLOCKS):
            stack.append(node)
            opened[tag] += 1
    return root


def names(value: str) -> set[str]:
    """The words of a class list or an id."""
    return {n.lower() for n in _NAMES.findall(value)}


# Alignment works on the block elements alone: (tag, children, size, signature).
@dataclass(slots=True)
class Frame:
    tag: str
    children: list
    index: int
    size: int = 1
    signature: int = 0


class Matcher:
    """Simple tree matching; equal shapes are known by number, so most work is a look-up."""

    def __init__(self, most: int = 100_000):
        self._most = most
        self._shapes: dict[tuple, int] = {}
        self._weights: dict[tuple[int, int], int] = {}

    def fresh(self) -> bool:
        """Forget shapes when there are too many; frames made before are then void."""
        if len(self._shapes) + len(self._weights) <= self._most:
            return False
        self._shapes.clear()
        self._weights.clear()
        return True

    def sign(self, frame: Frame) -> Frame:
        for child in frame.children:
            self.sign(child)
        frame.size = 1 + sum(c.size for c in frame.children)
        key = (frame.tag, *(c.signature for c in frame.children))
        frame.signature = self._shapes.setdefault(key, len(self._shapes))
        return frame

    def weight(self, a: Frame, b: Frame) -> int:
        """Most nodes that can be paired with order and parents kept."""
        if a.tag != b.tag:
            return 0
        if a.signature == b.signature:
            return a.size
        key = (a.signature, b.signature)
        if key not in self._weights:
            low, high, table = self._table(a.children, b.children)
            ends = sum(c.size for c in a.children[:low]) + sum(c.size for c in a.children[len(a.children) - high:])
            self._weights[key] = 1 + ends + table[-1][-1]
        return self._weights[key]

    def _table(self, a: list[Frame], b: list[Frame]) -> tuple[int, int, list[list[int]]]:
        """Equal ends are paired outright; the rest by dynamic programming."""
        low, most = 0, min(len(a), len(b))
        while low < most and a[low].signature == b[low].signature:
            low += 1
        high = 0
        while high < most - low and a[-1 - high].signature == b[-1 - high].signature:
            high += 1
        inner_a, inner_b = a[low: len(a) - high], b[low: len(b) - high]
        table = [[0] * (len(inner_b) + 1)]
        for x in inner_a:
            above, row = table[-1], [0]
            for k, y in enumerate(inner_b):
                row.append(max(row[k], above[k + 1], above[k] + self.weight(x, y)))
            table.append(row)
        return low, high, table

    def pairs(self, a: Frame, b: Frame, out: dict[int, int]) -> None:
        """Index in ``a`` to index in ``b`` of all paired nodes; the roots have one tag."""
        out[a.index] = b.index
        low, high, table = self._table(a.children, b.children)
        both = list(zip(a.children[:low], b.children[:low]))
        if high:
            both += zip(a.children[-high:], b.children[-high:])
        i, j = len(table) - 1, len(table[0]) - 1
        while i and j:
            x, y = a.children[low + i - 1], b.children[low + j - 1]
            weight = self.weight(x, y)
            if weight and table[i][j] == table[i - 1][j - 1] + weight:
                both.append((x, y))
                i, j = i - 1, j - 1
            elif table[i][j] == table[i - 1][j]:
                i -= 1
            else:
                j -= 1
        for x, y in both:
            self.pairs(x, y, out)


def number(root: Node) -> Frame:
    """Number the block elements and give the tree of those near enough to the root."""
    top, count = Frame("#root", [], 0), 1
    work = [(root, top, 0)]
    while work:
        node, frame, depth = work.pop()
        for child in node.children:
            if isinstance(child, str):
                continue
            if child.tag in BLOCKS:
                child.index, inner = count, Frame(child.tag, [], count)
                count += 1
                if depth < MAX_ALIGNED:
                    frame.children.append(inner)
                work.append((child, inner, depth + 1))
            else:
                work.append((child, frame, depth))
    return top


def skeleton(frame: Frame) -> str:
    """The tree as text: each node's depth and tag, parents first."""
    out, work = [], [(frame, 0)]
    while work:
        node, depth = work.pop()
        out.append(f"{depth}:{node.index}:{node.tag}")
        work += [(c, depth + 1) for c in reversed(node.children)]
    return " ".join(out)


def from_skeleton(text: str) -> Frame:
    path: list[Frame] = []
    for item in text.split(" "):
        depth, index, tag = item.split(":", 2)
        node = Frame(tag, [], int(index))
        del path[int(depth):]
        if path:
            path[-1].children.append(node)
        path.append(node)
    return path[0]
