"""HTML extraction by wrapper induction.

Pages of one host are made from few templates. The page with the smallest id is the host's
pattern; the block trees of all its pages are aligned with it by simple tree matching, each
page by itself, and every block gets the number of its partner in the pattern (its
*slot*). A slot whose text is the same on most pages of the host is template, a slot whose
text varies is content. Counting (host, slot, text) over all pages is one aggregation,
so no host's pages ever meet in one task.

What varies is not always the article, so the tree is read with the meaning of its elements:

* ``nav``, ``footer``, ``aside``, ``form``, scripts, styles and the like, hidden elements,
  and elements whose class, id or role names a menu, notice, advert, comment and so on are no
  content; a ``header`` is none outside an article. Inside an article only frames go by
  name: its paragraphs, headings, list items and tables are content whatever they are
  called;
* the article is the longest ``article``, else ``main``, else an element whose class or id says
  so and which holds most of the text, else the whole body; of a whole body blocks that
  are mostly links are left out.

A text block is a run of text between the borders of block elements; its white space becomes
one space, character references are decoded, and the blocks are joined by an empty line.
Template blocks are left out, unless nothing would be left. A host with fewer than
``min_pages`` pages has no template.

Null html: as empty; pages without text give the empty text. Null or odd urls: no host,
hence no template. Null ``page_id`` stays null; repeated rows give repeated results. Further
columns are not read. An empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from blockmill.llm import dom
from blockmill.llm.texts import map_rows
from blockmill.session import stored

# Elements that hold no article text.
NO_CONTENT = frozenset(
    "head script style noscript template svg iframe object canvas audio video nav footer aside form "
    "button select textarea input dialog menu title map noembed noframes xmp search fieldset".split()
)
# Words in class, id and role that name something beside the article.
BESIDE = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adslot sponsor sponsored sponsors "
    "promo promos promoted promotion banner comment comments commentlist reply replies respond disqus "
    "cookie cookies consent gdpr notice notices notification notifications alert newsletter subscribe subscription "
    "signup sidebar related recommended recommendations share sharing social breadcrumb breadcrumbs menu menus nav "
    "navbar navigation footer masthead popup modal overlay widget widgets pagination pager toolbar copyright "
    "login search skip complementary contentinfo discussion feedback teaser teasers side rail aside "
    "announcement announcements donate paywall topbar".split()
)
HEADERS = frozenset(["header", "banner"])
# Elements that frame other content; inside an article no others go by name.
FRAMES = frozenset("div section article main ul ol dl details summary header center hgroup address".split())
# Words in class and id that name the article of a page without article or main.
CONTENT = frozenset("article post entry story content main".split())


@dataclass(frozen=True)
class WrapperSettings:
    """A slot is template if one text fills it on ``min_share`` of at least ``min_pages`` pages."""

    min_pages: int = 5
    min_share: float = 0.8
    max_link_share: float = 0.5


def _skipped(node: dom.Node, inside: bool) -> bool:
    """Whether an element is beside the article; ``inside`` one it may have a header."""
    if node.tag in NO_CONTENT or (node.tag == "header" and not inside):
        return True
    if not node.attrs or node.tag in ("html", "body"):
        return False
    attrs = node.attributes()
    if "hidden" in attrs or attrs.get("aria-hidden") == "true":
        return True
    style = attrs.get("style", "").replace(" ", "").lower()
    if "display:none" in style or "visibility:hidden" in style:
        return True
    if inside:
        # "related" is a frame of links; a paragraph that is called so is text.
        return node.tag in FRAMES and bool(_said(attrs) & BESIDE) and not _holds_article(node)
    named = bool(_said(attrs) & (BESIDE | HEADERS))
    # A frame round the article may be called after something else that it holds.
    return named and not _holds_article(node)


def _said(attrs: dict[str, str]) -> set[str]:
    return set().union(*(dom.names(attrs.get(k, "")) for k in ("class", "id", "role")))


def _holds_article(node: dom.Node) -> bool:
    work = list(node.children)
    while work:
        child = work.pop()
        if isinstance(child, str):
            continue
        if child.tag in ("article", "main"):
            if not _said(child.attributes()) & BESIDE:
                return True
        elif child.tag not in NO_CONTENT:
            work += child.children
    return False


@dataclass(slots=True)
class Block:
    index: int
    pieces: list
    chars: int = 0
    link_chars: int = 0

    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def text_blocks(top: dom.Node, inside: bool) -> list[Block]:
    """Runs of text below an element, each with the block element that it stands in."""
    done: list[Block] = []

    done.append(Block(top.index, []))
    # Elements that are open, each with the children that are still to come.
    work = [(iter(top.children), top.index, inside, False)]
    while work:
        children, owner, within, link = work[-1]
        child = next(children, None)
        if child is None:
            work.pop()
            if work and work[-1][1] != owner:
                done.append(Block(work[-1][1], []))
        elif isinstance(child, str):
            block, size = done[-1], len(child.strip())
            block.pieces.append(child)
            block.chars += size
            block.link_chars += size if link else 0
        elif child.tag in ("br", "wbr"):
            done[-1].pieces.append(" " if child.tag == "br" else "")
        elif not _skipped(child, within):
            inner = within or child.tag in ("article", "main")
            if child.tag in dom.BLOCKS:
                done.append(Block(child.index, []))
                work.append((iter(child.children), child.index, inner, link))
            else:
                work.append((iter(child.children), owner, inner, link or child.tag == "a"))
        elif child.tag in dom.BLOCKS:
            done.append(Block(owner, []))
    return [b for b in done if b.chars]


def _is(node: dom.Node, kind: str) -> bool:
    if kind == "named":
        return node.tag in ("div", "section", "td") and bool(node.attrs) and bool(_said(node.attributes()) & CONTENT)
    return node.tag == kind or (kind == "main" and bool(node.attrs) and node.attributes().get("role") == "main")


def _tops(root: dom.Node, kind: str) -> list[dom.Node]:
    """Outermost elements of a kind that are not beside the article."""
    found, work = [], [root]
    while work:
        node = work.pop()
        for child in reversed(node.children):
            if isinstance(child, str) or _skipped(child, False):
                continue
            if _is(child, kind):
                found.append(child)
            else:
                work.append(child)
    return sorted(found, key=lambda n: n.index)


def article_blocks(root: dom.Node, settings: WrapperSettings) -> list[Block]:
    """The text blocks that the elements' meaning leaves."""
    for tag in ("article", "main"):
        tops = _tops(root, tag)
        if tops:
            blocks = max((text_blocks(t, True) for t in tops), key=lambda b: sum(x.chars for x in b))
            if blocks:
                return blocks
    blocks = [b for b in text_blocks(root, False) if b.link_chars <= settings.max_link_share * b.chars]
    named = max((text_blocks(t, True) for t in _tops(root, "named")), key=lambda b: sum(x.chars for x in b), default=[])
    # A part that is called content is believed if it holds most of the text.
    if 2 * sum(b.chars for b in named) > sum(b.chars for b in blocks):
        return named
    return blocks


PAGES = "page_id long, url string, host string, slots array<int>, texts array<string>"


class Aligner:
    """Slots of a page's blocks in its host's pattern."""

    def __init__(self):
        self._matcher, self._patterns = dom.Matcher(), {}

    def __call__(self, page: dom.Frame, pattern: str) -> dict[int, int]:
        if self._matcher.fresh() or len(self._patterns) > 1000:
            self._patterns.clear()
        frame = self._patterns.get(pattern)
        if frame is None:
            frame = self._patterns[pattern] = self._matcher.sign(dom.from_skeleton(pattern))
        found: dict[int, int] = {}
        self._matcher.pairs(self._matcher.sign(page), frame, found)
        return found


def _host() -> Column:
    host = F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    return F.when(host != "", host)


def _patterns(pages: DataFrame) -> DataFrame:
    """``host, pattern``: the block tree of one page of each host."""
    first = pages.filter("host is not null and page_id is not null").groupBy("host").agg(F.min("page_id").alias("page_id"))
    chosen = pages.select("host", "page_id", "html").join(stored(first, "first-pages"), ["host", "page_id"])

    def make():
        def rows(hosts, texts):
            for host, text in zip(hosts, texts):
                yield host, dom.skeleton(dom.number(dom.parse(text or "")))

        return rows

    made = map_rows(chosen, ["host", "html"], "host string, pattern string", make)
    return stored(made.groupBy("host").agg(F.min("pattern").alias("pattern")), "patterns")


def page_blocks(pages: DataFrame, settings: WrapperSettings) -> DataFrame:
    """``page_id, url, host, slots, texts`` of every row of ``page_id, url, html``; slot -1 has no partner."""
    hosted = pages.select("page_id", "url", _host().alias("host"), "html")
    patterns = _patterns(hosted)

    def make():
        align = Aligner()

        def rows(page_ids, urls, hosts, texts, patterns):
            for page_id, url, host, text, pattern in zip(page_ids, urls, hosts, texts, patterns):
                root = dom.parse(text or "")
                frame = dom.number(root)
                blocks = article_blocks(root, settings)
                slots = align(frame, pattern) if pattern and blocks else {}
                found = [(slots.get(b.index, -1), b.text()) for b in blocks]
                found = [(s, t) for s, t in found if t]
                yield page_id, url, host, [s for s, _ in found], [t for _, t in found]

        return rows

    joined = hosted.join(patterns, "host", "left")
    return map_rows(joined, ["page_id", "url", "host", "html", "pattern"], PAGES, make)


def _constants(blocks: DataFrame, settings: WrapperSettings) -> DataFrame:
    """``host, constants``: the (slot, text hash) pairs that are template."""
    pages = blocks.filter("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    pages = pages.filter(F.col("pages") >= settings.min_pages)
    filled = blocks.select("host", F.explode(F.array_distinct(F.transform(
        F.arrays_zip("slots", "texts"), lambda b: F.struct(b["slots"].alias("slot"), F.xxhash64(b["texts"]).alias("body"))
    ))).alias("b")).select("host", "b.*").filter("host is not null and slot >= 0")
    counts = filled.groupBy("host", "slot", "body").agg(F.count(F.lit(1)).alias("n"))
    constant = counts.join(pages, "host").filter(F.col("n") >= settings.min_share * F.col("pages"))
    return constant.groupBy("host").agg(F.collect_set(F.struct("slot", "body")).alias("constants"))


def extract_articles(pages: DataFrame, settings: WrapperSettings = WrapperSettings()) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``page_id, url, html``."""
    blocks = stored(page_blocks(pages, settings), "page-blocks")
    constants = stored(_constants(blocks, settings), "template-slots")
    both = F.arrays_zip("slots", "texts")
    varying = F.filter(both, lambda b: ~F.array_contains(
        F.col("constants"), F.struct(b["slots"].alias("slot"), F.xxhash64(b["texts"]).alias("body"))
    ))
    kept = F.when(F.col("constants").isNotNull() & (F.size(varying) > 0), F.transform(varying, lambda b: b["texts"]))
    text = F.array_join(F.coalesce(kept, F.col("texts")), "\n\n")
    return (
        blocks.join(constants, "host", "left").select("page_id", "url", text.alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
    )
