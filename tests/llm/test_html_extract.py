import random

import pytest

from blockmill.llm import dom, html_extract as H
from llm_cases import prose

PAGES = "page_id long, url string, html string"


def text_of(page):
    root = dom.parse(page)
    dom.number(root)
    return [b.text() for b in H.article_blocks(root, H.WrapperSettings()) if b.text()]


@pytest.mark.parametrize("page,want", [
    ("", []),
    ("plain &amp; simple", ["plain & simple"]),
    ("<p>one<p>two<br>three&nbsp;&#233;", ["one", "two three é"]),
    ("<ul><li>a<li><p>b</ul>c", ["a", "b", "c"]),
    ("<article><h1>T</h1><b>x <i>y</b> z</article><footer>f</footer>", ["T", "x y z"]),
    ("<script>var a='</p><p>x';</script><style>p{}</style><!-- <p>c</p> --><p>d", ["d"]),
    ("<body><header>H</header><main><header><h1>T</h1></header><p>t</p></main>", ["T", "t"]),
    ("<div class='cookie-notice'>c</div><div id=comments>k</div><p>t</p>", ["t"]),
    ("<p title='a>b'>t</p><p hidden>h</p><p style='display: none'>n</p>", ["t"]),
    ("<article><p>t</p><div class=adBox>ad</div><article class=comment><p>long long comment</p></article></article>", ["t"]),
    ("<table><tr><td>a<td>b<tr><th>c</table>", ["a", "b", "c"]),
    ("<p>unclosed <a href=\"x>t", ["unclosed t"]),
    ("a < b and b > c", ["a < b and b > c"]),
    ("<textarea><p>no</textarea><title>no</title><p>yes", ["yes"]),
    ("<div class='page has-sidebar'><main><p>t</p></main></div><div id=side-bar>s</div>", ["t"]),
    ("<div>Site</div><div id=content><p>" + "long text " * 9 + "</p></div><div>Imprint</div>", [("long text " * 9).strip()]),
    ("<div id=content>c</div><div>much more text outside of it</div>", ["c", "much more text outside of it"]),
    ("<article><p>t</p></article><section id=comments><article class=comment>c</article><p>Reply</p></section>", ["t"]),
    ("<nav>" * 300 + "deep" + "</nav>" * 300 + "<p>t", ["t"]),
    ("<div>" * 3000 + "deep", ["deep"]),
])
def test_blocks(page, want):
    assert text_of(page) == want


def slow_weight(a, b):
    """Simple tree matching, straight from its recurrence."""
    if a.tag != b.tag:
        return 0
    table = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children, 1):
        for j, y in enumerate(b.children, 1):
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + slow_weight(x, y))
    return 1 + table[-1][-1]


def test_matching_is_the_best():
    rng = random.Random(3)

    def tree(depth):
        node = dom.Frame(rng.choice("pd"), [], 0)
        if depth:
            node.children = [tree(depth - 1) for _ in range(rng.randint(0, 4))]
        return node

    def numbered(top):
        work, n = [top], 0
        while work:
            node = work.pop()
            node.index, n = n, n + 1
            work += node.children
        return top

    for _ in range(300):
        a, b = (numbered(dom.Frame("r", [tree(2) for _ in range(rng.randint(0, 4))], 0)) for _ in range(2))
        matcher, found = dom.Matcher(), {}
        matcher.sign(a), matcher.sign(b)
        matcher.pairs(a, b, found)
        assert matcher.weight(a, b) == slow_weight(a, b) == len(found) == len(set(found.values()))
        assert dom.skeleton(dom.from_skeleton(dom.skeleton(a))) == dom.skeleton(a)


def site(k):
    """Two hosts without telling tags: the template can only be told by comparing pages."""
    blocks = [f"<div>Welcome to site</div><div><h2>{prose(k, 4)}</h2>"]
    blocks += [f"<p>{prose(100 * k + j, 12)}</p>" for j in range(1 + k % 3)]
    return "<html><body>" + "".join(blocks) + "</div><div>Printed on paper</div></body></html>"


def test_template_blocks_go(spark):
    rows = [(k, f"https://one.example/{k}", site(k)) for k in range(12)]
    rows += [(100 + k, f"http://user@TWO.example:80/{k}", site(k)) for k in range(3)]  # too few pages
    got = {r["page_id"]: r for r in H.extract_articles(spark.createDataFrame(rows, PAGES).repartition(4)).collect()}
    for k in range(12):
        body = [prose(k, 4)] + [prose(100 * k + j, 12) for j in range(1 + k % 3)]
        assert got[k]["text"].split("\n\n") == body
        assert got[k]["n_chars"] == len(got[k]["text"])
    for k in range(3):
        assert got[100 + k]["text"].startswith("Welcome to site\n\n")


def test_equal_articles_are_not_emptied(spark):
    rows = [(k, f"http://same.example/{k}", "<article><p>the same</p></article>") for k in range(9)]
    assert {r["text"] for r in H.extract_articles(spark.createDataFrame(rows, PAGES)).collect()} == {"the same"}


def test_edge_rows(spark):
    rows = [(1, None, None), (2, "odd", ""), (3, "http://a/", "<p>t"), (3, "http://a/", "<p>t"), (None, "http://a/", "<p>n"),
            (4, "http://a/", "<p>" + prose(1, 20_000))]
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 as host", "2 as slots", "3 as texts", "4 as pattern")
    got = sorted((tuple(r) for r in H.extract_articles(frame).collect()), key=repr)
    want = [(1, None, "", 0), (2, "odd", "", 0), (3, "http://a/", "t", 1), (3, "http://a/", "t", 1),
            (None, "http://a/", "n", 1), (4, "http://a/", prose(1, 20_000), len(prose(1, 20_000)))]
    assert got == sorted(want, key=repr)
    assert H.extract_articles(spark.createDataFrame([], PAGES)).count() == 0


def test_paragraphs_of_an_article_stay_whatever_they_are_called():
    names = ["class=side-note", "class=discussion", "class=related", "class=feedback-loop", "id=alert-levels"]
    page = "<body><p class=related>links</p><article>" + "".join(f"<p {n}>{n}</p>" for n in names)
    page += "<h2 class=notice>h</h2><blockquote class=comment>q</blockquote><p>x <math>a+b</math></p>"
    page += "<div class=related>more</div><ul class=share><li>s</li></ul></article>"
    assert text_of(page) == [*names, "h", "q", "x a+b"]


@pytest.mark.parametrize("depth", [50, 101, 200, 20_000])
def test_rules_hold_at_any_depth(depth):
    inner = "<nav>menu</nav><article><p>text</p></article><div class=comments>bad</div>"
    assert text_of("<body>" + "<div>" * depth + inner + "</div>" * depth + "<footer>f</footer>") == ["text"]
