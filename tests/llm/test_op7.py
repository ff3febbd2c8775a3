"""Main texts of hand-made and of the driver's pages."""

import html
import math
import os
import random
import re
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from convolake.llm import op7_html as op7

LONG = "Some words of the main text, quite a few of them, so that it weighs enough."
CASES = [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a b"), ("a<br>b<b>c</b>d", "a bcd"),
    (f"<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>{LONG}</p></article><footer>f</footer>", f"T {LONG}"),
    (f"<div class=ad>x</div><div><p>{LONG}</p><p>{LONG}</p></div><div id='sidebar'>q</div>", f"{LONG} {LONG}"),
    (f"<main class='content has-sidebar'><p>{LONG}</p><aside>no</aside><form><p>no</p></form></main><div class='comments'><p>{LONG} no</p></div>", LONG),
    ("<article><p>a&nbsp;b &amp;lt; &#233;&hellip;</p><script>if (a < b) '</p>'</script><style>p{}</style><p>c</article>", "a b &lt; é… c"),
    ("<article>x <!-- <p>no</p> --> y <![CDATA[z]]> w</article>", "x y w"),
    ("<article><ul><li>one<li>two</ul><table><tr><td>a<td>b<tr><td>c</table></article>", "one two a b c"),
    ("<ARTICLE><P CLASS='Share-Buttons'>no</P><P>yes</ARTICLE>", "yes"),
    ("<article><p>broken off in the <b>midd", "broken off in the midd"), ("<p>1 < 2 and 3 > 2", "1 < 2 and 3 > 2"), ("<a href='x>y'>t</a", "t"),
    (f"<article class=comment>{LONG} no</article><article><p>the article</p></article>", "the article"),
]


@pytest.mark.parametrize("source,want", CASES)
def test_cases(source, want):
    assert op7.main_text(source) == want


HINTS = [
    (f"<article><p>{LONG}</p><section id='search-algorithms'><h2 id='related-work'>H</h2><p>short</p></section></article>", f"{LONG} H short"),
    (f"<body><nav>n</nav><div class='layout has-sidebar'><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG} {LONG}"),
    (f"<article class='post no-comments'><p>{LONG}</p></article>", LONG),
    (f"<div class='search'><article><h1 class=share>T</h1><p>{LONG}</p></article></div>", f"T {LONG}"),
    (f"<div id='related'><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG} {LONG}"),
    (f"<article><p>{LONG}</p><div class='notice'><p>{LONG} {LONG}</p></div><div class='share-buttons'><a>x</a><a>y</a></div></article>", f"{LONG} {LONG} {LONG}"),
    (f"<article><p>{LONG}</p></article><div class='comments'><p>{LONG} {LONG} {LONG}</p></div>", LONG),
    (f"<article><p>{LONG}</p><p hidden>{LONG} {LONG}</p></article>", LONG),
]


@pytest.mark.parametrize("source,want", HINTS)
def test_names_are_hints(source, want):
    assert op7.main_text(source) == want


def test_odd_rows(spark):
    rows = [(1, "u", "<article>a</article>", "clash"), (1, "u", "<article>a</article>", "clash"), (None, None, None, None), (3, "v", "<p>" + "long word " * 50_000, "x"), (4, "w", "<div>" * 30_000 + "deep", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").withColumn("n_chars", F.lit("clash"))
    got = sorted((tuple(r) for r in op7.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "a", 1), (1, "u", "a", 1), (None, None, "", 0), (3, "v", ("long word " * 50_000).strip(), 499_999), (4, "w", "deep", 4)], key=str)
    assert op7.extract(df.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the driver's tables")
def test_pages_hold_their_articles():
    for source in pd.read_parquet("/root/testdata/sf0.1/pages.parquet").html:
        inner = re.search(r"<article>(.*?)(</article>|$)", source, re.S)[1]
        inner = re.sub(r"<[^>]*>", "", re.sub(r"<br>|</?p>|</?h1>", " ", inner))
        assert op7.main_text(source) == " ".join(html.unescape(inner).split())


def _tree(rng, depth=0):
    """A random element: (tag, texts and elements)."""
    tag = "p" if depth > 3 else rng.choice(["div", "div", "section", "article", "a", "b"] if depth else ["div"])
    inner = []
    for _ in range(rng.randint(1, 4)):
        inner.append(" ".join(rng.choice(["ab", "cde", "fghi"]) for _ in range(rng.randint(1, 12))) if tag in ("p", "a", "b") or rng.random() < 0.3 else _tree(rng, depth + 1))
    return tag, inner


def _source(node):
    return node if isinstance(node, str) else f"<{node[0]}>" + "".join(map(_source, node[1])) + f"</{node[0]}>"


def _chars(node, linked=None):
    """Characters of a subtree that are no spaces: all, or those in links."""
    if isinstance(node, str):
        return len(node.replace(" ", "")) if linked in (None, True) else 0
    inside = True if linked is not None and node[0] == "a" else linked
    return sum(_chars(x, inside) for x in node[1])


def _tags(node, kind=None):
    return sum((kind is None or x[0] == kind) + _tags(x, kind) for x in node[1] if not isinstance(x, str))


def _density(node, body):
    c, lc = _chars(node), _chars(node, False)
    t, lt = max(1, _tags(node)), max(1, _tags(node, "a") + (node[0] == "a"))
    base = math.log(c / max(1, c - lc) * lc + _chars(body, False) / max(1, _chars(body)) * c + math.e)
    return c / t * max(0.0, math.log(c / max(1, lc) * t / lt) / base)


def _elements(node):
    yield node
    for x in node[1]:
        if not isinstance(x, str):
            yield from _elements(x)


def test_densities_against_their_definition():
    rng = random.Random(7)
    for _ in range(200):
        body = ("body", [_tree(rng) for _ in range(rng.randint(1, 4))])
        page = op7.Page(_source(body))
        density, total = page.densities()
        own = list(_elements(body))
        assert page.tag[page.body :] == [x[0] for x in own]
        want = [_density(x, body) for x in own]
        assert density[page.body :] == pytest.approx(want)
        sums = [sum(_density(y, body) for y in x[1] if not isinstance(y, str)) for x in own]
        assert total[page.body :] == pytest.approx(sums)
        # The winner, and nothing below the least density of its way to the body.
        best = max(range(len(own)), key=lambda k: (round(sums[k], 9), round(want[k], 9), -k))
        if sums[best] > max([s for k, s in enumerate(sums) if k != best], default=0) + 1e-6:
            chosen = [max(0, k - page.body) for k in page.content()]  # the root stands for the body
            assert any(id(own[best]) in map(id, _elements(own[k])) for k in chosen)
            way = [x for x in own if id(own[best]) in map(id, _elements(x))]
            assert all(want[k] >= min(_density(x, body) for x in way) - 1e-9 for k in chosen)


def test_article_elements_choose_nothing():
    page = f"<body><article><p>ad</p></article><div><p>{LONG}</p><p>{LONG}</p></div></body>"
    assert op7.main_text(page) == f"{LONG} {LONG}"
    assert op7.main_text(page.replace("article", "div")) == f"{LONG} {LONG}"


def _stack_walk(source):
    """Names of the ancestors of each text, as the rules say, walking the stack for each tag."""
    open_, out = ["html"], []
    for found in re.finditer(r"<(/?)(\w+)>|([^<]+)", source):
        if found[3]:
            out.append((found[3], tuple(open_)))
            continue
        name = found[2]
        ended = op7.ENDED_BY.get(name, set()) | ({"p"} if name in op7.CLOSES_P else set()) if not found[1] else {name}
        over = bool(found[1]) and name in op7.SCOPE
        for k in range(len(open_) - 1, 0, -1):
            if open_[k] in ended:
                del open_[k:]
                break
            if open_[k] in op7.SCOPE and not over:
                break
        if not found[1]:
            open_.append(name)
    return out


def test_ends_against_a_walk_of_the_stack():
    rng = random.Random(5)
    for _ in range(3000):
        source = "".join(rng.choice(["<{}>", "<{}>", "</{}>"]).format(rng.choice("b i p p div ul li li table tr td section dd dt a".split())) + rng.choice(["", "x", "yy"]) for _ in range(rng.randint(1, 25)))
        page = op7.Page(source)

        def way(k):
            return (*way(page.parent[k]), page.tag[k]) if k > 0 else ("html",)

        assert [(t, way(k)) for k, t in page.runs if t] == _stack_walk(source), source


@pytest.mark.parametrize("source", ["<b>" * 100_000 + "<div>" * 100_000 + "x", "<div>" * 100_000 + "</section>" * 100_000 + "x", "<p>x<i>" * 100_000, "<ul><li>x<b>" * 60_000 + "</p>" * 60_000])
def test_many_open_elements(source):
    began = time.perf_counter()
    assert "x" in op7.main_text(source)
    assert time.perf_counter() - began < 20


def test_what_is_not_shown():
    for hidden in ('style="display:none"', "style='color:red; DISPLAY : none !important'", 'style="visibility:hidden"', 'aria-hidden="true"', "hidden"):
        page = f"<body><article><h1>T</h1><p>{LONG}</p><p {hidden}>unseen words</p><p>{LONG}</p></article></body>"
        assert op7.main_text(page) == f"T {LONG} {LONG}", hidden
    for shown in ('style="display:block"', 'aria-hidden="false"', 'data-style="display:none"', 'style="x-display:none"'):
        assert "seen words" in op7.main_text(f"<body><article><p>{LONG}</p><p {shown}>seen words</p><p>{LONG}</p></article></body>"), shown


def test_headings_of_an_articles_header():
    page = f"<body><header><h1>Site</h1></header><article><header><div><h1>Title <i>x</i></h1></div><nav><h2>Menu</h2></nav><p>By A. B.</p></header><p>{LONG}</p><p>{LONG}</p></article></body>"
    assert op7.main_text(page) == f"Title x {LONG} {LONG}"
    named = page.replace("<p>By", '<div class="share">share it</div><p>By')
    assert op7.main_text(named) == f"Title x {LONG} {LONG}"
