"""Main text of web pages by composite text density.

A page is parsed into a tree in one pass, in time that grows with its length however many elements are open. Script,
style and other boilerplate elements (by tag, or hidden by attribute or style) leave no text; of an article's header the
headings stay.
Names (a whole class, id or role that is a word for boilerplate, alone or with words for parts of a page) are hints:
such elements leave no text either, unless they are headings, or hold the node with the largest density sum while hardly
any density is left without them, or are inside the chosen region and as dense as the threshold. For every other node
the composite density is its characters per tag, lowered by the share of link text; a node's density sum adds up its
children's densities. The node with the largest sum wins, and its subtree (with parents as dense and of comparable sum)
is the main text; other nodes beside it and in the body count where their density reaches the threshold, the least
density on the way from the winner to the body. Article and main elements only bound the region in which names are
weighed; they choose nothing.

White space inside a block becomes one space, blocks are joined by one space, character references are decoded after
parsing. Null or empty html gives an empty text. Unclosed elements end with their parents; a page that breaks off ends
all open ones. Rows that repeat give repeated rows; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Element names of HTML by role, and words that name boilerplate in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp".split())
SILENT = frozenset("aside audio button canvas dialog fieldset footer form head header iframe menu nav noscript object script select style svg template textarea title video".split())
BLOCK = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - frozenset("br body html head title caption tbody td tfoot th thead tr".split())
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("html body table ul ol dl article section main aside div nav footer header form".split())
BOILERPLATE = frozenset(
    "ad ads adsense advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs captcha comment comments consent contentinfo cookie cookies"
    " copyright disqus footer gdpr hidden login masthead menu modal nav navbar navigation navigations newsletter notice notices notification overlay pager"
    " pagination popup promo promos promotion recommended related replies respond search share sharing sidebar sidebars signup skip social sponsor sponsored subscribe"
    " subscription toolbar widget widgets".split()
)
PARTS = frozenset(
    "area bar block box button buttons container content count feed footer form group header icon icons inner item items left link links list lists module outer panel post"
    " posts right row section slot text title top bottom unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ANCHORED = frozenset("html body main".split())
#: The share of the largest density sum below which names leave too little to be right.
LITTLE = 0.05

MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*+)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
NAMED = re.compile(r"""(?:^|[\s"'/])(class|id|role|style|aria-hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)|(?:^|\s)(hidden)(?=[\s=/]|$)""", re.I)
UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\s*(?:!\s*important\s*)?(?:;|$)", re.I)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _hints(attributes: str) -> tuple[bool, bool]:
    """Whether an element is hidden, and whether one of its names is boilerplate's."""
    hidden = named = False
    for name, value, is_hidden in NAMED.findall(attributes):
        hidden = hidden or bool(is_hidden)
        if name.lower() in ("style", "aria-hidden"):
            value = entities.unescape(value.strip("\"'"))
            hidden = hidden or (value.strip().lower() == "true" if name.lower() == "aria-hidden" else bool(UNSEEN.search(value)))
            continue
        for token in value.strip("\"'").split():
            words = [w.lower() for w in WORD.findall(token)]
            named = named or any(w in BOILERPLATE for w in words) and all(w in BOILERPLATE or w in PARTS for w in words)
    return hidden, named


class Page:
    """The tree of a page: parallel lists over nodes in document order, and its texts and block edges in that order."""

    def __init__(self, source: str):
        self.tag, self.parent, self.silent, self.begin, self.end = ["html"], [-1], [False], [0], [0]
        #: The node whose silence a node shares, and (for what is silent only as an article's header) the first above that isn't.
        self.under, self.host = [-1], [0]
        #: Places of open elements in the stack, by name, and of those that bound what an end tag or a sibling can end.
        self.places: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        #: (node, text); a text of None is the edge of a block.
        self.runs: list[tuple[int, str | None]] = []
        self.body = 0
        #: Nodes with names of boilerplate.
        self.hinted: list[int] = []
        open_, at = [0], 0
        while found := MARKUP.search(source, at):
            self._text(open_[-1], source[at : found.start()])
            at = found.end()
            name = (found[2] or "").lower()
            if not name:
                continue
            if found[1]:
                self._close(open_, name)
                continue
            self._implied(open_, name)
            if name == "html":
                continue
            if name == "body":
                while len(open_) > 1:
                    self._pop(open_)
                self.body = self.body or len(self.parent)
            hidden, named = _hints(found[3]) if found[3] and name not in ANCHORED else (False, False)
            self._open(open_, name, hidden)
            if named and name not in HEADINGS and not self.silent[open_[-1]]:
                self.hinted.append(open_[-1])
            if name in VOID or found[3].endswith("/") and name not in BLOCK and name not in RAW:
                self._close(open_, name)
            elif name in RAW:
                stop = re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
                self._text(open_[-1], source[at : stop.start() if stop else len(source)])
                at = stop.end() if stop else len(source)
                self._close(open_, name)
        self._text(open_[-1], source[at:])
        for node in open_:
            self.end[node] = len(self.runs)

    def _text(self, node: int, text: str) -> None:
        if text and not self.silent[node]:
            self.runs.append((node, entities.unescape(text) if "&" in text else text))

    def _open(self, open_: list[int], name: str, hidden: bool) -> None:
        node, up = len(self.parent), open_[-1]
        # Of the header of an article the headings belong to the article.
        soft = name == "header" and "article" in self.places and bool(self.places["article"]) and not self.silent[up] or self.host[up] != up and name not in SILENT and name not in HEADINGS
        under = self.host[up] if name in HEADINGS else up
        self.tag.append(name)
        self.parent.append(up)
        self.under.append(under)
        self.silent.append(self.silent[under] or name in SILENT or hidden or soft)
        self.host.append(self.host[up] if soft and not hidden else node)
        self.begin.append(len(self.runs))
        self.end.append(0)
        self.places.setdefault(name, []).append(len(open_))
        if name in SCOPE:
            self.scopes.append(len(open_))
        open_.append(node)
        if name in BLOCK:
            self.runs.append((node, None))

    def _pop(self, open_: list[int]) -> None:
        node = open_.pop()
        self.places[self.tag[node]].pop()
        if self.scopes and self.scopes[-1] == len(open_):
            self.scopes.pop()
        if self.tag[node] in BLOCK:
            self.runs.append((node, None))
        self.end[node] = len(self.runs)

    def _end(self, open_: list[int], place: int, over: bool) -> None:
        """Ends the element at this place of the stack and all in it, unless another scope is open in it and that isn't passed over."""
        if place and (over or not self.scopes or self.scopes[-1] <= place):
            while len(open_) > place:
                self._pop(open_)

    def _close(self, open_: list[int], name: str) -> None:
        held = self.places.get(name)
        if held and name not in ("html", "body"):
            self._end(open_, held[-1], name in SCOPE)

    def _implied(self, open_: list[int], name: str) -> None:
        """Ends what an element of this name ends: an open paragraph, or its own kind in a list or table."""
        ended = ENDED_BY.get(name, set()) | ({"p"} if name in CLOSES_P else set())
        self._end(open_, max((self.places[t][-1] for t in ended if self.places.get(t)), default=0), False)

    def densities(self) -> tuple[list[float], list[float]]:
        """Composite density and density sum of each node."""
        n = len(self.parent)
        chars, tags, link_chars, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
        for node, text in self.runs:
            if text:
                chars[node] += len(text) - text.count(" ") - text.count("\n")
        for k in range(n - 1, -1, -1):
            if self.tag[k] == "a":
                link_chars[k], link_tags[k] = chars[k], link_tags[k] + 1
            if k and not self.silent[k]:
                p = self.parent[k]
                chars[p] += chars[k]
                tags[p] += tags[k] + 1
                link_chars[p] += link_chars[k]
                link_tags[p] += link_tags[k]
        share = link_chars[self.body] / max(1, chars[self.body])
        density, total = [0.0] * n, [0.0] * n
        for k in range(n - 1, -1, -1):
            if self.silent[k] or not chars[k]:
                continue
            c, t, lc, lt = chars[k], max(1, tags[k]), link_chars[k], max(1, link_tags[k])
            base = math.log(c / max(1, c - lc) * lc + share * c + math.e)
            density[k] = c / t * max(0.0, math.log(c / max(1, lc) * t / lt) / base)
            if k:
                total[self.parent[k]] += density[k]
        return density, total

    def _chosen(self) -> tuple[list[float], list[float], list[int]]:
        """Densities and their sums, and the way from the node with the largest sum to the body."""
        density, total = self.densities()
        path = [max(range(len(self.parent)), key=lambda k: (total[k], density[k], -k))]
        while path[-1] not in (0, self.body):
            path.append(self.parent[path[-1]])
        return density, total, path

    def _silence(self, certain: list[bool], hinted: set[int]) -> None:
        self.silent = list(certain)
        for k in range(1, len(self.parent)):
            self.silent[k] = self.silent[k] or k in hinted or self.silent[self.under[k]]

    def _region(self, path: list[int]) -> int | None:
        """The outermost article, else main element, around the winner or holding all of its text; else the winner, if it isn't the body."""
        best, n = path[0], len(self.parent)
        texts = [k for k, t in self.runs if t and not t.isspace() and not self.silent[k]]
        around = [k for k in reversed(path) if self.tag[k] in ("article", "main")]
        held = [0] * n
        for k in texts:
            held[k] += 1
        for k in range(n - 1, 0, -1):
            held[self.parent[k]] += held[k]
        below = [k for k in range(best + 1, n) if self.tag[k] in ("article", "main") and held[k] and held[k] == held[best]]
        all_ = around + below
        return next((k for k in all_ if self.tag[k] == "article"), all_[0] if all_ else None if best in (0, self.body) else best)

    def _weigh_hints(self) -> None:
        """Silences the elements that are boilerplate by name, but for those whose densities speak against it."""
        certain, hinted = self.silent, set(self.hinted)
        free, free_total, free_path = self._chosen()
        self._silence(certain, hinted)
        density, total, path = self._chosen()
        if hinted & set(free_path) and total[path[0]] < LITTLE * free_total[free_path[0]]:
            hinted -= set(free_path)
            self._silence(certain, hinted)
            density, total, path = self._chosen()
        region = self._region(path)
        if region is not None:
            threshold, inside = min(density[k] for k in path), [False] * len(self.parent)
            for k in range(region, len(self.parent)):
                inside[k] = k == region or inside[self.parent[k]]
            hinted -= {k for k in hinted if inside[k] and free[k] >= max(threshold, 1e-9)}
            self._silence(certain, hinted)

    def content(self) -> list[int]:
        """The nodes whose subtrees are the main text, in document order."""
        if self.hinted:
            self._weigh_hints()
        density, total, path = self._chosen()
        best, n = path[0], len(self.parent)
        last = list(range(n))  # the last node of each subtree
        for k in range(n - 1, 0, -1):
            last[self.parent[k]] = max(last[self.parent[k]], last[k])
        threshold = min(density[k] for k in path)
        inside = best
        while inside not in (0, self.body) and self.parent[inside] not in (0, self.body) and density[self.parent[inside]] >= threshold and total[self.parent[inside]] >= 0.5 * total[best]:
            inside = self.parent[inside]
        chosen = {inside}
        for k in range(1, n):
            if self.parent[k] in (self.body, self.parent[inside]) and not self.silent[k] and k != inside and not k <= inside <= last[k] and self.tag[k] != "a" and density[k] >= max(threshold, 1e-9):
                chosen.add(k)
        return sorted(chosen)

    def text(self) -> str:
        parts, reach = [], 0
        for node in self.content():
            if self.begin[node] >= reach:
                reach = self.end[node]
                parts += ["\n" if t is None else t for k, t in self.runs[self.begin[node] : reach] if t is None or not self.silent[k]]
                parts.append("\n")
        return " ".join("".join(parts).split())


def main_text(source: str | None) -> str:
    return Page(source).text() if source else ""


def extract(pages: DataFrame, html_col: str = "html", keys: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """keys, text and n_chars (code points) of each page."""

    def run(batches):
        for batch in batches:
            for part, sources in common.slices(batch, "__html"):
                texts = [main_text(s.decode()) for s in sources]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*keys, "text", "n_chars"])

    kinds = ", ".join(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keys)
    return pages.select(*keys, F.col(html_col).alias("__html")).mapInArrow(run, f"{kinds}, text string, n_chars long")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(common.table(spark, sf_dir, "pages"))
