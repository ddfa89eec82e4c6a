"""Main text of web pages: flat text blocks judged by a decision tree.

A page is cut into flat blocks at its block-level tags.  Each block is described by its words and
link density, by those of the blocks before and after it, and by the containers it stands in.  A
decision tree, trained on the small labelled table below, says which blocks are main text.

Scripts, styles, titles and comments are no text, and a head holds nothing else; it may be left open,
as text or a tag that cannot stand in it ends it.  noscript, template, svg, textarea, iframe and object are
left out where they are closed.  The words in class, id and role of the body, and of the page's first main
(without one, its first article) and what holds it, do not make it boilerplate; nor do, on a page without
main and article, those of a container that holds most of the page's words.  Inside main text a header
holds the text's own head.  Character references are decoded, white
space inside a block becomes one blank, and the blocks that are kept are joined by line ends.  Null
and empty pages and pages without main text give an empty text; pages of any length are read whole,
also where tags are not closed; repeated rows are treated alike; empty tables give empty results.
Extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimrisk.llm.frames import map_batches

# Every alternative goes forward only: a tag that is not closed ends at the next bracket.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|title)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)([^<>]*+)>|</?[a-zA-Z][^<>]*+\Z|([^<]++|<)",
    re.S | re.I)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = frozenset("noscript template svg textarea iframe object".split())
INLINE = frozenset(
    "a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small "
    "span strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset(
    "article aside body div dl fieldset figure footer form header main menu nav ol section table "
    "ul blockquote details dialog button select".split())
AROUND = frozenset("nav footer aside form menu button select dialog".split())
AROUND_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus dialog foot footer form gdpr header login masthead menu modal "
    "nav navbar navigation newsletter notice notification pager pagination popup promo promotion "
    "recommended related replies reply responses search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe tags teaser toolbar topbar widget".split())
MAIN_TAGS = frozenset(("article", "main"))
HEAD_NAMES = frozenset("header masthead".split())  # inside the main text they hold its own head
MAIN_NAMES = frozenset("article body content entry main post story text".split())
MOST = 4  # a container wraps its page if it holds more than 3 of 4 words
FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after",
            "around", "main", "heading")


class Block:
    __slots__ = ("parts", "words", "linked", "around", "main", "heading", "inside")

    def __init__(self, inside: int, main: int, heading: bool):
        self.parts: list[str] = []
        self.words = self.linked = self.around = 0
        self.inside, self.main, self.heading = inside, main, heading


def tokens_of(page: str) -> Iterator[tuple[int, int, bool, str, str, str, str | None]]:
    """Start, end, whether it is dropped, slash, tag, attributes and text of each token of a page."""
    for token in TOKEN.finditer(page):
        dropped, slash, tag, attributes, slash2, tag2, attributes2, text = token.groups()
        yield (token.start(), token.end(), bool(dropped), slash or slash2 or "", (tag or tag2 or "").lower(),
               attributes or attributes2 or "", text)


def _names(attributes: str) -> set[str]:
    """Words in class, id and role."""
    return {w for found in NAMES.findall(attributes) for w in re.split(r"[^a-z]+", "".join(found).lower())}


def _hidden(page: str) -> dict[int, int]:
    """Where elements that are no text start and end; only those that are closed."""
    out: dict[int, int] = {}
    opened: dict[str, list[int]] = {tag: [] for tag in HIDDEN}
    if not any(f"<{tag}" in page.lower() for tag in HIDDEN):
        return out
    for start, end, _, closing, tag, attributes, _ in tokens_of(page):
        if tag in HIDDEN:
            if closing:
                if opened[tag]:
                    out[opened[tag].pop()] = end
            elif attributes.endswith("/"):
                out[start] = end
            else:
                opened[tag].append(start)
    return out


def blocks_of(page: str) -> Iterator[Block]:
    """The flat text blocks of a page, in order."""
    hidden, until = _hidden(page), 0
    stack: list[tuple[str, int, int]] = []  # tag, number of the container, main
    depth: dict[str, int] = {}  # how often a tag is open
    containers = [(0, False, False)]  # number of the parent, around by its tag, by its names
    holding: dict[str, set[int]] = {}  # containers around the first main and the first article
    blocks, block, in_link, heading = [], Block(0, 0, False), 0, False
    for start, _, dropped, closing, tag, attributes, text in tokens_of(page):
        if start < until:
            continue
        if text is not None:
            text = html.unescape(text) if "&" in text else text
            n = len(text.split())
            block.parts.append(text)
            block.words += n
            block.linked += n * bool(in_link)
            continue
        if dropped or not tag:
            continue
        if tag in HIDDEN:
            until = hidden.get(start, 0)
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if closing else 1
            elif tag == "br":
                block.parts.append(" ")
            continue
        if block.words:
            blocks.append(block)
        in_link = 0
        if tag in CONTAINERS:
            if closing:
                while depth.get(tag):
                    last = stack.pop()[0]
                    depth[last] -= 1
                    if last == tag:
                        break
            elif not attributes.endswith("/"):
                _, inside, main = stack[-1] if stack else ("", 0, 0)
                names = _names(attributes)
                own_main = tag in MAIN_TAGS or bool(names & MAIN_NAMES)
                if tag in MAIN_TAGS and tag not in holding:  # its own names do not make it boilerplate either
                    holding[tag] = {number for _, number, _ in stack} | {len(containers)}
                stack.append((tag, len(containers), main + own_main))
                depth[tag] = depth.get(tag, 0) + 1
                containers.append((inside, tag in AROUND or tag == "header" and not main, tag != "body" and bool(
                    names & (AROUND_NAMES - HEAD_NAMES if main else AROUND_NAMES))))
        heading = not closing and len(tag) == 2 and tag[0] == "h" and tag[1].isdigit()
        _, inside, main = stack[-1] if stack else ("", 0, 0)
        block = Block(inside, main, heading)
        if not closing and tag not in CONTAINERS and attributes and _names(attributes) & AROUND_NAMES:
            block.around = 1  # a paragraph of its own class
    if block.words:
        blocks.append(block)
    whole = holding.get("main", holding.get("article"))
    if whole is None:
        whole = _wrapping(containers, blocks)
    around = [0] * len(containers)
    for i, (parent, by_tag, by_names) in enumerate(containers):
        around[i] = around[parent] + (by_tag or by_names and i not in whole)
    for block in blocks:
        block.around += around[block.inside]
        yield block


def _wrapping(containers: list[tuple[int, bool, bool]], blocks: list[Block]) -> set[int]:
    """Containers that hold most of a page's words outside links: they wrap the page itself."""
    held = [0] * len(containers)
    for block in blocks:
        held[block.inside] += block.words - block.linked
    for i in range(len(containers) - 1, 0, -1):
        held[containers[i][0]] += held[i]
    return {i for i, n in enumerate(held) if MOST * n > (MOST - 1) * held[0]}


def described(blocks: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block."""
    words = [float(b.words) for b in blocks]
    links = [b.linked / b.words for b in blocks]
    rows = zip(words, links, [0.0, *words], [0.0, *links], [*words[1:], 0.0], [*links[1:], 0.0],
               (b.around for b in blocks), (b.main for b in blocks), (b.heading for b in blocks))
    return np.array([tuple(map(float, r)) for r in rows]).reshape(-1, len(FEATURES))


# The labelled table: blocks of small pages; a block that starts with + is main text, with - not.
LABELLED = [
    "<nav><ul><li><a href=/>-Home</a><li><a href=/n>-News of today</a></ul></nav><div class=ad>-Buy "
    "this and that for less money in our shop today</div><article><h1>+A title</h1><p><b>+A first "
    "line.<br><p>+Short.</p><p>+A longer paragraph with a good many words in it, which goes on for a "
    "while and ends here.</p><p>+One <a href=/x>link</a> among other words of it</p></article>"
    "<footer>-(c) us - a line at the end of the page with many words in it for the law</footer>",
    "<div id=header><a href=/>-Logo</a> of us</div><div class=menu><a href=/a>-One</a> <a href=/b>Two"
    "</a></div><div id=content><h2>+Title of it</h2><p>+The story begins here and it has many words, "
    "as stories do, which is how we know them.</p><p>+Yes.</p></div><div class=sidebar><h3>-Popular"
    "</h3><p>-Read what others read, it is all very good and there are many more of them</p></div>"
    "<div id=footer><p>-All rights reserved by the people who made this page some years ago</p></div>",
    "<header><h1>-Our site</h1><p>-A claim that we made up for our site</p></header><main><h1>+Story"
    "</h1><p>+Some text that is the main text of the page and so is kept whole.</p><form><p>-Leave "
    "your address here and we will write to you every day of the week</p><button>-Send</button>"
    "</form><p>+Text that goes on after it.</p><section class=comments><h3>-2 comments</h3><p>-I do "
    "not agree with this at all, it is wrong in all its parts and I say so</p></section></main>",
    "<div class='cookie notice'><p>-We use cookies to make this page better for you and for us and "
    "all our friends</p></div><article class=post><header><h1>+Head of it</h1></header><p>+Words of "
    "the article in a row, more of them than in the blocks around.</p><ul><li>+first point of it"
    "<li>+second point</ul><div class=related><a href=/1>-Other story</a></div><blockquote>+A word "
    "that somebody said</blockquote></article><aside><p>-About us: we write what we like to read, "
    "and you may read what we write</p></aside>",
    "<body><table><tr><td><a href=/1>-One</a><td><a href=/2>-Two</a></table><p>+A page without any "
    "container has its text in long paragraphs, which is all that tells them from the rest.</p><p>+"
    "The next one is long as well, with commas, and words that say something to the reader.</p><p>"
    "<a href=/up>-up</a> <a href=/next>next page</a></p><p>-2010 us</p>",
    "<body><p><a href=/>-start</a></p><h1>+What came of it</h1><p>+It came to this, that a heading "
    "stands before a long block of text and belongs to it.</p><p>+More of it is said in this second "
    "long block, which ends the page, all in all a short one.</p><p>-print</p>",
    "<div><a href=/>-Us</a></div><div>-Welcome here</div><article><h1>+What ends a page</h1><p>+The "
    "last block of the page may well be main text.</p><p>+The end.</p></article>",
    "<div class=topbar>-Call us</div><p>-Tuesday</p><div class=entry><p>+First</p><p>+Then comes a "
    "longer block of main text, and it is not the last one.</p><p>+Last one of them</p></div>",
    "<body><p><a href=/a>-All the news of this day</a></p><p>-You are here on our pages</p><p><a "
    "href=/b>-More of the news of today</a></p><h2>+How it all went</h2><p>+It went on for some time, "
    "as such things do, and nobody could say for how long.</p><p>+Then it came to an end.</p><p>+The "
    "end was told in a last block, as long as the first one was, and that was that.</p><p><a href=/c>"
    "-Read the next story of the day</a></p><p>-Told by us to you and all</p><p><a href=/d>-Write to "
    "us about this page here</a></p>",
    "<div class=banner>-This is an offer that ends today, so do not wait and see but call us now and "
    "we will bring you two of them for the price of one</div><div class=advert>-Buy one of ours, it "
    "is the best there is and it lasts a lifetime and then some more, as all our customers say who "
    "bought one</div><p>+Where nothing else says so, long blocks of words are the text of a page, and "
    "the ones beside them are long as well.</p><p>+So is this one, which comes after it and has as "
    "many words as one can expect of such a block.</p><div class=comments><p>-I read all of this and "
    "I must say that I have never seen a page with so many words that say so little to me</p><p>-And "
    "I for one think that it is the best page on this subject, and I have read all of the others "
    "there are</p></div><div id=footer>-We do not answer for what others write here, nor for what "
    "comes of it, in any land or at any time, as the law says</div>",
    "<div>-Print it</div><main><p>+Only this</p></main><div>-Top of it</div>",
    "<body><div class='page has-sidebar'><h1>+Where the road ends</h1><p>+The road ends at a lake, which is as long "
    "as it is deep, and there one can sit.</p><p>+In spring the lake is full of birds, and in autumn of boats that "
    "nobody has taken in.</p></div>",
    "<body><div id=wrap><p><a href=/>-start of it all</a></p><h1>+A walk in the hills</h1><p>+One goes up in the "
    "morning, when it is cool, and comes down when the sun has gone.</p><p>+Yes, that is what they do.</p><p>+There is "
    "water on the way, and <a href=/w>a place to rest</a> for those who want one.</p><h2>+What to take</h2><p>+Take "
    "bread, and a coat for the evening, and leave the rest at home.</p><p><a href=/m>-more walks like this one</a></p>"
    "</div>",
    "<html><head><title>t</title><meta charset=utf-8><body class='has-sidebar'><div id=page class='nav-open'>"
    "<div class=menu><a href=/>-Home</a></div><article><h1>+A head without an end</h1><p>+The text of a page whose "
    "head is not closed is main text all the same.</p><p>+So it is.</p></article><div class=sidebar><p>-Read what "
    "others read, there are many more of them here</p></div></div>",
]


class Tree:
    """A binary classification tree by Gini impurity, grown until its leaves are pure."""

    def __init__(self, rows: np.ndarray, labels: np.ndarray):
        self.feature, self.value = -1, bool(2 * labels.sum() >= len(labels))
        best = len(labels) * self._impurity(labels)
        if best == 0:
            return
        for f in range(rows.shape[1]):
            values = np.unique(rows[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                left = rows[:, f] <= cut
                total = (left.sum() * self._impurity(labels[left])
                         + (~left).sum() * self._impurity(labels[~left]))
                if total < best - 1e-9:
                    best, self.feature, self.cut = total, f, float(cut)
        if self.feature >= 0:
            left = rows[:, self.feature] <= self.cut
            self.low, self.high = Tree(rows[left], labels[left]), Tree(rows[~left], labels[~left])

    @staticmethod
    def _impurity(labels: np.ndarray) -> float:
        p = labels.mean()
        return float(2 * p * (1 - p))

    def judge(self, rows: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(rows), self.value)
        out, left = np.empty(len(rows), bool), rows[:, self.feature] <= self.cut
        out[left] = self.low.judge(rows[left])
        out[~left] = self.high.judge(rows[~left])
        return out


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    rows, labels = [], []
    for page in LABELLED:
        blocks = list(blocks_of(page))
        rows.append(described(blocks))
        labels += ["".join(b.parts).strip()[0] == "+" for b in blocks]
    return np.concatenate(rows), np.array(labels)


def extract(page: str, tree: Tree) -> str:
    blocks = list(blocks_of(page))
    if not blocks:
        return ""
    return "\n".join(" ".join("".join(b.parts).split())
                     for b, keep in zip(blocks, tree.judge(described(blocks))) if keep)


def main_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in ("page_id", "url"))

    def work():
        tree = Tree(*labelled_table())

        def function(rows):
            texts = [extract(page, tree) for page in rows["html"]]
            return {"page_id": rows["page_id"], "url": rows["url"], "text": texts,
                    "n_chars": [len(t) for t in texts]}
        return function

    return map_batches(
        pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")),
        f"page_id {id_type}, url {url_type}, text string, n_chars long", work)
