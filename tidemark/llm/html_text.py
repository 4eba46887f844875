"""The main text of a web page, by a graphical model of its tree.

Each element is a node that is either content (main text, or holding it) or
boilerplate. The model is a tree of parent-child potentials:

* a child of boilerplate is boilerplate;
* a plain element that is all there is in its parent is what its parent is;
* a child of content is content by odds that its features give: its tag, alone
  and within its parent's, where the tag says what it is for; the words of its
  class, id and role; whether it has none; and whether it lies outside the page's
  main or article element;
* an element without a telling tag, whose words say nothing against it, follows
  its parent;
* within the main or article element a class or id speaks against text only if
  all its words are known from labelled pages, or if the text is mostly links:
  a comment box goes, a chapter named comment-policy stays;
* a node's own text pulls it to content by its share of the page's text, and text
  that is mostly links pulls the other way.

Messages are summed from the leaves up and from the root down, and a piece of
text is kept if the marginal of the element that it stands in favours content.
The odds are counted, and the pulls chosen, on labelled pages (`labelled_pages`).

Elements that hold no text to read (scripts, styles, the head, form controls) are
left out before. Text between the borders of block elements is one block; its
white space becomes single spaces, blocks are joined by an empty line.

Pages are not shuffled; a task holds one page's tree at a time.

Defined results: null or empty html, and a page that is all boilerplate, give
the empty text; markup that is not closed ends where its parent ends; text
without markup is content; rows that repeat are extracted each; an empty table
gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import cache
from html.parser import HTMLParser
from math import exp, log, log1p

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.labelled_pages import PAGES

#: Elements by their part in a page.
BLOCKS = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td
    tfoot th thead tr ul""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(
    """audio button canvas datalist head iframe map noframes noscript object optgroup option script select style
    svg template textarea title video""".split()
)
#: An element that starts ends these, up to the element named.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
CELLS = frozenset("td th caption table body html".split())

#: Elements whose tag says what they are for.
TELLING = frozenset("article aside footer form header main nav search figure table blockquote".split())
SMOOTHING = 0.1
#: What a word of a class or id can say for content at most, and from which odds
#: on a word that was seen with both says anything.
WORD_FOR_CONTENT, UNDECIDED = 1.0, 1.0
#: Log-odds of an element that nothing speaks against to follow its parent.
FOLLOWS = 4.0
#: Log-odds against content below boilerplate.
CLOSED = 12.0
#: Fixed value: a whole comment.
_comment_end = re.compile(r"<!--(?:-?>|.*?--!?>)", re.S)
_token = re.compile(r"[A-Za-z][a-z]*|[A-Z]+")


class Node:
    __slots__ = ("tag", "parent", "tokens", "names", "own", "links", "hidden", "linked", "marked")

    def __init__(self, tag: str, parent: int, tokens: tuple[str, ...], hidden: bool, linked: bool, marked: bool, names=()):
        self.tag, self.parent, self.tokens, self.names = tag, parent, tokens, names
        self.hidden, self.linked, self.marked = hidden, linked, marked
        self.own = self.links = 0  # characters of text directly in it, and of those within links


class Tree(HTMLParser):
    """Nodes in page order, and pieces of text as (node, text); node -1 is the border of a block."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("#page", -1, (), False, False, False)]
        self.tags: Counter = Counter()  # of the open elements
        self.pieces: list[tuple[int, str]] = []
        self.open = [0]
        self.feed(html)
        self.close()

    def parse_comment(self, i: int, report: bool = True) -> int:
        """A comment that is not closed hides the rest. The parser asks where markup may stand
        only, so not in scripts, styles and attributes; in a title or text area it is text."""
        if self.nodes[self.open[-1]].tag in ("title", "textarea"):
            return i + len("<!--")
        end = _comment_end.match(self.rawdata, i)
        return end.end() if end else len(self.rawdata)

    def _close(self, depth: int) -> None:
        for n in self.open[depth:]:
            self.tags[self.nodes[n].tag] -= 1
            if self.nodes[n].tag in BLOCKS:
                self.pieces.append((-1, ""))
        del self.open[depth:]

    def _find(self, tags: Iterable[str], stops: Iterable[str]) -> int:
        if not any(self.tags[tag] for tag in tags):
            return 0
        for depth in range(len(self.open) - 1, 0, -1):
            tag = self.nodes[self.open[depth]].tag
            if tag in tags:
                return depth
            if tag in stops:
                break
        return 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "br":
            self.pieces.append((self.open[-1], " "))
        if tag in ENDS:
            ended, stops = ENDS[tag]
            while depth := self._find(ended, stops):
                self._close(depth)
        if tag in BLOCKS:
            if depth := self._find({"p"}, CELLS):
                self._close(depth)
            self.pieces.append((-1, ""))
        if tag in VOID:
            return
        values = dict(attrs)
        named = " ".join(values.get(a) or "" for a in ("class", "id"))
        names = [tuple("word:" + t.lower() for t in _token.findall(name)) for name in named.split()]
        tokens = {word for name in names for word in name}
        if values.get("role"):
            tokens.add("role:" + values["role"].lower())
        style = (values.get("style") or "").replace(" ", "").lower()
        if "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style:
            tokens.add("word:hidden")
        parent = self.nodes[self.open[-1]]
        self.nodes.append(
            Node(
                tag,
                self.open[-1],
                tuple(sorted(tokens)),
                parent.hidden or tag in SILENT,
                parent.linked or tag == "a",
                "b" in values,
                names,
            )
        )
        self.tags[tag] += 1
        self.open.append(len(self.nodes) - 1)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag == "p" and not self._find({"p"}, CELLS):
            self.pieces.append((-1, ""))
        elif depth := self._find({tag}, () if tag in BLOCKS or tag in SILENT else BLOCKS):
            self._close(depth)

    def handle_data(self, data: str) -> None:
        at = self.open[-1]
        node = self.nodes[at]
        if not node.hidden:
            self.pieces.append((at, data))
            size = len(data.strip())
            node.own += size
            node.links += size * node.linked


def _totals(nodes: list[Node], field: str) -> list[int]:
    """Of each node and all in it."""
    totals = [getattr(n, field) for n in nodes]
    for n in range(len(nodes) - 1, 0, -1):
        totals[nodes[n].parent] += totals[n]
    return totals


def _mains(nodes: list[Node]) -> set[int]:
    main = {n for n, x in enumerate(nodes) if x.tag == "main" or "role:main" in x.tokens}
    return main or {n for n, x in enumerate(nodes) if x.tag == "article"}


def _inside(nodes: list[Node]) -> list[bool]:
    """Whether each node lies within one of the page's main elements."""
    main, inside = _mains(nodes), [False] * len(nodes)
    for n in range(1, len(nodes)):
        inside[n] = inside[nodes[n].parent] or nodes[n].parent in main
    return inside


def _places(nodes: list[Node]) -> list[bool]:
    """Whether each node lies outside of the page's main elements; never, if it has none."""
    main = _mains(nodes)
    if not main:
        return [False] * len(nodes)
    inside, above = _inside(nodes), set()
    for n in main:
        while n >= 0 and n not in above:
            above.add(n)
            n = nodes[n].parent
    return [not inside[n] and n not in above for n in range(len(nodes))]


def features(nodes: list[Node], n: int, outside: list[bool]) -> list[str]:
    """Named elements by tag and parent, others by the words of their attributes, or as plain."""
    node = nodes[n]
    found = [*node.tokens, *(["outside"] if outside[n] else [])]
    if node.tag in TELLING:
        found += ["tag:" + node.tag, f"in:{node.tag}<{nodes[node.parent].tag}"]
    elif not node.tokens:
        found.append("plain")
    return found


class Model:
    """Log-odds of a feature for a content parent's child to be content, and the pulls of text."""

    def __init__(self, pages: Iterable[str]):
        trees = [Tree(page) for page in pages]
        labels = [self._labels(tree.nodes) for tree in trees]
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
        children = {True: 0, False: 0}
        for tree, label in zip(trees, labels):
            outside = _places(tree.nodes)
            for n in range(1, len(tree.nodes)):
                if label[tree.nodes[n].parent] and not tree.nodes[n].hidden:
                    children[label[n]] += 1
                    counts[label[n]].update(features(tree.nodes, n, outside))
        self.prior = log(children[True] / children[False])
        self.odds = {}
        for f in counts[True].keys() | counts[False].keys():
            yes, no = ((counts[y][f] + SMOOTHING) / (children[y] + 2 * SMOOTHING) for y in (True, False))
            self.odds[f] = log(yes / no)
            if f.startswith("word:"):  # boilerplate is named for what it is; content may have any name
                both = counts[True][f] and counts[False][f] and abs(self.odds[f]) < UNDECIDED
                self.odds[f] = 0.0 if both else min(WORD_FOR_CONTENT, self.odds[f])

        def likelihood(pulls: tuple[float, float]) -> float:
            self.text_pull, self.link_pull = pulls
            return sum(
                log(max(1e-9, p if y else 1 - p))
                for tree, label in zip(trees, labels)
                for p, y in zip(self.marginals(tree.nodes), label)
            )

        self.text_pull, self.link_pull = max(((a, b) for a in (0.0, 1.0, 2.0) for b in (0.0, 1.0, 2.0)), key=likelihood)

    @staticmethod
    def _labels(nodes: list[Node]) -> list[bool]:
        label = [True]
        for node in nodes[1:]:
            label.append(label[node.parent] and not node.marked)
        return label

    def _doubtful(self, node: Node) -> set[str]:
        """Words that speak against a node only as part of names with a word that is not known: such
        a name may mean anything, as related-work or share-of-market do."""
        told = {word for name in node.names if all(w in self.odds for w in name) for word in name}
        return {word for name in node.names for word in name} - told

    def potentials(self, nodes: list[Node]) -> tuple[list[float], list[float], list[float]]:
        """Logs, for each node: of being content by itself; of content and of boilerplate below content."""
        sizes, links = _totals(nodes, "own"), _totals(nodes, "links")
        outside, page = _places(nodes), max(1, sizes[0])
        children = Counter(node.parent for node in nodes)
        inside = _inside(nodes)
        own, to_yes, to_no = [], [], []
        for n, node in enumerate(nodes):
            own.append((self.text_pull * (node.own - node.links) - self.link_pull * node.links) / page)
            plain = node.tag not in TELLING and not node.tokens
            if plain and children[node.parent] == 1 and not nodes[node.parent].own:
                odds = CLOSED  # alone in its parent: the same thing
            else:
                # in the main element, and with more than links in it, a name alone must be clear
                unclear = self._doubtful(node) if inside[n] and 2 * links[n] < sizes[n] else ()
                found = [self.odds.get(f, 0.0) for f in features(nodes, n, outside) if f not in unclear]
                odds = self.prior + sum(found)
                if node.tag not in TELLING and min(found, default=0.0) >= 0:
                    odds = max(odds, FOLLOWS)
            to_yes.append(-_log_sum(0.0, -odds))
            to_no.append(-_log_sum(0.0, odds))
        own[0] += CLOSED  # the page itself holds what there is
        return own, to_yes, to_no

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content for each node, by sum-product messages up and down the tree."""
        belief, to_yes, to_no = self.potentials(nodes)
        up = [0.0] * len(nodes)
        for n in range(len(nodes) - 1, 0, -1):  # up: what a node says for content of its parent
            below_content = _log_sum(to_yes[n] + belief[n], to_no[n])
            below_boilerplate = _log_sum(belief[n] - CLOSED, 0.0)
            up[n] = below_content - below_boilerplate
            belief[nodes[n].parent] += up[n]
        for n in range(1, len(nodes)):  # down: the parent's belief without this node's own message
            rest = belief[nodes[n].parent] - up[n]
            belief[n] += _log_sum(rest + to_yes[n], -CLOSED) - _log_sum(rest + to_no[n], 0.0)
        return [1 / (1 + exp(-max(-500.0, min(500.0, b)))) for b in belief]


def _log_sum(a: float, b: float) -> float:
    return max(a, b) + log1p(exp(-abs(a - b)))


@cache
def learned() -> Model:
    return Model(PAGES)


def main_text(html: str | None, model: Model | None = None) -> str:
    """Blocks of main text, joined by an empty line."""
    tree = Tree(html or "")
    keep = [p >= 0.5 for p in (model or learned()).marginals(tree.nodes)]
    blocks, block = [], []
    for n, text in [*tree.pieces, (-1, "")]:
        if n >= 0:
            if keep[n]:
                block.append(text)
        elif block:
            blocks.append(" ".join("".join(block).split()))
            block = []
    return "\n\n".join(b for b in blocks if b)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each page."""
    model = learned()

    def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py(), model) for html in batch.column("html")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    pages = pages.select("page_id", "url", "html")
    schema = pages.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema
    return pages.mapInArrow(each, schema)


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extracted(table(spark, sf_dir, "pages"))
