"""Main text of web pages: boosted trees over the nodes of the document tree, decoded so that no choice contradicts another.

A node's class is content if there is main text in it. The trees give each node's log odds; decoding keeps or drops whole
subtrees: a dropped node drops all below it, and what is kept has kept ancestors. The kept text runs are the blocks.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesdq.llm import words as W
from salesdq.llm.trees import BoostedTrees

#: Pages taken for training, nodes of them at most, and bytes of a page that teaches.
TRAINING_PAGES, TRAINING_NODES, TRAINING_BYTES = 600, 40_000, 256 << 10
#: Element names by their meaning in HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style iframe textarea title".split())
#: Elements that hold other things than running text: nodes that count as clutter. A start tag without its end tag opens none.
EMBEDDED = frozenset("svg select object noscript template".split())
EMBEDDED_START = re.compile(r"<(/?)(svg|select|object|noscript|template)\b", re.I)
FORMULA = "math semantics annotation mrow mi mn mo ms mtext mspace mfrac msqrt mroot mstyle merror mpadded mphantom menclose mfenced msub msup msubsup munder mover munderover mmultiscripts mprescripts none mtable mtr mtd".split()
INLINE = frozenset("a abbr b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()) | frozenset(FORMULA)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table body html div article section main aside nav header footer form td th".split())
#: Elements and attribute tokens that say what they hold; pages that have both kinds teach the model.
CONTENT = frozenset("article main".split())
BOILERPLATE = frozenset("nav footer header aside form button dialog menu".split())
CLUTTER = re.compile(
    r"(?:^|[-_])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notices?|popup|modal|newsletter|subscribe|comments?|replies|respond|"
    r"disqus|sidebar|related|recommend\w*|share|social|breadcrumbs?|menu|nav\w*|pager|pagination|foot\w*|head(?:er)?|masthead|login|signup|search|widget)(?:$|[-_])"
)
ARTICLE_TOKENS = re.compile(r"(?:^|[-_])(?:article|articlebody|content|entry|main|post|story|body|text)(?:$|[-_])")
TAG_START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
SIGNS = re.compile(r"[>\"']")
TOKENS = re.compile(r"(?:^|[-_])(?:article|articlebody|content|entry|main|post|story|body|text)(?:$|[-_])")
TAG = re.compile(r"<(?:!--.*?(?:-->|$)|[!?][^>]*(?:>|$)|(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>)", re.S)
TOKENS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
SPACES = re.compile(r"\s+")
NAMES = "#text p div article main section nav header footer aside form ul ol li h1 h2 h3 table td blockquote pre figure body".split()
NUMBER = {name: i for i, name in enumerate(NAMES)}
FEATURES = len(NAMES) + 23


class TagEnds:
    """Where tags end: at the first > outside quotes. Found for all places of a page in one pass from its end, so no tag, however
    its quotes are broken, is searched twice."""

    def __init__(self, page: str):
        signs = [(m.start(), m.group()) for m in SIGNS.finditer(page)]
        self.places = [at for at, _ in signs]
        n = len(signs)
        self.ends = [-1] * (n + 1)  # from each sign on, outside quotes; -1: nowhere
        later = {'"': n, "'": n}  # the next sign of the kind; n: none
        for i in range(n - 1, -1, -1):
            at, sign = signs[i]
            if sign == ">":
                self.ends[i] = at
            else:
                self.ends[i] = self.ends[later[sign] + 1] if later[sign] < n else -1
                later[sign] = i

    def after(self, place: int) -> int:
        """Place of the > that ends a tag whose name ends at ``place``, or -1."""
        return self.ends[bisect_left(self.places, place)]


def closed_starts(page: str, ends: TagEnds) -> set[int]:
    """Places of the EMBEDDED start tags that have an end tag of their own; of nested ones the inner have the first."""
    out: set[int] = set()
    waiting: dict[str, list[int]] = {}
    done = 0
    for m in EMBEDDED_START.finditer(page):
        end = ends.after(m.end())
        if m.start() < done or end < 0:
            continue
        done = end + 1
        name = m[2].lower()
        places = waiting.setdefault(name, [])
        if not m[1]:
            if page[end - 1] != "/" or name != "svg":
                places.append(m.start())
        elif places:
            out.add(places.pop())
    return out


class Open:
    """The open elements of a page, outermost first, with the places of each name and of those that are not inline."""

    def __init__(self) -> None:
        self.items: list[tuple[str, int]] = []  # name and node; inline ones have that of their block
        self.by_name: dict[str, list[int]] = {}
        self.blocks: list[int] = []  # not inline
        self.solid: list[int] = []  # neither inline nor p

    def __len__(self) -> int:
        return len(self.items)

    def node(self) -> int:
        return self.items[-1][1] if self.items else 0

    def push(self, name: str, node: int) -> None:
        at = len(self.items)
        self.items.append((name, node))
        self.by_name.setdefault(name, []).append(at)
        if name not in INLINE:
            self.blocks.append(at)
            if name != "p":
                self.solid.append(at)

    def pop(self) -> str:
        name, _ = self.items.pop()
        self.by_name[name].pop()
        if name not in INLINE:
            self.blocks.pop()
            if name != "p":
                self.solid.pop()
        return name

    def last(self, names) -> int:
        """Place of the innermost of these elements, or -1."""
        return max((places[-1] for name in names if (places := self.by_name.get(name))), default=-1)

    def only_inline_from(self, place: int) -> bool:
        return not self.blocks or self.blocks[-1] < place

    def only_p_from(self, place: int) -> bool:
        """Whether there are but p and inline elements from a place on."""
        return not self.solid or self.solid[-1] < place


class Tree:
    """Block elements and text runs of a page, in order: parent, name, tokens of class, id and role, text and link characters."""

    def __init__(self, page: str):
        self.parent, self.names, self.tokens, self.texts = [-1], ["html"], [()], [""]
        self.links, self.tags, self.children, self.place = [0], [0], [0], [0]
        #: depth; clutter and article tokens of its own and above; boilerplate and content elements, itself included
        self.above: list[tuple[int, int, int, int, int, int, int]] = [(0,) * 7]
        open_ = Open()
        run: list[str] = []
        anchors, linked, drawings = 0, 0, 0
        ends = TagEnds(page)
        closed = closed_starts(page, ends)
        raw_ended: dict[str, bool] = {}

        def add(name: str, tokens: tuple = (), text: str = "", links: int = 0) -> int:
            up = open_.node()
            own_clutter = int(name in EMBEDDED or any(map(CLUTTER.search, tokens)))
            own_article = int(any(map(ARTICLE_TOKENS.search, tokens))) if tokens else 0
            depth, c, clutter, a, article, boiler, inside = self.above[up]
            self.above.append((depth + 1, own_clutter, clutter + c, own_article, article + a, boiler + (name in BOILERPLATE), inside + (name in CONTENT)))
            self.children[up] += 1
            self.place.append(self.children[up])
            self.children.append(0)
            self.parent.append(up)
            self.names.append(name)
            self.tokens.append(tokens)
            self.texts.append(text)
            self.links.append(links)
            self.tags.append(0)
            return len(self.names) - 1

        def flush() -> None:
            nonlocal linked
            if run:
                text = SPACES.sub(" ", html.unescape("".join(run))).strip()
                if text:
                    add("#text", (), text, min(linked, len(text)))
                run.clear()
            linked = 0

        def close(place: int) -> None:
            """Close all from a place on."""
            nonlocal anchors, drawings
            while len(open_) > place:
                if open_.items[-1][0] not in INLINE:
                    flush()
                name = open_.pop()
                anchors -= name == "a"
                drawings -= name == "svg"

        at, size = 0, len(page)
        while at < size:
            begin = page.find("<", at)
            if begin < 0:
                begin = size
            if begin > at:
                run.append(page[at:begin])
                linked += (begin - at) if anchors else 0
            if begin == size:
                break
            if page.startswith(("!", "?"), begin + 1):
                mark = "-->" if page.startswith("!--", begin + 1) else ">"
                end = page.find(mark, begin + len(mark) + 1 if mark == "-->" else begin + 2)
                at = size if end < 0 else end + len(mark)
                continue
            m = TAG_START.match(page, begin)
            end = ends.after(m.end()) if m else -1
            if end < 0:
                run.append("<")
                at = begin + 1
                continue
            at = end + 1
            name, rest = m[2].lower(), page[m.end() : end]
            if m[1]:
                place = open_.last((name,))
                if name == "br":
                    run.append(" ")
                elif place >= 0 and (name not in INLINE or open_.only_inline_from(place)):
                    close(place)
                elif name == "p":
                    flush()
                continue
            if name in RAW:
                stop = None
                if raw_ended.get(name, True):
                    stop = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, at)
                    raw_ended[name] = stop is not None
                end = page.find(">", stop.end()) if stop else -1
                at = size if end < 0 else end + 1
                continue
            if name in EMBEDDED and begin not in closed or drawings and rest.endswith("/"):
                continue
            if name in INLINE or name in VOID:
                self.tags[open_.node()] += 1
                if name in ("br", "img", "hr", "wbr"):
                    run.append(" ")
                    if name == "hr":
                        flush()
                elif name not in VOID and not rest.rstrip().endswith("/"):
                    open_.push(name, open_.node())
                    anchors += name == "a"
                continue
            flush()
            if name in CLOSES_P:
                place = open_.last(("p",))
                if place >= 0 and open_.only_p_from(place):
                    close(place)
            if name in SAME:
                place = open_.last(SAME[name])
                if place >= 0 and place >= open_.last(SCOPE):
                    close(place)
            words = " ".join(x for found in TOKENS.findall(rest) for x in found).lower().split() if rest else ()
            open_.push(name, add(name, tuple(words)))
            drawings += name == "svg"
        flush()
        if not self.texts:
            self.texts = [""]

    def labels(self) -> np.ndarray | None:
        """Content or not by the page's own marks: text in an article or main element outside all clutter; None without such an element."""
        if not any(x in CONTENT for x in self.names):
            return None
        n = len(self.names)
        good, bad = np.zeros(n, bool), np.zeros(n, bool)
        for i in range(1, n):
            p = self.parent[i]
            bad[i] = bad[p] or self.names[i] in BOILERPLATE or self.names[i] in EMBEDDED or any(CLUTTER.search(t) for t in self.tokens[i])
            good[i] = good[p] or self.names[i] in CONTENT
        label = good & ~bad & np.array([x == "#text" for x in self.names])
        for i in range(n - 1, 0, -1):
            if label[i]:
                label[self.parent[i]] = True
        return label

    def decode(self, margins: np.ndarray) -> list[str]:
        """Texts of the kept runs under the most likely choice: of a node and all below it dropped, or it kept and its children chosen."""
        parent, n = self.parent, len(self.names)
        drop = (-np.logaddexp(0, margins)).tolist()  # log of 1 - p
        keep = (np.array(drop) + margins).tolist()
        for i in range(n - 1, 0, -1):
            p = parent[i]
            drop[p] += drop[i]
            keep[p] += max(keep[i], drop[i])
        kept, out = [True] * n, []
        for i in range(1, n):
            kept[i] = kept[parent[i]] and keep[i] > drop[i]
            if kept[i] and self.texts[i]:
                out.append(self.texts[i])
        return out


def features(trees: list[Tree]) -> tuple[np.ndarray, np.ndarray]:
    """A row for each node of all trees, and where each tree's rows end."""
    sizes = [len(t.names) for t in trees]
    ends = np.cumsum(sizes)
    first = ends - sizes
    parent = np.concatenate([t.parent for t in trees])
    roots = parent < 0
    up = np.where(roots, np.arange(len(parent)), parent + np.repeat(first, sizes))
    texts = [x for t in trees for x in t.texts]
    names = [x for t in trees for x in t.names]
    above = np.array([x for t in trees for x in t.above], float)
    depth = above[:, 0].astype(int)
    children, place = (np.array([x for t in trees for x in getattr(t, k)], float) for k in ("children", "place"))
    own = [
        [len(x) for x in texts],
        [x.count(" ") + 1 if x else 0 for x in texts],
        [x.count(".") + x.count(",") + x.count(";") if x else 0 for x in texts],
        [x for t in trees for x in t.links],
        [x + 1 for t in trees for x in t.tags],
        [x == "#text" for x in names],
    ]
    chars = np.array(own[0], float)
    before = np.cumsum(chars) - chars
    before -= np.repeat(before[first], sizes)
    sums = np.array(own, float)
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1)
    for at in levels[:0:-1]:  # from the deepest nodes up
        for s in sums:
            np.add.at(s, up[at], s[at])
    c, w, st, ln, tg, rn = sums
    total = np.maximum(np.repeat(c[first], sizes), 1)
    siblings = np.where(roots, 0, children[up])
    number = np.array([NUMBER.get(x, -1) for x in names])
    marked = np.repeat(np.maximum.reduceat(above[:, 6], first) > 0, sizes).astype(float)
    named = (number[:, None] == np.arange(len(NAMES))).astype(float)
    rows = [
        np.log1p(c), c / total, c / tg, w / np.maximum(rn, 1), st / np.maximum(w, 1), ln / np.maximum(c, 1), np.log1p(tg), rn,
        above[:, 0], place, siblings, place / np.maximum(siblings, 1), children, before / total,
        *above[:, 1:].T, c / np.maximum(c[up], 1), ln[up] / np.maximum(c[up], 1), marked,
    ]
    return np.column_stack([named, *rows]), ends


def withheld(rows: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Features without what defines the labels in the rows ``where``: counts of boilerplate and content elements, whether the page
    is marked, and the names article and main, which become div."""
    at, rows = len(NAMES), rows.copy()
    marks = [NUMBER["article"], NUMBER["main"]]
    rows[where, NUMBER["div"]] += rows[where][:, marks].sum(axis=1)
    rows[np.ix_(np.flatnonzero(where), [*marks, at + 18, at + 19, at + 22])] = 0
    return rows


def taken(sizes: list[int], n_nodes: int) -> np.ndarray:
    """Which nodes teach: ``n_nodes`` in all at most, as many of each page as all can have, by the hash of their places."""
    cap, left = 0, n_nodes
    for i, size in enumerate(sorted(sizes)):  # small pages leave their share to the others
        cap = left // (len(sizes) - i)
        if size > cap:
            break
        cap, left = size, left - size
    out = []
    for size in sizes:
        chosen = np.ones(size, bool)
        if size > cap:
            chosen[np.argsort(W.mixed(np.arange(1, size + 1, dtype=np.uint64)))[cap:]] = False
        out.append(chosen)
    return np.concatenate(out)


def train(pages: DataFrame, n_pages: int = TRAINING_PAGES, n_nodes: int = TRAINING_NODES) -> BoostedTrees | None:
    """Fit the trees on the pages of the ``n_pages`` smallest hashes of page_id and html that have an article or main element.

    Labels come from the pages' own marks. Each page teaches twice, as it is and with its marks withheld, so that density, tokens
    and siblings decide on pages without marks. The sample is bounded by ``n_pages``, ``n_nodes`` and TRAINING_BYTES for a page: a first
    pass finds the hashes, of which a task sends its ``n_pages`` smallest, a second one these pages, each once. Without any labelled
    page there is no model.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("html").cast("string").alias("html"))
    marked = source.where((F.octet_length("html") <= TRAINING_BYTES) & F.lower("html").rlike("<(article|main)[ >]"))
    hashed = marked.withColumn("h", F.xxhash64("page_id", "html"))
    last = hashed.select("h").distinct().orderBy("h").limit(n_pages).agg(F.max("h")).first()[0]
    taught = hashed.where(F.col("h") <= last).groupBy("h").agg(F.min("html").alias("html")).orderBy("h").collect() if last is not None else []
    trees, ys = [], []
    for _, page in taught:
        tree = Tree(page)
        label = tree.labels()
        if label is not None:
            trees.append(tree)
            ys.append(label)
    if not trees:
        return None
    chosen = taken([len(y) for y in ys], n_nodes)
    rows, label = features(trees)[0][chosen], np.concatenate(ys)[chosen].astype(float)
    return BoostedTrees().fit(np.concatenate([rows, withheld(rows, np.ones(len(rows), bool))]), np.tile(label, 2))


def rule_margins(features: np.ndarray) -> np.ndarray:
    """Log odds where no page could teach: clutter is dropped, the rest by length and links."""
    at = len(NAMES)
    clutter = features[:, at + 14] + features[:, at + 15] + features[:, at + 18]
    return np.where(clutter > 0, -4.0, 2.0 - 6.0 * features[:, at + 5])


def main_text(pages: DataFrame, model: BoostedTrees | None) -> DataFrame:
    """Per row: page_id, url and text, the main text's blocks joined by line feeds.

    Character references are decoded, white space in a block is one space; nothing else is changed or cut. A null or empty page has
    an empty text, as has one without main text. Repeated rows are extracted each; other columns are left out.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            texts: list[str] = []
            trees, held = [], 0

            def judged() -> None:
                if trees:
                    rows, ends = features(trees)
                    margins = model.margins(withheld(rows, rows[:, -1] == 0)) if model else rule_margins(rows)
                    for tree, own in zip(trees, np.split(margins, ends[:-1])):
                        texts.append("\n".join(tree.decode(own)))
                    trees.clear()

            for page in batch.column("html"):
                tree = Tree(page.as_py() or "")
                trees.append(tree)
                held += len(tree.names)
                if held > 20_000:
                    judged()
                    held = 0
            judged()
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    source = pages.select(*[F.col(c).cast(t).alias(c) for c, t in (("page_id", "long"), ("url", "string"), ("html", "string"))])
    return source.mapInArrow(run, "page_id long, url string, text string")


def op4_main_text(spark, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return main_text(pages, train(pages)).withColumn("n_chars", F.length("text").cast("long"))
