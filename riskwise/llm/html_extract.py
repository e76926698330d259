"""Main-text extraction: boosted trees over DOM nodes, then hierarchical decoding.

A page is parsed into element nodes in page order, so a subtree is a contiguous range and
its statistics are differences of prefix sums.  Spark ML's gradient-boosted trees score every
node: does its subtree hold main text?  A dynamic programme then picks the best labelling in
which nothing below a rejected node is kept.  The text of kept nodes is returned in blocks.

The trees are fitted on a bounded sample of the pages.  Its nodes are labelled by the
page's own semantic elements; copies with the semantic names taken away and with inserted
furniture teach the trees to use the other features too.  Where no sampled page has such elements, boxes whose
names speak of content count instead, and where none has those, the box that holds most of a page's paragraphs.

Fixed values: the element groups and the word lists below.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SAMPLE_PAGES = 160        # pages whose nodes the trees are fitted on
SAMPLE_NODES = 4_000      # nodes of one sampled page that are fitted on, evenly spaced if it has more
TREES, DEPTH = 24, 4

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
                 r"|<([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>])*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
NAMES = {"class", "id", "role", "itemprop", "aria-label"}      # attributes whose words are counted
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)
WORD = re.compile(r"[A-Za-z]+")

RAW = {"script", "style", "noscript", "template", "iframe", "svg", "math", "object", "textarea", "select", "canvas"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "dir",
         "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
         "head", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search",
         "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr", "ul"}
#: a start tag closes these open elements first, up to the nearest scope
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th", "tbody", "thead"},
          "tbody": {"tr", "td", "th", "tbody", "thead"}}
SCOPE = {"table", "ul", "ol", "dl", "html", "body", "article", "section", "div", "nav", "aside", "footer", "main", "form"}
CONTENT_TAGS, FURNITURE_TAGS = {"article", "main"}, {"nav", "aside", "footer", "form", "header", "menu", "dialog",
                                                     "button", "search", "fieldset", "label", "input", "option"}
CONTENT_WORDS = {"article", "body", "content", "entry", "main", "page", "post", "story", "text", "hentry", "articlebody"}
FURNITURE_WORDS = {"ad", "ads", "advert", "advertisement", "alert", "author", "banner", "bar", "bottom", "breadcrumb",
                   "breadcrumbs", "byline", "comment", "comments", "consent", "contact", "cookie", "cookies",
                   "copyright", "discussion", "disqus", "foot", "footer", "form", "gdpr", "head", "header", "legal",
                   "links", "login", "masthead", "menu", "meta", "modal", "nav", "navbar", "navigation", "newsletter",
                   "notice", "overlay", "pager", "pagination", "popup", "privacy", "promo", "promoted", "reader",
                   "recommended", "related", "replies", "reply", "reviews", "search", "share", "sharing", "sidebar",
                   "signup", "skip", "skyscraper", "social", "sponsor", "sponsored", "subscribe", "tags", "teaser",
                   "toolbar", "topbar", "tracking", "widget", "adsbygoogle", "site"}
PARAGRAPHS = {"p", "blockquote", "pre"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
LISTS = {"ul", "ol", "li", "dl", "dt", "dd"}
TABLES = {"table", "tr", "td", "th", "tbody", "thead"}
BOXES = {"div", "section", "article", "main", "body", "html"}
INLINE = {"a", "b", "i", "em", "strong", "span", "u", "code", "sub", "sup", "small", "mark", "q", "cite", "abbr", "time"}

FEATURES = ("depth", "n_children", "sibling_index", "n_siblings", "same_tag_siblings", "log_chars", "own_chars",
            "page_share", "sibling_share", "link_density", "tag_density", "mean_word", "stops", "digits", "word_density",
            "is_paragraph", "is_heading", "is_list", "is_table", "is_box", "is_inline", "is_link", "content_tag",
            "furniture_tag", "content_words", "furniture_words", "content_above", "furniture_above",
            "content_words_above", "furniture_words_above", "position", "paragraphs_below", "longest_paragraph")


class Page:
    """Element nodes in page order, and the text runs below them."""

    __slots__ = ("tag", "parent", "last", "content", "furniture", "hidden", "main", "runs")

    def __init__(self, source: str):
        self.tag, self.parent, self.last = ["#page"], [-1], [0]
        self.content, self.furniture, self.hidden, self.main = [0], [0], [False], [False]
        self.runs: list[tuple[int, str, bool]] = []      # node, text, whether a new block starts
        self._parse(source)

    def _parse(self, source: str) -> None:
        stack, at, fresh, n = [0], 0, True, len(source)

        def text(a: int, b: int) -> None:
            nonlocal fresh
            if b > a:
                self.runs.append((stack[-1], html.unescape(source[a:b]), fresh))
                fresh = False

        def close(count: int) -> None:
            nonlocal fresh
            for _ in range(count):
                node = stack.pop()
                self.last[node] = len(self.tag) - 1
                fresh = fresh or self.tag[node] in BLOCK

        while at < n:
            m = TAG.search(source, at)
            if not m:
                text(at, n)
                break
            text(at, m.start())
            at = m.end()
            if m[1]:
                name = m[1].lower()
                for k in range(len(stack) - 1, 0, -1):
                    if self.tag[stack[k]] == name:
                        close(len(stack) - k)
                        break
                fresh = fresh or name in BLOCK
            elif m[2]:
                name = m[2].lower()
                if name == "br":
                    self.runs.append((stack[-1], " ", False))
                    continue
                if name in RAW:
                    if not m[3].rstrip().endswith("/"):
                        end = re.compile(rf"</{re.escape(name)}\s*(?:>|\Z)", re.I).search(source, at)
                        at = end.end() if end else n
                    continue
                if name in BLOCK:
                    fresh = True
                    self._close_before(name, stack, close)
                if name in VOID:
                    continue
                self._open(name, m[3] or "", stack)
                if m[3] and m[3].endswith("/") and name not in BLOCK:
                    close(1)
        close(len(stack))

    def _close_before(self, name: str, stack: list[int], close) -> None:
        ends = CLOSES.get(name, set())
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag == "p" or tag in ends:
                close(len(stack) - k)
                return self._close_before(name, stack, close)
            if tag in SCOPE:
                return None
        return None

    def _open(self, name: str, attributes: str, stack: list[int]) -> None:
        content = furniture = 0
        hidden = main = False
        for m in ATTRIBUTE.finditer(attributes) if attributes else ():
            key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if key in NAMES:
                words = [w.lower() for w in WORD.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", value))]
                content += sum(w in CONTENT_WORDS for w in words)
                furniture += sum(w in FURNITURE_WORDS for w in words)
                main = main or key == "role" and "main" in words or key == "itemprop" and "articlebody" in value.lower()
            elif key == "hidden" or key == "style" and NOT_SHOWN.search(value) or key == "aria-hidden" and value.lower() == "true":
                hidden = True
        self.tag.append(name)
        self.parent.append(stack[-1])
        self.last.append(len(self.tag) - 1)
        self.content.append(content)
        self.furniture.append(furniture)
        self.hidden.append(hidden)
        self.main.append(main or name in CONTENT_TAGS)
        stack.append(len(self.tag) - 1)

    def block_nodes(self) -> list[int]:
        """Nearest enclosing block element of every node (itself if it is one)."""
        out = [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            out[i] = i if self.tag[i] in BLOCK else out[self.parent[i]]
        return out


def _in(tags: list[str], group: set[str]) -> np.ndarray:
    return np.array([t in group for t in tags], dtype=np.float64)


def node_features(page: Page) -> np.ndarray:
    """One row of FEATURES per node."""
    n = len(page.tag)
    parent, last = np.array(page.parent), np.array(page.last)
    own = {k: np.zeros(n) for k in ("chars", "words", "letters", "stops", "digits", "links")}
    longest, paragraph = np.zeros(n), _in(page.tag, PARAGRAPHS)
    link = _in(page.tag, {"a"})
    up = np.maximum(parent, 0)
    in_link = link.copy()
    counts = {"content_tag": _in(page.tag, CONTENT_TAGS), "furniture_tag": _in(page.tag, FURNITURE_TAGS),
              "content": np.array(page.content, float), "furniture": np.array(page.furniture, float)}
    above = {k: v.copy() for k, v in counts.items()}
    depth = np.zeros(n)
    children, rank, same = np.zeros(n), np.zeros(n), np.zeros(n)
    by_tag: dict[tuple[int, str], int] = {}
    for i in range(1, n):                     # parents come before their children
        p = page.parent[i]
        depth[i] = depth[p] + 1
        in_link[i] = max(in_link[i], in_link[p])
        for v in above.values():
            v[i] += v[p]
        rank[i] = children[p]
        children[p] += 1
        key = (p, page.tag[i])
        by_tag[key] = by_tag.get(key, 0) + 1
    for i in range(1, n):
        same[i] = by_tag[page.parent[i], page.tag[i]]
    for node, run, _ in page.runs:
        words = run.split()
        size = sum(map(len, words))
        if not size:
            continue
        own["chars"][node] += size
        own["words"][node] += len(words)
        own["stops"][node] += sum(run.count(c) for c in ".,;:!?")
        own["digits"][node] += sum(map(str.isdigit, run))
        own["links"][node] += size * in_link[node]

    def below(v: np.ndarray) -> np.ndarray:
        total = np.r_[0.0, np.cumsum(v)]
        return total[last + 1] - total[:-1]

    sums = {k: below(v) for k, v in own.items()}
    nodes = last - np.arange(n) + 1.0
    chars = sums["chars"]
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        mine = max(longest[i], chars[i] if paragraph[i] else 0)
        longest[i] = mine
        longest[p] = max(longest[p], mine)
    some = np.maximum(chars, 1)
    tags = page.tag
    return np.stack([
        depth, children, rank, children[up], same, np.log1p(chars), np.log1p(own["chars"]), chars / max(chars[0], 1),
        chars / np.maximum(chars[up], 1), sums["links"] / some, nodes / (some / 50 + 1), chars / np.maximum(sums["words"], 1),
        sums["stops"] / some, sums["digits"] / some, sums["words"] / nodes, paragraph, _in(tags, HEADINGS),
        _in(tags, LISTS), _in(tags, TABLES), _in(tags, BOXES), _in(tags, INLINE), link, counts["content_tag"],
        counts["furniture_tag"], counts["content"], counts["furniture"], above["content_tag"] - counts["content_tag"],
        above["furniture_tag"] - counts["furniture_tag"], above["content"] - counts["content"],
        above["furniture"] - counts["furniture"], np.arange(n) / n, below(paragraph), np.log1p(longest)], axis=1)


def semantic_labels(page: Page) -> tuple[int, np.ndarray] | None:
    """What tells the main text, and 1 where a node's subtree holds any of it; None for a page without text for it.

    0: semantic elements (article, main, role main, itemprop articleBody); 1: boxes with more words of content than of
    furniture in their names; 2: the box with most text in paragraphs directly below it.
    """
    n = len(page.tag)
    furniture = np.zeros(n, bool)
    for i in range(1, n):
        bad = page.tag[i] in FURNITURE_TAGS or page.furniture[i] > page.content[i] or page.tag[i] in ("head", "title")
        furniture[i] = furniture[page.parent[i]] or bad
    named = [page.tag[i] in ("div", "section", "td") and page.content[i] > page.furniture[i] for i in range(n)]
    for told, roots in enumerate((page.main, named, None)):
        if roots is None:
            held = np.zeros(n)
            for node, run, _ in page.runs:
                while node > 0 and page.tag[node] not in PARAGRAPHS:
                    node = page.parent[node]
                if node > 0 and not furniture[node]:
                    held[page.parent[node]] += len(run.strip())
            roots = (held == held.max()) & (held > 0)
        inside = np.zeros(n, bool)
        for i in range(1, n):
            inside[i] = (inside[page.parent[i]] or roots[i]) and not furniture[i]
        if inside.any():
            label = inside.copy()
            for i in range(n - 1, 0, -1):
                label[page.parent[i]] |= label[i]
            return told, label.astype(np.float64)
    return None


#: Furniture put into sampled pages, with texts of the page: where it goes, and its markup.
INSERTS = (
    ("before", '<header class="site-header"><a href="/">{s}</a><p>{s}</p></header>'),
    ("before", '<div class="cookie-notice" id="consent"><p>{l}</p><button>{s}</button></div>'),
    ("before", '<div id="topbar"><span>{s}</span> <a href="#">{s}</a></div>'),
    ("inside", '<aside class="related"><h3>{s}</h3><ul><li><a href="/a">{s}</a></li><li><a href="/b">{s}</a></li></ul></aside>'),
    ("inside", '<div class="share"><a href="#">{s}</a><a href="#">{s}</a></div>'),
    ("inside", '<form class="newsletter"><label>{s}</label><input name="q"><p>{l}</p></form>'),
    ("inside", '<div class="promo"><p>{l}</p></div>'),
    ("after", '<section id="comments"><h2>{s}</h2><div class="comment"><p>{l}</p></div><div class="comment"><p>{m}</p></div></section>'),
    ("after", '<div class="sidebar"><p>{l}</p><ul><li><a href="/c">{s}</a></li></ul></div>'),
    ("after", '<aside><h4>{s}</h4><p>{l}</p></aside>'),
    ("after", '<div id="disqus" class="replies"><p>{m}</p><p>{l}</p></div>'),
)
#: Start tags that replace the semantic element of sampled pages.
UNWRAPS = ('<div class="post-content">', '<div id="main">', "<div>", "<section>", '<main class="page">', '<article class="story">')


SEMANTIC = re.compile(r"<(article|main)(?=[\s>])(?:\"[^\"]*\"|'[^']*'|[^>])*>", re.I)


def variants(source: str, seed: int) -> Iterator[tuple[str, str]]:
    """(labelling source, shown source): the page as it is, and a disguised copy with furniture."""
    yield source, source
    rng = np.random.default_rng(seed)
    words = re.sub(r"<[^>]*>", " ", re.sub(r"(?s)<(script|style).*?</\1>", " ", source)).split()
    found = SEMANTIC.search(source)
    if len(words) < 20 or not found:
        return
    start, end = found[0], f"</{found[1]}>"

    def some(n: int) -> str:
        a = int(rng.integers(0, max(1, len(words) - n)))
        return html.escape(" ".join(words[a:a + n]))

    marked = source
    for k in rng.choice(len(INSERTS), 6, replace=False):
        where, markup = INSERTS[k]
        markup = re.sub(r"\{(.)\}", lambda m: some({"s": 3, "l": 24, "m": 70}[m[1]]), markup)
        if where == "before":
            marked = marked.replace(start, markup + start, 1)
        elif where == "after":
            marked = marked.replace(end, end + markup, 1)
        else:
            spots = [m.end() for m in re.finditer(r"</p>", marked) if m.end() <= marked.find(end)]
            if spots:
                at = spots[int(rng.integers(0, len(spots)))]
                marked = marked[:at] + markup + marked[at:]
    opening = UNWRAPS[int(rng.integers(0, len(UNWRAPS)))]
    tag = re.match(r"<(\w+)", opening)[1]
    yield marked, marked.replace(start, opening, 1).replace(end, f"</{tag}>", 1)


def training_rows(pages: DataFrame, html_col: str, sample_pages: int) -> DataFrame:
    """(told, label, features) of the nodes of the ``sample_pages`` distinct pages of smallest hash."""
    h = F.xxhash64(F.col(html_col))
    rows = pages.where(F.length(html_col) > 0).select(F.col(html_col).alias("html"), h.alias("h"))
    least = rows.select("h").distinct().orderBy("h").limit(sample_pages)       # only hashes are shuffled
    sample = (rows.join(F.broadcast(least), "h", "left_semi").groupBy("h").agg(F.min("html").alias("html"))
              .orderBy("h").limit(sample_pages).repartition(8).select("html", "h"))

    def run(batches):
        for batch in batches:
            told, labels, rows = [], [], []
            for source, seed in zip(batch.column("html").to_pylist(), batch.column("h").to_pylist()):
                for marked, shown in variants(source, seed & 0xFFFFFFFF):
                    truth, page = semantic_labels(Page(marked)), Page(shown)
                    if truth is not None and len(truth[1]) == len(page.tag):
                        n = len(page.tag)
                        some = np.arange(n) if n <= SAMPLE_NODES else np.linspace(0, n - 1, SAMPLE_NODES).astype(np.int64)
                        told += [truth[0]] * len(some)
                        labels += truth[1][some].tolist()
                        rows += node_features(page)[some].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(told, pa.int32()), pa.array(labels, pa.float64()), pa.array(rows, pa.list_(pa.float64()))],
                ["told", "label", "f"])

    rows = sample.mapInArrow(run, "told int, label double, f array<double>")
    return rows.select("told", "label", array_to_vector("f").alias("features"))


class Trees:
    """The fitted ensemble as arrays, so that tasks can score nodes without a JVM."""

    def __init__(self, model=None):
        self.trees = []
        for weight, tree in zip(model.treeWeights, model.trees) if model is not None else ():
            nodes: list[list[float]] = []

            def add(node) -> int:
                at = len(nodes)
                nodes.append([-1, 0.0, 0, 0, float(node.prediction())])
                if node.getClass().getSimpleName() == "InternalNode":
                    split = node.split()
                    nodes[at][:2] = [split.featureIndex(), float(split.threshold())]
                    nodes[at][2] = add(node.leftChild())
                    nodes[at][3] = add(node.rightChild())
                return at

            add(tree._call_java("rootNode"))
            self.trees.append((float(weight), np.array(nodes)))

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Half the log-odds that a node holds main text; without trees, what the fixed rule says."""
        if not self.trees:
            return fixed_rule(x)
        out = np.zeros(len(x))
        row = np.arange(len(x))
        for weight, t in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            feature, left, right = t[:, 0].astype(np.int64), t[:, 2].astype(np.int64), t[:, 3].astype(np.int64)
            for _ in range(DEPTH):
                f = feature[at]
                inner = f >= 0
                down = np.where(x[row, np.maximum(f, 0)] <= t[at, 1], left[at], right[at])
                at = np.where(inner, down, at)
            out += weight * t[at, 4]
        return out


def fixed_rule(x: np.ndarray) -> np.ndarray:
    """Furniture: what lies in elements of furniture, or under more names of furniture than of content, and boxes
    that are mostly links."""
    at = {name: x[:, i] for i, name in enumerate(FEATURES)}
    named = (at["furniture_tag"] + at["furniture_above"] > 0) | (
        at["furniture_words"] + at["furniture_words_above"] > at["content_words"] + at["content_words_above"])
    links = (at["link_density"] > 0.5) & (at["is_link"] == 0) & (at["is_inline"] == 0)
    return np.where(named | links, -1.0, 1.0)


def fit_trees(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Trees:
    """Trees fitted on the sampled pages that tell their main text best; an empty ensemble, which means
    ``fixed_rule``, if there are not labelled nodes of both kinds."""
    rows = training_rows(pages, html_col, sample_pages).cache()
    try:
        kinds = [tuple(r) for r in rows.select("told", "label").distinct().collect()]
        told = [t for t in range(3) if (t, 0.0) in kinds and (t, 1.0) in kinds]
        if not told:
            return Trees()
        return Trees(GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxMemoryInMB=64)
                     .fit(rows.where(F.col("told") == told[0]).drop("told")))
    finally:
        rows.unpersist()


def decode(page: Page, margin: np.ndarray) -> np.ndarray:
    """Kept nodes: the labelling of largest total margin with no kept node below a rejected one.

    A node without text below it has no say.  Ties are kept.
    """
    n = len(page.tag)
    has_text = np.zeros(n + 1, dtype=np.int64)
    for node, run, _ in page.runs:
        has_text[node + 1] += bool(run.strip())
    has_text = np.cumsum(has_text)
    last = np.array(page.last)
    gain = np.where(has_text[last + 1] > has_text[:-1], margin, 0.0)
    gain[0] = 0.0                                  # the page itself is always open
    for i, tag in enumerate(page.tag):
        if page.hidden[i] or tag in ("head", "title"):
            gain[i] = -1e9
    total = np.r_[0.0, np.cumsum(gain)]
    reject = -(total[last + 1] - total[:-1])       # the whole subtree is furniture
    best_keep = gain.copy()
    keep = np.zeros(n, dtype=bool)
    for i in range(n - 1, -1, -1):
        keep[i] = i == 0 or best_keep[i] >= reject[i]
        if i:
            best_keep[page.parent[i]] += max(best_keep[i], reject[i])
    for i in range(1, n):
        keep[i] &= keep[page.parent[i]]
    return keep


def main_text(page: Page, keep: np.ndarray) -> str:
    """Blocks of the kept nodes' text, joined by an empty line."""
    blocks: list[list[str]] = []
    block_of, current, pending = page.block_nodes(), None, True
    for node, run, fresh in page.runs:
        pending = pending or fresh or block_of[node] != current
        if not keep[node]:
            pending = pending or fresh
            continue
        if pending and run.strip():
            blocks.append([])
            pending, current = False, block_of[node]
        if blocks and not pending:
            blocks[-1].append(run)
    return "\n\n".join(t for b in blocks if (t := " ".join("".join(b).split())))


def extract_many(sources: list[str | None], trees: Trees, group: int = 64) -> list[str]:
    """Main text of every page; the trees score the nodes of ``group`` pages at once."""
    out: list[str] = []
    for i in range(0, len(sources), group):
        pages = [Page(s) if s else None for s in sources[i:i + group]]
        feats = [node_features(p) for p in pages if p]
        margins = np.split(trees.margin(np.concatenate(feats)), np.cumsum([len(f) for f in feats])[:-1]) if feats else []
        found = iter(margins)
        out += [main_text(p, decode(p, next(found))) if p else "" for p in pages]
    return out


def extract_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text",
                      sample_pages: int = SAMPLE_PAGES) -> DataFrame:
    """All rows and columns but ``html_col``, with ``text_col`` (replaced if it exists).

    NULL or empty html gives an empty text, as does a page without main text.  Broken, unclosed
    and very long markup is parsed whole.  Where nothing can be learned from the sampled pages, ``fixed_rule`` judges the
    nodes.  Equal pages give equal texts; an empty table gives an empty result.
    """
    trees = fit_trees(pages, html_col, sample_pages)
    rest = [c for c in pages.columns if c not in (html_col, text_col)]
    name = "__html"
    while name in rest:
        name += "_"
    source = pages.select(*rest, F.col(html_col).cast("string").alias(name))
    schema = StructType([*source.schema.fields[:-1], StructField(text_col, StringType())])

    def run(batches):
        for batch in batches:
            text = extract_many(batch.column(batch.num_columns - 1).to_pylist(), trees)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(text, pa.string())],
                                             names=[*batch.schema.names[:-1], text_col])

    return source.mapInArrow(run, schema)
