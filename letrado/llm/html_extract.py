"""Main text of web pages by a tree-structured graphical model (operator 9).

Block elements of a page form a tree; each carries a hidden label, content or
boilerplate.  Parent-child potentials say how a child's label follows its
parent's, node potentials how features (tag, text length, link share, sentence
marks) look under either label.  Both are counted on labelled pages: pages with
an ``article`` or ``main`` element label their own nodes.  One upward and one
downward pass of sum-product messages gives exact content marginals, and the
text of the nodes at 0.5 or more is the page's main text.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the HTML vocabulary.
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
    figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section
    summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
UNREAD = frozenset("head noscript template svg math object select button canvas audio video datalist".split())
CLOSES = {"li": ("li", ("ul", "ol", "menu", "dir")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)),
          "tr": ("tr td th", ("table",)), "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")),
          "tbody": ("thead tbody tr td th", ("table",)), "tfoot": ("thead tbody tr td th", ("table",))}
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog fieldset search".split())
BOILERPLATE_WORDS = frozenset("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment
    comments consent cookie cookies disqus footer form header login menu modal nav navbar navigation newsletter notice
    pagination popup promo promoted related reply replies search share sharing sidebar signup skip social sponsor
    sponsored subscribe toolbar widget complementary contentinfo search""".split())
CONTENT_TAGS = frozenset(("article", "main"))
CONTENT_WORDS = frozenset("article content entry main post story".split())

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|"""
                   r"""<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?/][^>]*>""", re.S)
NAMES = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
SPLIT = re.compile(r"[^a-z]+")
SENTENCE = re.compile(r"[.!?…。！？](?:\s|$)")


class Page:
    """The block elements of a page in document order (parents first) and its text runs.

    Inline elements belong to the block around them; link text is counted for
    the link share.  A neutral block inside a boilerplate one has its role.  ``runs`` holds (node, text or None): None is a boundary.
    """

    def __init__(self, source: str):
        self.tag, self.parent, self.role = ["html"], [-1], ["neutral"]
        self.chars, self.link_chars = [0], [0]
        self.runs: list[tuple[int, str | None]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int]] = [("html", 0)]         # open elements and the block each lies in
        opened: Counter = Counter()                           # open elements by name, and where the blocks among them are
        blocks: list[int] = []
        links = unread = at = 0

        def push(tag: str, node: int) -> None:
            opened[tag] += 1
            if tag in BLOCKS:
                blocks.append(len(stack))
            stack.append((tag, node))

        def close(to: int) -> None:
            nonlocal links, unread
            for tag, _ in stack[to:]:
                opened[tag] -= 1
                links -= tag == "a"
                unread -= tag in UNREAD
            del stack[to:]
            while blocks and blocks[-1] >= to:
                blocks.pop()

        def text(raw: str) -> None:
            if unread or not raw:
                return
            node = stack[-1][1]
            found = html.unescape(raw)
            self.runs.append((node, found))
            size = len(found) - found.count(" ")
            self.chars[node] += size
            if links:
                self.link_chars[node] += size

        end_of_tags = source.rfind(">") + 1
        while m := TOKEN.search(source, at, end_of_tags):
            text(source[at:m.start()])
            at = m.end()
            if m[0].startswith("<!--") and not m[0].endswith("-->"):
                at = len(source)                              # a comment that never ends
            end, name, attrs = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
            if not name:
                continue
            name = name.lower()
            if name in BLOCKS or name == "br":
                self.runs.append((stack[-1][1], None))
            if end:
                if opened[name]:                              # each element is passed once, when it is closed
                    close(next(i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name))
                continue
            if name in RAW:
                over = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(source, at)
                at = over.end() if over else len(source)
                continue
            if name in VOID:
                continue
            if name == "html" or name == "body" and opened[name]:
                continue
            if name in BLOCKS:
                if name in CLOSES:
                    ends, within = CLOSES[name]
                    for i in reversed(blocks):
                        if stack[i][0] in within:
                            break
                        if stack[i][0] in ends.split() or stack[i][0] == "p":
                            close(i)
                            break
                elif blocks and stack[blocks[-1]][0] == "p":
                    close(blocks[-1])
                self.tag.append(name)
                self.parent.append(stack[-1][1])
                role = role_of(name, attrs)
                below = self.role[stack[-1][1]] == "boilerplate" and role == "neutral"
                self.role.append("boilerplate" if below else role)
                self.chars.append(0)
                self.link_chars.append(0)
                push(name, len(self.tag) - 1)
            else:
                push(name, stack[-1][1])
                links += name == "a"
                unread += name in UNREAD
        over = source.find("<!--", at)
        text(source[at:over if over >= 0 else len(source)])

    def text_of(self, wanted: list[bool]) -> str:
        """Text of the wanted nodes: white space inside a block and between blocks is one blank."""
        return " ".join("".join(" " if t is None else t for n, t in self.runs if t is None or wanted[n]).split())

    def features(self) -> list[tuple]:
        """(name, value) pairs of each node, every value from a small fixed set; a node without text of
        its own has its tag alone."""
        marks = [0] * len(self.tag)
        for n, t in self.runs:
            if t:
                marks[n] += len(SENTENCE.findall(t))
        out = []
        for tag, size, links, m in zip(self.tag, self.chars, self.link_chars, marks):
            out.append((("tag", tag), ("size", min(size, 4000).bit_length()), ("links", (4 * links) // size),
                        ("marks", min(m, 3))) if size else (("tag", tag),))
        return out

    def labels(self) -> list[int] | None:
        """1 below ``article`` or ``main`` save in boilerplate parts; None for a page without them."""
        if not CONTENT_TAGS & set(self.tag):
            return None
        out: list[int] = []
        for tag, parent, role in zip(self.tag, self.parent, self.role):
            above = out[parent] if parent >= 0 else 0
            out.append(int(role != "boilerplate" and (above or tag in CONTENT_TAGS)))
        return out


def role_of(tag: str, attrs: str) -> str:
    """What an element's tag, class, id and role say: boilerplate, content or neutral."""
    if tag in BOILERPLATE_TAGS:
        return "boilerplate"
    if tag in CONTENT_TAGS:
        return "content"
    words = {w for v in NAMES.findall(attrs or "") for w in SPLIT.split(v.lower())} if tag not in ("html", "body") else set()
    bad, good = bool(words & BOILERPLATE_WORDS), bool(words & CONTENT_WORDS)
    return "neutral" if bad == good else "boilerplate" if bad else "content"


# Imagined observations that stand beside the counts, so that a role not seen in
# the labelled pages still has its meaning: (parent label, parent role, role, label) -> count.
ROLES = ("boilerplate", "content", "neutral")
PRIOR_EDGES = ({(y, above, "boilerplate", 0): 100_000 for y in (0, 1) for above in ROLES}
               | {(y, above, "content", 1): 200 for y in (0, 1) for above in ("content", "neutral")}
               | {(0, "boilerplate", "content", 0): 2000, (0, "content", "neutral", 0): 2000, (0, "neutral", "neutral", 0): 20}
               | {(1, above, "neutral", 1): 2000 for above in ("content", "neutral")})
LARGEST_RATIO = 10.0                                          # of one feature's potentials


@dataclass(frozen=True)
class PageModel:
    """Counts: ("edge", parent label, parent role, role, label) and ("node", feature, value, label)."""

    counts: tuple[tuple[tuple, int], ...]

    def potentials(self) -> tuple[dict, dict]:
        edge = Counter({k: v for k, v in PRIOR_EDGES.items()})
        node: dict = {}
        total: Counter = Counter()
        for key, n in self.counts:
            if key[0] == "edge":
                edge[key[1:]] += n
            else:
                node[key[1:]] = node.get(key[1:], 0) + n
                total[key[1], key[3]] += n
        edges = {}
        for above in (0, 1):
            for over in ROLES:
                for role in ROLES:
                    a, b = edge[above, over, role, 0] + 1, edge[above, over, role, 1] + 1
                    edges[above, over, role] = (a / (a + b), b / (a + b))
        ratio = {}
        for feature, value, _ in node:
            p = [(node.get((feature, value, y), 0) + 1) / (total[feature, y] + 50) for y in (0, 1)]
            ratio[feature, value] = min(max(p[1] / p[0], 1 / LARGEST_RATIO), LARGEST_RATIO)
        return edges, ratio


def marginals(page: Page, edges: dict, ratio: dict) -> list[float]:
    """Probability of content of every node, by sum-product on the tree."""
    n = len(page.tag)
    own = []                                                  # potential of label 1 against label 0
    for f in page.features():
        odds = 1.0
        for pair in f:
            odds *= ratio.get(pair, 1.0)
        own.append(odds)
    below = [[1.0, o] for o in own]                           # own potential times the children's messages
    sent = [(1.0, 1.0)] * n
    for i in range(n - 1, 0, -1):
        b0, b1 = below[i]
        up = []
        for above in (0, 1):
            e = edges[above, page.role[page.parent[i]], page.role[i]]
            up.append(e[0] * b0 + e[1] * b1)
        scale = up[0] + up[1]
        sent[i] = (up[0] / scale, up[1] / scale)
        parent = below[page.parent[i]]
        parent[0] *= sent[i][0]
        parent[1] *= sent[i][1]
        scale = parent[0] + parent[1]
        parent[0] /= scale
        parent[1] /= scale
    out = [0.0] * n
    belief = [(0.0, 0.0)] * n
    for i in range(n):
        if i == 0:
            prior = edges[0, "neutral", page.role[0]]
            b = (prior[0] * below[0][0], prior[1] * below[0][1])
        else:
            above = belief[page.parent[i]]
            down = [0.0, 0.0]
            for a in (0, 1):
                rest = above[a] / sent[i][a] if sent[i][a] > 0 else 0.0   # the parent without this child
                e = edges[a, page.role[page.parent[i]], page.role[i]]
                down[0] += rest * e[0]
                down[1] += rest * e[1]
            b = (down[0] * below[i][0], down[1] * below[i][1])
        scale = b[0] + b[1]
        belief[i] = (b[0] / scale, b[1] / scale)
        out[i] = belief[i][1]
    return out


def count_page(source: str) -> Counter:
    """The counts that one labelled page adds to a PageModel."""
    page = Page(source)
    labels = page.labels()
    counts: Counter = Counter()
    if labels is not None:
        for y, parent, role, feats in zip(labels, page.parent, page.role, page.features()):
            counts["edge", *((labels[parent], page.role[parent]) if parent >= 0 else (0, "neutral")), role, y] += 1
            for name, value in feats:
                if name != "tag" or value not in CONTENT_TAGS:
                    counts["node", name, value, y] += 1
    return counts


def fit_page_model(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                   max_pages: int = 5_000) -> PageModel:
    """Count potentials on at most ``max_pages`` labelled pages: those of smallest id hash.

    Null pages and ids are left out; of pages that share an id all count.
    Without a labelled page the imagined observations alone make the model.
    """
    labelled = pages.where(F.col(html_col).rlike(r"(?i)<(?:article|main)(?![\w:.-])"))
    ids = (labelled.select(F.col(id_col).alias("id")).where(F.col("id").isNotNull()).distinct()
           .orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(max_pages))
    found = (labelled.select(F.col(id_col).alias("id"), F.col(html_col).alias("html"))
             .join(F.broadcast(ids), "id", "left_semi").select("html"))     # at most max_pages ids

    def count(batches):
        total: Counter = Counter()
        for batch in batches:
            for source in batch.column(0).to_pylist():
                total.update(count_page(source))
        yield pa.RecordBatch.from_pydict({"key": [json.dumps(k) for k in total], "n": list(total.values())},
                                         schema=pa.schema([("key", pa.string()), ("n", pa.int64())]))

    rows = (found.mapInArrow(count, "key string, n bigint")
            .groupBy("key").agg(F.sum("n").alias("n")).collect())   # tags and buckets: a small table
    counts = [(tuple(json.loads(r.key)), r.n) for r in rows]
    return PageModel(tuple(sorted(counts, key=str)))


def extract_text(df: DataFrame, model: PageModel, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """``df`` with the main text of ``html_col`` in ``out_col`` (an existing one is replaced).

    Null and empty pages, and pages without content, give the empty text.
    Row-wise, no shuffle; pages are read whole.
    """
    edges, ratio = model.potentials()

    @F.arrow_udf("string")
    def extract(source: pa.Array) -> pa.Array:
        out = []
        for s in source.to_pylist():
            if not s:
                out.append("")
                continue
            page = Page(s)
            out.append(page.text_of([m >= 0.5 for m in marginals(page, edges, ratio)]))
        return pa.array(out, type=pa.string())

    return df.withColumn(out_col, extract(F.col(html_col)))
