"""Operator 7, HTML extraction: a tree-structured graphical model over the DOM.

Every element is a node with a hidden label, content or not. The parent's label and the element's
tag give the edge potential; tag, class and id words, text length and link share give the
node potential. Sum-product messages go up and down the tree once and give exact marginals; the
text directly inside elements with a marginal above one half is kept. Potentials are smoothed counts
over labelled pages: pages that mark their own article, at most `SAMPLE_PAGES` of them (those with the
smallest hash), and a few layouts written down here.

Defined cases: null and empty pages give empty text; broken markup is read as far as it goes,
an unknown declaration (`<![if x]>`) is a comment and an unfinished tag at the end is dropped; pages without an article are judged by the same
potentials; repeated rows give repeated results; an empty table gives an empty result and the
written layouts alone train the model; other columns pass through `extract`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakerisk.llm import rows

SAMPLE_PAGES = 2_000
LAYOUT_WEIGHT = 50.0
SMOOTHING = 0.5

# Fixed values of the markup language: elements without end tag, elements that break a line of
# text, and elements whose text a reader never sees as text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
UNSEEN = frozenset("button head iframe noscript object option script select style svg template textarea title".split())
# An element of the key ends an open one of the values.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

# Written layouts: words that name containers, by label.
CONTENT_NAMES = "content article post entry story body text main page single blog".split()
OTHER_NAMES = (
    "menu nav navbar navigation breadcrumb breadcrumbs header masthead topbar banner footer bottom copyright sidebar side aside widget related "
    "recommended more links tags share social follow cookie cookies consent notice alert popup modal overlay ad ads advert advertisement sponsor "
    "sponsored promo promotion newsletter subscribe signup login search form comment comments reply replies discussion respond disqus pagination legal"
).split()


class Tree(HTMLParser):
    """Elements in page order: parent, tag and words of each; and the pieces of text with their element."""

    def __init__(self, page: str | None):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.words = [-1], ["#page"], [()]
        self.open, self.texts, self.marks = [0], [], [()]
        self.feed(re.sub(r"<[/!a-zA-Z][^<>]*\Z", "", page or ""))
        self.close()

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._end({"p"}, BLOCK - {"p"})
            self.texts.append((-1, ""))
        if tag in ENDS:
            self._end(ENDS[tag], {"ul", "ol", "dl", "table", "div", "select"})
        if tag == "br" or tag == "hr":
            self.texts.append((self.open[-1], " "))
        if tag in VOID:
            return
        self.parent.append(self.open[-1])
        self.tag.append(tag)
        held = dict(attrs) if attrs else {}
        named = f"{held.get('class') or ''} {held.get('id') or ''} {held.get('role') or ''}" if held else ""
        self.words.append(tuple(dict.fromkeys(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", named).lower()))) if named else ())
        self.marks.append(held.get("data-content"))
        self.open.append(len(self.tag) - 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.texts.append((-1, ""))
        for i in range(len(self.open) - 1, 0, -1):
            if self.tag[self.open[i]] == tag:
                del self.open[i:]
                break

    def parse_marked_section(self, i, report=1):
        """A marked section other than CDATA is a comment up to its first `>`; the parser's own method raises on it."""
        if self.rawdata.startswith("<![CDATA[", i):
            return super().parse_marked_section(i, report)
        return self.parse_bogus_comment(i, report)

    def handle_data(self, data):
        self.texts.append((self.open[-1], data))

    def _end(self, tags, fence):
        """Close the nearest open element of `tags`, not looking past one of `fence`."""
        for i in range(len(self.open) - 1, 0, -1):
            name = self.tag[self.open[i]]
            if name in tags:
                del self.open[i:]
                return
            if name in fence:
                return

    def evidence(self) -> list[tuple[str, ...]]:
        """What is observed at each element: its words, and the size of its own text and the link share below it."""
        size, linked = [0] * len(self.tag), [0] * len(self.tag)
        for at, value in self.texts:
            if at >= 0:
                size[at] += len(value)
        own = size.copy()
        for i in range(len(self.tag) - 1, 0, -1):
            if self.tag[i] == "a":
                linked[i] = size[i]
            size[self.parent[i]] += size[i]
            linked[self.parent[i]] += linked[i]
        return [
            (*("." + w for w in self.words[i]), f"#size{min(len(str(own[i])), 4)}", f"#links{4 * linked[i] // max(size[i], 1)}")
            for i in range(len(self.tag))
        ]


def labels_from_article(tree: Tree) -> list[int] | None:
    """Content labels of a page that marks its article; None for other pages."""
    if "article" not in tree.tag:
        return None
    out = [0] * len(tree.tag)
    for i in range(1, len(tree.tag)):
        tag = tree.tag[i]
        inside = tag == "article" or out[tree.parent[i]] == 1
        out[i] = int(inside and tag not in UNSEEN and tag not in ("nav", "aside", "footer", "form") and not set(tree.words[i]) & set(OTHER_NAMES))
    return out


def layouts() -> Iterator[tuple[Tree, list[int]]]:
    """Written pages with labels: a content container among named boilerplate, at several depths."""
    line = "Some words of running text that a reader came for, long enough to count as such. "
    other = {"menu": "nav", "header": "header", "footer": "footer", "sidebar": "aside", "search": "form", "comments": "section"}
    for k, name in enumerate(OTHER_NAMES):
        content = CONTENT_NAMES[k % len(CONTENT_NAMES)]
        holder = ("div", "main", "section", "article")[k % 4]
        box = other.get(name, ("div", "section", "ul", "div")[k % 4])
        inner = f'<li><a href="#">{line[:20]}</a></li>' if box == "ul" else f"<p>{line}</p><a href='#'>{line[:20]}</a>"
        aside = f'<{box} class="{name}">{inner}</{box}>'
        body = f"<h1>{line[:30]}</h1><p>{line * 3}</p><h2>{line[:20]}</h2><p>{line * 2}<b>word</b> <a href='#'>link</a></p><ul><li>{line}</li></ul>"
        body += f"<blockquote><p>{line}</p></blockquote><table><tr><td>{line}</td></tr></table><div><p>{line}</p></div>"
        within = f'<{holder} data-content="1" class="{content}">{body}{aside if k % 2 else ""}</{holder}>'
        page = f"<html><head><title>{line}</title></head><body><nav><ul><li><a href='#'>Home</a></li></ul></nav><div id='page'>{'' if k % 2 else aside}{within}</div><footer><p>{line}</p></footer></body></html>"
        tree = Tree(page)
        out = [0] * len(tree.tag)
        for i in range(1, len(out)):
            out[i] = int((tree.marks[i] == "1" or out[tree.parent[i]] == 1) and name not in tree.words[i])
        yield tree, out
    for body in (f"<h1>{line[:30]}</h1>" + f"<p>{line * 2}</p>" * 3, f"<p>{line}</p>" * 2, line * 3):  # no container at all
        for page in (f"<html><head><title>{line}</title></head><body>{body}</body></html>", body):
            tree = Tree(page)
            yield tree, [int(t not in UNSEEN and t != "html" and (i > 0 or page is body)) for i, t in enumerate(tree.tag)]


def observed(tree: Tree, labels: list[int], weight: float = 1.0) -> Counter:
    """Counts of (kind, name, parent label, label) on one labelled page."""
    counts: Counter = Counter()
    for i, seen in enumerate(tree.evidence()):
        if i:
            counts["edge", tree.tag[i], labels[tree.parent[i]], labels[i]] += weight
        for name in seen:
            counts["node", name, -1, labels[i]] += weight
        counts["node", "", -1, labels[i]] += weight
    counts["node", "#page", -1, labels[0]] += weight
    return counts


@dataclass(frozen=True)
class Potentials:
    """Edge potentials P(label | parent's label, tag) and log ratios of the evidence."""

    edges: dict[str, tuple[tuple[float, float], tuple[float, float]]]
    evidence: dict[str, float]

    def marginals(self, tree: Tree) -> list[float]:
        """P(content) of every element by one upward and one downward pass."""
        size, edges = len(tree.tag), self.edges
        up = [(1.0, 1.0)] * size
        down, to_parent = [(1.0, 0.0)] * size, [(1.0, 1.0)] * size
        unknown = edges[""]
        for i, seen in enumerate(tree.evidence()):
            ratio = min(max(sum(self.evidence.get(n, 0.0) for n in seen), -12.0), 12.0)
            up[i] = (1.0, math.exp(ratio)) if tree.tag[i] not in UNSEEN else (1.0, 0.0)
        for i in range(size - 1, 0, -1):  # children stand after their parent
            a, b = up[i]
            a, b = a / (a + b), b / (a + b)
            up[i] = (a, b)
            edge = edges.get(tree.tag[i], unknown)
            message = (edge[0][0] * a + edge[0][1] * b, edge[1][0] * a + edge[1][1] * b)
            to_parent[i] = message
            p = up[tree.parent[i]]
            p = (p[0] * message[0], p[1] * message[1])
            total = p[0] + p[1]
            up[tree.parent[i]] = (p[0] / total, p[1] / total)
        root = self.evidence.get("#page", 0.0)
        down[0] = (1.0, math.exp(min(max(root, -12.0), 12.0)))
        out = [down[0][1] * up[0][1] / (down[0][0] * up[0][0] + down[0][1] * up[0][1])] + [0.0] * (size - 1)
        for i in range(1, size):
            parent = tree.parent[i]
            above, whole, message = down[parent], up[parent], to_parent[i]
            x = above[0] * whole[0] / max(message[0], 1e-300), above[1] * whole[1] / max(message[1], 1e-300)
            edge = edges.get(tree.tag[i], unknown)
            a, b = x[0] * edge[0][0] + x[1] * edge[1][0], x[0] * edge[0][1] + x[1] * edge[1][1]
            total = a + b
            down[i] = (a / total, b / total)
            p0, p1 = down[i][0] * up[i][0], down[i][1] * up[i][1]
            out[i] = p1 / (p0 + p1)
        return out


def potentials(counts: Counter) -> Potentials:
    """Smoothed potentials of counts; an unknown tag keeps its parent's label."""
    edges, evidence = {"": ((0.9, 0.1), (0.1, 0.9))}, {}
    for tag in {k[1] for k in counts if k[0] == "edge"}:
        table = []
        for parent in (0, 1):
            held = [counts["edge", tag, parent, y] + SMOOTHING * edges[""][parent][y] * 2 for y in (0, 1)]
            table.append((held[0] / sum(held), held[1] / sum(held)))
        edges[tag] = tuple(table)
    totals = [counts["node", "", -1, y] for y in (0, 1)]
    for name in {k[1] for k in counts if k[0] == "node"} - {""}:
        share = [(counts["node", name, -1, y] + SMOOTHING) / (totals[y] + 1) for y in (0, 1)]
        evidence[name] = math.log(share[1] / share[0])
    return Potentials(edges, evidence)


def main_text(page: str | None, model: Potentials) -> str:
    """Kept blocks in page order, joined by an empty line."""
    if not page:
        return ""
    tree = Tree(page)
    kept = [m > 0.5 for m in model.marginals(tree)]
    blocks, run = [], []
    for at, value in [*tree.texts, (-1, "")]:
        if at < 0:
            if run and (block := " ".join("".join(run).split())):
                blocks.append(block)
            run = []
        elif kept[at]:
            run.append(value)
    return "\n\n".join(blocks)


def fit(pages: DataFrame, most: int = SAMPLE_PAGES) -> Potentials:
    """Learn from `pages` (page_id, html) that mark their article, and the written layouts."""
    marked = pages.filter(F.col("html").contains("<article")).select(F.xxhash64("page_id", "html").alias("key"))
    # At most `most` numbers: a bounded broadcast.
    chosen = marked.orderBy("key").limit(most).distinct()
    sample = pages.select("html", F.xxhash64("page_id", "html").alias("key")).join(F.broadcast(chosen), "key").select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column("html").to_pylist():
                tree = Tree(page)
                if (labels := labels_from_article(tree)) is not None:
                    total.update(observed(tree, labels))
        columns = zip(*((*k, v) for k, v in total.items())) if total else [[]] * 5
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.float64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "name", "parent", "label", "n"])

    counted = sample.mapInArrow(run, "kind string, name string, parent long, label long, n double")
    held: Counter = Counter()
    for r in counted.groupBy("kind", "name", "parent", "label").agg(F.sum("n").alias("n")).collect():
        held[r["kind"], r["name"], r["parent"], r["label"]] = r["n"]
    for tree, labels in layouts():
        held.update(observed(tree, labels, LAYOUT_WEIGHT))
    return potentials(held)


def extract(pages: DataFrame, model: Potentials) -> DataFrame:
    """`pages` with its columns and the main text of each row's html."""
    return rows.with_columns(pages, {"text": T.StringType()}, lambda b: [[main_text(h, model) for h in b.column("html").to_pylist()]], "html")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: main text of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    found = extract(pages, fit(pages))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
