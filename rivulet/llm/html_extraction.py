"""Main-text extraction: gradient-boosted trees over DOM-node features, decoded along the tree.

Web pages come without labels, so the trees are fitted on labelled layouts: a
fixed-seed generator arranges menus, headers, footers, sidebars, notices,
adverts, forms, comments and an article in many markups (semantic tags, class
names, or neither), filled with words of at most ``max_train_pages`` pages of
the corpus. That is the classifier's documented bound. The boosted trees are
Spark ML's; their nodes travel to the tasks as arrays, where whole batches of
nodes are scored at once. ``html_dom.decode`` then picks the cheapest labelling
without contradictions between ancestors and descendants.

Defined cases: null or empty html, and pages without any visible text, give an
empty text with 0 characters; repeated rows give equal results; markup of any
size is read whole; unclosed or stray tags never fail; extra columns are kept
by ``extract``.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rivulet.llm.common import bound_batches, null_as_empty
from rivulet.llm.html_dom import GROUPS, Dom, decode, features

MAX_TRAIN_PAGES = 64   # pages whose words fill the layouts
LAYOUTS = 700
TREES, DEPTH = 30, 6
SEED = 3


class Layouts:
    """Random labelled pages: every element carries data-y, 1 for content, 0 for the rest, none for containers."""

    def __init__(self, words: list[str], seed: int = SEED):
        self.r, self.words = random.Random(seed), words or ["word", "text", "line", "the", "of"]

    def some(self, low: int, high: int) -> str:
        n = self.r.randint(low, high)
        out = [self.r.choice(self.words) for _ in range(n)]
        for i in range(0, n, self.r.randint(5, 14)):
            out[i] += self.r.choice([",", ".", ".", ""])
        return html.escape(" ".join(out)[:1].upper() + " ".join(out)[1:] + self.r.choice([".", ".", "", "?"]))

    def name(self, group: int | None) -> str:
        """A class or id attribute: telling, neutral or none."""
        r = self.r
        roll = r.random()
        if group is not None and roll < 0.6:
            w = r.choice(sorted(GROUPS[group]))
            w = r.choice([w, f"{w}-{r.choice(['box', 'wrap', 'area', 'inner', 'list', 'block'])}", f"c-{w}", f"{w}{r.randint(1, 9)}"])
        elif roll < 0.8:
            w = r.choice(["wrap", "row", "col-8", "inner", "container", "box", "block", "x1", "a9f", "grid", "module", "clearfix"])
        else:
            return ""
        return f' {r.choice(["class", "class", "id"])}="{w}"'

    def link(self, low=1, high=4) -> str:
        return f'<a href="/{self.r.randint(1, 999)}">{self.some(low, high)}</a>'

    def menu(self) -> str:
        r = self.r
        items = [self.link(1, 3) for _ in range(r.randint(3, 12))]
        tag = r.choice(["nav", "div", "div", "header", "ul"])
        body = "".join(f"<li data-y=0>{x}</li>" for x in items)
        body = f"<ul data-y=0>{body}</ul>" if tag != "ul" and r.random() < 0.75 else body if tag == "ul" else r.choice([" | ", " ", " &gt; "]).join(items)
        return f"<{tag}{self.name(1)} data-y=0>{body}</{tag}>"

    def head(self) -> str:
        tag = self.r.choice(["header", "div"])
        return (f"<{tag}{self.name(6)} data-y=0><{(h := self.r.choice(['h1', 'h2', 'div', 'p']))} data-y=0>{self.some(1, 5)}</{h}>"
                f"{self.r.choice(['', f'<p data-y=0>{self.some(2, 8)}</p>', self.menu()])}</{tag}>")

    def foot(self) -> str:
        r = self.r
        tag = r.choice(["footer", "footer", "div"])
        parts = [f"&copy; {r.randint(1999, 2025)} {self.some(1, 6)}"] + [f"<p data-y=0>{self.some(3, 25)}</p>" for _ in range(r.randint(0, 2))]
        if r.random() < 0.6:
            parts.append("<ul data-y=0>" + "".join(f"<li data-y=0>{self.link()}</li>" for _ in range(r.randint(2, 6))) + "</ul>")
        r.shuffle(parts)
        return f"<{tag}{self.name(6)} data-y=0>{''.join(parts)}</{tag}>"

    def side(self) -> str:
        r = self.r
        tag = r.choice(["aside", "aside", "div", "section"])
        parts = [f"<h3 data-y=0>{self.some(1, 3)}</h3>"]
        parts += r.choice([[f"<ul data-y=0>{''.join(f'<li data-y=0>{self.link(2, 8)}</li>' for _ in range(r.randint(3, 8)))}</ul>"],
                           [f"<p data-y=0>{self.some(5, 40)}</p>"], [f"<div data-y=0>{self.link(3, 9)} {self.some(4, 15)}</div>" for _ in range(r.randint(2, 5))]])
        return f"<{tag}{self.name(r.choice([5, 6, 6]))} data-y=0>{''.join(parts)}</{tag}>"

    def notice(self) -> str:
        tag = self.r.choice(["div", "div", "section", "aside", "p"])
        inner = self.some(6, 40)
        if tag == "p":
            return f'<p class="{self.r.choice(sorted(GROUPS[4]))}" data-y=0>{inner}</p>'
        if self.r.random() < 0.5:
            inner = f"<p data-y=0>{inner}</p>"
        return f"<{tag}{self.name(4)} data-y=0>{inner} {self.r.choice(['', self.link(1, 2), '<button>OK</button>'])}</{tag}>"

    def advert(self) -> str:
        tag = self.r.choice(["div", "div", "aside", "section", "p"])
        w = self.r.choice(sorted(GROUPS[3]))
        name = f' class="{w}"' if tag == "p" or self.r.random() < 0.75 else self.name(3)
        return f"<{tag}{name} data-y=0>{self.r.choice([self.some(3, 30), self.link(3, 10), f'{self.some(2, 12)} {self.link(1, 4)}'])}</{tag}>"

    def form(self) -> str:
        r = self.r
        body = "".join(r.choice([f"<label data-y=0>{self.some(1, 4)}</label><input name=q>", f"<p data-y=0>{self.some(3, 14)}</p>", "<button>go</button>"])
                       for _ in range(r.randint(1, 4)))
        out = f"<form{self.name(5)} data-y=0>{body}</form>"
        return f"<div{self.name(5)} data-y=0><h3 data-y=0>{self.some(1, 5)}</h3>{out}</div>" if r.random() < 0.4 else out

    def comments(self) -> str:
        r = self.r
        tag = r.choice(["div", "section", "ol", "ul", "aside"])
        item = "li" if tag in ("ol", "ul") else r.choice(["div", "div", "p"])
        some = "".join(f"<{item}{self.name(2)} data-y=0>" + (self.some(4, 50) if item == "p" else
                       f"<b>{self.some(1, 2)}</b> {r.choice(['', '<time>1 May</time> '])}<p data-y=0>{self.some(4, 60)}</p>") + f"</{item}>"
                       for _ in range(r.randint(1, 7)))
        w = r.choice(sorted(GROUPS[2]))
        return f'<{tag} {r.choice(["class", "id"])}="{w}" data-y=0>{r.choice(["", f"<h3 data-y=0>{self.some(1, 3)}</h3>"]) if tag not in ("ol", "ul") else ""}{some}</{tag}>'

    def paragraph(self) -> str:
        r = self.r
        text = self.some(*r.choice([(1, 4), (8, 40), (20, 90), (30, 160)]))
        if r.random() < 0.2:
            text += " " + self.link(1, 6) + " " + self.some(3, 30)
        return f"<p data-y=1>{r.choice(['', '', '<b>', '<em>'])}{text}{r.choice(['', '', '<br>' + self.some(4, 30)])}{r.choice(['</p>', '</p>', '</p>', ''])}"

    def block(self) -> str:
        r = self.r
        kind = r.random()
        if kind < 0.72:
            return self.paragraph()
        if kind < 0.79:
            return f"<{(h := r.choice(['h2', 'h3', 'h4']))} data-y=1>{self.some(1, 9)}</{h}>"
        if kind < 0.86:
            tag = r.choice(["ul", "ol"])
            return f"<{tag} data-y=1>" + "".join(f"<li data-y=1>{self.some(2, 25)}</li>" for _ in range(r.randint(2, 6))) + f"</{tag}>"
        if kind < 0.90:
            return f"<blockquote data-y=1>{r.choice([self.some(6, 40), f'<p data-y=1>{self.some(6, 40)}</p>'])}</blockquote>"
        if kind < 0.93:
            return f"<pre data-y=1>{self.some(4, 40)}</pre>"
        if kind < 0.96:
            return "<table data-y=1>" + "".join("<tr data-y=1>" + "".join(f"<td data-y=1>{self.some(1, 5)}</td>" for _ in range(3)) + "</tr>"
                                                for _ in range(r.randint(2, 5))) + "</table>"
        return f"<figure data-y=1><img src=x><figcaption data-y=1>{self.some(3, 20)}</figcaption></figure>"

    def article(self) -> str:
        r = self.r
        blocks = [self.block() for _ in range(r.choice([1, 2, 4, 8, 14, 25]))]
        if r.random() < 0.8:
            blocks.insert(0, f"<h1 data-y=1>{self.some(2, 12)}</h1>")
        if r.random() < 0.15:
            blocks = [f"<section{self.name(r.choice([0, None]))} data-y=1>{''.join(blocks)}</section>"]
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            blocks.insert(r.randint(0, len(blocks)), r.choice([self.advert, self.advert, self.side, self.form, self.notice])())
        if r.random() < 0.12:
            blocks.append(self.comments())
        tag = r.choice(["article", "article", "main", "div", "div", "section", "td"])
        out = f"<{tag}{self.name(0)} data-y=1>{''.join(blocks)}</{tag}>"
        return f"<table><tr>{out}</tr></table>" if tag == "td" else out

    def page(self) -> str:
        r = self.r
        body = [x() for x in (self.head, self.menu, self.notice, self.advert) if r.random() < 0.55]
        r.shuffle(body)
        middle = [self.article()] + [x() for x in (self.side, self.advert, self.form, self.menu) if r.random() < 0.3]
        r.shuffle(middle)
        if r.random() < 0.4:
            middle.append(self.comments())
        if r.random() < 0.5:
            tag = r.choice(["div", "main", "section", "div"])
            middle = [f"<{tag}{self.name(None)}>{''.join(middle)}</{tag}>"]
        if r.random() < 0.3:
            middle = [f"<div{self.name(None)}>{''.join(middle)}</div>"]
        tail = [x() for x in (self.advert, self.notice, self.foot, self.foot) if r.random() < 0.5]
        return f"<!DOCTYPE html><html><head><title>{self.some(2, 8)}</title></head><body>{''.join(body + middle + tail)}</body></html>"


def training_rows(words: list[str], layouts: int = LAYOUTS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, 0/1, weight) of the generated nodes; a container is what most of its text is, list items weigh less."""
    gen, xs, ys, ws = Layouts(words, seed), [], [], []
    for _ in range(layouts):
        dom = Dom(gen.page())
        n = len(dom.tag)
        good, total = np.zeros(n), np.zeros(n)
        label: list[str | None] = list(dom.label)
        for i in range(1, n):
            if label[i] is None:
                label[i] = label[dom.parent[i]]
        for k, t in zip(dom.run_node, dom.run_text):
            total[k] += len(t)
            good[k] += len(t) * (label[k] == "1")
        for i in range(n - 1, 0, -1):
            total[dom.parent[i]] += total[i]
            good[dom.parent[i]] += good[i]
        use = np.array([total[i] > 0 and dom.tag[i] not in ("#", "body") for i in range(n)])
        xs.append(features(dom)[use])
        ys.append((good[use] > 0.5 * total[use]).astype(int))
        ws.append(np.where(np.array([t == "li" for t in dom.tag]), 0.2, 1.0)[use])
    return np.concatenate(xs), np.concatenate(ys), np.concatenate(ws)


class Forest:
    """Boosted regression trees as flat arrays."""

    def __init__(self, trees: list[tuple[np.ndarray, ...]], weights: list[float]):
        self.trees, self.weights = trees, weights

    def probability(self, x: np.ndarray) -> np.ndarray:
        total, row = np.zeros(len(x)), np.arange(len(x))
        for (feature, threshold, left, right, value, depth), w in zip(self.trees, self.weights):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = np.where(x[row, feature[at]] <= threshold[at], left[at], right[at])
            total += w * value[at]
        return 1 / (1 + np.exp(-2 * total))


_LINE = re.compile(r"^( *)(?:(If|Else) \(feature (\d+) (?:<=|>) ([-\d.eE]+)\)|Predict: ([-\d.eE]+))$")


def _flatten(text: str) -> tuple:
    """A tree from Spark ML's printed form; leaves point at themselves."""
    lines = [m for m in map(_LINE.match, text.split("\n")) if m]
    feature, threshold, left, right, value = [], [], [], [], []
    deepest = 0

    def read(i: int, depth: int) -> tuple[int, int]:
        nonlocal deepest
        deepest = max(deepest, depth)
        k = len(feature)
        for a in (feature, left, right):
            a.append(0)
        threshold.append(0.0), value.append(0.0)
        m = lines[i]
        if m[5] is not None:
            left[k] = right[k] = k
            value[k] = float(m[5])
            return k, i + 1
        feature[k], threshold[k] = int(m[3]), float(m[4])
        left[k], i = read(i + 1, depth + 1)
        right[k], i = read(i + 1, depth + 1)  # lines[i] is the Else
        return k, i

    read(0, 0)
    return np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), deepest


def train(pages: DataFrame, max_train_pages: int = MAX_TRAIN_PAGES, layouts: int = LAYOUTS) -> Forest:
    """Fit on generated layouts filled with the words of a bounded, hash-chosen sample of pages."""
    spark: SparkSession = pages.sparkSession
    text = F.regexp_replace(null_as_empty(F.col("html")), "<[^>]*>", " ")  # filler words only
    # ids first: every task sends its few best ids, never page texts
    ids = [r[0] for r in pages.select("page_id").where("page_id is not null").orderBy(F.xxhash64("page_id"), "page_id")
           .limit(max_train_pages).collect()]
    rows = pages.where(F.col("page_id").isin(ids)).select("page_id", text.alias("t")).dropDuplicates(["page_id"]).collect()
    words = sorted({w for r in rows for w in re.findall(r"[^\W\d_]{1,20}", html.unescape(r["t"]))})
    x, y, w = training_rows(words, layouts)
    rows = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), w.tolist())), "x array<double>, y int, w double")
    table = rows.select(array_to_vector("x").alias("features"), F.col("y").cast("double").alias("label"), "w")
    fitted = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED, maxMemoryInMB=512, weightCol="w").fit(table)
    return Forest([_flatten(t.toDebugString) for t in fitted.trees], list(fitted.treeWeights))


def main_text(page: str | None, forest: Forest) -> str:
    """Main text of one page."""
    dom = Dom(page or "")
    return decode(dom, forest.probability(features(dom))) if dom.run_node else ""


def _extract(batches: Iterator[pa.RecordBatch], forest: Forest, column: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        doms = [Dom(h or "") for h in b.column(column).to_pylist()]
        xs = [features(d) for d in doms]
        cut = np.cumsum([0] + [len(x) for x in xs])
        p = forest.probability(np.concatenate(xs)) if xs else np.zeros(0)
        out = [decode(d, p[cut[i]:cut[i + 1]]) for i, d in enumerate(doms)]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                         names=[*b.schema.names, "text", "n_chars"])


def extract(pages: DataFrame, forest: Forest, column: str = "html") -> DataFrame:
    """``pages`` with text and n_chars added; columns of those names are replaced (but for the page's own column)."""
    bound_batches(pages.sparkSession, 256)
    pages = pages.drop(*(c for c in ("text", "n_chars") if c != column))
    schema = T.StructType([*pages.schema.fields, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return pages.mapInArrow(lambda it: _extract(it, forest, column), schema)
