"""Main text of web pages by a tree-structured graphical model.

Every block node of a page's tree is content or not. A node's own look (tag,
declared role, length of its text, share of links in it) gives an emission;
parent and child are tied by a potential that depends on whether either
declares a role. Sum-product messages go up the tree and down again and give
each node's exact marginal; a node's text is kept if content is likelier.

Trained from labelled pages: a bounded sample (``train_pages`` pages, those
with the smallest hashes of id and url) whose markup labels their nodes: content below an
article or main element, not content below any other declared role. Counts are
added to the prior counts below, so that roles the sample lacks keep a meaning.
Training is one job over the sample; the counts are a few dozen numbers.
Extraction is one narrow pass over all pages.

Defined cases: a null, empty or textless page gives an empty text; repeated
rows a row each; null ids and urls stay; without labelled pages the prior
alone decides; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstar.llm.html_tree import Node, joined, parse

#: Bound of the labelled sample.
TRAIN_PAGES = 500

# Prior counts (content, not content).
ROLE_PRIOR = {"": (50, 50), "main": (50, 0.05), "menu": (0.05, 50), "header": (1, 30), "footer": (0.1, 50),
              "sidebar": (0.1, 50), "notice": (0.05, 50), "advert": (0.05, 50), "form": (0.05, 50),
              "comments": (0.05, 50), "code": (0.001, 50)}
#: By (parent's region, child's role group) and parent's state: counts that the child is content or not.
TIE_PRIOR = {("none", "none"): ((97, 3), (25, 75)), ("none", "main"): ((50, 1), (50, 1)),
             ("none", "other"): ((10, 90), (1, 99)), ("main", "none"): ((199, 1), (1, 9)),
             ("main", "main"): ((99, 1), (9, 1)), ("main", "other"): ((20, 80), (1, 99)),
             ("other", "none"): ((50, 50), (0.01, 99)), ("other", "main"): ((9, 1), (1, 9)),
             ("other", "other"): ((10, 90), (0.1, 99))}

#: Largest log odds that one trait of a node can give: a tag that the sample
#: shows only in content says much, but not all, and so does a role that only
#: words of a class declare; a role declared by the tag itself says more.
BOUND = {"tag": 2.0, "length": 1.5, "links": 2.0, "word": 4.0, "role": 12.0}


def _length_class(words: int) -> int:
    return 0 if words == 0 else min(6, 1 + int(math.log2(words)) // 2 + (words > 2))


def looks(node: Node) -> list[tuple[str, object]]:
    """What the emission sees of a node."""
    text = "".join(p for _, p in node.pieces)
    chars = len(text.strip())
    links = min(3, math.ceil(3 * node.link_chars / chars)) if chars else 0
    return [("tag", node.tag), ("word" if node.by_word else "role", node.role), ("length", _length_class(len(text.split()))),
            ("links", links)]


def groups(nodes: list[Node]) -> list[tuple[str, str]]:
    """For each node its own role group, and the region (nearest role) it opens or lies in."""
    out: list[tuple[str, str]] = []
    for node in nodes:
        own = "none" if not node.role else "main" if node.role == "main" else "other"
        above = out[node.parent][1] if node.parent >= 0 else "none"
        out.append((own, own if own != "none" else above))
    return out


def count_page(nodes: list[Node]) -> Counter | None:
    """Training counts of a page, None if its markup does not label it."""
    if not any(n.role == "main" for n in nodes):
        return None
    seen: Counter = Counter()
    grouped = groups(nodes)
    content = [region == "main" for _, region in grouped]
    for node, (own, _), yes in zip(nodes, grouped, content):
        for name, value in looks(node):
            seen["look", name, str(value), yes] += 1
        if node.parent >= 0:
            seen["tie", grouped[node.parent][1], own, content[node.parent], yes] += 1
    return seen


class Model:
    """Log potentials from training counts and the prior."""

    def __init__(self, counts: Counter):
        kinds: dict[str, dict[str, list[float]]] = {kind: {} for kind in BOUND}
        for role, (yes, no) in ROLE_PRIOR.items():
            kinds["role"][role] = [no, yes]
            if role:
                kinds["word"][role] = [no, yes]
        for key, n in counts.items():
            if key[0] == "look":
                kinds[key[1]].setdefault(key[2], [1.0, 1.0])[key[3]] += n
        self.look = {}
        for kind, values in kinds.items():
            total = [sum(v[k] for v in values.values()) for k in (0, 1)]
            for value, (no, yes) in values.items():
                odds = math.log(yes / total[1]) - math.log(no / total[0])
                self.look[kind, value] = max(-BOUND[kind], min(BOUND[kind], odds))
        self.tie = {}
        for (region, own), prior in TIE_PRIOR.items():
            for parent in (0, 1):
                yes, no = prior[1 - parent]
                yes += counts.get(("tie", region, own, bool(parent), True), 0)
                no += counts.get(("tie", region, own, bool(parent), False), 0)
                self.tie[region, own, parent] = (math.log(no / (yes + no)), math.log(yes / (yes + no)))

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability that each node is content: messages up, then down."""
        grouped, n = groups(nodes), len(nodes)
        own = []
        for node in nodes:
            odds = sum(self.look.get((kind, str(value)), 0.0) for kind, value in looks(node))
            own.append([0.0, odds])  # becomes the belief from below

        def tie(k: int, parent: int) -> tuple[float, float]:
            return self.tie[grouped[nodes[k].parent][1], grouped[k][0], parent]

        up: list[tuple[float, float]] = [(0.0, 0.0)] * n
        for k in range(n - 1, 0, -1):
            up[k] = tuple(_add(own[k][0] + t[0], own[k][1] + t[1]) for t in (tie(k, 0), tie(k, 1)))
            parent = own[nodes[k].parent]
            parent[0] += up[k][0]
            parent[1] += up[k][1]
        belief = [(0.0, 0.0)] * n
        belief[0] = _unit(own[0][0], own[0][1] - 50)  # the page itself is no content
        for k in range(1, n):
            p, t0, t1 = belief[nodes[k].parent], tie(k, 0), tie(k, 1)
            q0, q1 = p[0] - up[k][0], p[1] - up[k][1]
            belief[k] = _unit(own[k][0] + _add(q0 + t0[0], q1 + t1[0]),
                              own[k][1] + _add(q0 + t0[1], q1 + t1[1]))
        return [math.exp(b[1]) for b in belief]


def _add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def _unit(a: float, b: float) -> tuple[float, float]:
    total = _add(a, b)
    return a - total, b - total


def train(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
          train_pages: int = TRAIN_PAGES) -> Model:
    """The model from the labelled pages of the sample."""
    given = pages.where(F.col(html_col).isNotNull()).select(
        F.xxhash64(id_col, url_col).alias("key"), F.col(html_col).alias("html"))
    # the bound is found on the keys alone; pages move only once they are chosen
    last = given.select("key").orderBy("key").limit(train_pages).agg(F.max("key")).first()[0]
    sample = given.where(F.col("key") <= F.lit(last).cast("long")).limit(train_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            for page in batch.column(0):
                total.update(count_page(parse(page.as_py())) or {})
        yield pa.RecordBatch.from_arrays(
            [pa.array([[str(x) for x in k] for k in total], pa.list_(pa.string())),
             pa.array(list(total.values()), pa.int64())], ["key", "n"])

    counts: Counter = Counter()
    for r in sample.select("html").mapInArrow(run, "key array<string>, n bigint").collect():
        counts[tuple({"True": True, "False": False}.get(x, x) for x in r.key)] += r.n
    return Model(counts)


def extract_text(page: str | None, model: Model) -> str:
    if not page:
        return ""
    nodes = parse(page)
    return joined(nodes, [m > 0.5 for m in model.marginals(nodes)])


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            train_pages: int = TRAIN_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) for each page."""
    model = train(pages, id_col, url_col, html_col, train_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract_text(p.as_py(), model) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    id_type = pages.schema[id_col].dataType.simpleString()
    return pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html")).mapInArrow(
        run, f"page_id {id_type}, url string, text string, n_chars bigint")
