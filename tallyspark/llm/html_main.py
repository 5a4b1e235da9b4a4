"""Main-text extraction: gradient-boosted trees over DOM-node features, decoded over the tree.

Every element of a page gets features: depth, subtree text, link and punctuation
density, attribute tokens of itself and its ancestors, siblings.  Boosted trees
give the log odds that it belongs to the article.  Decoding keeps or drops whole
subtrees so that nothing below a dropped node is kept: each node takes the better
of "dropped with all below" and "kept, each child as is best for it".

The trees are trained here: on at most ``MOST_TRAINED`` pages of the given table
(smallest id hash), labelled by their own semantic tags, and on generated pages
that also have layouts without such tags.  On a second copy of each the tag
features are hidden, so that the text features must carry the decision too.

Defined cases: null and empty html give an empty text; broken, cut-off and
deeply nested markup is read as far as it goes; repeated rows and null ids are
kept, other columns are dropped; an empty table trains on the generated pages only.
"""

from __future__ import annotations

import html as _html
import random
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_TRAINED = 1500
MOST_NODES = 400  # nodes of a training page that are used (evenly spread beyond)
GENERATED = 400
PAGES_AT_ONCE = 200
TREES, DEPTH, BINS, SHRINK, SEED = 40, 4, 24, 0.3, 5

# Element names of the HTML standard by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template iframe object svg math head title select textarea canvas audio "
                   "video datalist".split())
RAW = frozenset("script style textarea title noscript iframe".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
                  "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section "
                  "summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCK - frozenset("html body".split())
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
        "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
         "th": {"tr", "table"}, "option": {"select"}}
CONTROLS = frozenset("input button select textarea label fieldset option".split())
# Tokens of names, ids, classes and roles that mark page furniture or the article.
FURNITURE = frozenset("""ad ads advert adverts advertisement advertising alert aside banner breadcrumb breadcrumbs button byline-share
 comment comments complementary consent contentinfo cookie cookies copyright dialog discussion disclaimer disqus
 footer form gdpr header legal links login masthead menu menubar meta-nav modal nav navbar navigation newsletter
 notice notification outbrain pagination pager popup promo promoted promotion related replies reply respond search
 share sharing sidebar signup site-footer site-header skip social sponsor sponsored subscribe subscription taboola
 tags toc toolbar topbar widget widgets""".split())
ARTICLE = frozenset("article articlebody body-text content entry main maincontent post story text".split())

_TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*)>?", re.S)
_ATTR = re.compile(r"(class|id|role|hidden|style|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_ENDS = re.compile(r"[.!?,;:]")

(F_DEPTH, F_TEXT, F_LINKS, F_DENSITY, F_CHILDREN, F_ENDS, F_BAD, F_BAD_ABOVE, F_GOOD, F_GOOD_ABOVE, F_KIND, F_PLACE,
 F_SIBLINGS, F_ALIKE, F_RATIO, F_START, F_CONTROLS, F_SHARE, F_PARAGRAPHS, F_WORD) = range(20)
WIDTH = 20
_KINDS = {"p": 1, "h1": 2, "h2": 2, "h3": 2, "h4": 2, "h5": 2, "h6": 2, "li": 3, "ul": 3, "ol": 3, "a": 4, "div": 5,
          "section": 5, "td": 6, "tr": 6, "table": 6, "blockquote": 7, "pre": 7, "b": 8, "i": 8, "em": 8, "strong": 8,
          "span": 8}


@dataclass(slots=True)
class Node:
    tag: str
    up: int
    depth: int
    bad: int = 0
    good: int = 0
    hidden: bool = False
    parts: list = None  # strings (own text) and ints (child nodes), in page order
    label: int = -1


def _tokens(tag: str, attributes: str) -> tuple[int, int, bool, int]:
    bad, good, hidden, label = int(tag in FURNITURE), int(tag in ("article", "main")), False, -1
    if attributes and attributes.strip("/ "):
        for name, *values in _ATTR.findall(attributes):
            value, name = "".join(values), name.lower()
            if name == "hidden" or name == "aria-hidden" and value == "true":
                hidden = True
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "").lower()
            else:
                words = {w.lower() for w in _TOKEN.findall(value)} | set(value.lower().split())
                bad += len(words & FURNITURE)
                good += len(words & ARTICLE)
    return bad, good, hidden, label


def parse(page: str) -> list[Node]:
    """The elements of a page in document order; node 0 is the document."""
    nodes = [Node("#document", -1, 0, parts=[])]
    open_ = [0]
    at, raw = 0, None
    for m in _TAG.finditer(page):
        if m.start() < at:
            continue
        if raw is not None:
            if m.group(1) != "/" or (m.group(2) or "").lower() != raw:
                continue
            at = m.start()
            raw = None
        if m.start() > at:
            nodes[open_[-1]].parts.append(page[at:m.start()])
        at = m.end()
        if m.group(2) is None:
            if m.group(0).startswith("<![CDATA["):
                nodes[open_[-1]].parts.append(m.group(0)[9:].removesuffix("]]>"))
            continue
        tag = m.group(2).lower()
        if m.group(1):
            for k in range(len(open_) - 1, 0, -1):
                if nodes[open_[k]].tag == tag:
                    del open_[k:]
                    break
                if tag not in BLOCK and nodes[open_[k]].tag in BLOCK:
                    break  # an inline end tag does not close a block
            continue
        if tag == "br":
            nodes[open_[-1]].parts.append(" ")
            continue
        if tag in VOID and tag not in CONTROLS and tag != "hr":
            continue
        if tag in CLOSES_P:
            for k in range(len(open_) - 1, 0, -1):
                name = nodes[open_[k]].tag
                if name == "p":
                    del open_[k:]
                    break
                if name in BLOCK:
                    break
        if tag in SAME:
            for k in range(len(open_) - 1, 0, -1):
                name = nodes[open_[k]].tag
                if name in SCOPE[tag]:
                    break
                if name in SAME[tag]:
                    del open_[k:]
                    break
        bad, good, hidden, label = _tokens(tag, m.group(3))
        up = open_[-1]
        node = Node(tag, up, nodes[up].depth + 1, bad, good, hidden or nodes[up].hidden or tag in HIDDEN, [], label)
        nodes.append(node)
        nodes[up].parts.append(len(nodes) - 1)
        if tag not in VOID and not m.group(3).endswith("/"):
            open_.append(len(nodes) - 1)
            if tag in RAW:
                raw = tag
        elif tag not in VOID and tag in BLOCK:
            open_.append(len(nodes) - 1)  # a slash does not close such an element
    if raw is None and at < len(page):
        nodes[open_[-1]].parts.append(page[at:])
    return nodes


def features(nodes: list[Node]) -> np.ndarray:
    n = len(nodes)
    text, links, ends, words = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    controls, below, children, paragraphs = np.zeros(n), np.ones(n), np.zeros(n), np.zeros(n)
    start, seen = np.zeros(n), 0.0
    own_place, rank = np.zeros(n), {}
    for i, node in enumerate(nodes):
        start[i] = seen
        if i:
            up = node.up
            own_place[i] = children[up]
            children[up] += 1
            rank.setdefault((up, node.tag), []).append(i)
            controls[i] += node.tag in CONTROLS
            paragraphs[i] += node.tag == "p"
        if not node.hidden:
            for part in node.parts:
                if type(part) is str:
                    size = len(part)
                    text[i] += size
                    seen += size
                    ends[i] += len(_ENDS.findall(part))
                    words[i] += part.count(" ")
    for i in range(n - 1, 0, -1):
        node = nodes[i]
        if node.tag == "a":
            links[i] = text[i]
        up = node.up
        text[up] += text[i]
        links[up] += links[i]
        ends[up] += ends[i]
        words[up] += words[i]
        controls[up] += controls[i]
        paragraphs[up] += paragraphs[i]
        below[up] += below[i]
    x = np.zeros((n, WIDTH), "f4")
    total = max(text[0], 1.0)
    up = np.array([max(node.up, 0) for node in nodes])
    some = np.maximum(text, 1)
    x[:, F_DEPTH] = [node.depth for node in nodes]
    x[:, F_TEXT] = np.log1p(text)
    x[:, F_LINKS] = links / some
    x[:, F_DENSITY] = np.log1p(text / below)
    x[:, F_CHILDREN] = np.log1p(children)
    x[:, F_ENDS] = 100 * ends / some
    x[:, F_BAD] = [node.bad for node in nodes]
    x[:, F_GOOD] = [node.good for node in nodes]
    for i in range(1, n):
        p = nodes[i].up
        x[i, F_BAD_ABOVE] = x[p, F_BAD_ABOVE] + nodes[p].bad
        x[i, F_GOOD_ABOVE] = x[p, F_GOOD_ABOVE] + nodes[p].good
    x[:, F_KIND] = [_KINDS.get(node.tag, 0) for node in nodes]
    x[:, F_PLACE] = own_place / np.maximum(children[up], 1)
    x[:, F_SIBLINGS] = np.log1p(children[up])
    alike = np.zeros(n)
    for same in rank.values():
        alike[same] = len(same)
    x[:, F_ALIKE] = alike / np.maximum(children[up], 1)
    x[:, F_RATIO] = np.log1p(text * np.maximum(children[up], 1) / np.maximum(text[up], 1))
    x[:, F_START] = start / total
    x[:, F_CONTROLS] = np.log1p(controls)
    x[:, F_SHARE] = text / total
    x[:, F_PARAGRAPHS] = np.log1p(paragraphs)
    x[:, F_WORD] = np.minimum(some / np.maximum(words, 1), 40)
    return x


def semantic_labels(nodes: list[Node]) -> np.ndarray:
    """1 in an article or main element, 0 in or as page furniture, -1 where the tags say nothing."""
    y = np.full(len(nodes), -1)
    for i, node in enumerate(nodes[1:], 1):
        above = y[node.up]
        if above == 0 or node.bad and not node.good:
            y[i] = 0
        elif above == 1 or node.good:
            y[i] = 1
    if not (y == 1).any():
        return np.full(len(nodes), -1)
    holds = np.zeros(len(nodes), bool)
    for i in range(len(nodes) - 1, 0, -1):
        holds[nodes[i].up] |= holds[i] or y[i] == 1
    y[(y == -1) & ~holds] = 0  # beside the article, not around it
    return y


def generated_pages(n: int = GENERATED, seed: int = SEED):
    """Pages with known answers: ``(html, kept texts)``; layouts with and without semantic tags."""
    r = random.Random(seed)
    syllables = "ba ce di fo gu la me ni po ru sa te vi xo zu".split()
    word = lambda: "".join(r.choices(syllables, k=r.randint(1, 4)))

    def sentence():
        w = [word() for _ in range(r.randint(1, 16))]
        return " ".join(w).capitalize() + r.choice(".....?!")

    text = lambda k: " ".join(sentence() for _ in range(k))
    links = lambda k: "".join(f'<li><a href="/{word()}">{word()}</a></li>' for _ in range(k))
    furniture = [
        lambda: f"<nav><ul>{links(r.randint(2, 9))}</ul></nav>",
        lambda: f'<div class="menu"><ul>{links(r.randint(2, 9))}</ul></div>',
        lambda: f"<header><a href='/'>{word()}</a><p>{sentence()}</p></header>",
        lambda: f"<footer><p>&copy; {word()} {sentence()}</p></footer>",
        lambda: f'<div id="footer">{sentence()} <a href="/x">{word()}</a></div>',
        lambda: f"<aside><h3>{word()}</h3><p>{text(2)}</p></aside>",
        lambda: f'<div class="sidebar"><h3>{word()}</h3><ul>{links(4)}</ul><p>{sentence()}</p></div>',
        lambda: f'<div class="{r.choice(["ad", "advert", "sponsored", "promo"])}">{text(r.randint(1, 2))}</div>',
        lambda: f'<div class="cookie-notice"><p>{text(2)}</p><button>{word()}</button></div>',
        lambda: f'<form action="/s"><label>{word()}</label><input name="q"><button>{word()}</button></form>',
        lambda: ('<section id="comments"><h2>' + word() + "</h2>" + "".join(
            f'<div class="comment"><b>{word()}</b><p>{text(r.randint(1, 3))}</p></div>'
            for _ in range(r.randint(1, 5))) + "</section>"),
        lambda: f'<div class="related"><h3>{word()}</h3><ul>{links(3)}</ul></div>',
        lambda: f'<div class="share">{word()} <a href="/a">{word()}</a> <a href="/b">{word()}</a></div>',
        lambda: f'<ul>{links(r.randint(3, 8))}</ul>',
    ]
    frames = ["article", "main", 'div class="content"', 'div id="post"', "div", "div", 'section class="entry"']
    for _ in range(n):
        frame = r.choice(frames)
        inner = f"<h1>{sentence()}</h1>" if r.random() < 0.8 else ""
        for _ in range(r.choice((1, 1, 2, 3, 4, 6, 8, 10))):
            kind = r.random()
            inner += (f"<p>{text(r.randint(1, 6))}</p>" if kind < 0.8 else
                      f"<ul><li>{sentence()}</li><li>{sentence()}</li></ul>" if kind < 0.87 else
                      f"<blockquote><p>{sentence()}</p></blockquote>" if kind < 0.93 else f"<h2>{sentence()}</h2>")
            if r.random() < 0.08:
                inner += r.choice(furniture[5:])()
        if r.random() < 0.12:  # nothing but a little text
            yield f"<div data-main>{inner}</div>"
            continue
        before = "".join(r.choice(furniture)() for _ in range(r.randint(0, 3)))
        after = "".join(r.choice(furniture)() for _ in range(r.randint(0, 4)))
        body = f"{before}<{frame} data-main>{inner}</{frame.split()[0]}>{after}"
        if r.random() < 0.4:
            body = f'<div class="page">{body}</div>'
        yield f"<html><head><title>{sentence()}</title></head><body>{body}</body></html>"


def generated_labels(page: str, nodes: list[Node]) -> np.ndarray:
    """Labels of a generated page: its marked frame without furniture inside."""
    order = [m.group(3) for m in _TAG.finditer(page) if m.group(2) and not m.group(1)
             and (m.group(2).lower() not in VOID or m.group(2).lower() in CONTROLS)]
    y = np.zeros(len(nodes), int)
    y[0] = -1
    for i, node in enumerate(nodes[1:], 1):
        if "data-main" in order[i - 1]:
            y[i] = 1
        elif y[node.up] == 1:
            link_list = node.tag == "ul" and page and _only_links(nodes, i)
            y[i] = int(not (node.bad or link_list))
    for i in range(len(nodes) - 1, 0, -1):
        if y[i] == 1 and y[nodes[i].up] == 0 or y[i] == -1:
            y[nodes[i].up] = -1  # around the article: either may be said
    return y


def _only_links(nodes, i) -> bool:
    return all(type(p) is int and any(type(q) is int and nodes[q].tag == "a" for q in nodes[p].parts)
               for p in nodes[i].parts)


def training_rows(nodes: list[Node], y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = features(nodes)
    use = np.flatnonzero((y >= 0) & np.array([not node.hidden for node in nodes]))
    if len(use) > MOST_NODES:
        use = use[np.linspace(0, len(use) - 1, MOST_NODES).astype(int)]
    return x[use], y[use]


class BoostedTrees:
    """Boosted regression trees for the logistic loss, on binned features."""

    def __init__(self):
        self.trees, self.base = [], 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> "BoostedTrees":
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
        self.base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score = np.full(len(y), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, edges, y - p, p * (1 - p))
            self.trees.append(tree)
            score += tree[3][leaf]
        return self

    @staticmethod
    def _grow(binned, edges, g, h):
        """A full tree of ``DEPTH`` levels: split feature and value by heap place, leaf values."""
        inner = (1 << DEPTH) - 1
        feature, value = np.zeros(inner, int), np.full(inner, np.inf)
        at = np.zeros(len(g), int)
        for place in range(inner):
            rows = np.flatnonzero(at == place)
            best = (1e-3, None, None)
            if len(rows) > 20:
                total_g, total_h = g[rows].sum(), h[rows].sum()
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    left_g = np.cumsum(np.bincount(binned[rows, j], g[rows], len(e) + 1))[:-1]
                    left_h = np.cumsum(np.bincount(binned[rows, j], h[rows], len(e) + 1))[:-1]
                    gain = (left_g ** 2 / (left_h + 1) + (total_g - left_g) ** 2 / (total_h - left_h + 1)
                            - total_g ** 2 / (total_h + 1))
                    k = int(gain.argmax())
                    if gain[k] > best[0]:
                        best = (gain[k], j, k)
            if best[1] is not None:
                feature[place], value[place] = best[1], edges[best[1]][best[2]]
                right = binned[rows, best[1]] > best[2]
            else:
                right = np.zeros(len(rows), bool)
            at[rows] = 2 * place + 1 + right
        leaf = at - inner
        size = 1 << DEPTH
        leaves = SHRINK * np.bincount(leaf, g, size) / (np.bincount(leaf, h, size) + 1)
        return (feature, value, inner, leaves), leaf

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, value, inner, leaves in self.trees:
            at = np.zeros(len(x), int)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > value[at])
            score += leaves[at - inner]
        return score


def decode(nodes: list[Node], score: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Which nodes are kept: the best choice in which a dropped node drops all below it.

    A node's log odds count as often as it has text of its own (``own``, at least a little),
    so a wrapper's score does not outvote the paragraphs in it.
    """
    weight = np.log1p(own) + 0.1
    keep, drop = score * weight, -score * weight
    for i in range(len(nodes) - 1, 0, -1):
        up = nodes[i].up
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    kept = np.zeros(len(nodes), bool)
    kept[0] = True
    for i, node in enumerate(nodes[1:], 1):
        kept[i] = kept[node.up] and not node.hidden and keep[i] >= drop[i]
    return kept


def blocks(nodes: list[Node], kept: np.ndarray) -> list[str]:
    """Texts of the kept blocks in page order, references decoded, white space (no-break spaces too) made one blank."""
    out, run = [], []

    def flush():
        text = " ".join(_html.unescape("".join(run)).split())
        if text:
            out.append(text)
        run.clear()

    stack = [(0, 0)]
    while stack:
        i, k = stack.pop()
        node = nodes[i]
        block = node.tag in BLOCK
        if k == 0 and block:
            flush()
        parts = node.parts
        while k < len(parts):
            part = parts[k]
            k += 1
            if type(part) is str:
                if not node.hidden:
                    run.append(part)
            elif kept[part]:
                stack.append((i, k))
                stack.append((part, 0))
                break
            elif nodes[part].tag in BLOCK:
                flush()
        else:
            if block:
                flush()
    flush()
    return out


def main_texts(pages: list[str], trees: BoostedTrees) -> list[str]:
    """The main text of each page; the trees see the nodes of all of them at once."""
    parsed = [parse(page) for page in pages]
    if not parsed:
        return []
    scores = trees.log_odds(np.concatenate([features(nodes) for nodes in parsed]))
    out, at = [], 0
    for nodes in parsed:
        own = np.array([sum(len(p) for p in node.parts if type(p) is str and not p.isspace()) for node in nodes], "f8")
        out.append("\n".join(blocks(nodes, decode(nodes, scores[at:at + len(nodes)], own))))
        at += len(nodes)
    return out


_MASKED = [F_BAD, F_BAD_ABOVE, F_GOOD, F_GOOD_ABOVE]


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", most: int = MOST_TRAINED) -> BoostedTrees:
    """Trees from at most ``most`` pages of the table and from the generated ones."""

    def rows(frames):
        for frame in frames:
            for page in frame["html"]:
                nodes = parse(page)
                x, y = training_rows(nodes, semantic_labels(nodes))
                if len(x):
                    yield pd.DataFrame({"x": [x.astype("f4").tobytes()], "y": [y.astype("i1").tobytes()]})

    ids = (pages.select(pages[id_col].alias("t_id")).where("t_id is not null").distinct()
           .orderBy(F.xxhash64("t_id"), "t_id").limit(most))
    sample = pages.select(pages[id_col].alias("id"), pages[html_col].alias("html")).where("html is not null")
    sample = sample.join(F.broadcast(ids), sample["id"] == ids["t_id"]).select("html")  # bounded by ``most``
    made = sorted((bytes(r["x"]), bytes(r["y"])) for r in sample.mapInPandas(rows, "x binary, y binary").collect())
    xs = [np.frombuffer(x, "f4").reshape(-1, WIDTH) for x, _ in made]
    ys = [np.frombuffer(y, "i1") for _, y in made]
    for page in generated_pages():
        nodes = parse(page)
        x, y = training_rows(nodes, generated_labels(page, nodes))
        xs.append(x)
        ys.append(y)
    x, y = np.concatenate(xs), np.concatenate(ys)
    hidden = x[::2].copy()
    hidden[:, _MASKED] = 0
    return BoostedTrees().fit(np.concatenate((x, hidden)), np.concatenate((y, y[::2])).astype("f8"))


def extract(pages: DataFrame, trees: BoostedTrees, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row."""
    held = pages.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("string")
    def text_of(page: pd.Series) -> pd.Series:
        out = []
        for a in range(0, len(page), PAGES_AT_ONCE):
            out += main_texts(page.iloc[a:a + PAGES_AT_ONCE].tolist(), held.value)
        return pd.Series(out, dtype="object")

    f = pages.select(pages[id_col].alias("page_id"), pages[url_col].alias("url"),
                     text_of(F.coalesce(pages[html_col].cast("string"), F.lit(""))).alias("text"))
    return f.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
