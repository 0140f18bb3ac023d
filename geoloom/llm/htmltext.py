"""HTML extraction by a tree-structured graphical model.

Block-level elements are the nodes; each is content or not. Unary potentials come from tag, class words and text
statistics, pairwise potentials from each parent-child edge (by the child's kind). Messages pass upward and downward
once, which gives every node's exact marginal; text directly in nodes that are more likely content than not is kept.
The potentials are fitted by gradient ascent on the likelihood of labelled pages, whose gradient needs the same marginals.

`labelled_pages` writes the training pages: layouts, class names and markup habits of web pages with known labels.

Defined results: null and empty pages have the text ""; malformed markup never fails (a `<` that begins no tag is text,
unclosed elements end with their parent, stray end tags are ignored); what script, style, template, iframe,
noembed and noframes hold is no text, up to the page's end where one is not closed; a line break inside a block is white space; all
Unicode white space, no-break spaces too, counts as white space; parsing takes time in proportion to a page's length, whatever
its markup; repeated rows give repeated results; of the columns
page_id, url and html are read.
"""

from __future__ import annotations

import functools
import html
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common

#: Where markup may begin: a comment, a declaration, or a tag's name.
START = re.compile(r"<!--|<[!?]|<(/?)([a-zA-Z][^\s/><]*)")
#: What a tag's end is looked for among: its end, or a quote that hides others.
MARK = re.compile(r"[>\"']")
ATTR = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+("[^"]*"|'[^']*'|[^\s>"']++))?|["']""")
CLASS_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RAW = {"script", "style", "template", "iframe", "noembed", "noframes"}
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I | re.A) for name in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
CLOSES_P = {"address", "article", "aside", "blockquote", "center", "details", "dialog", "dir", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul"}
NODES = CLOSES_P - {"hr"} | {"html", "head", "title", "body", "li", "dt", "dd", "caption", "legend", "tbody", "thead", "tfoot", "tr", "td", "th", "button", "select", "option", "textarea", "label"}
#: A start tag ends an open element of these, unless one of the others stands between.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}), "tbody": ({"tbody", "thead", "tfoot"}, {"table"}), "tfoot": ({"tbody", "thead"}, {"table"}), "body": ({"head"}, set())}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
TAGS = sorted(NODES)
KINDS = {**dict.fromkeys(("p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption", "li", "dt", "dd", "td", "th", "tr", "tbody", "thead", "caption"), 0), **dict.fromkeys(("nav", "aside", "footer", "header", "form", "head", "title", "button", "select", "option", "textarea", "label", "menu", "dialog", "fieldset", "legend"), 1), **dict.fromkeys(("article", "main", "section", "body", "html"), 2)}
OTHER_KIND, N_KINDS = 3, 4
NUMBERS = 8


class Ends:
    """Ends of tags. What a search without success has seen is not searched again, so that all of them together take linear time."""

    def __init__(self, source: str) -> None:
        self.source, self.failed = source, set()
        self.last, self.no_mark = source.rfind(">"), len(source) + 1

    def of(self, at: int) -> int:
        """The `>` that ends a tag whose name ends at `at`: the first outside quotes, the first at all where quotes stay open, -1 where there is none."""
        if at > self.last:
            return -1
        i, seen = at, []
        while i < self.no_mark:
            m = MARK.search(self.source, i)
            if not m:
                self.no_mark = i
                break
            k = m.start()
            if m[0] == ">":
                return k
            if k in self.failed:
                break
            seen.append(k)
            close = self.source.find(m[0], k + 1)
            if close < 0:
                break
            i = close + 1
        self.failed.update(seen)
        return self.source.find(">", at)


@dataclass
class Page:
    """Nodes in document order, and text blocks as (node, text, characters inside links)."""

    tag: list[str] = field(default_factory=list)
    words: list[tuple[str, ...]] = field(default_factory=list)
    parent: list[int] = field(default_factory=list)
    depth: list[int] = field(default_factory=list)
    label: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def parse(source: str) -> Page:
    """The element tree of a page; every block's text has its character references decoded and its white space unified."""
    p = Page(["html"], [()], [-1], [0], [0])
    stack, parts, at, links, linked = [0], [], 0, 0, 0
    ends, places = Ends(source), {"html": [0]}

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                p.blocks.append((stack[-1], text, min(linked, len(text))))
            parts.clear()
        linked = 0

    def innermost(names: set[str]) -> int:
        return max((places[n][-1] for n in names if places.get(n)), default=-1)

    def close(names: set[str], stops: set[str]) -> None:
        """Ends the innermost open element of these names, unless one of the stops stands inside it."""
        k = innermost(names)
        if k > 0 and k > innermost(stops - names):
            flush()
            for node in stack[k:]:
                places[p.tag[node]].pop()
            del stack[k:]

    def text(upto: int) -> None:
        nonlocal linked
        if upto > at:
            parts.append(source[at:upto])
            linked += (upto - at) if links else 0

    while at < len(source):
        m = START.search(source, at)
        if not m:
            text(len(source))
            break
        if m[2]:
            stop = ends.of(m.end())
        elif m[0] == "<!--":
            stop = source.find("-->", m.end())
            stop = len(source) if stop < 0 else stop + 2
        else:
            stop = source.find(">", m.end()) if m.end() <= ends.last else -1
        if stop < 0:  # begins no tag: text
            text(m.end())
            at = m.end()
            continue
        text(m.start())
        at = stop + 1
        name = (m[2] or "").lower()
        if not name:
            continue
        end, attrs = m[1] == "/", source[m.end() : stop]
        if name in RAW:
            if not end and not attrs.endswith("/"):
                stop = RAW_END[name].search(source, at)
                at = stop.end() if stop else len(source)
            parts.append(" ")
        elif name not in NODES:
            if name == "a":
                links = 0 if end else 1
            if name in ("br", "img", "input", "wbr"):
                parts.append("" if name == "wbr" else " ")
            elif name == "hr":
                close({"p"}, {"table", "td", "th", "button"})
                flush()
        elif end:
            if name not in ("html", "body"):
                close(HEADINGS if name in HEADINGS else {name}, {"table", "td", "th"} - {name} if name not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th") else {"table"} - {name})
                links = 0 if name != "li" else links
        elif name == "html":
            continue
        else:
            if name in CLOSES_P:
                close({"p"}, {"table", "td", "th", "button"})
            if name in IMPLIED:
                close(*IMPLIED[name])
            flush()
            a = {k.lower(): v.strip("\"'") for k, v in ATTR.findall(attrs) if v}
            node = len(p.tag)
            p.tag.append(name)
            p.words.append(tuple(w.lower() for w in CLASS_WORD.findall(" ".join(a.get(k, "") for k in ("class", "id", "role", "itemprop", "aria-label")))))
            p.parent.append(stack[-1])
            p.depth.append(p.depth[stack[-1]] + 1)
            p.label.append(int(a["data-y"]) if a.get("data-y") in ("0", "1") else p.label[stack[-1]])
            places.setdefault(name, []).append(len(stack))
            stack.append(node)
    flush()
    return p


def numbers(p: Page) -> np.ndarray:
    """Text statistics of each node."""
    n = len(p.tag)
    own, link, ends, sub, sublink, kids = (np.zeros(n) for _ in range(6))
    for node, text, linked in p.blocks:
        own[node] += len(text)
        link[node] += linked
        ends[node] += text[-1] in ".!?:;\"'”»…"
    sub, sublink = own.copy(), link.copy()
    for i in range(n - 1, 0, -1):  # parents come before their children
        sub[p.parent[i]] += sub[i]
        sublink[p.parent[i]] += sublink[i]
        kids[p.parent[i]] += 1
    some = np.maximum(own, 1)
    return np.stack((np.log1p(own) / 5, link / some, ends > 0, own > 0, np.log1p(sub) / 7, sublink / np.maximum(sub, 1), np.log1p(kids) / 3, np.ones(n)), axis=1)


@dataclass
class Model:
    words: dict[str, int]
    unary: np.ndarray
    pair: np.ndarray


def design(pages: list[Page], words: dict[str, int]) -> np.ndarray:
    """Feature rows of all nodes of all pages."""
    rows = sum(len(p.tag) for p in pages)
    x = np.zeros((rows, len(TAGS) + len(words) + NUMBERS), np.float32)
    tags, at = {t: i for i, t in enumerate(TAGS)}, 0
    for p in pages:
        for i, (t, ws) in enumerate(zip(p.tag, p.words, strict=True)):
            x[at + i, tags[t]] = 1
            for w in ws:
                if w in words:
                    x[at + i, len(TAGS) + words[w]] = 1
        x[at : at + len(p.tag), -NUMBERS:] = numbers(p)
        at += len(p.tag)
    return x


def graph(pages: list[Page]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Parents (row numbers over all pages), kinds, and the non-root nodes of each depth from the top."""
    parent, kind, depth, at = [], [], [], 0
    for p in pages:
        parent += [at + q if q >= 0 else -1 for q in p.parent]
        kind += [KINDS.get(t, OTHER_KIND) for t in p.tag]
        depth += p.depth
        at += len(p.tag)
    d = np.array(depth)
    order = np.argsort(d, kind="stable")
    levels = np.split(order, np.searchsorted(d[order], np.arange(1, d.max() + 1))) if len(d) else []
    return np.array(parent), np.array(kind), [lv for lv in levels[1:]]


def marginals(u: np.ndarray, pair: np.ndarray, parent: np.ndarray, kind: np.ndarray, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sum-product over the trees: each node's marginal (columns: other, content), and each edge's joint marginal [parent, child]. u: log potential of content."""
    n = len(u)
    local = np.stack((np.zeros(n), u), axis=1)
    up, msg, down = np.zeros((n, 2)), np.zeros((n, 2)), np.zeros((n, 2))

    def unit(a: np.ndarray) -> np.ndarray:
        return a - a.max(axis=-1, keepdims=True)

    for lv in reversed(levels):
        msg[lv] = unit(np.logaddexp.reduce((local[lv] + up[lv])[:, None, :] + pair[kind[lv]], axis=2))
        np.add.at(up, parent[lv], msg[lv])
    edge = np.zeros((n, 2, 2))
    for lv in levels:
        q = parent[lv]
        above = (local[q] + up[q] - msg[lv] + down[q])[:, :, None] + pair[kind[lv]]
        down[lv] = unit(np.logaddexp.reduce(above, axis=1))
        both = above + (local[lv] + up[lv])[:, None, :]
        both = np.exp(both - both.max(axis=(1, 2), keepdims=True))
        edge[lv] = both / both.sum(axis=(1, 2), keepdims=True)
    belief = np.exp(unit(local + up + down))
    return belief / belief.sum(axis=1, keepdims=True), edge


def fit(pages: list[Page], steps: int = 150, rate: float = 0.1, l2: float = 2e-4) -> Model:
    """Potentials that make the labels of the pages likely: gradient ascent with per-weight step sizes."""
    seen = Counter(w for p in pages for ws in p.words for w in set(ws))
    words = {w: i for i, (w, n) in enumerate(sorted(seen.items())) if n >= 2}
    words = {w: i for i, w in enumerate(sorted(words))}
    x, y = design(pages, words).astype(np.float64), np.concatenate([p.label for p in pages])
    parent, kind, levels = graph(pages)
    inner = np.flatnonzero(parent >= 0)
    want = np.zeros((N_KINDS, 2, 2))
    np.add.at(want, (kind[inner], y[parent[inner]], y[inner]), 1)
    w, pair = np.zeros(x.shape[1]), np.zeros((N_KINDS, 2, 2))
    theta, m1, m2 = np.zeros(w.size + pair.size), 0.0, 0.0
    for t in range(1, steps + 1):
        w, pair = theta[: w.size], theta[w.size :].reshape(pair.shape)
        belief, edge = marginals(x @ w, pair, parent, kind, levels)
        got = np.zeros_like(want)
        np.add.at(got, kind[inner], edge[inner])
        g = np.concatenate((x.T @ (y - belief[:, 1]), (want - got).ravel())) / len(y) - l2 * theta
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.99 * m2 + 0.01 * g * g
        theta = theta + rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-9)
    return Model(words, theta[: w.size], theta[w.size :].reshape(pair.shape))


def texts(sources: list[str], model: Model) -> list[str]:
    """The main text of each page."""
    pages = [parse(s) for s in sources]
    if not pages:
        return []
    belief, _ = marginals(design(pages, model.words) @ model.unary, model.pair, *graph(pages))
    out, at = [], 0
    for p in pages:
        keep = belief[at : at + len(p.tag), 1] > 0.5
        out.append("\n".join(t for node, t, _ in p.blocks if keep[node]))
        at += len(p.tag)
    return out


#: Names that page authors give to the parts of a page.
OUTSIDE = {
    "nav": "nav navbar menu navigation mainmenu breadcrumb breadcrumbs topbar toc pagination pager",
    "header": "header masthead siteheader branding logo pagehead top",
    "footer": "footer sitefooter copyright legal colophon bottom imprint",
    "aside": "sidebar aside widget rail related recommended trending popular archive tags author",
    "ad": "ad ads advert advertisement adbox banner sponsor sponsored promo promotion",
    "notice": "notice cookie consent gdpr alert warning message popup modal overlay paywall",
    "form": "form newsletter subscribe signup login search searchbox contact",
    "comments": "comments comment reply replies discussion respond disqus commentlist thread feedback reader",
    "share": "share social sharing follow buttons toolbar tools actions skip hidden",
}
INSIDE = "content main article post entry story text body articlebody postcontent entrycontent page document prose read"


def labelled_pages(n: int = 400, seed: int = 11) -> list[str]:
    """Pages with labels: data-y="1" begins content, data-y="0" what is not; elements without it have their parent's."""
    r = random.Random(seed)

    def words(k: int) -> str:
        w = ["".join(r.choice("etaoinshrdlucm") for _ in range(r.choice((1, 2, 3, 4, 5, 7, 9)))) for _ in range(max(1, k))]
        return " ".join(w).capitalize()

    def sentence(short: bool = False) -> str:
        return words(r.choice((1, 2, 4)) if short else r.choice((1, 3, 9, 20, 60))) + r.choice(("", ".", ".", ".", "?"))

    def link(k: int) -> str:
        return f'<a href="/{r.randrange(99)}">{words(k)}</a>'

    def named(kind: str) -> str:
        if r.random() < 0.25:
            return ""
        w = r.choice(OUTSIDE[kind].split())
        w = r.choice((w, w, f"{w}-{r.randrange(9)}", f"site-{w}", f"{w}-box"))
        return r.choice((f' class="{w}"', f' id="{w}"', f' class="{w} block"'))

    def menu(kind: str) -> str:
        items = "".join(f"<li>{link(r.choice((1, 1, 2, 6)))}" + r.choice(("", "</li>")) for _ in range(r.randrange(1, 9)))
        return f"<ul>{items}</ul>" if r.random() < 0.7 else " ".join(link(1) for _ in range(r.randrange(1, 7)))

    def prose(short: bool = True) -> str:
        return "".join(f"<p>{sentence(short and r.random() < 0.6)}</p>" for _ in range(r.randrange(1, 4)))

    def outside(kind: str, inside: bool = False) -> str:
        tag = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        name = named(kind)
        tag = tag if tag and (not name or r.random() < 0.6) else r.choice(("div", "div", "section", "ul" if kind == "nav" else "div"))
        if tag in ("div", "section", "ul") and not name:
            name = f' class="{r.choice(OUTSIDE[kind].split())}"'
        if tag == "ul":
            return f'<ul data-y="0"{name}>' + "".join(f"<li>{link(1)}</li>" for _ in range(5)) + "</ul>"
        body = {
            "nav": lambda: menu(kind),
            "header": lambda: r.choice((f"<h1>{words(2)}</h1>", f"<div>{link(2)}</div>", f"<p>{words(5)}</p>")) + r.choice(("", menu(kind))),
            "footer": lambda: r.choice(("", menu(kind))) + f"{r.choice(('&copy; ', ''))}{words(4)} {r.choice(('', '&middot; '))}{sentence()}",
            "aside": lambda: f"<h{r.choice('234')}>{words(2)}</h3>" + r.choice((menu(kind), prose(False), sentence())),
            "ad": lambda: r.choice((sentence(), sentence(), prose(), link(4))),
            "notice": lambda: r.choice((sentence(), prose(False))) + r.choice(("", f"<button>{words(1)}</button>")),
            "form": lambda: r.choice(("", f"<h3>{words(2)}</h3>", prose())) + f"<label>{words(1)}</label><input name=q><button>{words(1)}</button>" + r.choice(("", f"<select><option>{words(1)}<option>{words(1)}</select>")),
            "comments": lambda: f"<h3>{words(2)}</h3>" + "".join(r.choice((f"<div{named('comments')}><b>{words(1)}</b><p>{sentence()}</p></div>", f"<li>{sentence()}</li>", f"<p>{sentence()}</p>", f"<article{named('comments')}><p>{sentence()}</p></article>")) for _ in range(r.randrange(1, 5))),
            "share": lambda: " ".join(link(1) for _ in range(3)),
        }[kind]()
        return f'<{tag} data-y="0"{name}>{body}</{tag}>'

    def part() -> str:
        kind = r.random()
        if kind < 0.6:
            body = f"{sentence()} {r.choice(('', link(2), '<b>' + words(2) + '</b>', '<i>' + words(1)))} {r.choice(('', sentence()))}"
            return f"<p>{body}" + r.choice(("</p>", "</p>", "</p>", "", "<br>"))
        if kind < 0.7:
            return f"<h{(h := r.choice('2346'))}>{words(r.choice((1, 2, 5)))}</h{h}>"
        if kind < 0.78:
            t = r.choice(("ul", "ol"))
            return f"<{t}>" + "".join(f"<li>{r.choice((sentence(), sentence(True), link(3)))}" + r.choice(("", "</li>")) for _ in range(r.randrange(1, 6))) + f"</{t}>"
        if kind < 0.83:
            return f"<blockquote>{r.choice((sentence(), '<p>' + sentence() + '</p>'))}</blockquote>"
        if kind < 0.87:
            return f"<pre>{sentence()}\n{sentence(True)}</pre>"
        if kind < 0.91:
            return "<table>" + "".join(f"<tr><td>{sentence(True)}<td>{words(1)}</td></tr>" for _ in range(r.randrange(1, 4))) + "</table>"
        if kind < 0.94:
            return f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>"
        if kind < 0.97:
            return f"<dl><dt>{words(1)}<dd>{sentence()}</dl>"
        return f"<div>{sentence()}</div>"

    def article() -> str:
        name = f' class="{r.choice(INSIDE.split())}"' if r.random() < 0.6 else ""
        tag = r.choice(("article", "article", "main", "div", "section"))
        if tag in ("div", "section") and not name:
            name = f' id="{r.choice(INSIDE.split())}"'
        title = f"<h1>{words(6)}</h1>" if r.random() < 0.8 else ""
        title = f"<header>{title}</header>" if title and r.random() < 0.1 else title
        brief = r.random() < 0.25
        body = "" if brief and r.random() < 0.5 else title
        for _ in range(r.randrange(1, 3) if brief else r.randrange(1, 14)):
            body += f"<p>{sentence(True)}</p>" if brief else part()
            if r.random() < 0.06:
                body += outside(r.choice(("ad", "share", "form", "aside", "nav", "notice")))
        if r.random() < 0.2:
            body += outside("comments")
        for _ in range(r.choice((0, 0, 1))):
            body = f"<div>{body}</div>"
        return f'<{tag} data-y="1"{name}>{body}</{tag}>'

    out = []
    for _ in range(n):
        before = [outside(k) for k in r.sample(("nav", "header", "ad", "notice", "form", "share", "nav"), r.randrange(1, 5))]
        after = [outside(k) for k in r.sample(("aside", "ad", "comments", "form", "nav", "notice"), r.randrange(0, 5))]
        body = "".join(before) + (article() if r.random() < 0.97 else "") + "".join(after) + (outside("footer") if r.random() < 0.85 else "")
        for _ in range(r.choice((0, 0, 0, 1, 2))):
            body = f'<div class="{r.choice(("wrap", "container", "page", "row", "layout"))}">{body}</div>'
        out.append(f'<!DOCTYPE html><html><head data-y="0"><title>{words(5)}</title><style>p{{}}</style></head><body>{body}</body></html>')
    return out


@functools.cache
def default_model() -> Model:
    """The model of labelled_pages(), fitted once in a process."""
    return trained()


def trained(pages: list[str] | None = None) -> Model:
    return fit([parse(s) for s in (labelled_pages() if pages is None else pages)])


def extracted(pages: DataFrame, model: Model | None = None, together: int = 200) -> DataFrame:
    """page_id, url, text, n_chars of each row."""
    spark = pages.sparkSession
    common.ship(spark)
    sent = spark.sparkContext.broadcast(model or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, together):
                part = b.slice(at, together)
                found = texts([x or "" for x in part.column(2).to_pylist()], sent.value)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
