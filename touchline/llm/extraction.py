"""HTML extraction (operator 8): a linear-chain conditional random field over
the leaf blocks of a page.

A page is cut into leaf blocks in page order (block-level tags part them; text
in scripts, styles, the head, templates and comments is no block). Each block
has features of its ancestors' tags, of words in their class, id and role, of
its own text and of its place. A two-label chain (main text or not) is trained
in numpy by full gradient steps on labelled pages and decoded by Viterbi.

Labelled pages: at most ``max_pages`` given pages (those with the smallest hash
of their id) that mark their article up, labelled by that markup, and the small
labelled layouts of :func:`layouts`, filled with blocks of those pages, which
teach lists, quotes and tables inside an article and notices, adverts, forms,
sidebars and comments inside and around it.

Cases: a null or empty page, and one without main text, gives an empty text
with 0 characters; unclosed and stray tags are taken as a browser would (a head
ends at the first text or tag that cannot stand in it, an svg at the first block,
and either, like a template, with its parent); text in math, object and noscript
belongs to its block, text in svg to none; blocks are never dropped for their size; repeated rows are extracted alike, each on
its own row; a null page_id or url is kept; an empty table gives no rows; other
columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import ship, slices, table

ship(__name__)

BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section "
                  "select summary table tbody td textarea tfoot th thead tr ul button iframe".split())
SKIP = frozenset("script style head template svg".split())
#: What may stand in a head; any other tag ends it.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: Tags that end an open svg, unless they stand in one of its elements that hold HTML.
NOT_IN_SVG = BLOCK - frozenset("iframe button".split()) | frozenset("b big br code em embed i img meta nobr s small span strike "
                                                                    "strong sub sup tt u var".split())
HOLDS_HTML = frozenset("foreignobject desc title".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: What an opening tag ends, if open in the same list, table or block.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "optgroup": {"option", "optgroup"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPE = frozenset("ul ol dl table select menu article section div main aside nav footer header body".split())
WORD = re.compile(r"[a-z]+")
#: Beginnings of class, id and role words that name what is around an article.
AROUND = ("ad", "advert", "banner", "breadcrumb", "byline", "comment", "cookie", "consent", "disqus", "footer", "form", "gdpr",
          "header", "login", "masthead", "menu", "modal", "nav", "newsletter", "notice", "pagination", "popup", "promo",
          "related", "reply", "respond", "search", "share", "sidebar", "signup", "social", "sponsor", "subscribe", "toolbar",
          "widget")
AROUND_TAGS = frozenset("nav aside footer header form button select textarea dialog menu iframe".split())


#: Elements that hold the whole page or its article: their class words tell the layout, not what the text is.
HOLDERS = frozenset("html body main article".split())


def around(name: str) -> str | None:
    """The listed beginning that a class, id or role name has: in its last word, or in
    either of two. (Of longer names the other words say what the last one is about.)
    Short beginnings must be the whole word or its plural."""
    words = WORD.findall(name)
    for word in reversed(words if len(words) <= 2 else words[-1:]):
        for a in AROUND:
            if word == a or word == a + "s" or (len(a) > 4 and word.startswith(a)):
                return a
    return None


class Blocks(HTMLParser):
    """Leaf blocks of a page: (text, ancestors' features, characters in links)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.out: list[tuple[str, tuple[str, ...], int]] = []
        self.text: list[str] = []
        self.links = 0
        self.skip = 0

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            feats = {f for _, fs in self.stack for f in fs}
            own = next((t for t, _ in reversed(self.stack) if t in BLOCK), "none")
            self.out.append((text, (f"own:{own}", *sorted(feats)), self.links))
        self.text, self.links = [], 0

    def cut(self, i: int) -> None:
        """Close the open elements from the i-th on."""
        self.skip -= sum(t in SKIP for t, _ in self.stack[i:])
        del self.stack[i:]

    def end_skipped(self, tag: str) -> None:
        """Close a head or svg in which the tag cannot stand."""
        i = max(i for i, (t, _) in enumerate(self.stack) if t in SKIP)
        if self.stack[i][0] == "head":
            if tag not in IN_HEAD and (tag == "body" or all(t not in ("title", "noscript") for t, _ in self.stack[i:])):
                self.cut(i)
        elif self.stack[i][0] == "svg" and tag in NOT_IN_SVG and all(t not in HOLDS_HTML for t, _ in self.stack[i:]):
            self.cut(i)
            if self.skip:
                self.end_skipped(tag)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skip:
            self.end_skipped(tag)
        if tag in SKIP or self.skip:
            if tag not in VOID:
                self.skip += tag in SKIP
                self.stack.append((tag, ()))
            return
        if tag in BLOCK:
            self.flush()
            self.close_implied(tag)
        elif tag == "br":
            self.text.append(" ")
        if tag in VOID:
            return
        feats = [f"in:{tag}"] if tag in BLOCK or tag == "a" else []
        for name, value in attrs:
            if name in ("class", "id", "role") and value and tag not in HOLDERS:
                for w in value.lower().split():
                    if a := around(w):
                        feats += ["around", f"around:{a}"]
        self.stack.append((tag, tuple(feats)))

    def close_implied(self, tag: str) -> None:
        if self.stack and any(t == "p" for t, _ in self.stack):
            for i in range(len(self.stack) - 1, -1, -1):      # a block ends an open paragraph
                if self.stack[i][0] == "p":
                    self.cut(i)
                    break
                if self.stack[i][0] in SCOPE:
                    break
        if tag in CLOSES:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] in CLOSES[tag]:
                    self.cut(i)
                    break
                if self.stack[i][0] in SCOPE:
                    break

    def handle_endtag(self, tag: str) -> None:
        i = next((i for i in range(len(self.stack) - 1, -1, -1) if self.stack[i][0] == tag), -1)
        inside = self.skip and (i < 0 or any(t in SKIP for t, _ in self.stack[:i]))     # a tag of what is skipped
        if tag in BLOCK and not inside:
            self.flush()
        if i < 0:
            return
        if tag not in BLOCK and tag not in SKIP and any(t in BLOCK for t, _ in self.stack[i + 1:]):
            # an inline tag closed across blocks: only itself
            del self.stack[i]
        else:
            self.cut(i)     # also what is skipped and was left open in it

    def handle_data(self, data: str) -> None:
        if self.skip and self.stack[-1][0] == "head" and data.strip():
            self.cut(len(self.stack) - 1)
        if not self.skip:
            self.text.append(data)
            if any(t == "a" for t, _ in self.stack):
                self.links += len(data.strip())


def blocks(html: str | None) -> list[tuple[str, tuple[str, ...], int]]:
    """The page's leaf blocks in page order."""
    p = Blocks()
    p.feed(html or "")
    p.close()
    p.flush()
    return p.out


def text_features(text: str, links: int, first: bool, last: bool) -> list[str]:
    n = len(text)
    out = ["bias", f"size:{min(n.bit_length(), 10)}", "links:" + ("none" if not links else "some" if links < n / 2 else "most")]
    if text[-1] in ".!?…:;\"'":
        out.append("ends")
    if "©" in text:
        out.append("copyright")
    if first:
        out.append("first")
    if last:
        out.append("last")
    return out


def page_features(page: list[tuple[str, tuple[str, ...], int]]) -> list[list[str]]:
    end = len(page) - 1
    return [[*path, *text_features(text, links, i == 0, i == end)] for i, (text, path, links) in enumerate(page)]


def marked_up(page: list[tuple[str, tuple[str, ...], int]]) -> list[int] | None:
    """Labels by the page's own markup, if it marks its article up."""
    labels = []
    for _, path, _ in page:
        inside = "in:article" in path or "in:main" in path
        labels.append(int(inside and "around" not in path and not any(f"in:{t}" in path for t in AROUND_TAGS)))
    return labels if any("in:article" in path or "in:main" in path for _, path, _ in page) else None


def layouts(texts: list[str]) -> list[tuple[str, list[int]]]:
    """Labelled layouts (html, label per leaf block), filled in turn with
    ``texts``: what stands in and around an article besides paragraphs."""
    import html as h

    at = iter(range(10 ** 9))
    t = lambda: h.escape(texts[next(at) % len(texts)])
    s = lambda: h.escape(" ".join(texts[next(at) % len(texts)].split()[:3]))
    inner = ["<h1>{s}</h1>", "<h2>{s}</h2>", "<ul><li>{t}</li><li>{s}</li></ul>", "<ol><li>{s}</li><li>{t}</li></ol>",
             "<blockquote><p>{t}</p></blockquote>", "<table><tr><td>{s}</td><td>{s}</td></tr></table>", "<pre>{t}</pre>",
             "<figure><figcaption>{s}</figcaption></figure>", "<section><h2>{s}</h2><p>{t}</p></section>",
             "<div>{t}</div>", "<p><a href=x>{s}</a> {t}</p>", "<p>{s}</p>", "<dl><dt>{s}</dt><dd>{t}</dd></dl>"]
    noise = [f'<div class="{a}"><p>{{t}}</p><p>{{s}}</p></div>' for a in AROUND] + \
            [f'<{tag}><p>{{t}}</p></{tag}>' for tag in ("aside", "nav", "footer", "header", "form")] + \
            ['<section class="comments"><h2>{s}</h2><ol><li>{t}</li><li>{t}</li></ol></section>',
             '<nav><ul><li><a href=x>{s}</a></li><li><a href=x>{s}</a></li></ul></nav>',
             '<form><textarea>{s}</textarea><button>{s}</button></form>', '<aside><h2>{s}</h2><ul><li><a href=x>{t}</a></li></ul></aside>']

    def fill(part: str) -> str:
        while "{t}" in part or "{s}" in part:
            part = part.replace("{t}", t(), 1) if "{t}" in part else part.replace("{s}", s(), 1)
        return part

    def count(part: str) -> int:
        return len(blocks(part))

    out = []
    for i, n in enumerate(noise):
        for j, wrap in enumerate(("article", "main", 'div class="content"', "body")):
            a, b, c = (inner[(i * 4 + j + k) % len(inner)] for k in (0, 5, 9))
            html, labels = "<body>", []
            def add(part: str, label: int) -> None:
                nonlocal html
                part = fill(part)
                html += part
                labels.extend([label] * count(part))
            add(noise[(i + 7) % len(noise)], 0)
            html += f"<{wrap}>" if wrap != "body" else ""
            add("<p>{t}</p>", 1)
            add(a, 1)
            if j % 2:
                add(n, 0)       # inside the article
            add(b, 1)
            add("<p>{t}</p>", 1)
            add(c, 1)
            html += f"</{wrap.split()[0]}>" if wrap != "body" else ""
            add(n if not j % 2 else noise[(i + 3) % len(noise)], 0)
            add("<footer>&copy; {s}</footer>", 0)
            out.append((html + "</body>", labels))
    return out


class Chain:
    """Two-label linear-chain CRF: weights per feature and label, transitions
    and first labels."""

    def __init__(self, names: dict[str, int], weights: np.ndarray, trans: np.ndarray, start: np.ndarray) -> None:
        self.names, self.weights, self.trans, self.start = names, weights, trans, start

    def parts(self) -> tuple:
        return self.names, self.weights, self.trans, self.start

    def viterbi(self, page: list[list[str]]) -> list[int]:
        """The most likely labels; of equal ones, not main text."""
        if not page:
            return []
        get, w = self.names.get, self.weights
        scores = []
        for feats in page:
            at = [i for f in feats if (i := get(f)) is not None]
            scores.append(w[at].sum(0) if at else np.zeros(2))
        (t00, t01), (t10, t11) = self.trans.tolist()
        a, b = (self.start + scores[0]).tolist()
        back = []
        for e0, e1 in (x.tolist() for x in scores[1:]):
            from0, from1 = (int(b + t10 > a + t00), int(b + t11 > a + t01))
            a, b = max(a + t00, b + t10) + e0, max(a + t01, b + t11) + e1
            back.append((from0, from1))
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def fit(pages: list[tuple[list[list[str]], list[int]]], epochs: int = 150, l2: float = 1e-3, rate: float = 0.3) -> Chain:
    """Maximum likelihood with an L2 penalty, by full gradient steps (Adam);
    forward-backward runs over all pages at once, padded to the longest."""
    names: dict[str, int] = {}
    rows, cols, bounds, gold = [], [], [0], []
    for feats, labels in pages:
        for f, label in zip(feats, labels, strict=True):
            rows += [len(gold)] * len(f)
            cols += [names.setdefault(x, len(names)) for x in f]
            gold.append(label)
        bounds.append(len(gold))
    n, k = len(gold), len(names)
    trans, start = np.zeros((2, 2)), np.zeros(2)
    weights = np.zeros((k, 2))
    if not n:
        return Chain(names, weights, trans, start)
    rows_, cols_, y = np.array(rows), np.array(cols), np.array(gold)
    lo = np.array(bounds[:-1])
    size = np.diff(bounds)
    lo, size = lo[size > 0], size[size > 0]
    longest, many = int(size.max()), len(size)
    at = np.minimum(lo[:, None] + np.arange(longest), n - 1)
    live = np.arange(longest)[None, :] < size[:, None]
    onehot = np.eye(2)[y]
    theta = np.concatenate([weights.ravel(), trans.ravel(), start])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    pair_gold = np.zeros((2, 2))
    inner = live[:, 1:]
    np.add.at(pair_gold, (y[at[:, :-1]][inner], y[at[:, 1:]][inner]), 1)
    for step in range(1, epochs + 1):
        weights, trans, start = theta[:2 * k].reshape(k, 2), theta[2 * k:2 * k + 4].reshape(2, 2), theta[2 * k + 4:]
        emit = np.stack([np.bincount(rows_, weights[cols_, c], n) for c in (0, 1)], 1)
        e = np.where(live[:, :, None], emit[at], 0.0)
        alpha, beta = np.zeros((many, longest, 2)), np.zeros((many, longest, 2))
        alpha[:, 0] = start + e[:, 0]
        for i in range(1, longest):
            nxt = np.logaddexp(alpha[:, i - 1, 0, None] + trans[0], alpha[:, i - 1, 1, None] + trans[1]) + e[:, i]
            alpha[:, i] = np.where(live[:, i, None], nxt, alpha[:, i - 1])
        for i in range(longest - 2, -1, -1):
            z = e[:, i + 1] + beta[:, i + 1]
            nxt = np.logaddexp(trans[:, 0] + z[:, 0, None], trans[:, 1] + z[:, 1, None])
            beta[:, i] = np.where(live[:, i + 1, None], nxt, 0.0)
        logz = np.logaddexp(alpha[:, -1, 0], alpha[:, -1, 1])
        post = np.exp(alpha + beta - logz[:, None, None]) * live[:, :, None]
        pair = np.exp(alpha[:, :-1, :, None] + trans + (e + beta)[:, 1:, None, :] - logz[:, None, None, None]) * inner[:, :, None, None]
        flat = np.zeros((n, 2))
        flat[at[live]] = post[live]
        d = flat - onehot
        g_w = np.stack([np.bincount(cols_, d[rows_, c], k) for c in (0, 1)], 1) / many
        g_t = (pair.sum((0, 1)) - pair_gold) / many
        g_s = (post[:, 0].sum(0) - onehot[lo].sum(0)) / many
        g = np.concatenate([g_w.ravel(), g_t.ravel(), g_s]) + l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Chain(names, theta[:2 * k].reshape(k, 2), theta[2 * k:2 * k + 4].reshape(2, 2), theta[2 * k + 4:])


def train(pages: DataFrame, max_pages: int = 384, max_blocks: int = 200) -> Chain:
    """The chain from at most ``max_pages`` marked-up pages of ``pages``
    (page_id, html) and the layouts; a sampled page of more than ``max_blocks``
    blocks is not fitted to. What reaches the driver is those pages' features."""
    sample = (pages.filter(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
              .orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            feats, labels, texts = [], [], []
            for page in map(blocks, b.column(1).to_pylist()):
                marks = marked_up(page)
                if marks is not None and len(page) <= max_blocks:
                    feats.append([",".join(f) for f in page_features(page)])
                    labels.append(marks)
                    texts.append([t for (t, _, _), y in zip(page, marks, strict=True) if y and len(t) <= 400][:4])
            yield pa.RecordBatch.from_arrays([pa.array(feats, pa.list_(pa.string())), pa.array(labels, pa.list_(pa.int32())),
                                              pa.array(texts, pa.list_(pa.string()))], names=["feats", "labels", "texts"])

    rows = (sample.select("page_id", "html").mapInArrow(run, "feats array<string>, labels array<int>, texts array<string>")
            .orderBy(F.xxhash64(F.array_join("feats", " "))).toArrow().to_pylist())
    known = [([f.split(",") for f in r["feats"]], r["labels"]) for r in rows]
    fillers = [t for r in rows for t in r["texts"]] or ["Some words of a text.", "Other words"]
    known += [(page_features(page), labels) for page, labels in ((blocks(h), y) for h, y in layouts(fillers))
              if len(page) == len(labels)]
    return fit(known)


def extract(pages: DataFrame, chain: Chain) -> DataFrame:
    """``pages`` (page_id, url, html) with the main text of each whole page:
    page_id, url, text."""
    sent = pages.sparkSession.sparkContext.broadcast(chain.parts())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Chain(*sent.value)
        for b in slices(batches):
            texts = []
            for html in b.column(2):
                page = blocks(html.as_py())
                labels = model.viterbi(page_features(page))
                texts.append("\n\n".join(t for (t, _, _), y in zip(page, labels, strict=True) if y))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(run, "page_id long, url string, text string")


def op8_html_extraction(spark, sf_dir: str) -> DataFrame:
    """The main text of every whole page: page_id, url, text, n_chars."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages, train(pages)).withColumn("n_chars", F.length("text").cast("long"))
