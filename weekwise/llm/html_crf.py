"""Main text of web pages by a linear-chain conditional random field.

A page is read into leaf blocks: the text between the borders of block
elements, with the tags and class words above it.  A two-label chain (main
text or not) scores every block by features of its ancestors and its text and
every pair of neighbours by a transition; Viterbi picks the best labelling of
the page.

The field is trained on labelled pages: a bounded sample of the table, whose
blocks are labelled by the elements made for the purpose (``article`` and
``main`` against ``nav``, ``footer``, ``aside`` and the like), and the same
pages' texts poured into the fixed layouts below, which label themselves.

Scripts, styles, comments and the head hold no blocks; a head that is not
closed ends at the first element that cannot be in it, or at text.  Within a block, white
space of any kind is one blank; blocks are joined by a line feed.

Defined cases: null, empty and text-free pages give ""; markup that is not
closed ends with its parent; repeated rows are read one by one.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekwise.llm.text_arrays import chunks

FIT_PAGES = 150          # pages of the table that the field is fitted on, at most
FIT_CHARS = 200_000      # longest page among them

# HTML's elements by what they do to the text.
BLOCK = set("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table
    tbody td tfoot th thead tr ul caption option select button label""".split())
HIDDEN = set("script style head title template noscript svg iframe textarea".split())
# A head whose end is left out ends before the first element that cannot be in it.
IN_HEAD = set("head title base basefont bgsound link meta script style noscript noframes template".split())
RAW = set("script style title textarea iframe noscript".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "menu", "table", "dl", "select"}
OPEN_P = BLOCK - {"body", "html", "option", "select", "button", "label", "legend", "tbody", "thead", "tfoot", "tr", "td",
                  "th", "caption"}
MAIN = {"article", "main"}
SIDE = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog"}
SIDE_WORDS = set("""ad ads advert advertisement banner sponsor sponsored promo comment comments reply replies cookie
    consent notice newsletter sidebar menu nav navbar breadcrumb breadcrumbs share social related widget footer""".split())

# Layouts of labelled pages.  $T and $P are a title and
# paragraphs of the main text, $B, $I and $D a quotation, a list and bare
# blocks of it; the others are not: $L links, $S a short line, $Q a paragraph
# that a reader or advertiser wrote.
LAYOUTS = [
    '<div id="header"><div class="logo">$S</div><ul class="menu">$L</ul></div><div id="content"><h1>$T</h1>$P</div>'
    '<div id="sidebar"><h3>$S</h3><ul>$L</ul></div><div id="footer"><p>$S</p></div>',
    '<header class="site-header"><a href="/">$S</a><nav><ul>$L</ul></nav></header><main><h1>$T</h1>$P</main>'
    '<footer class="site-footer"><p>&copy; $S</p></footer>',
    '<div class="cookie-banner"><p>$Q</p><button>$S</button></div><nav>$L</nav><article class="post"><h1>$T</h1>$P'
    '<div class="share">$L</div></article><section class="comments"><h2>$S</h2><div class="comment"><p>$Q</p></div>'
    '<div class="comment"><p>$Q</p></div><form><label>$S</label><button>$S</button></form></section>',
    '<div class="wrapper"><div class="navbar">$L</div><div class="post-content entry"><h2>$T</h2>$P</div>'
    '<div class="related"><h4>$S</h4><ul>$L</ul></div><div class="newsletter"><p>$Q</p></div></div>',
    '<table><tr><td class="menu">$L</td><td class="main"><h1>$T</h1>$P</td></tr></table><div class="copyright">$S</div>',
    '<body><div class="ad">$Q</div><div class="story-body"><h1>$T</h1>$P<div class="advert"><p>$Q</p></div>$P</div>'
    '<aside><h3>$S</h3><p>$Q</p></aside><footer>$S</footer></body>',
    '<nav>$L</nav><div class="notice"><p>$Q</p></div><main><article><h1>$T</h1>$P<aside class="promo"><p>$Q</p></aside>'
    '$P</article></main><div id="comments"><ol><li><p>$Q</p></li><li><p>$Q</p></li></ol></div>',
    '<ul class="breadcrumbs">$L</ul><section class="article-body"><h1>$T</h1>$P<blockquote>$B</blockquote>$P</section>'
    '<section class="widget"><h3>$S</h3><ul>$L</ul></section><form><p>$S</p><p>$Q</p></form>',
    '<div class="top"><p>$S</p></div><div class="text"><h1>$T</h1>$P<ul>$I</ul>$P</div><div class="sponsored"><p>$Q</p>'
    '</div><div class="social">$L</div>',
    '<header><h2>$S</h2><p>$S</p></header><article><h1>$T</h1>$P</article><section id="replies"><p>$Q</p><p>$Q</p>'
    '</section><footer><ul>$L</ul><p>$Q</p></footer>',
    '<div class="popup consent"><p>$Q</p></div><div class="page"><div class="body"><h1>$T</h1>$P</div></div>'
    '<div class="disqus_thread"><div class="reply"><p>$Q</p></div></div>',
    '<h1>$T</h1>$P<nav>$L</nav><div class="footer">$S</div>',
    '<nav>$L</nav><article><header><h1>$T</h1></header>$P<aside><p>$Q</p></aside>$P<nav class="toc"><ul>$L</ul></nav>'
    '</article><footer>$S</footer>',
    '<article><h1>$T</h1>$P<aside>$Q</aside>$P<section class="comments"><h2>$S</h2><p>$Q</p><p>$Q</p></section>'
    '<form><p>$S</p></form></article>',
    '<div class="header">$S</div><article>$P<div class="ad">$Q</div>$P<footer><p>$S</p></footer></article>'
    '<aside>$Q</aside>',
    '<article><h1>$T</h1>$P<form><p>$Q</p><label>$S</label><button>$S</button></form>$P</article>',
    '<body><article><h1>$T</h1><ol>$I</ol></article></body>',
    '<body><article><h1>$T</h1>$P<div class="ad-slot">$Q</div><ul>$I</ul></article></body>',
    '<article><h1>$T</h1>$P<div class="comments-area"><p>$Q</p><p>$Q</p></div></article><nav><ul>$L</ul></nav>',
    '<header><nav><ul>$L</ul></nav></header><main><section><h2>$T</h2>$P</section><section><h2>$T</h2>$P</section></main>'
    '<footer>$S</footer>',
    '<form><div class="menu"><ul>$L</ul></div><article><h1>$T</h1>$P</article><div class="footer">$S</div></form>',
    '<body><div>$D</div></body>',
    '<html><body><div class="top">$L</div><div><div><h1>$T</h1>$D</div></div><div class="bottom">$S</div></body></html>',
]

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""")
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_LABEL = re.compile(r'\bdata-main="([01])"')
_PART = re.compile(r"[a-z]+")


class Block:
    """Text with the element path above it."""

    __slots__ = ("text", "path", "names", "linked", "label", "kind", "near")

    def __init__(self, text: str, path: list[str], names: list[str], linked: int, label: str | None,
                 kind: str = "", depth: int = 0) -> None:
        self.text, self.path, self.names, self.linked, self.label = text, path, names, linked, label
        self.kind, self.near = kind, path[depth:]


def _nearest(stack: list[tuple[str, list[str], str | None]]) -> tuple[str, int]:
    """Kind and depth of the nearest element that says what its text is: a form in an article, an article in a form."""
    for depth in range(len(stack) - 1, -1, -1):
        tag, names, _ = stack[depth]
        if tag in SIDE or any(n in SIDE_WORDS for n in names):
            return "side", depth
        if tag in MAIN:
            return "main", depth
    return "", 0


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page, in its order."""
    out: list[Block] = []
    stack: list[tuple[str, list[str], str | None]] = []
    parts: list[str] = []
    linked = hidden = links = 0

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        if text:
            label = next((x[2] for x in reversed(stack) if x[2] is not None), None)
            out.append(Block(text, [x[0] for x in stack], [n for x in stack for n in x[1]], linked, label,
                             *_nearest(stack)))
        parts.clear()
        linked = 0

    def pop(depth: int) -> None:
        nonlocal hidden, links
        if any(x[0] in BLOCK for x in stack[depth:]):
            close()
        for name, _, _ in stack[depth:]:
            hidden -= name in HIDDEN
            links -= name == "a"
        del stack[depth:]

    def say(raw: str) -> None:
        nonlocal linked
        if hidden and stack[-1][0] == "head" and not raw.isspace() and raw:
            pop(len(stack) - 1)
        if raw and not hidden:
            text = entities.unescape(raw) if "&" in raw else raw
            parts.append(text)
            linked += len(text) if links else 0

    at, n = 0, len(page)
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            say(page[at:])
            break
        say(page[at:lt])
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt)
        if m is None:
            say("<")
            at = lt + 1
            continue
        at = m.end()
        k = 0 if m[2] else 3
        closing, name, attributes = m[k + 1], m[k + 2].lower(), m[k + 3]
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == name:
                    pop(depth)
                    break
            else:
                if name in BLOCK:
                    close()
            continue
        if name in ("br", "wbr"):
            parts.append(" " if name == "br" else "")
            continue
        if hidden and name not in IN_HEAD:
            above = [x[0] for x in stack]
            if "head" in above and (name == "body" or "template" not in above):
                pop(above.index("head"))
        if name in BLOCK:
            close()
            ends = CLOSED_BY.get(name, ())
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] in ends or (stack[depth][0] == "p" and name in OPEN_P):
                    pop(depth)
                    break
                if stack[depth][0] in SCOPE or (stack[depth][0] in BLOCK and stack[depth][0] != "p" and not ends):
                    break
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        names: list[str] = []
        label = None
        if attributes:
            for found in _NAMES.findall(attributes):
                names += _PART.findall("".join(found).lower())
            mark = _LABEL.search(attributes)
            label = mark[1] if mark else None
        if name in RAW:
            end = re.compile(f"</{name}", re.I).search(page, at)
            if end is None and any(x[0] == "head" for x in stack):
                end = re.compile("</head|<body", re.I).search(page, at)
            at = n if end is None else end.start()
        stack.append((name, names, label))
        hidden += name in HIDDEN
        links += name == "a"
    pop(0)
    close()
    return out


def _bucket(x: float) -> int:
    return int(math.log2(x + 1))


def features(found: list[Block]) -> list[list[str]]:
    """Names of the features that hold, by block."""
    out = []
    n = len(found)
    for i, b in enumerate(found):
        size = len(b.text)
        words = b.text.count(" ") + 1
        f = {f"in:{t}" for t in b.near if t not in ("html", "body")} | {f"named:{w}" for w in b.names}
        f |= {f"leaf:{b.path[-1] if b.path else ''}", f"chars:{_bucket(size)}", f"words:{_bucket(words)}",
              f"linked:{int(4 * b.linked / size)}", f"stops:{_bucket(b.text.count('.') + b.text.count(','))}",
              f"place:{int(4 * i / n)}", f"nearest:{b.kind}", "bias"}
        if b.text[-1] in ".!?;:":
            f.add("ends")
        if "©" in b.text:
            f.add("copyright")
        if b.kind == "main" and (any(w in SIDE_WORDS for w in b.names) or any(t in SIDE for t in b.path)):
            f.add("main in side")
        out.append(sorted(f))
    return out


class Field:
    """Weights of main text against the rest by feature, and transitions."""

    def __init__(self, pages: list[tuple[list[list[str]], np.ndarray]], steps: int = 100, rate: float = 0.5,
                 decay: float = 0.002) -> None:
        self.index: dict[str, int] = {}
        known = []
        for feats, labels in pages:
            known.append(([np.array([self.index.setdefault(x, len(self.index)) for x in f]) for f in feats], labels))
        self.weights = np.zeros(len(self.index))
        self.moves = np.zeros((2, 2))
        sums = [np.zeros_like(self.weights), np.zeros_like(self.moves)]
        total = sum(len(y) for _, y in known) or 1
        for _ in range(steps):
            gradient = [-decay * self.weights, -decay * self.moves]
            for feats, labels in known:
                node, edge = self._expect(np.array([self.weights[f].sum() for f in feats]))
                for f, error in zip(feats, (labels - node) * 50 / total):
                    gradient[0][f] += error
                seen = np.zeros((2, 2))
                np.add.at(seen, (labels[:-1], labels[1:]), 1)
                gradient[1] += (seen - edge) * 50 / total
            for value, g, s in zip((self.weights, self.moves), gradient, sums):
                s += g * g
                value += rate * g / (np.sqrt(s) + 1e-6)
        self.table = dict(zip(self.index, self.weights.tolist()))

    def _expect(self, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chance of label 1 by block and expected transitions (forward and backward sums)."""
        n = len(score)
        own = np.exp(np.clip(np.column_stack([np.zeros(n), score]), -30, 30))
        move = np.exp(self.moves)
        ahead, back = np.empty((n, 2)), np.ones((n, 2))
        ahead[0] = own[0] / own[0].sum()
        for t in range(1, n):
            ahead[t] = (ahead[t - 1] @ move) * own[t]
            ahead[t] /= ahead[t].sum()
        for t in range(n - 2, -1, -1):
            back[t] = move @ (own[t + 1] * back[t + 1])
            back[t] /= back[t].sum()
        both = ahead * back
        both /= both.sum(1, keepdims=True)
        edge = np.zeros((2, 2))
        for t in range(n - 1):
            pair = ahead[t][:, None] * move * (own[t + 1] * back[t + 1])[None, :]
            edge += pair / pair.sum()
        return both[:, 1], edge

    def labels(self, found: list[Block]) -> list[int]:
        """The likeliest labelling of a page's blocks (Viterbi)."""
        (a, b), (c, d) = self.moves.tolist()
        get = self.table.get
        off, on, came = 0.0, 0.0, []
        for i, f in enumerate(features(found)):
            score = sum([get(x, 0.0) for x in f])
            if i == 0:
                on = score
                continue
            came.append((0 if off + a >= on + c else 1, 0 if off + b >= on + d else 1))
            off, on = max(off + a, on + c), max(off + b, on + d) + score
        label = 1 if on > off else 0
        out = [label] if found else []
        for to in reversed(came):
            label = to[label]
            out.append(label)
        return out[::-1]

    def extract(self, page: str | None) -> str:
        found = blocks(page) if page else []
        return "\n".join(b.text for b, keep in zip(found, self.labels(found)) if keep)


def _by_elements(found: list[Block]) -> np.ndarray:
    """Labels of a page that has the elements made for the purpose."""
    return np.array([int(any(t in MAIN for t in b.path) and not any(t in SIDE for t in b.path)
                         and not any(w in SIDE_WORDS for w in b.names)) for b in found], dtype=np.int64)


def labelled_pages(pages: list[str]) -> list[tuple[list[list[str]], np.ndarray]]:
    """Features and labels of the pages themselves and of their texts in the layouts."""
    out = []
    texts: list[tuple[str, list[str]]] = []
    others: list[str] = []
    for page in pages:
        found = blocks(page)
        labels = _by_elements(found)
        if labels.any():
            out.append((features(found), labels))
            main = [b.text for b, y in zip(found, labels) if y]
            texts.append((main[0], main[1:] or main))
            others += [b.text for b, y in zip(found, labels) if not y]
    texts = texts or [("A plain title", ["This is a plain paragraph, of some length. It has two sentences."] * 4)]
    others = others or ["Home", "About us", "Contact", "All rights reserved."]
    for k in range(8 * len(LAYOUTS)):
        title, paragraphs = texts[k % len(texts)]
        foreign = texts[(k * 7 + 3) % len(texts)][1]

        def text(x: str) -> str:
            return entities.escape(x)

        def other(i: int) -> str:
            return text(others[(k * 5 + i) % len(others)][:80])

        links = "".join(f'<li><a href="/">{other(i)}</a></li>' for i in range(4))
        size = 1 + k // len(LAYOUTS) % 4
        body = "".join(f'<p data-main="1">{text(p)}</p>' for p in paragraphs[:size])
        fill = {"$T": f'<span data-main="1">{text(title)}</span>', "$P": body, "$L": links, "$S": other(9),
                "$Q": text(foreign[k % len(foreign)]), "$B": f'<p data-main="1">{text(paragraphs[-1])}</p>',
                "$I": "".join(f'<li data-main="1">{text(p[:90])}</li>' for p in paragraphs[:3]),
                "$D": "".join(f'<div data-main="1">{text(p)}</div>' for p in paragraphs[:size])}
        page = re.sub(r"\$[TPLSQBID]", lambda m: fill[m[0]], LAYOUTS[k % len(LAYOUTS)])
        page = page.replace('<h1><span data-main="1">', '<h1 data-main="1"><span>')
        page = page.replace('<h2><span data-main="1">', '<h2 data-main="1"><span>')
        found = blocks(page)
        out.append((features(found), np.array([int(b.label == "1") for b in found], dtype=np.int64)))
    return out


def fit(pages: DataFrame, rows: int = FIT_PAGES) -> Field:
    """A field from at most ``rows`` pages, those with the smallest hashes.

    The hashes are ranked first, so that tasks send no pages but the chosen ones.
    """
    fit_for = pages.select(F.xxhash64("page_id", "url").alias("rank"), "html").filter(
        F.length("html").between(1, FIT_CHARS))
    last = fit_for.select("rank").orderBy("rank").limit(rows).agg(F.max("rank")).head()[0]
    sample = fit_for.filter(F.col("rank") <= F.lit(last)).orderBy("rank", "html").limit(rows).collect()
    return Field(labelled_pages([r["html"] for r in sample]))


def extract_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """(page_id, url, text) of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(field or fit(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            texts = [shared.value.extract(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"),
                                              "text": pa.array(texts, pa.string())})

    kinds = [f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    return pages.select("page_id", "url", "html").mapInArrow(run, ", ".join([*kinds, "text string"]))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    return extract_text(pages).withColumn("n_chars", F.length("text").cast("long"))
