import html
import itertools
import random
import re

import numpy as np
from llm_helpers import importable

from weekwise.llm import html_crf

SF = "/root/testdata/sf0.01"
LONG = "Lorem ipsum dolor sit amet, consectetur adipiscing elit. Ut enim ad minim veniam, quis nostrud exercitation."


def article(page):
    inner = page[page.index("<article>") + 9:page.index("</article>")]
    parts = re.split(r"<(?:/?p|/?h1)>", re.sub(r"</?b>", "", inner).replace("<br>", " "))
    return "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)


def test_all_pages(spark):
    pages = importable(spark).read.parquet(f"{SF}/pages.parquet")
    source = {r.page_id: r.html for r in pages.collect()}
    for r in html_crf.main_text(pages).collect():
        assert r.text == article(source[r.page_id]) and r.n_chars == len(r.text)


def test_blocks():
    def texts(page):
        return [b.text for b in html_crf.blocks(page)]

    assert texts("<p>a &amp; b<p>c<br>d  e f") == ["a & b", "c d e f"]
    assert texts("<script>var t='</p>x'</script><style>p{}</style><!-- no --><title>t</title>x<b>y</b>z") == ["xyz"]
    assert texts("<ul><li>a<li>b<ul><li>c</ul></ul>d") == ["a", "b", "c", "d"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>") == ["1", "2", "3"]
    assert texts('<a title="x > y">k</a> 1 < 2 <') == ["k 1 < 2 <"]
    assert texts("") == texts("<<<>>") [:0] or texts("<div><!-- open") == []


def test_parts_that_hide_nothing():
    def texts(page):
        return [b.text for b in html_crf.blocks(page)]

    for end in ("</head><body>", "<body>", "<BODY class=x>", "", "</head>"):
        page = f"<!doctype html><html><head><meta charset=utf-8><title>t</title><script>x</script>{end}<p>a<p>b"
        assert texts(page) == ["a", "b"], end
    assert texts("<head><title>t</title><style>p{}</style>plain <b>text</b>") == ["plain text"]
    assert texts("<head><title>t<body><p>a</p>") == ["a"]
    assert texts("<head><title>t</title><noscript><style>x<body><p>a</p>") == ["a"]
    assert texts("<head><template><div>no</div></template><title>t</title><body><p>a</p>") == ["a"]
    assert texts("<head><template><div>no</div><body><p>a</p>") == ["a"]
    assert texts("<head><title>t</title><link rel=x href=y> <meta a=b></head><p>a</p>") == ["a"]
    assert texts("<p>if <math><mi>x</mi><mo>=</mo><mn>2</mn></math> then</p>") == ["if x=2 then"]
    assert texts("<p>see <object data=x>the film</object> here</p>") == ["see the film here"]


def test_page_without_head_end(spark):
    pages = importable(spark).read.parquet(f"{SF}/pages.parquet")
    field = html_crf.fit(pages)
    for r in pages.limit(20).collect():
        cut = r.html.replace("</head>", "").replace("</HEAD>", "")
        assert cut != r.html and field.extract(cut) == article(r.html)


def test_other_layouts(spark):
    pages = importable(spark).read.parquet(f"{SF}/pages.parquet")
    field = html_crf.fit(pages)
    page = ('<body><div class="topbar"><a href=x>Home</a> <a href=y>News</a></div><div class="article__body"><h1>The '
            f'title</h1><p>{LONG}</p><p>Short.</p></div><div class="comments-area"><p>I liked this, thanks.</p></div>'
            '<div class="site-info">Copyright 2020</div></body>')
    assert field.extract(page) == f"The title\n{LONG}\nShort."
    page = (f'<nav>a b</nav><article><h1>The title</h1><p>{LONG}</p><aside>See also this.</aside><p>Short.</p><section '
            'class="comments"><h2>Comments</h2><p>A long reader comment, with words. It goes on.</p></section></article>')
    assert field.extract(page) == f"The title\n{LONG}\nShort."


def said(n):
    return (f"<p>This is a sentence of the main text, number {n}. It goes on for a while, as such texts do, "
            "and then it ends.</p>")


TWO = said(1) + said(2)
HOME = '<nav><ul><li><a href="/">Home</a></li></ul></nav>'
# page, what its text holds, what it does not hold
BY_HAND = {
    "unordered list": (f"<article><h1>Title</h1>{TWO}<ul><li>First point<li>Second point</ul>{said(3)}</article>",
                       ["Title", "First point", "Second point", "number 3"], []),
    "only a list": ("<body><article><h1>How to</h1><ol><li>First point</li><li>Second point</li></ol></article></body>",
                    ["How to", "First point", "Second point"], []),
    "form": (f"<body><article><h1>Title</h1>{TWO}<form><p>Sign up now for our newsletter, it is free.</p>"
             f"<button>Go</button></form>{said(3)}</article></body>", ["number 1", "number 3"], ["Sign up", "Go"]),
    "form at the end": (f'{HOME}<article><h1>Title</h1>{TWO}<form action="/s"><p>Sign up for the letter of the week. It '
                        "is free, and you can leave at any time you like.</p></form></article>",
                        ["number 2"], ["Sign up", "Home"]),
    "page in a form": (f'<form id="f"><div class="menu"><a href="/">Home</a></div><article><h1>Title</h1>{TWO}</article>'
                       "</form>", ["Title", "number 1"], ["Home"]),
    "advert slot": (f'<article><h1>Title</h1>{TWO}<div class="ad-slot">Buy the best shoes of the season today.</div>'
                    f"{said(3)}</article>", ["number 2", "number 3"], ["shoes"]),
    "comments area": (f'<article><h1>Title</h1>{TWO}<div class="comments-area"><p>I liked this text very much. Thank you '
                      f"for it.</p></div></article>{HOME}", ["number 2"], ["liked", "Home"]),
    "list, then comments": (f'<article><h1>Title</h1>{TWO}<ul><li>One thing</li></ul><section class="comments"><h2>Comments'
                            "</h2><ul><li><p>I read this, and I did not like it. Sorry.</p></ul></section></article>",
                            ["One thing"], ["Sorry", "Comments"]),
    "plain div": (f"<body><div><div><h1>Title</h1><div>{TWO}</div></div></div></body>", ["Title", "number 1", "number 2"], []),
    "bare text": ("<body><div>This is a sentence of the main text. It goes on for a while.</div><div>And this one follows "
                  "it, with a comma. It ends here.</div></body>", ["main text", "follows"], []),
    "table": (f"{HOME}<article><h1>Title</h1>{TWO}<table><tr><th>Year<th>Sales<tr><td>2020<td>15</table></article>"
              "<footer>Contact us</footer>", ["Year", "Sales", "2020", "15"], ["Home", "Contact"]),
    "paragraph of a link": (f'{HOME}<article><h1>Title</h1>{TWO}<p><a href="/x">See the whole report here.</a></p>'
                            "</article>", ["whole report"], ["Home"]),
    "sections": (f"<header>{HOME}</header><main><section><h2>Part one</h2>{said(1)}</section><section><h2>Part two</h2>"
                 f"{said(2)}</section></main><footer>Imprint</footer>", ["Part one", "Part two", "number 2"],
                 ["Home", "Imprint"]),
    "kinds of blocks": (f"<article><h1>Title</h1>{TWO}<h2>Second part</h2><pre>code line</pre><blockquote>Someone said this."
                        "</blockquote><figure><figcaption>A caption</figcaption></figure><dl><dt>Term<dd>Its meaning</dl>"
                        "</article>", ["Second part", "code line", "Someone", "A caption", "Term", "Its meaning"], []),
}


def test_pages_by_hand(spark):
    field = html_crf.fit(importable(spark).read.parquet(f"{SF}/pages.parquet"))
    for name, (page, inside, outside) in BY_HAND.items():
        text = field.extract(page)
        assert [x for x in inside if x not in text] == [] and [x for x in outside if x in text] == [], name


def test_viterbi_is_the_best_labelling():
    r = random.Random(1)
    field = html_crf.Field.__new__(html_crf.Field)
    field.moves = np.array([[0.3, -0.4], [-0.2, 0.5]])
    names = ["in:p", "in:div", "leaf:p", "ends", "words:1", "words:2", "place:0", "place:1"]
    field.table = {n: r.uniform(-1, 1) for n in names}
    for _ in range(30):
        found = [html_crf.Block(r.choice(["a b.", "word", "x y z"]), r.sample(["p", "div"], r.randint(0, 2)), [], 0, None)
                 for _ in range(r.randint(1, 6))]
        scores = [sum(field.table.get(x, 0) for x in f) for f in html_crf.features(found)]

        def value(y):
            return (sum(s for s, k in zip(scores, y) if k)
                    + sum(field.moves[a, b] for a, b in zip(y[:-1], y[1:])))

        best = max(itertools.product((0, 1), repeat=len(found)), key=value)
        assert abs(value(field.labels(found)) - value(best)) < 1e-9


def test_edges(spark):
    kind = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, None, None, "x", "y"), (2, "u", "", "x", "y"), (None, "u", "<p></p>", "x", "y"), (4, "u", "<b>", None, None)]
    out = html_crf.main_text(importable(spark).createDataFrame(rows, kind)).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in out) == [(k, "", 0) for k in ("1", "2", "4", "None")]
    assert html_crf.main_text(spark.createDataFrame([], kind)).collect() == []
    long = "<article><p>" + "word " * 200_000 + "</article>"
    assert html_crf.main_text(spark.createDataFrame([(1, "u", long, "", "")], kind)).collect()[0].n_chars == 999_999
