"""HTML extraction: pages of known texts in random markup, and pages that would cost much."""

import html as entities
import random
import time

import pytest
from pyspark.sql import functions as F

from tessera.llm import html

SIDE = ['<nav><a href="/x">menu it\'s</a></nav>', "<div class=ad>buy <b>now</b></div>", "<aside>aside</aside>", "<script>var t='</p><p>no';</script>", "<style>p{}</style>", '<form><input value="a>b">form</form>', "<!-- <p>no</p> -->", "<!-->", "<section class='reader-comments'><p>a comment<p>another</section>", '<p hidden>unseen</p>', "<div style='display: none'>unseen</div>", "<div role=search>find</div>", "<ul class=share-buttons><li>share</ul>", "<svg><text>s</text></svg>", "<p class=ad>ad that is never closed"]
ATTRS = ["", " class=lead", ' title="a > b"', " title=it's", " title='\"'", " data-x", " =odd", " a=/b/ c", ' class="share-price"', " class='header'", ' title="the hidden valley"', " class=ad-free-edition", "\n id = x7"]


def _page(rng):
    """(html, text) of an article: blocks of words in random markup, with side matter between them."""
    out, want = [], []
    for _ in range(rng.randint(1, 8)):
        words = [rng.choice(["plain", "a<b", "x&y", "q\"q", "it's", "é", "1 < 2", "&lt;", " "]) for _ in range(rng.randint(1, 9))]
        tag = rng.choice(["p", "h2", "li", "blockquote", "div", "figcaption"])
        pieces = []
        for w in words:
            e = entities.escape(w) if rng.random() < 0.7 else w.replace("&", "&amp;").replace("<", "&#60;")
            shape = rng.choice(["{}", "<b>{}</b>", "<span class=comment>{}</span>", "<em{a}>{}</em>", "{}<!-- x -->", "<i>{}", "<a href=/q?a=1&b='>{}</a>"])
            pieces.append(shape.replace("{a}", rng.choice(ATTRS)).replace("{}", e))
        gap = rng.choice([" ", "\n\t ", "&nbsp;"])
        closed = tag not in ("p", "li") or rng.random() < 0.5
        out.append(f"<{tag}{rng.choice(ATTRS)}>{gap.join(pieces)}{f'</{tag}>' if closed else ''}")
        if text := " ".join(" ".join(words).split()):
            want.append(text)
        if rng.random() < 0.5:
            out.append(rng.choice(SIDE[:-1]) if not closed or rng.random() < 0.8 else SIDE[-1])
    article = "".join(out)
    shell = rng.choice(["<html><head><title>t</title></head><body><div class=header>top</div><article{a}>{x}</article><footer>f</footer></body></html>", "<body><div id=wrap><nav>n</nav><main>{x}</main><div class=sidebar>s</div></div>", "<article>{x}"])
    return shell.replace("{a}", rng.choice(ATTRS[:5])).replace("{x}", article), "\n".join(want)


def test_random_pages_of_known_texts(spark):
    rng = random.Random(4)
    pages = [_page(rng) for _ in range(1500)]
    for page, want in pages:
        assert html.Page(page).text(None) == want, page
    rows = [(k, f"http://h{k % 7}.example/", page) for k, (page, _) in enumerate(pages[:200])]
    table = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")).withColumn("path", F.lit(1)).withColumn("n", F.lit("x"))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in html.extract(table).collect()}
    assert got == {k: (want, len(want)) for k, (_, want) in enumerate(pages[:200])}


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<article><p title=it's>one two three</p><p>four five</p><p>don't stop</p></article>", "one two three\nfour five\ndon't stop"),
        ('<article><div class="share-price">Shares rose.</div><p class="header">kk</p></article>', "Shares rose.\nkk"),
        ("<article><p>a <code><span class='comment'># b</span></code></p><div class='ad-slot'>x</div></article>", "a # b"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
        ("<article><p>a</p><p>b <a href=", "a\nb"),
        ('<article><p>a</p><p class="x>b</p></article>', "a\nb"),
        ("<article>a <![CDATA[<b> & c]]> d<? pi ?></ x></article>", "a <b> & c d"),
        ("<article>1 <2 </article>", "1 <2"),
        ('<body class="single-post"><header>site<h2>name</h2></header><div class="sidebar-weather">rain</div><article><p>a</p></article></body>', "a"),
    ],
)
def test_pages(page, want):
    assert html.Page(page).text(None) == want


N = 2_000_000


@pytest.mark.parametrize(
    "page",
    ["<div class='abc'>" * (N // 17), "<a " * (N // 3), "<div>" * (N // 10) + "</section>" * (N // 20), "<" * N, "<p class='" * (N // 10), "<!--" * (N // 4), "<![CDATA[" * (N // 9), "&" * N, "<p a=" + "b " * (N // 2), "<article><p class=ad>" * (N // 21), "<script>" * (N // 8), '<p x="\'>' * (N // 8), "<b =" * (N // 4)],
)
def test_cost_is_in_proportion(page):
    start = time.process_time()
    html.Page(page).text(None)
    assert time.process_time() - start < 8


def test_hosts_beyond_the_broadcast_give_the_same(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(k, f"http://{'big' if k % 3 == 0 else f'h{k % 40}'}.example/{k}", _page(rng)[0]) for k in range(300)] + [(900, "http://" + "x" * 400 + "/", "<p>a"), (901, None, None), (None, "http://big.example", "<p>b")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    want = sorted(map(repr, html.extract(pages).collect()))
    monkeypatch.setattr(html, "MAX_BROADCAST", 3)
    monkeypatch.setattr(html, "LARGE", 6)
    assert sorted(map(repr, html.extract(pages).collect())) == want
