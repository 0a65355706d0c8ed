import random

import pytest
from pyspark.sql import functions as F

from refillcast.llm.html import extract, host_paths, main_text, parse

SCHEMA = "page_id long, url string, html string"
LONG = "A sentence of the article that is long enough, with commas, to count as prose. "


def page(body, head="<title>T</title><style>p{}</style>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


@pytest.mark.parametrize("source, want", [
    (page("<nav><a href=/>Menu</a></nav><article><h1>Head</h1><p>One&amp;two &lt;b&gt;\n  x&nbsp;y<p>Three <b>bold</b>.</article><footer>F</footer>"),
     "Head\n\nOne&two <b> x y\n\nThree bold."),
    (page(f"<div class='cookie-notice'>We use cookies</div><div class=content><p>{LONG}</p><div class='ad-slot'>Buy</div><p>{LONG}</p></div><div id=comments><p>First!</p></div>"),
     f"{LONG.strip()}\n\n{LONG.strip()}"),
    (page(f"<header><h2>Site</h2></header><article><header><h1>Own head</h1></header><p>{LONG}</p><aside>Side</aside><form>Mail<input></form></article>"),
     f"Own head\n\n{LONG.strip()}"),
    (page("<article><p>a<script>var t='</p>';</script>b<!-- c --><br>d</article>"), "ab d"),
    (page("<article><ul><li>one<li>two</ul><table><tr><td>x<td>y</table></article>"), "one\n\ntwo\n\nx\n\ny"),
    (page(f"<div class='content-sidebar-wrap'><p>{LONG}</p><div class='sidebar'><p>Aside words</p></div></div>"), LONG.strip()),
    (page(f"<div id='page' class='has-sidebar'><p>{LONG}</p></div>"), LONG.strip()),
    (page(f"<div class='no-sidebar'><main><p>{LONG}</p></main></div>"), LONG.strip()),
    (page(f"<form id='aspnetForm'><div class='content'><p>{LONG}</p></div></form>"), LONG.strip()),
    (page("<article><p>First part <span class='ad'>Buy</span> second part</p></article>"), "First part second part"),
    (page("<article><p>Chart <svg><text>x</text></svg> shows <button>Go</button>it.</p></article>"), "Chart shows it."),
    (page("<article><p>See <a class='related'>this</a> and go on</p><p><a class='share' href=x>Share this</a></p></article>"), "See this and go on"),
    (page("<article><p>Let <math><mi>x</mi></math> be</p><section id='discussion'><p>We discuss</p></section><div class='alert'>Beware</div></article>"),
     "Let x be\n\nWe discuss\n\nBeware"),
    # Comments and notices may be longer than the article, and comments may be articles.
    (page(f"<article><p>Short one.</p></article><div id='comments'><article class='comment'><p>{LONG * 3}</p></article></div>"), "Short one."),
    (page(f"<div class='content'><p>Short one.</p></div><div class='modal cookie'><p>{LONG * 4}</p></div>"), "Short one."),
    ("just < text & more", "just < text & more"),
    ("<article><p>cut off <b>in the mid", "cut off in the mid"),
    ("<p class=\"unclosed>x</p><article>y</article>", None),
    ("", ""),
])
def test_main_text(source, want):
    got = main_text(*parse(source), None)
    assert want is None or got == want


def test_hosts_agree_on_a_path(spark):
    good = page(f"<ul class='menu'><li><a href=/>Home</a></ul><div class='box-1'><p>{LONG * 3}</p></div>")
    # This page's own best would be the teaser; the host's path is the box.
    odd = page(f"<ul class='menu'><li><a href=/>Home</a></ul><div class='box-7'><p>Short.</p></div><div class='teaser'><p>{LONG * 2}</p></div>")
    rows = [(i, f"https://User@Host.example:80/{i}", good) for i in range(5)] + [(9, "http://host.example/z", odd)]
    pages = spark.createDataFrame(rows, SCHEMA).withColumn("path", F.lit("clash")).withColumn("host", F.lit("clash"))
    winner = host_paths(pages).collect()
    assert [(r["host"], r["path"]) for r in winner] == [("host.example", "html>body>div.box-#")]
    got = {r["page_id"]: r["text"] for r in extract(pages).collect()}
    assert got[9] == "Short." and got[0] == (LONG * 3).strip()


def test_odd_rows(spark):
    deep = "<div>" * 5000 + "<p>deep text" + "</div>" * 5000
    rows = [(1, None, None), (2, "", ""), (None, "no host", "<p>x</p>"), (3, "http://a/", deep), (4, "http://a/", page("<nav>only a menu</nav>")),
            (5, "http://b/", page(f"<article><p>{'long ' * 60000}</p></article>")), (5, "http://b/", page("<article><p>again</p></article>"))]
    got = [(r["page_id"], r["text"], r["n_chars"]) for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(rows) and all(len(t) == n for _, t, n in got)
    texts = {}
    for i, t, _ in got:
        texts.setdefault(i, set()).add(t)
    assert texts[1] == {""} and texts[2] == {""} and texts[None] == {"x"} and texts[3] == {"deep text"}
    assert texts[5] == {("long " * 60000).strip(), "again"}


def test_empty_table(spark):
    assert extract(spark.createDataFrame([], SCHEMA)).collect() == []


def generated(rng):
    """A page and its article's blocks, both made from one outline."""
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "d&eacute;lta", "x &lt; y", "end."]) for _ in range(n))
    blocks, body = [], []
    for _ in range(rng.randint(2, 8)):
        text = words(rng.randint(12, 40))
        plain = text.replace("&eacute;", "\u00e9").replace("&lt;", "<")
        kind = rng.randrange(6)
        if kind == 0:
            body.append(f"<p>{text} <span class='ad-slot'>Buy now</span> tail</p>")
            plain += " tail"
        elif kind == 1:
            body.append(f"<ul><li>{text}<li>second</ul>")
            blocks.append(plain)
            plain = "second"
        elif kind == 2:
            body.append(f"<h2>{text}</h2>")
        elif kind == 3:
            body.append(f"<p>{text}<script>p('</div>')</script><br>\n after</p>")
            plain += " after"
        elif kind == 4:
            body.append(f"<div class='{rng.choice(['ad', 'newsletter', 'share-bar'])}'>Noise words</div><p>{text}</p>")
        else:
            body.append(f"<p>{text}")
        blocks.append(plain)
    inner = "".join(body)
    inner = rng.choice([f"<article>{inner}</article>", f"<main>{inner}</main>", f"<div class='post-{rng.randint(1, 9)}'>{inner}</div>"])
    inner += rng.choice(["", "<aside>Other reading</aside>", "<div class='sidebar'><p>Side words here</p></div>"])
    for wrapper in rng.sample(["<div class='has-sidebar'>", "<div class='content-sidebar-wrap'>", "<div id='site'>"], rng.randint(0, 2)):
        inner = f"{wrapper}{inner}</div>"
    comments = f"<section id='comments'><p>{words(rng.randint(5, 150))}</p></section>" if rng.random() < 0.6 else ""
    return page(f"<header><h1>Site</h1></header><nav><a href=/>Home</a></nav>{inner}{comments}<footer>Imprint</footer>"), "\n\n".join(blocks)


def test_generated_pages():
    rng = random.Random(11)
    for _ in range(400):
        source, want = generated(rng)
        assert main_text(*parse(source), None) == want, source


def test_query_reads_whole_pages(spark):
    """Generated pages of some hosts through the whole operator."""
    rng = random.Random(12)
    made = [generated(rng) for _ in range(120)]
    rows = [(i, f"http://h{i % 7}.example/{i}", source) for i, (source, _) in enumerate(made)]
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: (want, len(want)) for i, (_, want) in enumerate(made)}
