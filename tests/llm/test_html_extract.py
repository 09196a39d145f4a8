import random

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import html_extract as H
from tessera.llm.url_filters import host_of
from tests.llm import plain_html

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>x";</script></head><body>
<nav><ul><li><a href="/">Home</a></li></ul></nav><!-- note --><div class="ad">Buy</div><header>Site</header>
<article><header><h1>Head &amp; line</h1></header><p>One  two&nbsp;<b>three</b>.<p>Four&lt;five<br>six<p>Open</article>
<aside>Side</aside><form><label>Mail</label><input value=x></form><div id="comments"><p>Nice!</p></div>
<footer>&copy; us</footer></body></html>"""


def kept(page):
    return H.main_texts([page])[0]


def test_article():
    assert kept(PAGE) == "Head & line\nOne two three.\nFour<five\nsix\nOpen"


def test_odd_markup():
    assert kept(None) == kept("") == kept("<p></p>") == kept("<script>alert(1)") == ""
    assert kept("plain &lt;b&gt; text") == "plain <b> text"
    assert kept("<article><p>a<p>b</article") == "a\nb"
    assert kept("<article><p>cut in the mid <b") == "cut in the mid"
    assert kept('<article><p title="a > b">x</p><article class="comment">no</article></article>') == "x"
    assert kept("<div class='page sidebar-left'><main><p>In a layout</p></main></div>") == "In a layout"
    assert kept("<div><p>Body " + "word " * 9 + "</p><p><a href=x>all link</a></p></div>").startswith("Body word")
    assert kept("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"


def test_pages_per_run_against_brute_force():
    rng = np.random.default_rng(3)
    tokens, page = rng.integers(0, 3, 400), np.sort(rng.integers(0, 12, 400))
    got = H.pages_per_run(tokens, page, 4)
    for i in range(400):
        gram = tokens[i:i + 4].tolist()
        if i > 396 or page[i] != page[i + 3]:
            assert got[i] == 0
            continue
        assert got[i] == len({int(page[j]) for j in range(397) if page[j] == page[j + 3] and tokens[j:j + 4].tolist() == gram})


def test_suffix_order():
    tokens = np.array([1, 0, 1, 0, 1, 2])
    order, rank = H.suffix_order(tokens, 6)
    assert order.tolist() == sorted(range(6), key=lambda i: tokens[i:].tolist())
    assert H.suffix_order(tokens, 2)[1][[0, 2]].tolist() == [1, 1]


def test_template_of_a_host_goes():
    menu = "<div>Start here or look at all of our other pages today</div>"
    body = ["no %d is the only page with %d such words %d" % (i, i * 7, i * 3) for i in range(10)]
    pages = [f"<body>{menu}<div>{b}</div></body>" for b in body]
    assert H.main_texts(pages) == body
    inside = [f"<article><p>{b}</p><p>Share this article with all of your friends now please</p></article>" for b in body]
    assert H.main_texts(inside) == body
    assert H.main_texts(inside[:3])[0].endswith("please")       # too few pages to tell


def test_pages(spark):
    rows = [(1, "http://h.com/1", PAGE), (1, "http://h.com/1", PAGE), (2, None, PAGE), (3, "http://h.com/3", None),
            (None, "http://g.com", "<p>x</p>")]
    pages = spark.createDataFrame([(*r, "a") for r in rows], "page_id long, url string, html string, host string")
    got = sorted(((r.page_id or 0), r.url or "", r.text, r.n_chars) for r in H.extract(pages, host_of(F.col("url"))).collect())
    assert got == sorted(((r[0] or 0), r[1] or "", kept(r[2]), len(kept(r[2]))) for r in rows)
    assert H.extract(pages.limit(0), host_of(F.col("url"))).count() == 0


def test_large_hosts_are_cut_into_shards(spark, monkeypatch):
    monkeypatch.setattr(H, "SHARD_PAGES", 4)
    pages = spark.createDataFrame([(i, f"http://h.com/{i}", f"<article><p>text {i}</p></article>") for i in range(40)],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.text for r in H.extract(pages, host_of(F.col("url"))).collect()}
    assert got == {i: f"text {i}" for i in range(40)}


def test_copies_of_a_page_are_one_page(spark):
    """Rows that repeat a page, and a host that is nearly all copies, keep their text."""
    text = "the only story that this host has ever told to any of its readers"
    for n in (8, 200):
        for page in (f"<article><p>{text}</p></article>", f"<div>{text}</div>"):
            assert H.main_texts([page] * n) == [text] * n
    others = [f"<div>story {i} is " + " ".join(f"w{i}x{k}" for k in range(12)) + "</div>" for i in range(3)]
    rows = ([(1, "http://a.com/1", f"<article><p>{text}</p></article>")] * 200 + [(2, "http://b.com/2", f"<div>{text}</div>")] * 8
            + [(k, f"http://c.com/{k}", f"<div>{text}</div>") for k in range(10, 50)]
            + [(k, f"http://c.com/{k}", page) for k, page in enumerate(others)])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = sorted((r.page_id, r.url, r.text, r.n_chars) for r in H.extract(pages, host_of(F.col("url"))).collect())
    plain = [H.blocks(r[2])[0][1] for r in rows]
    assert got == sorted((r[0], r[1], t, len(t)) for r, t in zip(rows, plain))


def test_runs_are_counted_over_the_whole_host(spark, monkeypatch):
    """However a host is cut, each page has the text that it has in one piece."""
    menu = "Start here or look at all of our other pages today"
    notice = "This section is kept by volunteers who would like your help"         # on a share of the pages at the limit
    rare = "Only a few of the pages carry this long remark at all"
    rows = []
    for i in range(60):
        body = " ".join(f"w{i}x{k}" for k in range(5 + i % 7))
        extra = (notice if i < 12 else "") + "</div><div>" + (rare if i >= 50 else "")
        rows.append((i, f"http://h.com/{i}", f"<div>{menu}</div><div>{extra}</div><div>{body}</div>"))
    for i in range(60, 90):         # another host, with articles
        rows.append((i, f"http://g.com/{i}", f"<article><p>{menu}</p><p>{rare if i < 80 else notice}</p><p>no {i}</p></article>"))
    want = {}
    for host in ("h", "g"):
        part = [r for r in rows if r[1].startswith(f"http://{host}")]
        want.update(zip([r[0] for r in part], H.main_texts([r[2] for r in part])))
    assert want[0].startswith("w0x0") and rare in want[55] and want[60] == f"{rare}\nno 60"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    for shard_pages, shard_chars in ((4, 2_000_000), (16, 2_000_000), (128, 200)):
        monkeypatch.setattr(H, "SHARD_PAGES", shard_pages)
        monkeypatch.setattr(H, "SHARD_CHARS", shard_chars)
        got = {r.page_id: r.text for r in H.extract(pages, host_of(F.col("url"))).collect()}
        assert got == want


def test_names_inside_an_article():
    """What an id or a heading is about is no part of the page; a part named by a whole class is."""
    body = "one two three four five"
    for piece in ('<h2 id="related-work">{}</h2>', '<section id="search-algorithms"><p>{}</p></section>', '<p class="notice">{}</p>',
                  '<p class="social">{}</p>', '<ul class="menu"><li>{}</li></ul>', '<div class="comments-on-the-war">{}</div>',
                  '<p><math><mi>{}</mi></math></p>', '<object data="x">{}</object>'):
        assert kept(f"<article><p>start</p>{piece.format(body)}</article>") == f"start\n{body}"
    for piece in ('<div class="comments">{}</div>', '<section id="comments"><p>{}</p></section>', '<div class="big social-share">{}</div>',
                  '<div class="cookie-notice">{}</div>', '<div role="search">{}</div>', '<aside>{}</aside>'):
        assert kept(f"<article><p>start</p>{piece.format(body)}</article>") == "start"
    assert kept(f'<div id="comments-on-the-war">{body}</div>') == body
    assert kept(f'<p>start</p><div id="comments">{body}</div>') == "start"


def test_a_teaser_beside_the_body():
    """The suffix array decides which open text beside a short article is the page's own."""
    strip = "these words are printed on each and every page of this host"
    pages = [f"<article><p>teaser {i}</p></article><div>{strip}</div><div>" + " ".join(f"w{i}x{k}" for k in range(40)) + "</div>"
             for i in range(9)]
    got = H.main_texts(pages)
    assert got == [f"teaser {i}\n" + " ".join(f"w{i}x{k}" for k in range(40)) for i in range(9)] == plain_html.texts(pages)
    long = [p.replace("teaser", "teaser " + "long " * 80) for p in pages]
    assert all("w" not in t for t in H.main_texts(long))


def test_against_a_plain_extractor(spark):
    """All pages of a given table, and hosts with templates of every kind, by an extractor that shares no code."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    rng = random.Random(8)
    made = []
    for k in range(60):
        own = [" ".join(f"v{rng.randint(0, 400)}" for _ in range(rng.randint(1, 25))) for _ in range(4)]
        strip = "read more of our pages on this and many other things of note here"
        parts = [f"<p>{own[0]} &amp; <b>{own[1]}</b></p>", f"<div>{strip if k % 3 else own[2]} {own[3]}</div>",
                 f"<nav><a href=x>{own[2]}</a></nav>", f'<div class="ad">{own[0]}</div>', f"<table><tr><td>{own[1]}</td><td>x</td></tr></table>"]
        rng.shuffle(parts)
        inner = "".join(parts[:2])
        page = "".join(parts[2:]) + (f"<article><header><h1>T {k}</h1></header>{inner}</article>" if k % 4 else inner) + "<footer>f</footer>"
        made.append((10 ** 6 + k, f"http://made{k % 2}.com/{k}", f"<html><head><title>t</title></head><body>{page}</body></html>"))
    made += [made[5], made[5]]
    every = [tuple(r) for r in rows] + made
    frame = spark.createDataFrame(every, "page_id long, url string, html string").repartition(4)
    hosts = {}
    for i, u, h in every:
        hosts.setdefault((u or "//").split("/")[2], []).append((i, h))
    want = {}
    for of in hosts.values():
        want.update(zip([i for i, _ in of], plain_html.texts([h for _, h in of])))
    got = H.extract(frame, host_of(F.col("url"))).collect()
    assert len(got) == len(every)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text), r.page_id
