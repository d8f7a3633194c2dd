"""Main text of pages whose articles are known, and of the given pages."""

import html
import random
import re

import pytest

from modelwatch.llm import main_text

FIELDS = "page_id bigint, url string, html string, site string, template int, text string, hash int, content string"
WORDS = "river stone & light < over > walk far \" quiet ' été 漢字 of the and".split()


def prose(rng, n=12):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(rng.randrange(2, n)))


def texts(spark, pages, **limits):
    rows = spark.createDataFrame([(i, u, h, "s", 1, "t", 2, "c") for i, u, h in pages], FIELDS).repartition(4)
    got = main_text.extract(rows, **limits).collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return sorted(((r["page_id"], r["text"]) for r in got), key=str)


def article(rng):
    """Known blocks of an article, and its markup with elements that are no text."""
    blocks = [prose(rng) for _ in range(rng.randrange(1, 6))]
    e = [html.escape(b) for b in blocks]
    extra = [
        "<script>var p = '<p>no</p>';</script>", "<style>p{}</style>", "<aside><p>Aside</p></aside>", "<!-- <p>old</p> -->",
        '<div class="ad-box">Buy this</div>', '<form><p>Name</p><input name=a></form>', '<ul role="navigation"><li>x</ul>',
        '<section id="comments"><article><p>I think so too</p></article></section>', "<div class='newsletter-signup'>Subscribe</div>",
    ]
    body = f"<header><h1>{e[0]}</h1></header>"
    for b in e[1:]:
        body += rng.choice(extra) + rng.choice([f"<p>{b}</p>", f"<p>{b}", f"<ul><li>{b}</ul>", f"<div><b>{b}</b></div>", f"<p>{b.replace(' ', '<br>' + chr(10), 1)}</p>"])
    return blocks, body


def test_articles(spark):
    rng = random.Random(1)
    pages, truth = [], []
    for i in range(120):
        blocks, body = article(rng)
        wrap = rng.choice(["<article>{}</article>", "<main><div class=post>{}</div></main>", '<div class="layout with-sidebar"><article class="entry">{}</article></div>'])
        page = f"<!doctype html><html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><header>Site</header>{wrap.format(body)}<div class=sidebar>Side {i}</div><footer>&copy; us"
        pages.append((i, f"http://host{i % 3}.example.com/{i}", page))
        truth.append((i, "\n\n".join(blocks)))
    assert texts(spark, pages) == sorted(truth, key=str)


def soup(rng, i, menu, foot):
    """A page without an article: only recurrence tells the site's parts."""
    blocks = [prose(rng, 20) for _ in range(3)]
    body = "".join(f"<div class=x><p>{html.escape(b)}</p></div>" for b in blocks)
    return blocks, f"<html><body><div class=a><ul>{menu}</ul></div>{body}<div class=z><span>{foot}</span></div></body></html>"


@pytest.mark.parametrize("broadcast_rows", [100_000, 0])
def test_templates(spark, broadcast_rows):
    rng = random.Random(2)
    pages, truth = [], []
    for i in range(200):
        host = ["a.example.com", "b.example.com", "few.example.com"][0 if i < 120 else 1 if i < 197 else 2]
        blocks, page = soup(rng, i, f"<li>Home<li>About {host}<li>News", f"All rights with {host}")
        if host.startswith("few"):  # too few pages for a template
            blocks = ["Home", f"About {host}", "News", *blocks, f"All rights with {host}"]
        pages.append((i, f"https://{host.upper() if i % 2 else host}/p?{i}", page))
        truth.append((i, "\n\n".join(blocks)))
    pages += [(300 + i, "https://a.example.com/copy", pages[0][2]) for i in range(90)]  # copies of one page
    truth += [(300 + i, truth[0][1]) for i in range(90)]
    assert texts(spark, pages, broadcast_rows=broadcast_rows) == sorted(truth, key=str)


def test_repeated_articles_stay(spark):
    """An article's passages stay though a third of the pages, and copies on hosts of their own, repeat them."""
    rng = random.Random(3)
    shared = prose(rng, 30)
    pages, truth = [], []
    for i in range(150):
        blocks = [prose(rng), *([shared] if i % 3 == 0 else []), prose(rng)]
        pages.append((i, "http://one.example.com/", "<article>" + "".join(f"<p>{html.escape(b)}" for b in blocks) + "</article>"))
        truth.append((i, "\n\n".join(blocks)))
    for i in range(150, 200):
        pages.append((i, "http://mirror.example.com/", pages[0][2]))
        truth.append((i, truth[0][1]))
    assert texts(spark, pages) == sorted(truth, key=str)


def test_boxes_inside_articles(spark):
    """What nearly every article of a site holds is the site's."""
    rng = random.Random(4)
    pages, truth = [], []
    for i in range(60):
        blocks = [prose(rng), prose(rng)]
        pages.append((i, "http://one.example.com/", f"<article><p>{html.escape(blocks[0])}</p><div class=k><p>Read more in our app</p></div><p>{html.escape(blocks[1])}</p></article>"))
        truth.append((i, "\n\n".join(blocks)))
    assert texts(spark, pages) == sorted(truth, key=str)


def test_odd_pages(spark):
    long = " ".join(f"word{i}" for i in range(200_000))
    pages = [
        (1, None, None), (2, "", ""), (3, "no host", "plain &amp; text"), (None, "http://h/", "<p>a<p>b&nbsp; c"), (5, "http:///x", "a < b <c"),
        (6, "http://h/", "<div>" * 4000 + "deep"), (7, "http://h/", "<" * 20_000), (8, "http://h/", f"<p>{long}</p>"), (8, "http://h/", f"<p>{long}</p>"),
        (9, "http://h/", "x<script>if (a<b) '</p>'"), (10, "http://h/", "<p title='a>b'>c</p><!-- open"), (11, "http://h/", "<table><tr><td>1<td>2</table>"),
    ]
    want = [(1, ""), (2, ""), (3, "plain & text"), (None, "a\n\nb c"), (5, "a < b"), (6, "deep"), (7, "<" * 20_000), (8, long), (8, long), (9, "x"), (10, "c"), (11, "1\n\n2")]
    assert texts(spark, pages) == sorted(want, key=str)
    assert texts(spark, [(1, "http://h/", "")]) == [(1, "")] and main_text.extract(spark.createDataFrame([], FIELDS)).collect() == []


def test_given_pages(spark):
    """A plain reading of <article> gives the same for every given page."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        parts = re.split("</?p>|<br>|</?h1>", re.search("<article>(.*?)</article>", r["html"], re.S)[1])
        blocks = (" ".join(html.unescape(re.sub("<.*?>", "", p)).split()) for p in parts)
        want[r["page_id"]] = "\n\n".join(b for b in blocks if b)
    assert {r["page_id"]: r["text"] for r in main_text.extract(pages).collect()} == want
