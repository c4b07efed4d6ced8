import pytest

from affinis.llm import html_text as ht

PAGE = """<html><head><title>T</title><script>var a = "<p>no</p>";</script></head><body>
<header class="site"><h1>Site</h1><p>Some slogan of the site stands here</p></header><nav><ul><li><a href=x>Home page of it</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies on this page and you agree with all of it</p></div>
<article class="post"><header><h1>Title &amp; more</h1></header><p>First   para with <a href="#">a link</a>
and more words that go on&hellip;</p><aside class="sidebar"><p>Related things are shown here</p></aside><div class="ad">Buy now</div>
<p>Second<br>para &lt;b&gt; here.</p><ul><li>one</li><li>two</li></ul><form><input><label>Your mail</label></form><p>Last.</p></article>
<section class="comments"><article class="comment"><p>I think this is a very good article that I liked to read so much, with many words in it</p></article></section>
<footer>&copy; 2024 the site and all of its owners</footer></body></html>"""
TEXT = "Title & more\nFirst para with a link and more words that go on…\nSecond para <b> here.\none\ntwo\nLast."
SCHEMA = "page_id long, url string, html string, text string"


def test_noise_is_left_out():
    assert ht.main_text(PAGE, ht.Weights()) == TEXT


@pytest.mark.parametrize(
    ("page", "text"),
    [(None, ""), ("", ""), ("<nav>menu of it</nav>", ""), ("plain words &amp; more", "plain words & more"), ("<p>a b<p>c d e", "a b\nc d e"), ("<p>broken <b>bold<br><p>next one here", "broken bold\nnext one here"), ("a < b and c", "a < b and c"), ("<script>never closed", ""), ("<!-- open comment", "")],
)
def test_odd_pages(page, text):
    assert ht.main_text(page, ht.Weights()) == text


def test_region_is_the_best_stretch():
    assert ht.region([-1, 2, -1, 3, -5, 4]) == (1, 4)
    assert ht.region([-1, -2]) == (0, 0)
    assert ht.region([1, -1, 1]) == (0, 3)


def test_brute_force_region():
    import random

    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.randrange(-3, 4) for _ in range(rng.randrange(1, 12))]
        first, last = ht.region(scores)
        best = max([0] + [sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)])
        assert sum(scores[first:last]) == best


def test_on_a_table(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, None), (None, "u", "<p>w</p>", "x"), (1, "u", PAGE, "x")]
    pages = spark.createDataFrame(rows, SCHEMA)
    got = ht.extracted(pages, ht.fit(pages)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "w", 1), (1, TEXT, len(TEXT)), (1, TEXT, len(TEXT)), (2, "", 0)]
    assert ht.extracted(pages.limit(0), ht.fit(pages.limit(0))).count() == 0


def test_weights_come_from_labelled_pages(spark):
    pages = spark.createDataFrame([(i, "u", f"<body><div>outside words here</div><article><p>inside {i} words are here</p></article></body>", "") for i in range(20)], SCHEMA)
    weights = ht.fit(pages)
    assert weights.shares["word in p"] > 0.9 > 0.1 > weights.shares["word in div"]
    assert ht.main_text("<div>outside words here</div><p>what one wants to have of it</p>", weights) == "what one wants to have of it"


P = "words of the article that go on and on for a while " * 4


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><h2 id='related-work'>Related work</h2><p>{P}</p></article>", f"Related work\n{P.strip()}"),
        (f"<article><section id='discussion'><p>{P}</p></section></article>", P.strip()),
        (f"<body><div class='content with-sidebar'><article><p>{P}</p></article></div></body>", P.strip()),
        (f"<article><p>{P}</p><div class='search-results'><p>Found</p></div></article>", f"{P.strip()}\nFound"),
        (f"<article><p>{P}</p><label>Name</label></article>", f"{P.strip()}\nName"),
        (f"<article><p>{P}</p><section class='comments'><p>me too</p></section><div class='ad'>buy</div></article>", P.strip()),
        (f"<div class='cookie-banner'>{P}</div><article><p>{P}</p></article><div id='site-footer'>{P}</div>", P.strip()),
    ],
)
def test_names_inside_and_outside_articles(page, text):
    assert ht.main_text(page, ht.Weights()) == text


@pytest.mark.parametrize("page", ["<a " * 350_000, "<!" * 500_000, "<div>x" * 150_000 + "</p>" * 30_000, "<script " * 120_000, "<a '" * 250_000, "<div class='x' " * 70_000])
def test_a_megabyte_takes_seconds(page):
    import time

    start = time.perf_counter()
    ht.main_text(page, ht.Weights())
    assert time.perf_counter() - start < 60
