import itertools
import random

import numpy as np
import pytest

from cardspark.llm.html_blocks import keys_of, parse
from cardspark.llm.html_crf import (
    FEATURES, Crf, block_features, extract, labelled_pages, main_text, train, trained,
)


@pytest.fixture(scope="module")
def model():
    return trained()


def texts(html):
    return [b.text for b in parse(html)[1]]


def test_blocks():
    assert texts("<p>a <b>b</b>  c</p><p>d<br>e") == ["a b c", "d e"]
    assert texts("<ul><li>one<li>two</ul>") == ["one", "two"]
    assert texts("x &amp; y &eacute; &#233; &lt;p&gt;") == ["x & y é é <p>"]
    assert texts('<script>var t="</p>"; a<b</script>t<style>p{}</style>') == ["t"]
    assert texts("a<!-- <p>no</p> -->b") == ["ab"]
    assert texts("1 < 2 <3") == ["1 < 2 <3"]
    assert texts('<p title="a > b">in</p>') == ["in"]
    assert texts("<p>open <b>bold<p>next") == ["open bold", "next"]
    assert texts("<select><option>x</select><button>y</button>z") == ["z"]
    assert texts("<textarea>q</textarea><noscript>r</noscript>s") == ["s"]
    assert texts("") == [] and texts("<p") == [] and texts("<!-- never closed") == []
    assert texts("<svg><title>t</title><text>u</text></svg>v") == ["v"]
    assert parse("<title>A &amp; B</title><p>x")[0] == "A & B"
    assert texts("a b\n\t c") == ["a b c"]


def test_paths_and_names():
    (block,) = parse('<article><div class="Post-Body"><p><a href=x>l</a>ink</p></div></article>')[1]
    assert [t for t, _ in block.path] == ["article", "div", "p"]
    assert block.link_chars == 1
    assert "content" in keys_of(' class="Post-Body"')
    assert keys_of(' id="cookieBar"') == ("notice",)
    assert "hidden" in keys_of(' style="display: none"')


def test_long_and_odd_pages_are_linear(model):
    for html in ("<div>" * 100_000 + "x", "<" * 200_000, '<a title="' * 20_000, "<p>a" * 50_000,
                 "</div>" * 100_000, "a" * 2_000_000):
        main_text(html, model)


def test_viterbi_is_the_best_labelling():
    rng = np.random.default_rng(1)
    k = len(FEATURES)
    for _ in range(20):
        crf = Crf(rng.normal(size=k), rng.normal(size=(2, 2)), rng.normal(size=2))
        active = [sorted(rng.choice(k, 4, replace=False).tolist()) for _ in range(7)]

        def value(path):
            return crf.starts[path[0]] + sum(crf.weights[active[t]].sum() * y for t, y in enumerate(path)) \
                + sum(crf.moves[a, b] for a, b in zip(path, path[1:]))
        best = max(itertools.product((0, 1), repeat=7), key=value)
        assert abs(value(crf.decode(active)) - value(best)) < 1e-9
    assert crf.decode([]) == []


def test_training_raises_the_likelihood():
    pages = labelled_pages(40, seed=5)
    early, late = train(pages, epochs=3), train(pages, epochs=80)

    def right(crf):
        hits = [a == b for t, bl, y in pages for a, b in zip(crf.decode(block_features(t, bl)), y)]
        return sum(hits) / len(hits)
    assert right(late) > 0.97 and right(late) >= right(early)


def test_held_out_blocks(model):
    held = labelled_pages(200, seed=99)
    hits = [a == b for t, bl, y in held for a, b in zip(model.decode(block_features(t, bl)), y)]
    assert sum(hits) / len(hits) > 0.98


PAGE = """<html><head><title>Big day</title><style>x{}</style></head><body>
<header><div class=logo>Site name</div></header><nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav>
<div class="cookie-notice"><p>We use cookies, to make this site work well. Accept them all now.</p></div>
<article><h1>Big day</h1><p>It was a big day, and all came. They sang.</p>
<div class="advert">Buy our fine shoes today, they are cheap. Half price now.</div>
<p>Then   it rained &amp; they left.</p></article>
<aside class="sidebar"><h3>More</h3><p>Some other story that you may like to read. It is good.</p></aside>
<section id="comments"><h3>Comments</h3><div class="comment">I was there too, it was great. Thanks for this.</div></section>
<form><label>Sign up to our letter, it is free.</label><input><button>Go</button></form>
<footer>&copy; Site name. All rights kept.</footer><script>track("</p>")</script></body></html>"""
WANT = "Big day\nIt was a big day, and all came. They sang.\nThen it rained & they left."


def test_planted_page(model):
    assert main_text(PAGE, model)[0] == WANT


def test_extract(spark, model):
    rows = [(1, "u", PAGE, "t", 1), (1, "u", PAGE, "t", 1), (2, None, None, "t", 1),
            (3, "v", "", None, None), (None, "w", "<nav><a href=x>m</a></nav>", "t", 2)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    got = extract(d, model)
    out = sorted(((r["page_id"] or 0), r["text"], r["n_chars"]) for r in got.collect())
    assert out == [(0, "", 0), (1, WANT, len(WANT)), (1, WANT, len(WANT)), (2, "", 0), (3, "", 0)]
    assert extract(d.limit(0), model).count() == 0


def test_table_pages_by_their_article(spark, model):
    """The pages of the table mark their article: a plain second reading."""
    import re
    from html import unescape
    for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect():
        inner = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        parts = [" ".join(unescape(re.sub("<[^>]*>", "", x)).split())
                 for x in re.split("</?(?:p|h1|br)>", inner)]
        assert main_text(r["html"], model)[0] == "\n".join(x for x in parts if x)


def test_pages_do_not_depend_on_words():
    assert labelled_pages(3, seed=2)[0][2] == labelled_pages(3, seed=2)[0][2]
    random.seed(0)


@pytest.mark.parametrize("tag, rest", [
    ('<a href="x>y">', ""), ("<a title='>' b=\">\">", ""), ("<p title=it's>", "that's > so"),
    ('<p ">', "a"), ("<p a = \"b\"c>", "d"), ('<a href="' + "y" * 50_000 + '>">', "text"),
    ('<p class="open>', "no quote follows"), ("<br/>", ""), ("<p =>", "x"), ('<p a="b">', '">')])
def test_tags_end_where_they_end(tag, rest):
    from cardspark.llm.html_blocks import _tag_end
    assert _tag_end(tag + rest, 0) == len(tag) - 1


def test_tags_without_an_end_are_linear():
    from cardspark.llm.html_blocks import _tag_end
    for t in ("<a " + "b='c' " * 100_000, "<a " + "=\"" * 100_001, "<a " + "'" * 300_000):
        _tag_end(t, 0)
