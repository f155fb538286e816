import re
import time
from html import unescape

import numpy as np
import pytest

from gridloom.llm import dom
from gridloom.llm.html_text import KINDS, Layouts, decode, extract, extract_pages, trained

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><script>var a="</p>";</script></head><body><nav><ul><li><a href="/a">Home</a><li><a href="/b">More</a></ul></nav>'
    '<div class="cookie-notice"><p>We use cookies, please accept them all.</p></div><article><h1>A &amp; B\n story</h1><p>First para&shy;graph, with <b>bold</b>ness and&nbsp;more words in it.'
    '<p>Second one, <i>long</i> enough to look like prose. It has sentences.<br>And a line.<div class="ad">Buy this now!</div></article>'
    '<section class="comments"><h3>Comments</h3><div class="comment"><p>I think this is a long comment, with sentences. Really.</p></div></section><footer>&copy; me</footer>'
)


def test_page():
    assert extract([PAGE], trained()) == ["A & B story First para\xadgraph, with boldness and more words in it. Second one, long enough to look like prose. It has sentences. And a line."]


def test_generated_pages_of_another_seed():
    layouts, both, found, true = Layouts(77), 0, 0, 0
    for _ in range(80):
        source = layouts.page()
        want = " ".join(" ".join(unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.findall(f"{Layouts.ON}(.*?){Layouts.OFF}", source, re.S)).split()
        got = extract([Layouts.clean(source)], trained())[0].split()
        found, true, both = found + len(got), true + len(want), both + len(set(got) & set(want)) / max(len(set(want) | set(got)), 1)
    assert both / 80 > 0.93 and 0.9 < found / true < 1.1


PROSE = "It was a long day, and nobody had expected the rain to stop. The river rose again at night. "


@pytest.mark.parametrize(
    ("source", "want"),
    [
        (PROSE, PROSE.strip()),
        (f"<p>{PROSE}</p>{PROSE}<p>{PROSE}</p>", " ".join([PROSE.strip()] * 3)),
        (f"<html><body><article><p>{PROSE}</p></article></body></html>", PROSE.strip()),
        (f"<article><p>{PROSE}So <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds &amp; 1 < 2 too.</p><p>{PROSE}</p></article>", f"{PROSE}So x=2 holds & 1 < 2 too. {PROSE.strip()}"),
        (f"<nav class=menu><a href=/>Home</a> <a href=/b>News</a></nav><div><p>{PROSE}</p><p>{PROSE}{PROSE}</p></div><footer>© me</footer>", " ".join([PROSE.strip()] * 3)),
        (f"<article><p>{PROSE}</p><script>var a = '<p>no</p>';</script><textarea>no</textarea><p>{PROSE}</p></article>", " ".join([PROSE.strip()] * 2)),
    ],
)
def test_known_pages(source, want):
    assert extract([source], trained()) == [want]


@pytest.mark.parametrize("part", ['<a "x" ', "<a x='", "<p", "<!--", "<", "<li><ul><span>", "</p", "<script", '<a b="', "<p><b>", "<td><tr>", "&amp;<br/"])
def test_time_grows_with_length_only(part):
    began = time.time()
    page = dom.Page(part * 100_000)
    assert len(page.parents) == len(page.tags) and time.time() - began < 4


def test_decoding_has_no_contradiction():
    rng = np.random.default_rng(1)
    page = dom.Page(PAGE)
    for _ in range(50):
        kept = decode(page, rng.normal(0, 3, len(page.tags)), np.ones(len(page.tags)))
        assert all(kept[p] or not k for k, p in zip(kept[1:], page.parents[1:], strict=True))


@pytest.mark.parametrize("source", ["", "no tags", "<", "<p", "<!--", "</p></div>", "<p>" * 3000, "<div>" * 3000 + "x", "<script>", "<table><tr><td>a<td>b<tr><td>c", "<p class=a'b>x</p>", "a" * 200_000])
def test_odd_sources(source):
    page = dom.Page(source)
    assert dom.features(page, trained().learned).shape == (len(page.tags), 2 * KINDS + dom.DENSITIES)
    assert isinstance(extract([source], trained())[0], str)


def test_rows(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "y"), (None, "v", "", "z")], "page_id long, url string, html string, text string")
    rows = extract_pages(df).collect()
    assert sorted(r.n_chars for r in rows)[:2] == [0, 0] and len(rows) == 4 and all(len(r.text) == r.n_chars for r in rows)
    assert extract_pages(df.limit(0)).count() == 0
