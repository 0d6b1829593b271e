"""Column functions on hand-written input."""

import html as stdlib_html
import html.entities
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from newsloom.functions import dates as D
from newsloom.functions import html as H
from newsloom.functions import text as T
from newsloom.functions import urls as U
from newsloom.operators.links import extract_links

PAGE = """<html><head><title>Fallback</title><meta property="og:image" content="/a.png">
<meta content='tech' property='article:section'><meta itemprop="keywords" content="a, b">
<link rel="image_src" href="//cdn.example.org/b.png?x=1&amp;y=2"></head><body>
<div class="outer"><div class="body extra"><p>One <b>bold</b> and <i>slanted <u>deep</u></i> end.</p>
<p></p><script>var x = "<p>not text</p>";</script><p><em>Two</em> tail<p>Open &amp; &#8217;late&rsquo;<div class="inner">side</div></div>
<span>after</span></div><img class="x" data-original="/lazy.jpg" src="/plain.jpg"></body></html>"""


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


def one(spark, value, fn):
    return column(spark, [value], fn)[0]


def test_paragraph_modes(spark):
    clean = H.strip_markup
    assert one(spark, PAGE, lambda x: H.body_text_all(clean(x))) == (
        "One bold and slanted deep end.Two tailOpen & ’late’")
    assert one(spark, PAGE, lambda x: H.body_text_first(clean(x))) == "One TwoOpen & ’late’"
    assert one(spark, PAGE, lambda x: H.body_text_direct(clean(x))) == "One  and  end. tailOpen & ’late’"
    assert one(spark, "<div>no paragraph</div>", H.body_text_all) == ""


def test_scripts_and_comments_never_leak(spark):
    html = "a<!-- <script> -->b<SCRIPT src=x>if (a < b) {'<!--'}</SCRIPT >c<style>p{}</style>d<script>open"
    assert one(spark, html, H.strip_markup) == "abcd"


def test_element_matches_its_own_closing_tag(spark):
    opening = H.opening_tag("div", "class", "body", contains=True)
    inner = one(spark, PAGE, lambda x: H.element(H.strip_markup(x), F.lit(opening), F.lit("div")))
    assert inner.startswith("<p>One") and inner.endswith('<div class="inner">side</div>')
    assert one(spark, "<div>x", lambda x: H.element(x, F.lit(H.opening_tag("p")), F.lit("p"))) is None
    assert one(spark, "<div><div>a</div><p>b</p></div>c", lambda x: H.element(
        x, F.lit(H.opening_tag("div")), F.lit("div"))) == "<div>a</div><p>b</p>"
    assert one(spark, "<div>a<div>b", lambda x: H.element(x, F.lit(H.opening_tag("div")), F.lit("div"))) == "a<div>b"


def test_child_elements_keep_nested_ones_inside(spark):
    html = "x<div a>1<div>2</div>3</div>y<div>4</div><div>5"
    assert one(spark, html, lambda x: H.child_elements(x, F.lit("div"))) == [
        "<div a>1<div>2</div>3", "<div>4", "<div>5"]


def test_meta_and_images(spark):
    assert one(spark, PAGE, lambda x: H.meta_content(x, "property", "og:image")) == "/a.png"
    assert one(spark, PAGE, lambda x: H.meta_content(x, "property", "section", contains=True)) == "tech"
    assert one(spark, PAGE, lambda x: H.meta_content(x, "itemprop", "keywords")) == "a, b"
    assert one(spark, PAGE, lambda x: H.meta_content(x, "rel", "image_src", tag="link", read="href")) == (
        "//cdn.example.org/b.png?x=1&y=2")
    assert one(spark, PAGE, lambda x: H.meta_content(x, "name", "none")) is None
    base = F.lit("https://example.com/a/b")
    assert one(spark, PAGE, lambda x: H.lead_image(x, base)) == "https://example.com/lazy.jpg"
    assert one(spark, "<img src='p.jpg'>", lambda x: H.lead_image(x, base)) == "https://example.com/a/p.jpg"
    assert one(spark, "<p>none</p>", lambda x: H.lead_image(x, base)) is None


def test_title_falls_back(spark):
    titles = ["<h1 class=a> A &amp; <b>B</b> </h1><title>no</title>", "<h1>&nbsp;</h1><title>T</title>", "<p>x"]
    assert column(spark, titles, H.page_title) == ["A & B", "T", None]


def test_entities_decode_once(spark):
    texts = ["&amp;lt; &lt;b&gt; &quot;x&quot; &apos;", "caf&eacute; &mdash; &Omega; &hellip; &nbsp;|",
             "&#39; &#8217; &#x2014; &#X41;", "plain", "&;&&amp;&", "AT&T &copy; 2020", ""]
    assert column(spark, texts, H.unescape_entities) == [stdlib_html.unescape(t) for t in texts]
    assert column(spark, texts, H.unescape_html5) == [stdlib_html.unescape(t) for t in texts]
    assert one(spark, "&unknown; &copy 1", H.unescape_entities) == "&unknown; &copy 1"
    assert one(spark, None, H.unescape_entities) is None


def test_html5_references_are_those_of_the_standard_library(spark):
    """Every name with and without its end, every kind of number, and random mixtures."""
    names, draw = stdlib_html.entities.html5, random.Random(1)
    texts = [f"a&{n}b" for n in names] + [f"x&{n[:-1]} y" for n in names if n.endswith(";")]
    texts += [f"&#{n};|&#x{n:X}z|&#X{n:x};" for n in [
        *range(0x110), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDD0, 0xFDEF, 0xFFFD, 0xFFFE, 0x1F600, 0x1FFFE, 0x10FFFF, 0x110000, 10**9]]
    parts = ["&", "#", "x", "amp", "lt", ";", "not", "notit", "in", "000", "65", " ", "<", "copy", "é", "\x01", "\x02", "frac12", "A"]
    texts += ["".join(draw.choices(parts, k=12)) for _ in range(1000)] + ["&", "", "&;", "&#;", "&#x;", "&#0000000000065;", "&#x000000041 "]
    assert column(spark, texts, H.unescape_html5) == [stdlib_html.unescape(t) for t in texts]
    assert one(spark, None, H.unescape_html5) is None


def test_every_html4_name(spark):
    from html.entities import name2codepoint
    text = "".join(f"&{n};" for n in name2codepoint)
    assert one(spark, text, H.unescape_entities) == "".join(map(chr, name2codepoint.values()))


def test_main_text_without_article(spark):
    prose = " ".join(["word"] * 30)
    page = f"<div><a href=/>Home</a> <a href=/x>About us</a></div><div>{prose} <a href=/y>link</a></div><p>{prose}<div><a href=/z>more</a></div>"
    assert one(spark, page, H.main_text) == f"{prose} link\n\n{prose}"
    assert one(spark, f"<nav>x</nav><article><p>A<p>B &amp; <b>C</article>{prose}", H.main_text) == "A\n\nB & C"


def test_clean_space(spark):
    texts = ["\n\t a b 　\x0b", " x ", "", " \n "]
    assert column(spark, texts, T.clean_space) == [t.strip() for t in texts]
    assert column(spark, texts, lambda x: T.clean_space(x, True)) == [t.lstrip() for t in texts]
    again = column(spark, texts, lambda x: T.clean_space(T.clean_space(x)))
    assert again == column(spark, texts, T.clean_space)


def test_strip_brackets_is_greedy_per_line(spark):
    assert one(spark, "a [1] b [2] c\nd [3", T.strip_brackets) == "a  c\nd [3"
    assert one(spark, "a [1] b [2] c", lambda x: T.strip_brackets(T.strip_brackets(x))) == "a  c"


def test_lead_sentences(spark):
    assert one(spark, "A. B. C. D. E.", T.lead_sentences) == "A B C D"
    assert one(spark, "short.", lambda x: T.lead_sentences(x, longer_than=50)) is None


def test_term_counts(spark):
    df = spark.createDataFrame([("The cat, the CAT & a dog!",), ("",), ("...",)], "x string")
    got = [{t.term: t.n for t in r.c} for r in df.select(T.term_counts(T.tokens(F.col("x"))).alias("c")).collect()]
    assert got == [{"the": 2, "cat": 2, "a": 1, "dog": 1}, {}, {}]


@pytest.mark.parametrize("href, want", [
    ("https://other.org/x", "https://other.org/x"), ("mailto:a@b.c", "mailto:a@b.c"),
    ("//cdn.org/x", "http://cdn.org/x"), ("/root", "http://example.com/root"),
    ("leaf", "http://example.com/a/leaf"), ("?start=40", "http://example.com/a/b?start=40"),
    ("#top", "http://example.com/a/b?q=1#top"), ("", None), (None, None),
])
def test_resolve_url(spark, href, want):
    assert one(spark, href, lambda x: U.resolve_url(x, F.lit("http://example.com/a/b?q=1#z"))) == want


def test_resolve_url_on_a_bare_host(spark):
    assert one(spark, "leaf", lambda x: U.resolve_url(x, F.lit("https://example.com"))) == "https://example.com/leaf"


def test_url_parts(spark):
    assert one(spark, "http://U:p@Www.Example.com:80/a/?q#f", U.host) == "www.example.com"
    assert one(spark, "http://example.com/a/?q=/#f", U.canonical_url) == "https://example.com/a/"
    urls = ["https://example.com/tag/tech/", "https://example.com/tag/tech", "https://example.com/"]
    assert column(spark, urls, U.url_category) == ["tech", None, "example.com"]
    assert column(spark, urls, lambda x: U.url_category(x, True))[:2] == ["tech", "tech"]


def test_dates(spark):
    texts = ["2021-03-05", "March 5, 2021", "5 Mar 2021", "March 5 2021", "5 March, 2021", "junk", "", None, "2021-13-40"]
    day = date(2021, 3, 5)
    assert column(spark, texts, D.parse_date) == [day] * 5 + [None] * 4
    printed = one(spark, "2021-03-05", lambda x: D.format_date(D.parse_date(x)))
    assert printed == "05/03/2021"


def test_clean_date_text(spark):
    cases = {
        "iso": ("2021-03-05T10:00:00Z", "2021-03-05"), "month_day": ("<b>On March 5, 2021</b> at noon", "March 5, 2021"),
        "iso_search": ("at 2021-03-05 now", "2021-03-05"), "drop": ("\n\tMarch 5, 2021\t", "March 5 2021"),
        "byline": ("By A | 5 March, 2021 | B", "5 March, 2021"), "plain": (" 5 Mar 2021 ", "5 Mar 2021"),
    }
    for mode, (text, want) in cases.items():
        assert one(spark, text, lambda x, m=mode: D.clean_date_text(x, m)) == want
    assert one(spark, "no date", lambda x: D.clean_date_text(x, "month_day")) is None
    assert one(spark, "5 March, 2021", lambda x: D.clean_date_text(x, "byline")) == "5 March, 2021"


def test_default_date(spark):
    run = F.lit(date(2024, 1, 15))
    for policy, want in (("run", date(2024, 1, 15)), ("month", date(2024, 1, 1)), ("none", None)):
        assert one(spark, "junk", lambda x, p=policy: D.default_date(D.parse_date(x), p, run)) == want


def test_every_element_once_and_only_at_a_depth(spark):
    div = F.lit(H.opening_tag("div", "class", "c"))
    every = lambda x: H.all_elements(x, div, F.lit("div"))
    page = '<div class="c">a<div class="c">b</div>c</div><div>no</div><div class="c">d<div>e</div>'
    assert one(spark, page, every) == ['a<div class="c">b</div>c', "d<div>e</div>"]
    assert column(spark, ["<div>x</div>", "", None], every) == [None, None, None]
    body = "<p>body.</p><aside><p>advert</p></aside><div><p>in</p><blockquote><p>quote</p></blockquote></div><p>end"
    text = lambda depth: lambda x: H.body_text_first(H.at_depth(x, F.lit(depth)))
    assert one(spark, body, text(0)) == "body.end"
    assert one(spark, body, text(1)) == "advertin"
    assert one(spark, body, text(None)) == "body.advertinquoteend"


def test_pick_looks_into_the_first_element_with_the_child(spark):
    rule = F.struct(F.lit(H.opening_tag("a")).alias("opening"), F.lit("a").alias("tag"), F.lit("span").alias("child"),
                    F.lit(None).cast("string").alias("attr"), F.lit(False).alias("every"))
    assert one(spark, '<a href="1"><img></a><a href="2"><span>title</span></a>', lambda x: H.pick(x, rule)) == "title"


def test_references_of_any_length(spark):
    texts = ["&#00000000065;", "&#x0000000041;", "&#99999999999999999999;", "&#x110000;", "&#0;", "&#1114111;"]
    assert column(spark, texts, H.unescape_entities) == ["A", "A", *texts[2:5], "\U0010ffff"]


def test_links_in_every_form(spark):
    pages = spark.createDataFrame([(1, "http://h/", p) for p in [
        '<a href="/a">one <a href="/b">two</a>', "<a href=/unq>x</a>", '<a href="/it\'s">y</a>', '<a title="p>q" href="/x?a>b">z</a>',
        '<A HREF = \'/c\' >t<b>u</b></A >v', "<abbr href=/no>n</abbr><a name=k>m</a>", None]], "page_id int, url string, html string")
    assert sorted((r.href, r.anchor) for r in extract_links(pages).collect()) == [
        ("/a", "one"), ("/b", "two"), ("/c", "tu"), ("/it's", "y"), ("/unq", "x"), ("/x?a>b", "z")]


def test_page_address(spark):
    url = "http://h/p?id=1#top"
    assert one(spark, url, U.page_address) == "http://h/p?id=1"
    assert one(spark, url, lambda x: U.page_address(x, True, True)) == "https://h/p"
    assert one(spark, url, lambda x: U.page_address(x, F.lit(None).cast("boolean"), F.lit(True))) == "https://h/p?id=1"
