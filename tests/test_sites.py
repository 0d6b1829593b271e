"""All site layouts end to end: one listing and one article page each, in our own words."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from newsloom.operators.links import extract_cards, next_pages
from newsloom.plans.articles import build_articles, card_table, extract_articles
from newsloom.sources.pages import with_source
from newsloom.sources.sites import listing_table, site_table, start_pages

RUN = date(2024, 1, 15)
LONG = "First point made here. Second point follows. Third one. Fourth one. Fifth is cut."
LEAD = "First point made here Second point follows Third one Fourth one"
META = '<meta property="og:image" content="https://img.example/{0}.png">'
WHEN = '<meta property="article:published_time" content="2021-03-05T08:00:00Z">'

# source: (listing URL, listing HTML, article URL, article HTML, expected fields)
CASES = {
    "aljazeera": (
        "https://www.aljazeera.com/tag/technology/",
        '<div class="gc__content"><h3><a href="/news/a1"><span>Robots &amp; us</span></a></h3>'
        '<div class="gc__excerpt"><p>A teaser</p></div></div>',
        "https://www.aljazeera.com/news/a1",
        f"<head>{META.format('a1')}{WHEN}</head><article><p>One</p><p>Two</p></article>",
        dict(title="Robots & us", blurp="A teaser", category="technology", text="One\n\nTwo",
             date=date(2021, 3, 5), imgurl="https://img.example/a1.png", tags=None)),
    "apnews": (
        "https://apnews.com/hub/technology/",
        '<div data-key="feed-card-wire-story-with-image"><a href="/article/b1"><h1 class="Component-h1-0-2-42">Chips</h1></a>'
        '<p>Short on chips</p><span data-source="2021-03-05T01:02:03Z">now</span></div>',
        "https://apnews.com/article/b1",
        '<meta property="og:url" content="https://apnews.com/b1.jpg"><div data-key="article"><div><p> One <b>bold</b></p>'
        '<p>Two</p></div></div><p>outside</p>',
        dict(title="Chips", blurp="Short on chips", category="technology", text="One boldTwo",
             date=date(2021, 3, 5), imgurl="https://apnews.com/b1.jpg", tags=None)),
    "cio": (
        "https://www.cio.com/asean/category/analytics/",
        '<div class="main-col">'
        '<div class="i"><div><h3><a href="/article/c0">Zero</a></h3><h4>never used</h4></div></div>'
        '<div class="i"><div><h3><a href="/article/c1">One</a></h3></div></div>'
        '<div class="i"><div><h3><a href="/article/c2">Two</a></h3><h4>gap</h4></div></div>'
        '<div class="i"><div><h3><a href="/article/c3">Three</a></h3><h4>Third blurp</h4></div></div>'
        '<div class="i"><div><h3><a href="/video/c4">Four</a></h3><h4>film</h4></div></div></div>',
        "https://www.cio.com/article/c3",
        '<meta itemprop="keywords" content="data, cloud"><h3 itemprop="description">Described</h3>'
        '<span class="pub-date" content="2021-03-05T00:00-05:00">5 Mar</span><img src=/no.png><img data-original="/c3.jpg">'
        '<div itemprop="articleBody"><p>One <b>bold</b></p><p></p><p><i>Two</i> tail</p></div>',
        dict(title="Three", blurp="Third blurp", category="analytics", text="One Two",
             date=date(2021, 3, 5), imgurl="https://www.cio.com/c3.jpg", tags=["data", "cloud"])),
    "govinsider": (
        "https://www.govinsider.asia/",
        '<div><h2 class="big entry-title"><a href="/d1">Digital ID</a></h2><div class="x entry-summary"><p>An ID for all</p></div></div>'
        '<div><h2 class="entry-title"><a href="/d2">No summary</a></h2></div>',
        "https://www.govinsider.asia/d2",
        f'{META.format("d2")}<div class="post-meta"><a> Security </a></div><time class="updated">5 Mar 2021</time>'
        f'<div class="entry-content post-content"><p>{LONG}</p></div>',
        dict(title="No summary", blurp=LEAD, category="Security", text=LONG, date=date(2021, 3, 5),
             imgurl="https://img.example/d2.png", tags=None)),
    "govtech": (
        "https://www.govtech.com/security/",
        '<div class="feature-article"><a href="https://www.govtech.com/e0"></a><h1><a href="#">Lead</a></h1></div>'
        '<div class="sub-feature-article"><h2><a href="https://www.govtech.com/e1?x=1">Patch</a></h2></div>',
        "https://www.govtech.com/e1",
        '<p class="description">About patches</p><div><span class="date"> March 5, 2021 </span></div>'
        '<div id="feature_image"><amp-img src="//img.example/e1.png"></amp-img></div><div id="article_body"><p>A<b>B</b></p><p>C</p></div>',
        dict(title="Patch", blurp="About patches", category="security", text="ABC", date=date(2021, 3, 5),
             imgurl="https://img.example/e1.png", tags=None)),
    "guardian": (
        "https://www.theguardian.com/uk/technology",
        '<div class="fc-item__container"><a href="https://www.theguardian.com/technology/f1">x</a>'
        '<a href="https://www.theguardian.com/sport/f9">y</a></div>'
        '<div class="fc-item__container"><a href="https://www.theguardian.com/technology/video/f2">z</a></div>',
        "https://www.theguardian.com/technology/f1",
        f'{META.format("f1")}{WHEN}<ul><li class="css-blajdl"><a>Tech</a></li><li class="css-184iqxr"><a>AI</a></li>'
        '<li class="css-184iqxr"><a>Law</a></li></ul><div class="css-zjgnrw"><p>Stand first</p></div>'
        "<article><h1>AI and the law</h1><p>Body</p></article>",
        dict(title="AI and the law", blurp="Stand first", category="Tech", text="AI and the law\n\nBody",
             date=date(2021, 3, 5), imgurl="https://img.example/f1.png", tags=["AI", "Law", "Tech"])),
    "infoworld": (
        "https://www.infoworld.com/category/analytics/",
        '<div class="river-well article"><h3><a href="/article/g1">ignored</a></h3></div>'
        '<div class="river-well article"><h3><a href="/blog/g2">no</a></h3></div>',
        "https://www.infoworld.com/article/g1",
        '<h1 itemprop="headline">Fast data</h1><h3 itemprop="description">Quick</h3><span class="pub-date" content="2021-03-05T09:00">x</span>'
        '<img itemprop="contentUrl" data-original="https://img.example/g1.png"><span class="primary-cat-name2">Data</span>'
        '<span class="primary-cat-name2">Cloud</span><div itemprop="articleBody"><p>Text [ad] more [ad2] end</p></div>',
        dict(title="Fast data", blurp="Quick", category="analytics", text="Text  end", date=date(2021, 3, 5),
             imgurl="https://img.example/g1.png", tags=["Data", "Cloud"])),
    "khaleej": (
        "https://www.khaleejtimes.com/technology",
        '<div class="listing_main_news"><h1><a href="/h0">Main</a></h1></div><div class="liting_list"><h2><a href="/h1">Drones</a></h2></div>',
        "https://www.khaleejtimes.com/h1",
        '<div class="main_content_bg"><div class="author_detail"><span>Staff</span> Filed on March 5, 2021 at noon</div>'
        '<div class="articlepage_summary"><h2> Up they go </h2></div><div class="main_article_img_main"><img src="/h1.png"></div>'
        '<div class="a articlepage_content_zz"><p>Fly</p></div></div>',
        dict(title="Drones", blurp="Up they go", category="technology", text="Fly", date=date(2021, 3, 5),
             imgurl="https://www.khaleejtimes.com/h1.png", tags=None)),
    "nytimes": (
        "https://www.nytimes.com/section/technology",
        '<h2 class="css-4tvmog eecsw3u0"><a href="/i0">Top</a></h2><article class="css-imuvyx"><a href="/i1">Middle</a>'
        '<p class="css-1jhf0lz eecsw3u3">Mid blurp</p></article><li class="css-ye6x8s"><a href="/i2"><h2>Bottom</h2></a><p>Low</p></li>',
        "https://www.nytimes.com/i0",
        f'{META.format("i0")}{WHEN}<span class="css-17xtcya"><a href="/section/business">B</a></span>'
        "<article><p>Alpha beta. Alpha gamma. Alpha beta delta. Zed.</p></article>",
        dict(title="Top", blurp="Alpha beta. Alpha gamma. Alpha beta delta.", category="business",
             text="Alpha beta. Alpha gamma. Alpha beta delta. Zed.", date=date(2021, 3, 5),
             imgurl="https://img.example/i0.png", tags=None)),
    "opengov": (
        "https://www.opengovasia.com",
        '<div class="elementor-post__text"><h3><a href="http://www.opengovasia.com/j1/"> Open data</a></h3></div>',
        "https://www.opengovasia.com/j1/",
        '<meta property="article:section" content="Big Data"><div class="w image"><div><img src="/j1.png"></div></div>'
        '<span class="x item--type-date">\n\tMarch 5, 2021\n</span>'
        f'<div class="y theme-post-content"><div><p>{LONG}</p></div></div>',
        dict(title="Open data", blurp=LEAD, category="Big Data", text=LONG, date=date(2021, 3, 5), imgurl="https://www.opengovasia.com/j1.png", tags=None)),
    "shanghai": (
        "https://www.shine.cn/biz/tech/",
        '<div class="list-story"><a href="/k1"><img data-original="https://img.example/k1.png"></a>'
        '<div class="list-card-text"><h2>Trains</h2></div></div>',
        "https://www.shine.cn/k1",
        '<div><span class="glyphicon glyphicon-time"></span> 10:00 2021-03-05 </div><div class="content"><p>Fast.</p><p>Far.</p></div>',
        dict(title="Trains", blurp="Fast.", category="technology", text="Fast.Far.", date=date(2021, 3, 5),
             imgurl="https://img.example/k1.png", tags=None)),
    "techcrunch": (
        "https://techcrunch.com/",
        '<div class="content"><header class="post-block__header"><h2><a href="https://techcrunch.com/l1/"> Start-up </a></h2>'
        '<time datetime="2021-03-05T07:00:00">x</time></header><header class="post-block__header"><a href="https://techcrunch.com/l2/">Next</a>'
        '<time datetime="">x</time></header></div>',
        "https://techcrunch.com/l1/",
        '<meta name="sailthru.tags" content="seed, ai"><div class="article__featured-image x"><img src="/l1.png"></div>'
        '<div class="article-content"><p id="speakable-summary">A <a href=/>firm</a> grew</p><p>It <b>really</b> did<iframe>ad</iframe></p></div>',
        dict(title="Start-up", blurp="A firm grew", category=None, text="A  grewIt  did", date=date(2021, 3, 5),
             imgurl="https://techcrunch.com/l1.png", tags=["seed", "ai"])),
    "techwire": (
        "https://www.techwireasia.com",
        '<article role="article"><a href="https://www.techwireasia.com/m1" title="Clouds">c</a>'
        '<p class="byline">By <b>Ann</b> | 5 March, 2021</p></article>',
        "https://www.techwireasia.com/m1",
        '<div class="main-post-thumbnail"><img src="/m1.png"></div><div class="large-7 medium-7 columns single-content">'
        f'<p>{LONG}</p></div><div class="tags-panel"><span>Cloud</span></div>',
        dict(title="Clouds", blurp=LEAD, category="cloud", text=LONG, date=date(2021, 3, 5), imgurl="https://www.techwireasia.com/m1.png", tags=["cloud"])),
    "yonhap": (
        "https://en.yna.co.kr/business/it",
        '<div class="txt-con"><h2 class="tit"><a href="//en.yna.co.kr/view/n1">Phones</a></h2></div>',
        "https://en.yna.co.kr/view/n1",
        '<link rel="image_src" href="/n1.png"><section class="contents"><span class="txt">10:00 March 5, 2021</span>'
        '<div class="inner"><p>Ring</p><p>Ring</p></div></section>',
        dict(title="Phones", blurp="Ring", category="technology", text="RingRing", date=date(2021, 3, 5), imgurl="https://en.yna.co.kr/n1.png", tags=None)),
}


@pytest.fixture(scope="module")
def pages(spark):
    rows, n = [], 0
    for listing_url, listing, url, article, _ in CASES.values():
        rows += [(n, listing_url, f"<html><body>{listing}</body></html>"), (n + 1, url, f"<html>{article}</html>")]
        n += 2
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1).cache()


@pytest.fixture(scope="module")
def cards(spark, pages):
    return card_table(pages, site_table(spark), listing_table(spark)).cache()


@pytest.fixture(scope="module")
def articles(spark, pages, cards):
    found = extract_articles(pages, site_table(spark), F.lit(RUN), cards)
    return {r.source: r.asDict() for r in found.collect()}


@pytest.mark.parametrize("source", sorted(CASES))
def test_article(articles, source):
    want = CASES[source][4]
    got = articles[source]
    assert {k: got[k] for k in want} == want
    assert got["url"] == CASES[source][2]


def test_card_positions(cards):
    rows = {r.title: r for r in cards.where("source = 'cio'").collect()}
    assert set(rows) == {"Zero", "One", "Three"}  # position 2 is skipped, the video is denied
    assert rows["Zero"].blurp is None and rows["Three"].blurp == "Third blurp"


def test_only_listing_pages_are_read_for_cards(spark, pages):
    """Pages that no layout is for go before their element trees are made."""
    found = extract_cards(with_source(pages, site_table(spark)), listing_table(spark))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Generate inline.*\bnodes\b.*Join [^\n]*LeftSemi", plan, re.S)  # the tree's generator stands above the join


def test_card_links_are_absolute_and_on_site(cards):
    urls = {r.url for r in cards.collect()}
    assert "https://www.govtech.com/e1" in urls and "https://en.yna.co.kr/view/n1" in urls
    assert "https://www.opengovasia.com/j1/" in urls and "https://techcrunch.com/l2/" in urls
    assert not any("video" in u or "sport" in u or "/blog/" in u for u in urls)


def test_card_blurp_behind_the_card(cards):
    blurps = {r.title: r.blurp for r in cards.where("source = 'govinsider'").collect()}
    assert blurps == {"Digital ID": "An ID for all", "No summary": None}


def test_keyed_table_without_cards(spark, pages):
    extra = spark.createDataFrame([
        (90, "https://en.yna.co.kr/view/x", "<title>Same</title>"), (91, "https://apnews.com/y", "<title>Same</title>"),
        (92, "https://unknown.example/z", "<title>Lost</title>"), (93, "https://apnews.com/w", "<p>no title"),
        (94, "https://www.theguardian.com/q", "<title>the Best phones</title>"),
        (95, "https://www.theguardian.com/r", "<title>Review of X</title>"),
        (96, "https://www.theguardian.com/s", "<title>A review of X</title>"),
        (97, "https://www.opengovasia.com/t", "<title>Undated</title>"),
        (98, "https://www.cio.com/asean/u/", "<title>Month</title>")], pages.schema)
    built = {r.title: r for r in build_articles(extra, site_table(spark), F.lit(RUN)).collect()}
    assert set(built) == {"Same", "Review of X", "Undated", "Month"}
    assert built["Same"].source == "apnews" and built["Same"].date == RUN and built["Same"].text == ""
    assert built["Undated"].date is None and built["Month"].date == date(2024, 1, 1)
    assert built["Month"].category == "u"


def test_start_and_next_pages(spark):
    sources = site_table(spark)
    starts = start_pages(sources)
    assert {r.source for r in starts.collect()} == set(CASES)
    assert with_source(starts.drop("source"), sources, rules=False).where("source is null").count() == 0
    more = '<a id="load-more-index" href="?start={}">More</a>'
    rows = [(1, "https://www.cio.com/asean/category/analytics", more.format(20)),
            (2, "https://www.cio.com/asean/category/analytics/?start=20", more.format(40)),
            (3, "https://apnews.com/hub/technology/", more.format(20)), (4, "https://www.cio.com/asean/", "<p>none</p>")]
    pages = with_source(spark.createDataFrame(rows, "page_id bigint, url string, html string"), sources)
    assert [(r.page_id, r.url) for r in next_pages(pages).collect()] == [
        (1, "https://www.cio.com/asean/category/analytics/?start=20")]


def test_the_most_specific_host_wins(spark):
    sources = site_table(spark, [
        {"source": "all", "hosts": ["example.com"]}, {"source": "news", "hosts": ["news.example.com"]},
        {"source": "exact", "hosts": ["a.b.news.example.com"]}])
    urls = ["https://example.com/", "http://x.example.com", "https://news.example.com/a", "https://x.news.example.com/",
            "https://A.B.news.example.com/", "https://notexample.com/", "not a url", None]
    tagged = with_source(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "i int, url string"), sources, rules=False)
    assert [r.source for r in tagged.orderBy("i").collect()] == ["all", "all", "news", "news", "exact", None, None, None]
