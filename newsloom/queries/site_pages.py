"""Whole pages of the table in the markup of all sites, two for each: a listing and an article.

Every link of a page becomes a card of the site's layout, with one more for the page itself, and its
article becomes the site's body; nothing is cut. Sites are dealt by the page's number. Containers and
cards of some sites are nested in their like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OG = '<meta property="og:image" content="/p/{i}.png">'
WHEN = '<meta property="article:published_time" content="2024-01-02T08:00:00Z">'
LINK = '<li><a href="([^"]*)">([^<]*)</a></li>'

# One entry per site, in alphabetical order, after the sites' markup.
#   listing: a listing page's address; box: what stands around the cards; card: $1 address, $2 text
#   story: what stands before a page's path; head: beside the body; body: what stands around the article
SITES = [
    dict(source="aljazeera", listing="https://www.aljazeera.com/tag/technology/", story="https://www.aljazeera.com",
         card='<div class="gc__content"><div class="in"><a href="$1"><span>$2</span></a></div><div class="gc__excerpt"><p>About $2</p></div></div>',
         head=OG + WHEN, body=("<article>", "</article>")),
    dict(source="apnews", listing="https://apnews.com/hub/technology/", story="https://apnews.com",
         card='<div data-key="feed-card-wire-story-with-image"><div><a href="$1">go</a></div><h1 class="Component-h1-0-2-42">$2</h1>'
              '<p>first $2</p><span data-source="2024-01-05T10:00:00Z">d</span></div>',
         head='<meta property="og:url" content="/p/{i}.png">', body=('<div data-key="article"><div data-key="article">', "</div></div>")),
    dict(source="cio", listing="https://www.cio.com/asean/category/analytics", story="https://www.cio.com",
         box=('<div class="main-col">', "</div>"), card='<div class="i"><div><h3><a href="$1">$2</a></h3><h4>About $2</h4></div></div>',
         head='<h3 itemprop="description">Described {i}</h3><span class="pub-date" content="2024-01-03T00:00">x</span><img src="/no.png">'
              '<img data-original="/p/{i}.png"><meta itemprop="keywords" content="data, cloud {i}">',
         body=('<div itemprop="articleBody">', "</div>")),
    dict(source="govinsider", listing="https://www.govinsider.asia/", story="https://www.govinsider.asia",
         card='<div><h2 class="big entry-title"><a href="$1">$2</a></h2><div class="x entry-summary"><div><p>About $2</p></div></div></div>',
         head=OG + '<time class="updated">4 Jan 2024</time><div class="post-meta"><a> Security </a></div>',
         body=('<div class="entry-content post-content">', "</div>")),
    dict(source="govtech", listing="https://www.govtech.com/security/", story="https://www.govtech.com",
         card='<div class="sub-feature-article"><h2><a href="$1?src=list">$2</a></h2><div class="sub-feature-article"><h2><a href="$1?src=in">$2</a></h2></div></div>',
         head='<p class="description">About {i}</p><span class="date"> January 9, 2024 </span><div id="feature_image"><div><amp-img src="/p/{i}.png"></amp-img></div></div>',
         body=('<div id="article_body"><div>', "</div></div>")),
    dict(source="guardian", listing="https://www.theguardian.com/uk/technology", story="https://www.theguardian.com/technology",
         box=('<div class="fc-item__container"><div><div class="fc-item__container">', '</div></div><a href="/technology/video/x">film</a></div>'),
         card='<a href="/technology$1">$2</a>',
         head=OG + WHEN + '<ul><li class="css-blajdl"><a>Tech</a></li><li class="css-184iqxr"><a>AI</a></li><li class="css-184iqxr"><b>no</b><a>Law {i}</a></li></ul>'
              '<div class="css-zjgnrw"><p>Stand <b>first</b></p></div>', body=("<article>", "</article>")),
    dict(source="infoworld", listing="https://www.infoworld.com/category/analytics/", story="https://www.infoworld.com/article",
         box=('<div class="river-well article"><div class="river-well article">', '</div><h3><a href="/blog/x">no</a></h3></div>'),
         card='<h3><a href="/article$1">$2</a></h3>',
         head='<h1 itemprop="headline">Headline {i}</h1><h3 itemprop="description">Described {i}</h3><span class="pub-date" content="2024-01-03T09:00">x</span>'
              '<img itemprop="contentUrl" data-original="/p/{i}.png"><span class="primary-cat-name2">Data</span><span class="primary-cat-name2">Cloud {i}</span>',
         body=('<div itemprop="articleBody">', "</div>")),
    dict(source="khaleej", listing="https://www.khaleejtimes.com/technology", story="https://www.khaleejtimes.com",
         box=('<div class="liting_list"><div class="liting_list">', "</div></div>"), card='<h2><a href="$1">$2</a></h2>',
         head='<div class="author_detail"><span>Staff</span> Filed on January 10, 2024 at noon</div><div class="articlepage_summary"><h2> Sum {i} </h2></div>'
              '<div class="main_article_img_main"><img src="/p/{i}.png"></div>', body=('<div class="a articlepage_content_zz">', "</div>")),
    dict(source="nytimes", listing="https://www.nytimes.com/section/technology", story="https://www.nytimes.com",
         card='<li class="css-ye6x8s"><div><a href="$1"><h2>$2</h2></a><p>About $2</p></div></li>',
         head=OG + WHEN + '<span class="css-17xtcya"><a href="/section/business">B</a></span>', body=("<article>", "</article>")),
    dict(source="opengov", listing="https://www.opengovasia.com", story="https://www.opengovasia.com",
         card='<div class="elementor-post__text"><h3><a href="http://www.opengovasia.com$1">$2</a></h3></div>',
         head='<meta property="article:section" content="Big Data"><div class="w image"><div><img src="/p/{i}.png"></div></div>'
              '<span class="x item--type-date">\n\tJanuary 4, 2024\n</span>', body=('<div class="y theme-post-content"><div>', "</div></div>")),
    dict(source="shanghai", listing="https://www.shine.cn/biz/tech/", story="https://www.shine.cn",
         card='<div class="list-story"><div class="list-story"><a href="$1"><img data-original="/img$1.jpg"></a></div><div class="list-card-text"><h2>$2</h2></div></div>',
         head='<span class="glyphicon glyphicon-time"></span> 10:00 2024-01-07 <div class="caption"><div><p>About {i}</p></div></div>',
         body=('<div class="content"><div class="content">', "</div></div>")),
    dict(source="techcrunch", listing="https://techcrunch.com/", story="https://techcrunch.com",
         card='<header class="post-block__header"><h2><a href="$1">$2</a></h2><time datetime="2024-01-06T07:00:00">x</time></header>',
         head='<div class="article__featured-image x"><img src="/p/{i}.png"></div><p id="speakable-summary">A <b>firm</b> {i}</p><meta name="sailthru.tags" content="seed, ai {i}">',
         body=('<div class="article-content"><div class="article-content">', "</div></div>")),
    dict(source="techwire", listing="https://www.techwireasia.com", story="https://www.techwireasia.com",
         card='<article role="article"><div><a href="$1" title="$2">c</a><p class="byline">By <b>Ann</b> | 8 January, 2024</p></div></article>',
         head='<div class="main-post-thumbnail"><img src="/p/{i}.png"></div><div class="tags-panel"><span>Cloud {i}</span></div>',
         body=('<div class="large-7 medium-7 columns single-content">', "</div>")),
    dict(source="yonhap", listing="https://en.yna.co.kr/business/it", story="https://en.yna.co.kr",
         card='<h2 class="tit"><a href="$1">$2</a></h2>',
         head='<link rel="image_src" href="/p/{i}.png"><span class="txt">10:00 January 11, 2024</span>', body=('<div class="inner"><div class="inner">', "</div></div>")),
]


def site_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, html``: listings have the even numbers, articles the odd ones."""
    number, html = F.col("page_id"), F.col("html")
    site = F.element_at(F.array(*[F.struct(
        F.lit(s["listing"]).alias("listing"), F.lit(s["story"]).alias("story"), F.lit(s["card"]).alias("card"), F.lit(s["head"]).alias("head"),
        *[F.lit(s.get(name, ("<nav>", "</nav>"))[k]).alias(f"{name}{k}") for name in ("box", "body") for k in range(2)]) for s in SITES]),
        (F.pmod(number, F.lit(len(SITES))) + 1).cast("int"))
    title = F.concat(F.regexp_extract(html, "<title>([^<]*)", 1), F.lit(" "), number)
    own = F.concat(F.lit('<nav><ul><li><a href="/story/'), number, F.lit('">'), title, F.lit("</a></li>"))

    def put(text: Column, old: str, new: Column | str) -> Column:
        return F.replace(text, F.lit(old), new if isinstance(new, Column) else F.lit(new))

    listing = F.regexp_replace(put(html, "<nav><ul>", own), F.lit(LINK), F.col("site.card"))
    listing = put(put(listing, "<nav><ul>", F.col("site.box0")), "</ul></nav>", F.col("site.box1"))
    article = put(put(html, "<article>", F.col("site.body0")), "</article>", F.col("site.body1"))
    head = F.concat(F.lit("<body>"), F.replace(F.col("site.head"), F.lit("{i}"), number.cast("string")))
    both = F.array(
        F.struct((number * 2).alias("page_id"), F.col("site.listing").alias("url"), listing.alias("html")),
        F.struct((number * 2 + 1).alias("page_id"), F.concat("site.story", F.lit("/story/"), number).alias("url"), put(article, "<body>", head).alias("html")))
    return pages.withColumn("site", site).select(F.inline(both))
