"""The rules of each site, as data.

A field rule is ``(tag, attribute, value)`` for the element that holds the field, with options:
``child`` (a tag inside it), ``read`` (an attribute instead of text), ``contains`` (the value is a
part of the attribute) and ``every`` (all text nodes, not only the first).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.html import opening_tag


def at(tag: str, attr: str | None = None, value: str | None = None, *, child: str | None = None,
       read: str | None = None, contains: bool = False, every: bool = False) -> dict:
    """One field rule."""
    return {"opening": opening_tag(tag, attr, value, contains), "tag": tag, "child": child,
            "attr": read, "every": every}


# One entry per site, in alphabetical order. They must equal what the sites use.
#   start: listing pages to begin with; next: link to the next listing page, next_stop: not this one
#   text: all | first | direct | region | main        date_default: run | month | none
#   date_clean: iso | month_day | iso_search | drop | byline
#   body_depth: only paragraphs so many elements below the body count (0: its own children)
#   drop_query, force_https: how the source's addresses are written; else they stay, but for fragments
#   blurp_else: what stands in for a missing blurp: lead | lead_long | paragraph | summary
SITES = [
    {
        "source": "aljazeera", "hosts": ["aljazeera.com"],
        "start": ["https://www.aljazeera.com/tag/technology/",
                  "https://www.aljazeera.com/tag/Cybersecurity/",
                  "https://www.aljazeera.com/tag/Crypto/"],
        "text": "main", "date": at("meta", "property", "article:published_time", read="content"),
        "date_clean": "iso", "date_default": "run",
        "image": at("meta", "property", "og:image", read="content"),
    },
    {
        "source": "apnews", "hosts": ["apnews.com"],
        "start": ["https://apnews.com/hub/technology/"],
        "body": at("div", "data-key", "article"), "text": "all",
        "date_clean": "iso", "date_default": "run",
        "image": at("meta", "property", "url", contains=True, read="content"),
    },
    {
        "source": "cio", "hosts": ["cio.com"], "slash": True,
        "start": ["https://www.cio.com/asean/category/analytics",
                  "https://www.cio.com/asean/category/cloud-computing",
                  "https://www.cio.com/asean/"],
        "body": at("div", "itemprop", "articleBody"), "text": "first", "body_depth": 0,
        "date": at("span", "class", "pub-date", read="content"),
        "date_clean": "iso", "date_default": "month",
        "blurp": at("h3", "itemprop", "description"),
        "image": at("img", "data-original", read="data-original"),
        "tags_text": at("meta", "itemprop", "keywords", read="content"),
        "next": at("a", "id", "load-more-index", read="href"), "next_stop": "?start=40",
    },
    {
        "source": "govinsider", "hosts": ["govinsider.asia"],
        "start": ["https://www.govinsider.asia/"],
        "body": at("div", "class", "entry-content post-content"), "text": "first", "body_depth": 0,
        "date": at("time", "class", "updated"), "date_clean": "plain", "date_default": "run",
        "blurp_else": "lead_long",
        "image": at("meta", "property", "og:image", read="content"),
        "category_page": at("div", "class", "post-meta", child="a"),
    },
    {
        "source": "govtech", "hosts": ["govtech.com"],
        "start": ["https://www.govtech.com/security/",
                  "https://www.govtech.com/biz/",
                  "https://www.govtech.com/products/",
                  "https://www.govtech.com/gov-experience/"],
        "body": at("div", "id", "article_body"), "text": "all",
        "date": at("span", "class", "date"), "date_clean": "plain", "date_default": "month",
        "blurp": at("p", "class", "description"),
        "image": at("div", "id", "feature_image", child="amp-img", read="src"),
    },
    {
        "source": "guardian", "hosts": ["theguardian.com"],
        "start": ["https://www.theguardian.com/technology/all",
                  "https://www.theguardian.com/uk/technology"],
        "text": "main", "date": at("meta", "property", "article:published_time", read="content"),
        "date_clean": "iso", "date_default": "run", "skip_reviews": True,
        "blurp": at("div", "class", "css-zjgnrw", child="p"),
        "image": at("meta", "property", "og:image", read="content"),
        "category_page": at("li", "class", "css-blajdl", child="a"),
        "tags_list": at("li", "class", "css-184iqxr", child="a"), "tags_with_category": True,
    },
    {
        "source": "infoworld", "hosts": ["infoworld.com"],
        "start": ["https://www.infoworld.com/category/analytics/",
                  "https://www.infoworld.com/category/machine-learning/",
                  "https://www.infoworld.com/category/software-development/",
                  "https://www.infoworld.com/category/cloud-computing/"],
        "title": at("h1", "itemprop", "headline"),
        "body": at("div", "itemprop", "articleBody"), "text": "region", "brackets": True,
        "date": at("span", "class", "pub-date", read="content"),
        "date_clean": "iso", "date_default": "month",
        "blurp": at("h3", "itemprop", "description"),
        "image": at("img", "itemprop", "contentUrl", read="data-original"),
        "tags_list": at("span", "class", "primary-cat-name2"),
    },
    {
        "source": "khaleej", "hosts": ["khaleejtimes.com"],
        "start": ["https://www.khaleejtimes.com/technology"],
        "body": at("div", "class", "articlepage_content_zz", contains=True), "text": "all",
        "date": at("div", "class", "author_detail", every=True),
        "date_clean": "month_day", "date_default": "month",
        "blurp": at("div", "class", "articlepage_summary", child="h2"),
        "image": at("div", "class", "main_article_img_main", child="img", read="src"),
        "category": "technology",
    },
    {
        "source": "nytimes", "hosts": ["nytimes.com"], "slash": True,
        "start": ["https://www.nytimes.com/section/technology"],
        "text": "main", "date": at("meta", "property", "article:published_time", read="content"),
        "date_clean": "iso", "date_default": "run", "blurp_else": "summary",
        "image": at("meta", "property", "og:image", read="content"),
        "category_link": at("span", "class", "css-17xtcya", child="a", read="href"),
    },
    {
        "source": "opengov", "hosts": ["opengovasia.com"],
        "start": ["https://www.opengovasia.com"], "force_https": True,
        "body": at("div", "class", "theme-post-content", contains=True), "text": "first", "body_depth": 1,
        "date": at("span", "class", "item--type-date", contains=True),
        "date_clean": "drop", "date_default": "none", "blurp_else": "lead",
        "image": at("div", "class", "image", contains=True, child="img", read="src"),
        "category_page": at("meta", "property", "article:section", read="content"),
    },
    {
        "source": "shanghai", "hosts": ["shine.cn"],
        "start": ["https://www.shine.cn/news/nation/",
                  "https://www.shine.cn/biz/tech/"],
        "body": at("div", "class", "content"), "text": "all",
        "date": at("span", "class", "glyphicon glyphicon-time"),
        "date_clean": "iso_search", "date_default": "month", "date_follows": True,
        "blurp": at("div", "class", "caption", child="p"), "blurp_else": "paragraph",
        "category_map": {"tech": "technology"},
    },
    {
        "source": "techcrunch", "hosts": ["techcrunch.com"],
        "start": ["https://techcrunch.com/"],
        "body": at("div", "class", "article-content"), "text": "direct",
        "date_clean": "iso", "date_default": "month",
        "blurp": at("p", "id", "speakable-summary", every=True), "blurp_else": "paragraph",
        "image": at("div", "class", "article__featured-image", contains=True, child="img", read="src"),
        "tags_text": at("meta", "name", "sailthru.tags", read="content"),
        "no_category": True,
    },
    {
        "source": "techwire", "hosts": ["techwireasia.com"],
        "start": ["https://www.techwireasia.com"],
        "body": at("div", "class", "large-7 medium-7 columns single-content", contains=True),
        "text": "first", "body_depth": 0,
        "date_clean": "byline", "date_default": "month", "blurp_else": "lead",
        "image": at("div", "class", "main-post-thumbnail", contains=True, child="img", read="src"),
        "tags_list": at("div", "class", "tags-panel", child="span", every=True),
        "tags_lower": True, "category_first_tag": True,
    },
    {
        "source": "yonhap", "hosts": ["en.yna.co.kr"],
        "start": ["https://en.yna.co.kr/business/it"],
        "body": at("div", "class", "inner"), "text": "all",
        "date": at("span", "class", "txt"),
        "date_clean": "month_day", "date_default": "month", "blurp_else": "paragraph",
        "image": at("link", "rel", "image_src", read="href"),
        "category": "technology",
    },
]

# Where each site's listing pages hold their cards, in the same order.
#   page: pattern of listing URLs the layout belongs to; deny/keep/starts: link tests;
#   skip_at: card position that is left out; bare_head: first cards that carry no blurp;
#   first_only: the first card alone; drop_query: the card's address is written without its query.
LISTINGS = [
    {"source": "aljazeera", "card": at("div", "class", "gc__content"),
     "link": at("a", read="href"), "title": at("a", child="span"),
     "blurp": at("div", "class", "gc__excerpt", child="p"), "every_visit": True},
    {"source": "apnews", "card": at("div", "data-key", "feed-card-wire-story-with-image"),
     "link": at("a", read="href"), "title": at("h1", "class", "Component-h1-0-2-42"),
     "blurp": at("p"), "date": at("span", "data-source", read="data-source"),
     "every_visit": True},
    {"source": "cio", "page": "/category/", "container": at("div", "class", "main-col"),
     "children": "div",
     "link": at("h3", child="a", read="href"), "title": at("h3", child="a"), "blurp": at("h4"),
     "deny": "video", "skip_at": 2, "bare_head": 2},
    {"source": "cio", "page": "/asean/$", "card": at("div", "class", "post-cont"),
     "link": at("h3", child="a", read="href"), "title": at("h3", child="a"), "blurp": at("h4"),
     "deny": "video"},
    {"source": "govinsider", "card": at("h2", "class", "entry-title", contains=True),
     "link": at("a", read="href"), "title": at("a"),
     "after_blurp": at("div", "class", "entry-summary", contains=True, child="p")},
    {"source": "govtech", "card": at("div", "class", "feature-article"),
     "link": at("a", read="href"), "title": at("h1", child="a"), "first_only": True},
    {"source": "govtech", "card": at("div", "class", "sub-feature-article"),
     "link": at("h2", child="a", read="href"), "title": at("h2", child="a"), "drop_query": True},
    {"source": "guardian", "page": "uk/technology",
     "container": at("div", "class", "fc-item__container"), "card": at("a"),
     "link": at("a", read="href"), "keep": "technology", "deny": "/video/|/gallery/"},
    {"source": "guardian", "page": "technology/all", "card": at("h3", "class", "fc-item__title"),
     "link": at("a", read="href")},
    {"source": "infoworld", "container": at("div", "class", "river-well article"), "card": at("h3"),
     "link": at("a", read="href"), "keep": "^/article/"},
    {"source": "khaleej", "card": at("div", "class", "listing_main_news"),
     "link": at("h1", child="a", read="href"), "title": at("h1", child="a"), "first_only": True},
    {"source": "khaleej", "container": at("div", "class", "liting_list"), "card": at("h2"),
     "link": at("a", read="href"), "title": at("a")},
    {"source": "nytimes", "card": at("h2", "class", "css-4tvmog eecsw3u0"),
     "link": at("a", read="href"), "title": at("a"),
     "blurp": at("p", "class", "css-1jhf0lz eecsw3u1"), "every_visit": True, "first_only": True},
    {"source": "nytimes", "card": at("article", "class", "css-imuvyx"),
     "link": at("a", read="href"), "title": at("a"),
     "blurp": at("p", "class", "css-1jhf0lz eecsw3u3"), "every_visit": True},
    {"source": "nytimes", "card": at("li", "class", "css-ye6x8s"),
     "link": at("a", read="href"), "title": at("h2"), "blurp": at("p"), "every_visit": True},
    {"source": "opengov", "card": at("div", "class", "elementor-post__text"),
     "link": at("h3", child="a", read="href"), "title": at("h3", child="a")},
    {"source": "opengov", "card": at("h1", "class", "elementor-heading-title elementor-size-default"),
     "link": at("a", read="href"), "title": at("a"), "every_visit": True},
    {"source": "shanghai", "card": at("div", "class", "list-story"),
     "link": at("a", read="href"), "title": at("div", "class", "list-card-text", child="h2"),
     "image": at("img", "data-original", read="data-original")},
    {"source": "techcrunch", "card": at("header", "class", "post-block__header"),
     "link": at("a", read="href"), "title": at("a"),
     "date": at("time", "datetime", read="datetime"), "min_cards": 2},
    {"source": "techwire", "card": at("article", "role", "article"),
     "link": at("a", read="href"), "title": at("a", "title", read="title"),
     "date": at("p", "class", "byline", every=True), "every_visit": True},
    {"source": "yonhap", "card": at("h2", "class", "tit"),
     "link": at("a", read="href"), "title": at("a")},
]

FIELD = "struct<opening string, tag string, child string, attr string, every boolean>"
SITE_SCHEMA = (
    f"source string, hosts array<string>, start array<string>, next {FIELD}, next_stop string, slash boolean, title {FIELD}, body {FIELD}, text string, "
    f"brackets boolean, date {FIELD}, date_follows boolean, date_clean string, date_default string, "
    f"blurp {FIELD}, blurp_else string, image {FIELD}, category string, category_page {FIELD}, "
    f"category_link {FIELD}, category_map map<string, string>, category_first_tag boolean, "
    f"no_category boolean, tags_text {FIELD}, tags_list {FIELD}, tags_lower boolean, "
    "tags_with_category boolean, skip_reviews boolean, drop_query boolean, force_https boolean, body_depth int"
)
LISTING_SCHEMA = (
    f"source string, page string, container {FIELD}, children string, card {FIELD}, min_cards int, link {FIELD}, title {FIELD}, "
    f"blurp {FIELD}, after_blurp {FIELD}, date {FIELD}, image {FIELD}, keep string, deny string, "
    "skip_at int, bare_head int, every_visit boolean, drop_query boolean, first_only boolean"
)


def _table(spark: SparkSession, rows: Iterable[Mapping], schema: str) -> DataFrame:
    names = spark.createDataFrame([], schema).schema
    flags = {f.name for f in names if f.dataType.simpleString() == "boolean"}
    return spark.createDataFrame(
        [tuple(row.get(n, False if n in flags else None) for n in names.names) for row in rows], names
    ).coalesce(1)


def site_table(spark: SparkSession, sites: Iterable[Mapping] = SITES) -> DataFrame:
    """The ``sources`` dimension: one row of rules per site."""
    return _table(spark, sites, SITE_SCHEMA)


def start_pages(sources: DataFrame) -> DataFrame:
    """The listing pages each source begins with: ``source, url``."""
    return sources.select("source", F.explode("start").alias("url"))


def listing_table(spark: SparkSession, listings: Iterable[Mapping] = LISTINGS) -> DataFrame:
    """Card layouts: one row per layout, several for some sites."""
    return _table(spark, listings, LISTING_SCHEMA)
