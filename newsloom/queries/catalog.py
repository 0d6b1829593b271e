"""One query per operator, over the whole test tables.

Where the tables lack a field (images, meta tags, change records), Spark derives the input from
them, row by row, so that the work grows with the table.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom.functions import dates as D
from newsloom.functions import html as H
from newsloom.functions import text as T
from newsloom.functions import urls as U
from newsloom.operators import articles as A
from newsloom.operators import discovery as S
from newsloom.operators import links as L
from newsloom.operators import sinks, tables
from newsloom.operators.block_search import search_blocks, write_blocks
from newsloom.operators.history import add_seen, unseen
from newsloom.operators.periods import distinct_over, term_bitmaps
from newsloom.plans.articles import build_articles, card_table
from newsloom.plans.recommend import recommend
from newsloom.queries.site_pages import site_pages
from newsloom.session import settle, shared_dir, spread, stage
from newsloom.sources import changes as C
from newsloom.sources import pages as P
from newsloom.sources.sites import at, listing_table, site_table
from newsloom.streaming.changes import ChangeCounter, apply_changes_stream, compact_log, counted, counts_of, latest_by_state, read_state, read_stream_state
from newsloom.streaming.links import attach_card_stream, dedupe_links_stream, trending_stream, with_open_windows

RUN_DATE = date(2024, 1, 15)

# Rules for the hosts of the test pages, one text mode each.
TEST_SITES = [
    {"source": "com", "hosts": ["example.com"], "text": "all", "blurp_else": "lead",
     "date_default": "run", "slash": False},
    {"source": "farm", "hosts": ["spam-farm.example.org"], "text": "direct",
     "blurp_else": "paragraph", "date_default": "none", "category": "spam"},
    {"source": "net", "hosts": ["example.net"], "text": "first", "blurp_else": "lead_long",
     "date_default": "month", "skip_reviews": True},
    {"source": "org", "hosts": ["example.org"], "text": "main", "blurp": at("div", "class", "ad"),
     "date_default": "month", "slash": True},
    {"source": "pills", "hosts": ["cheap-pills.example.com"], "text": "all",
     "blurp_else": "lead", "date_default": "run", "no_category": True},
]


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _pages(spark, sf):
    return spread(P.read_pages(spark, f"{sf}/pages.parquet"), "page_id")


def _as_text(query):
    """Dates and timestamps of the result as text, which both engines print alike."""
    return lambda spark, sf: tables.encode_temporal(query(spark, sf))


def _documents(spark, sf):
    return spread(_table(spark, sf, "documents"), "doc_id")


def _nav(spark, sf):
    """Canonical absolute links of all pages."""
    links = L.resolve_links(L.extract_links(_pages(spark, sf)))
    return links.withColumn("url", U.canonical_url(F.col("url")))


def _chain(spark, sf):
    """Edges from each page to the page with the next id."""
    pages = _pages(spark, sf).select("page_id", U.canonical_url(F.col("url")).alias("url"))
    after = pages.select((F.col("page_id") - 1).alias("page_id"), F.col("url").alias("next_url"))
    return pages.join(after, "page_id").select("page_id", F.col("url").alias("page_url"), F.col("next_url").alias("url"))


def read_pages(spark, sf):
    return _pages(spark, sf).select("page_id", "url", F.length("html").cast("long").alias("n_chars"))


def with_source(spark, sf):
    tagged = P.with_source(_pages(spark, sf).select("page_id", "url"), site_table(spark, TEST_SITES))
    return tagged.select("page_id", "url", "source", F.col("rule.text").alias("text_mode"))


def select_source(spark, sf):
    return P.select_source(_documents(spark, sf), "src3").select("doc_id", "source", "lang", "n_chars")


def _sequence(number):
    """Numbers of 41 and more digits that differ in the last ones; some with leading zeros."""
    zeros = F.when(number % 6 < 2, F.lit("00")).otherwise(F.lit(""))
    return F.concat(zeros, F.lit("9" * 37), F.lpad(number.cast("string"), 7, "0"))


def _batches(spark, sf):
    """Each event as a JSON batch: an upsert of its user's item, then a removal after an error."""
    def av(text):
        return F.struct(text.cast("string").alias("S"), F.lit(None).cast("array<struct<S string>>").alias("L"),
                        F.lit(None).cast("boolean").alias("NULL"))

    events = spread(_table(spark, sf, "events"), "event_id")
    key = F.create_map(F.lit("title"), av(F.concat(F.lit("user "), F.col("user_id"))))
    image = F.create_map(
        F.lit("title"), av(F.concat(F.lit("user "), F.col("user_id"))),
        F.lit("date"), av(F.date_format("ts", "dd/MM/yyyy")),
        F.lit("url"), av(F.concat(F.lit("https://example.com/"), F.col("event_id"))),
        F.lit("text"), av(F.col("props")),
        F.lit("category"), av(F.col("event_type")),
        F.lit("tag"), F.struct(
            F.lit(None).cast("string").alias("S"),
            F.array(F.struct(F.col("event_type").alias("S")),
                    F.struct(F.col("user_id").cast("string").alias("S"))).alias("L"),
            F.lit(None).cast("boolean").alias("NULL")),
        F.lit("blurp"), F.struct(
            F.lit(None).cast("string").alias("S"), F.lit(None).cast("array<struct<S string>>").alias("L"),
            F.lit(True).alias("NULL")),
    )

    def record(name, seq, image):
        return F.struct(F.lit(name).alias("eventName"), F.struct(
            seq.cast("string").alias("SequenceNumber"), key.alias("Keys"), image.alias("NewImage")).alias("dynamodb"))

    upsert = record("MODIFY", _sequence(F.col("event_id") * 2), image)
    removal = record("REMOVE", _sequence(F.col("event_id") * 2 + 1), F.when(F.lit(False), image))
    records = F.when(F.col("event_type") == "error", F.array(upsert, removal)).otherwise(F.array(upsert))
    return events.select(F.to_json(F.struct(records.alias("Records"))).alias("value"))


def read_changes(spark, sf):
    found = C.explode_changes(_batches(spark, sf))
    return found.select("event_name", F.col("seq.digits").alias("seq"), F.col("keys")["title"]["S"].alias("title"),
                        F.coalesce(F.size("image"), F.lit(-1)).cast("long").alias("n_fields"))


def _damaged(spark, sf):
    """The batches, some cut off, some with a record that is a number, or a number that is none."""
    number, value = F.col("n"), F.col("value")
    numbered = _batches(spark, sf).withColumn("n", F.regexp_extract("value", r"example\.com/([0-9]+)", 1).cast("long"))
    return numbered.select(
        F.when(number % 7 == 0, F.substr(value, F.lit(1), F.length(value) - 5))
        .when(number % 7 == 1, F.regexp_replace(value, r"^\{\"Records\":\[", '{"Records":[5,'))
        .when(number % 7 == 2, F.regexp_replace(value, '"SequenceNumber":"0*9', '"SequenceNumber":"x'))
        .when(number % 7 == 3, F.lit('{"Other":1}')).otherwise(value).alias("value"))


def sort_changes(spark, sf):
    sound, bad = C.sort_changes(_damaged(spark, sf))
    good = sound.select(F.lit("sound").alias("kind"), F.col("seq.digits").alias("seq"), F.lit(None).cast("string").alias("text"))
    return good.unionByName(bad.select(F.col("reason").alias("kind"), F.lit(None).cast("string").alias("seq"), F.when(
        F.col("reason") == "batch", F.regexp_extract("value", r"example\.com/([0-9]+)", 1)).when(F.col("reason") == "record", F.col("record")).otherwise(
        F.get_json_object("record", "$.dynamodb.SequenceNumber")).alias("text")))


def _decoded(spark, sf):
    return C.decode_attributes(C.explode_changes(_batches(spark, sf)).withColumn(
        "key", F.col("keys")["title"]["S"]).drop("keys"))


def decode_attributes(spark, sf):
    return _decoded(spark, sf).select(
        "event_name", F.col("seq.digits").alias("seq"), "key", "title", "url", "source", "date", "blurp", "text", "imgurl", "category",
        A.join_tags(F.col("tags")).alias("tags"))


def extract_links(spark, sf):
    """The pages' links, after an anchor left open and values without quotes, with a quote and with ``>``."""
    head = F.concat(F.lit('<a class="x>y" href="/open'), "page_id", F.lit("\">one <a href='/b'>two</a><a href=/unq"), "page_id",
                    F.lit("?a=b>three</a><a href=\"/it's\">four</a><A id=z HREF='/x?a>\"b'>five</A ><a name=\"none\">six</a><a href=/it's>seven</a>"))
    return L.extract_links(_pages(spark, sf).withColumn("html", F.concat(head, "html")))


def slice_cards(spark, sf):
    return L.slice_cards(L.extract_links(_pages(spark, sf)), blurp="anchor")


def resolve_url(spark, sf):
    links = L.extract_links(_pages(spark, sf))
    forms = links.select("page_url", F.explode(F.array(
        F.col("href"), F.substr("href", F.lit(2)), F.concat(F.lit("//cdn.example.org"), "href"),
        F.concat(F.lit("https://example.net"), "href"), F.concat(F.lit("?start="), F.col("pos").cast("string")),
    )).alias("href"))
    return L.resolve_links(forms)


def canonical_url(spark, sf):
    return _pages(spark, sf).select("page_id", U.canonical_url(F.col("url")).alias("url"))


def url_category(spark, sf):
    url = U.canonical_url(F.col("url"))
    return _pages(spark, sf).select(
        "page_id", U.url_category(F.col("url")).alias("plain"), U.url_category(url).alias("canonical"),
        U.url_category(url, True).alias("slashed"))


def filter_links(spark, sf):
    return L.filter_links(L.extract_links(_pages(spark, sf)), keep="[aeiou]{2}", starts="/", deny=("th", "é"))


def allowed_hosts(spark, sf):
    sources = site_table(spark, TEST_SITES)
    edges = P.with_source(_chain(spark, sf), sources, "page_url", rules=False)
    return P.allowed_hosts(edges, sources)


def dedupe_links(spark, sf):
    return L.dedupe_links(_nav(spark, sf)).select("url", "page_id", "pos", "anchor")


def dedupe_links_each_visit(spark, sf):
    links = _nav(spark, sf).withColumn("again", F.col("anchor").contains("th"))
    return L.dedupe_links(links, every_visit="again").select("url", "page_id", "pos", "again")


def expand_frontier(spark, sf):
    nav = _nav(spark, sf).select(U.canonical_url(F.col("page_url")).alias("page_url"), "url")
    pages = _pages(spark, sf).select(U.canonical_url(F.col("url")).alias("url"))
    return L.expand_frontier(nav, pages, pages)


def expand_frontier_hops(spark, sf):
    """Three hops along the page chain and the links of each page, from pages with a trailing slash."""
    nav = _nav(spark, sf).select(U.canonical_url(F.col("page_url")).alias("page_url"), "url")
    edges = nav.unionByName(_chain(spark, sf).select("page_url", "url"))
    pages = _pages(spark, sf).select(U.canonical_url(F.col("url")).alias("url"))
    seeds = pages.where(F.col("url").endswith("/"))
    return L.expand_frontier(edges, seeds, seeds, hops=3)


def unseen_links(spark, sf):
    """Links of the pages, then of the page chain, that are new to a history of all pages' addresses and earlier links."""
    root = shared_dir(spark, "seen-links")
    add_seen(_pages(spark, sf).select(U.canonical_url(F.col("url")).alias("url")), root, "pages")
    found = []
    for run, links in (("links", _nav(spark, sf)), ("chain", _chain(spark, sf).select("url").unionByName(_nav(spark, sf).select("url")))):
        new = stage(unseen(links, root), "unseen-links")
        add_seen(new, root, run)
        found.append(new.withColumn("run", F.lit(run)))
    return found[0].unionByName(found[1])


def attach_card(spark, sf):
    pages = _pages(spark, sf).select("page_id", "url")
    cards = pages.select(F.concat(F.lit("card "), F.col("page_id") - 1).alias("title"),
                         F.concat(U.page_address(F.col("url")), F.lit("#top")).alias("url")).where("title <> 'card -1'")
    return L.attach_card(pages, cards).select("page_id", "url", F.col("card.title").alias("card_title"))


def attach_card_stream_query(spark, sf):
    """Each page as a card two hours after midnight and as articles some hours before or after that, on two streams.

    A last row far ahead on either side moves the watermark past all others, so every article leaves.
    """
    root = shared_dir(spark, "card-stream")
    day = F.lit("2024-01-01 00:00:00").cast("timestamp")
    hours = lambda n: F.make_interval(hours=n)
    pages = _pages(spark, sf).select("page_id", "url", (day + hours(F.col("page_id").cast("int"))).alias("at"))
    cards = pages.where("page_id % 3 < 2").select(F.concat(F.lit("card "), "page_id").alias("title"), "url", (F.col("at") + hours(F.lit(2))).alias("seen"))
    fetched = pages.withColumn("at", F.explode(F.array(F.col("at"), F.col("at") + hours(F.lit(4)), F.col("at") + hours(F.lit(40)))))
    ahead = F.lit("2100-01-01 00:00:00").cast("timestamp")
    cards.unionByName(spark.range(1).select(F.lit("none").alias("title"), F.lit("about:end").alias("url"), ahead.alias("seen"))).write.parquet(f"{root}/cards")
    fetched.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("page_id"), F.lit("about:end").alias("url"), ahead.alias("at"))).write.parquet(f"{root}/articles")
    streams = [spark.readStream.schema(spark.read.parquet(f"{root}/{name}").schema).parquet(f"{root}/{name}") for name in ("articles", "cards")]
    joined = attach_card_stream(*streams, "at", "seen").select("page_id", "url", F.date_format("at", "yyyy-MM-dd HH:mm").alias("at"), F.col("card.title").alias("card_title"))
    joined.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint") \
        .trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").where("page_id >= 0")


def _clean(spark, sf):
    return _pages(spark, sf).select("page_id", "url", H.strip_markup(F.col("html")).alias("html"))


def _region(spark, sf):
    return _clean(spark, sf).select("page_id", H.article_region(F.col("html")).alias("html"))


def strip_markup(spark, sf):
    return _clean(spark, sf).select("page_id", "html")


def body_text_all(spark, sf):
    return _region(spark, sf).select("page_id", H.body_text_all(F.col("html")).alias("text"))


def body_text_first(spark, sf):
    return _region(spark, sf).select("page_id", H.body_text_first(F.col("html")).alias("text"))


def body_text_direct(spark, sf):
    return _region(spark, sf).select("page_id", H.body_text_direct(F.col("html")).alias("text"))


def main_text(spark, sf):
    return _clean(spark, sf).select("page_id", H.main_text(F.col("html")).alias("text"))


def dense_text(spark, sf):
    return _clean(spark, sf).select("page_id", H.dense_text(F.col("html")).alias("text"))


def scored_text(spark, sf):
    return _clean(spark, sf).select("page_id", H.scored_text(F.col("html")).alias("text"))


def page_title(spark, sf):
    return _clean(spark, sf).select("page_id", H.page_title(F.col("html")).alias("title"))


def _with_fields(spark, sf):
    """Pages with meta tags and images made from their own id and URL."""
    head = F.concat(
        F.lit('<head><meta content="/img/'), "page_id", F.lit('.png" property="og:image"><meta property=\'article:section\' content=\''),
        U.host(F.col("url")), F.lit('\'><link rel="image_src" href="'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('">'))
    image = F.concat(
        F.lit('<article class="post"><img class="x" '),
        F.when(F.col("url").startswith("https"), F.concat(F.lit('data-original="/lazy/'), "page_id", F.lit('.jpg" '))).otherwise(F.lit("")),
        F.lit('src="//cdn.example.org/'), "page_id", F.lit('.jpg">'))
    html = F.replace(F.replace("html", F.lit("<head>"), head), F.lit("<article>"), image)
    return _pages(spark, sf).select("page_id", "url", html.alias("html"))


def meta_content(spark, sf):
    html = F.col("html")
    return _with_fields(spark, sf).select(
        "page_id",
        H.meta_content(html, "property", "og:image").alias("image"),
        H.meta_content(html, "property", "section", contains=True).alias("section"),
        H.meta_content(html, "rel", "image_src", tag="link", read="href").alias("link_image"),
        H.meta_content(html, "name", "keywords").alias("keywords"))


def lead_image(spark, sf):
    return _with_fields(spark, sf).select(
        "page_id", H.lead_image(F.col("html"), F.col("url")).alias("imgurl"))


def strip_brackets(spark, sf):
    text = F.col("text")
    noisy = F.concat(F.substring(text, 1, 20), F.lit(" [note] "), F.substr(text, F.lit(21)), F.lit(" [x]\n"), text)
    return _documents(spark, sf).select("doc_id", T.strip_brackets(noisy).alias("text"))


def clean_space(spark, sf):
    padded = F.concat(F.lit("\n \t\u00a0 "), "text", F.lit("\u2003\u3000 \r\n"))
    return _documents(spark, sf).select(
        "doc_id", T.clean_space(padded).alias("both"), T.clean_space(padded, left_only=True).alias("left_only"))


def unescape_entities(spark, sf):
    """The pages, with references of many digits and beyond the last code point in front."""
    head = F.concat(F.lit("&#"), F.repeat(F.lit("0"), F.col("page_id") % 12 + 1), F.lit("65;&#X"),
                    F.repeat(F.lit("0"), F.col("page_id") % 9), F.lit("42;&#99999999;&#x110000;"))
    return _pages(spark, sf).select("page_id", H.unescape_entities(F.concat(head, "html")).alias("html"))


def unescape_html5(spark, sf):
    return _pages(spark, sf).select("page_id", H.unescape_html5(F.col("html")).alias("html"))


def _dated(spark, sf):
    layout = F.element_at(F.array(*[F.lit(x) for x in D.DATE_LAYOUTS]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    text = F.coalesce(*[F.when(layout == x, F.date_format("o_orderdate", x)) for x in D.DATE_LAYOUTS])
    return _table(spark, sf, "orders").select("o_orderkey", "o_orderdate", layout.alias("layout"), text.alias("text"))


def parse_date(spark, sf):
    return _dated(spark, sf).select("o_orderkey", D.parse_date(F.col("text")).alias("day"))


def clean_date_text(spark, sf):
    mode = F.element_at(F.array(*[F.lit(x) for x in ("iso", "month_day", "byline", "drop", "byline")]),
                        (F.col("o_orderkey") % 5 + 1).cast("int"))
    noisy = (
        F.when(mode == "iso", F.concat("text", F.lit("T00:00:00")))
        .when(mode == "month_day", F.concat(F.lit("Updated: "), "text", F.lit(" at noon")))
        .when(mode == "drop", F.concat(F.lit("\n\t"), "text", F.lit("\n")))
        .otherwise(F.concat(F.lit("By A Writer | "), "text", F.lit(" | News")))
    )
    cleaned = _dated(spark, sf).select("o_orderkey", D.clean_date_text(noisy, mode).alias("text"))
    return cleaned.withColumn("day", D.parse_date(F.col("text")))


def default_date(spark, sf):
    text = F.when(F.col("o_orderkey") % 7 != 0, F.col("text"))
    policy = F.element_at(F.array(F.lit("run"), F.lit("month"), F.lit("none")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    day = D.default_date(D.parse_date(text), policy, F.lit(RUN_DATE))
    return _dated(spark, sf).select("o_orderkey", day.alias("day"), D.format_date(day).alias("printed"))


def blurp(spark, sf):
    region = H.article_region(F.col("html"))
    texts = _clean(spark, sf).select(
        "page_id", "url", H.body_text_all(region).alias("text"),
        H.first_text(F.get(H.paragraphs(region), F.lit(0))).alias("first_paragraph"),
        H.extract(F.col("html"), '(?is)<div class="ad">(.*?)</div>').alias("ad"))
    fallback = F.when(F.col("url").startswith("https"), "lead").otherwise("paragraph")
    card = F.when(F.col("url").contains("#"), F.lit(""))
    described = F.when(F.col("url").contains("?"), F.col("ad"))
    return texts.select("page_id", A.blurp(
        card, described, F.col("text"), F.col("first_paragraph"), F.lit(None).cast("string"), fallback).alias("blurp"))


def lead_sentences(spark, sf):
    return _documents(spark, sf).select(
        "doc_id", T.lead_sentences(F.col("text")).alias("lead"),
        T.lead_sentences(F.col("text"), longer_than=50).alias("lead_if_long"))


def category(spark, sf):
    segment = U.url_category(U.canonical_url(F.col("url")))
    tagged = P.with_source(_clean(spark, sf), site_table(spark, TEST_SITES))
    found = A.category(
        F.col("rule.category"), F.when(F.col("source") == "net", H.extract(F.col("html"), '(?i)<html lang="([a-z]+)"')),
        segment, F.when(F.col("source") == "com", F.lit("first")), F.create_map(F.lit("first"), F.lit("leading")))
    return tagged.select("page_id", "source", F.when(F.col("source") != "pills", found).alias("category"))


def normalise_tags(spark, sf):
    form = F.col("p_partkey") % 3
    words = F.split("p_name", " ")
    text = F.when(form == 0, F.array_join(F.transform(words, F.initcap), ", "))
    tags = A.normalise_tags(text, F.when(form == 1, words), F.lower("p_type"))
    return _table(spark, sf, "part").select("p_partkey", A.join_tags(tags).alias("tags"))


def filter_titles(spark, sf):
    titled = _clean(spark, sf).select("page_id", H.page_title(F.col("html")).alias("title"))
    return A.filter_titles(settle(titled, "title"))


def filter_titles_documents(spark, sf):
    return A.filter_titles(_documents(spark, sf).select("doc_id", F.col("text").alias("title")))


def conform_union(spark, sf):
    pages = _clean(spark, sf).select(
        H.page_title(F.col("html")).alias("title"), "url", F.lit("pages").alias("source"))
    documents = _documents(spark, sf).select(
        F.concat(F.lit("document "), "doc_id").alias("title"), "text", "source", F.col("lang").alias("category"),
        F.lit(RUN_DATE).alias("date"))
    both = A.conform_union([pages, documents])
    return both.withColumn("tags", A.join_tags(F.col("tags")))


def _site_pages(spark, sf):
    return site_pages(_pages(spark, sf))


def _site_cards(spark, sf):
    pages, sites = _site_pages(spark, sf), site_table(spark)
    return card_table(pages, sites, listing_table(spark))


def extract_cards(spark, sf):
    return _site_cards(spark, sf).select("page_id", "source", "pos", "url", "title", "blurp", "date_text", "imgurl", "category")


def build_articles_cards(spark, sf):
    built = build_articles(_site_pages(spark, sf), site_table(spark), F.lit(RUN_DATE), _site_cards(spark, sf))
    return tables.to_export(built)


def build_articles_query(spark, sf):
    built = build_articles(_pages(spark, sf), site_table(spark, TEST_SITES), F.lit(RUN_DATE))
    return built.select("title", "url", "source", "date", "category", "blurp", "text")


def upsert_latest(spark, sf):
    titled = _clean(spark, sf).select("page_id", "url", H.page_title(F.col("html")).alias("title"))
    return tables.upsert_latest(settle(titled, "title"), "title", "page_id")


def _event_changes(spark, sf):
    op = F.when(F.col("event_type") == "error", "REMOVE").otherwise("MODIFY")
    return _table(spark, sf, "events").select(
        "user_id", F.col("event_id").alias("seq"), op.alias("event_name"), "event_type", "value")


def apply_changes(spark, sf):
    """By sequence numbers of over 40 digits, whose last digits decide."""
    changes = _event_changes(spark, sf).withColumn("order", C.sequence_order(_sequence(F.col("seq"))))
    return tables.apply_changes(changes, "user_id", "order").drop("order")


def apply_changes_stream_query(spark, sf):
    """The events as a stream in four quarters, a batch each, with a compaction after the second; read back as state."""
    events, root = _table(spark, sf, "events"), shared_dir(spark, "change-log")
    op = F.when(F.col("event_type") == "error", "REMOVE").otherwise("MODIFY")
    for part in range(4):
        events.where(F.col("event_id") % 4 == part).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
        changes = stream.select("user_id", F.col("event_id").alias("seq"), op.alias("event_name"), "event_type", "value")
        apply_changes_stream(changes, f"{root}/log", f"{root}/checkpoint", "user_id").awaitTermination()
        if part == 1:
            compact_log(spark, f"{root}/log", "user_id")
    return read_state(spark, f"{root}/log", "user_id").select("user_id", "seq", "event_name", "event_type", "value")


def apply_changes_state(spark, sf):
    """The same by the stream's own state: four quarters, a run each from the same checkpoint, the newest first."""
    events, root = _table(spark, sf, "events"), shared_dir(spark, "change-state")
    op = F.when(F.col("event_type") == "error", "REMOVE").otherwise("MODIFY")
    store = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    with_conf = spark.newSession()
    with_conf.conf.set("spark.sql.streaming.stateStore.providerClass", store)
    for part in (3, 1, 0, 2):
        events.where(F.col("event_id") % 4 == part).write.mode("append").parquet(f"{root}/in")
        stream = with_conf.readStream.schema(events.schema).parquet(f"{root}/in")
        changes = stream.select("user_id", F.col("event_id").alias("seq"), op.alias("event_name"), "event_type", "value")
        latest_by_state(changes, f"{root}/checkpoint", "user_id").awaitTermination()
    return read_stream_state(with_conf, f"{root}/checkpoint", "user_id").select("user_id", "seq", "event_name", "event_type", "value")


def to_search_doc(spark, sf):
    return tables.to_search_doc(tables.apply_changes(_decoded(spark, sf), "key"))


def change_counts(spark, sf):
    return tables.change_counts(_event_changes(spark, sf))


def change_counts_stream(spark, sf):
    """The events as a stream, stopped and started again, counted batch by batch while it runs."""
    events, root = _table(spark, sf, "events"), shared_dir(spark, "counted-stream")
    op = F.when(F.col("event_type") == "error", "REMOVE").otherwise("MODIFY")
    counter = ChangeCounter(spark, f"{root}/counts")
    spark.streams.addListener(counter)
    try:
        for part in range(3):
            events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(f"{root}/in")
            stream = spark.readStream.schema(events.schema).parquet(f"{root}/in")
            changes = counted(stream.select("user_id", F.col("event_id").alias("seq"), op.alias("event_name")))
            counter.wait(apply_changes_stream(changes, f"{root}/log", f"{root}/checkpoint", "user_id"))
    finally:
        spark.streams.removeListener(counter)
    counts = counts_of(spark, f"{root}/counts")
    both = F.array(F.struct(F.lit("MODIFY").alias("event_name"), F.col("upserted").alias("n")), F.struct(F.lit("REMOVE").alias("event_name"), F.col("removed").alias("n")))
    return counts.select(F.inline(both)).groupBy("event_name").agg(F.sum("n").alias("n")).where("n > 0")


def write_jsonl(spark, sf):
    path = shared_dir(spark, "jsonl") + ".gz"
    documents = _documents(spark, sf)
    for _ in range(2):  # a repeated run replaces the first
        sinks.write_jsonl(documents, path, mode="overwrite")
    return spark.read.schema(documents.schema).json(path)


def write_feed(spark, sf):
    root = shared_dir(spark, "feed")
    documents = _documents(spark, sf)
    for _ in range(2):  # a repeated run replaces its own folders
        sinks.write_feed(documents, root, "2024-01-15T00:00:00")
    return spark.read.schema(documents.drop("source").schema).json(root).select(
        "doc_id", "text", "lang", "n_chars", "source", "run_ts")


def write_feed_chunks(spark, sf):
    numbered = sinks.with_row_offset(_documents(spark, sf), "source", ["doc_id"])
    return numbered.select("source", "doc_id", "offset", "row")


def encode_temporal(spark, sf):
    return tables.encode_temporal(_table(spark, sf, "events").withColumn("day", F.to_date("ts")))


def keywords(spark, sf):
    return S.keywords(_documents(spark, sf))


def summary(spark, sf):
    return S.summarise(_documents(spark, sf))


def trending(spark, sf):
    return S.trending(S.keywords(_documents(spark, sf)), k=20)


def trending_daily(spark, sf):
    day = F.date_add(F.lit(date(2024, 1, 1)), (F.col("doc_id") % 28).cast("int"))
    documents = _documents(spark, sf).withColumn("day", day)
    return S.trending(S.keywords(documents, keep=("day",)), k=5, period="day")


def trending_hourly(spark, sf):
    events = _table(spark, sf, "events").select(
        F.floor(F.unix_timestamp(F.col("ts").cast("timestamp")) / 3600).alias("hour"), F.col("event_type").alias("term"))
    return S.trending(events, k=3, period="hour")


def trending_stream_query(spark, sf):
    """The events as a stream, counted per day and type: closed windows by the stream, open ones from the rows."""
    schema = _table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    terms = stream.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("term"))
    root = shared_dir(spark, "trending")
    query = (
        trending_stream(terms, "ts").writeStream.format("parquet").outputMode("append")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = _table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("term"))
    return with_open_windows(spark.read.parquet(f"{root}/out"), rows, "ts")


def trending_periods(spark, sf):
    """Keywords of articles that come twice, some hours apart: different articles in every 24 hours."""
    words = S.keywords(_documents(spark, sf)).where("rank <= 3").select("doc_id", "term")
    first = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=(F.col("doc_id") % 60).cast("int"))
    seen = F.explode(F.array(first, first + F.make_interval(hours=(F.col("doc_id") % 7 * 5).cast("int"))))
    bitmaps = stage(term_bitmaps(words.withColumn("at", seen), "at"), "term-bitmaps")
    return distinct_over(bitmaps, 24).select(F.date_format("start", "yyyy-MM-dd HH:mm").alias("start"), "term", "n")


def dedupe_links_stream_query(spark, sf):
    """The events as a stream of visits, each user once within the watermark."""
    schema = _table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
    visits = stream.select(F.col("ts").cast("timestamp").alias("ts"), F.concat(F.lit("https://example.com/"), "user_id").alias("url"))
    root = shared_dir(spark, "visits")
    query = (
        dedupe_links_stream(visits, "ts", delay="60 days").writeStream.format("parquet")
        .option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.schema("url string").parquet(f"{root}/out")


def search(spark, sf):
    documents = _documents(spark, sf)
    queries = _table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    size = Observation()
    return S.search(S.postings(documents, size=size), size, S.query_terms(queries))


def search_index(spark, sf):
    """The same on a stored index and a stored corpus size."""
    documents, root = _documents(spark, sf), shared_dir(spark, "index")
    S.write_postings(S.postings(documents), f"{root}/postings")
    stored = stage(S.corpus_size(documents), "corpus-size")
    queries = _table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return S.search(spark.read.parquet(f"{root}/postings"), stored, S.query_terms(queries))


def search_by_blocks(spark, sf):
    """The same by an index of blocks, of which those out of reach stay unread."""
    documents, root = _documents(spark, sf), shared_dir(spark, "blocks")
    size = stage(S.corpus_size(documents), "corpus-size")
    write_blocks(documents, size, f"{root}/blocks")
    queries = _table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return search_blocks(spark.read.parquet(f"{root}/blocks"), size, S.query_terms(queries))


def recommend_query(spark, sf):
    return recommend(_documents(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "a01_read_pages": read_pages,
    "a02_with_source": with_source,
    "a03_select_source": select_source,
    "a04_read_changes": read_changes,
    "a04_sort_changes": sort_changes,
    "a05_decode_attributes": _as_text(decode_attributes),
    "b01_extract_links": extract_links,
    "b01_extract_cards": extract_cards,
    "b02_slice_cards": slice_cards,
    "b03_resolve_url": resolve_url,
    "b04_canonical_url": canonical_url,
    "b05_url_category": url_category,
    "b06_filter_links": filter_links,
    "b07_allowed_hosts": allowed_hosts,
    "b08_dedupe_links": dedupe_links,
    "b08_dedupe_links_each_visit": dedupe_links_each_visit,
    "b08_dedupe_links_stream": dedupe_links_stream_query,
    "b09_expand_frontier": expand_frontier,
    "b09_expand_frontier_hops": expand_frontier_hops,
    "b09_unseen_links": unseen_links,
    "b10_attach_card": attach_card,
    "b10_attach_card_stream": attach_card_stream_query,
    "c01_strip_markup": strip_markup,
    "c02_body_text_all": body_text_all,
    "c02_body_text_direct": body_text_direct,
    "c03_body_text_first": body_text_first,
    "c04_main_text": main_text,
    "c04_dense_text": dense_text,
    "c04_scored_text": scored_text,
    "c05_page_title": page_title,
    "c06_meta_content": meta_content,
    "c07_lead_image": lead_image,
    "c08_strip_brackets": strip_brackets,
    "c09_clean_space": clean_space,
    "c10_unescape_entities": unescape_entities,
    "c10_unescape_html5": unescape_html5,
    "d01_parse_date": _as_text(parse_date),
    "d02_clean_date_text": _as_text(clean_date_text),
    "d03_default_date": _as_text(default_date),
    "d04_blurp": blurp,
    "d05_lead_sentences": lead_sentences,
    "d06_category": category,
    "d07_normalise_tags": normalise_tags,
    "d08_filter_titles": filter_titles,
    "d08_filter_titles_documents": filter_titles_documents,
    "d09_conform_union": _as_text(conform_union),
    "d10_build_articles_cards": build_articles_cards,
    "d10_build_articles": _as_text(build_articles_query),
    "e01_upsert_latest": upsert_latest,
    "e02_apply_changes": apply_changes,
    "e03_apply_changes_stream": apply_changes_stream_query,
    "e03_apply_changes_state": apply_changes_state,
    "e04_to_search_doc": to_search_doc,
    "e05_change_counts": change_counts,
    "e05_change_counts_stream": change_counts_stream,
    "e06_write_jsonl": write_jsonl,
    "e07_write_feed": write_feed,
    "e07_write_feed_chunks": write_feed_chunks,
    "e08_encode_temporal": encode_temporal,
    "f01_keywords": keywords,
    "f02_summary": summary,
    "f03_trending": trending,
    "f03_trending_daily": _as_text(trending_daily),
    "f03_trending_hourly": trending_hourly,
    "f03_trending_stream": _as_text(trending_stream_query),
    "f03_trending_periods": trending_periods,
    "f04_search": search,
    "f04_search_index": search_index,
    "f04_search_blocks": search_by_blocks,
    "f05_recommend": recommend_query,
}
