"""All sources in one job: raw pages to the keyed article table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import dates as D
from newsloom.functions import html as H
from newsloom.functions import tree as R
from newsloom.functions.text import blank_to_null, clean_space, strip_brackets
from newsloom.functions.urls import page_address, resolve_url, url_category
from newsloom.operators import articles as A
from newsloom.operators.discovery import summary
from newsloom.operators.links import attach_card, dedupe_links, extract_cards, resolve_links
from newsloom.operators.tables import upsert_latest
from newsloom.sources.pages import allowed_hosts, with_source

# What is still needed of a rule once the page has been read.
LATE_RULES = (
    "slash", "brackets", "date_clean", "date_default", "blurp_else", "category", "category_map",
    "category_first_tag", "no_category", "tags_lower", "tags_with_category", "skip_reviews",
)

NO_CARD = (
    "struct<title string, url string, blurp string, date_text string, imgurl string, category string, "
    "page_id bigint, pos int>"
)


def card_table(pages: DataFrame, sources: DataFrame, listings: DataFrame) -> DataFrame:
    """Cards of all listing pages with absolute URLs on the source's own hosts, each URL once."""
    cards = extract_cards(with_source(pages, sources), listings)
    address = page_address(F.col("url"), F.col("drop_query"), F.col("force_https"))
    cards = allowed_hosts(resolve_links(cards).withColumn("url", address), sources)
    return dedupe_links(cards, "url", every_visit="every_visit")


def body_text(region: Column, page: Column, rule: Column) -> Column:
    """Body text in the way the source asks for."""
    return F.when(rule["text"] == "main", H.main_text(page)).otherwise(H.joined_text(region, rule["text"]))


def extract_articles(pages: DataFrame, sources: DataFrame, run_date: Column,
                     cards: DataFrame | None = None) -> DataFrame:
    """One row per article page and card, in the common schema plus ``page_id, card_page, card_pos``.

    With ``cards``, only pages that a card leads to are articles, and the card's fields come first.
    Without, every page is an article. Each page is scanned once; the rules that differ by source
    arrive as columns, so the plan stays the same size whatever the number of sources.
    """
    known = with_source(pages, sources).where(F.col("source").isNotNull())
    rule, late, card = F.col("rule"), F.col("late"), F.col("card")
    page, region = F.col("page"), F.col("region")
    cleaned = R.with_tree(known.select(
        "page_id", page_address(F.col("url"), rule["drop_query"], rule["force_https"]).alias("url"), "source", "rule",
        H.strip_markup(F.col("html")).alias("page")), "page")
    # every body element counts, one inside another with it; the line between two ends a paragraph that the first leaves open
    own_body = F.array_join(F.transform(R.inner_markup("rule.body"), lambda e: H.at_depth(e, rule["body_depth"])), "<hr>")
    parts = cleaned.withColumn("region", F.when(rule["text"] != "main", F.when(
        rule["body"].isNull(), H.article_region(page)).otherwise(own_body)))
    picks = ["title", "blurp", "date", "image", "category_page", "category_link", "tags_text"]
    found = parts.select(
        "page_id", "url", "source",
        F.struct(*[rule[name].alias(name) for name in LATE_RULES]).alias("late"),
        F.struct(F.transform(R.fields([f"rule.{name}" for name in picks]), H.unescape_entities).alias("one"),
                 F.transform(R.texts_of("rule.tags_list"), H.unescape_entities).alias("tags")).alias("found"),
        H.page_title(page).alias("page_title"),
        body_text(region, page, rule).alias("body_text"),
        F.when(rule["blurp_else"] == "paragraph", H.first_text(F.get(
            H.paragraphs(F.coalesce(region, H.article_region(page))), F.lit(0)))).alias("first_paragraph"),
        F.when(rule["date_follows"], D.clean_date_text(F.get(
            F.split(page, rule["date"]["opening"], 2), F.lit(1)), rule["date_clean"])).alias("behind"),
    )
    # Cards join what was extracted, not the pages: the markup itself never crosses the network.
    found = found.withColumn("card", F.lit(None).cast(NO_CARD)) if cards is None else attach_card(
        found, cards.select("title", "url", "blurp", "date_text", "imgurl", "category", "page_id", "pos"))

    def field(name: str) -> Column:
        return F.get("found.one", F.lit(picks.index(name)))

    text = F.when(late["brackets"], strip_brackets(F.col("body_text"))).otherwise(F.col("body_text"))
    tags = F.coalesce(A.tag_list(field("tags_text")), F.col("found.tags"))
    fields = found.select(
        "page_id", "url", "source", "late", "card", "first_paragraph",
        F.coalesce(text, F.lit("")).alias("text"),
        A.first_present(card["title"], clean_space(field("title")), F.col("page_title")).alias("title"),
        blank_to_null(clean_space(field("blurp"))).alias("described"),
        F.coalesce(card["date_text"], F.col("behind"), field("date")).alias("date_found"),
        resolve_url(F.coalesce(card["imgurl"], field("image")), F.col("url")).alias("imgurl"),
        F.coalesce(clean_space(field("category_page")), url_category(field("category_link"), True)).alias("page_category"),
        F.when(late["tags_lower"], F.transform(tags, lambda t: F.lower(t))).otherwise(tags).alias("found_tags"),
        F.coalesce(card["category"], url_category(F.col("url"), late["slash"])).alias("segment"),
    ).withColumn("date_text", D.clean_date_text(F.col("date_found"), late["date_clean"]))
    category = F.when(~late["no_category"], A.category(
        late["category"], F.col("page_category"), F.col("segment"),
        F.when(late["category_first_tag"], F.get("found_tags", F.lit(0))), late["category_map"]))
    dated = fields.select(
        "page_id", F.col("card.page_id").alias("card_page"), F.col("card.pos").alias("card_pos"),
        "title", "url", "source", "text", "imgurl", "found_tags", "late",
        category.alias("category"),
        D.default_date(D.parse_date(F.col("date_text")), late["date_default"], run_date).alias("date"),
        A.blurp(card["blurp"], F.col("described"), F.col("text"), F.col("first_paragraph"),
                F.when(late["blurp_else"] == "summary", summary(F.col("text"))),
                late["blurp_else"]).alias("blurp"),
    )
    final = dated.withColumn("tags", F.when(
        late["tags_with_category"],
        F.array_compact(F.array_append(F.col("found_tags"), F.col("category"))),
    ).otherwise(F.col("found_tags")))
    # A page is an article or it is not: at most one struct per row. Tests on the fields stay above
    # the generator, so that Spark never repeats the extraction inside a filter near the scan.
    wanted = ~late["skip_reviews"] | ~A.is_review(F.col("title"))
    return final.select("page_id", "card_page", "card_pos", F.explode(F.when(wanted, F.array(
        F.struct(*A.ARTICLE.names)))).alias("article")).select("page_id", "card_page", "card_pos", "article.*")


def build_articles(pages: DataFrame, sources: DataFrame, run_date: Column,
                   cards: DataFrame | None = None, key: str = "title") -> DataFrame:
    """The article table: the latest page per key, and of its cards the last. The key's shuffle is the only one."""
    order = ["page_id", "card_page", "card_pos", "url", "source"]
    return upsert_latest(extract_articles(pages, sources, run_date, cards), key, order).drop("card_page", "card_pos")
