"""Link discovery: cards and links of pages, link tests, first visits, the frontier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions import html as H
from newsloom.functions.text import blank_to_null, clean_space, let
from newsloom.functions.tree import card_regions, fields, fields_each, with_tree
from newsloom.functions.urls import page_address, resolve_url, url_category
from newsloom.session import broadcast_if_small, ensure_checkpoint_dir, settle, stage

ANCHOR = r"(?i)(?=<a[\s>/])"
# An opening tag in which a value may hold ``>``: values in quotes, values without, other characters.
ANCHOR_TAG = r"(?is)^<a\s(?:=\s*+(?:\"[^\"]*+\"|'[^']*+'|[^\s\"'>][^\s>]*+)|[^=>]|=)*+>"
HREF = r"(?is)[\s\"'/]href\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>][^\s>]*+))"


def anchors(html: Column) -> Column:
    """``array<struct<href, inner>>`` of every ``<a>`` with a target, references not decoded.

    An anchor ends at its closing tag, at the next ``<a``, or with the page.
    """
    def read(piece: Column) -> Column:
        def parts(tag: Column) -> Column:
            href = F.concat(*[F.regexp_extract(tag, HREF, g) for g in (1, 2, 3)])
            rest = F.substr(piece, F.length(tag) + 1)
            return F.struct(blank_to_null(href).alias("href"), F.get(F.split(rest, r"(?i)</a[\s>]", 2), F.lit(0)).alias("inner"))

        return let(F.regexp_extract(piece, ANCHOR_TAG, 0), parts)

    return F.filter(F.transform(F.split(html, ANCHOR), read), lambda a: a["href"].isNotNull())


def extract_links(pages: DataFrame) -> DataFrame:
    """One row per link of a page: ``page_id, page_url, pos, href, anchor``."""
    found = pages.select("page_id", F.col("url").alias("page_url"), H.strip_markup(F.col("html")).alias("body")).select(
        "page_id", "page_url", F.posexplode(anchors(F.col("body"))).alias("pos", "link"))
    return found.select(
        "page_id", "page_url", "pos",
        H.unescape_entities(F.col("link.href")).alias("href"),
        clean_space(H.all_text(F.col("link.inner"))).alias("anchor"),
    )


def extract_cards(pages: DataFrame, listings: DataFrame) -> DataFrame:
    """One row per listing card, by the card layouts of the page's source.

    ``pages`` carries ``source`` and ``rule``. Output: ``page_id, page_url, source, pos, href,
    title, blurp, date_text, imgurl, category, every_visit, drop_query, force_https``. A layout
    marked ``first_only`` gives its first card and no other. Containers and cards may be nested in
    their like to any depth; a card stands once, and one around another holds all of it.
    """
    layouts = broadcast_if_small(listings.select(F.col("source").alias("_source"), F.struct("*").alias("lay")))
    of_source = (F.col("source") == F.col("_source")) & (F.col("lay.page").isNull() | F.regexp_like(F.col("url"), F.col("lay.page")))
    # pages without a layout go before their markup is read
    cleaned = pages.join(layouts, of_source, "left_semi").withColumn("body", H.strip_markup(F.col("html"))).drop("html")
    page = with_tree(cleaned, "body").drop("body").join(layouts, of_source)
    lay = F.col("lay")
    names = ["link", "title", "blurp", "after_blurp", "date", "image"]
    page = settle(page.withColumn("cards", card_regions("lay")), "cards").where(
        F.size("cards") >= F.coalesce(lay["min_cards"], F.lit(1)))
    read = fields_each("cards", [f"lay.{n}" for n in names])
    picked = (
        page.select("page_id", F.col("url").alias("page_url"), "source", "rule", "lay", F.posexplode(read).alias("pos", "raw"))
        .where(lay["skip_at"].isNull() | (F.col("pos") != lay["skip_at"]))
        .where(~lay["first_only"] | (F.col("pos") == 0))
    )
    picked = settle(picked.withColumn("picked", F.transform("raw", H.unescape_entities)).drop("raw"), "picked")

    def field(name: str) -> Column:
        return F.get("picked", F.lit(names.index(name)))

    href = field("link")
    kept = picked.where(
        href.isNotNull()
        & (lay["keep"].isNull() | F.regexp_like(href, lay["keep"]))
        & (lay["deny"].isNull() | ~F.regexp_like(href, lay["deny"])))
    segment = url_category(F.split_part("page_url", F.lit("?"), F.lit(1)), F.col("rule.slash"))
    return kept.select(
        "page_id", "page_url", "source", "pos", href.alias("href"),
        clean_space(field("title")).alias("title"),
        F.when(F.col("pos") >= F.coalesce(lay["bare_head"], F.lit(0)), blank_to_null(clean_space(
            F.coalesce(field("blurp"), field("after_blurp"))))).alias("blurp"),
        field("date").alias("date_text"),
        field("image").alias("imgurl"),
        F.coalesce(F.try_element_at("rule.category_map", segment), segment).alias("category"),
        lay["every_visit"].alias("every_visit"),
        (F.col("rule.drop_query") | lay["drop_query"]).alias("drop_query"),
        F.col("rule.force_https").alias("force_https"),
    )


def next_pages(pages: DataFrame) -> DataFrame:
    """The next listing page of each page whose source links to one: ``page_id, page_url, url``.

    The link may be nothing but a query, so its query string stays.
    """
    rule = F.col("rule")
    pages = with_tree(pages.where(rule["next"].isNotNull()).withColumn("body", H.strip_markup(F.col("html"))), "body")
    href = H.unescape_entities(F.get(fields(["rule.next"]), F.lit(0)))
    base = F.when(rule["slash"] & ~F.col("url").rlike("[/?#]$|[?#]"), F.concat("url", F.lit("/"))).otherwise(F.col("url"))
    found = settle(pages.select(
        "page_id", "rule", "url", base.alias("base"), href.alias("href")), "href")
    return found.where(F.col("href").isNotNull() & ~F.col("href").eqNullSafe(rule["next_stop"])).select(
        "page_id", F.col("url").alias("page_url"), resolve_url(F.col("href"), F.col("base")).alias("url"))


def slice_cards(cards: DataFrame, head: int = 2, tail_from: int = 3, pos: str = "pos",
                blurp: str | None = None) -> DataFrame:
    """The first ``head`` cards (without a blurp) and those from ``tail_from`` on; the gap is left out."""
    kept = cards.where((F.col(pos) < head) | (F.col(pos) >= tail_from))
    return kept if blurp is None else kept.withColumn(blurp, F.when(F.col(pos) >= tail_from, F.col(blurp)))


def resolve_links(links: DataFrame, href: str = "href", base: str = "page_url", out: str = "url") -> DataFrame:
    return links.withColumn(out, resolve_url(F.col(href), F.col(base)))


def filter_links(links: DataFrame, column: str = "href", keep: str | None = None,
                 starts: str | None = None, deny: tuple[str, ...] = ()) -> DataFrame:
    """Links that match ``keep``, begin with ``starts`` and hold none of ``deny``."""
    test = F.col(column).isNotNull()
    if keep:
        test &= F.col(column).rlike(keep)
    if starts:
        test &= F.col(column).startswith(starts)
    for part in deny:
        test &= ~F.col(column).contains(part)
    return links.where(test)


def first_per_key(df: DataFrame, key: str, order: list) -> DataFrame:
    """One row per key, the first in ``order``; null keys count as one key.

    Spark limits each group before the shuffle as well, so a hot key sends one row per task.
    """
    first = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def dedupe_links(links: DataFrame, key: str = "url", order: tuple[str, ...] = ("page_id", "pos"),
                 every_visit: str | None = None) -> DataFrame:
    """Visit each URL once, at its first link. Rows flagged ``every_visit`` all stay."""
    if links.isStreaming:
        raise ValueError("use newsloom.streaming.links.dedupe_links_stream for a stream")
    if every_visit is None:
        return first_per_key(links, key, list(order))
    flag = F.coalesce(F.col(every_visit), F.lit(False))
    return links.where(flag).unionByName(first_per_key(links.where(~flag), key, list(order)))


def expand_frontier(links: DataFrame, held: DataFrame, seeds: DataFrame, hops: int = 1) -> DataFrame:
    """URLs reached from ``seeds`` in at most ``hops`` links and not yet held: ``url, hop``.

    ``links(page_url, url)`` are edges between canonical URLs. Every hop is one join on the
    page URL. With more than one hop, the edges are staged, so that pages are parsed once, and
    each hop is checkpointed, so that lineage stays short.
    """
    ensure_checkpoint_dir(links.sparkSession)
    edges = links.select("page_url", "url").where(F.col("url").isNotNull())
    if hops > 1:
        edges = stage(edges, "edges")
    front = seeds.select("url").distinct()
    seen = front.withColumn("hop", F.lit(0))
    for hop in range(1, hops + 1):
        reached = (
            front.withColumnRenamed("url", "page_url").join(edges, "page_url")
            .select("url").distinct()
            .join(seen.select("url"), "url", "left_anti")
        )
        if hops > 1:
            reached = reached.checkpoint()
        seen = seen.unionByName(reached.withColumn("hop", F.lit(hop)))
        front = reached
    return seen.where("hop > 0").join(held.select("url"), "url", "left_anti")


def attach_card(articles: DataFrame, cards: DataFrame, url: str = "url") -> DataFrame:
    """Bring the fields of the card that led to a page onto the page, by their addresses.

    Both sides come with the addresses that their source's rule makes (``page_address``); here only
    fragments are ignored. All fields of a card arrive in the struct ``card``. A page reached by
    several cards comes out once per card. A hot URL is split by adaptive skew join handling.
    """
    left = articles.withColumn("_key", page_address(F.col(url)))
    right = cards.select(page_address(F.col(url)).alias("_key"), F.struct("*").alias("card"))
    return left.join(right, "_key").drop("_key")
