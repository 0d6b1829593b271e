"""Links and trending terms of an unbounded stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.urls import page_address


def dedupe_links_stream(links: DataFrame, event_time: str, key: str = "url", delay: str = "1 day") -> DataFrame:
    """The first link per URL within the watermark; state older than ``delay`` is dropped."""
    return links.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def attach_card_stream(articles: DataFrame, cards: DataFrame, article_time: str, card_time: str, within: str = "1 day",
                       delay: str = "1 hour", url: str = "url") -> DataFrame:
    """``attach_card`` on two streams: articles that come up to ``within`` after the card that led to them.

    Both sides keep rows in state only as long as a partner may still come. An article that no card of
    that time leads to leaves once the watermark has passed it, with a null ``card``; unlike the batch
    join, which has no time to wait for and leaves it out. Rows later than ``delay`` are dropped by
    Spark and counted in the query's progress (``numRowsDroppedByWatermark``). A null address has no card.
    """
    left = articles.withColumn("_key", page_address(F.col(url))).withWatermark(article_time, delay)
    right = cards.select(page_address(F.col(url)).alias("_card_key"), F.col(card_time).alias("_card_time"), F.struct("*").alias("card"))
    right = right.withWatermark("_card_time", delay)
    near = (F.col(article_time) >= F.col("_card_time")) & (F.col(article_time) <= F.col("_card_time") + F.expr(f"INTERVAL {within}"))
    return left.join(right, (F.col("_key") == F.col("_card_key")) & near, "left_outer").select(*articles.columns, "card")


def trending_stream(terms: DataFrame, event_time: str, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Articles per term and tumbling window: ``window_start, term, n``.

    A window is final once the watermark passes its end. Rows that arrive later are dropped by
    Spark and counted in the query's progress (``numRowsDroppedByWatermark``).
    """
    counted = (
        terms.withWatermark(event_time, delay)
        .groupBy(F.window(event_time, window).alias("w"), "term").agg(F.count("*").alias("n"))
    )
    return counted.select(F.col("w.start").alias("window_start"), "term", "n")


def with_open_windows(closed: DataFrame, rows: DataFrame, event_time: str, window: str = "1 day") -> DataFrame:
    """The stream's closed windows, and the counts so far of those it has not closed.

    ``rows`` are the stream's own rows as a table. All windows that start after the last closed one
    are counted from them, so the scan can skip whatever is older. A stream without closed windows
    yet gives every window from the rows.
    """
    last = closed.agg(F.max("window_start")).first()[0]
    counted = rows.groupBy(F.window(event_time, window).alias("w"), "term").agg(F.count("*").alias("n"))
    still = counted.select(F.col("w.start").alias("window_start"), "term", "n")
    return closed.unionByName(still if last is None else still.where(F.col("window_start") > F.lit(last)))
