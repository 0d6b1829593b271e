"""Ranked search that leaves out blocks of articles which cannot reach the best.

Articles are dealt into blocks. For each term and block the index stores the greatest impact of a
posting beside the postings themselves. A query first adds up the greatest impacts of its terms per
block, from those two numbers alone: no article of the block can score more. The most promising blocks are
read, the ``k``-th best score among their articles is a bound from below, and of the other blocks only
those that can reach it are read as well (block-max pruning).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.operators.discovery import B, K1, by_article, postings
from newsloom.session import broadcast_if_small, is_small, stage

_MARGIN = 2e-6  # sums in another order, and the rounding of scores


def impact(tf: Column, length: Column, mean_length: float | None) -> Column:
    """The part of a BM25 score that a posting alone decides."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.lit(mean_length)))


def write_blocks(docs: DataFrame, size: DataFrame, path: str, doc: str = "doc_id", fields: tuple[str, ...] = ("text",),
                 block_docs: int = 32, mode: str = "overwrite") -> None:
    """Write an index of ``term, block, greatest, entries``; ``size`` is one row as of ``corpus_size``.

    A row holds one term's postings in one block, about ``block_docs`` at most, so a very common term is
    many rows. Rows lie in ranges of term and block, so a search skips the row groups of other terms.
    """
    n_docs, mean_length = size.select("n_docs", "mean_length").first()
    n_blocks = max(1, -(-n_docs // block_docs))
    dealt = postings(docs, doc, fields).withColumn("block", F.pmod(F.xxhash64(doc), F.lit(n_blocks))).repartitionByRange("term", "block")
    # grouped where the ranges put them: postings cross the network once
    weighed = dealt.select("term", "block", F.struct(F.col(doc), impact(F.col("tf"), F.col("length"), mean_length).alias("impact")).alias("entry"))
    rows = weighed.groupBy("term", "block").agg(F.max("entry.impact").alias("greatest"), F.collect_list("entry").alias("entries"))
    rows.sortWithinPartitions("term", "block").write.mode(mode).parquet(path)


def weighted_terms(matching: DataFrame, terms: DataFrame, n_docs: int) -> DataFrame:
    """``query_id, term, df, idf`` from the blocks of the query terms."""
    frequency = matching.groupBy("term").agg(F.sum(F.size("entries")).alias("df"))
    return terms.join(frequency, "term").select(
        "query_id", "term", "df", F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"))


def block_bounds(matching: DataFrame, weighted: DataFrame) -> DataFrame:
    """``query_id, block, bound``: no article of the block scores more. Postings are not read.

    ``matching`` crosses the network by block, before each row becomes one for every query of its term.
    """
    dealt = by_article(matching.select("term", "block", "greatest"), weighted, "block")
    return dealt.join(weighted.drop("df"), "term").groupBy("query_id", "block").agg(
        F.sum(F.col("idf") * F.col("greatest")).alias("bound"))


def blocks_within_reach(bounds: DataFrame, scored: DataFrame, k: int) -> DataFrame:
    """Of ``bounds``, the blocks that may hold one of the best ``k``, by those ``scored`` so far (``query_id, score``)."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score")))
    least = scored.withColumn("rank", rank).where(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
    return bounds.join(broadcast_if_small(least), "query_id", "left").where(
        F.col("least").isNull() | (F.col("bound") >= F.col("least") - _MARGIN)).drop("least")


def search_blocks(index: DataFrame, size: DataFrame, terms: DataFrame, k: int = 10, doc: str = "doc_id", first: int = 4) -> DataFrame:
    """``query_id, rank, doc, score``: the rows of ``search``, by an index of ``write_blocks``.

    ``first`` blocks a query are read in any case. Neither the bounds nor the scores of blocks that are
    left out cross the network. Where more blocks are within reach than can be broadcast, their postings are
    dealt by block and meet all queries there. Queries without a known term have no rows. ``index`` is read
    several times.
    """
    matching = index.join(broadcast_if_small(terms.select("term").distinct()), "term", "left_semi")
    weighted = stage(weighted_terms(matching, terms, size.select("n_docs").first()[0]), "weighted-terms")
    bounds = stage(block_bounds(matching, broadcast_if_small(weighted)), "block-bounds")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "block"))
    leading = stage(bounds.withColumn("rank", rank).where(F.col("rank") <= first).select("query_id", "block"), "leading-blocks")

    def scores(read: DataFrame, *by: str) -> DataFrame:
        entries = read.select("query_id", "idf", *by, F.explode("entries").alias("e"))
        return entries.groupBy("query_id", *by, F.col(f"e.{doc}").alias(doc)).agg(
            F.round(F.sum(F.col("idf") * F.col("e.impact")), 6).alias("score")).drop(*by)

    def scores_of(blocks: DataFrame) -> DataFrame:
        return scores(matching.join(broadcast_if_small(weighted), "term").join(broadcast_if_small(blocks), ["query_id", "block"]))

    begun = stage(scores_of(leading), "leading-scores")
    others = bounds.join(broadcast_if_small(leading), ["query_id", "block"], "left_anti")
    rest = stage(blocks_within_reach(others, begun, k).select("query_id", "block"), "blocks-within-reach")
    if is_small(rest):
        found = begun.unionByName(scores_of(rest))
    else:
        read = stage(rest.select("block").union(leading.select("block")).distinct(), "blocks-to-read")
        dealt = by_article(matching.join(broadcast_if_small(read), "block", "left_semi"), weighted, "block")
        found = scores(dealt.join(broadcast_if_small(weighted), "term"), "block")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), doc)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", doc, "score")
