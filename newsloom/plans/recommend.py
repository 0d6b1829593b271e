"""Trending terms and the best articles for each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from newsloom.functions.text import STOPWORDS
from newsloom.operators.discovery import corpus_size, keywords, postings, search, trending


def recommend(articles: DataFrame, k_terms: int = 10, k_docs: int = 5, doc: str = "doc_id", text: str = "text",
              k_keywords: int = 10, stopwords: Sequence[str] = STOPWORDS,
              index: DataFrame | None = None) -> DataFrame:
    """``term, term_rank, rank, doc, score``: the ``k_docs`` best articles per trending term.

    Pass ``index`` (a table from ``write_postings``) to search without reading the texts again.
    """
    spark = articles.sparkSession
    top = trending(keywords(articles, k_keywords, stopwords, doc, text), k_terms).collect()  # k_terms rows
    terms = spark.createDataFrame(
        [(row["rank"], row["term"]) for row in top], "query_id int, term string").coalesce(1)
    size = Observation()
    if index is None:
        index = postings(articles, doc, (text,), [row["term"] for row in top], size)
    else:
        size = corpus_size(articles, (text,))
    best = search(index, size, terms, k_docs, doc)
    few = F.broadcast(terms) if len(top) <= 10_000 else terms
    return best.join(few, "query_id").select(
        F.col("query_id").alias("term_rank"), "term", "rank", doc, "score")
