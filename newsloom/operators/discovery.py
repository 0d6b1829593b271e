"""Keywords, summaries, trending terms and ranked search over an article table.

Each article is one row, so its terms are counted inside the row. Only counts cross the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from newsloom.functions.text import STOPWORDS, let, run_lengths, run_starts, sentences, term_counts, tokens
from newsloom.session import is_small, stage

# The usual BM25 constants (Robertson and Zaragoza 2009).
K1 = 1.2
B = 0.75

# Up to this many distinct query terms are passed to the scan as a filter.
FEW_TERMS = 200

# Scores that one task adds up: pairs of a query and an article, once for each term they share.
TASK_PAIRS = 1 << 20


def top_terms(text: Column, k: int, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """``array<struct<term, n, score>>``: the ``k`` most frequent terms, ties by term.

    Stopwords go before the sort, and only terms that reach the ``k``-th count are ranked.
    """
    def rank(words: Column) -> Column:
        kept = F.filter(words, lambda w: ~w.isin(list(stopwords))) if stopwords else words
        return let(F.sort_array(kept), lambda ordered: let(
            run_starts(ordered), lambda starts: let(
                run_lengths(ordered, starts), lambda lengths: best(words, ordered, starts, lengths))))

    def best(words: Column, ordered: Column, starts: Column, lengths: Column) -> Column:
        def ranked(least: Column) -> Column:
            return F.sort_array(F.array_compact(F.transform(starts, lambda start, j: F.when(
                F.get(lengths, j) >= least,
                F.struct((-F.get(lengths, j)).alias("minus_n"), F.get(ordered, start).alias("term"))))))

        least = F.coalesce(F.get(F.sort_array(lengths, False), F.lit(k - 1)), F.lit(1))
        return F.transform(F.slice(let(least, ranked), 1, k), lambda c: F.struct(
            c["term"].alias("term"), (-c["minus_n"]).alias("n"),
            (-c["minus_n"] / F.size(words)).alias("score")))

    return let(tokens(text), rank)


def keywords(df: DataFrame, k: int = 10, stopwords: Sequence[str] = STOPWORDS, doc: str = "doc_id",
             text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Top ``k`` terms of each article: ``doc, rank, term, n, score``. No shuffle."""
    best = df.select(doc, *keep, F.posexplode(top_terms(F.col(text), k, stopwords)).alias("pos", "kw"))
    return best.select(doc, *keep, (F.col("pos") + 1).alias("rank"), "kw.term", "kw.n", "kw.score")


def summary(text: Column, n: int = 3) -> Column:
    """The ``n`` sentences whose terms are most frequent in the article, in text order.

    A sentence scores the mean count of its terms (Luhn 1958). All work stays inside the row: the
    terms, tagged with their sentence, are sorted to count them. A term that occurs once adds one
    to its sentence's total, so totals start at the sentence's length and only repeated terms
    add to them, packed behind their sentence in one long and sorted. Both sorts compare plain values.
    """
    mark, low = "\x01", F.lit(2**32 - 1)

    def extras(ordered: Column) -> Column:
        """``sentence << 32 | count - 1`` for each occurrence of a repeated term."""
        def spread(starts: Column) -> Column:
            def pack(w: Column, count: Column) -> Column:
                return F.shiftleft(F.substring_index(w, mark, -1).cast("long"), 32) + (count - 1)

            none = F.array().cast("array<bigint>")
            return let(run_lengths(ordered, starts), lambda lengths: F.flatten(F.transform(
                starts, lambda start, j: F.when(
                    F.get(lengths, j) > 1,
                    F.transform(F.slice(ordered, start + 1, F.get(lengths, j)), lambda w: pack(w, F.get(lengths, j))),
                ).otherwise(none))))

        terms = F.transform(ordered, lambda w: F.substring_index(w, mark, 1))
        return let(let(terms, lambda t: run_starts(t)), spread)

    def means(counted: Column, lengths: Column) -> Column:
        """``struct<-mean, sentence>`` from the sorted totals; run ``j`` belongs to sentence ``j``."""
        def mean(starts: Column) -> Column:
            def one(start: Column, j: Column, size: Column) -> Column:
                total = F.aggregate(F.slice(counted, start + 1, size), F.lit(0).cast("long"),
                                    lambda acc, x: acc + x.bitwiseAND(low))
                return F.struct((-total / F.get(lengths, j)).alias("minus_mean"), j.alias("sentence"))

            return let(run_lengths(counted, starts), lambda sizes: F.transform(
                starts, lambda start, j: one(start, j, F.get(sizes, j))))

        return let(run_starts(counted, lambda x: F.shiftright(x, 32)), mean)

    def choose(found: Column) -> Column:
        def rank(words: Column) -> Column:
            lengths = F.transform(words, lambda w: F.size(w))
            tagged = F.flatten(F.transform(words, lambda w, i: F.transform(
                w, lambda t: F.concat(t, F.lit(mark), i.cast("string")))))
            base = F.transform(words, lambda w, i: F.shiftleft(i.cast("long"), 32) + F.size(w))
            totals = F.sort_array(F.concat(base, let(F.sort_array(tagged), extras)))
            return let(totals, lambda counted: let(lengths, lambda sizes: F.sort_array(means(counted, sizes))))

        ranked = let(F.transform(found, lambda s: tokens(s)), rank)
        best = F.sort_array(F.transform(F.slice(ranked, 1, n), lambda r: r["sentence"]))
        return F.array_join(F.transform(best, lambda i: F.get(found, i)), " ")

    return let(sentences(text), choose)


def summarise(df: DataFrame, n: int = 3, doc: str = "doc_id", text: str = "text") -> DataFrame:
    return df.select(doc, summary(F.col(text), n).alias("summary"))


def trending(terms: DataFrame, k: int = 10, period: str | None = None, step: int = 1) -> DataFrame:
    """The terms most articles use, over all or per period with the growth on the period before.

    ``terms`` has one row per article and term (as from ``keywords``). ``period`` is a date or
    number column whose next value lies ``step`` further. Counts are summed on the map side, and
    the ranking keeps ``k`` rows per period and task before its shuffle, so neither a hot term nor
    a hot period gathers in one task.
    """
    if period is None:
        top = terms.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(k)
        rank = F.row_number().over(Window.orderBy(F.desc("n"), "term"))
        return top.select(rank.alias("rank"), "term", "n")
    counts = terms.groupBy(period, "term").agg(F.count("*").alias("n"))
    by_term = Window.partitionBy("term").orderBy(period)
    before = F.lag(period).over(by_term)
    distance = F.date_diff(F.col(period), before) if dict(terms.dtypes)[period] == "date" else F.col(period) - before
    grown = counts.withColumn(
        "growth", F.col("n") - F.when(distance == step, F.lag("n").over(by_term)).otherwise(0))
    rank = F.row_number().over(Window.partitionBy(period).orderBy(F.desc("n"), "term"))
    return grown.withColumn("rank", rank).where(F.col("rank") <= k).select(period, "rank", "term", "n", "growth")


def _words(fields: Sequence[str]) -> Column:
    return tokens(F.concat_ws(" ", *fields) if len(fields) > 1 else F.col(fields[0]))


def postings(docs: DataFrame, doc: str = "doc_id", fields: Sequence[str] = ("text",),
             only: Sequence[str] | None = None, size: Observation | None = None) -> DataFrame:
    """Search index rows: ``term, doc, tf, length``, counted inside each article row.

    ``only`` limits the index to some terms; the others go before they are sorted. ``size`` is told
    the number of articles and their mean length when the index is first run, so that a search
    need not read the texts again for them. (Not under a range partitioning, whose sampling runs
    the rows once more.)
    """
    def count(words: Column) -> Column:
        kept = words if only is None else F.filter(words, lambda w: w.isin(list(only)))
        return F.struct(F.size(words).alias("length"), term_counts(kept).alias("terms"))

    counted = docs.select(doc, let(_words(fields), count).alias("d"))
    if size is not None:
        counted = counted.observe(size, F.count(F.lit(1)).alias("n_docs"),
                                  F.avg(F.coalesce(F.col("d.length"), F.lit(0))).alias("mean_length"))
    return counted.select(
        doc, F.col("d.length").alias("length"), F.explode("d.terms").alias("t")
    ).select("t.term", doc, F.col("t.n").alias("tf"), "length")


def corpus_size(docs: DataFrame, fields: Sequence[str] = ("text",)) -> DataFrame:
    """One row: the number of articles and their mean length in tokens."""
    length = F.coalesce(F.size(_words(fields)), F.lit(0))
    return docs.select(length.alias("length")).agg(
        F.count("*").alias("n_docs"), F.avg("length").alias("mean_length"))


def write_postings(index: DataFrame, path: str, doc: str = "doc_id", mode: str = "overwrite") -> None:
    """Postings sorted by term, so that a search skips the row groups of other terms.

    Ranges run over term and article, hence a very common term spreads over many files.
    """
    index.repartitionByRange("term", doc).sortWithinPartitions("term", doc).write.mode(mode).parquet(path)


def query_terms(queries: DataFrame, query: str = "query_id", text: str = "text") -> DataFrame:
    """The distinct terms of each query."""
    return queries.select(
        F.col(query).alias("query_id"), F.explode(F.array_distinct(tokens(F.col(text)))).alias("term"))


def by_article(matching: DataFrame, weighted: DataFrame, by: str) -> DataFrame:
    """``matching`` dealt by a column, so that about ``TASK_PAIRS`` uses of a posting (``weighted`` has ``df``) are one task's."""
    pairs = weighted.agg(F.sum("df")).first()[0] or 0
    return matching.repartition(max(1, -(-pairs // TASK_PAIRS)), by)


def search(index: DataFrame, size: DataFrame | Observation, terms: DataFrame, k: int = 10, doc: str = "doc_id") -> DataFrame:
    """Best ``k`` articles per query by BM25: ``query_id, rank, doc, score``.

    Only postings of query terms go on. A few terms become a filter that a stored index pushes to
    its scan; more meet the postings in a join, by broadcast when their counted size allows it.
    The matching postings are staged, since both the term frequencies and the scores need them.
    ``size`` is one row, read once, or what the index tells of itself when it runs here; both a
    stored row and the latter spare a pass over the texts.
    Matching postings cross the network once, by article. There they meet the queries and their
    scores are summed, so the pairs of queries and articles, far more than the postings, stay in their
    task. Ranks use the score rounded to 6 places, ties by article.
    """
    # Each small side below has at most one row per row of ``terms``.
    side = F.broadcast if is_small(terms) else (lambda df: df)
    wanted = terms.select("term").distinct()
    few = [row.term for row in wanted.limit(FEW_TERMS + 1).collect()]
    matching = (
        index.where(F.col("term").isin(few)) if len(few) <= FEW_TERMS
        else index.join(side(wanted), "term", "left_semi"))
    matching = stage(matching, "matching-postings")
    frequency = matching.groupBy("term").agg(F.count("*").alias("df"))
    if isinstance(size, Observation):
        n_docs, mean_length = size.get.get("n_docs", 0), size.get.get("mean_length")
    else:
        n_docs, mean_length = size.select("n_docs", "mean_length").first()
    weighted = stage(terms.join(frequency, "term").select(
        "query_id", "term", "df", F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")), "weighted-terms")
    norm = F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(mean_length))
    scored = by_article(matching, weighted, doc).withColumn("weight", F.col("tf") * (K1 + 1) / norm).join(side(weighted.drop("df")), "term")
    totals = scored.groupBy("query_id", doc).agg(F.round(F.sum(F.col("idf") * F.col("weight")), 6).alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), doc)
    return totals.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", doc, "score")
