"""Keywords, summaries, trends and search against brute force in plain Python."""

import math
import random
import re
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from newsloom.functions.text import STOPWORDS
from newsloom.operators import discovery as S
from newsloom.plans.recommend import recommend
from newsloom.session import shared_dir

WORDS = "alpha beta gamma delta the of news data cloud robot bank law".split()


def make_docs(n=60, seed=5):
    rng = random.Random(seed)
    docs = []
    for i in range(n):
        sentences = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(0, 7))]
        docs.append((i, "".join(f"{s.capitalize()}{rng.choice('.!?')} " for s in sentences)))
    return docs + [(n, docs[0][1]), (n + 1, docs[0][1]), (n + 2, ""), (n + 3, "...")]


DOCS = make_docs()


def toks(text):
    return [t for t in re.split(r"[^\w]+", text.lower()) if t]


def top(text, k):
    counts = Counter(t for t in toks(text) if t not in STOPWORDS)
    return sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:k]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id int, text string").repartition(3).cache()


def test_keywords(docs):
    got = {(r.doc_id, r.rank, r.term, r.n, round(r.score, 9)) for r in S.keywords(docs, k=4).collect()}
    want = {(i, rank, t, n, round(n / len(toks(text)), 9)) for i, text in DOCS
            for rank, (t, n) in enumerate(top(text, 4), 1)}
    assert got == want


def test_keywords_without_stopwords(docs):
    got = {(r.doc_id, r.term) for r in S.keywords(docs, k=100, stopwords=()).collect()}
    assert got == {(i, t) for i, text in DOCS for t in toks(text)}


def test_keywords_do_not_shuffle(spark, docs):
    plan = S.keywords(spark.range(5).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text")))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def best_sentences(text, n):
    found = [s.strip() for s in re.findall(r"[^.!?]+[.!?]*", text)]
    found = [s for s in found if toks(s)]
    counts = Counter(t for s in found for t in toks(s))
    mean = [sum(counts[t] for t in toks(s)) / len(toks(s)) for s in found]
    chosen = sorted(sorted(range(len(found)), key=lambda i: (-mean[i], i))[:n])
    return " ".join(found[i] for i in chosen)


def test_summary(docs):
    got = {r.doc_id: r.summary for r in S.summarise(docs, n=2).collect()}
    assert got == {i: best_sentences(text, 2) for i, text in DOCS}


def test_trending_overall(docs):
    counts = Counter(t for _, text in DOCS for t, _ in top(text, 5))
    want = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:3]
    got = [(r.term, r.n) for r in S.trending(S.keywords(docs, k=5), k=3).orderBy("rank").collect()]
    assert got == want


def test_growth_compares_with_the_period_before(spark):
    rows = [(date(2024, 1, 1), "a")] * 3 + [(date(2024, 1, 2), "a")] * 5 + [(date(2024, 1, 4), "a")] * 2 + [(date(2024, 1, 4), "b")] * 9
    got = {(r.day.day, r["rank"], r.term, r.n, r.growth) for r in S.trending(
        spark.createDataFrame(rows, "day date, term string"), period="day").collect()}
    assert got == {(1, 1, "a", 3, 3), (2, 1, "a", 5, 2), (4, 1, "b", 9, 9), (4, 2, "a", 2, 2)}


def bm25(queries, k):
    counts = {i: Counter(toks(text)) for i, text in DOCS}
    mean = sum(sum(c.values()) for c in counts.values()) / len(counts)
    df = Counter(t for c in counts.values() for t in c)
    out = set()
    for q, text in queries:
        scores = {}
        for i, c in counts.items():
            hits = [t for t in set(toks(text)) if t in c]
            if hits:
                scores[i] = round(sum(
                    math.log(1 + (len(counts) - df[t] + 0.5) / (df[t] + 0.5)) * c[t] * 2.2
                    / (c[t] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for t in hits), 6)
        ranked = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
        out |= {(q, rank, i, s) for rank, (i, s) in enumerate(ranked, 1)}
    return out


QUERIES = [(1, "robot law"), (2, "the the news"), (3, "nothing matches"), (4, "Alpha, BETA!")]


def test_search(spark, docs):
    queries = S.query_terms(spark.createDataFrame(QUERIES, "query_id int, text string"))
    got = S.search(S.postings(docs), S.corpus_size(docs), queries, k=5)
    assert {(r.query_id, r["rank"], r.doc_id, r.score) for r in got.collect()} == bm25(QUERIES, 5)


def test_search_on_a_written_index(spark, docs):
    path = shared_dir(spark, "test-index")
    S.write_postings(S.postings(docs), path)
    index = spark.read.parquet(path)
    queries = S.query_terms(spark.createDataFrame(QUERIES, "query_id int, text string"))
    got = S.search(index, S.corpus_size(docs), queries, k=5)
    assert {(r.query_id, r["rank"], r.doc_id, r.score) for r in got.collect()} == bm25(QUERIES, 5)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()


def test_search_with_several_fields(spark):
    docs = spark.createDataFrame([(1, "Robots", None), (2, None, "robots robots"), (3, "x", "y")], "doc_id int, title string, text string")
    fields = ("title", "text")
    queries = S.query_terms(spark.createDataFrame([(1, "robots")], "query_id int, text string"))
    got = S.search(S.postings(docs, fields=fields), S.corpus_size(docs, fields), queries)
    assert [r.doc_id for r in got.orderBy("rank").collect()] == [2, 1]


def test_recommend(docs):
    got = recommend(docs, k_terms=2, k_docs=3).collect()
    counts = Counter(t for _, text in DOCS for t, _ in top(text, 10))
    terms = [t for t, _ in sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:2]]
    want = bm25(list(enumerate(terms, 1)), 3)
    assert {(r.term_rank, r["rank"], r.doc_id, r.score) for r in got} == want
    assert {r.term for r in got} == set(terms)
