"""Block-max search, distinct articles over periods, row offsets, streams that keep state."""

import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.operators import block_search
from newsloom.operators import discovery as S
from newsloom.operators.block_search import block_bounds, blocks_within_reach, search_blocks, weighted_terms, write_blocks
from newsloom.operators.periods import distinct_over, term_bitmaps
from newsloom.operators.sinks import with_row_offset
from newsloom.streaming.changes import latest_by_state, read_stream_state
from newsloom.streaming.links import attach_card_stream


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(words[min(int(draw.expovariate(0.02)), 399)] for _ in range(n))
    rows = [(i, text(draw.randint(1, 60))) for i in range(600)] + [(700, None), (701, ""), (702, "rare needle"), (703, "rare needle needle")]
    queries = [(i, text(5)) for i in range(8)] + [(90, "needle rare"), (91, "unheard"), (92, None)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(queries, "query_id long, text string")


@pytest.mark.parametrize("block_docs, first", [(32, 4), (4, 1), (1000, 2)])
def test_blocks_give_the_same_ranks(spark, corpus, tmp_path, block_docs, first):
    docs, queries = corpus
    size, terms = S.corpus_size(docs), S.query_terms(queries)
    write_blocks(docs, size, f"{tmp_path}/b", block_docs=block_docs)
    got = search_blocks(spark.read.parquet(f"{tmp_path}/b"), size, terms, k=5, first=first)
    want = S.search(S.postings(docs), size, terms, k=5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_many_blocks_within_reach_give_the_same_ranks(spark, corpus, tmp_path, monkeypatch):
    """Where they are too many to broadcast, postings are dealt by block."""
    docs, queries = corpus
    size, terms = S.corpus_size(docs), S.query_terms(queries)
    write_blocks(docs, size, f"{tmp_path}/b", block_docs=8)
    monkeypatch.setattr(block_search, "is_small", lambda df: False)
    got = search_blocks(spark.read.parquet(f"{tmp_path}/b"), size, terms, k=5, first=1)
    want = S.search(S.postings(docs), size, terms, k=5)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_pairs_of_queries_stay_in_their_task(spark, corpus, tmp_path, monkeypatch):
    """What crosses the network before the ranking is postings, dealt by article or block, not a row for each query."""
    docs, queries = corpus
    size, terms = S.corpus_size(docs), S.query_terms(queries)
    monkeypatch.setattr(S, "TASK_PAIRS", 50)
    write_blocks(docs, size, f"{tmp_path}/b")
    index = spark.read.parquet(f"{tmp_path}/b")
    weighted = F.broadcast(weighted_terms(index, terms, size.first().n_docs).localCheckpoint())
    for found in (S.search(S.postings(docs), size, terms), block_bounds(index, weighted)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
        assert [d for d in dealt if "query_id" in d and ("doc_id" in d or "block" in d)] == [] and any("query_id" not in d for d in dealt)


def test_blocks_out_of_reach_are_skipped(spark, corpus, tmp_path):
    docs, queries = corpus
    size, terms = S.corpus_size(docs), S.query_terms(queries.where("query_id = 90")).unionByName(
        spark.createDataFrame([(90, "w1")], "query_id long, term string"))
    write_blocks(docs, size, f"{tmp_path}/b", block_docs=8)
    index = spark.read.parquet(f"{tmp_path}/b")
    bounds = block_bounds(index, weighted_terms(index.join(terms.select("term"), "term", "left_semi"), terms, size.first().n_docs))
    scored = S.search(S.postings(docs), size, terms, k=2)
    left = blocks_within_reach(bounds, scored.select("query_id", "score"), 2).count()
    assert 1 <= left <= 3 and bounds.count() > 20  # nearly all blocks hold w1, and two articles the rare words
    none = S.query_terms(queries.where("query_id > 90"))
    assert search_blocks(index, size, none).count() == 0


@pytest.mark.parametrize("length", [1, 2, 3, 5, 24])
def test_distinct_articles_of_periods(spark, length):
    draw = random.Random(length)
    rows = [(draw.choice([0, 1, 32767, 32768, 99_999, draw.randint(0, 200)]), draw.choice("ab"), draw.randint(0, 40)) for _ in range(300)]
    rows += [(None, "a", 1), (1, None, 1), (1, "a", None)]
    frame = spark.createDataFrame(rows, "doc_id long, term string, hour int").withColumn(
        "at", F.lit("2024-03-30 00:10:00").cast("timestamp") + F.make_interval(hours=F.col("hour")))
    got = {(r.h, r.term): r.n for r in distinct_over(term_bitmaps(frame, "at"), length).select(
        ((F.unix_timestamp("start") - F.unix_timestamp(F.lit("2024-03-30 00:00:00").cast("timestamp"))) / 3600).cast("int").alias("h"), "term", "n").collect()}
    want = {}
    for d, t, h in rows:
        if None not in (d, t, h):
            for s in range(h - length + 1, h + 1):
                want.setdefault((s, t), set()).add(d)
    assert got == {k: len(v) for k, v in want.items()}


def test_bitmaps_of_rare_terms_are_small(spark):
    """A set of one article takes a few bytes, ids below 0 count too, and sets that are stored twice count once."""
    frame = spark.range(-500, 500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.pmod("id", F.lit(300))).alias("term"), F.lit(
        "2024-01-01 05:00:00").cast("timestamp").alias("at"))
    bitmaps = term_bitmaps(frame, "at")
    assert bitmaps.agg(F.max(F.length(F.to_json(F.struct("*"))))).first()[0] < 200
    got = distinct_over(bitmaps.unionByName(bitmaps), 3).groupBy("start").agg(F.count("*"), F.sum("n")).collect()
    assert sorted((r[0].hour, r[1], r[2]) for r in got) == [(h, 300, 1000) for h in (3, 4, 5)]


def test_row_offsets_of_a_hot_group(spark):
    rows = [(i, "hot" if i % 10 else None) for i in range(2000)] + [(5000 + i, f"s{i}") for i in range(5)] + [(7, "hot"), (7, "hot")]
    frame = spark.createDataFrame(rows, "n long, source string").repartition(5)
    got = with_row_offset(frame, "source", ["n"], chunk=100)
    assert got.columns == ["n", "source", "row", "offset"]
    places = {}
    for r in got.collect():
        places.setdefault(r.source, []).append((r.row, r.n, r.offset))
    for source, held in places.items():
        held.sort()
        assert [row for row, *_ in held] == list(range(1, len(held) + 1))
        assert [n for _, n, _ in held] == sorted(n for n, s in rows if s == source)
        assert all(o == (row - 1) // 100 * 100 for row, _, o in held)
    assert with_row_offset(frame.limit(0), "source", ["n"]).count() == 0


def test_state_after_late_records_and_a_restart(spark, tmp_path):
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    schema = "title string, seq long, event_name string, text string"
    batches = [[("a", 5, "MODIFY", "a5"), ("b", 1, "INSERT", "b1"), (None, 9, "INSERT", "x")],
               [("a", 3, "MODIFY", "a3"), ("b", 4, "REMOVE", None), ("c", 2, "REMOVE", None)],
               [("b", 2, "MODIFY", "b2"), ("c", 1, "INSERT", "c1"), ("c", 3, "INSERT", "c3"), ("d", 1, None, "d1")]]
    for rows in batches:  # each run starts anew from the checkpoint
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = session.readStream.schema(schema).parquet(f"{tmp_path}/in")
        latest_by_state(stream, f"{tmp_path}/checkpoint").awaitTermination()
    got = sorted(map(tuple, read_stream_state(session, f"{tmp_path}/checkpoint").collect()))
    assert got == [("a", 5, "MODIFY", "a5"), ("c", 3, "INSERT", "c3"), ("d", 1, None, "d1")]


def test_late_articles_and_cards_on_streams(spark, tmp_path):
    day = "2024-01-0"
    batches = [([("x", f"{day}1 10:00"), ("x#top", f"{day}1 12:00"), ("y", f"{day}1 10:00")], [("X", "x", f"{day}1 09:00"), ("Y", "y", f"{day}1 11:00")]),
               ([("z", f"{day}5 10:00")], [("Z", "z#a", f"{day}5 09:00")]),
               ([("x", f"{day}1 11:00"), (None, f"{day}5 11:00"), ("end", f"{day}9 00:00")], [("late", "z", f"{day}1 08:00"), ("end", "end", f"{day}9 00:00")])]
    for name in ("articles", "cards"):
        spark.createDataFrame([], "url string, at timestamp" if name == "articles" else "title string, url string, seen timestamp").write.parquet(f"{tmp_path}/{name}")
    dropped = 0
    for articles, cards in batches:
        spark.createDataFrame(articles, "url string, at string").withColumn("at", F.to_timestamp("at", "yyyy-MM-dd HH:mm")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/articles")
        spark.createDataFrame(cards, "title string, url string, seen string").withColumn("seen", F.to_timestamp("seen", "yyyy-MM-dd HH:mm")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/cards")
        left = spark.readStream.schema("url string, at timestamp").parquet(f"{tmp_path}/articles")
        right = spark.readStream.schema("title string, url string, seen timestamp").parquet(f"{tmp_path}/cards")
        joined = attach_card_stream(left, right, "at", "seen").select("url", F.date_format("at", "dd HH").alias("at"), F.col("card.title").alias("title"))
        query = joined.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
        query.awaitTermination()
        dropped += sum(o["numRowsDroppedByWatermark"] for p in query.recentProgress for o in p["stateOperators"])
    got = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").where("url IS NULL OR url <> 'end'").collect()), key=str)
    assert got == sorted([("x", "01 10", "X"), ("x#top", "01 12", "X"), ("y", "01 10", None), ("z", "05 10", "Z"), (None, "05 11", None)], key=str)
    assert dropped == 2  # an article and a card that came days too late
