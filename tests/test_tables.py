"""Keyed table, change log, stream and sinks."""

import json
import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from newsloom.operators import links as L
from newsloom.operators import sinks
from newsloom.operators import tables as E
from newsloom.schemas import SEARCH_FIELDS
from newsloom.session import broadcast_if_small, is_small, shared_dir, spread
from newsloom.sources import changes as C
from newsloom.sources.pages import read_pages, select_source
from newsloom.streaming.changes import ChangeCounter, apply_changes_stream, compact_log, counted, counts_of, read_log, read_state
from newsloom.streaming.links import dedupe_links_stream, trending_stream

CHANGES = "title string, seq bigint, event_name string, text string"


def history(n_keys=20, n=400, seed=1):
    rng = random.Random(seed)
    # One key holds a third of all changes.
    return [("hot" if rng.random() < 1 / 3 else f"k{rng.randrange(n_keys)}", seq,
             rng.choice(["INSERT", "MODIFY", "REMOVE"]), f"v{seq}") for seq in range(n)]


def replay(rows):
    state = {}
    for title, seq, op, text in sorted(rows, key=lambda r: r[1]):
        if op == "REMOVE":
            state.pop(title, None)
        else:
            state[title] = (title, seq, op, text)
    return set(state.values())


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_apply_changes_ignores_arrival_order(spark):
    rows = history()
    shuffled = rows[:]
    random.Random(2).shuffle(shuffled)
    for given in (rows, shuffled, shuffled + shuffled[:50]):
        assert as_set(E.apply_changes(spark.createDataFrame(given, CHANGES))) == replay(rows)


def test_remove_then_insert_and_late_remove(spark):
    rows = [("a", 3, "INSERT", "x"), ("a", 2, "REMOVE", None), ("b", 1, "INSERT", "y"), ("b", 2, "REMOVE", None), (None, 9, "INSERT", "z")]
    assert as_set(E.apply_changes(spark.createDataFrame(rows, CHANGES))) == {("a", 3, "INSERT", "x")}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    plan = E.upsert_latest(spark.range(10).select((F.col("id") % 3).cast("string").alias("title"), F.col("id").alias("seq")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("row_number(), 1, Final") < text.index("Exchange") < text.index("row_number(), 1, Partial")


def write_batches(spark, rows, path, parts):
    for i in range(parts):
        spark.createDataFrame(rows[i::parts], CHANGES).coalesce(1).write.mode("append").parquet(path)


def test_stream_survives_restart_and_replay(spark):
    rows, root = history(seed=3), shared_dir(spark, "test-stream")
    write_batches(spark, rows[:200], f"{root}/in", 3)

    def run():
        stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        apply_changes_stream(stream, f"{root}/log", f"{root}/checkpoint").awaitTermination()

    run()
    assert as_set(read_state(spark, f"{root}/log")) == replay(rows[:200])
    write_batches(spark, rows[200:], f"{root}/in", 3)
    run()
    assert as_set(read_state(spark, f"{root}/log")) == replay(rows)
    # A batch that is run once more, as after a lost driver, changes nothing.
    before = read_log(spark, f"{root}/log").count()
    stream = spark.readStream.schema(CHANGES).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    apply_changes_stream(stream, f"{root}/log", f"{root}/second").awaitTermination()
    assert read_log(spark, f"{root}/log").count() == before
    assert as_set(read_state(spark, f"{root}/log")) == replay(rows)


def test_compaction_keeps_tombstones_and_later_batches(spark):
    root = shared_dir(spark, "test-compact")

    def add(*rows):
        spark.createDataFrame(rows, CHANGES).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(CHANGES).parquet(f"{root}/in")
        apply_changes_stream(stream, f"{root}/log", f"{root}/checkpoint").awaitTermination()

    with pytest.raises(ValueError, match="no batch"):
        read_state(spark, f"{root}/log")
    add(("a", 1, "INSERT", "x"), ("a", 5, "REMOVE", None), ("b", 2, "INSERT", "y"))
    compact_log(spark, f"{root}/log")
    add(("a", 4, "MODIFY", "late"), ("c", 3, "INSERT", "z"))
    assert as_set(read_state(spark, f"{root}/log")) == {("b", 2, "INSERT", "y"), ("c", 3, "INSERT", "z")}
    assert read_log(spark, f"{root}/log").count() == 4
    compact_log(spark, f"{root}/log", forget_before=6)
    assert read_log(spark, f"{root}/log").count() == 2
    add(("b", 9, "REMOVE", None))
    assert as_set(read_state(spark, f"{root}/log")) == {("c", 3, "INSERT", "z")}


def test_change_records_from_files(spark):
    def record(op, seq, image=None):
        body = {"SequenceNumber": str(seq), "Keys": {"title": {"S": "A"}}}
        if image:
            body["NewImage"] = image
        return {"eventName": op, "dynamodb": body}

    image = {"title": {"S": "A"}, "date": {"S": "05/03/2021"}, "tag": {"L": [{"S": "x"}, {"S": "y"}]},
             "blurp": {"NULL": True}, "text": {"S": "t"}}
    batches = [{"Records": [record("INSERT", 9, image), record("REMOVE", 111000000000000000000001)]}, {"Records": []}]
    root = shared_dir(spark, "test-records")
    spark.createDataFrame([(json.dumps(b),) for b in batches], "value string").write.text(f"{root}/lines")
    spark.createDataFrame([(json.dumps(batches[0], indent=1),)], "value string").coalesce(1).write.text(f"{root}/whole")
    for path, whole in ((f"{root}/lines", False), (f"{root}/whole", True)):
        rows = {r.event_name: r for r in C.decode_attributes(C.read_changes(spark, path, one_batch_per_file=whole)).collect()}
        first = rows["INSERT"]
        assert (first.title, first.date, first.tags, first.blurp, first.url, first.text) == (
            "A", date(2021, 3, 5), ["x", "y"], None, None, "t")
        assert rows["REMOVE"].title is None and rows["REMOVE"].seq > first.seq
    docs = E.to_search_doc(C.decode_attributes(C.read_changes(spark, f"{root}/lines")))
    assert docs.columns == SEARCH_FIELDS
    assert E.to_search_doc(docs.withColumn("source", F.lit("s")), with_source=True).columns[-1] == "source"


def test_observed_counts(spark):
    df, seen = E.observe_changes(spark.createDataFrame(history(), CHANGES), name="observed")
    df.write.format("noop").mode("overwrite").save()
    removed = sum(r[2] == "REMOVE" for r in history())
    assert seen.get == {"processed": 400, "removed": removed, "upserted": 400 - removed}


@pytest.mark.parametrize("suffix, gzip, ending", [("", None, ".json"), (".gz", None, ".json.gz"), ("", True, ".json.gz")])
def test_jsonl_chunks(spark, tmp_path, suffix, gzip, ending):
    path = str(tmp_path / f"out{suffix}")
    df = spark.range(0, 250, 1, 2).select("id", F.when(F.col("id") > 5, "é").alias("x"))
    sinks.write_jsonl(df, path, gzip=gzip)
    files = list((tmp_path / f"out{suffix}").glob("part-*"))
    assert files and all(f.name.endswith(ending) for f in files)
    assert len(files) == 4 and max(spark.read.text(str(f)).count() for f in files) == 100
    assert spark.read.text(path).where("value like '%null%'").count() == 6
    assert as_set(spark.read.schema(df.schema).json(path)) == as_set(df)


def test_empty_input_writes_nothing(spark, tmp_path):
    sinks.write_jsonl(spark.range(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_feed_layout_and_pruning(spark, tmp_path):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "big").otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("source"))
    sinks.write_feed(df, str(tmp_path), "2024-01-15T01:02:03")
    assert (tmp_path / "source=big" / "run_ts=2024-01-15T01-02-03").is_dir()
    back = select_source(spark.read.json(str(tmp_path)), "big")
    assert back.count() == 100
    assert "PartitionFilters: [isnotnull(source" in back._jdf.queryExecution().executedPlan().toString()
    for run in ("2024-01-16T00:00:00", "2024-01-17T00:00:00", "2024-01-17T00:00:00"):
        sinks.write_feed(df, str(tmp_path / "p"), run, fmt="parquet")
    assert spark.read.parquet(str(tmp_path / "p")).count() == 600  # a repeated run replaces its own folders only


def test_export_form(spark):
    df = spark.createDataFrame([(date(2024, 3, 9), ["a", "b"], [1]), (None, None, None)], "date date, tags array<string>, n array<int>")
    assert [tuple(r) for r in E.to_export(df).collect()] == [("09/03/2024", "a, b", [1]), (None, None, None)]


def test_sequence_numbers_of_any_length(spark):
    texts = ["9" * 40, "1" + "0" * 40, "00012", "12", "13", "0", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.sequence_order(F.col("t")).alias("o"))
    order = [r.t for r in df.where("t IS NOT NULL").orderBy("o", "t").collect()]
    assert order == ["0", "00012", "12", "13", "9" * 40, "1" + "0" * 40]
    with pytest.raises(Exception, match="not a sequence number"):
        spark.createDataFrame([("x1",)], "t string").select(C.sequence_order(F.col("t"))).collect()


def test_encode_temporal(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 2, 3, 4, 5), date(2024, 1, 2), 1)], "a timestamp, b date, c int")
    assert E.encode_temporal(df).first() == ("2024-01-02 03:04:05", "2024-01-02", 1)


def test_pages_stream_and_first_visits(spark):
    root = shared_dir(spark, "test-pages")
    rows = [(1, "https://example.com/a", "x"), (2, "https://example.com/a", "y"), (3, "https://example.com/b", "z")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{root}/pages")
    stream = read_pages(spark, f"{root}/pages", streaming=True, max_files_per_trigger=1)
    timed = stream.withColumn("at", F.timestamp_seconds(F.col("page_id")))
    with pytest.raises(ValueError):
        L.dedupe_links(timed)
    query = dedupe_links_stream(timed, "at").writeStream.format("parquet").option("path", f"{root}/out").option(
        "checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(r.url for r in spark.read.parquet(f"{root}/out").collect()) == ["https://example.com/a", "https://example.com/b"]
    assert read_pages(spark, f"{root}/pages").count() == 3


def test_trending_stream_drops_and_counts_late_rows(spark):
    root = shared_dir(spark, "test-late")
    days = [(datetime(2024, 1, 1, 5), "a"), (datetime(2024, 1, 1, 6), "a"), (datetime(2024, 1, 2, 1), "b")]
    schema = "at timestamp, term string"

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        query = trending_stream(spark.readStream.schema(schema).parquet(f"{root}/in"), "at").writeStream.format("parquet").option(
            "path", f"{root}/out").option("checkpointLocation", f"{root}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
        return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])

    assert run(days) == 0
    run([(datetime(2024, 1, 3, 12), "c")])
    assert run([(datetime(2024, 1, 1, 7), "a")]) == 1
    got = {(r.window_start.day, r.term, r.n) for r in spark.read.parquet(f"{root}/out").collect()}
    assert got == {(1, "a", 2), (2, "b", 1)}


def test_slice_and_filter_links(spark):
    cards = spark.createDataFrame([(i, f"/t/{i}", "b") for i in range(5)], "pos int, href string, blurp string")
    assert [(r.pos, r.blurp) for r in L.slice_cards(cards, blurp="blurp").orderBy("pos").collect()] == [
        (0, None), (1, None), (3, "b"), (4, "b")]
    links = spark.createDataFrame([("/article/1",), ("/article/video",), ("/blog/1",), (None,)], "href string")
    kept = L.filter_links(links, keep="^/a", starts="/article/", deny=("video",))
    assert [r.href for r in kept.collect()] == ["/article/1"]


def test_frontier_hops(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("a", "a"), ("b", "a"), ("a", "h")], "page_url string, url string")
    seeds, held = spark.createDataFrame([("a",)], "url string"), spark.createDataFrame([("a",), ("h",)], "url string")
    assert as_set(L.expand_frontier(edges, held, seeds)) == {("b", 1)}
    assert as_set(L.expand_frontier(edges, held, seeds, hops=2)) == {("b", 1), ("c", 2)}
    assert as_set(L.expand_frontier(edges, held, seeds, hops=9)) == {("b", 1), ("c", 2), ("d", 3)}


def test_broadcast_needs_a_checked_size(spark):
    small = spark.range(10)
    assert is_small(small) and not is_small(small, max_rows=9) and not is_small(small, max_bytes=20)
    joined = spark.range(100).join(broadcast_if_small(small, max_rows=9).hint("merge"), "id")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert spread(spark.range(0, 10, 1, 1), "id").rdd.getNumPartitions() == 4
    assert spread(spark.range(0, 10, 1, 6), "id").rdd.getNumPartitions() == 6


def test_a_hot_url_keeps_every_card(spark):
    url = F.when(F.col("id") % 3 == 0, "http://example.com/hot?x=1").otherwise(F.concat(F.lit("https://example.com/"), "id"))
    cards = spark.range(300).select(url.alias("url"), F.col("id").alias("card_id"))
    pages = spark.range(300).where("id % 3 <> 0 or id = 0").select(
        F.when(F.col("id") == 0, "http://example.com/hot?x=1#top").otherwise(F.concat(F.lit("https://example.com/"), "id")).alias("url"))
    joined = L.attach_card(pages, cards).select("card.card_id", "url")
    assert joined.count() == 300 and joined.select("card_id").distinct().count() == 300
    assert joined.where("url = 'http://example.com/hot?x=1#top'").count() == 100


def test_unsound_records_leave_the_others(spark):
    record = lambda seq, name="MODIFY": {"eventName": name, "dynamodb": {"SequenceNumber": seq, "Keys": {"title": {"S": f"t{seq}"}}}}
    batch = lambda *records: json.dumps({"Records": list(records)})
    rows = [batch(record("7"), record("08")), batch(record("9"), 5, record("x1"), {"eventName": "INSERT"}, record("10", "REMOVE"), "text", None),
            "not json", '{"Records": 3}', "{}", batch(), None, "", batch(record(None)), batch({"eventName": "MODIFY", "dynamodb": 4})]
    frame = spark.createDataFrame([(r,) for r in rows], "value string")
    sound, bad = C.sort_changes(frame)
    assert not any("unsound=" in name for name in sound.inputFiles())  # by folders, a task would sort all its rows before it writes
    assert sorted((r.seq.digits, r.event_name, r["keys"]["title"].S) for r in sound.collect()) == [
        ("10", "REMOVE", "t10"), ("7", "MODIFY", "t7"), ("8", "MODIFY", "t08"), ("9", "MODIFY", "t9")]
    found = sorted((rows.index(r.value), -1 if r.pos is None else r.pos, r.reason) for r in bad.collect())
    assert [f for f in found if f[0] == 1] == [(1, 1, "record"), (1, 2, "sequence"), (1, 3, "record"), (1, 5, "record"), (1, 6, "record")]
    assert [f for f in found if f[0] != 1] == [(2, -1, "batch"), (3, -1, "batch"), (4, -1, "batch"), (7, -1, "batch"), (8, 0, "sequence"), (9, 0, "record")]
    with pytest.raises(Exception):
        C.explode_changes(frame).collect()  # strict reading stays the default
    sound, bad = C.sort_changes(frame.limit(0))
    assert sound.count() == bad.count() == 0


def test_counts_of_a_stream_after_a_restart(spark, tmp_path):
    counter = ChangeCounter(spark, f"{tmp_path}/counts")
    spark.streams.addListener(counter)
    try:
        for part in (history(n=40), history(n=25, seed=2)):
            spark.createDataFrame(part, CHANGES).write.mode("append").parquet(f"{tmp_path}/in")
            stream = counted(spark.readStream.schema(CHANGES).parquet(f"{tmp_path}/in"))
            counter.wait(apply_changes_stream(stream, f"{tmp_path}/log", f"{tmp_path}/checkpoint"))
    finally:
        spark.streams.removeListener(counter)
    rows = counts_of(spark, f"{tmp_path}/counts").orderBy("batch").collect()
    removed = [sum(r[2] == "REMOVE" for r in part) for part in (history(n=40), history(n=25, seed=2))]
    told = [(r.processed, r.removed, r.upserted) for r in rows if r.processed]
    assert told == [(40, removed[0], 40 - removed[0]), (25, removed[1], 25 - removed[1])]
