"""Benchmark decontamination by winnowing, JVM-side throughout.

A window is ``span`` consecutive item words. Its fingerprint is the smallest hash of the k-grams in
it, so a document with the same words at any place has the same fingerprint for the window that
starts there: every shared span is met. Documents keep their different fingerprints only, these are
joined with the items' ones, and in the documents that share any, the hits are extended to whole
windows and compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.llm.common import word_array
from newsloom.session import broadcast_if_small, stage

SPAN, GRAM = 10, 5


def window_prints(words: Column, span: int, gram: int) -> Column:
    """The fingerprint of every window of ``span`` words, in order; none for a shorter text."""
    width = span - gram + 1

    def hashes(w):
        return F.transform(F.sequence(F.lit(1), F.size(w) - gram + 1), lambda i: F.xxhash64(F.slice(w, i, F.lit(gram))))

    def minima(h):
        return F.transform(F.sequence(F.lit(1), F.size(h) - width + 1), lambda j: F.array_min(F.slice(h, j, F.lit(width))))

    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= span, let(hashes(words), minima) if width > 1 else hashes(words)).otherwise(none)


def item_windows(items: DataFrame, text: str, id_col: str, span: int) -> DataFrame:
    """``item_id, n, gram``: each window of an item, or the whole item where it has fewer words."""
    words = items.select(F.col(id_col).cast("string").alias("item_id"), F.array(word_array(F.col(text))).alias("ws"))
    words = words.select("item_id", F.explode("ws").alias("w")).where(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(span))
    starts = words.select("item_id", n.alias("n"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("i"))
    return starts.select("item_id", "n", F.array_join(F.slice("w", F.col("i"), F.col("n")), " ").alias("gram")).distinct()


def prints_by_length(words: Column, lengths: list[int], span: int, gram: int) -> list[tuple[int, Column]]:
    """Fingerprints at every start, for windows of ``span`` words and each shorter length in use."""
    return [(n, window_prints(words, n, gram if n == span else n)) for n in lengths]


def find_hits(
    docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text",
    item_id: str = "item_id", span: int = SPAN, gram: int = GRAM,
) -> tuple[DataFrame, DataFrame]:
    """``id, text_key, start, n, gram`` for every place of a window, and the windows of all items."""
    windows = stage(item_windows(items, item_text, item_id, span), "windows")
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # at most ``span`` numbers
    distinct = windows.select("n", "gram").distinct()
    known = distinct.select(F.explode(F.concat(*[
        F.when(F.col("n") == n, p).otherwise(F.array().cast("array<bigint>"))
        for n, p in prints_by_length(F.split("gram", " "), lengths, span, gram)])).alias("print")).distinct() \
        if lengths else distinct.select(F.lit(0).cast("long").alias("print")).limit(0)
    lengths = lengths or [span]
    known = broadcast_if_small(stage(known, "window-prints"))

    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("t"), F.xxhash64(text).alias("text_key"))
    kept = let(word_array(F.col("t")), lambda w: F.array_distinct(F.concat(
        *[p for _, p in prints_by_length(w, lengths, span, gram)])))
    drawn = source.select("id", "text_key", F.explode(kept).alias("print"))
    met = drawn.join(known, "print", "left_semi").groupBy("id", "text_key").agg(F.collect_set("print").alias("met"))
    met = broadcast_if_small(stage(met, "met-prints"), max_rows=20_000, max_bytes=8 << 20)

    def starts(w, n, prints):
        def place(x, i):
            gram = F.array_join(F.slice(w, i + 1, F.lit(n)), " ")
            return F.when(F.array_contains("met", x), F.struct((i + 1).alias("start"), F.lit(n).alias("n"), gram.alias("gram")))

        return F.filter(F.transform(prints, place), lambda x: x.isNotNull())

    def extended(w):
        return F.flatten(F.array(*[starts(w, n, p) for n, p in prints_by_length(w, lengths, span, gram)]))

    same = [source["id"].eqNullSafe(met["id"]), source["text_key"] == met["text_key"]]
    places = source.join(met, same).select(
        source["id"], source["text_key"], F.explode(let(word_array(F.col("t")), extended)).alias("h"))
    places = places.select("id", "text_key", "h.start", "h.n", "h.gram")
    hits = places.join(broadcast_if_small(distinct), ["n", "gram"], "left_semi").distinct()
    return hits.select("id", "text_key", "start", "n", "gram"), windows


def covered(spans: Column) -> Column:
    """How many words an array of ``struct(start, n)`` covers, each once."""
    zero = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("end"))

    def add(acc, s):
        end = (s["start"] + s["n"]).cast("long")
        new = F.greatest(end - F.greatest(acc["end"], s["start"].cast("long")), F.lit(0).cast("long"))
        return F.struct((acc["words"] + new).alias("words"), F.greatest(acc["end"], end).alias("end"))

    return F.aggregate(F.array_sort(spans), zero, add, lambda acc: acc["words"])


def decontaminate(
    docs: DataFrame, items: DataFrame, text: str = "text", id_col: str = "doc_id", item_text: str = "text",
    item_id: str = "item_id", span: int = SPAN, gram: int = GRAM,
) -> DataFrame:
    """``id_col, n_words, n_hit, items, spans`` for every row of ``docs``.

    ``items`` are the ids, as sorted text, of the items with a window in the document, ``spans`` the
    windows' places (first word from 1, number of words). A null text has no words; an item without
    words has no window; an item without an id hits words but is not named. Equal ids of items are
    one item. Rows with a null or repeated id are told apart by their text. Empty tables of either
    side give no hits. Further columns are not read.
    """
    hits, windows = find_hits(docs, items, text, id_col, item_text, item_id, span, gram)
    hits = stage(hits, "window-hits")
    spans = hits.groupBy("id", "text_key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    pairs = hits.select("id", "text_key", "n", "gram").distinct().join(
        windows, ["n", "gram"]).select("id", "text_key", "item_id").distinct()
    named = pairs.groupBy("id", "text_key").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    same = spans["id"].eqNullSafe(named["id"]) & (spans["text_key"] == named["text_key"])
    found = spans.join(named, same, "left").select(spans["id"], spans["text_key"], "spans", "items")
    rows = docs.select(F.col(id_col), F.xxhash64(text).alias("text_key"),
                       F.size(word_array(F.col(text))).cast("long").alias("n_words"))
    same = rows[id_col].eqNullSafe(found["id"]) & (rows["text_key"] == found["text_key"])
    none = F.array().cast("array<struct<start:int,n:int>>")
    return rows.join(found, same, "left").select(
        rows[id_col], "n_words", F.coalesce(covered(F.col("spans")), F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce(F.array_sort("spans"), none).alias("spans"))


def op5_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


OP5_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n,
    array_to_string(list_slice(w, i, i + least(len(w), 10) - 1), ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
), grams AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT g.doc_id, g.i, g.n, item_id FROM grams g JOIN windows USING (n, gram)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY 1
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN named USING (doc_id)
"""
