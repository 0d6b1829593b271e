"""Ranked lexical search by lists in order of impact, without random access (NRA).

An index holds, per shard of documents and per term, the documents that hold the term. A shard is what
one task reads of some thousand documents, so building it shuffles nothing. In a search each list is
ordered by impact, and each query reads its lists from the top, all postings down to a falling level
at a time. A document read has a score interval: what was read of it, and that plus the next impact
of every list in which it was not met. Reading goes on until no other document can reach the last of
the best ``k``, ties included; those that still can are then read to the end of their lists, which
closes their intervals. Best lists of the shards are merged by rank.

Impacts are whole numbers: a term's weight ``w`` is ``floor(1000 ln((2N + 2) / (2 df + 1)))`` and a
posting's impact ``w * (10^9 tf div (1000 tf + 12 m))`` with ``m = 75 + (25 n N) div L``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from newsloom.llm.common import as_bytes, pieces, word_array, words_of
from newsloom.session import broadcast_if_small, stage

SHARD_DOCS, SHARD_BYTES, BLOCK = 8192, 24 << 20, 256
_SLICE = 1 << 20  # bytes of text split at a time
_DOC_SCHEMA = "shard long, term binary, ids binary, nulls binary, lengths binary, postings binary, df long"


def _term_slices(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, some at a time, so that a very long one is never held as a list of all its words."""
    start = 0
    while start < len(text):
        end = start + _SLICE
        while end < len(text) and (cut := text.find(b" ", end, end + _SLICE)) < 0:
            end += _SLICE
        end = cut if end < len(text) else len(text)
        yield words_of(text[start:end])
        start = end


class _Shard:
    """Counts of the terms of some documents."""

    def __init__(self) -> None:
        self.codes: defaultdict[bytes, int] = defaultdict()
        self.codes.default_factory = self.codes.__len__
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.keys: list[np.ndarray] = []  # term code << 32 | document, with counts beside
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, doc_id: int | None, text: bytes | None) -> None:
        at, n, found = len(self.ids), 0, []
        for words in _term_slices(text or b""):
            n += len(words)
            found.append(np.unique(np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words)), return_counts=True))
        if len(found) > 1:
            codes, back = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
            found = [(codes, np.bincount(back, weights=np.concatenate([k for _, k in found])).astype(np.int64))]
        for codes, counts in found:
            self.keys.append((codes << 32) | at)
            self.counts.append(counts)
        self.ids.append(doc_id)
        self.lengths.append(n)
        self.size += len(text or b"")

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        """The row of the documents, then one row per term; arrays are little-endian."""
        key = np.concatenate(self.keys) if self.keys else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        key, tf = key[order], (np.concatenate(self.counts) if self.counts else key)[order]
        term, doc = key >> 32, key & 0xFFFFFFFF
        postings = np.stack([doc, tf], axis=1).astype("<u4")
        edges = np.searchsorted(term, np.arange(len(self.codes) + 1))
        ids = np.array([i or 0 for i in self.ids], "<i8"), np.array([i is None for i in self.ids], np.uint8)
        yield _index_rows([(shard, None, ids[0].tobytes(), ids[1].tobytes(), np.array(self.lengths, "<i8").tobytes(), None, None)])
        names, some, held = list(self.codes), [], 0
        for code, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            some.append((shard, names[code], None, None, None, postings[a:b].tobytes(), b - a))
            held += b - a
            if held > 500_000 or len(some) == 10_000:
                yield _index_rows(some)
                some, held = [], 0
        if some:
            yield _index_rows(some)


def _index_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), *[pa.binary()] * 5, pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                                      names=["shard", "term", "ids", "nulls", "lengths", "postings", "df"])


def build_index(docs: DataFrame, text: str = "text", id_col: str = "doc_id",
                shard_docs: int = SHARD_DOCS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """An index of every row of ``docs``, stored in the shared folder.

    A row with a null term describes a shard: ids and lengths of its documents. Every other row is
    the list of a term: places of the documents in the shard and how often they hold the term. A
    shard has at most ``shard_docs`` documents and about ``shard_bytes`` of text, or one longer text.
    Null texts and texts without terms are there with length 0. Ids are whole numbers or null, and
    rows that repeat one are documents of their own. Further columns are not read.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, now = TaskContext.get().partitionId() << 32, _Shard()
        for batch in batches:
            for piece in pieces(batch, "text", _SLICE):
                for doc_id, t in zip(piece.column("id").to_pylist(), as_bytes(piece.column("text"))):
                    if now.ids and (len(now.ids) >= shard_docs or now.size + len(t or b"") > shard_bytes):
                        yield from now.rows(number)
                        number, now = number + 1, _Shard()
                    now.add(doc_id, t)
        if now.ids:
            yield from now.rows(number)

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"))
    return stage(source.mapInArrow(work, _DOC_SCHEMA), "impact-index")


def corpus_size(index: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [np.frombuffer(x, "<i8") for x in batch.column("lengths").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int((x > 0).sum()) for x in n], pa.int64()), pa.array([int(x.sum()) for x in n], pa.int64())],
                                             names=["n", "l"])

    row = index.where("term IS NULL").select("lengths").mapInArrow(work, "n long, l long").agg(F.sum("n").alias("n"), F.sum("l").alias("l")).first()
    return row.n or 0, row.l or 0


def query_terms(queries: DataFrame, text: str, id_col: str, block: int) -> DataFrame:
    """``block, term, uses``: the queries of each block that hold a term, with their numbers and counts."""
    rows = queries.select(F.col(id_col).cast("long").alias("item_id"), word_array(F.col(text)).alias("words")).distinct()
    rows = rows.where(F.size("words") > 0).withColumn("query", F.xxhash64("item_id", "words"))
    # blocks by a hash; a block holds about ``block`` queries
    n = max(1, rows.count())
    rows = rows.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "query"), F.lit(-(-n // block))))
    terms = rows.select("block", "query", "item_id", F.explode("words").alias("word")).groupBy("block", "query", "item_id", "word").agg(
        F.count("*").alias("times"))
    return stage(terms.groupBy("block", F.col("word").cast("binary").alias("term")).agg(
        F.collect_list(F.struct("query", "item_id", "times")).alias("uses")), "query-terms")


class _List:
    """A term's documents and impacts in a shard, highest impact first."""

    def __init__(self, postings: bytes, weight: int, m: np.ndarray):
        doc, tf = np.frombuffer(postings, "<u4").reshape(-1, 2).astype(np.int64).T
        impact = weight * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        order = np.argsort(-impact, kind="stable")
        self.doc, self.impact = doc[order], impact[order]
        self.rising = -self.impact  # to look up levels

    def down_to(self, level: int) -> int:
        """How many postings have an impact of ``level`` or more."""
        return int(np.searchsorted(self.rising, -level, side="right"))


def best_documents(lists: list[tuple[_List, int]], n_docs: int, k: int, tie: np.ndarray, reads: list[int] | None = None) -> list[tuple[int, int]]:
    """``(document, score)`` of the ``k`` best of a shard by NRA; equal scores by ascending ``tie``.

    ``lists`` has each term's list and how often the query holds the term. ``reads`` counts the postings
    that were read before membership was sure.
    """
    lower, met = np.zeros(n_docs, np.int64), np.zeros(n_docs, np.int64)
    done, ends = [0] * len(lists), [len(x.doc) for x, _ in lists]
    # The level is one of contributions; it falls by a third of itself each round.
    level = max((int(x.impact[0]) * t for x, t in lists if len(x.doc)), default=0)
    while True:
        level = level * 2 // 3
        ahead = []
        for i, (x, times) in enumerate(lists):
            upto = x.down_to(-(-level // times)) if level > 0 else ends[i]
            if upto > done[i]:
                lower[x.doc[done[i]:upto]] += x.impact[done[i]:upto] * times
                done[i] = upto
            ahead.append(int(x.impact[upto]) * times if upto < ends[i] else 0)
        if not any(ahead):
            alive = np.flatnonzero(lower > 0)
            break
        # the sum of what lies ahead in all lists, without those in which a document was met
        met[:] = 0
        for (x, _), upto, next_ in zip(lists, done, ahead):
            if next_:
                met[x.doc[:upto]] += next_
        upper = lower + sum(ahead) - met
        if n_docs <= k:
            continue
        last = int(np.partition(lower, n_docs - k)[n_docs - k])
        alive = np.flatnonzero(upper >= max(last, 1))
        if last > 0 and len(alive) <= 4 * k:
            break
    if reads is not None:
        reads.append(sum(done))
    if sum(done) < sum(ends):
        # Membership is down to these few: the rest of each list is read for them alone.
        wanted = np.zeros(n_docs, bool)
        wanted[alive] = True
        for i, (x, times) in enumerate(lists):
            doc = x.doc[done[i]:]
            keep = wanted[doc]
            lower[doc[keep]] += x.impact[done[i]:][keep] * times
        alive = alive[lower[alive] > 0]
    order = np.lexsort((tie[alive], -lower[alive]))[:k]
    return [(int(alive[i]), int(lower[alive[i]])) for i in order]


def search(index: DataFrame, queries: DataFrame, text: str = "text", id_col: str = "item_id", k: int = 20, block: int = BLOCK,
           doc_col: str = "doc_id") -> DataFrame:
    """``id_col, rank, doc_col, score`` of the ``k`` best documents of every query.

    Documents with a score above 0 only, fewer than ``k`` where there are no more; equal scores by
    ascending id, null ids last, and rows that repeat an id in any order. Queries that repeat id and
    text count once; others that share an id have their own ranks. A null text has no terms and no
    results. Queries are worked on in blocks, so a group holds one shard's lists of the terms of one
    block, however many queries or documents there are.
    """
    n, total = corpus_size(index)
    uses = query_terms(queries, text, id_col, block)
    lists = index.where("term IS NOT NULL").join(broadcast_if_small(uses), "term")
    lists = lists.select("block", "shard", "term", "postings", "df", "uses")
    frequent = index.where("term IS NOT NULL").join(broadcast_if_small(uses.select("term").distinct()), "term").groupBy("term").agg(F.sum("df").alias("in_all"))
    weight = F.floor(F.lit(1000.0) * F.log((2.0 * n + 2.0) / (F.lit(2.0) * F.col("in_all") + F.lit(1.0)))).cast("long")
    lists = lists.join(broadcast_if_small(stage(frequent.select("term", weight.alias("w")), "term-weights")), "term").drop("df")
    blocks = uses.select("block").distinct().agg(F.array_sort(F.collect_list("block")).alias("block")).first()["block"]
    shards = index.where("term IS NULL").select(F.col("shard").alias("in_shard"), "ids", "nulls", "lengths")
    # a long as in ``lists``: an int of the same value hashes to another partition, and the groups would not meet
    numbers = F.array(*map(F.lit, blocks)).cast("array<long>")
    shards = shards.withColumn("in_block", F.explode(numbers) if blocks else F.lit(None).cast("long"))

    def work(docs: pa.Table, terms: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if docs.num_rows and terms.num_rows:
            ids = np.frombuffer(docs.column("ids")[0].as_py(), "<i8")
            null = np.frombuffer(docs.column("nulls")[0].as_py(), np.uint8).astype(bool)
            lengths = np.frombuffer(docs.column("lengths")[0].as_py(), "<i8")
            tie = np.empty(len(ids), np.int64)
            tie[np.lexsort((ids, null))] = np.arange(len(ids))
            m = 75 + (25 * lengths * n) // total
            wanted: dict[tuple[int, int | None], list[tuple[_List, int]]] = {}
            for postings, w, users in zip(*(terms.column(c).to_pylist() for c in ("postings", "w", "uses"))):
                found = _List(postings, w, m)
                for u in users:
                    wanted.setdefault((u["query"], u["item_id"]), []).append((found, u["times"]))
            for (query, item), of in wanted.items():
                out += [(query, item, None if null[d] else int(ids[d]), s) for d, s in best_documents(of, len(ids), k, tie)]
        return pa.Table.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)], names=["query", "item", "doc", "score"])

    found = shards.groupBy("in_shard", "in_block").cogroup(lists.groupBy("shard", "block")).applyInArrow(
        work, "query long, item long, doc long, score long")
    order = W.partitionBy("query", "item").orderBy(F.col("score").desc(), F.col("doc").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        F.col("item").alias(id_col), "rank", F.col("doc").alias(doc_col), "score")


def op12_ranked_search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(build_index(docs), benchmark)


OP12_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
len AS (SELECT doc_id, sum(tf) AS n FROM tf GROUP BY 1),
corpus AS (SELECT count(*) AS big_n, sum(n) AS big_l FROM len),
m AS (SELECT doc_id, CAST(75 + (25 * n * big_n) // big_l AS BIGINT) AS m FROM len, corpus),
df AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * big_n + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM tf, corpus GROUP BY term, big_n),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL
), s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN df USING (term) JOIN m USING (doc_id) GROUP BY ALL
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 20
"""
