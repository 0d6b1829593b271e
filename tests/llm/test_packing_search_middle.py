"""Packing, ranked search and fill-in-the-middle by brute force and round trips."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import oracle_check
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from newsloom.llm import fill_middle, packing, queries, ranked_search
from newsloom.llm.common import words_of

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("term", T.StringType()),
                      T.StructField("shard", T.LongType()), T.StructField("doc_id", T.LongType())])


@pytest.mark.parametrize("name", ["op12_ranked_search", "op13_fill_middle"])
def test_queries_equal_their_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert oracle_check.compare(got, oracle_check.connect(SF).execute(queries.ORACLE[name]).df()) == ""


# packing


def test_encoder_gives_the_library_s_ids(monkeypatch):
    library, own, draw = Tokenizer.from_file(VOCABULARY), packing.ByteEncoder(VOCABULARY, bound=3000), random.Random(2)
    parts = [" ", "  ", " ", "\n", "\n\n", "\t", "\r\n", "a", "é", "Éa, b.", "1", "23", "'s", "'", "ll", "\xa0", "　", " ", "\x85", "\x1c", "!!", ".",
             ", ", ". ", ".\n", "don't", "<|endoftext|>", "😀", "中.", "\x00", "word", "​", "́", "x" * 40]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 16))) for _ in range(6000)]
    want = [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    for size in (1 << 20, 8):  # whole texts, and slices of a few characters
        monkeypatch.setattr(packing, "_LONG", size)
        assert [x for i in range(0, 6000, 500) for x in own.encode_all([t.encode() for t in texts[i:i + 500]])] == want
    assert own.encode_all([None, b""]) == [b"", b""] and own.encode_all([]) == []


def packed_rows(spark, documents, rows):
    frame = documents(rows)
    return frame, packing.pack(packing.cut_documents(frame, VOCABULARY))


def test_pieces_and_places(spark, documents, prose):
    rows = [(i, prose(i, 5 + 13 * (i % 40)), "aa") for i in range(150)]
    rows += [(200, None), (201, ""), (None, "null id"), (None, "null id"), (3, "again"), (3, "again"), (202, prose(1, 9000)), (203, " a" * 1023),
             (204, " a" * 1024), (205, " a" * 2047)]
    frame, packed = packed_rows(spark, documents, rows)
    got = packed.collect()
    library, want = Tokenizer.from_file(VOCABULARY), Counter()
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids), 1024), len(ids)]
        want.update((doc_id, k, a, b - a, struct.pack(f"<{b - a}I", *ids[a:b])) for k, (a, b) in enumerate(zip(cuts, cuts[1:])))
    assert Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length, bytes(r.ids)))
    for inside in places.values():
        inside.sort()
        assert [o for o, *_ in inside] == [sum(n for _, n, _ in inside[:i]) for i in range(len(inside))]
        assert sum(n for _, n, _ in inside) <= 1024
    assert len(places) <= math.ceil(sum(r.length for r in got) / 1024) * 1.05 + 2
    whole = {r.sequence_id: (bytes(r.ids), list(r.lengths)) for r in packing.sequences(packed.select("*")).collect()}
    assert sorted(x for x, _ in whole.values()) == sorted(b"".join(i for *_, i in inside) for inside in places.values())


def test_query_digests(spark, documents, prose):
    rows = [(i, prose(i, 30 * i), "aa") for i in range(50)]
    got = packing.op11_pack_sequences(documents(rows), VOCABULARY)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    known = {(r.doc_id, r.piece): zlib.crc32(bytes(r.ids)) for r in packing.cut_documents(documents(rows), VOCABULARY).collect()}
    assert {(r.doc_id, r.piece): r.ids_crc32 for r in got.collect()} == known


def test_lengths_out_of_bounds_and_no_pieces(spark):
    frame = spark.createDataFrame([(1, 10), (2, None), (3, 0), (4, 11), (5, 4), (6, 6)], "id long, length int")
    got = {r.id: (r.sequence_id, r.offset) for r in packing.pack(frame, capacity=10).collect()}
    assert got[2] == got[3] == got[4] == (None, None)
    assert got[5][0] == got[6][0] != got[1][0] and got[1][1] == 0
    assert packing.pack(frame.limit(0), capacity=10).collect() == []


def fewest(lengths, capacity):
    """The least number of sequences, by trying all."""
    best = len(lengths)

    def put(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + lengths[i] <= capacity and bins[k] not in bins[:k]:
                put(i + 1, [*bins[:k], bins[k] + lengths[i], *bins[k + 1:]])
        put(i + 1, [*bins, lengths[i]])

    put(0, [])
    return best


def test_plans_use_up_all_counts():
    draw = random.Random(3)
    for trial in range(120):
        capacity = draw.choice([7, 20, 50, 1024])
        counts = {draw.randint(1, capacity): draw.choice([1, 2, 3, 50, 10_000]) for _ in range(draw.randint(0, 40))}
        plan, used = packing.plan_sequences(counts, capacity), Counter()
        for times, held in plan:
            assert times > 0 and sum(held) <= capacity
            for n in held:
                used[n] += times
        assert used == Counter(counts)
    for trial in range(60):
        lengths = sorted((draw.randint(3, 30) for _ in range(9)), reverse=True)
        n = sum(t for t, _ in packing.plan_sequences(Counter(lengths), 30))
        assert n <= fewest(lengths, 30) + 1


def test_gaps_are_filled_exactly_by_one_two_or_three():
    for counts in ({60: 5, 40: 5}, {60: 5, 25: 5, 15: 5}, {60: 5, 20: 5, 11: 5, 9: 5}, {60: 4, 20: 8}, {58: 3, 14: 9}):
        plan = packing.plan_sequences(counts, 100)
        assert all(sum(held) == 100 for _, held in plan)
    index = packing.Complements({5: 1, 7: 2, 9: 1}, 30)
    assert index.fill(10) is None and index.fill(14) == (9, 5) and index.fill(19) == (7, 7, 5) and index.fill(15) is None
    index.take(7, 1)
    assert index.fill(14) == (9, 5) and index.fill(19) is None


# ranked search


def brute_search(docs, items, k=20):
    bags = [(d, Counter(words_of((t or "").encode()))) for d, t, *_ in docs]
    bags = [(d, b) for d, b in bags if b]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in set(items):
        words, scores = Counter(words_of((text or "").encode())), []
        for d, bag in bags:
            m = 75 + (25 * sum(bag.values()) * n) // total
            score = sum(times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((10**9 * bag[w]) // (1000 * bag[w] + 12 * m))
                        for w, times in words.items() if bag[w])
            if score > 0:
                scores.append((-score, d is None, d or 0, d))
        out += [(item, r, d, -s) for r, (s, *_, d) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus(prose):
    draw = random.Random(8)
    pool = prose(1, 300, "aeinst").split()
    text = lambda n: " ".join(pool[min(int(draw.expovariate(0.02)), 299)] for _ in range(n))
    docs = [(i, text(draw.randint(1, 90)), "aa") for i in range(500)]
    docs += [(600 + i, docs[i % 3][1], "aa") for i in range(60)]  # ties
    docs += [(700, None), (701, ""), (702, "!?"), (None, docs[0][1]), (None, docs[0][1]), (5, docs[0][1]), (703, "É é ÀB ab"), (704, text(30_000))]
    items = [(i, text(draw.randint(1, 40))) for i in range(30)] + [(100, None), (101, ""), (102, "unheard-of"), (103, docs[0][1]), (103, docs[0][1]),
                                                                   (104, docs[1][1] + " " + docs[1][1]), (104, docs[2][1]), (None, docs[0][1]), (105, "É Ab")]
    return docs, items


@pytest.mark.parametrize("shard, block", [(8192, 256), (37, 5)])
def test_search_equals_brute_force(spark, documents, corpus, shard, block):
    docs, items = corpus
    frame = spark.createDataFrame([(*i, "x", 1, 1) for i in items], ITEMS)
    index = ranked_search.build_index(documents(docs), shard_docs=shard)
    got = ranked_search.search(index, frame, block=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items)


def test_search_over_many_shuffle_partitions(spark, documents, corpus):
    """Groups of a shard and a block meet though no partitions are put together."""
    docs, items = corpus
    frame = spark.createDataFrame([(*i, "x", 1, 1) for i in items], ITEMS)
    changed = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {key: spark.conf.get(key) for key in changed}
    try:
        for key, value in changed.items():
            spark.conf.set(key, value)
        got = ranked_search.search(ranked_search.build_index(documents(docs), shard_docs=100), frame, block=10).collect()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sorted(map(tuple, got), key=str) == brute_search(docs, items)


def test_search_of_nothing(spark, documents, corpus):
    docs, items = corpus
    empty = spark.createDataFrame([(*i, "x", 1, 1) for i in items], ITEMS)
    assert ranked_search.op12_ranked_search(documents(docs).limit(0), empty).collect() == []
    assert ranked_search.op12_ranked_search(documents(docs), empty.limit(0)).collect() == []
    assert ranked_search.op12_ranked_search(documents([(1, None), (2, "")]), empty).collect() == []


def test_long_texts_are_counted_in_slices(monkeypatch):
    text = b"one two " * 5000 + b"x" * 3000 + b" three"
    whole, sliced = ranked_search._Shard(), ranked_search._Shard()
    whole.add(1, text)
    monkeypatch.setattr(ranked_search, "_SLICE", 100)
    sliced.add(1, text)
    rows = [sorted((r["term"] or b"", r["postings"] or b"", r["lengths"] or b"") for b in s.rows(0) for r in b.to_pylist()) for s in (whole, sliced)]
    assert rows[0] == rows[1] and len(rows[0]) == 5


def test_reading_stops_before_the_lists_end():
    """One document stands out, so membership is sure after part of the postings; scores are whole all the same."""
    draw = np.random.Generator(np.random.PCG64(1))
    n, m, lists = 5000, np.full(5000, 100), []
    for weight in (9000, 8000, 300, 200):
        docs = np.sort(draw.choice(n, 20 if weight > 1000 else 4000, replace=False))
        docs[:20] = np.arange(20)
        docs = np.unique(docs)
        tf = draw.integers(1, 4, len(docs))
        tf[:20] += 5 if weight > 1000 else 0
        lists.append((ranked_search._List(np.stack([docs, tf], 1).astype("<u4").tobytes(), weight, m), 1))
    reads, tie = [], np.arange(n)
    got = ranked_search.best_documents(lists, n, 20, tie, reads)
    total = np.zeros(n, np.int64)
    for x, times in lists:
        total[x.doc] += x.impact * times
    order = np.lexsort((tie, -total))[:20]
    assert got == [(int(d), int(total[d])) for d in order]
    assert reads[0] < sum(len(x.doc) for x, _ in lists) / 2


# fill-in-the-middle


def brute_middle(doc_id, text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text or "")
    n, digest = len(units), hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text or ""
    p, m, s = ("".join(units[x:y]) for x, y in ((0, a), (a, b), (b, n)))
    spm = h[3] % 100 < 50
    return n, "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


def test_middles_equal_brute_force(spark, documents, prose):
    draw = random.Random(6)
    parts = ["a", "é😀", "\n", "\n\n", "$1", "\\", "<", ">", "P>", "\r\n", "{2}", "%d", " ", "\x85", "(?s)", " "]
    rows = [(i, "".join(draw.choice(parts) for _ in range(draw.randint(0, 12)))) for i in range(400)]
    rows += [(500, None), (501, ""), (502, "a<P>b\n"), (503, "x\n<M>"), (None, "no\nid\n"), (None, "no\nid\n"), (3, "b\na\n"), (-7, "minus\none"),
             (504, "line\n" * 200_000), (505, prose(1, 200_000)), (506, "\n" * 100_000)]
    got = fill_middle.fill_in_middle(documents(rows)).withColumn("back", fill_middle.restored("output", "form")).collect()
    want = Counter((d, *brute_middle(d, t), t or "") for d, t in rows)
    assert Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got) == want
    digests = {(r.doc_id, r.output_sha256, r.restored_sha256) for r in fill_middle.op13_fill_middle(documents(rows)).collect()}
    assert digests == {(d, hashlib.sha256(brute_middle(d, t)[-1].encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows}


def test_share_of_texts_and_other_units(spark, documents, prose):
    frame = documents([(i, prose(i, 12)) for i in range(400)])
    some = fill_middle.fill_in_middle(frame, percent=30, spm_percent=0, unit=r"\S+\s*", marks=("[a$]", "[b\\]", "[c]"))
    forms = Counter(r["form"] for r in some.collect())
    assert set(forms) == {"plain", "psm"} and 80 < forms["psm"] < 160
    back = some.withColumn("back", fill_middle.restored("output", "form", ("[a$]", "[b\\]", "[c]"))).join(frame.select("doc_id", "text"), "doc_id")
    assert back.where("back <> text OR n <> 12").count() == 0
    assert back.where((F.col("form") == "psm") & (F.length("output") != F.length("text") + 11)).count() == 0
    assert fill_middle.op13_fill_middle(documents([])).collect() == []
