"""The pipeline's stages against brute-force versions, each on what the one before kept."""

import random
import struct
import tracemalloc
import weakref
import zlib
from collections import Counter

import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from newsloom.llm import common, language, token_store
from test_decontaminate_and_lines import brute_hits
from test_exact_and_near import brute_near

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory, prose):
    draw, folder = random.Random(4), tmp_path_factory.mktemp("pipeline")
    letters = {"aa": "etaoinshr", "bb": "zqxjvkwyg"}
    items = [(1, prose(1, 25, letters["aa"])), (2, prose(2, 12, letters["aa"])), (3, None)]
    rows = [(i, prose(10 + i, draw.randint(20, 120), letters[lang]), lang, f"s{i % 3}") for i in range(160) for lang in ["ab"[i % 2] * 2]]
    rows += [(200 + i, rows[i][1], rows[i][2], "s0") for i in range(30)]
    rows += [(300 + i, rows[i][1] + " more", rows[i][2], "s1") for i in range(0, 30, 3)]
    rows += [(400 + i, prose(700 + i, 30, letters["aa"]) + " " + items[i % 2][1], None, "s2") for i in range(8)]
    rows += [(500, None, None, None), (501, "", "aa", "s1"), (502, "12 34", None, "s1"), (503, "слово из букв", None, "s2"), (None, prose(5, 40, letters["bb"]), None, None)]
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), items


def test_every_stage(spark, tables):
    folder, items = tables
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        path = f"{folder}/stage{k}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        assert name == "token_store" or docs.columns == COLUMNS
        after = [tuple(r) for r in docs.collect()]
        kept.append(len(after))
        if name == "language_id":
            assert sorted(set(before) - set(after), key=str) == sorted([r for r in before if r[0] in (500, 501, 502, 503)], key=str)
        elif name == "near_duplicates":
            first = {d for d, c, _ in brute_near(before) if d == c}
            assert Counter(after) == Counter(r for r in before if r[0] in first)
        elif name == "decontamination":
            clean = {d for d, *_, hit in brute_hits(before, items) if not hit}
            assert Counter(after) == Counter(r for r in before if r[0] in clean) and len(after) < len(before)
        elif name == "mixture":
            times = Counter(after)
            assert set(times) <= set(before) and max(times.values()) == 2 and all(r[1] for r in times)
        else:
            library, start, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
            for d, text, *_ in sorted(before, key=lambda r: (r[0] is not None, r[0] or 0)):
                ids = library.encode(text, add_special_tokens=False).ids + [2]
                want.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
                start += len(ids)
            assert sorted(after, key=lambda r: r[1]) == want
    assert corpus_pipeline.run(spark, folder).count() == kept[-1]


def test_no_documents(spark, tables, tmp_path):
    folder, _ = tables
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_short_labelled_documents_stay(spark, prose):
    """Words whose trigrams are rare in their language, next to texts of other letters or of none."""
    rows = [(i, prose(3000 + i, 60), "aa") for i in range(150)]
    short = [(1000, "Wyxy.", "aa"), (1001, "J.", "aa"), (1002, "V.\nKwyz qvyj.", "aa"), (1003, "Zxgb jmpq", None)]
    short += [(1010 + i, f"{a}{b} {b}{c}", "aa") for i, (a, b, c) in enumerate(zip("bcfgjkmpqv", "wxyzbcfgjk", "mpqvwxyzbc"))]
    gone = [(2000, "слово", None), (2001, "о", None), (2002, "12 34", None), (2003, "слово из букв", None),
            (2004, prose(1, 300, "zqxjvkwygbpfm"), None), (2005, None, None), (2006, "", "aa")]
    rows += short + [(r[0] + 5000, r[1], r[2]) for r in short] + gone
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    kept = {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()}
    assert {r[0] for r in rows} - kept == {r[0] for r in gone}


def test_rows_that_share_an_id_are_told_apart_by_their_text(spark, prose, tmp_path):
    """Null and repeated ids, and rows that repeat both id and text."""
    a, b, c, d, e = (prose(800 + i, 40) for i in range(5))
    rows = [(1, a, "x"), (None, a + " more", "x"), (None, b, "x"), (2, a, "x"), (2, c, "x"), (3, d, "y"), (3, d, "x"), (3, d + " more", "x"),
            (None, e, "x"), (None, e, "x"), (1, "..", "x"), (1, "..", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = sorted(map(tuple, corpus_pipeline.keep_one_of_each_class(spark, docs, "").collect()), key=str)
    first = next(r for r in got if r[0] == 3)
    assert first in [(3, d, "x"), (3, d + " more", "x")]
    assert got == sorted([(1, a, "x"), (None, b, "x"), (2, c, "x"), first, (None, e, "x"), (1, "..", "x")], key=str)
    item = prose(900, 20)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, a, "x"), (None, b + " " + item, "x"), (4, c, "x"), (4, item, "x"), (5, d, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    clean = sorted(map(tuple, corpus_pipeline.keep_clean_of_benchmark(spark, docs, str(tmp_path)).collect()), key=str)
    assert clean == sorted([rows[0], rows[2], rows[4]], key=str)


def test_a_worker_does_not_hold_the_words_of_an_earlier_stage():
    path = public_tokenizers.path("word_bpe_49k.json")
    held = weakref.ref(token_store.encoder(path))
    ids = token_store.encoder(path).encode(b"some words")
    assert token_store.encoder(path) is held()
    language.encode(["some words"])
    assert held() is None
    assert token_store.encoder(path).encode(b"some words") == ids


def test_measuring_texts_of_many_trigrams_takes_little_memory(prose):
    texts = [prose(i, 60, "abcdefghijklmnopqrstuvwxyz") for i in range(600)]
    language.encode(texts[:1])
    tracemalloc.start()
    vectors, sizes, _ = language._measure(texts, language.DIMENSIONS, language.SEED)
    language._scale(vectors, sizes)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 36 << 20


def test_pieces_are_bounded_in_rows_and_bytes():
    batch = pa.RecordBatch.from_pydict({"text": pa.array(["ab", None, "", "abcdefgh", "a", "b", "c", "d"])})
    assert [p.column("text").to_pylist() for p in common.pieces(batch, "text", 6, 3)] == [["ab", None, ""], ["abcdefgh"], ["a", "b", "c"], ["d"]]
