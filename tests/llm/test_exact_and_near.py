"""Exact deduplication and the near-duplicate join against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import chosen_path, exact
from newsloom.llm.components import components


def brute_exact(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[norm(t)].append(i)
    out = []
    for i, t, *_ in rows:
        ids = groups[norm(t)]
        keep = min((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


def exact_rows(frame):
    return sorted([tuple(r) for r in frame.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()], key=str)


@pytest.fixture(scope="module")
def exact_fixture(prose):
    long = prose(1, 700)
    rows = [(1, "a b"), (2, "a \t\n b"), (3, "a  b "), (4, None), (5, ""), (6, " "), (7, "é\xa0é"), (8, "é é"),
            (9, long), (10, long.replace(" ", "\n", 3)), (11, long[:-1] + "#"), (12, "#" + long), (13, long + long),
            (14, long + long), (None, "a b"), (None, "only"), (15, "twice"), (15, "twice"), (15, "other")]
    return rows + [(100 + i, "copy") for i in range(60)]


@pytest.mark.parametrize("block", [1, 7, 64, 2048])
def test_exact_dedup_for_any_block_length(documents, exact_fixture, block):
    assert exact_rows(exact.dedupe_exact(documents(exact_fixture), block=block)) == brute_exact(exact_fixture)


def test_exact_dedup_when_digests_clash(documents, exact_fixture):
    """With a route that leads all blocks to two places, content decides."""
    got = exact.dedupe_exact(documents(exact_fixture), block=64, route=lambda c: F.pmod(F.xxhash64(c), F.lit(2)))
    assert exact_rows(got) == brute_exact(exact_fixture)


def test_exact_dedup_of_nothing(documents):
    assert exact.dedupe_exact(documents([])).count() == 0


def brute_near(rows, threshold=0.8):
    sets = [frozenset(chosen_path.shingles(t.encode() if t is not None else None).tolist()) for _, t, *_ in rows]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both >= threshold * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                n[i] += 1
                n[j] += 1
                parent[find(i)] = find(j)
    smallest = {}
    for i, (d, *_) in enumerate(rows):
        smallest[find(i)] = min([x for x in (smallest.get(find(i)), d) if x is not None], default=None)
    return sorted([(d, smallest[find(i)], n[i]) for i, (d, *_) in enumerate(rows)], key=str)


def near_rows(frame):
    return sorted([tuple(r) for r in frame.select("doc_id", "class_id", "n_links").collect()], key=str)


def test_shingles_of_short_texts():
    assert len(chosen_path.shingles(None)) == len(chosen_path.shingles(b" .,; ")) == 0
    assert len(chosen_path.shingles(b"one two")) == 1
    assert len(chosen_path.shingles(b"a b c d e f g")) == 3
    assert chosen_path.shingles(b"One TWO").tolist() == chosen_path.shingles(b"one, two!").tolist()
    assert chosen_path.shingles(b"ab c").tolist() != chosen_path.shingles(b"a bc").tolist()


def test_words_of_long_texts_are_read_in_slices(monkeypatch):
    text = ("Ünï çödé  one-two\tTHREE " * 500 + "x" * 900 + " the end").encode()
    whole = chosen_path.shingles(text).tolist()
    for size in (1, 7, 1000):
        monkeypatch.setattr(chosen_path, "SLICE", size)
        assert chosen_path.shingles(text).tolist() == whole
        assert len(chosen_path.shingles(b"one two")) == 1 and len(chosen_path.shingles(b" .,; " * 9)) == 0


def test_near_duplicates_match_brute_force(documents, prose):
    rows = [(1, None), (2, ""), (3, "?!"), (4, "two words"), (5, "Two, words"), (None, "two words"), (6, "one two three four")]
    for g in range(12):
        base = prose(g, 120).split()
        for k in range(5):
            words, draw = base[:], random.Random(g * 10 + k)
            for _ in range(k):
                words[draw.randrange(len(words))] = "changed" + str(draw.random())
            rows.append((100 + g * 10 + k, " ".join(words)))
    rows += [(200 + i, prose(900 + i, 80)) for i in range(40)] + [(300, prose(0, 120)), (300, prose(0, 120))]
    assert near_rows(chosen_path.near_duplicates(documents(rows))) == brute_near(rows)


def test_large_groups_of_near_copies_and_shared_passages(documents, prose):
    """More members than a bucket's limit, so that leaders, deeper splits and blocks are used."""
    draw, base, rows = random.Random(3), prose(50, 150).split(), []
    for k in range(300):
        words = base[:]
        for _ in range(draw.randint(0, 3)):
            words[draw.randrange(len(words))] = f"w{draw.random()}"
        rows.append((k, " ".join(words)))
    shared = prose(51, 25)
    rows += [(1000 + k, shared + " " + prose(2000 + k, 25)) for k in range(300)]
    rows += [(5000 + k, "the same text in all of these rows") for k in range(200)]
    assert near_rows(chosen_path.near_duplicates(documents(rows))) == brute_near(rows)


def test_near_duplicates_of_nothing(documents):
    assert chosen_path.near_duplicates(documents([])).count() == 0


def test_many_variants_of_a_text_that_is_not_there(documents, prose):
    """Every pair of variants is near the threshold, and most are unlike any one of them by a sketch's estimate."""
    draw, base = random.Random(5), prose(77, 150).split()
    rows = []
    for i in range(450):
        words = list(base)
        for k in draw.sample(range(0, 150, 15), 2):
            words[k] = prose(5000 + 200 * i + k, 1)
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(base[:80]) + " " + prose(9000 + i, 90)) for i in range(200)]  # share half of it, alike to none
    rows += [(2000 + i, prose(12_000 + i // 2, 60)) for i in range(20)]
    want = brute_near(rows)
    got = near_rows(chosen_path.near_duplicates(documents(rows)))
    assert got == want and max(r[2] for r in want) > 100


def test_a_large_group_of_near_copies_is_split_once(documents, prose, monkeypatch):
    """Buckets of mostly near copies with many unlike their centre: rows once a set, not in each bucket of each level."""
    draw, base, rows = random.Random(9), prose(60, 150).split(), []
    for i in range(750):
        words = base[:]
        for k in draw.sample(range(0, 150, 10), 1 if i < 450 else 8):
            words[k] = f"w{i}x{k}"
        rows.append((i, " ".join(words)))
    made, stage = {}, chosen_path.stage

    def counted(df, purpose):
        out = stage(df, purpose)
        made[purpose] = made.get(purpose, 0) + out.count()
        return out

    monkeypatch.setattr(chosen_path, "stage", counted)
    assert near_rows(chosen_path.near_duplicates(documents(rows))) == brute_near(rows)
    assert 0 < made["hard-sets"] <= len(rows) and made.get("split-buckets", 0) <= len(rows)


def test_work_on_a_large_bucket_grows_with_its_members(spark, documents, prose):
    """Rows dealt to groups of far members: at most two for each member of the bucket."""
    n = 3000
    marks = spark.range(n).select(F.col("id").cast("string").cast("binary").alias("node"), F.lit(1).cast("long").alias("b"),
                                  F.col("id").cast("string").cast("binary").alias("tag"), (F.col("id") < chosen_path.LIMIT).alias("far"),
                                  F.lit(b"x" * 128).alias("sketch"))
    sizes = spark.createDataFrame([(1, n, chosen_path.LIMIT)], "b long, n long, n_far long")
    assert chosen_path._finish(marks.drop("sketch"), sizes, marks.select("node", "sketch")).count() <= 2 * n + 2 * chosen_path.LIMIT


def test_recall_on_the_given_documents(spark):
    """All pairs by brute force; no link too many, and nine in ten found at least."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    sets = [set(chosen_path.shingles((t or "").encode()).tolist()) for _, t in texts]
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    want = dict.fromkeys((d for d, _ in texts), 0)
    for x, i in enumerate(order):
        for j in order[x + 1:]:
            if len(sets[j]) * 0.8 > len(sets[i]) + 1e-9:
                break
            both = len(sets[i] & sets[j])
            if sets[i] and both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                want[texts[i][0]] += 1
                want[texts[j][0]] += 1
    got = {r.doc_id: r.n_links for r in chosen_path.op4_near_duplicates(docs).collect()}
    assert all(got[d] <= n for d, n in want.items()) and sum(got.values()) >= 0.9 * sum(want.values()) > 0


def test_runs_reach_the_recall():
    """By drawing how often a pair at the threshold agrees at the places of each level, and of the last splits."""
    draw = np.random.Generator(np.random.PCG64(3))
    missed = 0
    for _ in range(4000):
        hits = draw.poisson(chosen_path.runs_needed(0.999))
        for _ in range(chosen_path.LEVELS - 1):
            hits = draw.poisson(hits)
        missed += hits == 0
    assert missed / 4000 <= 0.003
    assert (1 - 0.8 ** chosen_path.TOGETHER) ** chosen_path.splits_needed(0.999, 0.8) <= 0.001


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
