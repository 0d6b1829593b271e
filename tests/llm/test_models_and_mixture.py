"""Language ID and toxicity by held-out accuracy, licences and the mixture by brute force."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom.llm import language, licences, mixture, toxicity
from newsloom.llm.common import words_of


def talk(language_, seed, n=40):
    """Words of a language of its own: each has syllables that the others use seldom."""
    syllables = {"aa": ["ka", "to", "mi", "shi", "ra"], "bb": ["sch", "ein", "ung", "ver", "zu"], "cc": ["eau", "oi", "que", "ment", "la"]}
    draw = random.Random(f"{language_}{seed}")
    return " ".join("".join(draw.choices(syllables[language_], k=draw.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken():
    rows = [(i, talk("aabbcc"[i % 3 * 2:][:2], i, 3 + i % 50), "aabbcc"[i % 3 * 2:][:2]) for i in range(240)]
    return rows + [(1000, None, "aa"), (1001, "", "bb"), (1002, "12 % ²½", "cc"), (1003, talk("bb", 9, 9000), None), (1004, talk("aa", 1), None),
                   (1005, talk("cc", 5).upper(), None), (None, talk("cc", 6), "cc"), (1006, "中", None), (1007, talk("bb", 2), None), (1007, talk("bb", 2), None)]


def test_languages_are_told_apart(documents, spoken):
    got = language.op8_language_id(documents(spoken)).collect()
    assert len(got) == len(spoken)
    truth = {i: lang for i, _, lang in spoken} | {1003: "bb", 1004: "aa", 1005: "cc", 1007: "bb"}
    by_id = {r.doc_id: r for r in got}
    for i in (1000, 1001, 1002):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    held = [r for r in got if r.held_out and r.doc_id < 1000]
    assert len(held) > 40 and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97
    assert all(by_id[i].lang_pred == truth[i] for i in (1003, 1004, 1005, 1007))
    assert all(0 <= r.score <= 1 for r in got)
    assert by_id[None].held_out is False and by_id[1006].lang_pred in ("aa", "bb", "cc")


def test_language_reruns_agree_and_nothing_to_learn(documents, spoken):
    a, b = (language.train_prototypes(documents(spoken), per_language=30) for _ in range(2))
    assert a.keys() == b.keys() and all((a[k] == b[k]).all() for k in a)
    assert language.train_prototypes(documents([])) == {}
    got = language.identify(documents(spoken[:5]), {}).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert language.identify(documents([]), a).count() == 0
    with pytest.raises(ValueError, match="more than 2"):
        language.train_prototypes(documents(spoken), max_languages=2)


def test_keep_identified_drops_rows_without_a_language(documents, spoken):
    docs = documents(spoken)
    kept = language.keep_identified(docs, language.train_prototypes(docs), 0.1)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in kept.collect()} == {1000, 1001, 1002, 1006}


def test_encoding_is_the_sum_of_bound_letters_for_any_block(monkeypatch):
    text = "ab ab"
    grams = language.letter_grams(text)
    assert len(grams) == 5  # .ab ab. b.a .ab ab.
    v = lambda c: language._letter(c, 64, 1).astype(int)
    want = sum(np.roll(v(x), 2) * np.roll(v(y), 1) * v(z) for x, y, z in
               [(0, 97, 98), (97, 98, 0), (98, 0, 97), (0, 97, 98), (97, 98, 0)])
    assert (language.encode([text], 64, 1)[0] == want).all()
    whole = language.encode([text, None, "zebra xylophone", "ab"], 64, 1)
    monkeypatch.setattr(language, "_GRAMS", 3)
    monkeypatch.setattr(language, "_CELLS", 4)
    assert (language.encode([text, None, "zebra xylophone", "ab"], 64, 1) == whole).all()


def brute_marginals(scores, first, pairs):
    import itertools
    total, toxic = 0.0, np.zeros(len(scores))
    for tags in itertools.product((0, 1), repeat=len(scores)):
        w = np.exp(first[tags[0]] + sum(s * t for s, t in zip(scores, tags)) + sum(pairs[a, b] for a, b in zip(tags, tags[1:])))
        total += w
        toxic += w * np.array(tags)
    return toxic / total


def test_marginals_are_those_of_all_taggings(monkeypatch):
    draw = np.random.default_rng(2)
    first, pairs = draw.normal(size=2), draw.normal(size=(2, 2))
    lengths = np.array([5, 0, 1, 9, 4, 8])
    scores = draw.normal(size=lengths.sum()) * 3
    want = np.concatenate([brute_marginals(s, first, pairs) for s in np.split(scores, np.cumsum(lengths)[:-1]) if len(s)])
    for block in (2, 4, 64):
        monkeypatch.setattr(toxicity, "BLOCK", block)
        assert np.allclose(toxicity.marginals(scores, lengths, first, pairs), want)
    assert len(toxicity.marginals(np.zeros(0), np.zeros(0, int), first, pairs)) == 0
    mask = np.arange(9) < np.array([[9], [4]])
    tag, both = toxicity.pair_marginals(np.stack([scores[6:15], np.append(scores[15:19], np.zeros(5))]), first, pairs, mask)
    assert np.allclose(tag[0, :, 1], brute_marginals(scores[6:15], first, pairs))
    assert np.allclose(tag[1, :4, 1], brute_marginals(scores[15:19], first, pairs))
    assert np.allclose(both[0].sum(axis=(1, 2)), 1) and np.allclose(both[1, 3:], 0)


@pytest.fixture(scope="module")
def scored(spark, documents, prose):
    draw, rows, labels = random.Random(5), [], []
    for i in range(500):
        words, bad = prose(i, draw.randint(5, 120)).split(), i % 6 == 0
        if bad:
            for _ in range(draw.randint(1, 3)):
                words.insert(draw.randrange(len(words)), draw.choice(["Blorg", "snark!", "vexium", "grumbleit", "grumbleos"]))
        rows.append((i, " ".join(words)))
        labels += [(i, int(bad))] if i % 10 != 9 else []
    rows += [(900, None), (901, ""), (902, "…"), (903, "Blorg"), (904, prose(3, 3000)), (904, prose(3, 3000)), (None, "the vexium"), (905, prose(6, 9000) + " snark")]
    labels += [(900, 0), (None, 1), (901, None), (0, 1)]
    marks = spark.createDataFrame([(i, 1, t, "x") for i, t in labels], "doc_id long, quality int, toxic int, text string")
    return documents(rows), marks, rows


def test_toxic_documents_and_spans_are_found(scored):
    docs, marks, rows = scored
    got = toxicity.op6_toxicity(docs, marks).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r for r in got}
    held = [r for r in got if r.held_out and r.doc_id < 500]
    assert len(held) > 60 and np.mean([r.predicted == int(r.doc_id % 6 == 0) for r in held]) > 0.97
    assert [by_id[i].predicted for i in (900, 901, 902, 903, 904, 905, None)] == [0, 0, 0, 1, 0, 1, 1]
    assert [dict(rows)[905][s.start:s.end] for s in by_id[905].spans] == ["snark"]
    assert [by_id[i].spans for i in (900, 901, 902, 904)] == [[]] * 4 and all(0.5 <= s.p <= 1 for r in got for s in r.spans)


def test_toxicity_without_labels_or_documents(spark, documents, scored):
    docs, marks, _ = scored
    assert toxicity.train_field(docs, marks.where("toxic = 0")) is None
    assert toxicity.train_field(documents([]), marks) is None
    got = toxicity.op6_toxicity(docs, marks.limit(0)).collect()
    assert {(r.score, r.predicted) for r in got} == {(0.0, 0)}
    assert toxicity.op6_toxicity(documents([]), marks).count() == 0


@pytest.mark.parametrize("expression, labels, free", [
    ("MIT", {"mit"}, True), ("MIT OR GPL-2.0-only", {"mit", "gpl"}, True), ("MIT AND GPL-2.0-only", {"mit", "gpl"}, False),
    ("GPL-2.0-or-later WITH Classpath-exception-2.0", {"gpl"}, False),
    ("(MIT OR GPL-3.0) AND Apache-2.0", {"mit", "gpl", "apache"}, True), ("GPL-3.0 OR MIT AND AGPL-3.0", {"gpl", "mit", "agpl"}, False),
    ("(LGPL-2.1+ OR (BSD-3-Clause AND ISC)) */", {"lgpl", "bsd", "isc"}, True), ("CC-BY-NC-4.0", {"cc-by-nc"}, False),
    ("LicenseRef-Own", {"licenseref-own"}, False), ("mit -->", {"mit"}, True),
])
def test_licence_expressions(expression, labels, free):
    assert licences.evaluate(expression) == (labels, free)


@pytest.mark.parametrize("expression", ["", "OR", "MIT OR", "(MIT", "()", "AND MIT"])
def test_broken_licence_expressions(expression):
    assert licences.evaluate(expression) is None


@pytest.mark.parametrize("text, labels, free", [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software", {"mit"}, True),
    ("Redistribution and use in source and binary forms, with or without", {"bsd"}, True),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose", {"isc"}, True),
    ("Permission is granted to anyone to use this software for any purpose", {"zlib"}, True),
    ("Distributed under the Boost Software License, Version 1.0.", {"bsl"}, True),
    ("This is free and unencumbered software released into the public domain.", {"unlicense", "public-domain"}, True),
    ("under the Artistic License", {"artistic"}, False), ("Permission is hereby granted", set(), None),
])
def test_openings_of_licence_texts(text, labels, free):
    got = licences.scan(text.encode(), licences._automaton())
    assert (set(filter(None, got["labels"].split(","))), got["permissive"], got["n_base"]) == (labels, free, 0)


def brute_licences(text):
    w = [x.decode() for x in words_of(text.encode() if text else None)]
    places = [(i, label) for phrase, label in licences.BASE_PHRASES.items() for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_licence_scan_matches_brute_force(documents):
    draw = random.Random(9)
    vocabulary = "mit MIT license License, apache general public PUBLIC lesser gnu 2.0 summit licenses é word".split()
    rows = [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, 60)))) for i in range(80)]
    rows += [(100, None), (101, ""), (102, "MIT-License; mit\nlicense"), (103, "mit license " * 20_000), (None, "Apache License"), (104, "mitlicense"),
             (105, "/* SPDX-License-Identifier: (MIT OR GPL-2.0) AND Apache-2.0 */\nSPDX-License-Identifier: BSD-3-Clause"), (105, "twice"), (105, "twice"),
             (106, "Licensed under CC BY-NC 4.0."), (107, "GNU Affero General Public License")]
    got = licences.op9_licence_scan(documents(rows)).collect()
    key = lambda x: (str(x[0]), *map(str, x[1:]))
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=key) == sorted(
        ((i, *brute_licences(t)) for i, t in rows), key=key)
    by_id = {r.doc_id: r for r in got}
    assert by_id[105].labels in ("", "apache,bsd,gpl,mit") and by_id[106].labels == "cc-by,cc-by-nc"
    assert "agpl" in by_id[107].labels and by_id[107].base_labels == "gpl"
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in got)
    assert licences.op9_licence_scan(documents([])).count() == 0


def brute_targets(sizes, weights, total, cap):
    """By small steps: pour out the total in proportion to the weights of those that are not full."""
    got, left = dict.fromkeys(sizes, 0.0), total
    while left > 1e-9:
        open_ = [s for s in sizes if got[s] < cap * sizes[s] - 1e-9]
        if not open_:
            break
        unit = min([left / sum(weights[s] for s in open_), *((cap * sizes[s] - got[s]) / weights[s] for s in open_)])
        for s in open_:
            got[s] += weights[s] * unit
            left -= weights[s] * unit
    return got


def test_targets_share_the_excess_anew(spark):
    for seed in range(30):
        draw = random.Random(seed)
        sizes = {s: draw.randint(0, 50) for s in "abcdef"}
        weights = {s: draw.choice([5, 2, 1]) for s in sizes}
        sources = spark.createDataFrame([(s, float(weights[s]), n) for s, n in sizes.items()], "source string, weight double, source_size long")
        got = {r.source: r.target for r in mixture.source_targets(sources, 1.5 * sum(sizes.values()), 2).collect()}
        assert got == pytest.approx(brute_targets(sizes, weights, 1.5 * sum(sizes.values()), 2))


def test_flow_is_the_largest_and_cheapest():
    """Against a search over all flows of tiny networks."""
    import itertools
    for seed in range(25):
        draw = random.Random(seed)
        sizes = [draw.randint(0, 3) for _ in range(3)]
        members = [sorted(draw.sample(range(2), draw.randint(1, 2))) for _ in sizes]
        targets = [draw.randint(0, 5) for _ in range(2)]
        arcs = [(p, s) for p, m in enumerate(members) for s in m]
        best = None
        for flow in itertools.product(*(range(2 * sizes[p] + 1) for p, _ in arcs)):
            out, into = [0] * 3, [0] * 2
            for (p, s), x in zip(arcs, flow):
                out[p] += x
                into[s] += x
            if all(o <= 2 * c for o, c in zip(out, sizes)) and all(i <= t for i, t in zip(into, targets)):
                value = (sum(flow), -sum(max(0, o - c) for o, c in zip(out, sizes)))
                best = max(best or value, value)
        got = mixture.route(sizes, members, targets, 2)
        out = [sum(r) for r in got]
        assert (sum(out), -sum(max(0, o - c) for o, c in zip(out, sizes))) == best
        assert all(sum(r[m.index(s)] for r, m in zip(got, members) if s in m) <= t for s, t in enumerate(targets))


def test_mixture_of_documents(documents, prose):
    draw = random.Random(12)
    rows = [(i, prose(i, draw.randint(1, 60)), None, draw.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(900)]
    rows += [(2000, None, None, "a"), (2001, "", None, "b"), (2002, " \t\n", None, "e"), (None, "some words", None, "b"), (2003, prose(5, 30), None, "c"), (2003, prose(5, 30), None, "c")]
    got = mixture.op10_mix_sources(documents(rows)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixture.op10_mix_sources(documents(rows)).collect()), key=str)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(i), size(t)) for i, t, *_ in rows)
    sources, words = {i: s for i, _, _, s in rows}, defaultdict(int)
    for _, t, _, s in rows:
        words[s] += size(t)
    names = sorted(words, key=lambda s: (s is None, s or ""))
    targets = brute_targets(words, {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, 1.5 * sum(words.values()), 2)
    taken = defaultdict(int)
    for r in got:
        s = sources[r.doc_id]
        assert r.source_size == words[s] and r.target == pytest.approx(targets[s]) and 0 <= r.taken <= 2 * r.size and r.taken % max(1, r.size) == 0
        taken[s] += r.taken
    assert all(abs(taken[s] - targets[s]) <= 60 for s in words)
    assert mixture.op10_mix_sources(documents([])).count() == 0


def test_rows_that_share_an_id_are_drawn_apart(documents, prose):
    """A source whose rows have no id or one id; rows alike in id and text too."""
    rows = [(None, prose(i, 20 + i % 3), None, "a") for i in range(200)] + [(7, prose(900 + i, 30), None, "b") for i in range(300)]
    rows += [(8, prose(5000, 25), None, "c")] * 400 + [(20 + i, prose(i, 40), None, "d") for i in range(10)]
    source, taken, targets = {None: "a", 7: "b", 8: "c"}, defaultdict(int), {}
    got = mixture.op10_mix_sources(documents(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        s = source.get(r.doc_id, "d")
        taken[s] += r.taken
        targets[s] = r.target
    assert all(abs(taken[s] - targets[s]) <= 20 for s in "abcd"), (taken, targets)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixture.op10_mix_sources(documents(rows)).collect()), key=str)


def test_sources_and_targets_match_sql(documents, prose):
    import duckdb

    draw = random.Random(14)
    rows = [(i, prose(i, draw.randint(0, 30)), None, draw.choice(["a", "B", "é", "", None, "zz"])) for i in range(300)] + [(400, None, None, "only null")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, t, s) for i, t, _, s in rows])
    want = con.sql(r"""
        WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
        s AS (SELECT source, sum(size) AS n, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w FROM d GROUP BY source),
        level AS (
          SELECT 0 AS step, 1.5 * (SELECT sum(n) FROM s) / (SELECT sum(w) FROM s) AS unit
          UNION ALL
          SELECT step + 1, (1.5 * (SELECT sum(n) FROM s) - (SELECT coalesce(sum(2 * n) FILTER (w * unit > 2 * n), 0) FROM s))
            / (SELECT sum(w) FILTER (w * unit <= 2 * n) FROM s) FROM level WHERE step < 8)
        SELECT doc_id, size, CAST(n AS BIGINT), least(2.0 * n, w * (SELECT max(unit) FROM level))
        FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source ORDER BY doc_id""").fetchall()
    got = sorted((r.doc_id, r.size, r.source_size, r.target) for r in mixture.op10_mix_sources(documents(rows)).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([float(r[3]) for r in want])


def test_two_hundred_thousand_sources(spark):
    docs = spark.range(200_000).select(F.col("id").alias("doc_id"), F.format_string("s%06d", "id").alias("source"), F.lit(3).alias("size"))
    weights = mixture.source_weights(docs)
    mixed, sources = mixture.mix_with_sources(docs.select("doc_id", F.array("source").alias("members"), "size"), weights)
    assert sources.count() == 200_000 and {r.weight: r.n for r in sources.groupBy("weight").agg(F.count("*").alias("n")).collect()} == {
        5.0: 66_667, 2.0: 66_667, 1.0: 66_666}
    assert sources.agg(F.sum("target")).first()[0] == pytest.approx(900_000)
    joined = mixed.join(sources, F.get("members", F.lit(0)) == F.col("source"))
    assert joined.count() == 200_000 and joined.where(F.abs(F.col("copies") * 3 - F.col("target")) > 1.5).count() == 0


def test_overlapping_sources(spark):
    rows = [(i, [["x"], ["y"], ["y", "x", "x"], [], None][i % 5], 10) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, members array<string>, size long")
    got = {r.doc_id: r for r in mixture.mix(docs, {"x": 3, "y": 1}, total_share=1.0).collect()}
    taken = defaultdict(int)
    for r in got.values():
        taken[tuple(r.members or ())] += r.copies * r.size
    assert taken[()] == 0 and got[0].members == ["x"] and got[2].members == ["x", "y"]
    # 3000 words, of which x gets 2250 at most from itself and the overlap, y 750
    assert sum(taken.values()) == pytest.approx(3000, abs=20)
    assert all(r.copies <= 1 or sum(taken.values()) > 2990 for r in got.values())


def test_long_texts_are_read_in_slices(monkeypatch, documents, spoken):
    """Slices of a few characters give the trigrams, vectors, sizes and letters of whole texts."""
    import numpy as np

    texts = [r[1] for r in spoken[:20]] + ["", None, "..", "a", "ab cd", "x" * 300, "Ünï çödé — ß! " * 40, " a ", "中文没有空格" * 50, "1 2 3 b"]
    known = np.zeros(0x110000, bool)
    known[[ord(c) for c in "abcdefghij中"]] = True
    whole = [language.letter_grams(t).tolist() for t in texts], language._measure(texts, 64, 1, known)
    for size in (3, 10, 64):
        monkeypatch.setattr(language, "_SLICE", size)
        assert [language.letter_grams(t).tolist() for t in texts] == whole[0]
        for a, b in zip(language._measure(texts, 64, 1, known), whole[1]):
            assert (a == b).all()
    monkeypatch.undo()
    rows = [*spoken, (9000, " ".join(r[1] for r in spoken[:10]) * 200, "aa")]
    assert {r.doc_id: r.lang_pred for r in language.op8_language_id(documents(rows)).where("doc_id = 9000").collect()}[9000] != "und"
