"""Winnowing and line templates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from newsloom.llm import decontaminate, line_templates

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_hits(docs, items, span=10):
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        n = min(span, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[k:k + n])].add(i)
    out = []
    for d, t, *_ in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= ids
        names = sorted(str(i) for i in found if i is not None)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def op5_rows(documents, spark, docs, items):
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n long")
    got = decontaminate.op5_decontaminate(documents(docs), bench)
    return sorted([tuple(r) for r in got.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()], key=str)


def test_windows_are_found_wherever_they_stand(documents, spark, prose):
    items = [(1, prose(1, 30)), (2, prose(2, 10)), (3, "short item here"), (4, "Ärger É"), (5, None), (6, "?!"), (7, prose(1, 12)),
             (None, prose(9, 11)), (8, "one"), (8, prose(8, 14)), (10, "x " * 25), (9, prose(2, 10))]
    draw, docs = random.Random(4), [(0, None), (1, ""), (2, "."), (3, "one"), (4, "ÄRGER é"), (5, "Ärger, É!"), (6, "x " * 60)]
    for k in range(60):
        _, t = items[draw.randrange(len(items))]
        w = words(t)
        part = w[draw.randrange(len(w) + 1):][:draw.randint(5, 20)] if w else []
        docs.append((100 + k, f"{prose(k, draw.randint(0, 30))}; {', '.join(part).upper()}. {prose(500 + k, draw.randint(0, 9))} {' '.join(part)}"))
    docs += [(None, prose(1, 30)), (7, prose(2, 10)), (7, prose(2, 10)), (7, "other text of the same id"), (11, prose(1, 30) * 50)]
    assert op5_rows(documents, spark, docs, items) == brute_hits(docs, items)


def test_many_windows_of_repeated_words(documents, spark):
    """Ties among the hashes of a window, and items that differ in one word."""
    draw = random.Random(6)
    text = lambda n: " ".join(draw.choice(["a", "b"]) for _ in range(n))
    items = [(i, text(draw.randint(8, 14))) for i in range(12)]
    docs = [(i, text(400)) for i in range(20)]
    assert op5_rows(documents, spark, docs, items) == brute_hits(docs, items)


def test_empty_sides(documents, spark):
    docs = [(1, "some words"), (2, None)]
    assert op5_rows(documents, spark, docs, []) == brute_hits(docs, [])
    assert op5_rows(documents, spark, [], [(1, "some words")]) == []
    assert op5_rows(documents, spark, docs, [(1, None), (2, "..")]) == brute_hits(docs, [])


def brute_lines(docs, min_docs=3, agree=0.7):
    lines = []
    for d, t, *_ in docs:
        for pos, line in enumerate((t or "").split("\n")):
            w = tuple("<*>" if re.search("[0-9]", x) else x for x in re.findall(r"[^\x20\x09-\x0D]+", line))
            lines.append((d, t, pos, w, line))
    many = lambda xs: len({x[:2] for x in xs})
    gone, left = set(), [x for x in lines if x[3]]
    for depth in (2, 4, None):
        key = (lambda x: x[4] if set(x[3]) == {"<*>"} else x[3]) if depth is None else (lambda x: (len(x[3]), x[3][:depth]))
        nodes = defaultdict(list)
        for x in left:
            nodes[key(x)].append(x)
        left = []
        for xs in nodes.values():
            if many(xs) < min_docs:
                continue
            if depth is None:
                gone |= {x[:3] for x in xs}
                continue
            constant = [Counter(place).most_common(1)[0] for place in zip(*(x[3] for x in xs))]
            constant = [token if n >= agree * len(xs) else None for token, n in constant]
            fit = []
            for x in xs:
                same = [i for i, (a, b) in enumerate(zip(x[3], constant)) if a == b != "<*>"]
                counted = sum((a, b) != ("<*>", "<*>") for a, b in zip(x[3], constant))
                if len(same) >= agree * counted and any(i >= depth for i in same):
                    fit.append(x)
            if many(fit) < min_docs:
                fit = []
            gone |= {x[:3] for x in fit}
            left += [x for x in xs if x not in fit]
    out = []
    for d, t, *_ in docs:
        parts = (t or "").split("\n")
        kept = [p for i, p in enumerate(parts) if (d, t, i) not in gone]
        out.append((d, None if t is None else "\n".join(kept), 0 if t is None else len(parts), len(parts) - len(kept)))
    return sorted(out, key=str)


def line_rows(frame):
    return sorted([tuple(r) for r in frame.select("doc_id", "text", "n_lines", "n_dropped").collect()], key=str)


def test_line_templates_match_brute_force(documents, prose):
    draw, docs = random.Random(8), [(1, None), (2, ""), (3, "\n\n"), (4, "Page 1 of 9\r\n\tPage 2 of 9"), (5, "Page 3 of 17"), (6, "Page x7 of y8")]
    for k in range(60):
        lines = [prose(k * 7 + i, draw.randint(1, 9)) for i in range(draw.randint(0, 4))]
        if k % 2:
            lines.insert(draw.randint(0, len(lines)), f"user u{k} logged in from host at {k}:00")
        if k % 3 == 0:
            lines.append(f"Licensed under the {draw.choice(['MIT', 'BSD', 'Apache'])} license of this site .")
        if k % 5 == 0:
            lines += ["read  more", "read more"]
        docs.append((100 + k, "\n".join(lines)))
    docs += [(None, "read more\nown line of the row"), (7, "read more"), (7, "read more"), (7, "again read more")]
    docs += [(8, "no digit " * 3 + "x" * 5000 + "\n" + "9" * 5000)]
    got = line_rows(line_templates.drop_recurring_lines(documents(docs)))
    assert got == brute_lines(docs)
    assert any(r[3] for r in got) and any(r[3] == 0 for r in got)


def test_line_templates_of_nothing(documents):
    assert line_templates.drop_recurring_lines(documents([])).count() == 0


def test_lines_do_not_agree_by_fields_or_leading_tokens_alone(documents):
    """Rows of numbers, and lines of the same four tokens with another last one, are no template."""
    places = ["Avignon", "Bremen", "Cadiz", "Derby", "Essen"]
    docs = [(k, f"{k}.5 1{k} 20{k}\n7 8 9\nwe went home from {p}\nwe went {p} and back\nuser u{k} came in at {k}:00\nTotal: {k}") for k, p in enumerate(places)]
    got = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(documents(docs)).collect()}
    assert got == {k: f"{k}.5 1{k} 20{k}\nwe went home from {p}\nwe went {p} and back" for k, p in enumerate(places)}


def test_numbers_that_recur_word_for_word_go(documents):
    docs = [(k, f"1 2 3\n1  2 3\n{k} 2 3") for k in range(2)] + [(5, "1 2 3"), (6, "4 4 4 4\nown"), (7, "4 4 4 4"), (8, "4 4 4 4")]
    got = {r.doc_id: r.text for r in line_templates.drop_recurring_lines(documents(docs)).collect()}
    assert got == {0: "1  2 3\n0 2 3", 1: "1  2 3", 5: "", 6: "own", 7: "", 8: ""}


def test_a_template_is_dropped_whatever_the_number_of_its_copies(documents):
    """One of eleven free places is another in each document."""
    for n in (3, 30, 300):
        docs = []
        for k in range(n):
            line = "this site is now run by people who read all your mail twice".split()
            line[2 + k % 11] = "x" + "abcdefghij"[k % 10] + "klmnopqrst"[k // 10 % 10] + "uvwxyz"[k // 100]
            docs.append((k, f"{chr(97 + k % 26)}{chr(97 + k // 26)} alone\n" + " ".join(line)))
        got = line_rows(line_templates.drop_recurring_lines(documents(docs)))
        assert got == brute_lines(docs)
        assert [r[3] for r in got] == [1] * n


def test_lines_beside_the_majority_have_templates_of_their_own(documents):
    docs = [(k, "we are glad to see you here today" if k < 8 else "we are not open on any such day") for k in range(11)]
    docs += [(20 + k, f"we are glad that {w} came by yesterday") for k, w in enumerate(["nobody", "Anna"])]
    got = line_rows(line_templates.drop_recurring_lines(documents(docs)))
    assert got == brute_lines(docs)
    assert {r[0]: r[3] for r in got} == {k: 1 for k in range(11)} | {20: 0, 21: 0}


def test_line_templates_match_sql(documents, prose):
    import duckdb

    draw, docs = random.Random(9), [(1, None), (2, ""), (3, "1 2\n3"), (4, "1 2"), (5, "1 2"), (6, "1 2")]
    for k in range(80):
        lines = [" ".join(draw.choices("a b c d 7".split(), k=draw.randint(1, 6))) for _ in range(6)] + [prose(k, 8)]
        docs.append((100 + k, "\n".join(lines)))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [list(r) for r in docs])
    want = sorted(con.sql(line_templates.OP3_SQL).fetchall(), key=str)
    got = line_rows(line_templates.op3_line_templates(documents(docs)))
    assert got == want == brute_lines(docs)
