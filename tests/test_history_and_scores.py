"""Links against a stored history, and main text by scores against all runs of a page."""

import random
import re

from pyspark.sql import functions as F

from newsloom.functions.html import scored_text
from newsloom.operators.history import add_seen, seen_links, unseen, with_maybe_seen


def urls(spark, names):
    return spark.createDataFrame([(n,) for n in names], "url string")


def test_unseen_links_equal_the_plain_anti_join(spark, tmp_path):
    root, draw, known = f"{tmp_path}/history", random.Random(3), set()
    for run in range(3):
        links = [f"https://site.example/{draw.randrange(3000)}" for _ in range(800)] + [None, ""]
        got = sorted(r.url for r in unseen(urls(spark, links), root, places=1 << 16, parts=4).collect())
        assert got == sorted({x for x in links if x is not None} - known)
        for _ in range(2):  # a run that is repeated changes nothing
            add_seen(urls(spark, links), root, f"r{run}", places=1 << 16, parts=4)
        known |= {x for x in links if x is not None}
    assert {r.url for r in seen_links(spark, root).collect()} == known
    assert seen_links(spark, root).where("run = 'r0'").count() <= 801


def test_few_new_links_meet_the_exact_join(spark, tmp_path):
    root = f"{tmp_path}/history"
    add_seen(spark.range(4000).select(F.format_string("https://a.example/%d", "id").alias("url")), root, "one", places=1 << 16)
    new = spark.range(4000, 8000).select(F.format_string("https://a.example/%d", "id").alias("url"))
    marked = with_maybe_seen(new, root, places=1 << 16)
    assert marked.where("maybe_seen").count() < 400  # 4000 of 65536 places are taken: 244 of 4000 expected
    assert unseen(new, root, places=1 << 16).count() == 4000
    old = spark.range(4000).select(F.format_string("https://a.example/%d", "id").alias("url"))
    assert with_maybe_seen(old, root, places=1 << 16).where("NOT maybe_seen").count() == 0
    assert unseen(old, root, places=1 << 16).count() == 0


def test_a_repeated_run_replaces_its_own(spark, tmp_path):
    root = f"{tmp_path}/history"
    add_seen(urls(spark, ["a", "b", "c"]), root, "one")
    add_seen(urls(spark, ["b"]), root, "one")
    add_seen(urls(spark, []), root, "two")
    assert sorted(r.url for r in unseen(urls(spark, ["a", "b", "c"]), root).collect()) == ["a", "c"]


def best_run(html, word=4, tag=-13):
    tokens = re.findall(r"<[^>]*>|[^<\x09-\x0D\x20]+", html)
    best, run = 0, []
    for last in range(len(tokens)):
        for first in range(last, -1, -1):
            part = tokens[first:last + 1]
            total = sum(tag if t.startswith("<") else word for t in part)
            if total > best:
                best, run = total, part
    return " ".join(t for t in run if not t.startswith("<"))


def test_scored_text_is_the_best_of_all_runs(spark):
    draw, pages = random.Random(5), ["", "<p></p>", "plain words", "<b>one</b>", "a < b", "<p>a b c d</p><p>e f g h</p>", "<i>x<i>y<i>"]
    for _ in range(60):
        pages.append(" ".join(draw.choice(["<p>", "</p>", "<a href='x y'>", "w", "word", "\u00e9", "x<br>y", "one two three four five"])
                              for _ in range(draw.randint(1, 40))))
    rows = spark.createDataFrame([(i, p) for i, p in enumerate([*pages, None])], "i int, html string")
    got = {r.i: r.t for r in rows.select("i", scored_text(F.col("html")).alias("t")).collect()}
    assert got == {i: best_run(p) for i, p in enumerate(pages)} | {len(pages): None}


def test_scored_text_leaves_navigation_out(spark):
    menu = "".join(f"<li><a href='/{i}'>part {i}</a></li>" for i in range(20))
    html = f"<body><ul>{menu}</ul><div><p>{'word ' * 60}</p><p>{'more &amp; ' * 40}</p></div><ul>{menu}</ul></body>"
    got = spark.createDataFrame([(html,)], "html string").select(scored_text(F.col("html"))).first()[0]
    assert got == " ".join(["word"] * 60 + ["more &"] * 40)
