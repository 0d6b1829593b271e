"""The element tree against a parser with a stack, and rules on containers nested in their like."""

import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.functions import tree as R
from newsloom.functions.html import BLOCKS, VOID
from newsloom.plans.articles import card_table, extract_articles
from newsloom.queries.catalog import build_articles_cards
from newsloom.sources.sites import FIELD, at, listing_table, site_table

ITEMS = {"li", "dt", "dd", "tr", "td", "th"}


def brute_tree(html):
    parts = [p for p in re.split(r"(?=</?[A-Za-z!])", html)]
    parts = parts[1:] if parts and parts[0] == "" and len(parts) > 1 else parts
    stack, done = [], []

    def end(k, stop):
        for j in range(k, len(stack)):
            done.append((stack[j][1], stop, j, stack[j][0]))
        del stack[k:]

    for i, part in enumerate(parts):
        m = re.match(r"</?([A-Za-z][A-Za-z0-9:-]*)", part)
        if not m:
            continue
        name = m[1].lower()
        if part.startswith("</"):
            k = max((j for j, (n, _) in enumerate(stack) if n == name), default=None)
            if k is not None:
                end(k, i)
        elif name in VOID:
            done.append((i, i + 1, len(stack), name))
        else:
            k = max((j for j, (n, _) in enumerate(stack) if n in BLOCKS), default=None) if name in BLOCKS else None
            if k is not None and (stack[k][0] == "p" or stack[k][0] == name and name in ITEMS):
                end(k, i)
            stack.append((name, i))
    end(0, len(parts))
    return sorted(done)


def test_regions_equal_a_parser(spark):
    draw = random.Random(1)
    bits = ["<div>", "<div class=a>", "</div>", "<p>", "</p>", "<b>", "</b>", "<li>", "<ul>", "</ul>", "text", "a < b", "<br>", "<img src='a>b'>", "</x>",
            "<H1>", "</h1>", "<!DOCTYPE html>", "<amp-img src=x></amp-img>", "<td>", " "]
    rows = [(i, "".join(draw.choice(bits) for _ in range(draw.randint(0, 25)))) for i in range(300)] + [(300, ""), (301, "<div>" * 400), (302, None)]
    got = R.with_tree(spark.createDataFrame(rows, "i int, body string"), "body").select("i", "nodes").collect()
    for r in got:
        html = rows[r.i][1]
        assert r.nodes is None if html is None else [tuple(n) for n in r.nodes] == brute_tree(html)


@pytest.fixture(scope="module")
def one(spark):
    def make(html, rule):
        page = R.with_tree(spark.createDataFrame([(html,)], "body string"), "body")
        whole = {"opening": None, "tag": None, "child": None, "attr": None, "every": False} | rule
        names = [f.split()[0] for f in FIELD[7:-1].split(", ")]
        return page.withColumn("rule", F.struct(*[F.lit(whole[n]).cast("boolean" if n == "every" else "string").alias(n) for n in names]))

    return make


def test_fields_of_nested_elements(one):
    html = "<div class=a>one<div class=a><span x='5 > 4'></span>two</div>three<img data-y=\"q&amp;r\"></div><div class=a><h2></h2><h2>four</h2></div>"
    read = lambda rule: one(html, rule).select(R.fields(["rule"])[0].alias("v")).first().v
    assert read(at("div", "class", "a")) == "one" and read(at("div", "class", "a", every=True)) == "onetwothree"
    assert read(at("div", "class", "a", child="h2")) is None  # the first one is empty
    assert read(at("span", "x", read="x")) == "5 > 4" and read(at("img", read="data-y")) == "q&amp;r"
    assert read(at("p")) is None and read(at("div", "class", "b")) is None and read({}) is None
    assert one(html, at("div", "class", "a")).select(R.texts_of("rule").alias("v")).first().v == ["one", "two", "four"]
    inner = one(html, at("div", "class", "a")).select(R.inner_markup("rule").alias("v")).first().v
    assert len(inner) == 2 and inner[0].startswith("one<div class=a>") and inner[0].endswith('r">')


def deep(inner, opening, closing, n):
    return opening * n + inner + closing * n


def test_cards_in_nested_containers_and_cards(spark):
    inside = deep('<h3><a href="/article/{0}">x</a></h3>', '<div class="river-well article">', "</div>", 4)
    card = ('<div data-key="feed-card-wire-story-with-image"><a href="/article/out"></a>'
            '<div data-key="feed-card-wire-story-with-image"><a href="/article/in"></a><h1 class="Component-h1-0-2-42">In</h1></div>'
            '<h1 class="Component-h1-0-2-42">Out</h1><p>behind the nested card</p></div>')
    rows = [(1, "https://www.infoworld.com/category/analytics/", inside.format(1) + inside.format(2) + '<h3><a href="/article/3">outside</a></h3>'),
            (2, "https://apnews.com/hub/technology/", card)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {(r.page_id, r.pos): r for r in card_table(pages, site_table(spark), listing_table(spark)).collect()}
    assert {k: r.url for k, r in got.items() if k[0] == 1} == {(1, 0): "https://www.infoworld.com/article/1", (1, 1): "https://www.infoworld.com/article/2"}
    assert got[2, 0].url.endswith("/out") and got[2, 0].blurp == "behind the nested card" and got[2, 0].title == "In"
    assert got[2, 1].url.endswith("/in") and got[2, 1].title == "In" and got[2, 1].blurp is None


def test_body_nested_in_its_like_counts_once(spark):
    body = deep("<p>One</p>", '<div class="inner">', "</div>", 5) + '<div class="inner"><div class="inner"><p>Two</div></div><p>no</p>'
    pages = spark.createDataFrame([(1, "https://en.yna.co.kr/view/1", f"<title>T</title>{body}"), (2, "https://en.yna.co.kr/view/2", None)],
                                  "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract_articles(pages, site_table(spark), F.current_date()).collect()}
    assert got[1] == "OneTwo" and got.get(2, "") == ""


def test_registered_query_reads_whole_pages(spark):
    text = build_articles_cards(spark, "/root/testdata/sf0.001").agg(F.max(F.length("text")).alias("n"), F.count_distinct("source").alias("s")).first()
    assert text.n > 2000 and text.s == 14
