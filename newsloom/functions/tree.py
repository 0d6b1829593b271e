"""The element tree of a page, by region encoding.

A page is cut before every tag, and one pass with a stack of open elements gives each element its
region: the part with its opening tag, the part at which it ends, and its depth. What lies inside an
element is then a matter of comparing numbers, however deep elements of one name are nested, and a
rule finds its element without scanning the markup again.

Open elements end where an element around them closes, a paragraph also at the next block, an item
of a list or table also at the next of its kind; elements that never close reach to the end of the
page. Closing tags without an opening are ignored.

The expressions are SQL text: one call builds a whole rule, which keeps the driver's part small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.html import BLOCKS, VOID
from newsloom.session import settle

TREE = ("parts", "texts", "nodes")
# A tag, in which a value in quotes may hold ``>``.
WHOLE_TAG = r"""^</?[A-Za-z!](?:=\s*+(?:"[^"]*+"|\x27[^\x27]*+\x27)|[^>])*+>?"""
REGION = "array<struct<at: int, stop: int, depth: int, name: string>>"


def _let(value: str, name: str, body: str) -> str:
    """``value`` once, by a name."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _names(names: list[str]) -> str:
    return "array(" + ", ".join(f"'{n}'" for n in names) + ")"


def _last(of: str) -> str:
    """The last place, from 1, at which an array of booleans is true; null without one."""
    return f"cast(size(s.open) + 1 - nullif(array_position(reverse({of}), true), 0) AS int)"


def _ended(first: str, left: str) -> str:
    """Elements from a place of the stack on end before the event's part."""
    done = (f"concat(s.done, transform(slice(s.open, {first}, greatest(size(s.open) - {first} + 1, 0)), "
            f"(o, j) -> struct(o.at AS at, e.at AS stop, {first} - 1 + j AS depth, o.name AS name)))")
    return f"struct({left} AS open, {done} AS done)"


def _nodes() -> str:
    events = (r"filter(transform(parts, (p, i) -> struct(lower(regexp_extract(p, r'^</?([A-Za-z][A-Za-z0-9:-]*)', 1)) AS name, "
              r"startswith(p, '</') AS close, i AS at)), e -> e.name <> '')")
    zero = f"struct(cast(array() AS array<struct<name: string, at: int>>) AS open, cast(array() AS {REGION}) AS done)"
    opened = "struct(e.name AS name, e.at AS at)"
    block = f"array_contains({_names(BLOCKS)}, {{}}.name)"
    # the innermost open block, where the event ends it
    implied = (f"CASE WHEN {block.format('e')} THEN {_let(_last(f'transform(s.open, o -> {block.format("o")})'), 'k', _IMPLIED)} END")
    close = _let(_last("transform(s.open, o -> o.name = e.name)"), "k", f"if(k IS NULL, s, {_ended('k', 'slice(s.open, 1, k - 1)')})")
    push = _let(implied, "k", f"if(k IS NULL, struct(array_append(s.open, {opened}) AS open, s.done AS done), "
                              f"{_ended('k', f'array_append(slice(s.open, 1, k - 1), {opened})')})")
    void = "struct(s.open AS open, array_append(s.done, struct(e.at AS at, e.at + 1 AS stop, size(s.open) AS depth, e.name AS name)) AS done)"
    step = f"CASE WHEN e.close THEN {close} WHEN array_contains({_names(VOID)}, e.name) THEN {void} ELSE {push} END"
    rest = "transform(s.open, (o, j) -> struct(o.at AS at, size(parts) AS stop, j AS depth, o.name AS name))"
    return f"array_sort(aggregate({events}, {zero}, (s, e) -> {step}, s -> concat(s.done, {rest})))"


# Elements that end where the next of their name starts.
_ITEMS = ["li", "dt", "dd", "tr", "td", "th"]
_IMPLIED = f"if(s.open[k - 1].name = 'p' OR (s.open[k - 1].name = e.name AND array_contains({_names(_ITEMS)}, e.name)), k, NULL)"


def with_tree(df: DataFrame, html: str) -> DataFrame:
    """``df`` with its markup as ``parts``, their ``texts`` without tags, and ``nodes`` in page order, each made once."""
    cut = df.withColumn("parts", F.split(html, r"(?=</?[A-Za-z!])"))
    cut = cut.withColumn("texts", F.expr(f"transform(parts, p -> regexp_replace(p, r'{WHOLE_TAG}', ''))"))
    return settle(cut.withColumn("nodes", F.expr(_nodes())), *TREE)


def _matching(rule: str, nodes: str = "nodes") -> str:
    """Nodes that a rule's opening tag matches."""
    return f"filter({nodes}, n -> n.name = lower({rule}.tag) AND parts[n.at] RLIKE concat('^', {rule}.opening))"


def _first_text(node: str) -> str:
    return f"get(filter(slice(texts, {node}.at + 1, {node}.stop - {node}.at), t -> t <> ''), 0)"


def _attribute(node: str, name: str) -> str:
    pattern = rf"""concat(r'(?is)\s', {name}, r'\s*=\s*("[^"]*"|\x27[^\x27]*\x27|[^\s"\x27>][^\s>]*)')"""
    value = f"regexp_extract(regexp_extract(parts[{node}.at], r'{WHOLE_TAG}', 0), {pattern}, 1)"
    return _let(value, "v", "nullif(if(left(v, 1) IN ('\"', '\\''), substr(v, 2, greatest(length(v) - 2, 0)), v), '')")


def _pick(rule: str, nodes: str) -> str:
    child = f"filter({nodes}, c -> c.name = lower({rule}.child) AND exists(found, e -> c.at > e.at AND c.stop <= e.stop))"
    value = (f"CASE WHEN {rule}.attr IS NOT NULL THEN {_attribute('t', f'{rule}.attr')} "
             f"WHEN {rule}.every THEN array_join(slice(texts, t.at + 1, t.stop - t.at), '') ELSE {_first_text('t')} END")
    return f"if({rule}.opening IS NULL, NULL, {_let(_matching(rule, nodes), 'found', _let(f'get(if({rule}.child IS NULL, found, {child}), 0)', 't', value))})"


def fields(rules: list[str]) -> Column:
    """What each rule (columns ``struct<opening, tag, child, attr, every>``) finds on the page, as an array in the same order.

    The first element that matches, or the first ``child`` inside one that does; its attribute, all its
    text, or its first text. References are not decoded. Null without a rule or a match.
    """
    return F.expr(f"transform(array({', '.join(rules)}), r -> {_pick('r', 'nodes')})")


def fields_each(regions: str, rules: list[str]) -> Column:
    """``fields`` within each of the ``regions`` (``array<struct<at, stop>>``), the element itself included."""
    inside = "filter(nodes, n -> n.at >= c.at AND n.stop <= c.stop)"
    return F.expr(f"transform({regions}, c -> {_let(inside, 'ns', f'transform(array({", ".join(rules)}), r -> {_pick("r", "ns")})')})")


def texts_of(rule: str) -> Column:
    """First text of every element at a rule, or of its first ``child``; null without a rule."""
    child = f"get(filter(nodes, c -> c.name = lower({rule}.child) AND c.at > e.at AND c.stop <= e.stop), 0)"
    each = _let(f"if({rule}.child IS NULL, e, {child})", "t", _first_text("t"))
    return F.expr(f"if({rule}.opening IS NULL, NULL, array_compact(transform({_matching(rule)}, e -> {each})))")


def inner_markup(rule: str) -> Column:
    """Inner markup of every outermost element at a rule; null without a rule."""
    outermost = "filter(found, e -> NOT exists(found, o -> o.at < e.at AND e.stop <= o.stop))"
    inner = "concat(texts[e.at], array_join(slice(parts, e.at + 2, greatest(e.stop - e.at - 1, 0)), ''))"
    return F.expr(f"if({rule}.opening IS NULL, NULL, {_let(_matching(rule), 'found', f'transform({outermost}, e -> {inner})')})")


def card_regions(layout: str) -> Column:
    """``array<struct<at, stop>>``: the cards of a layout, at any depth and each once, in page order.

    Cards lie inside a ``container`` if there is one; with ``children`` they are its direct children
    of that name. A card whose blurp follows it reaches to the next card.
    """
    inside = "exists(boxes, b -> n.at > b.at AND n.stop <= b.stop)"
    below = f"filter(nodes, n -> n.name = lower({layout}.children) AND exists(boxes, b -> n.at > b.at AND n.stop <= b.stop AND n.depth = b.depth + 1))"
    at_rule = f"filter({_matching(f'{layout}.card')}, n -> {layout}.container IS NULL OR {inside})"
    boxes = f"if({layout}.container IS NULL, cast(array() AS {REGION}), {_matching(f'{layout}.container')})"
    found = _let(boxes, "boxes", f"if({layout}.children IS NULL, {at_rule}, {below})")
    reach = f"if({layout}.after_blurp IS NULL, c.stop, coalesce(get(cards, i + 1).at, size(parts)))"
    return F.expr(_let(found, "cards", f"transform(cards, (c, i) -> struct(c.at AS at, {reach} AS stop))"))
