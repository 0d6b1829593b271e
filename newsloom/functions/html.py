"""Column functions that read HTML with Spark's own string functions.

Real pages leave tags open, so nothing here needs a well-formed tree: an element runs from its
opening tag to the matching closing tag, or to the end of the text when that never comes.
Patterns may be columns, so that each row can follow the rules of its own source.
"""

from __future__ import annotations

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import blank_to_null, clean_space, let
from newsloom.functions.urls import resolve_url

# Elements whose start or end also ends an open paragraph.
BLOCKS = (
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section table td th tr ul"
).split()
# Elements that have no content.
VOID = "area base br col embed hr img input link meta source track wbr".split()

TAG = r"</?[A-Za-z!][^>]*>"
PARAGRAPH = r"(?i)<p(?:\s[^>]*)?>"
PARAGRAPH_END = rf"(?is)^(.*?)(?:</?(?:{'|'.join(BLOCKS)})\b|\z)"
BLOCK_EDGE = rf"(?i)</?(?:{'|'.join(BLOCKS)})(?:\s[^>]*)?/?>"
FIRST_TEXT = "(?:^|>)([^<]+)"


def extract(text: Column, pattern: Column | str, group: int = 1) -> Column:
    """``regexp_extract`` that also takes a pattern column; null when nothing matches."""
    pattern = F.lit(pattern) if isinstance(pattern, str) else pattern
    found = F.call_function("regexp_extract", text, pattern, F.lit(group))
    return let(found, lambda v: blank_to_null(v))


def strip_markup(html: Column, tags: tuple[str, ...] = ("script", "style", "iframe")) -> Column:
    """Remove comments and the named elements with all they hold, in one pass."""
    parts = [r"!--.*?(?:-->|\z)"] + [rf"{t}(?:[\s/][^>]*)?>.*?(?:</{t}\s*>|\z)" for t in tags]
    return F.regexp_replace(html, f"(?is)<(?:{'|'.join(parts)})", "")


def drop_tags(html: Column) -> Column:
    return F.regexp_replace(html, TAG, "")


def _entity_table() -> str:
    """``;name=letter`` for every HTML 4 name, the frequent ones first."""
    names = {**name2codepoint, "apos": 0x27}
    common = ["amp", "quot", "lt", "gt", "apos", "nbsp"]
    return "".join(f";{n}={chr(names[n])}" for n in common + [n for n in names if n not in common])


def unescape_entities(text: Column) -> Column:
    """Decode named (HTML 4) and numeric character references, each exactly once.

    Only references closed by ``;`` count, as in common HTML parsers. The names are looked up in
    one string, which keeps the plan small and stays inside the JVM.
    """
    table = F.lit(_entity_table())
    reference = r"^(#[0-9]+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);"

    def letter(name: Column) -> Column:
        hexadecimal = F.lower(F.substring(name, 2, 1)) == "x"
        digits = F.ltrim(F.substr(name, F.when(hexadecimal, 3).otherwise(2)), F.lit("0"))
        # more digits than the last code point has are beyond it
        number = F.when(F.length(digits) <= 7, F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits)).try_cast("int")
        number = F.when(number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF), number)
        coded = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        place = F.call_function("instr", table, F.concat(F.lit(";"), name, F.lit("=")))
        named = F.when(place > 0, F.substr(table, place + F.length(name) + 2, F.lit(1)))
        return F.when(name.startswith("#"), coded).when(name != "", named)

    def decode(piece: Column, i: Column) -> Column:
        found = let(F.regexp_extract(piece, reference, 1), lambda name: F.concat(
            letter(name), F.substr(piece, F.length(name) + 2)))
        return F.when(i == 0, piece).otherwise(F.coalesce(found, F.concat(F.lit("&"), piece)))

    return let(text, lambda t: F.when(
        t.contains("&"), F.array_join(F.transform(F.split(t, "&"), decode), "")).otherwise(t))


def _html5_table() -> str:
    """``\\x01name;\\x02letters`` for every HTML 5 name, the ones also known without ``;`` twice."""
    return "".join(f"\x01{name}\x02{letters}" for name, letters in html5.items()) + "\x01"


def _cp1252(number: int) -> str:
    """What a reference to 0x80 to 0x9F stands for: the letter of that byte in Windows' Latin, where it has one."""
    return bytes([number]).decode("cp1252", "ignore") or chr(number)


def unescape_html5(text: Column) -> Column:
    """Decode character references as HTML 5 does, each exactly once.

    All HTML 5 names closed by ``;`` count; the old names also without it, the longest that fits.
    Numbers of no character become U+FFFD, those of control characters and non-characters vanish, and
    those of 0x80 to 0x9F are read as Windows' Latin. What is no reference stays as it is.
    """
    table = F.lit(_html5_table())
    old = "|".join(sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name)))
    latin = F.lit("".join(map(_cp1252, range(0x80, 0xA0))))

    def named(name: Column) -> Column:
        place = F.call_function("instr", table, F.concat(F.lit("\x01"), name, F.lit("\x02")))
        return F.when((name != "") & (place > 0), F.substring_index(F.substr(table, place + F.length(name) + 2, F.lit(3)), "\x01", 1))

    def numbered(reference: Column) -> Column:
        hexadecimal = F.lower(F.substring(reference, 2, 1)) == "x"
        digits = F.ltrim(F.regexp_extract(reference, "^#[xX]?([0-9A-Fa-f]+)", 1), F.lit("0"))
        # more digits than the last code point has are beyond it
        number = F.when(digits == "", 0).when(F.length(digits) <= 7, F.when(
            hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("int")).otherwise(0x110000)
        return let(number, lambda n: F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), F.lit("�"))
                   .when(n.between(0x80, 0x9F), F.substr(latin, n - 0x7F, F.lit(1)))
                   .when(n.between(0x01, 0x08) | (n == 0x0B) | n.between(0x0E, 0x1F) | (n == 0x7F) | n.between(0xFDD0, 0xFDEF)
                         | (n.bitwiseAND(0xFFFE) == 0xFFFE), F.lit(""))
                   .otherwise(F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")))

    def after(piece: Column, reference: Column, letters: Column) -> Column:
        return F.concat(letters, F.substr(piece, F.length(reference) + 1))

    def decode(piece: Column, i: Column) -> Column:
        parts = F.array(F.regexp_extract(piece, r"^#(?:[0-9]+|[xX][0-9A-Fa-f]+);?", 0),
                        F.regexp_extract(piece, r"^[A-Za-z][A-Za-z0-9]{1,30};", 0), F.regexp_extract(piece, f"^(?:{old})", 0))
        found = let(parts, lambda p: F.coalesce(
            F.when(p[0] != "", after(piece, p[0], numbered(p[0]))), after(piece, p[1], named(p[1])), after(piece, p[2], named(p[2]))))
        return F.when(i == 0, piece).otherwise(F.coalesce(found, F.concat(F.lit("&"), piece)))

    return let(text, lambda t: F.when(
        t.contains("&"), F.array_join(F.transform(F.split(t, "&"), decode), "")).otherwise(t))


def inner_to_close(piece: Column, tag: Column) -> Column:
    """What lies before the closing tag that matches an element opened just before ``piece``."""
    # The blank in front keeps the first part free of tags, also when the piece starts with one.
    edges = F.split(F.concat(F.lit(" "), piece), F.concat(F.lit("(?i)(?=</?"), tag, F.lit(r"[\s>/])")))

    def cut(parts: Column) -> Column:
        state = F.struct(F.lit(0).alias("i"), F.lit(1).alias("depth"), F.lit(0).alias("end"))

        def step(s: Column, part: Column) -> Column:
            turn = (
                F.when(s["i"] == 0, F.lit(0)).when(part.startswith("</"), F.lit(-1)).otherwise(F.lit(1))
            )
            return F.struct(
                (s["i"] + 1).alias("i"),
                (s["depth"] + turn).alias("depth"),
                F.when((s["end"] == 0) & (s["depth"] + turn == 0), s["i"]).otherwise(s["end"]).alias("end"),
            )

        return let(
            F.aggregate(parts, state, step),
            lambda s: F.substr(F.array_join(
                F.slice(parts, 1, F.when(s["end"] > 0, s["end"]).otherwise(s["i"])), ""), F.lit(2)),
        )

    return let(edges, cut)


def elements(html: Column, opening: Column, tag: Column) -> Column:
    """Inner HTML of every element that ``opening`` matches, in page order."""
    pieces = F.split(html, opening)
    return F.transform(F.slice(pieces, 2, F.size(pieces)), lambda p: inner_to_close(p, tag))


def outer_elements(html: Column, opening: Column, tag: Column) -> Column:
    """As ``elements``, with the opening tag kept in front."""
    pieces = F.split(html, F.concat(F.lit("(?="), opening, F.lit(")")))
    matching = F.filter(pieces, lambda p: F.regexp_like(p, F.concat(F.lit("^"), opening)))

    def cut(piece: Column) -> Column:
        start = F.call_function("regexp_extract", piece, opening, F.lit(0))
        return F.concat(start, inner_to_close(F.substr(piece, F.length(start) + 1), tag))

    return F.transform(matching, cut)


def child_elements(html: Column, tag: Column) -> Column:
    """Outer HTML of each ``tag`` at the top level of ``html``, nested ones left inside."""
    state = F.struct(
        F.lit(0).alias("depth"), F.lit("").alias("open"), F.array().cast("array<string>").alias("done"))

    def step(s: Column, part: Column) -> Column:
        turn = F.when(part.startswith("</"), -1).when(
            F.regexp_like(part, F.concat(F.lit("(?i)^<"), tag, F.lit(r"[\s>/]"))), 1).otherwise(0)
        depth = F.greatest(s["depth"] + turn, F.lit(0))
        closed = (s["depth"] > 0) & (depth == 0)
        return F.struct(
            depth.alias("depth"),
            F.when(depth > 0, F.concat(s["open"], part)).otherwise("").alias("open"),
            F.when(closed, F.array_append(s["done"], s["open"])).otherwise(s["done"]).alias("done"),
        )

    def finish(s: Column) -> Column:
        return F.when(s["depth"] > 0, F.array_append(s["done"], s["open"])).otherwise(s["done"])

    edges = F.split(html, F.concat(F.lit("(?i)(?=</?"), tag, F.lit(r"[\s>/])")))
    return F.aggregate(edges, state, step, finish)


def element(html: Column, opening: Column, tag: Column) -> Column:
    """Inner HTML of the first element that ``opening`` matches; null when there is none."""
    return inner_to_close(F.get(F.split(html, opening, 2), F.lit(1)), tag)


def all_elements(html: Column, opening: Column, tag: Column) -> Column:
    """Inner HTML of every element that ``opening`` matches; one inside another is part of it only."""
    def step(s: Column, _: Column) -> Column:
        rest = F.get(F.split(s["rest"], opening, 2), F.lit(1))
        return let(rest, lambda r: let(inner_to_close(r, tag), lambda inner: F.when(r.isNull(), s).otherwise(F.struct(
            F.substr(r, F.length(inner) + 1).alias("rest"), F.array_append(s["done"], inner).alias("done")))))

    n = F.size(F.split(html, opening)) - 1
    start = F.struct(html.alias("rest"), F.array().cast("array<string>").alias("done"))
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), start, step)["done"])


def at_depth(html: Column, depth: Column) -> Column:
    """What lies exactly ``depth`` container elements below the top of ``html``. Null keeps all."""
    names = "|".join(b for b in BLOCKS if b not in ("p", "hr"))
    edges = F.split(html, rf"(?i)(?=<(?:/?(?:{names}))[\s>/])")

    def turn(part: Column) -> Column:
        return F.when(part.rlike(rf"(?i)^</(?:{names})[\s>/]"), -1).when(part.rlike(rf"(?i)^<(?:{names})[\s>/]"), 1).otherwise(0)

    def kept(parts: Column) -> Column:
        turns = F.transform(parts, turn)
        zero = F.struct(F.lit(0).alias("now"), F.lit("").alias("depths"))
        # one character per part tells its depth, up to nine; text is joined once at the end
        depths = F.aggregate(turns, zero, lambda s, t: F.struct(
            F.greatest(s["now"] + t, F.lit(0)).alias("now"),
            F.concat(s["depths"], F.least(F.greatest(s["now"] + t, F.lit(0)), F.lit(9)).cast("string")).alias("depths")))["depths"]
        return let(depths, lambda d: F.array_join(F.filter(parts, lambda p, i: F.substr(d, i + 1, F.lit(1)) == depth.cast("string")), ""))

    return F.when(depth.isNull(), html).otherwise(let(edges, kept))


def raw_attribute(tag_text: Column, name: Column | str) -> Column:
    """Value of an attribute inside one opening tag, references not decoded."""
    name = F.lit(name) if isinstance(name, str) else name
    pattern = F.concat(F.lit(r"(?is)\s"), name, F.lit("\\s*=\\s*(?:\"([^\"]*)\"|'([^']*)'|([^\\s\"'>][^\\s>]*))"))
    value = let(tag_text, lambda t: F.concat(*[
        F.call_function("regexp_extract", t, pattern, F.lit(g)) for g in (1, 2, 3)]))
    return let(value, lambda v: blank_to_null(v))


def attribute(tag_text: Column, name: Column | str) -> Column:
    return unescape_entities(raw_attribute(tag_text, name))


def opening_tag(tag: str, attr: str | None = None, value: str | None = None,
                contains: bool = False) -> str:
    """Pattern for an opening tag, chosen by an attribute when one is given."""
    if attr is None:
        return rf"(?i)<{tag}(?:\s[^>]*)?>"
    if value is None:
        return rf"(?i)<{tag}\s(?:[^>]*\s)?{attr}\s*=[^>]*>"
    text = "".join("\\" + c if c in r"\.^$|?*+()[]{}" else c for c in value)
    text = rf"[^\"'>]*{text}[^\"'>]*" if contains else text
    return rf"(?i)<{tag}\s(?:[^>]*\s)?{attr}\s*=\s*[\"']?{text}[\"']?(?:[\s/][^>]*)?>"


def first_text(inner: Column) -> Column:
    """First text node, also when it sits inside a nested tag."""
    return unescape_entities(extract(inner, FIRST_TEXT))


def all_text(inner: Column) -> Column:
    """All text nodes joined with nothing."""
    return unescape_entities(drop_tags(inner))


def direct_text(inner: Column) -> Column:
    """Only the text nodes that are children of the element itself, not of nested tags.

    Character references stay as they are.
    """
    state = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"))

    def step(s: Column, part: Column) -> Column:
        name = F.lower(F.regexp_extract(part, r"^</?([A-Za-z][A-Za-z0-9]*)", 1))
        plain = (name == "") | name.isin(VOID)
        depth = s["depth"] + (
            F.when(plain, F.lit(0)).when(part.startswith("</"), F.lit(-1)).otherwise(F.lit(1)))
        body = F.when(name == "", part).otherwise(F.regexp_replace(part, "^<[^>]*>", ""))
        return F.struct(
            F.greatest(depth, F.lit(0)).alias("depth"),
            F.when(depth <= 0, F.concat(s["text"], body)).otherwise(s["text"]).alias("text"),
        )

    text = F.aggregate(F.split(inner, "(?=<)"), state, step)["text"]
    return F.when(inner.contains("<"), text).otherwise(inner)


def paragraphs(html: Column) -> Column:
    """Inner HTML of each paragraph. One left open ends at the next paragraph or block."""
    pieces = F.split(html, PARAGRAPH)
    return F.transform(
        F.slice(pieces, 2, F.size(pieces)), lambda p: F.regexp_extract(p, PARAGRAPH_END, 1))


def joined_text(html: Column, mode: Column | str) -> Column:
    """Text of the paragraphs joined with nothing.

    ``all``: every text node, trimmed; ``first``: the first node of each paragraph; ``direct``: the
    nodes outside nested tags; ``region``: every text node of ``html``, trimmed.
    """
    mode = F.lit(mode) if isinstance(mode, str) else mode
    raw = let(paragraphs(html), lambda found: (
        F.when(mode == "first", F.array_join(
            F.transform(found, lambda p: F.regexp_extract(p, FIRST_TEXT, 1)), ""))
        .when(mode == "direct", F.array_join(F.transform(found, lambda p: direct_text(p)), ""))
        .when(mode == "region", drop_tags(html))
        .otherwise(drop_tags(F.array_join(found, "")))))
    text = unescape_entities(raw)
    return F.when(mode.isin("first", "direct"), text).otherwise(clean_space(text))


def body_text_all(html: Column) -> Column:
    return joined_text(html, "all")


def body_text_first(html: Column) -> Column:
    return joined_text(html, "first")


def body_text_direct(html: Column) -> Column:
    return joined_text(html, "direct")


def article_region(html: Column) -> Column:
    """Content of ``<article>``, else the whole page."""
    article = F.lit(opening_tag("article"))
    return F.coalesce(element(html, article, F.lit("article")), html)


def blocks(html: Column) -> Column:
    """``array<struct<text, words, linked>>``: text blocks with their word and linked-word counts."""
    def count(text: Column) -> Column:
        return F.size(F.array_remove(F.split(text, r"\s+"), ""))

    def measure(piece: Column) -> Column:
        links = F.array_join(
            F.regexp_extract_all(piece, F.lit(r"(?is)<a\s[^>]*>(.*?)(?:</a\s*>|\z)"), F.lit(1)), " ")
        both = F.transform(F.array(piece, links), lambda x: clean_space(unescape_entities(drop_tags(x))))
        return let(both, lambda t: F.struct(
            F.get(t, F.lit(0)).alias("text"), count(F.get(t, F.lit(0))).alias("words"),
            count(F.get(t, F.lit(1))).alias("linked")))

    return F.filter(F.transform(F.split(html, BLOCK_EDGE), lambda p: measure(p)), lambda b: b["text"] != "")


def dense_blocks(found: Column) -> Column:
    """Blocks that shallow text features call content (Kohlschuetter et al., WSDM 2010, alg. 2).

    A block is judged by its word count and link density and by those of both neighbours.
    """
    def share(b: Column) -> Column:
        return F.coalesce(b["linked"] / F.greatest(b["words"], F.lit(1)), F.lit(0.0))

    def words(b: Column) -> Column:
        return F.coalesce(b["words"], F.lit(0))

    def is_content(block: Column, i: Column) -> Column:
        before, after = F.get(found, i - 1), F.get(found, i + 1)
        plain_before = (words(block) > 16) | (words(after) > 15) | (words(before) > 4)
        linked_before = (words(block) > 40) | (words(after) > 17)
        return (share(block) <= 1 / 3) & F.when(share(before) <= 5 / 9, plain_before).otherwise(linked_before)

    return F.filter(found, is_content)


def block_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda b: b["text"]), "\n\n")


def dense_text(html: Column) -> Column:
    return let(blocks(html), lambda found: block_text(dense_blocks(found)))


def main_text(html: Column) -> Column:
    """Main text whatever the layout: every block of ``<article>``, else the dense blocks."""
    article = element(html, F.lit(opening_tag("article")), F.lit("article"))
    return let(article, lambda inner: let(
        blocks(F.coalesce(inner, html)),
        lambda found: block_text(F.when(inner.isNotNull(), found).otherwise(dense_blocks(found)))))


def scored_text(html: Column, word: int = 4, tag: int = -13) -> Column:
    """The run of words and tags with the greatest sum of scores (Pasternack and Roth, WWW 2009), without its tags.

    A word gains, a tag costs. One scan keeps the best run that ends at each token; of equal runs the
    first to end counts, and of these the shortest. A page without words gives an empty text.
    """
    tokens = F.regexp_extract_all(html, F.lit(r"<[^>]*+>|[^<\x09-\x0D\x20]++"), F.lit(0))
    state = F.struct(*[F.lit(0).alias(n) for n in ("i", "start", "sum", "best", "first", "last")])

    def step(s: Column, token: Column) -> Column:
        score = F.when(token.startswith("<"), F.lit(tag)).otherwise(F.lit(word))
        fresh = s["sum"] <= 0
        now = F.struct((s["i"] + 1).alias("i"), F.when(fresh, s["i"] + 1).otherwise(s["start"]).alias("start"),
                       (F.when(fresh, F.lit(0)).otherwise(s["sum"]) + score).alias("sum"))
        return let(now, lambda n: F.struct(
            n["i"], n["start"], n["sum"], F.greatest(n["sum"], s["best"]).alias("best"),
            F.when(n["sum"] > s["best"], n["start"]).otherwise(s["first"]).alias("first"),
            F.when(n["sum"] > s["best"], n["i"]).otherwise(s["last"]).alias("last")))

    def text(found: Column) -> Column:
        run = let(F.aggregate(found, state, step), lambda s: F.when(
            s["best"] > 0, F.slice(found, s["first"], s["last"] - s["first"] + 1)).otherwise(F.slice(found, 1, 0)))
        return F.array_join(F.filter(run, lambda t: ~t.startswith("<")), " ")

    return unescape_entities(let(tokens, text))


def page_title(html: Column) -> Column:
    """The first heading, else the page title."""
    raw = F.array(*[
        F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)(?:</{tag}\s*>|\z)", 1) for tag in ("h1", "title")])
    clean = F.transform(raw, lambda t: clean_space(unescape_entities(drop_tags(t))))
    return F.get(F.filter(clean, lambda t: t != ""), F.lit(0))


def meta_content(html: Column, attr: str, value: str, contains: bool = False,
                 tag: str = "meta", read: str = "content") -> Column:
    """``content`` of the meta tag (or ``href`` of the link tag) chosen by an attribute."""
    return attribute(extract(html, opening_tag(tag, attr, value, contains), 0), read)


def lead_image(html: Column, base: Column, attrs: tuple[str, ...] = ("data-original", "src")) -> Column:
    """Absolute URL of the first image, the lazy-load attribute before the plain one."""
    image = extract(html, r"(?i)<(?:amp-)?img\s[^>]*>", 0)
    found = let(image, lambda tag: F.coalesce(*[raw_attribute(tag, a) for a in attrs]))
    return let(unescape_entities(found), lambda href: resolve_url(href, base))


def pick(html: Column, rule: Column) -> Column:
    """Text or attribute at a rule ``struct<opening, tag, child, attr, every>``; null without a match.

    ``child`` names a tag to look for inside the element; ``attr`` asks for an attribute instead of
    text; ``every`` joins all text nodes instead of taking the first.
    """
    child = F.concat(F.lit("(?i)<"), rule["child"], F.lit(r"(?:\s[^>]*)?>"))

    def inside(area: Column, opening: Column, tag: Column) -> Column:
        text = let(element(area, opening, tag), lambda found: F.when(
            rule["every"], drop_tags(found)).otherwise(extract(found, FIRST_TEXT)))
        return F.when(rule["attr"].isNotNull(), raw_attribute(extract(area, opening, 0), rule["attr"])).otherwise(text)

    # the first element that has the child
    having = F.get(F.filter(all_elements(html, rule["opening"], rule["tag"]), lambda e: F.regexp_like(e, child)), F.lit(0))
    outer = F.when(rule["child"].isNull(), html).otherwise(having)
    value = let(outer, lambda area: inside(
        area, F.coalesce(child, rule["opening"]), F.coalesce(rule["child"], rule["tag"])))
    return F.when(rule["opening"].isNotNull(), unescape_entities(value))


def pick_each(html: Column, rules: list[Column]) -> Column:
    """``pick`` for several rules at once, as an array in the same order: one expression for all."""
    return F.transform(F.array(*rules), lambda rule: pick(html, rule))


def pick_all(html: Column, rule: Column) -> Column:
    """First text of every element at a rule, as an array; null when the source has no such rule."""
    child = F.concat(F.lit("(?i)<"), rule["child"], F.lit(r"(?:\s[^>]*)?>"))

    def inner_text(inner: Column) -> Column:
        area = F.when(rule["child"].isNull(), inner).otherwise(element(inner, child, rule["child"]))
        return unescape_entities(extract(area, FIRST_TEXT))

    return F.when(rule["opening"].isNotNull(), F.array_compact(
        F.transform(elements(html, rule["opening"], rule["tag"]), lambda p: inner_text(p))))
