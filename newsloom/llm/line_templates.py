"""Line deduplication by a log-template tree.

A line's tokens with a digit are variable fields. Lines descend a tree of fixed depth by their
number of tokens and their leading tokens. A token that most lines of a node have at a place is
constant there, and the constants are the node's template; a line is of the template when it has
the constants at most of its places. Lines that differ from it, and those of nodes without a
template, descend to the next level, where those left have constants of their own; at last equal
lines are templates. Lines of a template that many documents have are dropped. Agreement is counted
over constant tokens: not over variable fields, and not by the node's own leading tokens alone.
Lines of variable fields alone, as rows of numbers are, recur only when their texts are equal.

Shares of lines decide, so a template found among few copies is found among any number of them. A
node that few documents have needs no further look, since those below it have no more. Tokens are
counted by place before the shuffle, and only counts that can be constants are kept after it: a node
with a third of all lines costs no more than its lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.session import broadcast_if_small, stage

DEPTHS = (2, 4)
_WITH_DIGIT = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*"
FIELD = "<*>"


def line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def tokens(line: Column) -> Column:
    """Tokens of a line; those with an ASCII digit become variable fields."""
    # Most lines have neither tabs nor digits, and looking for them costs less than replacing them.
    plain = F.when(line.rlike(r"[\x09-\x0D]"), F.regexp_replace(line, r"[\x09-\x0D]", " ")).otherwise(line)
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(plain, _WITH_DIGIT, FIELD)).otherwise(plain)
    return F.array_remove(F.split(masked, " "), "")


def node(words: Column, depth: int) -> Column:
    """The tree's node at a depth: number of tokens and leading tokens, as a hash."""
    return F.xxhash64(F.size(words), F.slice(words, 1, depth))


def _many(lines: DataFrame, key: str, min_docs: int) -> DataFrame:
    """Keys that at least ``min_docs`` documents have."""
    return lines.select(key, "doc").distinct().groupBy(key).agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs).select(key)


def _templates(lines: DataFrame, agree: float, depth: int, min_docs: int) -> DataFrame:
    """Constants of the nodes that can have a template: ``key, places``, an array of place and token's hash.

    A constant is the token of at least a share ``agree`` of the node's lines, so a place has one at
    most. The tokens that make the node are constant by construction: one beyond them must be too.
    """
    nodes = lines.groupBy("key").agg(F.count("*").alias("n_lines"), F.max(F.size("words")).alias("n_words"))
    counts = lines.select("key", F.posexplode("words").alias("place", "token")).groupBy(
        "key", "place", F.xxhash64("token").alias("code")).agg(F.count("*").alias("n_same"))
    common = counts.where(F.col("n_same") >= agree * min_docs).join(nodes, "key").where(F.col("n_same") >= agree * F.col("n_lines"))
    told = F.col("code") != _field_code()
    return common.groupBy("key").agg(
        F.collect_list(F.struct("place", "code")).alias("places"), F.max("n_words").alias("n_words"), F.count_if(told).alias("k"),
        F.count_if(~told).alias("n_fields"), F.count_if(told & (F.col("place") >= depth)).alias("beyond"),
    ).where((F.col("k") >= agree * (F.col("n_words") - F.col("n_fields"))) & (F.col("beyond") > 0)).select("key", "places")


def _field_code() -> Column:
    return F.xxhash64(F.lit(FIELD))


def _fits(agree: float, depth: int) -> Column:
    """Whether ``words`` have the constants of ``places`` at most places, of those that are not fields in both."""
    met = F.filter("places", lambda p: F.xxhash64(F.get("words", p["place"])) == p["code"])

    def share(met: Column) -> Column:
        same = F.filter(met, lambda p: p["code"] != _field_code())
        return (F.size(same) >= agree * (F.size("words") - F.size(met) + F.size(same))) & F.exists(same, lambda p: p["place"] >= depth)

    return F.coalesce(let(met, share), F.lit(False))


def recurring_lines(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_docs: int = 3, agree: float = 0.7,
    depths: tuple[int, ...] = DEPTHS,
) -> DataFrame:
    """``id, text_key, pos`` of every line whose template at least ``min_docs`` documents have."""
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("text_key"), F.xxhash64(id_col, text).alias("doc"),
                         F.col(text).alias("t"))

    def parsed(line: Column, i: Column) -> Column:
        return let(tokens(line), lambda w: F.struct(i.alias("pos"), node(w, depths[0]).alias("key"), F.size(w).alias("n")))

    where = source.select("id", "text_key", "doc", F.explode(F.transform(line_array(F.col("t")), parsed)).alias("l"))
    many = stage(_many(where.where("l.n > 0").select("doc", F.col("l.key").alias("key")), "key", min_docs), "recurring-nodes")
    many = broadcast_if_small(many, max_rows=1_000_000, max_bytes=64 << 20)

    def whole(line: Column, i: Column) -> Column:
        return let(tokens(line), lambda w: F.struct(
            i.alias("pos"), F.when(F.size(w) > 0, node(w, depths[0])).alias("key"), line.alias("line")))

    lines = source.select("id", "text_key", "doc", F.explode(F.transform(line_array(F.col("t")), whole)).alias("l"))
    lines = lines.select("id", "text_key", "doc", "l.*").join(many, "key", "left_semi")
    lines = lines.withColumn("words", tokens(F.col("line")))
    # A line of variable fields alone is known by its own text.
    own = F.when(F.forall("words", lambda t: t == FIELD), F.xxhash64("line"))
    lines, found = stage(lines.withColumn("own", own).drop("line"), "recurring-lines"), []
    for above, depth in zip(depths, (*depths[1:], None)):
        templates = stage(_templates(lines, agree, above, min_docs), "templates")
        marked = lines.join(templates, "key", "left").withColumn("fits", _fits(agree, above)).drop("places")
        recur = stage(_many(marked.where("fits"), "key", min_docs).withColumn("recurs", F.lit(True)), "recurring-templates")
        marked = marked.join(recur, "key", "left").withColumn("gone", F.col("fits") & F.coalesce("recurs", F.lit(False)))
        found.append(marked.where("gone").select("id", "text_key", "pos"))
        rest = marked.where(~F.col("gone")).drop("key", "fits", "recurs", "gone")
        deeper = F.coalesce("own", F.xxhash64("words")) if depth is None else node(F.col("words"), depth)
        rest = rest.withColumn("key", deeper)
        many = _many(rest, "key", min_docs)
        lines = stage(rest.join(many, "key", "left_semi"), "recurring-lines")
    found.append(lines.select("id", "text_key", "pos"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def drop_recurring_lines(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", min_docs: int = 3, agree: float = 0.7,
    depths: tuple[int, ...] = DEPTHS,
) -> DataFrame:
    """``id_col, text, n_lines, n_dropped`` for every row of ``docs``, without its recurring lines.

    A template recurs when at least ``min_docs`` different documents (id and text) have a line of
    it; a document's own repeats count once. Blank lines belong to no template and stay. A null text
    stays null, with no lines; an empty one has one, blank line. Rows that repeat, or lack an id,
    are told apart by their text. An empty table gives none. Further columns are not read.
    """
    dropped = recurring_lines(docs, text, id_col, min_docs, agree, depths).groupBy("id", "text_key").agg(
        F.collect_set("pos").alias("gone"))
    dropped = stage(dropped, "dropped-lines")
    rows = docs.select(F.col(id_col), F.col(text).alias("t"), F.xxhash64(text).alias("key"))
    rows = rows.join(dropped, rows[id_col].eqNullSafe(dropped["id"]) & (rows["key"] == dropped["text_key"]), "left")

    def without(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    cleaned = F.when(F.col("gone").isNull(), F.col("t")).otherwise(let(line_array(F.col("t")), without))
    n_lines = F.when(F.col("t").isNull(), 0).otherwise(F.regexp_count("t", F.lit("\n")) + 1)
    return rows.select(rows[id_col], cleaned.alias("text"), n_lines.cast("long").alias("n_lines"),
                       F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"))


def op3_line_templates(docs: DataFrame) -> DataFrame:
    return drop_recurring_lines(docs)


def _level_sql(lines: str, d: int, min_docs: int = 3, agree: float = 0.7) -> str:
    """CTEs of a level: ``r{d}`` its lines of frequent nodes, ``d{d}`` those of templates, ``rest{d}`` the others."""
    return f"""
m{d} AS (SELECT n, k{d} FROM {lines} GROUP BY ALL HAVING count(DISTINCT doc_id) >= {min_docs}),
r{d} AS (SELECT * FROM {lines} SEMI JOIN m{d} USING (n, k{d})),
u{d} AS (SELECT doc_id, pos, n, k{d}, unnest(w) AS token, generate_subscripts(w, 1) - 1 AS place FROM r{d}),
c{d} AS (
  SELECT n, k{d}, place, token FROM (SELECT n, k{d}, place, token, count(*) AS same FROM u{d} GROUP BY ALL)
  JOIN (SELECT n, k{d}, count(*) AS n_lines FROM r{d} GROUP BY ALL) USING (n, k{d}) WHERE same >= CAST({agree} AS DOUBLE) * n_lines
), f{d} AS (
  SELECT doc_id, pos, n, k{d} FROM u{d} SEMI JOIN c{d} USING (n, k{d}, place, token) GROUP BY ALL
  HAVING count(*) FILTER (token <> '<*>') >= CAST({agree} AS DOUBLE) * (n - count(*) FILTER (token = '<*>'))
    AND count(*) FILTER (token <> '<*>' AND place >= {d}) > 0
), d{d} AS (
  SELECT doc_id, pos FROM f{d} SEMI JOIN (SELECT n, k{d} FROM f{d} GROUP BY ALL HAVING count(DISTINCT doc_id) >= {min_docs}) USING (n, k{d})
), rest{d} AS (SELECT * FROM r{d} ANTI JOIN d{d} USING (doc_id, pos)),"""


# For given tables, in which a document is its id.
OP3_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
    lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS w
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS pos FROM documents)
), all_lines AS (
  SELECT *, len(w) AS n, list_slice(w, 1, 2) AS k2, list_slice(w, 1, 4) AS k4 FROM lines WHERE len(w) > 0
),""" + _level_sql("all_lines", 2) + _level_sql("rest2", 4) + r"""
l0 AS (SELECT *, CASE WHEN len(list_filter(w, lambda t: t <> '<*>')) = 0 THEN [line] ELSE w END AS own FROM rest4),
m0 AS (SELECT own FROM l0 GROUP BY own HAVING count(DISTINCT doc_id) >= 3),
gone AS (
  SELECT * FROM d2 UNION ALL SELECT * FROM d4 UNION ALL SELECT doc_id, pos FROM l0 SEMI JOIN m0 USING (own)
), kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
      generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM documents WHERE text IS NOT NULL)
  ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
), counted AS (SELECT doc_id, count(*) AS n_dropped FROM gone GROUP BY 1)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text,
  CASE WHEN d.text IS NULL THEN 0 ELSE CAST(len(string_split(d.text, chr(10))) AS BIGINT) END AS n_lines,
  CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN counted c ON d.doc_id = c.doc_id
"""
