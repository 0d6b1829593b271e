"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of characters. All different blocks are sorted, and a
block's place in the order is its integer name. Adjacent names then form pairs, the different pairs
are sorted and named in their turn, and so on until each document has one name. Two texts are equal
if and only if they have as many blocks and the same last name: a name stands for one content, and
no hash decides.

Blocks cross the network once, to be sorted; an occurrence then finds its block's name by a
128-bit digest. Should two different blocks share a digest, which is looked for, their occurrences
find their names by content instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.session import stage

SPACES = r"[\x20\x09-\x0D]+"
BLOCK = 2048


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " ")


def digest(content: Column) -> Column:
    """128 bits of a content, only a route to its name."""
    return F.struct(F.xxhash64(content).alias("a"), F.xxhash64(F.lit(31), content).alias("b"))


def name_in_order(values: DataFrame, content: list[str], keep: list[str], purpose: str) -> DataFrame:
    """Each row of ``values``, distinct in ``content``, with an integer ``name``; stored.

    Values are dealt out by their hash, sorted where they land, and numbered there. The numbers are
    written once, so every later reader sees the same ones.
    """
    return stage(values.sortWithinPartitions(*content).select(*keep, F.monotonically_increasing_id().alias("name")), purpose)


def name_texts(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", block: int = BLOCK,
    route: Callable[[Column], Column] = digest,
) -> DataFrame:
    """``id, sha, n_blocks, name, n_rows`` for every different id and text; equal texts have equal ``(n_blocks, name)``.

    ``route`` leads occurrences to names; any function of the content gives the same result.
    """
    source = docs.select(F.col(id_col).alias("id"), normalised(F.col(text)).alias("t"))
    count = F.greatest(F.ceil(F.length("t") / block), F.lit(1)).cast("int")
    cuts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("t"), i * block + 1, F.lit(block)))
    cut = source.select("id", F.sha2(F.col("t").cast("binary"), 256).alias("sha"), count.alias("n_blocks"),
                        F.posexplode(cuts).alias("pos", "content"))
    contents = cut.groupBy("content").agg(F.lit(1).alias("one")).drop("one")
    names = name_in_order(contents.withColumn("key", route(F.col("content"))), ["content"], ["key"], "block-names")
    places = stage(cut.select("id", "sha", "n_blocks", "pos", route(F.col("content")).alias("key")), "block-places")

    shared = names.groupBy("key").agg(F.count("*").alias("n"), F.max("name").alias("name"))
    named = places.join(shared.where("n = 1").select("key", "name"), "key").select("id", "sha", "n_blocks", "pos", "name")
    clashes = stage(shared.where("n > 1").select("key"), "block-clashes")
    if not clashes.isEmpty():
        found = cut.withColumn("key", route(F.col("content"))).join(clashes, "key", "left_semi")
        base = names.agg(F.max("name")).first()[0] + 1
        own = name_in_order(found.select("content").distinct(), ["content"], ["content"], "clash-names")
        named = named.unionByName(found.join(own, "content").select(
            "id", "sha", "n_blocks", "pos", (F.col("name") + F.lit(base)).alias("name")))

    keys = ["id", "sha", "n_blocks"]
    named = named.withColumn("n_rows", F.lit(1).cast("long"))
    done = named.where("n_blocks = 1").select(*keys, "name", "n_rows")
    level = stage(named.where("n_blocks > 1").select(*keys, F.col("n_blocks").alias("width"), "pos", "name", "n_rows"), "block-level")
    while not level.isEmpty():
        left, right = (F.when(F.col("pos") % 2 == side, F.col("name")) for side in (0, 1))
        pairs = stage(level.groupBy(*keys, "width", F.floor(F.col("pos") / 2).cast("int").alias("pos")).agg(
            F.max(left).alias("first"), F.coalesce(F.max(right), F.lit(-1)).alias("second"),
            F.sum(F.when(left.isNotNull(), F.col("n_rows"))).alias("n_rows")), "block-pairs")
        different = pairs.groupBy("first", "second").agg(F.lit(1).alias("one"))
        names = name_in_order(different, ["first", "second"], ["first", "second"], "pair-names")
        level = stage(pairs.join(names, ["first", "second"]).select(
            *keys, F.ceil(F.col("width") / 2).cast("int").alias("width"), "pos", "name", "n_rows"), "block-level")
        done = done.unionByName(level.where("width = 1").select(*keys, "name", "n_rows"))
        level = level.where("width > 1")
    return done.groupBy(*keys, "name").agg(F.sum("n_rows").alias("n_rows"))


def dedupe_exact(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", block: int = BLOCK,
    route: Callable[[Column], Column] = digest,
) -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_sha256`` for every row of ``docs``.

    Texts are equal when they agree after each run of ASCII white space became one blank; null
    counts as the empty text. The smallest id of a group stays. ``group_size`` counts rows. Rows
    that repeat an id and its text carry the same decision; a null id stays only where a group has
    no other, and then ``keep_id`` is null. An empty table gives none. Further columns are not read.
    """
    named = stage(name_texts(docs, text, id_col, block, route), "identities")
    # stored, so that the join deals both sides out itself and can split a large group's rows
    groups = stage(named.groupBy("n_blocks", "name").agg(
        F.min("id").alias("keep_id"), F.sum("n_rows").alias("group_size")), "text-groups")
    rows = named.join(groups, ["n_blocks", "name"])
    rows = rows.withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("long"), "n_rows")))
    return rows.select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))


def op7_exact_dedup(docs: DataFrame) -> DataFrame:
    return dedupe_exact(docs)


OP7_SQL = r"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
  FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents))
"""
