"""Mixing sources to target weights by min-cost flow.

Documents may belong to several sources. They are summed by membership pattern, so the flow network
has one node per pattern and one per source, however many documents there are: a pattern offers its
words once at no cost, again at cost 1, a third time at cost 2 and so on (convex repetition), and a
source takes up to its target. Each pattern's routed words are then met by whole documents: every
document as often as the flow covers the pattern in full, and a seeded choice of documents once more.

A source that shares no document with another is a network of its own with one arc, and its flow is
its target: such sources, whatever their number, are settled by arithmetic on their rows. Sources,
weights and targets are tables throughout; the driver routes only patterns that overlap.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from newsloom.operators.sinks import with_row_offset
from newsloom.session import broadcast_if_small, stage

NOT_SPACE = r"[^\x20\x09-\x0D]+"
BUCKETS = 4096
_AT_ONCE = 4096


def source_targets(sources: DataFrame, total: float, cap: float) -> DataFrame:
    """``sources`` (``source_size``, ``weight``) with ``target``: a share of ``total`` by weight, ``cap`` times its size at most.

    What is above the cap is shared anew among the others. Each round sums the table once: sources at
    their cap stay there, since the words for a unit of weight only rise.
    """
    full, unit, n_full = F.lit(False), 0.0, -1
    while True:
        sums = sources.agg(
            F.count_if(full).alias("n"), F.sum(F.when(full, F.col("source_size"))).alias("held"),
            F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        if sums.n <= n_full or sums.open is None:
            break
        n_full, unit = sums.n, max(0.0, total - cap * (sums.held or 0)) / sums.open
        full = F.col("weight") * unit > F.col("source_size") * cap
    return sources.withColumn("target", F.when(full, F.col("source_size") * F.lit(float(cap))).otherwise(F.col("weight") * unit))


def route(sizes: Sequence[int], members: Sequence[Sequence[int]], targets: Sequence[int], repeats: int) -> list[list[int]]:
    """Words from each pattern to each of its sources, of the largest flow with the least repetition cost.

    Costs lie on the patterns' own arcs and rise with each repetition. Opening the repetitions one
    after the other and augmenting by shortest paths gives, after each, the cheapest flow of its
    amount, since no augmenting path takes words back from a pattern.
    """
    flow = [dict.fromkeys(m, 0) for m in members]
    of_source: list[list[int]] = [[] for _ in targets]
    for p, m in enumerate(members):
        for s in m:
            of_source[s].append(p)
    spare, want = [0] * len(sizes), list(targets)
    for _ in range(repeats):
        spare = [a + b for a, b in zip(spare, sizes)]
        while True:
            seen: dict[tuple[str, int], tuple[str, int] | None] = {("p", p): None for p, x in enumerate(spare) if x > 0}
            queue, goal = deque(seen), None
            while queue and goal is None:
                kind, node = queue.popleft()
                if kind == "p":
                    steps = [("s", s) for s in members[node]]
                elif want[node] > 0:
                    goal = (kind, node)
                    break
                else:
                    steps = [("p", p) for p in of_source[node] if flow[p][node] > 0]
                for step in steps:
                    if step not in seen:
                        seen[step] = (kind, node)
                        queue.append(step)
            if goal is None:
                break
            path = [goal]
            while seen[path[-1]] is not None:
                path.append(seen[path[-1]])
            path.reverse()
            back = [flow[path[i + 1][1]][path[i][1]] for i in range(1, len(path) - 1, 2)]
            amount = min([spare[path[0][1]], want[goal[1]], *back])
            spare[path[0][1]] -= amount
            want[goal[1]] -= amount
            for i in range(0, len(path) - 1, 2):
                flow[path[i][1]][path[i + 1][1]] += amount
            for i in range(1, len(path) - 1, 2):
                flow[path[i + 1][1]][path[i][1]] -= amount
    return [[f[s] for s in m] for f, m in zip(flow, members)]


def _boundary(docs: DataFrame, keys: list[str], bits: Column) -> DataFrame:
    """Split the rows of each key by a part of their hash at the bucket where the wanted words end.

    Adds ``below`` (the row's bucket is taken in full), ``at_edge`` (it is the bucket in which the
    wanted words end) and ``rest`` (words still wanted from that bucket). Buckets are summed before
    they meet, so a window sees no more than ``BUCKETS`` rows of a key, however large it is.
    """
    rows = docs.withColumn("bucket", bits)
    sums = rows.groupBy(*keys, "rest", "bucket").agg(F.sum("size").alias("words"))
    before = F.coalesce(F.sum("words").over(
        W.partitionBy(*keys).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*keys, "bucket", (F.col("rest") - before).alias("left"), "words")
    return rows.drop("rest").join(sums.withColumnRenamed("left", "rest"), [*keys, "bucket"]) \
        .withColumn("below", F.col("rest") >= F.col("words")) \
        .withColumn("at_edge", (F.col("rest") > 0) & (F.col("rest") < F.col("words"))).drop("bucket", "words")


def _routed(patterns: DataFrame, sources: DataFrame, repeats: int, max_patterns: int) -> DataFrame:
    """``patterns`` with ``routed``, the words that the flow takes of each."""
    several = patterns.where(F.size("pattern") > 1)
    shared = stage(several.select(F.explode("pattern").alias("m")).select("m.*").distinct(), "shared-sources")
    one = patterns.where(F.size("pattern") == 1).withColumn("m", F.get("pattern", F.lit(0)))
    met = F.col("m.x") == F.col("x"), F.col("m.name").eqNullSafe(F.col("name"))
    alone = one.join(shared, list(met), "left_anti").join(
        broadcast_if_small(sources.select("source", "target")), F.col("m.name").eqNullSafe(F.col("source")))
    done = alone.select("pattern", "words", F.rint("target").cast("long").alias("routed"))
    none = patterns.where(F.coalesce(F.size("pattern"), F.lit(0)) <= 0).select("pattern", "words", F.lit(0).cast("long").alias("routed"))
    overlapping = several.unionByName(one.join(shared, list(met), "left_semi").drop("m"))
    found = overlapping.limit(max_patterns + 1).collect()
    if not found:
        return done.unionByName(none)
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns overlap")
    found.sort(key=lambda r: str(r.pattern))
    wanted = {r.source: round(r.target) for r in sources.join(shared, F.col("source").eqNullSafe(F.col("name")), "left_semi").collect()}
    names = sorted(wanted, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    flow = route([r.words or 0 for r in found], [[place[m.name] for m in r.pattern] for r in found], [wanted[s] for s in names], repeats)
    shape = T.StructType([patterns.schema["pattern"], T.StructField("words", T.LongType()), T.StructField("routed", T.LongType())])
    lists = patterns.sparkSession.createDataFrame([(r.pattern, r.words, sum(f)) for r, f in zip(found, flow)], shape)
    return done.unionByName(none).unionByName(lists)


def mix_with_sources(
    docs: DataFrame, weights: DataFrame | Mapping, members: str = "members", size: str = "size", id_col: str = "doc_id",
    told_by: Sequence[str] = (), total_share: float = 1.5, max_repeats: int = 2, seed: int = 11, max_patterns: int = 100_000,
) -> tuple[DataFrame, DataFrame]:
    """``mix`` and the table of its sources: ``source, weight, source_size, target``."""
    names = F.array_sort(F.array_distinct(F.transform(F.col(members), lambda m: F.struct(m.isNull().alias("x"), m.alias("name")))))
    key = [id_col, *told_by]
    docs = stage(docs.select(*key, names.alias("pattern"), F.col(size).cast("long").alias("size"),
                             F.xxhash64(F.lit(seed), *key).alias("drawn")), "mixture")
    spark = docs.sparkSession
    if isinstance(weights, Mapping):
        weights = spark.createDataFrame([(s, float(w)) for s, w in weights.items()], "source string, weight double")
    patterns = stage(docs.groupBy("pattern").agg(F.sum("size").alias("words")), "patterns")
    sizes = patterns.select(F.explode("pattern").alias("m"), "words").groupBy(F.col("m.name").alias("name")).agg(
        F.coalesce(F.sum("words"), F.lit(0)).alias("source_size"))
    sources = stage(sizes.join(weights, F.col("name").eqNullSafe(F.col("source"))).select("source", "weight", "source_size"), "sources")
    everything = patterns.where(F.size("pattern") > 0).agg(F.sum("words")).first()[0] or 0
    sources = source_targets(sources, total_share * everything, max_repeats)
    words = F.coalesce("words", F.lit(0))
    lists = _routed(patterns, sources, max_repeats, max_patterns).select(
        "pattern", F.monotonically_increasing_id().alias("p"),
        F.when(words > 0, F.floor(F.col("routed") / words)).otherwise(0).cast("long").alias("copies"),
        F.when(words > 0, F.col("routed") % words).otherwise(0).alias("rest"))
    lists = broadcast_if_small(stage(lists, "routed-patterns"))
    rows = docs.join(lists, docs["pattern"].eqNullSafe(lists["pattern"])).drop(lists["pattern"])

    first = _boundary(rows, ["p"], F.shiftrightunsigned("drawn", 52))
    edge = stage(first.where("at_edge").drop("below", "at_edge"), "edge-documents")
    second = _boundary(edge, ["p"], F.shiftrightunsigned("drawn", 40) % BUCKETS)
    keep = ["pattern", *key, "size", "copies"]
    sure = [x.where(~F.coalesce("at_edge", F.lit(False))).select(*keep, F.coalesce("below", F.lit(False)).cast("long").alias("extra"))
            for x in (first, second)]
    last = _one_by_one(second.where("at_edge").drop("below", "at_edge"), [*key, "size"]).select(*keep, "extra")
    copies = F.when(F.coalesce(F.col("size"), F.lit(0)) > 0, F.col("copies") + F.col("extra")).otherwise(0)
    mixed = sure[0].unionByName(sure[1]).unionByName(last).select(
        *key, F.transform("pattern", lambda m: m["name"]).alias("members"),
        F.col("size"), F.least(copies, F.lit(max_repeats)).cast("long").alias("copies"))
    return mixed, sources


def _one_by_one(edge: DataFrame, alike: list[str]) -> DataFrame:
    """The rows at the very edge with ``extra``: taken in the order of their draw while half of them or more is wanted.

    Rows alike in all that is returned are one row with their number until the end, so that the window
    sees only the different rows whose draws share 24 bits.
    """
    same = edge.groupBy("p", "pattern", "drawn", "copies", "rest", *alike).agg(F.count("*").alias("n"))
    words = F.coalesce("size", F.lit(0))
    before = F.coalesce(F.sum(words * F.col("n")).over(
        W.partitionBy("p").orderBy("drawn", *alike).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    left = F.col("rest") - before
    same = same.withColumn("k", F.when(words > 0, F.floor((2 * left + words) / (2 * words))).otherwise(0))
    block = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _AT_ONCE))
    rows = same.withColumn("block", F.explode(block)).withColumn("i", F.explode(F.sequence(
        F.col("block") * _AT_ONCE + 1, F.least(F.col("n"), (F.col("block") + 1) * _AT_ONCE))))
    return rows.withColumn("extra", (F.col("i") <= F.col("k")).cast("long"))


def mix(docs: DataFrame, weights: DataFrame | Mapping, members: str = "members", size: str = "size", id_col: str = "doc_id",
        told_by: Sequence[str] = (), total_share: float = 1.5, max_repeats: int = 2, seed: int = 11,
        max_patterns: int = 100_000) -> DataFrame:
    """``id_col, told_by, members, size, copies`` for every row of ``docs``.

    ``members`` is an array with the names of the sources a document belongs to (null is a name of
    its own), ``weights`` gives each source's weight, as a table (``source, weight``) or a mapping. All
    sources together want ``total_share`` times all sizes, a source at most ``max_repeats`` times its
    own. No document is taken more than ``max_repeats`` times. A source's words miss its target by
    half a document at most: the last one is taken if half of it or more is still wanted. Rows are
    drawn by their id and the columns ``told_by``, so rows that share an id, null or not, are drawn
    apart by these; rows alike in all are taken one by one. Rows of size 0 or without sources have 0
    copies. Sources may be any number; of overlapping patterns the driver sees one row each, and more
    than ``max_patterns`` of them are an error.
    """
    return mix_with_sources(docs, weights, members, size, id_col, told_by, total_share, max_repeats, seed, max_patterns)[0]


def source_weights(docs: DataFrame, source: str = "source", cycle: Sequence[float] = (5, 2, 1)) -> DataFrame:
    """``source, weight``: sources by code point, null last, with weights that repeat."""
    found = docs.select(F.col(source).alias("source")).distinct().select("source", F.col("source").isNull().alias("none"))
    placed = with_row_offset(found.withColumn("all", F.lit(0)), "all", ["none", "source"])
    return placed.select("source", F.get(F.array(*[F.lit(float(c)) for c in cycle]), ((F.col("row") - 1) % len(cycle)).cast("int")).alias("weight"))


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(NOT_SPACE)), F.lit(0)).cast("long")


def op10_mix_sources(docs: DataFrame) -> DataFrame:
    """All documents with the words that the mix takes of each."""
    sized = docs.select("doc_id", F.array("source").alias("members"), word_count("text").alias("size"), F.xxhash64("text").alias("text_key"))
    mixed, sources = mix_with_sources(sized, source_weights(docs), told_by=["text_key"])
    mixed = mixed.select("doc_id", F.get("members", F.lit(0)).alias("member"), "size", "copies")
    known = broadcast_if_small(sources.select("source", "source_size", "target"))
    return mixed.join(known, F.col("member").eqNullSafe(F.col("source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
