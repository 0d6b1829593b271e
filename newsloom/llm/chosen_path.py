"""Near-duplicate join by chosen paths.

Documents are sets of shingles of five words. A minhash signature turns the similarity of two sets
into the share of places at which their signatures agree. Each run splits all sets on a few sampled
places: sets that share a value there share a bucket, and buckets that are still large are split
again on places sampled for them. Small buckets are compared in full; a large one first has its centre
taken out, the sets that are like its commonest sketch. Single places hardly part a large bucket of which
most sets are like its centre, and all runs hold it: its sets, and what is still in large buckets at the last level,
are split on several places together, each set once whatever the number of its buckets, as often as the recall asks.
Runs repeat until a pair at the threshold is missed with less than the allowed chance. All pairs of a
class of candidates are then compared exactly by their shingles.

Equal sets are one node throughout. A bucket gives a star of candidate links, not all its pairs.
"""

from __future__ import annotations

import math
import random
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import FOLD, as_bytes, hold_for, pieces
from newsloom.llm.components import components
from newsloom.session import broadcast_if_small, stage

SHINGLE, PLACES, LIMIT, LEVELS = 5, 128, 128, 3
SLICE = 1 << 16  # bytes of a text whose words are held at a time
TOGETHER = 6  # places of a split of what single places do not part
_ODD = np.random.Generator(np.random.PCG64(97)).integers(0, 1 << 63, PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _word_hashes(text: bytes | None) -> np.ndarray:
    """A hash of each word. Words are held for a slice of the text at a time, cut where one ends."""
    if not text:
        return np.zeros(0, np.uint64)
    folded, out, at = text.translate(FOLD), [], 0
    while at < len(folded):
        end = folded.find(b" ", at + SLICE)
        words = folded[at:end if end >= 0 else len(folded)].split()
        out.append(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
        at = end if end >= 0 else len(folded)
    return np.concatenate(out)


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted different 64-bit hashes of all runs of ``size`` words; fewer words are one run."""
    each = _word_hashes(text)
    if not len(each):
        return np.zeros(0, np.uint64)
    n = min(size, len(each))
    runs = np.full(len(each) - n + 1, n, np.uint64)
    for k in range(n):
        runs = _mixed(runs + each[k:len(each) - n + 1 + k])
    return np.unique(runs)


def signature(grams: np.ndarray) -> np.ndarray:
    out = np.empty(PLACES, np.uint32)
    for first in range(0, PLACES, 8):
        out[first:first + 8] = ((grams[None, :] * _ODD[first:first + 8, None]) >> np.uint64(32)).min(axis=1)
    return out


def runs_needed(recall: float, levels: int = LEVELS) -> int:
    """Runs until a pair at the threshold is found with chance ``recall``, at the full depth.

    The number of places at which a node is split and the pair agrees is Poisson with mean 1.
    """
    met = 1.0
    for _ in range(levels):
        met = 1 - math.exp(-met)
    return math.ceil(math.log(1 - recall) / math.log(1 - met))


def splits_needed(recall: float, threshold: float, together: int = TOGETHER) -> int:
    """Splits on ``together`` places each until a pair at the threshold agrees at all of one, with chance ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** together))


def root_places(runs: int, threshold: float, seed: int) -> list[tuple[int, int]]:
    """The places on which each run splits all sets; one at least."""
    draw = random.Random(seed)
    out = []
    for r in range(runs):
        chosen = [i for i in range(PLACES) if draw.random() < 1 / (threshold * PLACES)] or [draw.randrange(PLACES)]
        out += [(r, i) for i in chosen]
    return out


def groups_of(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Whole groups of equal keys from batches that are sorted by the key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if held and held[-1].column(key)[0].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        edges = [0, *cuts.tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if held and a > 0:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def stars(alike: np.ndarray) -> np.ndarray:
    """The first member of each member's component, from a square table of links."""
    root = np.arange(len(alike))
    for i in range(len(alike)):
        near = np.flatnonzero(alike[i])
        if len(near):
            roots = np.unique(np.append(root[near], root[i]))
            root[np.isin(root, roots)] = roots[0]
    return root


def _sketches(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, PLACES)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from sketches of one byte a place, less the bytes that agree by chance."""
    return ((a == b).mean(axis=-1) - 1 / 256) * 256 / 255


def sketch(docs: DataFrame, text: str, id_col: str) -> DataFrame:
    """``id, text_key, node, sig, sketch`` of every row; the node stands for the set of shingles, null for none."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold_for("near duplicates", lambda: None)
        for batch in batches:
            for piece in pieces(batch, "text"):
                nodes, sigs, marks = [], [], []
                for t in as_bytes(piece.column("text")):
                    grams = shingles(t)
                    sig = signature(grams) if len(grams) else None
                    nodes.append(xxhash.xxh128_digest(grams.tobytes()) if len(grams) else None)
                    sigs.append(None if sig is None else sig.astype("<u4").tobytes())
                    marks.append(None if sig is None else (sig & 0xFF).astype(np.uint8).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("id"), piece.column("text_key"), *(pa.array(x, pa.binary()) for x in (nodes, sigs, marks))],
                    names=["id", "text_key", "node", "sig", "sketch"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("text_key"), F.col(text).alias("text"))
    return source.mapInArrow(work, "id long, text_key long, node binary, sig binary, sketch binary")


_LINK = "u binary, v binary"


def _links(us: list[bytes], vs: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])


def _bucket_links(members: DataFrame, least: float) -> DataFrame:
    """Candidate links of buckets. ``members`` has ``b, node, tag, sketch, far``: pairs with a far member are compared.

    Members of one tag are linked already; links are given between tags.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for group in groups_of(batches, "b"):
            tags, far = group.column("tag").to_pylist(), group.column("far").to_numpy(zero_copy_only=False).astype(bool)
            marks = _sketches(group.column("sketch"))
            known = np.unique(np.array(tags, dtype=object), return_inverse=True)[1]
            alike = known[:, None] == known[None, :]
            for i in np.flatnonzero(far):
                alike[i] |= estimate(marks, marks[i]) >= least
            root = stars(alike | alike.T)
            new = {(tags[r], tags[i]) for i, r in enumerate(root) if tags[r] != tags[i]}
            us += [u for u, _ in new]
            vs += [v for _, v in new]
            if len(us) > 10_000:
                yield _links(us, vs)
                us, vs = [], []
        yield _links(us, vs)

    dealt = members.select("b", "node", "tag", "sketch", "far").repartition("b").sortWithinPartitions("b", "node")
    return dealt.mapInArrow(work, _LINK)


def _alike(a: str, b: str) -> Column:
    """``estimate`` of two sketch columns, JVM-side."""
    same = F.filter(F.sequence(F.lit(1), F.lit(PLACES)), lambda i: F.substring(F.col(a), i, F.lit(1)) == F.substring(F.col(b), i, F.lit(1)))
    return (F.size(same) / PLACES - 1 / 256) * 256 / 255


def _finish(rows: DataFrame, sizes: DataFrame, nodes: DataFrame) -> DataFrame:
    """Deal a bucket of few far members into groups in which each of these meets ``LIMIT`` other members."""
    n_far, n_all = (F.ceil(F.col(c) / LIMIT).cast("int") for c in ("n_far", "n"))
    rows = rows.join(sizes, "b")
    for column, n in (("in_all", n_all), ("in_far", n_far)):
        rows = rows.withColumn(column, F.pmod(F.xxhash64("node"), n).cast("int"))
    # Each member goes to every block of far members, and a far one to every block of all members
    # too; where both lead a far member to the same group, once is enough.
    crowd = F.transform(F.sequence(F.lit(0), n_far - 1), lambda f: F.struct(
        f.alias("in_far"), F.col("in_all"), (F.col("far") & (f == F.col("in_far"))).alias("far")))
    ahead = F.filter(F.transform(F.sequence(F.lit(0), n_all - 1), lambda a: F.struct(
        F.col("in_far"), a.alias("in_all"), F.lit(True).alias("far"))), lambda g: g["in_all"] != F.col("in_all"))
    dealt = rows.select("b", "node", "tag", F.explode(F.when(F.col("far"), F.concat(crowd, ahead)).otherwise(crowd)).alias("g"))
    return dealt.select(F.xxhash64("b", "g.in_far", "g.in_all").alias("b"), "node", "tag", "g.far").join(
        nodes.select("node", "sketch"), "node")


def _centres(rows: DataFrame, large: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """``b, centre, lead, deep, kindred`` of each large bucket, from about 64 of its members, chosen by a hash.

    The centre has the commonest byte of each place. ``lead`` is the tag of the member nearest to it,
    null where none is like it. ``deep`` tells that the far ones among the 64 stand for more than
    twice ``LIMIT``, so that the bucket is to be split without counting them, ``kindred`` that at least
    half of the 64 are not far.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, leads, deep, kindred = [], [], [], []
            for n, held in zip(batch.column("n").to_pylist(), batch.column("held").to_pylist()):
                held.sort(key=lambda h: (h["tag"], h["sketch"]))
                marks = np.frombuffer(b"".join(h["sketch"] for h in held), np.uint8).reshape(-1, PLACES)
                counts = np.zeros((PLACES, 256), np.int32)
                np.add.at(counts, (np.arange(PLACES)[None, :], marks), 1)
                centre = counts.argmax(axis=1).astype(np.uint8)
                near = estimate(marks, centre)
                lead = held[int(near.argmax())]["tag"] if near.max() >= least else None
                far = sum(h["tag"] != lead and (lead is None or x < least) for h, x in zip(held, near))
                centres.append(centre.tobytes())
                leads.append(lead)
                deep.append(far * n > 2 * LIMIT * len(held))
                kindred.append(lead is not None and 2 * far <= len(held))
            yield pa.RecordBatch.from_arrays(
                [batch.column("b"), pa.array(centres, pa.binary()), pa.array(leads, pa.binary()), pa.array(deep, pa.bool_()),
                 pa.array(kindred, pa.bool_())], names=["b", "centre", "lead", "deep", "kindred"])

    some = rows.join(large, "b").where(F.pmod(F.xxhash64("b", "node"), F.ceil(F.col("n") / 64)) == 0).select("b", "n", "node", "tag")
    held = some.join(nodes.select("node", "sketch"), "node").groupBy("b", "n").agg(F.collect_list(F.struct("tag", "sketch")).alias("held"))
    return held.mapInArrow(work, "b long, centre binary, lead binary, deep boolean, kindred boolean")


def candidate_links(nodes: DataFrame, threshold: float, recall: float, seed: int, levels: int = LEVELS) -> DataFrame:
    """``u, v`` of nodes that met in a bucket and seem alike, as stars.

    A large bucket has a centre. Members like it are linked to one of them and carry its tag from then
    on: in the buckets split off they are known to be of one class, so only pairs with a far member,
    one of another tag and unlike the centre, are still of interest. Few far members meet all members
    of the bucket; more of them are split, on sampled places or, where most members are like the centre,
    at the end with the other hard sets. Each step takes work in proportion to a bucket's members:
    one join with the centres, and one with the counts of far members where the centre's sample does
    not already tell that they are many.
    """
    least = threshold - 0.15  # over four standard errors of a sketch of 128 places
    places = root_places(runs_needed(recall, levels), threshold, seed)
    keys = F.array(*[F.xxhash64(F.lit(r), F.lit(i), F.substring("sig", 4 * i + 1, 4)) for r, i in places])
    rows = nodes.select("node", F.col("node").alias("tag"), F.explode(keys).alias("b"))
    found, hard = [], []
    for level in range(1, levels + 1):
        sizes = stage(rows.groupBy("b").agg(
            F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y"),
            ).where("n > 1"), "bucket-sizes")
        # buckets of several runs with the same members are compared once
        small = sizes.where(F.col("n") <= LIMIT).groupBy("n", "x", "y").agg(F.min("b").alias("b")).select("b")
        members = rows.join(small, "b").join(nodes.select("node", "sketch"), "node").withColumn("far", F.lit(True))
        found.append(stage(_bucket_links(members, least), "bucket-links"))
        large = sizes.where(F.col("n") > LIMIT).select("b", "n")
        if large.isEmpty():
            break
        centres = stage(_centres(rows, large, nodes, least), "bucket-centres")
        crowd = rows.join(broadcast_if_small(centres), "b").join(nodes.select("node", "sketch", "sig"), "node")
        crowd = crowd.select("b", "node", "tag", "sig", "lead", "deep", "kindred", _alike("sketch", "centre").alias("near"))
        alike, other = F.col("lead").isNotNull() & (F.col("near") >= least), ~F.col("tag").eqNullSafe(F.col("lead"))
        # stored once: links, counts, comparisons and splits all read it. Members almost equal to a
        # centre that leads cannot be like a far one, so they need no further split and lose their signature
        crowd = stage(crowd.select(
            "b", "node", "deep", "kindred", F.when(F.col("lead").isNull() | (F.col("near") < 0.95), F.col("sig")).alias("sig"),
            F.when(alike & other, F.col("tag")).alias("linked"), (~alike & other).alias("far"),
            F.when(~alike & other, F.col("tag")).otherwise(F.col("lead")).alias("tag")), "led-buckets")
        found.append(crowd.where("linked IS NOT NULL").select(F.col("tag").alias("u"), F.col("linked").alias("v")))
        counted = crowd.where("NOT deep").select("b", "node", "tag", "sig", "far", "kindred")
        counts = stage(counted.groupBy("b").agg(F.count("*").alias("n"), F.sum(F.col("far").cast("long")).alias("n_far")).where("n_far > 0"), "far-sizes")
        found.append(stage(_bucket_links(_finish(counted, counts.where(F.col("n_far") <= LIMIT), nodes), least), "bucket-links"))
        deeper = counts.where(F.col("n_far") > LIMIT).select("b")
        left = counted.where("sig IS NOT NULL").join(deeper, "b").select("b", "node", "tag", "sig", "kindred").unionByName(
            crowd.where("deep AND sig IS NOT NULL").select("b", "node", "tag", "sig", "kindred"))
        hard.append((left if level == levels else left.where("kindred")).select("node"))
        left = left.where("NOT kindred")
        if level == levels or left.isEmpty():
            break
        step = int((1 << 32) / (threshold * PLACES))
        chosen = F.filter(F.sequence(F.lit(0), F.lit(PLACES - 1)), lambda i: F.xxhash64(F.lit(level), "b", i).bitwiseAND(F.lit((1 << 32) - 1)) < step)
        rows = stage(left.select("node", "tag", F.explode(F.transform(chosen, lambda i: F.xxhash64(
            F.lit(level), "b", i, F.substring(F.col("sig"), i * 4 + 1, F.lit(4))))).alias("b")), "split-buckets")
    if hard:
        sets = stage(reduce(DataFrame.unionByName, hard).distinct(), "hard-sets")
        if not sets.isEmpty():
            found.append(_last_links(sets, nodes, threshold, recall, seed, least))
    return reduce(DataFrame.unionByName, found)


def _last_links(hard: DataFrame, nodes: DataFrame, threshold: float, recall: float, seed: int, least: float) -> DataFrame:
    """Links among the sets left in large buckets, each set once whatever the number of these.

    Sets that agree at several places together share a bucket, and most that do are alike. A bucket
    that is large all the same is linked to its least member where alike; the others are compared in blocks.
    """
    draw = random.Random(seed + 1)
    groups = [draw.sample(range(PLACES), TOGETHER) for _ in range(splits_needed(recall, threshold))]
    keys = F.array(*[F.xxhash64(F.lit(-1 - r), *[F.substring("sig", 4 * i + 1, 4) for i in group]) for r, group in enumerate(groups)])
    rows = stage(hard.join(nodes.select("node", "sig"), "node").select("node", F.explode(keys).alias("b")), "hard-buckets")
    sizes = stage(rows.groupBy("b").agg(F.count("*").alias("n"), F.min("node").alias("lead"), F.bit_xor(F.xxhash64("node")).alias("x"),
                                        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("y")).where("n > 1"), "hard-sizes")
    once = sizes.groupBy("n", "x", "y").agg(F.min(F.struct("b", "lead")).alias("k")).select("k.b", "k.lead", "n")
    members = rows.join(once.where(F.col("n") <= LIMIT).select("b"), "b").join(nodes.select("node", "sketch"), "node")
    small = _bucket_links(members.withColumn("tag", F.col("node")).withColumn("far", F.lit(True)), least)
    leads = once.where(F.col("n") > LIMIT).join(nodes.select(F.col("node").alias("lead"), F.col("sketch").alias("lead_sketch")), "lead")
    crowd = rows.join(leads, "b").join(nodes.select("node", "sketch"), "node").withColumn("alike", _alike("sketch", "lead_sketch") >= least)
    crowd = stage(crowd.select("b", "node", "lead", F.when(F.col("alike"), F.col("lead")).otherwise(F.col("node")).alias("tag"),
                               (~F.col("alike")).alias("far")), "hard-crowds")
    counts = crowd.groupBy("b").agg(F.count("*").alias("n"), F.sum(F.col("far").cast("long")).alias("n_far")).where("n_far > 0")
    return small.unionByName(crowd.where(~F.col("far")).select(F.col("lead").alias("u"), F.col("node").alias("v"))).unionByName(
        _bucket_links(_finish(crowd.drop("lead"), stage(counts, "far-sizes"), nodes), least))


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairs' intersections, by products of slices of the incidence table."""
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(at, kind="stable")
    rows, at = rows[order], at[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for first in range(0, len(values), 16_384):
        lo, hi = np.searchsorted(at, (first, first + 16_384))
        part = np.zeros((len(sets), 16_384), np.float32)
        part[rows[lo:hi], at[lo:hi] - first] = 1
        out += part @ part.T
    return out


def _exact_links(texts: DataFrame, threshold: float) -> DataFrame:
    """``node, root, links`` from groups of texts of one class.

    A group holds one block of a class (``side`` 0) or two of them (0 and 1, compared across).
    ``links`` is the number of documents linked to the node in this group, ``root`` a member of its
    component there.
    """
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "g"):
            nodes = group.column("node").to_pylist()
            sides = group.column("side").to_numpy(zero_copy_only=False)
            copies = group.column("copies").to_numpy(zero_copy_only=False).astype(np.int64)
            sets = [shingles(t) for t in as_bytes(group.column("text"))]
            sizes = np.array([len(s) for s in sets], np.float64)
            both = shared_counts(sets).astype(np.float64)
            alike = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
            np.fill_diagonal(alike, False)
            if sides.any():
                alike &= sides[:, None] != sides[None, :]
            root = stars(alike)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array([nodes[r] for r in root], pa.binary()), pa.array(alike @ copies, pa.int64())],
                names=["node", "root", "links"])

    dealt = texts.select("g", "node", "side", "copies", "text").repartition("g").sortWithinPartitions("g", "node")
    return dealt.mapInArrow(work, "node binary, root binary, links long")


def _node_classes(
    docs: DataFrame, text: str, id_col: str, threshold: float, recall: float, seed: int,
) -> tuple[DataFrame, DataFrame]:
    """``id, text_key, node`` of every row, and ``node, label, min_id, n_links`` of every set of shingles."""
    seen = stage(sketch(docs, text, id_col), "sketches")
    nodes = stage(seen.where("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("copies"), F.min("id").alias("min_id"), F.min(F.struct("id", "text_key")).alias("source"),
        F.any_value("sig").alias("sig"), F.any_value("sketch").alias("sketch")), "nodes")
    classes = components(candidate_links(nodes, threshold, recall, seed))
    sizes = classes.groupBy("label").agg(F.count("*").alias("m"))
    members = classes.join(sizes, "label").join(nodes.select("node", "copies", "source"), "node").select(
        "node", "label", "m", "copies", "source.id", "source.text_key")
    members = broadcast_if_small(stage(members, "class-members"))
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    rows = rows.join(members, F.col("doc").eqNullSafe(F.col("id")) & (F.col("key") == F.col("text_key")))
    n = F.ceil(F.col("m") / LIMIT).cast("int")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), n)).dropDuplicates(["node"])
    pairs = F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(
        F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    dealt = rows.select("node", "label", "copies", "text", "block", F.explode(pairs).alias("p")).select(
        F.xxhash64("label", "p.i", "p.j").alias("g"), "node", "copies", "text",
        (F.col("block") != F.col("p.i")).cast("int").alias("side"))
    exact = stage(_exact_links(dealt, threshold), "exact-links")
    links = exact.groupBy("node").agg(F.sum("links").alias("links"))
    labels = components(exact.select(F.col("root").alias("u"), F.col("node").alias("v")))
    known = nodes.select("node", "copies", "min_id").join(labels, "node", "left").join(links, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), "min_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    known = stage(known, "node-classes")
    return seen, known


def near_duplicates(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", threshold: float = 0.8, recall: float = 0.999, seed: int = 5,
) -> DataFrame:
    """``id_col, class_id, n_links`` for every row of ``docs``.

    Two documents are linked when their sets of five-word shingles have a Jaccard similarity of
    ``threshold`` or more; ``n_links`` counts the other rows a row is linked to, ``class_id`` is the
    smallest id of its class, that is, of all rows it reaches by links. A pair at the threshold is
    missed with a chance of at most ``1 - recall``; a linked pair is never wrong. A text of fewer
    than five words is one shingle. Null texts and texts without words have no links and are a class
    by id. A null id gets the class of its text's other rows, or null. Rows that repeat count as
    links. An empty table gives none. Further columns are not read.
    """
    seen, known = _node_classes(docs, text, id_col, threshold, recall, seed)
    named = known.join(known.groupBy("label").agg(F.min("min_id").alias("class_id")), "label").select("node", "class_id", "n_links")
    return seen.select("id", "node").join(named, "node", "left").select(
        F.col("id").alias(id_col),
        F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"))


def one_of_each_class(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", threshold: float = 0.8, recall: float = 0.999, seed: int = 5,
) -> DataFrame:
    """One row of ``docs``, with all its columns, of each class of ``near_duplicates``.

    It is the one with the smallest id, a null id last, and among equal ids the smallest hash of the
    text; of rows that repeat both, the one with the smallest columns. Null texts and texts without
    words are a class by id and text.
    """
    seen, known = _node_classes(docs, text, id_col, threshold, recall, seed)
    rows = seen.groupBy("id", "text_key", "node").agg(F.count("*").alias("n"))
    firsts = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_key", "n")).alias("first"))
    firsts = firsts.join(known, "node").groupBy("label").agg(F.min("first").alias("first")).select("first.id", "first.text_key", "first.n")
    kept = stage(firsts.unionByName(rows.where("node IS NULL").select("id", "text_key", "n")), "kept-documents").select(
        F.col("id").alias("kept_id"), F.col("text_key").alias("kept_key"), F.col("n").alias("kept_n"))

    def these(some: DataFrame) -> DataFrame:
        same = docs[id_col].cast("long").eqNullSafe(some["kept_id"]) & F.xxhash64(docs[text]).eqNullSafe(some["kept_key"])
        return docs.join(broadcast_if_small(some), same, "left_semi")

    repeated = these(kept.where("kept_n > 1")).groupBy(F.col(id_col).alias("kept_id"), F.xxhash64(text).alias("kept_key")).agg(
        F.min(F.struct(*docs.columns)).alias("row"))
    return these(kept.where("kept_n = 1")).unionByName(repeated.select("row.*"))


def op4_near_duplicates(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs)
