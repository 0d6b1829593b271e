"""Packing token sequences by exact complements.

Documents are encoded, those longer than a sequence are cut, and the pieces are counted by length:
however many there are, the plan is made from at most ``capacity`` counts. The longest length opens
a sequence. The gap is looked up among the lengths at hand, then among the sums of two and of three of
them; while none fills it exactly, the longest that fits goes in. A combination that fills a sequence
to the last token is consumed as often as the counts allow at once, so each step uses up a length.
What is left over, longest first, goes into the fullest sequence in which it fits (best fit).

Each piece then finds its place by its number among the pieces of its length. Tasks number theirs
while they write them; sums of their counts turn that into numbers over all, without a sort and
without one task that holds a frequent length. The plan gives each length its runs of numbers.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from newsloom.llm.common import as_bytes, pieces as slices
from newsloom.session import broadcast_if_small, stage

CAPACITY = 1024
_LONG = 1 << 20  # bytes of text encoded at a time
_ODD_BYTES = b"\x09\x0b\x0c\x0d\x1c\x1d\x1e\x1f"
_WIDE_SPACE = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
_SAFE_CUT = re.compile(rb"(?<=[!-~]) (?=[!-~])")
# A full stop or comma that does not end a word of letters or digits may belong to a longer run of marks.
_ODD_STOP = re.compile(rb"[,.](?<![0-9A-Za-z].)(?<!\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].)[ \n]")
# The last character of a run of white space goes with the word behind it, the others before it stand alone.
_CHUNKS = re.compile(r"\s+(?=\s\S)|\s?\S+|\s+")
_ODD_SPACE = re.compile(r"[\x1c-\x1f]")
_BARE = b"\x00"  # marks a chunk without a blank before it


def single_spaced(text: bytes) -> bool:
    """Whether all white space is single blanks and newlines between words."""
    if b"  " in text or b" \n" in text or b"\n " in text or b"\n\n" in text or len(text.translate(None, _ODD_BYTES)) < len(text):
        return False
    return text.isascii() or not ((b"\xe2" in text or b"\xc2" in text or b"\xe1" in text or b"\xe3" in text) and _WIDE_SPACE.search(text))


class ByteEncoder:
    """Ids of whole texts by a byte-level tokenizer, whose tokens never span the start of white space.

    Words with the blank or newline before them are encoded by the library once, many at a time, and
    remembered, ``bound`` of them at most. A text with a special token's name, or with control
    characters on whose kind libraries differ, is left to the library as a whole.
    """

    def __init__(self, path: str, bound: int = 1_000_000):
        self.tokenizer, self.bound, self.known = Tokenizer.from_file(path), bound, {}
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        names = self.tokenizer.get_vocab()
        # ids whose tokens start with a blank or a newline, which are these letters in the vocabulary
        self.starts = {lead: np.zeros(max(names.values()) + 1, bool) for lead in " \n"}
        for lead, letter in ((" ", "\u0120"), ("\n", "\u010a")):
            self.starts[lead][[i for name, i in names.items() if name.startswith(letter)]] = True

    def ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, dtype="<u4").tobytes() for f in found]

    def chunks(self, text: bytes) -> list[bytes] | None:
        """Parts that the tokenizer encodes on their own, or None.

        A part that starts with the mark of a bare chunk or a newline is meant as it is; any other
        had a blank before it.
        """
        if single_spaced(text):
            if not _ODD_STOP.search(text):
                for stop in (b",", b"."):
                    text = text.replace(stop + b" ", b" " + _BARE + stop + b" ").replace(stop + b"\n", b" " + _BARE + stop + b"\n")
            first, *rest = text.replace(b"\n", b" \n").split(b" ")
            return [_BARE + first, *rest] if first else rest
        plain = text.decode("utf-8", "replace")
        if _ODD_SPACE.search(plain):
            return None
        found = (c.encode() for c in _CHUNKS.findall(plain))
        return [c[1:] if c[:1] == b" " and b"!" <= c[1:2] <= b"~" else _BARE + c for c in found]

    def parts(self, text: bytes) -> Iterator[list[bytes] | bytes]:
        """Lists of chunks of one text, a slice of it each; bytes are for the library as a whole."""
        if _BARE in text or any(s in text for s in self.special):
            yield text
            return
        start = 0
        while start < len(text):
            cut = _SAFE_CUT.search(text, start + _LONG) if len(text) - start > 2 * _LONG else None
            end = cut.start() if cut else len(text)
            chunks = self.chunks(text[start:end])
            yield text[start:end] if chunks is None else chunks
            start = end

    def learn(self, chunks: set[bytes]) -> None:
        new = chunks.difference(self.known)
        if len(self.known) + len(new) > self.bound:
            self.known.clear()
            new = chunks
        single = {c for c in new if c[:1] == _BARE or c in (b"", b"\n")}
        breaks = {c for c in new if c[:1] == b"\n"} - single
        for lead, some in ((" ", list(new - single - breaks)), ("\n", list(breaks))):
            for first in range(0, len(some), 100):  # longer runs fall out of the processor's caches
                here = some[first:first + 100]
                text = b" " + b" ".join(here) if lead == " " else b"".join(here)
                ids = np.array(self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids, dtype="<u4")
                cuts = np.flatnonzero(self.starts[lead][ids]) * 4
                if len(cuts) == len(here):
                    codes = ids.tobytes()
                    self.known.update((c, codes[a:b]) for c, a, b in zip(here, cuts.tolist(), [*cuts[1:].tolist(), len(codes)]))
                else:
                    single.update(here)
        last = list(single)
        texts = [(c[1:] if c[:1] == _BARE else c if c[:1] == b"\n" else b" " + c).decode("utf-8", "replace") for c in last]
        self.known.update(zip(last, self.ids(texts)))

    def encode_all(self, texts: list[bytes | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. A null text has none."""
        split = [list(self.parts(t)) if t else [] for t in texts]
        wanted = set().union(*(p for parts in split for p in parts if isinstance(p, list)))
        if not wanted <= self.known.keys():
            self.learn(wanted)
        known = self.known.__getitem__
        return [b"".join([b"".join(map(known, p)) if isinstance(p, list) else self.ids([p.decode("utf-8", "replace")])[0] for p in parts])
                for parts in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    """One per worker process, which keeps its words from task to task."""
    return ByteEncoder(path)


def cut_documents(
    docs: DataFrame, tokenizer: str, text: str = "text", id_col: str = "doc_id", end_id: int | None = 2, capacity: int = CAPACITY,
) -> DataFrame:
    """``id_col, piece, start, length, ids`` of every piece of every row, ids as little-endian unsigned 32-bit integers.

    Only documents of more than ``capacity`` tokens, their end token included, are cut; all pieces
    but the first are full. A null or empty text is its end token alone (or no piece, without one).
    Rows that repeat an id stay, and further columns are not read.
    """
    tail, kind = struct.pack("<I", end_id) if end_id is not None else b"", docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "text", _LONG):
                rows: list[tuple[int, int, int, bytes]] = []
                for i, ids in enumerate(encoder(tokenizer).encode_all(as_bytes(some.column("text")))):
                    ids += tail
                    n = len(ids) // 4
                    starts = [0, *range(n % capacity or capacity, n, capacity)] if n else []
                    rows += [(i, k, a, ids[4 * a:4 * b]) for k, (a, b) in enumerate(zip(starts, [*starts[1:], n]))]
                at = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(at), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()),
                     pa.array([len(r[3]) // 4 for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary())],
                    names=[id_col, "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col), F.col(text).alias("text")).mapInArrow(
        work, f"`{id_col}` {kind}, piece int, start long, length long, ids binary")


class Complements:
    """Counts of lengths, and which sums two of those at hand have."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.n = capacity, np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.n[length] = count
        at_hand = np.flatnonzero(self.n)
        self.pairs = np.zeros(2 * capacity + 1, np.int64)  # sum -> pairs of lengths at hand with it
        for i, length in enumerate(at_hand):
            self.pairs[length + at_hand[i + 1:]] += 1
            self.pairs[2 * length] += self.n[length] > 1

    def take(self, length: int, times: int) -> None:
        before = self.n[length]
        self.n[length] = after = before - times
        if before > 1 >= after:
            self.pairs[2 * length] -= 1
        if after == 0 and before:
            self.pairs[length + np.flatnonzero(self.n)] -= 1

    def longest(self, most: int) -> int:
        """The longest length at hand of at most ``most``, or 0."""
        found = np.flatnonzero(self.n[1:max(most, 0) + 1])
        return int(found[-1]) + 1 if len(found) else 0

    def _pair(self, gap: int) -> tuple[int, int] | None:
        """The most unequal two lengths with the sum ``gap``."""
        if gap < 2 or self.pairs[gap] <= 0:
            return None
        large = np.arange(gap - 1, (gap - 1) // 2, -1)
        ok = (self.n[large] > 0) & (self.n[gap - large] > (large == gap - large))
        at = np.flatnonzero(ok)
        return (int(large[at[0]]), int(gap - large[at[0]])) if len(at) else None

    def fill(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three lengths at hand whose sum is ``gap``, long ones first."""
        if self.n[gap] > 0:
            return (gap,)
        two = self._pair(gap)
        if two:
            return two
        first = np.arange(gap - 2, 0, -1)
        first = first[(self.n[first] > 0) & (self.pairs[gap - first] > 0)]
        for x in first.tolist():
            self.n[x] -= 1  # its pairs may count on the copy that is taken
            two = self._pair(gap - x)
            self.n[x] += 1
            if two:
                return (x, *two)
        return None


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """``(times, lengths)`` of sequences that together use up ``counts``, pieces by length."""
    left, plan, residual = Complements({n: c for n, c in counts.items() if n > 0 and c > 0}, capacity), [], {}
    top = capacity
    while (top := left.longest(top)) > 0:
        held = [top]
        left.take(top, 1)
        while (gap := capacity - sum(held)) > 0:
            rest = left.fill(gap) or ((n,) if (n := left.longest(gap)) else ())
            if not rest:
                break
            held += rest
            for n in rest:
                left.take(n, 1)
        if gap > 0:  # nothing fills it: the opening piece waits for the best fit, the others stay at hand
            for n in held[1:]:
                _give(left, n)
            residual[top] = residual.get(top, 0) + 1 + int(left.n[top])
            left.take(top, int(left.n[top]))
            continue
        lengths, uses = np.unique(held, return_counts=True)
        more = int((left.n[lengths] // uses).min())
        for n, k in zip(lengths.tolist(), uses.tolist()):
            if more:
                left.take(n, k * more)
        plan.append((1 + more, held))
    return plan + best_fit(residual, capacity)


def _give(left: Complements, length: int) -> None:
    before = left.n[length]
    if before == 0:
        left.pairs[length + np.flatnonzero(left.n)] += 1
    left.n[length] = before + 1
    if before == 1:
        left.pairs[2 * length] += 1


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """The same by best fit, longest first. Sequences alike are one group, which a length splits at most once."""
    open_: dict[int, list[list]] = {}  # gap -> [times, lengths] of groups
    gaps = np.zeros(capacity + 1, bool)

    def put(times: int, lengths: list[int], gap: int) -> None:
        open_.setdefault(gap, []).append([times, lengths])
        gaps[gap] = True

    for length in sorted(counts, reverse=True):
        n = counts[length]
        while n > 0:
            fitting = np.flatnonzero(gaps[length:])
            if not len(fitting):
                each = min(capacity // length, n)
                put(n // each, [length] * each, capacity - each * length)
                n %= each
                continue
            gap = int(fitting[0]) + length
            times, lengths = group = open_[gap][-1]
            used = min(times, n)
            if used == times:
                open_[gap].pop()
                gaps[gap] = bool(open_[gap])
            else:
                group[0] -= used
            put(used, [*lengths, length], gap - length)
            n -= used
    return [(t, held) for groups in open_.values() for t, held in groups]


def _runs(plan: list[tuple[int, list[int]]], capacity: int) -> np.ndarray:
    """Runs of piece numbers: length, first number, sequences, first sequence, offset of the first; sorted."""
    out, used, sequence = [], [0] * (capacity + 1), 0
    for times, held in plan:
        offset = 0
        lengths, uses = np.unique(held, return_counts=True)
        for length, k in zip(lengths.tolist(), uses.tolist()):
            out.append((length, used[length], times, sequence, offset))
            used[length] += times * k
            offset += length * k
        sequence += times
    return np.array(sorted(out), np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with all their columns, and ``sequence_id, offset``: the place of each in a sequence.

    Every row with a length from 1 to ``capacity`` has its place; each sequence holds ``capacity`` at
    most and is gapless from 0. A null or other length has null places. Rows that repeat are
    pieces of their own. An empty table gives none. The driver sees one count per length. Columns
    of ``pieces`` must not be called ``pack_part``, ``pack_pos``, ``sequence_id`` or ``offset``.
    """
    spark, before = pieces.sparkSession, list(pieces.columns)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            lengths = batch.column(length).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            lengths = np.where((lengths > 0) & (lengths <= capacity), lengths, 0)
            order = np.argsort(lengths, kind="stable")
            ranked = lengths[order]
            firsts = np.searchsorted(ranked, ranked, side="left")
            pos = np.empty(len(lengths), np.int64)
            pos[order] = np.arange(len(lengths)) - firsts + seen[ranked]
            seen += np.bincount(lengths, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(pos), part), pa.int64()), pa.array(pos)], names=[*before, "pack_part", "pack_pos"])

    own = T.StructType([*pieces.schema.fields, T.StructField("pack_part", T.LongType()), T.StructField("pack_pos", T.LongType())])
    held = stage(pieces.mapInArrow(number, own), "numbered-pieces")
    sized = F.col(length).between(1, capacity)
    parts = stage(held.where(sized).groupBy(F.col(length).cast("long").alias("of"), "pack_part").agg(F.count("*").alias("n")), "piece-counts")
    counts = {r["of"]: r["n"] for r in parts.groupBy("of").agg(F.sum("n").alias("n")).collect()}
    runs = spark.sparkContext.broadcast(_runs(plan_sequences(counts, capacity), capacity))
    ahead = F.sum("n").over(W.partitionBy("of").orderBy("pack_part").rowsBetween(W.unboundedPreceding, -1))
    parts = broadcast_if_small(parts.select("of", F.col("pack_part").alias("of_part"), F.coalesce(ahead, F.lit(0)).alias("ahead")), max_rows=1_000_000)
    held = held.join(parts, (F.col(length) == F.col("of")) & (F.col("pack_part") == F.col("of_part")), "left")
    held = held.select(*before, (F.col("ahead") + F.col("pack_pos")).alias("pack_pos"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        for batch in batches:
            number = batch.column("pack_pos")
            known = np.array(number.is_valid())
            rank = number.fill_null(0).to_numpy(zero_copy_only=False)[known]
            lengths = batch.column(length).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[known]
            at = _last_at_most(table, lengths, rank)
            _, first, times, sequence, offset = table[at].T
            turn = rank - first
            out = np.zeros((2, len(known)), np.int64)
            out[0, known], out[1, known] = sequence + turn % times, offset + turn // times * lengths
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(x, pa.int64(), mask=~known) for x in out)], names=[*before, "sequence_id", "offset"])

    return held.mapInArrow(place, T.StructType([
        *pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]))


def _last_at_most(table: np.ndarray, lengths: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The place in the sorted runs of the last one of each length whose first number is not above ``rank``."""
    low, high = np.searchsorted(table[:, 0], lengths, "left"), np.searchsorted(table[:, 0], lengths, "right")
    while (high - low > 1).any():
        middle = (low + high) // 2
        up = table[middle, 1] <= rank
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return low


def sequences(packed: DataFrame, ids: str = "ids") -> DataFrame:
    """``sequence_id, ids, lengths`` of whole sequences, from packed pieces with their ids. A group holds one sequence."""
    inside = F.array_sort(F.collect_list(F.struct("offset", F.col(ids).alias("ids"))))
    whole = packed.where("sequence_id IS NOT NULL").groupBy("sequence_id").agg(inside.alias("inside"))
    joined = F.aggregate("inside", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x["ids"]))
    return whole.select("sequence_id", joined.alias("ids"), F.transform("inside", lambda x: (F.octet_length(x["ids"]) / 4).cast("int")).alias("lengths"))


def op11_pack_sequences(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Pieces of all documents with their places and digests of their ids."""
    found = cut_documents(docs, tokenizer).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(found)
