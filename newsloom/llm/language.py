"""Language identification with hyperdimensional profiles.

Every letter has a seeded random vector of plus and minus ones. A letter trigram is the product of
its letters' vectors, each rotated by its place. A document is the sum of its trigrams' vectors, a
language the sum of its training documents' unit vectors, and a document's language is the
prototype with the largest cosine. The work per document is one small matrix product.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import hash_share, hold_for, pieces, remainder, share
from newsloom.session import stage

DIMENSIONS = 1024
SEED = 20240229
UNKNOWN = "und"
SCALES = 40  # powers of two that tell lengths of texts
_GRAMS = 2048  # trigram vectors held at a time
_CELLS = 1 << 19  # counts held at a time
_ROWS = 1024  # texts measured at a time, each of which has a vector
_SLICE = 1 << 18  # characters of text encoded at a time
_PIECE = 1 << 20  # bytes of text decoded at a time


@cache
def _letter_table() -> np.ndarray:
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), dtype=bool, count=0x110000)


@lru_cache(maxsize=8192)
def _letter(code: int, dimensions: int, seed: int) -> np.ndarray:
    """The vector of a letter (0: the edge of a word), a function of its code point and the seed."""
    bits = np.random.Generator(np.random.Philox(key=(seed << 32) + code)).integers(0, 2, dimensions, dtype=np.int8)
    return bits * 2 - 1


def _gram_vectors(grams: np.ndarray, dimensions: int, seed: int) -> np.ndarray:
    out = None
    for shift, turn in ((42, 2), (21, 1), (0, 0)):
        codes, at = np.unique((grams >> shift) & 0x1FFFFF, return_inverse=True)
        letters = np.stack([np.roll(_letter(int(c), dimensions, seed), turn) for c in codes])[at]
        out = letters if out is None else out * letters
    return out.astype(np.float32)


def _letters(text: str | None) -> Iterator[tuple[np.ndarray, int]]:
    """Code points of the lower-case letters, a slice of the text at a time, and how many of them are new.

    Anything before, between or after letters is one edge, 0. A slice starts with the last two codes
    of the one before, so that the trigrams of all slices are those of the whole text.
    """
    text, start, carry = text or "", 0, np.zeros(0, np.int64)
    while start < len(text) or not start:
        end = start + _SLICE
        if end < len(text):
            end = max(text.rfind(" ", start, end), start) + 1 if text.rfind(" ", start, end) > start else end
        codes = np.frombuffer(text[start:end].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        codes[~_letter_table()[codes]] = 0
        if end >= len(text):
            codes = np.append(codes, 0)
        before = carry[-1:] if len(carry) else np.ones(1, np.int64)  # the first edge stays
        if not len(carry):
            codes = np.concatenate(([0], codes))
        codes = codes[(codes != 0) | (np.concatenate((before, codes[:-1])) != 0)]
        held = np.concatenate((carry, codes))
        yield held, len(codes)
        carry, start = held[-2:], max(end, 1)


def letter_grams(text: str | None) -> np.ndarray:
    """Trigrams of the lower-case letters as integers. Anything between letters is one edge."""
    return np.concatenate([_grams(c) for c, _ in _letters(text)])


def _grams(codes: np.ndarray) -> np.ndarray:
    return (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:] if len(codes) > 2 else codes[:0]


def _measure(texts: list[str | None], dimensions: int, seed: int, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text the sum of its trigrams' vectors, their number, and how many letters are ``known`` less the others.

    About ``_SLICE`` characters are worked on at a time, so memory does not grow with the lengths of
    texts; callers give about ``_ROWS`` texts, since each has a vector.
    """
    hold_for("language", _letter.cache_clear)
    out, sizes, balance = np.zeros((len(texts), dimensions), np.float32), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    rows: list[int] = []
    parts: list[np.ndarray] = []
    held = 0

    def flush() -> None:
        np.add.at(out, rows, _encode(parts, dimensions, seed))
        rows.clear()
        parts.clear()

    for i, text in enumerate(texts):
        for codes, new in _letters(text):
            grams = _grams(codes)
            sizes[i] += len(grams)
            if known is not None:
                fresh = codes[len(codes) - new:]
                fresh = fresh[fresh != 0]
                balance[i] += 2 * int(known[fresh].sum()) - len(fresh)
            rows.append(i)
            parts.append(grams)
            held += len(grams)
            if held >= 2 * _SLICE:
                flush()
                held = 0
    if rows:
        flush()
    return out, sizes, balance


def encode(texts: list[str | None], dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """One row per text: the sum of its trigrams' vectors. A text without letters is all zero.

    Trigram vectors and counts are made in blocks, so memory does not grow with the alphabet.
    """
    return _measure(texts, dimensions, seed)[0]


def _encode(parts: list[np.ndarray], dimensions: int, seed: int) -> np.ndarray:
    out = np.zeros((len(parts), dimensions), dtype=np.float32)
    rows = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    grams, at = np.unique(np.concatenate(parts) if parts else np.zeros(0, np.int64), return_inverse=True)
    order = np.argsort(at, kind="stable") if len(grams) > _GRAMS else None
    if order is not None:
        rows, at = rows[order], at[order]
    for first in range(0, len(grams), _GRAMS):
        block = grams[first:first + _GRAMS]
        lo, hi = (0, len(at)) if order is None else np.searchsorted(at, (first, first + len(block)))
        vectors, step = _gram_vectors(block, dimensions, seed), max(1, _CELLS // len(block))
        here, which = rows[lo:hi], at[lo:hi] - first
        for top in range(0, len(parts), step):
            n = min(step, len(parts) - top)
            inside = slice(None) if n == len(parts) else (here >= top) & (here < top + n)
            counts = np.bincount((here[inside] - top) * len(block) + which[inside], minlength=n * len(block))
            out[top:top + n] += counts.reshape(n, -1).astype(np.float32) @ vectors
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def train_prototypes(
    docs: DataFrame, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
    per_language: int = 2000, max_languages: int = 4096, dimensions: int = DIMENSIONS, seed: int = SEED,
) -> dict[str, np.ndarray]:
    """Language prototypes from the labelled rows of ``docs``.

    ``per_language`` bounds the sample: about so many rows of each language are used, chosen by a
    hash of their id. Rows without a language or without letters teach nothing. Sums are taken in
    whole numbers, so a rerun gives the same prototypes. More than ``max_languages`` different
    values are an error, since a prototype of each goes to every task. An empty table gives none.
    """
    labelled = _labelled(docs, text, lang, id_col)
    found = _bounded(labelled.groupBy("lang").agg(F.count("*").alias("n_rows")), max_languages)
    return _train(_sampled(labelled, found, per_language), dimensions, seed) if found else {}


def _labelled(docs: DataFrame, text: str, lang: str, id_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")) \
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull())


def _bounded(counts: DataFrame, max_languages: int) -> list:
    """Rows ``lang, n_rows`` of all languages. A prototype of each goes to every task, so very many are an error."""
    found = counts.limit(max_languages + 1).collect()
    if len(found) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    return found


def _train(sample: DataFrame, dimensions: int, seed: int) -> dict[str, np.ndarray]:
    """Prototypes of the languages of a sample ``lang, text``."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in pieces(batch, "text", _PIECE, _ROWS):
                vectors = np.rint(_unit(encode(piece.column("text").to_pylist(), dimensions, seed)) * (1 << 24))
                names = np.array(piece.column("lang").to_pylist(), dtype=object)
                for name in set(names):
                    totals[name] = totals.get(name, 0) + vectors[names == name].astype(np.int64).sum(axis=0)
        if totals:
            yield pa.RecordBatch.from_pydict({"lang": list(totals), "sums": [v.tolist() for v in totals.values()]},
                                             schema=pa.schema([("lang", pa.string()), ("sums", pa.list_(pa.int64()))]))

    parts = sample.mapInArrow(sums, "lang string, sums array<bigint>")
    totals = parts.select("lang", F.posexplode("sums").alias("pos", "v")).groupBy("lang", "pos").agg(F.sum("v").alias("v"))
    rows = totals.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("pos", "v"))).alias("vs")).collect()
    vectors = {r.lang: np.array([x.v for x in r.vs], dtype=np.float64) for r in rows}
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in sorted(vectors.items()) if np.linalg.norm(v) > 0}


def identify(
    docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text", id_col: str = "doc_id",
    dimensions: int = DIMENSIONS, seed: int = SEED,
) -> DataFrame:
    """``id_col, lang_pred, score`` for every row of ``docs``, in one pass without a shuffle.

    ``score`` is the cosine with the nearest prototype, at least 0. A null text, a text without a
    letter, or no prototypes at all give ``und`` and 0. Equal cosines go to the first name. Rows
    with a null or repeated id are answered like any other; further columns are not read.
    """
    names = sorted(prototypes)
    shared = docs.sparkSession.sparkContext.broadcast(
        (names, np.stack([prototypes[n] for n in names]) if names else np.zeros((0, dimensions), np.float32)))
    kind = docs.schema[id_col].dataType.simpleString()

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, matrix = shared.value
        for batch in batches:
            for piece in pieces(batch, "text", _PIECE, _ROWS):
                vectors = encode(piece.column("text").to_pylist(), dimensions, seed)
                known = np.abs(vectors).sum(axis=1) > 0
                cosines = _unit(vectors) @ matrix.T if names else np.zeros((len(vectors), 1))
                best, score = cosines.argmax(axis=1), np.clip(cosines.max(axis=1).astype(np.float64), 0.0, 1.0)
                known = known & bool(names)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([names[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                     pa.array(np.where(known, score, 0.0))], names=[id_col, "lang_pred", "score"])

    return docs.select(F.col(id_col), F.col(text).alias("text")).mapInArrow(
        predict, f"`{id_col}` {kind}, lang_pred string, score double")


def _sampled(labelled: DataFrame, counts: list, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, chosen by a hash of their id."""
    sizes = F.broadcast(labelled.sparkSession.createDataFrame([(r.lang, r.n_rows) for r in counts], "lang string, n_rows long"))
    return labelled.join(sizes, "lang").where(hash_share("key") < share(per_language)).select("lang", "text")


def _scale(vectors: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Texts' lengths as rounded powers of two.

    The length is the number of trigrams over their mean count in the text, so that repeating a
    text does not make it longer. A sum's square is ``dimensions`` times the counts' squares.
    """
    squares = np.maximum(np.einsum("ij,ij->i", vectors, vectors, dtype=np.float64) / vectors.shape[1], 1e-9)
    return np.rint(np.log2(np.clip(sizes.astype(np.float64) ** 2 / squares, 1.0, 2.0 ** (SCALES - 1)))).astype(np.int64)


@dataclass(frozen=True)
class Model:
    """What labelled rows teach: prototypes, the least cosine to ask at each scale, and the letters' code points."""

    prototypes: dict[str, np.ndarray]
    bounds: np.ndarray
    letters: np.ndarray


def learn(
    docs: DataFrame, min_score: float, text: str = "text", lang: str = "lang", id_col: str = "doc_id",
    per_language: int = 2000, max_languages: int = 4096, spreads: float = 4.0, least: int = 30,
    dimensions: int = DIMENSIONS, seed: int = SEED,
) -> Model:
    """Learn from the labelled rows of ``docs``: prototypes, bounds and letters.

    One pass counts the rows of each language and finds the letters of all of them, another draws the
    sample of about ``per_language`` rows a language. The cosine of a short text is small by nature.
    The sample, whole and cut to 1, 2, 4, ... trigrams, tells its mean and standard deviation at each
    scale (length as a power of two); the bound is ``min_score`` or, where less, the mean without
    ``spreads`` deviations. A scale of fewer than ``least`` texts takes the bound of the next shorter
    one; without any there is no bound, -1.
    """
    labelled = _labelled(docs, text, lang, id_col)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(0x110000, dtype=bool), Counter()
        for batch in batches:
            rows.update(batch.column("lang").to_pylist())
            for piece in pieces(batch, "text", _PIECE):
                for t in piece.column("text").to_pylist():
                    for first in range(0, len(t), _SLICE):
                        found[np.frombuffer(t[first:first + _SLICE].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)] = True
        letters = np.flatnonzero(found & _letter_table()).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array([*rows, *[None] * len(letters)], pa.string()), pa.array([*[-1] * len(rows), *letters], pa.int32()),
             pa.array([*rows.values(), *[0] * len(letters)], pa.int64())], names=["lang", "letter", "n"])

    seen = stage(labelled.select("lang", "text").mapInArrow(look, "lang string, letter int, n long")
                 .groupBy("lang", "letter").agg(F.sum("n").alias("n_rows")), "labelled-letters")
    letters = np.array(sorted(r.letter for r in seen.where("letter > 0").select("letter").collect()), dtype=np.int64)  # no more than Unicode has
    found = _bounded(seen.where("letter < 0").select("lang", "n_rows"), max_languages)
    sample = stage(_sampled(labelled, found, per_language), "labelled-sample") if found else None
    prototypes = _train(sample, dimensions, seed) if found else {}
    return Model(prototypes, _length_bounds(sample, prototypes, min_score, spreads, least, seed), letters)


def _length_bounds(sample: DataFrame | None, prototypes: dict[str, np.ndarray], min_score: float, spreads: float, least: int, seed: int) -> np.ndarray:
    bounds, last = np.full(SCALES, -1.0), -1.0
    if not prototypes:
        return bounds
    shared = sample.sparkSession.sparkContext.broadcast(np.stack([*prototypes.values()]))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((3, SCALES), dtype=np.int64)

        def add(some: list[np.ndarray]) -> None:
            vectors = _encode(some, shared.value.shape[1], seed)
            scale = _scale(vectors, np.array([len(g) for g in some], np.int64))
            best = np.rint((_unit(vectors) @ shared.value.T).max(axis=1, initial=-1.0).astype(np.float64) * (1 << 20)).astype(np.int64)
            for row, value in enumerate((np.ones_like(best), best, best * best >> 20)):
                np.add.at(totals[row], scale, value)

        for batch in batches:
            for piece in pieces(batch, "text", _PIECE, _ROWS):
                texts = piece.column("text").to_pylist()
                vectors, sizes, _ = _measure(texts, shared.value.shape[1], seed)
                scale, best = _scale(vectors, sizes), (_unit(vectors) @ shared.value.T).max(axis=1, initial=-1.0)
                best = np.rint(best.astype(np.float64) * (1 << 20)).astype(np.int64)
                told = sizes > 0
                for row, value in enumerate((np.ones_like(best), best, best * best >> 20)):
                    np.add.at(totals[row], scale[told], value[told])
                some, held = [], 0
                for t in texts:
                    grams = _grams(next(_letters(t))[0])  # cuts of the first slice
                    cuts = [grams[:1 << k] for k in range((len(grams) - 1).bit_length())] if len(grams) else []
                    some, held = some + cuts, held + sum(map(len, cuts))
                    if held >= 2 * _SLICE or len(some) >= _ROWS:
                        add(some)
                        some, held = [], 0
                if some:
                    add(some)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(SCALES), pa.int64()), *map(pa.array, totals)], names=["scale", "n", "s", "q"])

    rows = sample.mapInArrow(sums, "scale long, n long, s long, q long") \
        .groupBy("scale").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).orderBy("scale").collect()
    for r in rows:
        if r.n >= least:
            mean = r.s / r.n / (1 << 20)
            last = min(min_score, mean - spreads * max(r.q / r.n / (1 << 20) - mean * mean, 0.0) ** 0.5)
        bounds[r.scale] = last
    return bounds


def keep_identified(
    docs: DataFrame, prototypes: dict[str, np.ndarray], min_score: float, text: str = "text",
    bounds: np.ndarray | None = None, letters: np.ndarray | None = None,
) -> DataFrame:
    """Rows of ``docs``, with all their columns, whose text is of some language with ``min_score`` or more.

    Rows whose text is null, has no letter, or is less like every prototype go. With ``bounds`` (of
    ``learn``) the cosine to reach is that of the text's own length, and with ``letters`` texts of
    which most letters are none of these go too, however short. Nothing is shuffled.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((np.stack([*prototypes.values()]) if prototypes else None, bounds, letters))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matrix, bounds, letters = shared.value
        known = None
        if letters is not None:
            known = np.zeros(0x110000, dtype=bool)
            known[letters] = True
        for batch in batches:
            for piece in pieces(batch, text, _PIECE, _ROWS):
                if matrix is not None:
                    vectors, sizes, balance = _measure(piece.column(text).to_pylist(), matrix.shape[1], SEED, known)
                    best = (_unit(vectors) @ matrix.T).max(axis=1)
                    enough = best >= (min_score if bounds is None else bounds[_scale(vectors, sizes)])
                    yield piece.filter(pa.array(enough & (balance >= 0) & (np.abs(vectors).sum(axis=1) > 0)))

    return docs.mapInArrow(keep, docs.schema)


def op8_language_id(docs: DataFrame) -> DataFrame:
    """Predict all documents by prototypes learnt from those whose remainder by three is not 1."""
    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))
    prototypes = train_prototypes(docs.where(remainder("doc_id", 3) != 1))
    return identify(docs, prototypes).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
