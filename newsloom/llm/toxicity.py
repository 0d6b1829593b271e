"""Toxic spans by a linear-chain conditional random field.

Only documents are labelled, so token labels come first: a word or stem is toxic if its different
contexts (the words before and after it) lie in toxic documents far more often than chance, and its
tokens in toxic documents are labelled so. The field then learns to tag tokens from these by word,
its ends and its neighbours. Forward-backward gives each token's probability; runs of likely tokens
are spans, and a logistic of the sum and the largest of the probabilities and of the length is the
document's score.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.text import let
from newsloom.llm.common import as_bytes, hash_share, pieces, remainder, share, word_array, words_of

BITS = 18
STEMS = (5, 7)
BLOCK = 64  # tokens per block of the forward-backward pass
_MASK = (1 << BITS) - 1
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before A-Z are lowered


def features(word: bytes) -> tuple[int, ...]:
    """Hashed: the word, its first 4, 6 and 8 bytes, its last 3, and the word as left and right neighbour."""
    return tuple(zlib.crc32(kind + part) & _MASK for kind, part in (
        (b"w", word), (b"4", word[:4]), (b"6", word[:6]), (b"8", word[:8]), (b"s", word[-3:]), (b"l", word), (b"r", word)))


@dataclass
class Field:
    """Weights of features for a toxic tag, log-potentials of the first tag and of tag pairs.

    ``document`` are the coefficients that turn a document's marginals into its score.
    """

    weights: np.ndarray
    first: np.ndarray
    pairs: np.ndarray
    document: np.ndarray | None = None


def summary(p: np.ndarray) -> tuple[float, float, float, float]:
    """What a document's score is made of: constant, sum of the likely marginals, largest, length."""
    return 1.0, float(np.log1p(p[p >= 0.2].sum())), float(p.max()) if len(p) else 0.0, float(np.log1p(len(p))) / 10


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, decay: float = 1e-3) -> np.ndarray:
    """Newton's method with a small ridge; ``weight`` restores the labels' true shares."""
    c = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -30, 30)))
        slope = x.T @ (weight * (y - p)) - decay * c
        c = c + np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + decay * np.eye(len(c)), slope)
    return c


def marginals(scores: np.ndarray, lengths: np.ndarray, first: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Probability of a toxic tag for every token of several sequences laid end to end.

    Exact forward-backward, by blocks: the product of each block's step matrices is formed for all
    blocks at once, messages then pass from block to block, and the blocks are filled in again at
    once. So a long text costs a few steps per block, not per token.
    """
    blocks = -(-lengths // BLOCK)
    rows = int(blocks.sum())
    if rows == 0:
        return np.zeros(0)
    starts = np.cumsum(blocks) - blocks
    inside = np.arange(len(scores)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.repeat(starts * BLOCK, lengths) + inside
    weight = np.ones(rows * BLOCK)
    weight[at] = np.exp(np.clip(scores, -30, 30))
    stay = np.ones(rows * BLOCK, bool)  # no step before a first token and in the padding
    stay[at[inside > 0]] = False
    weight, stay = weight.reshape(rows, BLOCK), stay.reshape(rows, BLOCK)
    step, begin = np.exp(pairs), np.exp(first)

    def forward(state: np.ndarray, t: int) -> np.ndarray:
        state = np.where(stay[:, t].reshape(-1, *[1] * (state.ndim - 1)), state, state @ step)
        state[..., 1] *= weight[:, t].reshape(-1, *[1] * (state.ndim - 2))
        return state / state.max(axis=tuple(range(1, state.ndim)), keepdims=True)

    product = np.broadcast_to(np.eye(2), (rows, 2, 2)).copy()
    for t in range(BLOCK):
        product = forward(product, t)
    enter, leave = np.tile(begin, (rows, 1)), np.ones((rows, 2))
    for k in range(1, int(blocks.max())):
        here = starts[blocks > k] + k
        passed = np.einsum("ri,rij->rj", enter[here - 1], product[here - 1])
        enter[here] = passed / passed.max(axis=1, keepdims=True)
        here = (starts + blocks)[blocks > k] - 1 - k
        passed = np.einsum("rij,rj->ri", product[here + 1], leave[here + 1])
        leave[here] = passed / passed.max(axis=1, keepdims=True)
    ahead = np.empty((rows, BLOCK, 2))
    for t in range(BLOCK):
        ahead[:, t] = enter = forward(enter, t)
    toxic = np.empty((rows, BLOCK))
    for t in range(BLOCK - 1, -1, -1):
        both = ahead[:, t] * leave
        toxic[:, t] = both[:, 1] / both.sum(axis=1)
        leave = leave * np.stack([np.ones(rows), weight[:, t]], axis=1)
        leave = np.where(stay[:, t, None], leave, leave @ step.T)
        leave = leave / leave.max(axis=1, keepdims=True)
    return toxic.reshape(-1)[at]


def pair_marginals(scores: np.ndarray, first: np.ndarray, pairs: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tag and tag-pair probabilities of equally long, padded sequences, for training."""
    n, length = scores.shape
    weight = np.stack([np.ones_like(scores), np.exp(np.clip(scores, -30, 30))], axis=2)
    step = np.exp(pairs)
    ahead, back = np.empty((n, length, 2)), np.ones((n, length, 2))
    for t in range(length):
        x = (np.exp(first) if t == 0 else ahead[:, t - 1] @ step) * weight[:, t]
        x = np.where(mask[:, t, None], x, ahead[:, t - 1] if t else x)
        ahead[:, t] = x / x.sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        x = (back[:, t + 1] * weight[:, t + 1]) @ step.T
        back[:, t] = np.where(mask[:, t + 1, None], x / x.sum(axis=1, keepdims=True), 1.0)
    tag = ahead * back
    tag /= tag.sum(axis=2, keepdims=True)
    both = ahead[:, :-1, :, None] * step[None, None] * (weight * back)[:, 1:, None, :]
    both /= both.sum(axis=(2, 3), keepdims=True)
    return tag, both * mask[:, 1:, None, None]


def fit_field(marks: np.ndarray, tags: np.ndarray, mask: np.ndarray, rounds: int = 60, rate: float = 0.5, decay: float = 1e-5) -> Field:
    """Full-batch AdaGrad on the conditional likelihood. ``marks`` are the features of each token."""
    params = [np.zeros(1 << BITS), np.zeros(2), np.zeros((2, 2))]
    seen = [np.full_like(p, 1e-6) for p in params]
    gold = np.stack([1 - tags, tags], axis=2) * mask[:, :, None]
    gold_pairs = np.einsum("nta,ntb->ab", gold[:, :-1], gold[:, 1:])
    n = mask.sum()
    for _ in range(rounds):
        weights, first, pairs = params
        tag, both = pair_marginals(weights[marks].sum(axis=2), first, pairs, mask)
        off = (tags - tag[:, :, 1]) * mask
        slopes = [np.bincount(marks.ravel(), np.repeat(off.ravel(), marks.shape[2]), 1 << BITS) / n - decay * weights,
                  (gold[:, 0] - tag[:, 0] * mask[:, :1]).sum(axis=0) / n, (gold_pairs - both.sum(axis=(0, 1))) / n]
        for p, s, g in zip(params, seen, slopes):
            s += g * g
            p += rate * g / np.sqrt(s)
    return Field(params[0].astype(np.float32), params[1], params[2])


def toxic_words(sample: DataFrame, evidence: float, purity: float, max_words: int) -> list[str]:
    """Words (after ``=``) and stems of five or seven letters of toxic contexts, the surest first.

    ``sample`` has ``words`` and ``toxic``. ``evidence`` is the least log-likelihood ratio. Contexts
    are counted once however often copies repeat them.
    """
    def contexts(w: Column) -> Column:
        return F.transform(w, lambda x, i: F.struct(x.alias("x"), F.xxhash64(
            F.get(w, i - 1), F.get(w, i + 1)).alias("context")))

    seen = sample.select("toxic", F.explode(let(F.col("words"), contexts)).alias("c")).select("toxic", "c.*")
    stems = [F.when(F.length("x") >= n, F.substring("x", 1, n)) for n in STEMS]
    seen = seen.select("toxic", "context", F.explode(F.array(F.concat(F.lit("="), "x"), *stems)).alias("word"))
    seen = seen.where("word IS NOT NULL").distinct()
    counts = seen.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    total = counts.agg(F.sum("a").alias("a"), F.sum("b").alias("b")).first()
    if not total.a:
        return []
    base = total.a / (total.a + (total.b or 0))
    n = F.col("a") + F.col("b")
    gain = F.col("a") * F.log(F.col("a") / n / base)
    if base < 1:
        gain = gain + F.when(F.col("b") > 0, F.col("b") * F.log(F.col("b") / n / (1 - base))).otherwise(0)
    sure = counts.where((F.col("a") >= purity * n) & (gain >= evidence)) if base < 1 else counts.limit(0)
    return [r.word for r in sure.orderBy(F.desc(gain), "word").limit(max_words).collect()]


def train_field(
    docs: DataFrame, labels: DataFrame, text: str = "text", id_col: str = "doc_id", toxic: str = "toxic",
    per_label: int = 3000, evidence: float = 12.0, purity: float = 0.8, max_words: int = 2000,
) -> Field | None:
    """Learn the field from documents that ``labels`` marks as toxic (1) or not (0).

    ``per_label`` bounds the sample: about so many documents of each label, chosen by a hash of
    their id, and of each up to two windows of 64 words with a suspect word and one other. A null
    label or id teaches nothing; an id labelled twice is toxic if either says so. Without toxic
    documents, or without words that tell them apart, there is no field.
    """
    marked = labels.select(F.col(id_col).alias("id"), F.col(toxic).cast("int").alias("toxic")).where(
        "id IS NOT NULL AND toxic IN (0, 1)").groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {r.toxic: r.n_rows for r in marked.groupBy("toxic").agg(F.count("*").alias("n_rows")).collect()}
    if not counts.get(1):
        return None
    sizes = F.when(F.col("toxic") == 1, F.lit(counts[1])).otherwise(F.lit(counts.get(0, 1)))
    drawn = marked.withColumn("n_rows", sizes).where(hash_share("id") < share(per_label)).limit(4 * per_label)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(
        F.broadcast(drawn.select("id", "toxic")), "id").dropDuplicates(["text", "toxic"])
    known = toxic_words(sample.select("toxic", word_array(F.col("text")).alias("words")), evidence, purity, max_words)
    if not known:
        return None

    def suspect(word: bytes, units: set[str]) -> bool:
        word = word.decode("utf-8", "replace")
        return "=" + word in units or any(len(word) >= n and word[:n] in units for n in STEMS)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = set(known)
        for batch in batches:
            rows = []
            for doc_id, t, label in zip(batch.column("id").to_pylist(), as_bytes(batch.column("text")), batch.column("toxic").to_pylist()):
                words = words_of(t)
                found = np.array([suspect(w, units) for w in words], dtype=np.uint8)
                tops = range(0, len(words), BLOCK)
                hit = [i for i in tops if found[i:i + BLOCK].any()]
                other = [i for i in tops if not found[i:i + BLOCK].any()]
                pick = zlib.crc32(str(doc_id).encode())
                for i in hit[:2] + ([other[pick % len(other)]] if other else []):
                    around = [features(w) for w in (words[i - 1:i] or [b""]) + words[i:i + BLOCK] + (words[i + BLOCK:i + BLOCK + 1] or [b""])]
                    marks = [(*a[:5], l[5], r[6]) for l, a, r in zip(around, around[1:], around[2:])]
                    rows.append((np.array(marks, dtype=np.int32).tobytes(), (found[i:i + BLOCK] * label).astype(np.uint8).tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.binary()) for k in (0, 1)], names=["marks", "tags"])

    rows = sample.mapInArrow(windows, "marks binary, tags binary").limit(12 * per_label).collect()
    rows.sort(key=lambda r: bytes(r.marks))
    n = len(rows)
    marks, tags, mask = np.zeros((n, BLOCK, 7), np.int32), np.zeros((n, BLOCK)), np.zeros((n, BLOCK), bool)
    for i, r in enumerate(rows):
        m = len(r.tags)
        marks[i, :m] = np.frombuffer(r.marks, np.int32).reshape(m, 7)
        tags[i, :m], mask[i, :m] = np.frombuffer(r.tags, np.uint8), True
    field = fit_field(marks, tags, mask)
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                found = [summary(p) for p in scorer.marginals(as_bytes(piece.column("text")))]
                yield pa.RecordBatch.from_arrays([piece.column("toxic"), pa.array(found, pa.list_(pa.float64()))], names=["toxic", "x"])

    rows = sample.select("toxic", "text").mapInArrow(summaries, "toxic int, x array<double>").collect()
    rows.sort(key=lambda r: (r.toxic, r.x))
    y = np.array([r.toxic for r in rows], dtype=float)
    weight = np.where(y == 1, counts[1] / max(1, y.sum()), counts.get(0, 0) / max(1, (1 - y).sum()))
    field.document = fit_logistic(np.array([r.x for r in rows]), y, weight * len(y) / weight.sum())
    return field


class Scorer:
    """The field with the parts of its scores that belong to a word alone, held for the last words met."""

    def __init__(self, field: Field, bound: int = 400_000):
        self.field, self.bound, self.place = field, bound, {}
        self.parts = np.zeros((1024, 3), np.float32)

    def learn(self, words: list[bytes]) -> None:
        new = set(words).difference(self.place)
        if len(self.place) + len(new) > self.bound:
            self.place.clear()
            new = set(words)
        first, new = len(self.place), list(new)
        if first + len(new) > len(self.parts):
            grown = np.zeros((2 * (first + len(new)), 3), np.float32)
            grown[:first] = self.parts[:first]
            self.parts = grown
        found = self.field.weights[np.array([features(w) for w in new], dtype=np.int64)]
        self.parts[first:first + len(new)] = np.stack([found[:, :5].sum(axis=1), found[:, 5], found[:, 6]], axis=1)
        self.place.update(zip(new, range(first, first + len(new))))

    def scores(self, words: list[bytes]) -> np.ndarray:
        try:
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        except KeyError:
            self.learn(words)
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        parts = self.parts[at]
        out = parts[:, 0].astype(np.float64)
        out[1:] += parts[:-1, 1]
        out[:-1] += parts[1:, 2]
        edge_left, edge_right = (self.field.weights[features(b"")[k]] for k in (5, 6))
        if len(out):
            out[0] += edge_left
            out[-1] += edge_right
        return out

    def marginals(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Each text's probabilities by word."""
        words = [words_of(t) for t in texts]
        lengths = np.array([len(w) for w in words], dtype=np.int64)
        each = marginals(np.concatenate([self.scores(w) for w in words] or [np.zeros(0)]), lengths, self.field.first, self.field.pairs)
        return np.split(each, np.cumsum(lengths)[:-1]) if len(words) else []

    def documents(self, texts: list[bytes | None]) -> list[tuple[float, list[tuple[int, int, float]]]]:
        """Score and spans (first word, word after the last, probability) of each text."""
        out = []
        for p in self.marginals(texts):
            edges = np.flatnonzero(np.diff(np.concatenate(([0], (p >= 0.5).astype(np.int8), [0]))))
            spans = [(int(a), int(b), float(p[a:b].max())) for a, b in zip(edges[::2], edges[1::2])]
            out.append((float(1 / (1 + np.exp(-np.clip(np.dot(summary(p), self.field.document), -30, 30)))), spans))
        return out


def offsets(text: str, spans: list[tuple[int, int, float]]) -> list[dict]:
    """Character offsets of spans of words."""
    places = [m.span() for m in _WORD.finditer(text)]
    return [{"start": places[a][0], "end": places[b - 1][1], "p": p} for a, b, p in spans]


def score_toxicity(docs: DataFrame, field: Field | None, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id_col, score, spans`` for every row, in one pass without a shuffle.

    ``spans`` are the offending places: character offsets and the probability of the surest word.
    Null and empty texts have the score of a text without a suspect word; where there is no field,
    all texts score 0 without spans. Rows with a
    null or repeated id are answered like any other; further columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = docs.schema[id_col].dataType.simpleString()
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value) if shared.value else None
        for batch in batches:
            for piece in pieces(batch, "text", 2 << 20):
                texts = as_bytes(piece.column("text"))
                found = scorer.documents(texts) if scorer else [(0.0, [])] * len(texts)
                spans = [offsets(t.decode("utf-8", "replace"), s) if s else [] for t, (_, s) in zip(texts, found)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array([s for s, _ in found], pa.float64()), pa.array(spans, span_type)],
                    names=[id_col, "score", "spans"])

    return docs.select(F.col(id_col), F.col(text).alias("text")).mapInArrow(
        score, f"`{id_col}` {kind}, score double, spans array<struct<start:int,end:int,p:double>>")


def op6_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores and spans of all documents, by a field learnt from labels whose remainder by five is not 0."""
    field = train_field(docs, labels.where(remainder("doc_id", 5) != 0))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return score_toxicity(docs, field).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
