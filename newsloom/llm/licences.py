"""Licence scan: identifier tags and notice phrases by Aho-Corasick, expressions by shunting-yard."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import as_bytes, pieces, words_of

# The phrases that every scan counts.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Further notices, as words, and the labels they stand for.
NOTICE_PHRASES = {
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "bsd license": "bsd",
    "isc license": "isc",
    "creative commons attribution": "cc-by",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "public domain": "public-domain",
    "all rights reserved": "proprietary",
    "artistic license": "artistic",
    "boost software license": "bsl",
    "gnu free documentation license": "gfdl",
    "server side public license": "sspl",
    "european union public licence": "eupl",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "permission is granted to anyone to use this software for any purpose": "zlib",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
TAG = "spdx license identifier"
# Licences of each family by the start of their identifier, the longest first.
FAMILIES = (
    "agpl", "lgpl", "gpl", "apache", "mit", "mpl", "epl", "bsd", "isc", "cc-by-nc-nd", "cc-by-nc-sa", "cc-by-nc",
    "cc-by-nd", "cc-by-sa", "cc-by", "cc0", "unlicense", "artistic", "bsl", "eupl", "gfdl", "sspl", "zlib",
)
PERMISSIVE = {"apache", "mit", "bsd", "bsl", "isc", "cc-by", "cc0", "unlicense", "public-domain", "zlib"}
_BINDS = {"or": 1, "and": 2, "with": 3}
_TAGGED = re.compile(r"spdx-license-identifier\s*:\s*([^\r\n]*)")
_TOKEN = re.compile(r"[()]|[a-z0-9.+:-]+")


def family(identifier: str) -> str:
    """``gpl-2.0-only`` is ``gpl``; an identifier of no known family stands for itself."""
    return next((f for f in FAMILIES if identifier == f or identifier.startswith((f + "-", f + "+"))), identifier)


def to_postfix(expression: str) -> list[str]:
    """Shunting-yard: ``or`` binds least, then ``and``, then ``with``; all from the left.

    Reading ends at the first token that cannot follow, as a comment's end after the expression. An
    expression that is empty, or open at its end, gives an empty list.
    """
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression.lower()):
        if token == "(" and operand_next:
            stack.append(token)
        elif token == ")" and not operand_next and "(" in stack:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif token in _BINDS and not operand_next:
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[token]:
                out.append(stack.pop())
            stack.append(token)
            operand_next = True
        elif token not in _BINDS and token not in "()" and operand_next:
            out.append(token)
            operand_next = False
        else:
            break
    if operand_next or "(" in stack:
        return []
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[set[str], bool] | None:
    """Labels of all named licences, and whether the whole can be used under permissive terms.

    ``or`` needs one permissive side, ``and`` both; an exception after ``with`` changes nothing.
    """
    labels: set[str] = set()
    values: list[tuple[str, bool]] = []
    for token in to_postfix(expression):
        if token not in _BINDS:
            values.append((token, family(token) in PERMISSIVE))
            continue
        (right, b), (left, a) = values.pop(), values.pop()
        if token == "with":
            values.append((left, a))
        else:
            labels |= {family(x) for x in (left, right) if x}
            values.append(("", a or b if token == "or" else a and b))
    if not values:
        return None
    name, free = values[0]
    return labels | ({family(name)} if name else set()), free


def _automaton() -> ahocorasick.Automaton:
    """Phrases between blanks, so that a hit covers whole words only."""
    found = ahocorasick.Automaton()
    for phrase in {**BASE_PHRASES, **NOTICE_PHRASES, TAG: ""}:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(text: bytes | None, automaton: ahocorasick.Automaton) -> dict:
    words = words_of(text)
    line = b" ".join([b"", *words, b""]).decode("utf-8", "replace")
    base, labels, places, tagged, tags = [], set(), [], 0, []
    hits = list(automaton.iter(line))
    at, seen = 0, 0
    for start, phrase in sorted((end - len(phrase) - 1, phrase) for end, phrase in hits):
        at, seen = at + line.count(" ", seen, start), start
        if phrase == TAG:
            tagged += 1
            continue
        if phrase in BASE_PHRASES:
            base.append((at, BASE_PHRASES[phrase]))
        else:
            labels.add(NOTICE_PHRASES[phrase])
        places.append((at, phrase))
    if tagged:
        tags = [x.strip() for x in _TAGGED.findall(text.decode("utf-8", "replace").lower())]
    parsed = [e for e in map(evaluate, tags) if e]
    for names, _ in parsed:
        labels |= names
    base_labels = sorted({label for _, label in base})
    free = None
    if parsed or places:
        free = all(f for _, f in parsed) and all(
            (BASE_PHRASES | NOTICE_PHRASES)[p] in PERMISSIVE for _, p in places)
    return {
        "n_words": len(words), "n_base": len(base),
        "first_word": min((p for p, _ in base), default=None), "last_word": max((p for p, _ in base), default=None),
        "base_labels": ",".join(base_labels), "labels": ",".join(sorted(labels.union(base_labels))),
        "score": 1.0 - 0.5 ** len(places) * 0.1 ** len(parsed),
        "expressions": tags, "permissive": free,
    }


_FIELDS = [
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
    ("expressions", pa.list_(pa.string())), ("permissive", pa.bool_()),
]


def scan_licences(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Licence marks of every row, in one pass without a shuffle.

    ``n_base``, ``first_word`` and ``last_word`` tell of the base phrases, ``labels`` of these, the
    further notices and the tags' expressions; ``expressions`` are the tags' own texts, and
    ``permissive`` is whether all marks allow use under permissive terms (null without marks). Each
    notice halves the doubt that the text is licensed, each parsed tag leaves a tenth: ``score`` is
    1 less the doubt. Null and empty texts have no words and score 0. Rows with a null or repeated
    id are answered like any other; further columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def scan_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            for piece in pieces(batch, "text"):
                rows = [scan(t, automaton) for t in as_bytes(piece.column("text"))]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), *(pa.array([r[n] for r in rows], t) for n, t in _FIELDS)],
                    names=[id_col, *(n for n, _ in _FIELDS)])

    return docs.select(F.col(id_col), F.col(text).alias("text")).mapInArrow(
        scan_all, f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, expressions array<string>, permissive boolean")


def op9_licence_scan(docs: DataFrame) -> DataFrame:
    return scan_licences(docs).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "permissive")
