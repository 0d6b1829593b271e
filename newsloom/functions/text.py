"""Column functions on plain text: whitespace, brackets, sentences, terms."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in Unicode text.
WHITE_SPACE = (
    "\t\n\x0b\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Common function words of English, French, German and Spanish.
STOPWORDS = (
    "a an and are as at be but by for from had has have he her his in is it its not of on or "
    "she that the their they this to was were which who will with you "
    "au aux ce de des du elle en est et il la le les ne pas pour que qui sur un une "
    "das dem den der die ein eine er es ist nicht sich sie und von zu "
    "como con del el ella los las no para por se su una y"
).split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use the result any number of times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def clean_space(text: Column, left_only: bool = False) -> Column:
    """Trim all white space, not only blanks. A character-set trim is linear in the run length."""
    trim = F.ltrim if left_only else F.trim
    return trim(text, F.lit(WHITE_SPACE))


def strip_brackets(text: Column) -> Column:
    """Cut from the first ``[`` to the last ``]`` of each line (greedy on purpose)."""
    return F.regexp_replace(text, r"\[.*\]", "")


def lead_sentences(text: Column, n: int = 4, longer_than: int | None = None) -> Column:
    """First ``n`` pieces between full stops, joined with nothing, so the stops are lost."""
    lead = F.array_join(F.slice(F.split(text, "[.]"), 1, n), "")
    return lead if longer_than is None else F.when(F.length(text) > longer_than, lead)


def sentences(text: Column) -> Column:
    """Sentences with their closing marks, trimmed; pieces without a letter or digit dropped."""
    pieces = F.transform(F.regexp_extract_all(text, F.lit("[^.!?]+[.!?]*"), F.lit(0)), lambda s: clean_space(s))
    return F.filter(pieces, lambda s: s.rlike(r"[\p{L}\p{N}]"))


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def run_starts(ordered: Column, key: Callable[[Column], Column] = lambda x: x) -> Column:
    """0-based positions where a new run of equal keys begins in a sorted array."""
    return F.array_compact(F.transform(
        ordered, lambda x, i: F.when(~key(x).eqNullSafe(key(F.get(ordered, i - 1))), i)))


def run_lengths(ordered: Column, starts: Column) -> Column:
    return F.transform(
        starts, lambda start, j: F.coalesce(F.get(starts, j + 1), F.size(ordered)) - start)


def term_counts(terms: Column) -> Column:
    """``array<struct<term, n>>`` of one row's terms: sort, then measure the runs.

    The whole histogram stays inside the row, so counting terms per article needs no shuffle.
    """
    def measure(ordered: Column) -> Column:
        return let(run_starts(ordered), lambda starts: F.transform(starts, lambda start, j: F.struct(
            F.get(ordered, start).alias("term"),
            (F.coalesce(F.get(starts, j + 1), F.size(ordered)) - start).alias("n"))))
    return let(F.sort_array(terms), measure)
