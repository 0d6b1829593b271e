"""Fill-in-the-middle by counted quantifiers.

A text is a run of units, such as lines. ``regexp_count`` tells their number ``n``, a hash of the id
two cuts ``a <= b`` between 0 and ``n``, and a pattern made for the row,

    (?s)\\A((?:unit){a}+)((?:unit){b-a}+)(.*+)

captures prefix, middle and suffix in one match, whose replacement puts them behind their marks.
Possessive counts never give a unit back, so the match is one pass over the text however many
units it counts. All of it stays in the JVM and nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINE = r"[^\n]*\n|[^\n]+"
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"


def _draw(seed: str, id_col: str, k: int) -> Column:
    """The ``k``-th group of eight digits of the seeded hash of the id, unsigned."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")


def _literal(mark: str) -> str:
    """A mark as it stands in a replacement."""
    return mark.replace("\\", "\\\\").replace("$", "\\$")


def fill_in_middle(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", unit: str = LINE, seed: str = "7",
    percent: int = 100, spm_percent: int = 50, marks: Sequence[str] = MARKS,
) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    ``unit`` is a pattern whose matches, left to right, cover a text without a gap, and which does
    not capture. Of the texts, ``percent`` in a hundred are turned round, ``spm_percent`` of these
    with the suffix first; the hash of ``seed:id`` decides, so a row's outcome depends on its id and
    text alone. A text that is null, empty or holds a mark, and any other not to be turned round, is
    plain: the output is the text ('' for null) and the lengths are null. Any of the three parts may
    be empty. A null id is hashed as '', rows that repeat an id are each turned by the same draws,
    and an empty table gives none. Further columns are not read.
    """
    held = docs.select(F.col(id_col).alias("fim_id"), F.coalesce(F.col(text), F.lit("")).alias("fim_text"),
                       *[_draw(seed, id_col, k).alias(f"fim_h{k}") for k in range(4)])
    held = held.withColumn("fim_n", F.regexp_count("fim_text", F.lit(unit)).cast("long"))
    cuts = [F.col(f"fim_h{k}") % (F.col("fim_n") + 1) for k in range(2)]
    marked = F.col("fim_text").rlike("|".join(map(re.escape, marks)))
    plain = (F.col("fim_text") == "") | marked | (F.col("fim_h2") % 100 >= percent)
    form = F.when(plain, PLAIN).when(F.col("fim_h3") % 100 < spm_percent, SPM).otherwise(PSM)
    held = held.select("fim_id", "fim_text", "fim_n", form.alias("fim_form"), F.least(*cuts).alias("fim_a"), F.greatest(*cuts).alias("fim_b"))
    pattern = F.format_string(
        "(?s)\\A((?:" + unit.replace("%", "%%") + "){%d}+)((?:" + unit.replace("%", "%%") + "){%d}+)(.*+)",
        F.col("fim_a"), F.col("fim_b") - F.col("fim_a"))
    p, s, m = map(_literal, marks)
    order = F.when(F.col("fim_form") == PSM, f"{p}$1{s}$3{m}$2").otherwise(f"{s}$3{p}$1{m}$2")
    held = held.withColumn("fim_output", F.when(F.col("fim_form") == PLAIN, F.col("fim_text")).otherwise(
        F.regexp_replace("fim_text", pattern, order)))
    # where the marks stand tells the lengths; the text has none of its own
    at = {k: F.instr("fim_output", mark) for k, mark in zip("psm", marks)}
    prefix = F.when(F.col("fim_form") == PSM, at["s"]).when(F.col("fim_form") == SPM, at["m"]) - at["p"] - len(marks[0])
    middle = F.when(F.col("fim_form") != PLAIN, F.length("fim_output") - at["m"] + 1 - len(marks[2]))
    return held.select(
        F.col("fim_id").alias(id_col), F.col("fim_n").alias("n"), F.col("fim_form").alias("form"),
        prefix.cast("long").alias("prefix_chars"), middle.cast("long").alias("middle_chars"), F.col("fim_output").alias("output"))


def restored(output: Column | str, form: Column | str, marks: Sequence[str] = MARKS) -> Column:
    """The text that an output of a form was made of."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    p, s, m = map(re.escape, marks)
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*+)", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*+)", "$2$3$1")
    return F.when(form == PSM, psm).when(form == SPM, spm).otherwise(output)


def op13_fill_middle(docs: DataFrame) -> DataFrame:
    """Cuts, form and lengths of every document, with digests of its output and of the text rebuilt from that."""
    turned = fill_in_middle(docs)
    return turned.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), h AS (
  SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS h FROM d
), c AS (
  SELECT doc_id, t, u, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
         WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT doc_id, t, n, form, coalesce(array_to_string(u[1:a], ''), '') AS prefix, coalesce(array_to_string(u[a + 1:b], ''), '') AS middle,
    coalesce(array_to_string(u[b + 1:], ''), '') AS suffix FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
