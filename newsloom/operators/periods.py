"""Distinct articles per term over sliding periods, by bitmaps that can be merged.

Articles of one term and hour are a set of bits, in words of 64 numbers. Sets are stored once per hour
and joined to any longer period without the rows: an article that comes again in a later hour is the
same bit and counts once. A word takes a few bytes, so rare terms cost no more than their articles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

WORD_BITS = 64  # of a long; ``>> 6`` divides by it


def term_bitmaps(terms: DataFrame, time: str, article: str = "doc_id", unit: str = "hour") -> DataFrame:
    """``start, term, bucket, bits``: the articles of each term and unit of time.

    ``article`` is a whole number; bit ``b`` of word ``bucket`` is article ``64 * bucket + b``. Bits are set
    on the map side first, so a hot term or hour sends one word per task and 64 articles. Rows without a
    time, a term or an article do not count.
    """
    known = terms.where(F.col(time).isNotNull() & F.col("term").isNotNull() & F.col(article).isNotNull())
    number = F.col(article).cast("long")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(WORD_BITS - 1).cast("int"))
    words = known.select(F.date_trunc(unit, F.col(time)).alias("start"), "term", F.shiftright(number, 6).alias("bucket"), bit.alias("bit"))
    return words.groupBy("start", "term", "bucket").agg(F.bit_or("bit").alias("bits"))


def distinct_over(bitmaps: DataFrame, length: int, unit: str = "HOUR") -> DataFrame:
    """``start, term, n``: different articles in every period of ``length`` units that holds one.

    Periods slide by one unit; ``start`` is the period's first. A bit is the first of its article in the
    periods that start after the article's bit before, as far back as ``length`` reaches. So each bit
    adds one at the first of these and takes it away behind the last, and ``n`` is the sum so far: a bit
    is read once, whatever the length, and bits that repeat in one unit count once.
    """
    def later(column: str, steps: int):
        return F.col(column) + F.expr(f"INTERVAL '{steps}' {unit}")

    bit = F.explode(F.expr(f"filter(sequence(0, {WORD_BITS - 1}), b -> shiftright(bits, b) & 1L = 1L)"))
    set_bits = bitmaps.select("start", "term", "bucket", bit.alias("bit"))
    seen = Window.partitionBy("term", "bucket", "bit").orderBy("start")
    since = set_bits.withColumn("before", F.lag("start").over(seen)).select(
        "term", "start", F.greatest(later("start", 1 - length), later("before", 1)).alias("first")).where(F.col("first") <= F.col("start"))
    steps = since.select("term", F.inline(F.array(
        F.struct(F.col("first").alias("start"), F.lit(1).cast("long").alias("step")),
        F.struct(later("start", 1).alias("start"), F.lit(-1).cast("long").alias("step")))))
    turns = steps.groupBy("term", "start").agg(F.sum("step").alias("step"))
    by_term = Window.partitionBy("term").orderBy("start")
    counts = turns.select("term", "start", F.sum("step").over(by_term).alias("n"), F.lead("start").over(by_term).alias("until")).where("n > 0")
    return counts.select(F.explode(F.sequence(F.col("start"), later("until", -1), F.expr(f"INTERVAL '1' {unit}"))).alias("start"), "term", "n")
