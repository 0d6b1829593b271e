"""Column functions that clean, parse, default and print dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from newsloom.functions.text import blank_to_null, clean_space

# The date layouts found on the sites, each with the shape of text that fits it.
DATE_LAYOUTS = {
    "yyyy-M-d": r"^\d{4}-\d{1,2}-\d{1,2}$",
    "MMMM d, yyyy": r"^[A-Za-z]+ \d{1,2}, \d{4}$",
    "d MMM yyyy": r"^\d{1,2} [A-Za-z]{3} \d{4}$",
    "MMMM d yyyy": r"^[A-Za-z]+ \d{1,2} \d{4}$",
    "d MMMM, yyyy": r"^\d{1,2} [A-Za-z]+, \d{4}$",
}
EXPORT_LAYOUT = "dd/MM/yyyy"

# Patterns that find a date inside other text.
MONTH_DAY_YEAR = r"[A-Za-z]+ [0-9]+?, [0-9]{4}"
ISO_DAY = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"


def parse_date(text: Column, layouts: list[str] | None = None) -> Column:
    """Date from text in any of the layouts; null when none fits.

    Each parser runs only on text of its own shape, so junk never costs a parse failure per layout.
    """
    result = None
    for layout in layouts or list(DATE_LAYOUTS):
        fits = text.rlike(DATE_LAYOUTS[layout])
        parsed = F.try_to_date(text, layout)
        result = F.when(fits, parsed) if result is None else result.when(fits, parsed)
    return result


def to_date(df, name: str) -> Column:
    """A date or timestamp column passes through as a date; text is parsed."""
    if isinstance(df.schema[name].dataType, (DateType, TimestampType, TimestampNTZType)):
        return F.col(name).cast("date")
    return parse_date(F.col(name))


def clean_date_text(text: Column, mode: Column | str) -> Column:
    """Cut the date out of its surroundings.

    ``iso``: before the ``T``; ``month_day``/``iso_search``: first match of a pattern;
    ``drop``: without line breaks, tabs and commas; ``byline``: second part around a bar.
    """
    mode = F.lit(mode) if isinstance(mode, str) else mode
    parts = F.split(text, "[|]")
    cut = (
        F.when(mode == "iso", F.split_part(text, F.lit("T"), F.lit(1)))
        .when(mode == "month_day", F.regexp_extract(text, MONTH_DAY_YEAR, 0))
        .when(mode == "iso_search", F.regexp_extract(text, ISO_DAY, 0))
        .when(mode == "drop", F.translate(text, "\n\t,", ""))
        .when(mode == "byline", F.coalesce(F.get(parts, F.lit(1)), F.get(parts, F.lit(0))))
        .otherwise(text)
    )
    return blank_to_null(clean_space(cut))


def default_date(date: Column, policy: Column | str, run_date: Column) -> Column:
    """``run``: the run date; ``month``: first day of the run month; ``none``: stays null."""
    policy = F.lit(policy) if isinstance(policy, str) else policy
    return F.coalesce(
        date,
        F.when(policy == "run", run_date).when(policy == "month", F.trunc(run_date, "month")),
    )


def format_date(date: Column) -> Column:
    return F.date_format(date, EXPORT_LAYOUT)
