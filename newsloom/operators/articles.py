"""Article-level operators: blurps, categories, tags, title tests, one common schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from newsloom.functions.text import blank_to_null, lead_sentences
from newsloom.schemas import ARTICLE


def first_present(*choices: Column) -> Column:
    """First choice that is neither null nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in choices])


def blurp(card: Column, described: Column, text: Column, first_paragraph: Column, summary: Column,
          fallback: Column) -> Column:
    """Card blurp, else the page's own description, else the source's fallback."""
    return first_present(
        card, described,
        F.when(fallback == "lead", lead_sentences(text))
        .when(fallback == "lead_long", lead_sentences(text, longer_than=50))
        .when(fallback == "paragraph", first_paragraph)
        .when(fallback == "summary", summary),
    )


def tag_list(tags: Column, lower: bool = False, separator: str = r"\s*,\s*") -> Column:
    """Comma text as an array, blanks dropped; null stays null."""
    parts = F.filter(F.split(F.trim(tags), separator), lambda t: t != "")
    return F.transform(parts, F.lower) if lower else parts


def normalise_tags(from_text: Column, from_list: Column, category: Column | None = None) -> Column:
    """Tags from whichever form is present, lower-case, with the category appended when given."""
    tags = F.coalesce(tag_list(from_text), from_list)
    tags = F.transform(tags, F.lower)
    if category is not None:
        tags = F.array_compact(F.array_append(tags, category))
    return tags


def join_tags(tags: Column) -> Column:
    return F.array_join(tags, ", ")


def category(constant: Column, page_field: Column, url_segment: Column, first_tag: Column,
             remap: Column | None = None) -> Column:
    """The source's constant, else the page field, URL segment or first tag; then remapped."""
    found = first_present(constant, page_field, url_segment, first_tag)
    return found if remap is None else F.coalesce(F.try_element_at(remap, found), found)


def is_review(title: Column) -> Column:
    """``review`` counts in lower case only, ``best`` in any case."""
    return F.coalesce(title.contains("review") | F.lower(title).contains("best"), F.lit(False))


def filter_titles(df: DataFrame, title: str = "title") -> DataFrame:
    """Without reviews and best-of lists."""
    return df.where(~is_review(F.col(title)))


def conform(df: DataFrame, schema: StructType = ARTICLE) -> DataFrame:
    """Exactly the columns of ``schema``, in order and type; missing ones are null."""
    return df.select(*[
        (F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


def conform_union(frames: list[DataFrame], schema: StructType = ARTICLE) -> DataFrame:
    """All frames in one fixed schema, duplicates kept."""
    return reduce(DataFrame.unionByName, [conform(df, schema) for df in frames])
