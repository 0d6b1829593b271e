"""The keyed article table and its change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, StringType, TimestampNTZType, TimestampType

from newsloom.functions.dates import format_date
from newsloom.operators.articles import join_tags
from newsloom.operators.links import first_per_key
from newsloom.schemas import SEARCH_FIELDS


def upsert_latest(df: DataFrame, key: str = "title", order: str | list[str] = "seq") -> DataFrame:
    """One row per key: the last write replaces the whole row. A row without a key is no item."""
    order = [order] if isinstance(order, str) else order
    return first_per_key(df.where(F.col(key).isNotNull()), key, [F.desc(c) for c in order])


def apply_changes(changes: DataFrame, key: str = "title", seq: str | list[str] = "seq",
                  op: str = "event_name", keep_removed: bool = False) -> DataFrame:
    """Current state of a keyed table: the latest change per key, unless that is a REMOVE.

    ``keep_removed`` keeps the tombstones, which a log needs so that a late, older upsert
    cannot bring a removed key back.
    """
    latest = upsert_latest(changes, key, seq)
    return latest if keep_removed else latest.where(F.coalesce(F.col(op), F.lit("")) != "REMOVE")


def to_export(df: DataFrame) -> DataFrame:
    """Articles as they leave the engine: dates as ``dd/MM/yyyy`` text and lists as comma-joined text."""
    def export(field):
        if isinstance(field.dataType, DateType):
            return format_date(F.col(field.name)).alias(field.name)
        if isinstance(field.dataType, ArrayType) and isinstance(field.dataType.elementType, StringType):
            return join_tags(F.col(field.name)).alias(field.name)
        return F.col(field.name)

    return df.select(*[export(f) for f in df.schema])


def to_search_doc(df: DataFrame, with_source: bool = False) -> DataFrame:
    """The fields the search index holds, all of them text. ``tag`` is taken as ``tags``."""
    df = to_export(df)
    if "tags" not in df.columns and "tag" in df.columns:
        df = df.withColumnRenamed("tag", "tags")
    elif "tag" in df.columns:
        df = df.withColumn("tags", F.coalesce("tags", "tag"))
    return df.select(*SEARCH_FIELDS, *(["source"] if with_source else []))


def change_counts(changes: DataFrame, op: str = "event_name") -> DataFrame:
    """Records per operation; counted on the map side first."""
    return changes.groupBy(op).agg(F.count("*").alias("n"))


def observe_changes(changes: DataFrame, op: str = "event_name", name: str = "changes") -> tuple[DataFrame, Observation]:
    """Count processed, removed and upserted records while the frame runs anyway."""
    seen = Observation(name)
    removed = F.coalesce(F.col(op) == "REMOVE", F.lit(False))
    return changes.observe(
        seen, F.count(F.lit(1)).alias("processed"),
        F.count_if(removed).alias("removed"), F.count_if(~removed).alias("upserted"),
    ), seen


def encode_temporal(df: DataFrame) -> DataFrame:
    """Timestamps as ``yyyy-MM-dd HH:mm:ss`` text and dates as ``yyyy-MM-dd`` text."""
    def encode(field):
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            return F.date_format(field.name, "yyyy-MM-dd HH:mm:ss").alias(field.name)
        if isinstance(field.dataType, DateType):
            return F.date_format(field.name, "yyyy-MM-dd").alias(field.name)
        return F.col(field.name)

    return df.select(*[encode(f) for f in df.schema])
