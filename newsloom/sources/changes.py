"""Batches of change records from a keyed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from newsloom.schemas import ARTICLE, CHANGE_BATCH
from newsloom.session import stage


def sequence_order(text: Column) -> Column:
    """``struct<width, digits>`` that sorts as the number does, however long it is.

    Leading zeros do not count; a text that is not all digits fails the job, and null stays null.
    """
    digits = F.ltrim(text, F.lit("0"))
    order = F.struct(F.length(digits).alias("width"), digits.alias("digits"))
    bad = F.raise_error(F.concat(F.lit("not a sequence number: "), text)).cast("struct<width int, digits string>")
    return F.when(text.isNull(), F.lit(None)).when(F.regexp_like(text, F.lit("^[0-9]+$")), order).otherwise(bad)


def explode_changes(df: DataFrame, column: str = "value") -> DataFrame:
    """One row per change from JSON batches: ``event_name, seq, keys, image``.

    A batch that is not JSON fails the job rather than vanish. ``seq`` is the
    record's sequence number as a struct that sorts as the number does; its digits are ``seq.digits``.
    """
    batch = df.select(F.from_json(F.col(column), CHANGE_BATCH, {"mode": "FAILFAST"}).alias("batch"))
    record = batch.select(F.explode("batch.Records").alias("r"))
    return record.select(
        F.col("r.eventName").alias("event_name"),
        sequence_order(F.col("r.dynamodb.SequenceNumber")).alias("seq"),
        F.col("r.dynamodb.Keys").alias("keys"),
        F.col("r.dynamodb.NewImage").alias("image"),
    )


def sort_changes(df: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(changes, quarantine)``: what ``explode_changes`` gives of every sound record, and what is not sound.

    A batch that is bad in part loses its bad records only. The quarantine has ``value, pos, record, reason``: the
    batch, the place of the record in it, the record's own text, and why it was put aside: ``batch`` (not
    JSON, or without records; place and record are null), ``record`` (not of a change record's shape) or
    ``sequence`` (its number is missing or not one). Both come from one pass over ``df``, which is
    stored in the shared folder with a mark on unsound rows. A null batch is none.
    """
    kept = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "corrupt"}
    record_type = CHANGE_BATCH[len("Records array<struct<"):-2]
    batch = df.where(F.col(column).isNotNull()).select(
        F.col(column).alias("value"), F.from_json(F.col(column), "Records array<string>, corrupt string", kept).alias("batch"))
    # a batch without sound records is one row without a record
    sound = F.col("batch.corrupt").isNull() & F.col("batch.Records").isNotNull()
    rows = batch.select("value", sound.alias("sound"), F.posexplode_outer(F.when(sound, F.col("batch.Records"))).alias("pos", "record"))
    rows = rows.where(~F.col("sound") | F.col("pos").isNotNull()).withColumn("r", F.from_json("record", f"struct<{record_type}, corrupt: string>", kept))
    number = F.col("r.dynamodb.SequenceNumber")
    reason = (F.when(~F.col("sound"), "batch").when(F.col("record").isNull() | F.col("r.corrupt").isNotNull() | F.col("r.dynamodb").isNull(), "record")
              .when(number.isNull() | ~F.regexp_like(number, F.lit("^[0-9]+$")), "sequence"))
    rows = rows.withColumn("reason", reason)
    bad = F.col("reason").isNotNull()
    told = rows.select(
        "reason", F.when(bad, F.col("value")).alias("value"), F.when(bad, F.col("pos")).alias("pos"), F.when(bad, F.col("record")).alias("record"),
        F.col("r.eventName").alias("event_name"), sequence_order(F.when(~bad, number)).alias("seq"),
        F.col("r.dynamodb.Keys").alias("keys"), F.col("r.dynamodb.NewImage").alias("image"), bad.alias("unsound"))
    # a mark and not a folder for each kind: rows written by folder are sorted first, a whole task's with their maps
    stored = stage(told, "sorted-changes")
    return (stored.where("NOT unsound").select("event_name", "seq", "keys", "image"),
            stored.where("unsound").select("value", "pos", "record", "reason"))


def read_changes(spark: SparkSession, path: str, streaming: bool = False,
                 one_batch_per_file: bool = False) -> DataFrame:
    """Change rows from JSON files that hold one batch per line, or one per file."""
    reader = spark.readStream if streaming else spark.read
    return explode_changes(reader.text(path, wholetext=one_batch_per_file))


def attribute_value(av: Column) -> Column:
    """Text of a typed value: a string, or a list joined with commas; null stays null."""
    items = F.transform(av["L"], lambda x: x["S"])
    return F.coalesce(av["S"], F.array_join(items, ", "))


def attribute_list(av: Column) -> Column:
    """List of a typed value; a lone string becomes a list of one."""
    return F.coalesce(
        F.array_compact(F.transform(av["L"], lambda x: x["S"])),
        F.when(av["S"].isNotNull(), F.array(av["S"])),
    )


def decode_attributes(df: DataFrame, column: str = "image", schema: StructType = ARTICLE) -> DataFrame:
    """Replace a map of typed values by one plain column per field of ``schema``.

    A missing field is null. ``tag`` is read where ``tags`` is absent.
    """
    fields = []
    for field in schema:
        av = F.try_element_at(F.col(column), F.lit(field.name))
        if field.name == "tags":
            av = F.coalesce(av, F.try_element_at(F.col(column), F.lit("tag")))
        is_list = isinstance(field.dataType, ArrayType)
        value = attribute_list(av) if is_list else attribute_value(av)
        if not is_list and field.dataType.typeName() == "date":
            value = F.coalesce(F.try_to_date(value, "dd/MM/yyyy"), F.try_to_date(value, "yyyy-MM-dd"))
        elif not is_list:
            value = value.try_cast(field.dataType)
        fields.append(value.alias(field.name))
    return df.select(*[c for c in df.columns if c != column], *fields)
