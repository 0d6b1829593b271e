"""JSON-lines sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from newsloom.operators.tables import to_export
from newsloom.session import broadcast_if_small, remove, stage

MAX_ROWS = 100


def _writer(df: DataFrame, max_rows: int, gzip: bool):
    writer = df.write.option("maxRecordsPerFile", max_rows).option("ignoreNullFields", "false")
    return writer.option("compression", "gzip" if gzip else "none")


def write_jsonl(df: DataFrame, path: str, max_rows: int = MAX_ROWS, gzip: bool | None = None,
                mode: str = "errorifexists") -> None:
    """One JSON object per line, at most ``max_rows`` per file, nulls written out.

    gzip is on when asked for, or when the path ends in ``.gz``. The input runs once; where it turns
    out to be empty, the folder is taken away again. Large feeds should raise ``max_rows``.
    """
    seen = Observation()
    rows = to_export(df).observe(seen, F.count(F.lit(1)).alias("n"))
    _writer(rows, max_rows, path.endswith(".gz") if gzip is None else gzip).mode(mode).json(path)
    if mode != "append" and not seen.get.get("n"):
        remove(df.sparkSession, path)


def write_feed(df: DataFrame, root: str, run_ts: str, layout: tuple[str, ...] = ("source", "run_ts"),
               max_rows: int = MAX_ROWS, gzip: bool = False, fmt: str = "json") -> None:
    """One folder per source and run under ``root``.

    ``run_ts`` is made safe for a path (``:`` becomes ``-``). ``fmt`` overrides the default JSON
    lines for this run. A run that is repeated replaces its own folders and no others. Rows are
    rebalanced by the layout columns before the write: small sources share tasks, and a source that
    holds much of the data is split over many.
    """
    stamped = to_export(df).withColumn("run_ts", F.lit(run_ts.replace(":", "-")))
    writer = _writer(stamped.hint("rebalance", *layout), max_rows, gzip).option("partitionOverwriteMode", "dynamic")
    writer.mode("overwrite").partitionBy(*layout).format(fmt).save(root)


def with_row_offset(df: DataFrame, group: str, order: list[str], chunk: int = MAX_ROWS) -> DataFrame:
    """``df`` with ``row`` (its number from 1 in its group, by ``order``) and ``offset`` (rows before its chunk).

    Rows are dealt in ranges of group and order, numbered inside each part, and the parts' counts are
    added up before them. A group that holds most rows is spread over many parts, so no task sees it
    whole, and only one row per group and part meets in a window. Rows that ``order`` leaves equal share
    a part and are numbered in any order. A null group is a group.
    """
    keys = [F.col(group), *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("part", F.spark_partition_id())
    dealt = stage(dealt, "numbered-rows")
    counts = dealt.groupBy(F.col(group).alias("of"), F.col("part").alias("of_part")).agg(F.count("*").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("of").orderBy("of_part").rowsBetween(Window.unboundedPreceding, -1))
    counts = broadcast_if_small(stage(counts.select("of", "of_part", F.coalesce(ahead, F.lit(0)).alias("ahead")), "rows-before"))
    inside = F.row_number().over(Window.partitionBy(group, "part").orderBy(*order))
    numbered = dealt.withColumn("row", inside.cast("long")).join(
        counts, F.col(group).eqNullSafe(F.col("of")) & (F.col("part") == F.col("of_part")))
    row = F.col("ahead") + F.col("row")
    return numbered.select(*df.columns, row.alias("row"), (row - 1 - (row - 1) % chunk).alias("offset"))


def write_articles(df: DataFrame, root: str, mode: str = "overwrite") -> None:
    """The article table as Parquet by source, so that reading one source prunes the others."""
    df.hint("rebalance", "source").write.mode(mode).partitionBy("source").parquet(root)
