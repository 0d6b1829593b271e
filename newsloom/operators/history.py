"""Links of earlier runs: a stored history with an exact table and a filter that spares most links the join.

The filter has a bit per hash place, in bitmaps of 32768 places. A link whose bit is not set was never
seen; only links whose bit is set meet the exact table. A run adds a folder of links and one of
bitmaps, and replaces its own when it is repeated; bitmaps of all runs are merged when they are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.session import broadcast_if_small

PLACES = 1 << 26  # about sixteen times the links a history holds leaves one new link in sixteen to the exact join
PARTS = 64


def _place(url: Column, places: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(places))


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of the history, empty before the first run."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def seen_links(spark: SparkSession, root: str) -> DataFrame:
    return _stored(spark, f"{root}/links", "url string, run string, part int")


def add_seen(links: DataFrame, root: str, run: str, places: int = PLACES, parts: int = PARTS) -> None:
    """Add the ``url`` of ``links`` to the history under ``root``, as run ``run``.

    Nulls are left out. ``run`` names a folder, so it has letters, digits and ``-`` only. ``places`` and ``parts`` belong to a history and must stay as they are. The
    bitmaps come last and from the stored links: a run that fails in between is repeated.
    """
    spark = links.sparkSession
    part = F.pmod(F.xxhash64("url"), F.lit(parts)).cast("int").alias("part")
    found = links.where("url IS NOT NULL").select("url").distinct().select("url", part)
    found.hint("rebalance", "part").write.mode("overwrite").partitionBy("part").parquet(f"{root}/links/run={run}")
    place = seen_links(spark, root).where(F.col("run") == run).select(_place(F.col("url"), places).alias("place"))
    place.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).write.mode("overwrite").parquet(f"{root}/filter/run={run}")


def with_maybe_seen(links: DataFrame, root: str, places: int = PLACES) -> DataFrame:
    """``links`` with ``maybe_seen``: false for a ``url`` that no run has seen, for certain."""
    bits = _stored(links.sparkSession, f"{root}/filter", "bucket long, bits binary, run string").groupBy(
        "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    place = _place(F.col("url"), places)
    marked = links.withColumn("bucket", F.bitmap_bucket_number(place)).join(broadcast_if_small(bits), "bucket", "left")
    at = F.bitmap_bit_position(place)
    octet = F.conv(F.hex(F.substring("bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.floor(octet / F.pow(F.lit(2), at % 8)) % 2 == 1
    return marked.withColumn("maybe_seen", F.coalesce(is_set, F.lit(False))).drop("bucket", "bits")


def unseen(links: DataFrame, root: str, places: int = PLACES, parts: int = PARTS) -> DataFrame:
    """The different ``url`` of ``links`` that no run has seen; nulls are left out."""
    marked = with_maybe_seen(links.where("url IS NOT NULL").select("url").distinct(), root, places)
    doubtful = marked.where("maybe_seen").withColumn("part", F.pmod(F.xxhash64("url"), F.lit(parts)).cast("int"))
    new = doubtful.join(seen_links(links.sparkSession, root).select("url", "part"), ["part", "url"], "left_anti")
    return marked.where("NOT maybe_seen").select("url").unionByName(new.select("url"))
