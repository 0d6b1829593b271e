"""Raw pages, and the source each one belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.urls import host
from newsloom.schemas import PAGE
from newsloom.session import broadcast_if_small


def read_pages(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Pages from Parquet, as a table or as a stream of new files."""
    if not streaming:
        return spark.read.schema(PAGE).parquet(path)
    reader = spark.readStream.schema(PAGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def with_source(df: DataFrame, sources: DataFrame, url: str = "url", rules: bool = True) -> DataFrame:
    """Add ``source`` (and the struct ``rule`` of its rules) by the most specific registered host.

    Rows of unknown hosts keep a null source. The host table is broadcast once its size is
    checked, so tagging moves no page.
    """
    value = F.struct(*[c for c in sources.columns]) if rules else F.struct("source")
    hosts = broadcast_if_small(
        sources.select(F.explode("hosts").alias("_host"), value.alias("_rule"))
        .groupBy("_host").agg(F.min_by("_rule", F.col("_rule.source")).alias("_rule")))
    # The exact host, then its last three and last two labels.
    found = df.withColumn("_part0", host(F.col(url)))
    for level, labels in enumerate((None, -3, -2)):
        side = hosts.select(F.col("_host").alias(f"_host{level}"), F.col("_rule").alias(f"_rule{level}"))
        if labels:
            found = found.withColumn(f"_part{level}", F.substring_index("_part0", ".", labels))
        found = found.join(side, F.col(f"_part{level}") == F.col(f"_host{level}"), "left")
    rule = F.coalesce(*[F.col(f"_rule{level}") for level in range(3)])
    found = found.withColumn("source", rule["source"])
    if rules:
        found = found.withColumn("rule", rule)
    return found.select(*[c for c in found.columns if not c.startswith(("_host", "_rule", "_part"))])


def select_source(df: DataFrame, name: str) -> DataFrame:
    """Only one source; on a table partitioned by source this prunes the scan."""
    return df.where(F.col("source") == name)


def allowed_hosts(links: DataFrame, sources: DataFrame, url: str = "url") -> DataFrame:
    """Only the links that stay on a host of their own source (subdomains included)."""
    target = with_source(links.withColumnRenamed("source", "_own"), sources, url, rules=False)
    return target.where(F.col("source") == F.col("_own")).drop("_own").select(links.columns)
