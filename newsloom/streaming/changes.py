"""Continuous application of a change stream to a keyed table on plain files.

The table is a log: each micro-batch, reduced to its latest change per key, is a folder of its own,
and readers take the latest change per key of all folders. A folder counts once a marker names it.
Markers appear by a rename, so a reader sees a batch whole or not at all, and a batch that runs
again after it was published is left as it is. A compaction is a folder too; its marker tells up to
which batch it holds everything, and readers then take it and the later batches. So the stream goes
on writing while the log is compacted.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from newsloom.operators.tables import apply_changes

BATCHES, COMPACTED = "_batches", "_compacted"
COUNTS = "run string, batch long, processed long, removed long, upserted long"


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _markers(spark: SparkSession, log: str, kind: str) -> dict[int, str]:
    """Batch number and data folder of every marker: ``<number>-<folder>``."""
    fs, path = _folder(spark, f"{log}/{kind}")
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return {int(number): folder for number, _, folder in (n.partition("-") for n in names if not n.startswith("."))}


def _publish(spark: SparkSession, log: str, kind: str, number: int, folder: str) -> None:
    fs, path = _folder(spark, f"{log}/{kind}")
    fs.mkdirs(path)
    draft = _folder(spark, f"{log}/{kind}/.{folder}")[1]
    fs.create(draft).close()
    if not fs.rename(draft, _folder(spark, f"{log}/{kind}/{number}-{folder}")[1]):
        raise OSError(f"could not publish batch {number} of {log}")


def _parts(spark: SparkSession, log: str) -> tuple[list[str], int]:
    """The folders that hold the state, and the last batch among them."""
    compacted, batches = _markers(spark, log, COMPACTED), _markers(spark, log, BATCHES)
    upto = max(compacted, default=-1)
    folders = [compacted[upto]] if compacted else []
    folders += [folder for number, folder in sorted(batches.items()) if number > upto]
    if not folders:
        raise ValueError(f"no batch has been published in {log}")
    return [f"{log}/data/{f}" for f in folders], max([upto, *batches])


def apply_changes_stream(stream: DataFrame, log: str, checkpoint: str, key: str = "title",
                         seq: str = "seq", op: str = "event_name", available_now: bool = True,
                         interval: str = "1 minute") -> StreamingQuery:
    """Reduce each batch to its latest change per key and add it to the log.

    Removals stay in the log as tombstones, so an older upsert that comes late changes nothing.
    """
    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in _markers(spark, log, BATCHES) or batch_id <= max(_markers(spark, log, COMPACTED), default=-1):
            return
        folder = uuid.uuid4().hex
        apply_changes(batch, key, seq, op, keep_removed=True).write.parquet(f"{log}/data/{folder}")
        _publish(spark, log, BATCHES, batch_id, folder)

    writer = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


class ChangeCounter(StreamingQueryListener):
    """Appends the counts of every batch of a counted stream to a table: ``run, batch, processed, removed, upserted``.

    ``counted`` puts the counters on the stream. A batch that runs again after a failure is appended
    again only if it ended before, so readers take one row a batch (``counts_of``).
    """

    def __init__(self, spark: SparkSession, table: str, name: str = "changes"):
        super().__init__()
        self.spark, self.table, self.name, self.seen = spark, table, name, {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self.name)
        if found is not None:
            row = (str(progress.id), progress.batchId, found["processed"], found["removed"], found["upserted"])
            self.spark.createDataFrame([row], COUNTS).coalesce(1).write.mode("append").parquet(self.table)
        self.seen[str(progress.runId)] = progress.batchId

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.seen[str(event.runId)] = None

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until the listener has heard the end of a query; events come a moment after the batches."""
        query.awaitTermination()
        until = time.monotonic() + seconds
        while self.seen.get(str(query.runId), -1) is not None:
            if time.monotonic() > until:
                raise TimeoutError("the stream's last counts did not arrive")
            time.sleep(0.05)


def counted(changes: DataFrame, op: str = "event_name", name: str = "changes") -> DataFrame:
    """The stream with counters of processed, removed and upserted records, told at the end of each batch."""
    removed = F.coalesce(F.col(op) == "REMOVE", F.lit(False))
    return changes.observe(name, F.count(F.lit(1)).alias("processed"), F.count_if(removed).alias("removed"), F.count_if(~removed).alias("upserted"))


def counts_of(spark: SparkSession, table: str) -> DataFrame:
    """One row per batch of the table a ``ChangeCounter`` fills."""
    return spark.read.schema(COUNTS).parquet(table).dropDuplicates(["run", "batch"])


def latest_by_state(stream: DataFrame, checkpoint: str, key: str = "title", seq: str = "seq", available_now: bool = True,
                    interval: str = "1 minute") -> StreamingQuery:
    """Keep the latest change per key in the stream's own state instead of a log of files.

    The state store holds one row per key, changed in place, so nothing needs compacting. Records may
    come in any order: the greatest ``seq`` stands. Removals stay as tombstones, as in the log. The
    session must name a state store that ``read_stream_state`` can read; RocksDB keeps it off the heap.
    A restart from the checkpoint goes on where the last batch ended.
    """
    rest = [c for c in stream.columns if c != key]
    latest = stream.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), F.col(seq)).alias("latest"))
    writer = latest.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def read_stream_state(spark: SparkSession, checkpoint: str, key: str = "title", op: str = "event_name") -> DataFrame:
    """Current rows of ``latest_by_state``, read from the state of its last finished batch."""
    state = spark.read.format("statestore").load(checkpoint)
    names = state.schema["value"].dataType.names  # the aggregate's buffer: the value, and what it is ordered by
    rows = state.select(F.col(f"key.{key}").alias(key), F.col("value").getField(names[0]).alias("latest"))
    return rows.select(key, "latest.*").where(F.coalesce(F.col(op), F.lit("")) != "REMOVE")


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All changes that still count, tombstones included."""
    return spark.read.parquet(*_parts(spark, log)[0])


def read_state(spark: SparkSession, log: str, key: str = "title", seq: str = "seq",
               op: str = "event_name") -> DataFrame:
    """Current rows of the table."""
    return apply_changes(read_log(spark, log), key, seq, op)


def compact_log(spark: SparkSession, log: str, key: str = "title", seq: str = "seq", op: str = "event_name",
                forget_before: Column | int | str | None = None) -> None:
    """Write one row per key for all batches published so far, and make readers start from it.

    Tombstones stay, but for those with ``seq`` under ``forget_before``: pass a bound only when no
    older change can still arrive. Batches that are published meanwhile stay beside the compaction.
    """
    folders, upto = _parts(spark, log)
    latest = apply_changes(spark.read.parquet(*folders), key, seq, op, keep_removed=True)
    if forget_before is not None:
        bound = forget_before if isinstance(forget_before, Column) else F.lit(forget_before)
        removed = F.coalesce(F.col(op) == "REMOVE", F.lit(False))
        latest = latest.where(~(removed & (F.col(seq) < bound)))
    folder = uuid.uuid4().hex
    latest.write.parquet(f"{log}/data/{folder}")
    _publish(spark, log, COMPACTED, upto, folder)
