"""Incremental jobs on Structured Streaming.

State that must be kept per key lives in Spark's state store under the query's
checkpoint, so a restart continues where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import validate as V
from ..operators.dedupe import last_wins
from ..sources.sinks import write_json

SNAPSHOT_DDL = "page_id STRING, version BIGINT, ts TIMESTAMP, status STRING, seq BIGINT"


def snapshots(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of snapshot files."""
    reader = spark.readStream.schema(SNAPSHOT_DDL)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


KEYED_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGE_DDL = "page_id STRING, version BIGINT, seq BIGINT, action STRING"


class NewestVersion(StatefulProcessor):
    """Keeps the newest version of one page; a row a micro-batch tells what became of its arrivals.

    ``mirrored``: a version newer than the one held arrived and is held now. ``resumed``: nothing newer
    arrived, the row shows the version held. Of equal versions the first arrival stays; a null version is
    older than any other.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "version BIGINT, seq BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = tuple(self.held.get()) if self.held.exists() else None
        best = held
        for row in rows:
            if best is None or _age(row.version) > _age(best[0]) or (best is not held and row.version == best[0] and row.seq < best[1]):
                best = (row.version, row.seq)
        if best is not held:
            self.held.update(best)
        yield Row(page_id=key[0], version=best[0], seq=best[1], action="resumed" if best is held else "mirrored")

    def close(self) -> None:
        pass


def _age(version: int | None) -> tuple[bool, int]:
    return version is not None, version or 0


def newest_changes(stream: DataFrame) -> DataFrame:
    """A row for each page of a micro-batch: the version it holds now, and whether this batch brought it.

    State is keyed by page in Spark's state store, so a batch reads and writes only the pages it names.
    """
    return stream.groupBy("page_id").transformWithState(
        statefulProcessor=NewestVersion(), outputStructType=CHANGE_DDL, outputMode="append", timeMode="none"
    )


def incremental_mirror(stream: DataFrame, table: str, checkpoint: str):
    """Append the changes of :func:`newest_changes` to the folder ``table``; replays and restarts change nothing.

    The work and the rows written grow with the micro-batch, not with the table; :func:`mirrored_pages` reads the
    pages as they stand.
    """
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, KEYED_STATE)  # keyed state needs this store; a started query keeps it
    try:
        return (
            newest_changes(stream).writeStream.format("parquet").outputMode("append")
            .option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(PROVIDER, before)


def mirrored_pages(spark: SparkSession, table: str) -> DataFrame:
    """Newest version of every page in a folder written by :func:`incremental_mirror`."""
    changes = spark.read.schema(CHANGE_DDL).parquet(table).where("action = 'mirrored'")
    return last_wins(changes.select("page_id", "version", "seq"), "page_id", "version")


def outcome_counts(stream: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Outcome counts per window; rows later than the watermark are dropped."""
    return (
        stream.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "status")
        .agg(F.count("*").alias("outcomes")).select(F.col("w.start").alias("window_start"), "status", "outcomes")
    )


def without_repeats(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Repeated (page, version) snapshots inside the watermark are suppressed."""
    return stream.withWatermark("ts", late).dropDuplicatesWithinWatermark(["page_id", "version"])


def validate_stream(stream: DataFrame, schema: str, valid_path: str, dead_letter_path: str, checkpoint: str, json: str = "json"):
    """Valid records to one table, violations to a dead-letter table."""
    def gate(batch: DataFrame, batch_id: int) -> None:
        valid, bad = V.split_valid(batch, schema, json)
        # One folder per batch number: a repeated batch replaces its own output.
        write_json(valid, f"{valid_path}/batch={batch_id:012d}")
        write_json(bad, f"{dead_letter_path}/batch={batch_id:012d}")

    return stream.writeStream.foreachBatch(gate).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
