"""Stream writers. Each gives the same result when a batch is repeated after a failure."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shopbank.sinks.commits import CommittedTable, LatestTable, State

BatchWriter = Callable[[DataFrame, int], None]


def _triggered(writer, every: str | None):
    """Every so often, or all that is there and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_append(df: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Final rows to Parquet files; the sink's log keeps a repeated batch from showing twice."""
    writer = df.writeStream.format("parquet").outputMode("append")
    return _triggered(writer.option("checkpointLocation", checkpoint), every).start(path)


def start_batches(
    df: DataFrame, write: BatchWriter, checkpoint: str, mode: str = "append", every: str | None = None
) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(write).outputMode(mode)
    return _triggered(writer.option("checkpointLocation", checkpoint), every).start()


def start_preview(df: DataFrame, name: str | None = None, mode: str = "append") -> StreamingQuery:
    """To the console, or to an in-memory table of that name. For looking at small streams."""
    writer = df.writeStream.outputMode(mode)
    return (writer.format("memory").queryName(name) if name else writer.format("console")).start()


def increments(target: str, keys: Sequence[str], total: Column) -> BatchWriter:
    """Appends what each batch adds to the total of its keys, as the partition ``batch_id``.

    A repeated batch overwrites its own partition. ``summed`` reads the totals back.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        added = batch.groupBy(*keys).agg(total).persist()
        if not added.isEmpty():
            added.write.mode("overwrite").parquet(f"{target}/batch_id={batch_id}")
        added.unpersist()

    return write


def summed(stored: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return stored.groupBy(*keys).agg(F.sum(value).alias(value))


def upsert(target: str, key: Sequence[str], order: Sequence[str], compact_at: int = 16) -> BatchWriter:
    """Keeps the latest row of each key, by ``order``, in a table that ``latest_rows`` reads back.

    Each batch adds the latest of its own rows and touches nothing else; a repeated batch adds nothing. When ``compact_at`` segments have
    gathered, those that are due are made one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = LatestTable(batch.sparkSession, target, key, order)
        if table.write(batch, batch_id) and len(table.state().segments) >= compact_at:
            table.compact()

    return write


def latest_rows(spark: SparkSession, target: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return LatestTable(spark, target, key, order).rows()


def snapshot(target: str) -> BatchWriter:
    """For complete mode: each batch is the whole result and takes the place of the one before; readers see either."""

    def write(batch: DataFrame, batch_id: int) -> None:
        CommittedTable(batch.sparkSession, target).add("stream", batch_id, batch, whole=True)

    return write


def kept_setting(spark: SparkSession, checkpoint: str, name: str, value: int) -> int:
    """A number that is part of a stream's state layout: the value it had when the checkpoint began."""
    table = CommittedTable(spark, f"{checkpoint}-settings")

    def change(state: State) -> State | None:
        return None if name in state.notes else replace(state, notes={**state.notes, name: value})

    table.commit(change)
    return table.state().notes[name]


#: Where an event stood to the events of earlier batches.
ON_TIME, LATE, DROPPED = "on time", "late", "dropped"


def routed_by_lateness(target: str, delay: str, time: str = "event_time") -> BatchWriter:
    """Splits events as a watermark of that delay does, and keeps what it drops.

    An event behind the latest of all earlier batches is late; one behind it by more than ``delay`` is dropped by stateful operators. Both
    kinds and the events on time go to one table, under their own names, with the batch and the verdict, in one commit; the latest
    event time is part of it, so a repeated batch is judged as the first time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        table = CommittedTable(batch.sparkSession, target)
        state = table.state()
        if state.applied.get("stream", -1) >= batch_id:
            return
        latest = state.notes.get("latest")
        micros = F.unix_micros(time)
        behind = F.timestamp_micros(F.lit(latest)) if latest is not None else F.lit(None).cast("timestamp")
        bound = behind - F.expr(f"interval {delay}")
        verdict = F.when(F.col(time) < bound, DROPPED).when(F.col(time) < behind, LATE).otherwise(ON_TIME)
        seen = Observation()
        rows = batch.withColumns({"batch": F.lit(batch_id), "verdict": verdict}).observe(seen, F.max(micros).alias("latest")).persist()
        segments = [table.stage(rows.where(F.col("verdict") != DROPPED)), table.stage(rows.where(F.col("verdict") == DROPPED), "dropped")]
        rows.unpersist()
        found = max((x for x in (latest, seen.get["latest"]) if x is not None), default=None)
        schema = rows.schema.json()

        def change(now: State) -> State | None:
            if now.applied.get("stream", -1) >= batch_id:
                return None
            return replace(
                now, segments=(*now.segments, *[x for x in segments if x.rows]), applied={**now.applied, "stream": batch_id},
                notes=now.notes if found is None else {**now.notes, "latest": found}, schemas={"rows": schema, "dropped": schema},
            )

        table.commit(change)

    return write


def lateness(spark: SparkSession, target: str) -> DataFrame:
    """Events by batch and verdict."""
    table = CommittedTable(spark, target)
    state = table.state()
    both = table.read(state=state).unionByName(table.read("dropped", state))
    return both.groupBy("batch", "verdict").agg(F.count("*").alias("events"))
