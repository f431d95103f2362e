"""Forecast files as a stream: arrivals, duplicates, completeness, late data.

A pass is one run of a checkpointed query over the files that landed since the
last one (``availableNow``). State and watermark carry over between passes.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from cubeweave.operators import forecast

# fixed value: missed files are fetched for three days
LATENESS = "3 days"


def source(spark: SparkSession, folder: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    """The files of a folder (or table) as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def append_pass(stream: DataFrame, out: str, partition: list[str] = ()) -> None:
    """Append what is new to a table; each file is taken once."""
    writer = stream.writeStream.format("parquet").option("checkpointLocation", os.path.join(out, "_checkpoint"))
    if partition:
        writer = writer.partitionBy(*partition)
    writer.outputMode("append").trigger(availableNow=True).start(os.path.join(out, "data")).awaitTermination()


def update_pass(stream: DataFrame, out: str) -> None:
    """Write the changed groups of every batch to the folder of that batch.

    A batch that is run again after a failure replaces its own folder.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(out, "data", f"batch={number}"))

    (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", os.path.join(out, "_checkpoint"))
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def run_passes(
    landing: str, passes: list[DataFrame], make: Callable[[], DataFrame], step: Callable[[DataFrame, str], None], out: str
) -> None:
    """Land the rows of each pass, then let the query take them."""
    for rows in passes:
        rows.write.mode("append").parquet(landing)
        step(make(), out)


def result(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(os.path.join(out, "data"))


def timed(stream: DataFrame, time: str, delay: str = LATENESS) -> DataFrame:
    """Add the event time and its watermark."""
    return stream.withColumn("event_time", F.col(time).cast("timestamp")).withWatermark("event_time", delay)


def unique_files(stream: DataFrame, time: str, delay: str) -> DataFrame:
    """One row per file; a duplicate within the delay is dropped."""
    return timed(stream, time, delay).dropDuplicatesWithinWatermark(["cycle", "source", "lead"])


def lead_sets(stream: DataFrame, time: str = "reftime") -> DataFrame:
    """Leads seen so far per cycle and source.

    The set is kept as two 64-bit masks, one bit per lead, so the state of a
    group has a fixed size and a repeated lead changes nothing. A lead that no
    cycle has sets no bit.
    """
    place = F.array_position(forecast.lead_array(), F.col("lead")) - 1
    bit = lambda low: F.when(
        place.between(0, 63) if low else (place >= 64), F.expr("shiftleft(1L, CAST((array_position(_leads, lead) - 1) % 64 AS INT))")
    ).otherwise(F.lit(0).cast("bigint"))
    marked = timed(stream, time).withColumn("_leads", forecast.lead_array())
    return (
        marked.withColumns({"_low": bit(True), "_high": bit(False)})
        .groupBy("event_time", "cycle", "source")
        .agg((F.bit_count(F.bit_or("_low")) + F.bit_count(F.bit_or("_high"))).cast("bigint").alias("n_leads"))
    )


def counts(stream: DataFrame, time: str = "reftime") -> DataFrame:
    """Rows per cycle and source that were not too late."""
    return timed(stream, time).groupBy("event_time", "cycle", "source").agg(F.count("*").alias("n"))


class Memory(StatefulProcessor):
    """Remembers each key until it was not seen for some time, in event time.

    The first sight of a key gives ``new``; a key that was not seen for that time
    gives ``expired`` and leaves the state, so it is new when it comes back. Keys are kept by bucket, with the
    time when each was last seen: every call for state goes to the JVM and back, and so there are a few of them for a
    bucket, not for a key. A bucket has one timer, for the key that is the next to expire.
    """

    def __init__(self, keep_seconds: int) -> None:
        self.keep = keep_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getValueState("seen", "keys array<string>, ats array<bigint>")

    def _held(self) -> dict[str, int]:
        state = self.seen.get()
        return dict(zip(*state, strict=True)) if state else {}

    def _hold(self, held: dict[str, int], timer: int | None) -> None:
        """Keep the keys; ``timer`` is the one that is set, if there is one."""
        if not held:
            self.seen.clear()
            return
        self.seen.update((list(held), list(held.values())))
        first = min(held.values()) + self.keep
        if first != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)

    def handleInputRows(self, key, rows, timerValues):
        here: dict[str, int] = {}
        for r in rows:
            here[r.key] = max(r.at, here.get(r.key, r.at))
        held = self._held()
        timer = min(held.values()) + self.keep if held else None
        for k, at in here.items():
            if k not in held:
                yield Row(key=k, what="new", at=at)
            held[k] = max(at, held.get(k, at))
        self._hold(held, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        # all that have expired by now, not those of this time alone: the next timer is a later one
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = self._held()
        for k, at in held.items():
            if at + self.keep <= now:
                yield Row(key=k, what="expired", at=at + self.keep)
        self._hold({k: at for k, at in held.items() if at + self.keep > now}, None)

    def close(self) -> None:
        pass


#: Settings of streams that keep state of their own.
MEMORY_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


#: Parts of the keys of a stream that remembers them: a part's state is read and written as a whole.
BUCKETS = 8_192


def remembered(stream: DataFrame, key: str, time: str, keep_seconds: int, buckets: int = BUCKETS) -> DataFrame:
    """Keys that are new, and keys that were not seen for ``keep_seconds``: key, what, at (milliseconds).

    State is bounded by the keys seen within that time. Run it under ``MEMORY_SETTINGS``. A stream that is
    run again from its checkpoint needs the same number of buckets.
    """
    rows = timed(stream, time, "0 seconds").select(F.col(key).alias("key"), "event_time", F.unix_millis("event_time").alias("at"))
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    return dealt.groupBy("bucket").transformWithState(Memory(keep_seconds), "key string, what string, at bigint", "append", "EventTime")
