"""Event-time windows over driver activity: tumbling, sliding and sessions, with a watermark.

``activity`` is the same for a table and for a stream; on a stream Spark keeps the open windows in its state store and
drops them once the watermark has passed their end. Rows whose window has closed before they came take part in no window;
``count_late`` writes how many those are, by driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from milemark.sources import readers

DEFAULT_DELAY = "10 minutes"


@dataclass(frozen=True)
class Windows:
    """``size`` alone: tumbling; with ``slide``: sliding; ``gap`` alone: sessions that end after so much silence."""

    size: str | None = None
    slide: str | None = None
    gap: str | None = None

    def __post_init__(self):
        if (self.size is None) == (self.gap is None) or (self.slide is not None and self.size is None):
            raise ValueError("give a size, a size and a slide, or a gap")

    def column(self, at: str) -> Column:
        return F.session_window(at, self.gap) if self.gap else F.window(at, self.size, self.slide)

    def last_end(self, at: str) -> Column:
        """The end of the last window that a row alone falls into."""
        if self.gap:
            return F.col(at) + F.expr(f"interval {self.gap}")
        if self.slide is None:
            return F.window(at, self.size)["end"]
        # the last window opens at the start of the row's slide
        return F.window(at, self.slide)["start"] + F.expr(f"interval {self.size}")


def activity(
    events: DataFrame, windows: Windows, delay: str = DEFAULT_DELAY, at: str = "event_at", key: str = "driver_id", value: str = "speed_mps"
) -> DataFrame:
    """(driver, opens, closes, n, total, least, most) of each window; rows without a time or a driver count in none."""
    rows = events.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withWatermark(at, delay)
    found = rows.groupBy(windows.column(at).alias("_w"), key).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.min(value).alias("least"), F.max(value).alias("most")
    )
    return found.select(key, F.col("_w.start").alias("opens"), F.col("_w.end").alias("closes"), "n", "total", "least", "most")


def write_activity(
    events: DataFrame, windows: Windows, path: str, checkpoint: str, delay: str = DEFAULT_DELAY, trigger: dict | None = None, **columns
) -> StreamingQuery:
    """Each window once, when the watermark has passed its end. Windows still open wait in the state for the next start."""
    return (
        activity(events, windows, delay, **columns)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def count_late(
    events: DataFrame, windows: Windows, base: str, checkpoint: str, delay: str = DEFAULT_DELAY, trigger: dict | None = None,
    at: str = "event_at", key: str = "driver_id",
) -> StreamingQuery:
    """``late`` below ``base``: (driver, n_late, furthest) by micro-batch, the rows that come after all their windows closed.

    A micro-batch is held against the watermark that closed windows before it came, as Spark does: the latest event time
    of the micro-batches up to the last but one, less the delay; at a start of the stream up to the last one, since
    ``availableNow`` closes what can be closed before it stops. One row for each micro-batch, in ``progress``, carries
    that on; repeating a micro-batch replaces its files.
    """
    begun = False

    def take(batch: DataFrame, batch_id: int) -> None:
        nonlocal begun
        spark = batch.sparkSession
        schema = "reached timestamp, before timestamp"
        last = readers.optional(spark.read.schema(schema).parquet, f"{base}/progress/batch={batch_id - 1}") if batch_id else None
        held = last.first() if last is not None else None
        rows = batch.where(F.col(key).isNotNull() & F.col(at).isNotNull())
        # whole milliseconds, as watermarks are
        newest = F.timestamp_millis(F.unix_millis(F.max(at)))
        if held is not None and held.reached is not None:
            newest = F.greatest(newest, F.lit(held.reached))
        passed = None if held is None else held.before if begun else held.reached
        begun = True
        watermark = F.lit(passed).cast("timestamp") - F.expr(f"interval {delay}")
        late = rows.withColumn("_behind", F.unix_millis(watermark) - F.unix_millis(windows.last_end(at))).where(
            windows.last_end(at) <= watermark
        )
        late = late.groupBy(key).agg(F.count(F.lit(1)).alias("n_late"), F.max("_behind").alias("furthest_ms"))
        late.write.mode("overwrite").parquet(f"{base}/late/batch={batch_id}")
        reached = held.reached if held is not None else None
        progress = rows.agg(newest.alias("reached")).select("reached", F.lit(reached).cast("timestamp").alias("before"))
        progress.write.mode("overwrite").parquet(f"{base}/progress/batch={batch_id}")

    return (
        events.writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
