"""The rate limit as a stateful stream: arrivals wait in the state until the watermark has passed them.

Drivers are dealt to buckets by hash, since calls and timers cost more than the arrivals of one driver: their number is that
of the buckets, however many drivers there are. A bucket's state is, by driver, the arrivals not decided yet and the
instants of at most ``limit`` accepted ones, as Arrow tables. Arrivals are decided in order of time once no earlier one can
come, so the outcome depends neither on how files fell into micro-batches nor on the buckets. One timer by event time wakes
a bucket when the next arrival is due or the last accepted one has left the window: after silence a driver has no state.
Arrivals that come behind the watermark are not decided; ``count_late`` of ``windows`` counts them with ``Instants``. What
is still ahead of the watermark waits for the next start. A checkpoint goes on with the number of buckets it began with.

One driver's verdicts depend on each other and are one task's work; its state holds no more than the arrivals of the delay.
"""

from __future__ import annotations

from collections import defaultdict, deque
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from milemark.operators.arrivals import MAX_EVENTS_PER_WINDOW, WINDOW_MS

DEFAULT_DELAY = "10 seconds"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DECIDED = "driver_id string, at_ms long, number long, accepted boolean"
BUCKETS = 4096
# rows of a table in the state, and of a table of verdicts
CHUNK = 50_000
PENDING = pa.schema([("driver_id", pa.large_string()), ("at_ms", pa.int64()), ("number", pa.int64())])
ACCEPTED = pa.schema([("driver_id", pa.large_string()), ("at_ms", pa.int64())])
_ORDER = [("driver_id", "ascending"), ("at_ms", "ascending"), ("number", "ascending")]


class Instants:
    """For ``count_late``: a row is late when the watermark has reached the row itself."""

    @staticmethod
    def last_end(at: str) -> Column:
        return F.col(at)


class RateLimiter(StatefulProcessor):
    """Accepts an arrival with fewer than ``limit`` accepted ones of the driver in [t − window, t] before it."""

    def __init__(self, limit: int, window_ms: int, chunk: int = CHUNK):
        self.limit, self.window_ms, self.chunk = limit, window_ms, chunk

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "rows binary")
        self.accepted = handle.getListState("accepted", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for batch in rows:
            number = pa.array(batch["number"].to_numpy(), pa.int64(), mask=batch["unnumbered"].to_numpy(bool))
            arrivals = pa.table([batch["driver_id"].tolist(), batch["at_ms"].tolist(), number], schema=PENDING)
            self.pending.appendValue((_packed(arrivals),))
            least = int(batch["at_ms"].min())
            first = least if first is None else min(first, least)
        if first is not None:
            self._wake(first)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        waiting = _read(self.pending, PENDING)
        passed = pc.less_equal(waiting["at_ms"], watermark)
        due, ahead = waiting.filter(passed).sort_by(_ORDER), waiting.filter(pc.invert(passed))
        recent = defaultdict(deque)
        for driver, at in zip(*_read(self.accepted, ACCEPTED).to_pydict().values()):
            recent[driver].append(at)
        for part in due.to_batches(self.chunk):
            yield pd.DataFrame(
                {
                    "driver_id": part["driver_id"].to_pandas(), "at_ms": part["at_ms"].to_pandas(),
                    "number": part["number"].to_pandas(types_mapper={pa.int64(): pd.Int64Dtype()}.get),
                    "accepted": self._verdicts(part, recent),
                }
            )
        # without what no arrival to come can meet
        held = [(driver, at) for driver, instants in recent.items() for at in instants if at >= watermark - self.window_ms]
        if len(due):
            self._hold(self.pending, ahead)
        self._hold(self.accepted, pa.table([[d for d, _ in held], [at for _, at in held]], schema=ACCEPTED))
        ends = [max(at for _, at in held) + self.window_ms + 1] if held else []
        if len(ahead):
            ends.append(pc.min(ahead["at_ms"]).as_py())
        if ends:
            self.handle.registerTimer(min(ends))

    def close(self) -> None:
        pass

    def _verdicts(self, part: pa.RecordBatch, recent: dict[str, deque]) -> list[bool]:
        """Of arrivals by driver and time; ``recent`` is carried on."""
        found = []
        for driver, at in zip(part["driver_id"].to_pylist(), part["at_ms"].to_pylist()):
            before = recent[driver]
            while before and before[0] < at - self.window_ms:
                before.popleft()
            found.append(len(before) < self.limit)
            if found[-1]:
                before.append(at)
        return found

    def _wake(self, at: int) -> None:
        """One timer at the earliest: what it wakes looks at all that is due."""
        timers = list(self.handle.listTimers())
        if not timers or at < min(timers):
            for later in timers:
                self.handle.deleteTimer(later)
            self.handle.registerTimer(at)

    def _hold(self, state, table: pa.Table) -> None:
        state.clear()
        for start in range(0, len(table), self.chunk):
            state.appendValue((_packed(table.slice(start, self.chunk).combine_chunks()),))


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _read(state, schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([schema.empty_table(), *(pa.ipc.open_stream(rows).read_all() for (rows,) in state.get())])


def limited(
    arrivals: DataFrame, limit: int = MAX_EVENTS_PER_WINDOW, window_ms: int = WINDOW_MS, delay: str = DEFAULT_DELAY,
    key: str = "driver_id", at: str = "event_at", number: str = "arrival_no", buckets: int = BUCKETS,
) -> DataFrame:
    """(driver_id, at_ms, number, accepted) of a stream of arrivals; rows without a driver or a time take no part.
    ``number`` tells arrivals of one driver and millisecond apart, those without one come last."""
    driver, no = F.col(key).cast("string"), F.col(number).cast("long")
    # numbers without nulls: pandas would make doubles of them
    known = arrivals.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(
        F.pmod(F.xxhash64(driver), F.lit(buckets)).alias("bucket"), driver.alias("driver_id"), F.col(at).alias("event_at"),
        F.unix_millis(F.col(at)).alias("at_ms"), F.coalesce(no, F.lit(0)).alias("number"), no.isNull().alias("unnumbered"),
    )
    grouped = known.withWatermark("event_at", delay).groupBy("bucket")
    return grouped.transformWithStateInPandas(RateLimiter(limit, window_ms), DECIDED, "Append", "EventTime")


def write_limited(
    arrivals: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **settings
) -> StreamingQuery:
    """Verdicts as Parquet files below ``path``, each once."""
    spark = arrivals.sparkSession
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)  # a query keeps the settings it was started with
    try:
        return (
            limited(arrivals, **settings)
            .writeStream.format("parquet")
            .outputMode("append")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True}))
            .start()
        )
    finally:
        spark.conf.set(STATE_STORE, before)
