"""Queries for event-time windows and the stateful rate limit: three micro-batches of shuffled files, some of whose rows come late or too late."""

from __future__ import annotations

from pyspark.sql import functions as F

from milemark.catalog.registry import query
from milemark.session import scratch_path
from milemark.streaming.ingest import finish
from milemark.streaming.limiter import DECIDED, Instants, write_limited
from milemark.streaming.windows import Windows, activity, count_late, write_activity

FILES_PER_BATCH = 3
DELAY_HOURS = 24
TUMBLING = Windows(size="6 hours")
SLIDING = Windows(size="12 hours", slide="3 hours")
SESSIONS = Windows(gap="8 hours")

_HOUR = 3_600_000_000
# Ten days after the other; one row in ten comes a micro-batch later, and one in ten with the last.
_PLACED = f"""placed AS MATERIALIZED (
    SELECT event_id, user_id, value, us, CASE WHEN event_id % 10 = 7 THEN 2 WHEN event_id % 10 = 3 THEN least(span + 1, 2) ELSE span END AS batch
    FROM (SELECT *, least((us - min(us) OVER ()) // {10 * 24 * _HOUR}, 2) AS span
      FROM (SELECT event_id, user_id, value, epoch_us(ts) AS us FROM events))),
  marks AS MATERIALIZED (
    SELECT (max(us) FILTER (batch = 0) // 1000) * 1000 - {DELAY_HOURS * _HOUR} AS early,
      (max(us) // 1000) * 1000 - {DELAY_HOURS * _HOUR} AS final FROM placed)"""


def _sql_fixed(size: int, slide: int) -> str:
    return f"""WITH {_PLACED},
      dealt AS (
        SELECT *, opens + {size * _HOUR} AS closes
        FROM (SELECT *, unnest(range(us // {slide * _HOUR} * {slide * _HOUR}, us - {size * _HOUR}, -{slide * _HOUR})) AS opens FROM placed))
      SELECT user_id AS driver_id, opens // 1000000 AS opens, closes // 1000000 AS closes, count(*) AS n,
        round(sum(value), 2) AS total, min(value) AS least, max(value) AS most
      FROM dealt, marks WHERE NOT (batch = 2 AND closes <= early) AND closes <= final GROUP BY ALL"""


def _sql_sessions(rows: str, name: str) -> str:
    return f"""{name} AS MATERIALIZED (
      SELECT *, min(us) OVER (PARTITION BY user_id, session) AS opens, max(us) OVER (PARTITION BY user_id, session) + {8 * _HOUR} AS closes
      FROM (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY us) AS session
        FROM (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY user_id ORDER BY us) <= {8 * _HOUR} THEN 0 ELSE 1 END AS fresh FROM ({rows}))))"""


def _streamed(spark, sf, windows: Windows, name: str):
    base = scratch_path(spark, name)
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id", F.col("user_id").alias("driver_id"), F.col("ts").alias("event_at"), F.col("value").alias("speed_mps"))
    us = F.unix_micros(F.col("event_at").cast("timestamp"))
    first = events.agg(F.min(us)).first()[0]
    span = F.least(F.floor((us - F.lit(first)) / (10 * 24 * _HOUR)), F.lit(2))
    last = F.col("event_id") % 10
    batch = F.when(last == 7, 2).when(last == 3, F.least(span + 1, F.lit(2))).otherwise(span)
    events = events.withColumn("event_at", F.col("event_at").cast("timestamp"))
    for k in range(3):
        events.where(batch == k).repartition(FILES_PER_BATCH, F.xxhash64("event_id")).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(f"{base}/in")
    return base, stream


def _closed(spark, sf, windows: Windows, name: str):
    base, stream = _streamed(spark, sf, windows, name)
    finish(write_activity(stream, windows, f"{base}/out", f"{base}/checkpoint", f"{DELAY_HOURS} hours"))
    found = spark.read.schema(activity(stream, windows).schema).parquet(f"{base}/out")
    seconds = {c: F.unix_seconds(c) for c in ("opens", "closes")}
    return found.withColumns({**seconds, "total": F.round("total", 2)})


@query("sm7_tumbling_windows", _sql_fixed(6, 6))
def sm7_tumbling(spark, sf):
    return _closed(spark, sf, TUMBLING, "sm7t")


@query("sm7_sliding_windows", _sql_fixed(12, 3))
def sm7_sliding(spark, sf):
    return _closed(spark, sf, SLIDING, "sm7s")


@query(
    "sm7_session_windows",
    f"""WITH {_PLACED}, {_sql_sessions('SELECT user_id, value, us FROM placed WHERE batch < 2', 'one')},
      {_sql_sessions(f'''SELECT user_id, value, us FROM one, marks WHERE closes > early
        UNION ALL SELECT user_id, value, us FROM placed, marks WHERE batch = 2 AND us + {8 * _HOUR} > early''', 'two')},
      closed AS (SELECT user_id, value, opens, closes FROM one, marks WHERE closes <= early
        UNION ALL SELECT user_id, value, opens, closes FROM two, marks WHERE closes <= final)
      SELECT user_id AS driver_id, opens // 1000000 AS opens, closes // 1000000 AS closes, count(*) AS n,
        round(sum(value), 2) AS total, min(value) AS least, max(value) AS most FROM closed GROUP BY user_id, opens, closes""",
)
def sm7_sessions(spark, sf):
    return _closed(spark, sf, SESSIONS, "sm7g")


@query(
    "sm7_late_rows",
    f"""WITH {_PLACED}
      SELECT user_id AS driver_id, count(*) AS n_late, max(early // 1000 - (us // {6 * _HOUR} + 1) * {6 * 3_600_000}) AS furthest_ms
      FROM placed, marks WHERE batch = 2 AND (us // {6 * _HOUR} + 1) * {6 * _HOUR} <= early GROUP BY user_id""",
)
def sm7_late(spark, sf):
    base, stream = _streamed(spark, sf, TUMBLING, "sm7l")
    finish(count_late(stream, TUMBLING, base, f"{base}/checkpoint", f"{DELAY_HOURS} hours"))
    return spark.read.parquet(f"{base}/late").select("driver_id", "n_late", "furthest_ms")


LIMIT, LIMIT_HOURS = 3, 12
_LIMITED = f"""dealt AS MATERIALIZED (
    SELECT user_id, event_id, us // 1000 AS ms, row_number() OVER (PARTITION BY user_id ORDER BY us // 1000, event_id) AS place
    FROM placed, marks WHERE user_id IS NOT NULL AND NOT (batch = 2 AND us <= early) AND us // 1000 <= final // 1000),
  fold AS (
    SELECT user_id, event_id, ms, place, [ms] AS recent, true AS accepted FROM dealt WHERE place = 1
    UNION ALL
    SELECT user_id, event_id, ms, place, CASE WHEN len(kept) < {LIMIT} THEN list_append(kept, ms) ELSE kept END, len(kept) < {LIMIT}
    FROM (SELECT d.*, list_filter(f.recent, lambda t: t >= d.ms - {LIMIT_HOURS * 3_600_000}) AS kept
      FROM fold f JOIN dealt d ON d.user_id = f.user_id AND d.place = f.place + 1))"""


@query(
    "sm3_stateful_rate_limit",
    f"WITH RECURSIVE {_PLACED}, {_LIMITED} SELECT user_id::varchar AS driver_id, ms AS at_ms, event_id AS number, accepted FROM fold",
)
def sm3_stateful(spark, sf):
    """Verdicts in order of time over micro-batches with early and late rows, as far as the watermark came."""
    base, stream = _streamed(spark, sf, TUMBLING, "sm3s")
    finish(
        write_limited(
            stream, f"{base}/out", f"{base}/checkpoint", limit=LIMIT, window_ms=LIMIT_HOURS * 3_600_000, delay=f"{DELAY_HOURS} hours",
            number="event_id",
        )
    )
    return spark.read.schema(DECIDED).parquet(f"{base}/out")


@query(
    "sm3_undecided_rows",
    f"""WITH {_PLACED}
      SELECT user_id::varchar AS driver_id, count(*) AS n_late, max((early - us // 1000 * 1000) // 1000) AS furthest_ms
      FROM placed, marks WHERE batch = 2 AND us <= early AND user_id IS NOT NULL GROUP BY user_id""",
)
def sm3_undecided(spark, sf):
    """Arrivals that came behind the watermark, by driver."""
    base, stream = _streamed(spark, sf, TUMBLING, "sm3u")
    finish(count_late(stream, Instants(), base, f"{base}/checkpoint", f"{DELAY_HOURS} hours"))
    found = spark.read.parquet(f"{base}/late")
    return found.select(F.col("driver_id").cast("string").alias("driver_id"), "n_late", "furthest_ms")
