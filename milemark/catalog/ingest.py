"""Queries for the ingest path, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from milemark.catalog import inputs
from milemark.catalog.cleaning import REASON_SQL
from milemark.catalog.registry import CTES, ORACLES, query, with_ctes
from milemark.operators import arrivals, ingest, monitoring, recency
from milemark.plans.medallion import ingest_batch
from milemark.session import scratch_path, store
from milemark.sources import readers
from milemark.streaming import ingest as streaming


def sql_rate_fold(rows: str) -> str:
    """Recursive expressions ``numbered`` and ``fold``: each arrival of a driver after the one before."""
    return f"""numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY driver_id
        ORDER BY arrival_ms, arrival_no) AS place FROM {rows}),
      fold AS (
        SELECT driver_id, place, arrival_no, true AS accepted, [arrival_ms] AS recent FROM numbered WHERE place = 1
        UNION ALL
        SELECT driver_id, place, arrival_no, len(kept) < 20,
          CASE WHEN len(kept) < 20 THEN list_append(kept, arrival_ms) ELSE kept END
        FROM (SELECT n.driver_id, n.place, n.arrival_no, n.arrival_ms,
                list_filter(f.recent, lambda x: x >= n.arrival_ms - 1000) AS kept
              FROM fold f JOIN numbered n ON n.driver_id = f.driver_id AND n.place = f.place + 1))"""


CTES["verdicts"] = (
    ["request_events", "device_keys"],
    """SELECT e.*, device_keys.driver_id IS NOT NULL AND NOT is_forged AS authorized,
         NOT is_broken AND device_keys.driver_id IS NOT NULL AND NOT is_forged AS candidate
       FROM request_events e LEFT JOIN device_keys USING (driver_id)""",
)
CTES["firsts"] = (
    ["verdicts"],
    """SELECT * EXCLUDE (copy_no) FROM (SELECT *, row_number() OVER (PARTITION BY event_id
         ORDER BY arrival_ms, arrival_no) AS copy_no FROM verdicts WHERE candidate) WHERE copy_no = 1""",
)

_OUTCOMES = f""", {sql_rate_fold('firsts')},
    reasons AS MATERIALIZED (SELECT v.*, CASE
        WHEN is_broken THEN 'INVALID_JSON'
        WHEN NOT authorized THEN 'UNAUTHORIZED'
        WHEN f.arrival_no IS NULL THEN 'DUPLICATE_EVENT'
        WHEN NOT f.accepted THEN 'RATE_LIMIT_EXCEEDED'
        WHEN is_mistyped THEN 'SCHEMA_VALIDATION_FAILED'
        ELSE {REASON_SQL} END AS reason
      FROM verdicts v LEFT JOIN (SELECT arrival_no, accepted FROM fold) f USING (arrival_no))"""

_OUTCOME = """CASE WHEN reason = 'OK' THEN 'ACCEPTED' WHEN reason IN ('INVALID_JSON', 'UNAUTHORIZED',
  'DUPLICATE_EVENT', 'RATE_LIMIT_EXCEEDED') THEN reason ELSE 'REJECTED' END"""


def sql_outcomes(body: str) -> str:
    return with_ctes("", "verdicts", "firsts", recursive=True).rstrip() + _OUTCOMES + "\n" + body


def classified(spark, sf):
    return ingest.classify(inputs.requests(spark, sf), inputs.device_keys(spark, sf))


@query(
    "src5_json_bodies",
    with_ctes(
        """SELECT arrival_no, NOT is_broken AS is_json, NOT (is_broken OR is_mistyped) AS schema_ok,
             CASE WHEN NOT is_broken THEN event_id END AS event_id, CASE WHEN NOT is_broken THEN ts END AS ts,
             CASE WHEN NOT is_broken THEN lat END AS lat,
             CASE WHEN NOT (is_broken OR is_mistyped) THEN speed_mps END AS speed_mps
           FROM request_events""",
        "request_events",
    ),
)
def src5(spark, sf):
    return ingest.parse_events(inputs.requests(spark, sf)).select(
        "arrival_no", "is_json", F.col("_schema_ok").alias("schema_ok"), "event_id", "ts", "lat", "speed_mps"
    )


@query(
    "wn2_duplicates_marked",
    with_ctes(
        """SELECT arrival_no, event_id, row_number() OVER (PARTITION BY event_id ORDER BY arrival_ms, arrival_no) > 1
             AS is_duplicate FROM arrivals""",
        "arrivals",
    ),
)
def wn2(spark, sf):
    marked = arrivals.mark_duplicates(inputs.arrivals(spark, sf), ["arrival_ms", "arrival_no"])
    return marked.select("arrival_no", "event_id", "is_duplicate")


def sql_recent(rows: str, capacity: int) -> str:
    """``marked``: whether fewer than ``capacity`` other ids came since an id's last arrival. Arrivals between that repeat
    an id from between are no further ids."""
    return f"""numbered_ids AS MATERIALIZED (SELECT arrival_no, event_id,
        row_number() OVER (ORDER BY arrival_ms, arrival_no) AS i FROM {rows} WHERE event_id IS NOT NULL),
      reuse AS MATERIALIZED (SELECT *, lag(i) OVER (PARTITION BY event_id ORDER BY i) AS p FROM numbered_ids),
      far AS (SELECT f.i, any_value(f.i - f.p - 1) - count(n.i) AS others
        FROM reuse f LEFT JOIN reuse n ON n.p > f.p AND n.i < f.i WHERE f.i - f.p - 1 >= {capacity} GROUP BY f.i),
      marked AS (SELECT arrival_no, coalesce(i - p - 1 < {capacity} OR others < {capacity}, false) AS is_duplicate
        FROM reuse LEFT JOIN far USING (i))"""


@query(
    "wn2_bounded",
    f"""WITH reused AS ({inputs.for_duckdb(inputs.REUSED_IDS)}), {sql_recent('reused', recency.REMEMBERED_IDS)}
        SELECT arrival_no, event_id, coalesce(is_duplicate, false) AS is_duplicate FROM reused LEFT JOIN marked USING (arrival_no)""",
)
def wn2_bounded(spark, sf):
    """Only the last 10,000 distinct ids are remembered."""
    return recency.mark_repeats(inputs.reused_ids(spark, sf), ["arrival_ms", "arrival_no"]).select("arrival_no", "event_id", "is_duplicate")


@query(
    "wn3_rate_limit",
    with_ctes("", "arrivals", recursive=True).rstrip()
    + f", {sql_rate_fold('arrivals')} SELECT arrival_no, driver_id, accepted FROM fold",
)
def wn3(spark, sf):
    return arrivals.rate_limit(inputs.arrivals(spark, sf)).select("arrival_no", "driver_id", "accepted")


@query("sm1_request_outcomes", sql_outcomes(f"SELECT arrival_no, reason, {_OUTCOME} AS outcome FROM reasons"))
def sm1(spark, sf):
    return classified(spark, sf).select("arrival_no", "reason", "outcome")


@query(
    "ag28_outcome_counters",
    sql_outcomes(
        "SELECT counter, count(o.outcome) AS n FROM (VALUES ('accepted', 'ACCEPTED'), ('rejected', 'REJECTED'), "
        "('unauth', 'UNAUTHORIZED'), ('duplicates', 'DUPLICATE_EVENT'), ('rate_limited', 'RATE_LIMIT_EXCEEDED')) "
        f"c(counter, outcome) LEFT JOIN (SELECT {_OUTCOME} AS outcome FROM reasons) o USING (outcome) GROUP BY counter"
    ),
)
def ag28(spark, sf):
    return monitoring.outcome_counters(classified(spark, sf))


# The body of a request as it was sent, from its parts: what JSON keeps is checked by its marks.
_LETTERS = """SELECT arrival_no, event_id, reason AS _dlq_reason, is_mistyped AS has_text_speed, is_mistyped AS has_unused
  FROM reasons WHERE reason NOT IN ('OK', 'INVALID_JSON', 'UNAUTHORIZED', 'DUPLICATE_EVENT', 'RATE_LIMIT_EXCEEDED')"""


def _letter_marks(letters):
    """What only the original body still holds: a value that did not fit, and a field outside the contract."""
    body = F.col("_original")
    return letters.select(
        "event_id", "_dlq_reason",
        (F.get_json_object(body, "$.speed_mps") == "fast").alias("has_text_speed"),
        F.get_json_object(body, "$.unused").isNotNull().alias("has_unused"),
        (F.get_json_object(body, "$.event_id") == F.col("event_id")).alias("is_own_body"),
    )


@query(
    "jb1_ingest_batch",
    sql_outcomes(
        """SELECT CASE WHEN reason = 'OK' THEN 'bronze' ELSE 'dlq' END AS sink,
             CASE WHEN reason <> 'OK' THEN reason END AS _dlq_reason, count(*) AS n, sum(ts)::bigint AS ts_sum
           FROM reasons WHERE reason NOT IN ('INVALID_JSON', 'UNAUTHORIZED', 'DUPLICATE_EVENT', 'RATE_LIMIT_EXCEEDED')
           GROUP BY ALL"""
    ),
)
def jb1(spark, sf):
    base = scratch_path(spark, "jb1")
    for _ in range(2):  # the second run of a named batch replaces the files of the first
        ingest_batch(inputs.requests(spark, sf), inputs.device_keys(spark, sf), f"{base}/bronze", f"{base}/dlq", batch="0")
    good = readers.read_raw_events(spark, f"{base}/bronze").withColumn("_dlq_reason", F.lit(None).cast("string"))
    bad = readers.read_dead_letters(spark, f"{base}/dlq").drop("_original")
    both = good.withColumn("sink", F.lit("bronze")).unionByName(bad.withColumn("sink", F.lit("dlq")))
    return _with_whole_sums(both.groupBy("sink", "_dlq_reason"), "ts", "ts_sum")


def _with_whole_sums(groups, column: str, name: str):
    """Count and exact sum of a bigint by group. Five million instants in milliseconds exceed a bigint: the sum is one where
    all groups fit, as in the SQL, and a decimal where the SQL's cast fails."""
    wide = F.sum(F.col(column).cast("decimal(28,0)"))
    found = store(groups.agg(F.count(F.lit(1)).alias("n"), wide.alias(name)), "sums")
    fits = F.coalesce(F.bool_and(F.col(name).between(-(1 << 63), (1 << 63) - 1)), F.lit(True))
    return found.withColumn(name, F.col(name).cast("bigint")) if found.agg(fits).first()[0] else found


@query(
    "snk5_original_bodies",
    sql_outcomes(f"SELECT event_id, _dlq_reason, has_text_speed, has_unused, true AS is_own_body FROM ({_LETTERS})"),
)
def snk5_bodies(spark, sf):
    base = scratch_path(spark, "snk5")
    ingest_batch(inputs.requests(spark, sf), inputs.device_keys(spark, sf), f"{base}/bronze", f"{base}/dlq")
    return _letter_marks(readers.read_dead_letters(spark, f"{base}/dlq"))


FILES_PER_BATCH = 2
ROWS_OF_A_FILE = 100_000


def _request_files(spark, sf, batches: int = 3) -> tuple[str, int]:
    """The requests as JSON-lines files: as many files for each span of arrival times, one span after the other. Returns
    the folder and the files of a span, two at least and more for large tables."""
    path = scratch_path(spark, "requests")
    requests = store(inputs.requests(spark, sf), "requests")
    first, last, n = requests.agg(F.min("arrival_ms"), F.max("arrival_ms"), F.count("*")).first()
    span = F.floor((F.col("arrival_ms") - first) * batches / (last - first + 1))
    files = max(FILES_PER_BATCH, n // (batches * ROWS_OF_A_FILE))
    for k in range(batches):
        requests.filter(span == k).repartition(files, "arrival_no").write.mode("append").json(path)
    return path, files


def _streamed(spark, sf, name, **options) -> str:
    """The folder that the streaming ingest filled from three micro-batches."""
    base = scratch_path(spark, name)
    requests = streaming.request_stream(spark, *_request_files(spark, sf))
    streaming.finish(streaming.ingest_stream(requests, inputs.device_keys(spark, sf), base, f"{base}/checkpoint", **options))
    return base


@query(
    "sm2_streaming_dedup",
    sql_outcomes("SELECT arrival_no, reason = 'DUPLICATE_EVENT' AS is_duplicate FROM reasons"),
)
def sm2(spark, sf):
    """Repeated ids over several micro-batches: the earliest arrival stays."""
    outcomes = spark.read.option("recursiveFileLookup", "true").parquet(f"{_streamed(spark, sf, 'sm2')}/outcomes")
    return outcomes.select("arrival_no", (F.col("outcome") == "DUPLICATE_EVENT").alias("is_duplicate"))


#: So few that ids come back after they were forgotten.
_FEW_IDS = 3


@query(
    "sm2_bounded_cache",
    with_ctes("", "verdicts").rstrip()
    + f""", {sql_recent('(SELECT * FROM verdicts WHERE candidate)', _FEW_IDS)}
    SELECT arrival_no, coalesce(is_duplicate, false) AS is_duplicate FROM verdicts LEFT JOIN marked USING (arrival_no)""",
)
def sm2_bounded(spark, sf):
    """The last ids go from one micro-batch to the next, and no more than those."""
    outcomes = spark.read.option("recursiveFileLookup", "true").parquet(f"{_streamed(spark, sf, 'sm2b', capacity=_FEW_IDS)}/outcomes")
    return outcomes.select("arrival_no", (F.col("outcome") == "DUPLICATE_EVENT").alias("is_duplicate"))


@query(
    "sm3_streaming_rate_limit",
    with_ctes("", "request_events", recursive=True).rstrip()
    + f", {sql_rate_fold('(SELECT * FROM request_events WHERE NOT is_broken)')}"
    + " SELECT arrival_no, driver_id, accepted FROM fold",
)
def sm3(spark, sf):
    base = scratch_path(spark, "sm3")
    parsed = ingest.parse_events(streaming.request_stream(spark, *_request_files(spark, sf))).filter("is_json")
    narrow = parsed.select("arrival_no", "arrival_ms", "driver_id")
    streaming.finish(streaming.limit_rate_stream(narrow, base, f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/decided").select("arrival_no", "driver_id", "accepted")


@query("sm3_streaming_outcomes", sql_outcomes(f"SELECT arrival_no, reason, {_OUTCOME} AS outcome FROM reasons"))
def sm3_outcomes(spark, sf):
    """Every request has its outcome, also over the borders of micro-batches: as in one batch."""
    outcomes = spark.read.option("recursiveFileLookup", "true").parquet(f"{_streamed(spark, sf, 'sm3o')}/outcomes")
    return outcomes.select("arrival_no", "reason", "outcome")


@query(
    "sm4_streaming_two_sinks",
    sql_outcomes(
        f"""SELECT 'bronze' AS sink, event_id, NULL AS _dlq_reason, NULL::boolean AS has_text_speed FROM reasons WHERE reason = 'OK'
            UNION ALL SELECT 'dlq', event_id, _dlq_reason, has_text_speed FROM ({_LETTERS})"""
    ),
)
def sm4(spark, sf):
    base = _streamed(spark, sf, "sm4")
    good = readers.read_raw_events(spark, f"{base}/bronze").select(F.lit("bronze").alias("sink"), "event_id")
    bad = _letter_marks(readers.read_dead_letters(spark, f"{base}/dead_letters"))
    return good.unionByName(
        bad.select(F.lit("dlq").alias("sink"), "event_id", "_dlq_reason", "has_text_speed"), allowMissingColumns=True
    )


@query("sm5_streaming_counters", ORACLES["ag28_outcome_counters"])
def sm5(spark, sf):
    """The five counters, equal to those of the batch."""
    return streaming.stream_counters(spark, _streamed(spark, sf, "sm5"))


@query(
    "snk6_streaming_bronze",
    with_ctes(
        "SELECT event_id, count(*) AS n FROM request_events WHERE NOT is_broken GROUP BY event_id", "request_events"
    ),
)
def snk6(spark, sf):
    base = scratch_path(spark, "snk6")
    parsed = ingest.parse_events(streaming.request_stream(spark, *_request_files(spark, sf))).filter("is_json")
    events = parsed.drop("arrival_no", "arrival_ms", "signature", "is_json", "_schema_ok", "arrived_at", "body")
    streaming.finish(streaming.write_bronze_stream(events, f"{base}/out", f"{base}/checkpoint"))
    return spark.read.schema(events.schema).parquet(f"{base}/out").groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n")
    )
