"""The ingest path as one classification of requests: every request gets exactly one outcome."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milemark.functions.hashing import hmac_pads, signature_ok
from milemark.operators.arrivals import MAX_EVENTS_PER_WINDOW, WINDOW_MS, mark_duplicates, rate_limit
from milemark.operators.hot_keys import join_spread
from milemark.operators.recency import mark_repeats
from milemark.operators.validation import OK, failure_reason
from milemark.schemas import EVENTS
from milemark.session import store

_BODY_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType) for f in EVENTS.fields] + [T.StructField("_unfit", T.StringType())]
)


def parse_events(requests: DataFrame, body: str = "body") -> DataFrame:
    """Add the event columns of a JSON body, ``is_json``, and ``_schema_ok`` (every type fits).

    A malformed body keeps its row, with null columns.
    """
    parsed = F.from_json(F.col(body), _BODY_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_unfit"})
    taken = [f.name for f in EVENTS.fields]
    kept = [c for c in requests.columns if c not in taken]
    return (
        requests.select(*kept, F.try_parse_json(F.col(body)).isNotNull().alias("is_json"), parsed.alias("_event"))
        .select(*kept, "is_json", "_event.*")
        .withColumn("_schema_ok", F.col("_unfit").isNull())
        .drop("_unfit")
    )


def authenticate(
    parsed: DataFrame, device_keys: DataFrame, body: str = "body", signature: str = "signature"
) -> DataFrame:
    """Add ``is_authorized``. The device table grows with the fleet; requests of a busy driver are dealt to several
    tasks, see ``join_spread``, which passes over ``parsed`` twice."""
    joined = join_spread(parsed, hmac_pads(device_keys), "driver_id").select(*parsed.columns, "inner_pad", "outer_pad")
    ok = signature_ok(F.col("inner_pad"), F.col("outer_pad"), F.col(body), F.col(signature))
    return joined.withColumn("is_authorized", ok).drop("inner_pad", "outer_pad")


def classify(
    requests: DataFrame,
    device_keys: DataFrame,
    arrival_no: str = "arrival_no",
    arrival_ms: str = "arrival_ms",
    limit: int = MAX_EVENTS_PER_WINDOW,
    window_ms: int = WINDOW_MS,
    rate_limited: bool = True,
    seen: DataFrame | None = None,
    recent: DataFrame | None = None,
    capacity: int | None = None,
    cache: DataFrame | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = store,
) -> DataFrame:
    """Add ``outcome`` and ``reason`` to requests (arrival_no, arrival_ms, body, signature).

    The stages exclude each other in this order: malformed, unauthorised, duplicate, over the rate
    limit, failing validation, accepted. An id counts as seen even if its event fails later.
    An arrival without id is no duplicate; it fails validation. ``seen`` (event_id) and ``recent``
    (driver_id and arrival time of arrivals within the limit) carry on from earlier requests.
    With ``capacity`` an id counts as seen while it is among the last so many distinct ids, see
    ``recency.mark_repeats``; ``cache`` holds those of earlier requests.

    Parsed events are written once, so are authenticated ones, and so are the narrow candidates with their
    duplicate marks and the flags of those that were turned away (by ``keep``, which the caller may
    use to delete them after the job).
    """
    known = keep(authenticate(keep(parse_events(requests), "parsed"), device_keys), "requests")
    order = [arrival_ms, arrival_no]

    candidates = known.filter(F.col("is_json") & F.col("is_authorized")).select(
        *order, "event_id", "driver_id"
    )
    if capacity is None:
        repeated = mark_duplicates(candidates, order, seen=seen)
    else:
        repeated = mark_repeats(candidates, order, capacity=capacity, cache=cache, keep=keep)
    marked = keep(repeated, "candidates")
    flags = marked.filter("is_duplicate").select(F.col(arrival_no).alias("_no"), F.lit("DUPLICATE_EVENT").alias("_flag"))
    if rate_limited:
        admitted = rate_limit(
            marked.filter(~F.col("is_duplicate")).select(*order, "driver_id"),
            "driver_id", arrival_ms, [arrival_no], limit, window_ms, recent=recent,
        )
        over = admitted.filter(~F.col("accepted"))
        flags = flags.unionByName(
            over.select(F.col(arrival_no).alias("_no"), F.lit("RATE_LIMIT_EXCEEDED").alias("_flag"))
        )
    flags = keep(flags, "flags")
    flagged = known.join(flags, known[arrival_no] == flags["_no"], "left").drop("_no")
    reason = (
        F.when(~F.col("is_json"), F.lit("INVALID_JSON"))
        .when(~F.col("is_authorized"), F.lit("UNAUTHORIZED"))
        .when(F.col("_flag").isNotNull(), F.col("_flag"))
        .otherwise(failure_reason(flagged.columns))
    )
    outcome = (
        F.when(F.col("reason") == OK, F.lit("ACCEPTED"))
        .when(
            F.col("reason").isin("INVALID_JSON", "UNAUTHORIZED", "DUPLICATE_EVENT", "RATE_LIMIT_EXCEEDED"),
            F.col("reason"),
        )
        .otherwise(F.lit("REJECTED"))
    )
    return flagged.withColumn("reason", reason).withColumn("outcome", outcome).drop("_flag", "_schema_ok")


def accepted_events(classified: DataFrame) -> DataFrame:
    return classified.filter("outcome = 'ACCEPTED'").select(*[f.name for f in EVENTS.fields])


def dead_letters(classified: DataFrame) -> DataFrame:
    """Events that failed validation, with the reason and the body as it came: values that did not fit
    and fields outside the contract are in there. Other outcomes leave no dead letter."""
    return classified.filter("outcome = 'REJECTED'").select(
        *[f.name for f in EVENTS.fields], F.col("reason").alias("_dlq_reason"), F.col("body").alias("_original")
    )
