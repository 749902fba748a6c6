"""Deduplication, filters and projections of the cleaning step."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milemark.schemas import CLEANED_ENUMS, ENUM_DOMAINS

# Plausible ranges, both ends included.
LAT_RANGE = (-90.0, 90.0)
LON_RANGE = (-180.0, 180.0)
SPEED_RANGE = (0.0, 80.0)
MAX_ABS_ACCEL = 12.0
MAX_HEADING = 360.0

# The earliest arrival of an event wins; what copies may differ in besides decides in ``copy_order``.
FIRST_COPY_ORDER = [
    "ingestion_ts", "ts", "lat", "lon", "speed_mps", "accel_mps2", "gyro", "heading",
    "odometer_km", "source", "vehicle_type",
]


def copy_order(columns: list[str]) -> list[str]:
    """A total order of different copies: the stated columns first, then all others by name."""
    first = [c for c in FIRST_COPY_ORDER if c in columns]
    return [*first, *sorted(c for c in columns if c not in first and c != "event_id")]


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in ``order`` (nulls first).

    ``row_number() = 1`` lets Spark keep one row per key already before the shuffle, so a key with
    very many copies sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("_copy", F.row_number().over(window)).filter("_copy = 1").drop("_copy")


def dedup_events(events: DataFrame, order: list[str] | None = None) -> DataFrame:
    return keep_first(events, ["event_id"], order or copy_order(events.columns))


def in_plausible_range(
    lat: tuple[float, float] = LAT_RANGE,
    lon: tuple[float, float] = LON_RANGE,
    speed: tuple[float, float] = SPEED_RANGE,
    max_abs_accel: float = MAX_ABS_ACCEL,
) -> Column:
    """A missing reading is not in range; that includes a missing acceleration."""
    return (
        F.col("lat").between(*lat)
        & F.col("lon").between(*lon)
        & F.col("speed_mps").between(*speed)
        & F.col("accel_mps2").between(-max_abs_accel, max_abs_accel)
    )


def sanity_filter(events: DataFrame, **limits) -> DataFrame:
    return events.filter(in_plausible_range(**limits))


def heading_filter(events: DataFrame, max_heading: float = MAX_HEADING) -> DataFrame:
    """0 ≤ heading < max; a missing heading stays."""
    heading = F.col("heading")
    return events.filter(heading.isNull() | ((heading >= 0) & (heading < max_heading)))


def _in_domain(name: str) -> Column:
    return F.col(name).isNull() | F.col(name).isin(ENUM_DOMAINS[name])


def drop_bad_enums(events: DataFrame, columns: list[str] = CLEANED_ENUMS) -> DataFrame:
    """Keep rows whose enumerated columns are null or legal; absent columns are not checked."""
    for name in columns:
        if name in events.columns:
            events = events.filter(_in_domain(name))
    return events


def remap_bad_enums(
    events: DataFrame, columns: list[str] = CLEANED_ENUMS, replacement: str = "OTHER"
) -> DataFrame:
    """Replace illegal symbols by one literal, even where the domain has no such symbol."""
    present = [c for c in columns if c in events.columns]
    return events.withColumns(
        {c: F.when(_in_domain(c), F.col(c)).otherwise(F.lit(replacement)) for c in present}
    )


def claimants(training: DataFrame, label: str = "claim_occurred") -> DataFrame:
    """Rows with a claim: the input of the severity models."""
    return training.filter(F.col(label).cast("boolean"))


def over_known_limit(events: DataFrame) -> DataFrame:
    """Events with a known speed limit that the speed exceeds."""
    limit = F.col("posted_speed_limit")
    return events.filter(limit.isNotNull() & (F.col("speed_mps") > limit))


# Label columns, preferred name first.
LABEL_NAMES = ["had_claim_within_30d", "claim_occurred"]
AMOUNT_NAMES = ["claim_severity", "claim_amount"]

# Columns that identify a row or tell where it came from, never features.
NON_FEATURES = ["driver_id", "generation_version", "run_date"]


def unify_label_names(training: DataFrame) -> DataFrame:
    """Rename ``claim_occurred`` / ``claim_amount`` to the names the models expect, and insist on them."""
    renamed = training.withColumnsRenamed(
        {"claim_occurred": "had_claim_within_30d", "claim_amount": "claim_severity"}
    )
    missing = [c for c in ("had_claim_within_30d", "claim_severity") if c not in renamed.columns]
    if missing:
        raise ValueError(f"training set lacks label columns: {', '.join(missing)}")
    return renamed


def label_columns(columns: list[str]) -> tuple[str | None, str | None]:
    """(claim column, amount column) by preference, ``None`` where neither name is present."""
    claim = next((c for c in LABEL_NAMES if c in columns), None)
    amount = next((c for c in AMOUNT_NAMES if c in columns), None)
    return claim, amount


def numeric_features(df: DataFrame) -> list[str]:
    """Names of the model inputs: numeric columns that are neither id, label nor lineage."""
    excluded = set(NON_FEATURES + LABEL_NAMES + AMOUNT_NAMES)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in excluded
    ]


def feature_frame(df: DataFrame) -> DataFrame:
    return df.select(*numeric_features(df))


def illegal_symbols(events: DataFrame, column: str = "source") -> DataFrame:
    """Distinct non-null values outside the column's domain."""
    return (
        events.select(F.col(column).alias("value"))
        .filter(F.col("value").isNotNull() & ~F.col("value").isin(ENUM_DOMAINS[column]))
        .distinct()
    )


def values_in_domain(df: DataFrame, column: str, domain: DataFrame, domain_column: str) -> DataFrame:
    """Semi-join against a domain table too long for a literal list."""
    return df.join(domain, df[column] == domain[domain_column], "left_semi")


def values_outside_domain(df: DataFrame, column: str, domain: DataFrame, domain_column: str) -> DataFrame:
    """Anti-join: non-null values that the domain table lacks."""
    known = df.filter(F.col(column).isNotNull())
    return known.join(domain, known[column] == domain[domain_column], "left_anti")


def union_tables(tables: list[DataFrame]) -> DataFrame:
    """Union-all by column name; columns a table lacks are null there."""
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table, allowMissingColumns=True)
    return out


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """A report's sample: the first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)
