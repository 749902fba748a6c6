"""Event validation, routing, contract checks and quality reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from milemark.schemas import ENUM_DOMAINS, EVENTS, REQUIRED_EVENT_COLUMNS, SILVER_EVENTS

OK = "OK"

# Limits of the ingest checks and the reasons reported, first failure first.
MAX_INGEST_ACCEL = 10.0
SAFETY_RATING_RANGE = (0, 5)
MODEL_YEAR_RANGE = (1980, 2025)
REASONS = [
    "SCHEMA_VALIDATION_FAILED",
    "MISSING_LAT_LON",
    "LAT_LON_OUT_OF_RANGE",
    "NEGATIVE_SPEED",
    "ACCEL_OUT_OF_RANGE",
    "HEADING_OUT_OF_RANGE",
    "INVALID_DRIVER_AGE_BAND",
    "INVALID_VEHICLE_TYPE",
    "INVALID_OWNERSHIP_TYPE",
    "INVALID_WEATHER",
    "INVALID_ROAD_TYPE",
    "INVALID_SAFETY_RATING",
    "INVALID_MODEL_YEAR",
    "INVALID_CRIME_INDEX",
    "INVALID_ACCIDENT_INDEX",
]

# Position and speed have reasons of their own, so only the other required columns are checked here.
_SCHEMA_CHECKED = [c for c in REQUIRED_EVENT_COLUMNS if c not in ("lat", "lon", "speed_mps")]


def _failures(columns: list[str], max_accel: float) -> dict[str, Column]:
    """Reason → condition under which an event fails; a null condition does not fail."""

    def c(name: str) -> Column:
        dtype = EVENTS[name].dataType
        return F.col(name) if name in columns else F.lit(None).cast(dtype)

    def bad_symbol(name: str) -> Column:
        return (c(name) != "") & ~c(name).isin(ENUM_DOMAINS[name])

    # ``source`` is the one enumerated column without a reason of its own
    schema_broken = ~c("source").isin(ENUM_DOMAINS["source"])
    for name in _SCHEMA_CHECKED:
        schema_broken = c(name).isNull() | schema_broken
    if "_schema_ok" in columns:
        schema_broken = schema_broken | ~F.col("_schema_ok")

    return dict(
        zip(
            REASONS,
            [
                schema_broken,
                c("lat").isNull() | c("lon").isNull(),
                ~(c("lat").between(-90, 90) & c("lon").between(-180, 180)),
                c("speed_mps").isNull() | (c("speed_mps") < 0),
                F.abs(c("accel_mps2")) > max_accel,
                ~((c("heading") >= 0) & (c("heading") < 360)),
                bad_symbol("driver_age_band"),
                bad_symbol("vehicle_type"),
                bad_symbol("ownership_type"),
                bad_symbol("weather"),
                bad_symbol("road_type"),
                ~c("safety_rating").between(*SAFETY_RATING_RANGE),
                ~c("vehicle_model_year").between(*MODEL_YEAR_RANGE),
                c("crime_index") < 0,
                c("accident_index") < 0,
            ],
            strict=True,
        )
    )


def failure_reason(columns: list[str], max_accel: float = MAX_INGEST_ACCEL) -> Column:
    """The first reason why an event with these columns fails, else ``OK``."""
    chain = F
    for reason, condition in _failures(columns, max_accel).items():
        chain = chain.when(condition, F.lit(reason))
    return chain.otherwise(F.lit(OK))


def validate(events: DataFrame, max_accel: float = MAX_INGEST_ACCEL) -> DataFrame:
    return events.withColumn("reason", failure_reason(events.columns, max_accel))


def route(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted events, dead letters with ``_dlq_reason``)."""
    good = validated.filter(F.col("reason") == OK).drop("reason")
    bad = validated.filter(F.col("reason") != OK).withColumnRenamed("reason", "_dlq_reason")
    return good, bad


def missing_columns(columns: list[str], contract: T.StructType = SILVER_EVENTS) -> list[str]:
    return [f.name for f in contract.fields if f.name not in columns]


def silver_report(events: DataFrame, contract: T.StructType = SILVER_EVENTS) -> DataFrame:
    """One row, one pass: violations of the ranges, illegal sources, missing columns."""
    lat, lon, source = F.col("lat"), F.col("lon"), F.col("source")
    illegal = F.when(~source.isin(ENUM_DOMAINS["source"]), source)
    return events.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col("speed_mps") < 0).alias("bad_speed"),
        F.count_if((lat < -90) | (lat > 90)).alias("bad_lat"),
        F.count_if((lon < -180) | (lon > 180)).alias("bad_lon"),
        F.count_if(illegal.isNotNull()).alias("bad_source_rows"),
        F.lit(",".join(missing_columns(events.columns, contract))).alias("missing_columns"),
    )


def illegal_sources(events: DataFrame) -> DataFrame:
    """(source, rows) of every source outside the domain."""
    illegal = events.filter(~F.col("source").isin(ENUM_DOMAINS["source"]))
    return illegal.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))


def contract_report(df: DataFrame, contract: T.StructType = EVENTS) -> DataFrame:
    """One row per contract column: present, expected and found type, optional or required, nulls found."""
    found = {f.name: f for f in df.schema.fields}
    rows = []
    for field in contract.fields:
        actual = found.get(field.name)
        rows.append(
            (
                field.name,
                "optional" if field.nullable else "required",
                actual is not None,
                field.dataType.simpleString(),
                actual.dataType.simpleString() if actual else None,
                actual is not None and actual.dataType == field.dataType,
                ",".join(ENUM_DOMAINS.get(field.name, [])) or None,
            )
        )
    declared = df.sparkSession.createDataFrame(
        rows,
        "column string, kind string, present boolean, expected_type string, found_type string, "
        "type_ok boolean, domain string",
    )
    return declared.join(null_report(df, contract).select("column", "nulls"), "column", "left")


def domain_report(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column, value, legal, rows) for every symbol found in the enumerated columns; one pass."""
    columns = columns or [c for c in ENUM_DOMAINS if c in df.columns]
    long = df.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(c).alias("value"),
                        F.col(c).isin(ENUM_DOMAINS[c]).alias("legal"),
                    )
                    for c in columns
                ]
            )
        ).alias("s")
    ).select("s.*")
    return (
        long.filter(F.col("value").isNotNull())
        .groupBy("column", "value", "legal")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def null_report(df: DataFrame, contract: T.StructType = EVENTS) -> DataFrame:
    """(column, required, nulls, ok): a required column must have no null."""
    present = [f for f in contract.fields if f.name in df.columns]
    counts = df.agg(*[F.count_if(F.col(f.name).isNull()).alias(f.name) for f in present])
    return counts.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f.name).alias("column"),
                        F.lit(not f.nullable).alias("required"),
                        F.col(f.name).alias("nulls"),
                        (F.lit(f.nullable) | (F.col(f.name) == 0)).alias("ok"),
                    )
                    for f in present
                ]
            )
        ).alias("s")
    ).select("s.*")


def training_consistency(training: DataFrame, manifest: DataFrame) -> DataFrame:
    """Row and positive counts of the training set against its manifest, with a verdict."""
    measured = training.agg(
        F.lit("data").alias("side"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("claim_occurred")).alias("positives"),
    )
    declared = manifest.select(
        F.lit("manifest").alias("side"),
        F.col("rows").cast("bigint").alias("rows"),
        F.col("positives").cast("bigint").alias("positives"),
    )

    def pick(side: str, column: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(column))).alias(f"{column}_{side}")

    sides = measured.unionByName(declared).agg(
        *[pick(side, column) for column in ("rows", "positives") for side in ("data", "manifest")]
    )
    return sides.select(
        "*",
        F.col("rows_data").eqNullSafe(F.col("rows_manifest")).alias("rows_ok"),
        # a manifest without the count of positives cannot contradict it
        F.coalesce(F.col("positives_data") == F.col("positives_manifest"), F.lit(True)).alias("positives_ok"),
    )


# Quality rules of the driver features.
RATE_COLUMNS = [
    "harsh_brake_rate", "harsh_accel_rate", "overspeed_rate", "night_trip_ratio", "weekend_trip_ratio",
]
NON_NEGATIVE_COLUMNS = ["trip_count", "total_km"]


def gold_rules(features: DataFrame) -> DataFrame:
    """(rule, violations, ok), one pass over the features."""
    rules = {f"{c} in [0,1]": ~F.col(c).between(0, 1) for c in RATE_COLUMNS}
    rules |= {f"{c} >= 0": F.col(c) < 0 for c in NON_NEGATIVE_COLUMNS}
    counted = features.agg(*[F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(rules.values())])
    pairs = ", ".join(f"'{name}', r{i}" for i, name in enumerate(rules))
    return counted.selectExpr(f"stack({len(rules)}, {pairs}) as (rule, violations)").withColumn(
        "ok", F.col("violations") == 0
    )
