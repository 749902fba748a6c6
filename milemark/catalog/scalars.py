"""Queries for the column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from milemark.catalog import inputs
from milemark.catalog.registry import gold, query, r, rounded, silver, silver_trips, sql_uniform, training, with_ctes
from milemark.functions import actuarial, driving, hashing
from milemark.operators import features, labels
from milemark.operators.labels import SEED

_TS = "make_timestamp(ts * 1000)"


@query(
    "fn1_event_date",
    with_ctes(
        f"SELECT event_id, ingestion_ts, ts, strftime({_TS}, '%Y-%m-%d') AS event_date FROM telemetry", "telemetry"
    ),
)
def fn1(spark, sf):
    return inputs.telemetry(spark, sf).select(
        "event_id", "ingestion_ts", "ts", driving.event_date(F.col("ts")).alias("event_date")
    )


@query(
    "fn2_hour",
    with_ctes(f"SELECT event_id, ingestion_ts, hour({_TS}) AS hour FROM telemetry", "telemetry"),
)
def fn2(spark, sf):
    return inputs.telemetry(spark, sf).select(
        "event_id", "ingestion_ts", driving.hour_of_day(F.col("ts")).alias("hour")
    )


@query(
    "fn3_weekday",
    with_ctes(f"SELECT event_id, ingestion_ts, isodow({_TS}) - 1 AS weekday FROM telemetry", "telemetry"),
)
def fn3(spark, sf):
    return inputs.telemetry(spark, sf).select(
        "event_id", "ingestion_ts", driving.weekday(F.col("ts")).alias("weekday")
    )


def _flag_query(name: str, *flags: str) -> None:
    @query(name, with_ctes(f"SELECT event_id, ts, {', '.join(flags)} FROM flagged", "flagged"))
    def flag(spark, sf):
        return features.with_flags(silver(spark, sf)).select("event_id", "ts", *flags)


_flag_query("fn4_night_flag", "is_night")
_flag_query("fn5_weekend_flag", "is_weekend")
_flag_query("fn6_harsh_flags", "is_harsh_brake", "is_harsh_accel")
_flag_query("fn7_overspeed_flag", "is_overspeed")


@query(
    "fn7_overspeed_flag_kmh",
    with_ctes(
        """SELECT event_id, ts, coalesce(speed_mps > posted_speed_limit / 3.6::double + 5 / 3.6::double, false)
           AS is_overspeed FROM silver""",
        "silver",
    ),
)
def fn7_kmh(spark, sf):
    return features.with_flags(silver(spark, sf), limit_unit="kmh").select("event_id", "ts", "is_overspeed")


@query(
    "fn8_trip_arithmetic",
    with_ctes(
        f"""SELECT driver_id, trip_id, {r('trip_duration_sec')} AS trip_duration_sec,
            {r('trip_distance_km')} AS trip_distance_km, {r('avg_speed_calc', 4)} AS avg_speed_calc FROM trips""",
        "trips",
    ),
)
def fn8(spark, sf):
    return silver_trips(spark, sf).select(
        "driver_id", "trip_id", F.round("trip_duration_sec", 6).alias("trip_duration_sec"),
        F.round("trip_distance_km", 6).alias("trip_distance_km"), F.round("avg_speed_calc", 4).alias("avg_speed_calc"),
    )


@query(
    "fn9_logistic_logit",
    with_ctes(
        f"""SELECT driver_id, {r('1 / (1 + exp(-c))', 9)} AS logistic, {r('ln(p / (1 - p))', 9)} AS logit
            FROM (SELECT driver_id, severity_raw / 1000 AS c, (p_raw + 0.2::double) / 1.5::double AS p FROM risk_in)""",
        "risk_in",
    ),
)
def fn9(spark, sf):
    p = (F.col("p_raw") + 0.2) / 1.5
    return rounded(
        inputs.risk_in(spark, sf).select(
            "driver_id",
            actuarial.logistic(F.col("severity_raw") / 1000).alias("logistic"),
            actuarial.logit(p).alias("logit"),
        ),
        9,
    )


@query(
    "fn10_claim_probability",
    with_ctes(
        f"""SELECT driver_id, {r('0.6::double * coalesce(harsh_brake_rate, 0) + 0.6::double * coalesce(harsh_accel_rate, 0)'
              ' + 0.2::double * coalesce(night_trip_ratio, 0) + 0.001::double * coalesce(trip_count, 0)', 9)} AS risk_score,
            {r('p', 9)} AS claim_probability, 0.2::double AS flat_probability FROM probable""",
        "probable",
    ),
)
def fn10(spark, sf):
    return rounded(
        gold(spark, sf).select(
            "driver_id",
            actuarial.risk_score().alias("risk_score"),
            actuarial.claim_probability().alias("claim_probability"),
            actuarial.claim_probability(use_feature_weights=False).alias("flat_probability"),
        ),
        9,
    )


@query(
    "fn11_bernoulli",
    with_ctes(
        f"""SELECT driver_id, {r(sql_uniform('driver_id', SEED, 'claim'), 12)} AS u, claim_occurred
            FROM training""",
        "training",
    ),
)
def fn11(spark, sf):
    return training(spark, sf).select(
        "driver_id",
        F.round(hashing.uniform(F.col("driver_id"), SEED, "claim"), 12).alias("u"),
        "claim_occurred",
    )


@query(
    "fn12_gamma",
    with_ctes(
        f"""SELECT driver_id, {r(f"-500.0::double * (ln({sql_uniform('driver_id', SEED, 'severity0')}) + ln({sql_uniform('driver_id', SEED, 'severity1')}))")}
            AS severity FROM gold""",
        "gold",
    ),
)
def fn12(spark, sf):
    draw = hashing.gamma(F.col("driver_id"), SEED, labels.GAMMA_SHAPE, labels.GAMMA_SCALE)
    return rounded(gold(spark, sf).select("driver_id", draw.alias("severity")))


@query(
    "fn12_gamma_any_shape",
    with_ctes("SELECT count(*) AS n, true AS positive, true AS mean_ok, true AS variance_ok FROM gold", "gold"),
)
def fn12_any(spark, sf):
    """A shape that is no integer needs rejection sampling, over Arrow batches; checked by its moments: the mean k s and
    the variance k s² within five standard errors."""
    shape, scale = 2.5, labels.GAMMA_SCALE
    x = F.col("severity")
    drawn = gold(spark, sf).select(hashing.gamma(F.col("driver_id"), SEED, shape, scale).alias("severity"))
    n = F.count(x)
    return drawn.agg(
        n.alias("n"), (F.min(x) > 0).alias("positive"),
        (F.abs(F.avg(x) - shape * scale) <= 5 * scale * shape**0.5 / F.sqrt(n)).alias("mean_ok"),
        (F.abs(F.var_pop(x) - shape * scale**2) <= 5 * shape * scale**2 * (2 + 6 / shape) ** 0.5 / F.sqrt(n)).alias("variance_ok"),
    )


@query(
    "fn13_claim_amount",
    with_ctes(f"SELECT driver_id, claim_occurred, {r('claim_amount')} AS claim_amount FROM training", "training"),
)
def fn13(spark, sf):
    return rounded(training(spark, sf).select("driver_id", "claim_occurred", "claim_amount"))


_CLIPPED = "least(greatest(p_raw, 0), 1)"


@query(
    "fn14_clipped_scores",
    with_ctes(
        f"""SELECT driver_id, {_CLIPPED} AS p_claim_30d, greatest(severity_raw, 0) AS severity_pred
            FROM risk_in""",
        "risk_in",
    ),
)
def fn14(spark, sf):
    return labels.clip_scores(inputs.risk_in(spark, sf)).select("driver_id", "p_claim_30d", "severity_pred")


@query(
    "fn15_probability_of_margin",
    with_ctes(f"SELECT driver_id, {r('1 / (1 + exp(-(p_raw * 4 - 2)))', 9)} AS p FROM risk_in", "risk_in"),
)
def fn15(spark, sf):
    from pyspark.ml.functions import array_to_vector

    from milemark.models.scoring import probability_of_margin

    margin = F.col("p_raw") * 4 - 2
    raw = inputs.risk_in(spark, sf).select(
        "driver_id", array_to_vector(F.array(-margin, margin)).alias("rawPrediction")
    )
    return rounded(raw.select("driver_id", probability_of_margin(F.col("rawPrediction")).alias("p")), 9)


@query(
    "fn16_expected_loss",
    with_ctes(
        f"SELECT driver_id, {r(f'{_CLIPPED} * greatest(severity_raw, 0)')} AS expected_loss FROM risk_in", "risk_in"
    ),
)
def fn16(spark, sf):
    scores = labels.with_expected_loss(labels.clip_scores(inputs.risk_in(spark, sf)))
    return rounded(scores.select("driver_id", "expected_loss"))


@query(
    "fn17_premium",
    with_ctes(
        f"SELECT driver_id, {r(f'{_CLIPPED} * greatest(severity_raw, 0) * 1.35::double')} AS premium FROM risk_in",
        "risk_in",
    ),
)
def fn17(spark, sf):
    scores = labels.with_expected_loss(labels.clip_scores(inputs.risk_in(spark, sf)))
    return rounded(labels.with_premium(scores).select("driver_id", "premium"))


@query("fn18_residual", with_ctes(f"SELECT row_id, {r('y_true - y_pred')} AS residual FROM reg_preds", "reg_preds"))
def fn18(spark, sf):
    return rounded(
        inputs.reg_preds(spark, sf).select("row_id", actuarial.residual(F.col("y_true"), F.col("y_pred")).alias("residual"))
    )


# HMAC by its definition: the key is ASCII and shorter than a block, so its padded form is text.
def _sql_pad(value: int) -> str:
    return (
        "rpad(array_to_string(list_transform(string_split(secret, ''), "
        f"lambda c: chr(xor(ascii(c), {value}))), ''), 64, chr({value}))"
    )


SQL_HMAC = (
    f"sha256(encode({_sql_pad(0x5C)}) || unhex(sha256(encode({_sql_pad(0x36)}) || encode(body))))"
)


@query(
    "fn19_signature",
    with_ctes(
        f"""SELECT arrival_no, CASE WHEN secret IS NOT NULL THEN {SQL_HMAC} END AS expected,
              coalesce({SQL_HMAC} = signature, false) AS authorized
            FROM (SELECT arrival_no, concat('body-', arrival_no, '-', driver_id) AS body, driver_id,
                    md5(cast(arrival_no AS varchar)) AS signature FROM arrivals)
            LEFT JOIN device_keys USING (driver_id)""",
        "arrivals", "device_keys",
    ),
)
def fn19(spark, sf):
    bodies = inputs.arrivals(spark, sf).select(
        "arrival_no", "driver_id",
        F.concat(F.lit("body-"), F.col("arrival_no").cast("string"), F.lit("-"), F.col("driver_id")).alias("body"),
        F.md5(F.col("arrival_no").cast("string")).alias("signature"),
    )
    joined = bodies.join(hashing.hmac_pads(inputs.device_keys(spark, sf)), "driver_id", "left")
    pads = F.col("inner_pad"), F.col("outer_pad")
    return joined.select(
        "arrival_no",
        hashing.hmac_sha256(*pads, F.col("body")).alias("expected"),
        hashing.signature_ok(*pads, F.col("body"), F.col("signature")).alias("authorized"),
    )


@query(
    "fn20_pseudonym",
    with_ctes(
        "SELECT driver_id, substr(sha1(concat_ws('-', driver_id, '7')), 1, 12) AS vehicle_vin_hash FROM risk_in",
        "risk_in",
    ),
)
def fn20(spark, sf):
    return inputs.risk_in(spark, sf).select(
        "driver_id", hashing.pseudonym(F.col("driver_id"), F.lit(7)).alias("vehicle_vin_hash")
    )


_DIGEST = "md5(concat_ws('|', coalesce(length(driver_id) || '=' || driver_id, '~'), coalesce(length(secret) || '=' || secret, '~')))"


@query(
    "fn21_data_fingerprint",
    with_ctes(
        f"""SELECT n AS rows, substr(sha256(concat_ws('|', n::varchar, total::varchar)), 1, 16) AS data_hash FROM (
              SELECT count(*) AS n, sum(cast('0x' || substr({_DIGEST}, 1, 15) AS bigint)::hugeint) AS total
              FROM device_keys)""",
        "device_keys",
    ),
)
def fn21(spark, sf):
    return hashing.table_fingerprint(inputs.device_keys(spark, sf), ["driver_id", "secret"])


@query(
    "fn22_standardized",
    with_ctes(
        f"""SELECT driver_id, {r('(p_raw - m) / s', 9)} AS p_raw, {r('(severity_raw - ms) / ss', 9)} AS severity_raw
            FROM risk_in, (SELECT avg(p_raw) AS m, stddev_pop(p_raw) AS s, avg(severity_raw) AS ms,
              stddev_pop(severity_raw) AS ss FROM risk_in)""",
        "risk_in",
    ),
)
def fn22(spark, sf):
    return rounded(labels.standardize(inputs.risk_in(spark, sf), ["p_raw", "severity_raw"]), 9)


@query(
    "fn23_rounded_report",
    with_ctes(
        """SELECT round(avg(y_true), 2) AS mean_true, round(avg(y_pred), 3) AS mean_pred,
           round(stddev_samp(y_pred), 4) AS std_pred FROM reg_preds""",
        "reg_preds",
    ),
)
def fn23(spark, sf):
    return inputs.reg_preds(spark, sf).agg(
        F.round(F.avg("y_true"), 2).alias("mean_true"),
        F.round(F.avg("y_pred"), 3).alias("mean_pred"),
        F.round(F.stddev_samp("y_pred"), 4).alias("std_pred"),
    )
