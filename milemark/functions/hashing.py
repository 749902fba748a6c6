"""Hash-based expressions: reproducible draws, signatures, pseudonyms, fingerprints.

Draws depend only on the row's key, a seed and a tag, so any partitioning gives the same result.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HEX_DIGITS = 13  # 52 bits: exactly representable in a double
_SCALE = float(16**_HEX_DIGITS)


def uniform(key: Column, seed: int, tag: str) -> Column:
    """In the open interval (0, 1)."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed)), F.lit(tag)))
    number = F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double")
    return (number + 0.5) / _SCALE


def bernoulli(p: Column, key: Column, seed: int, tag: str = "claim") -> Column:
    return uniform(key, seed, tag) < p


def gamma(key: Column, seed: int, shape: float, scale: float, tag: str = "severity") -> Column:
    """Gamma(shape, scale). Any integer shape is a sum of that many exponentials, with no Python involved."""
    if shape <= 0:
        raise ValueError("shape must be positive")
    if float(shape).is_integer():
        logs = [F.ln(uniform(key, seed, f"{tag}{i}")) for i in range(int(shape))]
        return sum(logs[1:], logs[0]) * F.lit(-float(scale))
    return _gamma_sampler(float(shape))(F.xxhash64(key.cast("string"), F.lit(seed), F.lit(tag))) * scale


def _gamma_sampler(shape: float):
    """Marsaglia and Tsang's rejection method (2000) over Arrow batches, seeded per row."""

    @F.pandas_udf("double")
    def sample(seeds: pd.Series) -> pd.Series:
        import numpy as np

        def mixed(counter):  # one 64-bit hash per row and counter (SplitMix64 finaliser)
            z = base + np.uint64(counter) * np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return ((z ^ (z >> np.uint64(31))) >> np.uint64(12)).astype("float64") / 2.0**52 + 2.0**-53

        base = seeds.to_numpy(dtype="int64").view("uint64")
        boost = shape < 1
        d = (shape + 1 if boost else shape) - 1.0 / 3.0
        c = 1.0 / np.sqrt(9.0 * d)
        out = np.full(len(base), np.nan)
        counter = 1
        while np.isnan(out).any():
            u1, u2, u3 = mixed(counter), mixed(counter + 1), mixed(counter + 2)
            counter += 3
            normal = np.sqrt(-2.0 * np.log(u1)) * np.cos(2.0 * np.pi * u2)
            v = (1.0 + c * normal) ** 3
            positive = v > 0
            log_v = np.log(np.where(positive, v, 1.0))
            accept = positive & (np.log(u3) < 0.5 * normal**2 + d - d * v + d * log_v) & np.isnan(out)
            out[accept] = d * v[accept]
        if boost:
            out *= mixed(0) ** (1.0 / shape)
        return pd.Series(out)

    return sample


def hmac_pads(secrets: DataFrame, key: str = "driver_id", secret: str = "secret") -> DataFrame:
    """Device table → (key, inner_pad, outer_pad): the two 64-byte padded keys of HMAC-SHA256.

    Computed once per device, so that verifying an event costs two native SHA-256 calls.
    Secrets longer than the 64-byte block are hashed first, as the standard demands.
    """
    raw = F.encode(F.col(secret), "UTF-8")
    block = F.when(F.length(raw) > 64, F.unhex(F.sha2(raw, 256))).otherwise(raw)
    digits = F.rpad(F.hex(block), 128, "0")
    words = [F.conv(F.substring(digits, i, 8), 16, 10).cast("bigint") for i in range(1, 129, 8)]

    def pad(byte: int) -> Column:
        mask = F.lit(byte * 0x01010101)
        return F.unhex(F.concat(*[F.lpad(F.hex(word.bitwiseXOR(mask)), 8, "0") for word in words]))

    return secrets.select(
        F.col(key), pad(0x36).alias("inner_pad"), pad(0x5C).alias("outer_pad"),
    )


def hmac_sha256(inner_pad: Column, outer_pad: Column, body: Column) -> Column:
    """Lower-case hex HMAC-SHA256 of ``body``; null when the pads are unknown."""
    inner = F.unhex(F.sha2(F.concat(inner_pad, F.encode(body, "UTF-8")), 256))
    return F.sha2(F.concat(outer_pad, inner), 256)


def signature_ok(inner_pad: Column, outer_pad: Column, body: Column, signature: Column) -> Column:
    """An unknown device or a missing signature is never authorised."""
    return F.coalesce(hmac_sha256(inner_pad, outer_pad, body) == signature, F.lit(False))


def pseudonym(identifier: Column, salt: Column) -> Column:
    """First 12 hex digits of the SHA-1 of ``identifier-salt``."""
    return F.substring(F.sha1(F.concat_ws("-", identifier.cast("string"), salt.cast("string"))), 1, 12)


def row_digest(columns: list[str]) -> Column:
    """MD5 of one row; every value comes with its length, and nulls are told apart from empty strings."""
    text = [F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.char_length(t).cast("string"), F.lit("="), t), F.lit("~")) for t in text]
    return F.md5(F.concat_ws("|", *parts))


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row (rows, data_hash): 16 hex digits that do not depend on row order."""
    digest = row_digest(columns or df.columns)
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(number), F.lit(0).cast("decimal(38,0)"))
    text = F.concat_ws("|", F.count(F.lit(1)).cast("string"), total.cast("string"))
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.substring(F.sha2(text, 256), 1, 16).alias("data_hash"),
    )


def config_fingerprint(config: dict) -> str:
    """MD5 of the canonical JSON text of a small settings dictionary."""
    import hashlib
    import json

    return hashlib.md5(json.dumps(config, sort_keys=True).encode()).hexdigest()
