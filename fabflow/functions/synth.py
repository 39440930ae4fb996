"""Seeded draws as Column expressions, and telemetry synthesis as one projection.

A draw depends only on (seed, row id, stream), never on partitioning or task
order: ``u = (first 32 bits of md5("seed:row:stream") + 0.5) / 2^32``. Other
distributions are built from such uniforms (Box-Muller normal, inverse-CDF
Poisson, order-statistic Beta with integer shape), so the same text runs in
any engine with ``md5``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabflow import constants as C
from fabflow.functions.scalar import format_wafer_id

TWO32 = 4294967296.0
DEFAULT_BASE_TIME = "2024-02-01 00:00:00"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def uniform(seed: int, row, stream) -> Column:
    """U(0, 1) draw for (seed, row, stream); ``stream`` is an int/str or a Column."""
    s = stream if isinstance(stream, Column) else F.lit(str(stream))
    key = F.concat(F.lit(f"{seed}:"), _c(row).cast("string"), F.lit(":"), s.cast("string"))
    return (F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(TWO32)


def uniform_between(lo: float, hi: float, seed: int, row, stream) -> Column:
    return F.lit(float(lo)) + F.lit(float(hi - lo)) * uniform(seed, row, stream)


def normal(mean: float, std: float, seed: int, row, stream: int) -> Column:
    """N(mean, std) by Box-Muller from streams ``stream`` and ``stream + 1``."""
    u1, u2 = uniform(seed, row, stream), uniform(seed, row, stream + 1)
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    return F.lit(float(mean)) + F.lit(float(std)) * z


def poisson_cdf(lam: float, eps: float = 1e-12) -> list[float]:
    """Cumulative Poisson probabilities P(X <= k), k = 0.. until within eps of 1."""
    out, p, acc, k = [], math.exp(-lam), 0.0, 0
    while True:
        acc += p
        out.append(acc)
        if acc >= 1.0 - eps or k > 1000:
            return out
        k += 1
        p = p * lam / k


def poisson(lam: float, seed: int, row, stream) -> Column:
    """Poisson(lam) by inverse CDF: the first k with u < P(X <= k).

    Written branch-free as the number of cumulative probabilities <= u, so the
    draw is computed once per row (no per-branch re-evaluation).
    """
    u = uniform(seed, row, stream)
    hits = [(u >= F.lit(c)).cast("int") for c in poisson_cdf(lam)]
    total = hits[0]
    for h in hits[1:]:
        total = total + h
    return total.cast("bigint")


def beta_int(a: int, b: int, seed: int, row, stream: int) -> Column:
    """Beta(a, b) for integer shapes: the a-th smallest of n = a + b - 1 uniforms.

    Uniform order statistics counted from the top (Renyi representation):
    X(n) = U1^(1/n), X(n-1) = X(n) * U2^(1/(n-1)), ... so X(a) needs only b
    uniforms and b powers, not n draws and a sort.
    """
    n = a + b - 1
    x = F.lit(1.0)
    for j in range(b):
        x = x * F.pow(uniform(seed, row, f"{stream}.{j + 1}"), F.lit(1.0 / (n - j)))
    return x


def choice(values: list, seed: int, row, stream) -> Column:
    """Uniform pick from a fixed list."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(uniform(seed, row, stream) * len(values)) + 1).cast("int"))


def synth_telemetry(ids: DataFrame, id_col: str = "id", seed: int = 42,
                    base_time: str = DEFAULT_BASE_TIME) -> DataFrame:
    """One synthetic telemetry row per id: a single projection (no shuffle).

    Timestamps count back one second per ordinal from a fixed base, so ids
    from different batches never overlap in time.
    """
    i = F.col(id_col)
    return ids.select(
        (F.lit(base_time).cast("timestamp_ntz") - F.make_dt_interval(secs=i)).alias("timestamp"),
        format_wafer_id(i).alias("wafer_id"),
        choice(C.VALID_EQUIPMENT, seed, i, 1).alias("equipment_id"),
        normal(C.TEMP_MEAN, C.TEMP_STD, seed, i, 2).alias("temperature_c"),
        normal(C.PRESSURE_MEAN, C.PRESSURE_STD, seed, i, 4).alias("pressure_torr"),
        (F.lit(C.YIELD_OFFSET) + F.lit(C.YIELD_SCALE) * beta_int(*C.YIELD_BETA, seed, i, 6)).alias("yield_rate"),
        poisson(C.DEFECT_LAMBDA, seed, i, 7).alias("defect_count"),
        F.lit(False).alias("is_anomaly"),
    )


def inject_anomalies(df: DataFrame, rate: float = C.ANOMALY_RATE, seed: int = 42, key: str = "wafer_id") -> DataFrame:
    """Exactly floor(rows * rate) rows (seeded hash order) get one of four anomaly types.

    The anomaly value replaces the reading: spike/drop = 350 +/- U(15, 25),
    pressure = 10 +/- U(3, 5), burst = 10..30 defects with yield U(0.5, 0.7).
    """
    from fabflow.operators.sorting import exact_sample
    chosen = exact_sample(df.select(key), rate, key, seed).select(key, F.lit(True).alias("_sel"))
    k = F.col(key)
    kind = choice(C.ANOMALY_TYPES, seed, k, "kind")
    sign = choice([-1.0, 1.0], seed, k, "sign")
    from fabflow.operators.joins import join_small
    j = join_small(df, chosen, key, "left").withColumn("_kind", F.when(F.col("_sel"), kind))
    t, p = F.col("_kind"), F.lit(C.TEMP_MEAN)
    return j.select(
        "timestamp", key, "equipment_id",
        F.when(t == "temp_spike", p + uniform_between(15, 25, seed, k, "mag"))
         .when(t == "temp_drop", p - uniform_between(15, 25, seed, k, "mag"))
         .otherwise(F.col("temperature_c")).alias("temperature_c"),
        F.when(t == "pressure_fluctuation", F.lit(C.PRESSURE_MEAN) + sign * uniform_between(3, 5, seed, k, "mag"))
         .otherwise(F.col("pressure_torr")).alias("pressure_torr"),
        F.when(t == "defect_burst", uniform_between(0.5, 0.7, seed, k, "yield")).otherwise(F.col("yield_rate"))
         .alias("yield_rate"),
        F.when(t == "defect_burst", (F.lit(10) + F.floor(uniform(seed, k, "count") * 21)).cast("bigint"))
         .otherwise(F.col("defect_count")).alias("defect_count"),
        F.coalesce(F.col("_sel"), F.lit(False)).alias("is_anomaly"),
    ).select(*df.columns)


def golden_pattern(ids: DataFrame, id_col: str = "id", base_time: str = DEFAULT_BASE_TIME) -> DataFrame:
    """Closed-form deterministic messages for ordinal i (exact expected values)."""
    i = F.col(id_col)
    # The pattern's starting values, steps and periods.
    return ids.select(
        (F.lit(base_time).cast("timestamp_ntz") - F.make_dt_interval(secs=i)).alias("timestamp"),
        format_wafer_id(i).alias("wafer_id"),
        F.concat(F.lit("EQ00"), (i % 4 + 1).cast("string")).alias("equipment_id"),
        (F.lit(350.0) + i % 10).cast("double").alias("temperature_c"),
        (F.lit(10.0) + F.lit(0.1) * (i % 5)).alias("pressure_torr"),
        (F.lit(0.95) - F.lit(0.01) * (i % 10)).alias("yield_rate"),
        (i % 5).cast("bigint").alias("defect_count"),
        F.lit(False).alias("is_anomaly"),
    )


def generate_batch(spark, num_records: int, start_id: int = 0, inject: bool = True,
                   rate: float = C.ANOMALY_RATE, seed: int = 42, base_time: str = DEFAULT_BASE_TIME) -> DataFrame:
    """``num_records`` synthetic readings with ordinals start_id.. (one projection over ``range``)."""
    ids = spark.range(start_id, start_id + num_records)
    df = synth_telemetry(ids, "id", seed, base_time)
    return inject_anomalies(df, rate, seed) if inject and rate > 0 else df


def generate_to_json(spark, total_records: int, path: str, seed: int = 42, inject: bool = True,
                     encoding: str = "iso") -> None:
    """Synthesize ``total_records`` readings and write them as JSON lines in one distributed job.

    No driver-side batching: ``range`` is split into tasks, each task draws
    and writes its own slice.
    """
    from fabflow.sinks.files import write_json_lines
    write_json_lines(generate_batch(spark, total_records, 0, inject, seed=seed), path, encoding=encoding)
