"""Reflection tests of flaw A-scans against a surface A-scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import samples as sm
from .ordered import with_halo

# Noise level above which the tests become stricter, and by how much.
NOISE_STD, STRICTER_DIFF, STRICTER_RATIO = 1.6, 15, 0.06
SATURATED_HIGH, SATURATED_LOW = 220, 30


def std_pop(values: Column) -> Column:
    n = F.size(values)
    mean = sm.total(values) / n
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + (x - mean) * (x - mean)) / n)


def first_echo_tests(df: DataFrame, start: int, stop: int, diff_limit: float, ratio_limit: float, std_limit: float, open_limit: float) -> DataFrame:
    """Difference and ratio of the first echo of ``samples`` and ``reference`` in [start, stop]; what follows is the reflection window."""
    window = F.lit(start), F.lit(stop)
    flaw, surface = sm.time_slice(F.col("samples"), *window), sm.time_slice(F.col("reference"), *window)
    tail = sm.time_slice(F.col("samples"), F.lit(stop), F.size("samples") - 1)
    rows = df.withColumns(
        {"_smax": F.array_max(surface), "_smin": F.array_min(surface), "_fmax": F.array_max(flaw), "_fmin": F.array_min(flaw), "ref_std": std_pop(tail)}
    )
    diff = F.greatest(F.col("_smax") - F.col("_fmax"), F.col("_fmin") - F.col("_smin"))
    ratio = F.greatest(F.col("_fmax") / F.col("_smax"), F.col("_smin") / (F.col("_fmin") + 1))
    noisy = F.col("ref_std") > NOISE_STD
    by_ratio = ratio < F.when(noisy, ratio_limit + STRICTER_RATIO).otherwise(ratio_limit)
    by_diff = diff >= F.when(noisy, diff_limit - STRICTER_DIFF).otherwise(diff_limit)
    unsaturated = (F.col("_smax") < SATURATED_HIGH) & (F.col("_smin") > SATURATED_LOW)
    found = F.when(unsaturated, by_ratio).otherwise(by_diff) & (F.col("ref_std") >= std_limit)
    return rows.withColumns({"fwg_amp_diff": diff, "open_surface": diff >= open_limit, "reflection": found}).drop("_smax", "_smin", "_fmax", "_fmin")


def away_from_open_surface(df: DataFrame, frame_keys: list[str], reach: int = 1, block: int = 4096) -> DataFrame:
    """Adds ``reflection_kept``: reflections not at or next to an open surface."""
    near = F.col("open_surface").cast("int")
    marked = with_halo(df, frame_keys, "rotary_idx", reach, block, lambda w: {"_near": F.max(near).over(w.rowsBetween(-reach, reach))})
    return marked.withColumn("reflection_kept", F.col("reflection") & (F.col("_near") == 0)).drop("_near")


def count_reflections(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count_if("reflection").alias("n_reflections"), F.count_if("reflection_kept").alias("n_kept"), F.count_if("open_surface").alias("n_open"),
        F.max("fwg_amp_diff").alias("max_diff"),
    )
