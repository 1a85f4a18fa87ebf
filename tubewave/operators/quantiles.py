"""Exact quantiles per group for groups of any size.

Equal values are counted first (map-side), then only the few value ranges that hold a wanted rank are
looked at row by row. No task ever holds all values of a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, wanted: dict[str, float], width: float, frequency: str | None = None
) -> DataFrame:
    """Linearly interpolated quantiles, one row per group with one column per entry of ``wanted``.

    ``width`` is the size of a value range that comfortably fits one task; it affects speed only.
    NULL values do not count and groups without any value do not appear.
    """
    group = list(keys) or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(0))
    amount = F.sum(frequency) if frequency else F.count(F.lit(1))
    counts = (
        rows.where(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).cast("double").alias("_v"))
        .agg(amount.alias("_n"))
        .withColumn("_range", F.floor(F.col("_v") / width))
    )
    by_range = Window.partitionBy(*group).orderBy("_range")
    ranges = (
        counts.groupBy(*group, "_range")
        .agg(F.sum("_n").alias("_size"))
        .withColumn("_before", F.sum("_size").over(by_range) - F.col("_size"))
        .withColumn("_total", F.sum("_size").over(Window.partitionBy(*group)))
    )

    def position(q: float) -> Column:
        return (F.col("_total") - 1) * F.lit(float(q))

    def holds(start: Column, size: Column, rank: Column) -> Column:
        return (start <= rank) & (rank < start + size)

    wanted_here = F.lit(False)
    for q in wanted.values():
        for rank in (F.floor(position(q)), F.ceil(position(q))):
            wanted_here = wanted_here | holds(F.col("_before"), F.col("_size"), rank)
    inside = Window.partitionBy(*group, "_range").orderBy("_v")
    picked = (
        counts.join(ranges.where(wanted_here), [*group, "_range"])
        .withColumn("_start", F.col("_before") + F.sum("_n").over(inside) - F.col("_n"))
    )

    def at(rank: Column) -> Column:
        return F.max(F.when(holds(F.col("_start"), F.col("_n"), rank), F.col("_v")))

    parts: list[Column] = [F.max("_total").alias("_total")]
    for i, q in enumerate(wanted.values()):
        parts += [at(F.floor(position(q))).alias(f"_lo{i}"), at(F.ceil(position(q))).alias(f"_hi{i}")]
    found = picked.groupBy(*group).agg(*parts)
    columns = [
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (position(q) - F.floor(position(q)))).alias(name)
        for i, (name, q) in enumerate(wanted.items())
    ]
    return found.select(*keys, *columns)
