"""Best-of choices: top rows, depth selection with amplitude rules, choice between probes and methods.

``row_number() <= k`` is planned by Spark with a limit per group before the shuffle, so the rows of a
very large group never meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_rows(df: DataFrame, keys: list[str], order: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k).drop("_rank")


def top_peaks(samples: Column, k: int, threshold: float) -> Column:
    """The k highest local maxima at or above a threshold, highest first, as (height, index) structs."""
    last = F.size(samples) - 1

    def is_peak(x: Column, i: Column) -> Column:
        before, after = F.get(samples, i - 1), F.get(samples, i + 1)
        return (x >= threshold) & (i > 0) & (i < last) & (x > before) & (x > after)

    indexed = F.transform(samples, lambda x, i: F.struct((-x).alias("neg"), i.alias("index"), is_peak(x, i).alias("peak")))
    peaks = F.array_sort(F.filter(indexed, lambda e: e["peak"]))
    return F.transform(F.slice(peaks, 1, k), lambda e: F.struct((-e["neg"]).alias("height"), e["index"].alias("index")))


def drop_far_depths(df: DataFrame, keys: list[str], depth: str, tie: str, limit: float, top: int = 5) -> DataFrame:
    """Mark depths too far from the median of the deepest few.

    Adds ``reference`` and ``kept``; when every depth of a group is far from its reference all are kept. A missing depth is
    neither counted nor kept; a group without any depth has no reference.
    """
    known = F.col(depth).isNotNull()
    deepest = top_rows(df.where(known), keys, [F.col(depth).desc(), F.col(tie)], top)
    reference = deepest.groupBy(*keys).agg(F.percentile(depth, F.lit(0.5)).alias("reference"))
    marked = df.join(reference, keys, "left").withColumn("_near", F.coalesce(F.abs(F.col(depth) - F.col("reference")) <= limit, F.lit(False)))
    some = marked.groupBy(*keys).agg(F.max("_near").alias("_some"))
    return marked.join(some, keys).withColumn("kept", F.col("_near") | (known & ~F.col("_some"))).drop("_near", "_some")


def pick_depth(df: DataFrame, keys: list[str], depth: str, amp: str, frame: str, tie: str, ratio: float = 0.6, reach: int = 2) -> DataFrame:
    """Deepest row per group unless its amplitude is weak.

    If its amplitude is below ``ratio`` of the largest other one, the deepest row of sufficient amplitude
    within ``reach`` frames replaces it; without such a row the deepest one stays. Rows without a depth take no part;
    a group that has no depth keeps a row of NULLs.
    """
    row = F.struct(depth, amp, frame, tie)
    known = F.col(depth).isNotNull()
    rank = F.struct(F.col(depth), (-F.col(tie)).alias("neg"))
    deepest = df.groupBy(*keys).agg(F.max_by(row, F.when(known, rank)).alias("_top"))
    joined = df.join(deepest, keys)
    others = joined.groupBy(*keys).agg(F.max(F.when(known & (F.col(tie) != F.col(f"_top.{tie}")), F.col(amp))).alias("_other"))
    placed = joined.join(others, keys)
    strong = known & (F.col(amp) >= ratio * F.col("_other")) & (F.abs(F.col(frame) - F.col(f"_top.{frame}")) <= reach)
    chosen = placed.groupBy(*keys).agg(
        F.first("_top").alias("_top"), F.max("_other").alias("_other"), F.max_by(row, F.when(strong, rank)).alias("_alt")
    )
    weak = F.coalesce(F.col(f"_top.{amp}") < ratio * F.col("_other"), F.lit(False)) & F.col("_alt").isNotNull()
    pick = F.when(weak, F.col("_alt")).otherwise(F.col("_top"))
    return chosen.select(*keys, pick.alias("_pick"), weak.alias("by_amplitude")).select(*keys, "_pick.*", "by_amplitude")


def deeper_probe(first: Column, second: Column, names: tuple[str, str]) -> tuple[Column, Column]:
    """Depth and probe of the deeper of two probes; the second has to be strictly deeper."""
    wins = F.coalesce(second > first, first.isNull() & second.isNotNull())
    return F.when(wins, second).otherwise(first), F.when(wins, names[1]).when(first.isNotNull(), names[0])


def depth_source(final: Column, variants: dict[str, Column]) -> Column:
    """Which variant a chosen depth equals: echo-removed, inverted, both or the normal one."""
    removed = F.coalesce((final == variants["echo_removed"]) | (final == variants["both"]), F.lit(False))
    turned = F.coalesce((final == variants["inverted"]) | (final == variants["both"]), F.lit(False))
    return F.when(removed & turned, "both").when(removed, "echo_removed").when(turned, "inverted").otherwise("normal")
