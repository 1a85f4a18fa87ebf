"""Wavegroup search report: one row per frame with the best box of each echo group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import Series, interpolate, numbered, runs
from .quantiles import exact_quantiles

GROUPS = ["G2", "G3", "G4"]


def out_of_order(ends: list[Column]) -> Column:
    missing = ends[0].isNull() | ends[1].isNull() | ends[2].isNull()
    return missing | F.coalesce((ends[0] > ends[1]) | (ends[1] > ends[2]), F.lit(False))


def search_report(frames: DataFrame, boxes: DataFrame) -> DataFrame:
    """Box of highest confidence (the first one on equal confidence) per frame and group, with flags.

    ``frames`` lists every frame, so frames without any box appear with everything missing.
    """
    aggregates = []
    for g in GROUPS:
        mine = F.col("cls") == g
        rank = F.when(mine, F.struct((-F.col("conf")).alias("neg"), "box_id"))
        aggregates.append(F.min_by(F.struct("box_start", "box_end"), rank).alias(g))
        aggregates.append(F.count_if(mine).alias(f"n_{g}"))
    best = boxes.groupBy("scan_id", "frame").agg(*aggregates)
    report = frames.join(best, ["scan_id", "frame"], "left")
    columns = []
    for g in GROUPS:
        name = g.lower()
        columns += [F.col(f"{g}.box_start").alias(f"{name}_start"), F.col(f"{g}.box_end").alias(f"{name}_end")]
    return report.select(
        "scan_id", "frame", *columns, *[(F.coalesce(f"n_{g}", F.lit(0)) == 0).alias(f"missing_{g.lower()}") for g in GROUPS],
        F.coalesce(F.greatest(*[F.col(f"n_{g}") for g in GROUPS]) > 1, F.lit(False)).alias("repeating_labels"),
        F.when(F.col("n_G2").isNull(), False).otherwise(out_of_order([F.col(f"{g}.box_end") for g in GROUPS])).alias("labels_not_in_order"),
    )


def frame_bounds(slices: DataFrame) -> DataFrame:
    """Pixel bounds per frame from its slice ranges; a frame without any range gives 0, 0."""
    per = slices.groupBy("scan_id", "frame").agg(F.min("start").alias("lower"), F.max("end").alias("upper"))
    return per.select("scan_id", "frame", *[F.coalesce(F.bround(c), F.lit(0)).cast("bigint").alias(c) for c in ("lower", "upper")])


def rotary_bands(ascans: DataFrame, frame_keys: list[str], bands: int) -> DataFrame:
    """A-scans with the number of their rotary band; positions behind the last full band are left out."""
    sizes = ascans.groupBy(*frame_keys).agg(F.floor(F.count(F.lit(1)) / bands).alias("_band"))
    placed = ascans.join(sizes.where("_band > 0"), frame_keys).withColumn("slice", F.floor(F.col("rotary_idx") / F.col("_band")))
    return placed.where(F.col("slice") < bands).drop("_band")


def rescore_frames(report: DataFrame, s: Series, skip: int, overlap: float) -> DataFrame:
    """Frames worth a second look: every ``skip``-th one of a run of frames without G4, or with much overlap."""
    marked = runs(report, s, F.col("missing_g4"))
    counted = numbered(marked, Series([*s.keys, "run"], s.order, s.chunk), "_n")
    again = (F.col("missing_g4") & (F.pmod(F.col("_n") - 1, F.lit(skip)) == 0)) | (F.col("overlap") > overlap)
    return counted.where(again).drop("_n", "run")


def impute_slices(rows: DataFrame, keys: list[str], limit: float, chunk: float, width: float, low: float = 0.25, high: float = 0.75) -> DataFrame:
    """Fill slice positions: drop those that end behind a limit and outliers, then interpolate along the frames."""
    kept = rows.withColumn("_v", F.when(F.col("end") <= limit, F.col("start")))
    q = exact_quantiles(kept, keys, "_v", {"_q1": low, "_q3": high}, width)
    spread = F.col("_q3") - F.col("_q1")
    outlier = (F.col("_v") >= F.col("_q3") + 1.5 * spread) | (F.col("_v") <= F.col("_q1") - 1.5 * spread)
    clean = kept.join(q, keys, "left").withColumn("_v", F.when(~F.coalesce(outlier, F.lit(False)), F.col("_v")))
    filled = interpolate(clean, Series(keys, ["frame"], chunk), "_v", "filled")
    return filled.withColumn("imputed", F.col("_v").isNull()).drop("_v", "_q1", "_q3")
