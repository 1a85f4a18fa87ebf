"""Scan frames and maps as text files: one file per frame, one line per rotary position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXPORT_LAYOUT = r"scan_id=([^/]+)/probe=([^/]+)/frame=(\d+)/"
VENDOR_LAYOUT = r"([^/]+)/([A-Z0-9]+)/[A-Z0-9]+_(\d+)\.csv$"


def read_frames(spark: SparkSession, path: str, layout: str = EXPORT_LAYOUT) -> DataFrame:
    """A-scans from frame files; scan, probe and frame come from the file path.

    A frame file holds a bounded number of lines (one turn), so it is read as one text.
    """
    # partition folders are part of the path pattern, not columns of their own
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    place = F.col("_metadata.file_path")
    rows = files.select(
        *[F.regexp_extract(place, layout, i).alias(n) for i, n in ((1, "scan_id"), (2, "probe"), (3, "frame"))],
        F.posexplode(F.split(F.regexp_replace("value", r"\s+$", ""), r"\r?\n")).alias("rotary_idx", "line"),
    )
    samples = F.transform(F.split("line", ","), lambda v: F.trim(v).cast("smallint"))
    return rows.select("scan_id", "probe", F.col("frame").cast("int").alias("frame"), "rotary_idx", samples.alias("samples"))


def export_frames(ascans: DataFrame, path: str) -> None:
    """One file per (scan, probe, frame), lines in rotary order.

    The lines of one frame, at most one turn of the probe, become one text.
    """
    keys = ["scan_id", "probe", "frame"]
    line = F.array_join(F.col("samples").cast("array<string>"), ",").alias("line")
    lines = F.sort_array(F.collect_list(F.struct("rotary_idx", line)))
    texts = ascans.groupBy(*keys).agg(F.array_join(F.transform(lines, lambda e: e["line"]), "\n").alias("value"))
    texts.write.mode("overwrite").partitionBy(*keys).text(path)


def location_table(positions: DataFrame, probes: list[str]) -> DataFrame:
    """Axial and rotary location per frame with one pair of columns per probe."""
    return positions.groupBy("scan_id", "frame").pivot("probe", probes).agg(
        F.min("axial_mm").alias("axial"), F.min("rotary_deg").alias("rotary")
    )


def map_lines(cmap: DataFrame, value: str) -> DataFrame:
    """One text line per frame of a map, values in rotary order."""
    cells = F.sort_array(F.collect_list(F.struct("rotary_idx", F.col(value).cast("string").alias("v"))))
    return cmap.groupBy("scan_id", "probe", "frame").agg(F.array_join(F.transform(cells, lambda c: c["v"]), ",").alias("line"))
