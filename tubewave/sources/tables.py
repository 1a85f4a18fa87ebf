"""Lists, spreadsheets, labels and cached maps as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Column names of the exchanged files.
REPORTED_SHEET_SCHEMA = (
    "Filename STRING, `reported ind num` STRING, `Axial Start` DOUBLE, `Rotary Start` DOUBLE, `Length (mm)` STRING, "
    "`Width (deg)` STRING, `Depth (mm)` STRING, `Flaw-group` STRING"
)
LABEL_SCHEMA = (
    "anf_fn STRING, `Ind num` STRING, `Flaw Type General` STRING, `rotary start` INT, `rotary end` INT, `frame start` INT, "
    "`frame end` INT, Depth STRING, Disposition BOOLEAN"
)
CACHE_NAMES = {"tof_flat": "ToF_flat", "ToF": "tof"}


def read_scan_list(spark: SparkSession, path: str) -> DataFrame:
    """One scan path per line; Type D entries stand for their Type A file."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    return lines.select(F.regexp_replace(F.trim("value"), "Type D", "Type A").alias("path"))


def route_by_extension(paths: DataFrame, column: str = "path") -> tuple[DataFrame, DataFrame]:
    """Readable scans with their format, and rejects with the reason."""
    found = F.regexp_extract(F.lower(column), r"\.(anf|daq|csv)$", 1)
    routed = paths.withColumn("format", F.when(found != "", found))
    return routed.where("format IS NOT NULL"), routed.where("format IS NULL").drop("format").withColumn("error", F.lit("unknown extension"))


def read_reported_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Reported flaws exported from the spreadsheet, one row per flaw."""
    raw = spark.read.csv(path, schema=REPORTED_SHEET_SCHEMA, header=True)
    names = ["scan_name", "ind_num", "axial_start", "rotary_start", "length", "width", "depth", "flaw_type"]
    return raw.toDF(*names)


def read_adjusted_labels(spark: SparkSession, path: str) -> DataFrame:
    """Adjusted labels without the ones that were only added."""
    raw = spark.read.csv(path, schema=LABEL_SCHEMA, header=True)
    names = ["scan_name", "ind_num", "flaw_type", "rotary_start", "rotary_end", "frame_start", "frame_end", "depth", "disposition"]
    return raw.toDF(*names).where(F.col("ind_num") != "Added")


def with_backup(primary: DataFrame, backup: DataFrame, key: str = "scan_id") -> DataFrame:
    """Cached maps of the primary folder, completed by scans that only the backup has."""
    main = primary.withColumnsRenamed({k: v for k, v in CACHE_NAMES.items() if k in primary.columns})
    spare = backup.withColumnsRenamed({k: v for k, v in CACHE_NAMES.items() if k in backup.columns})
    return main.unionByName(spare.join(main.select(key), key, "left_anti"), allowMissingColumns=True)


def append_summary(run: DataFrame, path: str) -> None:
    """Add this run to the summary table; earlier runs are not read or rewritten."""
    run.write.mode("append").parquet(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("mergeSchema", "true").parquet(path)
