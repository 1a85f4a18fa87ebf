"""The scan database: nested JSON documents in, partitioned tables out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FLAW = (
    "ind_num STRING, axial_start DOUBLE, rotary_start DOUBLE, frame_start INT, frame_end INT, length DOUBLE, width DOUBLE, "
    "depth STRING, depth2 DOUBLE, depth_category STRING, flaw_type STRING, is_reported BOOLEAN, is_predicted BOOLEAN, "
    "VERSION STRING, reported_id STRING, pred_depth STRING"
)
METRICS = "width_diff DOUBLE, length_diff DOUBLE, position_x_diff DOUBLE, position_y_diff DOUBLE, depth_diff DOUBLE"
REPORTED_FLAW = (
    f"{FLAW}, depth_nb1 DOUBLE, depth_nb2 DOUBLE, depth_apc DOUBLE, depth_cpc DOUBLE, pred_ind_num STRING, "
    f"is_classified_correct BOOLEAN, iou DOUBLE, metrics STRUCT<{METRICS}>"
)
EXTRA = "ind_num STRING, pred_flaw_type STRING, pred_depth STRING, axial_start DOUBLE, rotary_start DOUBLE, length DOUBLE, width DOUBLE"
SCAN = (
    "scan_id STRING, bscan_path STRING, local_path STRING, scan_name STRING, scan_unit INT, scan_station STRING, scan_channel STRING, "
    "year INT, month INT, day INT, outage_number STRING, scan_axial_pitch DOUBLE, first_axial INT, last_axial INT, first_rotary INT, "
    "last_rotary INT, train_val STRING, numeric_id INT, "
    f"flaws ARRAY<STRUCT<{FLAW}>>, reported_flaws ARRAY<STRUCT<{REPORTED_FLAW}>>, extra ARRAY<STRUCT<{EXTRA}>>"
)


def read_documents(spark: SparkSession, path: str, whole_file: bool = False) -> DataFrame:
    """Scan documents. ``whole_file`` reads the legacy layout, one object {"scans": [...]} per file.

    One scan per line is the layout that can be split, and the one this package writes.
    """
    if whole_file:
        schema = f"scans ARRAY<STRUCT<{SCAN}>>"
        return spark.read.schema(schema).option("multiLine", True).json(path).select(F.explode("scans").alias("s")).select("s.*")
    return spark.read.schema(SCAN).json(path)


def child_table(documents: DataFrame, field: str) -> DataFrame:
    """Rows of one nested array with the id of their scan."""
    return documents.select("scan_id", F.explode(field).alias("f")).select("scan_id", "f.*")


def write_documents(documents: DataFrame, path: str) -> None:
    documents.write.mode("overwrite").json(path)


def write_table(df: DataFrame, path: str, partition: str = "outage_number") -> None:
    """Partitioned by outage; rows of one outage are brought together first so that files stay few."""
    df.repartition(partition, F.pmod(F.xxhash64(*df.columns), F.lit(16))).write.mode("overwrite").partitionBy(partition).parquet(path)
