"""Pairing of the two files of one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_scans(scans: DataFrame) -> DataFrame:
    """Every Type A scan with the Type D scan of the same name, which holds the second normal-beam probe."""
    keyed = scans.withColumn("_pair", F.regexp_replace("scan_name", "Type [AD]", ""))
    a = keyed.where(F.contains("scan_name", F.lit("Type A"))).select("_pair", F.col("scan_id").alias("scan_a"))
    d = keyed.where(F.contains("scan_name", F.lit("Type D"))).select("_pair", F.col("scan_id").alias("scan_d"))
    return a.join(d, "_pair", "left").drop("_pair")
