"""Run summary kept up to date from a folder of run results.

Each finished run leaves its flaw rows as files in a folder. What is new since the last call is appended
to the summary table; the file log of the stream makes sure that a run is added once, also after a
restart. Files do not arrive out of order in a way that matters, so there is no watermark and no state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def new_runs(spark: SparkSession, folder: str, schema: StructType | str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder).withColumn("run_file", F.col("_metadata.file_path"))


def append_new_runs(spark: SparkSession, folder: str, schema: StructType | str, summary: str, progress: str) -> StreamingQuery:
    """Append everything that arrived since the last call and stop; ``progress`` is the stream's log folder."""
    writer = new_runs(spark, folder, schema).writeStream.format("parquet").outputMode("append")
    return writer.option("path", summary).option("checkpointLocation", progress).trigger(availableNow=True).start()
