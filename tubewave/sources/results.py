"""Results of depth sizing as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.sizing import deepest_cell
from ..operators.store import split_failures


def write_sizing_tables(cells: DataFrame, keys: list[str], folder: str, partition: str | None = None) -> None:
    """Depth cells, statistics per flaw and rejects below one folder.

    The cells are written first and the statistics read them back, so sizing is not repeated.
    """
    good, bad = split_failures(cells)

    def write(df: DataFrame, name: str) -> None:
        writer = df.write.mode("append")
        (writer.partitionBy(partition) if partition else writer).parquet(f"{folder}/{name}")

    write(good, "depth_cells")
    write(bad, "rejects")
    write(deepest_cell(cells.sparkSession.read.parquet(f"{folder}/depth_cells"), keys), "depth_stats")
