"""Readers of recorded scan files. The files are written by Spark from the given A-scans first."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import samples as sm
from ..session import scratch_path
from ..sources import binary
from . import fixture_files
from . import fixtures as fx
from .fixtures import with_tables
from .registry import query

FRAMES_SQL = """, f AS (SELECT *, row_number() OVER (PARTITION BY scan_id, probe ORDER BY frame) - 1 AS i FROM (SELECT DISTINCT scan_id, probe, frame FROM ascans))"""


def recorded(rows):
    """A-scans that the scan has; what fills up its last turn or a channel with fewer frames is zero throughout."""
    return rows.where(F.array_max("samples") > 0)


def _files(spark, sf_dir, fmt):
    folder = scratch_path(spark, f"scans-{fmt}")
    fixture_files.write_scan_files(fx.ascans(spark, sf_dir), folder, fmt).write.format("noop").mode("overwrite").save()
    return f"{folder}/*.{fmt}"


@query(
    "anf_scans_s1",
    with_tables(
        "ascans",
        f"""{FRAMES_SQL}
SELECT 'BSCAN Type A ' || a.scan_id AS scan_id, a.probe, CAST(f.i AS INTEGER) AS frame, CAST(a.rotary_idx AS INTEGER) AS rotary_idx, round(2500 + 3e-1 * a.frame, 3) AS axial_mm,
  round((1e-1 * (a.rotary_idx + 3590)) % 360, 4) AS rotary_deg, len(samples)::INTEGER AS n, list_sum(samples)::DOUBLE AS total FROM ascans a JOIN f USING (scan_id, probe, frame)""",
    ),
)
def anf_scans(spark, sf_dir):
    rows = recorded(binary.read_scans(spark, _files(spark, sf_dir, "anf"), split_mb=0.01))
    return rows.select(
        "scan_id", "probe", "frame", "rotary_idx", F.round("axial_mm", 3).alias("axial_mm"), F.round("rotary_deg", 4).alias("rotary_deg"),
        F.size("samples").alias("n"), sm.total(F.col("samples")).alias("total"),
    )


@query(
    "daq_scans_s2",
    with_tables(
        "ascans",
        f"""{FRAMES_SQL}
SELECT 'BSCAN Type A ' || a.scan_id AS scan_id, a.probe, CAST(f.i AS INTEGER) AS frame, CAST(a.rotary_idx AS INTEGER) AS rotary_idx, list_sum(samples)::DOUBLE AS total
FROM ascans a JOIN f USING (scan_id, probe, frame) WHERE a.probe = 'NB2' AND f.i >= 1""",
    ),
)
def daq_scans(spark, sf_dir):
    """Only the second probe from the second frame on: both conditions reach the reader."""
    rows = binary.read_scans(spark, _files(spark, sf_dir, "daq"), split_mb=0.01).where("probe = 'NB2' AND frame >= 1")
    return recorded(rows).select("scan_id", "probe", "frame", "rotary_idx", sm.total(F.col("samples")).alias("total"))


@query(
    "scan_headers_s5",
    with_tables(
        "ascans",
        f"""{FRAMES_SQL}
SELECT 'BSCAN Type A ' || scan_id AS scan_id, 'K09' AS channel, CASE probe WHEN 'NB1' THEN 'ID1 NB' ELSE 'ID2 NB' END AS label, CAST(rank() OVER (PARTITION BY scan_id ORDER BY probe) - 1 + 20 AS DOUBLE) AS gain,
  100 AS pulse_voltage FROM f GROUP BY scan_id, probe""",
    ),
)
def scan_headers(spark, sf_dir):
    headers = binary.read_headers(spark, _files(spark, sf_dir, "anf")).where("error IS NULL")
    return headers.select("scan_id", "channel", F.posexplode("channels").alias("i", "c")).select("scan_id", "channel", "c.label", "c.gain", "c.pulse_voltage")
