"""Inspection tables derived row by row from the given tables, in Spark and as SQL text.

Every derived table is a narrow projection of one given table: all rows take part, nothing is
sampled, and keys come from columns rather than from a global numbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CTES: dict[str, str] = {}


def with_tables(names: str, body: str) -> str:
    """SQL text with the named derived tables in front of ``body``; a body may go on with ', more AS (…)'."""
    parts = [f"{n.strip()} AS ({CTES[n.strip()]})" for n in names.split(",")]
    glue = "" if body.lstrip().startswith(",") else "\n"
    return "WITH " + ",\n".join(parts) + glue + body.lstrip()


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(spark: SparkSession, sf_dir: str, source: str, columns: list[str]) -> DataFrame:
    return given(spark, sf_dir, source).selectExpr(*columns)


# --- flaws ---------------------------------------------------------------------------------------

_IND = "concat_ws('-', l_linenumber, l_partkey, l_suppkey, CAST(floor((l_extendedprice * 100) + 0.5) AS BIGINT))"
_TYPE = (
    "concat(CASE WHEN l_linestatus = 'O' AND l_linenumber > 4 THEN 'BM_' ELSE '' END, "
    "CASE l_returnflag WHEN 'R' THEN 'Debris' WHEN 'A' THEN 'CC' ELSE 'FBBPF' END, "
    "CASE WHEN l_linenumber = 1 THEN ' (M)' ELSE '' END)"
)

REPORTED_COLUMNS = [
    "l_orderkey AS scan_id",
    f"{_IND} AS ind_num",
    f"{_TYPE} AS flaw_type",
    "l_quantity AS axial_start",
    "floor((l_extendedprice % 20) * 100 + 0.5) / 100 AS rotary_start",
    "floor((1 + 10 * l_tax) * 100 + 0.5) / 100 AS length",
    "CAST(5 + l_linenumber AS DOUBLE) AS width",
    "floor((l_tax + 0.1) * 10000 + 0.5) / 10000 AS depth",
    "CASE WHEN l_tax < 0.02 THEN '< 0.1' WHEN l_linenumber = 6 THEN '> 0.3' "
    "WHEN l_linenumber = 2 THEN concat(CAST(floor((l_tax + 0.1) * 10000 + 0.5) / 10000 AS {text}), ' (2)') "
    "ELSE CAST(floor((l_tax + 0.1) * 10000 + 0.5) / 10000 AS {text}) END AS depth_text",
]

PREDICTED_COLUMNS = [
    "l_orderkey AS scan_id",
    f"{_IND} AS ind_num",
    f"CASE WHEN l_linenumber = 3 THEN 'Other' ELSE {_TYPE} END AS flaw_type",
    "floor((l_quantity + l_discount + CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN 100 ELSE 0 END) * 100 + 0.5) / 100 "
    "AS axial_start",
    "floor((l_extendedprice % 20 + 0.3 * l_linenumber) * 100 + 0.5) / 100 AS rotary_start",
    "floor((1 + 10 * l_tax + l_discount) * 100 + 0.5) / 100 AS length",
    "CAST(5 + l_linenumber AS DOUBLE) AS width",
    "floor((l_discount * 10) * 100 + 0.5) / 100 AS confidence",
    "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE floor((l_tax + 0.1 + (l_discount - 0.05) / 10) * 10000 + 0.5) / 10000 END AS depth",
    "CASE WHEN l_suppkey % 13 = 0 THEN NULL WHEN l_linenumber = 4 THEN 'nan (2)' WHEN l_linenumber = 2 "
    "THEN concat(CAST(floor((l_tax + 0.1 + (l_discount - 0.05) / 10) * 10000 + 0.5) / 10000 AS {text}), ' (2)') "
    "ELSE CAST(floor((l_tax + 0.1 + (l_discount - 0.05) / 10) * 10000 + 0.5) / 10000 AS {text}) END AS depth_text",
]

CTES["reported"] = "SELECT " + ", ".join(REPORTED_COLUMNS).format(text="VARCHAR") + " FROM lineitem"
CTES["predicted"] = "SELECT " + ", ".join(PREDICTED_COLUMNS).format(text="VARCHAR") + " FROM lineitem"


def reported(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, "lineitem", [c.format(text="STRING") for c in REPORTED_COLUMNS])


def predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, "lineitem", [c.format(text="STRING") for c in PREDICTED_COLUMNS])


# --- scans ---------------------------------------------------------------------------------------

SCAN_COLUMNS = [
    "o_orderkey AS scan_id",
    "concat(CASE o_orderstatus WHEN 'F' THEN 'P' ELSE 'D' END, CAST(year(o_orderdate) % 100 + 100 AS {text}), "
    "CAST(o_custkey % 8 + 1 AS {text}), '1') AS raw_outage",
    "CASE o_orderstatus WHEN 'F' THEN 'Pickering' ELSE 'Darlington' END AS scan_station",
    "CAST(o_custkey % 8 + 1 AS INT) AS scan_unit",
    "concat(substr(o_orderpriority, 3, 1), lpad(CAST(o_custkey % 24 + 1 AS {text}), 2, '0')) AS scan_channel",
    "CAST(year(o_orderdate) AS INT) AS scan_year",
    "CAST(month(o_orderdate) AS INT) AS scan_month",
    "CAST(day(o_orderdate) AS INT) AS scan_day",
    "CASE WHEN o_custkey % 3 = 0 THEN 'daq' ELSE 'anf' END AS extension",
    "concat('BSCAN Type ', CASE WHEN o_custkey % 2 = 0 THEN 'A' ELSE 'D' END, ' ', "
    "substr(o_orderpriority, 3, 1), '-', lpad(CAST(o_custkey % 24 + 1 AS {text}), 2, '0'), ' ', "
    "CASE o_orderstatus WHEN 'F' THEN 'Pickering' ELSE 'Darlington' END, ' Unit-', CAST(o_custkey % 8 + 1 AS {text}), "
    "' ', CAST(o_orderkey AS {text}), ' ', lpad(CAST(day(o_orderdate) AS {text}), 2, '0'), '-Jan-', "
    "CAST(year(o_orderdate) AS {text}), ' [', CAST(o_custkey AS {text}), '] x') AS scan_name",
    "round(o_totalprice / 100000, 3) AS raw_pitch",
]
CTES["scans"] = "SELECT " + ", ".join(SCAN_COLUMNS).format(text="VARCHAR") + " FROM orders"


def scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, "orders", [c.format(text="STRING") for c in SCAN_COLUMNS])


# --- A-scans: one vector is one A-scan, 64 neighbouring vectors are one frame -----------------------

CTES["ascans"] = (
    "SELECT vec_id // 512 AS scan_id, CASE WHEN (vec_id // 64) % 2 = 0 THEN 'NB1' ELSE 'NB2' END AS probe, "
    "(vec_id // 64) % 8 AS frame, vec_id % 64 AS rotary_idx, "
    "[CAST(floor(128 + 100 * CAST(x AS DOUBLE)) AS INTEGER) FOR x IN embedding] AS samples FROM embeddings"
)


def ascans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples around the median level 128; the frame size is fixed, so groups by frame stay small."""
    return _project(
        spark,
        sf_dir,
        "embeddings",
        [
            "vec_id DIV 512 AS scan_id",
            "CASE WHEN (vec_id DIV 64) % 2 = 0 THEN 'NB1' ELSE 'NB2' END AS probe",
            "(vec_id DIV 64) % 8 AS frame",
            "vec_id % 64 AS rotary_idx",
            "transform(embedding, x -> CAST(floor(128 + 100 * CAST(x AS DOUBLE)) AS INT)) AS samples",
        ],
    )


# --- ordered series: one row per (scan, frame) with a value that is sometimes missing ---------------

CTES["series"] = (
    "SELECT user_id AS scan_id, event_id AS frame, event_type AS cls, "
    "CASE WHEN event_id % 7 = 0 OR event_id % 5 = 3 THEN NULL ELSE value END AS value, value AS full_value, "
    "CAST(floor(value) AS BIGINT) % 11 AS lag FROM events"
)


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(
        spark,
        sf_dir,
        "events",
        [
            "user_id AS scan_id",
            "event_id AS frame",
            "event_type AS cls",
            "CASE WHEN event_id % 7 = 0 OR event_id % 5 = 3 THEN NULL ELSE value END AS value",
            "value AS full_value",
            "CAST(floor(value) AS BIGINT) % 11 AS lag",
        ],
    )


# --- depth cells: one row per (flaw, frame, rotary) --------------------------------------------------

CTES["cells"] = (
    "SELECT user_id AS scan_id, event_type AS flaw_id, event_id // 64 AS frame, event_id % 64 AS rotary_idx, "
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(value / 200, 5) END AS depth, "
    "CAST(floor(value * 7) AS BIGINT) % 128 AS amp FROM events"
)


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(
        spark,
        sf_dir,
        "events",
        [
            "user_id AS scan_id",
            "event_type AS flaw_id",
            "event_id DIV 64 AS frame",
            "event_id % 64 AS rotary_idx",
            "CASE WHEN event_id % 7 = 0 THEN NULL ELSE round(value / 200, 5) END AS depth",
            "CAST(floor(value * 7) AS BIGINT) % 128 AS amp",
        ],
    )


# --- detection boxes, relative to their image ---------------------------------------------------------

BOX_COLUMNS = [
    "l_orderkey AS image_id",
    f"{_IND} AS box_id",
    "CASE l_returnflag WHEN 'R' THEN 'V' WHEN 'A' THEN 'MR' ELSE 'Spaghetti' END AS cls",
    "floor((l_discount * 10) * 100 + 0.5) / 100 AS conf",
    "floor((l_extendedprice % 1) * 100 + 0.5) / 100 AS x",
    "l_quantity / 50 AS y",
    "(1 + l_linenumber) / 20.0{d} AS w",
    "l_tax + 0.04{d} AS h",
    "1000 AS img_w",
    "600 AS img_h",
]
CTES["boxes"] = "SELECT " + ", ".join(BOX_COLUMNS).format(d="::DOUBLE") + " FROM lineitem"


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, "lineitem", [c.format(d="D") for c in BOX_COLUMNS])


# --- flaws on the A-scan grid --------------------------------------------------------------------------

CTES["grid_flaws"] = (
    "SELECT scan_id, probe, concat(frame // 4, '-', label) AS flaw_id, min(frame) AS frame_start, max(frame) AS frame_end, "
    "min(rotary_idx) AS rotary_start, least(min(rotary_idx) + 5, 63) AS rotary_end FROM (SELECT vec_id // 512 AS scan_id, "
    "CASE WHEN (vec_id // 64) % 2 = 0 THEN 'NB1' ELSE 'NB2' END AS probe, (vec_id // 64) % 8 AS frame, vec_id % 64 AS rotary_idx, "
    "label FROM embeddings) GROUP BY scan_id, probe, frame // 4, label"
)


def grid_flaws(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _project(
        spark,
        sf_dir,
        "embeddings",
        [
            "vec_id DIV 512 AS scan_id",
            "CASE WHEN (vec_id DIV 64) % 2 = 0 THEN 'NB1' ELSE 'NB2' END AS probe",
            "(vec_id DIV 64) % 8 AS frame",
            "vec_id % 64 AS rotary_idx",
            "label",
        ],
    )
    return (
        rows.groupBy("scan_id", "probe", F.expr("frame DIV 4").alias("part"), "label")
        .agg(
            F.min("frame").alias("frame_start"),
            F.max("frame").alias("frame_end"),
            F.min("rotary_idx").alias("rotary_start"),
            F.least(F.min("rotary_idx") + 5, F.lit(63)).alias("rotary_end"),
        )
        .withColumn("flaw_id", F.concat_ws("-", F.col("part").cast("string"), F.col("label").cast("string")))
        .drop("part", "label")
    )


# --- axis of a scan: index to axial position in mm and rotary angle --------------------------------------

CTES["axis"] = (
    "SELECT p_partkey AS idx, round(2500 + p_partkey * 0.3 + p_size / 1000, 3) AS axial_mm, "
    "round((0.1 * (p_partkey + 50)) % 360, 1) AS rotary_deg FROM part"
)


def axis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(
        spark,
        sf_dir,
        "part",
        [
            "p_partkey AS idx",
            "round(2500 + p_partkey * 0.3D + p_size / 1000, 3) AS axial_mm",
            "round((0.1D * (p_partkey + 50)) % 360, 1) AS rotary_deg",
        ],
    )


# --- depth differences with category and flag -------------------------------------------------------------

DELTA_COLUMNS = [
    "l_orderkey AS scan_id",
    f"{_IND} AS ind_num",
    "CASE l_suppkey % 7 WHEN 0 THEN 'd' WHEN 1 THEN 'V' WHEN 2 THEN 'MV' WHEN 3 THEN 's' WHEN 4 THEN 'M' WHEN 5 THEN '7' "
    "ELSE 'V+d' END AS category",
    "floor(((l_discount - 0.05{d}) * 0.9{d} + l_linenumber * 0.001{d}) * 10000 + 0.5) / 10000 AS delta1",
    "CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE floor(((l_tax - 0.04{d}) * 0.8{d} + (l_discount - 0.05{d}) * 0.3{d}) * 10000 + 0.5) / 10000 END AS delta2",
    "l_linenumber = 2 AS flagged",
    "floor((0.08{d} + l_quantity / 100) * 10000 + 0.5) / 10000 AS depth",
    "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE floor((l_tax + 0.1{d}) * 10000 + 0.5) / 10000 END AS depth_nb1",
    "CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE floor((l_discount + 0.1{d}) * 10000 + 0.5) / 10000 END AS depth_nb2",
]
CTES["deltas"] = "SELECT " + ", ".join(DELTA_COLUMNS).format(d="::DOUBLE") + " FROM lineitem"


def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, "lineitem", [c.format(d="D") for c in DELTA_COLUMNS])


# --- echo-group boxes: ten per frame --------------------------------------------------------------------------

WAVE_BOX_COLUMNS = [
    "event_id {div} 640 AS scan_id",
    "(event_id {div} 10) % 64 AS frame",
    "event_id AS box_id",
    "CASE event_type WHEN 'click' THEN 'G2' WHEN 'view' THEN 'G3' WHEN 'purchase' THEN 'G4' WHEN 'error' THEN 'G4' ELSE 'G3' END AS cls",
    "value AS box_start",
    "value + 20 + event_id % 5 AS box_end",
    "(event_id * 13) % 100 / 100.0{d} AS conf",
]
CTES["wave_boxes"] = "SELECT " + ", ".join(WAVE_BOX_COLUMNS).format(div="//", d="::DOUBLE") + " FROM events"


def wave_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, "events", [c.format(div="DIV", d="D") for c in WAVE_BOX_COLUMNS])


# --- rows of measured boxes: sixteen rows per box, eight boxes per image ---------------------------------------

BOX_ROW_COLUMNS = [
    "event_id {div} 128 AS image_id",
    "event_id {div} 16 AS box_id",
    "CASE (event_id {div} 16) % 5 WHEN 0 THEN 'V' WHEN 1 THEN 'MR' WHEN 2 THEN 'Spaghetti' WHEN 3 THEN '7' ELSE 'default' END AS cls",
    "event_id % 16 + (event_id {div} 16) % 8 * 3 AS y",
    "CAST(floor(value) AS BIGINT) % 60 + 10 AS max_x",
    "CAST(floor(value * 10) AS BIGINT) % 120 AS max_value",
    "CAST(10 AS BIGINT) AS x1",
    "CAST(70 AS BIGINT) AS x2",
]
CTES["box_rows"] = "SELECT " + ", ".join(BOX_ROW_COLUMNS).format(div="//") + " FROM events"


def box_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(spark, sf_dir, "events", [c.format(div="DIV") for c in BOX_ROW_COLUMNS])
