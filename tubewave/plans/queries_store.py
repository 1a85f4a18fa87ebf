"""Sources, sinks, updates of the store and best-of choices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import samples as sm
from ..operators import ranking, store
from ..operators import projections as pj
from ..session import scratch_path
from ..sources import database, frames, tables
from . import fixtures as fx
from .fixtures import with_tables
from .registry import query

PATH_SQL = "concat('/raw/', scan_name, CASE scan_unit WHEN 7 THEN '.txt' WHEN 8 THEN '.DAQ' ELSE '.' || extension END)"


@query(
    "scan_list_routing_s4_s7",
    with_tables(
        "scans",
        f""", l AS (SELECT replace({PATH_SQL}, 'Type D', 'Type A') AS path FROM scans)
SELECT path, CASE WHEN regexp_matches(lower(path), '\\.(anf|daq|csv)$') THEN right(lower(path), 3) ELSE 'rejected' END AS format FROM l""",
    ),
)
def scan_list_routing(spark, sf_dir):
    """The list is written and read back as text, one path per line."""
    listing = scratch_path(spark, "scan-list")
    fx.scans(spark, sf_dir).select(F.expr(PATH_SQL).alias("value")).write.text(listing)
    good, bad = tables.route_by_extension(tables.read_scan_list(spark, listing))
    return good.unionByName(bad.select("path", F.lit("rejected").alias("format")))


@query(
    "database_roundtrip_s8_s15",
    with_tables(
        "scans, reported",
        """SELECT CAST(s.scan_id AS VARCHAR) AS scan_id, s.raw_outage AS outage_number, r.ind_num, r.flaw_type, r.length, r.depth_text AS depth
FROM scans s JOIN reported r USING (scan_id)""",
    ),
)
def database_roundtrip(spark, sf_dir):
    scans = fx.scans(spark, sf_dir).select(F.col("scan_id").cast("string").alias("scan_id"), "scan_name", F.col("raw_outage").alias("outage_number"))
    flaws = fx.reported(spark, sf_dir).select(
        F.col("scan_id").cast("string").alias("scan_id"), "ind_num", "flaw_type", "axial_start", "length", "width", F.col("depth_text").alias("depth")
    )
    path = scratch_path(spark, "database")
    database.write_documents(pj.nested_documents(scans, flaws, "scan_id", "reported_flaws").drop("part"), path)
    docs = database.read_documents(spark, path)
    rows = database.child_table(docs, "reported_flaws")
    outages = docs.select("scan_id", "outage_number").distinct()
    return rows.join(outages, "scan_id").select("scan_id", "outage_number", "ind_num", "flaw_type", "length", "depth")


@query(
    "reported_sheet_s9",
    with_tables(
        "reported, scans",
        """SELECT s.scan_name, 0 AS part, count(*)::INTEGER AS n, round(sum(r.axial_start), 4) AS axial_sum FROM reported r JOIN scans s USING (scan_id) GROUP BY 1""",
    ),
)
def reported_sheet(spark, sf_dir):
    path = scratch_path(spark, "reported-sheet")
    rows = fx.reported(spark, sf_dir).join(fx.scans(spark, sf_dir).select("scan_id", "scan_name"), "scan_id")
    rows.select("scan_name", "ind_num", "axial_start", "rotary_start", "length", "width", "depth_text", "flaw_type").write.csv(path, header=True)
    sheet = tables.read_reported_sheet(spark, path)
    docs = pj.nested_documents(sheet.select("scan_name").distinct(), sheet, "scan_name", "reported_flaws")
    axial = F.transform("reported_flaws", lambda f: f["axial_start"])
    return docs.select("scan_name", "part", F.size("reported_flaws").alias("n"), F.round(sm.total(axial), 4).alias("axial_sum"))


@query(
    "adjusted_labels_s10",
    with_tables(
        "reported",
        "SELECT CAST(scan_id AS VARCHAR) AS scan_name, ind_num, CAST(floor(rotary_start * 10) AS INTEGER) AS rotary_start, depth_text AS depth "
        "FROM reported WHERE NOT ind_num LIKE '7-%'",
    ),
)
def adjusted_labels(spark, sf_dir):
    path = scratch_path(spark, "labels")
    rot = F.floor(F.col("rotary_start") * 10).cast("int")
    fx.reported(spark, sf_dir).select(
        "scan_id", F.when(F.col("ind_num").startswith("7-"), "Added").otherwise(F.col("ind_num")).alias("ind"), "flaw_type",
        rot.alias("r0"), (rot + 10).alias("r1"), F.lit(1).alias("f0"), F.lit(2).alias("f1"), "depth_text", F.lit(False).alias("disp"),
    ).write.csv(path, header=True)
    return tables.read_adjusted_labels(spark, path).select("scan_name", "ind_num", "rotary_start", "depth")


@query(
    "cached_maps_s11",
    with_tables(
        "cells",
        """, p AS (SELECT scan_id, frame, rotary_idx, depth AS "ToF_flat", amp AS tof FROM cells WHERE flaw_id IN ('click', 'view')),
b AS (SELECT scan_id, frame, rotary_idx, depth AS "ToF_flat", amp AS tof FROM cells WHERE flaw_id NOT IN ('click', 'view'))
SELECT * FROM p UNION ALL SELECT * FROM b WHERE scan_id NOT IN (SELECT scan_id FROM p)""",
    ),
)
def cached_maps(spark, sf_dir):
    rows = fx.cells(spark, sf_dir).select("scan_id", "flaw_id", "frame", "rotary_idx", F.col("depth").alias("tof_flat"), F.col("amp").alias("ToF"))
    primary = rows.where(F.col("flaw_id").isin("click", "view")).drop("flaw_id")
    return tables.with_backup(primary, rows.where("flaw_id NOT IN ('click', 'view')").drop("flaw_id"))


@query(
    "frame_files_s3_s12",
    with_tables(
        "ascans",
        """SELECT CAST(scan_id AS VARCHAR) AS scan_id, probe, CAST(frame AS INTEGER) AS frame, CAST(rotary_idx AS INTEGER) - (SELECT min(rotary_idx) FROM ascans b
  WHERE b.scan_id = a.scan_id AND b.frame = a.frame)::INTEGER AS rotary_idx, len(samples)::INTEGER AS n, list_sum(samples)::DOUBLE AS total FROM ascans a""",
    ),
)
def frame_files(spark, sf_dir):
    path = scratch_path(spark, "frames")
    frames.export_frames(fx.ascans(spark, sf_dir), path)
    back = frames.read_frames(spark, path)
    return back.select("scan_id", "probe", "frame", "rotary_idx", F.size("samples").alias("n"), sm.total(F.col("samples")).alias("total"))


@query(
    "location_table_s12",
    with_tables(
        "ascans",
        """SELECT scan_id, frame, min(CASE WHEN probe = 'NB1' THEN 3e-1 * frame END) AS "NB1_axial", min(CASE WHEN probe = 'NB1' THEN round((1e-1 * rotary_idx) % 360, 4) END) AS "NB1_rotary",
  min(CASE WHEN probe = 'NB2' THEN 3e-1 * frame END) AS "NB2_axial", min(CASE WHEN probe = 'NB2' THEN round((1e-1 * rotary_idx) % 360, 4) END) AS "NB2_rotary"
FROM ascans GROUP BY 1, 2""",
    ),
)
def location_table(spark, sf_dir):
    pos = fx.ascans(spark, sf_dir).select(
        "scan_id", "probe", "frame", (F.lit(0.3) * F.col("frame")).alias("axial_mm"),
        F.round(pj.rotary_angle(F.col("rotary_idx"), F.lit(0)), 4).alias("rotary_deg"),
    )
    return frames.location_table(pos, ["NB1", "NB2"])


@query(
    "map_lines_s13",
    with_tables(
        "ascans",
        """SELECT scan_id, probe, frame, string_agg(CAST(list_max(samples) AS VARCHAR), ',' ORDER BY rotary_idx) AS line FROM ascans GROUP BY 1, 2, 3""",
    ),
)
def map_lines(spark, sf_dir):
    path = scratch_path(spark, "map")
    peaks = fx.ascans(spark, sf_dir).select("scan_id", "probe", "frame", "rotary_idx", F.array_max("samples").alias("peak"))
    frames.map_lines(peaks, "peak").write.csv(path, header=True)
    return spark.read.csv(path, schema="scan_id BIGINT, probe STRING, frame BIGINT, line STRING", header=True)


@query(
    "run_summary_s14_u2",
    with_tables(
        "scans",
        """SELECT scan_id, scan_name, scan_year, CASE WHEN scan_year < 1998 THEN NULL ELSE scan_unit END AS scan_unit FROM scans""",
    ),
)
def run_summary(spark, sf_dir):
    """Two runs appended one after the other; the later one has a column more."""
    path = scratch_path(spark, "summary")
    scans = fx.scans(spark, sf_dir)
    tables.append_summary(scans.where("scan_year < 1998").select("scan_id", "scan_name", "scan_year"), path)
    tables.append_summary(scans.where("scan_year >= 1998").select("scan_id", "scan_name", "scan_year", "scan_unit"), path)
    return tables.read_summary(spark, path).select("scan_id", "scan_name", "scan_year", "scan_unit")


# --- best-of choices ------------------------------------------------------------------------------


@query(
    "sorted_counts_t1",
    with_tables("predicted", "SELECT flaw_type, count(*)::BIGINT AS n, min(rotary_start) AS first_rotary FROM predicted GROUP BY 1 ORDER BY n DESC, flaw_type"),
)
def sorted_counts(spark, sf_dir):
    counts = fx.predicted(spark, sf_dir).groupBy("flaw_type").agg(F.count(F.lit(1)).alias("n"), F.min("rotary_start").alias("first_rotary"))
    return counts.orderBy(F.desc("n"), "flaw_type")


@query(
    "top_peaks_t2_x4",
    with_tables(
        "ascans",
        """, s AS (SELECT vec_id // 512 AS scan_id, CASE WHEN (vec_id // 64) % 2 = 0 THEN 'NB1' ELSE 'NB2' END AS probe, (vec_id // 64) % 8 AS frame, vec_id % 64 AS rotary_idx,
  unnest([CAST(floor(128 + 100 * CAST(x AS DOUBLE)) AS INTEGER) FOR x IN embedding]) AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings),
n AS (SELECT *, lag(v) OVER w AS a, lead(v) OVER w AS b FROM s WINDOW w AS (PARTITION BY scan_id, probe, frame, rotary_idx ORDER BY i)),
k AS (SELECT *, row_number() OVER (PARTITION BY scan_id, probe, frame, rotary_idx ORDER BY v DESC, i) AS rk FROM n WHERE v >= 135 AND v > a AND v > b)
SELECT scan_id, probe, frame, rotary_idx, CAST(rk AS INTEGER) AS rank, v AS height, CAST(i AS INTEGER) AS idx FROM k WHERE rk <= 3""",
    ),
)
def top_peaks(spark, sf_dir):
    peaks = fx.ascans(spark, sf_dir).select(
        "scan_id", "probe", "frame", "rotary_idx", F.posexplode(ranking.top_peaks(F.col("samples"), 3, 135)).alias("p", "e")
    )
    return peaks.select(
        "scan_id", "probe", "frame", "rotary_idx", (F.col("p") + 1).alias("rank"), F.col("e.height").alias("height"), F.col("e.index").alias("idx")
    )


@query(
    "far_depths_t3",
    with_tables(
        "cells",
        """, c AS (SELECT *, row_number() OVER (PARTITION BY scan_id, flaw_id ORDER BY depth DESC NULLS LAST, frame * 64 + rotary_idx) AS rk FROM cells),
r AS (SELECT scan_id, flaw_id, quantile_cont(depth, 0.5) AS reference FROM c WHERE rk <= 5 GROUP BY 1, 2),
m AS (SELECT c.*, r.reference, coalesce(abs(depth - reference) <= 0.4, FALSE) AS near FROM c JOIN r USING (scan_id, flaw_id)),
k AS (SELECT *, near OR (depth IS NOT NULL AND NOT bool_or(near) OVER (PARTITION BY scan_id, flaw_id)) AS kept FROM m)
SELECT scan_id, flaw_id, frame, rotary_idx, CASE WHEN kept THEN depth WHEN depth IS NOT NULL THEN round(reference, 6) END AS depth, kept FROM k""",
    ),
)
def far_depths(spark, sf_dir):
    rows = fx.cells(spark, sf_dir).withColumn("cell", F.col("frame") * 64 + F.col("rotary_idx"))
    out = ranking.drop_far_depths(rows, ["scan_id", "flaw_id"], "depth", "cell", 0.4)
    depth = F.when(F.col("kept"), F.col("depth")).when(F.col("depth").isNotNull(), F.round("reference", 6))
    return out.select("scan_id", "flaw_id", "frame", "rotary_idx", depth.alias("depth"), "kept")


@query(
    "depth_with_amplitude_t4",
    with_tables(
        "cells",
        """, e AS (SELECT *, frame * 64 + rotary_idx AS cell FROM cells), c AS (SELECT * FROM e WHERE depth IS NOT NULL),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scan_id, flaw_id ORDER BY depth DESC, cell) AS rk FROM c) WHERE rk = 1),
o AS (SELECT c.scan_id, c.flaw_id, max(CASE WHEN c.cell <> t.cell THEN c.amp END) AS other FROM c JOIN t USING (scan_id, flaw_id) GROUP BY 1, 2),
a AS (SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY c.scan_id, c.flaw_id ORDER BY c.depth DESC, c.cell) AS rk FROM c JOIN t USING (scan_id, flaw_id)
  JOIN o USING (scan_id, flaw_id) WHERE c.amp >= 0.6 * other AND abs(c.frame - t.frame) <= 20) WHERE rk = 1)
SELECT scan_id, flaw_id, CASE WHEN w THEN a.depth ELSE t.depth END AS depth, CASE WHEN w THEN a.cell ELSE t.cell END AS cell, coalesce(w, FALSE) AS by_amplitude
FROM (SELECT DISTINCT scan_id, flaw_id FROM e) LEFT JOIN (SELECT t.*, coalesce(t.amp < 0.6 * o.other, FALSE) AND a.cell IS NOT NULL AS w FROM t JOIN o USING (scan_id, flaw_id) LEFT JOIN a USING (scan_id, flaw_id)) t USING (scan_id, flaw_id)
LEFT JOIN a USING (scan_id, flaw_id)""",
    ),
)
def depth_with_amplitude(spark, sf_dir):
    rows = fx.cells(spark, sf_dir).withColumn("cell", F.col("frame") * 64 + F.col("rotary_idx"))
    picked = ranking.pick_depth(rows, ["scan_id", "flaw_id"], "depth", "amp", "frame", "cell", reach=20)
    return picked.select("scan_id", "flaw_id", "depth", "cell", "by_amplitude")


@query(
    "first_rows_t5",
    with_tables(
        "deltas",
        """SELECT category, scan_id, ind_num, rk::BIGINT AS position FROM (SELECT *, row_number() OVER (PARTITION BY category ORDER BY scan_id, ind_num) AS rk FROM deltas) WHERE rk <= 100""",
    ),
)
def first_rows(spark, sf_dir):
    """The first hundred rows of each category, the sample shown in the data-set report."""
    from pyspark.sql import Window

    first = ranking.top_rows(fx.deltas(spark, sf_dir), ["category"], [F.col("scan_id"), F.col("ind_num")], 100)
    w = Window.partitionBy("category").orderBy("scan_id", "ind_num")
    return first.select("category", "scan_id", "ind_num", F.row_number().over(w).cast("bigint").alias("position"))


@query(
    "query_page_t6",
    with_tables("scans", "SELECT scan_id, scan_name FROM scans WHERE scan_year >= 1996 ORDER BY scan_id LIMIT 200 OFFSET 50"),
)
def query_page(spark, sf_dir):
    """A page of a query result: limit and start offset are the feature."""
    return fx.scans(spark, sf_dir).where("scan_year >= 1996").select("scan_id", "scan_name").orderBy("scan_id").offset(50).limit(200)


@query(
    "best_probe_t7",
    with_tables(
        "deltas",
        """SELECT scan_id, ind_num, CASE WHEN depth_nb2 > depth_nb1 OR depth_nb1 IS NULL THEN depth_nb2 ELSE depth_nb1 END AS best_depth,
  CASE WHEN depth_nb2 > depth_nb1 OR (depth_nb1 IS NULL AND depth_nb2 IS NOT NULL) THEN 'NB2' WHEN depth_nb1 IS NOT NULL THEN 'NB1' END AS probe_used FROM deltas""",
    ),
)
def best_probe(spark, sf_dir):
    depth, probe = ranking.deeper_probe(F.col("depth_nb1"), F.col("depth_nb2"), ("NB1", "NB2"))
    return fx.deltas(spark, sf_dir).select("scan_id", "ind_num", depth.alias("best_depth"), probe.alias("probe_used"))


@query(
    "depth_source_t8",
    with_tables(
        "deltas",
        """, v AS (SELECT *, coalesce(depth_nb1, depth_nb2, depth) AS fin FROM deltas)
SELECT scan_id, ind_num, CASE WHEN coalesce(fin = depth_nb1 OR fin = depth, FALSE) AND coalesce(fin = depth_nb2 OR fin = depth, FALSE) THEN 'both'
  WHEN coalesce(fin = depth_nb1 OR fin = depth, FALSE) THEN 'echo_removed' WHEN coalesce(fin = depth_nb2 OR fin = depth, FALSE) THEN 'inverted' ELSE 'normal' END AS source FROM v""",
    ),
)
def depth_source(spark, sf_dir):
    variants = {"echo_removed": F.col("depth_nb1"), "inverted": F.col("depth_nb2"), "both": F.col("depth")}
    source = ranking.depth_source(F.coalesce("depth_nb1", "depth_nb2", "depth"), variants)
    return fx.deltas(spark, sf_dir).select("scan_id", "ind_num", source.alias("source"))


# --- set operations and updates ---------------------------------------------------------------------


@query(
    "detection_union_u1",
    with_tables(
        "boxes",
        "SELECT image_id, box_id, cls, conf FROM boxes UNION ALL SELECT image_id, box_id, 'Others', conf FROM boxes WHERE cls = 'Spaghetti'",
    ),
)
def detection_union(spark, sf_dir):
    main = fx.boxes(spark, sf_dir).select("image_id", "box_id", "cls", "conf")
    binary = main.where("cls = 'Spaghetti'").withColumn("cls", F.lit("Others"))
    return main.unionByName(binary)


@query(
    "debris_fallback_u3",
    with_tables(
        "deltas",
        """, p AS (SELECT scan_id, ind_num, depth_nb1, depth_nb2, CASE WHEN depth_nb1 IS NOT NULL THEN 'NB1' WHEN depth_nb2 IS NOT NULL THEN 'NB2' END AS probe,
  coalesce(depth_nb1, depth_nb2) AS pred, CASE WHEN flagged THEN depth + 0.01 END AS peak, depth AS removed FROM deltas)
SELECT scan_id, ind_num, probe, round(CASE WHEN pred IS NOT NULL THEN coalesce(peak, CASE WHEN probe = 'NB1' AND removed - pred >= 0.25 THEN removed END, pred) END, 6) AS final_depth FROM p""",
    ),
)
def debris_fallback(spark, sf_dir):
    rows = fx.deltas(spark, sf_dir)
    common = ["scan_id", "ind_num", F.col("depth").alias("echo_removed")]
    nb1 = rows.select(*common, F.col("depth_nb1").alias("pred_depth"), F.when(F.col("flagged"), F.col("depth") + 0.01).alias("first_peak"))
    nb2 = rows.select(*common, F.col("depth_nb2").alias("pred_depth"), F.lit(None).cast("double").alias("first_peak"))
    final = store.debris_final_depth(nb1, nb2, ["scan_id", "ind_num"])
    return final.select("scan_id", "ind_num", "probe", F.round("final_depth", 6).alias("final_depth"))


@query(
    "first_scan_kept_u4",
    with_tables("scans", "SELECT raw_outage, min(scan_id) AS scan_id, arg_min(scan_name, scan_id) AS scan_name FROM scans GROUP BY 1"),
)
def first_scan_kept(spark, sf_dir):
    rows = fx.scans(spark, sf_dir).select("raw_outage", "scan_id", "scan_name")
    return store.first_per_key(rows, "raw_outage", "scan_id")


@query(
    "train_val_u6",
    with_tables(
        "scans, reported",
        """SELECT scan_id, CASE WHEN EXISTS (SELECT 1 FROM reported r WHERE r.scan_id = s.scan_id AND r.flaw_type = 'CC') THEN 'val' ELSE 'train' END AS train_val FROM scans s""",
    ),
)
def train_val(spark, sf_dir):
    members = fx.reported(spark, sf_dir).where("flaw_type = 'CC'")
    return store.mark_members(fx.scans(spark, sf_dir).select("scan_id"), members, "val", "train")


@query(
    "insert_delete_u7",
    with_tables(
        "scans",
        "SELECT scan_id, scan_name FROM scans WHERE scan_year <> 1999 UNION ALL SELECT -scan_id - 1, scan_name FROM scans WHERE scan_year = 1999",
    ),
)
def insert_delete(spark, sf_dir):
    scans = fx.scans(spark, sf_dir).select("scan_id", "scan_name", "scan_year")
    gone = scans.where("scan_year = 1999")
    added = gone.select((-F.col("scan_id") - 1).alias("scan_id"), "scan_name")
    return store.delete_scans(scans, gone).select("scan_id", "scan_name").unionByName(added)


@query(
    "upsert_u8",
    with_tables(
        "predicted, reported",
        """, o AS (SELECT scan_id, ind_num, flaw_type, rotary_start, depth, 'V1' AS version, CASE WHEN length > 1.3 THEN 'R' || ind_num END AS reported_id FROM reported WHERE width <> 7),
n AS (SELECT scan_id, ind_num, flaw_type, rotary_start, depth, CASE WHEN width > 9 THEN 'V2' ELSE 'V1' END AS version FROM predicted WHERE width <> 8)
SELECT scan_id, ind_num, o.flaw_type, o.rotary_start, CASE WHEN n.version <> o.version THEN coalesce(o.depth, n.depth) ELSE coalesce(n.depth, o.depth) END AS depth,
  coalesce(n.version, o.version) AS version, o.reported_id FROM o LEFT JOIN n USING (scan_id, ind_num)""",
    ),
)
def upsert(spark, sf_dir):
    old = fx.reported(spark, sf_dir).where("width <> 7").select(
        "scan_id", "ind_num", "flaw_type", "rotary_start", "depth", F.lit("V1").alias("version"),
        F.when(F.col("length") > 1.3, F.concat(F.lit("R"), F.col("ind_num"))).alias("reported_id"),
    )
    new = fx.predicted(spark, sf_dir).where("width <> 8").select(
        "scan_id", "ind_num", "flaw_type", "rotary_start", "depth", F.when(F.col("width") > 9, "V2").otherwise("V1").alias("version")
    )
    return store.keep_depth_across_versions(old, new, ["scan_id", "ind_num"])


@query(
    "upsert_scans_u8",
    with_tables(
        "scans",
        """, o AS (SELECT scan_id, scan_name, scan_unit, scan_year FROM scans WHERE scan_unit <> 2),
n AS (SELECT scan_id, CASE WHEN scan_unit > 4 THEN scan_name || ' v2' END AS scan_name, scan_unit + 100 AS scan_unit FROM scans WHERE scan_unit <> 3)
SELECT scan_id, coalesce(n.scan_name, o.scan_name) AS scan_name, coalesce(o.scan_unit, n.scan_unit)::INTEGER AS scan_unit, o.scan_year FROM o FULL JOIN n USING (scan_id)""",
    ),
)
def upsert_scans(spark, sf_dir):
    scans = fx.scans(spark, sf_dir)
    old = scans.where("scan_unit <> 2").select("scan_id", "scan_name", "scan_unit", "scan_year")
    name = F.when(F.col("scan_unit") > 4, F.concat(F.col("scan_name"), F.lit(" v2")))
    new = scans.where("scan_unit <> 3").select("scan_id", name.alias("scan_name"), (F.col("scan_unit") + 100).alias("scan_unit"))
    return store.upsert(old, new, ["scan_id"], keep_old=["scan_unit"])


@query(
    "rejects_u9",
    with_tables("predicted", "SELECT scan_id, ind_num, CASE WHEN depth_text IS NULL THEN 'depth is missing' ELSE 'depth is not a number' END AS error FROM predicted WHERE TRY_CAST(depth_text AS DOUBLE) IS NULL"),
)
def rejects(spark, sf_dir):
    number = F.col("depth_text").try_cast("double")
    error = F.when(F.col("depth_text").isNull(), "depth is missing").when(number.isNull(), "depth is not a number")
    rows = fx.predicted(spark, sf_dir).select("scan_id", "ind_num", error.alias("error"))
    return store.split_failures(rows)[1]
