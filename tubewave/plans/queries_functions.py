"""Scalar functions over texts, names, numbers and maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry, text
from .fixtures import given, predicted, reported, scans, with_tables
from .registry import query


@query(
    "measure_texts_f1_f2",
    with_tables(
        "predicted, reported",
        """SELECT p.scan_id, p.ind_num,
  TRY_CAST(trim(replace(replace(split_part(r.depth_text, '(', 1), '<', ''), '*', '')) AS DOUBLE) AS reported_number,
  CASE WHEN p.depth_text = 'nan (2)' THEN 'See note_2'
       WHEN TRY_CAST(split_part(p.depth_text, ' ', 1) AS DOUBLE) < 0.1 AND contains(p.depth_text, ' ') THEN '< 0.1 (2)'
       WHEN TRY_CAST(split_part(p.depth_text, ' ', 1) AS DOUBLE) < 0.1 THEN '< 0.1' ELSE p.depth_text END AS depth_out,
  CASE WHEN p.length < 1.5 THEN '< 1.5' ELSE CAST(p.length AS VARCHAR) END AS length_out
FROM predicted p JOIN reported r USING (scan_id, ind_num)""",
    ),
)
def measure_texts(spark, sf_dir):
    rep = reported(spark, sf_dir).select("scan_id", "ind_num", text.parse_measure(F.col("depth_text")).alias("reported_number"))
    return predicted(spark, sf_dir).join(rep, ["scan_id", "ind_num"]).select(
        "scan_id", "ind_num", "reported_number", text.depth_text(F.col("depth_text")).alias("depth_out"),
        text.extent_text(F.col("length")).alias("length_out"),
    )


CATEGORY_DEPTHS_SQL = """SELECT scan_id, ind_num,
  CASE WHEN substr(ind_num, 1, 1) = '1' THEN NULL ELSE [depth_text, CASE WHEN substr(ind_num, 1, 1) = '2' THEN '0.05 (2)' ELSE '0.07' END] END AS vals,
  CASE WHEN substr(ind_num, 1, 1) = '1' THEN NULL ELSE ['CC', 'Debris'] END AS names
FROM predicted"""


@query(
    "category_depth_text_f3_f4",
    with_tables(
        "predicted",
        f""", c AS ({CATEGORY_DEPTHS_SQL})
SELECT scan_id, ind_num,
  CASE WHEN vals IS NULL THEN NULL
       WHEN TRY_CAST(split_part(vals[1], ' ', 1) AS DOUBLE) < 0.1 AND TRY_CAST(split_part(vals[2], ' ', 1) AS DOUBLE) < 0.1
       THEN CASE WHEN contains(vals[1], '(2)') OR contains(vals[2], '(2)') THEN '< 0.1 (1)(2)' ELSE '< 0.1 (1)' END
       ELSE 'see possible category flaw depth' END AS depth_out,
  CASE WHEN vals IS NULL THEN NULL ELSE concat_ws(' ', names[1] || ': ' || vals[1] || '.', names[2] || ': ' || vals[2] || '.') END AS sentence
FROM c""",
    ),
)
def category_depth_text(spark, sf_dir):
    first = F.substring("ind_num", 1, 1)
    depths = F.when(
        first != "1",
        F.create_map(
            F.lit("CC"), F.col("depth_text"), F.lit("Debris"), F.when(first == "2", "0.05 (2)").otherwise("0.07")
        ),
    )
    rows = predicted(spark, sf_dir)
    return rows.select(
        "scan_id", "ind_num", text.category_depth_text(depths).alias("depth_out"), text.map_sentence(depths).alias("sentence")
    )


COUNT_MAP = {
    0: [],
    1: [("V", 1)],
    2: [("V", 3)],
    3: [("V", 1), ("default", 1)],
    4: [("MR", 2), ("V", 1)],
    5: [("V", 1), ("MR", 1), ("7", 2)],
    6: [("Spaghetti", 1), ("V", 2)],
    7: [("MR", 4)],
    8: [("default", 1)],
    9: [("default", 2), ("7", 1)],
}


def _count_map(index):
    """Class counts chosen by a column, so that every labelling rule is met."""
    out = F.create_map().cast("map<string,int>")
    for i, pairs in COUNT_MAP.items():
        if pairs:
            entries = F.create_map(*[x for k, v in pairs for x in (F.lit(k), F.lit(v).cast("int"))])
            out = F.when(index == i, entries).otherwise(out)
    return out


@query(
    "class_count_label_f7_a20",
    """SELECT l_returnflag AS flag, CASE l_suppkey % 10 WHEN 0 THEN 'dnd' WHEN 1 THEN 'V' WHEN 2 THEN 'MV' WHEN 3 THEN 'V+d'
  WHEN 4 THEN 'V+M' WHEN 5 THEN 'V+M+7' WHEN 6 THEN 's' WHEN 7 THEN 'M' WHEN 8 THEN 'd' ELSE '7+d' END AS label,
  count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2""",
)
def class_count_label(spark, sf_dir):
    rows = given(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), text.category_label(_count_map(F.col("l_suppkey") % 10)).alias("label")
    )
    return rows.groupBy("flag", "label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "scan_names_f8_f10_f11_f12_f13",
    with_tables(
        "scans",
        """SELECT scan_id,
  CASE WHEN raw_outage LIKE 'D%' AND regexp_extract(substr(raw_outage, 2), '([0-9][0-9])', 1) <> ''
       THEN 2000 + CAST(regexp_extract(substr(raw_outage, 2), '([0-9][0-9])', 1) AS INTEGER) END AS outage_year,
  regexp_extract(scan_name, 'Type (\\w+)', 1) AS scan_type,
  substr(scan_station, 1, 1) || scan_year || scan_unit || '1' AS outage_number,
  CASE WHEN extension = 'daq' THEN raw_pitch ELSE round(raw_pitch, 1) / 10 END AS scan_pitch,
  CASE WHEN (raw_pitch * 100) % 360 < 180 THEN 0 ELSE 360 END AS boundary
FROM scans""",
    ),
)
def scan_names(spark, sf_dir):
    return scans(spark, sf_dir).select(
        "scan_id",
        text.outage_year(F.col("raw_outage")).alias("outage_year"),
        text.scan_type(F.col("scan_name")).alias("scan_type"),
        text.outage_number(F.col("scan_station"), F.col("scan_year"), F.col("scan_unit")).alias("outage_number"),
        text.scan_pitch(F.col("raw_pitch"), F.col("extension")).alias("scan_pitch"),
        geometry.nearest_boundary(F.col("raw_pitch") * 100).alias("boundary"),
    )


@query(
    "file_name_facts_f9",
    with_tables(
        "scans",
        """, w AS (SELECT *, string_split(scan_name, ' ') AS words FROM scans),
named AS (SELECT scan_id, scan_name, CASE WHEN contains(scan_name, 'Type D')
    THEN CASE WHEN contains(words[5], 'Darlington') THEN 'Darlington' ELSE 'Pickering' END
    ELSE CASE WHEN words[2] LIKE 'D%' THEN 'Darlington' ELSE 'Pickering' END END AS station, words FROM w)
SELECT scan_id, station,
  CASE WHEN NOT contains(scan_name, 'Type D') THEN words[2]
    WHEN len(words) = 9 THEN words[4]
    WHEN substr(station, 1, 1) || right(string_split(words[-3], '-')[-1], 2) || string_split(words[6], '-')[-1] || '1' = 'D2111'
    THEN 'D2011'
    ELSE substr(station, 1, 1) || right(string_split(words[-3], '-')[-1], 2) || string_split(words[6], '-')[-1] || '1' END AS outage,
  CASE WHEN NOT contains(scan_name, 'Type D') THEN substr(trim(words[3], '-'), 1, 3)
    WHEN len(words) = 9 THEN substr(trim(words[5], '-'), 1, 3) ELSE substr(replace(words[4], '-', ''), 1, 3) END AS channel
FROM named""",
    ),
)
def file_name_facts(spark, sf_dir):
    facts = text.file_name_facts(F.col("scan_name"))
    return scans(spark, sf_dir).select("scan_id", facts.alias("f")).select("scan_id", "f.station", "f.outage", "f.channel")


@query(
    "scan_paths_f9",
    with_tables(
        "scans",
        """, d AS (SELECT *, CASE WHEN scan_unit = 5 THEN 'P2251' ELSE raw_outage END AS outage,
  replace(scan_channel, '-', '') AS folder FROM scans)
SELECT scan_id,
  '/raw/Scan Data - ' || CASE substr(outage, 1, 1) WHEN 'D' THEN 'Darlington' ELSE 'Pickering' END || '/' || outage || '/' || folder
  || '/' || replace(scan_name, 'BSCAN Type D', 'BSCAN Type A')
  || CASE WHEN outage = 'P2251' AND folder <> 'N09' THEN '.daq' ELSE '.anf' END AS path_a,
  CASE WHEN outage = 'P2251' AND folder <> 'N09' THEN NULL ELSE '/raw/Scan Data - '
  || CASE substr(outage, 1, 1) WHEN 'D' THEN 'Darlington' ELSE 'Pickering' END || '/' || outage || '/' || folder
  || '/' || scan_name || '.anf' END AS path_d
FROM d""",
    ),
)
def scan_paths(spark, sf_dir):
    outage = F.when(F.col("scan_unit") == 5, F.lit("P2251")).otherwise(F.col("raw_outage"))
    path_a, path_d = text.scan_file_path(outage, F.col("scan_channel"), F.col("scan_name"), "/raw")
    return scans(spark, sf_dir).select("scan_id", path_a.alias("path_a"), path_d.alias("path_d"))


@query(
    "path_out_of_quotes_f14",
    "SELECT o_orderkey AS scan_id, '/data/' || o_orderpriority || '/' || o_orderkey AS path FROM orders",
)
def path_out_of_quotes(spark, sf_dir):
    stored = F.format_string("(WindowsPath('/data/%s/%d'),)", "o_orderpriority", "o_orderkey")
    return given(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("scan_id"), text.quoted_path(stored).alias("path"))


@query(
    "text_numbers_f17_f19_f20_f22",
    """SELECT l_linestatus AS status, sum(round(l_tax + 0.1, 2) + l_discount) AS total, sum(l_linenumber)::BIGINT AS frames,
  count(*)::BIGINT AS n, sum(length(l_returnflag))::BIGINT AS chars, sum(CASE WHEN l_tax = 0 THEN 1 ELSE 2 END)::BIGINT AS kept
FROM (SELECT *, 1 AS one FROM lineitem) GROUP BY 1""".replace(
        "sum(round(l_tax + 0.1, 2) + l_discount)", "round(sum(round(l_tax + 0.1, 2) + l_discount), 4)"
    ),
)
def text_numbers(spark, sf_dir):
    words = F.concat_ws(" ", F.round(F.col("l_tax") + 0.1, 2).cast("string"), F.lit("(2)"), F.col("l_discount").cast("string"))
    numbers = text.numbers_in(words)
    frame = text.frame_number(F.format_string("frame_%03d", "l_linenumber"))
    flag = text.until_nul(F.concat(F.col("l_returnflag"), F.lit("\x00\x00junk")))
    nested = F.array(F.array(F.lit("x"), F.lit("")), F.array(F.when(F.col("l_tax") == 0, "0").otherwise("5")))
    kept = F.size(text.drop_empty(F.flatten(nested)))
    rows = given(spark, sf_dir, "lineitem").select(
        F.col("l_linestatus").alias("status"),
        F.aggregate(numbers, F.lit(0.0), lambda a, v: a + v).alias("total"),
        frame.alias("frame"), F.length(flag).alias("chars"), kept.alias("kept"),
    )
    return rows.groupBy("status").agg(
        F.round(F.sum("total"), 4).alias("total"), F.sum("frame").alias("frames"), F.count(F.lit(1)).alias("n"),
        F.sum("chars").alias("chars"), F.sum("kept").alias("kept"),
    )


@query(
    "nice_axis_f18",
    """WITH r AS (SELECT l_orderkey AS scan_id, min(l_extendedprice) AS a, max(l_extendedprice) + 1 AS b FROM lineitem GROUP BY 1),
n1 AS (SELECT *, b - a AS width, pow(10.0, floor(log10(b - a))) AS m FROM r),
n2 AS (SELECT *, (CASE WHEN width / m <= 1 THEN 1.0 WHEN width / m <= 2 THEN 2.0 WHEN width / m <= 5 THEN 5.0 ELSE 10.0 END) * m / 9
  AS part FROM n1),
n3 AS (SELECT *, pow(10.0, floor(log10(part))) AS m2 FROM n2),
n4 AS (SELECT *, (CASE WHEN part / m2 < 1.5 THEN 1.0 WHEN part / m2 < 3 THEN 2.0 WHEN part / m2 < 7 THEN 5.0 ELSE 10.0 END) * m2
  AS base FROM n3),
n5 AS (SELECT *, (SELECT base * f FROM (VALUES (1, 1.0), (2, 0.5), (3, 0.25), (4, 0.2), (5, 0.1), (6, 0.05), (7, 0.025), (8, 0.01)) v(i, f)
  WHERE floor(width / (base * f)) + 1 >= 10 ORDER BY i LIMIT 1) AS tick FROM n4)
SELECT scan_id, round(floor(a / tick) * tick, 4) AS first, round(ceil(b / tick) * tick, 4) AS last, round(tick, 6) AS tick FROM n5""",
)
def nice_axis(spark, sf_dir):
    ranges = given(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("scan_id")).agg(
        F.min("l_extendedprice").alias("a"), (F.max("l_extendedprice") + 1).alias("b")
    )
    return text.with_nice_axis(ranges, "a", "b").select(
        "scan_id", F.round("first", 4).alias("first"), F.round("last", 4).alias("last"), F.round("tick", 6).alias("tick")
    )


@query(
    "ordered_unique_u5",
    """SELECT l_orderkey AS scan_id, l_returnflag || CASE WHEN l_linestatus <> l_returnflag THEN ',' || l_linestatus ELSE '' END AS cats,
  count(*)::BIGINT AS n FROM lineitem GROUP BY 1, 2""",
)
def ordered_unique(spark, sf_dir):
    cats = F.array_distinct(F.array("l_returnflag", "l_linestatus", "l_returnflag"))
    rows = given(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("scan_id"), F.array_join(cats, ",").alias("cats"))
    return rows.groupBy("scan_id", "cats").agg(F.count(F.lit(1)).alias("n"))


@query(
    "channel_labels_s6",
    """WITH l AS (SELECT o_orderkey AS scan_id, o_custkey % 2 = 1 AS type_d, CASE o_custkey % 6 WHEN 0 THEN '[8] ID1 NB'
  WHEN 1 THEN 'ID2 NB' WHEN 2 THEN 'x Circ Shear P/C' WHEN 3 THEN 'Axial Shear P/C' WHEN 4 THEN 'ID NB' ELSE 'spare' END AS raw
  FROM orders),
c AS (SELECT *, CASE WHEN contains(raw, 'ID1 NB') THEN 'ID1 NB' WHEN contains(raw, 'ID2 NB') THEN 'ID2 NB'
  WHEN contains(raw, 'Circ Shear P/C') THEN 'Circ Shear P/C' WHEN contains(raw, 'Axial Shear P/C') THEN 'Axial Shear P/C'
  WHEN contains(raw, 'ID NB') THEN 'ID1 NB' ELSE raw END AS label FROM l)
SELECT scan_id, label, unnest(CASE WHEN type_d AND label IN ('ID1 NB', 'ID2 NB') THEN ['NB1', 'NB2'] ELSE [CASE label
  WHEN 'ID1 NB' THEN 'NB1' WHEN 'ID2 NB' THEN 'NB2' WHEN 'Circ Shear P/C' THEN 'CPC' WHEN 'Axial Shear P/C' THEN 'APC' ELSE 'NA' END]
  END) AS probe FROM c""",
)
def channel_labels(spark, sf_dir):
    kind = F.col("o_custkey") % 6
    raw = (
        F.when(kind == 0, "[8] ID1 NB").when(kind == 1, "ID2 NB").when(kind == 2, "x Circ Shear P/C")
        .when(kind == 3, "Axial Shear P/C").when(kind == 4, "ID NB").otherwise("spare")
    )
    rows = given(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("scan_id"), text.clean_label(raw).alias("label"), (F.col("o_custkey") % 2 == 1).alias("type_d")
    )
    return rows.select("scan_id", "label", F.explode(text.label_probes(F.col("label"), F.col("type_d"))).alias("probe"))


@query(
    "sample_units_p26",
    """SELECT event_id, greatest(round(value * 0.008 * 0.71, 4), 0.0) AS mm, least(greatest(round(value * 0.008 * 0.71, 4), 0.0), 0.3) AS capped,
  round(value / 0.71 / 0.008, 4) AS samples FROM events""",
)
def sample_units(spark, sf_dir):
    v = F.col("value")
    return given(spark, sf_dir, "events").select(
        "event_id", text.samples_to_mm(v).alias("mm"), text.samples_to_mm(v, 0.3).alias("capped"),
        F.round(text.mm_to_samples(v), 4).alias("samples"),
    )
