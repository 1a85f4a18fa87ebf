import numpy as np
import pytest
from pyspark.sql import functions as F

from tubewave.functions import text
from tubewave.operators import projections, scoring, sizing
from tubewave.plans import fixture_files
from tubewave.sources import binary, database, tables
from tubewave.streaming import summary

rng = np.random.default_rng(5)


def cube(frames, rotary, time, low=100, high=150):
    return [(2500.0 + 0.3 * i, rng.integers(low, high, (rotary, time))) for i in range(frames)]


@pytest.fixture(scope="module")
def anf(tmp_path_factory):
    folder = tmp_path_factory.mktemp("anf")
    a, b, shear = cube(4, 6, 20), cube(3, 6, 20), cube(2, 5, 10)
    (folder / "BSCAN Type D one.anf").write_bytes(fixture_files.anf_bytes([("[8] ID1 NB", a), ("[9] Axial Shear P/C", shear)], 3598))
    (folder / "BSCAN Type A two.anf").write_bytes(fixture_files.anf_bytes([("ID2 NB", b)]))
    (folder / "broken.anf").write_bytes(b"short")
    return folder, a, b, shear


def test_type_d_frames_alternate(spark, anf):
    folder, a, _, shear = anf
    rows = binary.read_scans(spark, f"{folder}/BSCAN*one.anf", split_mb=0.0005).collect()
    got = {(r.probe, r.frame, r.rotary_idx): r for r in rows}
    assert {k[0] for k in got} == {"NB1", "NB2", "APC"}
    for i, (axial, data) in enumerate(a):
        probe, frame = ("NB1", "NB2")[i % 2], i // 2
        for r in range(6):
            assert list(got[(probe, frame, r)].samples) == data[r].tolist()
            assert got[(probe, frame, r)].axial_mm == pytest.approx(axial, abs=1e-3)
    assert [round(got[("NB1", 0, r)].rotary_deg, 1) for r in range(3)] == [359.8, 359.9, 0.0]
    assert len(rows) == 4 * 6 + 2 * 5
    assert list(got[("APC", 1, 4)].samples) == shear[1][1][4].tolist()


def test_conditions_prune_frames(spark, anf):
    folder, _, b, _ = anf
    df = binary.read_scans(spark, f"{folder}/BSCAN*.anf").where("scan_id = 'BSCAN Type A two' AND frame >= 1 AND probe IN ('NB2')")
    rows = df.collect()
    assert {r.frame for r in rows} == {1, 2} and len(rows) == 12
    roi = projections.region(binary.read_scans(spark, f"{folder}/BSCAN*two.anf"), (0, 1), (2, 3), (4, 8)).collect()
    assert len(roi) == 4 and all(list(r.samples) == b[r.frame][1][r.rotary_idx][4:9].tolist() for r in roi)


def test_headers_and_rejects(spark, anf):
    folder, *_ = anf
    rows = {r.scan_id: r for r in binary.read_headers(spark, f"{folder}/*.anf").collect()}
    one = rows["BSCAN Type D one"]
    assert (one.unit, one.year, one.month, one.day, one.channel, one.operator) == (4, 21, 6, 15, "K09", "operator")
    assert [c.label for c in one.channels] == ["ID1 NB", "Axial Shear P/C"]
    assert [(c.gain, c.gate_start, c.gate_width) for c in one.channels] == [(20.0, 0, 20), (21.0, 1, 21)]
    assert one.frames == 2 and list(one.probes) == ["NB1", "NB2", "APC"]
    assert rows["broken"].error is not None and one.error is None


def test_daq(spark, tmp_path):
    a, b = cube(3, 4, 15, 1900, 2200), cube(3, 4, 12, 1900, 2200)
    infos = {"Station": "North", "Unit": "3", "Channel": "B14", "Axial Pitch": "0.3"}
    (tmp_path / "scan.daq").write_bytes(fixture_files.daq_bytes([("ID1 NB", a), ("Circ Shear P/C", b)], infos))
    got = {(r.probe, r.frame, r.rotary_idx): r for r in binary.read_scans(spark, f"{tmp_path}/*.daq", split_mb=0.0005).collect()}
    assert len(got) == 24
    for probe, data in (("NB1", a), ("CPC", b)):
        for i, (axial, samples) in enumerate(data):
            assert list(got[(probe, i, 3)].samples) == samples[3].tolist()
            assert got[(probe, i, 0)].axial_mm == pytest.approx(axial, abs=1e-3)
    head = binary.read_headers(spark, f"{tmp_path}/*.daq").first()
    assert (head.unit, head.channel, head.axial_pitch, head.frames) == (3, "B14", 0.3, 3)
    assert head.infos["Station"] == "North" and head.channels[0].gain == 12.5 and head.channels[1].gate_width == 60


def test_other_extension_is_an_error(spark, tmp_path):
    (tmp_path / "scan.xyz").write_bytes(b"")
    with pytest.raises(Exception, match="unknown scan file extension"):
        binary.read_scans(spark, f"{tmp_path}/*.xyz").collect()
    with pytest.raises(ValueError):
        projections.check_range(5, 4)


def test_legacy_database_document(spark, tmp_path):
    (tmp_path / "db.json").write_text(
        '{"scans": [{"scan_id": "s1", "year": 2021,\n "flaws": [{"ind_num": "Ind 1", "depth": "0.2 (2)"}]}, {"scan_id": "s2", "flaws": []}]}'
    )
    docs = database.read_documents(spark, str(tmp_path / "db.json"), whole_file=True)
    assert docs.count() == 2
    assert [(r.scan_id, r.ind_num, r.depth) for r in database.child_table(docs, "flaws").collect()] == [("s1", "Ind 1", "0.2 (2)")]
    database.write_table(docs.select("scan_id", F.lit("D1").alias("outage_number")), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_scan_list(spark, tmp_path):
    (tmp_path / "list.txt").write_text("/x/BSCAN Type D 1.anf\n\n/x/b.DAQ\n/x/c.txt\n")
    good, bad = tables.route_by_extension(tables.read_scan_list(spark, str(tmp_path / "list.txt")))
    assert {(r.path, r.format) for r in good.collect()} == {("/x/BSCAN Type A 1.anf", "anf"), ("/x/b.DAQ", "daq")}
    assert [r.path for r in bad.collect()] == ["/x/c.txt"]


def test_new_runs_are_appended_once(spark, tmp_path):
    folder, out, log = (str(tmp_path / n) for n in ("runs", "summary", "log"))
    schema = "scan_id BIGINT, depth DOUBLE"
    for start in (0, 10):
        spark.range(start, start + 10).select(F.col("id").alias("scan_id"), F.lit(0.1).alias("depth")).write.mode("append").parquet(folder)
        for _ in range(2):
            summary.append_new_runs(spark, folder, schema, out, log).awaitTermination()
    assert spark.read.parquet(out).count() == 20


@pytest.mark.parametrize(
    "outage, channel, folder", [("D1711", "G-13", "G13"), ("P1361", "B-14 x", "B14"), ("D1711", "D-6", "D06")]
)
def test_scan_paths(spark, outage, channel, folder):
    df = spark.createDataFrame([(outage, channel, "BSCAN Type D n")], "o STRING, c STRING, f STRING")
    a, d = text.scan_file_path(F.col("o"), F.col("c"), F.col("f"), "/r")
    row = df.select(a.alias("a"), d.alias("d")).first()
    station = {"D": "Darlington", "P": "Pickering"}[outage[0]]
    assert row.a == f"/r/Scan Data - {station}/{outage}/{folder}/BSCAN Type A n.anf"
    assert row.d.endswith("BSCAN Type D n.anf")


def test_unknown_outage_has_no_path(spark):
    df = spark.createDataFrame([("A1234", "B-14", "n")], "o STRING, c STRING, f STRING")
    assert df.select(text.scan_file_path(F.col("o"), F.col("c"), F.col("f"), "/r")[0]).first()[0] is None


def test_letterbox_and_mapping_back(spark):
    box, scale, left, top = scoring.letterbox(np.full((10, 40), 200.0), 80)
    assert (scale, left, top) == (2.0, 0, 30) and box[0, 0] == 114 and box[40, 10] == 200
    pixels = np.full((10, 40), 50)
    pixels[4:7, 20:30] = 250
    images = spark.createDataFrame([(1, pixels.ravel().tolist(), 10, 40)], "id INT, pixels ARRAY<INT>, height INT, width INT")
    r = scoring.score_images(images, ["id"], lambda: scoring.BrightRegion(0.8), ["V"], 80).first()
    # enlarging blurs the edges by up to half a pixel
    assert (r.x1, r.y1, r.x2, r.y2) == pytest.approx((20, 4, 30, 7), abs=0.51)


def test_alignment_finds_a_known_lag(spark):
    """Flaw echo later than the surface echo by a known number of samples."""
    echo = np.array([0, 10, 40, 90, 60, 20, 0])

    def scan(at):
        s = np.full(80, 128)
        s[at : at + 7] += echo
        return s.tolist()

    rows = [(1, "NB1", f, r, scan(30 + (5 if 8 <= r <= 10 else 0))) for f in range(3) for r in range(20)]
    ascans = spark.createDataFrame(rows, "scan_id INT, probe STRING, frame BIGINT, rotary_idx BIGINT, samples ARRAY<INT>")
    flaws = spark.createDataFrame([(1, "NB1", "f", 0, 2, 8, 10)], "scan_id INT, probe STRING, flaw_id STRING, frame_start BIGINT, frame_end BIGINT, rotary_start BIGINT, rotary_end BIGINT")
    cells = sizing.size_by_alignment(flaws, ascans, 2, 20).collect()
    assert len(cells) == 9 and {c.lag for c in cells} == {5}
    assert {c.raw_depth for c in cells} == {round(5 * 0.008 * 0.71, 4)}
