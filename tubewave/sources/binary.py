"""Spark data source for recorded scan files (.anf and .daq).

The driver only lists files and their sizes. Each file is cut into as many splits as its size asks for;
a split reads the header itself, takes its share of the frames and emits one Arrow batch per frame, so
files far beyond 2 GB are read in parallel and no task holds more than one frame.
"""

from __future__ import annotations

import glob
import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from ..functions.text import CHANNEL_LABELS, LABEL_PROBE

ASCAN_SCHEMA = "scan_id STRING, probe STRING, frame INT, rotary_idx INT, axial_mm DOUBLE, rotary_deg DOUBLE, samples ARRAY<SMALLINT>"
CHANNEL_SCHEMA = (
    "ARRAY<STRUCT<label: STRING, gain: DOUBLE, pulse_voltage: INT, pulse_width: INT, low_filter: INT, high_filter: INT, "
    "gate_start: INT, gate_width: INT>>"
)
HEADER_SCHEMA = (
    "scan_id STRING, path STRING, format STRING, station STRING, unit INT, year INT, month INT, day INT, channel STRING, operator STRING, "
    "head_id STRING, axial_pitch DOUBLE, axial_start DOUBLE, axial_end DOUBLE, first_rotary DOUBLE, frames INT, "
    f"probes ARRAY<STRING>, channels {CHANNEL_SCHEMA}, infos MAP<STRING, STRING>, error STRING"
)

# Layout of the .anf header (little endian) and of its hardware block.
ANF_HEAD = struct.Struct("<6BcBB10s22s10s10s")
ANF_EXTENDED_AT = 70
ANF_EXTENDED = struct.Struct("<BBHHHHBBBBHffBx4H7h60s10x" + "21s" * 16 + "16h8Q25h25H5HfffQ" + "12s" * 4)
ANF_HARDWARE_AT = 800
ANF_CHANNEL = struct.Struct("<BHHBB")
ANF_HARDWARE_CHANNELS, ANF_GATES = 12, 20
ANF_BLOCK = struct.Struct("<HHH")
ANF_FRAME = struct.Struct("<fH")
# Sizes within a .daq frame.
DAQ_PREFIX = "ANDEDAQ"
DAQ_FRAME_HEADER, DAQ_AXIAL_AT, DAQ_COUNT_AT, DAQ_ASCAN_HEADER, DAQ_SAMPLE = 32, 12, 28, 26, 2
DEGREES_PER_STEP = 0.1


def nul_text(raw: bytes) -> str:
    return raw.split(b"\0", 1)[0].decode("latin-1").strip()


def expected_label(label: str) -> str:
    return next((clean for part, clean in CHANNEL_LABELS if part in label), label)


@dataclass
class Track:
    """Where the frames of one probe lie: first frame, distance between frames, sizes."""

    probe: str
    rotary: int
    time: int
    frames: int
    offsets: list[int]


@dataclass
class Scan:
    """What a header says about a scan file."""

    facts: dict
    tracks: list[Track]
    channels: list[dict] = field(default_factory=list)
    infos: dict[str, str] = field(default_factory=dict)
    first_rotary: float = 0.0


def read_anf_header(f, name: str) -> Scan:
    """Header, hardware settings and frame places of an .anf file.

    In Type D scans the frames of both normal-beam probes alternate in one block.
    """
    f.seek(0)
    station, unit, year, month, day, number, letter, _, _, head, operator, _, _ = ANF_HEAD.unpack(f.read(ANF_HEAD.size))
    f.seek(ANF_EXTENDED_AT)
    values = ANF_EXTENDED.unpack(f.read(ANF_EXTENDED.size))
    first_rotary, axial_start, axial_end, pitch = values[3], values[11], values[12], values[13]
    labels = [t for t in (nul_text(raw) for raw in values[26:42]) if t]
    labels = labels if set(labels) & set(LABEL_PROBE) else [expected_label(t) for t in labels]
    offsets = [o for o in values[58:66] if o]
    interleaved = "Type D" in name
    tracks = []
    for label, offset in zip(labels, offsets):
        f.seek(offset)
        time, rotary, frames = ANF_BLOCK.unpack(f.read(ANF_BLOCK.size))
        size = time * rotary + ANF_FRAME.size
        both = interleaved and label == "ID1 NB"
        probes = ["NB1", "NB2"] if both else [LABEL_PROBE.get(label, "NA")]
        for k, probe in enumerate(probes):
            count = frames // len(probes)
            first = offset + ANF_BLOCK.size
            tracks.append(Track(probe, rotary, time, count, [first + (i * len(probes) + k) * size for i in range(count)]))
    facts = {
        "station": str(station), "unit": unit, "year": year, "month": month, "day": day, "channel": f"{letter.decode('latin-1')}{number:02d}",
        "operator": nul_text(operator), "head_id": nul_text(head), "axial_pitch": float(pitch), "axial_start": axial_start, "axial_end": axial_end,
    }
    return Scan(facts, tracks, _anf_channels(f, labels), {}, float(first_rotary))


def _anf_channels(f, labels: list[str]) -> list[dict]:
    f.seek(ANF_HARDWARE_AT)
    raw = f.read(ANF_CHANNEL.size * ANF_HARDWARE_CHANNELS)
    f.seek(2 * ANF_HARDWARE_CHANNELS, os.SEEK_CUR)
    gates = struct.unpack(f"<{2 * ANF_GATES}H", f.read(4 * ANF_GATES))
    out = []
    for i, label in enumerate(labels[:ANF_HARDWARE_CHANNELS]):
        gain, voltage, width, low, high = ANF_CHANNEL.unpack_from(raw, i * ANF_CHANNEL.size)
        out.append(
            {"label": label, "gain": float(gain), "pulse_voltage": voltage, "pulse_width": width, "low_filter": low, "high_filter": high,
             "gate_start": gates[i], "gate_width": gates[ANF_GATES + i]}
        )
    return out


class Cursor:
    """Reads little-endian numbers and length-prefixed texts one after the other."""

    def __init__(self, f):
        self.f = f

    def uint(self, size: int) -> int:
        return int.from_bytes(self.f.read(size), "little")

    def uints(self, *sizes: int) -> list[int]:
        return [self.uint(s) for s in sizes]

    def text(self) -> str:
        return self.f.read(self.uint(1)).decode("latin-1")

    def skip(self, size: int) -> None:
        self.f.seek(size, os.SEEK_CUR)


def read_daq_header(f, name: str) -> Scan:
    """Variable-length header of a .daq file; each frame holds all channels one after the other."""
    f.seek(0)
    c = Cursor(f)
    if f.read(7).decode("latin-1") != DAQ_PREFIX:
        raise ValueError("not a .daq file")
    major, minor = c.uints(2, 2)
    operator, head, _ = c.text(), c.text(), c.text()
    year, month, day = c.uints(4, 4, 4)
    c.skip(12 + 8)
    frames = c.uint(4)
    c.skip(8)
    channels, rx = [], []
    for _ in range(c.uint(4)):
        label = c.text().split(" ", 1)[1]
        _, n_rx, _, _, _ = c.uints(4, 4, 4, 4, 1)
        c.text()
        low, high, _, _, _, _ = c.uints(4, 4, 4, 4, 4, 4)
        if major + minor / 10 > 6.5:
            gain = struct.unpack("<f", f.read(4))[0]
        else:
            gain = float("nan")
            c.skip(16)
        voltage, width, _, _, _, _, _, _, _, _ = c.uints(2, 2, 2, 2, 1, 1, 2, 2, 1, 1)
        c.text()
        gate_start, gate_width, _, _ = c.uints(2, 2, 2, 2)
        for _ in range(c.uint(4)):
            c.text()
            c.skip(8)
        c.skip(2)
        rx.append(n_rx)
        channels.append({"label": label, "gain": gain, "pulse_voltage": voltage, "pulse_width": width, "low_filter": low, "high_filter": high,
                         "gate_start": gate_start, "gate_width": gate_width})
    c.skip(4)
    c.text()
    c.skip(4)
    for _ in range(2):
        if c.uint(1):
            c.skip(4 + 4 + 16 + 16 + 4 + 16)
            c.text()
    c.skip(1)
    c.text()
    probes = c.uint(2)
    c.skip(4)
    for _ in range(probes):
        c.text()
        c.skip(12)
    infos: dict[str, str] = {}
    for _ in range(2):
        for _ in range(c.uint(4)):
            key = c.text()
            infos[key] = c.text()
    c.skip(8)
    places = [c.uint(8) for _ in range(frames)]
    offsets: list[list[int]] = [[] for _ in channels]
    sizes = [0] * len(channels)
    for place in places:
        at = place
        for j, n_rx in enumerate(rx):
            offsets[j].append(at)
            f.seek(at + DAQ_COUNT_AT)
            sizes[j] = c.uint(4)
            at += DAQ_FRAME_HEADER + (sizes[j] * DAQ_SAMPLE + DAQ_ASCAN_HEADER) * n_rx
    tracks = [Track(LABEL_PROBE.get(ch["label"], "NA"), rx[j], sizes[j], frames, offsets[j]) for j, ch in enumerate(channels)]

    def number(key: str) -> float | None:
        return float(infos[key]) if key in infos else None

    facts = {
        "station": infos.get("Station"), "unit": int(infos["Unit"]) if "Unit" in infos else None, "year": year % 100, "month": month, "day": day,
        "channel": infos.get("Channel"), "operator": operator, "head_id": head, "axial_pitch": number("Axial Pitch"),
        "axial_start": number("Axial Start"), "axial_end": number("Axial End"),
    }
    return Scan(facts, tracks, channels, infos, 0.0)


def read_frame(f, fmt: str, track: Track, frame: int) -> tuple[float, np.ndarray]:
    """Axial position and samples (rotary, time) of one frame."""
    f.seek(track.offsets[frame])
    if fmt == "anf":
        axial, _ = ANF_FRAME.unpack(f.read(ANF_FRAME.size))
        data = np.frombuffer(f.read(track.rotary * track.time), np.uint8).reshape(track.rotary, track.time)
        return axial, data.astype(np.int16)
    head = f.read(DAQ_FRAME_HEADER)
    axial = struct.unpack_from("<f", head, DAQ_AXIAL_AT)[0]
    count = struct.unpack_from("<I", head, DAQ_COUNT_AT)[0]
    row = DAQ_ASCAN_HEADER + count * DAQ_SAMPLE
    raw = np.frombuffer(f.read(row * track.rotary), np.uint8).reshape(track.rotary, row)
    return axial, np.ascontiguousarray(raw[:, DAQ_ASCAN_HEADER:]).view("<u2").astype(np.int16)


HEADER_READERS = {"anf": read_anf_header, "daq": read_daq_header}


def file_format(path: str) -> str:
    fmt = os.path.splitext(path)[1].lower().lstrip(".")
    if fmt not in HEADER_READERS:
        raise ValueError(f"unknown scan file extension: {path}")
    return fmt


def scan_id_of(path: str) -> str:
    return os.path.splitext(os.path.basename(path))[0]


@dataclass
class Split(InputPartition):
    path: str
    part: int
    parts: int


class ScanReader(DataSourceReader):
    """Reads A-scans; conditions on scan, probe and frame decide what is read at all."""

    def __init__(self, options: dict, headers: bool):
        self.path = options["path"]
        self.split_bytes = int(float(options.get("splitMB", 128)) * 1024 * 1024)
        self.headers = headers
        self.filters: list = []

    def pushFilters(self, filters: list) -> Iterator:
        known = (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)
        for f in filters:
            if isinstance(f, known) and f.attribute in (("scan_id",), ("probe",), ("frame",)):
                self.filters.append(f)
            # Spark checks the rows again, so a missed condition costs time but not correctness
            yield f

    def _wanted(self, column: str, value) -> bool:
        for f in self.filters:
            if f.attribute != (column,):
                continue
            ok = (
                value == f.value if isinstance(f, EqualTo)
                else value in f.value if isinstance(f, In)
                else value > f.value if isinstance(f, GreaterThan)
                else value >= f.value if isinstance(f, GreaterThanOrEqual)
                else value < f.value if isinstance(f, LessThan)
                else value <= f.value
            )
            if not ok:
                return False
        return True

    def partitions(self) -> list[Split]:
        out = []
        for path in sorted(p for part in self.path.split(",") for p in glob.glob(part)):
            file_format(path)
            if not self._wanted("scan_id", scan_id_of(path)):
                continue
            parts = 1 if self.headers else max(1, -(-os.path.getsize(path) // self.split_bytes))
            out.extend(Split(path, i, parts) for i in range(parts))
        return out

    def read(self, split: Split) -> Iterator[pa.RecordBatch]:
        fmt, name = file_format(split.path), scan_id_of(split.path)
        if self.headers:
            yield self._header_batch(split.path, fmt, name)
            return
        with open(split.path, "rb") as f:
            scan = HEADER_READERS[fmt](f, os.path.basename(split.path))
            for track in scan.tracks:
                if not self._wanted("probe", track.probe):
                    continue
                for frame in range(track.frames * split.part // split.parts, track.frames * (split.part + 1) // split.parts):
                    if self._wanted("frame", frame):
                        yield self._frame_batch(name, track, frame, *read_frame(f, fmt, track, frame), scan.first_rotary)

    @staticmethod
    def _frame_batch(name: str, track: Track, frame: int, axial: float, data: np.ndarray, first_rotary: float) -> pa.RecordBatch:
        n, width = data.shape
        positions = np.arange(n, dtype=np.int32)
        samples = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(data.ravel()))
        columns = [
            pa.array([name] * n), pa.array([track.probe] * n), pa.array(np.full(n, frame, np.int32)), pa.array(positions), pa.array(np.full(n, axial, float)),
            pa.array((DEGREES_PER_STEP * (positions + first_rotary)) % 360.0), samples,
        ]
        return pa.RecordBatch.from_arrays(columns, names=["scan_id", "probe", "frame", "rotary_idx", "axial_mm", "rotary_deg", "samples"])

    @staticmethod
    def _header_batch(path: str, fmt: str, name: str) -> pa.RecordBatch:
        channel = pa.struct(
            [("label", pa.string()), ("gain", pa.float64()), *[(c, pa.int32()) for c in ("pulse_voltage", "pulse_width", "low_filter", "high_filter", "gate_start", "gate_width")]]
        )
        row: dict = {"scan_id": name, "path": path, "format": fmt, "error": None}
        try:
            with open(path, "rb") as f:
                scan = HEADER_READERS[fmt](f, os.path.basename(path))
            row |= scan.facts | {"first_rotary": scan.first_rotary, "frames": max((t.frames for t in scan.tracks), default=0), "probes": [t.probe for t in scan.tracks],
                                 "channels": scan.channels, "infos": list(scan.infos.items())}
        except (OSError, ValueError, struct.error, IndexError) as err:
            row["error"] = f"{type(err).__name__}: {err}"
        text, whole, real = pa.string(), pa.int32(), pa.float64()
        schema = pa.schema(
            [("scan_id", text), ("path", text), ("format", text), ("station", text), ("unit", whole), ("year", whole), ("month", whole), ("day", whole),
             ("channel", text), ("operator", text), ("head_id", text), ("axial_pitch", real), ("axial_start", real), ("axial_end", real), ("first_rotary", real),
             ("frames", whole), ("probes", pa.list_(text)), ("channels", pa.list_(channel)), ("infos", pa.map_(text, text)), ("error", text)]
        )
        return pa.RecordBatch.from_pylist([{f.name: row.get(f.name) for f in schema}], schema=schema)


class ScanSource(DataSource):
    """``format("tubescan")``: A-scans of all files that match the path (several patterns are separated by commas)."""

    @classmethod
    def name(cls) -> str:
        return "tubescan"

    def schema(self) -> str:
        return ASCAN_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return ScanReader(self.options, headers=False)


class ScanHeaderSource(DataSource):
    """``format("tubescan_header")``: one row per file with its header, channel settings and read error."""

    @classmethod
    def name(cls) -> str:
        return "tubescan_header"

    def schema(self) -> str:
        return HEADER_SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return HeaderReader(self.options, headers=True)


class HeaderReader(ScanReader):
    """Headers are small: every file is read, whatever the conditions."""

    def pushFilters(self, filters: list) -> Iterator:
        yield from filters


def read_scans(spark: SparkSession, path: str, split_mb: float = 128) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ScanSource)
    return spark.read.format("tubescan").option("path", path).option("splitMB", split_mb).load()


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ScanHeaderSource)
    return spark.read.format("tubescan_header").option("path", path).load()
