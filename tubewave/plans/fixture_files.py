"""Scan files in both recorded layouts, made from A-scans, for queries and tests of the readers."""

from __future__ import annotations

import os
import struct

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..sources import binary as b


def anf_bytes(blocks: list[tuple[str, list[tuple[float, np.ndarray]]]], first_rotary: int = 0) -> bytes:
    """An .anf file with one block of (axial, samples) frames per channel label."""
    head = b.ANF_HEAD.pack(1, 4, 21, 6, 15, 9, b"K", 1, 1, b"HEAD-1", b"operator", b"15-Jun-21", b"12:00:00")
    labels = [label.encode() for label, _ in blocks] + [b""] * (16 - len(blocks))
    start = 4096
    offsets, body = [], b""
    for _, frames in blocks:
        offsets.append(start + len(body))
        rotary, time = frames[0][1].shape
        body += b.ANF_BLOCK.pack(time, rotary, len(frames))
        for axial, data in frames:
            body += b.ANF_FRAME.pack(axial, first_rotary) + data.astype(np.uint8).tobytes()
    axials = [a for _, frames in blocks for a, _ in frames]
    extended = b.ANF_EXTENDED.pack(
        1, 1, 0, first_rotary, 0, 3599, 0, 3, 1, 0, 10, min(axials), max(axials), 3, *[0] * 4, *[0] * 7, b"comment", *labels, *[0] * 16,
        *offsets, *[0] * (8 - len(offsets)), *[0] * 25, *[0] * 25, *[0] * 5, 0.1, 0.1, 0.0, 0, *[b""] * 4,
    )
    hardware = b"".join(b.ANF_CHANNEL.pack(20 + i, 100, 50, 1, 20) for i in range(b.ANF_HARDWARE_CHANNELS))
    hardware += bytes(2 * b.ANF_HARDWARE_CHANNELS) + struct.pack(f"<{2 * b.ANF_GATES}H", *range(2 * b.ANF_GATES))
    out = bytearray(start)
    out[: len(head)] = head
    out[b.ANF_EXTENDED_AT : b.ANF_EXTENDED_AT + len(extended)] = extended
    out[b.ANF_HARDWARE_AT : b.ANF_HARDWARE_AT + len(hardware)] = hardware
    return bytes(out) + body


def _text(value: str) -> bytes:
    return bytes([len(value)]) + value.encode()


def daq_bytes(channels: list[tuple[str, list[tuple[float, np.ndarray]]]], infos: dict[str, str]) -> bytes:
    """A .daq file; every frame holds the A-scans of all channels."""
    frames = len(channels[0][1])
    out = b.DAQ_PREFIX.encode() + struct.pack("<HH", 7, 0) + _text("operator") + _text("HEAD-2") + _text("S1")
    out += struct.pack("<6I", 2022, 3, 9, 10, 11, 12) + struct.pack("<III", 50, 12, frames) + struct.pack("<QI", 0, len(channels))
    for i, (label, data) in enumerate(channels):
        rotary, time = data[0][1].shape
        out += _text(f"{i + 1} {label}") + struct.pack("<4IB", 0, rotary, 1, 50, 1) + _text("filter")
        out += struct.pack("<6I", 1, 20, 0, 0, 0, time) + struct.pack("<f", 12.5) + struct.pack("<4HBBHHBB", 100, 50, 1, 1, 0, 0, 1, 1, 0, 0)
        out += _text("gate") + struct.pack("<4H", 5, 60, 0, 0) + struct.pack("<I", 0) + bytes(2)
    out += struct.pack("<I", 2) + _text("axes") + struct.pack("<I", 0)
    for unit in ("mm", "deg"):
        out += b"\x01" + bytes(4 + 4 + 16 + 16 + 4 + 16) + _text(unit)
    out += b"\x00" + _text("probe") + struct.pack("<HI", 1, 0) + _text("p") + struct.pack("<3f", 5.0, 0.0, 0.0)
    out += struct.pack("<I", 0) + struct.pack("<I", len(infos)) + b"".join(_text(k) + _text(v) for k, v in infos.items())
    table = len(out) + 8 + 12 * frames
    body, places = b"", []
    for i in range(frames):
        places.append(table + len(body))
        for _, data in channels:
            axial, samples = data[i]
            body += bytes(b.DAQ_AXIAL_AT) + struct.pack("<f", axial) + bytes(12) + struct.pack("<I", samples.shape[1])
            for row in samples:
                body += bytes(b.DAQ_ASCAN_HEADER) + row.astype("<u2").tobytes()
    return out + struct.pack("<Q", table) + struct.pack(f"<{frames}Q", *places) + struct.pack(f"<{frames}I", *range(frames)) + body


def write_scan_files(ascans: DataFrame, folder: str, fmt: str) -> DataFrame:
    """One file per scan of the fixture (512 A-scans at most); returns the paths.

    Files hold whole turns and, in one layout, equally many frames of each channel. What a scan lacks is written as A-scans of zeros.
    """

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        scan = int(pdf["scan_id"].iloc[0])
        pdf = pdf.sort_values(["probe", "frame", "rotary_idx"])
        channels: dict[str, list[tuple[float, np.ndarray]]] = {}
        for (probe, frame), rows in pdf.groupby(["probe", "frame"], sort=True):
            data = np.stack(rows["samples"].to_numpy())
            turn = np.zeros((64, data.shape[1]), data.dtype)
            turn[rows["rotary_idx"].to_numpy()] = data
            channels.setdefault("ID1 NB" if probe == "NB1" else "ID2 NB", []).append((2500.0 + 0.3 * frame, turn))
        longest = max(len(v) for v in channels.values()) if fmt == "daq" else 0
        blocks = [(label, [*frames, *[(frames[-1][0], np.zeros_like(frames[-1][1]))] * (longest - len(frames))]) for label, frames in channels.items()]
        os.makedirs(folder, exist_ok=True)
        path = f"{folder}/BSCAN Type A {scan}.{fmt}"
        content = anf_bytes(blocks, first_rotary=3590) if fmt == "anf" else daq_bytes(blocks, {"Station": "North", "Unit": "3", "Axial Pitch": "0.3"})
        with open(path, "wb") as f:
            f.write(content)
        return pd.DataFrame({"path": [path]})

    return ascans.groupBy("scan_id").applyInPandas(write, "path STRING")
