"""Packing of documents into sequences of a fixed length, with a bounded number of open windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import begin, own_name, slices, texts_of
from .tokens import encoder

LENGTH = 2048
#: Windows that a partition keeps open.
OPEN_WINDOWS = 16
#: Partitions whose leftovers are merged in one task: at most 64 x 16 windows of 8 kB.
MERGED_PARTITIONS = 64
PIECE = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class Windows:
    """Places pieces ``(row, start, ids, doc_tokens)``; ``ids`` are little-endian 32-bit numbers as bytes."""

    def __init__(self, length: int, most: int):
        self.length, self.most = length, most
        self.open: list[list] = []  # [used, pieces]
        self.full: list[list[tuple]] = []

    def add(self, row, start: int, ids: bytes, total: int) -> None:
        """Place one piece: best fit among the open windows; when none fits and no more may be opened, the fullest is
        filled up with the head of the piece and emitted."""
        length = self.length
        while len(ids) >= 4 * length:
            self.full.append([(row, start, ids[: 4 * length], total)])
            ids, start = ids[4 * length :], start + length
        while ids:
            size = len(ids) // 4
            best = max((w for w in self.open if w[0] + size <= length), key=lambda w: w[0], default=None)
            if best is None and len(self.open) < self.most:
                best = [0, []]
                self.open.append(best)
            if best is None:
                best = max(self.open, key=lambda w: w[0])
                size = length - best[0]
            best[0] += size
            best[1].append((row, start, ids[: 4 * size], total))
            ids, start = ids[4 * size :], start + size
            if best[0] == length:
                self.full.append(best[1])
                self.open.remove(best)

    def take(self) -> list[list[tuple]]:
        out, self.full = self.full, []
        return out

    def close(self) -> None:
        """Merge what is still open: full sequences as long as there is enough, then lengths that are powers of two."""
        left = [piece for _, pieces in sorted(self.open, key=lambda w: -w[0]) for piece in pieces]
        rest = sum(len(ids) // 4 for _, _, ids, _ in left)
        self.open = []
        sequence: list[tuple] = []
        room = target = 0
        for row, start, ids, total in left:
            while ids:
                if not room:
                    room = target = min(self.length, 1 << (rest.bit_length() - 1))
                    rest -= target
                size = min(room, len(ids) // 4)
                sequence.append((row, start, ids[: 4 * size], total))
                ids, start, room = ids[4 * size :], start + size, room - size
                if not room:
                    self.full.append(sequence)
                    sequence = []


def pack(
    docs: DataFrame, tokenizer: str, spaces: str, end_id: int, text: str = "text", keep: list[str] | None = None,
    length: int = LENGTH, open_windows: int = OPEN_WINDOWS, with_ids: bool = True,
) -> DataFrame:
    """Pieces of documents in sequences of at most ``length`` tokens: ``keep`` columns and ``PIECE``.

    ``tokenizer`` is a file that every executor can read, ``spaces`` tells what it does with white space (see
    ``tokens.Encoder``), ``end_id`` follows each document. A NULL or empty text is that one id. Each id is in exactly one
    piece; offsets in a sequence are gapless. ``ids`` are little-endian 32-bit numbers (NULL without ``with_ids``). Rows are
    independent, so repeated rows, NULL keys and equal ids give pieces each. Columns in ``keep`` with one of the new names get
    underscores in front; an empty table gives no piece. ``length`` is a power of two.

    Each partition packs its rows as they come, with ``open_windows`` windows in memory. What stays open is merged for
    groups of ``MERGED_PARTITIONS`` partitions; the rest of a group goes into sequences whose lengths are powers of two.
    Sequence numbers are built from partition numbers, so a lost task writes the same rows again.
    """
    if length & (length - 1):
        raise ValueError("length must be a power of two")
    new = [part.split()[0] for part in PIECE.split(", ")] + ["part", "window"]
    kept_columns = [F.col(c) for c in keep or []] or [F.lit(None).cast("int").alias("_none")]  # rows need a column
    source = docs.select(*kept_columns, F.col(text).alias(own_name("_text", keep or [])))
    text = source.columns[-1]
    names = [own_name(c, [*source.columns, *new]) if c in new else c for c in source.columns[:-1]]
    source = source.toDF(*names, text)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])
    schema = f"{kinds}, {PIECE}"
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("tokens")
        encode, windows = encoder(tokenizer, spaces).encode, Windows(length, open_windows)
        part, count = TaskContext.get().partitionId(), 0
        kept: list[pa.RecordBatch] = []
        first = 0  # number of the first row in `kept`
        at = 0
        for batch in slices(batches, text, 1 << 20):
            kept.append(batch.select(names))
            for ids in encode(texts_of(batch, text)):
                windows.add(at, 0, ids + end, len(ids) // 4 + 1)
                at += 1
            done = windows.take()
            yield from pieces(kept, first, done, (part << 32) + count, None)
            count += len(done)
            # rows that open windows still refer to stay, the others go
            used = sorted({piece[0] for _, own in windows.open for piece in own})
            kept, first, renumber = _only(kept, first, used), at - len(used), {row: at - len(used) + k for k, row in enumerate(used)}
            windows.open = [[size, [(renumber[p[0]], *p[1:]) for p in own]] for size, own in windows.open]
        yield from pieces(kept, first, [own for _, own in windows.open], None, part)

    def pieces(kept, first, sequences, number, part) -> Iterator[pa.RecordBatch]:
        """Rows of finished sequences, or with ``part`` of open windows: those keep their ids and have no number."""
        if not sequences:
            return
        flat = [(k, offset, *piece) for k, own in enumerate(sequences) for offset, piece in zip(_offsets(own), own, strict=True)]
        rows = pa.Table.from_batches(kept).take(pa.array([f[2] - first for f in flat], pa.int64()))
        ids = [f[4] for f in flat]
        columns = [
            pa.array([f[3] for f in flat], pa.int64()),
            pa.array([len(b) // 4 for b in ids], pa.int64()),
            pa.array([zlib.crc32(b) for b in ids], pa.int64()),
            pa.array([f[5] for f in flat], pa.int64()),
            pa.array([None if part is not None else number + f[0] for f in flat], pa.int64()),
            pa.array([f[1] for f in flat], pa.int64()),
            pa.array(ids if with_ids or part is not None else [None] * len(ids), pa.binary()),
            pa.array([part] * len(flat), pa.int64()),
            pa.array([f[0] for f in flat], pa.int32()),
        ]
        table = pa.Table.from_arrays([*rows.columns, *columns], [*names, *new])
        yield from table.combine_chunks().to_batches()

    def merge(table: pa.Table) -> pa.Table:
        windows = Windows(length, open_windows)
        order = [("part", "ascending"), ("window", "ascending"), ("offset", "ascending")]
        table = table.sort_by(order)
        for row, (start, ids, total) in enumerate(zip(*(table.column(c).to_pylist() for c in ("start", "ids", "doc_tokens")), strict=True)):
            windows.add(row, start, ids, total)
        windows.close()
        group = table.column("part")[0].as_py() // MERGED_PARTITIONS
        kept = table.select(names).combine_chunks().to_batches()
        return pa.Table.from_batches(list(pieces(kept, 0, windows.take(), (1 << 62) + (group << 32), None))).drop_columns(["part", "window"])

    first = cut_lineage(source.mapInArrow(run, f"{schema}, part long, window int"), "packed")
    done = first.where("part IS NULL").drop("part", "window")
    left = first.where("part IS NOT NULL").groupBy(F.expr(f"part DIV {MERGED_PARTITIONS}")).applyInArrow(merge, schema)
    return done.unionByName(left).drop(*([] if keep else names))


def _offsets(pieces: list[tuple]) -> list[int]:
    return np.cumsum([0, *(len(ids) // 4 for _, _, ids, _ in pieces[:-1])]).tolist()


def _only(kept: list[pa.RecordBatch], first: int, used: list[int]) -> list[pa.RecordBatch]:
    if not kept or not used:
        return []
    return pa.Table.from_batches(kept).take(pa.array([u - first for u in used], pa.int64())).combine_chunks().to_batches()
