"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: How to free what a Python worker keeps from task to task, by operator.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(operator: str, free: Callable[[], None]) -> None:
    _KEPT[operator] = free


def begin(operator: str) -> None:
    """A task of ``operator`` begins. Spark gives a worker tasks of all operators in turn; it forgets what it kept for the others."""
    for other, free in _KEPT.items():
        if other != operator:
            free()


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case; every other letter stays as it is."""
    return F.translate(column, UPPER, UPPER.lower())


def sha256_hex(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def own_name(wanted: str, taken: Iterable[str]) -> str:
    """``wanted``, with underscores in front until no column of the input has that name."""
    names = {name.lower() for name in taken}
    while wanted.lower() in names:
        wanted = f"_{wanted}"
    return wanted


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces whose texts take about ``most_bytes``; a longer text makes a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes, dtype=np.int64) // most_bytes
        edges = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for start, stop in pairwise(edges):
            yield batch.slice(start, stop - start)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes]:
    """UTF-8 bytes of each text; a missing text counts as empty."""
    binary = batch.column(column).cast(pa.binary())
    return [value or b"" for value in binary.to_pylist()]


def with_schema(df: DataFrame, added: str) -> str:
    """DDL of the columns of ``df`` followed by ``added``."""
    own = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return f"{own}, {added}"
