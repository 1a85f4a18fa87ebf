"""Removal of long passages that an earlier document already has, by super-k-mers of words."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import own_name, slices, texts_of, with_schema
from .jaccard import _ODD, _digests

#: Words of a window, and of the short runs whose smallest digest stands for a window.
WINDOW, MINIMISER = 50, 6
#: Windows that one bucket sorts in memory; buckets with more deal out their windows by digest.
BUCKET_WINDOWS = 20_000


def minimisers(words: list[bytes], window: int = WINDOW, size: int = MINIMISER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive windows that share their minimiser: its digest (signed), the first window, how many windows."""
    if len(words) < window:
        none = np.zeros(0, np.int64)
        return none, none, none
    own = np.fromiter(map(_digests.__getitem__, words), np.uint64, len(words))
    low = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        low += own[k : len(own) - size + 1 + k] * np.uint64(_ODD[k])
    low ^= low >> np.uint64(31)
    low *= np.uint64(_ODD[0])
    low ^= low >> np.uint64(29)
    reach, step = window - size + 1, 1
    while step * 2 <= reach:  # smallest of 2, 4, 8 … neighbours, then of two such stretches that cover the window
        low = np.minimum(low[: len(low) - step], low[step:])
        step *= 2
    low = np.minimum(low[: len(low) - (reach - step)], low[reach - step :])
    edges = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1, [len(low)]))
    return low[edges[:-1]].view(np.int64), edges[:-1], np.diff(edges)


def _runs(places: list[int]) -> list[tuple[int, int]]:
    """Rising numbers as runs: the first of neighbours and how many there are."""
    if not places:
        return []
    edges = [0, *(k for k in range(1, len(places)) if places[k] != places[k - 1] + 1), len(places)]
    return [(places[a], b - a) for a, b in pairwise(edges)]


def _order(key: Column) -> Column:
    """NULL keys come after all others."""
    return F.struct(key.isNull().alias("none"), key.alias("key"))


ADDED = "n_words long, n_removed long, kept_text string"


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """All rows of ``docs`` with ``n_words, n_removed, kept_text``.

    Words are split at ASCII white space. A word goes if a window of ``window`` words that covers it also starts in a row
    with a smaller key; windows are judged on the input. ``kept_text`` has the other words, joined by one space. NULL and
    empty texts have no words; a NULL key is larger than all keys; rows with equal keys take nothing from each other, so of
    repeated rows each keeps what the other does. Columns of ``docs`` with one of the new names get underscores in front.

    1. Equal texts are one text, held by its smallest key; a copy with a larger key loses everything from ``window`` words on.
    2. Each text names the minimisers of its runs of windows (super-k-mers). Only those of two or more texts go on.
    3. Such super-k-mers travel as packed words to the bucket of their minimiser, where their windows are sorted and equal
       ones told apart from all others word by word. A minimiser with more than ``BUCKET_WINDOWS`` windows has no bucket: its
       windows are compared by 128-bit digest in an aggregate and a join, in which pieces of rows ask once for each window,
       however many documents share it.
    """
    new = [part.split()[0] for part in ADDED.split(", ")]
    for name in new:
        if name in docs.columns:
            renamed = own_name(name, [*docs.columns, *new])
            docs = docs.withColumnRenamed(name, renamed)
            key, text = (renamed if c == name else c for c in (key, text))
    row = own_name("_row", docs.columns)
    lead = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("row"))

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            seen: set[int] = set()
            found = []
            for own, body in zip(batch.column("row").to_pylist(), texts_of(batch, "text"), strict=True):
                if own not in seen:
                    seen.add(own)
                    found.append((own, *minimisers(body.split(), window)))
            parts = [np.concatenate([f[k] for f in found]).astype(t) for k, t in ((1, np.int64), (2, np.int32), (3, np.int32))]
            rows = np.repeat(np.array([f[0] for f in found], np.int64), [len(f[1]) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(rows), *map(pa.array, parts)], ["row", "minimiser", "start", "windows"])

    found = cut_lineage(lead.select("row", "text").mapInArrow(runs, "row long, minimiser long, start int, windows int"), "super-k-mers")
    shared = found.groupBy("minimiser").agg(F.min("row").alias("low"), F.max("row").alias("high"), F.sum("windows").alias("total")).where("low < high")
    wanted = found.join(shared.select("minimiser", (F.col("total") > BUCKET_WINDOWS).alias("many")), "minimiser")
    wanted = wanted.groupBy("row").agg(F.collect_set(F.struct("start", "windows", "minimiser", "many")).alias("wanted"))
    holder = cut_lineage(lead.groupBy("row").agg(F.min(_order(F.col("key"))).alias("first")), "holders")

    kind = docs.schema[key].dataType.simpleString()
    held = lead.join(holder.join(wanted, "row").withColumnRenamed("row", "of"), (F.col("row") == F.col("of")) & F.col("key").eqNullSafe(F.col("first.key")))
    held = held.select("row", "first", "text", "wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Light super-k-mers with their words; heavy ones with the digests of their windows, and once in a piece of rows
        (about 1 MB of text) each window with the smallest and largest key that showed it."""
        schema = pa.schema([("piece", pa.int64()), ("row", pa.int64()), ("first", first_type), ("last", first_type), ("minimiser", pa.int64()), ("start", pa.int32()), ("packed", pa.binary()), ("digest", pa.binary())])
        part = TaskContext.get().partitionId() << 24
        for number, batch in enumerate(slices(batches, "text", 1 << 20)):
            piece, firsts = part + number, batch.column("first").to_pylist()
            order = sorted(range(len(firsts)), key=lambda k: (firsts[k]["none"], firsts[k]["key"]))
            texts, wanted, rows = texts_of(batch, "text"), batch.column("wanted").to_pylist(), batch.column("row").to_pylist()
            out = []
            shown: dict[bytes, list] = {}
            for at in order:
                words, first = texts[at].split(), firsts[at]
                for run in wanted[at]:
                    start, n = run["start"], run["windows"]
                    if not run["many"]:
                        out.append((None, rows[at], first, None, run["minimiser"], start, b" ".join(words[start : start + n + window - 1]), None))
                        continue
                    digests = [xxhash.xxh3_128_digest(b" ".join(words[k : k + window])) for k in range(start, start + n)]
                    for digest in digests:
                        shown.setdefault(digest, [first, None])[1] = first
                    out.append((piece, rows[at], first, None, None, start, b"".join(digests), None))
            out += [(piece, None, first, last, None, None, None, digest) for digest, (first, last) in shown.items()]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(schema)], schema=schema)

    first_type = pa.struct([("none", pa.bool_()), ("key", lead.select("key").limit(0).toArrow().schema.field("key").type)])
    first_kind = f"first struct<none: boolean, key: {kind}>, last struct<none: boolean, key: {kind}>"
    pieces = cut_lineage(held.mapInArrow(cut, f"piece long, row long, {first_kind}, minimiser long, start int, packed binary, digest binary"), "packed-windows")

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def repeats() -> list[tuple[int, int, int]]:
            """Rows, first windows and numbers of windows that a smaller key has as well."""
            if len(held) < 2:
                return []
            windows = []
            for at, (_, _, packed) in enumerate(held):
                ends = [k for k, c in enumerate(packed) if c == 0x20] + [len(packed)]
                starts = [0, *(e + 1 for e in ends)]
                windows += [(packed[starts[k] : ends[k + window - 1]], at, k) for k in range(len(ends) - window + 1)]
            # held is in the order of keys, so the first of equal windows is in the smallest key
            windows.sort()
            gone: dict[int, list[int]] = {}
            before, owner = None, None
            for words, at, k in windows:
                if words != before:
                    before, owner = words, held[at][0]
                elif held[at][0] != owner:
                    gone.setdefault(at, []).append(k)
            out = []
            for at, places in gone.items():
                out += [(held[at][1][0], held[at][1][1] + a, n) for a, n in _runs(sorted(places))]
            return out

        def out(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], ["row", "start", "windows"])

        for batch in batches:
            rows: list[tuple[int, int, int]] = []
            for own, first, minimiser, start, packed in zip(*(batch.column(c).to_pylist() for c in ("row", "first", "minimiser", "start", "packed")), strict=True):
                if minimiser != bucket:
                    rows += repeats()
                    bucket, held = minimiser, []
                held.append(((first["none"], first["key"]), (own, start), packed))
            if rows:
                yield out(rows)
        if rows := repeats():
            yield out(rows)

    light = pieces.where("minimiser IS NOT NULL").select("row", "first", "minimiser", "start", "packed")
    light = light.repartition("minimiser").sortWithinPartitions("minimiser", "first", "row", "start").mapInArrow(buckets, "row long, start int, windows int")
    one = F.struct("start", "windows")
    gone = light.groupBy("row").agg(F.collect_list(one).alias("light")).withColumnRenamed("row", "of")
    # heavy: pieces of rows ask for the smallest key of each of their windows once, and look it up for all of their rows
    windows = pieces.where("digest IS NOT NULL").select("piece", "first", "last", "digest")
    earliest = windows.groupBy("digest").agg(F.min("first").alias("low"), F.max("last").alias("high")).where("low < high").select("digest", "low")
    lows = windows.select(F.col("piece").alias("asking"), "digest").join(earliest, "digest")
    members = pieces.where("piece IS NOT NULL AND row IS NOT NULL").select("piece", "row", "first", "start", "packed")

    def look_up(asking: pa.Table, told: pa.Table) -> pa.Table:
        order = lambda key: (key["none"], key["key"])
        low = {d: order(k) for d, k in zip(told.column("digest").to_pylist(), told.column("low").to_pylist(), strict=True)}
        out: list[tuple] = []
        for own, first, start, packed in zip(*(asking.column(c).to_pylist() for c in ("row", "first", "start", "packed")), strict=True):
            first = order(first)
            gone = [k for k in range(len(packed) // 16) if (found := low.get(packed[16 * k : 16 * k + 16])) is not None and found < first]
            out += [(own, start + a, n) for a, n in _runs(gone)]
        return pa.table([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int32()))], ["row", "start", "windows"])

    found = members.groupBy("piece").cogroup(lows.groupBy("asking")).applyInArrow(look_up, "row long, start int, windows int")
    heavy = found.groupBy("row").agg(F.collect_list(one).alias("heavy")).withColumnRenamed("row", "of")
    holder = holder.withColumnRenamed("row", "of").join(gone, "of", "left").join(heavy, "of", "left")
    none = F.array().cast("array<struct<start: int, windows: int>>")
    fate = cut_lineage(holder.select("of", "first", F.concat(F.coalesce("light", none), F.coalesce("heavy", none)).alias("gone")), "repeats")

    names = docs.columns
    # helper columns of the last join, under names that the documents do not have
    of, first, lost, later = (own_name(name, names) for name in ("_of", "_first", "_gone", "_copy"))
    fate = fate.withColumnsRenamed({"of": of, "first": first, "gone": lost})

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            out = []
            for body, copy, gone in zip(texts_of(batch, text), batch.column(later).to_pylist(), batch.column(lost).to_pylist(), strict=True):
                words = body.split()
                marks = np.zeros(len(words) + 1, np.int64)
                for run in gone or []:
                    marks[run["start"]] += 1
                    marks[run["start"] + run["windows"] + window - 1] -= 1
                covered = np.cumsum(marks[:-1]) > 0
                if copy and len(words) >= window:
                    covered[:] = True
                n = int(covered.sum())
                kept = [w for w, c in zip(words, covered.tolist(), strict=True) if not c] if n else words
                out.append((len(words), n, b" ".join(kept).decode()))
            added = [pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.select(names).columns, *added], [*names, *new])

    judged = docs.withColumn(row, F.xxhash64(text)).join(fate, F.col(row) == F.col(of))
    judged = judged.withColumn(later, _order(F.col(key)) > F.col(first)).select(*names, later, lost)
    return judged.mapInArrow(keep, with_schema(docs, ADDED))
