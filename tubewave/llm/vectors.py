"""Near-duplicate vectors by cosine, with a pigeonhole join over low-dimensional blocks of rotated vectors."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components

#: Dimensions of a block, and leading ones of a block by which it is dealt to cells.
BLOCK, CELL_DIMENSIONS = 16, 2
#: Vectors from which the rotation and the shares of the blocks are computed.
ROTATION_ROWS = 5_000
#: Vectors at home in a tile, which are held in memory, and vectors that visit it, which pass by.
HOMES, VISITORS = 8_000, 40_000
#: Visitors that are compared with all homes at a time.
ABREAST = 512


class Rotation:
    """Orthonormal axes in the order of falling spread, dealt to blocks of about equal spread, with their shares of the budget."""

    def __init__(self, sample: np.ndarray, block: int = BLOCK):
        n = sample.shape[1]
        spread, axes = np.linalg.eigh(sample.T @ sample / max(len(sample), 1))
        order = np.argsort(-spread)
        blocks = -(-n // block)
        # snake through the blocks, so that each gets strong and weak axes, strong ones first
        places = [[] for _ in range(blocks)]
        for k, axis in enumerate(order):
            at = k % blocks
            places[at if (k // blocks) % 2 == 0 else blocks - 1 - at].append(axis)
        self.axes = [axes[:, p] for p in places]
        energy = np.array([max(spread[p].sum(), 1e-12) for p in places])
        self.shares = energy / energy.sum()

    def blocks(self, vectors: np.ndarray) -> list[np.ndarray]:
        return [vectors @ own for own in self.axes]


def unit(vector) -> np.ndarray | None:
    """The vector as doubles of length 1; None if it is missing, empty, zero or has missing or non-finite parts."""
    if vector is None or len(vector) == 0 or any(v is None for v in vector):
        return None
    own = np.asarray(vector, np.float64)
    if not np.isfinite(own).all():
        return None
    own = own / (np.abs(own).max() or 1)  # no overflow of squares
    length = np.linalg.norm(own)
    return own / length if length > 0 else None


def pack(vector) -> tuple[int, bytes] | None:
    """Dimensions and bytes of a usable vector, in single precision if that loses nothing; None for one that has no unit."""
    if unit(vector) is None:
        return None
    own = np.asarray(vector, np.float64)
    single = own.astype(np.float32)
    return len(own), (single if (single == own).all() else own).tobytes()


def unpack(vectors: list[bytes], size: int) -> np.ndarray:
    """Unit vectors, one a row, in double precision."""
    return np.stack([unit(np.frombuffer(v, np.float32 if len(v) == 4 * size else np.float64)) for v in vectors]) if vectors else np.zeros((0, size))


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """``key, n_links, component_id, kept`` for every row of ``table``.

    Two rows link if the cosine of their vectors, in double precision, is ``cosine`` or more. Vectors that are NULL, empty,
    zero or hold NULL or non-finite parts link with nothing; vectors of different length do not link with each other.
    Rows with the same vector are one vector that counts as often as it occurs. ``component_id`` is the smallest key
    reachable by links (a NULL key counts as larger than all), ``kept`` tells whether that is the own key.

    Vectors are scaled to length 1 and rotated to principal axes (fitted to at most ``ROTATION_ROWS`` rows, which changes
    speed only). If the cosine is reached, the squared distance is at most ``2 - 2 cosine``, so in one block at least it is
    within that block's share of it. Each block is range-joined by cells of its leading axes: a vector is at home in one
    cell and visits those within its radius. Cells are dealt to tiles of ``HOMES`` and ``VISITORS``. Candidates within
    a block's budget are verified with all dimensions; a pair counts in its first such block only, so links are counted
    without being listed, and tiles give sums by vector and the links of a spanning forest.
    """
    lead = table.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
    kind = lead.schema["key"].dataType.simpleString()
    probe = lead.select("key").limit(0).toArrow().schema.field("key").type

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pack(v) for v in batch.column("vector").to_pylist()]
            packed = [f and f[1] for f in found]
            # copies of a vector are told by its digest
            uids = [None if p is None else xxhash.xxh3_64_intdigest(p) - (1 << 63) for p in packed]
            yield pa.RecordBatch.from_arrays([batch.column("key").cast(probe), pa.array(uids, pa.int64()), pa.array([f and f[0] for f in found], pa.int32()), pa.array(packed, pa.binary())], ["key", "uid", "size", "vector"])

    rows = cut_lineage(lead.mapInArrow(scale, f"key {kind}, uid long, size int, vector binary"), "vectors")
    distinct = cut_lineage(rows.where("uid IS NOT NULL").groupBy("uid").agg(F.first("size").alias("size"), F.first("vector").alias("vector"), F.count("*").alias("copies")), "distinct-vectors")
    links = [_links_of(distinct.where(F.col("size") == r.size), r.size, cosine) for r in distinct.select("size").distinct().orderBy("size").collect()]

    named = rows.select("key", "uid").join(distinct.select("uid", "copies"), "uid", "left")
    if not links:
        return _result(named.withColumn("other", F.lit(0)).withColumn("component", F.col("uid")), key)
    counts, forest = links[0]
    for more, trees in links[1:]:
        counts, forest = counts.union(more), forest.union(trees)
    counts = counts.groupBy("uid").agg(F.sum("links").alias("other"))
    return _result(named.join(counts, "uid", "left").join(components(forest).withColumnRenamed("node", "uid"), "uid", "left"), key)


def _result(named: DataFrame, key: str) -> DataFrame:
    named = cut_lineage(named.withColumn("class", F.coalesce("component", "uid")).withColumn("n_links", (F.coalesce("copies", F.lit(1)) - 1 + F.coalesce("other", F.lit(0))).cast("long")), "vector-classes")
    low = named.where("class IS NOT NULL").groupBy("class").agg(F.min("key").alias("low"))
    component = F.coalesce("low", "key")
    return named.join(low, "class", "left").select(F.col("key").alias(key), "n_links", component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"))


def _links_of(vectors: DataFrame, size: int, cosine: float) -> tuple[DataFrame, DataFrame]:
    """For distinct unit vectors of ``size`` dimensions: ``uid, links`` (linked rows of other vectors), and links ``a, b``."""
    sample = vectors.orderBy("uid").limit(ROTATION_ROWS).select("vector").toPandas()["vector"].tolist()
    rotation = Rotation(unpack(sample, size))
    budget = max(2 - 2 * cosine, 0) * (1 + 1e-9) + 1e-12
    budgets = rotation.shares * budget
    shared = vectors.sparkSession.sparkContext.broadcast(rotation)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each block and cell that a vector lives in or visits."""
        for batch in batches:
            own = unpack(batch.column("vector").to_pylist(), size)
            parts = []
            for number, block in enumerate(shared.value.blocks(own)):
                radius = np.sqrt(budgets[number])
                led = block[:, :CELL_DIMENSIONS] / radius
                home = np.floor(led).astype(np.int64)
                for step in np.ndindex(*(3,) * led.shape[1]):
                    cell = home + np.array(step) - 1
                    # distance to the cell, in radii; nothing is left out for rounding
                    gap = np.maximum(np.maximum(cell - led, led - cell - 1), 0)
                    near = np.flatnonzero((gap**2).sum(axis=1) <= 1 + 1e-9)
                    flat = cell[near, 0] * 1_000_003 + (cell[near, 1] if cell.shape[1] > 1 else 0)
                    parts.append((near, np.full(len(near), number), flat, np.full(len(near), all(s == 1 for s in step))))
            at, number, cell, home = (np.concatenate([p[k] for p in parts]) for k in range(4))
            yield pa.RecordBatch.from_arrays([batch.column("uid").take(pa.array(at)), pa.array(number.astype(np.int32)), pa.array(cell), pa.array(home.astype(bool))], ["uid", "block", "cell", "home"])

    placed = cut_lineage(vectors.select("uid", "vector").mapInArrow(cells, "uid long, block int, cell long, home boolean"), "cells")
    tiles = placed.groupBy("block", "cell").agg(F.ceil(F.sum(F.col("home").cast("int")) / HOMES).cast("int").alias("homes"), F.ceil(F.count("*") / VISITORS).cast("int").alias("visits")).where("homes > 0")
    dealt = placed.join(tiles, ["block", "cell"])
    left = dealt.where("home").select("uid", "block", "cell", F.pmod(F.xxhash64("uid", "block"), F.col("homes")).cast("int").alias("row"), F.expr("explode(sequence(0, visits - 1))").alias("col"), F.lit(True).alias("home"))
    right = dealt.select("uid", "block", "cell", F.expr("explode(sequence(0, homes - 1))").alias("row"), F.pmod(F.xxhash64("uid", "block", F.lit(3)), F.col("visits")).cast("int").alias("col"), F.lit(False).alias("home"))
    members = left.union(right).join(vectors.drop("size"), "uid")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, group = None, None
        names = ("block", "cell", "row", "col")
        for batch in batches:
            rows: list[tuple] = []
            keys = list(zip(*(batch.column(c).to_pylist() for c in (*names, "home")), strict=True))
            edges = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
            for start, stop in pairwise(edges):
                *own, home = keys[start]
                if own != group:
                    rows += tile.result() if tile else []
                    group, tile = own, _Tile(own[0], shared.value, budgets, cosine, size)
                part = batch.slice(start, stop - start)
                tile.add(home, *(part.column(c).to_pylist() for c in ("uid", "copies", "vector")))
            if rows:
                yield _link_batch(rows)
        if tile and (rows := tile.result()):
            yield _link_batch(rows)

    keys = ["block", "cell", "row", "col"]
    found = members.select(*keys, "home", "uid", "copies", "vector").repartition(*keys).sortWithinPartitions(*keys, F.desc("home"))
    found = cut_lineage(found.mapInArrow(compare, "uid long, links long, other long"), "tiles")
    return found.where("other IS NULL").select("uid", "links"), found.where("other IS NOT NULL").select(F.col("uid").alias("a"), F.col("other").alias("b"))


def _link_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["uid", "links", "other"])


class _Tile:
    """Vectors at home in a cell, held, and visitors that pass by; counts links that have their first block within budget here."""

    def __init__(self, block: int, rotation: Rotation, budgets: np.ndarray, cosine: float, size: int):
        self.block, self.rotation, self.budgets, self.cosine, self.size = block, rotation, budgets, cosine, size
        self.waiting: list[list] = [[], [], []]
        self.homes: tuple | None = None
        self.sums: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []
        self.parent: dict[int, int] = {}

    def add(self, home: bool, uids: list[int], copies: list[int], vectors: list[bytes]) -> None:
        if home:
            for own, new in zip(self.waiting, (uids, copies, vectors), strict=True):
                own.extend(new)
            return
        if self.homes is None:
            self.homes = self._read(*self.waiting)
            self.waiting = [[], [], []]
        for s in range(0, len(uids), ABREAST):
            self._meet(*self._read(uids[s : s + ABREAST], copies[s : s + ABREAST], vectors[s : s + ABREAST]))

    def _read(self, uids: list[int], copies: list[int], vectors: list[bytes]) -> tuple:
        units = unpack(vectors, self.size)
        own = units @ self.rotation.axes[self.block]
        return np.array(uids, np.int64), np.array(copies, np.int64), units, own.astype(np.float32), ((own**2).sum(axis=1) / 2).astype(np.float32)

    def _meet(self, uids: np.ndarray, copies: np.ndarray, units: np.ndarray, own: np.ndarray, half: np.ndarray) -> None:
        ids, weights, others, block, halves = self.homes
        # candidates: squared distance within budget, in single precision with slack
        near = own @ block.T - halves >= (half - np.float32(self.budgets[self.block] / 2 + 1e-5))[:, None]
        j, i = np.nonzero(near)
        first = ids[i] < uids[j]  # of a pair the smaller number is the one at home
        i, j = i[first], j[first]
        for s in range(0, len(i), 50_000):
            pi, pj = i[s : s + 50_000], j[s : s + 50_000]
            x, y = others[pi], units[pj]
            linked = np.einsum("ij,ij->i", x, y) >= self.cosine
            pi, pj, gap = pi[linked], pj[linked], x[linked] - y[linked]
            if not len(pi):
                continue
            within = np.stack([(part**2).sum(axis=1) <= own for part, own in zip(self.rotation.blocks(gap), self.budgets, strict=True)], axis=1)
            here = within.argmax(axis=1) == self.block
            pi, pj = pi[here], pj[here]
            for a, b, n, m in zip(ids[pi].tolist(), uids[pj].tolist(), copies[pj].tolist(), weights[pi].tolist(), strict=True):
                self.sums[a] = self.sums.get(a, 0) + n
                self.sums[b] = self.sums.get(b, 0) + m
                ra, rb = self._root(a), self._root(b)
                if ra != rb:
                    self.parent[max(ra, rb)] = min(ra, rb)
                    self.links.append((a, b))

    def _root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = parent.setdefault(parent[x], parent[x])
            x = parent[x]
        return x

    def result(self) -> list[tuple]:
        """Sums by vector, then a spanning forest of the links."""
        return [(uid, n, None) for uid, n in self.sums.items()] + [(a, None, b) for a, b in self.links]
