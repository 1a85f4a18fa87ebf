"""Exact top-k by inner product over a bit-sliced index: scores are added up as bitmaps and searched from the highest bit."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Rows of a block of the index, and queries that meet a block at a time.
BLOCK_ROWS, CHUNK_QUERIES = 32_768, 1_024
#: Most tasks for pairs of a block and a chunk; beyond that several pairs follow each other in a task.
MOST_TASKS = 20_000
#: Largest quantised component in magnitude: squares of it can be added up 2**22 times in a long.
LARGEST = 1 << 20


def to_words(bits: np.ndarray) -> np.ndarray:
    """Rows of a bitmap as 64-bit words, the first row in the lowest bit."""
    packed = np.packbits(bits, axis=-1, bitorder="little")
    return np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, -packed.shape[-1] % 8)]).view(np.uint64)


def places(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


class Slices:
    """Slices of the integer columns of a block: bit ``j`` of ``column - lowest of the column`` for all rows is one bitmap."""

    def __init__(self, values: np.ndarray):
        self.rows = len(values)
        self.lowest = values.min(axis=0)
        above = (values - self.lowest).astype(np.uint64)
        self.width = [int(v).bit_length() for v in above.max(axis=0)]
        self.valid = to_words(np.ones(self.rows, bool))
        self.bits = [[to_words((above[:, d] >> np.uint64(j)) & np.uint64(1) == 1) for j in range(w)] for d, w in enumerate(self.width)]
        # a negative factor is a positive one of what is missing to the largest value
        self.missing = [[self.valid & ~b for b in own] for own in self.bits]

    def scores(self, query: list[int]) -> tuple[list[np.ndarray], int]:
        """Slices of ``score - constant`` of every row, lowest first, and the constant.

        Each set bit of a factor adds the column's slices, moved up by that bit. Three bitmaps of one level become one of
        it and one carry of the next, so the sum is never handled row by row.
        """
        waiting: list[list[np.ndarray]] = []
        constant = 0

        def put(level: int, bitmap: np.ndarray) -> None:
            while True:
                while len(waiting) <= level:
                    waiting.append([])
                own = waiting[level]
                if len(own) < 2:
                    own.append(bitmap)
                    return
                a, b = own
                odd = a ^ b
                own[:] = [odd ^ bitmap]
                level, bitmap = level + 1, (a & b) | (odd & bitmap)

        for factor, low, width, bits, missing in zip(query, self.lowest.tolist(), self.width, self.bits, self.missing, strict=True):
            constant += factor * low
            slices, size = (bits, factor) if factor >= 0 else (missing, -factor)
            if factor < 0:
                constant += factor * ((1 << width) - 1)
            for k in range(size.bit_length()):
                if size >> k & 1:
                    for j, bitmap in enumerate(slices):
                        put(j + k, bitmap)
        level = 0
        while level < len(waiting):
            if len(waiting[level]) == 2:
                a, b = waiting[level]
                waiting[level] = [a ^ b]
                put(level + 1, a & b)
            level += 1
        zero = np.zeros_like(self.valid)
        return [own[0] if own else zero for own in waiting], constant

    def top(self, query: list[int], k: int, without: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best rows but those of the bitmap ``without``; equal scores by smaller place.

        From the highest slice down, rows with a set bit are surely better than those without: they are taken if they are
        few enough, else the search goes on among them. What is undecided after the last slice has one and the same score,
        and its first rows fill up.
        """
        slices, constant = self.scores(query)
        taken = np.zeros_like(self.valid)
        open_ = self.valid if without is None else self.valid & ~without
        wanted = k
        for bitmap in reversed(slices):
            better = open_ & bitmap
            n = int(np.bitwise_count(better).sum())
            if n > wanted:
                open_ = better
            else:
                taken, open_, wanted = taken | better, open_ & ~bitmap, wanted - n
                if not wanted:
                    break
        found = np.concatenate([places(taken), places(open_)[:wanted] if wanted else np.zeros(0, np.int64)]).astype(np.int64)
        score = np.full(len(found), constant, np.int64)
        word, bit = found >> 6, (found & 63).astype(np.uint64)
        for level, bitmap in enumerate(slices):
            score += ((bitmap[word] >> bit) & np.uint64(1)).astype(np.int64) << level
        return found, score


def _blocks(vectors: DataFrame, id: str, vector: str, scale: int, rows: int, name: str) -> tuple[DataFrame, int]:
    """Usable vectors as integers, dealt by digest to blocks of about ``rows`` rows: ``size, <name>, row, id, parts``."""
    usable = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v")).where(
        "v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    whole = usable.select("id", F.transform(F.col("v").cast("array<double>"), lambda x: F.floor(x * float(scale))).alias("parts")).distinct()
    whole = cut_lineage(whole.withColumn("size", F.size("parts")).withColumn("row", F.monotonically_increasing_id()), name)
    if not whole.where(F.exists("parts", lambda x: (x > LARGEST) | (x < -LARGEST))).isEmpty():
        raise ValueError(f"components times the scale must not exceed {LARGEST}")
    blocks = max(1, -(-whole.count() // rows))
    return whole.withColumn(name, F.pmod(F.xxhash64("id", "parts"), F.lit(blocks)).cast("int")), blocks


def _matrix(lists: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = lists.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), size).astype(np.int64)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 20, scale: int = 64, id: str = "vec_id", vector: str = "embedding",
    block_rows: int = BLOCK_ROWS, chunk_queries: int = CHUNK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row of ``queries`` the ``k`` rows of ``vectors`` with the highest scores.

    Components are quantised to ``floor(scale * x)``, the score is the integer inner product. Equal scores go by the smaller
    id, a NULL id last. Vectors with the query's id are the query's own and no candidates. A query gets all candidates if
    there are fewer than ``k``, and no row if there is none. Vectors that are NULL or hold NULL or non-finite components take
    no part; a query meets vectors of its own length only (empty ones have score 0); rows that repeat id and quantised vector
    count once; components beyond ``LARGEST`` after scaling are refused. Other columns are not looked at. Empty tables give no rows.

    Vectors are dealt to blocks, queries to chunks, both by digest, so neither copies nor a hot id meet in one task. Each
    pair of a block and a chunk is one group of bounded size: it builds the block's slices and returns ``k`` rows a query.
    """
    index, n_blocks = _blocks(vectors, id, vector, scale, block_rows, "block")
    asked, n_chunks = _blocks(queries, id, vector, scale, chunk_queries, "chunk")
    # every chunk meets every block: the stated queries against all rows
    left = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    # tiles are small in bytes and long in time, so they are not gathered to tasks by size
    tasks = min(4 * n_blocks * n_chunks, MOST_TASKS)
    keys = ["size", "block", "chunk"]
    left, right = (side.repartition(tasks, *keys) for side in (left, right))
    schema = "query long, row long, vec_id long, score long"

    def search(rows: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if rows.num_rows and wanted.num_rows:
            rows = rows.sort_by([("id", "ascending")])  # NULL comes last
            ids = rows.column("id").combine_chunks()
            known = ids.drop_null().to_numpy()
            size = rows.column("size")[0].as_py()
            slices = Slices(_matrix(rows.column("parts"), size))
            for query, row, parts in zip(*(wanted.column(c).to_pylist() for c in ("id", "row", "parts")), strict=True):
                own = None
                if query is not None:
                    first, last = np.searchsorted(known, [query, query + 1])
                    if last > first:
                        own = np.zeros(slices.rows, bool)
                        own[first:last] = True
                        own = to_words(own)
                found, score = slices.top(parts, k, own)
                out[0] += [query] * len(found)
                out[1] += [row] * len(found)
                out[2].append(ids.take(pa.array(found)))
                out[3].append(pa.array(score))
        join = lambda arrays: pa.concat_arrays(arrays) if arrays else pa.array([], pa.int64())
        columns = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), join(out[2]), join(out[3])]
        return pa.table(columns, names=["query", "row", "vec_id", "score"])

    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)
    place = F.expr("row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id ASC NULLS LAST)")
    return best.withColumn("rank", place).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), F.col("rank").cast("int"), "vec_id", "score")
