"""Token-id files: documents in the order of their keys, coded in independent, checksummed blocks."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import begin, slices, texts_of
from .token_coder import decode_blocks, encode_blocks
from .tokens import encoder

#: Ids after which a record ends; it takes whole documents, so a longer one makes a larger record.
RECORD_IDS = 6_000_000


def write_token_files(docs: DataFrame, path: str, tokenizer: str, spaces: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Write the ids of all rows, in ascending order of ``key`` (NULL first), below ``path``.

    Files hold records ``part, record, keys, sizes, coded``: the keys of consecutive documents, how many ids each has, and
    the ids of all of them as coded blocks (``token_coder``). ``end_id`` follows each document; a NULL or empty text is that
    one id. Rows with equal keys are ordered by the digest of their text. Spark's own writer stores the records, so any
    storage it reaches will do, a lost task is written again, and a failed job leaves nothing behind that is read.
    """
    kind = docs.schema[key].dataType.simpleString()
    probe = docs.select(key).limit(0).toArrow().schema.field(key).type
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema([("part", pa.int32()), ("record", pa.int32()), ("keys", pa.list_(probe)), ("sizes", pa.list_(pa.int64())), ("coded", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("tokens")
        encode, part = encoder(tokenizer, spaces).encode, TaskContext.get().partitionId()
        keys, sizes, ids, held, record = [], [], [], 0, 0

        def out() -> pa.RecordBatch:
            coded = encode_blocks(np.frombuffer(b"".join(ids), "<u4"))
            columns = [[part], [record], [keys], [sizes], [coded]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        for batch in slices(batches, "text", 1 << 20):
            own = batch.column("key").to_pylist()
            for k, found in zip(own, encode(texts_of(batch, "text")), strict=True):
                keys.append(k)
                ids.append(found + end)
                sizes.append(len(found) // 4 + 1)
                held += sizes[-1]
            if held >= RECORD_IDS:
                yield out()
                keys, sizes, ids, held, record = [], [], [], 0, record + 1
        if keys:
            yield out()

    lead = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    order = [F.col("key"), F.xxhash64("text")]
    records = lead.repartitionByRange(*order).sortWithinPartitions(*order)
    records.mapInArrow(run, f"part int, record int, keys array<{kind}>, sizes array<long>, coded binary").write.parquet(path)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``key, start, n_tokens, ids_crc32, ids`` of each document in the files below ``path``.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian 32-bit numbers (NULL without
    ``with_ids``). A damaged block raises. Starts come from sums by part, of which there are as many as tasks wrote files.
    """
    records = spark.read.parquet(path)
    kind = records.schema["keys"].dataType.elementType.simpleString()
    counted = records.select("part", "record", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    parts = counted.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    starts = counted.join(parts, "part").select("part", "record", (F.col("part_start") + F.sum("n").over(Window.partitionBy("part").orderBy("record")) - F.col("n")).alias("first"))
    names = ["key", "start", "n_tokens", "ids_crc32", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                one = batch.slice(at, 1)
                sizes = np.array(one.column("sizes")[0].as_py(), np.int64)
                ends = np.cumsum(sizes)
                flat = decode_blocks(one.column("coded")[0].as_py()).tobytes()
                own = [flat[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                columns = [one.column("keys").flatten(), pa.array(one.column("first")[0].as_py() + ends - sizes), pa.array(sizes), pa.array([zlib.crc32(b) for b in own], pa.int64())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(own if with_ids else [None] * len(own), pa.binary())], names)

    return records.join(starts, ["part", "record"]).mapInArrow(run, f"key {kind}, start long, n_tokens long, ids_crc32 long, ids binary")
