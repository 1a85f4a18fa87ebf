"""Target-distribution importance resampling: documents whose hashed n-grams look like a target are drawn more often."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import own_name, slices, texts_of, with_schema
from .decontaminate import _FOLD

#: Buckets of the hashed n-grams.
BUCKETS = 10_000
_SPACES = regex.compile(rb" {2,}")


@lru_cache(maxsize=16)
def gram_pattern(size: int) -> regex.Pattern:
    """Runs of ``size`` words of a text whose separators are single spaces; both ends lie at the edge of a word."""
    return regex.compile(rb"(?<![^ ])[^ ]+(?: [^ ]+){%d}(?![^ ])" % (size - 1))


def collapse(text: bytes) -> bytes:
    """A-Z in lower case, every run of separators as one space."""
    return _SPACES.sub(b" ", text.translate(_FOLD))


def gram_buckets(text: bytes, least: int, most: int, buckets: int) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of ``least`` to ``most`` words, repeats included.

    Matches overlap: each scan starts anew one byte after the start of the match before, and the look-behind lets it
    begin at words only, so the runs of a size come out one for each word that has enough successors.
    """
    plain = collapse(text)
    words = 0 if not plain or plain == b" " else plain.count(b" ") + 1 - plain.startswith(b" ") - plain.endswith(b" ")
    found = [np.fromiter((crc32(m[0]) for m in gram_pattern(n).finditer(plain, overlapped=True)), np.uint32) for n in range(least, min(most, words) + 1)]
    return words, (np.concatenate(found) % buckets).astype(np.int32) if found else np.zeros(0, np.int32)


def gram_features(docs: DataFrame, text: str, keep: list[str], least: int = 1, most: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """Columns ``keep``, ``n_words`` and ``grams`` (the bucket of each n-gram) of every row; one scan, no shuffle."""
    wanted = docs.select(*keep, F.col(text).alias(own_name("text", keep)))
    body = wanted.columns[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, body):
            found = [gram_buckets(t, least, most, buckets) for t in texts_of(batch, body)]
            edges = np.concatenate(([0], np.cumsum([len(g) for _, g in found]))).astype(np.int32)
            grams = pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate([g for _, g in found])))
            columns = [*batch.columns[:-1], pa.array([n for n, _ in found], pa.int64()), grams]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "n_words", "grams"])

    added = "n_words long, grams array<int>"
    return wanted.mapInArrow(run, with_schema(docs.select(*keep), added) if keep else added)


def bucket_counts(features: DataFrame, buckets: int) -> DataFrame:
    """``bucket, n`` over all rows: each task adds up its own and hands on one row a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["bucket", "n"])

    return features.select("grams").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int, unit: int = 1000) -> DataFrame:
    """``bucket, gain``: how much likelier the target is to hold the bucket, as ``floor(unit * ln(ratio))`` of smoothed shares."""
    size = lambda counts: float(counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])
    total, wanted = size(corpus), size(target)
    of = lambda counts, name: counts.select("bucket", F.col("n").cast("double").alias(name))
    every = corpus.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = every.join(of(corpus, "s"), "bucket", "left").join(of(target, "t"), "bucket", "left").fillna(0.0, ["s", "t"])
    ratio = (F.col("t") + 1.0) * (total + buckets) / ((F.col("s") + 1.0) * (wanted + buckets))
    return both.select("bucket", F.floor(F.lit(float(unit)) * F.log(ratio)).alias("gain"))


def noise(key: Column, seed: int, unit: int = 1000) -> Column:
    """Gumbel noise fixed by the key: the highest ``weight + noise`` are a draw without replacement in proportion to the weights."""
    digits = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8)
    share = (F.conv(digits, 16, 10).cast("double") + 0.5) / 4294967296.0
    return F.floor(F.lit(-float(unit)) * F.log(-F.log(share)))


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows with their place ``name`` (from 1) in the given total order, sorted over all tasks.

    Ranges of the order go to tasks and are sorted there; the table of sorted rows is written once, so that places stay
    what they are. One count a range reaches the driver.
    """
    at = own_name("_at", rows.columns)
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())
    ranged = cut_lineage(ranged, "ranges").withColumn(f"{at}_range", F.shiftright(at, 33))
    before, rest = 0, []
    for r in sorted(ranged.groupBy(f"{at}_range").count().collect()):
        rest.append((r[0], before))
        before += r[1]
    starts = rows.sparkSession.createDataFrame(rest, f"`{at}_range` long, `{at}_start` long")
    place = F.col(f"{at}_start") + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranged.join(starts, f"{at}_range").withColumn(name, place).drop(at, f"{at}_range", f"{at}_start")


def resample(
    docs: DataFrame, target: DataFrame, id: str = "doc_id", text: str = "text", target_text: str = "text", keep: list[str] | None = None,
    percent: int = 10, least_words: int = 20, least: int = 1, most: int = 1, buckets: int = BUCKETS, seed: int = 2024,
) -> DataFrame:
    """Every row of ``docs``: the columns ``keep`` (the id by default), ``n_words, n_features, weight, score, rank``.

    Features are all runs of ``least`` to ``most`` words, repeats included, in ``buckets`` buckets by checksum. A bucket's
    gain is the logarithm of its share in ``target`` by its share in ``docs``, in thousandths, rounded down; ``weight`` adds the
    gains of a row's features, ``score`` adds noise fixed by id and seed. ``rank`` numbers the ``percent`` of rows with at
    least ``least_words`` words that have the highest scores, equal ones by smaller id; NULL for all others.

    A NULL or empty text has no features and weight 0; a NULL id has the noise of the empty text and comes first among equal
    scores; repeated rows are drawn one by one. An empty target or an empty ``docs`` leaves the smoothed shares. Kept columns
    with one of the new names get underscores in front.

    Texts are scanned once; bucket numbers are written to the shared folder, counted there and weighed there. The driver
    holds one number a bucket.
    """
    spark = docs.sparkSession
    keep = [id] if keep is None else keep
    new = ["n_words", "grams", "n_features", "weight", "score", "rank"]
    renamed = [F.col(c).alias(own_name(c, [*docs.columns, *new]) if c in new else c) for c in keep]
    own = docs.select(*renamed, F.col(id).alias(own_name("_key", docs.columns)), F.col(text).alias(own_name("_body", docs.columns)))
    *names, key, body = own.columns
    features = cut_lineage(gram_features(own, body, [*names, key], least, most, buckets), "grams")
    wanted = gram_features(target, target_text, [], least, most, buckets)
    rows = bucket_gains(bucket_counts(features, buckets), bucket_counts(wanted, buckets), buckets).collect()
    gains = np.zeros(buckets, np.int64)
    gains[[r.bucket for r in rows]] = [r.gain for r in rows]
    table = spark.sparkContext.broadcast(gains)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("grams")
            sums = np.concatenate(([0], np.cumsum(table.value[lists.flatten().to_numpy(zero_copy_only=False)])))
            edges = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            columns = [*batch.columns[:-1], pa.array(np.diff(edges).astype(np.int64)), pa.array(sums[edges[1:]] - sums[edges[:-1]])]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "n_features", "weight"])

    weighed = features.mapInArrow(weigh, with_schema(features.drop("grams"), "n_features long, weight long"))
    scored = cut_lineage(weighed.withColumn("score", F.col("weight") + noise(F.col(key), seed)), "scores")
    # equal rows are told apart by nothing; a running number only lets them go to several tasks
    tie = own_name("_tie", scored.columns)
    long_enough = scored.where(F.col("n_words") >= least_words).withColumn(tie, F.monotonically_increasing_id())
    ranked = numbered(long_enough, [F.desc("score"), F.asc(key), F.asc(tie)], "rank").drop(tie)
    drawn = percent * scored.where(F.col("n_words") >= least_words).count() // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    short = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.withColumn("rank", rank).unionByName(short).select(*names, "n_words", "n_features", "weight", "score", "rank")
