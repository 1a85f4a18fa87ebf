"""Counts and error statistics over flaw tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import Series, running
from .quantiles import exact_quantiles

ALL = "ALL"


def with_overall(df: DataFrame, group: str) -> DataFrame:
    """Repeat every row for the overall group; use it on rows that are already counted up."""
    return df.withColumn(group, F.explode(F.array(F.col(group), F.lit(ALL))))


def counted(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values per group with their frequency ``n``; NULL values are left out."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))


def weighted_moments(value: str, digits: int = 9) -> list[Column]:
    """n, mean, mean of absolute values and both standard deviations of a counted column."""
    v, n = F.col(value), F.col("n")
    total = F.sum(n)
    mean = F.sum(v * n) / total
    spread = F.greatest(F.sum(v * v * n) - F.sum(v * n) * F.sum(v * n) / total, F.lit(0.0))
    return [
        total.cast("bigint").alias("n"),
        F.round(F.sum(F.abs(v) * n) / total, digits).alias("mean_abs"),
        F.round(mean, digits).alias("mean"),
        F.round(F.sqrt(spread / total), digits).alias("sd_pop"),
        F.round(F.when(total > 1, F.sqrt(spread / (total - 1))), digits).alias("sd_samp"),
    ]


def error_statistics(df: DataFrame, group: str, error: str, width: float = 0.01) -> DataFrame:
    """Mean absolute error, two population sigmas, mean, median and count per group and overall."""
    levels = with_overall(counted(df, [group], error), group)
    moments = levels.groupBy(group).agg(*weighted_moments(error))
    medians = exact_quantiles(levels, [group], error, {"median": 0.5}, width, frequency="n")
    return moments.join(medians, group).select(
        group, "mean_abs", (2 * F.col("sd_pop")).alias("two_sigma"), "mean", F.round("median", 9).alias("median"), "n"
    )


def share_of_total(counts: DataFrame, n: str = "n") -> DataFrame:
    """Percentage of each (already counted) category in the sum over all categories."""
    everything = Window.partitionBy(F.lit(0))
    return counts.withColumn("percent", F.round(100 * F.col(n) / F.sum(n).over(everything), 4))


def moments_by_group(df: DataFrame, group: str, metrics: list[str]) -> DataFrame:
    """n, mean and population sigma of several metrics per group and overall, one row per group and metric."""
    pairs = ", ".join(f"'{m}', {m}" for m in metrics)
    long = df.selectExpr(group, f"stack({len(metrics)}, {pairs}) AS (metric, value)")
    levels = with_overall(counted(long, [group, "metric"], "value"), group)
    stats = levels.groupBy(group, "metric").agg(*weighted_moments("value"))
    return stats.select(
        group, "metric", "n", "mean", F.col("sd_pop").alias("sigma"),
        F.round(F.col("mean") - 2 * F.col("sd_pop"), 9).alias("low_2s"), F.round(F.col("mean") + 2 * F.col("sd_pop"), 9).alias("high_2s"),
    )


def histogram(df: DataFrame, keys: list[str], value: str, low: float, high: float, bins: int) -> DataFrame:
    """Counts per equal-width bin; values outside are left out, the last bin includes its right edge."""
    v = F.col(value)
    place = F.when(v == high, F.lit(bins - 1)).otherwise(F.floor((v - low) / (high - low) * bins))
    return df.where(v.between(low, high)).groupBy(*keys, place.cast("bigint").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def clipped_histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """Histogram of values clipped at ``high``, with the number of clipped values per bin."""
    clipped = df.withColumn("_v", F.least(F.col(value), F.lit(high))).withColumn("_over", (F.col(value) > high).cast("int"))
    v = F.col("_v")
    place = F.when(v == high, F.lit(bins - 1)).otherwise(F.floor((v - low) / (high - low) * bins))
    return clipped.where(v >= low).groupBy(place.cast("bigint").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_over").alias("n_over")
    )


TRIM_START, TRIM_STEP, TRIM_STEPS = 99.0, 0.1, 990


def trim_to_spread(df: DataFrame, value: str, target: float, min_rows: int = 10, chunk: float = 0.05) -> DataFrame:
    """Smallest share of largest |z| to drop so that two sigmas of the rest stay within ``target``.

    Percentiles of |z| are tried from 99 downwards in steps of 0.1; trying ends early when fewer than
    ``min_rows`` values would be left. Running sums along |z| give the sigma of every prefix at once, so
    all steps are answered by one ordered pass that is split into chunks of |z|.
    """
    counts = counted(df, [], value)
    v, n = F.col(value), F.col("n")
    total = F.sum(n)
    mean, square = F.sum(v * n) / total, F.sum(v * v * n) / total
    facts = counts.agg(total.alias("total"), mean.alias("mean"), F.sqrt(square - mean * mean).alias("sigma"))
    total_n = facts.select("total").scalar()
    z = F.abs((v - facts.select("mean").scalar()) / facts.select("sigma").scalar())
    by_z = counts.withColumn("z", z).groupBy("z").agg(
        F.sum("n").alias("n"), F.sum(v * n).alias("s"), F.sum(v * v * n).alias("ss")
    )
    series = Series(["_all"], ["z"], chunk)
    sums = {"upto": F.col("n"), "sum_v": F.col("s"), "sum_vv": F.col("ss")}
    prefix = running(by_z.withColumn("_all", F.lit(0)), series, sums).withColumn("total", total_n)

    def rank(step: Column) -> Column:
        return F.floor((F.col("total") - 1) * (F.lit(TRIM_START) - TRIM_STEP * step) / 100)

    before = F.col("upto") - F.col("n")
    guess_first = F.floor((TRIM_START - 100 * F.col("upto") / (F.col("total") - 1)) / TRIM_STEP) - 2
    guess_last = F.ceil((TRIM_START - 100 * before / (F.col("total") - 1)) / TRIM_STEP) + 2
    first = F.greatest(guess_first, F.lit(0)).cast("int")
    last = F.greatest(F.least(guess_last, F.lit(TRIM_STEPS - 1)), first).cast("int")
    steps = F.filter(F.sequence(first, last), lambda i: (rank(i) >= before) & (rank(i) < F.col("upto")))
    kept_mean = F.col("sum_v") / F.col("upto")
    spread = 2 * F.sqrt(F.greatest(F.col("sum_vv") / F.col("upto") - kept_mean * kept_mean, F.lit(0.0)))
    tried = prefix.select(
        F.explode(steps).alias("step"), F.col("upto").alias("kept"), spread.alias("two_sigma"), "total",
    )
    ends = (F.col("kept") < min_rows) | (F.col("two_sigma") <= target) | (F.col("step") == TRIM_STEPS - 1)
    best = tried.where(ends).agg(F.min(F.struct("step", "kept", "two_sigma", "total")).alias("b"))
    return best.select(
        F.round(TRIM_START - TRIM_STEP * F.col("b.step"), 1).alias("percentile"),
        F.col("b.kept").alias("kept"),
        F.round("b.two_sigma", 6).alias("two_sigma"),
        F.round(100 * (1 - F.col("b.kept") / F.col("b.total")), 6).alias("removed_percent"),
    )


def column_profile(df: DataFrame, columns: list[str], samples: int = 5) -> DataFrame:
    """Non-null, null, distinct counts and the smallest few values of each column, in long form.

    Values are counted before distinct ones are counted, so no set of values is held in one task.
    """
    total = df.select(F.count(F.lit(1)).alias("n")).scalar()
    pairs = ", ".join(f"'{c}', CAST({c} AS STRING)" for c in columns)
    counts = df.selectExpr(f"stack({len(columns)}, {pairs}) AS (column, value)").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    per = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("non_null"),
        F.coalesce(F.sum(F.when(~known, F.col("n"))), F.lit(0)).alias("nulls"),
        F.count("value").alias("distinct_values"),
    )
    rank = F.row_number().over(Window.partitionBy("column").orderBy("value"))
    firsts = counts.where(known).withColumn("_rank", rank).where(F.col("_rank") <= samples)
    shown = firsts.groupBy("column").agg(F.array_join(F.sort_array(F.collect_list("value")), ", ").alias("samples"))
    return per.join(shown, "column", "left").select(
        "column", "non_null", "nulls", F.round(100 * F.col("nulls") / total, 4).alias("null_percent"), "distinct_values", "samples"
    )


def describe_column(df: DataFrame, value: str, width: float) -> DataFrame:
    """Count, mean, sample sigma, extremes and quartiles of one column."""
    counts = counted(df.withColumn("_all", F.lit(0)), ["_all"], value)
    stats = counts.groupBy("_all").agg(*weighted_moments(value), F.min(value).alias("min"), F.max(value).alias("max"))
    quartiles = exact_quantiles(counts, ["_all"], value, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, width, frequency="n")
    joined = stats.join(quartiles, "_all")
    return joined.select("n", "mean", F.col("sd_samp").alias("sd"), "min", *[F.round(q, 9).alias(q) for q in ("q25", "q50", "q75")], "max")


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of each pair of columns over the rows where both are known."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"{a}|{b}"), 3).alias("corr")) for a, b in pairs])
    return row.select(F.explode(entries).alias("e")).select("e.*")
