"""Set operations and updates of the scan store, as rewrites of whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the first in input order."""
    columns = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*columns), order).alias("_row")).select(key, "_row.*")


def mark_members(scans: DataFrame, members: DataFrame, label: str, otherwise: str, out: str = "train_val") -> DataFrame:
    listed = members.select("scan_id").distinct().withColumn("_listed", F.lit(True))
    return scans.join(listed, "scan_id", "left").withColumn(out, F.when(F.col("_listed"), label).otherwise(otherwise)).drop("_listed")


def delete_scans(scans: DataFrame, gone: DataFrame) -> DataFrame:
    return scans.join(gone.select("scan_id"), "scan_id", "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_old: list[str] = (), add_new: bool = True) -> DataFrame:
    """New non-NULL values replace old ones; columns in ``keep_old`` keep their old value where there is one.

    With ``add_new`` False rows that only the update has are ignored.
    """
    values = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
    a = old.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in values if c in old.columns])
    b = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in values if c in new.columns])

    def merged(c: str) -> Column:
        before = F.col(f"_old_{c}") if c in old.columns else None
        after = F.col(f"_new_{c}") if c in new.columns else None
        order = [before, after] if c in keep_old else [after, before]
        return F.coalesce(*[x for x in order if x is not None]).alias(c)

    return a.join(b, keys, "full" if add_new else "left").select(*keys, *[merged(c) for c in values])


def keep_depth_across_versions(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Update of known flaws only: position, type and report link stay, depth stays when the version changes."""
    previous = old.select(*keys, F.col("depth").alias("_depth"), F.col("version").alias("_version"))
    stays = F.col("version").isNotNull() & F.col("_version").isNotNull() & (F.col("version") != F.col("_version"))
    versioned = new.join(previous, keys).withColumn("depth", F.when(stays, F.coalesce("_depth", "depth")).otherwise(F.col("depth")))
    return upsert(old, versioned.drop("_depth", "_version"), keys, ["rotary_start", "flaw_type", "reported_id"], add_new=False)


def first_tier(tiers: list[DataFrame], keys: list[str]) -> DataFrame:
    """Ordered union: a key takes its row from the first tier that has one."""
    tagged = [t.withColumn("tier", F.lit(i)) for i, t in enumerate(tiers)]
    union = tagged[0]
    for t in tagged[1:]:
        union = union.unionByName(t, allowMissingColumns=True)
    columns = [c for c in union.columns if c not in keys]
    return union.groupBy(*keys).agg(F.min_by(F.struct(*columns), "tier").alias("_row")).select(*keys, "_row.*")


def debris_final_depth(nb1: DataFrame, nb2: DataFrame, keys: list[str], dominant: float = 0.25) -> DataFrame:
    """Final depth per indication from the two normal-beam probes.

    First probe, else second; on the first probe an echo-removed depth at least ``dominant`` deeper wins;
    a depth from the first peak overrides everything; indications without any depth stay with NULL.
    """
    found = first_tier(
        [t.where("pred_depth IS NOT NULL").withColumn("probe", F.lit(p)) for t, p in ((nb1, "NB1"), (nb2, "NB2"))], keys
    )
    peak = nb1.select(*keys, F.col("first_peak").alias("_peak"))
    joined = peak.join(found, keys, "left")
    dominated = (F.col("probe") == "NB1") & (F.col("echo_removed") - F.col("pred_depth") >= dominant)
    depth = F.when(F.col("pred_depth").isNotNull(), F.coalesce("_peak", F.when(dominated, F.col("echo_removed")), "pred_depth"))
    return joined.select(*keys, "probe", depth.alias("final_depth"))


def split_failures(df: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """Rows that worked, and the rejects with their error text."""
    return df.where(F.col(error).isNull()).drop(error), df.where(F.col(error).isNotNull())
