"""Connected sets, work on sets whose boxes grow, and long chains."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tubewave.operators import matching, merging, overlap_graph


def smallest_reachable(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


@pytest.mark.parametrize("one_task", [500_000, 0])
def test_sets_of_chains_stars_and_random_links(spark, monkeypatch, one_task):
    """The same sets by one task and by many, for a shuffled chain, a hub and random links."""
    monkeypatch.setattr(overlap_graph, "ONE_TASK", one_task)
    rng = np.random.default_rng(4)
    chain = rng.permutation(300) + 10_000
    links = [(int(a), int(b)) for a, b in zip(chain, chain[1:])] + [(500, int(x)) for x in range(501, 700)]
    links += [(int(a), int(b)) for a, b in rng.integers(0, 400, (250, 2))] + [(9, 9)]
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r["node"]: r["set"] for r in overlap_graph.connected_sets(df).collect()}
    assert got == smallest_reachable(links)
    assert overlap_graph.connected_sets(df.where("false")).count() == 0


def boxes(rows):
    return pd.DataFrame(rows, columns=["image_id", "box_id", "cls", "conf", "x1", "y1", "x2", "y2"]).astype({"image_id": "int64"})


def test_grown_boxes_reach_other_sets(spark):
    """Two boxes unite to one that covers a third, which neither of them touched; it is united as well."""
    rows = [(0, "a", "V", 0.9, 0.0, 0.0, 10.0, 4.0), (0, "b", "V", 0.5, 0.0, 2.0, 4.0, 12.0), (0, "c", "V", 0.4, 6.0, 8.0, 9.0, 11.0), (1, "c", "V", 0.4, 6.0, 8.0, 9.0, 11.0)]
    got = merging.unite_v_and_mr(spark.createDataFrame(boxes(rows)), ["image_id"], 0.05).collect()
    assert sorted((r.image_id, r.box_id, r.x1, r.y1, r.x2, r.y2) for r in got) == [(0, "a", 0.0, 0.0, 10.0, 12.0), (1, "c", 6.0, 8.0, 9.0, 11.0)]


def test_boxes_chained_along_one_axis_are_many_sets(spark):
    """100,000 boxes whose extents along y form one chain lie apart in x: they are worked on in small sets by several tasks."""
    n = 100_000
    df = spark.range(n).select(
        F.lit(0).cast("long").alias("image_id"), F.format_string("%06d", "id").alias("box_id"), F.lit("V").alias("cls"), F.lit(0.5).alias("conf"),
        (F.expr("id DIV 2 % 500") * 40.0).alias("x1"), (F.col("id") * 1.0).alias("y1"), (F.expr("id DIV 2 % 500") * 40.0 + 30).alias("x2"), (F.col("id") + 3.0).alias("y2"),
    )
    sets = overlap_graph.overlap_sets(df, ["image_id", "cls"], (F.col("x1"), F.col("y1"), F.col("x2") + 1, F.col("y2") + 1), merging.PIXELS)
    assert sets.groupBy("_set").count().agg(F.max("count")).first()[0] == 2
    united = merging.merge_tile_boxes(df, ["image_id"], 0.3, 0.9)
    assert united.count() == n // 2 and united.where("y2 - y1 <> 4").count() == 0


def test_chain_of_ever_better_boxes_is_suppressed_in_order(spark):
    """Every second box stays, however long the chain: the first rounds decide its end, a walk the rest."""
    n = 200
    rows = [(0, f"{k:03d}", "V", (k + 1) / n, k * 5.0, 0.0, k * 5.0 + 10, 10.0) for k in range(n)]
    got = merging.suppress_overlaps(spark.createDataFrame(boxes(rows).rename(columns={"conf": "score"})), ["image_id"], 0.3, 0.0, inclusive=False)
    assert sorted(r.box_id for r in got.collect()) == [f"{k:03d}" for k in range(1, n, 2)]


def test_sets_cross_the_ends_of_batches(spark):
    """Sets longer than an Arrow batch, and many short ones, leave the same rows."""
    rows = [(k // 5000, f"{k:05d}", k / 10) for k in range(15_000)] + [(10 + k // 3, f"{k:05d}", 0.5) for k in range(3000)] + [(None, "x", 1.0)]
    df = spark.createDataFrame(rows, "s long, name string, value double")

    def last_of(columns):
        columns["value"][:] = columns["value"].sum()
        return np.array([len(columns["value"]) - 1])

    got = {(r.s, r.name): r.value for r in overlap_graph.work_on_sets(df, "s", "name", ["value"], ["value"], last_of).collect()}
    want = {(None, "x"): 1.0, **{(s, f"{5000 * s + 4999:05d}"): pytest.approx(sum(k / 10 for k in range(5000 * s, 5000 * s + 5000))) for s in range(3)}}
    want |= {(10 + g, f"{3 * g + 2:05d}"): 1.5 for g in range(1000)}
    assert got == want


def test_a_match_is_planned_with_few_joins(spark):
    df = spark.createDataFrame([(1, "a", 0.0, 0.0, 5.0, 5.0)], "scan_id long, ind_num string, rotary_start double, axial_start double, width double, length double")
    plan = matching.best_match(df, df, ["scan_id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") <= 6
