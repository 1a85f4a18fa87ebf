"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.overlap_graph import connected_sets


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (longs ``a, b``): the smallest node that can be reached.

    Links are contracted by tasks from level to level (``connected_sets``), so a hub or a long chain takes no more rounds than
    any other graph, and no link, label or component reaches the driver.
    """
    return connected_sets(links.where("a <> b")).withColumnRenamed("set", "component")


def union_find(n: int):
    """A small union-find over ``0 … n-1`` for use inside a task: ``find(x)`` and ``unite(x, y)``."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def unite(x: int, y: int) -> None:
        x, y = find(x), find(y)
        if x != y:
            parent[max(x, y)] = min(x, y)

    return find, unite
