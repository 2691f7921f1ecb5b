"""Connected components of links between long ids, by hooking, shortcuts and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import stage


def _shortcut(parent: DataFrame) -> DataFrame:
    """Every ``node`` with the top of its chain of parents; the length of chains halves in each step."""
    while True:
        above = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
        parent = stage(
            parent.join(above, "parent", "left").select(
                "node", F.coalesce("above", "parent").alias("parent"), F.col("above").isNotNull().alias("moved")
            ),
            "components-shortcut",
        )
        moved = parent.where("moved").isEmpty()
        parent = parent.select("node", "parent")
        if moved:
            return parent


def _renamed(edges: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    to = parent.select(F.col("node").alias(column), "parent")
    return edges.join(to, column, "left").withColumn(column, F.coalesce("parent", column)).drop("parent")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest id of its component) of every node of the links ``a``, ``b``
    that is not its own root.

    Each round hooks every node to its smallest smaller neighbour, shortens the chains, and replaces the
    nodes of the links by their roots; links inside one component vanish.  Rounds are written to the
    shared folder, so lineage stays short and a lost executor costs one step; only the question whether
    links are left reaches the driver.  Self-links and repeated links are allowed; null ids are not.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = stage(edges.distinct(), "components-links")
    found = edges.sparkSession.createDataFrame([], "node bigint, root bigint")
    while not edges.isEmpty():
        parent = _shortcut(
            stage(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")), "components-hooks")
        )
        moved = found.join(parent.withColumnRenamed("node", "root"), "root", "left").select(
            "node", F.coalesce("parent", "root").alias("root")
        )
        found = stage(moved.unionByName(parent.withColumnRenamed("parent", "root")), "components-found")
        edges = _renamed(_renamed(edges, parent, "a"), parent, "b").where("a <> b")
        edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = stage(edges.distinct(), "components-links")
    return found
