"""Connected components of links held in tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``comp``) of every node with a link; ``comp`` is a node of the component.

    Each round hooks every node to its smallest neighbour, follows the hooks
    twice, and contracts the links, until none is left between different
    nodes. Nothing is collected: rounds pass tables in the shared folder, and
    hubs are combined map-side (minimum per node) before the shuffle. Loops
    and repeated links are harmless; no links give an empty result.
    """
    u, v = F.col(a).alias("u"), F.col(b).alias("v")
    edges = links.where(F.col(a) != F.col(b)).select(u, v)
    labels: DataFrame | None = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hooks = both.groupBy("u").agg(F.least("u", F.min("v")).alias("p"))
        hooks = stored(hooks, "component-hooks")
        for _ in range(2):
            up = hooks.select(F.col("u").alias("p"), F.col("p").alias("q"))
            hooks = hooks.join(up, "p").select("u", F.col("q").alias("p"))
        hooks = stored(hooks, "component-hooks")
        if labels is None:
            labels = hooks.select(F.col("u").alias("node"), F.col("p").alias("comp"))
        else:
            up = hooks.select(F.col("u").alias("comp"), "p")
            labels = labels.join(up, "comp", "left").select("node", F.coalesce("p", "comp").alias("comp"))
            labels = stored(labels, "component-labels")
        pu, pv = (hooks.select(F.col("u").alias(x), F.col("p").alias(f"p{x}")) for x in ("u", "v"))
        edges = edges.join(pu, "u").join(pv, "v").where("pu != pv")
        edges = stored(edges.select(F.col("pu").alias("u"), F.col("pv").alias("v")).distinct(), "component-links")
        if edges.isEmpty():
            return labels
