"""Connected components of a link table, by contraction in rounds of joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from chainloom.llm.common import stored


def components(links: DataFrame, purpose: str) -> DataFrame:
    """(node, root) of every node that has a link in ``links`` (a, b); nodes of one component share a root.

    Each round every node hooks to its neighbour of smallest hash, the hooks are followed once more, and the
    links are carried over to what the nodes hooked to. Links and nodes shrink by a constant share per round.
    """
    edges = stored(
        links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        f"{purpose}-links",
    )
    hooks = []
    while not edges.isEmpty():
        order = lambda c: F.xxhash64(F.lit(len(hooks)), c)  # noqa: E731, B023
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = (
            both.groupBy("a")
            .agg(F.min(F.struct(order("b").alias("h"), "b")).alias("m"))
            .select(
                F.col("a").alias("node"),
                F.when(F.struct("m.h", "m.b") < F.struct(order("a").alias("h"), F.col("a").alias("b")), F.col("m.b"))
                .otherwise(F.col("a"))
                .alias("up"),
            )
        )
        first = stored(first, f"{purpose}-hook-{len(hooks)}")
        above = first.select(F.col("node").alias("up"), F.col("up").alias("top"))
        hook = stored(first.join(above, "up").select("node", F.col("top").alias("root")), f"{purpose}-root-{len(hooks)}")
        hooks.append(hook)
        x, y = (hook.select(F.col("node").alias(c), F.col("root").alias(f"r{c}")) for c in "ab")
        moved = edges.join(x, "a").join(y, "b").where("ra <> rb")
        edges = stored(
            moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(),
            f"{purpose}-links-{len(hooks)}",
        )
    if not hooks:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = hooks[0]
    for hook in hooks[1:]:
        later = hook.select(F.col("node").alias("root"), F.col("root").alias("later"))
        out = out.join(later, "root", "left").select("node", F.coalesce("later", "root").alias("root"))
    return out
