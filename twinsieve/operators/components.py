"""Connected components by alternating large-star and small-star steps.

The method is that of Kiveris et al., "Connected Components in MapReduce and Beyond",
SoCC 2014. Edges are rows (src, dst); no step collects a neighbourhood.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from twinsieve.functions import forest
from twinsieve.operators.skew import HOT_ROWS, with_group_min
from twinsieve.sources.workspace import Workspace


class NotConverged(RuntimeError):
    """The round limit was reached before the components were found."""


def large_star(
    edges: DataFrame,
    workspace: Workspace,
    hot_rows: int = HOT_ROWS,
    at_most: int | None = None,
    name: str = "large_star",
) -> DataFrame:
    """Link every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.select("src", "dst").unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    at_most = None if at_most is None else 2 * at_most
    reduced = with_group_min(both, ["src"], "dst", "low", workspace, name, hot_rows, at_most)
    return (
        reduced.where(F.col("dst") > F.col("src"))
        .select(F.col("dst").alias("src"), F.least("src", "low").alias("dst"))
        .distinct()
    )


def small_star(
    edges: DataFrame,
    workspace: Workspace,
    hot_rows: int = HOT_ROWS,
    at_most: int | None = None,
    name: str = "small_star",
) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    reduced = with_group_min(down, ["src"], "dst", "low", workspace, name, hot_rows, at_most)
    return (
        reduced.select(F.explode(F.array("src", "dst")).alias("src"), F.col("low").alias("dst"))
        .where(F.col("src") > F.col("dst"))
        .distinct()
    )


def contracted(edges: DataFrame, most_edges: int = forest.MOST_EDGES) -> DataFrame:
    """Edges with the same components: each task links the nodes it has seen to the smallest one
    they are connected with there, so it has fewer edges than nodes. Takes no shuffle.

    A task holds twice ``most_edges`` links at most, and passes on what it has when contracting leaves
    ``most_edges`` or more.
    """
    kind = edges.schema["src"].dataType.simpleString()
    function = forest.contracting(most_edges)
    return edges.select("src", "dst").mapInArrow(function, f"src {kind}, dst {kind}")


def unsettled(edges: DataFrame) -> DataFrame:
    """(node): each src with several dst, and each src that is itself a dst.

    Both steps keep the components and point from larger to smaller, so if there is no such
    node, each dst is the smallest node of its component, and the search is over.
    """
    sources = edges.select(F.col("src").alias("node"), F.lit(0).alias("is_dst"))
    targets = edges.select(F.col("dst").alias("node"), F.lit(1).alias("is_dst"))
    return (
        sources.unionByName(targets)
        .groupBy("node")
        .agg(F.sum(1 - F.col("is_dst")).alias("out"), F.max("is_dst").alias("is_dst"))
        .where((F.col("out") > 1) | ((F.col("out") == 1) & (F.col("is_dst") == 1)))
        .select("node")
    )


def connected_components(
    edges: DataFrame,
    workspace: Workspace,
    max_rounds: int = 100,
    hot_rows: int = HOT_ROWS,
    name: str = "components",
    prepared: bool = False,
    contract: bool = False,
) -> DataFrame:
    """(id, component) of every node but the smallest of each component.

    ``component`` is the smallest node. Each round is staged; the driver only learns counts.
    No step adds edges, so the first count bounds every later one. In a graph of more than
    ``hot_rows`` edges, components that are done leave the loop, so late rounds are small.
    ``prepared`` says that the edges are staged already, distinct and each from the larger to
    the smaller node. With ``contract`` each task first contracts the edges it reads, see
    ``contracted``, before the first shuffle, and in a large graph again in each round.
    """
    if contract:
        edges = contracted(edges)
        prepared = False
    state = edges if prepared else workspace.stage(_downward(edges), f"{name}-start")
    at_most = state.count()
    done: list[DataFrame] = []
    for turn in range(max_rounds + 1):
        stale = [] if prepared and turn == 0 else [state]
        open_nodes = unsettled(state)
        large_graph = at_most > hot_rows
        if large_graph:
            open_nodes = workspace.stage(open_nodes, f"{name}-unsettled")
            stale.append(open_nodes)
        if open_nodes.isEmpty():
            if large_graph:
                workspace.drop(open_nodes)
            return _labels([*done, state])
        if turn == max_rounds:
            break
        if large_graph:
            finished, state = _split_done(state, open_nodes, workspace, name)
            done.append(finished)
            stale.append(state)
            at_most = state.count()
        if contract and 2 * at_most > hot_rows:
            state = workspace.stage(contracted(state), f"{name}-contracted")
            stale.append(state)
        large = large_star(state, workspace, hot_rows, at_most, f"{name}-heavy")
        if 2 * at_most > hot_rows:
            large = workspace.stage(large, f"{name}-large-star")
            stale.append(large)
        small = small_star(large, workspace, hot_rows, at_most, f"{name}-heavy")
        state = workspace.stage(small, f"{name}-round")
        for table in stale:
            workspace.drop(table)
    raise NotConverged(f"components still changed after {max_rounds} rounds")


def _split_done(
    edges: DataFrame, nodes: DataFrame, workspace: Workspace, name: str
) -> tuple[DataFrame, DataFrame]:
    """Edges of the components that are done and those that are not, both staged.

    A component is done if it is one star: neither its centre nor a node that points to the
    centre is unsettled. The joins carry no hint, so the planner broadcasts few centres and
    shuffles many, and a centre with very many edges can be split.
    """
    above = edges.join(nodes, F.col("src") == F.col("node"), "left_semi")
    centres = workspace.stage(nodes.union(above.select("dst")).distinct(), f"{name}-centres")
    is_open = F.col("dst") == F.col("node")
    parts = (
        workspace.stage(edges.join(centres, is_open, "left_anti"), f"{name}-done"),
        workspace.stage(edges.join(centres, is_open, "left_semi"), f"{name}-open"),
    )
    workspace.drop(centres)
    return parts


def _labels(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.select(F.col("src").alias("id"), F.col("dst").alias("component"))


def _downward(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    return (
        edges.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .where(F.col("src") > F.col("dst"))
        .distinct()
    )


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found in exactly one of the two frames, from one shuffle."""
    sides = left.withColumn("__side", F.lit(1)).union(right.withColumn("__side", F.lit(2)))
    seen = sides.groupBy(*left.columns).agg(F.bit_or("__side").alias("__side"))
    return seen.where(F.col("__side") < 3).drop("__side")
