"""Value rewriting: applying a name mapping, its cycles, chains and fixpoint."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devigil.functions.text import strip
from devigil.session import cut_estimates

# length of a walk that can go on for ever; a longest walk has fewer edges
ENDLESS = 2**62


def rewrite_edges(mapping: DataFrame) -> DataFrame:
    """``src -> dst`` of ``original_name, normalized_name``, compared in lower case, no self-maps."""
    edges = mapping.select(
        F.lower(strip(F.col("original_name"))).alias("src"),
        F.lower(strip(F.col("normalized_name"))).alias("dst"),
    )
    return edges.filter(F.col("src") != F.col("dst")).distinct()


def one_target(mapping: DataFrame) -> DataFrame:
    """The smallest of several targets of a name."""
    return mapping.groupBy("original_name").agg(
        F.min("normalized_name").alias("normalized_name")
    )


def apply_mapping(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Replace mapped values; the value before stays in ``<column>_original``."""
    pairs = one_target(mapping).select(
        F.col("original_name").alias("_from"), F.col("normalized_name").alias("_to")
    )
    renamed = df.withColumn(f"{column}_original", F.col(column))
    return (
        renamed.join(pairs, F.col(column) == F.col("_from"), "left")
        .withColumn(column, F.coalesce("_to", column))
        .drop("_from", "_to")
    )


def changed_rows(df: DataFrame, column: str) -> DataFrame:
    """How many rows the last ``apply_mapping`` touched."""
    changed = ~F.col(column).eqNullSafe(F.col(f"{column}_original"))
    return df.agg(F.count_if(changed).alias("changed"))


def resolve(mapping: DataFrame) -> DataFrame:
    """``original_name, resolved_name, status``: where repeated application of a mapping ends.

    Every round doubles the distance looked ahead, so n names need about log2(n) rounds. Names that
    never come to rest lead into a cycle: they stay unmapped with status ``cycle``.
    """
    state = cut_estimates(
        one_target(mapping)
        .filter(F.col("original_name") != F.col("normalized_name"))
        .select(F.col("original_name").alias("name"), F.col("normalized_name").alias("target"))
    )
    rounds = max(1, math.ceil(math.log2(state.count() + 1)) + 1)
    for _ in range(rounds):
        ahead = state.select(F.col("name").alias("target"), F.col("target").alias("next"))
        step = state.join(ahead, "target", "left")
        state = cut_estimates(
            step.select(
                "name",
                F.coalesce("next", "target").alias("target"),
                F.col("next").isNotNull().alias("open"),
            )
        )
        if state.filter("open").isEmpty():
            break
    return state.select(
        F.col("name").alias("original_name"),
        F.when(~F.col("open"), F.col("target")).alias("resolved_name"),
        F.when(F.col("open"), "cycle").otherwise("resolved").alias("status"),
    )


def _doubled(state: DataFrame) -> DataFrame:
    ahead = state.select(
        F.col("node").alias("next"), F.col("next").alias("after"), F.col("steps").alias("more")
    )
    return state.join(ahead, "next", "left").select(
        "node",
        "chosen",
        F.coalesce("after", "next").alias("next"),
        (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
        F.col("after").isNotNull().alias("open"),
    )


def _follow(choice: DataFrame, jumps: int) -> DataFrame:
    """``node, chosen, steps``: the walk from every ``node`` along the choices, ENDLESS on a cycle.

    Every round doubles the distance twice; a walk that is open after ``jumps`` doublings is on a cycle
    or leads to one.
    """
    state = choice.select(
        "node", "chosen", F.col("chosen").alias("next"), F.lit(1).cast("bigint").alias("steps")
    ).withColumn("open", F.lit(True))
    for _ in range(0, jumps, 2):
        state = cut_estimates(_doubled(_doubled(state)))
        if state.filter("open").isEmpty():
            break
    steps = F.when(F.col("open"), F.lit(ENDLESS)).otherwise(F.col("steps"))
    return state.select("node", "chosen", steps.alias("steps"))


def walk_lengths(edges: DataFrame) -> DataFrame:
    """``node, steps``: edges on the longest walk from every node that has one, ENDLESS into a cycle.

    Every node chooses one of its targets. The walks along the choices are measured by doubling, then
    nodes with a better target choose that one, until none has. For one target per name that is a
    single look; the number of looks otherwise is how often a choice proves wrong, not the length.
    """
    edges = cut_estimates(edges.select("src", "dst"))
    choice = cut_estimates(
        edges.groupBy("src").agg(F.max("dst").alias("chosen")).withColumnRenamed("src", "node")
    )
    jumps = math.ceil(math.log2(choice.count() + 1)) + 1
    while True:
        steps = _follow(choice, jumps)
        ahead = steps.select(F.col("node").alias("dst"), F.col("steps").alias("rest"))
        reach = F.least(F.lit(1) + F.coalesce("rest", F.lit(0)), F.lit(ENDLESS))
        best = (
            edges.join(ahead, "dst", "left")
            .groupBy("src")
            .agg(F.max(F.struct(reach.alias("reach"), "dst")).alias("best"))
            .select(F.col("src").alias("node"), "best")
        )
        wrong = F.col("best.reach") > F.col("steps")
        step = cut_estimates(
            steps.join(best, "node").select(
                "node", F.when(wrong, F.col("best.dst")).otherwise(F.col("chosen")).alias("chosen"),
                wrong.alias("wrong"),
            )
        )
        if step.filter("wrong").isEmpty():
            return steps.select("node", "steps")
        choice = step.drop("wrong")


def _cyclic_core(edges: DataFrame) -> DataFrame:
    """The edges between nodes that come from a cycle and lead into one."""
    for _ in range(0 if edges.isEmpty() else 2):
        endless = walk_lengths(edges).filter(F.col("steps") == ENDLESS).select("node")
        inner = edges.join(endless, edges.src == endless.node, "left_semi")
        inner = inner.join(endless, inner.dst == endless.node, "left_semi")
        edges = cut_estimates(_turned(inner))
    return edges


def _turned(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def _spread_largest(edges: DataFrame) -> DataFrame:
    """``node, color``: the largest node that leads to each node, itself included."""
    nodes = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    colors = cut_estimates(nodes.withColumn("color", F.col("node")))
    while True:
        incoming = (
            edges.join(colors, edges.src == colors.node)
            .groupBy("dst")
            .agg(F.max("color").alias("incoming"))
        )
        step = colors.join(incoming, colors.node == incoming.dst, "left").select(
            "node", "color", F.greatest("color", "incoming").alias("new")
        )
        # whatever leads to the color of a node leads to the node itself
        jump = step.select(F.col("node").alias("new"), F.col("new").alias("further"))
        step = cut_estimates(
            step.join(jump, "new").select(
                "node", "color", F.greatest("new", "further").alias("new")
            )
        )
        colors = step.select("node", F.col("new").alias("color"))
        if step.filter("new <> color").isEmpty():
            return colors


def cycle_members(edges: DataFrame) -> DataFrame:
    """``node, cycle``: the nodes on rewrite cycles, grouped by mutual reachability.

    What lies before the first and behind the last cycle goes first. What is left is split by the largest node that leads
    to each node; within such a part, the nodes that lead back to it form one group. A group is
    named after its smallest node.
    """
    remaining, found = _cyclic_core(cut_estimates(edges.select("src", "dst"))), []
    while not remaining.isEmpty():
        colors = _spread_largest(remaining)
        start = colors.select(F.col("node").alias("src"), F.col("color"))
        end = colors.select(F.col("node").alias("dst"), F.col("color").alias("end_color"))
        inside = cut_estimates(
            remaining.join(start, "src").join(end, "dst").filter("color = end_color")
        )
        # the color is the largest node there: who leads back to it is found on the turned edges
        back = _spread_largest(_turned(inside)).select("node", F.col("color").alias("back"))
        loops = colors.join(back, "node").filter("color = back").select("node", "color")
        roots = colors.filter("node = color")
        group = cut_estimates(loops.unionByName(roots).distinct())
        found.append(group)
        members = group.select("node")
        rest = remaining.join(members, remaining.src == members.node, "left_anti")
        rest = rest.join(members, rest.dst == members.node, "left_anti")
        remaining = _cyclic_core(cut_estimates(rest))
    if not found:
        return edges.select(F.col("src").alias("node"), F.col("src").alias("cycle")).limit(0)
    merged = reduce(DataFrame.unionByName, found)
    names = merged.groupBy("color").agg(
        F.min("node").alias("cycle"), F.count(F.lit(1)).alias("size")
    )
    return merged.join(names.filter("size > 1"), "color").select("node", "cycle")


def longest_chain(edges: DataFrame, on_cycles: DataFrame | None = None) -> int:
    """Nodes on the longest rewrite chain outside cycles (``a -> b`` has two).

    Repeated mapping needs one pass less than that to settle, plus one that changes nothing.
    """
    if on_cycles is None:
        longest = walk_lengths(edges).agg(F.max("steps").alias("steps")).first()["steps"] or 0
        if longest < ENDLESS:
            return 1 + longest
        on_cycles = cycle_members(edges)
    members = on_cycles.select("node")
    acyclic = edges.join(members, edges.src == members.node, "left_anti")
    acyclic = acyclic.join(members, acyclic.dst == members.node, "left_anti")
    longest = walk_lengths(acyclic).agg(F.max("steps").alias("steps")).first()["steps"]
    return 1 + (longest or 0)
