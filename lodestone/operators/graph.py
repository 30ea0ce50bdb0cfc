"""Reachability, levels and cycles of directed graphs that may be larger than one machine."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.tables import discard, written


def reach(edges: DataFrame, entries: DataFrame) -> DataFrame:
    """node and depth: the fewest edges (from, to) from any entry (node). Cycles end the search by themselves.

    Breadth first, a join for each level; nodes already seen are left out, so a level's cost is that of
    its own edges. A level's nodes are counted on the executors.
    """
    edges = written(edges.select("from", "to").distinct())
    frontier = written(entries.select("node").distinct().withColumn("depth", F.lit(0).cast("bigint")))
    seen, depth = frontier, 0
    while frontier.limit(1).count():
        depth += 1
        found = frontier.select(F.col("node").alias("from")).join(edges, "from").select(F.col("to").alias("node")).distinct()
        frontier = written(found.join(seen, "node", "left_anti").withColumn("depth", F.lit(depth).cast("bigint")))
        seen = seen.unionByName(frontier)
    return seen


def unreachable(nodes: DataFrame, edges: DataFrame, entries: DataFrame) -> DataFrame:
    """The nodes that no entry reaches."""
    return nodes.select("node").distinct().join(reach(edges, entries), "node", "left_anti")


def leaves(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The nodes without an outgoing edge."""
    return nodes.select("node").distinct().join(edges.select(F.col("from").alias("node")), "node", "left_anti")


def _ends_of_chains(single: DataFrame) -> DataFrame:
    """node, to, base and w for nodes (node, base, to, w) that wait for one other node each: `to` is no longer such a node.

    Every node's level is the greater of its base and w above the level of `to`. That holds for two steps taken as one,
    so each round doubles the steps, and rounds grow with the logarithm of a chain. What still moves after more steps
    than there are nodes goes round a cycle, and gets a null `to`.
    """
    own = lambda c: F.col(f"s.{c}")
    most, steps, last = single.count(), 1, single
    while True:
        nexts = last.select(F.col("node").alias("to"), F.col("to").alias("to2"), F.col("base").alias("base2"), F.col("w").alias("w2"))
        both = last.alias("s").join(nexts.alias("n"), "to", "left")
        base = F.greatest(own("base"), F.col("base2") + own("w"))
        moved = F.col("to2").isNotNull()
        now = written(both.select(own("node").alias("node"), F.coalesce("to2", F.col("to")).alias("to"), base.alias("base"), (own("w") + F.coalesce("w2", F.lit(0))).alias("w"), moved.alias("moved")))
        moving = now.filter("moved").limit(1).count()
        if last is not single:
            discard(last)
        last, steps = now, steps * 2
        if not moving:
            return now
        if steps > 2 * most:
            return now.withColumn("to", F.when(~F.col("moved"), F.col("to")))


def topo_levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node and level: 0 without dependencies, else one more than the highest of the nodes it depends on.

    Edges lead from a node to what it depends on; those that leave `nodes` are ignored, as are loops of one
    node. Null levels are the cyclic remainder: nodes that a cycle keeps from ever being ready.

    In each round, nodes that wait for nothing get their level, and raise the base of those that wait for them; then nodes
    that wait for one other node are taken out, with the end of their chain, and edges to them lead to that end. So a
    chain takes as many rounds as the logarithm of its length, and rounds grow only with the number of nodes in a row that
    wait for several others. What was taken out gets its level from its end, the last first.
    """
    nodes = nodes.select("node").distinct()
    names = nodes.withColumnRenamed("node", "to")
    links = edges.select(F.col("from").alias("node"), "to").filter("node != to").distinct().join(nodes, "node", "left_semi").join(names, "to", "left_semi")
    links, active = written(links.select("node", "to", F.lit(1).cast("bigint").alias("w"))), written(nodes.withColumn("base", F.lit(0).cast("bigint")))
    levels, taken = [], []
    while True:
        waits = links.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.first("to").alias("to"), F.first("w").alias("w"))
        state = written(active.join(waits, "node", "left").select("node", "base", F.coalesce("n", F.lit(0)).alias("n"), "to", "w"))
        ready = state.filter("n = 0").select("node", F.col("base").alias("level"))
        some = ready.limit(1).count()
        if some:
            levels.append(ready)
            met = written(links.join(ready.withColumnRenamed("node", "to"), "to", "left").select("node", "to", "w", (F.col("level") + F.col("w")).alias("least")))
            raised = met.groupBy("node").agg(F.max("least").alias("least"), F.count(F.when(F.col("least").isNull(), 1)).alias("n"), F.first(F.when(F.col("least").isNull(), F.struct("to", "w")), True).alias("next"))
            base = F.greatest("base", F.coalesce("least", F.lit(0)))
            state = written(state.filter("n > 0").select("node", "base").join(raised, "node").select("node", base.alias("base"), "n", "next.to", "next.w"))
            links = met.filter("least IS NULL").drop("least")
        single = state.filter("n = 1")
        if single.limit(1).count():
            ends = _ends_of_chains(single.select("node", "base", "to", "w"))
            taken.append(ends)
            over = ends.filter("to IS NOT NULL").select(F.col("node").alias("to"), F.col("to").alias("end"), F.col("base").alias("end_base"), F.col("w").alias("end_w"))
            left = links.join(single.select("node"), "node", "left_anti").join(over, "to", "left")
            left = written(left.select("node", F.coalesce("end", "to").alias("to"), (F.col("w") + F.coalesce("end_w", F.lit(0))).alias("w"), (F.col("w") + F.col("end_base")).alias("least")))
            raised = left.groupBy("node").agg(F.max("least").alias("least"))
            active = written(state.filter("n <> 1").select("node", "base").join(raised, "node", "left").select("node", F.greatest("base", F.coalesce("least", F.lit(0))).alias("base")))
            links = written(left.groupBy("node", "to").agg(F.max("w").alias("w")))
        elif some:
            active = state.select("node", "base")
        else:
            break
    found = reduce(DataFrame.unionByName, levels, active.select("node", F.lit(None).cast("bigint").alias("level")))
    for ends in reversed(taken):
        at = ends.join(found.select(F.col("node").alias("to"), F.col("level").alias("end_level")), "to", "left")
        found = found.unionByName(at.select("node", F.when(F.col("end_level").isNotNull(), F.greatest("base", F.col("end_level") + F.col("w"))).alias("level")))
        if len(taken) > 1:
            found = written(found)
    return found


def cyclic_remainder(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """The nodes that no leaf-first order can contain."""
    return topo_levels(nodes, edges).filter("level IS NULL").select("node")


def leaf_first_order(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """unit, node, position and cuts: depth-first post-order in each unit, from declaration order.

    `nodes` has unit, node and ord; `edges` has unit, from and to, and ord, if callees are to be visited in the order of
    their first call instead of that of their declaration. The order within a unit is sequential by nature and units are
    small; units are spread over tasks. A call of a node that is still open closes a cycle: it is passed over, and its
    callee is among the caller's cuts.
    """
    graph = nodes.groupBy("unit").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "node"))), lambda x: x.getField("node")).alias("nodes"))
    called = F.col("ord") if "ord" in edges.columns else F.lit(0)
    links = edges.groupBy("unit", "from", "to").agg(F.min(called).alias("ord")).groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("ord", "from", "to"))).alias("edges"))

    def order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for unit, own, pairs in zip(batch["unit"], batch["nodes"], batch["edges"], strict=True):
                place = {n: i for i, n in enumerate(own)}
                calls: dict[str, list[tuple]] = {n: [] for n in own}
                for e in [] if pairs is None else pairs:
                    if e["from"] in place and e["to"] in place:
                        calls[e["from"]].append((e["ord"], place[e["to"]], e["to"]))
                rest = {n: iter(sorted(found)) for n, found in calls.items()}
                cuts: dict[str, list[str]] = {n: [] for n in own}
                seen: set[str] = set()
                done: set[str] = set()
                for start in own:
                    stack = [] if start in seen else [start]
                    seen.add(start)
                    while stack:
                        node = stack[-1]
                        step = next(rest[node], None)
                        if step is None:
                            stack.pop()
                            out.append((unit, node, len(done), cuts[node]))
                            done.add(node)
                        elif step[2] not in seen:
                            seen.add(step[2])
                            stack.append(step[2])
                        elif step[2] not in done:
                            cuts[node].append(step[2])
            yield pd.DataFrame(out, columns=["unit", "node", "position", "cuts"])

    kind = nodes.schema["unit"].dataType.simpleString()
    return graph.join(links, "unit", "left").mapInPandas(order, f"unit {kind}, node string, position long, cuts array<string>")
