"""Trees kept as parent/child rows: subtrees, flattening and condition trees."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from haulage.session import stored


def depths(nodes: DataFrame, root: str) -> DataFrame:
    """``(id, depth)`` of all nodes ``(id, parent_id, name)`` that the root name is above of, and of the roots themselves.

    Pointers double: every node that has not met a root yet points to an ancestor, and takes over that ancestor's pointer, or its
    depth, in each round. A chain of a thousand nodes takes ten rounds. Nodes on a circle without a root never meet one; no
    node has more ancestors than there are nodes, which ends the rounds.
    """
    own = nodes.groupBy("id").agg(F.max(F.coalesce(F.col("name") == root, F.lit(False))).alias("is_root"))
    state = stored(nodes.join(own, "id").where(F.col("is_root") | F.col("parent_id").isNotNull()).select(
        "id", F.when(~F.col("is_root"), F.col("parent_id")).alias("up"), F.when(F.col("is_root"), 0).otherwise(1).cast("long").alias("far")).distinct(), "tree-pointers")
    rounds = state.count().bit_length()
    met = state.where("up IS NULL")
    waiting = state.where("up IS NOT NULL")
    for _ in range(rounds):
        if waiting.isEmpty():
            break
        above = met.unionByName(waiting).select(F.col("id").alias("up"), F.col("up").alias("next"), F.col("far").alias("further"))
        # parents that are no nodes lead nowhere: their children go
        moved = waiting.join(above, "up").groupBy("id", F.col("next").alias("up")).agg(F.min(F.col("far") + F.col("further")).alias("far"))
        moved = stored(moved, "tree-pointers")
        arrived = moved.where("up IS NULL")
        waiting = moved.where("up IS NOT NULL").join(arrived.select("id"), "id", "left_anti")
        met = met.unionByName(arrived)
    return met.select("id", F.col("far").cast("int").alias("depth"))


def subtree(nodes: DataFrame, root: str) -> DataFrame:
    """All nodes ``(id, parent_id, name)`` below and including the root name, with ``parent_name`` and ``depth``.

    Any depth and any row order, in rounds by the logarithm of the depth; a node stands at its smallest depth, also where the
    rows run in a circle. Nodes without an id or a parent, and parents that are no nodes, end their chain.
    """
    level = depths(nodes, root)
    placed = nodes.select("id", "parent_id", "name").join(level, "id")
    above = placed.select(F.col("id").alias("_p"), F.col("name").alias("parent_name"), (F.col("depth") + 1).alias("_below"))
    top = placed.where((F.col("depth") == 0) & (F.col("name") == root)).select("id", "parent_id", "name", F.lit(None).cast("string").alias("parent_name"), "depth")
    lower = placed.where("depth > 0").join(above, (F.col("parent_id") == F.col("_p")) & (F.col("depth") == F.col("_below")))
    return top.unionByName(lower.select("id", "parent_id", "name", "parent_name", "depth"))


def flatten_entities(docs: DataFrame, column: str = "tree") -> DataFrame:
    """Nested ``{"entity": {...}, "kidz": [...]}`` JSON texts of any depth as ``(id, parent_id, name)`` rows.

    One pass over Arrow batches; every document stays inside its row.
    """
    def walk(doc: str | None):
        import json

        out, todo = [], [json.loads(doc)] if doc else []
        while todo:
            node = todo.pop()
            entity = node["entity"]
            out.append((entity["id"], entity.get("parentId"), entity.get("name")))
            todo += node.get("kidz") or []
        return out

    @F.pandas_udf("array<struct<id:bigint,parent_id:bigint,name:string>>")
    def entities(texts: pd.Series) -> pd.Series:
        return texts.map(walk)

    return docs.select(F.inline(entities(column)))


def evaluate_conditions(nodes: DataFrame, ready: DataFrame) -> DataFrame:
    """Value of every condition tree.

    ``nodes``: ``(tree_id, node_id, parent_id, depth, op, event_key)`` with op ``statVal``, ``or`` or ``and``;
    ``ready``: ``(event_key, is_ready)``. Leaves take their event's state (unknown is not ready), inner nodes fold
    their children bottom-up, an inner node without children is not ready.
    """
    leaves = nodes.where(F.col("op") == "statVal").join(ready, "event_key", "left").select(
        "tree_id", "node_id", "parent_id", "depth", F.coalesce("is_ready", F.lit(False)).alias("value"))
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    level = leaves.where(F.col("depth") == deepest)
    for depth in range(deepest - 1, -1, -1):
        folded = level.groupBy("tree_id", F.col("parent_id").alias("node_id")).agg(
            F.bool_or("value").alias("any_ready"), F.bool_and("value").alias("all_ready"))
        inner = nodes.where((F.col("depth") == depth) & (F.col("op") != "statVal")).join(folded, ["tree_id", "node_id"], "left").select(
            "tree_id", "node_id", "parent_id", "depth",
            F.coalesce(F.when(F.col("op") == "and", F.col("all_ready")).otherwise(F.col("any_ready")), F.lit(False)).alias("value"))
        level = leaves.where(F.col("depth") == depth).unionByName(inner)
    return level.select("tree_id", "value")
