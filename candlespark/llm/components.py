"""Connected components of nodes that share keys, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlespark.llm.staging import staged


def connected_components(rows: DataFrame, key: str = "key", node: str = "node") -> DataFrame:
    """(node, root) for every node of ``rows`` that has a key in common with another.

    Nodes are connected that have a key in common; root is the least node
    reachable. No edge between two nodes is ever made. Every round takes the
    least label of each key, moves a label to the least one that it meets (and
    on to where that one moves) and contracts the rows to their distinct (key,
    label). Keys whose rows agree drop out, so a group of copies that share many
    keys is down to a few rows after the first round. Sums are partial before a
    shuffle; joins meet one row for each key or label, and a hot one is split.
    """
    held = rows.select(F.col(key).alias("key"), F.col(node).alias("label"))
    names = None
    while True:
        spans = held.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).filter("least < most").select("key", "least")
        live = staged(held.join(spans, "key"), "cc-live")
        if live.isEmpty():
            return rows.select(F.col(node).alias("node"), F.col(node).alias("root")).limit(0) if names is None else staged(names, "cc-names")
        near = live.groupBy("label").agg(F.min("least").alias("up"))
        onward = near.select(F.col("label").alias("up"), F.col("up").alias("next"))
        moved = staged(near.join(onward, "up", "left").select("label", F.coalesce("next", "up").alias("up")), "cc-moved")
        if names is None:
            names = moved.select(F.col("label").alias("node"), F.col("up").alias("root"))
        else:
            onto = moved.select(F.col("label").alias("root"), "up")
            names = names.join(onto, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        held = live.select("key", "label").join(moved, "label").select("key", F.col("up").alias("label")).distinct()
