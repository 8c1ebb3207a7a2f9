"""Connected components by min-label propagation with pointer jumping; the state is a written table each round.

Rounds go on until no label falls. Labels are ends, only ever fall and a label that can fall does, so this ends; chains halve
with every round, so that the rounds grow with the logarithm of the longest shortest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """v, label of every end of an edge (a, b longs); label: the component's smallest end.

    A round gives each end the smallest label among its neighbours (pre-aggregated before the shuffle, so a
    hub costs no more than its edges), then the label of its label. Chains halve with every round.
    """
    both = written(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("v"), F.least("a", "m").alias("label")), "labels")
    while True:
        seen = both.join(labels, F.col("b") == F.col("v")).groupBy("a").agg(F.min("label").alias("m"))
        lowered = labels.join(seen, F.col("v") == F.col("a")).select("v", F.col("label").alias("old"), F.least("label", "m").alias("low"))
        jump = labels.select(F.col("v").alias("j"), F.col("label").alias("jl"))
        moved = written(lowered.join(jump, F.col("low") == F.col("j"), "left").select("v", F.least("low", F.coalesce("jl", "low")).alias("label"), "old"), "labels")
        changed = moved.where("label <> old").limit(1).count()
        labels = moved.select("v", "label")
        if not changed:
            return labels
