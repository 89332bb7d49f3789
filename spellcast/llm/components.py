"""Connected components of links between integer nodes, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spellcast.session import checkpointed


def connect(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (node, comp) after joining the components that ``links`` (a, b) connect.

    ``comp`` is the smallest node of a component. Each round replaces links by links between
    components, hooks every component to its smallest neighbour and shortens the resulting paths,
    so links vanish in a number of rounds that grows with the logarithm of the longest path.
    """
    while True:
        left = labels.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
        right = labels.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
        across = checkpointed(
            links.join(left, "a").join(right, "b").filter(F.col("ca") != F.col("cb"))
            .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct()
        )
        if across.isEmpty():
            return labels
        parents = across.groupBy(F.col("b").alias("comp")).agg(F.min("a").alias("parent"))
        above = parents.select(F.col("comp").alias("parent"), F.col("parent").alias("above"))
        parents = parents.join(above, "parent", "left").select("comp", F.coalesce("above", "parent").alias("root"))
        labels = checkpointed(labels.join(parents, "comp", "left").select("node", F.coalesce("root", "comp").alias("comp")))
        links = across
