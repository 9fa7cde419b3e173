"""Connected components of links by least labels, with a written table between rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import rows


def components(links: DataFrame, folder: str) -> DataFrame:
    """node, label (the least node reachable) of every node in links (a, b: long). Empty links: no rows.

    Each round takes the least label among a node and its neighbours and then the label's own label, so that the number
    of rounds follows the logarithm of a component's width. Nothing but a count comes to the driver.
    """
    both = rows.saved(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{folder}/edges")
    labels = rows.saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), f"{folder}/labels-0")
    step = 0
    while True:
        step += 1
        near = both.join(labels, both["b"] == labels["node"]).groupBy(both["a"].alias("n")).agg(F.min("label").alias("least"))
        lower = labels.join(near, labels["node"] == near["n"]).select("node", F.col("label").alias("old"), F.least("label", "least").alias("via"))
        to = lower.select(F.col("node").alias("via"), F.least("old", "via").alias("far"))
        jumped = lower.join(to, "via", "left").select("node", "old", F.least("via", F.coalesce("far", "via")).alias("label"))
        found = rows.saved(jumped, f"{folder}/labels-{step}")
        labels = found.select("node", "label")
        if not found.where(F.col("label") < F.col("old")).limit(1).count():
            return labels
