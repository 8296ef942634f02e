"""Connected components of a stored list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for every node of (a, b) links; ``comp`` is the component's smallest node.

    Each round gives a node the smallest label among its neighbours and then the label
    of that label, so long chains shrink at the speed of doubling. Labels live in
    written tables, a hot node's messages are combined before they are shuffled, and no
    more than a count reaches the driver.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")).select(
            "node", F.least("node", "low").alias("comp")
        ),
        "labels",
    )
    while True:
        near = (
            both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("near"))
        )
        heard = labels.join(near, labels.node == near.a).select(
            "node", F.col("comp").alias("old"), F.least("comp", "near").alias("comp")
        )
        heard = stored(heard, "heard")
        to = heard.select(F.col("node").alias("root"), F.col("comp").alias("further"))
        moved = heard.join(to, heard.comp == to.root).select(
            "node", "old", F.least("comp", "further").alias("comp")
        )
        moved = stored(moved, "labels")
        labels = moved.select("node", "comp")
        if moved.filter("comp <> old").isEmpty():
            return labels
