"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.work import written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (the least node reachable) for every node of the
    links ``a, b``.  Each round takes the least label among the neighbours and
    then the label of that label; both are aggregated before the shuffle and
    written, so nothing is gathered and lineage stays short.  A graph without
    links gives an empty table; repeated links and loops change nothing."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = written(both.distinct(), "links")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("component")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        hooked = labels.join(near, "node").select("node", "component", F.least("component", "near").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        moved = written(
            hooked.join(jump, "next").select("node", F.least("next", "far").alias("component"), (F.least("next", "far") != F.col("component")).alias("moved")),
            "labels",
        )
        labels = moved.select("node", "component")
        if moved.filter("moved").isEmpty():
            return labels
