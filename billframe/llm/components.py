"""Connected components of a link table by min-label rounds with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billframe.llm.common import write_stage


def connected_components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node reachable over ``links`` (columns a, b; never NULL).

    Only linked nodes take part. Every round takes the smallest label among a
    node's neighbours (a map-side minimum, so a hub costs one row per task),
    then jumps to that label's own label, so chains shrink geometrically. Each
    round is a written stage; the loop ends when no label changes.
    """
    both = write_stage(
        links.where("a <> b").select("a", "b").union(links.where("a <> b").select("b", "a")).distinct(), "links"
    )
    labels = write_stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "labels")
    while True:
        seen = both.join(labels.select(F.col("node").alias("b"), "root"), "b")
        nearest = seen.groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        stepped = labels.join(nearest, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
        )
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = write_stage(
            stepped.join(jump, "root", "left").select(
                "node", "old", F.least("root", F.coalesce("further", "root")).alias("root")
            ),
            "labels",
        )
        changed = not after.where("old <> root").isEmpty()
        labels = after.select("node", "root")
        if not changed:
            return labels
