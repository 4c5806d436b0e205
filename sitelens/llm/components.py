"""Connected components as a distributed loop over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitelens.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) for the ends of ``edges`` (src, dst): comp is the smallest
    node reachable.

    Every round takes the smallest label among the neighbours (combined
    map-side, so a hub costs no more than its edges) and then the label of
    that label. It ends when nothing changes. Each round's labels are written
    to the shared folder; a lost executor repeats one round at most."""
    both = materialize(edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
                       .filter("src <> dst").distinct(), "edges")
    labels = materialize(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("low"))
                         .select("node", F.least("node", "low").alias("comp")), "labels")
    while True:
        near = (both.join(labels, both["dst"] == labels["node"]).groupBy("src").agg(F.min("comp").alias("low")))
        step = (labels.join(near, labels["node"] == near["src"], "left")
                .select("node", F.col("comp").alias("old"), F.least("comp", F.coalesce("low", "comp")).alias("comp")))
        far = labels.select(F.col("node").alias("_at"), F.col("comp").alias("_far"))
        new = materialize(step.join(far, step["comp"] == far["_at"], "left")
                          .select("node", "old", F.least("comp", F.coalesce("_far", "comp")).alias("comp")), "labels")
        if new.filter("comp <> old").isEmpty():
            return new.select("node", "comp")
        labels = new.select("node", "comp")
