"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.llm.common import attach
from driftline.session import measured, settled, stored


def components(links: DataFrame) -> DataFrame:
    """A stored table of `node` and `root` (the smallest node reachable) for the ends of the links `a`, `b`.

    Each round takes the smallest label among a node's neighbours, then the label of that label,
    so rounds grow with the logarithm of a component's length. Each round's labels are
    a table in the shared folder, which also cuts the plan, and are removed at the end. A component's label can be that of very
    many nodes: labels are looked up once each, and `attach` spreads the popular ones.
    """
    return settled(links.sparkSession, "roots", lambda: _labelled(links))


def _labelled(links: DataFrame) -> DataFrame:
    """`node` and `root`, as `components` stores them."""
    both = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "links")
    labels, seen = measured(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "labels", nodes=F.count(F.lit(1)))
    total = seen["nodes"]
    while total:
        # Tables of a loop are joined by a shuffle, small or not: what a broadcast leaves in the driver adds up.
        near = both.join(labels.withColumnRenamed("node", "b").hint("merge"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        nearer = labels.join(near.hint("merge"), "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        nearer, seen = measured(nearer, "labels", changed=F.count_if(F.col("old") != F.col("root")))
        # No label differs from a neighbour's.
        if not seen["changed"]:
            break
        used = nearer.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
        next_of = used.join(nearer.select(F.col("node").alias("root"), F.col("root").alias("next")).hint("merge"), "root")
        next_of, seen = measured(next_of, "labels", most=F.max("members"))
        jumped = attach(nearer.drop("old"), next_of.hint("merge"), ["root"], "members", total, seen["most"])
        labels = stored(jumped.select("node", F.col("next").alias("root")), "labels")
    return labels
