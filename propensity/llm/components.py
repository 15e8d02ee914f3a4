"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.session import materialize, release


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node that can be reached.

    In a round every node takes the smallest root around it, then its root's root, so the rounds grow with the logarithm of
    the longest chain. Each round's labels are written and the last ones read again, which also cuts the lineage.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    roots = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))
    kept = roots
    while True:
        of = roots.select(F.col("node").alias("b"), F.col("root").alias("near"))
        around = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        pulled = roots.join(around, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        pulled = materialize(pulled)
        jump = pulled.select(F.col("node").alias("root"), F.col("root").alias("further"))
        after = materialize(
            pulled.join(jump, "root", "left").select("node", "old", F.coalesce(F.least("root", "further"), "root").alias("root"))
        )
        release(pulled, kept)
        kept = after
        if after.where("root <> old").isEmpty():
            release(both)
            return after.select("node", "root")
        roots = after.select("node", "root")
