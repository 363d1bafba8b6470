"""Connected components of an undirected graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapledger.session import discard, materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """One row (``node``, ``comp``) per node that has a link: ``comp`` is the least node reachable.

    Rounds in which a node takes the least of its label, its neighbours' labels and its label's own label, until
    nothing changes. A node with very many links is a join key only: its rows can be split, and minima are
    taken partially before they are shuffled. Each round is written once to the shared folder, and the one before it removed. Loops and
    repeated links do no harm; links with a null end are ignored; no links give no rows.
    """
    ends = links.select(F.col(a).alias("node"), F.col(b).alias("other")).filter("node IS NOT NULL AND other IS NOT NULL")
    both = ends.unionByName(ends.select(F.col("other").alias("node"), F.col("node").alias("other")))
    both = materialize(both, "links")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    labels = materialize(least.select("node", F.least("node", "least").alias("comp")), "labels")
    while True:
        found = labels.select(F.col("node").alias("other"), F.col("comp").alias("seen"))
        near = both.join(found, "other").groupBy("node").agg(F.min("seen").alias("seen"))
        roots = labels.select(F.col("node").alias("comp"), F.col("comp").alias("root"))
        lower = labels.join(roots, "comp").join(near, "node")
        after = lower.select("node", F.least("comp", "seen", "root").alias("comp"), F.col("comp").alias("was"))
        after = materialize(after, "labels")
        done = after.filter("comp <> was").isEmpty()
        discard(labels)
        labels = after
        if done:
            discard(both)
            return labels.select("node", "comp")
