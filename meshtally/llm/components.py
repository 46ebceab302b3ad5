"""Connected components of a link table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meshtally.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of links (a, b): the smallest node that links reach from it.

    Each round every node takes the smallest of itself and its neighbours as its leader,
    and links are carried over to the leaders; links inside a leader vanish. A star is done
    in one round, a chain shrinks by a constant factor. Only sums over keys and joins that
    Spark can split are used, so a node may have any number of links. The rounds' tables
    are stored; the driver holds only whether links are left.
    """
    links = stored(links.where("a <> b").select("a", "b").distinct())
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        leads = stored(both.groupBy(F.col("a").alias("node")).agg(F.least("a", F.min("b")).alias("leader")))
        carried = (links.join(leads.toDF("a", "la"), "a").join(leads.toDF("b", "lb"), "b")
                   .where("la <> lb").select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")))
        links = stored(carried.distinct())
        if labels is None:
            labels = leads.select("node", F.col("leader").alias("label"))
        else:
            labels = stored(labels.join(leads.toDF("label", "leader"), "label", "left")
                            .select("node", F.coalesce("leader", "label").alias("label")))
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
