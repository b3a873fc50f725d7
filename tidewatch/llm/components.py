"""Connected components of a table of links, as smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import stage


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every id in ``links`` (columns ``a, b``, either way round).

    Each round gives an id the smallest label among its neighbours' and then that label's own label, so the
    rounds grow with the logarithm of a path's length. Each round is written to the shared folder, which ends
    its lineage. Ids with very many links meet in joins that adaptive execution may split and in minima that
    are summed up before they are shuffled. Repeated links and links of an id to itself change nothing.
    """
    both = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.least("a", F.min("b")).alias("component")), "labels")
    while True:
        known = labels.select(F.col("id").alias("b"), "component")
        near = both.join(known, "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("near"))
        least = labels.join(near, "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("new"))
        jump = labels.select(F.col("id").alias("new"), F.col("component").alias("far"))
        after = stage(least.join(jump, "new").select("id", "old", F.least("new", "far").alias("component")), "labels")
        labels = after.select("id", "component")
        if after.filter("component < old").isEmpty():
            return labels
