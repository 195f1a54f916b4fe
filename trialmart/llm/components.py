"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trialmart.llm.common import Scratch


def connected_components(links: DataFrame) -> DataFrame:
    """One row (id, component_id) per id that occurs in a link between two different ids;
    component_id is the smallest id that it reaches.

    links: columns a, b (whole numbers, either order, repeats and self-links allowed; a link
    with a null end is ignored). Each round points every neighbour of an id at the smallest
    one, first the larger neighbours, then the smaller. Minima are summed on the map side and
    stored before they are joined, so that adaptive execution can split the rows of an id
    with very many links. Nothing is gathered per id, and rounds grow with the logarithm of the
    largest component. Only the last round's table stays.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    with Scratch(links.sparkSession) as tables:
        edges = tables.stored(edges.select(larger.alias("u"), smaller.alias("v")).distinct(), "links")
        while True:
            ways = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = tables.stored(ways.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
            large = ways.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            large = tables.stored(large.distinct(), "large-star")
            tables.drop(edges, least)
            least = tables.stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
            small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            small = small.where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
            edges = tables.stored(small, "small-star")
            tables.drop(large, least)
            if not _unsettled(edges).head(1):
                tables.keep(edges)
                break
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component_id"))


def _unsettled(edges: DataFrame) -> DataFrame:
    """Ids that still point at several others, or point on while others point at them."""
    ends = edges.select(F.col("u").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("into"))
    ends = ends.unionByName(edges.select(F.col("v").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    both = ends.groupBy("id").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
    return both.where("out > 1 OR (out = 1 AND into = 1)")
