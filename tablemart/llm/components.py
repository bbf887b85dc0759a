"""Connected components of a link table by alternating stars, with each round in a shared table."""

from pyspark.sql import functions as F

from tablemart.storage import via_table


def _star(links, keep):
    """Link every kept neighbour of a node to the smallest node in sight of it.

    The smallest neighbour is a map-side combined aggregate, so a node with very many links costs
    one row per task; the join back to it is one that Spark splits when a node is hot.
    """
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    joined = links.join(least, "a").withColumn("low", F.least("low", "a"))
    return joined.filter(keep).select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a <> b")


def components(links, label="components"):
    """(node, component_id): the smallest node reachable, for every node that has a link.

    links: columns a, b (long); direction, repeats, self links and nulls do not matter. Empty links
    give no rows. Rounds of a large and a small star go on until the links no longer change; their
    number grows with the logarithm of the longest path. Every round is written to the shared
    folder, so that no plan grows with the rounds and a lost executor costs one round at most.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = via_table(pairs.filter("a <> b").distinct(), label)
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _star(both, F.col("b") > F.col("a"))
        own = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        small = _star(own, F.lit(True)).unionByName(
            own.groupBy("a").agg(F.min("b").alias("b"))
        ).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
        stars = via_table(small, label)
        mark = stars.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))
        ).first()
        if mark == before:
            break
        before = mark
    roots = stars.groupBy("a").agg(F.min("b").alias("component_id"))
    return roots.select(F.col("a").alias("node"), "component_id").unionByName(
        stars.select(F.col("b").alias("node"), F.col("b").alias("component_id")).distinct()
    )
