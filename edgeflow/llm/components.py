"""Connected components of links that no machine could hold alone.

Rounds of two steps, after the published large-star and small-star method: every vertex ties its
larger neighbours to its smallest one, then its smaller neighbours to the smallest of them. The links
of each round are a written table, minima are combined before they are shuffled, and nothing of a round
visits the driver but whether there is more to do. Links of a hub meet its minimum in a join that
adaptive execution can split.
"""

from pyspark.sql import functions as F

from edgeflow.plans import Rounds, keep


def _all_stars(links):
    """Whether every vertex has one link down and none up, or only links up."""
    lower = links.select(F.col("a").alias("v"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    upper = links.select(F.col("b").alias("v"), F.lit(0).alias("down"), F.lit(1).alias("up"))
    ends = lower.unionByName(upper).groupBy("v").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return ends.where("down > 1 OR down = 1 AND up = 1").isEmpty()


def _smallest(links):
    """(a, low): a table of its own, so that both sides of its joins are shuffled and can be split."""
    return keep(links.groupBy("a").agg(F.min("b").alias("low")), "components-smallest")


def _large_star(links):
    """(a > b) → every neighbour above a vertex goes to the smallest of the vertex and its neighbours."""
    smallest = _smallest(links)
    towards = links.join(smallest.select(F.col("a").alias("b"), "low"), "b", "left")
    return towards.select("a", F.coalesce("low", "b").alias("b"))


def _small_star(links):
    links = keep(links.distinct(), "components-large")
    smallest = _smallest(links)
    both = links.join(smallest, "a")
    own = both.select("a", F.col("low").alias("b"))
    others = both.where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    return own.unionByName(others).distinct()


def stars(links, name="components"):
    """Links (a, b) of 64-bit vertices → (a, b) with b the smallest vertex of the component of a, for a ≠ b.

    Links in any order, repeated ones, loops and no links at all are fine; links with a null end are none.
    """
    spark = links.sparkSession
    rounds = Rounds(spark, name, "a bigint, b bigint")
    ordered = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    current, number = rounds.write(0, ordered.distinct()), 0
    while not _all_stars(current):
        number += 1
        current = rounds.write(number, _small_star(_large_star(current)))
    return current
