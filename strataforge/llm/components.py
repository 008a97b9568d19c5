"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataforge.session import cut


def _signature(links: DataFrame) -> tuple:
    r = links.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    return tuple(r)


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id that a link names; a component is its smallest id.

    Each round first hooks an id's larger neighbours, then its smaller ones, to the
    smallest id around it, until nothing changes; the number of rounds grows with the
    logarithm of the longest chain.  Links are checkpointed in every round.  Links to
    oneself and repeated links don't matter, links with a null end are left out.
    """
    ends = links.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"), (F.col(a) != F.col(b)).alias("real"))
    now = cut(ends.where("real").select("hi", "lo").distinct())
    before = None
    while (signature := _signature(now)) != before:
        before = signature
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
            now.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(root, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = cut(small.unionByName(root.select("hi", F.col("m").alias("lo"))).distinct())
    roots = now.select(F.col("lo").alias("id")).distinct()
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(
        roots.select("id", F.col("id").alias("component"))
    )
