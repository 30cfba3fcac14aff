"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Table


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (the least node reachable) for every node of an edge
    that isn't the least of its component itself.

    Each round joins every node's larger neighbours with its least neighbour,
    then its smaller ones; both keep what is connected, and stars are left
    after a number of rounds that grows with the logarithm of the longest path.
    A node with very many edges is spread by the joins' skew handling; minima
    are combined before they move.  Each round is written to the shared folder,
    so a lost executor costs no more than a round.

    Null ends and loops are ignored; repeated edges do no harm; no edges give an
    empty result.
    """
    now = Table(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")
    state = None
    while True:
        e = now.read()
        both = e.union(e.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u != v").distinct()
        then = Table(small, "edges")
        now.drop()
        now = then
        new = tuple(now.read().agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if new == state:
            return now.read().select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = new
