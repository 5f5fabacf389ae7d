"""Connected components of a table of links, by alternating large and small stars.

Defined results: links with a null end or from a node to itself are none; repeated links count once;
without links there are no nodes; the name of a component is its least node, so that ties don't arise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import forget, settle


def _large(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is linked to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below are linked to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))


def lookup(rows: DataFrame, key: str, table: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``table``, whose keys are unique; null where a key isn't in it.

    Keys of more than a thousandth of all rows, so a thousand at most, are looked up by broadcast;
    their rows are spread over all tasks of the join that looks up the others.
    """
    total, values = rows.count(), [c for c in table.columns if c != key]
    hot = rows.groupBy(key).count().where(F.col("count") * 1000 > total).select(key)
    few = table.join(F.broadcast(hot), key).select(F.col(key).alias("__hot"), *[F.col(c).alias(f"__{c}") for c in values])
    own = rows.join(F.broadcast(few), F.col(key) == F.col("__hot"), "left")
    own = own.withColumn("__at", F.when(F.col("__hot").isNull(), F.col(key)).otherwise(F.xxhash64(*rows.columns)))
    out = own.join(table.withColumnRenamed(key, "__key"), F.col("__at") == F.col("__key"), "left")
    pick = [F.when(F.col("__hot").isNotNull(), F.col(f"__{c}")).otherwise(F.col(c)).alias(c) for c in values]
    return out.select(*rows.columns, *pick)


def components(edges: DataFrame) -> DataFrame:
    """(node, least): the least node that links (a, b) lead to, for every node that has links.

    Each round groups with map-side minima and joins on single rows, so that a node with many
    links is no task of its own; the driver sees two numbers a round.
    """
    now = settle(edges.where("a <> b").select("a", "b").distinct())
    state = None
    while True:
        after = settle(_small(_large(now)).where("a <> b").distinct())
        mark = tuple(after.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first())
        forget(now.sparkSession, now)
        now = after
        if mark == state:
            return now.select(F.col("a").alias("node"), F.col("b").alias("least")).union(now.select(F.col("b"), F.col("b"))).distinct()
        state = mark
