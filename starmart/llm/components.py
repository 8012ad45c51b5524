"""Connected components of an undirected graph held as a frame of edges.

Alternates the two star operations until the edges stop changing: every round is two
grouped minima and two joins, all with partial aggregation, and O(log n) rounds are
needed however long the chains are. Rounds are cut by tables in the shared folder. No
node's neighbours are gathered and nothing but one row of totals reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back: later jobs do not
    recompute it and a lost executor costs no lineage. Digests and texts take less room
    under zstd than under the session's default."""
    where = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(where)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    joined = down.join(low, "a")
    return (joined.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
            .unionByName(low.select("a", F.col("m").alias("b"))).distinct())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component): component is the smallest node reachable. ``edges`` has long
    columns a, b; loops and repeats are allowed; nodes without an edge are not listed."""
    e = edges.select("a", "b").where("a <> b").distinct()
    seen = None
    for _ in range(max_rounds):
        e = stored(_small_star(_large_star(e)), "components")
        state = e.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    else:
        raise RuntimeError("components did not settle")
    low = e.groupBy("b").agg(F.lit(1).alias("one")).select(F.col("b").alias("node"), F.col("b").alias("component"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(low)
