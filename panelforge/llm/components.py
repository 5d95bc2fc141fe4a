"""Connected components of a graph of any size, by alternating large and small stars.

Edges are narrow rows of two ids. A round hangs every neighbour of a node on the
smallest id that the node knows, first the larger neighbours, then the smaller
ones, until each component is a star around its smallest id. Minima are combined
before they are shuffled, and return to the edges by join_hubs(), so that the
edges of a node with very many of them stay where they are. Each round is
written to the shared folder, in two halves; the last one's table goes when the driver ends.
At most FEW edges are solved by the driver, as a round takes many jobs however few they are.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import Scratch, dropped, freed_shuffles, shared_dir, until_exit

#: Keys that can have over one in so many of all rows: no more than that, so they fit a broadcast.
HUBS = 4096
LEAST_HUB = 1000
#: Edges, some 2 MB, that come to the driver at most.
FEW = 1 << 17


def _stars(edges: pa.Table) -> pa.Table:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    for u, v in zip(edges.column("u").to_pylist(), edges.column("v").to_pylist(), strict=True):
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    nodes = list(parent)
    return pa.table({"node": pa.array(nodes, pa.int64()), "component": pa.array([root(x) for x in nodes], pa.int64())})


def join_hubs(rows: DataFrame, facts: DataFrame, key: str, total: int) -> DataFrame:
    """rows joined with facts on key, of which facts has one row each, with the number n of its rows among the total.

    At most HUBS keys have over total / HUBS rows. Their facts are broadcast, so
    that no task gathers the rows of such a key; the others are shuffled.
    """
    if total <= LEAST_HUB:
        return rows.join(facts.drop("n"), key)
    many = F.col("n") > max(LEAST_HUB, total // HUBS)
    hubs = F.broadcast(facts.filter(many).drop("n"))
    rest = rows.join(hubs.select(key), key, "left_anti").join(facts.filter(~many).drop("n"), key)
    return rows.join(hubs, key).unionByName(rest)


def components(edges: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """edges (a, b: long) to (node, component), for every node with an edge; component is the smallest node reachable.

    The result reads a table that goes with scratch, or else when the driver ends.
    """
    spark = edges.sparkSession

    def put(df: DataFrame) -> tuple[DataFrame, str]:
        path = shared_dir(spark)
        with freed_shuffles(spark):
            df.write.parquet(path)
        return spark.read.schema("u long, v long").parquet(until_exit(path, spark)), path

    now, path = put(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    sign = lambda df: df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).collect()[0]
    was = sign(now)
    if was["n"] <= FEW:
        out = spark.createDataFrame(_stars(now.toArrow()), "node long, component long")
        dropped(path, spark)
        return out
    while was["n"]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.count("*").alias("n"))
        large = join_hubs(both, least, "u", 2 * was["n"]).filter("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large, large_path = put(large)  # so that the plan of the second half doesn't hold the first one several times
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_hubs(large, least, "u", 2 * was["n"]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        new, new_path = put(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        dropped(path, spark)
        dropped(large_path, spark)
        got = sign(new)
        now, path, same, was = new, new_path, got == was, got
        if same:
            break
    if scratch is not None:
        scratch.paths.append(path)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
