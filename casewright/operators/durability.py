"""Cuts of lineage in the folder that driver and executors share, and connected components on top of them."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession, functions as F


_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a session on one machine that has none gets a temporary one, on a cluster that is an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or _folders.get(spark.sparkContext.applicationId)
    if at is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = _folders[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="casewright-checkpoint-")
    return at


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, so that a lost executor costs no more than what came after."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def star_components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Connected components of the undirected ``edges``: (node, component), the component being its smallest node.

    Large-star and small-star steps alternate until every node hangs on its smallest one. Both steps keep
    at most as many edges as they get, need only a minimum for each node (summed up before the shuffle) and
    an equi-join, and never gather a component. Each round's edges are checkpointed, so a lost executor costs
    one round. Nodes without an edge to another node are not in the result; null ends are left out.
    """
    least, most = F.least(a, b), F.greatest(a, b)
    now = durable(edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).select(most.alias("u"), least.alias("v")).distinct())
    was = None
    for _ in range(rounds):
        seen = now.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)), F.count_distinct("u")).first()
        if seen[0] == 0 or seen == was:
            break
        was = seen
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(nearest, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = large.join(lowest, F.col("u") == F.col("k")).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = durable(small.distinct())
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def shared_key_components(pairs: DataFrame) -> DataFrame:
    """(node, component) for ``pairs`` (node, key): nodes that share keys, directly or through others, have one component, its smallest node.

    The nodes of a key become a star around its smallest one, so a key that many nodes have makes as many edges.
    """
    pairs = durable(pairs.where("node is not null and key is not null").select("node", "key").distinct())
    heads = pairs.groupBy("key").agg(F.min("node").alias("head"))
    edges = pairs.join(heads, "key").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    tops = star_components(edges)
    return pairs.select("node").distinct().join(tops.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select("node", F.coalesce("component", "node").alias("component"))
