"""Connected components by contraction, as joins and aggregations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgertone.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written once to shared storage and read back: a lost executor cannot change it, and it runs once."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """(a, b) to (node, label): one label for each component, which is one of its nodes; every node of an edge occurs.

    In each round a node takes the neighbour, or itself, that comes first: by number of links, then by a hash drawn
    anew for the round. The graph is contracted to what was taken. A star of any size goes in one round, since all
    take its centre; of a chain a constant share goes in each. A node with very many links costs one row in each task
    after partial aggregation.
    """
    edges = staged(edges.select("a", "b").where("a <> b").distinct(), "edges")
    none = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    steps = []
    while not edges.isEmpty():
        salt = F.lit(len(steps))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links = both.groupBy("a").agg((-F.count("*")).alias("links"))
        ranked = both.join(links.select(F.col("a").alias("b"), "links"), "b")
        best = ranked.groupBy("a").agg(
            F.min(F.struct("links", F.xxhash64(salt, "b").alias("r"), F.col("b").alias("v"))).alias("best"),
            (-F.count("*")).alias("links"),
        )
        own = F.struct("links", F.xxhash64(salt, "a").alias("r"), F.col("a").alias("v"))
        taken = staged(
            best.select(F.col("a").alias("node"), F.least(own, F.col("best"))["v"].alias("label")), "taken"
        )
        steps.append(taken)
        of_a = taken.select(F.col("node").alias("a"), F.col("label").alias("la"))
        of_b = taken.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        edges = staged(
            edges.join(of_a, "a").join(of_b, "b").where("la <> lb")
            .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "edges",
        )
    if not steps:
        return none
    nodes = steps[0]
    for taken in steps[1:]:
        step = taken.select(F.col("node").alias("label"), F.col("label").alias("next"))
        nodes = nodes.join(step, "label", "left").select("node", F.coalesce("next", "label").alias("label"))
    return staged(nodes, "nodes") if len(steps) > 1 else nodes
