"""Connected components of a graph whose edges may be more than a machine holds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialogue_engine.scratch import written


def _reach(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """One star step: every node hands its neighbours to its smallest neighbour.

    The large step moves the neighbours above a node, the small step those below it and the
    node itself. Both keep the components; in turn they shrink any of them to a star. The
    smallest neighbour is a partial aggregate, so a node with very many edges is one row per
    task; the join that follows has one row per node on its other side.
    """
    backwards = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    around = edges if smaller_only else edges.unionByName(backwards)
    least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    moved = around if smaller_only else around.where(F.col("b") > F.col("a"))
    handed = moved.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    if smaller_only:
        handed = handed.unionByName(least.select("a", F.col("m").alias("b")))
    return handed.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node each node of an edge (a, b) is connected with.

    Any orderable type of node. Nodes without an edge do not appear. Edges may repeat, point
    either way, or join a node to itself. Every round is written to the shared folder, so a
    lost executor costs at most one round; the number of rounds grows with the logarithm of
    the longest path.
    """
    down = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    )
    now = written(down.distinct())
    print_of = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))]
    seen = now.agg(*print_of).first()
    while True:
        now = written(_reach(_reach(now, smaller_only=False), smaller_only=True))
        found = now.agg(*print_of).first()
        if found == seen:
            break
        seen = found
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
