"""Connected components of an edge table, and the shared folder that iterative plans are cut into."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir, or a temporary one on a local master where that is unset."""
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="rasterloom-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def cut(df: DataFrame) -> DataFrame:
    """df, computed once into the shared checkpoint folder: later reads survive lost executors and never recompute it."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again.

    Unlike an aggregate, a stored table can meet a hot key in a join: Spark knows its size, so it sends a small one
    everywhere and else splits the hot key's tasks, which it can't while one side comes straight out of a grouping.
    """
    folder = fresh_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(df: DataFrame) -> None:
    """Removes the folders of a table that stored wrote, when nothing is left to read it."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges(a, b): root is the smallest node of its connected component.

    Alternating large-star and small-star rounds. The minimum of each node's neighbours combines before it is shuffled
    and is stored before it is joined back, so adaptive execution may split a node with very many neighbours over
    tasks. The number of rounds grows with the logarithm of the nodes; ``max_rounds`` is a guard that raises and never
    returns an unsettled result. Edges with a null end are left out.
    """
    def marked(df: DataFrame) -> tuple[DataFrame, dict]:
        """df, stored, with its number of rows and two digests of them."""
        told = Observation()
        marks = [F.count(F.lit(1)).alias("n"), F.expr("bit_xor(xxhash64(a, b))").alias("x"), F.expr("bit_xor(xxhash64(b, a, 1))").alias("y")]
        return stored(df.observe(told, *marks), "edges"), told.get

    edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, seen = marked(edges)
    for _ in range(max_rounds if seen["n"] else 0):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stored(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "lowest")
        large = stored(both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        small_low = stored(large.groupBy("a").agg(F.min("b").alias("m")), "lowest")
        small = large.join(small_low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        used, before = (edges, low, large, small_low), seen
        edges, seen = marked(small.unionByName(small_low.select("a", F.col("m").alias("b"))).distinct())
        for table in used:
            discard(table)
        if seen == before:
            break
    else:
        if seen["n"]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
