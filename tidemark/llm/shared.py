"""Written tables in the shared checkpoint folder, and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path


def write_table(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts lineage and survives lost executors."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def connected_components(spark: SparkSession, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the undirected edges; component: its smallest node.

    Alternating large-star and small-star rounds: each links neighbourhoods to
    their smallest node, so the number of edges never grows and the number of
    rounds is logarithmic in practice.  Every round is a written table; only a
    count and a digest of the edges reach the driver.
    """

    def smallest(near: DataFrame) -> DataFrame:
        return near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))

    def seal(df: DataFrame) -> tuple[DataFrame, tuple]:
        df = write_table(spark, df, "components")
        digest = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return df, tuple(digest)

    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    e, before = seal(e)
    while before[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(smallest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        low = smallest(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        e, after = seal(small.where("u != v").distinct())
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v"), F.col("v")).distinct())


def ship_library(spark: SparkSession) -> None:
    """Give the Python workers this library, unless PYTHONPATH names it: Spark's own file
    server hands a zip of the package from the driver to every executor."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    context = spark.sparkContext
    if root in os.environ.get("PYTHONPATH", "").split(os.pathsep) or getattr(context, "_tidemark_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-lib-"), "tidemark.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "tidemark")):
            for name in names:
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), root))
    context.addPyFile(path)
    context._tidemark_shipped = True
