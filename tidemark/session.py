"""Session helpers.

On a cluster the session is created by the platform; we only read settings from
it.  ``get_session`` is for tests, local benches and scripts.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    builder = (
        SparkSession.builder.master(master or os.environ.get("TIDEMARK_MASTER", "local[*]"))
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Runtime SQL settings for what runs inside; afterwards the session has its own again."""
    names = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read here.
    Only when it is unset (local tests) is a scratch folder created and set.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        current = held.get() if held.isDefined() else None
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.sparkContext.setCheckpointDir(current)
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def write_layer(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: computed once, whatever reads it, and lost
    executors recompute from it.  Unlike a checkpoint, its columns are read as they are needed."""
    path = scratch_path(spark, name)
    # a ladder of some 30 cases over many aliases of one column makes the inference of constraints explode
    with settings(spark, spark__sql__constraintPropagation__enabled="false"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
