"""Session helpers: a tuned builder for local runs and lineage cutting for loops."""

from __future__ import annotations

import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "keyscout", cpus: str = "8", memory: str = "16g") -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, use the session you are given."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``, for tables and checkpoints.

    A temporary folder is used only where that is unset and the master is local.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="keyscout-checkpoint-")
    return folder.rstrip("/")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and continue from the files.

    The folder is that of ``shared_folder``.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder, read back: ``cut_lineage`` for loops that join their own result.

    A checkpoint keeps the optimizer's estimate of its size. Each join multiplies the estimates of its sides, so over
    the rounds of a loop the number outgrows all bounds and planning never ends; files have a size of their own.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    path = f"{shared_folder(spark)}/rounds-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def kept_table(df: DataFrame):
    """``df`` as a table in the shared folder for the block, so that its plan runs once; the table goes with the block."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    path = f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def settled(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage, for a small result that several steps read.

    Without this each reader would scan the source tables again.
    """
    plan = df._jdf.queryExecution().logical().getClass().getSimpleName()
    return df if plan in ("LogicalRDD", "LocalRelation") else cut_lineage(df)


SMALL_BYTES = 4 << 30


@contextmanager
def kept_if_small(df: DataFrame):
    """``df``, cached for the block if its estimated size is small.

    Larger inputs are read again by each pass, since a pass over few columns of a columnar
    file is cheaper than spilling the whole table.
    """
    small = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= SMALL_BYTES
    if not small:
        yield df
        return
    cached = df.persist()
    try:
        yield cached
    finally:
        cached.unpersist()
