"""Session settings and lineage cutting shared by all jobs."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

#: Checkpoint folders written inside the innermost :func:`released` block.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def build_session(app_name: str = "patronage", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution on; everything else is left to the cluster."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # split a hot key's join partition even where that costs another shuffle
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # a checkpoint that no table refers to any more is deleted
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; make one up only where all tasks run in the
    driver's own process."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        context.setCheckpointDir(configured)
    elif re.fullmatch(r"local(\[[^]]*\])?", context.master):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="patronage-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of the executors that made them."""
    prepare_checkpoint_dir(df.sparkSession)
    stored = df.checkpoint(eager=True)
    written = _written.get()
    if written is not None:
        folder = stored._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if folder.isDefined():
            written.append(folder.get())
    return stored


def stored(df: DataFrame) -> DataFrame:
    """The rows written below the checkpoint folder as a table and read back. For loops of joins:
    a checkpoint carries the constraints of the plan it cuts, which such loops multiply."""
    prepare_checkpoint_dir(df.sparkSession)
    folder = f"{df.sparkSession.sparkContext.getCheckpointDir()}/stored-{uuid4().hex}"
    df.write.parquet(folder)
    written = _written.get()
    if written is not None:
        written.append(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Delete the checkpoints that are written in the block when it ends. For jobs that write
    their results: a table that is still to be read must not leave the block."""
    token = _written.set([])
    try:
        yield
    finally:
        folders = _written.get()
        _written.reset(token)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
