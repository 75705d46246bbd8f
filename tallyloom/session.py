"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# What every operator here takes for granted. AQE splits the shuffle
# partitions of hot join keys and swaps in broadcast joins once it has seen the
# real size of a side; ANSI makes a bad cast fail instead of turning to null.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session without the setting gets a folder of its own; on a
    cluster a missing setting is an error, since a machine-local folder would
    be lost with the machine.
    """
    conf = spark.sparkContext.getConf()
    named = conf.get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    own = tempfile.mkdtemp(prefix="tallyloom-")
    spark.sparkContext.setCheckpointDir(own)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/tallyloom/{label}-{uuid.uuid4().hex}"


_frozen: ContextVar[list[str] | None] = ContextVar("frozen", default=None)


def freeze(df: DataFrame, label: str = "frozen") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The result no longer depends on its inputs: lost executors re-read files
    instead of recomputing, and values that must not move between computations
    (row numbers over sampled ranges) are fixed.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    paths = _frozen.get()
    if paths is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Drop the tables frozen inside the block when it ends.

    For work whose result has been written elsewhere by then; a frame that still
    reads a frozen table must not leave the block.
    """
    token = _frozen.set([])
    try:
        yield
    finally:
        paths = _frozen.get() or []
        _frozen.reset(token)
        for name in paths:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether the planner's size of ``df`` is within the session's broadcast limit."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return limit > 0 and int(size) <= limit
