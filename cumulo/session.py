"""Sessions with the settings that the engine's semantics rest on."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

#: Instants are UTC everywhere; AQE splits skewed joins and merges small partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
}


def create(name: str = "cumulo", **more: str) -> SparkSession:
    # Python workers import this package too, wherever the program was started
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if home not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [home, os.environ.get("PYTHONPATH")]))
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def broadcast_if_small(df, rows: int = 100_000):
    """Hint a broadcast only after counting: at most ``rows`` rows, otherwise an ordinary join."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def spread(df):
    """``df`` in as many partitions as there are cores, if it has fewer: a small file is read by one task, which then does
    alone what follows."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.isStreaming or df.rdd.getNumPartitions() >= cores else df.repartition(cores)


_LOCAL: dict[str, str] = {}


def shared_folder(spark) -> str:
    """Where intermediate tables go: the session's ``spark.checkpoint.dir``; a temporary folder only in a local
    session, whose one process needs no shared disk."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if configured:
        return f"{configured.rstrip('/')}/cumulo-tables-{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the driver and all executors")
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="cumulo-tables-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return f"file://{_LOCAL[app]}"


#: The folder of the innermost ``scratch`` block.
_SCRATCH: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark):
    """What ``cut_lineage`` writes within the block is deleted at its end, so frames made inside it must be written by then."""
    path = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"
    before = _SCRATCH.set(path)
    try:
        yield
    finally:
        _SCRATCH.reset(before)
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def cut_lineage(df, label: str):
    """``df`` written as Parquet into the shared folder and read back: plans that use a frame several times stay
    small, and a lost executor costs no step before."""
    path = f"{_SCRATCH.get() or shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
