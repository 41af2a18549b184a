"""Small helpers that every operator of this subpackage shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL_SHARED: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local session (one process, so one disk) may leave it unset; it then gets a
    temporary folder of its own. On a cluster a missing setting is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by the driver and all executors")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_SHARED:
        _LOCAL_SHARED[app] = tempfile.mkdtemp(prefix="cumulo-shared-")
        atexit.register(shutil.rmtree, _LOCAL_SHARED[app], ignore_errors=True)
    return "file://" + _LOCAL_SHARED[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in this application's part of the shared folder."""
    return f"{_own_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/cumulo-{spark.sparkContext.applicationId}"


def forget(spark: SparkSession) -> None:
    """Delete all intermediate tables and files of this application. Frames that operators returned read from
    them, so call it when results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_own_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it back."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """Number of partitions for explicit repartitioning: the session's own setting."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(id_column: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus``; null ids give null."""
    return F.crc32(F.col(id_column).cast("string")) % F.lit(modulus)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def to_hex64(column):
    """16 lower-case hexadecimal digits of a signed 64-bit column."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows; else as it is, for an ordinary join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


#: Parts that the join of a hot key is dealt to.
SALTS = 32


def hot_join(left: DataFrame, right: DataFrame, key: str, rows: int, how: str = "inner") -> DataFrame:
    """Join with ``right`` (a row a key): broadcast up to ``rows`` rows, else every key dealt to SALTS parts, and
    rows without a key spread evenly."""
    small = small_side(right, rows)
    if small is not right:
        return left.join(small, key, how)
    spread = F.xxhash64(*[c for c in left.columns if c != key] or [key])
    salted = left.withColumn("__salt", F.when(F.col(key).isNull(), spread).otherwise(F.pmod(spread, F.lit(SALTS))))
    return salted.join(right.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))), [key, "__salt"], how).drop("__salt")


#: Rows in an Arrow batch between Spark and Python: with long texts the default of 10,000 is too many.
ARROW_ROWS = 1_000


def bound_batches(df: DataFrame) -> DataFrame:
    """Lower the session's Arrow batch size to ARROW_ROWS, if it is larger; ``df`` as it is. The setting stays, as
    it is read when the frame is run, which may be long after this call."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= ARROW_ROWS:
        df.sparkSession.conf.set(key, str(ARROW_ROWS))
    return df


def release_memory() -> None:
    """Give freed memory of this Python worker back to the system: workers live on between stages."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library


def grouped(batches, keys: int):
    """Tables of consecutive rows that agree in the first ``keys`` (integer) columns, from Arrow batches."""
    import numpy as np
    import pyarrow as pa

    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(keys)], 1)
        starts = np.r_[0, np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1, len(key)].tolist()
        for start, stop in zip(starts[:-1], starts[1:]):
            if last is not None and (key[start] != last).any():
                yield pa.Table.from_batches(held)
                held = []
            last = key[start]
            held.append(batch.slice(start, stop - start))
    if held:
        yield pa.Table.from_batches(held)


# --- files in the shared folder -------------------------------------------------------------


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def _plain(uri: str) -> str | None:
    if uri.startswith("file:"):
        return "/" + uri[5:].lstrip("/")
    return uri if uri.startswith("/") else None


def make_folder(uri: str) -> None:
    if path := _plain(uri):
        os.makedirs(path, exist_ok=True)
    else:
        f, path = _filesystem(uri)
        f.create_dir(path, recursive=True)


class AtomicFile:
    """A file that appears under its name only when complete.

    Bytes go to a name of this attempt's own, which a rename replaces at the end. A task that is
    run again after an executor loss therefore never leaves half a file or mixes two attempts.
    """

    def __init__(self, uri: str):
        self.uri, self.temporary = uri, f"{uri}.{uuid.uuid4().hex}.tmp"
        if path := _plain(self.temporary):
            self.stream = open(path, "wb", buffering=1 << 20)  # noqa: SIM115
        else:
            self.fs, path = _filesystem(self.temporary)
            self.stream = self.fs.open_output_stream(path)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def commit(self) -> None:
        self.stream.close()
        if path := _plain(self.uri):
            os.replace(_plain(self.temporary), path)
        else:
            self.fs.move(_filesystem(self.temporary)[1], _filesystem(self.uri)[1])


def open_input(uri: str):
    """A seekable binary reader."""
    if path := _plain(uri):
        return open(path, "rb", buffering=1 << 20)  # noqa: SIM115
    f, path = _filesystem(uri)
    return f.open_input_file(path)
