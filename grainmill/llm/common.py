"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: 2**32 - 1, the mask of an unsigned 32-bit number.
U32 = 0xFFFFFFFF


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` to the folder that the cluster shares and cut its lineage.

    The folder is the one in ``spark.checkpoint.dir``, or that shared_folder() makes.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a session on one machine may leave it unset, and gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="grainmill-")


def parallelism(df: DataFrame) -> int:
    """Partitions that a shuffle of this session makes."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def digest(value: Column) -> Column:
    """SHA-256 of a string's UTF-8 bytes, lowercase hex."""
    return F.sha2(value, 256)


#: Bytes of an Arrow batch on its way to and from Python; the default of 64 MB is held several times over by every task.
BATCH, BATCH_KEY = "4194304b", "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, for a session whose Arrow batches are bounded by BATCH unless it sets another bound than the default."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_KEY, None) in (None, "67108864b"):
        conf.set(BATCH_KEY, BATCH)
    return df


def relieve() -> None:
    """Gives memory that earlier tasks of this worker have freed back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_RESIDENT: dict = {}


def resident(kind: str, build, *key):
    """A model that a Python worker keeps from task to task: one at a time, so that the stages of a pipeline don't add up in its memory."""
    relieve()
    name = (kind, key)
    if name not in _RESIDENT:
        _RESIDENT.clear()
        _RESIDENT[name] = build(*key)
    return _RESIDENT[name]


def in_parts(batch: pa.RecordBatch, column: int, most: int = 4_000_000):
    """Slices of a batch with about ``most`` bytes of text, one row at least, and their texts."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = size[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(size, before + most, side="right")))
        part = batch.slice(start, stop - start)
        yield part, part.column(column).to_pylist()
        start = stop
