"""Helpers shared by the training-data operators.

Every operator selects the columns it needs under names of its own, so extra
or clashing columns of the input never reach its plan.
"""

from __future__ import annotations

import contextlib
import ctypes
import math
import pickle
import re
import sys
import types
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import loadcast
from loadcast.session import work_dir
from loadcast.sources.testdata import table  # noqa: F401  (re-exported)

BATCH_ROWS = 1000

# Task functions travel by value: workers need no copy of the package.
cloudpickle.register_pickle_by_value(loadcast)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` under the cluster's shared checkpoint folder
    and read it back, so a lost executor never repeats what came before."""
    return stored(df, name)[0]


def stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``written``, and the folder, for a caller that knows when it is done."""
    spark: SparkSession = df.sparkSession
    path = f"{work_dir(spark, name)}/t"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``stored`` made."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast a bounded object together with its class (workers need no copy
    of the package); a task gets it by calling the result."""
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def kept(name: str, make: Callable[[], object]) -> object:
    """An object that a worker process makes once and keeps for later tasks
    (a bounded cache; tasks give the same results without it).  What operators
    before kept goes (names that begin otherwise up to the first - or :)."""
    held = sys.modules.setdefault("loadcast_worker_state", types.ModuleType("loadcast_worker_state")).__dict__
    owner = re.split("[-:]", name)[0]
    for other in [k for k in held if not k.startswith("__") and re.split("[-:]", k)[0] != owner]:
        del held[other]
    if name not in held:
        held[name] = make()
    return held[name]


def give_back() -> None:
    """Return memory that a worker process has freed to the machine: workers
    outlive their tasks, and what they hold counts for the executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def in_small_batches(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """``df``, whose texts go to Python in batches of at most ``rows`` (the
    session's own setting if that is smaller), so that a task's memory does not
    grow with long texts times a large batch."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= rows:
        df.sparkSession.conf.set(key, rows)
    return df


def texts_of(batch: pa.RecordBatch, field: str | None = None) -> list[bytes | None]:
    """The texts of a batch as UTF-8: its column ``t``, or a field of ``row``
    (so that a text that travels with its row is sent once)."""
    if field is None:
        return batch.column("t").to_pylist()
    return pc.struct_field(batch.column("row"), field).cast(pa.binary()).to_pylist()


def n_blocks(rows: int, per_block: int) -> int:
    """Blocks of about ``per_block`` rows; at least one, growing with the data."""
    return max(1, math.ceil(rows / per_block))


def text_or_empty(col: str) -> F.Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))
