"""Written intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import ctypes
import gc
import shutil
import tempfile
import uuid

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``.  Where it is unset, a local session
    gets a folder of its own; on a cluster that would be another folder on each
    machine, so an error is raised."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="driftwell-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def trim() -> None:
    """Give back what a Python worker's last task has left; workers live on between stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    It cuts the lineage at files that outlive any executor, and gives the
    optimiser the real size, so that a join broadcasts the table only if it is
    below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    path = f"{shared_dir(df.sparkSession)}/driftwell/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return written(df.sparkSession, path, df.schema)


_written: list[tuple[SparkSession, str]] = []


@atexit.register
def clean() -> None:
    """Delete all that this session has written and not discarded.  It runs at the end of the
    driver, for tables that results are read from until then; call it once they are stored."""
    while _written:
        spark, path = _written.pop()
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except (Py4JError, OSError):  # the JVM has ended before
            return


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def written(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table that was written to ``path``, as ``materialise`` gives it."""
    out = spark.read.schema(schema).parquet(path)
    out._driftwell_path = path
    _written.append((spark, path))
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``materialise`` wrote for ``df``, once nothing will read it."""
    _written[:] = [x for x in _written if x[1] != df._driftwell_path]
    _delete(df.sparkSession, df._driftwell_path)
