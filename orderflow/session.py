"""Session helpers: durable staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import contextmanager
from functools import lru_cache

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


@lru_cache(maxsize=8)
def _temporary_dir(application_id: str) -> str:
    return "file:" + tempfile.mkdtemp(prefix=f"orderflow-{application_id}-")


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only a local session, where driver and executors share one machine, may
    fall back to a temporary folder.
    """
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder shared by all executors")
    return _temporary_dir(spark.sparkContext.applicationId)


#: Staged paths of the open areas, innermost last.
_areas: list[list[str]] = []


def delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def staging_area(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end; nothing may read them afterwards."""
    _areas.append([])
    try:
        yield
    finally:
        for path in _areas.pop():
            delete(spark, path)


@contextmanager
def branches(spark: SparkSession) -> Iterator[Callable[[Callable], Future]]:
    """Give a function that starts work beside the caller's, in a thread of the same session.

    Work that was started is finished before the block is left, also by an error; a branch's own
    error is raised by its ``result()``.
    """
    with ThreadPoolExecutor(max_workers=64, thread_name_prefix="branch") as pool:
        yield lambda work: pool.submit(inheritable_thread_target(spark)(work))


def staged_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; inside a staging area it is deleted at its end."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _areas:
        _areas[-1].append(path)
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Lineage ends at files that outlive any executor, later passes read only
    the columns they need, and Catalyst sees the true table size.
    """
    spark = df.sparkSession
    path = staged_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
