"""Shared working storage: where a job cuts lineage.

A cluster names the shared folder in ``spark.checkpoint.dir``; that setting is
read from the session. Only a local session that has none gets a folder of its
own, as unit tests do.

Every function that writes takes the folder as ``work``; without one it makes a
new folder below the shared one. ``release`` removes a folder once nothing reads
its tables any more; a job that keeps to one folder releases all it wrote at once.
"""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.conf.get("spark.master", "") or ""
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.conf.get("spark.app.id")
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tillroll-")
    return _local_dirs[app]


def work_path(spark: SparkSession, name: str, work: str | None = None) -> str:
    """A fresh path, below ``work`` if given; never reused, so a retry cannot mix runs."""
    root = work or f"{shared_dir(spark).rstrip('/')}/tillroll"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, work: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Compared with ``checkpoint()`` the table is columnar and carries its real
    size, so the join that follows broadcasts it only when that size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and is otherwise a sort-merge join
    whose hot partitions the adaptive planner can split (it splits only sides
    that come straight from a shuffle, which an aggregate does not).
    """
    spark = df.sparkSession
    path = work_path(spark, name, work)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, work: str) -> bool:
    """Remove a work folder and all tables in it; whether there was one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def many_small_files(spark: SparkSession) -> Iterator[None]:
    """Spark's settings for very many small objects, as long as the block runs.

    By default a folder of more than 32 folders is listed by a job with one task
    per folder, and a task reads 32 small objects. Inside the block a listing has a few tasks
    per core, and an object counts as its size and a little. What the session sets itself stays.
    """
    wanted = {
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": str(4 * spark.sparkContext.defaultParallelism),
        "spark.sql.files.openCostInBytes": "64k",
    }
    ours = {name: value for name, value in wanted.items() if name not in spark.conf.getAll}
    for name, value in ours.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in ours:
            spark.conf.unset(name)
