"""Intermediate tables in the shared checkpoint folder.

Lineage is cut by writing a table below ``spark.checkpoint.dir`` and reading it
back, so a lost executor never costs more than one stage. Tables live until the
process ends, unless ``free`` or a later ``stage_of`` deletes them before.
"""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..session import ship


@dataclass
class _Scratch:
    spark: SparkSession
    path: str
    table: str | None
    stage: str | None


_written: list[_Scratch] = []
_stage: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share. A local one only in local mode where none is configured."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="newsweft-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str, table: str | None = None) -> str:
    ship(spark)
    path = f"{scratch_root(spark)}/newsweft-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    _written.append(_Scratch(spark, path, table, _stage[-1] if _stage else None))
    return path


def persist(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the table that was written."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def persist_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As ``persist``, bucketed by ``key`` so that later joins on it move only the other side."""
    spark = df.sparkSession
    table = f"newsweft_{name}_{uuid.uuid4().hex[:12]}"
    (df.write.format("parquet").option("compression", "zstd").option("path", new_path(spark, name, table))
       .bucketBy(buckets, key).saveAsTable(table))
    return spark.table(table)


def roots_of(df: DataFrame) -> set[str]:
    """Folders that a DataFrame reads."""
    found, leaves = set(), df._jdf.queryExecution().analyzed().collectLeaves()
    for i in range(leaves.size()):
        with contextlib.suppress(Exception):  # leaves that are no files have no location
            paths = leaves.apply(i).relation().location().rootPaths()
            found |= {paths.apply(k).toUri().getPath() for k in range(paths.size())}
    return found


def _delete(x: _Scratch) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        if x.table:
            x.spark.sql(f"DROP TABLE IF EXISTS {x.table}")
        where = x.spark._jvm.org.apache.hadoop.fs.Path(x.path)
        where.getFileSystem(x.spark._jsc.hadoopConfiguration()).delete(where, True)


def _under(path: str, roots: set[str]) -> bool:
    return any(path.endswith(r) or r.endswith(path) or path in r for r in roots)


def free(*dfs: DataFrame) -> None:
    """Delete the scratch tables that these DataFrames read; nothing may read them any more."""
    roots = set().union(*map(roots_of, dfs))
    for x in [x for x in _written if _under(x.path, roots)]:
        _delete(x)
        _written.remove(x)


def sweep(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


@contextlib.contextmanager
def stage_of(pipeline: str, docs: DataFrame) -> Iterator[None]:
    """A stage of a pipeline: tables of the pipeline's earlier stages go, except those that ``docs`` reads.

    The result of the stage before must have been written, as ``docs`` has it.
    """
    keep = roots_of(docs)
    for x in [x for x in _written if x.stage == pipeline and not _under(x.path, keep)]:
        _delete(x)
        _written.remove(x)
    sweep(docs.sparkSession)
    _stage.append(pipeline)
    try:
        yield
    finally:
        _stage.pop()


@atexit.register
def release() -> None:
    """Delete every scratch table of this process; results that still read them become unreadable."""
    while _written:
        _delete(_written.pop())
