"""Session defaults, and shipping this package to Python workers."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import weakref
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Rows of long texts must not make huge Arrow batches.
ARROW_BYTES = "16m"
#: Plan-shaping settings; sizes of partitions are left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": ARROW_BYTES,
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}

_shipped: set[str] = set()
_folders: list[tuple[SparkSession, str]] = []
_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def get_session(app: str = "newsweft", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in (DEFAULTS | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in the session's Python workers; once for each application."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        root = Path(__file__).resolve().parent
        to = Path(tempfile.mkdtemp(prefix="newsweft-ship-")) / "newsweft.zip"
        with zipfile.ZipFile(to, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(to))
        _shipped.add(app)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the one the cluster shares; a local one only in local mode where none is configured."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="newsweft-")
    path = f"{root.rstrip('/')}/newsweft-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"
    _folders.append((spark, path))
    return path


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written below the shared folder and read back, which cuts its lineage; deleted by ``release`` or when the process ends."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(df: DataFrame) -> None:
    """Delete what ``written`` wrote of ``df``, which nothing may read any more."""
    if path := _written.pop(df, None):
        _folders.remove((df.sparkSession, path))
        _delete(df.sparkSession, path)


@atexit.register
def release_folders() -> None:
    """Delete the shared folders of this process; results that still read them become unreadable."""
    while _folders:
        _delete(*_folders.pop())
