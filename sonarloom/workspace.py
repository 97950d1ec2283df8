"""Tables shared between driver and executors, and small helpers used by operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Folders made inside ``scratch`` blocks, innermost last.
_made: list[list[str]] = []


def root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    A directory set by ``setCheckpointDir`` counts too. Only where both are unset and all runs on one machine (tests) a
    temporary folder is made and remembered; on a cluster that is an error, as executors would not share it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        made = spark._jsc.sc().getCheckpointDir()
        folder = made.get() if made.isDefined() else None
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='sonarloom-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder; nothing is created."""
    app = spark.sparkContext.applicationId
    path = f"{root(spark)}/sonarloom-{app}/{name}-{uuid.uuid4().hex}"
    if _made:
        _made[-1].append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession, *keep: str) -> Iterator[None]:
    """Deletes the tables made inside, but those in ``keep``, when the block ends: for work whose result is stored inside."""
    _made.append([])
    try:
        yield
    finally:
        for path in _made.pop():
            if path not in keep:
                delete(spark, path)


def materialize(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back, which cuts its lineage:
    an executor lost later costs a re-read, not a re-computation."""
    path = path or new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete every intermediate table of this application (call it when its results are stored)."""
    delete(spark, f"{root(spark)}/sonarloom-{spark.sparkContext.applicationId}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Bound the rows and bytes of an Arrow batch, so that a batch of long texts fits in a Python worker."""
    for key, most in ("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size):
        key = f"spark.sql.execution.arrow.{key}"
        now = int(spark.conf.get(key).removesuffix("b"))
        if now <= 0 or now > most:
            spark.conf.set(key, str(most))
