"""Incremental runs on Structured Streaming: resumable logs, upserts, sliding and session windows of event time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace
from sonarloom.operators.latest import latest


def new_only(stream: DataFrame, key: str = "_id", ts: str | None = None, delay: str = "1 day") -> DataFrame:
    """The first record of each key; with a time column, state older than the delay is dropped."""
    if ts:
        return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    return stream.dropDuplicates([key])


def upsert_into(path: str, key: str = "_id", order: str = "line_no", buckets: int = 256) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: keeps the latest record of each key in a table of ``buckets`` by the key's hash.

    A batch reads and rewrites only the buckets that it touches, under ``path/data/epoch=<n>/bucket=<k>``, and then writes
    ``path/buckets/epoch=<n>``: a row per bucket (so of bounded number) with the epoch that holds it. A batch that is run
    again starts from the epochs before it, so a restart changes nothing; files that the epoch before replaced are
    deleted, so the table doesn't grow by its history."""

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        new = latest(batch, key, order).drop("first_line").withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        new = workspace.materialize(new, "upserts")
        touched = {r["bucket"] for r in new.select("bucket").distinct().collect()}
        epochs = _epochs(spark, path)
        before = [e for e in epochs if e < epoch]
        known = _places(spark, path, before[-1]) if before else {}
        old = [f"{path}/data/epoch={e}/bucket={b}" for b, e in known.items() if b in touched]
        rows = new.drop("bucket")
        if old:
            rows = latest(spark.read.schema(rows.schema).parquet(*old).unionByName(rows), key, order).drop("first_line")
        dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/data/epoch={epoch}")
        places = list((known | dict.fromkeys(touched, epoch)).items())
        spark.createDataFrame(places, "bucket int, epoch bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/buckets/epoch={epoch}")
        if len(before) > 1:
            # A reader of the last version may still be at work; what the version before it alone had can go.
            for b, e in _places(spark, path, before[-2]).items():
                if known.get(b) != e:
                    _path(spark, f"{path}/data/epoch={e}/bucket={b}", delete=True)

    return write


def upserted(spark: SparkSession, path: str) -> DataFrame:
    """The table that ``upsert_into`` keeps, as of its last batch."""
    epochs = _epochs(spark, path)
    if not epochs:
        raise ValueError(f"{path} holds no batch yet")
    return spark.read.parquet(*[f"{path}/data/epoch={e}/bucket={b}" for b, e in _places(spark, path, epochs[-1]).items()])


def _path(spark: SparkSession, path: str, delete: bool = False):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if delete:
        store.delete(where, True)
    return store, where


def _epochs(spark: SparkSession, path: str) -> list[int]:
    """Epochs whose list of buckets is written whole."""
    store, where = _path(spark, f"{path}/buckets")
    names = [f.getPath() for f in store.listStatus(where)] if store.exists(where) else []
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(int(p.getName().partition("=")[2]) for p in names if store.exists(done(p, "_SUCCESS")))


def _places(spark: SparkSession, path: str, epoch: int) -> dict[int, int]:
    return {r["bucket"]: r["epoch"] for r in spark.read.parquet(f"{path}/buckets/epoch={epoch}").collect()}


def sliding(events: DataFrame, ts: str, size: str = "3 seconds", hop: str = "1.5 seconds", *keys: str, delay: str | None = None) -> DataFrame:
    rows = events.withWatermark(ts, delay) if delay else events
    out = rows.groupBy(F.window(ts, size, hop), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")


def sessions(events: DataFrame, ts: str, gap: str, *keys: str, delay: str | None = None) -> DataFrame:
    rows = events.withWatermark(ts, delay) if delay else events
    out = rows.groupBy(F.session_window(ts, gap), *keys).agg(F.count("*").alias("n"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *keys, "n")
