"""Records of append logs: the latest per key, what is still to be done, retries, sidecars and point look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonarloom.functions import text as T


def has_file(c: str = "file") -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def latest(log: DataFrame, key: str = "_id", order: str = "line_no", with_file: bool = False) -> DataFrame:
    """The last record of each key, and ``first_line``, the place at which the key first stood. A partial aggregate, so
    a key with very many records is no hot spot. ``with_file``: only records with a file count."""
    rows = log.where(has_file()) if with_file else log
    best = rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), order).alias("r"), F.min(order).alias("first_line"))
    return best.select("r.*", "first_line")


def pending(docs: DataFrame, done: DataFrame, key: str = "_id") -> DataFrame:
    return docs.join(done.select(key).distinct(), key, "left_anti")


def without_failed(records: DataFrame, status: str = "transcript_status") -> DataFrame:
    return records.where(F.coalesce(F.col(status), F.lit("")) != "failed")


def multi_get(posts: DataFrame, keys: DataFrame) -> DataFrame:
    """Contents of the posts asked for by (``_index``, ``_id``); keys without an index are skipped."""
    asked = keys.where(F.coalesce(F.col("_index"), F.lit("")) != "").select("_index", "_id").distinct()
    return posts.join(asked, ["_index", "_id"]).select("_id", F.coalesce("content", F.lit("")).alias("content"))


def captions(records: DataFrame, cache: DataFrame, key: str = "_id") -> DataFrame:
    """A ``caption`` per record: the cached one even if empty, else the record's own content."""
    known = cache.select(F.col(key).alias("__k"), F.col("text").alias("__t"))
    return records.join(known, F.col(key) == F.col("__k"), "left").withColumn("caption", F.when(F.col("__k").isNotNull(), F.col("__t")).otherwise(T.text_of("content"))).drop("__k", "__t")


def refreshed(cache: DataFrame, new: DataFrame, key: str = "_id") -> DataFrame:
    """Union of two maps; the new one wins."""
    return cache.join(new.select(key), key, "left_anti").unionByName(new)


def derived_manifest(manifest: DataFrame, stats: DataFrame, key: str = "_id") -> DataFrame:
    """The manifest with the prepared file of clips whose measurement succeeded, null for the others."""
    ok = stats.where("status = 'ok'").select(F.col(key).alias("__k")).distinct()
    out = manifest.join(ok, F.col(key) == F.col("__k"), "left").withColumn("source_file", F.col("file"))
    return out.withColumn("file", F.when(F.col("__k").isNotNull(), F.concat(T.file_stem("source_file"), F.lit(".wav")))).drop("__k")


def missing_captions(records: DataFrame, cache: DataFrame, key: str = "_id") -> DataFrame:
    """Records without a cached caption that can be asked for: those with an index."""
    return records.join(cache.select(key), key, "left_anti").where(F.coalesce(F.col("_index"), F.lit("")) != "")


def with_file(records: DataFrame, manifest: DataFrame, strict: bool = False, key: str = "_id") -> DataFrame:
    """The file of each record; ``strict``: a record without one is an error, as scoring needs the audio."""
    found = records.join(manifest.select(F.col(key).alias("__k"), "file"), F.col(key) == F.col("__k"), "left").drop("__k")
    if not strict:
        return found
    message = F.concat(F.lit("no file for "), F.coalesce(F.col(key).cast("string"), F.lit("a record without id")))
    return found.withColumn("file", F.when(has_file(), F.col("file")).otherwise(F.raise_error(message)))


def overridden(records: DataFrame, new: DataFrame, key: str = "_id") -> DataFrame:
    """Records whose fields the row of the same key in ``new`` replaces, nulls included; rows of ``new`` are one a key. Fields
    that only ``new`` has are added, null for records without a row there."""
    side = new.select(F.col(key).alias("__k"), F.lit(True).alias("__in"), *[F.col(n).alias(f"__{n}") for n in new.columns if n != key])
    out = records.join(side, F.col(key) == F.col("__k"), "left")
    replaced = {n: F.when(F.col("__in"), F.col(f"__{n}")).otherwise(F.col(n) if n in records.columns else F.lit(None)) for n in new.columns if n != key}
    return out.withColumns(replaced).drop("__k", "__in", *[f"__{n}" for n in new.columns if n != key])
