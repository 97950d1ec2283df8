"""A transcript as speaker turns: main voices are numbered by first appearance, neighbouring segments of a name merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonarloom.functions import text as T

# Fixed values of the report.
SPEAKER, UNKNOWN, SIMILAR, MATCHED = "Pembicara ", "Pembicara ?", " (mirip {})", "*"


def tenths(c: str) -> Column:
    """A time as a whole number of tenths: a key without fractions."""
    return F.round(F.col(c) * 10).cast("long")


def attribute(segments: DataFrame, spoken: DataFrame, clip: str = "_id") -> DataFrame:
    """Transcript segments with the voice fields of the speaker segment of equal times (to 0.1 s) and text; of several,
    the last counts. ``spoken`` has a column ``pos``."""
    key = [tenths("start").alias("__s"), tenths("end").alias("__e"), F.col("text").alias("__t")]
    last = spoken.select(F.col(clip).alias("__c"), *key, "pos", "voice", "match_voice").groupBy("__c", "__s", "__e", "__t").agg(F.max_by(F.struct("voice", "match_voice"), "pos").alias("v"))
    same = (F.col(clip) == F.col("__c")) & (tenths("start") == F.col("__s")) & (tenths("end") == F.col("__e")) & F.col("text").eqNullSafe(F.col("__t"))
    return segments.join(last, same, "left").select(*segments.columns, F.col("v.voice").alias("voice"), F.col("v.match_voice").alias("match_voice"))


def turns(segments: DataFrame, voices: DataFrame, clip: str = "_id", main_seconds: float = 3.0, target: str = "target") -> DataFrame:
    """clip, turn (from 0), start, name and text of each turn. ``segments``: clip, seg, start, text, voice, match_voice,
    without flagged ones; ``voices``: clip, voice, seconds, label."""
    v = voices.select(F.col(clip).alias("__c"), F.col("voice").alias("__v"), "seconds", "label")
    own = segments.join(v, (F.col(clip) == F.col("__c")) & (F.col("voice") == F.col("__v")), "left").drop("__c", "__v")
    main = F.coalesce(F.col("seconds") >= main_seconds, F.lit(False))
    other = v.select(F.col("__c").alias("__mc"), F.col("__v").alias("__mv"), F.col("seconds").alias("__ms"), F.col("label").alias("__ml"))
    both = own.withColumn("__main", main).join(other, (F.col(clip) == F.col("__mc")) & (F.col("match_voice") == F.col("__mv")), "left")
    matched = ~F.col("__main") & F.col("match_voice").isNotNull()
    pick = lambda a, b: F.when(matched, F.col(a)).otherwise(F.col(b))
    named = both.select(
        clip, "seg", "start", "text", pick("match_voice", "voice").alias("v"), pick("__ml", "label").alias("label"),
        F.coalesce(pick("__ms", "seconds") >= main_seconds, F.lit(False)).alias("main"), F.when(matched, MATCHED).otherwise("").alias("star"),
    )
    by_clip = Window.partitionBy(clip)
    first = F.min(F.when(F.col("main"), F.col("seg"))).over(Window.partitionBy(clip, "v"))
    named = named.withColumn("first", F.when(F.col("main"), first))
    # Every clip's numbers go by first appearance; null places (unknown voices) come last and take none.
    named = named.withColumn("number", F.dense_rank().over(by_clip.orderBy(F.col("first").asc_nulls_last())))
    name = F.when(F.col("main"), F.concat(F.lit(SPEAKER), F.col("number").cast("string"), F.col("star"))).otherwise(UNKNOWN)
    named = named.withColumn("name", F.concat(name, F.when(F.col("label") == "target", SIMILAR.format(target)).otherwise("")))
    order = by_clip.orderBy("seg")
    new = F.when(F.lag("name").over(order).eqNullSafe(F.col("name")), 0).otherwise(1)
    isles = named.withColumn("new", new).withColumn("turn", F.sum("new").over(order) - 1)
    out = isles.groupBy(clip, "turn").agg(F.min_by("start", "seg").alias("start"), F.first("name").alias("name"), F.array_sort(F.collect_list(F.struct("seg", "text"))).alias("t"))
    return out.select(clip, F.col("turn").cast("int").alias("turn"), "start", "name", F.array_join(F.transform("t", lambda s: s["text"]), " ").alias("text"))


def as_text(turn_rows: DataFrame, clip: str = "_id") -> DataFrame:
    """One text per clip: a line ``[m:ss] name: text`` per turn."""
    line = F.concat(F.lit("["), T.mmss("start"), F.lit("] "), F.col("name"), F.lit(": "), F.col("text"))
    rows = turn_rows.select(clip, "turn", line.alias("line")).groupBy(clip).agg(F.array_sort(F.collect_list(F.struct("turn", "line"))).alias("l"))
    return rows.select(clip, F.array_join(F.transform("l", lambda s: s["line"]), "\n").alias("turns"))
