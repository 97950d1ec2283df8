"""Windows of media time: overlapping windows inside segments, and unions of intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonarloom.functions import text as T
from sonarloom.operators.transcript import NO_SPEECH_PROB, STOCK_PHRASES

WINDOW, HOP, SHORTEST = 3.0, 1.5, 1.0


def speech_segments(segments: DataFrame, shortest: float = SHORTEST) -> DataFrame:
    """Segments that hold speech long enough, with ``clip_end`` inside the audio. Columns: start, end, audio_seconds,
    text, no_speech_prob, hallucination."""
    end = F.least("end", "audio_seconds")
    voiced = F.coalesce("no_speech_prob", F.lit(0.0)) < NO_SPEECH_PROB
    fine = F.col("hallucination").isNull() & ~T.bare("text").isin(STOCK_PHRASES)
    return segments.withColumn("clip_end", end).where(voiced & fine & (F.col("clip_end") - F.col("start") >= shortest))


def sliding(segments: DataFrame, size=WINDOW, hop=HOP, start: str = "start", end: str = "clip_end") -> DataFrame:
    """A row per window: k, win_start, win_end. The last window ends with the segment; 3.0 s or less make one."""
    n = F.greatest(F.ceil((F.col(end) - F.col(start) - size) / hop), F.lit(0)).cast("int")
    out = segments.withColumn("k", F.explode(F.sequence(F.lit(0), n)))
    return out.withColumn("win_start", F.col(start) + F.col("k") * hop).withColumn("win_end", F.least(F.col("win_start") + size, F.col(end)))


def merged(spans: DataFrame, key: str, start: str = "start", end: str = "end") -> DataFrame:
    """Overlapping or touching spans of a key as one: key, start, end."""
    by = Window.partitionBy(key).orderBy(start, end)
    before = F.max(end).over(by.rowsBetween(Window.unboundedPreceding, -1))
    isle = F.sum(F.when(before >= F.col(start), 0).otherwise(1)).over(by)
    marked = spans.withColumn("__isle", isle)
    return marked.groupBy(key, "__isle").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__isle")


def energy_share(part: Column, whole: Column) -> Column:
    """Energy of a part's samples against that of the whole's."""
    energy = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    return energy(part) / F.greatest(energy(whole), F.lit(1e-9))


def overlaps(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Pairs of spans of a key that overlap, with the overlap's length: a range join on top of an equi join."""
    x = a.select(key, F.col("start").alias("a_start"), F.col("end").alias("a_end"))
    y = b.select(key, F.col("start").alias("b_start"), F.col("end").alias("b_end"))
    out = x.join(y, key).where("a_start < b_end and b_start < a_end")
    return out.withColumn("overlap", F.least("a_end", "b_end") - F.greatest("a_start", "b_start"))
