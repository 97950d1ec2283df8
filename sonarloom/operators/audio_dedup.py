"""Clips that carry the same audio: alignment of bit fingerprints, candidate blocking, groups.

The pair search never compares all pairs: fingerprints that can match at a low bit-error rate share exact values, so
pairs are found by an equi join on values, ``least`` of which must be shared."""

from __future__ import annotations

import difflib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from sonarloom.functions import text as T
from sonarloom.operators.components import components
from sonarloom.operators.report import numbered

#: Seconds per fingerprint value of the public Chromaprint algorithm: a hop of 4096 / 3 samples at 11025 Hz.
ITEM = 4096 / 3 / 11025
MAX_BER, MIN_OVERLAP, FLAT = 0.20, 5.0, 10


def not_flat(fp: str = "fp") -> Column:
    """Silence and constant tones have few distinct values and match anything flat."""
    return F.size(F.array_distinct(fp)) > FLAT


def _signs(x: np.ndarray) -> np.ndarray:
    """A row of +1 and -1 per bit of the values."""
    bits = np.asarray(x, np.uint64) >> np.arange(32, dtype=np.uint64)[:, None] & np.uint64(1)
    return np.where(bits == 1, 1.0, -1.0)


def align(a: np.ndarray, b: np.ndarray, item: float = ITEM, min_overlap: float = MIN_OVERLAP) -> tuple[float, int, int] | None:
    """(bit error rate, offset of b in a, overlap) at the first offset with the lowest rate; None if none overlaps enough.

    The overlap asked for bounds the offsets to look at; agreements at all of them are one correlation of bits by a
    Fourier transform, rounded back to whole numbers."""
    need = max(1, int(np.ceil(min_overlap / item - 1e-9)))
    if need > min(len(a), len(b)):
        return None
    offsets = range(need - len(b), len(a) - need + 1)
    length = len(a) + len(b)
    spectrum = (np.fft.rfft(_signs(a), length) * np.fft.rfft(_signs(b), length).conj()).sum(axis=0)
    # The place of a negative offset in a circular correlation is counted from its end.
    agree = np.rint(np.fft.irfft(spectrum, length)).astype(np.int64)[np.array(offsets) % length]
    shared = np.array([min(len(a) - max(o, 0), len(b) + min(o, 0)) for o in offsets])
    rates = (32 * shared - agree) / (64.0 * shared)
    best = int(np.argmin(rates))
    return float(rates[best]), offsets[best], int(shared[best])


def candidates(fps: DataFrame, key: str = "_id", fp: str = "fp", least: int = 1, order: str | None = None) -> DataFrame:
    """Pairs a, b (a before b) of clips that aren't flat and share ``least`` distinct values or more, and their number.

    Each clip is looked up by its rarest values only, ``least - 1`` fewer than it has: of so many shared ones, at least
    one is among them on both sides. So values that very many clips have, as of silence, make no pairs unless a clip
    has ``least`` of them. The pairs found are counted on their whole sets."""
    order = order or key
    solid = fps.where(not_flat(fp)).select(F.col(key).alias("k"), F.col(order).alias("o"), F.array_distinct(fp).alias("own"))
    values = solid.select("k", "o", F.size("own").alias("n"), F.explode("own").alias("value"))
    spread = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    common = values.join(spread, "value").groupBy("k", "o", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("v"))
    # Values of one clip only come first in the order and need no row.
    rare = common.select("k", "o", F.explode(F.slice("v", F.lit(1), F.greatest(F.size("v") - (least - 1), F.lit(0)))).alias("v")).select("k", "o", "v.value")
    x, y = (rare.select(F.col("k").alias(s), F.col("o").alias(f"o{s}"), "value") for s in "ab")
    pairs = x.join(y, "value").where((F.col("oa") < F.col("ob")) | (F.col("oa") == F.col("ob")) & (F.col("a") < F.col("b"))).select("a", "b").distinct()
    left, right = (solid.select(F.col("k").alias(s), F.col("own").alias(f"v{s}")) for s in "ab")
    both = pairs.join(left, "a").join(right, "b")
    return both.select("a", "b", F.size(F.array_intersect("va", "vb")).cast("long").alias("shared")).where(F.col("shared") >= least)


def alignments(pairs: DataFrame, fps: DataFrame, key: str = "_id", max_ber: float = MAX_BER, item: float = ITEM, min_overlap: float = MIN_OVERLAP) -> DataFrame:
    """a, b, ber, lag and overlap (in values) of pairs whose best alignment has a low bit error rate."""
    kind = fps.schema[key].dataType.simpleString()
    wide = pairs.select("a", "b").join(fps.select(F.col(key).alias("a"), F.col("fp").alias("fa")), "a").join(fps.select(F.col(key).alias("b"), F.col("fp").alias("fb")), "b")

    def run(batches):
        for pdf in batches:
            found = [align(np.asarray(x), np.asarray(y), item, min_overlap) for x, y in zip(pdf["fa"], pdf["fb"])]
            keep = [f is not None and f[0] <= max_ber for f in found]
            good = [f for f, k in zip(found, keep) if k]
            yield pdf.loc[keep, ["a", "b"]].assign(ber=[g[0] for g in good], lag=[g[1] for g in good], overlap=[g[2] for g in good])

    return wide.mapInPandas(run, f"a {kind}, b {kind}, ber double, lag int, overlap int")


def native_alignments(pairs: DataFrame, fps: DataFrame, key: str = "_id", min_values: int = 1) -> DataFrame:
    """The same in built-in functions, by counting differing bits at every offset: exact, for short fingerprints."""
    wide = pairs.select("a", "b").join(fps.select(F.col(key).alias("a"), F.col("fp").alias("fa")), "a").join(fps.select(F.col(key).alias("b"), F.col("fp").alias("fb")), "b")
    m, n = F.size("fa"), F.size("fb")
    at = wide.select("a", "b", "fa", "fb", F.explode(F.sequence(1 - n, m - 1)).alias("lag"))
    at = at.withColumn("overlap", F.least(F.size("fa"), F.col("lag") + F.size("fb")) - F.greatest(F.lit(0), F.col("lag"))).where(F.col("overlap") >= min_values)
    part = F.zip_with(F.slice("fa", F.greatest(F.lit(0), F.col("lag")) + 1, F.col("overlap")), F.slice("fb", F.greatest(F.lit(0), -F.col("lag")) + 1, F.col("overlap")), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    at = at.withColumn("wrong", F.aggregate(part, F.lit(0), lambda s, x: s + x))
    rate = (F.col("wrong") / (32.0 * F.col("overlap"))).alias("ber")
    best = at.select("a", "b", rate, "lag", "overlap").groupBy("a", "b").agg(F.min(F.struct("ber", "lag", "overlap")).alias("m"))
    return best.select("a", "b", "m.ber", "m.lag", "m.overlap")


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, list(x), list(y)).ratio() for x, y in zip(a, b)])


def transcript_ratio(a, b) -> Column:
    """Similarity of two texts as lists of words; 1 for two empty ones."""
    return F.round(_ratio(T.words(a), T.words(b)), 3)


def with_texts(pairs: DataFrame, texts: DataFrame, key: str = "_id", text: str = "transcript") -> DataFrame:
    """transcript_ratio of each pair; a missing transcript is empty."""
    t = texts.select(F.col(key).alias("__k"), F.col(text).alias("__t"))
    out = pairs.join(t.withColumnsRenamed({"__k": "ka", "__t": "ta"}), F.col("a") == F.col("ka"), "left").join(t.withColumnsRenamed({"__k": "kb", "__t": "tb"}), F.col("b") == F.col("kb"), "left")
    return out.withColumn("transcript_ratio", transcript_ratio("ta", "tb")).drop("ka", "kb", "ta", "tb")


def groups(pairs: DataFrame, nodes: DataFrame, key: str = "_id", order: tuple[str, ...] = ("created_at", "line_no")) -> DataFrame:
    """keep (the earliest) and duplicates of each group of linked clips, in node order; null times come first."""
    linked = pairs.select(F.col("a").alias(key)).union(pairs.select(F.col("b").alias(key))).distinct()
    # Only linked clips are ranked, by ranges of the order.
    ranked = numbered(nodes.join(linked, key, "left_semi"), F.coalesce(order[0], F.lit("")), *map(F.col, order[1:]), name="n").select(key, F.col("n").cast("long").alias("n"))
    x, y = (ranked.select(F.col(key).alias(f"k{s}"), F.col("n").alias(f"n{s}")) for s in "ab")
    edges = pairs.join(x, F.col("a") == F.col("ka")).join(y, F.col("b") == F.col("kb")).select("na", "nb")
    found = components(edges, "na", "nb").join(ranked, F.col("node") == F.col("n"))
    lists = found.groupBy("root").agg(F.array_sort(F.collect_list(F.struct("n", F.col(key).alias("k")))).alias("m"))
    return lists.select("root", F.col("m")[0]["k"].alias("keep"), F.transform(F.slice("m", 2, F.size("m")), lambda s: s["k"]).alias("duplicates"))
