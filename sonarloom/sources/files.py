"""Files of a batch: JSON lines with their order, JSON maps, media bytes, optional sidecars, WAV decoding."""

from __future__ import annotations

import io
import struct
import wave

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from sonarloom.functions import text as T


def json_lines(spark: SparkSession, path: str, schema: str, ordered: bool = True) -> DataFrame:
    """Records of a JSON-lines path; blank lines are skipped, lines part at newlines only. With ``ordered``, ``line_no``
    grows along each file (and along the files in the order Spark lists them), without a sort or a gathering."""
    lines = spark.read.option("lineSep", "\n").text(path)
    if ordered:
        lines = lines.withColumn("line_no", F.monotonically_increasing_id())
    rows = lines.where(F.btrim("value", F.lit(" \t\r")) != "").withColumn("r", F.from_json("value", schema))
    return rows.select("r.*", *(["line_no"] if ordered else []))


def json_map(spark: SparkSession, path: str) -> DataFrame:
    """_id and text of a file that is one JSON object of texts."""
    one = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,string>").alias("m"))
    return one.select(F.explode("m").alias("_id", "text"))


def sidecar(spark: SparkSession, path: str, schema: str, reader=json_lines) -> DataFrame:
    """The file's rows, or none if it isn't there."""
    try:
        return reader(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{schema}, line_no bigint")


def media(spark: SparkSession, path: str, content: bool = True) -> DataFrame:
    """path, stem, bytes and (if asked for) content of media files; half-written ones (``.part``) are left out. Without
    content it is a listing, so that bytes are read last and never shuffled."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(~F.col("path").endswith(".part"))
    return rows.select("path", T.file_stem("path").alias("stem"), F.col("length").alias("bytes"), *(["content"] if content else []))


def existing(posts: DataFrame, listing: DataFrame) -> DataFrame:
    """Posts whose media file is there already: status ``exists`` with file and bytes."""
    rows = posts.withColumn("stem", T.media_stem("platform", "_id")).join(listing.select("stem", F.col("path").alias("file"), "bytes"), "stem")
    return rows.withColumn("status", F.lit("exists")).drop("stem")


def decode_wav(data: bytes) -> np.ndarray:
    """Mono samples in -1..1 of PCM16 WAV bytes; channels are averaged."""
    with wave.open(io.BytesIO(data)) as w:
        x = np.frombuffer(w.readframes(w.getnframes()), "<i2").astype(np.float32) / 32768
        return x.reshape(-1, w.getnchannels()).mean(1)


def encode_wav(samples, rate: int = 16000) -> bytes:
    """PCM16 mono WAV bytes; samples are clipped to -1..1. The header is the RIFF one with a format and a data chunk."""
    level = np.nan_to_num(np.asarray(samples, np.float64)).clip(-1.0, 1.0)
    data = np.trunc(level * 32767).astype("<i2").tobytes()
    form = struct.pack("<4sIHHIIHH", b"fmt ", 16, 1, 1, rate, 2 * rate, 2, 16)
    return b"RIFF" + struct.pack("<I", 4 + len(form) + 8 + len(data)) + b"WAVE" + form + struct.pack("<4sI", b"data", len(data)) + data


@F.pandas_udf(ArrayType(FloatType()))
def wav_samples(content: pd.Series) -> pd.Series:
    return content.map(lambda b: None if b is None else decode_wav(b))
