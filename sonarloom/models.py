"""Pluggable models as Arrow-batched functions: fetchers, voice activity, speech to text, embedding, fingerprints.

Only interfaces and deterministic stand-ins are shipped: no weights. A model is made once per worker by a factory; an error
becomes an ``error`` column, so that one bad clip doesn't fail a task."""

from __future__ import annotations

import os
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import Protocol

import numpy as np
import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonarloom.functions import text as T
from sonarloom.operators.transcript import rounded
from sonarloom.operators.voices import norm
from sonarloom.sources.files import decode_wav, encode_wav

RATE = 16000


class Fetcher(Protocol):
    def fetch(self, url: str) -> tuple[str, bytes]:
        """(content type, bytes); raises if it can't."""


class VadModel(Protocol):
    def spans(self, samples: np.ndarray, rate: int) -> list[list[float]]: ...


class Transcriber(Protocol):
    def transcribe(self, content: bytes, language: str | None, prompt: str) -> dict: ...


class Embedder(Protocol):
    def embed(self, pieces: list[np.ndarray]) -> np.ndarray: ...


class Fingerprinter(Protocol):
    def fingerprint(self, samples: np.ndarray, rate: int) -> np.ndarray: ...


class Separator(Protocol):
    def vocals(self, samples: np.ndarray, rate: int) -> np.ndarray:
        """The voices in the samples, of equal length."""


class BandSeparator:
    """Stand-in: the part of the spectrum in which speech lies."""

    def __init__(self, low: float = 100.0, high: float = 4000.0):
        self.low, self.high = low, high

    def vocals(self, samples: np.ndarray, rate: int = RATE) -> np.ndarray:
        spectrum, at = np.fft.rfft(samples), np.fft.rfftfreq(len(samples), 1 / rate)
        return np.fft.irfft(np.where((at >= self.low) & (at <= self.high), spectrum, 0), len(samples)).astype(np.float32)


class HttpFetcher:
    """Reads an address whole; the referer that a platform asks for goes by the host's end."""

    def __init__(self, referers: dict[str, str] | None = None, timeout: float = 120.0):
        self.referers, self.timeout = referers or {}, timeout

    def fetch(self, url: str) -> tuple[str, bytes]:
        request = urllib.request.Request(url, headers={"User-Agent": "sonarloom"})
        for host, referer in self.referers.items():
            if (request.host or "").split(":")[0].endswith(host):
                request.add_header("Referer", referer)
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return answer.headers.get_content_type(), answer.read()


class EnergyVad:
    """Stand-in: frames of 30 ms above a level; close spans join, short ones go, the rest is padded."""

    def __init__(self, level: float = 0.01, shortest: float = 0.25, gap: float = 0.3, pad: float = 0.2):
        self.level, self.shortest, self.gap, self.pad = level, shortest, gap, pad

    def spans(self, samples: np.ndarray, rate: int = RATE) -> list[list[float]]:
        step = int(0.03 * rate)
        frames = samples[: len(samples) // step * step].reshape(-1, step)
        loud = np.sqrt((frames.astype(float) ** 2).mean(1)) > self.level
        edges = np.flatnonzero(np.diff(np.concatenate([[0], loud.astype(int), [0]]))).reshape(-1, 2) * step / rate
        out: list[list[float]] = []
        for s, e in edges:
            if out and s - out[-1][1] < self.gap:
                out[-1][1] = e
            else:
                out.append([s, e])
        end = len(samples) / rate
        return [[max(0.0, s - self.pad), min(end, e + self.pad)] for s, e in out if e - s >= self.shortest]


class SpectrumEmbedder:
    """Stand-in: unit vector of mean log energies in bands of the spectrum."""

    def __init__(self, size: int = 64):
        self.size = size

    def embed(self, pieces: list[np.ndarray]) -> np.ndarray:
        out = []
        for p in pieces:
            power = np.abs(np.fft.rfft(p.astype(float), 2048 if len(p) < 2048 else None)) ** 2
            bands = np.array([np.log1p(b.sum()) for b in np.array_split(power, self.size)])
            bands = bands - bands.mean()
            out.append(bands / (np.linalg.norm(bands) or 1.0))
        return np.array(out, np.float32)


class SpectrumFingerprinter:
    """Stand-in: 32 bits per hop, each whether a band gained energy against the next one since the hop before."""

    def fingerprint(self, samples: np.ndarray, rate: int = RATE) -> np.ndarray:
        hop = int(4096 / 3 / 11025 * rate)
        n = max(0, (len(samples) - 2 * hop) // hop + 1)
        power = np.array([np.abs(np.fft.rfft(samples[k * hop : k * hop + 2 * hop] * np.hanning(2 * hop))) ** 2 for k in range(n)]).reshape(n, -1)
        if n < 2:
            return np.zeros(0, np.int64)
        bands = np.stack([b.sum(1) for b in np.array_split(power[:, 8:], 33, axis=1)], 1)
        slope = bands[:, :-1] - bands[:, 1:]
        bits = (slope[1:] > slope[:-1]).astype(np.int64)
        return (bits << np.arange(32)).sum(1)


class Replay:
    """Stand-in transcriber: gives stored results by the clip's bytes."""

    def __init__(self, results: dict[bytes, dict]):
        self.results = results

    def transcribe(self, content: bytes, language: str | None, prompt: str) -> dict:
        return self.results[content]


def apply(clips: DataFrame, make: Callable[[], object], call: Callable[[object, dict], dict], schema: str) -> DataFrame:
    """``call(model, row)`` for each row, in batches; keys of the result and ``error`` are added to the row's columns."""
    names = [x.strip().split()[0] for x in _split(schema)]
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in clips.schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            found = []
            for row in pdf.to_dict("records"):
                try:
                    found.append(call(model, row) | {"error": None})
                except Exception as e:
                    found.append({"error": str(e)[:300] or type(e).__name__})
            yield pdf.assign(**{n: [f.get(n) for f in found] for n in [*names, "error"]})

    return clips.drop("error").mapInPandas(run, f"{kinds}, {schema}, error string")


def _split(schema: str) -> list[str]:
    out, depth = [""], 0
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append("")
        else:
            out[-1] += c
    return out


def vad(clips: DataFrame, make: Callable[[], VadModel] = EnergyVad) -> DataFrame:
    """vad_spans, audio_seconds and vad_speech_seconds (of the spans' union, to 0.1 s) of WAV ``content``."""

    def call(model, row):
        x = decode_wav(row["content"])
        spans = model.spans(x, RATE)
        mask = np.zeros(len(x), bool)
        for s, e in spans:
            mask[int(s * RATE) : int(e * RATE)] = True
        return {"vad_spans": [[round(s, 2), round(e, 2)] for s, e in spans], "audio_seconds": round(len(x) / RATE, 1), "vad_speech_seconds": round(mask.sum() / RATE, 1), "status": "ok"}

    return apply(clips, make, call, "vad_spans array<array<double>>, audio_seconds double, vad_speech_seconds double, status string")


def fingerprints(clips: DataFrame, make: Callable[[], Fingerprinter] = SpectrumFingerprinter) -> DataFrame:
    return apply(clips, make, lambda m, r: {"fp": m.fingerprint(decode_wav(r["content"]), RATE).tolist()}, "fp array<bigint>")


def energy_share(part: np.ndarray, whole: np.ndarray) -> float:
    """Energy of a part against that of the whole."""
    return float((np.asarray(part, float) ** 2).sum() / max((np.asarray(whole, float) ** 2).sum(), 1e-9))


ALLOWED = ("video/", "application/octet-stream", "binary/")


def fetch(posts: DataFrame, chain: list[tuple[str, Callable[[], Fetcher], str]]) -> DataFrame:
    """Try each (method, factory, url column) in turn; status ok with the method, bytes and content, or failed with all errors."""

    def make():
        return [(m, f(), c) for m, f, c in chain]

    def call(models, row):
        errors = []
        for method, model, column in models:
            if not row.get(column):
                continue
            try:
                kind, data = model.fetch(row[column])
                if not kind.startswith(ALLOWED):
                    raise ValueError(f"content type {kind}")
                return {"status": "ok", "method": method, "bytes": len(data), "content": data}
            except Exception as e:
                errors.append(f"{method}: {e}")
        return {"status": "failed", "reason": " | ".join(errors) or "no media url"}

    return apply(posts, make, call, "status string, method string, bytes bigint, content binary, reason string")


SEGMENTS = "array<struct<start double, end double, text string, no_speech_prob double, compression_ratio double, avg_logprob double>>"


def transcribe(clips: DataFrame, make: Callable[[], Transcriber], prompt: str = "") -> DataFrame:
    """Transcripts of ``content`` with ``lang`` as a hint where it is a known one: segments as stored (without flags yet),
    transcript, transcript_lang, transcript_duration, transcript_prompt, process_seconds, and ``error`` of clips that failed. What a
    model returns: text, language, duration and segments."""

    def call(model, row):
        began = time.monotonic()
        found = model.transcribe(row["content"], row["hint"], prompt)
        return {
            "segments": [{k: s.get(k) for k in ("start", "end", "text", "no_speech_prob", "compression_ratio", "avg_logprob")} for s in found.get("segments") or []],
            "transcript": found.get("text"), "transcript_lang": found.get("language"), "transcript_duration": found.get("duration"), "process_seconds": round(time.monotonic() - began, 1),
        }

    out = apply(clips.withColumn("hint", T.language_hint("lang")), make, call, f"segments {SEGMENTS}, transcript string, transcript_lang string, transcript_duration double, process_seconds double")
    flagged = F.transform(rounded(F.col("segments")), lambda s: s.withField("hallucination", F.lit(None).cast("string")))
    fresh = {"segments": flagged, "transcript": F.btrim("transcript"), "transcript_duration": F.round("transcript_duration", 1), "transcript_prompt": F.lit(prompt), "transcript_raw": F.lit(None).cast("string"), "transcript_status": F.lit(None).cast("string")}
    return out.withColumns(fresh).drop("hint")


def embed(clips: DataFrame, make: Callable[[], Embedder] = SpectrumEmbedder, key: str = "_id", most: int = 64) -> DataFrame:
    """key, seg, win and unit ``embedding`` of each window of clips (key, content, windows: array of seg, win, start, end). A
    clip's bytes are decoded once; the model gets up to ``most`` windows of equal length at a time, so none is padded."""
    kind = clips.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make()
        for pdf in batches:
            for name, content, found in zip(pdf[key], pdf["content"], pdf["windows"]):
                x = decode_wav(content)
                cut = sorted(((x[int(w["start"] * RATE) : int(w["end"] * RATE)], w["seg"], w["win"]) for w in found), key=lambda c: (len(c[0]), c[2]))
                for _, same in groupby(cut, key=lambda c: len(c[0])):
                    some = list(same)
                    for k in range(0, len(some), most):
                        part = some[k : k + most]
                        yield pd.DataFrame({key: name, "seg": [p[1] for p in part], "win": [p[2] for p in part], "embedding": [e.tolist() for e in np.asarray(model.embed([p[0] for p in part]), float)]})

    rows = clips.where("size(windows) > 0").select(key, "content", "windows").mapInPandas(run, f"`{key}` {kind}, seg int, win int, embedding array<double>")
    size = norm(F.col("embedding"))
    return rows.withColumn("embedding", F.when(size > 0, F.transform("embedding", lambda v: v / size)).otherwise(F.col("embedding")))


def separated(clips: DataFrame, make: Callable[[], Separator] = BandSeparator) -> DataFrame:
    """``vocals`` (WAV bytes) of each clip and their share of its energy."""

    def call(model, row):
        x = decode_wav(row["content"])
        voice = model.vocals(x, RATE)
        return {"vocals": encode_wav(voice, RATE), "vocals_energy_share": round(energy_share(voice, x), 3)}

    return apply(clips, make, call, "vocals binary, vocals_energy_share double")


def muted(clips: DataFrame, content: str = "content", spans: str = "vad_spans") -> DataFrame:
    """``masked``: the clip's WAV bytes with silence outside its spans of speech; length and times stay."""

    def call(_, row):
        x = decode_wav(row[content])
        keep = np.zeros(len(x), bool)
        for s, e in row[spans]:
            keep[int(s * RATE) : int(e * RATE)] = True
        return {"masked": encode_wav(np.where(keep, x, 0), RATE)}

    return apply(clips, lambda: None, call, "masked binary")


def saved(fetched: DataFrame, folder: str, stem: str = "stem", suffix: str = ".mp4") -> DataFrame:
    """Write the ``content`` of rows with status ok below a shared folder; ``file`` in its place. Each file is written under a
    temporary name of its own (``.part``) and then renamed, so a reader never meets half a file and a task that runs
    again writes the same one."""

    def call(store, row):
        if row["content"] is None:
            return {"file": None}
        disk, top = store
        path = f"{top}/{row[stem]}{suffix}"
        part = f"{path}.{uuid.uuid4().hex}.part"
        disk.create_dir(os.path.dirname(path), recursive=True)
        with disk.open_output_stream(part) as f:
            f.write(row["content"])
        disk.move(part, path)
        return {"file": path}

    return apply(fetched, lambda: fs.FileSystem.from_uri(folder), call, "file string").drop("content")
