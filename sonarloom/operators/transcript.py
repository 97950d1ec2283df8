"""Hallucinated segments, transcript cleaning, status, and the order in which a clip gets its status.

Everything is a column expression over ``segments`` (array of structs) or over one segment; nothing shuffles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonarloom.functions import text as T

# Phrases that speech models write over music or silence, the pattern of subtitle-style speaker
# labels, reasons and statuses.
STOCK_PHRASES = ["terima kasih", "terima kasih telah menonton", "sampai jumpa", "thank you", "thanks for watching", "you"]
SPEAKER_LABEL = r"^(pembicara|speaker) \p{Nd}+$"
EMPTY, OUTSIDE, STOCK, REPEATED, PROMPT_COPY = "kosong", "di_luar_audio", "frasa_umum", "berulang", "salinan_prompt"
LEAKS = [REPEATED, PROMPT_COPY]
DONE, SUSPECT, NO_SPEECH, NO_AUDIO, FAILED = "done", "suspect_hallucination", "no_speech", "no_audio", "failed"
STATUSES = [DONE, SUSPECT, NO_SPEECH, NO_AUDIO, FAILED]

NO_SPEECH_PROB, GATE_SECONDS = 0.6, 1.0
REPEAT_WORDS, REPEAT_SHARE, COPY_WORDS, COPY_SHARE = 8, 0.4, 5, 0.8


def reason(text: Column, start: Column, duration: Column, prompt_words: Column | list[str]) -> Column:
    """Why a segment looks made up: the first of the reasons that holds, else null. Words are taken once: a struct of
    them is the one element that the cascade is transformed over."""
    prompt = prompt_words if isinstance(prompt_words, Column) else F.array(*[F.lit(p) for p in prompt_words]).cast("array<string>")

    def cascade_(x: Column) -> Column:
        w, n = x["w"], F.size(x["w"])
        copied = F.size(F.filter(w, lambda y: F.array_contains(prompt, y)))
        return (
            F.when(n == 0, EMPTY)
            .when((F.coalesce(duration, F.lit(0.0)) != 0) & (start >= duration), OUTSIDE)
            .when(x["bare"].isin(STOCK_PHRASES) | x["bare"].rlike(SPEAKER_LABEL), STOCK)
            .when((n >= REPEAT_WORDS) & (F.size(F.array_distinct(w)) / n < REPEAT_SHARE), REPEATED)
            .when((n >= COPY_WORDS) & (copied / n >= COPY_SHARE), PROMPT_COPY)
        )

    return F.transform(F.array(F.struct(T.words(text).alias("w"), T.bare(text).alias("bare"))), cascade_)[0]


def voiced(segment: Column) -> Column:
    return F.coalesce(segment["no_speech_prob"], F.lit(0.0)) < NO_SPEECH_PROB


def status(transcript: Column, segments: Column) -> Column:
    """done: text, and a voiced segment without a flag; suspect: a voiced one flagged for more than being empty."""
    has_text = F.btrim(F.coalesce(transcript, F.lit("")), F.lit(" \t\n\r\x0b\x0c")) != ""
    clean = F.exists(segments, lambda s: voiced(s) & s["hallucination"].isNull())
    made_up = F.exists(segments, lambda s: voiced(s) & s["hallucination"].isNotNull() & (s["hallucination"] != EMPTY))
    return F.when(has_text & clean, DONE).when(made_up, SUSPECT).otherwise(NO_SPEECH)


def kept_text(segments: Column) -> Column:
    return F.btrim(F.array_join(F.transform(F.filter(segments, lambda s: s["hallucination"].isNull()), lambda s: s["text"]), " "))


def rounded(segments: Column) -> Column:
    """Segments as stored: times to 0.1, probabilities and ratios to 0.01, texts stripped, missing numbers 0."""
    at = lambda s, n, d: F.round(F.coalesce(s[n], F.lit(0.0)), d).alias(n)
    return F.transform(
        segments,
        lambda s: F.struct(
            F.round(s["start"], 1).alias("start"), F.round(s["end"], 1).alias("end"), F.btrim(s["text"]).alias("text"),
            at(s, "no_speech_prob", 2), at(s, "compression_ratio", 2), at(s, "avg_logprob", 2),
        ),
    )


def reclassify(records: DataFrame, prompt_words: list[str]) -> DataFrame:
    """Flags, transcript and status again from the stored segments; rows without segments stay as they are.
    The unfiltered transcript is kept once. Applying it twice changes nothing."""
    flagged = F.transform("segments", lambda s: s.withField("hallucination", reason(s["text"], s["start"], F.col("transcript_duration"), prompt_words)))
    has = F.col("segments").isNotNull()
    out = records.withColumn("transcript_raw", F.when(has, F.coalesce("transcript_raw", "transcript", F.lit(""))).otherwise(F.col("transcript_raw")))
    out = out.withColumn("segments", flagged)
    out = out.withColumn("transcript", F.when(has, kept_text(F.col("segments"))).otherwise(F.col("transcript")))
    return out.withColumn("transcript_status", F.when(has, status(F.col("transcript"), F.col("segments"))).otherwise(F.col("transcript_status")))


def prompt_leaked(prompt: Column, segments: Column) -> Column:
    return (F.coalesce(prompt, F.lit("")) != "") & F.coalesce(F.exists(segments, lambda s: s["hallucination"].isin(LEAKS)), F.lit(False))


def has_audio_track(content: Column) -> Column:
    """Whether media bytes declare a sound track."""
    return F.decode(content, "ISO-8859-1").rlike("(?s)hdlr.{8}soun")


def gated(vad_status: Column, speech_seconds: Column, gate: float = GATE_SECONDS) -> Column:
    """Too little speech to be transcribed; clips without a measurement pass."""
    return F.coalesce((vad_status == "ok") & (speech_seconds < gate), F.lit(False))


def cascade(clips: DataFrame, transcribe: Callable[[DataFrame, str], DataFrame], prompt: str, prompt_words: list[str]) -> DataFrame:
    """Clips (``has_audio``, ``vad_status``, ``vad_speech_seconds``) to records with a status.

    Clips without sound and gated ones never reach ``transcribe``, for which a filter is needed: Spark would run a
    Python function in a CASE branch on all rows. Results in which the prompt leaked are made again without it."""
    silent = clips.where("not has_audio").withColumn("transcript_status", F.lit(NO_AUDIO))
    stop = gated(F.col("vad_status"), F.col("vad_speech_seconds"))
    quiet = clips.where(F.col("has_audio") & stop).withColumns({"transcript_status": F.lit(NO_SPEECH), "vad_gate": F.lit(True)})
    first = reclassify(transcribe(clips.where(F.col("has_audio") & ~stop), prompt), prompt_words)
    leaked = prompt_leaked(F.col("transcript_prompt"), F.col("segments"))
    failed = F.col("error").isNotNull()
    again = reclassify(transcribe(first.where(leaked & ~failed).select(*clips.columns), ""), prompt_words).withColumn("prompt_fallback", F.lit(True))
    spoken = first.where(~leaked | failed).unionByName(again, allowMissingColumns=True)
    spoken = spoken.withColumn("transcript_status", F.when(F.col("error").isNotNull(), FAILED).otherwise(F.col("transcript_status")))
    return spoken.withColumn("error", T.prefix("error", 300)).unionByName(quiet, allowMissingColumns=True).unionByName(silent, allowMissingColumns=True)


def audit(segments: DataFrame, prompt_words: list[str], key: str = "id") -> DataFrame:
    """Unflagged segments that three further rules find: ``past_end`` (over 1 s past the audio), ``run`` (equal texts three
    or more in a row), ``prompt_only`` (one to four words, all of the prompt). Rows: key, seg, text, end, duration."""
    from pyspark.sql import Window

    by = Window.partitionBy(key).orderBy("seg")
    run = F.sum(F.when(F.lag("text").over(by).eqNullSafe(F.col("text")), 0).otherwise(1)).over(by)
    w = T.words("text")
    only = (F.size(w).between(1, 4)) & F.forall(w, lambda x: x.isin(prompt_words))
    out = segments.withColumn("run", run).withColumn("run_length", F.count("*").over(Window.partitionBy(key, "run")))
    return out.select(key, "seg", (F.col("end") > F.col("duration") + 1).alias("past_end"), (F.col("run_length") >= 3).alias("repeated"), only.alias("prompt_only"))
