"""Schemas of the records of a media batch. Every field but ``_id`` may be null; an absent key is null."""

from __future__ import annotations

from pyspark.sql.types import StructType

SEGMENT = "start double, end double, text string, no_speech_prob double, compression_ratio double, avg_logprob double, hallucination string"
VOICE = "voice int, windows int, sim double, label string, seconds double"
VOICE_SEGMENT = "start double, end double, text string, sim double, voice int, label string, match_voice int, match_sim double"
_BASE = "_id string, _index string, platform string, link string, created_at string, lang string, content string"

POSTS = f"{_BASE}, id string, media_type string, media_url array<string>"
MANIFEST = f"{_BASE}, status string, method string, file string, bytes bigint, seconds double, error string"
VAD = "_id string, source_file string, status string, vad_seconds double, audio_seconds double, vad_speech_seconds double, vad_spans array<array<double>>"
PREP = f"{VAD}, demucs_seconds double, vocals_energy_share double"
TRANSCRIPTS = (
    f"{_BASE}, transcript_status string, transcript string, transcript_raw string, transcript_lang string, transcript_duration double, "
    "transcript_prompt string, transcript_model string, process_seconds double, error string, vad_speech_seconds double, vad_gate boolean, "
    f"prompt_fallback boolean, segments array<struct<{SEGMENT}>>"
)
SPEAKERS = (
    "_id string, speaker string, model string, threshold double, verdict string, target_seconds double, speech_seconds double, target_share double, "
    f"max_sim double, n_voices int, voices array<struct<{VOICE}>>, segments array<struct<{VOICE_SEGMENT}>>"
)
VOICEPRINT = (
    "name string, model string, vec array<float>, source string, audio_seconds double, windows_total int, windows_used int, cluster_thr double, "
    "member_sim_min double, member_sim_median double, outlier_windows array<array<double>>, segments array<struct<start double, end double, sim double, text string>>"
)
FINGERPRINTS = "_id string, fp array<bigint>"


def of(text: str) -> StructType:
    return StructType.fromDDL(text)
