"""Further queries over the driver's tables: whole paths (scoring, cascade, report, summary), files and streams.

Registered with those of ``catalog``; the tables stand in for a media batch in the same way."""

from __future__ import annotations

from pyspark.sql import functions as F

from sonarloom import workspace
from sonarloom.functions import text as T
from sonarloom.operators import audio_dedup, latest, report, transcript, turns, voices, windows
from sonarloom.plans import catalog as c
from sonarloom.plans.catalog import SQL_CLIPS, SQL_FP, SQL_REPORT, SQL_SEGMENTS, _t, query
from sonarloom.sinks import files as sinks
from sonarloom.sources import files, search
from sonarloom.streaming import incremental

#: Times of lines, beside the flags of SQL_SEGMENTS.
SQL_TIMES = """raw_lines AS (SELECT doc_id, unnest(range(len(l)))::INT AS seg, unnest(l) AS raw FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
times AS (SELECT doc_id, seg, (end_ms - length(trim(raw)) * 60) / 1000.0::DOUBLE AS start_s, end_ms / 1000.0::DOUBLE AS end_s
          FROM (SELECT *, sum(length(raw) * 60) OVER (PARTITION BY doc_id ORDER BY seg) AS end_ms FROM raw_lines))"""

# --- segments and statuses -------------------------------------------------------------------------------------------


@query(f"""WITH {SQL_SEGMENTS}, {SQL_TIMES} SELECT doc_id, seg, round(least(end_s, doc_id % 40 + 5.0::DOUBLE), 2) AS clip_end FROM flagged JOIN times USING (doc_id, seg)
WHERE no_speech_prob < 0.6 AND reason IS NULL AND least(end_s, doc_id % 40 + 5.0::DOUBLE) - start_s >= 1.0
AND trim(lower(text), ' .!?') NOT IN ('terima kasih', 'terima kasih telah menonton', 'sampai jumpa', 'thank you', 'thanks for watching', 'you')""")
def window_skips(spark, sf_dir):
    rows = c.flagged_segments(spark, sf_dir).withColumnRenamed("reason", "hallucination").withColumn("audio_seconds", F.col("doc_id") % 40 + F.lit(5.0))
    return windows.speech_segments(rows).select("doc_id", "seg", F.round("clip_end", 2).alias("clip_end"))


@query(f"""WITH {SQL_SEGMENTS}, {SQL_TIMES} SELECT doc_id, seg, CASE WHEN n = 0 THEN 'kosong' WHEN doc_id % 15 <> 0 AND start_s >= doc_id % 15 THEN 'di_luar_audio' ELSE reason END AS reason FROM flagged JOIN times USING (doc_id, seg)""")
def outside_audio_flags(spark, sf_dir):
    rows = c.segments(spark, sf_dir)
    return rows.select("doc_id", "seg", transcript.reason(F.col("text"), F.col("start"), (F.col("doc_id") % 15).cast("double"), c.prompt_words(spark, sf_dir)).alias("reason"))


@query(f"""WITH {SQL_SEGMENTS}, {SQL_TIMES} SELECT doc_id, seg, round(start_s, 1) AS start, round(end_s, 1) AS "end", round(no_speech_prob, 2) AS no_speech_prob,
CASE WHEN seg % 2 = 0 THEN 0.0 ELSE round((doc_id % 97) / 31.0::DOUBLE, 2) END AS compression_ratio, round(-(seg % 100 + 2) / 300.0::DOUBLE, 2) AS avg_logprob FROM segs JOIN times USING (doc_id, seg)""")
def stored_segments(spark, sf_dir):
    rows = c.segments(spark, sf_dir).withColumn("compression_ratio", F.when(F.col("seg") % 2 != 0, (F.col("doc_id") % 97) / 31.0)).withColumn("avg_logprob", -(F.col("seg") % 100 + 2) / 300.0)
    one = F.struct("start", "end", "text", "no_speech_prob", "compression_ratio", "avg_logprob")
    s = transcript.rounded(F.array(one))[0]
    return rows.select("doc_id", "seg", *[s[n].alias(n) for n in ("start", "end", "no_speech_prob", "compression_ratio", "avg_logprob")])


def stored(spark, sf_dir):
    """Transcript records before they are judged, with segments as arrays."""
    s = c.segments(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seg", "start", "end", "text", "no_speech_prob"))).alias("s"))
    null = F.lit(None).cast("string")
    shape = lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["text"].alias("text"), x["no_speech_prob"].alias("no_speech_prob"), null.alias("hallucination"))
    return s.select("doc_id", F.transform("s", shape).alias("segments"), null.alias("transcript"), null.alias("transcript_raw"), F.lit(None).cast("double").alias("transcript_duration"))


@query(f"WITH {SQL_SEGMENTS} SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'no_audio' ELSE status END AS status, CASE WHEN doc_id % 10 <> 0 THEN transcript END AS transcript FROM statused")
def reclassified_shapes(spark, sf_dir):
    """Records without segments stay as they are."""
    rows = stored(spark, sf_dir).withColumn("segments", F.when(F.col("doc_id") % 10 != 0, F.col("segments"))).withColumn("transcript_status", F.when(F.col("doc_id") % 10 == 0, "no_audio"))
    again = transcript.reclassify(transcript.reclassify(rows, words := c.prompt_words(spark, sf_dir)), words)
    return again.select("doc_id", F.col("transcript_status").alias("status"), "transcript")


@query(f"""WITH {SQL_SEGMENTS}, leak AS (SELECT doc_id, doc_id % 3 = 0 OR coalesce(bool_or(reason IN ('berulang', 'salinan_prompt')), false) AS leaked FROM flagged GROUP BY doc_id),
g AS (SELECT d.doc_id, s.status, k.leaked, d.doc_id % 13 = 0 AS silent, coalesce(l.quality = 1 AND round((d.doc_id % 30) / 10.0::DOUBLE, 1) < 1.0, false) AS gated, d.doc_id % 17 = 0 AS broken
      FROM documents d JOIN statused s USING (doc_id) JOIN leak k USING (doc_id) LEFT JOIN labels l USING (doc_id))
SELECT doc_id, CASE WHEN silent THEN 'no_audio' WHEN gated THEN 'no_speech' WHEN broken THEN 'failed' ELSE status END AS status, NOT silent AND gated AS vad_gate,
NOT silent AND NOT gated AND NOT broken AND leaked AS prompt_fallback, CASE WHEN NOT silent AND NOT gated AND broken THEN 300 END AS error_length FROM g""")
def status_cascade(spark, sf_dir):
    """All ways a clip gets its status: no sound, gated, transcribed, made again without the prompt, failed."""
    vad = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("v"), F.when(F.col("quality") == 1, "ok").otherwise("no_audio").alias("vad_status"))
    clips = _t(spark, sf_dir, "documents").join(vad, F.col("doc_id") == F.col("v"), "left")
    clips = clips.select("doc_id", (F.col("doc_id") % 13 != 0).alias("has_audio"), "vad_status", F.round((F.col("doc_id") % 30) / 10.0, 1).alias("vad_speech_seconds"))
    words, records = c.prompt_words(spark, sf_dir), stored(spark, sf_dir)
    copied = records.schema["segments"].dataType.elementType.simpleString()
    echo = F.array(F.struct(F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), F.lit(" ".join(words[:8])).alias("text"), F.lit(0.9).alias("no_speech_prob"), F.lit(None).cast("string").alias("hallucination")).cast(copied))

    def transcribe(some, prompt):
        out = some.join(records, "doc_id").withColumn("transcript_prompt", F.lit(prompt)).withColumn("transcript_status", F.lit(None).cast("string"))
        if prompt:
            out = out.withColumn("segments", F.when(F.col("doc_id") % 3 == 0, F.concat("segments", echo)).otherwise(F.col("segments")))
        return out.withColumn("error", F.when(F.col("doc_id") % 17 == 0, F.repeat(F.lit("x"), 400)))

    done = transcript.cascade(clips, transcribe, "prompt", words)
    return done.select("doc_id", F.col("transcript_status").alias("status"), F.coalesce("vad_gate", F.lit(False)).alias("vad_gate"), F.coalesce("prompt_fallback", F.lit(False)).alias("prompt_fallback"), F.length("error").alias("error_length"))


@query(f"WITH {SQL_SEGMENTS}, {SQL_TIMES} SELECT doc_id, seg, end_s > doc_id % 30 + 1 AS past_end FROM segs JOIN times USING (doc_id, seg)")
def leak_audit_past_end(spark, sf_dir):
    rows = c.segments(spark, sf_dir).withColumn("duration", (F.col("doc_id") % 30).cast("double"))
    return transcript.audit(rows, c.prompt_words(spark, sf_dir), "doc_id").select("doc_id", "seg", "past_end")


@query(f"WITH {SQL_SEGMENTS} SELECT doc_id FROM statused WHERE status IN ('done', 'suspect_hallucination')")
def scoring_input(spark, sf_dir):
    return voices.to_score(c.records(spark, sf_dir), ("done", "suspect_hallucination")).select("doc_id")


# --- voices ----------------------------------------------------------------------------------------------------------

_VOICE = "((length(coalesce(text, '')) // 40) % 3)::INT"


@query(f"""WITH {SQL_CLIPS} SELECT conv_id, turn::INT AS seg, CASE WHEN turn % 5 = 4 THEN NULL WHEN turn % 2 = 0 THEN {_VOICE} + 10 ELSE {_VOICE} END AS voice,
CASE WHEN turn % 5 <> 4 AND turn % 3 = 0 THEN 1 END AS match_voice FROM clips WHERE length(coalesce(text, '')) > 0""")
def attributed_segments(spark, sf_dir):
    """Every second segment has two speaker segments, of which the last counts; every fifth has none."""
    rows = c.voiced_clips(spark, sf_dir).where("text <> ''").select("conv_id", "seg", (F.col("start_ms") / 1000.0).alias("start"), (F.col("end_ms") / 1000.0).alias("end"), "text", "voice")
    own = rows.where("seg % 5 <> 4").withColumn("match_voice", F.when(F.col("seg") % 3 == 0, 1)).withColumn("pos", F.col("seg"))
    later = own.where("seg % 2 = 0").withColumn("voice", F.col("voice") + 10).withColumn("pos", F.col("seg") + 100_000)
    return turns.attribute(rows.select("conv_id", "seg", "start", "end", "text"), own.unionByName(later), "conv_id").select("conv_id", "seg", "voice", "match_voice")


@query(f"""WITH {SQL_CLIPS}, v AS (SELECT *, start_ms // 1000 AS start, {_VOICE} AS own, CASE WHEN turn % 4 = 3 THEN 1 END AS match_voice FROM clips),
s AS (SELECT conv_id, own AS voice, sum(end_ms - start_ms) / 1000.0::DOUBLE AS seconds FROM v GROUP BY 1, 2),
n1 AS (SELECT v.*, coalesce(a.seconds >= 20, false) AS own_main, b.seconds AS other_seconds FROM v LEFT JOIN s a ON a.conv_id = v.conv_id AND a.voice = v.own LEFT JOIN s b ON b.conv_id = v.conv_id AND b.voice = v.match_voice),
n2 AS (SELECT *, NOT own_main AND match_voice IS NOT NULL AS matched FROM n1),
n3 AS (SELECT *, CASE WHEN matched THEN match_voice ELSE own END AS voice, CASE WHEN matched THEN coalesce(other_seconds >= 20, false) ELSE own_main END AS main, CASE WHEN matched THEN other_seconds IS NOT NULL AND match_voice = 1 ELSE own = 1 END AS target FROM n2),
n4 AS (SELECT *, CASE WHEN main THEN min(CASE WHEN main THEN turn END) OVER (PARTITION BY conv_id, voice) END AS first FROM n3),
n5 AS (SELECT *, dense_rank() OVER (PARTITION BY conv_id ORDER BY first NULLS LAST) AS number FROM n4),
n6 AS (SELECT *, CASE WHEN main THEN 'Pembicara ' || number || CASE WHEN matched THEN '*' ELSE '' END ELSE 'Pembicara ?' END || CASE WHEN target THEN ' (mirip target)' ELSE '' END AS name FROM n5),
g AS (SELECT *, CASE WHEN lag(name) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM name THEN 0 ELSE 1 END AS new FROM n6),
i AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS t FROM g),
l AS (SELECT conv_id, t, '[' || min(start) // 60 || ':' || lpad((min(start) % 60)::VARCHAR, 2, '0') || '] ' || any_value(name) || ': ' || string_agg(coalesce(text, ''), ' ' ORDER BY turn) AS line FROM i GROUP BY conv_id, t)
SELECT conv_id, string_agg(line, chr(10) ORDER BY t) AS turns FROM l GROUP BY conv_id""")
def matched_turn_texts(spark, sf_dir):
    """Turns in which short voices were matched to main ones, as one text a clip."""
    return turns.as_text(_matched_turns(spark, sf_dir), "conv_id")


def _matched_turns(spark, sf_dir):
    v = c.voiced_clips(spark, sf_dir)
    seconds = v.groupBy("conv_id", "voice").agg((F.sum(F.col("end_ms") - F.col("start_ms")) / 1000.0).alias("seconds")).withColumn("label", F.when(F.col("voice") == 1, "target").otherwise("lain"))
    return turns.turns(v.withColumn("match_voice", F.when(F.col("seg") % 4 == 3, 1)), seconds, "conv_id", main_seconds=20.0)


def one_hot(voice):
    return F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.when(k == voice, 1.0).otherwise(0.0))


def scored(spark, sf_dir, every: bool = True):
    """Clips scored from windows whose embeddings are told apart by voice; without ``every``, a fourth of segments is left out."""
    rows = c.voiced_clips(spark, sf_dir).select("conv_id", "seg", (F.col("start_ms") / 1000.0).alias("start"), (F.col("end_ms") / 1000.0).alias("end"), "start_ms", "end_ms", "text", F.col("voice").alias("real"))
    rows = rows if every else rows.where("seg % 4 <> 3")
    cut = windows.sliding(rows.where("end_ms - start_ms >= 1000"), 3000, 1500, "start_ms", "end_ms")
    embedded = cut.select("conv_id", "seg", (F.col("seg") * 1000 + F.col("k")).alias("win"), one_hot(F.col("real")).alias("embedding"))
    return voices.score_clips(rows.select("conv_id", "seg", "start", "end", "text"), embedded, [0.0, 1.0, 0.0], "conv_id")


SQL_SCORED = f"""{SQL_CLIPS}, sw AS (SELECT *, {_VOICE} AS own, greatest(ceil((end_ms - start_ms - 3000) / 1500.0::DOUBLE), 0)::INT + 1 AS wins FROM clips WHERE end_ms - start_ms >= 1000 {{only}}),
sv AS (SELECT conv_id, own, sum(wins) AS wins, min(turn) AS first, round(sum(end_ms - start_ms) / 1000.0::DOUBLE, 1) AS seconds FROM sw GROUP BY 1, 2),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY wins DESC, first) - 1)::INT AS voice FROM sv)"""


@query(f"""WITH {SQL_SCORED.format(only="")}, a AS (SELECT conv_id, coalesce(round(sum(end_ms - start_ms) FILTER (WHERE own = 1) / 1000.0::DOUBLE, 1), 0) AS t, round(sum(end_ms - start_ms) / 1000.0::DOUBLE, 1) AS s FROM sw GROUP BY 1),
b AS (SELECT conv_id, max(CASE WHEN own = 1 THEN 1.0 ELSE 0.0 END) AS m, count(*) FILTER (WHERE seconds >= 3.0) AS n FROM ranked GROUP BY 1)
SELECT DISTINCT clips.conv_id, coalesce(t, 0)::DOUBLE AS target_seconds, coalesce(s, 0)::DOUBLE AS speech_seconds, round(t / s, 3)::DOUBLE AS target_share, CASE WHEN s IS NULL THEN 'tanpa_ucapan' WHEN t >= 3 THEN 'ya' ELSE 'tidak' END AS verdict,
m::DOUBLE AS max_sim, n::INT AS n_voices FROM clips LEFT JOIN a USING (conv_id) LEFT JOIN b USING (conv_id)""")
def scored_clips(spark, sf_dir):
    return scored(spark, sf_dir)[0].select("conv_id", "target_seconds", "speech_seconds", "target_share", "verdict", "max_sim", "n_voices")


@query(f"""WITH {SQL_SCORED.format(only="")} SELECT conv_id, voice, wins::BIGINT AS windows, CASE WHEN own = 1 THEN 1.0 ELSE 0.0 END::DOUBLE AS sim, CASE WHEN own = 1 THEN 'target' ELSE 'lain' END AS label, seconds::DOUBLE AS seconds FROM ranked""")
def scored_voices(spark, sf_dir):
    return scored(spark, sf_dir)[1].select("conv_id", F.col("voice").cast("int").alias("voice"), "windows", "sim", "label", "seconds")


@query(f"""WITH {SQL_SCORED.format(only="AND turn % 4 <> 3")}, mine AS (SELECT sw.conv_id, turn, voice, CASE WHEN sw.own = 1 THEN 'target' ELSE 'lain' END AS label, CASE WHEN sw.own = 1 THEN 1.0 ELSE 0.0 END AS sim FROM sw JOIN ranked r ON r.conv_id = sw.conv_id AND r.own = sw.own),
pieces AS (SELECT c.conv_id, c.turn, r.voice AS match_voice FROM (SELECT *, {_VOICE} AS own FROM clips WHERE turn % 4 = 3) c JOIN ranked r ON r.conv_id = c.conv_id AND r.own = c.own AND r.seconds >= 3.0)
SELECT conv_id, turn::INT AS seg, voice, label, sim::DOUBLE AS sim, NULL::INT AS match_voice, NULL::DOUBLE AS match_sim FROM mine UNION ALL SELECT conv_id, turn::INT, NULL, NULL, NULL, match_voice, 1.0::DOUBLE FROM pieces""")
def scored_segments(spark, sf_dir):
    """Segments with their voice, and short pieces matched to main voices."""
    _, found, spoken = scored(spark, sf_dir, every=False)
    pieces = c.voiced_clips(spark, sf_dir).where("seg % 4 = 3").select("conv_id", "seg", (F.col("start_ms") / 1000.0).alias("start"), (F.col("end_ms") / 1000.0).alias("end"), "text", one_hot(F.col("voice")).alias("embedding"))
    matches = voices.match_short(pieces, found.where(F.col("seconds") >= voices.MAIN_SECONDS), "conv_id", "seg")
    both = voices.with_matches(spoken, pieces.drop("embedding"), matches, "conv_id")
    return both.select("conv_id", "seg", F.col("voice").cast("int").alias("voice"), "label", "sim", "match_voice", "match_sim")


@query(c.SQL["window_ref_similarity"])
def voiceprint_similarity(spark, sf_dir):
    """Against a voiceprint that is written as a table and read by name and model."""
    e = _t(spark, sf_dir, "embeddings")
    ids = e.agg(F.min("vec_id").alias("least"))
    table = e.join(F.broadcast(ids), F.col("vec_id") == F.col("least")).select(F.lit("target").alias("name"), F.lit("stand-in").alias("model"), F.col("embedding").alias("vec"))
    found = voices.voiceprint(workspace.materialize(table, "voiceprints"), "target", "stand-in")
    return voices.against(e, found).select("vec_id", F.round("sim", 4).alias("sim"))


@query()
def enrolled_voiceprints(spark, sf_dir):
    """A voiceprint per label, with the windows that don't belong to it."""
    rows = voices.voiceprints(_t(spark, sf_dir, "embeddings"), "label", "vec_id", threshold=0.3)
    return rows.select("name", "model", "windows_total", "windows_used", "member_sim_min", "member_sim_median", F.transform("outlier_windows", lambda s: s["vec_id"]).alias("outliers"), "vec")


@query("""WITH f AS (SELECT vec_id, unnest(range(64)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings) SELECT vec_id, round(sum(x * x) FILTER (WHERE pos < 32) / greatest(sum(x * x), 1e-9), 4) AS share FROM f GROUP BY vec_id""")
def energy_shares(spark, sf_dir):
    e = F.col("embedding")
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.round(windows.energy_share(F.slice(e, 1, 32), e), 4).alias("share"))


# --- audio dedup -----------------------------------------------------------------------------------------------------


@query(f"WITH {SQL_FP} SELECT _id FROM (SELECT _id, fp[1:(_id % 20)::INT] AS p FROM fps) WHERE len(list_distinct(p)) > 10")
def solid_fingerprints(spark, sf_dir):
    rows = c.fingerprints(spark, sf_dir).withColumn("fp", F.slice("fp", F.lit(1), (F.col("_id") % 20).cast("int")))
    return rows.where(audio_dedup.not_flat()).select("_id")


@query(f"""WITH RECURSIVE p AS (SELECT * FROM ({c.SQL["fingerprint_alignment"]})), e AS (SELECT a, b FROM p UNION SELECT b, a FROM p), reach(n, m) AS (SELECT a, a FROM e UNION SELECT r.n, e.b FROM reach r JOIN e ON e.a = r.m),
g AS (SELECT n, min(m) AS root FROM reach GROUP BY n), o AS (SELECT root, n, row_number() OVER (PARTITION BY root ORDER BY (n % 5)::VARCHAR, n) AS k FROM g)
SELECT min(n) FILTER (WHERE k = 1) AS keep, string_agg(n::VARCHAR, ',' ORDER BY k) FILTER (WHERE k > 1) AS duplicates FROM o GROUP BY root""")
def duplicate_groups(spark, sf_dir):
    f = c.fingerprints(spark, sf_dir)
    pairs = audio_dedup.alignments(audio_dedup.candidates(f, least=10), f, item=1.0, min_overlap=10)
    nodes = f.select("_id", (F.col("_id") % 5).cast("string").alias("created_at"), F.col("_id").alias("line_no"))
    return audio_dedup.groups(pairs, nodes).select("keep", F.array_join("duplicates", ",").alias("duplicates"))


# --- logs, sidecars, files -------------------------------------------------------------------------------------------


@query("SELECT doc_id AS _id, 'old' AS text FROM labels WHERE doc_id % 4 <> 0 UNION ALL SELECT doc_id, 'new' FROM documents WHERE doc_id % 4 = 0")
def refreshed_cache(spark, sf_dir):
    cache = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"), F.lit("old").alias("text"))
    return latest.refreshed(cache, _t(spark, sf_dir, "documents").where("doc_id % 4 = 0").select(F.col("doc_id").alias("_id"), F.lit("new").alias("text")))


@query("SELECT doc_id AS _id FROM documents d WHERE doc_id % 6 <> 0 AND source <> '' AND NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def missing_captions(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("_id"), F.when(F.col("doc_id") % 6 != 0, F.col("source")).alias("_index"))
    return latest.missing_captions(rows, _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id"))).select("_id")


@query("SELECT doc_id AS _id, source || '_' || doc_id AS file FROM documents")
def strict_files(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    manifest = d.select(F.col("doc_id").alias("_id"), T.media_stem("source", F.col("doc_id").cast("string")).alias("file"))
    return latest.with_file(d.select(F.col("doc_id").alias("_id")), manifest, strict=True)


@query("SELECT doc_id AS _id, coalesce(l.toxic = 1, false) AS old, CASE WHEN l.toxic = 1 THEN 'labels' ELSE d.source END AS source, d.lang FROM documents d LEFT JOIN labels l USING (doc_id)")
def overridden_records(spark, sf_dir):
    rows = _t(spark, sf_dir, "documents").select(F.col("doc_id").alias("_id"), "source", "lang", F.lit(False).alias("old"))
    new = _t(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("_id"), F.lit("labels").alias("source"), F.lit(True).alias("old"))
    return latest.overridden(rows, new).select("_id", "old", "source", "lang")


@query("SELECT event_id, user_id, event_type, 'now' AS kind FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, user_id, event_type, 'backup' FROM events")
def json_lines_round_trip(spark, sf_dir):
    """Appended twice with blank lines between, backed up once, then replaced by a part of itself."""
    rows = _t(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    path, schema = workspace.new_folder(spark, "lines"), "event_id bigint, user_id bigint, event_type string"
    sinks.append_json(rows.where("event_id % 2 = 0"), path)
    sinks.append_json(rows.where("event_id % 2 <> 0"), path)
    spark.createDataFrame([(" ",), ("",)], "value string").write.mode("append").text(path)
    sinks.backup_once(spark, path)
    sinks.replace_json(files.json_lines(spark, path, schema, ordered=False).where("event_type <> 'error'"), path)
    sinks.backup_once(spark, path)
    read = lambda p, kind: files.json_lines(spark, p, schema).drop("line_no").withColumn("kind", F.lit(kind))
    return read(path, "now").unionByName(read(f"{path}.bak", "backup"))


@query("SELECT doc_id, 'tanpa_ucapan' AS verdict FROM documents")
def absent_sidecar(spark, sf_dir):
    side = files.sidecar(spark, workspace.new_folder(spark, "absent"), "_id bigint, verdict string")
    rows = _t(spark, sf_dir, "documents").select("doc_id").join(side, F.col("doc_id") == F.col("_id"), "left")
    return rows.select("doc_id", F.coalesce("verdict", F.lit(report.NO_SPEECH_VERDICT)).alias("verdict"))


@query("SELECT item_id::VARCHAR AS _id, text FROM benchmark WHERE text IS NOT NULL")
def json_map_scan(spark, sf_dir):
    """A file that is one JSON object (the captions of a batch, of bounded number)."""
    path = workspace.new_folder(spark, "map")
    items = _t(spark, sf_dir, "benchmark").where("text is not null").select(F.struct(F.col("item_id").cast("string").alias("k"), F.col("text").alias("v")).alias("e"))
    items.agg(F.to_json(F.map_from_entries(F.collect_list("e"))).alias("value")).coalesce(1).write.text(path)
    return files.json_map(spark, path)


@query("SELECT DISTINCT user_id AS _id FROM events")
def stream_first_seen(spark, sf_dir):
    source, sink = _as_stream(spark, sf_dir), workspace.new_folder(spark, "seen")
    rows = incremental.new_only(source.select(F.col("user_id").alias("_id")))
    rows.writeStream.format("parquet").option("checkpointLocation", workspace.new_folder(spark, "state")).trigger(availableNow=True).start(sink).awaitTermination()
    return spark.read.schema(rows.schema).parquet(sink)


@query(c.SQL["latest_manifest_any"])
def stream_upserts(spark, sf_dir):
    """The latest record of each key, from batches of a stream."""
    path = workspace.new_folder(spark, "upserts")
    rows = _as_stream(spark, sf_dir, 2).select(F.col("user_id").alias("_id"), F.struct("ts", "event_id").alias("line_no"), "event_id", "event_type")
    write = incremental.upsert_into(path, buckets=4)
    rows.writeStream.foreachBatch(write).option("checkpointLocation", workspace.new_folder(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    return incremental.upserted(spark, path).select("_id", "event_id", "event_type")


def _as_stream(spark, sf_dir, files_a_batch: int = 1000):
    """The events as a stream of three files and what the table has more."""
    path, rows = workspace.new_folder(spark, "events"), _t(spark, sf_dir, "events")
    rows.withColumn("part", F.col("event_id") % 3).write.partitionBy("part").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files_a_batch).option("recursiveFileLookup", "true").parquet(path)


# --- search ----------------------------------------------------------------------------------------------------------

_TOKENS = c._TOKENS


@query(f"""WITH t AS (SELECT doc_id, {_TOKENS} AS w FROM documents), n AS (SELECT count(*) AS n, count(*) FILTER (WHERE list_contains(w, 'moron')) AS a, count(*) FILTER (WHERE list_contains(w, 'the')) AS b FROM t),
k AS (SELECT doc_id, len(list_filter(w, lambda x: x = 'moron')) AS x, len(list_filter(w, lambda x: x = 'the')) AS y FROM t),
s AS (SELECT doc_id, round(ln(1 + (n - a + 0.5) / (a + 0.5)) * x / (x + 1.2::DOUBLE) + ln(1 + (n - b + 0.5) / (b + 0.5)) * y / (y + 1.2::DOUBLE), 9) AS score FROM k, n WHERE x + y > 0)
SELECT doc_id FROM s ORDER BY score DESC, doc_id LIMIT 25""")
def search_by_relevance(spark, sf_dir):
    body = {"query": {"simple_query_string": {"query": "moron the", "fields": ["text"]}}, "size": 25}
    return search.search(_t(spark, sf_dir, "documents"), body, tie="doc_id").select("doc_id")


@query("SELECT doc_id, lang FROM documents WHERE source IS NOT NULL AND lang IN ('de', 'fr') AND n_chars >= 100 AND n_chars <= 2000")
def search_projection(spark, sf_dir):
    must = [{"exists": {"field": "source"}}, {"terms": {"lang": ["de", "fr"]}}, {"range": {"n_chars": {"gte": 100, "lte": 2000}}}]
    return search.search(_t(spark, sf_dir, "documents"), {"query": {"bool": {"must": must}}, "_source": ["doc_id", "lang"], "sort": ["n_chars"]}, tie="doc_id", size=0)


# --- report ----------------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN lang IN ('en', 'id') THEN lang END AS hint, printf('%.0f', round_even((n_chars % 1000) / 1000.0::DOUBLE * 100, 0)) || '%' AS part,
CASE WHEN n_chars % 7 = 0 THEN 0 ELSE (n_chars % 50) / (n_chars % 7)::DOUBLE END AS portion, substr(coalesce(text, ''), 1, 300) AS error FROM documents""")
def scalar_formats(spark, sf_dir):
    n = F.col("n_chars")
    return _t(spark, sf_dir, "documents").select("doc_id", T.language_hint("lang").alias("hint"), T.percent((n % 1000) / 1000.0).alias("part"), T.ratio(n % 50, n % 7).alias("portion"), T.prefix(T.text_of("text"), 300).alias("error"))


MANUAL = ["7=salah", "7=cek = ulang", "12=dua", "15=tiga"]
_MANUAL = "m(_id, manual) AS (VALUES (7, 'cek = ulang'), (12, 'dua'), (15, 'tiga'))"


@query(f"""WITH {SQL_SEGMENTS}, {SQL_TIMES}, {SQL_REPORT}, {_MANUAL},
gone AS (SELECT doc_id, count(*) AS n, sum(end_s - start_s) AS s, string_agg(DISTINCT reason, ', ' ORDER BY reason) AS r FROM flagged JOIN times USING (doc_id, seg) WHERE reason IS NOT NULL AND reason <> 'kosong' GROUP BY 1),
v AS (SELECT _id, (_id % 5)::DOUBLE AS a, (_id % 7)::DOUBLE AS b FROM base),
h AS (SELECT _id, CASE WHEN a + b <> 0 THEN (CASE WHEN a < 3 THEN a ELSE 0 END + CASE WHEN b < 3 THEN b ELSE 0 END) / (a + b) END AS share FROM v)
SELECT n._id, concat_ws('; ', CASE WHEN n.status = 'done' THEN nullif(concat_ws('; ',
 CASE WHEN len(list_filter(regexp_split_to_array(coalesce(transcript, ''), '[\\s\\x{{A0}}]+'), lambda x: x <> '')) <= 3 THEN '{report.NOTE_SHORT}' END,
 CASE WHEN transcript_lang IS DISTINCT FROM lang THEN 'Bahasa beda dari caption (' || coalesce(lang, 'None') || ')' END,
 CASE WHEN gone.n > 0 THEN gone.n || ' segmen halusinasi Whisper dibuang (' || printf('%.0f', round_even(gone.s, 0)) || ' detik, ' || gone.r || ')' END,
 CASE WHEN n._id % 6 = 0 THEN '{report.NOTE_FALLBACK}' END,
 CASE WHEN share >= 0.5 THEN printf('%.0f', round_even(share * 100, 0)) || '%' || '{report.NOTE_TURNS.removeprefix("%s")}' END,
 CASE WHEN duplicate_of IS NOT NULL THEN 'Duplikat isi dengan _id ' || duplicate_of || ' (reupload)' END), '') END, manual) AS notes
FROM nos n LEFT JOIN dups USING (_id) LEFT JOIN gone ON gone.doc_id = n._id LEFT JOIN h USING (_id) LEFT JOIN m USING (_id)""")
def notes_full(spark, sf_dir):
    rows = report.numbered(c.report_base(spark, sf_dir), *report.report_key())
    first = report.first_seen(rows.where("transcript_status = 'done'"), "transcript").select(F.col("_id").alias("d"), "duplicate_of")
    made = c.records(spark, sf_dir).select(F.col("doc_id").alias("r"), "segments")
    rows = rows.join(first, F.col("_id") == F.col("d"), "left").join(made, F.col("_id") == F.col("r"), "left")
    a, b = (F.col("_id") % 5).cast("double"), (F.col("_id") % 7).cast("double")
    rows = rows.withColumns({"prompt_fallback": F.col("_id") % 6 == 0, "voices": F.array(F.struct(a.alias("seconds")), F.struct(b.alias("seconds"))), "speech_seconds": a + b})
    manual = report.manual_notes(spark, MANUAL).select(F.col("_id").cast("long").alias("k"), "manual_note")
    rows = rows.join(F.broadcast(manual), F.col("_id") == F.col("k"), "left")
    return rows.select("_id", report.notes(rows).alias("notes"))


def full_report(spark, sf_dir):
    d = c.report_base(spark, sf_dir).withColumns({
        "platform": F.col("transcript_lang"), "content": T.prefix("transcript", 40), "link": F.concat(F.lit("l"), F.col("_id").cast("string")), "_index": F.lit("i"),
        "transcript_duration": F.when(F.col("_id") % 8 != 0, (F.col("_id") % 50).cast("double")), "process_seconds": (F.col("_id") % 9).cast("double"),
    })
    ids = F.col("doc_id").alias("_id")
    labels = _t(spark, sf_dir, "labels")
    segs = F.array(F.struct(F.lit(61.5).alias("start"), F.lit("satu").alias("text"), F.lit("target").alias("label")), F.struct(F.lit(70.0).alias("start"), F.lit("dua").alias("text"), F.when(F.col("toxic") == 1, "target").otherwise("lain").alias("label")))
    seconds = (F.col("doc_id") % 6).cast("double")
    speakers = labels.select(
        ids, F.when((F.col("quality") == 1) & (F.col("toxic") == 1), "ya").otherwise("tidak").alias("verdict"), seconds.alias("target_seconds"), F.lit(0.5).alias("max_sim"), F.lit(2).alias("n_voices"),
        seconds.alias("speech_seconds"), F.array(F.struct(seconds.alias("seconds"))).alias("voices"), segs.alias("spoken"),
    )
    captions = labels.where("doc_id % 2 = 0").select(ids, F.when(F.col("toxic") == 1, "").otherwise("kata moron").alias("text"))
    translations = labels.where("doc_id % 3 = 0").select(ids, F.lit("terjemahan").alias("text"))
    manual = report.manual_notes(spark, MANUAL).select(F.col("_id").cast("long").alias("_id"), "manual_note")
    media = labels.where("doc_id % 5 <> 0").select(ids, F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("file"))
    turn_texts = _matched_turns_text(spark, sf_dir)
    return report.report_rows(d, ["the", "que"], ["and", "la"], "moron", speakers, captions, translations, manual, media, turn_texts)


def _matched_turns_text(spark, sf_dir):
    return turns.as_text(_matched_turns(spark, sf_dir), "conv_id").select(F.col("conv_id").alias("_id"), "turns")


SQL_FULL = f"""{SQL_REPORT}, {_MANUAL}, tt AS (SELECT conv_id, turns FROM ({c.SQL.get("matched_turn_texts", "")})),
j AS (SELECT n.*, l.quality, l.toxic, l.doc_id IS NOT NULL AS has, n._id % 6 AS sec, CASE WHEN n._id % 8 <> 0 THEN (n._id % 50)::DOUBLE END AS dur, lower(coalesce(n.transcript, '')) AS low, dups.duplicate_of, m.manual, tt.turns
      FROM nos n LEFT JOIN labels l ON l.doc_id = n._id LEFT JOIN dups USING (_id) LEFT JOIN m USING (_id) LEFT JOIN tt ON tt.conv_id = n._id),
f AS (SELECT *, CASE WHEN has AND quality = 1 AND toxic = 1 THEN 'ya' WHEN has THEN 'tidak' ELSE 'tanpa_ucapan' END AS suara, CASE WHEN has THEN sec ELSE 0 END::DOUBLE AS detik, contains(low, 'and') OR contains(low, 'la') AS heard,
      CASE WHEN has AND _id % 2 = 0 THEN CASE WHEN toxic = 1 THEN '' ELSE 'kata moron' END ELSE substr(coalesce(transcript, ''), 1, 40) END AS caption FROM j),
full_ AS (SELECT no, status, concat_ws('; ', CASE WHEN status = 'done' THEN nullif(concat_ws('; ',
  CASE WHEN len(list_filter(regexp_split_to_array(coalesce(transcript, ''), '[\\s\\x{{A0}}]+'), lambda x: x <> '')) <= 3 THEN '{report.NOTE_SHORT}' END,
  CASE WHEN transcript_lang IS DISTINCT FROM lang THEN 'Bahasa beda dari caption (' || coalesce(lang, 'None') || ')' END,
  CASE WHEN has AND sec <> 0 AND sec < 3 THEN '100%' || '{report.NOTE_TURNS.removeprefix("%s")}' END,
  CASE WHEN duplicate_of IS NOT NULL THEN 'Duplikat isi dengan _id ' || duplicate_of || ' (reupload)' END), '') END, manual) AS catatan,
  transcript_lang AS platform, created_at, dur AS durasi, (_id % 9)::DOUBLE AS proses, transcript_lang AS lang,
  CASE WHEN trim(regexp_replace(coalesce(transcript, ''), ' +', ' ', 'g'), ' ') = '' THEN 0 ELSE length(trim(regexp_replace(coalesce(transcript, ''), ' +', ' ', 'g'), ' ')) - length(replace(trim(regexp_replace(coalesce(transcript, ''), ' +', ' ', 'g'), ' '), ' ', '')) + 1 END::BIGINT AS kata,
  CASE WHEN contains(low, 'the') OR contains(low, 'que') THEN 'ya' ELSE 'tidak' END AS kunci_lisan, CASE WHEN heard THEN 'ya' ELSE 'tidak' END AS nama_lisan, suara, detik AS suara_detik,
  CASE WHEN coalesce(dur, 0) = 0 THEN 0 ELSE detik / dur END::DOUBLE AS suara_porsi, CASE WHEN has THEN 0.5 END::DOUBLE AS suara_skor, CASE WHEN has THEN 2 ELSE 0 END::INT AS n_suara,
  CASE WHEN suara = 'ya' THEN 'pembicara' WHEN heard THEN 'dibicarakan' WHEN contains(lower(caption), 'moron') THEN 'hanya_caption' ELSE 'tidak_disebut' END AS peran, caption,
  coalesce(transcript, '') AS transkrip, coalesce(turns, '') AS per_pembicara, CASE WHEN has AND _id % 3 = 0 THEN 'terjemahan' ELSE '' END AS terjemahan,
  CASE WHEN NOT has THEN '' WHEN toxic = 1 THEN '[1:01] satu' || chr(10) || '[1:10] dua' ELSE '[1:01] satu' END AS kutipan, 'l' || _id AS link, CASE WHEN has AND _id % 5 <> 0 THEN 'f' || _id END AS file, _id, 'i' AS _index FROM f)"""


@query(f"WITH {SQL_FULL} SELECT * FROM full_")
def report_full(spark, sf_dir):
    """All 26 columns of the report, with all sidecars."""
    return full_report(spark, sf_dir)


METHOD = [("Model", None, "stand-in; 3 s"), ("Ambang", 0.45, "cosine"), ("Minimal durasi", 3, None)]


@query(f"""WITH {SQL_FULL}, st AS (SELECT unnest(range(5))::INT AS place, unnest(['done', 'suspect_hallucination', 'no_speech', 'no_audio', 'failed']) AS name), ro AS (SELECT unnest(range(4))::INT AS place, unnest(['pembicara', 'dibicarakan', 'hanya_caption', 'tidak_disebut']) AS name),
s AS (SELECT place, name, (SELECT count(*) FROM full_ WHERE status = name) AS value FROM st), r AS (SELECT place, name, (SELECT count(*) FROM full_ WHERE peran = name) AS value FROM ro),
a AS (SELECT sum(durasi) / 60 AS am, sum(proses) FILTER (WHERE durasi > 0) / 60 AS wm, count(*) FILTER (WHERE status = 'done' AND kunci_lisan = 'ya') AS sp, count(*) FILTER (WHERE status = 'done' AND nama_lisan = 'ya') AS na, count(*) AS hi,
      count(*) FILTER (WHERE coalesce(file, '') = '') AS mi, sum(suara_detik) AS ts, bool_and(contains(lower(caption), 'a')) AS al FROM full_)
SELECT 'status' AS section, place, name, value::DOUBLE AS value, NULL AS text FROM s UNION ALL SELECT 'status', 5, 'total', sum(value)::DOUBLE, NULL FROM s
UNION ALL SELECT 'peran', place, name, value::DOUBLE, NULL FROM r UNION ALL SELECT 'peran', 4, 'total', sum(value)::DOUBLE, NULL FROM r
UNION ALL SELECT 'metrik', 0, 'audio_minutes', round(am, 4), NULL FROM a UNION ALL SELECT 'metrik', 1, 'work_minutes', round(wm, 4), NULL FROM a UNION ALL SELECT 'metrik', 2, 'speed', round(coalesce(am / wm, 0), 4), NULL FROM a
UNION ALL SELECT 'metrik', 3, 'spoken', sp, CASE WHEN al THEN 'Semua caption memuat a' END FROM a UNION ALL SELECT 'metrik', 4, 'named', na, NULL FROM a UNION ALL SELECT 'metrik', 5, 'hits', hi, NULL FROM a
UNION ALL SELECT 'metrik', 6, 'missing', mi, NULL FROM a UNION ALL SELECT 'metrik', 7, 'target_seconds', round(ts, 4), NULL FROM a
UNION ALL SELECT 'metode', 0, 'Model', NULL, 'stand-in; 3 s' UNION ALL SELECT 'metode', 1, 'Ambang', 0.45, 'cosine' UNION ALL SELECT 'metode', 2, 'Minimal durasi', 3, NULL""")
def report_summary(spark, sf_dir):
    out = report.summary(full_report(spark, sf_dir), METHOD, "a")
    return out.select("section", "place", "name", F.round("value", 4).alias("value"), "text")
