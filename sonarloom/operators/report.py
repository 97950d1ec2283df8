"""Report rows, notes, roles and the summary. What a spreadsheet would compute on opening is computed here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonarloom.functions import text as T
from sonarloom.operators.transcript import DONE, EMPTY, STATUSES

# Fixed values of the report: roles, their order, and texts of notes.
SPEAKER, DISCUSSED, CAPTION_ONLY, NOT_NAMED = "pembicara", "dibicarakan", "hanya_caption", "tidak_disebut"
ROLES = [SPEAKER, DISCUSSED, CAPTION_ONLY, NOT_NAMED]
NO_SPEECH_VERDICT = "tanpa_ucapan"
NOTE_SHORT = "Transkrip sangat pendek, cek manual"
NOTE_LANGUAGE = "Bahasa beda dari caption (%s)"
NOTE_DROPPED = "%d segmen halusinasi Whisper dibuang (%s detik, %s)"
NOTE_FALLBACK = "Prompt ejaan memicu halusinasi, ditranskrip ulang tanpa prompt"
NOTE_TURNS = "%s ucapan berupa giliran bicara pendek (<3 detik per suara): jumlah suara tidak terhitung, bisa lebih banyak"
NOTE_DUPLICATE = "Duplikat isi dengan _id %s (reupload)"
SHORT_WORDS, PREFIX, SHORT_VOICE, SHORT_SHARE = 3, 120, 3.0, 0.5


def rank_of(status) -> Column:
    """Place in the report's order of statuses; 9 for any other."""
    out = F.lit(9)
    for k, s in enumerate(STATUSES):
        out = F.when(T._col(status) == s, k).otherwise(out)
    return out


def report_key(status: str = "transcript_status", created: str = "created_at", line: str = "line_no") -> list[Column]:
    return [rank_of(status), F.coalesce(created, F.lit("")), F.col(line)]


def numbered(rows: DataFrame, *order: Column, name: str = "no") -> DataFrame:
    """Row numbers 1.. in a global order without gathering all rows in one task: rows are dealt by ranges of the order,
    numbered inside each, and shifted by the rows of the ranges before (a row per partition)."""
    dealt = rows.withColumns({f"__o{k}": c for k, c in enumerate(order)})
    keys = [f"__o{k}" for k in range(len(order))]
    n = max(1, rows.sparkSession.sparkContext.defaultParallelism)
    dealt = dealt.repartitionByRange(n, *keys).withColumn("__p", F.spark_partition_id())
    # Ranges are fixed once: written out, they are the same for both uses.
    from sonarloom import workspace

    dealt = workspace.materialize(dealt, "ranges")
    counts = dealt.groupBy("__p").agg(F.count("*").alias("__n"))
    before = counts.select("__p", (F.sum("__n").over(Window.orderBy("__p")) - F.col("__n")).alias("__before"))
    own = F.row_number().over(Window.partitionBy("__p").orderBy(*keys))
    return dealt.withColumn("__own", own).join(F.broadcast(before), "__p").withColumn(name, F.col("__before") + F.col("__own")).drop("__p", "__own", "__before", *keys)


def first_seen(rows: DataFrame, text: str, key: str = "_id", no: str = "no", length: int = PREFIX) -> DataFrame:
    """``duplicate_of``: the first row (by number) with the same first characters, null for that row itself. The first is a
    partial aggregate, so that a text in very many rows is no hot spot."""
    mark = F.xxhash64(T.prefix(T.text_of(text), length))
    marked = rows.withColumn("__m", mark)
    first = marked.groupBy("__m").agg(F.min(F.struct(no, F.col(key).alias("k"))).alias("__f"))
    out = marked.join(first, "__m").withColumn("duplicate_of", F.when(F.col("__f")[no] < F.col(no), F.col("__f.k")))
    return out.drop("__m", "__f")


def dropped(segments: Column) -> Column:
    return F.filter(segments, lambda s: s["hallucination"].isNotNull() & (s["hallucination"] != EMPTY))


def dropped_note(segments: Column) -> Column:
    gone = dropped(segments)
    # Each length first: in another order, sums that end in a half round to another whole number.
    seconds = F.aggregate(gone, F.lit(0.0), lambda a, s: a + (s["end"] - s["start"]))
    reasons = F.array_join(F.array_sort(F.array_distinct(F.transform(gone, lambda s: s["hallucination"]))), ", ")
    return F.when(F.size(gone) > 0, F.format_string(NOTE_DROPPED, F.size(gone), T.whole(seconds), reasons))


def short_turn_share(voices: Column, speech: Column) -> Column:
    short = F.aggregate(F.filter(voices, lambda v: v["seconds"] < SHORT_VOICE), F.lit(0.0), lambda a, v: a + v["seconds"])
    return F.when(F.coalesce(speech, F.lit(0.0)) != 0, short / speech)


def notes(rows: DataFrame) -> Column:
    """Notes of done rows, joined in their fixed order. Optional columns: segments, prompt_fallback, voices,
    speech_seconds, duplicate_of, manual_note."""
    has, parts = set(rows.columns), []
    parts.append(F.when(T.word_count("transcript") <= SHORT_WORDS, NOTE_SHORT))
    parts.append(F.when(T.differs("transcript_lang", "lang"), F.format_string(NOTE_LANGUAGE, F.coalesce("lang", F.lit("None")))))
    if "segments" in has:
        parts.append(dropped_note(F.coalesce("segments", F.array().cast(rows.schema["segments"].dataType))))
    if "prompt_fallback" in has:
        parts.append(F.when(F.col("prompt_fallback"), NOTE_FALLBACK))
    if {"voices", "speech_seconds"} <= has:
        share = short_turn_share(F.col("voices"), F.col("speech_seconds"))
        parts.append(F.when(share >= SHORT_SHARE, F.format_string(NOTE_TURNS, T.percent(share))))
    if "duplicate_of" in has:
        parts.append(F.when(F.col("duplicate_of").isNotNull(), F.format_string(NOTE_DUPLICATE, F.col("duplicate_of").cast("string"))))
    auto = F.when(F.col("transcript_status") == DONE, T.joined(F.array(*parts), "; "))
    return T.joined(F.array(auto, F.col("manual_note")), "; ") if "manual_note" in has else F.coalesce(auto, F.lit(""))


def role(verdict, spoken: Column, caption: Column, name: str) -> Column:
    """Speaker, talked about, only in the caption, or not named."""
    return (
        F.when(F.coalesce(verdict, F.lit(NO_SPEECH_VERDICT)) == "ya", SPEAKER).when(spoken, DISCUSSED).when(T.has_substring(caption, name), CAPTION_ONLY).otherwise(NOT_NAMED)
    )


def count_over(rows: DataFrame, column: str, domain: list[str], total: str = "total") -> DataFrame:
    """Counts of a fixed domain, zeros too, and their sum as a row of its own; values outside it count nowhere."""
    spark = rows.sparkSession
    names = spark.createDataFrame([(k, d) for k, d in enumerate(domain)], "place int, value string")
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    full = names.join(counts, "value", "left").select("place", "value", F.coalesce("n", F.lit(0)).alias("n"))
    return full.unionByName(full.agg(F.lit(len(domain)).alias("place"), F.lit(total).alias("value"), F.sum("n").alias("n")))


def speed(rows: DataFrame, duration: str = "transcript_duration", process: str = "process_seconds") -> DataFrame:
    """Minutes of audio and of work (of rows with a duration above 0) and their ratio, 0 where there is none."""
    out = rows.agg((F.sum(duration) / 60).alias("audio_minutes"), (F.sum(F.when(F.col(duration) > 0, F.col(process))) / 60).alias("work_minutes"))
    return out.withColumn("speed", T.ratio("audio_minutes", "work_minutes"))


def all_match(rows: DataFrame, caption: str, *needles: str, by: list[str] | None = None) -> DataFrame:
    """Whether every caption has all the words (in each group of ``by``); true for no rows."""
    cond = F.lit(True)
    for n in needles:
        cond = cond & T.has_substring(caption, n)
    return rows.groupBy(*(by or [])).agg(F.coalesce(F.bool_and(cond), F.lit(True)).alias("all_match"))


#: Columns of the report in order; the second group is left out where no clip was scored, the third without translations.
COLUMNS = [
    "no", "status", "catatan", "platform", "created_at", "durasi", "proses", "lang", "kata", "kunci_lisan", "nama_lisan", "suara", "suara_detik", "suara_porsi", "suara_skor", "n_suara",
    "peran", "caption", "transkrip", "per_pembicara", "terjemahan", "kutipan", "link", "file", "_id", "_index",
]
SPEAKER_COLUMNS = ["suara", "suara_detik", "suara_porsi", "suara_skor", "n_suara", "peran", "per_pembicara", "kutipan"]


def manual_notes(spark, given: list[str]) -> DataFrame:
    """_id and manual_note of ``_id=text`` arguments; of several for an id, the last."""
    rows = spark.createDataFrame([(k, g) for k, g in enumerate(given)], "place int, g string").select("place", T.key_value("g").alias("kv"))
    return rows.groupBy(F.col("kv.key").alias("_id")).agg(F.max_by("kv.value", "place").alias("manual_note"))


def report_rows(
    rows: DataFrame, spoken: list[str], named: list[str], name: str, speakers: DataFrame | None = None, captions: DataFrame | None = None,
    translations: DataFrame | None = None, manual: DataFrame | None = None, files: DataFrame | None = None, turn_texts: DataFrame | None = None,
) -> DataFrame:
    """The report: a row per transcript in the report's order, all of ``COLUMNS`` that their sidecars allow.

    ``rows``: _id, _index, line_no, platform, created_at, lang, content, link, transcript and its status, lang, duration, process_seconds.
    ``speakers``: _id, verdict, target_seconds, max_sim, n_voices, voices, speech_seconds, segments (start, text, label); captions and
    translations: _id, text; ``files``: _id, file; ``turn_texts``: _id, turns. Missing sidecars and rows have defaults;
    sidecars have one row per id."""
    out = numbered(rows, *report_key())
    first = first_seen(out.where(F.col("transcript_status") == DONE), "transcript").select(F.col("_id").alias("__d"), "duplicate_of")
    out = out.join(first, F.col("_id") == F.col("__d"), "left").drop("__d")

    def joined(df: DataFrame | None, kinds: dict[str, str]) -> DataFrame:
        if df is None:
            return out.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items()})
        have = [F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()]
        return out.join(df.select(F.col("_id").alias("__k"), *have), F.col("_id") == F.col("__k"), "left").drop("__k")

    voices = "array<struct<seconds double>>"
    out = joined(speakers, {"verdict": "string", "target_seconds": "double", "max_sim": "double", "n_voices": "int", "speech_seconds": "double", "voices": voices, "spoken": "array<struct<start double, text string, label string>>"})
    out = joined(None if captions is None else captions.select("_id", F.col("text").alias("cached"), F.lit(True).alias("is_cached")), {"cached": "string", "is_cached": "boolean"})
    out = joined(None if translations is None else translations.select("_id", F.col("text").alias("translated")), {"translated": "string"})
    out = joined(manual, {"manual_note": "string"})
    out = joined(files, {"file": "string"})
    out = joined(turn_texts, {"turns": "string"})
    out = out.withColumn("caption", F.when(F.coalesce("is_cached", F.lit(False)), F.col("cached")).otherwise(T.text_of("content")))
    heard = T.has_substring("transcript", *named)
    target = F.filter("spoken", lambda s: s["label"] == "target")
    quotes = F.array_join(F.transform(target, lambda s: F.concat(F.lit("["), T.mmss(s["start"]), F.lit("] "), s["text"])), "\n")
    full = out.select(
        "no", F.col("transcript_status").alias("status"), notes(out).alias("catatan"), "platform", "created_at", F.col("transcript_duration").alias("durasi"), F.col("process_seconds").alias("proses"),
        F.col("transcript_lang").alias("lang"), T.space_word_count("transcript").cast("long").alias("kata"), T.yes_no(T.has_substring("transcript", *spoken)).alias("kunci_lisan"), T.yes_no(heard).alias("nama_lisan"),
        F.coalesce("verdict", F.lit(NO_SPEECH_VERDICT)).alias("suara"), F.coalesce("target_seconds", F.lit(0.0)).alias("suara_detik"),
        T.ratio(F.coalesce("target_seconds", F.lit(0.0)), F.nullif("transcript_duration", F.lit(0.0))).alias("suara_porsi"), F.col("max_sim").alias("suara_skor"), F.coalesce("n_voices", F.lit(0)).alias("n_suara"),
        role(F.col("verdict"), heard, F.col("caption"), name).alias("peran"), "caption", T.text_of("transcript").alias("transkrip"), T.text_of("turns").alias("per_pembicara"),
        T.text_of("translated").alias("terjemahan"), F.coalesce(quotes, F.lit("")).alias("kutipan"), "link", "file", "_id", "_index",
    )
    optional = {c: speakers is not None for c in SPEAKER_COLUMNS} | {"terjemahan": translations is not None}
    return full.select(*present(COLUMNS, optional))


def summary(report: DataFrame, method: list[tuple[str, float | None, str | None]] | None = None, *captions: str) -> DataFrame:
    """The batch in rows of place, section, name, value and text: counts by status, minutes, speed, mentions, roles, seconds of
    target speech, then ``method``: literal rows of how it was made. ``report``: rows of ``report_rows``. The figures are one
    aggregate each; captions: words that all captions are said to have, if they do."""
    spark, has = report.sparkSession, set(report.columns)
    parts = [count_over(report, "status", STATUSES, "total").select(F.lit("status").alias("section"), "place", F.col("value").alias("name"), F.col("n").cast("double").alias("value"))]
    one = speed(report, "durasi", "proses").join(all_match(report, "caption", *captions) if captions else spark.createDataFrame([(False,)], "all_match boolean"))
    done = F.col("status") == DONE
    counts = report.agg(F.count_if(done & (F.col("kunci_lisan") == "ya")).alias("spoken"), F.count_if(done & (F.col("nama_lisan") == "ya")).alias("named"), F.count("*").alias("hits"), F.count_if(F.coalesce("file", F.lit("")) == "").alias("missing"), *([F.sum("suara_detik").alias("target_seconds")] if "suara_detik" in has else []))
    figures = one.join(counts)
    names = ["audio_minutes", "work_minutes", "speed", "spoken", "named", "hits", "missing", *(["target_seconds"] if "suara_detik" in has else [])]
    listed = F.array(*[F.struct(F.lit(k).alias("place"), F.lit(n).alias("name"), F.col(n).cast("double").alias("value"), (F.when(F.col("all_match"), F.lit("Semua caption memuat " + ", ".join(captions))) if n == "spoken" and captions else F.lit(None).cast("string")).alias("text")) for k, n in enumerate(names)])
    parts.append(figures.select(F.explode(listed).alias("f")).select(F.lit("metrik").alias("section"), "f.place", "f.name", "f.value", "f.text"))
    if "peran" in has:
        parts.append(count_over(report, "peran", ROLES, "total").select(F.lit("peran").alias("section"), "place", F.col("value").alias("name"), F.col("n").cast("double").alias("value")))
    if method:
        told = [("metode", k, n, None if v is None else float(v), t) for k, (n, v, t) in enumerate(method)]
        parts.append(spark.createDataFrame(told, "section string, place int, name string, value double, text string"))
    out = parts[0].withColumn("text", F.lit(None).cast("string"))
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def variants(rows: DataFrame, variant: str, status: str, flagged: str, words: str, leaked: str | None = None) -> DataFrame:
    """Status counts, flagged segments and words per variant of an experiment, and how many rows are ``leaked`` (boolean)."""
    one = lambda s: F.count_if(F.col(status) == s).alias(s)
    return rows.groupBy(variant).agg(*[one(s) for s in STATUSES[:3]], F.sum(flagged).alias("flagged"), F.sum(words).alias("words"), *([F.count_if(F.col(leaked)).alias("leaked")] if leaked else []))


def present(columns: list[str], optional: dict[str, bool]) -> list[str]:
    """Columns of a report without those whose sidecar is absent."""
    return [c for c in columns if optional.get(c, True)]
