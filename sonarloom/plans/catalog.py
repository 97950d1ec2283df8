"""All queries over the driver's tables and their DuckDB SQL.

The tables stand in for a media batch: ``documents`` are transcripts (``source`` as platform) and their lines segments,
``conversations`` are clips of spoken turns with times made from text lengths (60 ms a character), ``labels`` an optional
sidecar, ``events`` an append log, ``embeddings`` window embeddings of speakers (``label``), ``orders`` dated posts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonarloom import workspace
from sonarloom.functions import text as T
from sonarloom.operators import audio_dedup, latest, report, similar, transcript, turns, voices, windows
from sonarloom.operators.components import components
from sonarloom.sources import search
from sonarloom.streaming import incremental

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return workspace.table(spark, sf_dir, name)


# --- segments of documents -------------------------------------------------------------------------------------------

N_PROMPT = 60


def prompt_words(spark: SparkSession, sf_dir: str) -> list[str]:
    """The commonest words of the benchmark, a fixed number of them."""
    w = _t(spark, sf_dir, "benchmark").select(F.explode(T.words("text")).alias("w"))
    return [r["w"] for r in w.groupBy("w").count().orderBy(F.desc("count"), "w").limit(N_PROMPT).collect()]


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, seg, text, start, end, duration, no_speech_prob of the lines of documents."""
    lines = _t(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(T.text_of("text"), "\n")).alias("seg", "text"))
    ms = F.sum(F.length("text") * 60).over(Window.partitionBy("doc_id").orderBy("seg"))
    out = lines.withColumn("text", F.btrim("text")).withColumn("end_ms", ms)
    out = out.withColumn("start", (F.col("end_ms") - F.length("text") * 60) / 1000.0).withColumn("end", F.col("end_ms") / 1000.0)
    return out.withColumn("no_speech_prob", ((F.col("doc_id") * 31 + F.col("seg") * 17) % 100) / 100.0).drop("end_ms")


SQL_SEGMENTS = rf"""
prompt AS (SELECT list(w) AS p FROM (SELECT w FROM (SELECT unnest(regexp_extract_all(lower(coalesce(text, '')), '[\p{{L}}\p{{N}}_]+')) AS w FROM benchmark)
           GROUP BY w ORDER BY count(*) DESC, w LIMIT {N_PROMPT})),
lines AS (SELECT doc_id, unnest(range(len(l)))::INT AS seg, trim(unnest(l)) AS text
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
segs AS (SELECT *, ((doc_id * 31 + seg * 17) % 100) / 100.0::DOUBLE AS no_speech_prob,
         regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w FROM lines),
counted AS (SELECT segs.*, len(w) AS n, len(list_distinct(w)) AS d, len(list_filter(w, lambda x: list_contains(p, x))) AS c FROM segs, prompt),
flagged AS (SELECT *, CASE WHEN n = 0 THEN 'kosong'
    WHEN trim(lower(text), ' .!?') IN ('terima kasih', 'terima kasih telah menonton', 'sampai jumpa', 'thank you', 'thanks for watching', 'you')
      OR regexp_matches(trim(lower(text), ' .!?'), '^(pembicara|speaker) \p{{Nd}}+$') THEN 'frasa_umum'
    WHEN n >= 8 AND d / n::DOUBLE < 0.4 THEN 'berulang' WHEN n >= 5 AND c / n::DOUBLE >= 0.8 THEN 'salinan_prompt' END AS reason FROM counted),
cleaned AS (SELECT doc_id, coalesce(trim(string_agg(text, ' ' ORDER BY seg) FILTER (WHERE reason IS NULL)), '') AS transcript,
    coalesce(bool_or(no_speech_prob < 0.6 AND reason IS NULL), false) AS clean, coalesce(bool_or(no_speech_prob < 0.6 AND reason IS NOT NULL AND reason <> 'kosong'), false) AS made_up,
    count(*) FILTER (WHERE reason IS NOT NULL AND reason <> 'kosong') AS n_dropped FROM flagged GROUP BY doc_id),
statused AS (SELECT *, CASE WHEN transcript <> '' AND clean THEN 'done' WHEN made_up THEN 'suspect_hallucination' ELSE 'no_speech' END AS status FROM cleaned)"""


def flagged_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments(spark, sf_dir).withColumn("reason", transcript.reason(F.col("text"), F.col("start"), F.lit(None).cast("double"), prompt_words(spark, sf_dir)))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A transcript record per document, cleaned and with a status."""
    seg = segments(spark, sf_dir).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("seg", "start", "end", "text", "no_speech_prob"))).alias("s"))
    null = F.lit(None).cast("string")
    as_stored = F.transform("s", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["text"].alias("text"), s["no_speech_prob"].alias("no_speech_prob"), null.alias("hallucination")))
    raw = seg.select("doc_id", as_stored.alias("segments"), null.alias("transcript"), null.alias("transcript_raw"), F.lit(None).cast("double").alias("transcript_duration"), null.alias("transcript_status"))
    return transcript.reclassify(raw, prompt_words(spark, sf_dir))


@query(f"""WITH {SQL_SEGMENTS}, names AS (SELECT unnest(['done', 'suspect_hallucination', 'no_speech', 'no_audio', 'failed']) AS status),
full_ AS (SELECT names.status, count(statused.status) AS n FROM names LEFT JOIN statused USING (status) GROUP BY 1)
SELECT status, n FROM full_ UNION ALL SELECT 'total', sum(n)::BIGINT FROM full_""")
def status_summary(spark, sf_dir):
    out = report.count_over(records(spark, sf_dir), "transcript_status", transcript.STATUSES)
    return out.select(F.col("value").alias("status"), "n")


@query(f"WITH {SQL_SEGMENTS} SELECT doc_id, seg, n::INT AS n_words, d::INT AS n_distinct, reason FROM flagged")
def segment_flags(spark, sf_dir):
    w = T.words("text")
    return flagged_segments(spark, sf_dir).select("doc_id", "seg", F.size(w).alias("n_words"), F.size(F.array_distinct(w)).alias("n_distinct"), "reason")


@query(f"WITH {SQL_SEGMENTS} SELECT doc_id, transcript, status FROM statused")
def clean_transcript(spark, sf_dir):
    return records(spark, sf_dir).select("doc_id", "transcript", F.col("transcript_status").alias("status"))


@query(f"WITH {SQL_SEGMENTS} SELECT coalesce(reason, 'none') AS reason, count(*) AS n FROM flagged GROUP BY 1")
def reason_histogram(spark, sf_dir):
    return flagged_segments(spark, sf_dir).groupBy(F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("n"))


@query(f"""WITH {SQL_SEGMENTS} SELECT doc_id, count(*) AS n_dropped, string_agg(DISTINCT reason, ', ' ORDER BY reason) AS reasons
FROM flagged WHERE reason IS NOT NULL AND reason <> 'kosong' GROUP BY doc_id""")
def dropped_summary(spark, sf_dir):
    gone = report.dropped(F.col("segments"))
    rows = records(spark, sf_dir).select("doc_id", F.size(gone).cast("long").alias("n_dropped"), F.array_join(F.array_sort(F.array_distinct(F.transform(gone, lambda s: s["hallucination"]))), ", ").alias("reasons"))
    return rows.where("n_dropped > 0")


@query(f"WITH {SQL_SEGMENTS} SELECT doc_id, seg, round(c / n::DOUBLE, 4) AS share FROM flagged WHERE n >= 5")
def prompt_copy_share(spark, sf_dir):
    p, w = prompt_words(spark, sf_dir), T.words("text")
    return segments(spark, sf_dir).where(F.size(w) >= 5).select("doc_id", "seg", F.round(F.size(F.filter(w, lambda x: x.isin(p))) / F.size(w), 4).alias("share"))


@query(f"""WITH {SQL_SEGMENTS}, steps AS (SELECT *, CASE WHEN lag(text) OVER w IS NOT DISTINCT FROM text THEN 0 ELSE 1 END AS new FROM flagged WINDOW w AS (PARTITION BY doc_id ORDER BY seg)),
isles AS (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY seg) AS isle FROM steps)
SELECT doc_id, seg, count(*) OVER (PARTITION BY doc_id, isle) >= 3 AS repeated, n BETWEEN 1 AND 4 AND c = n AS prompt_only FROM isles""")
def leak_audit_runs(spark, sf_dir):
    rows = segments(spark, sf_dir).withColumn("duration", F.lit(None).cast("double"))
    return transcript.audit(rows, prompt_words(spark, sf_dir), "doc_id").drop("past_end")


@query(f"WITH {SQL_SEGMENTS} SELECT doc_id, bool_or(reason IN ('berulang', 'salinan_prompt') AND reason IS NOT NULL) AS leaked FROM flagged GROUP BY doc_id")
def prompt_leaks(spark, sf_dir):
    return records(spark, sf_dir).select("doc_id", transcript.prompt_leaked(F.lit("prompt"), F.col("segments")).alias("leaked"))


@query(f"""WITH {SQL_SEGMENTS} SELECT source, count(*) FILTER (WHERE status = 'done') AS done, count(*) FILTER (WHERE status = 'suspect_hallucination') AS suspect_hallucination,
count(*) FILTER (WHERE status = 'no_speech') AS no_speech, sum(n_dropped)::BIGINT AS flagged, sum(len(list_filter(string_split(transcript, ' '), lambda x: x <> '')))::BIGINT AS words, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM flagged WHERE reason IN ('berulang', 'salinan_prompt'))) AS leaked
FROM statused JOIN documents USING (doc_id) GROUP BY source""")
def variant_comparison(spark, sf_dir):
    rows = records(spark, sf_dir).withColumn("flagged", F.size(report.dropped(F.col("segments"))).cast("long")).withColumn("words", T.space_word_count("transcript").cast("long"))
    rows = rows.withColumn("leaked", transcript.prompt_leaked(F.lit("prompt"), F.col("segments")))
    return report.variants(rows.join(_t(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id"), "source", "transcript_status", "flagged", "words", "leaked")


# --- append logs -----------------------------------------------------------------------------------------------------


def log(spark, sf_dir):
    return _t(spark, sf_dir, "events").select(F.col("user_id").alias("_id"), F.struct("ts", "event_id").alias("line_no"), "ts", "event_id", "event_type", F.when(F.col("event_type") == "click", F.concat(F.lit("f"), F.col("event_id").cast("string"))).alias("file"), "value")


_LATEST = """WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events {w}) SELECT user_id AS _id, event_id, event_type FROM r WHERE k = 1"""


@query(_LATEST.format(w=""))
def latest_manifest_any(spark, sf_dir):
    return latest.latest(log(spark, sf_dir)).select("_id", "event_id", "event_type")


@query(_LATEST.format(w="WHERE event_type = 'click'"))
def latest_manifest_with_file(spark, sf_dir):
    return latest.latest(log(spark, sf_dir), with_file=True).select("_id", "event_id", "event_type")


@query("SELECT doc_id, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_pending(spark, sf_dir):
    return latest.pending(_t(spark, sf_dir, "documents"), _t(spark, sf_dir, "labels"), "doc_id").select("doc_id", "source")


@query("SELECT event_id, event_type FROM events WHERE event_type IS DISTINCT FROM 'error'")
def retry_queue(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").withColumn("transcript_status", F.when(F.col("event_type") == "error", "failed").otherwise(F.col("event_type")))
    return latest.without_failed(rows).select("event_id", "event_type")


@query("""SELECT d.doc_id, CASE WHEN d.doc_id % 13 = 0 THEN 'no_audio' WHEN coalesce(l.quality = 1 AND round((d.doc_id % 30) / 10.0::DOUBLE, 1) < 1.0, false) THEN 'no_speech' ELSE 'to_transcribe' END AS status
FROM documents d LEFT JOIN labels l USING (doc_id)""")
def gate_cascade(spark, sf_dir):
    vad = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("v"), F.when(F.col("quality") == 1, "ok").otherwise("no_audio").alias("vad_status"))
    rows = _t(spark, sf_dir, "documents").join(vad, F.col("doc_id") == F.col("v"), "left")
    stop = transcript.gated(F.col("vad_status"), F.round((F.col("doc_id") % 30) / 10.0, 1))
    return rows.select("doc_id", F.when(F.col("doc_id") % 13 == 0, transcript.NO_AUDIO).when(stop, transcript.NO_SPEECH).otherwise("to_transcribe").alias("status"))


@query("SELECT doc_id AS _id, coalesce(d.text, '') AS content FROM documents d WHERE doc_id IN (SELECT item_id FROM benchmark) AND source IS NOT NULL")
def sidecar_multi_get(spark, sf_dir):
    posts = _t(spark, sf_dir, "documents").select(F.col("source").alias("_index"), F.col("doc_id").alias("_id"), F.col("text").alias("content"))
    ids = _t(spark, sf_dir, "benchmark").select(F.col("item_id").alias("_id"))
    return latest.multi_get(posts, posts.select("_index", "_id").join(ids, "_id"))


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN CASE WHEN l.toxic = 1 THEN '' ELSE 'cached ' || l.quality END ELSE coalesce(d.text, '') END AS caption FROM documents d LEFT JOIN labels l USING (doc_id)")
def caption_precedence(spark, sf_dir):
    cache = _t(spark, sf_dir, "labels").select("doc_id", F.when(F.col("toxic") == 1, "").otherwise(F.concat(F.lit("cached "), F.col("quality").cast("string"))).alias("text"))
    docs = _t(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    return latest.captions(docs, cache, "doc_id").select("doc_id", "caption")


@query("SELECT d.doc_id, d.source || '_' || d.doc_id AS source_file, CASE WHEN l.quality = 1 THEN d.source || '_' || d.doc_id || '.wav' END AS file FROM documents d LEFT JOIN labels l USING (doc_id)")
def derived_manifest(spark, sf_dir):
    m = _t(spark, sf_dir, "documents").select("doc_id", T.media_stem("source", F.col("doc_id").cast("string")).alias("file"))
    stats = _t(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "ok").otherwise("no_audio").alias("status"))
    return latest.derived_manifest(m, stats, "doc_id").select("doc_id", "source_file", "file")


# --- reports ---------------------------------------------------------------------------------------------------------

SPOKEN, NAME = "the", "and"
_DOC_STATUS = "CASE WHEN doc_id % 7 = 0 THEN 'failed' WHEN doc_id % 5 = 0 THEN 'no_speech' WHEN doc_id % 11 = 0 THEN 'other' ELSE 'done' END"


def report_base(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("_id"), F.expr(_DOC_STATUS).alias("transcript_status"), F.when(F.col("doc_id") % 9 != 0, F.col("source")).alias("created_at"), F.col("doc_id").alias("line_no"),
        F.col("text").alias("transcript"), F.col("lang").alias("transcript_lang"), F.when(F.col("doc_id") % 4 != 0, "en").alias("lang"),
    )


SQL_REPORT = f"""
base AS (SELECT doc_id AS _id, {_DOC_STATUS} AS status, CASE WHEN doc_id % 9 <> 0 THEN source END AS created_at, text AS transcript, lang AS transcript_lang, CASE WHEN doc_id % 4 <> 0 THEN 'en' END AS lang FROM documents),
nos AS (SELECT *, row_number() OVER (ORDER BY CASE status WHEN 'done' THEN 0 WHEN 'suspect_hallucination' THEN 1 WHEN 'no_speech' THEN 2 WHEN 'no_audio' THEN 3 WHEN 'failed' THEN 4 ELSE 9 END, coalesce(created_at, ''), _id) AS no FROM base),
firsts AS (SELECT *, first_value(_id) OVER (PARTITION BY substr(coalesce(transcript, ''), 1, 120) ORDER BY no) AS f FROM nos WHERE status = 'done'),
dups AS (SELECT _id, CASE WHEN f <> _id THEN f END AS duplicate_of FROM firsts)"""


@query(f"WITH {SQL_REPORT} SELECT no, _id, status FROM nos")
def report_order(spark, sf_dir):
    return report.numbered(report_base(spark, sf_dir), *report.report_key()).select("no", "_id", F.col("transcript_status").alias("status"))


@query(f"WITH {SQL_REPORT} SELECT _id, duplicate_of FROM dups WHERE duplicate_of IS NOT NULL")
def first_seen_duplicates(spark, sf_dir):
    rows = report.numbered(report_base(spark, sf_dir), *report.report_key()).where("transcript_status = 'done'")
    return report.first_seen(rows, "transcript").where("duplicate_of is not null").select("_id", "duplicate_of")


@query(f"""WITH {SQL_REPORT} SELECT n._id, CASE WHEN n.status <> 'done' THEN '' ELSE concat_ws('; ',
 CASE WHEN len(list_filter(regexp_split_to_array(coalesce(transcript, ''), '[\\s\\x{{A0}}]+'), lambda x: x <> '')) <= 3 THEN '{report.NOTE_SHORT}' END,
 CASE WHEN transcript_lang IS DISTINCT FROM lang THEN 'Bahasa beda dari caption (' || coalesce(lang, 'None') || ')' END,
 CASE WHEN duplicate_of IS NOT NULL THEN 'Duplikat isi dengan _id ' || duplicate_of || ' (reupload)' END) END AS notes FROM nos n LEFT JOIN dups USING (_id)""")
def notes(spark, sf_dir):
    rows = report.numbered(report_base(spark, sf_dir), *report.report_key())
    first = report.first_seen(rows.where("transcript_status = 'done'"), "transcript").select(F.col("_id").alias("d"), "duplicate_of")
    rows = rows.join(first, F.col("_id") == F.col("d"), "left")
    return rows.select("_id", report.notes(rows).alias("notes"))


_ROLE = """CASE WHEN l.quality = 1 AND l.toxic = 1 THEN 'pembicara' WHEN contains(lower(coalesce(d.text, '')), 'ablé') OR contains(lower(coalesce(d.text, '')), 'moron') THEN 'dibicarakan'
 WHEN contains(lower(d.source), '1') THEN 'hanya_caption' ELSE 'tidak_disebut' END"""


def roles(spark, sf_dir):
    speakers = _t(spark, sf_dir, "labels").select(F.col("doc_id").alias("k"), F.when((F.col("quality") == 1) & (F.col("toxic") == 1), "ya").otherwise("tidak").alias("verdict"))
    rows = _t(spark, sf_dir, "documents").join(speakers, F.col("doc_id") == F.col("k"), "left")
    return rows.withColumn("role", report.role(F.col("verdict"), T.has_substring("text", "ablé", "moron"), F.col("source"), "1"))


@query(f"""WITH {SQL_REPORT} SELECT n.no, n._id, n.status, coalesce(n.created_at, '') AS created_at, {_ROLE} AS role, CASE WHEN l.doc_id IS NULL THEN 'tanpa_ucapan' WHEN l.quality = 1 AND l.toxic = 1 THEN 'ya' ELSE 'tidak' END AS voice
FROM nos n JOIN documents d ON d.doc_id = n._id LEFT JOIN labels l ON l.doc_id = n._id""")
def report_rows(spark, sf_dir):
    rows = report.numbered(report_base(spark, sf_dir), *report.report_key())
    r = roles(spark, sf_dir).select("doc_id", "role", F.coalesce("verdict", F.lit("tanpa_ucapan")).alias("voice"))
    return rows.join(r, F.col("_id") == F.col("doc_id")).select("no", "_id", F.col("transcript_status").alias("status"), F.coalesce("created_at", F.lit("")).alias("created_at"), "role", "voice")


@query(f"""WITH r AS (SELECT {_ROLE} AS role FROM documents d LEFT JOIN labels l USING (doc_id)), names AS (SELECT unnest(['pembicara', 'dibicarakan', 'hanya_caption', 'tidak_disebut']) AS role),
f AS (SELECT names.role, count(r.role) AS n FROM names LEFT JOIN r USING (role) GROUP BY 1) SELECT role, n FROM f UNION ALL SELECT 'total', sum(n)::BIGINT FROM f""")
def role_counts(spark, sf_dir):
    return report.count_over(roles(spark, sf_dir), "role", report.ROLES).select(F.col("value").alias("role"), "n")


@query(r"SELECT doc_id, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\s\x{85}\x{A0}\x{2000}-\x{200A}\x{2028}\x{2029}\x{3000}]+'), lambda x: x <> ''))::INT AS n_words FROM documents")
def word_counts_a(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.word_count("text").alias("n_words"))


@query("SELECT doc_id, CASE WHEN t = '' THEN 0 ELSE length(t) - length(replace(t, ' ', '')) + 1 END::INT AS n_words FROM (SELECT doc_id, trim(regexp_replace(coalesce(text, ''), ' +', ' ', 'g'), ' ') AS t FROM documents)")
def word_counts_b(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", T.space_word_count("text").cast("int").alias("n_words"))


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(coalesce(text, ''), '(?i)\bthe\b|all rights') THEN 'ya' ELSE 'tidak' END AS word, CASE WHEN regexp_matches(coalesce(text, ''), '(?i)and|moron') THEN 'ya' ELSE 'tidak' END AS part,
CASE WHEN contains(lower(coalesce(text, '')), 'idiot') THEN 'ya' ELSE 'tidak' END AS sub FROM documents""")
def mention_flags(spark, sf_dir):
    d = _t(spark, sf_dir, "documents")
    return d.select("doc_id", T.yes_no(T.mentions("text", r"\bthe\b|all rights")).alias("word"), T.yes_no(T.mentions("text", "and|moron")).alias("part"), T.yes_no(T.has_substring("text", "idiot")).alias("sub"))


@query("""SELECT round(sum(value) / 60, 4) AS audio_minutes, round(sum(value / 2) FILTER (WHERE value > 0 AND event_type <> 'error') / 60, 4) AS work_minutes,
round(coalesce(sum(value) / sum(value / 2) FILTER (WHERE value > 0 AND event_type <> 'error'), 0), 4) AS speed FROM events""")
def speed_metrics(spark, sf_dir):
    rows = _t(spark, sf_dir, "events").select(F.col("value").alias("transcript_duration"), F.when(F.col("event_type") != "error", F.col("value") / 2).alias("process_seconds"))
    return report.speed(rows).select(*[F.round(c, 4).alias(c) for c in ("audio_minutes", "work_minutes", "speed")])


@query("SELECT lang, coalesce(bool_and(contains(lower(coalesce(text, '')), 'e') AND contains(lower(coalesce(text, '')), 'n')), true) AS all_match FROM documents GROUP BY lang")
def all_captions_match(spark, sf_dir):
    return report.all_match(_t(spark, sf_dir, "documents"), "text", "e", "n", by=["lang"])


@query("SELECT o_orderkey, replace(printf('%.1f', round(o_totalprice, 1)), '.', ',') AS price, replace(coalesce(o_orderpriority, ''), chr(13), ' ') AS priority FROM orders")
def decimal_comma_export(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select("o_orderkey", T.decimal_comma("o_totalprice").alias("price"), T.no_carriage_return("o_orderpriority").alias("priority"))


@query("""WITH t AS (SELECT *, list_distinct([url, replace(url, 'http', 'HTTP'), url || '.mp4']) AS x FROM pages)
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url WHEN page_id % 3 = 1 THEN url || '.mp4' END AS media_url, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host FROM t""")
def pick_media_url(spark, sf_dir):
    u = F.col("url")
    urls = F.when(F.col("page_id") % 3 == 0, F.array(u, u)).when(F.col("page_id") % 3 == 1, F.array(u, u, F.concat(u, F.lit(".mp4"))))
    return _t(spark, sf_dir, "pages").select("page_id", T.pick_media_url(urls).alias("media_url"), T.host("url").alias("host"))


# --- search ----------------------------------------------------------------------------------------------------------

BODY = {"query": {"bool": {"must": [{"simple_query_string": {"query": "the + moron", "fields": ["text"]}}, {"term": {"lang": {"value": "en"}}}]}}, "sort": [{"n_chars": "desc"}]}
_TOKENS = r"regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+')"


@query(f"SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND list_contains({_TOKENS}, 'the') AND list_contains({_TOKENS}, 'moron')")
def search_posts(spark, sf_dir):
    return search.search(_t(spark, sf_dir, "documents"), BODY, tie="doc_id", size=0).select("doc_id", "n_chars")


@query(f"SELECT doc_id, n_chars FROM documents WHERE lang = 'en' AND list_contains({_TOKENS}, 'the') AND list_contains({_TOKENS}, 'moron') ORDER BY n_chars DESC, doc_id LIMIT 30")
def search_topk(spark, sf_dir):
    return search.search(_t(spark, sf_dir, "documents"), BODY, tie="doc_id").select("doc_id", "n_chars")


@query("SELECT o_orderkey FROM orders WHERE o_orderdate >= DATE '1996-03-13' AND o_orderdate < DATE '1996-06-21' AND o_orderstatus = 'O'")
def date_range_day(spark, sf_dir):
    body = {"query": {"bool": {"must": [{"range": {"o_orderdate": {"gte": "13-03-1996", "lte": "20-06-1996", "format": "dd-MM-yyyy"}}}, {"term": {"o_orderstatus": "O"}}]}}}
    return search.search(_t(spark, sf_dir, "orders"), body, tie="o_orderkey", size=0).select("o_orderkey")


# --- media time of conversations -------------------------------------------------------------------------------------


def clips(spark, sf_dir):
    """conv_id, seg, role, text, start_ms, end_ms."""
    by = Window.partitionBy("conv_id").orderBy("turn")
    ms = F.length(T.text_of("text")).cast("long") * 60
    c = _t(spark, sf_dir, "conversations").withColumn("end_ms", F.sum(ms).over(by)).withColumn("start_ms", F.col("end_ms") - ms)
    return c.withColumn("seg", F.col("turn").cast("int"))


SQL_CLIPS = """clips AS (SELECT *, (end_ms - length(coalesce(text, '')) * 60)::BIGINT AS start_ms FROM (SELECT *, (sum(length(coalesce(text, '')) * 60) OVER (PARTITION BY conv_id ORDER BY turn))::BIGINT AS end_ms FROM conversations))"""


@query(f"""WITH {SQL_CLIPS}, n AS (SELECT *, greatest(ceil((end_ms - start_ms - 3000) / 1500.0::DOUBLE), 0)::INT AS m FROM clips WHERE end_ms - start_ms >= 1000), w AS (SELECT *, unnest(range(0, m + 1))::INT AS k FROM n)
SELECT conv_id, turn, k, start_ms + 1500 * k AS win_start, least(start_ms + 1500 * k + 3000, end_ms) AS win_end FROM w""")
def sliding_windows(spark, sf_dir):
    rows = clips(spark, sf_dir).where("end_ms - start_ms >= 1000")
    return windows.sliding(rows, 3000, 1500, "start_ms", "end_ms").select("conv_id", "turn", "k", "win_start", "win_end")


@query(f"WITH {SQL_CLIPS} SELECT conv_id, turn, greatest(ceil((end_ms - start_ms - 3000) / 1500.0::DOUBLE), 0)::BIGINT + 1 AS n FROM clips WHERE end_ms - start_ms >= 1000")
def windows_per_segment(spark, sf_dir):
    return sliding_windows(spark, sf_dir).groupBy("conv_id", "turn").agg(F.count("*").alias("n"))


@query(f"""WITH {SQL_CLIPS}, spans AS (SELECT conv_id, greatest(start_ms - 200, 0) AS s, start_ms + (end_ms - start_ms) // 2 + (turn % 3) * 2000 AS e FROM clips),
b AS (SELECT *, max(e) OVER (PARTITION BY conv_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pe FROM spans),
i AS (SELECT *, sum(CASE WHEN pe >= s THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id ORDER BY s, e) AS isle FROM b),
m AS (SELECT conv_id, isle, max(e) - min(s) AS len FROM i GROUP BY 1, 2) SELECT conv_id, sum(len)::BIGINT AS speech_ms, count(*) AS spans FROM m GROUP BY 1""")
def speech_union_seconds(spark, sf_dir):
    c = clips(spark, sf_dir)
    spans = c.select("conv_id", F.greatest(F.col("start_ms") - 200, F.lit(0)).alias("start"), (F.col("start_ms") + F.expr("(end_ms - start_ms) div 2") + (F.col("turn") % 3) * 2000).alias("end"))
    return windows.merged(spans, "conv_id").groupBy("conv_id").agg(F.sum(F.col("end") - F.col("start")).alias("speech_ms"), F.count("*").alias("spans"))


@query(f"""WITH {SQL_CLIPS}, q AS (SELECT *, start_ms // 1000 AS s FROM clips WHERE role = 'assistant')
SELECT conv_id, string_agg('[' || s // 60 || ':' || lpad((s % 60)::VARCHAR, 2, '0') || '] ' || coalesce(text, ''), chr(10) ORDER BY turn) AS quotes FROM q GROUP BY conv_id""")
def mmss_quotes(spark, sf_dir):
    line = F.concat(F.lit("["), T.mmss(F.floor(F.col("start_ms") / 1000)), F.lit("] "), T.text_of("text"))
    rows = clips(spark, sf_dir).where("role = 'assistant'").select("conv_id", "turn", line.alias("line"))
    return rows.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "line"))), lambda s: s["line"]), "\n").alias("quotes"))


@query(f"""WITH {SQL_CLIPS} , s AS (SELECT conv_id, coalesce(sum(end_ms - start_ms) FILTER (WHERE role = 'user'), 0) / 1000.0::DOUBLE AS t, sum(end_ms - start_ms) / 1000.0::DOUBLE AS a FROM clips GROUP BY conv_id)
SELECT conv_id, round(t, 1) AS target_seconds, round(a, 1) AS speech_seconds, CASE WHEN round(a, 1) <> 0 THEN round(round(t, 1) / round(a, 1), 3) ELSE 0 END AS target_share, CASE WHEN round(t, 1) >= 3 THEN 'ya' ELSE 'tidak' END AS verdict FROM s""")
def talk_time_by_role(spark, sf_dir):
    # Whole milliseconds are summed, so that the order of rows can't change the result.
    rows = clips(spark, sf_dir).select("conv_id", F.col("start_ms").alias("start"), F.col("end_ms").alias("end"), F.when(F.col("role") == "user", "target").alias("label"))
    return voices.talk_time(rows, "conv_id", 1000.0)


def voiced_clips(spark, sf_dir):
    c = clips(spark, sf_dir)
    return c.select("conv_id", "seg", F.floor(F.col("start_ms") / 1000).alias("start"), "start_ms", "end_ms", T.text_of("text").alias("text"), (F.expr("length(coalesce(text, '')) div 40") % 3).cast("int").alias("voice"))


@query(f"""WITH {SQL_CLIPS}, v AS (SELECT *, start_ms // 1000 AS start, ((length(coalesce(text, '')) // 40) % 3)::INT AS voice FROM clips),
s AS (SELECT conv_id, voice, sum(end_ms - start_ms) / 1000.0::DOUBLE AS seconds, min(turn) AS first FROM v GROUP BY 1, 2),
m AS (SELECT *, CASE WHEN seconds >= 20 THEN row_number() OVER (PARTITION BY conv_id, seconds >= 20 ORDER BY first) END AS number FROM s),
n AS (SELECT v.*, coalesce('Pembicara ' || number, 'Pembicara ?') || CASE WHEN v.voice = 1 THEN ' (mirip target)' ELSE '' END AS name FROM v JOIN m USING (conv_id, voice)),
g AS (SELECT *, CASE WHEN lag(name) OVER (PARTITION BY conv_id ORDER BY turn) IS NOT DISTINCT FROM name THEN 0 ELSE 1 END AS new FROM n),
i AS (SELECT *, sum(new) OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS t FROM g)
SELECT conv_id, t::INT AS turn, min(start) AS start, any_value(name) AS name, string_agg(coalesce(text, ''), ' ' ORDER BY i.turn) AS text FROM i GROUP BY conv_id, t""")
def speaker_turns(spark, sf_dir):
    v = voiced_clips(spark, sf_dir)
    seconds = v.groupBy("conv_id", "voice").agg((F.sum(F.col("end_ms") - F.col("start_ms")) / 1000.0).alias("seconds")).withColumn("label", F.when(F.col("voice") == 1, "target").otherwise("lain"))
    return turns.turns(v.withColumn("match_voice", F.lit(None).cast("int")), seconds, "conv_id", main_seconds=20.0)


@query("""WITH c AS (SELECT user_id, length(event_type) AS voice, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, voice::INT AS voice, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, voice) AS k FROM c) WHERE k = 1""")
def segment_voice_mode(spark, sf_dir):
    return voices.mode_low(_t(spark, sf_dir, "events").select("user_id", F.length("event_type").alias("voice")), ["user_id"], "voice").select("user_id", "voice", "n")


# --- embeddings ------------------------------------------------------------------------------------------------------


def reference(spark, sf_dir) -> list[float]:
    """The voiceprint: the vector of the smallest id."""
    return _t(spark, sf_dir, "embeddings").orderBy("vec_id").first()["embedding"]


_D = "embedding::DOUBLE[]"


@query(f"SELECT e.vec_id, round(list_dot_product(e.{_D}, r.{_D}), 4) AS sim FROM embeddings e, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) r")
def window_ref_similarity(spark, sf_dir):
    ref = F.array(*[F.lit(float(x)) for x in reference(spark, sf_dir)])
    return _t(spark, sf_dir, "embeddings").select("vec_id", F.round(voices.dot(F.col("embedding"), ref), 4).alias("sim"))


SQL_CENTROIDS = """flat AS (SELECT label, unnest(range(64)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT label, pos, avg(x) AS m, count(*) AS n FROM flat GROUP BY 1, 2), cents AS (SELECT label, list(m ORDER BY pos) AS c, max(n) AS windows FROM means GROUP BY 1)"""


@query(f"""WITH {SQL_CENTROIDS} SELECT label, windows, round(list_dot_product(c, {_D}) / sqrt(list_dot_product(c, c)), 3) AS sim,
CASE WHEN list_dot_product(c, {_D}) / sqrt(list_dot_product(c, c)) >= 0.45 THEN 'target' ELSE 'lain' END AS voice FROM cents, (SELECT embedding FROM embeddings ORDER BY vec_id LIMIT 1) r""")
def voice_centroids(spark, sf_dir):
    c = voices.centroids(_t(spark, sf_dir, "embeddings").withColumnRenamed("label", "k"), ["k"])
    return voices.score(c, reference(spark, sf_dir)).select(F.col("k").alias("label"), "windows", "sim", F.col("label").alias("voice"))


@query(f"""WITH {SQL_CENTROIDS}, s AS (SELECT vec_id, cents.label AS v, list_dot_product({_D}, c) / sqrt(list_dot_product(c, c)) AS sim FROM embeddings, cents),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, v DESC) AS k, lead(sim) OVER (PARTITION BY vec_id ORDER BY sim DESC, v DESC) AS second FROM s)
SELECT vec_id, v AS match_voice, round(sim, 3) AS match_sim FROM r WHERE k = 1 AND sim >= 0.30 AND sim - coalesce(second, -1) >= 0.10""")
def short_match_margin(spark, sf_dir):
    e = _t(spark, sf_dir, "embeddings").withColumn("clip", F.lit(0))
    c = voices.centroids(e, ["clip", "label"]).withColumnRenamed("label", "voice")
    return voices.match_short(e, c, "clip", "vec_id", least=0.30).select("vec_id", "match_voice", "match_sim")


PAIR_SIM = 0.30


def _pairs(spark, sf_dir, least: float):
    """Pairs of vectors of one label: blocks are labels, so no vector meets all others."""
    e = _t(spark, sf_dir, "embeddings")
    x, y = (e.select("label", F.col("vec_id").alias(n), F.col("embedding").alias(f"e{n}")) for n in "ab")
    sim = voices.dot(F.col("ea"), F.col("eb"))
    return x.join(y, "label").where("a < b").withColumn("sim", sim).where(F.col("sim") >= least).select("a", "b", F.round("sim", 4).alias("sim"))


_PAIRS = f"SELECT x.vec_id AS a, y.vec_id AS b, round(list_dot_product(x.{_D}, y.{_D}), 4) AS sim FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id < y.vec_id WHERE list_dot_product(x.{_D}, y.{_D}) >= {PAIR_SIM}"


@query(_PAIRS)
def similar_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir, PAIR_SIM)


@query(f"""WITH RECURSIVE p AS ({_PAIRS}), e AS (SELECT a, b FROM p UNION SELECT b, a FROM p), reach(n, m) AS (SELECT a, a FROM e UNION SELECT r.n, e.b FROM reach r JOIN e ON e.a = r.m)
SELECT n AS node, min(m) AS root FROM reach GROUP BY n""")
def similar_components(spark, sf_dir):
    return similar.similar_components(_t(spark, sf_dir, "embeddings"), "label", "vec_id", "embedding", PAIR_SIM).select("node", "root")


@query()
def diarize_clips(spark, sf_dir):
    """Each label's vectors as one clip's windows."""
    return voices.diarize(_t(spark, sf_dir, "embeddings"), "label", "vec_id")


@query()
def dominant_voice(spark, sf_dir):
    rows = voices.enroll(_t(spark, sf_dir, "embeddings"), "label", "vec_id", threshold=0.3)
    return rows.groupBy("label").agg(F.count("*").alias("windows"), F.count_if("member").alias("used"), F.round(F.min(F.when(F.col("member"), F.col("sim"))), 3).alias("least"), F.round(F.expr("percentile(sim, 0.5) FILTER (WHERE member)"), 3).alias("median"))


# --- audio fingerprints ----------------------------------------------------------------------------------------------


def fingerprints(spark, sf_dir):
    """Words of benchmark items as 32-bit values; every second item also without its first two, as a trimmed copy."""
    w = F.filter(F.split(F.regexp_replace(T.text_of("text"), r"\s+", " "), " "), lambda x: x != "")
    value = F.transform(w, lambda x: F.conv(F.substring(F.md5(x), 1, 8), 16, 10).cast("bigint"))
    b = _t(spark, sf_dir, "benchmark").select("item_id", value.alias("fp"))
    copies = b.where("item_id % 2 = 0").select((F.col("item_id") + 1_000_000).alias("_id"), F.expr("slice(fp, 3, size(fp))").alias("fp"))
    return b.select(F.col("item_id").alias("_id"), "fp").union(copies)


SQL_FP = r"""w AS (SELECT item_id, list_filter(string_split(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'), ' '), lambda x: x <> '') AS l FROM benchmark),
b AS (SELECT item_id, list_transform(l, lambda x: ('0x' || md5(x)[1:8])::BIGINT) AS fp FROM w), fps AS (SELECT item_id AS _id, fp FROM b UNION ALL SELECT item_id + 1000000, fp[3:] FROM b WHERE item_id % 2 = 0)"""


@query(f"""WITH {SQL_FP}, flat AS (SELECT _id, unnest(range(len(fp))) AS i, unnest(fp) AS v FROM fps),
c AS (SELECT x._id AS a, y._id AS b FROM (SELECT DISTINCT _id, v FROM flat) x JOIN (SELECT DISTINCT _id, v FROM flat) y ON x.v = y.v AND x._id < y._id GROUP BY 1, 2 HAVING count(*) >= 10),
o AS (SELECT c.a, c.b, x.i - y.i AS lag, count(*) AS overlap, sum(bit_count(xor(x.v, y.v))) AS wrong FROM c JOIN flat x ON x._id = c.a JOIN flat y ON y._id = c.b GROUP BY 1, 2, 3 HAVING count(*) >= 10),
r AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY wrong / (32.0::DOUBLE * overlap), lag) AS k FROM o)
SELECT a, b, round(wrong / (32.0::DOUBLE * overlap), 3) AS ber, lag::INT AS lag, overlap::INT AS overlap FROM r WHERE k = 1 AND wrong / (32.0::DOUBLE * overlap) <= 0.2""")
def fingerprint_alignment(spark, sf_dir):
    f = fingerprints(spark, sf_dir)
    pairs = audio_dedup.candidates(f, least=10)
    return audio_dedup.alignments(pairs, f, item=1.0, min_overlap=10).withColumn("ber", F.round("ber", 3))


@query(SQL["fingerprint_alignment"])
def fingerprint_alignment_native(spark, sf_dir):
    f = fingerprints(spark, sf_dir)
    found = audio_dedup.native_alignments(audio_dedup.candidates(f, least=10), f, min_values=10)
    return found.where("ber <= 0.2").withColumn("ber", F.round("ber", 3))


@query()
def transcript_ratio(spark, sf_dir):
    """Texts of documents whose first 120 characters are equal."""
    rows = report.numbered(report_base(spark, sf_dir), *report.report_key()).where("transcript_status = 'done'")
    pairs = report.first_seen(rows, "transcript").where("duplicate_of is not null").select(F.col("duplicate_of").alias("a"), F.col("_id").alias("b"))
    return audio_dedup.with_texts(pairs, rows.select("_id", "transcript"))


@query("SELECT doc_id, doc_id % 3 = 0 AS has_audio FROM documents")
def audio_track_predicate(spark, sf_dir):
    """Bytes with and without a sound track's handler box."""
    data = F.when(F.col("doc_id") % 3 == 0, F.lit(b"\x00\x00hdlr\x00\x00\x00\x00\x0a\x00\x00\x00soun")).otherwise(F.lit(b"hdlrvide"))
    return _t(spark, sf_dir, "documents").select("doc_id", transcript.has_audio_track(data).alias("has_audio"))


# --- event time ------------------------------------------------------------------------------------------------------


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g)
SELECT min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", user_id, count(*) AS n FROM i GROUP BY user_id, s""")
def event_sessions(spark, sf_dir):
    return incremental.sessions(_t(spark, sf_dir, "events"), "ts", "30 minutes", "user_id")


@query("""WITH s AS (SELECT event_type, time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE * k AS start FROM events, (SELECT unnest([0, 1]) AS k)) SELECT start, start + INTERVAL 10 MINUTE AS "end", event_type, count(*) AS n FROM s GROUP BY ALL""")
def event_sliding(spark, sf_dir):
    return incremental.sliding(_t(spark, sf_dir, "events"), "ts", "10 minutes", "5 minutes", "event_type")


from sonarloom.plans import more as _more  # noqa: E402, F401  registers its queries
