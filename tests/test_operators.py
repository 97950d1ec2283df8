"""Edge cases of operators on small inline tables."""

import json
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonarloom import models, schemas, workspace
from sonarloom.functions import text as T
from sonarloom.operators import audio_dedup, latest, report, similar, transcript, turns, voices, windows
from sonarloom.operators.components import components
from sonarloom.sinks import files as sinks
from sonarloom.sources import files, search

PROMPT = ["makan", "gizi", "sppg"]


@pytest.mark.parametrize(
    "text, start, duration, reason",
    [
        ("", 0.0, None, "kosong"), ("...", 0.0, None, "kosong"), ("halo", 5.0, 5.0, "di_luar_audio"), ("halo", 4.9, 5.0, None), ("halo", 5.0, 0.0, None), ("halo", 5.0, None, None),
        (" Terima kasih. ", 0.0, None, "frasa_umum"), ("Thank you!", 0.0, None, "frasa_umum"), ("Speaker 12", 0.0, None, "frasa_umum"), ("terima kasih semua", 0.0, None, None),
        ("a b a b a b a", 0.0, None, None), ("a b a b a b a b", 0.0, None, "berulang"), ("a b c d a b c d a b", 0.0, None, None), ("a b c d a b c d a a", 0.0, None, None), ("a b c a b c a b", 0.0, None, "berulang"),
        ("makan gizi sppg makan", 0.0, None, None), ("makan gizi sppg makan x", 0.0, None, "salinan_prompt"), ("makan gizi sppg y x", 0.0, None, None),
    ],
)
def test_reason(spark, text, start, duration, reason):
    df = spark.createDataFrame([(text, start, duration)], "t string, s double, d double")
    assert df.select(transcript.reason(F.col("t"), F.col("s"), F.col("d"), PROMPT)).first()[0] == reason


def record(spark, segments, **more):
    seg = [(0.0, 1.0, t, p, None, None, None) for t, p in segments] if segments is not None else None
    row = {"_id": "x", "segments": seg, "transcript": more.get("transcript"), "transcript_status": more.get("status"), "transcript_duration": None, "transcript_raw": None}
    return spark.createDataFrame([row], schemas.of(f"_id string, segments array<struct<{schemas.SEGMENT}>>, transcript string, transcript_status string, transcript_duration double, transcript_raw string"))


@pytest.mark.parametrize(
    "segments, status, text",
    [
        ([("halo dunia", None)], "done", "halo dunia"), ([("halo", 0.59)], "done", "halo"), ([("halo", 0.6)], "no_speech", "halo"), ([("terima kasih", 0.1)], "suspect_hallucination", ""),
        ([("...", 0.1)], "no_speech", ""), ([("terima kasih", 0.7), ("halo", 0.9)], "no_speech", "halo"), ([], "no_speech", ""), (None, "done", "old"),
    ],
)
def test_reclassify(spark, segments, status, text):
    once = transcript.reclassify(record(spark, segments, transcript="old", status="done"), PROMPT)
    got = once.first()
    assert (got["transcript_status"], got["transcript"]) == (status, text)
    assert got["transcript_raw"] == (None if segments is None else "old")
    assert transcript.reclassify(once, PROMPT).first() == got


def test_cascade_never_transcribes_gated_clips(spark):
    clips = spark.createDataFrame([("a", False, None, None), ("b", True, "ok", 0.9), ("c", True, "ok", 1.0), ("d", True, None, None), ("e", True, "ok", 5.0)], "_id string, has_audio boolean, vad_status string, vad_speech_seconds double")

    def fake(df, prompt):
        assert_ok = F.when(F.col("_id").isin("a", "b"), F.raise_error(F.lit("gated"))).otherwise(F.col("_id"))
        text = F.when((F.col("_id") == "d") & F.lit(bool(prompt)), "makan gizi sppg makan gizi").otherwise("halo dunia")
        seg = F.array(F.struct(F.lit(0.0).alias("start"), F.lit(1.0).alias("end"), text.alias("text"), F.lit(0.1).alias("no_speech_prob"), F.lit(None).cast("string").alias("hallucination")))
        error = F.when(F.col("_id") == "e", "x" * 400)
        null = F.lit(None).cast("string")
        return df.withColumns({"_id": assert_ok, "segments": seg, "transcript": null, "transcript_raw": null, "transcript_duration": F.lit(None).cast("double"), "transcript_prompt": F.lit(prompt), "transcript_status": null, "error": error})

    got = {r["_id"]: r for r in transcript.cascade(clips, fake, "prompt", PROMPT).collect()}
    assert {k: r["transcript_status"] for k, r in got.items()} == {"a": "no_audio", "b": "no_speech", "c": "done", "d": "done", "e": "failed"}
    assert got["d"]["prompt_fallback"] and got["b"]["vad_gate"] and len(got["e"]["error"]) == 300


def test_text_functions(spark):
    df = spark.createDataFrame([("a b  c ²", None, 125.4, "k=v=w")], "t string, n string, x double, kv string")
    r = df.select(
        T.word_count("t").alias("a"), T.space_word_count("t").alias("b"), T.words("n").alias("c"), T.mmss("x").alias("d"), T.decimal_comma("x").alias("e"), T.key_value("kv").alias("f"), T.words("t").alias("g"),
        T.whole(F.lit(2.5)).alias("h"), T.percent(F.lit(0.5)).alias("i"), T.differs("n", F.lit(None)).alias("j"), T.joined(F.array(F.lit("a"), F.lit(None), F.lit("")), "; ").alias("k"), T.file_stem(F.lit("x/y/z.tar.mp4")).alias("l"),
    ).first()
    assert tuple(r)[:6] == (4, 3, [], "2:05", "125,4", ("k", "v=w")) and r["g"] == ["a", "b", "c", "²"]
    assert (r["h"], r["i"], r["j"], r["k"], r["l"]) == ("2", "50%", False, "a", "z.tar")


def test_latest_variants(spark):
    log = spark.createDataFrame([("a", "f1", 0), ("b", "f2", 1), ("a", None, 2), ("c", "", 3), ("c", "f3", 4)], "_id string, file string, line_no long")
    assert {(r["_id"], r["file"], r["first_line"]) for r in latest.latest(log).collect()} == {("a", None, 0), ("b", "f2", 1), ("c", "f3", 3)}
    assert {(r["_id"], r["file"], r["first_line"]) for r in latest.latest(log, with_file=True).collect()} == {("a", "f1", 0), ("b", "f2", 1), ("c", "f3", 4)}
    assert latest.latest(log.where("false")).count() == 0


@pytest.mark.parametrize("length, n", [(0.9, 0), (1.0, 1), (3.0, 1), (3.01, 2), (4.5, 2), (10.0, 6)])
def test_windows(spark, length, n):
    df = spark.createDataFrame([(0.0, length, "halo", None, None, 100.0)], "start double, end double, text string, no_speech_prob double, hallucination string, audio_seconds double")
    got = windows.sliding(windows.speech_segments(df)).orderBy("k").collect()
    assert len(got) == n and (not n or got[-1]["win_end"] == length)


def test_overlaps(spark):
    a = spark.createDataFrame([("x", 0.0, 2.0), ("x", 3.0, 4.0)], "k string, start double, end double")
    b = spark.createDataFrame([("x", 1.0, 3.0), ("y", 0.0, 9.0)], "k string, start double, end double")
    assert [r["overlap"] for r in windows.overlaps(a, b, "k").collect()] == [1.0]


def test_centroid_trap_stays_two_voices():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(2, 64))
    x = np.concatenate([base[0] + 0.9 * rng.normal(size=(10, 64)), base[1] + 0.9 * rng.normal(size=(6, 64))])
    assert list(voices.average_linkage(x, 0.35)) == [0] * 10 + [1] * 6
    assert list(voices.average_linkage(x[:1], 0.35)) == [0] and len(voices.average_linkage(x[:0], 0.35)) == 0
    centre, members = voices.dominant(x / np.linalg.norm(x, axis=1, keepdims=True), 0.35)
    assert members[:10].all() and not members[10:].any()


@pytest.mark.parametrize("best, second, ok", [(0.44, 0.1, False), (0.46, 0.1, True), (0.6, 0.52, False), (0.6, 0.49, True), (0.46, None, True)])
def test_match_short(spark, best, second, ok):
    unit = lambda c, k: [c, (1 - c * c) ** 0.5 if k else 0.0, 0.0 if k else (1 - c * c) ** 0.5]
    v = [("c", 0, unit(best, True))] + ([("c", 1, unit(second, False))] if second else [])
    pieces = spark.createDataFrame([("c", 7, [1.0, 0.0, 0.0])], "clip string, seg int, embedding array<double>")
    assert voices.match_short(pieces, spark.createDataFrame(v, "clip string, voice int, centroid array<double>"), "clip", "seg").count() == ok


def test_score_clips(spark):
    seg = spark.createDataFrame([("c", 0, 0.0, 2.0), ("c", 1, 2.0, 6.0), ("d", 0, 0.0, 0.5)], "_id string, seg int, start double, end double")
    e = spark.createDataFrame([("c", 0, 0, [0.0, 1.0]), ("c", 1, 1, [1.0, 0.0]), ("c", 1, 2, [1.0, 0.1])], "_id string, seg int, win int, embedding array<double>")
    clips, v, spoken = voices.score_clips(seg, e, [1.0, 0.0])
    got = {r["_id"]: r for r in clips.collect()}
    assert (got["c"]["verdict"], got["c"]["target_seconds"], got["c"]["speech_seconds"], got["c"]["n_voices"]) == ("ya", 4.0, 6.0, 1)
    assert got["d"]["verdict"] == "tanpa_ucapan" and spoken.count() == 2 and v.count() == 2


def test_turns_with_match(spark):
    s = spark.createDataFrame([("c", 0, 0.0, "a", 1, None), ("c", 1, 61.0, "b", 1, None), ("c", 2, 65.0, "d", 2, 1), ("c", 3, 66.0, "e", None, None)], "_id string, seg int, start double, text string, voice int, match_voice int")
    v = spark.createDataFrame([("c", 1, 5.0, "target"), ("c", 2, 1.0, "lain")], "_id string, voice int, seconds double, label string")
    text = turns.as_text(turns.turns(s, v)).first()["turns"]
    assert text == "[0:00] Pembicara 1 (mirip target): a b\n[1:05] Pembicara 1* (mirip target): d\n[1:06] Pembicara ?: e"
    spoken = spark.createDataFrame([("c", 0.04, 1.0, "a", 3, None, 0), ("c", 0.0, 1.0, "a", 4, None, 1)], "_id string, start double, end double, text string, voice int, match_voice int, pos int")
    seg = spark.createDataFrame([("c", 0, 0.0, 1.0, "a"), ("c", 1, 5.0, 6.0, "z")], "_id string, seg int, start double, end double, text string")
    assert [r["voice"] for r in turns.attribute(seg, spoken).orderBy("seg").collect()] == [4, None]


def test_alignment_finds_shift(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 2**32, 80)
    assert audio_dedup.align(a, a[13:], 1.0, 40)[:2] == (0.0, 13) and audio_dedup.align(a[13:], a, 1.0, 40)[:2] == (0.0, -13)
    assert audio_dedup.align(a[:39], a, 1.0, 40) is None
    rows = spark.createDataFrame([("a", a.tolist()), ("b", (a[5:] ^ 1).tolist()), ("c", rng.integers(0, 2**32, 60).tolist())], "_id string, fp array<bigint>")
    pairs = spark.createDataFrame([("a", "b"), ("a", "c")], "a string, b string")
    x = audio_dedup.alignments(pairs, rows, item=1.0, min_overlap=40).collect()
    y = audio_dedup.native_alignments(pairs, rows, min_values=40).where("ber <= 0.2").collect()
    assert [tuple(r) for r in x] == [tuple(r) for r in y] == [("a", "b", 1 / 32, 5, 75)]


def test_groups_and_components(spark):
    pairs = spark.createDataFrame([("a", "b"), ("b", "c"), ("e", "d")], "a string, b string")
    nodes = spark.createDataFrame([("a", "2", 0), ("b", "1", 1), ("c", None, 2), ("d", "5", 3), ("e", "5", 4), ("f", "0", 5)], "_id string, created_at string, line_no int")
    got = {(r["keep"], tuple(r["duplicates"])) for r in audio_dedup.groups(pairs, nodes).collect()}
    assert got == {("c", ("b", "a")), ("d", ("e",))}
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(1000, 1100)] + [(None, 3)]
    up = {}
    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((root(a), root(b)))
            up[y] = x
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(up)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("least, tile", [(0.3, 16), (0.6, 16), (0.9, 16), (0.3, 2048)])
def test_similar_components_equal_all_pairs(spark, least, tile):
    rng = np.random.default_rng(1)
    rows = [(k % 3, k, [float(x) for x in v / np.linalg.norm(v)]) for k, v in enumerate(rng.normal(size=(240, 6)))]
    rows += [(0, 500 + k, [least, 1.0, 0.0, 0.0, 0.0, float(k)]) for k in range(3)] + [(0, 510, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (1, 510, [9.0] * 6), (1, 7, rows[7][2])]
    rows += [(2, 600, [float("nan")] * 6), (2, 601, [float("inf")] * 6), (3, 602, [1.0]), (3, 603, [1.0]), (3, 604, []), (3, 605, [1.0, 1.0]), (None, 606, [1.0] * 6), (0, None, [9.0] * 6), (0, 607, None), (0, 608, [9.0] * 5 + [None]), (4, 609, [1.0])]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for i, (p, a, x) in enumerate(rows):
        for q, b, y in rows[:i]:
            if p is None or p != q or a is None or b is None or a == b or x is None or y is None or None in x + y or len(x) != len(y):
                continue
            if not sum(u * v for u, v in zip(x, y)) < least:
                up[max(root(a), root(b))] = min(root(a), root(b))
    df = spark.createDataFrame(rows, "label int, vec_id long, embedding array<double>")
    got = {r["node"]: r["root"] for r in similar.similar_components(df, "label", "vec_id", "embedding", least, tile).collect()}
    assert got == {x: root(x) for x in list(up)}
    assert similar.similar_components(df.limit(0), "label", "vec_id", "embedding", least, tile).count() == 0


def test_similar_components_make_no_row_a_pair(spark, tmp_path, monkeypatch):
    """1,200 vectors of one label have 719,400 pairs; what is written out stays near the number of vectors."""
    from sonarloom.plans import catalog

    vectors = [(k, [1.0, k / 1e4], 1) for k in range(1200)]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    made, plain = [], workspace.materialize

    def counted(df, name, path=None):
        out = plain(df, name, path)
        made.append(out.count())
        return out

    monkeypatch.setattr(workspace, "materialize", counted)
    assert {(r["node"], r["root"]) for r in catalog.similar_components(spark, str(tmp_path)).collect()} == {(k, 0) for k in range(1200)}
    assert max(made) <= 3 * 1200


def test_notes_order(spark):
    row = {"_id": "x", "transcript": "satu dua", "transcript_lang": "en", "lang": None, "transcript_status": "done", "prompt_fallback": True, "speech_seconds": 4.0, "duplicate_of": "q", "manual_note": "m",
           "voices": [(0, 1, 0.1, "lain", 2.0)], "segments": [(0.0, 2.5, "t", None, None, None, "berulang"), (0.0, 1.0, "t", None, None, None, "kosong")]}
    kind = f"_id string, transcript string, transcript_lang string, lang string, transcript_status string, prompt_fallback boolean, speech_seconds double, duplicate_of string, manual_note string, voices array<struct<{schemas.VOICE}>>, segments array<struct<{schemas.SEGMENT}>>"
    df = spark.createDataFrame([row, {**row, "transcript_status": "failed"}], schemas.of(kind))
    a, b = [r[0] for r in df.select(report.notes(df)).collect()]
    assert [p.split()[0] for p in a.split("; ")] == ["Transkrip", "Bahasa", "1", "Prompt", "50%", "Duplikat", "m"] and b == "m"


def test_dropped_seconds_add_lengths(spark):
    """Lengths of 0.72 and 0.78 s make 1.5; ends added and starts taken off one by one make a little less."""
    segments = [(0.84, 1.56, "a", "berulang"), (2.64, 3.42, "b", "berulang")]
    df = spark.createDataFrame([(segments,)], "s array<struct<start double, end double, text string, hallucination string>>")
    assert df.select(report.dropped_note(F.col("s"))).first()[0] == "2 segmen halusinasi Whisper dibuang (2 detik, berulang)"


SEARCH = [("a", "MBG makan siang", "video", "2026-09-29 10:00:00"), ("b", "mbgku", "video", "2026-09-29 23:59:59"), ("c", None, "video", "2026-09-30 00:00:00"), ("d", "makan", "image", None)]


@pytest.mark.parametrize(
    "query, ids",
    [("mbg", "a"), ("mbg*", "ab"), ("MBG + makan", "a"), ("mbg | makan", "ad"), ("makan -siang", "abcd"), ("makan + -siang", "d"), ('"makan siang"', "a"), ("(mbg | mbgku) + makan", "a"), ("mbg makan", "ad")],
)
def test_search(spark, query, ids):
    df = spark.createDataFrame(SEARCH, "_id string, content string, media_type string, created string")
    body = {"query": {"simple_query_string": {"query": query, "fields": ["content"]}}}
    assert "".join(sorted(r["_id"] for r in search.search(df, json.dumps(body)).collect())) == ids
    if query == "makan -siang":
        # Without a sort, by relevance: rows with the word first.
        assert [r["_id"] for r in search.search(df, body).collect()] in (["d", "a", "b", "c"], ["a", "d", "b", "c"])


def test_search_range_sort_pushdown(spark, tmp_path):
    df = spark.createDataFrame(SEARCH, "_id string, content string, media_type string, created string").withColumn("created", F.to_timestamp("created"))
    df.write.parquet(f"{tmp_path}/p")
    body = {"query": {"bool": {"must": [{"range": {"created": {"gte": "29-09-2026", "lte": "29-09-2026", "format": "dd-MM-yyyy"}}}, {"term": {"media_type": "video"}}]}}, "sort": [{"created": "desc"}], "_source": ["_id"]}
    out = search.search(spark.read.parquet(f"{tmp_path}/p"), body)
    assert [r[0] for r in out.collect()] == ["b", "a"]
    assert "IsNotNull(media_type)" in out._jdf.queryExecution().toString()


def test_files(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"_id": "a", "content": "x y"}\n\n{"_id": "b"}\n', encoding="utf-8")
    rows = files.json_lines(spark, f"file://{tmp_path}/m.jsonl", schemas.MANIFEST).orderBy("line_no").collect()
    assert [(r["_id"], r["content"]) for r in rows] == [("a", "x y"), ("b", None)]
    assert files.sidecar(spark, f"file://{tmp_path}/none.jsonl", schemas.VAD).count() == 0
    (tmp_path / "c.json").write_text('{"a": "t", "b": ""}')
    assert {tuple(r) for r in files.json_map(spark, f"file://{tmp_path}/c.json").collect()} == {("a", "t"), ("b", "")}
    x = np.sin(np.arange(16000) / 20) * 0.5
    (tmp_path / "x_a.wav").write_bytes(files.encode_wav(x))
    (tmp_path / "x_b.part").write_bytes(b"1")
    clip = files.media(spark, f"file://{tmp_path}/*.{{wav,part}}")
    assert [(r["stem"], r["bytes"]) for r in clip.collect()] == [("x_a", 32044)]
    assert np.abs(files.decode_wav((tmp_path / "x_a.wav").read_bytes()) - x).max() < 1e-4
    v = models.vad(clip).first()
    assert v["audio_seconds"] == 1.0 and v["vad_speech_seconds"] == 1.0 and v["error"] is None
    assert len(models.fingerprints(clip).first()["fp"]) > 5
    assert models.vad(clip.withColumn("content", F.lit(b"bad"))).first()["error"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "done", 'a;"b"', 0.5, "http://x"), (2, "failed", None, None, None)], "no int, status string, t string, x double, link string")
    assert sinks.csv_report(df, f"{tmp_path}/r.csv", ["no"]) == 2
    assert (tmp_path / "r.csv").read_bytes() == '﻿no;status;t;x;link\r\n1;done;"a;""b""";0.5;http://x\r\n2;failed;;;\r\n'.encode()
    sinks.workbook(f"{tmp_path}/r.xlsx", {"Sum": df.select("no"), "Rows": df}, {"x": "0%"}, ("link",), {"t": 40}, {"done": "E2EFDA"})
    from xml.dom import minidom

    with zipfile.ZipFile(tmp_path / "r.xlsx") as z:
        assert z.testzip() is None
        for n in z.namelist():
            minidom.parseString(z.read(n))
        assert b"http://x" in z.read("xl/worksheets/_rels/sheet2.xml.rels")
    path = f"file://{tmp_path}/j"
    sinks.append_json(df, path)
    sinks.replace_json(spark.read.json(path).where("no = 1"), path)
    assert spark.read.json(path).count() == 1
    assert sinks.backup_once(spark, path) and not sinks.backup_once(spark, path)


def test_fetch_chain(spark):
    class Ok:
        def fetch(self, url):
            return ("text/html", b"") if "bad" in url else ("video/mp4", b"123")

    posts = spark.createDataFrame([("a", "u", None), ("b", "bad", "v"), ("c", "bad", "bad"), ("d", None, None)], "_id string, u string, v string")
    got = {r["_id"]: (r["status"], r["method"], r["bytes"]) for r in models.fetch(posts, [("media_url", Ok, "u"), ("page", Ok, "v")]).collect()}
    assert got["a"] == ("ok", "media_url", 3) and got["b"] == ("ok", "page", 3) and got["c"][0] == got["d"][0] == "failed"


def test_streams_equal_batch(spark, tmp_path):
    from sonarloom.streaming import incremental

    rows = [("a", 1, "x"), ("b", 2, "y"), ("a", 3, "z"), ("c", 4, "w")]
    src = f"file://{tmp_path}/in"
    for k in (0, 2):
        spark.createDataFrame(rows[k : k + 2], "_id string, line_no int, v string").coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema("_id string, line_no int, v string").option("maxFilesPerTrigger", 1).parquet(src)
    q = stream.writeStream.foreachBatch(incremental.upsert_into(f"file://{tmp_path}/out")).option("checkpointLocation", f"file://{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    want = latest.latest(spark.createDataFrame(rows, "_id string, line_no int, v string")).drop("first_line")
    assert {tuple(r) for r in incremental.upserted(spark, f"file://{tmp_path}/out").select("_id", "line_no", "v").collect()} == {tuple(r) for r in want.collect()}
    # A batch that runs again changes nothing; a third one leaves what it doesn't touch, and old files go.
    write = incremental.upsert_into(f"file://{tmp_path}/out")
    write(spark.createDataFrame(rows[2:], "_id string, line_no int, v string"), 1)
    write(spark.createDataFrame([("b", 9, "n")], "_id string, line_no int, v string"), 2)
    assert {tuple(r) for r in incremental.upserted(spark, f"file://{tmp_path}/out").select("_id", "line_no", "v").collect()} == {("a", 3, "z"), ("b", 9, "n"), ("c", 4, "w")}
    write(spark.createDataFrame([("b", 10, "m")], "_id string, line_no int, v string"), 3)
    assert len(list((tmp_path / "out/data").glob("epoch=*/bucket=*/*.parquet"))) == 4
    q = incremental.new_only(stream).writeStream.format("memory").queryName("fresh").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select count(*), count(distinct _id) from fresh").first()[:] == (3, 3)


def test_models_on_frames(spark, tmp_path):
    import pandas as pd

    from sonarloom import models
    from sonarloom.operators import voices, windows
    from sonarloom.sources.files import decode_wav, encode_wav

    t = np.arange(4 * 16000) / 16000
    tone = 0.5 * np.sin(2 * np.pi * 440 * t) + 0.3 * np.sin(2 * np.pi * 6000 * t)
    wav = encode_wav(tone)
    assert np.abs(decode_wav(wav) - tone).max() < 1e-3 and decode_wav(encode_wav([2.0, -2.0, 0.0])).tolist() == pytest.approx([1, -1, 0], abs=1e-4)
    clips = spark.createDataFrame([("a", wav, "id"), ("b", b"broken", "xx")], "_id string, content binary, lang string")
    stored = {"text": " halo dunia ", "language": "id", "duration": 4.04, "segments": [{"start": 0.04, "end": 1.26, "text": " halo", "no_speech_prob": None}]}
    got = {r["_id"]: r for r in models.transcribe(clips, lambda: models.Replay({wav: stored}), "ejaan").collect()}
    assert got["a"]["transcript"] == "halo dunia" and got["a"]["segments"][0].asDict() == {"start": 0.0, "end": 1.3, "text": "halo", "no_speech_prob": 0.0, "compression_ratio": 0.0, "avg_logprob": 0.0, "hallucination": None}
    assert got["a"]["transcript_prompt"] == "ejaan" and got["a"]["error"] is None and got["b"]["error"] and got["b"]["transcript"] is None
    out = models.separated(clips.where("_id = 'a'")).first()
    assert out["vocals_energy_share"] == pytest.approx(0.25 / 0.34, abs=0.01)
    spans = clips.where("_id = 'a'").selectExpr("*", "array(array(1D, 2D)) AS vad_spans")
    quiet = decode_wav(models.muted(spans).first()["masked"])
    assert len(quiet) == len(tone) and not quiet[:16000].any() and not quiet[32000:].any() and quiet[16000:32000].any()
    segs = spark.createDataFrame([("a", 0, 0.0, 4.0), ("a", 1, 0.0, 2.0)], "_id string, seg int, start double, clip_end double")
    cut = windows.sliding(segs, 3.0, 1.5).selectExpr("_id", "struct(seg, seg * 100 + k AS win, win_start AS start, win_end AS end) AS w").groupBy("_id").agg({"w": "collect_list"}).toDF("_id", "windows")
    sizes = []

    class Sizes(models.SpectrumEmbedder):
        def embed(self, pieces):
            assert len({len(p) for p in pieces}) == 1
            return super().embed(pieces)

    rows = models.embed(clips.join(cut, "_id"), Sizes).collect()
    assert sorted((r["seg"], r["win"]) for r in rows) == [(0, 0), (0, 1), (1, 100)] and all(abs(sum(x * x for x in r["embedding"]) - 1) < 1e-9 for r in rows) and not sizes
    saved = models.saved(clips.selectExpr("_id AS stem", "content"), f"file://{tmp_path}/media").collect()
    assert {r["stem"] for r in saved} == {"a", "b"} and sorted(p.name for p in (tmp_path / "media").iterdir()) == ["a.mp4", "b.mp4"] and (tmp_path / "media/a.mp4").read_bytes() == wav
    from sonarloom.sources import files

    posts = spark.createDataFrame([("a", None), ("c", None)], "_id string, platform string")
    listing = files.media(spark, f"{tmp_path}/media", content=False).selectExpr("concat('unknown_', stem) AS stem", "path", "bytes")
    assert [(r["_id"], r["status"], r["bytes"]) for r in files.existing(posts, listing).collect()] == [("a", "exists", len(wav))]
    assert pd.notna(voices.dominant(np.eye(3))[0]).all()


def test_http_fetcher(spark):
    import http.server
    import threading

    from sonarloom import models

    class Page(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            self.send_response(200)
            self.send_header("Content-Type", "video/mp4" if "mp4" in self.path else "text/html")
            self.end_headers()
            self.wfile.write((self.headers.get("Referer") or "none").encode())

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Page)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        base = f"http://127.0.0.1:{server.server_port}"
        posts = spark.createDataFrame([(1, f"{base}/a.mp4"), (2, f"{base}/page"), (3, None)], "_id int, url string")
        got = {r["_id"]: r for r in models.fetch(posts, [("direct", lambda: models.HttpFetcher({"0.0.1": "https://example.com/"}), "url")]).collect()}
        assert bytes(got[1]["content"]) == b"https://example.com/" and got[2]["status"] == "failed" and "text/html" in got[2]["reason"] and got[3]["reason"] == "no media url"
    finally:
        server.shutdown()


def test_credentials(tmp_path, monkeypatch):
    from sonarloom.sources.credentials import credentials

    (tmp_path / "netrc").write_text("machine search.example login ann password x\n")
    monkeypatch.delenv("SEARCH_USER", raising=False)
    assert credentials("search.example", str(tmp_path / "netrc")) == ("ann", "x") and credentials("other", str(tmp_path / "netrc")) is None and credentials("x", str(tmp_path / "none")) is None
    monkeypatch.setenv("SEARCH_USER", "u")
    monkeypatch.setenv("SEARCH_PASSWORD", "p")
    assert credentials("any") == ("u", "p")


def test_align_equals_all_offsets():
    from sonarloom.operators.audio_dedup import align

    r = np.random.default_rng(4)
    for _ in range(60):
        a, b = (r.integers(0, 1 << 32, r.integers(1, 30)) & r.choice([0xFFFFFFFF, 0xF]) for _ in "ab")
        least = int(r.integers(1, 12))
        best = None
        for lag in range(1 - len(b), len(a)):
            x, y = a[max(lag, 0) : len(b) + lag], b[max(-lag, 0) :]
            n = min(len(x), len(y))
            if n >= least:
                rate = sum(int(p ^ q).bit_count() for p, q in zip(x[:n].tolist(), y[:n].tolist())) / (32 * n)
                best = min(best or (9, 0, 0), (rate, lag, n))
        got = align(a, b, 1.0, float(least))
        assert got is None if best is None else got[0] == pytest.approx(best[0]) and got[1:] == best[1:]


def test_candidates_with_a_common_value(spark):
    """A value in all clips makes no pairs; pairs that share enough are found, flat clips aren't."""
    from sonarloom.operators import audio_dedup

    r = np.random.default_rng(5)
    rows = [(i, [0, *r.integers(1, 1 << 30, 30).tolist()]) for i in range(200)]
    rows += [(200, rows[3][1][5:]), (201, [0] * 40), (202, [0] * 40), (203, [*rows[7][1][:10], *r.integers(1, 1 << 30, 20).tolist()])]
    got = {(x["a"], x["b"], x["shared"]) for x in audio_dedup.candidates(spark.createDataFrame(rows, "_id long, fp array<bigint>"), least=5).collect()}
    assert got == {(3, 200, 26), (7, 203, 10)}


def test_voiceprints(spark):
    from sonarloom.operators import voices

    r = np.random.default_rng(6)
    near = np.eye(8)[0] + 0.1 * r.normal(size=(20, 8))
    x = np.concatenate([near, np.eye(8)[3:5]])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([("n", i, v.tolist()) for i, v in enumerate(x)], "name string, win int, embedding array<double>")
    table = voices.voiceprints(df, "name", "win")
    row = table.first()
    assert row["windows_total"] == 22 and row["windows_used"] == 20 and [o["win"] for o in row["outlier_windows"]] == [20, 21]
    want = near_unit = x[:20].mean(0) / np.linalg.norm(x[:20].mean(0))
    assert np.allclose(row["vec"], want, atol=1e-6) and row["member_sim_median"] == pytest.approx(np.median(x[:20] @ near_unit), abs=1e-3)
    assert voices.voiceprint(table, "n", "stand-in").count() == 1
    with pytest.raises(Exception, match="several"):
        voices.voiceprint(table.union(table), "n", "stand-in").collect()


def test_strict_file_is_an_error(spark):
    from sonarloom.operators import latest

    rows, files_ = spark.createDataFrame([("a",), ("b",)], "_id string"), spark.createDataFrame([("a", "f"), ("b", "")], "_id string, file string")
    assert latest.with_file(rows, files_).count() == 2
    with pytest.raises(Exception, match="no file for b"):
        latest.with_file(rows, files_, strict=True).collect()
