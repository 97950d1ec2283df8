"""Every query of the library against DuckDB on the smallest tables, and those without SQL against plain Python."""

import numpy as np
import pytest

from sonarloom.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_equals_sql(name, spark, sf, duck, same):
    same(catalog.QUERIES[name](spark, sf), duck.sql(catalog.SQL[name]))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 6
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_diarize_clips(spark, sf):
    rows = catalog.diarize_clips(spark, sf).toPandas()
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas().set_index("vec_id")
    from sonarloom.operators.voices import average_linkage

    for label, g in rows.sort_values("vec_id").groupby("label"):
        x = np.stack(e.loc[g["vec_id"], "embedding"].to_numpy()).astype(float)
        assert slow_linkage(x, 0.35) == list(g["voice"]) == list(average_linkage(x, 0.35))


def slow_linkage(x, thr):
    """Means over all pairs, taken anew each time."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    groups = [[i] for i in range(len(x))]
    s = x @ x.T
    while len(groups) > 1:
        best = max(((s[np.ix_(a, b)].mean(), -i, -j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j), default=None)
        if best[0] < thr - 1e-12:
            break
        i, j = -best[1], -best[2]
        groups[i] += groups.pop(j)
    groups.sort(key=lambda g: (-len(g), min(g)))
    return [next(k for k, g in enumerate(groups) if i in g) for i in range(len(x))]


def test_dominant_voice(spark, sf):
    rows = catalog.dominant_voice(spark, sf).collect()
    assert len(rows) == 10 and all(1 <= r["used"] <= r["windows"] and r["least"] <= r["median"] for r in rows)


def test_transcript_ratio(spark, sf):
    import difflib
    import re

    docs = {r["doc_id"]: re.findall(r"[^\W]+", (r["text"] or "").lower()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in catalog.transcript_ratio(spark, sf).collect():
        assert r["transcript_ratio"] == pytest.approx(difflib.SequenceMatcher(None, docs[r["a"]], docs[r["b"]]).ratio(), abs=6e-4)


def test_audio_track(spark, sf):
    assert all(r["has_audio"] == (r["doc_id"] % 3 == 0) for r in catalog.audio_track_predicate(spark, sf).collect())
