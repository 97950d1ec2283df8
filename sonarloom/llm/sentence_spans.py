"""Substring dedup by sliding sentence spans.

A text is cut into sentences: a sentence ends with a word that ends in ``.``, ``!`` or ``?`` (quotes and brackets
closed after it aside), or before a newline. Sentences of ``MAX_UNIT`` words or more are cut further by their content:
before the word with the least hash of every ``MAX_UNIT`` consecutive ones, the last of equal ones. So a cut depends on
the words around it alone, not on where the sentence starts, and no part has more than ``MAX_UNIT`` words. Every run of
``run`` consecutive parts is hashed, whatever its length; a longer run that repeats is covered by these. Hashes are
joined globally: the first occurrence (smallest document, then position) of a run stays, and the parts that any other
occurrence covers are removed. White space between words doesn't count; letters do.

A passage of 51 words holds three whole parts wherever it stands, so it is found; where it starts or ends inside a
sentence, up to 11 words at its start and 12 at its end share their part with words around it and stay.

A run's hash is a difference of prefix sums of its words' hashes, so all runs of a batch are made at once, in time that
grows with its words. Counting is a partial aggregate over hashes alone, so that a passage in a third of all documents
is no hot spot; places are read again only for hashes that a filter of bounded size lets pass (all, where there are too
many for it), and the joins back are ones that adaptive execution can split. Hashes have 64 bits.

Defined results: a null text stays null, one without words is unchanged; rows that repeat an id with another text
are told apart by a hash of the text, equal rows share their fate; a null id comes after all others; overlapping
repeats inside one document go like any other; an empty table gives an empty result; other columns pass through
untouched, whatever their names."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace
from sonarloom.llm.memo import Memo
from sonarloom.llm.minhash_dedup import bitmap, passes
from sonarloom.llm.token_counts import slices

MAX_UNIT = 12
WORD = re.compile(r"\S+\s*")
CLOSERS = "\"')]}»”’"
#: Odd, so that its powers can be undone modulo 2 ** 64.
BASE = 0x9E3779B97F4A7C15


def word_value(raw: str) -> int:
    """Hash of a word with the white space after it left out; the lowest bit says whether a sentence ends with it."""
    bare = raw.rstrip()
    ends = bare.rstrip(CLOSERS)[-1:] in (".", "!", "?") or "\n" in raw[len(bare) :]
    return xxhash.xxh3_64_intdigest(bare) & ~1 | ends


class Parts:
    """The parts of many texts at once."""

    def __init__(self):
        self.known = Memo(word_value, 300_000)
        self.powers = np.ones((2, 1), np.uint64)

    def cut(self, texts: list[str | None]) -> None:
        self.words = [WORD.findall(t) if t else [] for t in texts]
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        n = int(self.offsets[-1])
        value = np.fromiter((self.known[w] for some in self.words for w in some), np.uint64, n)
        self.hashes = value & ~np.uint64(1)
        start = np.zeros(n + 1, bool)
        start[1:] = value & np.uint64(1)
        start[self.offsets] = True  # a text without words starts where the next one does
        start = start[:n]
        if n >= MAX_UNIT:
            sentence = np.cumsum(start)
            inside = np.flatnonzero(sentence[: n - MAX_UNIT + 1] == sentence[MAX_UNIT - 1 :])
            some = np.lib.stride_tricks.sliding_window_view(self.hashes, MAX_UNIT)[inside, ::-1]
            start[inside + (MAX_UNIT - 1 - some.argmin(axis=1))] = True
        #: Place of the first word of each part, and of the first part of each text.
        self.starts = np.append(np.flatnonzero(start), n)
        self.first = np.searchsorted(self.starts[:-1], self.offsets)

    def runs(self, run: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``run`` parts and their number in each text."""
        parts = np.diff(self.first)
        count = np.maximum(parts - run + 1, 0)
        at = np.repeat(self.first[:-1] - (np.cumsum(count) - count), count) + np.arange(count.sum())
        a, z = self.starts[at], self.starts[at + run]
        n = len(self.hashes)
        if self.powers.shape[1] <= n:
            steps = np.full((2, 2 * n + 1), [[BASE], [pow(BASE, -1, 1 << 64)]], np.uint64)
            steps[:, 0] = 1
            self.powers = np.cumprod(steps, axis=1, dtype=np.uint64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * self.powers[0, :n], dtype=np.uint64)])
        h = (sums[z] - sums[a]) * self.powers[1, a] ^ (z - a).astype(np.uint64)
        h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return (h ^ h >> np.uint64(31)).view(np.int64), count

    def without(self, text: int, whole: str, gone: set[int]) -> str:
        """A text without the parts whose numbers are in ``gone``; white space before its first word stays."""
        words, begin = self.words[text], self.offsets[text]
        lead = len(whole) - sum(map(len, words))
        places = self.starts[self.first[text] : self.first[text + 1] + 1] - begin
        kept = (w for k, (a, z) in enumerate(zip(places[:-1], places[1:])) if k not in gone for w in words[a:z])
        return whole[:lead] + "".join(kept)


def span_table(docs: DataFrame, run: int) -> DataFrame:
    """doc, row and the hashes of all runs, in order, of the rows that have any."""

    def make(batches):
        parts = Parts()
        for whole in batches:
            for b in slices(whole, 2):
                parts.cut(b.column(2).to_pylist())
                h, count = parts.runs(run)
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(count)]).astype(np.int32), h)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], names=["doc", "row", "runs"]).filter(pa.array(count > 0))

    return docs.mapInArrow(make, "doc bigint, row bigint, runs array<bigint>")


def places(table: DataFrame, repeated: DataFrame) -> DataFrame:
    """h, doc, row and place of the runs whose hash is in ``repeated`` (h)."""
    among = bitmap(repeated.withColumnRenamed("h", "rep"), repeated.count(), plain=True)

    def run(batches):
        for b in batches:
            lists = b.column(2)
            h, offsets = lists.flatten().to_numpy(), lists.offsets.to_numpy().astype(np.int64)
            offsets = offsets - offsets[0]
            at = np.flatnonzero(passes(among.value, h))
            text = np.searchsorted(offsets, at, side="right") - 1
            columns = [pa.array(h[at]), b.column(0).take(pa.array(text)), b.column(1).take(pa.array(text)), pa.array((at - offsets[text]).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "doc", "row", "place"])

    if among is None:
        every = table.select("doc", "row", F.posexplode("runs").alias("place", "h"))
    else:
        every = table.mapInArrow(run, "h bigint, doc bigint, row bigint, place int")
    return every.join(repeated, "h").select("h", "doc", "row", "place")


def remove_repeats(docs: DataFrame, run: int = 3, text: str = "text", doc_id: str = "doc_id", counts: bool = False) -> DataFrame:
    """``docs`` without the parts that a non-first repeated run covers; with ``counts``, n_units and n_removed are added."""
    workspace.small_batches(docs.sparkSession)
    last = (1 << 63) - 1
    doc, row = F.coalesce(F.col(doc_id).cast("long"), F.lit(last)), F.xxhash64(F.col(doc_id), F.col(text))
    slim = docs.select(doc.alias("doc"), row.alias("row"), F.col(text).cast("string").alias("text"))
    table = workspace.materialize(span_table(slim, run), "spans")
    # Written out, both sides of each join below come from exchanges of its own, which can be split where a run is hot.
    repeated = workspace.materialize(table.select(F.explode("runs").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"), "repeated")
    hits = workspace.materialize(places(table, repeated), "hits")
    firsts = workspace.materialize(hits.groupBy("h").agg(F.min(F.struct("doc", "row", "place")).alias("at")), "firsts")
    again = hits.join(firsts, "h").where(F.struct("doc", "row", "place") != F.col("at"))
    gone = again.groupBy(F.col("doc").alias("gone_doc"), F.col("row").alias("gone_row")).agg(F.collect_set("place").alias("gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"), doc.alias("doc"), row.alias("row"))
    rows = rows.join(gone, (F.col("doc") == F.col("gone_doc")) & (F.col("row") == F.col("gone_row")), "left")
    place = docs.columns.index(text)
    kinds = docs.schema.simpleString()[len("struct<") : -1]
    schema = f"`all` struct<{kinds}>, n_units bigint, n_removed bigint"

    def rebuild(batches):
        parts = Parts()
        for whole in batches:
            for b in slices(pa.RecordBatch.from_arrays([*whole.columns, whole.column(0).field(place)], names=["all", "gone", "text"]), 2):
                all_, texts = b.column(0), b.column(2).to_pylist()
                parts.cut(texts)
                n_removed = [0] * len(texts)
                for k, starts in enumerate(b.column(1).to_pylist()):
                    if starts:
                        out = {s + i for s in starts for i in range(run)}
                        texts[k], n_removed[k] = parts.without(k, texts[k], out), len(out)
                columns = [all_.field(k) for k in range(len(all_.type))]
                columns[place] = pa.array(texts, all_.type[place].type)
                new = pa.StructArray.from_arrays(columns, fields=list(all_.type))
                yield pa.RecordBatch.from_arrays([new, pa.array(np.diff(parts.first), pa.int64()), pa.array(n_removed, pa.int64())], names=["all", "n_units", "n_removed"])

    done = rows.select("all", "gone").mapInArrow(rebuild, schema)
    return done.select(*[F.col("all")[c].alias(c) for c in docs.columns], *(["n_units", "n_removed"] if counts else []))


def op6_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = workspace.table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, counts=True).select("doc_id", "n_units", "n_removed", "text")
