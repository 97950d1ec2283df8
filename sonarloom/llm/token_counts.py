"""Token counts: texts are encoded in Arrow batches and only lengths come back.

A text is cut into units at *safe boundaries*: places no vocabulary piece spans, so that no merge of the
encoder can cross them and the count of the text is the sum over its units. Units are encoded in batches of
about equal bytes, and each worker remembers the counts of units it has seen (bounded).

Safe boundaries of a SentencePiece model with identity normaliser, dummy prefix and whitespace kept:
a single space after a character that is neither a space nor U+2581 (the encoder's dummy prefix stands for the
space dropped), and before a newline. ``SafeUnits`` checks the vocabulary for pieces that would span either;
with such a piece, or another normaliser, whole texts are encoded instead.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows are each counted; extra columns
of the input are ignored unless named in ``keep``; an empty table gives an empty result."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace

SPACE = "▁"
#: Bytes of text encoded by one call of the library.
BATCH_BYTES = 1 << 18


class SafeUnits:
    """Counts tokens of whole texts with a SentencePiece model."""

    def __init__(self, model_path: str, limit: int = 300_000):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        self.library = sentencepiece.SentencePieceProcessor(model_file=model_path)
        spec = pb.ModelProto()
        with open(model_path, "rb") as f:
            spec.ParseFromString(f.read())
        norm, pieces = spec.normalizer_spec, [p.piece for p in spec.pieces if p.type in (1, 4)]
        plain = norm.add_dummy_prefix and not norm.remove_extra_whitespaces and not norm.precompiled_charsmap
        self.safe = plain and not spec.trainer_spec.treat_whitespace_as_suffix and not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces)
        #: Before a newline a cut is safe if no piece has one after another character.
        self.lines = self.safe and not any("\n" in p and len(p) > 1 for p in pieces) and self.library.encode("\nx")[:-1] == self.library.encode("\n")
        self.known: dict[str, int] = {}
        self.limit = limit

    def units(self, text: str) -> tuple[list[str], int]:
        """The units of a text and the tokens to take off their sum."""
        if not self.safe or not text or SPACE in text:
            return [text], 0
        off = 0
        if self.lines and "\n" in text:
            # A newline unit encodes as the dummy prefix, then the newline; the prefix is taken off unless
            # it stands for a real space before the newline.
            off = text.count("\n") - text.count(" \n") - text.startswith("\n")
            text = re.sub("(?<=[^ ])\n", " \n", text)
        if "  " in text or text[0] == " ":
            return re.split("(?<=[^ ]) ", text), off
        return text.split(" "), off

    def counts(self, texts: list[str | None]) -> list[int]:
        parts, known = [self.units(t or "") for t in texts], self.known
        new = list(set().union(*(u for u, _ in parts)).difference(known))
        for some in by_bytes(new):
            known.update(zip(some, map(len, self.library.encode(some, num_threads=1))))
        # An empty unit is what follows a trailing space: one token; an empty text has none.
        known[""] = 1
        out = [sum(map(known.__getitem__, u)) - off if t else 0 for t, (u, off) in zip(texts, parts)]
        if len(known) > self.limit:
            # Oldest half goes; dictionaries keep insertion order.
            self.known = dict(list(known.items())[len(known) // 2 :])
        return out


def by_bytes(texts: list[str], most: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of ``texts`` of about ``most`` characters each; a longer text stands alone."""
    some: list[str] = []
    size = 0
    for t in texts:
        if some and size + len(t) > most:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t)
    if some:
        yield some


def slices(batch: pa.RecordBatch, column: int, most: int = 8 * BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of an Arrow batch balanced by the bytes of one column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = size = 0
    for k, n in enumerate(sizes):
        if k > start and size + n > most:
            yield batch.slice(start, k - start)
            start, size = k, 0
        size += n
    if len(sizes) > start:
        yield batch.slice(start)


def token_counts(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None, limit: int = 4096) -> DataFrame:
    """``keep`` columns, then n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of each row's whole text.

    No shuffle: one narrow pass in which a row's text never leaves the Python worker."""
    keep = keep or ["doc_id"]
    workspace.small_batches(docs.sparkSession)
    slim = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    fields = slim.select(*keep).schema
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in fields)}{', ' if keep else ''}n_bytes bigint, n_tokens bigint"

    def run(batches):
        units = SafeUnits(model_path)
        for whole in batches:
            for b in slices(whole, len(keep)):
                texts = b.column(len(keep))
                n = pc.cast(pc.fill_null(pc.binary_length(texts), 0), pa.int64())
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], n, pa.array(units.counts(texts.to_pylist()), pa.int64())], names=[*keep, "n_bytes", "n_tokens"])

    return slim.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(workspace.table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
