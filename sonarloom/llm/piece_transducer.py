"""SentencePiece encoding and decoding by a weighted finite-state transducer.

Compiled from a model file are: the normaliser (white space to U+2581, with the dummy prefix), the pieces as arcs from
characters to ids, and byte fallback for characters without a piece. States are the last piece taken. A text is
composed with the transducer, which gives a lattice of pieces over its characters, and its encoding is the shortest path
in the tropical semiring (sums along a path, the least over paths).

For a unigram model an arc weighs minus its piece's score, whatever the state. For a BPE model, weights of no arc alone
reproduce the merges; there an arc from piece p to piece t weighs nothing if merging the characters of p and t gives
back just p and t, and infinitely much if not. A sequence of pieces whose neighbours all agree in this way is the
one that the merges make, so the only path of finite weight is the encoding.

A text is composed in units that no piece reaches across (characters that never stand together in a piece are cut
apart), and each worker remembers units (bounded). Runs of several spaces, whose pieces all score the same so that
merge order decides, are merged directly, from a heap. Time grows with a unit's length (times its logarithm, for spaces).

Defined results: a null text has no ids (null for ``encode``), an empty one none; U+2581 in a text is a space, as in the
library; a model with a precompiled normaliser is refused; repeated rows are encoded each; texts of any length whole."""

from __future__ import annotations

import re
import zlib
from heapq import heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace
from sonarloom.llm.memo import Memo
from sonarloom.llm.token_counts import slices

SPACE = "▁"
UNIGRAM, BPE = 1, 2
INF = float("inf")
#: Key of a piece's number among arcs by character; a bound of all numbers; the state before the first piece.
ARC, NUMBERS = "", 1 << 22
START = NUMBERS - 1
#: Longer units are not remembered.
LONG_UNIT = 1000


class Transducer:
    def __init__(self, model_path: str, limit: int = 300_000):
        from sentencepiece import sentencepiece_model_pb2 as pb

        spec = pb.ModelProto()
        with open(model_path, "rb") as f:
            spec.ParseFromString(f.read())
        norm, self.kind = spec.normalizer_spec, spec.trainer_spec.model_type
        if norm.precompiled_charsmap or self.kind not in (UNIGRAM, BPE) or spec.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only unigram and BPE models with the identity normaliser can be compiled")
        self.prefix, self.squeeze = norm.add_dummy_prefix, norm.remove_extra_whitespaces
        #: Arcs: piece -> (id, score); bytes of the fallback; what each id is decoded to.
        self.arcs, self.bytes, self.out = {}, {}, []
        for i, p in enumerate(spec.pieces):
            self.out.append(p.piece.replace(SPACE, " ").encode())
            if p.type in (1, 4):
                self.arcs[p.piece] = (i, p.score)
            elif p.type == 6:
                self.bytes[int(p.piece[3:-1], 16)] = i
                self.out[i] = bytes([int(p.piece[3:-1], 16)])
            elif p.type == 3:
                self.out[i] = b""
            elif p.type == 2:
                self.unk = i
                self.out[i] = " ⁇ ".encode()
        self.pieces = [p.piece for p in spec.pieces]
        #: Weights of pieces by number, whatever the state.
        self.scores = [-p.score if self.kind == UNIGRAM else 0.0 for p in spec.pieces]
        #: Arcs by character, as nested dictionaries; a piece's number stands where it ends.
        self.start: dict = {}
        for p, (i, _) in self.arcs.items():
            node = self.start
            for c in p:
                node = node.setdefault(c, {})
            node[ARC] = i
        self.longest = max(map(len, self.arcs), default=1)
        #: A character without a piece costs more than any piece.
        self.floor = 10 - min((s for _, s in self.arcs.values()), default=0.0) if self.kind == UNIGRAM else 0.0
        self.halves, self.spines = Memo(self._halves, limit), Memo(self._spine, limit)
        self.weights = Memo(self._weight, 2 * limit)
        self.units = Memo(self._unit, limit)
        self.cut = re.compile(self._classes())

    def _classes(self) -> str:
        """A pattern for units: runs of characters that stand together in pieces, with the spaces before them."""
        up: dict[str, str] = {}

        def root(c: str) -> str:
            while up.setdefault(c, c) != c:
                c = up[c]
            return c

        for p in self.arcs:
            for a, b in pairwise(p):
                if b == SPACE and a != SPACE:
                    return r"(?s).+"  # pieces reach over spaces: no cut is safe
                if a != SPACE:
                    up[root(a)] = root(b)
        groups: dict[str, list[str]] = {}
        for c in up:
            groups.setdefault(root(c), []).append(c)
        runs = sorted(groups.values(), key=len, reverse=True)
        # With the space, so that its piece and the next character's stay together.
        return f"(?s){SPACE}*(?:{'|'.join(f'[{"".join(map(re.escape, g))}]+' for g in runs)}|[^{SPACE}])|{SPACE}+"

    def merged(self, text: str, stop: str | None = None) -> list[str]:
        """Merges by score, leftmost first among equals: the definition of BPE. Ends before ``stop`` is made."""
        parts, n = list(text), len(text)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        open_: list[tuple[float, int, str, str]] = []

        def offer(k: int) -> None:
            if k >= 0 and after[k] < n and (arc := self.arcs.get(parts[k] + parts[after[k]])):
                heappush(open_, (-arc[1], k, parts[k], parts[after[k]]))

        for k in range(n - 1):
            offer(k)
        while open_:
            _, k, left, right = heappop(open_)
            # A part that was merged away is empty; one that has grown makes its old offers void.
            if parts[k] != left or after[k] >= n or parts[after[k]] != right:
                continue
            if left + right == stop:
                break
            gone = after[k]
            parts[k], parts[gone], after[k] = left + right, "", after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(k)
            offer(before[k])
        return [p for p in parts if p]

    def _spine(self, item: tuple[str, bool]) -> list[tuple[str, float, float]]:
        """The parts of a piece that once stood at its right (or left) end: text, rank at which each was made and rank at
        which it was merged away. Ranks are scores with the sign changed; characters are there from the start."""
        piece, right = item
        out, used = [], INF
        while len(piece) > 1:
            made = -self.arcs[piece][1]
            out.append((piece, made, used))
            piece, used = self.halves[piece][right], made
        return [*out, (piece, -INF, used)]

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The parts that the last merge of a piece joins; None if merging its characters doesn't give the piece."""
        parts = self.merged(piece, piece)
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def _agree(self, pair: tuple[str, str]) -> float:
        if self.kind == UNIGRAM:
            return 0.0
        a, b = pair
        if len(b) > 1 and self.halves[b] is None or len(a) > 1 and self.halves[a] is None:
            return INF
        if not a:
            return 0.0
        # A merge over the border happens if both parts stand there at its rank; among equals the leftmost is first.
        for left, made, used in self.spines[a, True]:
            for right, made2, used2 in self.spines[b, False]:
                arc = self.arcs.get(left + right)
                if arc and made < -arc[1] and made2 < -arc[1] and -arc[1] < used and -arc[1] <= used2:
                    return INF
        return 0.0

    def _weight(self, key: int) -> float:
        """Weight of the arc to a piece from the state of another (or from the start)."""
        before, piece = divmod(key, NUMBERS)
        return self._agree(("" if before == START else self.text(before), self.text(piece)))

    def text(self, number: int) -> str:
        """The characters of a piece, or of a character without one, by number."""
        return self.pieces[number] if number < len(self.pieces) else chr(number - len(self.pieces))

    def path(self, text: str) -> list[int]:
        """Numbers of the pieces of the shortest path through the lattice of a unit.

        One state per place is enough: in a unigram model weights don't depend on the state, and in a BPE model
        only one path of finite weight leads to a place, the encoding of the characters before it."""
        n, start, weights, scores = len(text), self.start, self.weights, self.scores
        least, last, back = [INF] * (n + 1), [START] * (n + 1), [0] * (n + 1)
        least[0] = 0.0
        for i in range(n):
            so_far = least[i]
            if so_far == INF:
                continue
            state, node, j = last[i] * NUMBERS, start, i
            for c in text[i : i + self.longest]:
                node = node.get(c)
                j += 1
                piece = node.get(ARC) if node is not None else None
                if piece is None:
                    if j > i + 1:
                        if node is None:
                            break
                        continue
                    piece = len(self.pieces) + ord(c)
                w = so_far + weights[state + piece] + (scores[piece] if piece < len(scores) else self.floor)
                if w < least[j]:
                    least[j], last[j], back[j] = w, piece, i
                if node is None:
                    break
        out, at = [], n
        while at:
            out.append(last[at])
            at = back[at]
        return out[::-1]

    def _unit(self, unit: str) -> bytes:
        # Where scores are equal, merge order decides: runs of spaces.
        if self.kind == BPE and unit.startswith(SPACE * 2):
            pieces = [self.arcs[p][0] if p in self.arcs else len(self.pieces) + ord(p) for p in self.merged(unit)]
        else:
            pieces = self.path(unit)
        ids = []
        for p in pieces:
            if p < len(self.pieces):
                ids.append(p)
            elif self.bytes:
                ids += [self.bytes[b] for b in self.text(p).encode()]
            elif not (ids and ids[-1] == self.unk):
                ids.append(self.unk)
        return np.array(ids, "<u4").tobytes()

    def normal(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(f"[ {SPACE}]+", " ", text).strip(" ")
        return (SPACE if self.prefix and text else "") + text.replace(" ", SPACE)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian unsigned 32-bit numbers."""
        units = self.cut.findall(self.normal(text))
        if max(map(len, units), default=0) > LONG_UNIT:
            return b"".join(self._unit(u) if len(u) > LONG_UNIT else self.units[u] for u in units)
        return b"".join(map(self.units.__getitem__, units))

    def decode(self, ids) -> str:
        raw = b"".join(map(self.out.__getitem__, ids))
        text = raw.decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


def encode(docs: DataFrame, model_path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and ``ids`` of each row's text."""
    keep = keep or ["doc_id"]
    workspace.small_batches(docs.sparkSession)
    slim = docs.select(*keep, F.col(text).cast("string").alias("__text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema)

    def run(batches):
        t = Transducer(model_path)
        for whole in batches:
            for b in slices(whole, len(keep)):
                ids = [None if x is None else np.frombuffer(t.encode(x), "<u4").astype(np.int32) for x in b.column(len(keep)).to_pylist()]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(ids, pa.list_(pa.int32()))], names=[*keep, "ids"])

    return slim.mapInArrow(run, f"{kinds}, ids array<int>")


def decode(encoded: DataFrame, model_path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns and the ``text`` of each row's ids."""
    keep = keep or ["doc_id"]
    workspace.small_batches(encoded.sparkSession)
    slim = encoded.select(*keep, F.col(ids).alias("__ids"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema)

    def run(batches):
        t = Transducer(model_path)
        for b in batches:
            texts = [None if x is None else t.decode(x) for x in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(texts, pa.string())], names=[*keep, "text"])

    return slim.mapInArrow(run, f"{kinds}, text string")


def op8_piece_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of little-endian 32-bit ids) and whether decoding gives the text back."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = workspace.table(spark, sf_dir, "documents")
    workspace.small_batches(spark)

    def run(batches):
        t = Transducer(model)
        for whole in batches:
            for b in slices(whole, 1):
                n, crc, same = [], [], []
                for text in b.column(1).to_pylist():
                    ids = t.encode(text or "")
                    n.append(len(ids) // 4)
                    crc.append(zlib.crc32(ids))
                    same.append(t.decode(np.frombuffer(ids, "<u4").tolist()) == (text or "").replace(SPACE, " "))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(same)], names=["doc_id", "n_tokens", "ids_crc32", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_crc32 bigint, decoded boolean")
