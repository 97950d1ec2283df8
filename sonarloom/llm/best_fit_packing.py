"""Best-fit packing of documents into sequences of fixed capacity, in bulk-synchronous supersteps.

Lengths are whole numbers of at most the capacity, so documents of one length are carried as a run: one row with a
count, whose members are told apart by rank. Ranks are made in a distributed way: the task that makes a piece gives it a
rank among its own pieces of that length, and offsets of the tasks are added by a cumulated sum of counts. Open gaps are
runs too: a size and an interval of sequences.

A superstep is a Spark job. Documents and gaps are range-sorted together by size, and every range is swept from large to
small: a run of documents takes its successor, the smallest gap that fits and is still free; the conflict of documents
over a gap is resolved by rank, as many to a sequence as fit. What a range can't match (documents with no gap above
them, gaps with no document below them) meets in a sweep over the leftovers of all ranges. The outcome doesn't depend on
where ranges are cut. Then gaps are updated, the result is written to the shared folder, and the next superstep reads
it. Lengths are taken by halves, (capacity / 2, capacity] first, so that what a superstep leaves of a gap is offered to
the same lengths again before shorter ones use it; new sequences are opened only when no gap fits any document left.

The driver only sees sizes and counts of runs (at most two rows a size and the intervals of gaps) to choose the next
superstep, and in the end the matches, intervals of ranks onto intervals of sequences, which go back to the tasks that
place the rows. A superstep adds at most two gap rows for each length it handles, so all of this depends on the capacity
and the number of supersteps and not on the number of documents.

The number of sequences is near that of sequential best-fit decreasing: sometimes a few in ten thousand more.

Defined results: a null text is empty; a document of no tokens is its separator alone; only documents longer
than the capacity are cut, into full pieces and a rest; repeated rows are packed each for itself; an empty table
gives an empty result; extra columns of the input are ignored."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonarloom import workspace
from sonarloom.llm.memo import lean
from sonarloom.llm.token_counts import slices
from sonarloom.llm.word_bpe import WordBpe

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, task int, task_rank bigint"
#: A gap has its first sequence as ``start``, a run of documents its first rank; both have ``n`` members. A match puts ``n``
#: documents into sequences from ``first`` on, at offset ``at``, ``per`` to a sequence.
STATE = "kind bigint, size bigint, start bigint, n bigint, first bigint, at bigint, per bigint"
PLACED = f"{STATE}, range bigint, place bigint"
GAP, RUN, MATCH, UPDATED = range(4)
RANGES = 8


def pieces(docs: DataFrame, tokenizer: str, capacity: int, separator: int = 0, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per piece of a document, ranked among the pieces of its length that its task has made."""
    workspace.small_batches(docs.sparkSession)
    end = np.array([separator], "<u4").tobytes()

    def run(batches):
        encoder, task = WordBpe(tokenizer), TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for whole in batches:
            for b in slices(whole, 1):
                cols: list[list] = [[] for _ in range(7)]
                for i, ids in zip(b.column(0).to_pylist(), encoder.batch(b.column(1))):
                    tokens = len(ids) + 1
                    for k, at in enumerate(range(0, tokens, capacity)):
                        part = np.ascontiguousarray(ids[at : at + capacity])
                        n = min(capacity, tokens - at)
                        crc = zlib.crc32(part)
                        for c, v in zip(cols, (i, k, at, n, crc if n == len(part) else zlib.crc32(end, crc), task, ranks[n])):
                            c.append(v)
                        ranks[n] += 1
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in PIECES.split(", ")])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(lean(run), PIECES)


def successors(rows: Iterable[tuple], capacity: int, longest: int) -> list[tuple]:
    """One sweep over rows of ``STATE``, sorted by descending size with gaps before runs of their size. What a match leaves
    of a gap goes on at once if all documents fit (``longest``), else it comes out as ``UPDATED`` for the next superstep.
    Runs left come out in order, then free gaps in the order in which a sweep that goes on must meet them."""
    free: list[tuple[int, int, int]] = []  # the next to take last
    out = []
    for row in rows:
        kind, size, start, n = row[:4]
        if kind == GAP:
            free.append((size, start, n))
        elif kind == RUN:
            while n and free:
                gap, first, many = free.pop()
                most, again = gap // size, []
                for per in (most, n % most):  # full sequences, then one with the rest
                    used = min(many, n // per) if per else 0
                    if used:
                        out.append((MATCH, size, start, used * per, first, capacity - gap, per))
                        start, n, first, many = start + used * per, n - used * per, first + used, many - used
                        rest = (gap - per * size, first - used, used)
                        if rest[0] >= longest:
                            again.append(rest)
                        elif rest[0]:
                            out.append((UPDATED, *rest, 0, 0, 0))
                if many:
                    free.append((gap, first, many))
                free += again
            if n:
                out.append((RUN, size, start, n, 0, 0, 0))
        else:
            out.append(row)
    return out + [(GAP, *g, 0, 0, 0) for g in free]


def to_open(left: dict[int, int], capacity: int) -> int:
    """How many sequences to open for runs that fit no gap: as the longest need, as far as shorter ones would not
    fill what those leave."""
    lengths = sorted(left)
    need, low, rest = 0.0, 0, left[lengths[0]]
    for high in range(len(lengths) - 1, -1, -1):
        if high < low:
            break
        most = capacity // lengths[high]
        gap, share = capacity - most * lengths[high], (rest if high == low else left[lengths[high]]) / most
        need += share
        while low < high and lengths[low] <= gap and share > 0:
            fit = gap // lengths[low]
            take = min(rest, share * fit)
            share, rest = share - take / fit, rest - take
            if rest > 0:
                break
            low += 1
            rest = left[lengths[low]]
    return max(1, math.ceil(need))


def supersteps(lengths: dict[int, int], capacity: int, step: Callable[[int, int, bool, int, int], tuple[dict[int, int], int]]) -> None:
    """Call ``step(shortest, longest, enter, first, opened)`` until all runs (length -> number) are placed. It lets the
    runs of these lengths enter, opens sequences, sweeps, and returns the runs left and the widest gap."""
    widest = sequences = 0
    high = capacity
    while high:
        left = {k: n for k, n in lengths.items() if high // 2 < k <= high}
        enter = True
        while left:
            opened = to_open(left, capacity) if widest < min(left) else 0
            left, widest = step(high // 2 + 1, high, enter, sequences, opened)
            sequences, enter = sequences + opened, False
        high //= 2


def seen(rows: Iterable[tuple]) -> tuple[dict[int, int], int]:
    """Runs left (length -> number) and the widest gap."""
    left: Counter = Counter()
    widest = 0
    for kind, size, n in rows:
        if kind == RUN:
            left[size] += n
        elif kind == GAP:
            widest = max(widest, size)
    return dict(left), widest


def ordered(matches: Iterable[tuple]) -> np.ndarray:
    """Rows in order of length and rank: length, first rank, number, first sequence, offset, rows per sequence."""
    return np.array(sorted(matches), np.int64).reshape(-1, 6)


def sweep(runs: dict[int, int], capacity: int) -> np.ndarray:
    """All supersteps in this process, without Spark: for small inputs, and to compare with."""
    state: list[tuple] = []
    matches: list[tuple] = []

    def step(shortest: int, longest: int, enter: bool, first: int, opened: int):
        rows = state + [(RUN, k, 0, n) for k, n in runs.items() if enter and shortest <= k <= longest]
        rows += [(GAP, capacity, first, opened)] if opened else []
        out = successors(sorted(rows, key=lambda r: (-r[1], r[0], r[2])), capacity, longest)
        matches.extend(r[1:] for r in out if r[0] == MATCH)
        state[:] = [(GAP if r[0] == UPDATED else r[0], *r[1:]) for r in out if r[0] != MATCH]
        return seen((r[0], r[1], r[3]) for r in state)

    supersteps(runs, capacity, step)
    return ordered(matches)


def swept(state: DataFrame, capacity: int, longest: int) -> DataFrame:
    """A superstep: a sweep of each range, and one over what the ranges leave, in the order of ranges."""

    def sweeps(last: bool):
        def run(batches):
            rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns[:7]))]
            out = successors(rows, capacity, longest)
            if out:
                if last:
                    out = [(GAP if r[0] == UPDATED else r[0], *r[1:]) for r in out]
                else:
                    out = [(*r, TaskContext.get().partitionId(), i) for i, r in enumerate(out)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=[x.split()[0] for x in (STATE if last else PLACED).split(", ")])

        return run

    order = [F.desc("size"), F.asc("kind"), F.asc("start")]
    ranges = state.repartitionByRange(RANGES, *order).sortWithinPartitions(*order).mapInArrow(sweeps(False), PLACED)
    return ranges.repartition(1).sortWithinPartitions("range", "place").mapInArrow(sweeps(True), STATE)


def matched(runs: DataFrame, capacity: int) -> np.ndarray:
    """Matches of runs (length, n) with sequences, by supersteps over tables in the shared folder."""
    spark = runs.sparkSession
    paths: list[str] = []
    with workspace.scratch(spark):
        none = [F.lit(0).cast("bigint").alias(c) for c in ("first", "at", "per")]
        runs = workspace.materialize(runs.select(F.lit(RUN).cast("bigint").alias("kind"), F.col("length").cast("bigint").alias("size"), F.lit(0).cast("bigint").alias("start"), "n", *none), "runs")

        def step(shortest: int, longest: int, enter: bool, first: int, opened: int):
            rows = [spark.read.schema(STATE).parquet(paths[-1]).where(F.col("kind").isin(GAP, RUN))] if paths else []
            if enter:
                rows.append(runs.where(F.col("size").between(shortest, longest)))
            if opened:
                new = {"kind": GAP, "size": capacity, "start": first, "n": opened}
                rows.append(spark.range(1).select(*(F.lit(v).cast("bigint").alias(c) for c, v in new.items()), *none))
            paths.append(workspace.new_folder(spark, "superstep"))
            state = workspace.materialize(swept(reduce(DataFrame.unionAll, rows), capacity, longest), "superstep", paths[-1])
            return seen(state.where(F.col("kind").isin(GAP, RUN)).select("kind", "size", "n").collect())

        supersteps({r["size"]: r["n"] for r in runs.select("size", "n").collect()}, capacity, step)
        if not paths:
            return ordered([])
        return ordered(map(tuple, spark.read.schema(STATE).parquet(*paths).where(F.col("kind") == MATCH).drop("kind").collect()))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, separator: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    made = workspace.materialize(pieces(docs, tokenizer, capacity, separator), "pieces")
    # Rows of each length by task: at most one row for a task and a length.
    counts = made.groupBy("task", "length").agg((F.max("task_rank") + 1).alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task")) - F.col("n")
    offsets = counts.select("task", "length", "n", before.alias("before"))
    runs = counts.groupBy("length").agg(F.sum("n").alias("n"))
    found = docs.sparkSession.sparkContext.broadcast(matched(runs, capacity))

    def place(batches):
        m = found.value
        # Length and first rank as one ordered key; ranks stay below 2 ** 44.
        key = m[:, 0] << 44 | m[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("task_rank").to_numpy() + b.column("before").to_numpy()
            at = m[np.searchsorted(key, length << 44 | rank, side="right") - 1]
            n = rank - at[:, 1]
            cols = [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            cols += [pa.array(at[:, 3] + n // at[:, 5], pa.int64()), pa.array(at[:, 4] + n % at[:, 5] * length, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return made.join(offsets, ["task", "length"]).mapInArrow(lean(place), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(workspace.table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
