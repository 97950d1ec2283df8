"""Approximate nearest neighbours by inner product: a hierarchical navigable small-world graph per shard.

Rows are dealt to shards by a hash of their id, so shards are about equal whatever the vectors are. In a shard, equal
vectors are one node that lists its smallest ids (as many as an answer can need). Nodes are lengthened by one
coordinate so that all have the same norm; nearest by inner product and nearest by angle are then the same. A graph
is flat arrays: per layer, a row of neighbour numbers for each node. Nodes are inserted in blocks that search the
graph built so far in step with one another; each block is also compared within itself. The index is a table of one
row per shard in the shared folder.

Queries come in blocks; each block visits each shard once, and each shard returns its best ``k`` for each query,
scored exactly in double precision on the original vectors. The final ranking is per query over ``k`` rows a shard.

Defined results: vectors that are null, zero, of another length than the commonest, or hold null, NaN or infinite
parts take no part, nor do rows with a null id; ties go to the smaller id; rows that repeat an id are separate
candidates, but none is a neighbour of its own id; rows that repeat an id are one query if their vectors are equal, else
queries with an answer each, told apart by ``query_hash``; an empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonarloom import workspace

#: Rows of a shard, neighbours of a node (twice as many in the lowest layer), beams when building and searching.
SHARD_ROWS, M, EF_BUILD, EF_SEARCH = 32768, 16, 80, 160
#: Rows inserted together; queries that visit a shard together, so that a graph is moved once for as many of them.
BLOCK, QUERY_BLOCK = 256, 32768


class Graph:
    """Layers of neighbour numbers over unit vectors; -1 is no neighbour."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        self.x = np.ascontiguousarray(x, np.float32)
        n = len(x)
        draw = np.random.default_rng(seed).random(n)
        self.level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(M)).astype(np.int64), 8)
        self.layers = [np.full((n, 2 * M if k == 0 else M), -1, np.int32) for k in range((self.level.max() if n else 0) + 1)]
        self.entry, self.top, done = -1, -1, 0
        while done < n:
            # Blocks grow with the graph: nodes of one block don't meet through it.
            size = min(BLOCK, max(32, done // 4), n - done)
            self._insert(np.arange(done, done + size))
            done += size

    def _insert(self, new: np.ndarray) -> None:
        q = self.x[new]
        inside = q @ q.T
        np.fill_diagonal(inside, -np.inf)
        at = np.full(len(new), self.entry)
        for layer in range(max(self.top, int(self.level[new].max())), -1, -1):
            here = self.level[new] >= layer
            if self.entry >= 0 and layer <= self.top:
                # Nodes that stay below this layer only pass through.
                if not here.all():
                    ids, _ = self.search(q[~here], at[~here], 1, layer)
                    at[~here] = ids[:, 0]
                if here.any():
                    ids, sims = self.search(q[here], at[here], EF_BUILD, layer)
                    at[here] = ids[:, 0]
            if here.any():
                own = np.flatnonzero(here)
                near = np.where(here[None, :], inside[own], -np.inf)
                k = min(EF_BUILD, near.shape[1])
                pick = np.argpartition(-near, k - 1, axis=1)[:, :k]
                cand, sim = np.where(np.isfinite(np.take_along_axis(near, pick, 1)), new[pick], -1), np.take_along_axis(near, pick, 1)
                if self.entry >= 0 and layer <= self.top:
                    cand, sim = np.concatenate([ids, cand], 1), np.concatenate([sims, sim], 1)
                self._link(new[own], cand, sim, layer)
        best = int(self.level[new].argmax())
        if self.level[new[best]] > self.top:
            self.entry, self.top = int(new[best]), int(self.level[new[best]])

    def _spread(self, cand: np.ndarray, sim: np.ndarray, most: int) -> np.ndarray:
        """Up to ``most`` candidates a row: first those nearer to the row's node than to any chosen one, then the nearest left."""
        width = min(cand.shape[1], EF_BUILD)
        order = np.argsort(-np.where(cand >= 0, sim, -np.inf), axis=1, kind="stable")[:, :width]
        cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
        v = self.x[np.maximum(cand, 0)]
        between = v @ v.transpose(0, 2, 1)
        chosen, count = np.zeros(cand.shape, bool), np.zeros(len(cand), int)
        nearest = np.full(cand.shape, -np.inf, np.float32)  # of each candidate to those chosen
        for j in range(width):
            good = (cand[:, j] >= 0) & (count < most) & (sim[:, j] > nearest[:, j])
            chosen[:, j] = good
            count += good
            nearest = np.where(good[:, None], np.maximum(nearest, between[:, j]), nearest)
        rank = np.where(cand < 0, 2 * width, np.where(chosen, 0, width) + np.arange(width))
        keep = np.argsort(rank, axis=1, kind="stable")[:, :most]
        return np.take_along_axis(cand, keep, 1)

    def _link(self, nodes: np.ndarray, cand: np.ndarray, sim: np.ndarray, layer: int) -> None:
        links = self.layers[layer]
        out = self._spread(cand, sim, M)
        links[nodes, : out.shape[1]] = out
        # Backward links: to each neighbour, sorted so that one target's new ones stand together.
        to, back = out.ravel(), np.repeat(nodes, out.shape[1])
        to, back = to[to >= 0], back[to >= 0]
        order = np.argsort(to, kind="stable")
        to, back = to[order], back[order]
        targets, first, count = np.unique(to, return_index=True, return_counts=True)
        if not len(targets):
            return
        more = np.full((len(targets), int(count.max())), -1, np.int64)
        more[np.repeat(np.arange(len(targets)), count), np.arange(len(to)) - np.repeat(first, count)] = back
        both = np.concatenate([links[targets], more], 1)
        # Nodes of one block can be neighbours both ways already.
        srt = np.sort(both, axis=1)
        twice = np.concatenate([np.zeros((len(srt), 1), bool), (srt[:, 1:] == srt[:, :-1])], 1)
        both = np.where(twice, -1, srt)
        s = np.einsum("nkd,nd->nk", self.x[np.maximum(both, 0)], self.x[targets])
        s = np.where(both >= 0, s, -np.inf)
        width = links.shape[1]
        full = (both >= 0).sum(1) > width
        if (~full).any():
            keep = np.argsort(-s[~full], axis=1, kind="stable")[:, :width]
            links[targets[~full], : keep.shape[1]] = np.take_along_axis(both[~full], keep, 1)
        if full.any():
            links[targets[full]] = self._spread(both[full], s[full], width)

    def search(self, q: np.ndarray, start: np.ndarray, ef: int, layer: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the beam of each query, best first; all queries step together."""
        b, links = len(q), self.layers[layer]
        ids, sims = np.full((b, ef), -1, np.int64), np.full((b, ef), -np.inf, np.float32)
        open_ = np.zeros((b, ef), bool)
        seen = np.zeros((b, len(self.x)), bool)
        ids[:, 0], sims[:, 0], open_[:, 0] = start, np.einsum("bd,bd->b", q, self.x[start]), True
        seen[np.arange(b), start] = True
        live = np.arange(b)
        while len(live):
            # Beams are in order: the first open one is the best.
            pick = open_[live].argmax(1)
            node = ids[live, pick]
            open_[live, pick] = False
            near = links[node].astype(np.int64)
            fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
            seen[live[:, None], np.maximum(near, 0)] |= near >= 0
            s = np.einsum("bkd,bd->bk", self.x[np.maximum(near, 0)], q[live])
            s = np.where(fresh, s, -np.inf).astype(np.float32)
            all_s = np.concatenate([sims[live], s], 1)
            all_i = np.concatenate([ids[live], np.where(fresh, near, -1)], 1)
            all_o = np.concatenate([open_[live], fresh], 1)
            order = np.argsort(-all_s, axis=1, kind="stable")[:, :ef]
            sims[live], ids[live], open_[live] = (np.take_along_axis(a, order, 1) for a in (all_s, all_i, all_o))
            live = live[open_[live].any(1)]
        return ids, sims

    def nearest(self, q: np.ndarray, ef: int) -> np.ndarray:
        """Node numbers of each query's beam in the lowest layer; -1 where the beam isn't full."""
        at = np.full(len(q), self.entry)
        for layer in range(self.top, 0, -1):
            at = self.search(q, at, 1, layer)[0][:, 0]
        return self.search(q, at, ef, 0)[0]

    def dump(self) -> bytes:
        f = io.BytesIO()
        np.savez(f, x=self.x, entry=self.entry, top=self.top, **{f"layer{k}": v for k, v in enumerate(self.layers)})
        return f.getvalue()

    @classmethod
    def load(cls, data: bytes) -> Graph:
        self, z = cls.__new__(cls), np.load(io.BytesIO(data))
        self.x, self.entry, self.top = z["x"], int(z["entry"]), int(z["top"])
        self.layers = [z[f"layer{k}"] for k in range(len(z.files) - 3)]
        return self


def same_norm(x: np.ndarray) -> np.ndarray:
    """One coordinate more gives all rows the largest norm; then all are divided by it."""
    x = x.astype(np.float64)
    square = (x * x).sum(1)
    top = square.max()
    return (np.concatenate([x, np.sqrt(np.maximum(top - square, 0))[:, None]], 1) / np.sqrt(top)).astype(np.float32)


def valid(df: DataFrame, vec: str, vec_id: str) -> DataFrame:
    """id and v (floats, as given) of the rows that take part."""
    v = F.col("v")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vec).alias("v")).where("id is not null and v is not null")
    return rows.where((F.size(v) > 0) & F.forall(v, fine) & F.exists(v, lambda x: x != 0))


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1)


def build(rows: DataFrame, shards: int, k: int) -> DataFrame:
    """shard and its index, packed."""

    def index(key, table):  # without annotations: Spark reads them, and these are texts here
        ids, x = table.column("id").to_numpy(), _matrix(table.column("v"))
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], np.ascontiguousarray(x[order])
        # One node for equal vectors; its ids in order, no more than can be in an answer.
        _, first, node = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
        by = np.argsort(node, kind="stable")
        count = np.bincount(node)
        nth = np.arange(len(by)) - np.repeat(np.cumsum(count) - count, count)
        by = by[nth < k + 1]
        f = io.BytesIO()
        np.savez(f, vectors=x[first], node=node[by], ids=ids[by], graph=np.frombuffer(Graph(same_norm(x[first])).dump(), np.uint8))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "index": pa.array([f.getvalue()], pa.binary())})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    # By ranges, each shard is a task of its own; groups by hash would be joined into a few.
    return dealt.repartitionByRange(shards, "shard").groupBy("shard").applyInArrow(index, "shard int, index binary")


def search_shard(packed: bytes, ids: np.ndarray, q: np.ndarray, k: int, ef: int):
    """(places in ``ids``, vec ids, scores) of each query's best k in a shard, scored exactly."""
    z = np.load(io.BytesIO(packed))
    vectors, graph = z["vectors"].astype(np.float64), Graph.load(z["graph"].tobytes())
    start = np.concatenate([[0], np.cumsum(np.bincount(z["node"], minlength=len(vectors)))])
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(q), 512):
        some, own = q[a : a + 512].astype(np.float64), ids[a : a + 512]
        unit = some / np.linalg.norm(some, axis=1, keepdims=True)
        found = graph.nearest(np.concatenate([unit, np.zeros((len(unit), 1))], 1).astype(np.float32), max(ef, k + 1))
        r, c = np.nonzero(found >= 0)
        nodes = found[r, c]
        score = np.einsum("nd,nd->n", some[r], vectors[nodes])
        # Each node stands for its ids.
        size = start[nodes + 1] - start[nodes]
        at = np.repeat(start[nodes] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        r, score, vec = np.repeat(r, size), np.repeat(score, size), z["ids"][at]
        other = vec != own[r]
        r, score, vec = r[other], score[other], vec[other]
        order = np.lexsort((vec, -score, r))
        r, score, vec = r[order], score[order], vec[order]
        n = np.bincount(r, minlength=len(own))
        best = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n) < k
        out.append((a + r[best], vec[best], score[best]))
    return [np.concatenate(c) for c in zip(*out)]


def nearest(df: DataFrame, queries: DataFrame, k: int = 20, vec: str = "embedding", vec_id: str = "vec_id", shard_rows: int = SHARD_ROWS, ef: int = EF_SEARCH) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's ``k`` nearest rows of ``df`` found."""
    spark = df.sparkSession
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double, query_hash bigint")
    rows = valid(df, vec, vec_id)
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return empty
    shards = -(-sizes["n"] // shard_rows)
    index = workspace.materialize(build(rows.where(F.size("v") == sizes["d"]), shards, k), "graphs")
    asked = valid(queries, vec, vec_id).where(F.size("v") == sizes["d"]).withColumn("hash", F.xxhash64("v")).dropDuplicates(["id", "hash"])
    blocks = -(-max(asked.count(), 1) // QUERY_BLOCK)
    # Blocks of queries are bounded: ids are dealt by hash.
    packed = asked.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")).agg(F.collect_list(F.struct("id", "v", "hash")).alias("q"))
    visits = packed.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).repartition(shards, "shard")
    pairs = visits.join(index.repartition(shards, "shard"), "shard").select("index", "q")

    def run(batches):
        for b in batches:
            for j in range(len(b)):
                q = b.column(1)[j].values
                ids = q.field("id").to_numpy()
                at, found, score = search_shard(b.column(0)[j].as_py(), ids, _matrix(q.field("v")), k, ef)
                columns = [pa.array(ids[at]), pa.array(q.field("hash").to_numpy()[at]), pa.array(found, pa.int64()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "query_hash", "vec_id", "score"])

    workspace.small_batches(spark)
    found = pairs.mapInArrow(run, "query_id bigint, query_hash bigint, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score", "query_hash").where(F.col("rank") <= k)


def op10_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = workspace.table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))
