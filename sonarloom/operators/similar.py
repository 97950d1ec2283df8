"""Groups of vectors that are joined by dot products of at least a threshold, inside blocks (equal ``by``), with no row a pair.

A block's vectors are dealt into tiles of about ``TILE``, and two tiles meet as matrices. A pair of tiles gives no more
links than it has vectors: a star for each group it joins. First all vectors meet the first tile of their block; most
vectors of a block that hangs together are one group then, and pairs inside it imply nothing new. The others meet one
another and that group, so every pair is either compared or inside one group already. Where little is linked, all pairs
are compared: the square of a block's size in products, its square by ``TILE`` in vectors moved.

Products are double precision; those too close to the threshold for the order of a sum not to matter are added up again
place by place. NaN counts as above every threshold, as in SQL. Vectors or ids that are null, vectors with a null
component and those of different lengths have no product; rows that repeat an id are no pair."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from sonarloom import workspace
from sonarloom.operators.components import components

#: Vectors in a tile.
TILE = 2048
#: Rows of a tile multiplied at once, and pairs added up again at once.
ROWS, AGAIN = 256, 1 << 16
KEYS = ["label", "d"]


def hits(x: np.ndarray, y: np.ndarray, least: float) -> np.ndarray:
    """Whether the dot product of each row of ``x`` with each of ``y`` is at least ``least``."""
    out = np.empty((len(x), len(y)), bool)
    with np.errstate(all="ignore"):
        length = [np.sqrt((v * v).sum(1)) for v in (x, y)]
        most = [v[np.isfinite(v)].max(initial=0.0) for v in length]
        close = 1e-14 * (x.shape[1] + 1) * most[0] * most[1]
        for k in range(0, len(x), ROWS):
            s = x[k : k + ROWS] @ y.T
            out[k : k + ROWS] = ~(s < least)
            a, b = np.nonzero(np.abs(s - least) <= close)
            for m in range(0, len(a), AGAIN):
                p, q = a[m : m + AGAIN] + k, b[m : m + AGAIN]
                total = np.zeros(len(p))
                for i in range(x.shape[1]):
                    total += x[p, i] * y[q, i]
                out[p, q] = ~(total < least)
    return out


def stars(hit: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each group that ``hit`` joins of rows (ids ``a``) and columns (ids ``b``): one of its ids, beside each of its ids."""
    turned, roots, nodes = np.ascontiguousarray(hit.T), [], []
    rows, columns = hit.any(1), hit.any(0)
    for first in np.flatnonzero(rows):
        if not rows[first]:
            continue
        rows[first] = False
        front, group = np.array([first]), [a[[first]]]
        while len(front):
            right = np.flatnonzero(hit[front].any(0) & columns)
            columns[right] = False
            front = np.flatnonzero(turned[right].any(0) & rows)
            rows[front] = False
            group += [b[right], a[front]]
        ids = np.unique(np.concatenate(group))
        roots.append(np.full(len(ids), ids[0]))
        nodes.append(ids)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *roots]), np.concatenate([none, *nodes])


def _met(rows: DataFrame, least: float, blocks: int) -> DataFrame:
    """Links a, b of the groups of label, d, i, j, in which the vectors of side 0 meet those of side 1."""

    def meet(key, table):
        side, ids = table.column("side").to_numpy(), table.column("id").to_numpy()
        e = pa.concat_arrays(table.column("e").chunks).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(ids), key[1].as_py())
        left, right = side == 0, side == 1
        hit = hits(e[left], e[right], least) & (ids[left][:, None] != ids[right][None, :])
        roots, nodes = stars(hit, ids[left], ids[right])
        return pa.table({"a": roots, "b": nodes})

    spark = rows.sparkSession
    # A number of its own: tiles are few bytes for the work they are, and would be put together by their size.
    n = max(1, min(2 * blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)))
    dealt = rows.select(*KEYS, "i", "j", "side", "id", "e").repartition(n, *KEYS, "i", "j")
    return workspace.materialize(dealt.groupBy(*KEYS, "i", "j").applyInArrow(meet, "a bigint, b bigint").where("a <> b"), "links")


def similar_components(rows: DataFrame, by: str, key: str, vec: str, least: float, tile: int = TILE) -> DataFrame:
    """``node`` and ``root`` (smallest id of its group) of every id that has a product of at least ``least`` with another
    one of its block."""
    floats = rows.schema[vec].dataType == ArrayType(FloatType(), rows.schema[vec].dataType.containsNull)
    e = F.col(vec) if floats else F.col(vec).cast("array<double>")
    slim = rows.select(F.col(by).alias("label"), F.col(key).cast("long").alias("id"), e.alias("e")).where("label is not null and id is not null and e is not null and not exists(e, x -> x is null)")
    # Numbers that rows keep: tiles are dealt by them, so that repeated ids and vectors are spread like others.
    slim = workspace.materialize(slim.withColumn("d", F.size("e")).withColumn("at", F.monotonically_increasing_id()), "vectors")
    in_tiles = lambda n: F.ceil(n / F.lit(tile)).cast("int")
    sizes = workspace.materialize(slim.groupBy(*KEYS).agg(F.count("*").alias("n")).select(*KEYS, in_tiles(F.col("n")).alias("k")), "sizes")
    blocks, most = sizes.agg(F.sum("k"), F.max("k")).first()
    tiles = slim.join(sizes, KEYS).withColumn("t", F.pmod(F.xxhash64("at"), F.col("k")).cast("int"))
    hubs = tiles.where("t = 0").withColumns({"i": F.lit(0), "j": F.explode(F.expr("sequence(0, k - 1)")), "side": F.lit(0)})
    every = tiles.withColumns({"i": F.lit(0), "j": F.col("t"), "side": F.lit(1)})
    columns = [*KEYS, "i", "j", "side", "id", "e"]
    links = _met(hubs.select(columns).union(every.select(columns)), least, blocks or 0)
    if (most or 0) > 1:
        links = links.union(_others(tiles, links, least, in_tiles))
    return components(links)


def _others(tiles: DataFrame, links: DataFrame, least: float, in_tiles) -> DataFrame:
    """Links of the vectors that are outside the largest group of their block after its first tile has met all."""
    up = components(links)
    # Vectors of first tiles have met all.
    owned = tiles.where("t > 0").drop("k", "t").join(up, F.col("id") == F.col("node"), "left")
    owned = workspace.materialize(owned.select(*KEYS, "id", "e", "at", F.coalesce("root", "id").alias("own")), "owned")
    groups = owned.groupBy(*KEYS, "own").agg(F.count("*").alias("n")).groupBy(*KEYS)
    main = groups.agg(F.max_by("own", F.struct("n", "own")).alias("main"), F.max("n").alias("in_main"), F.sum("n").alias("n"))
    main = main.select(*KEYS, "main", in_tiles(F.col("n") - F.col("in_main")).alias("kr"), in_tiles(F.col("in_main")).alias("km"))
    main = workspace.materialize(main.where("kr > 0"), "sizes")
    blocks = main.agg(F.sum(F.expr("kr * (kr + 1L) div 2 + kr * bigint(km)"))).first()[0] or 0
    dealt = owned.join(main, KEYS).withColumn("rest", F.col("own") != F.col("main"))
    # Tiles of the others are numbered first, those of the largest group after them.
    dealt = dealt.withColumn("t", F.when(F.col("rest"), F.pmod(F.xxhash64("at"), "kr")).otherwise(F.col("kr") + F.pmod(F.xxhash64("at"), "km")).cast("int"))
    columns = [*KEYS, "i", "j", "side", "id", "e"]
    left = dealt.where("rest").withColumns({"i": F.col("t"), "j": F.explode(F.expr("sequence(t, kr + km - 1)")), "side": F.lit(0)})
    right = dealt.withColumns({"j": F.col("t"), "i": F.explode(F.expr("sequence(0, least(t, kr - 1))")), "side": F.lit(1)})
    return _met(left.select(columns).union(right.select(columns)), least, blocks)
