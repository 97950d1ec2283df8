"""Near-duplicate documents by circulant MinHash, banding and exact verification.

Shingles are runs of ``words`` words (a text with fewer has its whole sequence as one), hashed to 64 bits. Two fixed
permutations of 0 .. 2 ** 32 - 1 make every coordinate of the signature: the first scatters the shingles, the second
gives ranks, and coordinate k is the least rank after a circular shift by k. 160 coordinates in 32 bands of 5 miss a
pair at similarity 0.8 with a chance of 3e-6, and more similar ones with less.

Documents with equal shingle sets form one class and go on as its smallest id. Documents that share a bucket of a band
are candidates. A pair whose ends are in one component already implies nothing new, so what has to be verified are the
pairs of different components, and they are worked off in two steps, both on full sets and by exact counts:

* Rounds that contract. Each bucket has a centre, and each document is compared with one centre of its buckets that is
  in another component: at most one pair a document and round. Links join components, buckets of one component are
  done. Rounds go on while at least one pair in ``WORTH`` links, so groups of near copies shrink geometrically.
* All that is left, by a prefix join: the documents of unsettled buckets are joined on their rarest shingles. Of a pair
  that links, the shorter set has one of its first n - ceil(2 p n / (100 + p)) + 1 shingles among the prefix that the
  longer one has for sets of that size class, and no pair whose places leave too little overlap passes. So the join
  finds every pair of documents of different components that links; documents that merely share a template meet only
  where their rarest shingles do. On a shingle that one component dominates, its documents meet only those of others.

So no pair that shares a bucket is left out, and nothing is capped. Nothing is gathered: centres are partial
aggregates, joins are ones that adaptive execution can split.

Defined results: a null or empty text, or one without words, has no shingles and is linked with nothing; a null id
takes no part in links and is kept; rows that repeat an id are one document, to which all links of its texts
count; exact copies have one component; an empty table gives an empty result; other columns pass through untouched,
whatever their names."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace
from sonarloom.llm.memo import Memo, lean
from sonarloom.llm.token_counts import slices
from sonarloom.operators.components import components

BANDS, ROWS = 32, 5
COORDINATES = BANDS * ROWS
#: Least and most 64-bit words of a filter of ids; beyond eight ids a word the filter isn't used.
FILTER_WORDS = 1 << 14, 1 << 22
#: A contracting round is worth repeating while one pair in so many links.
WORTH = 20
#: Sizes of sets within this factor are one class of the prefix join.
CLASS = 1.05


def _scatter(x: np.ndarray) -> np.ndarray:
    """First permutation of 0 .. 2 ** 32 - 1: odd multiplications and shifts, each of which can be undone."""
    x = (x ^ x >> np.uint32(15)) * np.uint32(0x2C1B3C6D)
    x = (x ^ x >> np.uint32(12)) * np.uint32(0x297A2D39)
    return x ^ x >> np.uint32(15)


def _rank(x: np.ndarray) -> np.ndarray:
    """Second permutation of the same kind, in place."""
    x ^= x >> np.uint32(16)
    x *= np.uint32(0x7FEB352D)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x846CA68B)
    x ^= x >> np.uint32(16)
    return x


def signature(hashes: np.ndarray) -> np.ndarray:
    """All coordinates of a set of 64-bit hashes."""
    at = _scatter((hashes ^ hashes >> np.uint64(32)).astype(np.uint32))
    shifts = np.arange(COORDINATES, dtype=np.uint32)[:, None]
    least = np.full(COORDINATES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(at), 2048):
        np.minimum(least, _rank(at[None, k : k + 2048] + shifts).min(axis=1), out=least)
    return least


def bands(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of a signature, different in each band."""
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for part in sig.reshape(BANDS, ROWS).T.astype(np.uint64):
        key = (key ^ part) * np.uint64(0xBF58476D1CE4E5B9)
        key ^= key >> np.uint64(31)
    return key.view(np.int64)


class Shingles:
    """Distinct shingle hashes, in order, of each text of an Arrow array."""

    def __init__(self, words: int):
        self.words = words
        self.hash = Memo(lambda w: xxhash.xxh3_64_intdigest(w), 200_000)

    def sets(self, texts: pa.Array):
        texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))
        words = pc.ascii_split_whitespace(texts)
        coded = words.flatten().dictionary_encode()
        values = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = np.fromiter(map(self.hash.__getitem__, values), np.uint64, len(values))
        codes = coded.indices.to_numpy()
        full = np.array([bool(v) for v in values], bool)[codes] if len(values) else np.zeros(0, bool)
        all_, offsets = known[codes] if len(values) else np.zeros(0, np.uint64), words.offsets.to_numpy()
        offsets = offsets - offsets[0]
        for a, z in zip(offsets[:-1], offsets[1:]):
            h = all_[a:z][full[a:z]]  # leading and trailing white space leaves empty parts
            n = min(self.words, len(h))
            if not n:
                yield h
                continue
            # With fewer words than a shingle has, the number of words goes into the hash of their whole sequence.
            g = np.full(len(h) - n + 1, np.uint64(n))
            for k in range(n):
                g = (g ^ h[k : len(h) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                g ^= g >> np.uint64(29)
            yield np.unique(g)


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """doc, n (shingles), key (equal for equal sets) and band keys of each row of doc, text."""

    def run(batches):
        shingles = Shingles(words)
        for whole in batches:
            for b in slices(whole, 1):
                n, key, keys = [], [], []
                for h in shingles.sets(b.column(1)):
                    n.append(len(h))
                    key.append(xxhash.xxh3_128_digest(h.tobytes()))
                    keys.append(bands(signature(h)) if len(h) else np.zeros(0, np.int64))
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32), np.concatenate([np.zeros(0, np.int64), *keys]))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(key, pa.binary()), lists], names=["doc", "n", "key", "bands"])

    return docs.mapInArrow(lean(run), "doc bigint, n bigint, key binary, bands array<bigint>")


def bitmap(ids: DataFrame, count: int, plain: bool = False):
    """A Bloom filter of the ``count`` ids in column ``rep`` (hashes already, if ``plain``), two bits an id; None where they
    are too many for a filter of bounded size (32 MB). It is made by aggregation; what comes to the driver and goes out
    again is the filter."""
    least, most = FILTER_WORDS
    size = max(least, 1 << max(count // 8, 1).bit_length())
    if size > most:
        return None
    h = F.col("rep") if plain else F.xxhash64("rep")
    bits = ids.select(F.explode(F.array(h, F.shiftrightunsigned(h, 32))).alias("h"))
    word = F.pmod("h", F.lit(size)).cast("int").alias("word")
    made = bits.groupBy(word).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(h div %d, 64) as int))" % size)).alias("bits"))
    out = np.zeros(size, np.int64)
    for b in made.toArrow().to_batches():  # 12 bytes a word; rows as Python objects would be hundreds
        out[b.column(0).to_numpy()] = b.column(1).to_numpy()
    return ids.sparkSession.sparkContext.broadcast(out.view(np.uint64))


def passes(words: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether ids with these hashes may be in a filter."""
    out, size = np.ones(len(h), bool), len(words)
    for x in (h, (h.view(np.uint64) >> np.uint64(32)).view(np.int64)):
        # The same as pmod and div: the remainder is never negative, the quotient is cut towards zero.
        word, quotient = x % size, np.where(x < 0, -(-x // size), x // size)
        out &= (words[word] >> (quotient % 64).astype(np.uint64) & np.uint64(1)).astype(bool)
    return out


def shingle_sets(docs: DataFrame, words: int, wanted: DataFrame) -> DataFrame:
    """doc and its sorted shingle hashes, packed, of the documents in ``wanted`` (rep) and few more. Texts are only
    shuffled where the ids are too many for a filter."""
    among = bitmap(wanted, wanted.count())

    def run(batches):
        shingles = Shingles(words)
        for every in batches:
            whole = every.filter(pa.array(passes(among.value, every.column(2).to_numpy()))) if among else every
            for b in slices(whole, 1):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([h.tobytes() for h in shingles.sets(b.column(1))], pa.binary())], names=["doc", "hashes"])

    rows = docs.where("doc is not null")
    if among is None:
        rows = rows.join(wanted, F.col("doc") == F.col("rep"), "left_semi")
    return rows.withColumn("h", F.xxhash64("doc")).mapInArrow(lean(run), "doc bigint, hashes binary")


def links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b (of components own_a, own_b) whose sets have 100 * intersection >= percent * union."""

    def verify(batches):
        for batch in batches:
            for b in slices(batch, 5):
                good = []
                for x, y in zip(b.column(4), b.column(5)):
                    x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                        good.append(False)
                        continue
                    both = np.sort(np.concatenate([x, y]), kind="stable")
                    common = int((both[1:] == both[:-1]).sum())
                    good.append(100 * common >= percent * (len(x) + len(y) - common))
                keep = pa.array(good, pa.bool_())
                yield pa.RecordBatch.from_arrays([c.filter(keep) for c in b.columns[:4]], names=["a", "b", "own_a", "own_b"])

    left, right = (sets.select(F.col("doc").alias(f"{k}d"), F.col("hashes").alias(f"{k}h")) for k in "ab")
    # The many different documents first; a centre's set meets them in a join that can be split.
    wide = pairs.join(right, F.col("b") == F.col("bd")).join(left, F.col("a") == F.col("ad"))
    return wide.select("a", "b", "own_a", "own_b", "ah", "bh").mapInArrow(lean(verify), "a bigint, b bigint, own_a bigint, own_b bigint")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id of its group) and kept (it is that one) of every row."""
    spark = docs.sparkSession
    workspace.small_batches(spark)
    slim = docs.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).cast("string").alias("text"))
    made = workspace.materialize(signatures(slim, words), "signatures")
    real = made.where("n > 0 and doc is not null")
    classes = workspace.materialize(real.groupBy("key").agg(F.min("doc").alias("rep"), F.first("bands").alias("bands"), F.count("*").alias("rows")), "classes")
    # Buckets of two documents or more.
    members = classes.select(F.explode("bands").alias("band"), "rep")
    # Written out, so that the join's sides are exchanges of its own, which can be split where a bucket is hot.
    shared = workspace.materialize(members.groupBy("band").agg(F.count("*").alias("size")).where("size > 1").select("band"), "shared")
    members = workspace.materialize(members.join(shared, "band"), "buckets")
    sets = workspace.materialize(shingle_sets(slim, words, members.select("rep").distinct()), "sets")

    found = _components(members, sets, percent)
    # Classes are components of their own; a repeated id may stand in several.
    joined = classes.join(found, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("root", "rep").alias("root"))
    every = made.join(joined, "key", "left").withColumn("own", F.when((F.col("n") > 0) & F.col("doc").isNotNull(), F.coalesce("root", "doc")).otherwise(F.col("doc")))
    repeated = every.groupBy("doc").agg(F.min("own").alias("own_min"), F.max("own").alias("own_max")).where("own_min <> own_max and doc is not null")
    if not repeated.isEmpty():
        # An id with different texts ties their components together.
        ties = every.join(repeated.select("doc"), "doc").select(F.col("doc").alias("a"), F.col("own").alias("b"))
        tied = components(ties)
        every = every.join(tied, F.col("own") == F.col("node"), "left").withColumn("own", F.coalesce(tied["root"], "own"))
    return every.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("own").alias("component_id"), F.coalesce(F.col("doc") == F.col("own"), F.lit(True)).alias("kept")
    )


def _unsettled(named: DataFrame) -> DataFrame:
    """band, rep and own of the buckets that hold several components."""
    several = named.groupBy("band").agg(F.min("own").alias("lo"), F.max("own").alias("hi")).where("lo <> hi").select("band")
    return workspace.materialize(named.join(several, "band"), "buckets")


def _centre_pairs(named: DataFrame, turn: int) -> DataFrame:
    """a, b, own_a, own_b: each document with one centre of its buckets that is in another component.

    In the first round centres are the smallest ids, which different bands agree on; later they are picked by a hash."""
    pick = F.xxhash64(F.lit(turn), "band", "rep") if turn else F.col("rep")
    centres = named.groupBy("band").agg(F.min(F.struct(pick.alias("p"), "rep", "own")).alias("c"))
    met = named.join(centres, "band").where(F.col("own") != F.col("c.own"))
    which = F.xxhash64(F.lit(turn), "c.rep", "rep") if turn else F.col("c.rep")
    one = met.groupBy("rep").agg(F.min(F.struct(which.alias("p"), F.col("c.rep").alias("a"), F.col("c.own").alias("own_a"), "own")).alias("m"))
    return one.select("m.a", F.col("rep").alias("b"), "m.own_a", F.col("m.own").alias("own_b"))


def _components(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """node and root of the documents that links join; ``members`` are band and rep of all buckets."""
    named, every, turn = members.withColumn("own", F.col("rep")), [], 0
    while True:
        pairs = workspace.materialize(_centre_pairs(named, turn), "pairs")
        new = workspace.materialize(links(pairs, sets, percent), "links")
        tried, linked = pairs.count(), new.count()
        if linked:
            every.append(new)
            up = components(new, "own_a", "own_b")
            named = named.join(up, F.col("own") == F.col("node"), "left").select("band", "rep", F.coalesce("root", "own").alias("own"))
        named = _unsettled(named)
        if not turn:
            # Most buckets are one component now; what follows reads only the sets that the others need.
            sets = workspace.materialize(sets.join(named.select(F.col("rep").alias("doc")).distinct(), "doc", "left_semi"), "sets")
        turn += 1
        if WORTH * linked < tried or not linked:
            break
    rest = workspace.materialize(prefix_pairs(named.select("rep", "own").distinct(), sets, percent), "pairs")
    every.append(workspace.materialize(links(rest, sets, percent), "links"))
    out = every[0]
    for more in every[1:]:
        out = out.union(more)
    return components(out)


def prefix_pairs(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b, own_a, own_b: the pairs of documents (rep, own) of different components that can link, and few more."""

    def unpack(batches):
        for b in batches:
            for part in slices(b, 2, 1 << 20):
                packed = [np.frombuffer(x.as_buffer(), np.int64) for x in part.column(2)]
                n = np.array([len(x) for x in packed], np.int64)
                cols = [np.repeat(part.column(k).to_numpy(), n) for k in range(2)]
                # Rows that repeat an id with another text are sets of their own.
                row = np.repeat(np.array([xxhash.xxh3_64_intdigest(x.as_buffer()) for x in part.column(2)], np.uint64).view(np.int64), n)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*cols, row, np.repeat(n, n), np.concatenate([np.zeros(0, np.int64), *packed]))], names=["doc", "own", "row", "n", "h"])

    held = docs.join(sets, F.col("rep") == F.col("doc")).select("doc", "own", "hashes").distinct()
    tokens = workspace.materialize(held.mapInArrow(lean(unpack), "doc bigint, own bigint, row bigint, n bigint, h bigint"), "tokens")
    spread = workspace.materialize(tokens.groupBy("h").agg(F.count("*").alias("df")).where("df > 1"), "spread")
    # Rarest first; shingles of one set only come before all others and join nothing, so their number is enough.
    shared = tokens.join(spread, "h").groupBy("doc", "own", "row", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("t"))
    n, need = F.col("n"), lambda x: F.ceil(F.lit(percent) * x / F.lit(100 + percent)).cast("long")
    size = lambda x: F.floor(F.log(x.cast("double")) / float(np.log(CLASS))).cast("long")
    least = F.ceil(F.lit(percent) * n / 100).cast("long")
    alone = n - F.size("t")
    placed = shared.select("doc", "own", "n", least.alias("least"), F.slice("t", F.lit(1), F.greatest(n - least + 1 - alone, F.lit(0)).cast("int")).alias("t"), alone.alias("alone"))
    placed = placed.select("doc", "own", "n", "least", "alone", F.posexplode("t").alias("i", "t")).select("doc", "own", "n", "least", (F.col("alone") + F.col("i")).alias("p"), F.col("t.h").alias("h"))
    placed = workspace.materialize(placed, "prefixes")
    # As the shorter one of a pair, in the class of its size; as the longer one, in every class that a partner can have.
    index = placed.where(F.col("p") < n - need(2 * n) + 1).select("h", size(n).alias("c"), F.lit(0).alias("long"), "doc", "own", "n", "p")
    probe = placed.withColumn("c", F.explode(F.sequence(size(F.col("least")), size(n))))
    low = F.greatest(F.col("least"), F.floor(F.pow(F.lit(CLASS), F.col("c"))).cast("long") - 1)
    probe = probe.where(F.col("p") < n - need(n + low) + 1).select("h", "c", F.lit(1).alias("long"), "doc", "own", "n", "p")
    both = workspace.materialize(index.union(probe), "prefixes")
    counts = both.groupBy("h", "c", "own").agg(F.count("*").alias("rows"))
    main = counts.groupBy("h", "c").agg(F.max_by("own", F.struct("rows", "own")).alias("main"), F.count("*").alias("owns")).where("owns > 1").drop("owns")
    both = workspace.materialize(both.join(main, ["h", "c"]), "prefixes")
    found = None
    for mine, other in (("own <> main", "true"), ("own = main", "own <> main")):
        short = both.where("long = 0").where(mine).select("h", "c", F.col("doc").alias("a"), F.col("own").alias("own_a"), F.col("n").alias("n_a"), F.col("p").alias("p_a"))
        long_ = both.where("long = 1").where(other).select("h", "c", F.col("doc").alias("b"), F.col("own").alias("own_b"), F.col("n").alias("n_b"), F.col("p").alias("p_b"))
        first = (F.col("n_a") < F.col("n_b")) | (F.col("n_a") == F.col("n_b")) & (F.col("a") < F.col("b"))
        fits = first & (F.col("own_a") != F.col("own_b")) & (100 * F.col("n_a") >= percent * F.col("n_b"))
        fits = fits & (F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b")) >= need(F.col("n_a") + F.col("n_b")))
        pairs = short.join(long_, ["h", "c"]).where(fits).select("a", "b", "own_a", "own_b")
        found = pairs if found is None else found.union(pairs)
    return found.distinct()


def keep_one(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group."""
    gone = near_duplicates(docs, words, percent).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"))
    left = rows.join(gone, F.col("id") == F.col("gone"), "left_anti")
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(workspace.table(spark, sf_dir, "documents"), words=2)


#: All pairs that share a shingle, counted; ids are taken to be unique and not null.
ORACLE = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(w) = 1 THEN w[1] ELSE w[i] || ' ' || w[i + 1] END AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w), 2))) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY 1),
sized AS (SELECT doc_id, s, n FROM sh JOIN n USING (doc_id)),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM sized a JOIN sized b ON a.s = b.s AND a.doc_id < b.doc_id
           AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM common WHERE 100 * c >= 80 * (na + nb - c)),
e AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(x, y) AS (SELECT a, a FROM e UNION SELECT r.x, e.b FROM reach r JOIN e ON e.a = r.y),
root AS (SELECT x, min(y) AS root FROM reach GROUP BY x)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(root, w.doc_id) AS component_id, coalesce(root, w.doc_id) = w.doc_id AS kept FROM w LEFT JOIN n USING (doc_id) LEFT JOIN root ON root.x = w.doc_id"""
