"""Line dedup by distinct-site spread.

A HyperLogLog sketch of the sites of each line hash is merged by aggregation, map side first. Lines whose
estimate lies near the threshold get an exact distinct count; lines clearly above are taken at once. A line
found on ``min_sites`` sites or more is boilerplate: it stays in its first document (smallest id) and goes from
all others. Built-in functions throughout; hot lines and hot sites are sums of partial aggregates, and the join
that finds a boilerplate line's documents is one that adaptive execution can split.

Lines are the parts between newlines that hold a character other than space and U+0009..U+000D, compared whole.
They are told apart by 64-bit hashes.

Defined results: a null text stays null and has no lines; a null site is one site more; a null id comes after all
others and is matched as a value; rows that repeat an id share its decisions, so all copies of the first
document's row keep their lines; lines repeated inside one document are left; a document that loses all its lines
stays, with an empty text; other columns pass through untouched, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace

LG_K = 12
#: Relative standard error of such a sketch.
ERROR = 1.04 / 2 ** (LG_K / 2)


def _lines(text: str):
    return F.split(F.col(text), "\n")


def _has_word(line):
    return line.rlike("[^ \\t-\\r]")


def occurrences(docs: DataFrame, text: str, doc_id: str, site: str) -> DataFrame:
    """h, doc and site of every line that has a word."""
    hashes = F.transform(F.filter(_lines(text), _has_word), lambda x: F.xxhash64(x))
    site = F.concat(F.when(F.col(site).isNull(), "0").otherwise("1"), F.coalesce(F.col(site).cast("string"), F.lit("")))
    return docs.select(F.col(doc_id).alias("doc"), site.alias("site"), F.explode(hashes).alias("h"))


def boilerplate(seen: DataFrame, min_sites: int) -> DataFrame:
    """h and first document of the lines that are spread over ``min_sites`` sites or more."""
    lines = workspace.materialize(
        seen.groupBy("h").agg(F.count("*").alias("n"), F.min("doc").alias("first"), F.hll_sketch_agg("site", LG_K).alias("sites"))
        # A line can't be on more sites than it has occurrences.
        .where(F.col("n") >= min_sites)
        .select("h", "first", F.hll_sketch_estimate("sites").alias("spread")),
        "spread",
    )
    # Ten standard errors and two sites: beyond that no estimate is on the wrong side.
    band = 2 + 10 * ERROR * min_sites
    near = lines.where(F.abs(F.col("spread") - min_sites) <= band)
    exact = seen.join(near.select("h"), "h").groupBy("h", "site").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("*").alias("exact"))
    sure = lines.where(F.col("spread") > min_sites + band).select("h", "first")
    return sure.union(near.join(exact.where(F.col("exact") >= min_sites), "h").select("h", "first"))


def dedup_lines(docs: DataFrame, min_sites: int = 10, text: str = "text", doc_id: str = "doc_id", site: str = "source", counts: bool = False) -> DataFrame:
    """``docs`` with boilerplate lines removed from the text; with ``counts``, n_lines and n_removed are added."""
    seen = workspace.materialize(occurrences(docs, text, doc_id, site), "lines")
    common = boilerplate(seen, min_sites)
    gone = seen.join(common, "h").where(~F.col("doc").eqNullSafe(F.col("first"))).groupBy("doc").agg(F.collect_set("h").alias("gone"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("__id"))
    both = rows.join(gone, F.col("__id").eqNullSafe(F.col("doc")), "left")
    lines = F.split(F.col("row")[text], "\n")
    kept = F.filter(lines, lambda x: ~_has_word(x) | ~F.array_contains(F.col("gone"), F.xxhash64(x)))
    both = both.withColumn("kept", F.when(F.col("gone").isNotNull(), kept))
    new = F.when(F.col("kept").isNull(), F.col("row")[text]).otherwise(F.array_join("kept", "\n"))
    out = [(new if c == text else F.col("row")[c]).alias(c) for c in docs.columns]
    if counts:
        out += [
            F.coalesce(F.size(F.filter(lines, _has_word)), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size(lines) - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
        ]
    return both.select(*out)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = workspace.table(spark, sf_dir, "documents")
    return dedup_lines(docs, counts=True).select("doc_id", "n_lines", "n_removed", "text")


def sql(table: str, min_sites: int = 10) -> str:
    """DuckDB: named subqueries that end in ``line_deduped`` (the columns of ``table``, n_lines, n_removed)."""
    return f"""
    ld_rows AS (SELECT row_number() OVER () AS r, * FROM {table}),
    ld_lines AS (SELECT r, doc_id, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS k FROM ld_rows),
    ld_words AS (SELECT *, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS has_word FROM ld_lines),
    ld_common AS (SELECT line, min(doc_id) AS first FROM ld_words WHERE has_word GROUP BY line
                  HAVING count(DISTINCT coalesce('1' || source, '0')) >= {min_sites}),
    ld_marked AS (SELECT w.*, c.line IS NOT NULL AND w.doc_id IS DISTINCT FROM c.first AS gone FROM ld_words w LEFT JOIN ld_common c ON w.has_word AND w.line = c.line),
    ld_texts AS (SELECT r, coalesce(string_agg(line, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '') AS new_text,
                        count(*) FILTER (WHERE has_word) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed FROM ld_marked GROUP BY r),
    line_deduped AS (SELECT d.* EXCLUDE (r) REPLACE (CASE WHEN d.text IS NULL THEN NULL ELSE t.new_text END AS text),
                            coalesce(n_lines, 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed
                     FROM ld_rows d LEFT JOIN ld_texts t USING (r))"""


ORACLE = f"WITH {sql('documents')} SELECT doc_id, n_lines, n_removed, text FROM line_deduped"
