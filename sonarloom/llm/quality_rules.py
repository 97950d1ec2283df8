"""Quality rules: a threshold table compiled into one projection of built-in expressions (no user function).

Per text: words are runs of characters other than space and U+0009..U+000D. The measures are counted in array
expressions inside the row, so nothing is shuffled and a text of n words costs O(n log n) at most.

Repeated windows are found by 64-bit hashes of five word hashes; within one text two different windows share
a hash with a chance of about n * n / 2 ** 65.

Defined results: a null text is an empty text: no words, no lines, rejected by the base rule; repeated rows
each get their row; columns of the input other than the kept ones and the text are ignored, so names cannot
clash; a word or line of any length is compared whole."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonarloom import workspace

#: Frequent function words of the languages served, lower case.
STOP_WORDS = {
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "in", "is", "it", "for", "on", "as", "at", "by", "this", "are", "was", "or", "from"],
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "zu", "mit", "von", "den", "dem", "auf", "in", "im", "es", "sich", "auch", "als"],
    "fr": ["le", "la", "les", "de", "des", "et", "un", "une", "du", "en", "que", "qui", "dans", "pour", "par", "sur", "au", "est", "pas", "ne", "avec"],
    "es": ["el", "la", "los", "las", "de", "y", "que", "en", "un", "una", "por", "con", "para", "del", "se", "no", "es", "al", "lo", "su"],
}


@dataclass(frozen=True)
class Rule:
    """A text passes while ``low <= 1000 * numerator / denominator <= high`` (in whole numbers: no rounding;
    a zero denominator passes). None: no bound on that side. Length rules have the denominator ``one``. A text
    whose denominator is below ``least`` passes: on so few words or lines the share says nothing."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None
    least: int = 0


#: The production table; limits in thousandths.
RULES = [
    Rule("word_length", "word_chars", "n_words", 2_000, 15_000),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 100),
    Rule("stop_word_ratio", "n_stop_words", "n_words", 20, None, least=50),
    Rule("duplicate_line_ratio", "n_dup_lines", "n_lines", None, 500),
]

BLANK = r"[ \t-\r]"
BLANKS = " \t\n\x0b\f\r"
NO_SYMBOLS = "[^#*$%&|<>]+"
#: Punctuation that may stand at the ends of a stop word; letters that are lowered there.
MARKS, CAPITALS = ".,;:!?\"()[]{}*#«»„“”‘…–—-", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: Column) -> Column:
    """The words of a text; an empty array where there are none."""
    core = F.btrim(text, F.lit(BLANKS))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, f"{BLANK}+"))


def measures(docs: DataFrame, text: str = "text", keep: list[str] | None = None, stop_words: list[str] | None = None) -> DataFrame:
    """``keep`` columns and the counts that rules are made of. Each step is a projection of its own, so that no
    expression is evaluated twice."""
    keep = keep or ["doc_id"]
    stops = sorted(set(stop_words or sum(STOP_WORDS.values(), [])))
    names = [f"__k{i}" for i in range(len(keep))]
    df = docs.select(*[F.col(k).alias(n) for k, n in zip(keep, names)], F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    df = df.select(*names, "t", words_of(F.col("t")).alias("w"), F.filter(F.split("t", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("ln"))
    df = df.select(
        *names,
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", NO_SYMBOLS, "")).cast("long").alias("n_symbols"),
        F.size("ln").cast("long").alias("n_lines"),
        (F.size("ln") - F.size(F.array_distinct("ln"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("w", lambda x: F.btrim(F.translate(x, CAPITALS, CAPITALS.lower()), F.lit(MARKS)).isin(stops))).cast("long").alias("n_stop_words"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
    )
    grams = F.when(
        F.size("h") >= 5,
        F.transform(F.sequence(F.lit(0), F.size("h") - 5), lambda i: F.xxhash64(*[F.get(F.col("h"), i + k) for k in range(5)])),
    ).otherwise(F.array().cast("array<bigint>"))
    base = [*names, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_stop_words"]
    df = df.select(*base, grams.alias("g"))
    # Only texts with a repeated window are sorted.
    repeated = F.size(F.array_distinct("g")) < F.size("g")
    df = df.select(*base, F.when(repeated, F.sort_array(F.transform("g", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("s"))
    beside = lambda x, i: F.get(F.col("s"), i)["h"].eqNullSafe(x["h"])
    at = F.sort_array(F.transform(F.filter("s", lambda x, i: beside(x, i - 1) | beside(x, i + 1)), lambda x: x["i"]))
    df = df.select(*base, at.alias("at"))
    covered = F.aggregate(
        "at",
        F.struct(F.lit(-5).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda a, i: F.struct(i.alias("last"), (a["n"] + F.least(F.lit(5), i - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    df = df.select(*base, F.coalesce(F.when(F.col("at").isNotNull(), covered), F.lit(0)).cast("long").alias("n_repeat_words"))
    return df.withColumnsRenamed(dict(zip(names, keep)))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def compiled(rules: list[Rule]) -> Column:
    """True where every rule passes: the threshold table as one expression."""
    verdict = F.lit(True)
    for r in rules:
        top, under = 1000 * F.col(r.numerator), F.lit(1) if r.denominator == "one" else F.col(r.denominator)
        limits = [top >= r.low * under] if r.low is not None else []
        limits += [top <= r.high * under] if r.high is not None else []
        for limit in limits:
            verdict = verdict & (limit | (under < r.least) if r.least else limit)
    return verdict


def quality(docs: DataFrame, text: str = "text", keep: list[str] | None = None, rules: list[Rule] | None = None) -> DataFrame:
    """The measures, base_failed and kept of each row."""
    df = measures(docs, text, keep)
    return df.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & compiled(RULES if rules is None else rules))


def filtered(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns; judged row by row, so repeated ids are no matter.

    The optimizer would push a filter below the projections of the measures and put their expressions into each other,
    which builds the arrays anew for every element; so the verdict goes through a generator of one row, which no filter
    on its output passes."""
    names = docs.columns
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text"))
    judged = quality(row, keep=["row"], rules=rules).select("row", F.explode(F.array("kept")).alias("verdict"))
    return judged.where("verdict").select(*[F.col("row")[c].alias(c) for c in names])


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality(workspace.table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop_words")


def _limits(rules: list[Rule]) -> str:
    out = ["true"]
    for r in rules:
        under = "1" if r.denominator == "one" else r.denominator
        few = f" OR {under} < {r.least}" if r.least else ""
        if r.low is not None:
            out.append(f"(1000 * {r.numerator} >= {r.low} * {under}{few})")
        if r.high is not None:
            out.append(f"(1000 * {r.numerator} <= {r.high} * {under}{few})")
    return " AND ".join(out)


def measures_sql(table: str) -> str:
    """DuckDB SQL for the measures of a table with doc_id and text; a row is known by its rowid-like number."""
    stops = ", ".join(f"'{w}'" for w in sorted(set(sum(STOP_WORDS.values(), []))))
    return f"""
    numbered AS (SELECT row_number() OVER () AS r, *, coalesce(text, '') AS t FROM {table}),
    split_ AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
                      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ln FROM numbered),
    grams AS (SELECT r, i, w[i:i+4] AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM split_ WHERE len(w) >= 5)),
    twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
    covered AS (SELECT r, count(DISTINCT p) AS n_repeat_words FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
    measured AS (
      SELECT split_.*, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(ln)::BIGINT AS n_lines,
             (len(ln) - len(list_distinct(ln)))::BIGINT AS n_dup_lines,
             len(list_filter(w, lambda x: list_contains([{stops}], trim(translate(x, '{CAPITALS}', '{CAPITALS.lower()}'), '{MARKS}'))))::BIGINT AS n_stop_words,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM split_ LEFT JOIN covered USING (r)),
    judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, {_limits(RULES)} AS passed FROM measured)"""


ORACLE = f"""WITH {measures_sql("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND passed AS kept, n_lines, n_stop_words FROM judged"""
