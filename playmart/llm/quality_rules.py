"""Quality rules with risk-controlled cutoffs (DataFrame functions only).

A fixed base rule rejects short and repetitive texts.  On top, each stratum
(language) gets cutoffs on four measured shares, chosen on labelled documents that
pass the base rule.  The settings tried are a fixed sequence of ``LEVELS`` from mild
to strict, each a cutoff for every measure, stated beforehand.  Level by level
an exact binomial test asks whether the share of good documents that the setting
rejects - by any of its measures - is at most ``risk``; the sequence ends with the
first level that fails.  Tests in a fixed order need no division by their number,
so only the strata share ``error`` (Bonferroni): with probability 1 - error *no*
stratum's setting rejects more than its share of good documents.  Among the levels
that pass, the one wins whose rejected bad share exceeds ten times its rejected good
share the most (ties: the mildest); with none, the base rule alone decides there,
and ``verdict`` says so for every document of the stratum.

Defined cases: a null text has no words and fails the base rule.  A null
language is a stratum of its own.  Several labels of one id count as good only
if all are; labels without a quality, and documents without one, aren't used.
Without labels only the base rule decides.  Rows are judged one by one, so
repeated rows get equal answers.  Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

RISK = 0.04
ERROR = 0.05
#: Cutoffs of each measure from mild to strict, one per level; fixed beforehand, so they owe nothing to the labels.
GRID = {
    "symbol_share": (1.0, 0.5, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02),
    "dup_line_share": (0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.1),
    "repeat_share": (0.18, 0.15, 0.12, 0.1, 0.08, 0.05, 0.03, 0.02),
    "word_length": (15.0, 12.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.0),
}
LEVELS = 8
MEASURES = tuple(GRID)
WINDOW = 5
SPACE = r"[\x20\x09-\x0D]+"


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, stratum, the four counts, base_failed and the measures of every document."""
    gone = F.col("text")
    for c in (" ", "\t", "\n", "\x0b", "\x0c", "\r"):
        gone = F.replace(gone, F.lit(c), F.lit(""))
    w = WINDOW
    first = (docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("stratum"),
                         F.coalesce("text", F.lit("")).alias("text"))
             .select("doc_id", "stratum",
                     F.filter(F.split("text", SPACE), lambda x: x != "").alias("words"),
                     F.char_length(gone).cast("long").alias("word_chars"),
                     (F.octet_length("text") - F.octet_length(F.regexp_replace("text", r"[#*$%&|<>]+", "")))
                     .cast("long").alias("n_symbols"),
                     F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines")))
    hashed = first.select(
        "doc_id", "stratum", F.size("words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr(f"CASE WHEN size(words) >= {w} THEN transform(sequence(1, size(words) - {w - 1}), "
               f"i -> xxhash64(slice(words, i, {w}))) ELSE array() END").alias("grams"))
    # windows sorted by hash, with their place; only where some hash comes twice
    paired = hashed.withColumn("pairs", F.expr(
        "CASE WHEN size(grams) > size(array_distinct(grams)) THEN "
        "sort_array(transform(grams, (h, i) -> struct(h AS h, i AS i))) END"))
    starts = paired.withColumn("starts", F.expr(
        "sort_array(filter(transform(pairs, (e, j) -> CASE WHEN get(pairs, j - 1).h = e.h "
        "OR get(pairs, j + 1).h = e.h THEN e.i END), x -> x IS NOT NULL))"))
    return (starts.withColumn("n_repeat_words", F.expr(
                # each window adds the words that the one before it doesn't cover; least() skips a null
                f"coalesce(aggregate(transform(starts, (x, j) -> CAST(least({w}, x - get(starts, j - 1)) AS BIGINT)), "
                "0L, (a, b) -> a + b), 0L)"))
            .withColumn("base_failed", (F.col("n_words") < 10)
                        | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
            .select("doc_id", "stratum", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed",
                    *[F.coalesce(F.try_divide(a, b), F.lit(0.0)).alias(m) for m, a, b in (
                        ("symbol_share", F.col("n_symbols"), F.col("n_words")),
                        ("dup_line_share", F.col("n_dup_lines"), F.col("n_lines")),
                        ("repeat_share", F.col("n_repeat_words"), F.col("n_words")),
                        ("word_length", F.col("word_chars"), F.col("n_words")))]))


def binomial_tail(k: str, n: str, p: float) -> str:
    """SQL for P(X <= k), X binomial(n, p), summed term by term from logarithms."""
    return (f"aggregate(sequence(0L, {k}), "
            f"named_struct('t', {n} * ln(1 - {p}D), 's', 0D), "
            f"(a, i) -> named_struct("
            f"'t', a.t + CASE WHEN i < {n} THEN ln(CAST({n} - i AS DOUBLE) / (i + 1)) + ln({p}D / (1 - {p}D)) ELSE 0D END, "
            f"'s', a.s + exp(a.t)), a -> a.s)")


def tests(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per stratum and level: good and bad documents, rejected ones, the test's p value."""
    good = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    over = lambda k: F.greatest(*[F.col(m) > GRID[m][k] for m in MEASURES])
    levels = F.array(*[F.struct(F.lit(k).alias("level"), over(k).alias("out")) for k in range(LEVELS)])
    is_good, out = F.col("quality") == 1, F.col("t.out")
    return (measured.filter(~F.col("base_failed")).join(good, "doc_id")
            .select("stratum", "quality", F.explode(levels).alias("t"))
            .groupBy("stratum", "t.level")
            .agg(F.count_if(is_good).alias("n_good"), F.count_if(is_good & out).alias("k_good"),
                 F.count_if(~is_good).alias("n_bad"), F.count_if(~is_good & out).alias("k_bad"))
            .withColumn("p_value", F.expr(binomial_tail("k_good", "n_good", RISK))))


def select_levels(tested: DataFrame, error: float = ERROR) -> DataFrame:
    """stratum, level: the chosen setting of each stratum that has one."""
    m = max(1, tested.select("stratum").distinct().count())
    fails = F.min(F.when((F.col("p_value") > error / m) | (F.col("n_good") == 0), F.col("level")))
    gain = F.col("k_bad") / F.greatest("n_bad", F.lit(1)) - 10 * F.col("k_good") / F.greatest("n_good", F.lit(1))
    ends = tested.groupBy("stratum").agg(F.coalesce(fails, F.lit(LEVELS)).alias("end"))
    return (tested.join(ends, "stratum").filter("level < end").withColumn("gain", gain).filter("gain > 0")
            .groupBy("stratum").agg(F.max_by("level", F.struct("gain", -F.col("level"))).alias("level")))


def judge(docs: DataFrame, labels: DataFrame, error: float = ERROR) -> DataFrame:
    """The counts of every document, base_failed, kept, the first measure over its cutoff, and the stratum's verdict."""
    measured = materialise(measures(docs), "measures")
    tested = materialise(tests(measured, labels.select("doc_id", "quality")), "tests")
    levels = materialise(select_levels(tested, error), "levels")
    cutoff = lambda m: F.get(F.array(*[F.lit(c) for c in GRID[m]]), F.col("level"))
    over = F.coalesce(*[F.when(F.col(m) > cutoff(m), F.lit(m)) for m in MEASURES])
    verdict = F.when(F.col("level").isNull(), F.lit("base rule")).otherwise(F.concat(F.lit("level "), F.col("level")))
    return (measured.join(levels, "stratum", "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & over.isNull()).alias("kept"), over.alias("rejected_by"),
                    verdict.alias("verdict")))
