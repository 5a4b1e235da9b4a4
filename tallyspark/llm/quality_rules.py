"""Quality rules: counting rules, then a hashed n-gram log-likelihood ratio.

Built from SQL functions only.  The ratio compares two multinomials over hashed
n-grams: one of trusted documents, one of the whole raw corpus.  N-grams are
words, and pairs of word shapes (each run of letters written ``a``), hashed into ``BUCKETS``.  A text's score is the mean of
``log p_trusted - log p_raw`` over its n-grams; it is kept when it passes the
counting rules and its score is at least ``LEAST_SCORE`` (deterministic: no
draws).  The two tables have ``BUCKETS`` counts at any corpus size; the raw one
is made from all documents, the trusted one from all trusted documents.

Defined cases: null and empty texts have no words, fail the word-count rule and
are not kept; every row gives one row (repeated rows, null ids); other columns
are dropped; with no trusted document the ratio is 0 everywhere and only the
counting rules decide.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE_RUN, texts

SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
#: Share of the words in repeated three-word windows above which a text fails, in per cent.
MOST_REPEATED = 50
#: Trusted ids that are broadcast, at most (8 bytes each).
MOST_BROADCAST = 2_000_000
BUCKETS = 1 << 14
LEAST_SCORE = -0.15
#: Added to each bucket's count.
SMOOTHING = 1.0


def words(text: Column) -> Column:
    """The words of a text: runs of characters that are not white space."""
    return F.array_remove(F.split(text, WHITE_RUN, -1), "")


def rule_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counting rules of each text, with its ``words`` and ``text`` for later steps."""
    t = texts(docs, id_col, text_col).select("doc_id", "text", words(F.col("text")).alias("words"))
    t = t.select(
        "*", F.expr("""if(size(words) < 3, cast(array() as array<bigint>), transform(sequence(0, size(words) - 3),
            i -> xxhash64(words[i], words[i + 1], words[i + 2])))""").alias("windows"))
    repeated = F.expr("size(array_distinct(windows)) < size(windows)")
    ordered = F.when(repeated, F.sort_array(F.expr("transform(windows, (h, i) -> struct(h as h, i as i))")))
    t = t.select("doc_id", "text", "words", ordered.alias("ordered"))
    places = F.expr("""filter(transform(ordered, (x, j) -> if(
            (j > 0 and get(ordered, j - 1).h = x.h) or coalesce(get(ordered, j + 1).h = x.h, false), x.i, -1)),
            i -> i >= 0)""")
    t = t.select("doc_id", "text", "words", places.alias("places"))
    covered = F.expr("size(array_distinct(flatten(transform(places, i -> array(i, i + 1, i + 2)))))")
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    t = t.select("*", lines.alias("lines"))
    n_words, n_repeat = F.size("words").cast("long"), F.when(F.col("places").isNull(), 0).otherwise(covered)
    return t.select(
        "doc_id", "text", "words", n_words.alias("n_words"),
        (F.length("text") - F.length(F.regexp_replace("text", f"[{SYMBOLS}]+", ""))).cast("long").alias("n_symbols"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        n_repeat.cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < LEAST_WORDS)
                 | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")))


def with_buckets(df: DataFrame, n: int = BUCKETS) -> DataFrame:
    """``df`` with column ``buckets``: the hash buckets of its ``words`` and of the shape pairs of its ``text``."""
    keep = df.columns
    f = df.select(*keep, F.regexp_replace("text", r"\p{L}++", "a").alias("shape"))
    f = f.select(*keep, words(F.col("shape")).alias("shape"))
    single = F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(n)).cast("int"))
    pairs = F.zip_with("shape", F.slice("shape", F.lit(2), F.size("shape") + 1),
                       lambda a, b: F.pmod(F.xxhash64(a, F.coalesce(b, F.lit(""))), F.lit(n)).cast("int"))
    return f.select(*keep, F.concat(single, pairs).alias("buckets"))


def ratio_table(docs: DataFrame, trusted: DataFrame, n: int = BUCKETS, smoothing: float = SMOOTHING) -> list[float]:
    """``log p_trusted - log p_raw`` of each bucket.

    ``docs`` has ``doc_id, text`` and counts in full, as do all its rows whose id is in
    ``trusted``.  One aggregate of ``n`` rows reaches the driver.  The trusted ids are counted first: up to
    ``MOST_BROADCAST`` of them go to every task (then no text is shuffled), more meet the documents in a sort-merge join.
    """
    ids = trusted.select(F.col("doc_id").alias("t_id")).where("t_id is not null").distinct()
    ids = F.broadcast(ids) if ids.count() <= MOST_BROADCAST else ids.hint("merge")
    f = docs.join(ids, docs["doc_id"] == ids["t_id"], "left")
    f = with_buckets(f.select(F.col("t_id").isNotNull().alias("good"), "text", words(F.col("text")).alias("words")), n)
    counts = (f.select("good", F.explode("buckets").alias("bucket")).groupBy("bucket")
              .agg(F.count("*").alias("raw"), F.count_if("good").alias("target")).collect())
    raw, target = [0] * n, [0] * n
    for row in counts:
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not sum(target):
        return [0.0] * n
    all_raw, all_target = sum(raw) + smoothing * n, sum(target) + smoothing * n
    return [round(math.log((t + smoothing) / all_target) - math.log((r + smoothing) / all_raw), 6)
            for t, r in zip(target, raw)]


def mean_ratio(table: list[float]) -> Column:
    """Length-normalised log-likelihood ratio from column ``buckets`` (0 without n-grams)."""
    ratios = F.from_json(F.lit(json.dumps(table)), "array<double>")
    total = F.aggregate("buckets", F.lit(0.0), lambda a, b: a + F.get(ratios, b))
    return F.coalesce(F.try_divide(total, F.size("buckets")), F.lit(0.0))


def quality_rules(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  least_score: float = LEAST_SCORE) -> DataFrame:
    """One row per document: the counts, ``base_failed``, the ratio ``score`` and ``kept``."""
    table = ratio_table(texts(docs, id_col, text_col), trusted)
    f = rule_counts(docs, id_col, text_col)
    f = with_buckets(f).withColumn("score", F.round(mean_ratio(table), 6))
    return f.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & (F.col("score") >= least_score)).alias("kept"), "score")
