"""Quality rules: plain counts with fixed limits, then a log-likelihood ratio of hashed n-grams.

A word counts by its last ENDING characters, in their case: those carry the inflection, the
punctuation and what junk puts behind words, and they recur often enough to be counted. Bigrams of
them (the last word's is with nothing) are hashed into BUCKETS classes. Two multinomials with add-ALPHA smoothing are
counted over whole tables: one over the trusted target texts, one over all texts. A document's
score is the mean over its n-grams of log p_target - log p_raw; it is kept from THRESHOLD on.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskspark.llm.common import BLANKS, checkpoint, words_of

BUCKETS = 1 << 16
ENDING = 3
ALPHA = 1.0
#: Mean log ratio (nats per n-gram) from which a document is kept.
THRESHOLD = -0.3
MIN_WORDS, WINDOW, MAX_REPEATED_PERCENT = 10, 5, 20
SYMBOLS = "#*$%&|<>"
FEW = 64
_ALL = 1 << 30  # start + length has to stay an int


def tail(xs: Column, n: int) -> Column:
    """The array without its first n elements."""
    return F.slice(xs, n + 1, _ALL)


def paired(a: str, b: Column) -> Column:
    return F.zip_with(F.col(a), b, lambda x, y: F.xxhash64(x, y))


def with_windows(rows: DataFrame) -> DataFrame:
    """`windows`: a hash for every run of five `words`, put together from hashes of shorter runs.

    Each step is a column of its own, so that none is computed again inside the next.
    """
    return (rows.withColumn("ones", F.transform("words", lambda w: F.xxhash64(w)))
            .withColumn("twos", paired("ones", tail(F.col("ones"), 1)))
            .withColumn("fours", paired("twos", tail(F.col("twos"), 2)))
            .withColumn("fives", paired("fours", tail(F.col("ones"), 4)))
            .withColumn("windows", F.slice("fives", 1, F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))))
            .drop("ones", "twos", "fours", "fives"))


def with_repeats(rows: DataFrame) -> DataFrame:
    """`n_repeat_words`: how many words lie in a window that occurs twice or more.

    Most texts repeat few different windows, whose places a look through the array finds; for a
    text that repeats more than FEW, hashes are sorted together with their places.
    """
    no_places = F.array().cast("array<int>")
    again = F.zip_with("sorted", tail(F.col("sorted"), 1), lambda a, b: F.when(a == b, a))
    known = F.col("again")
    places = F.filter(F.transform("windows", lambda h, i: F.when(F.array_contains(known, h), i)), lambda i: i.isNotNull())
    paired_up = F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    equal = F.zip_with(
        "by_hash", tail(F.col("by_hash"), 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(no_places))
    steps = F.zip_with("at", tail(F.col("at"), 1), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(WINDOW)))
    return (rows.withColumn("sorted", F.sort_array("windows"))
            .withColumn("again", F.array_distinct(F.array_compact(again)))
            .withColumn("by_hash", F.when(F.size("again") > FEW, paired_up))
            .withColumn("at", F.when(F.size("again") == 0, no_places).when(F.size("again") <= FEW, places)
                        .otherwise(F.sort_array(F.array_distinct(F.flatten(equal)))))
            .withColumn("n_repeat_words", covered.cast("long"))
            .drop("windows", "sorted", "again", "by_hash", "at"))


def base_counts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The counts of every document, beside the columns `keep` and its words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    symbols = F.length("text") - F.length(F.translate("text", SYMBOLS, ""))
    rows = docs.select(*keep, text.alias("text"), words_of(F.col("text")).alias("words")).withColumn("lines", lines)
    return with_repeats(with_windows(rows)).select(
        *keep, "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.when(F.col("text").rlike(r"[#*$%&|<>]"), symbols).otherwise(0).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                 | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def with_grams(rows: DataFrame) -> DataFrame:
    """`grams`: the bucket of every pair of neighbouring words, each reduced to its last ENDING characters."""
    end = lambda w: F.substring(w, -ENDING, ENDING)
    pairs = F.zip_with("words", tail(F.col("words"), 1),
                       lambda a, b: F.pmod(F.xxhash64(end(a), end(F.coalesce(b, F.lit("")))), F.lit(BUCKETS)).cast("int"))
    return rows.withColumn("grams", pairs).drop("words")


def log_ratios(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, alpha: float = ALPHA) -> DataFrame:
    """bucket, ratio: log p_target - log p_raw, for all buckets that occur in `docs`.

    `trusted` has the doc_id of every target document, once or more; NULL ids are no target.
    """
    ids = trusted.select("doc_id").filter("doc_id IS NOT NULL").distinct().withColumn("_target", F.lit(1))
    # The n-grams are shuffled to the ids at every size, in two bytes each instead of their texts.
    rows = with_grams(docs.select("doc_id", words_of(F.col("text")).alias("words"))).select(
        "doc_id", F.transform("grams", lambda b: (b - BUCKETS // 2).cast("smallint")).alias("grams"))
    marked = rows.join(ids.hint("merge"), "doc_id", "left").select(
        F.coalesce("_target", F.lit(0)).alias("target"), F.explode_outer("grams").alias("gram"))
    bucket = F.col("gram").cast("int") + BUCKETS // 2
    counts = checkpoint(marked.filter("gram IS NOT NULL").groupBy(bucket.alias("bucket"))
                        .agg(F.count("*").alias("n"), F.sum("target").alias("m")))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("m"), F.lit(0)).alias("m")).first()
    target = (F.col("m") + alpha) / F.lit(float(total.m + alpha * buckets))
    raw = (F.col("n") + alpha) / F.lit(float(total.n + alpha * buckets))
    return counts.select("bucket", F.log(target / raw).alias("ratio"))


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, llr_score and kept for every row of `docs`.

    NULL and blank texts have no words, fail the base and have a NULL score. Repeated rows are
    judged each. Other columns are ignored. With no trusted documents all scores are a constant
    per bucket of the smoothing alone. An empty table gives an empty result.
    """
    ratios = F.broadcast(log_ratios(docs, trusted))  # at most BUCKETS rows
    rows = base_counts(docs.withColumn("_row", F.monotonically_increasing_id()), ["_row", "doc_id"])
    own = [c for c in rows.columns if c != "words"]
    scored = (with_grams(rows).select(*own, F.explode_outer("grams").alias("bucket"))
              .join(ratios, "bucket", "left").groupBy(*own).agg(F.avg("ratio").alias("llr_score")))
    kept = ~F.col("base_failed") & (F.coalesce("llr_score", F.lit(float("-inf"))) >= threshold)
    return scored.drop("_row").withColumn("kept", kept)
