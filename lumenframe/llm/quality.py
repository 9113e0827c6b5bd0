"""Quality rules: a hashed n-gram log-likelihood ratio between trusted and raw text, after plain counts; DataFrame functions only.

Words and pairs of neighbouring words fall into BUCKETS by a hash. All documents give the raw multinomial over the buckets, the
trusted ones the target, both with one added to every count. A document's score is the sum of log(target / raw) over its n-grams, divided by
their number, and it is kept from THRESHOLD on. Ratios are whole millionths and sums are exact, so that the order of the sum
decides nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
BUCKETS = 8192
#: Least mean log ratio of a kept document, in millionths.
THRESHOLD = -50_000
WINDOW = 8
FEWEST_WORDS, MOST_REPEATED = 20, 30


def words_of(text: str):
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACE), "")


def neighbours(hashes: str, step: int):
    """Hashes of every hash together with the one ``step`` places on."""
    n = F.greatest(F.size(hashes) - step, F.lit(0))
    return F.zip_with(F.slice(hashes, F.lit(1), n), F.slice(hashes, F.lit(1 + step), n), lambda a, b: F.xxhash64(a, b))


def with_grams(df: DataFrame, text: str) -> DataFrame:
    """``df`` with __words, and __ones and __twos, hashes of its words and pairs of words."""
    df = df.withColumn("__words", words_of(text)).withColumn("__ones", F.transform("__words", lambda w: F.xxhash64(w)))
    return df.withColumn("__twos", neighbours("__ones", 1))


def bucket(h):
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def ratios(docs: DataFrame, trusted: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row with one column: log(target / raw) of every bucket in millionths, in order.

    Counts are partial sums over BUCKETS keys in every task; the row has BUCKETS numbers at any size of the input.
    """
    known = trusted.select(F.col(doc_id).alias("__id")).filter("__id IS NOT NULL").distinct().withColumn("__trusted", F.lit(1))
    # hashed by partition at any size: the ids of a partition fit, and texts need no sort
    marked = docs.select(doc_id, text).join(known.hint("shuffle_hash"), F.col(doc_id) == F.col("__id"), "left")
    grams = with_grams(marked, text).select(F.explode(F.concat("__ones", "__twos")).alias("h"), F.coalesce("__trusted", F.lit(0)).alias("t"))
    counts = grams.groupBy(bucket(F.col("h")).alias("bucket")).agg(F.count(F.lit(1)).alias("raw"), F.sum("t").alias("target"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    every = every.select("bucket", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("raw", "target")])
    rows = every.agg(
        F.sum("raw").alias("all_raw"), F.sum("target").alias("all_target"), F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("b")
    )

    def ratio(x):
        target = (x["target"] + 1) / (F.col("all_target") + BUCKETS)
        return F.round(F.log(target / ((x["raw"] + 1) / (F.col("all_raw") + BUCKETS))) * 1_000_000).cast("long")

    return rows.select(F.transform("b", ratio).alias("ratios"))


def base_counts(df: DataFrame, text: str) -> DataFrame:
    """``df`` (with the columns of :func:`with_grams`) with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Windows are only hashed where four words in a row repeat, without which no longer window can.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("__lines", lines).withColumns(
        {
            "n_words": F.size("__words").cast("long"),
            "word_chars": F.length(F.array_join("__words", "")).cast("long"),
            "n_symbols": F.regexp_count(value, F.lit(SYMBOLS)).cast("long"),
            "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        }
    )
    df = df.withColumn("__fours", neighbours("__twos", 2))
    some = (F.size("__words") >= WINDOW) & (F.size(F.array_distinct("__fours")) < F.size("__fours"))
    starts = F.when(some, F.sequence(F.lit(1), F.size("__words") - (WINDOW - 1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice("__words", i, F.lit(WINDOW))))
    df = df.withColumn("__windows", hashes)
    some = F.size(F.array_distinct("__windows")) < F.size("__windows")
    placed = F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("__placed", F.when(some, placed))

    def again(x, k):
        before = F.when(k > 0, F.col("__placed")[k - 1]["h"] == x["h"]).otherwise(False)
        after = F.when(k + 1 < F.size("__placed"), F.col("__placed")[k + 1]["h"] == x["h"]).otherwise(False)
        return before | after

    df = df.withColumn("__at", F.sort_array(F.transform(F.filter("__placed", again), lambda x: x["i"])))
    steps = F.transform(
        "__at", lambda p, k: F.when(k + 1 < F.size("__at"), F.least(F.lit(WINDOW), F.col("__at")[k + 1] - p)).otherwise(WINDOW)
    )
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda s, x: s + x)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))


def judge(df: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score and kept.

    ``trusted`` has the ids (column ``doc_id``) of the target's documents; null ids are never trusted. score is the mean ratio in
    millionths, null without words. A null text has no words. Columns named as the results are replaced. Runs the job of the ratios;
    their one row of BUCKETS numbers becomes a constant of the plan.
    """
    own = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed score kept".split()
    df = df.select(*[c for c in df.columns if c.lower() not in own])
    names = df.columns
    line = ratios(df, trusted, doc_id, text).select(F.array_join("ratios", ",")).collect()[0][0]
    table = F.split(F.lit(line), ",").cast("array<bigint>")
    rows = base_counts(with_grams(df, text), text)
    total = F.lit(0).cast("long")
    for grams in ("__ones", "__twos"):
        total = F.aggregate(grams, total, lambda s, h: s + F.element_at(table, bucket(h) + 1))
    failed = (F.col("n_words") < FEWEST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    rows = rows.withColumn("base_failed", failed).withColumn("__total", total)
    # a long: THRESHOLD times the n-grams of a text of 21,475 words is beyond an int, which raises
    size = (F.size("__ones") + F.size("__twos")).cast("long")
    rows = rows.withColumn("score", F.when(size > 0, F.col("__total") / size))
    kept = ~F.col("base_failed") & (F.col("__total") >= size * THRESHOLD)
    rows = rows.withColumn("kept", kept)
    # a generator: a later filter on a result stays above it, instead of being computed anew inside every function above
    return rows.select(*names, F.inline(F.array(F.struct(*own))))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents that a label calls good and none calls toxic or bad."""
    good = F.min((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")
    return labels.groupBy("doc_id").agg(good).filter("good").select("doc_id")
