"""Importance resampling of raw documents towards a target's distribution of hashed word runs.

Texts are reduced to words with single spaces between. One overlapped scan of a regular expression, tied to word borders by
lookarounds, gives the spans of the runs of one to three words that begin at each word; their CRC-32 names the bucket. The
buckets of a document are written once, two bytes a feature, and read for the corpus counts and again for the weights, so that
each text is scanned once. Gumbel noise from a hash of the id turns drawing without replacement by weight into a top-k by score.
"""

from __future__ import annotations

import itertools
import math
import operator
import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from lumenframe.llm.common import add_columns
from lumenframe.operators.position import with_position
from lumenframe.sources.scratch import materialize, release

BUCKETS = 10_000
#: Words that a document needs to be drawn.
LEAST_WORDS = 20
#: Bytes of text that a worker scans at a time.
SLICE = 4 << 20

# every byte that no word has becomes a space, A to Z become a to z
PLAIN = bytes(
    b if b >= 0x80 or chr(b).isdigit() or "a" <= chr(b) <= "z" else b + 32 if "A" <= chr(b) <= "Z" else 32 for b in range(256)
)
#: At each word: the run of up to three words from there, the run of up to two, and the word.
RUNS = rb"(?<![^ ])((([^ ]++)(?: [^ ]++)?+)(?: [^ ]++)?+)(?![^ ])"


def squeezed(text: str | None) -> bytes:
    """The words of a text in lower case with one space between."""
    return b" ".join((text or "").encode().translate(PLAIN).split())


def scan(pattern, plain: bytes) -> np.ndarray:
    """The CRC-32 of every run of one to three words of a squeezed text."""
    spans = map(operator.methodcaller("groups"), pattern.finditer(plain, overlapped=True))
    made = np.fromiter(map(zlib.crc32, itertools.chain.from_iterable(spans)), np.uint32)
    n = len(made)
    # the last word begins no longer run, the one before it none of three words
    return np.delete(made, [i for i in (n - 6, n - 3, n - 2) if i >= 0])


def features(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``n_words``, ``n_features`` and ``buckets``, a packed 16-bit number for each feature (null: none)."""

    def run(texts):
        import regex

        pattern = regex.compile(RUNS)
        rows = [scan(pattern, squeezed(t)) % BUCKETS for t in texts.to_pylist()]
        sizes = np.array([len(r) for r in rows], np.int64)
        words = np.where(sizes < 2, sizes, sizes // 3 + 1)  # n words make 3n - 3 features, one word makes one
        packed = [r.astype("<u2").tobytes() for r in rows]
        return [pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]

    outs = [StructField("n_words", LongType()), StructField("n_features", LongType()), StructField("buckets", BinaryType())]
    return add_columns(df, text, outs, run, SLICE)


def bucket_counts(made: DataFrame) -> DataFrame:
    """(bucket, n): how often all rows' features fall into each bucket; a task sends at most one row a bucket."""

    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                total += np.bincount(np.frombuffer(packed.as_py() or b"", "<u2"), minlength=BUCKETS)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit], pa.int64())], names=["bucket", "n"])

    counts = made.select("buckets").mapInArrow(run, "bucket int, n long")
    return counts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame) -> list[int]:
    """The gain of each bucket in thousandths from two tables of counts, each of at most ``BUCKETS`` rows."""
    s, t = ({r.bucket: r.n for r in counts.collect()} for counts in (raw, target))
    big_s, big_t = float(sum(s.values()) + BUCKETS), float(sum(t.values()) + BUCKETS)
    ratios = ((t.get(b, 0) + 1) * big_s / ((s.get(b, 0) + 1) * big_t) for b in range(BUCKETS))
    return [math.floor(1000 * math.log(r)) for r in ratios]


def weigh(made: DataFrame, gain: Sequence[int]) -> DataFrame:
    """``made`` without its buckets and with ``weight``, the sum of the gains over a row's features."""

    def run(packed):
        table = np.array(gain, np.int64)
        sums = [int(table[np.frombuffer(p or b"", "<u2")].sum()) for p in packed.to_pylist()]
        return [pa.array(sums, pa.int64())]

    return add_columns(made, "buckets", [StructField("weight", LongType())], run).drop("buckets")


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths from a hash of the id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, seed: int = 42, doc_id: str = "doc_id", text: str = "text",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every row's ``doc_id``, the columns in ``keep``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    ``rank`` is 1 for the highest score and null for rows not drawn; ``percent`` of the rows with at least 20 words are drawn,
    rounded down. Ties go to the smaller id (null first), then to fewer features; rows equal in all of it are drawn in some
    order. A null or empty text has no features and weight 0. An empty table gives an empty result, an empty target pulls
    evenly. Columns in ``keep`` that are named as a result are replaced; all others are left out, texts too unless kept.
    """
    results = {"n_words", "n_features", "buckets", "weight", "score", "rank", "__text", "__row", "__neg", doc_id.lower()}
    kept = [F.col(f"`{c}`") for c in keep if c.lower() not in results]
    rows = docs.select(F.col(f"`{doc_id}`"), *kept, F.col(f"`{text}`").alias("__text"))
    made = materialize(features(rows, "__text").drop("__text"), "features")
    wanted = bucket_counts(features(target.select(F.col(f"`{text}`").alias("__text")), "__text"))
    weighed = weigh(made, gains(bucket_counts(made), wanted))
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col(f"`{doc_id}`"), seed))
    scored = materialize(scored.withColumn("__row", F.monotonically_increasing_id()), "scores")
    release(made)
    able = F.col("n_words") >= LEAST_WORDS
    n = scored.filter(able).count() * percent // 100
    # ranked by ranges of the order, without their other columns and without one task that sees all
    order = scored.filter(able).select((-F.col("score")).alias("__neg"), F.col(f"`{doc_id}`").alias("__id"), "n_features", "__row")
    ranked = with_position(order, [], ["__neg", "__id", "n_features", "__row"], "rank")
    drawn = ranked.filter(F.col("rank") <= n).select("__row", "rank")
    return scored.join(drawn, "__row", "left").drop("__row")
