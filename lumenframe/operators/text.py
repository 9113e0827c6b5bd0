"""Term counts, cleaning, sentiment and fixed-length encoding."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.functions.tokens import raw_tokens, words
from lumenframe.operators.position import with_position
from lumenframe.sources.scratch import materialize

PAD, UNKNOWN, START, END = 0, 1, 2, 3
FIRST_ID = 4
# the constant of s / sqrt(s^2 + c) that maps a valence sum into (-1, 1)
COMPOUND = 15.0
# A negated word counts -0.74 times; a booster moves a valence by 0.293 away from 0.
NEGATION = -0.74
# word lists up to this length are constants of the plan
LITERAL_WORDS = 2000
BOOST = 0.293


def term_counts(df: DataFrame, key: str, text: str, min_length: int = 2) -> DataFrame:
    """``key, term, cnt``; the rows of a text are folded before the shuffle."""
    terms = df.select(key, F.explode(words(F.col(text), min_length)).alias("term"))
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("cnt"))


def inverse_document_frequency(counts: DataFrame, n: int) -> DataFrame:
    """``term, idf``: ln((n + 1) / (texts with the term + 1)) of ``counts`` with one row per text and term."""
    docs = counts.groupBy("term").agg(F.count(F.lit(1)).alias("docs"))
    return docs.select("term", F.ln(F.lit(n + 1.0) / (F.col("docs") + 1)).alias("idf"))


def vocabulary(counts: DataFrame, min_docs: int = 1) -> DataFrame:
    """Terms found in at least ``min_docs`` texts."""
    docs = counts.groupBy("term").agg(F.count(F.lit(1)).alias("docs"))
    return docs.filter(F.col("docs") >= min_docs)


def keep_terms(counts: DataFrame, terms: DataFrame) -> DataFrame:
    """The counts of the given terms. The term list is written first, so that its size picks the join."""
    return counts.join(materialize(terms.select("term"), "terms"), "term", "left_semi")


def strip_stopwords(text: Column, stop: Sequence[str]) -> Column:
    """Tokens that are not stop words in any case, in order and as written, joined by one space."""
    return F.array_join(F.filter(raw_tokens(text), lambda w: ~F.lower(w).isin(*stop)), " ")


def lemmatize(df: DataFrame, key: str, text: str, lemmas: DataFrame, out: str = "lemmas") -> DataFrame:
    """``key, out, n_changed``: each token replaced by its lemma where ``lemmas(form, lemma)`` has one.

    Lists of up to LITERAL_WORDS entries become a constant map and texts are mapped where they lie. For longer ones the different
    words of each text meet the list, and the text is put together from what was found.
    """
    found, how = _looked_up(df.select(key, raw_tokens(F.col(text)).alias("_t")), lemmas.select("form", "lemma"))
    lemma = F.transform("_t", lambda w: F.coalesce(how(w), w))
    rows = found.select(key, "_t", lemma.alias("_l"))
    changed = F.size(F.filter(F.zip_with("_t", "_l", lambda a, b: a != b), lambda x: x))
    return rows.select(key, F.array_join("_l", " ").alias(out), F.greatest(changed, F.lit(0)).cast("long").alias("n_changed"))


def _looked_up(rows: DataFrame, pairs: DataFrame):
    """(``rows`` (.., _t), a function from a word of _t to its value in ``pairs`` (word, value) or null).

    A word that is listed more than once has the least of its values, whatever the length of the list.
    """
    word, value = pairs.columns
    pairs = pairs.filter(F.col(word).isNotNull()).groupBy(word).agg(F.min(value).alias(value))
    listed = pairs.limit(LITERAL_WORDS + 1).collect()
    if len(listed) <= LITERAL_WORDS:
        flat = [F.lit(x) for r in listed for x in r]
        if not flat:
            return rows, lambda w: F.lit(None).cast(pairs.schema[1].dataType)
        known = F.create_map(*flat)
        return rows, lambda w: F.try_element_at(known, w)
    joined = _met(rows, pairs, word, value)
    known = F.map_from_entries("_pairs")
    return joined.withColumn("_map", known).drop("_pairs"), lambda w: F.try_element_at("_map", w)


def _met(rows: DataFrame, pairs: DataFrame, word: str, value: str) -> DataFrame:
    """``rows`` (.., _t) and ``_pairs``, the (word, value) of its different words in ``pairs``; null if there are none."""
    keyed = rows.withColumn("_row", F.xxhash64(F.to_json(F.struct("*"))))
    own = keyed.select("_row", F.explode(F.array_distinct("_t")).alias(word))
    met = own.join(materialize(pairs, "words"), word).groupBy("_row").agg(F.collect_set(F.struct(word, value)).alias("_pairs"))
    return keyed.join(met, "_row", "left").drop("_row")


def _coded(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """``key, _c``: the id of each word of ``_t``, UNKNOWN where it has none. A text's words are found in one hash table."""
    term, code = ids.columns
    listed = ids.filter(F.col(term).isNotNull()).groupBy(term).agg(F.min(code).alias(code))
    met = _met(rows, listed, term, code).select(key, "_t", F.col(f"_pairs.{term}").alias("_w"), F.col(f"_pairs.{code}").alias("_i"))

    def one(words_: pa.ListScalar, known: pa.ListScalar, codes: pa.ListScalar) -> pa.Array:
        if not words_.is_valid:
            return pa.nulls(0, pa.int64())
        if not known.is_valid:
            return pa.array(np.full(len(words_.values), UNKNOWN), pa.int64())
        at = pc.index_in(words_.values, value_set=known.values)
        return pc.fill_null(pc.take(codes.values, at), UNKNOWN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [one(*row) for row in zip(*[batch.column(i) for i in (1, 2, 3)])]
            if found:
                ends = pa.array(np.concatenate([[0], np.cumsum([len(f) for f in found])]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.concat_arrays(found))
                yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "_c"])

    return met.mapInArrow(run, T.StructType([rows.schema[key], T.StructField("_c", T.ArrayType(T.LongType()))]))


def sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame, modifiers: DataFrame) -> DataFrame:
    """``key, compound``: valences summed per text and mapped into (-1, 1).

    ``lexicon(word, valence)``; ``modifiers(word, kind)`` with kind 'negation' or 'booster' acts on
    the word that follows it. Words are looked up as in :func:`lemmatize`, so no token is shuffled for short lists.
    """
    rows, valence = _looked_up(df.select(key, words(F.col(text)).alias("_t")), lexicon.select("word", "valence"))
    rows = rows.select(key, "_t", F.transform("_t", valence).alias("_v"))
    rows, kind = _looked_up(rows, modifiers.select("word", "kind"))

    def moved(v, k):
        return F.when(k == "negation", v * NEGATION).when(k == "booster", v + F.signum(v) * BOOST).otherwise(v)

    kinds = F.concat(F.array(F.lit("")), F.slice("_t", F.lit(1), F.greatest(F.size("_t") - 1, F.lit(0))))
    rows = rows.select(key, "_v", F.transform(kinds, lambda w: F.coalesce(kind(w), F.lit(""))).alias("_k"))
    parts = F.zip_with("_v", "_k", lambda v, k: F.coalesce(moved(v, k), F.lit(0.0)))
    total = F.coalesce(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x), F.lit(0.0))
    rows = rows.select(key, total.alias("s"))
    return rows.select(key, (F.col("s") / F.sqrt(F.col("s") * F.col("s") + COMPOUND)).alias("compound"))


def frequent_ids(df: DataFrame, text: str, size: int | None = None) -> DataFrame:
    """``term, id``: all words, or the ``size`` most frequent, numbered from FIRST_ID by frequency; ties by the word.

    Numbered over ranges of the words, so that the vocabulary may be of any size.
    """
    counts = df.select(F.explode(words(F.col(text))).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    placed = with_position(counts.withColumn("_less", -F.col("n")), [], ["_less", "term"])
    placed = placed if size is None else placed.filter(F.col("pos") <= size)
    return placed.select("term", (F.col("pos") + (FIRST_ID - 1)).alias("id"))


def encode_ids(df: DataFrame, key: str, text: str, ids: DataFrame, length: int = 128) -> DataFrame:
    """``key, block, ids, mask`` of fixed length: start, up to length - 2 word ids, end, padding.

    A longer text goes on in further blocks; block 0 is the text cut to the length. The different words of each text meet the
    ids, and the text is coded where it lies, so that no token is shuffled.
    """
    room = length - 2
    rows = _coded(df.select(key, words(F.col(text)).alias("_t")), key, ids.select("term", F.col("id").cast("long").alias("id")))
    last = F.greatest(F.ceil(F.size("_c") / room), F.lit(1)) - 1
    rows = rows.select(key, "_c", F.explode(F.sequence(F.lit(0), last.cast("int"))).alias("block"))
    real = F.concat(F.array(F.lit(START)), F.slice("_c", F.col("block") * room + 1, F.lit(room)), F.array(F.lit(END)))
    blocks = rows.select(key, "block", real.alias("_r"))
    pad = F.lit(length) - F.size("_r")
    mask = F.concat(F.array_repeat(F.lit(1), F.size("_r")), F.array_repeat(F.lit(0), pad))
    return blocks.select(key, "block", F.concat("_r", F.array_repeat(F.lit(PAD), pad)).alias("ids"), mask.alias("mask"))
