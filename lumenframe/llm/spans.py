"""Substring dedup by level-wise doubling of repeated word windows.

Windows of HALF words are counted first, and only those that repeat are extended to twice that length. Of the windows of HALF
words, one for every window of SPAN words is enough: the one with the least hash among those it contains, which equal windows
choose alike wherever they stand. A window of SPAN words is a candidate if the one it chose repeats, and is removed if its own 96-bit
hash also starts earlier. :func:`longer` extends the repeated windows on, to twice the length each time, until none survives.

Counts and first places are mergeable aggregates joined back, so that a passage shared by a third of all documents is
pre-aggregated by every task, and its join can be split.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from lumenframe.llm.common import add_columns, mix, slices, tidy, text_bytes, word_hashes, word_spans
from lumenframe.sources.scratch import materialize, release

HALF, SPAN = 10, 20
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)
#: An id that stands for null, in order after all others.
LAST = (1 << 63) - 1


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


def window_hashes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of HALF and SPAN words that start at each word, by doubling; the last ones are shorter arrays."""
    two = _pair(words[:-1], words[1:])
    four = _pair(two[:-2], two[2:])
    eight = _pair(four[:-4], four[4:])
    half = _pair(eight[:-2], two[8:])
    return half, _pair(half[:-HALF], half[HALF:])


class Windows:
    """All windows of the texts of a slice: per word its text, its number there, and the hashes of windows from it."""

    def __init__(self, texts: pa.Array, second: bool):
        self.raw, self.at = text_bytes(texts)
        self.starts, self.ends, self.before = word_spans(self.raw, self.at)
        n = len(self.starts)
        self.counts = np.diff(self.before)
        self.text = np.repeat(np.arange(len(self.counts)), self.counts)
        self.number = np.arange(n) - self.before[:-1][self.text]
        fits = self.number + SPAN <= self.counts[self.text] if n else np.zeros(0, bool)
        self.fits = fits[: max(0, n - SPAN + 1)]
        if n < SPAN:
            self.half = self.span = self.span2 = self.least = np.zeros(0, np.uint64)
            return
        self.half, self.span = window_hashes(word_hashes(self.raw, self.starts, self.ends, 1))
        if second:
            self.span2 = window_hashes(word_hashes(self.raw, self.starts, self.ends, 2))[1]
        least = self.half
        for step in (1, 2, 4):
            least = np.minimum(least[:-step], least[step:])
        least = np.minimum(least[:-3], least[3:])
        self.least = np.where(self.fits, least[: len(self.fits)], NONE)

    def chosen(self) -> tuple[np.ndarray, np.ndarray]:
        """Text and hash of every window of HALF words that some window of SPAN words chose."""
        if not len(self.least):
            return np.zeros(0, np.int64), self.least
        most = np.where(self.fits, self.least, np.uint64(0))
        most = np.concatenate([np.zeros(HALF, np.uint64), most, np.zeros(HALF, np.uint64)])
        for step in (1, 2, 4):
            most = np.maximum(most[:-step], most[step:])
        most = np.maximum(most[:-3], most[3:])[: len(self.half)]
        at = np.flatnonzero((most == self.half) & (self.half != 0))
        return self.text[at], self.half[at]


def _lists(rows: np.ndarray, n: int, values: pa.Array) -> pa.Array:
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _keyed(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Order key and content hash of each row; null ids come last."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(LAST))
    return df.withColumns({"__k": key, "__t": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})


def repeated_halves(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(narrow, halves): (__k, __t, rank, n_words, copy) per document, rank in order of id; (__k, __t, rank, halves) that repeat.

    A copy has the whole text of a document of lower rank, and needs no windows.
    """

    def chosen(texts):
        w = Windows(texts, False)
        rows, hashes = w.chosen()
        return [pa.array(w.counts, pa.int64()), _lists(rows, len(w.counts), pa.array(hashes.view(np.int64)))]

    outs = [StructField("n_words", LongType()), StructField("halves", ArrayType(LongType()))]
    texts = docs.select("__k", "__t", "__null", "__text", F.md5("__text").alias("whole"))
    found = add_columns(texts, "__text", outs, chosen).drop("__text").withColumn("row", F.monotonically_increasing_id())
    found = materialize(found, "span-halves")

    distinct = found.groupBy("__k", "__null", "__t").agg(F.max("n_words").alias("n_words"), F.first("whole").alias("whole"))
    ranked = distinct.orderBy("__k", "__null", "__t").withColumn("rank", F.monotonically_increasing_id())
    ranked = materialize(ranked, "span-docs")
    first = ranked.groupBy("whole").agg(F.min("rank").alias("__f"))
    narrow = ranked.join(first, "whole").select("__k", "__t", "rank", "n_words", (F.col("rank") != F.col("__f")).alias("copy"))
    narrow = materialize(narrow, "span-docs")

    count = found.select(F.explode("halves").alias("half")).groupBy("half").count().filter("count > 1").select("half")
    own = found.select("row", F.explode(F.array_distinct("halves")).alias("half"))
    rows = own.join(count, "half").groupBy("row").agg(F.collect_list("half").alias("halves"))
    rows = found.select("row", "__k", "__t").join(rows, "row").dropDuplicates(["__k", "__t"]).drop("row")
    kept = narrow.filter("NOT copy").select("__k", "__t", "rank").join(rows, ["__k", "__t"])
    halves = materialize(kept, "span-halves")
    release(found)
    tidy(docs.sparkSession)
    return narrow, halves


def candidates(docs: DataFrame, halves: DataFrame) -> DataFrame:
    """(rank, start, h1, h2, again) of the windows of SPAN words whose chosen half repeats.

    ``again`` tells that the same document has the window earlier; each document is seen whole, so this needs no shuffle.
    """
    rows = docs.join(halves, ["__k", "__t"]).select("rank", "__text", "halves")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "__text"):
                w = Windows(part.column("__text"), True)
                lists = part.column("halves")
                sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
                values = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
                known = set_pairs(np.repeat(np.arange(len(sizes)), sizes), values)
                text = w.text[: len(w.fits)]
                hit = np.flatnonzero(w.fits)
                hit = hit[np.isin(set_pairs(text[hit], w.least[hit]), known)]
                text, number, h1, h2 = text[hit], w.number[hit], *(x[hit] if len(hit) else w.least for x in (w.span, w.span2))
                order = np.lexsort((number, h2, h1, text))
                same = (text[order][1:] == text[order][:-1]) & (h1[order][1:] == h1[order][:-1]) & (h2[order][1:] == h2[order][:-1])
                again = np.zeros(len(hit), bool)
                again[order[1:][same]] = True
                own = part.column("rank").take(pa.array(text))
                short = (h2 >> np.uint64(32)).astype(np.uint32).view(np.int32)
                columns = [own, pa.array(number.astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(short), pa.array(again)]
                yield pa.RecordBatch.from_arrays(columns, names=["rank", "start", "h1", "h2", "again"])

    return rows.mapInArrow(run, "rank long, start int, h1 long, h2 int, again boolean")


def set_pairs(rows: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """One number for each pair of a row of the slice and a hash."""
    return mix(hashes ^ mix(rows.astype(np.uint64) + np.uint64(1)))


def later_windows(found: DataFrame) -> DataFrame:
    """(rank, start) of the windows whose words also start earlier."""
    once = found.filter("NOT again")
    first = once.groupBy("h1", "h2").agg(F.min("rank").alias("__f"))
    later = once.join(first, ["h1", "h2"]).filter("rank != __f").select("rank", "start")
    return later.unionByName(found.filter("again").select("rank", "start"))


def longer(found: DataFrame, levels: int = 64) -> DataFrame:
    """(rank, longest): words of the longest window of SPAN times a power of two in a document that occurs twice or more.

    Each level pairs repeated windows with the repeated ones right after them, and goes on while any pair repeats.
    """
    level, length, best = found.select("rank", "start", "h1", "h2"), SPAN, []
    for _ in range(levels):
        many = level.groupBy("h1", "h2").count().filter("count > 1").select("h1", "h2")
        level = materialize(level.join(many, ["h1", "h2"]), "span-level")
        best.append(level.select("rank").distinct().withColumn("longest", F.lit(length)))
        if level.isEmpty():
            break
        after = level.select("rank", (F.col("start") - length).alias("start"), F.col("h1").alias("a1"), F.col("h2").alias("a2"))
        level = level.join(after, ["rank", "start"])
        level = level.select("rank", "start", F.xxhash64("h1", "a1").alias("h1"), F.hash("h2", "a2").alias("h2"))
        length *= 2
    return functools.reduce(DataFrame.unionByName, best).groupBy("rank").agg(F.max("longest").alias("longest"))


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with n_words, n_removed and kept: each text without words that a window starting earlier repeats.

    Kept words are joined by one space. Earlier means a smaller id, or the same document and an earlier word; null ids come last,
    rows that share an id come in order of a hash of their texts, and rows that share id and text are one document. Null texts
    have no words. Columns named as the results are replaced. Runs jobs and writes working tables.
    """
    own = ("n_words", "n_removed", "kept")
    df = df.select(*[c for c in df.columns if c.lower() not in own])
    keyed = _keyed(df, doc_id, text).withColumns({"__text": F.coalesce(F.col(text), F.lit("")), "__null": F.col(doc_id).isNull()})
    docs = keyed.select("__k", "__t", "__null", "__text")
    narrow, halves = repeated_halves(docs)
    found = materialize(candidates(docs, halves), "span-windows")
    tidy(df.sparkSession)
    later = later_windows(found).groupBy("rank").agg(F.collect_set("start").alias("starts"))
    plan = narrow.join(later, "rank", "left")
    plan = materialize(plan.filter("copy OR starts IS NOT NULL").select("__k", "__t", "copy", "starts"), "span-plan")
    release(found)
    tidy(df.sparkSession)
    return removed(keyed.drop("__null", "__text").join(plan, ["__k", "__t"], "left"), text)


def removed(df: DataFrame, text: str) -> DataFrame:
    """Apply the removal plan in the columns copy and starts."""
    schema = [f for f in df.schema.fields if f.name not in ("__k", "__t", "copy", "starts")]
    outs = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept", StringType())]

    def run(batches):
        for batch in batches:
            for part in slices(batch, "__in"):
                raw, at = text_bytes(part.column("__in"))
                starts, ends, before = word_spans(raw, at)
                counts = np.diff(before)
                lists, copies = part.column("starts").to_pylist(), part.column("copy").to_pylist()
                gone = np.zeros(len(starts) + 1, np.int64)
                for i, (list_, copy) in enumerate(zip(lists, copies, strict=True)):
                    if copy and counts[i] >= SPAN:
                        gone[before[i]] += 1
                        gone[before[i + 1]] -= 1
                    elif list_:
                        a = before[i] + np.array(list_)
                        np.add.at(gone, a, 1)
                        np.add.at(gone, a + SPAN, -1)
                gone = np.cumsum(gone[:-1]) > 0
                texts = _joined(raw, starts, ends, before, ~gone)
                dropped = np.add.reduceat(np.append(gone, False).astype(np.int64), before[:-1]) * (counts > 0)
                own = [part.column(f.name) for f in schema]
                made = [pa.array(counts, pa.int64()), pa.array(dropped, pa.int64()), texts]
                yield pa.RecordBatch.from_arrays([*own, *made], names=[f.name for f in [*schema, *outs]])

    return df.select(*[f"`{f.name}`" for f in schema], "copy", "starts", F.col(f"`{text}`").alias("__in")).mapInArrow(
        run, StructType([*schema, *outs])
    )


def _joined(raw, starts, ends, before, keep) -> pa.Array:
    """Per text the kept words, one space between."""
    sizes = np.where(keep, ends - starts + 1, 0)
    ends_out = np.cumsum(sizes)
    out = np.full(int(ends_out[-1]) if len(sizes) else 0, 32, np.uint8)
    begins = ends_out - sizes
    at, to, length = starts[keep], begins[keep], (ends - starts)[keep]
    index = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(to, length) + index] = raw[np.repeat(at, length) + index]
    edges = np.concatenate([[0], ends_out])[before]
    texts = [out[a : max(a, b - 1)].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return pa.array(texts, pa.binary()).cast(pa.string())


def digest(df: DataFrame) -> DataFrame:
    return df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
