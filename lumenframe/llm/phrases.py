"""Phrase collocations by dynamic itemset counting.

The rows are dealt into shards that are scanned in turn, round and round. Every word is active from the first shard on. A longer
phrase is active from the scan after both of its subphrases, without the last and without the first word, have reached the
threshold, raises its counter from that shard on, and stops one full cycle later, so that each phrase meets each shard once and
phrases of all lengths are counted in the same scans. The counters are a table of hashed counters whose size is bounded; phrases that
share a counter can only be activated too early, which costs work and loses nothing. From the scan after its counter has reached the
threshold, a phrase is counted by itself for one full cycle. These exact counts are the result; phrases in counters that stay below
the threshold are never written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumenframe.llm.common import mix, tidy
from lumenframe.sources.scratch import fresh_path, materialize, release

#: The longest phrase, the threshold, the score's scale and the share that a longer phrase must reach, in percent.
LONGEST = 4
THRESHOLD = 30
SCALE = 2_000_000
COVERED = 80
#: Shards of a cycle.
SHARDS = 4
#: Bytes of one language that a worker counts at a time.
BLOCK = 12 << 20
#: Counters of each length: one for this many bytes of text, between the two bounds (as powers of two).
BYTES_A_COUNTER, FEWEST, MOST = 16, 16, 24
NEVER = 255
ROWS = 1 << 16
# A to Z become a to z, tabs spaces, and all that ends a piece a line end
FOLDED = bytes(10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Counters of a length are summed in ranges of this many, so that two bytes tell them apart.
RANGE = 1 << 16
PENDING = 1 << 22
COUNTED = "lang string, size int, phrase string, n long"
#: Rows of a scan: exact counts (no words: all words of the language), or what a task adds to a range of counters.
SCANNED = f"{COUNTED}, range int, slots binary, sums binary"


def word_lanes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: tuple[int, int]) -> list[np.ndarray]:
    """Two independent 64-bit hashes of each word, from eight bytes at a time; ``raw`` goes on for eight bytes after the last word."""
    eight = np.ndarray(len(raw) - 7, "<u8", raw, strides=(1,))
    size = ends - starts
    lanes = [mix(size.astype(np.uint64) ^ np.uint64(seed)) for seed in seeds]
    alive = np.arange(len(starts))
    at = starts
    while len(alive):
        left = ends[alive] - at
        chunk = eight[at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * np.maximum(8 - left, 0)).astype(np.uint64))
        for lane, odd in zip(lanes, (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93), strict=True):
            with np.errstate(over="ignore"):
                lane[alive] = mix(lane[alive] ^ chunk) * np.uint64(odd)
        more = left > 8
        alive, at = alive[more], at[more] + 8
    return lanes


class Block:
    """The words of many texts of one language in a row, each with its place in the bytes, its piece and its hashes."""

    def __init__(self, lang: str, texts: list[bytes]):
        raw = np.frombuffer(b"\n".join(texts).translate(FOLDED) + b"\n" * 8, np.uint8)
        blank = raw == 32
        raw = raw[~(blank & np.append(False, blank[:-1]))]  # one space between words, so that a phrase is a stretch of bytes
        outside = (raw == 32) | (raw == 10)
        edges = np.flatnonzero(np.diff(outside, prepend=True))
        self.starts, self.ends = edges[::2], edges[1::2]
        self.pieces = np.cumsum(raw == 10, dtype=np.int32)[self.starts]
        seed = int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")
        self.hashes, self.checks = word_lanes(raw, self.starts, self.ends, (seed, seed ^ 0x5851F42D4C957F2D))
        self.raw, self.lang = raw, lang

    def phrase_hashes(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, hash of the phrase from each place, whether there is one) for 1, 2, ... words."""
        made = self.hashes
        for size in range(1, LONGEST + 1):
            if size > 1:
                with np.errstate(over="ignore"):
                    made = mix(made[:-1] * np.uint64(0x9E3779B97F4A7C15) + self.hashes[size - 1 :])
            yield size, made, self.pieces[: len(made)] == self.pieces[size - 1 :]

    def grouped(self, size: int, hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first place, count) of each phrase of ``size`` words that begins at one of the places; 128 bits a word tell phrases apart."""
        order = places[np.argsort(hashes[places])]
        new = np.ones(len(order), bool)
        for k in range(size):
            checks = self.checks[order + k]
            new[1:] = (checks[1:] != checks[:-1]) | (new[1:] if k else hashes[order[1:]] != hashes[order[:-1]])
        first = np.flatnonzero(new)
        return order[first], np.diff(np.append(first, len(order)))

    def rows(self, size: int, first: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The phrases that begin at ``first`` and their counts, in batches."""
        for a in range(0, len(first), ROWS):
            at = first[a : a + ROWS]
            begin, end = self.starts[at], self.ends[at + size - 1]
            offsets = np.append(0, np.cumsum(end - begin))
            letters = self.raw[np.repeat(begin - offsets[:-1], end - begin) + np.arange(offsets[-1])]
            phrases = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(letters))
            yield self.counted(size, phrases, pa.array(n[a : a + ROWS], pa.int64()))

    def total(self) -> pa.RecordBatch:
        return self.counted(0, pa.array([""]), pa.array([len(self.starts)], pa.int64()))

    def counted(self, size: int, phrases: pa.Array, n: pa.Array) -> pa.RecordBatch:
        many = len(phrases)
        columns = [pa.repeat(self.lang, many), pa.repeat(pa.scalar(size, pa.int32()), many), phrases, n]
        return scanned(*columns, pa.nulls(many, pa.int32()), pa.nulls(many, pa.binary()), pa.nulls(many, pa.binary()))


def scanned(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names=["lang", "size", "phrase", "n", "range", "slots", "sums"])


class Rises:
    """By how much a task raises the counters of each length: at most to the threshold, sent by ranges of counters."""

    def __init__(self):
        self.held: dict[int, list[np.ndarray]] = {}
        self.size = 0

    def add(self, size: int, slots: np.ndarray) -> None:
        slots = np.sort(slots)
        first = np.flatnonzero(np.append(True, slots[1:] != slots[:-1])[: len(slots)])
        n = np.minimum(np.diff(np.append(first, len(slots))), THRESHOLD).astype(np.uint32)
        self.held.setdefault(size, []).append(slots[first] << np.uint32(5) | n)  # 24 bits of counter, 5 of a number up to 30
        self.size += len(first)

    def rows(self) -> Iterator[pa.RecordBatch]:
        for size, parts in self.held.items():
            both = np.sort(np.concatenate(parts))
            slots, n = both >> np.uint32(5), both & np.uint32(31)
            first = np.flatnonzero(np.append(True, slots[1:] != slots[:-1])[: len(slots)])
            if not len(first):
                continue
            slots, n = slots[first], np.minimum(np.add.reduceat(n, first), THRESHOLD).astype(np.uint8)
            ranges = slots // RANGE
            cuts = np.append(np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])), len(slots))
            steps = np.diff(slots, prepend=slots[:1]).astype(np.uint16)  # packs better than the counters themselves
            steps[cuts[:-1]] = slots[cuts[:-1]] % RANGE
            pairs = list(zip(cuts[:-1], cuts[1:], strict=True))
            many = len(pairs)
            columns = [pa.nulls(many, pa.string()), pa.array([size] * many, pa.int32()), pa.nulls(many, pa.string()), pa.nulls(many, pa.int64())]
            columns.append(pa.array(ranges[cuts[:-1]], pa.int32()))
            yield scanned(*columns, *(pa.array([x[a:b].tobytes() for a, b in pairs], pa.binary()) for x in (steps, n)))
        self.held, self.size = {}, 0


def active_counts(block: Block, step: int, shards: int, reached: list[np.ndarray], rises: Rises) -> Iterator[pa.RecordBatch]:
    """Exact counts of the block's phrases that are in their cycle at ``step``; ``rises`` gets the phrases that raise their counters.

    ``reached`` has for each counter the step from which its phrases are counted by themselves. A phrase begins where both of
    its subphrases do, and is counted by itself from there or from ``reached``, whichever is later.
    """
    bits = np.uint64(64 - len(reached[0]).bit_length() + 1)
    if step < shards and len(block.starts):
        yield block.total()
    since = None
    for size, hashes, whole in block.phrase_hashes():
        slots = (hashes >> bits).astype(np.uint32)
        full = reached[size - 1][slots]
        begun = np.zeros(len(slots), np.uint8) if since is None else np.maximum(since[:-1], since[1:])
        rises.add(size, slots[whole & (full == NEVER) & (begun <= step) & (begun > step - shards)])
        since = np.maximum(begun, full)
        yield from block.rows(size, *block.grouped(size, hashes, np.flatnonzero(whole & (since <= step) & (since > step - shards))))


def scan(shard: DataFrame, step: int, shards: int, tables, counters: int) -> DataFrame:
    """What one shard's active phrases add; ``tables`` is a broadcast of the counters' steps, packed."""

    def run(batches):
        reached = [np.frombuffer(pa.decompress(t, counters, "zstd"), np.uint8) for t in tables.value]
        rises = Rises()
        waiting: dict[str, list[bytes]] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                waiting.setdefault(lang, []).append(text.as_buffer().to_pybytes())
                held += len(waiting[lang][-1])
                if held >= BLOCK:
                    yield from flush(waiting, reached, rises)
                    waiting, held = {}, 0
        yield from flush(waiting, reached, rises)
        yield from rises.rows()

    def flush(waiting, reached, rises):
        while waiting:
            lang, texts = waiting.popitem()
            yield from active_counts(Block(lang, texts), step, shards, reached, rises)
            if rises.size > PENDING:
                yield from rises.rows()

    return shard.select("lang", "text").mapInArrow(run, SCANNED)


def raised(rows: DataFrame, before: DataFrame | None, counters: int) -> DataFrame:
    """(size, range, sums, rose): the counters after a scan, at most at the threshold, and flags of those that just reached it.

    A range's rises stream through one task, which holds one byte for each of its counters; a range without counters that just
    reached the threshold has no flags.
    """
    width = min(counters, RANGE)

    def run(batches):
        totals: dict[tuple[int, int], np.ndarray] = {}
        was: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for size, part, steps, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own, n = totals.setdefault((size, part), np.zeros(width, np.uint8)), np.frombuffer(n, np.uint8)
                if steps is None:
                    was[size, part] = n >= THRESHOLD
                at = slice(None) if steps is None else np.cumsum(np.frombuffer(steps, np.uint16), dtype=np.int64)
                own[at] = np.minimum(own[at] + n, THRESHOLD)
        for key, own in totals.items():
            rose = (own >= THRESHOLD) & ~was.get(key, False)
            columns = [pa.array([x], pa.int32()) for x in key] + [pa.array([own.tobytes()], pa.binary())]
            flags = np.packbits(rose).tobytes() if rose.any() else None
            yield pa.RecordBatch.from_arrays([*columns, pa.array([flags], pa.binary())], names=["size", "range", "sums", "rose"])

    rises = rows.filter("range IS NOT NULL").select("size", "range", "slots", "sums")
    if before is not None:
        rises = rises.unionByName(before.select("size", "range", F.lit(None).cast("binary").alias("slots"), "sums"))
    return rises.repartition("size", "range").mapInArrow(run, "size int, range int, sums binary, rose binary")


def written(df: DataFrame, folder: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def count_phrases(docs: DataFrame, lang: str = "lang", text: str = "text", shards: int = SHARDS) -> tuple[DataFrame, DataFrame]:
    """(lang, n): all words of each language, and (lang, size, phrase, n): words and phrases that occur 30 times or more.

    Words come from lower-cased pieces between ``.,;:!?`` and line ends. A null lang is ``und``; a null text has no words. The
    counters stay in the shared folder; a flag for each that has just reached the threshold comes to the driver, which holds and
    sends the step of each, at most 2^24 bytes for each length. The exact counts of a scan are summed before the next one.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(f"`{lang}`"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"), F.octet_length(f"`{text}`").alias("size"),
        F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"),
    )
    dealt = fresh_path(spark, "shards")
    rows.filter("text IS NOT NULL").write.option("compression", "zstd").partitionBy("shard").parquet(dealt)
    table = spark.read.schema("lang string, text string, size int, shard int").parquet(dealt)
    total = table.agg(F.sum(F.col("size").cast("long"))).first()[0] or 0
    counters = 1 << min(max((total // BYTES_A_COUNTER).bit_length(), FEWEST), MOST)
    width = min(counters, RANGE)
    reached = [np.full(counters, NEVER, np.uint8) for _ in range(LONGEST)]
    counts, state, step, last = fresh_path(spark, "phrase-counts"), None, 0, 0
    while step < last + shards:
        tables = spark.sparkContext.broadcast([pa.compress(r, "zstd", asbytes=True) for r in reached])
        found = written(scan(table.filter(F.col("shard") == step % shards), step, shards, tables, counters), fresh_path(spark, "phrase-rows"))
        tables.destroy()
        before, state = state, written(raised(found, state, counters), fresh_path(spark, "counters"))
        exact = found.filter("range IS NULL").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
        written(exact, f"{counts}/step={step}")
        step += 1
        for size, part, rose in state.filter("rose IS NOT NULL").select("size", "range", "rose").collect():
            flags = np.unpackbits(np.frombuffer(rose, np.uint8), count=width).view(bool)
            reached[size - 1][part * width : (part + 1) * width][flags] = last = step
        for used in (found, before):
            if used is not None:
                release(used)
        tidy(spark)  # shuffle files of this step
    release(table)
    release(state)
    counted = spark.read.schema(COUNTED).parquet(counts)
    words = materialize(counted.filter("size = 0").groupBy("lang").agg(F.sum("n").alias("n")), "words")
    summed = counted.filter("size > 0").groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    frequent = materialize(summed.filter(F.col("n") >= THRESHOLD), "frequent-phrases")
    release(counted)
    return words, frequent


def _joined(words, start, size):
    return F.array_join(F.slice(words, start, size), " ")


def cut_scores(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, size, a, score, k, l, r) of each phrase of two words or more: its lowest-scoring cut, ties to the earliest."""
    words, size = F.split("phrase", " "), F.col("size")
    cuts = frequent.filter("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", _joined(words, F.lit(1), F.col("k")).alias("left"), _joined(words, F.col("k") + 1, size - F.col("k")).alias("right"))
    # a common word is a part of many phrases; adaptive execution splits its side of the join, the other side has one row
    for part, name in (("left", "l"), ("right", "r")):
        known = frequent.select("lang", F.col("phrase").alias(part), F.col("n").alias(name))
        cuts = cuts.join(known, ["lang", part])
    score = F.expr(f"CAST((CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(19,0))) DIV (CAST(l AS DECIMAL(19,0)) + r) AS BIGINT)")
    least = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return least.select("lang", "phrase", "size", "a", "cut.*")


def covered_by(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, longer): for each run of two words or more inside a longer phrase, the most often that any such phrase occurs."""
    words, size = F.split("phrase", " "), F.col("size")
    inner = F.flatten(
        F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: _joined(words, i, n)))
    )
    return frequent.filter("size > 2").select("lang", "n", F.explode(inner).alias("phrase")).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", top: int = 2000, shards: int = SHARDS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases.

    ``a``, ``l`` and ``r`` are the counts of the phrase and of the two parts of its lowest-scoring cut, ``n`` all words of the language
    (a null one is ``und``). A phrase inside a longer one that occurs at least 80 times for each 100 of its own is left out. Null and
    empty texts have no words, and languages without a frequent phrase no rows. Other columns are not read.
    """
    words, frequent = count_phrases(docs, lang, text, shards)
    scored = cut_scores(frequent).join(covered_by(frequent), ["lang", "phrase"], "left")
    covered = F.expr(f"CAST(longer AS DECIMAL(19,0)) * 100 >= CAST(a AS DECIMAL(19,0)) * {COVERED}")
    free = scored.filter(~F.coalesce(covered, F.lit(False)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    # the limit on the rank reaches the tasks before the exchange: each sends at most its own best rows of a language
    best = free.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return best.join(words, "lang").select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents WHERE text IS NOT NULL
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda w: w <> '') AS w FROM pieces
), grams AS (
    SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
    FROM words, (VALUES (1), (2), (3), (4)) AS sizes(size) WHERE len(w) >= size
), frequent AS (
    SELECT lang, size, phrase, count(*) AS n FROM grams GROUP BY ALL HAVING count(*) >= {THRESHOLD}
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang
), split AS (
    SELECT lang, phrase, size, n, string_split(phrase, ' ') AS w FROM frequent WHERE size > 1
), cuts AS (
    SELECT lang, phrase, size, n AS a, w, unnest(range(1, size)) AS k FROM split
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.k, x.n AS l, y.n AS r, (CAST({SCALE} AS HUGEINT) * c.a) // (x.n + y.n) AS score
    FROM cuts c
    JOIN frequent x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN frequent y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_runs AS (
    SELECT s.lang, s.n, array_to_string(s.w[i:i + m - 1], ' ') AS phrase
    FROM split s, range(1, 4) AS starts(i), range(2, 4) AS lengths(m) WHERE m < s.size AND i + m - 1 <= s.size
), longer AS (
    SELECT lang, phrase, max(n) AS n FROM inner_runs GROUP BY ALL
), free AS (
    SELECT b.* FROM lowest b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
    WHERE g.n IS NULL OR CAST(100 AS HUGEINT) * g.n < CAST({COVERED} AS HUGEINT) * b.a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM free
)
SELECT p.lang, p.rank, p.phrase, p.a, p.l, p.r, CAST(t.n AS BIGINT) AS n, CAST(p.score AS BIGINT) AS score
FROM ranked p JOIN totals t USING (lang) WHERE p.rank <= 2000
"""
