"""Token counts, phrase collocations and importance resampling against plain versions."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from lumenframe.llm import counts, phrases, resample
from lumenframe.llm.common import read_tokenizer
from lumenframe.llm.queries import QUERIES, tokenizer_path

BYTE_LEVEL = "byte_bpe_50k.json"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def library_counts(text):
    tokenizer = read_tokenizer(tokenizer_path(BYTE_LEVEL))
    return [len(tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(1, len(text) + 1)]


def odd_texts():
    rnd = random.Random(5)
    parts = [*"aabcethinos're ll ve  \n\n\t'',.   　\x1c​﻿\x85éÈ中文ก123²½😀👍🏽_<|>́", "<|endoftext|>", "the", "'re", "<|endof", "    ", "===="]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    fixed = ["", " ", "  a", "a  ", "\n\nb", " \n b", "x \n\n y", "don't we're they'll I've 'r", "a <|endoftext|> b", "<|endoftext|><|endoftext|>"]
    return [*fixed, "a" * 300, " " * 90 + "b", *made]


def test_counts_of_every_prefix_are_the_librarys():
    made = counts._prefixes(tokenizer_path(BYTE_LEVEL))
    texts = odd_texts()
    for text, own in zip(texts, made(texts), strict=True):
        assert own.tolist() == library_counts(text), repr(text)


def test_every_white_space_is_seen_as_the_library_sees_it():
    made = counts._prefixes(tokenizer_path(BYTE_LEVEL))
    for c in map(chr, [*range(0x100), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF]):
        text = f"a{c}{c}b{c}c"
        assert made([text])[0].tolist() == library_counts(text), hex(ord(c))


def test_counts_do_not_depend_on_what_is_remembered(monkeypatch):
    texts = odd_texts()
    made = counts.Prefixes(tokenizer_path(BYTE_LEVEL))
    monkeypatch.setattr(counts, "REMEMBERED", 3)
    monkeypatch.setattr(counts, "BORDERS", 3)
    first = [made([t])[0].tolist() for t in texts]
    assert first == [c.tolist() for c in made(texts)]


def test_stored_counts_answer_budgets(spark):
    texts = [(1, None), (2, ""), (3, "Hello, hello world!\n\n  Bye"), (3, "Hello, hello world!\n\n  Bye"), (4, "ééé 中文字 😀 " * 2000)]
    df = spark.createDataFrame([(i, t, b"x", 7) for i, t in texts], "doc_id long, text string, prefix_tokens binary, n_fit int")
    made = counts.add_counts(df, tokenizer_path(BYTE_LEVEL))
    assert made.columns == ["doc_id", "text", "n_fit", "prefix_tokens"]
    asked = made.select("doc_id", "text", *[counts.tokens_of_first(F.col("prefix_tokens"), F.lit(k)).alias(f"k{k}") for k in (-1, 0, 5, 20, 10**6)])
    for r in asked.collect():
        want = [0, *library_counts((r.text or "")[:60])]
        total = len(read_tokenizer(tokenizer_path(BYTE_LEVEL)).encode(r.text or "", add_special_tokens=False).ids)
        assert (r["k-1"], r.k0, r.k5, r.k20) == (0, 0, want[min(5, len(want) - 1)], want[min(20, len(want) - 1)])
        assert r.k1000000 == total
    for r, cut in zip(made.sort("doc_id").collect(), counts.truncate(made, 6).sort("doc_id").collect(), strict=True):
        own = counts._prefixes(tokenizer_path(BYTE_LEVEL))([r.text])[0].tolist()
        assert (cut.text or "") == (r.text or "")[: max([i + 1 for i, n in enumerate(own) if n <= 6], default=0)]
    assert counts.digest(made.limit(0)).count() == 0


def test_counts_refuse_other_kinds_of_files():
    with pytest.raises(ValueError, match="byte-level"):
        counts.Prefixes(tokenizer_path("word_bpe_49k.json"))


def test_query_counts_as_the_library(spark, folder, corpus):
    tokenizer = read_tokenizer(tokenizer_path(BYTE_LEVEL))
    want = {i: (len((t or "").encode()), len(tokenizer.encode(t or "", add_special_tokens=False).ids)) for i, t in corpus}
    got = QUERIES["op11_token_counts"](spark, folder).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and all(r.over_limit == (r.n_tokens > 1024) for r in got)


def plain_collocations(rows):
    f, totals = Counter(), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            f.update((lang or "und", tuple(words[i : i + n])) for n in range(1, 5) for i in range(len(words) - n + 1))
    scored, longer = [], Counter()
    for (lang, w), a in f.items():
        if len(w) < 2 or a < 30:
            continue
        for n in range(2, len(w)):
            for i in range(len(w) - n + 1):
                longer[lang, w[i : i + n]] = max(longer[lang, w[i : i + n]], a)
        score, k = min((2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w)))
        scored.append((lang, w, a, f[lang, w[:k]], f[lang, w[k:]], score))
    out = []
    for lang in {s[0] for s in scored}:
        free = [s for s in scored if s[0] == lang and 100 * longer[lang, s[1]] < 80 * s[2]]
        free.sort(key=lambda s: (-s[5], -s[2], " ".join(s[1]).encode()))
        out += [(lang, i, " ".join(w), a, l, r, totals[lang], s) for i, (_, w, a, l, r, s) in enumerate(free[:2000], 1)]
    return sorted(out)


def talk(seed, n):
    rnd = random.Random(seed)
    stock = ["new york", "New York city", "red,green", "a b c d", "so it goes", "a\tb  c", "x!y", "Été É", "\x0b", "\r\n", "tail", "of", "the", "the"]
    return [(rnd.choice(["en", "en", None, "und", "de"]), " ".join(rnd.choice(stock) for _ in range(rnd.randint(0, 40)))) for _ in range(n)]


@pytest.mark.parametrize("shards", [1, 3])
def test_collocations_equal_plain_counts(spark, shards):
    rows = [*talk(3, 250), ("en", None), (None, None), ("en", ""), ("fr", "un deux. " * 40), ("en", "long ago " * 20000), ("es", "once upon a time")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, text string, shard int, phrase string").repartition(7)
    got = phrases.collocations(df, shards=shards)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows)


def test_shared_counters_lose_no_phrase(spark, monkeypatch):
    rows = talk(4, 200)
    monkeypatch.setattr(phrases, "FEWEST", 2)
    monkeypatch.setattr(phrases, "MOST", 2)
    monkeypatch.setattr(phrases, "BLOCK", 200)
    got = phrases.collocations(spark.createDataFrame(rows, "lang string, text string"), top=10**6)
    assert sorted(tuple(r) for r in got.collect()) == plain_collocations(rows)


def test_phrases_reached_late_meet_every_shard_once(spark):
    """A chain that becomes frequent only with the last shard of each cycle."""
    rows = [("en", "one two three four")] * 30
    df = spark.createDataFrame(rows, "lang string, text string").coalesce(1)
    got = {r.phrase: r.n for r in phrases.count_phrases(df)[1].collect()}
    assert got["one two three four"] == 30 and got["two three"] == 30


def test_phrases_below_the_threshold_are_not_written(spark, monkeypatch):
    """Working tables hold counts of frequent phrases alone, summed, and the driver gets flags but no sums of the counters."""
    rows = [("en", " ".join(f"w{i}x{j}" for j in range(40)) + ". to be or not") for i in range(200)]
    tables, sent, collect = [], [], DataFrame.collect
    write, wide = phrases.written, lambda r: sum(len(x) for x in r if isinstance(x, bytes | bytearray))
    monkeypatch.setattr(phrases, "written", lambda df, folder: tables.append(write(df, folder)) or tables[-1])
    monkeypatch.setattr(phrases, "release", lambda df: None)
    monkeypatch.setattr(DataFrame, "collect", lambda df: sent.append(collect(df)) or sent[-1])
    _, frequent = phrases.count_phrases(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    assert {r.phrase: r.n for r in collect(frequent.filter("size > 2"))} == {"to be or": 200, "be or not": 200, "to be or not": 200}
    names = {r.phrase for t in tables if "phrase" in t.columns for r in collect(t.filter("size > 0 AND phrase IS NOT NULL"))}
    assert names == {" ".join("to be or not".split()[a:b]) for a in range(4) for b in range(a + 1, 5)}
    assert len(sent) > 4 and max(sum(map(wide, rows)) for rows in sent) <= phrases.LONGEST * (1 << 16) // 8


def test_rises_keep_their_counters_and_sums():
    rng = np.random.default_rng(1)
    drawn = rng.integers(0, 1 << 24, 50_000, dtype=np.uint32)
    drawn = np.concatenate([drawn, drawn[:100].repeat(40), np.uint32([0, 0, (1 << 24) - 1])])
    rises = phrases.Rises()
    for part in np.array_split(drawn, 3):
        rises.add(2, part)
    got = {}
    for batch in rises.rows():
        for r in batch.to_pylist():
            at = np.cumsum(np.frombuffer(r["slots"], np.uint16), dtype=np.int64) + r["range"] * phrases.RANGE
            got |= dict(zip(at.tolist(), np.frombuffer(r["sums"], np.uint8).tolist(), strict=True))
    assert got == {k: min(v, 30) for k, v in Counter(drawn.tolist()).items()} and list(rises.rows()) == []


def test_collocations_of_nothing(spark):
    for rows in ([], [("en", None)], [("en", "a b c")]):
        assert phrases.collocations(spark.createDataFrame(rows, "lang string, text string")).count() == 0


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9 * 10**18 // 2
    rows = [("en", 1, "a", big + 1), ("en", 1, "b", big + 3), ("en", 2, "a b", big)]
    got = phrases.cut_scores(spark.createDataFrame(rows, "lang string, size int, phrase string, n long")).first()
    assert got.score == 2000000 * big // (2 * big + 4)


def plain_resample(docs, target, percent=5):
    def words(text):
        return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(FOLD))

    def runs(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    made = [(i, runs(t), len(words(t))) for i, t in docs]
    s, t = Counter(b for _, r, _ in made for b in r), Counter(b for x in target for b in runs(x))
    big_s, big_t = float(s.total() + 10000), float(t.total() + 10000)
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in s}
    out = []
    for i, r, n in made:
        weight = sum(gain[b] for b in r)
        h = int(sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(r), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((x for x in out if x[4] >= 20), key=lambda x: (-x[3], x[0] is not None, x[0] or 0))
    place = {id(x): k for k, x in enumerate(able[: percent * len(able) // 100], 1)}
    return [(*x[:4], place.get(id(x))) for x in out]


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


COLUMNS = ["doc_id", "n_features", "weight", "score", "rank"]


def test_query_resamples_as_the_plain_version(spark, folder, corpus):
    target = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    got = QUERIES["op13_resample_to_target"](spark, folder)
    assert got.columns == COLUMNS
    assert ordered(got.collect()) == ordered(plain_resample(corpus, target))


def test_resample_odd_rows(spark):
    rnd = random.Random(6)
    texts = ["".join(rnd.choice("abcXYZ  \n.,é中 0_-") for _ in range(rnd.randint(0, 200))) for _ in range(150)]
    rows = [*enumerate(texts), (None, texts[3]), (900, None), (901, ""), (902, "word"), (903, "two words"), (904, "Über 9 " * 30000)]
    df = spark.createDataFrame([(i, t, 5, "s", i) for i, t in rows], "doc_id long, text string, rank int, score string, shown long")
    target = texts[:20] + [None, ""]
    made = resample.resample(df, spark.createDataFrame([(t,) for t in target], "text string"), 30, keep=["shown", "rank", "score"])
    assert made.columns == ["doc_id", "shown", "n_words", "n_features", "weight", "score", "rank"]
    assert ordered(made.select(COLUMNS).collect()) == ordered(plain_resample(rows, target, 30))


def test_resample_repeated_rows_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(25))
    df = spark.createDataFrame([(1, text)] * 40, "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    got = resample.resample(df, none, 50)
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 21))
    assert resample.resample(none, df).count() == 0
