"""Text operators against brute force, under few and many partitions, and on odd rows."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import jaccard as brute_jaccard
from brute import quality as brute_quality
from brute import spans as brute_spans

from lumenframe.llm import jaccard, quality, spans

EMPTY = "doc_id long, text string, kept string, n_words string, __x int, rank int, size string"


def odd_rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    a, b, long = text(60), text(25), text(6000)
    change = a.split()
    change[30] = "other"
    return [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, a), (5, a), (6, " ".join(change)), (7, f"{b} {text(10)} {b}"), (8, long),
        (9, f"{text(5)}  {a}\n{text(5)}"), (10, long + " x"), (11, "one two"), (12, "one two"), (13, "a b \x1c c"), (14, "x " * 500),
        (15, text(19)), (16, "é ü\t中文 " * 10), (17, a + " " + a), (-3, text(40)), (18, b.replace(" ", "\n\n")),
    ]


def test_jaccard_equals_brute_force(documents, corpus, partitions):
    for rows in (odd_rows(), corpus):
        want = brute_jaccard(rows)
        for got in partitions(lambda rows=rows: jaccard.join(documents(rows)).collect(), (1, 7)):
            assert len(got) == len(rows)
            assert {r.doc_id: (r.class_id, r.n_links) for r in got} == want


def test_jaccard_large_group_in_blocks(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randint(1, 6)):
            words[rng.randrange(200)] = f"x{rng.randrange(50)}"
        rows.append((i, " ".join(words)))
    got = jaccard.join(documents(rows)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute_jaccard(rows)


def test_jaccard_keeps_one_of_each_group(documents):
    rows = [*odd_rows(), (4, odd_rows()[3][1]), (None, odd_rows()[7][1]), (None, "null id alone here now"), (20, "null id alone here now")]
    kept = sorted((r.doc_id is None, r.doc_id) for r in jaccard.keep_one(documents(rows)).collect())
    classes = brute_jaccard(odd_rows())
    assert [i for _, i in kept if i is not None] == sorted({c for c, _ in classes.values()} | {20})


def test_prefix_depth_is_shortened_to_the_target():
    assert jaccard.depth_for(0.8, 24, 8, 0.9999) == 5
    assert jaccard.depth_for(0.99, 24, 8, 0.9999) == 8
    assert jaccard.depth_for(0.1, 2, 8, 0.99) == 1


def test_spans_equal_brute_force(documents, corpus, partitions):
    for rows in (odd_rows(), corpus):
        want = brute_spans(rows)
        for got in partitions(lambda rows=rows: spans.dedup(documents(rows)).collect(), (1, 7)):
            assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == want


def test_spans_order_of_null_and_equal_ids(documents):
    text = " ".join(f"t{i}" for i in range(30))
    got = spans.dedup(documents([(None, text + " end"), (5, text), (5, text), (9, "start " + text)])).collect()
    by = {(r.doc_id, r.n_words): r.n_removed for r in got}
    assert by == {(5, 30): 0, (9, 31): 30, (None, 31): 30} and len(got) == 4


def test_longer_windows_until_none_survives(documents):
    text = " ".join(f"t{i}" for i in range(100))
    docs = documents([(1, text), (2, "a " + text + " b"), (3, " ".join(f"u{i}" for i in range(100)) + " " + text[: text.index(" t30")])])
    keyed = spans._keyed(docs, "doc_id", "text").selectExpr("__k", "__t", "doc_id IS NULL AS __null", "text AS __text")
    _, halves = spans.repeated_halves(keyed)
    got = spans.longer(spans.candidates(keyed, halves)).collect()
    assert sorted(r.longest for r in got) == [20, 80, 80]


def test_quality_equals_brute_force(spark, documents, corpus):
    trusted = {i for i, _ in corpus if i % 3 == 0}
    for rows in (odd_rows(), corpus):
        ids = spark.createDataFrame([(i,) for i in sorted(trusted)], "doc_id long")
        names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept".split()
        got = {r.doc_id: tuple(r[c] for c in names) for r in quality.judge(documents(rows), ids).collect()}
        assert got == {i: w for (i, _), w in zip(rows, brute_quality(rows, trusted), strict=True)}


def test_quality_of_a_long_text(spark, documents):
    """The threshold times the n-grams of a text of over 21,474 words is beyond an int."""
    rng = np.random.default_rng(9)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(3000, size=n))) for i, n in enumerate((30, 21_474, 21_475, 60_000))]
    ids = spark.createDataFrame([(0,), (2,)], "doc_id long")
    got = {r.doc_id: (r.n_words, r.base_failed, r.kept) for r in quality.judge(documents(rows), ids).collect()}
    want = brute_quality(rows, {0, 2})
    assert got == {i: (w[0], *w[-2:]) for (i, _), w in zip(rows, want, strict=True)}


@pytest.mark.parametrize("name", ["jaccard", "spans", "quality"])
def test_empty_table_and_clashing_columns(spark, name):
    run = {
        "jaccard": lambda d: jaccard.keep_one(d),
        "spans": lambda d: spans.dedup(d),
        "quality": lambda d: quality.judge(d, d.select("doc_id")),
    }[name]
    assert run(spark.createDataFrame([], EMPTY)).count() == 0
    one = run(spark.createDataFrame([(1, "a b c " * 20, "k", "n", 3, 4, "s")], EMPTY)).collect()[0]
    assert (one.doc_id, one["__x"], one["rank"], one["size"]) == (1, 3, 4, "s")


def test_slices_cut_texts_alike():
    import pyarrow as pa

    rng = np.random.default_rng(0)
    texts = pa.array([None, "", *(" ".join(rng.choice(["a", "bb", "ccc"], 50)) for _ in range(20))])
    whole = jaccard.shingles(texts)
    parts = [jaccard.shingles(texts.slice(i, 1)) for i in range(len(texts))]
    assert np.array_equal(whole[0], np.concatenate([p[0] for p in parts]))
