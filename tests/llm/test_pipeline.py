"""The pipeline against its stages in plain Python, with the mix by SQL; each registered query against a plain version."""

from __future__ import annotations

import hashlib

import duckdb
import numpy as np
from brute import jaccard, quality, spans

import __spark_entry__ as entry
import corpus_pipeline
from lumenframe.llm import bpe, mixing, queries


def test_pipeline_equals_plain_stages(spark, folder):
    table = lambda name: spark.read.parquet(f"{folder}/{name}.parquet").collect()
    docs = table("documents")
    trusted = {r.doc_id for r in table("labels") if r.quality == 1 and r.toxic == 0}
    kept = [d for d, q in zip(docs, quality([(d.doc_id, d.text) for d in docs], trusted), strict=True) if q[-1]]
    classes = jaccard([(d.doc_id, d.text) for d in kept])
    kept = [d for d in kept if classes[d.doc_id][0] == d.doc_id]
    cut = spans([(d.doc_id, d.text) for d in kept])
    rows = [(d.doc_id, cut[d.doc_id][2] if cut[d.doc_id][1] else d.text, d.source) for d in kept if not 0 < cut[d.doc_id][0] == cut[d.doc_id][1]]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    copies = dict(con.execute(f"SELECT doc_id, taken // size FROM ({mixing.SQL}) WHERE size > 0").fetchall())
    tokenizer = bpe.read_tokenizer(queries.tokenizer_path())
    want = []
    for i, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        want += [(i, len(ids), sha, decoded)] * copies.get(i, 0)
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == sorted(want) and len(want) > 50


def test_stages_on_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0


def test_first_stage_takes_a_long_text(spark, folder):
    """A text of over 21,474 words, which is kept, does not end the pipeline's first stage."""
    text = " ".join(f"w{x}" for x in np.random.default_rng(9).integers(3000, size=25_000))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one = spark.createDataFrame([(10**9, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.unionByName(one.select(*docs.columns))
    got = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, folder).collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    trusted = {r.doc_id for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if r.quality == 1 and r.toxic == 0}
    assert got == {i for (i, _), q in zip(rows, quality(rows, trusted), strict=True) if q[-1]}


def test_all_eleven_are_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and set(entry.oracle_sql()) <= set(names)


def test_nearest_vectors_recall(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = queries.QUERIES["op2_nearest_vectors"](spark, folder).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, set()).add(r.vec_id)
    hits = []
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        s[i] = -np.inf
        hits.append(len(by[ids[i]] & set(ids[np.argsort(-s)[:20]].tolist())) / 20)
    assert np.mean(hits) >= 0.9 and all(len(v) == 20 for v in by.values())


def test_spans_and_pairs_of_the_registered_queries(spark, folder, corpus):
    want = spans(corpus)
    got = queries.QUERIES["op6_remove_repeated_spans"](spark, folder).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == {
        i: (a, b, hashlib.sha256(t.encode()).hexdigest()) for i, (a, b, t) in want.items()
    }
    want = jaccard(corpus)
    got = queries.QUERIES["op4_jaccard_join"](spark, folder).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == want
