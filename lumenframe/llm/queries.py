"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lumenframe.llm import bpe, chat, counts, forest, html, jaccard, language, mixing, phrases, quality, resample, shards, spans
from lumenframe.llm.registry import ORACLES, QUERIES, query, read


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_bpe_round_trip")
def bpe_round_trip(spark, folder):
    return bpe.digest(encoded(read(spark, folder, "documents")))


def encoded(docs):
    return bpe.encode(docs.select("doc_id", "text"), tokenizer_path(), decoded="decoded").drop("text")


@query("op2_nearest_vectors")
def nearest_vectors(spark, folder):
    return forest.neighbours(read(spark, folder, "embeddings"), lambda c: F.col(c) % 20 == 0)


SHARDS = [f"shard-{i:03d}" for i in range(64)]


@query("op3_shard_documents")
def shard_documents(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "source")
    return shards.place(docs, ["doc_id"], SHARDS)


@query("op4_jaccard_join")
def jaccard_join(spark, folder):
    return jaccard.join(read(spark, folder, "documents"))


@query("op5_language_kernel")
def language_kernel(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.held_out())
    model = language.fit(docs.filter("NOT held_out"))
    return language.predict(docs.select("doc_id", "held_out", "text"), model).select("doc_id", "held_out", "lang_pred", "score")


@query("op6_remove_repeated_spans")
def remove_repeated_spans(spark, folder):
    return spans.digest(spans.dedup(read(spark, folder, "documents").select("doc_id", "text")))


@query("op7_quality_rules")
def quality_rules(spark, folder):
    trusted = quality.trusted_ids(read(spark, folder, "labels"))
    made = quality.judge(read(spark, folder, "documents").select("doc_id", "text"), trusted)
    return made.drop("text")


@query("op8_extract_html")
def extract_html(spark, folder):
    return html.extract(read(spark, folder, "pages"))


@query("op9_mix_sources", mixing.SQL)
def mix_sources(spark, folder):
    return mixing.digest(mixing.mix(read(spark, folder, "documents")))


#: A conversation whose texts look like another template's marks.
TRICKY = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query("op10_format_conversations")
def format_conversations(spark, folder):
    talks = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.format_turns(talks.unionByName(more)))


@query("op11_token_counts")
def token_counts(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return counts.digest(counts.add_counts(docs, tokenizer_path("byte_bpe_50k.json")))


@query("op12_phrase_collocations", phrases.SQL)
def phrase_collocations(spark, folder):
    return phrases.collocations(read(spark, folder, "documents").select("lang", "text"))


@query("op13_resample_to_target")
def resample_to_target(spark, folder):
    docs = read(spark, folder, "documents").select("doc_id", "text")
    made = resample.resample(docs, read(spark, folder, "benchmark").select("text"))
    return made.select("doc_id", "n_features", "weight", "score", "rank")


def all_queries():
    return dict(QUERIES)


def all_sql():
    return dict(ORACLES)
