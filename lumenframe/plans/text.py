"""Text and term selection queries on ``documents`` and ``labels``; train texts by hash of the id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenframe.functions import scalars
from lumenframe.functions.tokens import raw_tokens
from lumenframe.operators import selection as Sel
from lumenframe.operators import text as T
from lumenframe.operators.splits import holdout_hashed
from lumenframe.plans.features import texts
from lumenframe.plans.prep import round_doubles
from lumenframe.plans.registry import query
from lumenframe.sources.scratch import materialize
from lumenframe.sources.tables import table

TOP = 30
VARIANCE_P = 0.9
LENGTH = 128

# Stop words of the four languages of the texts.
STOPWORDS = (
    "the", "of", "and", "to", "in", "that", "is", "it", "de", "la", "le", "que", "les", "der", "die", "und", "den", "en", "el", "los",
)
# Word forms and their lemmas.
LEMMAS = {
    "was": "be", "is": "be", "are": "be", "had": "have", "has": "have", "les": "le", "la": "le", "des": "de", "du": "de",
    "die": "der", "das": "der", "den": "der", "dem": "der", "los": "el", "las": "el", "una": "un", "une": "un", "est": "être",
    "ist": "sein", "eine": "ein",
}
# Valence of words.
LEXICON = {
    "the": 0.1, "of": -0.1, "and": 0.3, "to": 0.2, "in": -0.2, "that": -0.4, "it": 0.5, "for": 0.6, "was": -0.5, "with": 0.7,
    "le": 0.2, "la": -0.3, "est": 0.6, "pas": -1.1, "der": 0.1, "das": 0.4, "nicht": -1.3, "los": 0.3, "el": -0.2, "este": 0.9,
}
# Words that act on the next word.
MODIFIERS = {"not": "negation", "ne": "negation", "en": "negation", "on": "booster", "de": "booster", "und": "booster"}
# Edges and names of the sentiment bins.
EDGES, LABELS = (-1.0, -0.4, 0.5, 1.0), ("negative", "neutral", "positive")

TOK_SQL = r"""
tok AS (SELECT doc_id, term FROM (SELECT doc_id, unnest(string_split_regex(lower(text), '[^\p{L}\p{N}_]+')) AS term FROM documents)
        WHERE length(term) >= 2),
lab AS (SELECT doc_id, quality, ('0x' || substr(md5(doc_id::VARCHAR || '-42'), 1, 8))::BIGINT % 100 < 75 AS train
        FROM labels JOIN documents USING (doc_id)),
allc AS (SELECT doc_id, term, count(*) AS cnt FROM tok JOIN lab USING (doc_id) GROUP BY doc_id, term),
voc AS (SELECT DISTINCT term FROM allc JOIN lab USING (doc_id) WHERE train),
tc AS (SELECT allc.*, quality, train FROM allc JOIN voc USING (term) JOIN lab USING (doc_id)),
sz AS (SELECT count(*) FILTER (quality = 0) AS s0, count(*) FILTER (quality = 1) AS s1, count(*)::DOUBLE AS n FROM lab WHERE train),
"""
CHI_SQL = TOK_SQL + """
chis AS (SELECT term, pow(o0 - t * s0 / n, 2) / (t * s0 / n) + pow(o1 - t * s1 / n, 2) / (t * s1 / n) AS score
         FROM (SELECT term, sum(cnt) FILTER (quality = 0) AS p0, coalesce(p0, 0)::DOUBLE AS o0, sum(cnt)::DOUBLE AS t, t - o0 AS o1
               FROM tc WHERE train GROUP BY term), sz),
chi AS (SELECT term, score, row_number() OVER (ORDER BY round(score, 9) DESC, term) AS rank FROM chis),
"""
MI_SQL = """
seen AS (SELECT term, cnt, count(*) FILTER (quality = 0) AS n0, count(*) FILTER (quality = 1) AS n1 FROM tc WHERE train GROUP BY term, cnt),
cells AS (SELECT term, n0, n1 FROM seen UNION ALL SELECT term, any_value(s0) - sum(n0), any_value(s1) - sum(n1) FROM seen, sz GROUP BY term),
mis AS (SELECT term, sum(CASE WHEN n0 > 0 THEN n0 / n * ln(n0 * n / ((n0 + n1) * s0)) ELSE 0 END
                         + CASE WHEN n1 > 0 THEN n1 / n * ln(n1 * n / ((n0 + n1) * s1)) ELSE 0 END) AS score
        FROM cells, sz GROUP BY term),
mi AS (SELECT term, score, row_number() OVER (ORDER BY round(score, 9) DESC, term) AS rank FROM mis),
"""
VAR_SQL = f"""
vars AS (SELECT term, sum(cnt * cnt) / any_value(n) - pow(sum(cnt) / any_value(n), 2) AS score FROM tc, sz WHERE train GROUP BY term),
var AS (SELECT term, score, row_number() OVER (ORDER BY term) AS rank FROM vars WHERE round(score, 9) > {VARIANCE_P * (1 - VARIANCE_P)!r}),
"""


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, quality, part of the labelled documents."""
    docs = table(spark, sf, "documents").select("doc_id")
    return holdout_hashed(docs.join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id"), "doc_id", 75)


def counted(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(counts of the train vocabulary in all labelled documents, labels with part), both written."""
    labels = materialize(labelled(spark, sf), "labels")
    docs = texts(spark, sf).join(labels.select("doc_id", "part"), "doc_id")
    counts = materialize(T.term_counts(docs, "doc_id", "text"), "counts")
    train = labels.filter("part = 'train'")
    vocabulary = T.vocabulary(counts.join(train.select("doc_id"), "doc_id", "left_semi"))
    return materialize(T.keep_terms(counts, vocabulary), "kept"), labels


def train_part(counts: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    train = labels.filter("part = 'train'").select("doc_id", "quality")
    return counts.join(train.select("doc_id"), "doc_id", "left_semi"), train


def chosen_sets(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    counts, train = train_part(*counted(spark, sf))
    return {name: select(counts, train, "doc_id", "quality", TOP) for name, select in Sel.SELECTORS.items()}


@query("term_counts", f"WITH {TOK_SQL.rstrip().rstrip(',')} SELECT doc_id, term, cnt FROM tc")
def term_counts(spark, sf):
    counts, _ = counted(spark, sf)
    return counts.select("doc_id", "term", "cnt")


@query("chi2_terms", f"WITH {CHI_SQL.rstrip().rstrip(',')} SELECT term, round(score, 6) AS score, rank FROM chi WHERE rank <= {TOP}")
def chi2_terms(spark, sf):
    counts, train = train_part(*counted(spark, sf))
    return round_doubles(Sel.top_terms(Sel.chi2_scores(counts, train, "doc_id", "quality"), TOP))


@query("mutual_info_terms", f"WITH {(TOK_SQL + MI_SQL).rstrip().rstrip(',')} SELECT term, round(score, 6) AS score, rank FROM mi WHERE rank <= {TOP}")
def mutual_info_terms(spark, sf):
    counts, train = train_part(*counted(spark, sf))
    return round_doubles(Sel.top_terms(Sel.mutual_info_scores(counts, train, "doc_id", "quality"), TOP))


@query("variance_terms", f"WITH {(TOK_SQL + VAR_SQL).rstrip().rstrip(',')} SELECT term, round(score, 6) AS score, rank FROM var WHERE rank <= {TOP}")
def variance_terms(spark, sf):
    counts, train = train_part(*counted(spark, sf))
    scores = Sel.variance_scores(counts, train, "doc_id")
    return round_doubles(Sel.variance_select(scores, VARIANCE_P, TOP))


SETS_SQL = f"""WITH {CHI_SQL}{MI_SQL}{VAR_SQL}
sets AS (SELECT term, 'chi2' AS s FROM chi WHERE rank <= {TOP} UNION ALL SELECT term, 'mi' FROM mi WHERE rank <= {TOP}
         UNION ALL SELECT term, 'var' FROM var WHERE rank <= {TOP})
"""


@query("selection_overlap", SETS_SQL + """
SELECT term, bool_or(s = 'chi2') AS in_chi2, bool_or(s = 'mi') AS in_mi, bool_or(s = 'var') AS in_var FROM sets GROUP BY term
""")
def selection_overlap(spark, sf):
    return Sel.overlap(chosen_sets(spark, sf))


@query("selection_table", SETS_SQL + """
SELECT row::INT AS row, any_value(term) FILTER (s = 'chi2') AS chi2, any_value(term) FILTER (s = 'mi') AS mi,
       any_value(term) FILTER (s = 'var') AS var
FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY term) AS row FROM sets) GROUP BY row
""")
def selection_table(spark, sf):
    return Sel.side_by_side(chosen_sets(spark, sf))


@query("naive_bayes", f"""WITH {TOK_SQL}
m AS (SELECT term, coalesce(sum(cnt) FILTER (quality = 0), 0) AS c0, coalesce(sum(cnt) FILTER (quality = 1), 0) AS c1
      FROM tc WHERE train GROUP BY term),
l AS (SELECT term, ln((c0 + 1) / (sum(c0) OVER () + count(*) OVER ())) AS l0, ln((c1 + 1) / (sum(c1) OVER () + count(*) OVER ())) AS l1 FROM m),
s AS (SELECT lab.doc_id, lab.quality, coalesce(sum(cnt * l0), 0) + any_value(ln(s0 / n)) AS p0, coalesce(sum(cnt * l1), 0) + any_value(ln(s1 / n)) AS p1
      FROM lab LEFT JOIN (SELECT doc_id, cnt, l0, l1 FROM tc JOIN l USING (term)) t USING (doc_id), sz GROUP BY lab.doc_id, lab.quality)
SELECT doc_id, quality, CASE WHEN round(p1, 9) > round(p0, 9) THEN 1 ELSE 0 END AS pred FROM s
""")
def naive_bayes(spark, sf):
    counts, labels = counted(spark, sf)
    model, priors = Sel.naive_bayes_fit(*train_part(counts, labels), "doc_id", "quality")
    docs = labels.select("doc_id", "quality")
    return Sel.naive_bayes_predict(counts, docs, "doc_id", materialize(model, "model"), priors)


SPACE_SQL = r"list_filter(string_split_regex(text, '[\t-\r\x1c-\x1f\x{85}\p{Z}]+'), lambda w: w <> '')"


def sql_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def sql_rows(pairs: dict) -> str:
    return ", ".join(f"('{k}', {v!r})" for k, v in pairs.items())


@query("strip_stopwords", f"""
SELECT doc_id, len(t)::INT AS n_before, len(k)::INT AS n_after, md5(array_to_string(k, ' ')) AS digest
FROM (SELECT doc_id, t, list_filter(t, lambda w: lower(w) NOT IN {sql_list(STOPWORDS)}) AS k
      FROM (SELECT doc_id, {SPACE_SQL} AS t FROM documents))
""")
def strip_stopwords(spark, sf):
    docs = texts(spark, sf)
    rows = docs.select("doc_id", F.size(raw_tokens(F.col("text"))).alias("n_before"), T.strip_stopwords(F.col("text"), STOPWORDS).alias("k"))
    return rows.select("doc_id", "n_before", F.size(raw_tokens(F.col("k"))).alias("n_after"), F.md5("k").alias("digest"))


def lemma_table(spark):
    return spark.createDataFrame(list(LEMMAS.items()), "form string, lemma string")


@query("lemmatize_lookup", f"""
WITH lem AS (SELECT * FROM (VALUES {sql_rows(LEMMAS)}) AS v(form, lemma)),
t AS (SELECT doc_id, unnest(k) AS w, generate_subscripts(k, 1) AS pos FROM
      (SELECT doc_id, list_filter({SPACE_SQL}, lambda w: lower(w) NOT IN {sql_list(STOPWORDS)}) AS k FROM documents)),
j AS (SELECT doc_id, count(lemma) FILTER (lemma <> w) AS n, string_agg(coalesce(lemma, w), ' ' ORDER BY pos) AS s
      FROM t LEFT JOIN lem ON form = w GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_changed, md5(coalesce(s, '')) AS digest FROM documents LEFT JOIN j USING (doc_id)
""")
def lemmatize_lookup(spark, sf):
    """Cleaning: stop words out, then lemmas in."""
    docs = texts(spark, sf).select("doc_id", T.strip_stopwords(F.col("text"), STOPWORDS).alias("text"))
    rows = T.lemmatize(docs, "doc_id", "text", lemma_table(spark))
    return rows.select("doc_id", "n_changed", F.md5("lemmas").alias("digest"))


SENT_SQL = rf"""
WITH lex AS (SELECT * FROM (VALUES {sql_rows(LEXICON)}) AS v(word, valence)),
md AS (SELECT * FROM (VALUES {sql_rows(MODIFIERS)}) AS v(word, kind)),
t AS (SELECT doc_id, unnest(k) AS word, unnest(list_concat([''], k[:-2])) AS before FROM
      (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}_]+'), lambda w: w <> '') AS k FROM documents)),
s AS (SELECT doc_id, sum(CASE kind WHEN 'negation' THEN -0.74 * valence WHEN 'booster' THEN valence + sign(valence) * 0.293
                         ELSE valence END::DOUBLE) AS s
      FROM t JOIN lex USING (word) LEFT JOIN md ON md.word = before GROUP BY doc_id),
c AS (SELECT doc_id, round(coalesce(s / sqrt(s * s + 15), 0), 4) + 0.0 AS compound FROM documents LEFT JOIN s USING (doc_id))
"""


def compounds(spark, sf):
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, valence double")
    modifiers = spark.createDataFrame(list(MODIFIERS.items()), "word string, kind string")
    scored = T.sentiment(texts(spark, sf), "doc_id", "text", lexicon, modifiers)
    return round_doubles(scored, 4)


@query("sentiment_score", SENT_SQL + "SELECT doc_id, compound FROM c")
def sentiment_score(spark, sf):
    return compounds(spark, sf)


@query("sentiment_label", SENT_SQL + """
SELECT label, CASE label WHEN 'negative' THEN 0 WHEN 'neutral' THEN 1 WHEN 'positive' THEN 2 ELSE -1 END AS code, count(*) AS cnt
FROM (SELECT CASE WHEN compound > -1 AND compound <= -0.4 THEN 'negative' WHEN compound > -0.4 AND compound <= 0.5 THEN 'neutral'
                  WHEN compound > 0.5 AND compound <= 1 THEN 'positive' END AS label FROM c) GROUP BY label
""")
def sentiment_label(spark, sf):
    label = scalars.cut_right(F.col("compound"), EDGES, LABELS)
    rows = compounds(spark, sf).select(label.alias("label"))
    return rows.select("label", scalars.category_code(F.col("label"), LABELS).alias("code")).groupBy("label", "code").agg(
        F.count(F.lit(1)).alias("cnt")
    )


@query("encode_ids", rf"""
WITH t AS (SELECT doc_id, unnest(k) AS term, generate_subscripts(k, 1) - 1 AS pos FROM
      (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}_]+'), lambda w: w <> '') AS k FROM documents)),
v AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) + 3 AS id FROM t GROUP BY term),
b AS (SELECT doc_id, pos // {LENGTH - 2} AS block, pos % {LENGTH - 2} + 1 AS slot, coalesce(id, 1) AS id FROM t LEFT JOIN v USING (term)),
g AS (SELECT doc_id, block, count(*) AS n, sum(id) AS s, sum(id * slot) AS ps FROM b GROUP BY doc_id, block
      UNION ALL SELECT doc_id, 0, 0, 0, 0 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM t))
SELECT doc_id, block::INT AS block, (n + 2)::INT AS n_real, (s + 5)::BIGINT AS id_sum, (ps + 3 * (n + 1))::BIGINT AS order_sum FROM g
""")
def encode_ids(spark, sf):
    """Whole texts in blocks of LENGTH ids; block 0 is the text cut to the length."""
    docs = texts(spark, sf)
    rows = T.encode_ids(docs, "doc_id", "text", T.frequent_ids(docs, "text"), LENGTH)
    ids = F.transform("ids", lambda x: x.cast("long"))
    placed = F.transform(ids, lambda x, i: x * i)

    def total(a):
        return F.aggregate(a, F.lit(0).cast("long"), lambda acc, x: acc + x)

    return rows.select(
        "doc_id", "block", F.aggregate("mask", F.lit(0), lambda acc, x: acc + x).alias("n_real"),
        total(ids).alias("id_sum"), total(placed).alias("order_sum"),
    )
