"""Language identification by a string kernel.

The kernel of two texts is the number of letter n-grams (n = 1 to 3, a blended spectrum) present in both, over the geometric mean of the
numbers present in each, as far as some landmark has them. Landmarks and fitting rows are bounded samples of each language; a
Nyström map from the kernels with the landmarks turns one-versus-rest kernel ridge regression into a linear fit. Whole texts of any length are scored in batches: presence
matrix times landmark matrix times coefficients.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from lumenframe.llm.common import add_columns
from lumenframe.sources.scratch import materialize

#: Bounds of the fit: landmarks in all, fitting rows of a language, and languages.
LANDMARKS, FIT_ROWS, LANGUAGES = 256, 384, 128
ORDERS = 3
#: Bits of a code point, so that an n-gram's number holds its letters whole, and what stands for all that is no letter.
BITS, GAP = 21, 1
RIDGE = 0.1
UNKNOWN = "und"
#: Cells of a presence matrix.
CELLS = 1 << 22
SLICE = 2 << 20


@functools.lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def codes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts' letters in lower case, GAP for what is no letter and around each text, and the text of each."""
    lower = [f" {t.lower()} " if t else "  " for t in texts]
    points = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(_is_letter()[points], points, GAP).astype(np.int64), np.repeat(np.arange(len(lower)), [len(t) for t in lower])


def grams(code: np.ndarray, text: np.ndarray):
    """(texts, n-gram numbers) for each order; the number of an n-gram is its code points one after another, so no two share one."""
    at, blank = code, 0
    for n in range(1, ORDERS + 1):
        if n > 1:
            at = at[:-1] << BITS | code[n - 1 :]
        blank = blank << BITS | GAP
        first = text[: len(at)]
        inside = (first == text[n - 1 :]) & (at != blank)
        yield first[inside], at[inside]


def gram_set(text: str | None) -> np.ndarray:
    return np.unique(np.concatenate([numbers for _, numbers in grams(*codes([text]))]))


class Kernel:
    """Normalised kernels of texts with the landmarks."""

    def __init__(self, sets: list[np.ndarray]):
        self.vocabulary = np.unique(np.concatenate(sets)) if sets else np.zeros(0, np.int64)
        self.marks = np.zeros((len(sets), len(self.vocabulary)), np.float32)
        for i, s in enumerate(sets):
            self.marks[i, np.searchsorted(self.vocabulary, s)] = 1 / np.sqrt(len(s)) if len(s) else 0

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Kernels (texts by landmarks), and which texts have a letter."""
        out, lettered = np.zeros((len(texts), len(self.marks)), np.float32), np.zeros(len(texts), bool)
        step = max(1, CELLS // max(1, len(self.vocabulary)))
        for a in range(0, len(texts), step):
            some = texts[a : a + step]
            code, text = codes(some)
            lettered[a + np.unique(text[code > GAP])] = True
            present = np.zeros((len(some), len(self.vocabulary)), np.float32)
            for rows, numbers in grams(code, text):
                at = np.searchsorted(self.vocabulary[:-1], numbers)
                known = self.vocabulary[at] == numbers
                present[rows[known], at[known]] = 1
            size = np.sqrt(np.maximum(1, present.sum(axis=1, keepdims=True)))
            out[a : a + step] = (present @ self.marks.T) / size
        return out, lettered


def sample(rows: DataFrame, per_language: int) -> DataFrame:
    """At most so many rows (id, lang) of each language, those with the least hash of the id."""
    order = F.xxhash64("id")
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(order, "id")))
    return ranked.filter(F.col("n") <= per_language)


def fit(train: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id"):
    """(languages, Kernel, coefficients) from bounded samples of ``train``; None if no row has a language.

    Reads the samples' whole texts. Raises if there are more than LANGUAGES languages.
    """
    rows = train.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull())
    picked = materialize(sample(rows.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang")), FIT_ROWS), "language-sample")
    languages = sorted(r.lang for r in picked.select("lang").distinct().limit(LANGUAGES + 1).collect())
    if not languages:
        return None
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    per_language = max(2, LANDMARKS // len(languages))
    small = F.broadcast(picked.select(F.col("id").alias("__id"), F.col("lang").alias("__lang"), "n"))
    texts = rows.join(small, (F.col(doc_id) == F.col("__id")) & (F.col(lang) == F.col("__lang")))
    texts = materialize(texts.select(F.col(text).alias("text"), F.col(lang).alias("lang"), "n").repartition(8, "n"), "language-texts")
    marked = texts.filter(F.col("n") <= per_language)

    def marks(batches):
        for pdf in batches:
            for language, t in zip(pdf["lang"], pdf["text"], strict=True):
                yield pd.DataFrame({"lang": [language], "grams": [gram_set(t).astype("<i8").tobytes()]})

    found = marked.mapInPandas(marks, "lang string, grams binary").distinct().collect()
    sets = [np.frombuffer(r.grams, "<i8") for r in sorted(found, key=lambda r: (r.lang, bytes(r.grams))) if r.grams]
    if not sets:
        return None
    shared = train.sparkSession.sparkContext.broadcast(sets)

    def sums(batches):
        kernel = Kernel(shared.value)
        m, c = len(kernel.marks), len(languages)
        square, cross = np.zeros((m, m)), np.zeros((m, c))
        for pdf in batches:
            k = kernel(pdf["text"].tolist())[0].astype(np.float64)
            goal = np.where(pdf["lang"].to_numpy()[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
            square += k.T @ k
            cross += k.T @ goal
        yield pd.DataFrame({"square": [square.tobytes()], "cross": [cross.tobytes()]})

    parts = texts.coalesce(8).mapInPandas(sums, "square binary, cross binary").collect()
    kernel = Kernel(sets)
    m = len(sets)
    square = sum(np.frombuffer(p.square).reshape(m, m) for p in parts)
    cross = sum(np.frombuffer(p.cross).reshape(m, -1) for p in parts)
    values, vectors = np.linalg.eigh(kernel.marks.astype(np.float64) @ kernel.marks.T.astype(np.float64))
    root = (vectors / np.sqrt(np.maximum(values, 1e-6))) @ vectors.T
    weights = np.linalg.solve(root @ square @ root + RIDGE * np.eye(m), root @ cross)
    return languages, sets, (root @ weights).astype(np.float64)


@functools.lru_cache(maxsize=1)
def _kernel(key):
    return Kernel(key.value)


def predict(df: DataFrame, model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score (0 to 1); without a letter, or a model, UNKNOWN with 0. Columns of these names are replaced."""
    outs = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    if model is None:
        kept = [c for c in df.columns if c.lower() not in ("lang_pred", "score")]
        return df.select(*kept, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    languages, parts, alpha = model
    shared = df.sparkSession.sparkContext.broadcast(parts)

    def run(texts):
        k, lettered = _kernel(shared)(texts.to_pylist())
        values = k.astype(np.float64) @ alpha
        best = values.argmax(axis=1)
        score = np.clip((1 + values[np.arange(len(best)), best]) / 2, 0, 1)
        names = np.where(lettered, np.array(languages, object)[best], UNKNOWN)
        return [pa.array(names, pa.string()), pa.array(np.where(lettered, score, 0.0))]

    return add_columns(df, text, outs, run, SLICE)


def held_out(doc_id: str = "doc_id"):
    """Whether crc32 of the id as text leaves 2 when divided by 4; a null id isn't held out, and isn't learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))
