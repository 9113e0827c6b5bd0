"""What several operators of this subpackage share: Arrow passes over whole rows and vectorised words."""

from __future__ import annotations

import functools
import gc
import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 8 << 20
#: Bytes from which a word is hashed on its own.
LONG_WORD = 64


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose text comes to about ``limit`` bytes; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


def add_columns(
    df: DataFrame, column: str, outs: list[StructField], fn: Callable[[pa.Array], list[pa.Array]], limit: int = SLICE_BYTES
) -> DataFrame:
    """``df`` with the columns ``outs`` that ``fn`` makes of ``column``, batch by batch; columns of those names are replaced."""
    names = {f.name.lower() for f in outs}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    schema = StructType([*kept, *outs])
    source = column

    def run(batches):
        for batch in batches:
            for part in slices(batch, "__in", limit):
                made = fn(part.column("__in"))
                own = [part.column(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*own, *made], names=[f.name for f in schema.fields])

    return df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(f"`{source}`").alias("__in")).mapInArrow(run, schema)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another and the offsets of each; null counts as empty."""
    filled = texts.fill_null("" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    wide = filled.cast(pa.large_string() if not pa.types.is_binary(filled.type) else pa.large_binary())
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if not len(at):
        at = np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ (x >> np.uint64(29))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word (bytes other than space and 0x09 to 0x0D) and the count of words before each text."""
    inside = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = at[1:-1]
    edges = edges[edges < len(raw)]
    first[edges] = inside[edges]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cut = edges[edges > 0] - 1
    last[cut] = inside[cut]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, at)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each word from its bytes and length alone, the same wherever the word stands."""
    rng = np.random.default_rng(seed)
    odd = np.uint64(int(rng.integers(1 << 62)) * 2 + 1)
    table = mix(rng.integers(1, 1 << 63, 256, dtype=np.uint64))
    sizes = ends - starts
    out = mix(sizes.astype(np.uint64) + np.uint64(seed))
    long = np.flatnonzero(sizes > LONG_WORD)
    for i in long:
        digest = hashlib.blake2b(raw[starts[i] : ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little"))
        out[i] = np.uint64(int.from_bytes(digest.digest(), "little"))
    alive = np.flatnonzero(sizes <= LONG_WORD)
    at = starts[alive]
    with np.errstate(over="ignore"):
        while len(alive):
            x = out[alive] * odd + table[raw[at]]
            out[alive] = x ^ (x >> np.uint64(32))
            at = at + 1
            more = at < ends[alive]
            alive, at = alive[more], at[more]
    return mix(out)


def tidy(spark) -> None:
    """Let Spark delete shuffle files of finished jobs now; it otherwise waits until the driver happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@functools.lru_cache(maxsize=2)
def read_tokenizer(path: str):
    """The tokenizer in a file of every machine's Python environment, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer
