"""BPE encoding and decoding, equal to the tokenizer library's own for texts of any length.

A long text is cut into leaves that different tasks encode, at a space or line end where there is one, as no token crosses these.
Leaves of a stretch without any are joined in a tree. Two neighbouring encodings are then joined: a window around
the join is encoded anew and grows until it agrees with the left side on a run of tokens before the join and with the right
side on a run after it; in between the window's tokens hold. Pairs of joined parts are joined again. Where the
sides never agree the window ends as the whole text, so that the result is that of one call in any case.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField

from lumenframe.llm.common import add_columns, read_tokenizer

#: Code points of a leaf; longer texts are encoded leaf by leaf.
LEAF = 1 << 15
#: Code points on either side of a join in the first window.
WINDOW = 64
#: Tokens that a window must share with a side, at the same places.
AGREE = 4
#: Pieces between spaces whose ids a worker remembers; when full it starts afresh.
REMEMBERED = 1 << 17
#: Stops that may follow a word.
STOPS = ".,;:!?"
#: Bytes of text that a worker encodes at a time.
SLICE = 4 << 20


class Tokens:
    """Ids of a stretch of text and the code points each stands for."""

    def __init__(self, ids, starts, ends):
        self.ids, self.starts, self.ends = ids, starts, ends

    def part(self, a: int, b: int | None = None) -> Tokens:
        return Tokens(self.ids[a:b], self.starts[a:b], self.ends[a:b])

    def __len__(self) -> int:
        return len(self.ids)


def encode_span(tokenizer, text: str, a: int, b: int) -> Tokens:
    """The library's tokens of ``text[a:b]``, with places counted in ``text``."""
    made = tokenizer.encode(text[a:b], add_special_tokens=False)
    spans = np.array(made.offsets, np.int64).reshape(-1, 2) + a
    return Tokens(np.array(made.ids, np.uint32), spans[:, 0], spans[:, 1])


def _rows(t: Tokens) -> np.ndarray:
    return np.stack([t.ids.astype(np.int64), t.starts, t.ends], axis=1)


def _first_shared(side: np.ndarray, window: np.ndarray, agree: int) -> tuple[int, int] | None:
    """Least (place in window, place in side) at which both go on with ``agree`` equal tokens."""
    for w in range(len(window) - agree + 1):
        if w and window[w, 1] == window[w - 1, 1]:
            continue
        s = int(np.searchsorted(side[:, 1], window[w, 1]))
        if s + agree <= len(side) and np.array_equal(side[s : s + agree], window[w : w + agree]):
            return w, s
    return None


def _last_shared(side: np.ndarray, window: np.ndarray, agree: int) -> tuple[int, int] | None:
    """Greatest (place in window, place in side) of such a run, its first token."""
    for w in range(len(window) - agree, -1, -1):
        if w and window[w, 1] == window[w - 1, 1]:
            continue
        s = int(np.searchsorted(side[:, 1], window[w, 1]))
        if s + agree <= len(side) and np.array_equal(side[s : s + agree], window[w : w + agree]):
            return w, s
    return None


def join(tokenizer, text: str, left: Tokens, right: Tokens, a: int, m: int, b: int, size: int = WINDOW) -> Tokens:
    """The tokens of ``text[a:b]`` from those of ``text[a:m]`` and ``text[m:b]``."""
    while True:
        i = int(np.searchsorted(left.starts, m - size))
        j = int(np.searchsorted(right.ends, m + size))
        begin = int(left.starts[i]) if 0 < i < len(left) else max(a, m - size) if i else a
        end = int(right.ends[j]) if j < len(right) - 1 else b
        if m - size <= a:
            begin = a
        window = encode_span(tokenizer, text, begin, end)
        if begin == a and end == b:
            return window
        rows, head, tail = _rows(window), (0, 0), (len(window), len(right))
        if begin > a:
            near = max(0, i - 1)
            head = _first_shared(_rows(left.part(near)), rows, AGREE)
            head = head and (head[0], head[1] + near)
        if end < b:
            tail = _last_shared(_rows(right.part(0, j + 2)), rows, AGREE)
        if head and tail and head[0] + (AGREE if begin > a else 0) <= tail[0]:
            parts = [left.part(0, head[1]), window.part(head[0], tail[0]), right.part(tail[1])]
            return Tokens(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("ids", "starts", "ends")))
        size *= 2


def join_all(tokenizer, text: str, parts: list[Tokens], cuts: list[int]) -> Tokens:
    """Join neighbouring parts two by two until one is left; ``cuts`` are the ends of the parts from 0 on."""
    while len(parts) > 1:
        joined, ends = [], [cuts[0]]
        for k in range(0, len(parts) - 1, 2):
            joined.append(join(tokenizer, text, parts[k], parts[k + 1], cuts[k], cuts[k + 1], cuts[k + 2]))
            ends.append(cuts[k + 2])
        if len(parts) % 2:
            joined.append(parts[-1])
            ends.append(cuts[-1])
        parts, cuts = joined, ends
    return parts[0]


def _one_word(piece: str) -> bool:
    """Whether the tokenizer's rules, too, see letters only in the piece, and so one word."""
    return piece.isalpha() and (piece.isascii() or unicodedata.normalize("NFC", piece).lower().isalpha())


class Encoder:
    """Encodes texts piece by piece between spaces and line ends, where no token can cross; known pieces are looked up.

    A word and the stops after it are pieces of their own, too. Words not yet known are encoded in one call and told apart by
    their last tokens. Two generations of pieces are remembered: a full one replaces the one before, from which used pieces
    come back.
    """

    def __init__(self, path: str):
        self.tokenizer = read_tokenizer(path)
        strings = _strings(path)
        self.last = np.array([t.endswith("</w>") for t in strings])
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        pieces = [(t or "").replace("\n", " ").split(" ") for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        known = self.known
        stopped = {}
        missing = set()
        for p in set().union(*pieces).difference(known):
            if p and p[-1] in STOPS and _one_word(core := p.rstrip(STOPS)):
                stopped[p] = core
                missing.update((core, p[len(core) :]))
            else:
                missing.add(p)
        self.learn(missing.difference(known))
        for p, core in stopped.items():
            known[p] = known[core] + known[p[len(core) :]]
        return [b"".join(map(known.__getitem__, row)) for row in pieces]

    def learn(self, missing: set[str]) -> None:
        words, others = [], []
        for p in missing:
            ids = self.before.get(p)
            if ids is not None:
                self.known[p] = ids
            else:
                (words if _one_word(p) else others).append(p)
        for a in range(0, len(words), 4096):
            some = words[a : a + 4096]
            ids = np.array(self.tokenizer.encode(" ".join(some), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.last[ids]) + 1
            if len(cuts) == len(some):
                packed, cuts = ids.tobytes(), (cuts * 4).tolist()
                self.known.update(zip(some, map(packed.__getitem__, map(slice, [0, *cuts[:-1]], cuts)), strict=True))
            else:
                others.extend(some)
        for a in range(0, len(others), 4096):
            some = others[a : a + 4096]
            made = self.tokenizer.encode_batch_fast(some, add_special_tokens=False)
            self.known.update(zip(some, (np.array(e.ids, "<u4").tobytes() for e in made), strict=True))


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


@functools.lru_cache(maxsize=2)
def _strings(path: str) -> list[str]:
    tokenizer = read_tokenizer(path)
    return [tokenizer.id_to_token(i) or "" for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def encode(df: DataFrame, path: str, text: str = "text", out: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the column ``out``: the ids of each whole text as packed little-endian 32-bit numbers (null: none).

    With ``decoded``, that column has what :func:`decode` makes of the ids. Equal texts longer than a leaf are encoded once.
    Columns named as the results are replaced; rows repeat as they came.
    """
    fields = [StructField(out, BinaryType())] + [StructField(decoded, StringType())] * bool(decoded)

    def run(texts):
        ids = _encoder(path)(texts.to_pylist())
        return [pa.array(ids, pa.binary())] + [pa.array(decode_rows(path, ids), pa.string())] * bool(decoded)

    whole = F.coalesce(F.length(F.col(text)) <= LEAF, F.lit(True))
    short = add_columns(df.filter(whole), text, fields, run, SLICE)
    long = df.filter(~whole)
    keyed = long.withColumn("__key", F.sha2(F.col(text), 256))
    made = encode_long(keyed.select("__key", F.col(text).alias("__text")).dropDuplicates(["__key"]), path, bool(decoded))
    rest = [c for c in long.columns if c.lower() not in [f.name.lower() for f in fields]]
    own = [F.col("__ids").alias(out)] + [F.col("__decoded").alias(decoded or "")] * bool(decoded)
    return short.unionByName(keyed.join(made, "__key").select(*[F.col(f"`{c}`") for c in rest], *own))


def leaves_of(text: str, limit: int = LEAF) -> list[tuple[str, bool]]:
    """``text`` in leaves of at most ``limit`` code points, each with whether it goes on in the next without a space between."""
    out, a = [], 0
    while len(text) - a > limit:
        cut = max(text.rfind(" ", a + 1, a + limit), text.rfind("\n", a + 1, a + limit))
        out.append((text[a : cut if cut > 0 else a + limit], cut <= 0))
        a = cut if cut > 0 else a + limit
    return [*out, (text[a:], False)]


def encode_long(texts: DataFrame, path: str, decoded: bool) -> DataFrame:
    """(__key, __ids, __decoded) of long texts (__key, __text): leaves over all tasks, then one tree of joins for each unsplit run."""
    names = ["__key", "part", "text", "tied", "opens"]

    def cut(batches):
        for batch in batches:
            for key, text in zip(*(batch.column(c).to_pylist() for c in ("__key", "__text")), strict=True):
                made = leaves_of(text)
                tied = [t for _, t in made]
                columns = [[key] * len(made), list(range(len(made))), [t for t, _ in made], tied, [False, *tied[:-1]]]
                types = [pa.string(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    def leaf(batches):
        encoder, tokenizer = _encoder(path), read_tokenizer(path)
        for batch in batches:
            for key, part, text, tied, opens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                packed = ["", b"", b"", b""]
                if tied or opens:
                    t = encode_span(tokenizer, text, 0, len(text))
                    packed = [text, t.ids.astype("<u4").tobytes(), t.starts.astype("<i4").tobytes(), t.ends.astype("<i4").tobytes()]
                else:
                    packed[1] = encoder([text])[0]
                values = [key, part, tied, *packed]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=fields)

    def tree(table):
        rows = sorted(zip(*(table.column(c).to_pylist() for c in fields), strict=True), key=lambda r: r[1])
        run, texts, ids = [], [], []
        for _, _, tied, text, own, starts, ends in rows:
            run.append((own, starts, ends))
            texts.append(text)
            if not tied:
                ids.append(_joined(path, run, texts) if len(run) > 1 else own)
                run, texts = [], []
        ids = b"".join(ids)
        text = decode_rows(path, [ids])[0] if decoded else ""
        return pa.table({"__key": [rows[0][0]], "__ids": pa.array([ids], pa.binary()), "__decoded": [text]})

    fields = ["__key", "part", "tied", "text", "ids", "starts", "ends"]
    kinds = [pa.string(), pa.int32(), pa.bool_(), pa.string(), pa.binary(), pa.binary(), pa.binary()]
    leaves = texts.mapInArrow(cut, "__key string, part int, text string, tied boolean, opens boolean")
    leaves = leaves.repartition(F.col("__key"), F.col("part"))
    schema = "__key string, part int, tied boolean, text string, ids binary, starts binary, ends binary"
    made = leaves.mapInArrow(leaf, schema).groupBy("__key")
    return made.applyInArrow(tree, "__key string, __ids binary, __decoded string")


def _joined(path: str, run: list[tuple[bytes, bytes, bytes]], texts: list[str]) -> bytes:
    cuts = [0, *np.cumsum([len(t) for t in texts]).tolist()]
    parts = [
        Tokens(np.frombuffer(i, "<u4"), np.frombuffer(s, "<i4").astype(np.int64) + at, np.frombuffer(e, "<i4").astype(np.int64) + at)
        for (i, s, e), at in zip(run, cuts[:-1], strict=True)
    ]
    return join_all(read_tokenizer(path), "".join(texts), parts, cuts).ids.astype("<u4").tobytes()


def decode_rows(path: str, rows: list[bytes | None]) -> list[str]:
    """The library's decode of each row of packed ids: without a decoder the tokens with a space between."""
    lists = [np.frombuffer(x or b"", "<u4").tolist() for x in rows]
    tokenizer = read_tokenizer(path)
    if tokenizer.decoder is not None:
        return tokenizer.decode_batch(lists, skip_special_tokens=False)
    word = _strings(path).__getitem__
    return [" ".join(map(word, ids)) for ids in lists]


def decode(df: DataFrame, path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with the text that the library's decode gives for the packed ids, special tokens included (null: empty)."""
    fields = [StructField(out, StringType())]
    return add_columns(df, ids, fields, lambda a: [pa.array(decode_rows(path, a.to_pylist()), pa.string())], SLICE)


def digest(df: DataFrame) -> DataFrame:
    """Count and digests of the columns ids and decoded."""
    return df.select(
        "doc_id",
        F.expr("CAST(length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
