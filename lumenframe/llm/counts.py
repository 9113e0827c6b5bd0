"""Exact token counts of every prefix of a text, for byte-level BPE files.

The encoding of a prefix is that of a shorter prefix and one more token. Which token is last is decided from left to right: of
the tokens that end at a place, one alone stands beside the last token of the prefix before it, which means that BPE keeps
the border between the two. So one pass over the text gives the count at each place, and no prefix is encoded by itself. The
pre-tokenizer's pieces are counted one by one; known stretches between spaces are looked up. Budget and truncation
questions are then answered from the stored counts.
"""

from __future__ import annotations

import functools
import itertools
import json
import operator
import re
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from lumenframe.llm.common import add_columns, read_tokenizer

#: Stretches whose counts a worker remembers; two generations are kept, so that common ones stay.
REMEMBERED = 1 << 17
#: Pairs of tokens whose border a worker remembers before it starts afresh.
BORDERS = 1 << 18
#: Code points up to which a stretch is remembered.
SHORT = 48
#: Bytes of text that a worker counts at a time; the counts take four times as much.
SLICE = 4 << 20
#: White space as the pre-tokenizer's pattern sees it, and letters that every Unicode version knows.
WHITE = "\t-\r \x85\xa0  -     　"
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
#: Endings that the pre-tokenizer keeps together though their own prefixes fall into two pieces.
SPLIT_ENDINGS = ("'re", "'ve", "'ll")

# stretches that begin where a piece of the pre-tokenizer does, whatever stands before them
STRETCH = re.compile(f" ?[{LETTERS}]+(?=[\0-@[-`{{-\x7f]|$)| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
WORD = re.compile(f" ?[{LETTERS}]+")
WHITE_RUN = re.compile(f"[{WHITE}]{{2,}}(?=[^{WHITE}])")


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the code points from 256 on in turn."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = itertools.count(256)
    return [chr(b if b in own else next(spare)) for b in range(256)]


class Prefixes:
    """Counts of a worker: the merge table of a file, the automaton of its tokens and remembered stretches."""

    def __init__(self, path: str):
        import ahocorasick

        tokenizer = read_tokenizer(path)
        spec = json.loads(tokenizer.to_str())
        _check(spec, path)
        self.split = tokenizer.pre_tokenizer.pre_tokenize_str
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.pattern = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)")
        ids = spec["model"]["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.birth: dict[int, int] = {}
        for at, (a, b) in enumerate(spec["model"]["merges"]):
            made = ids[a + b]
            self.rank[ids[a], ids[b]] = at
            self.birth.setdefault(made, at)
            self.parts.setdefault(made, (ids[a], ids[b]))
        letters = byte_letters()
        self.tokens = ahocorasick.Automaton()
        for word, i in ids.items():
            if all(c in letters for c in word) and (len(word) == 1 or i in self.parts and self.stands(*self.parts[i], self.birth[i])):
                self.tokens.add_word(word, (i, len(word)))
        self.tokens.make_automaton()
        self.letters = "".join(letters)
        self.borders: dict[tuple[int, int], bool] = {}
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def stands(self, a: int, b: int, limit: int | None = None) -> bool:
        """Whether BPE keeps the border between the tokens ``a`` and ``b``, looking at merges of a rank below ``limit``.

        Undoes the later of the two sides' merges step by step; at each step the tokens that then faced each other must not
        merge earlier than the undone merge. Of two places with the same rank the left one goes first.
        """
        limit = len(self.rank) if limit is None else limit
        while True:
            if self.rank.get((a, b), limit) < limit:
                return False
            left, right = self.birth.get(a, -1), self.birth.get(b, -1)
            if left < 0 and right < 0:
                return True
            if left > right:
                limit, a = left, self.parts[a][1]
            else:
                limit, b = right + 1, self.parts[b][0]

    def piece(self, letters: str) -> list[int]:
        """Token counts of a piece's prefixes of 0, 1, 2, ... bytes; ``letters`` has one letter for each byte."""
        counts, last, borders = [0] * (len(letters) + 1), [-1] * (len(letters) + 1), self.borders
        for end, (token, size) in self.tokens.iter(letters):
            end += 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                pair = last[start], token
                kept = borders.get(pair)
                if kept is None:
                    kept = borders[pair] = self.stands(*pair)
                if not kept:
                    continue
            last[end] = token
            counts[end] = counts[start] + 1
        return counts

    def pieces(self, stretch: str) -> list[tuple[str, tuple[int, int]]]:
        """The pre-tokenizer's pieces; a stretch of letters is one, which needs no call."""
        if WORD.fullmatch(stretch):
            return [(stretch.encode().decode("latin-1").translate(self.letters), (0, len(stretch)))]
        return self.split(stretch)

    def steps(self, stretch: str) -> bytes:
        """By how much the count changes with each code point of a stretch, as packed 32-bit numbers."""
        counts = [0]
        for letters, (a, b) in self.pieces(stretch):
            base, made = counts[-1], self.piece(letters)
            if len(letters) > b - a:
                made = [made[k] for k in itertools.accumulate((len(c.encode()) for c in stretch[a:b]), initial=0)]
            if stretch[a:b] in SPLIT_ENDINGS:
                made[2] = made[1] + 1
            counts += [base + n for n in made[1:]]
        return array("i", map(operator.sub, counts[1:], counts)).tobytes()

    def learn(self, stretches: set[str]) -> dict[str, bytes]:
        """Steps of stretches not yet known; long ones are not remembered."""
        long = {}
        if len(self.borders) > BORDERS:
            self.borders.clear()
        for s in stretches:
            steps = self.before.get(s) or self.steps(s)
            (self.known if len(s) <= SHORT else long)[s] = steps
        return long

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        """Counts at each code point of texts in which added tokens are ordinary text."""
        cut = [STRETCH.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        long = self.learn(set().union(*cut).difference(self.known))
        get = self.known.__getitem__ if not long else lambda s: long.get(s) or self.known[s]
        out = []
        for text, row in zip(texts, cut, strict=True):
            counts = np.cumsum(np.frombuffer(b"".join(map(get, row)), np.int32), dtype=np.int32)
            for m in WHITE_RUN.finditer(text):  # a prefix that ends with the run keeps it in one piece
                a, b = m.span()
                run = self.split(m[0])
                counts[b - 1] = (counts[a - 1] if a else 0) + sum(self.piece(p)[-1] for p, _ in run)
            out.append(counts)
        return out

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """The count of tokens of each text's first 1, 2, ... code points; the last one is that of the whole text."""
        texts = [t or "" for t in texts]
        made = self.plain([t for t in texts if not self.pattern.search(t)])
        plain = iter(made)
        return [self.marked(t) if self.pattern.search(t) else next(plain) for t in texts]

    def marked(self, text: str) -> np.ndarray:
        """Counts of a text with added tokens: a prefix that ends inside one sees its letters as ordinary text."""
        out, base, a = [], 0, 0
        for m in self.pattern.finditer(text):
            counts = base + self.plain([text[a : m.end()]])[0]
            before = counts[m.start() - a - 1] if m.start() > a else base
            counts[-1] = base = int(before) + 1
            out.append(counts)
            a = m.end()
        return np.concatenate([*out, base + self.plain([text[a:]])[0]]).astype(np.int32)


def _check(spec: dict, path: str) -> None:
    """Refuse files whose tokens do not follow from bytes, merges and the usual pieces alone."""
    model, pieces = spec["model"], spec["pre_tokenizer"] or {}
    plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
    level = pieces.get("type") == "ByteLevel" and pieces.get("use_regex", True) and not pieces.get("add_prefix_space")
    added = [t["content"] for t in spec["added_tokens"]]
    alone = not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip"))
    nested = any(a != b and a in b for a in added for b in added)
    if not (plain and level and alone) or spec["normalizer"] or nested:
        raise ValueError(f"{path}: prefix counts need a byte-level BPE file without normalizer")


@functools.lru_cache(maxsize=2)
def _prefixes(path: str) -> Prefixes:
    return Prefixes(path)


def add_counts(df: DataFrame, path: str, text: str = "text", out: str = "prefix_tokens") -> DataFrame:
    """``df`` with the column ``out``: the token count of each prefix of 1, 2, ... code points of the whole text.

    Counts are packed as big-endian 32-bit numbers, equal to what the library of the file at ``path`` gives for the prefix as a
    text of its own, without special tokens around it. A null or empty text has no counts. A column named as the result is
    replaced; rows repeat as they came. A row's counts stay in one row and take four bytes a code point.
    """

    def run(texts):
        made = _prefixes(path)(texts.to_pylist())
        return [pa.array([c.astype(">u4").tobytes() for c in made], pa.binary())]

    return add_columns(df, text, [StructField(out, BinaryType())], run, SLICE)


def tokens_of_first(counts: Column, places: Column) -> Column:
    """How many tokens the first ``places`` code points make (more than there are: all of them; none or fewer: 0)."""
    at = F.least(places, F.length(counts) / 4).cast("int")
    packed = F.substring(counts, F.when(at > 0, at * 4 - 3).otherwise(1), F.lit(4))
    return F.when(at > 0, F.conv(F.hex(packed), 16, 10).cast("long")).otherwise(F.lit(0).cast("long"))


def total_tokens(counts: Column) -> Column:
    """The tokens of the whole text."""
    return tokens_of_first(counts, (F.length(counts) / 4).cast("int"))


def longest_prefix(df: DataFrame, budget: int, counts: str = "prefix_tokens", out: str = "n_fit") -> DataFrame:
    """``df`` with the most code points from the start that ``budget`` tokens hold. A longer prefix may have fewer tokens than a shorter one."""

    def fit(packed: bytes | None) -> int:
        within = np.flatnonzero(np.frombuffer(packed or b"", ">u4") <= budget)
        return int(within[-1]) + 1 if len(within) else 0

    return add_columns(df, counts, [StructField(out, LongType())], lambda a: [pa.array(map(fit, a.to_pylist()), pa.int64())])


def truncate(df: DataFrame, budget: int, text: str = "text", counts: str = "prefix_tokens") -> DataFrame:
    """``df`` with each text cut to its longest prefix of at most ``budget`` tokens, read from the stored counts."""
    cut = longest_prefix(df, budget, counts, "__fit")
    return cut.withColumn(text, F.substring(F.col(text), F.lit(1), F.col("__fit").cast("int"))).select(*df.columns)


def digest(df: DataFrame, limit: int = 1024) -> DataFrame:
    """Bytes and tokens of each document, and whether the tokens pass ``limit``."""
    tokens = total_tokens(F.col("prefix_tokens"))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return df.select("doc_id", size.alias("n_bytes"), tokens.alias("n_tokens"), (tokens > limit).alias("over_limit"))
