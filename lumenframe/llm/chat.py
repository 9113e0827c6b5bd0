"""Chat formatting by columnar byte assembly.

Every turn becomes one segment ``<|turn|>role\\ntext<|end|>\\n``; a formatted conversation is its segments in order. Segments of a
whole batch are laid out at once: lengths, cumulative offsets and scatter indices in numpy, and all headers and texts copied into
one preallocated Arrow buffer. Turns are formatted where they lie; only reading back brings a conversation together, as a
stream in turn order that holds one segment at a time, so that a conversation of any length fits.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenframe.llm.common import slices, text_bytes

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
#: What may not stand in a role or a text as it is: the own marks and those of other common templates.
CONTROL = r"(\||/?s>|/?INST\]|/?SYS>)"
ESCAPE, ESCAPED = rf"([<\[])(\\*){CONTROL}", re.compile(rf"([<\[])\\(\\*){CONTROL}")
LEARNED = "assistant"


def escape(texts: pa.Array) -> pa.Array:
    """One backslash more between the opening sign of each control string and its rest."""
    return pc.replace_substring_regex(texts, ESCAPE, r"\1\\\2\3")


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2\3", text) if "\\" in text else text


def escape_role(roles: pa.Array) -> pa.Array:
    """Roles on one line: backslashes doubled and line ends as ``\\n`` first, then as texts."""
    return escape(pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role)) if "\\" in role else role


def assemble(rows: int, parts: list[bytes | tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """One buffer with the parts of each row one after another; its row offsets, and where each part of each row starts.

    A part is the same bytes for all rows, or the bytes of all rows with their offsets.
    """
    sizes = np.stack([np.full(rows, len(p)) if isinstance(p, bytes) else np.diff(p[1]) for p in parts], axis=1).astype(np.int64)
    ends = np.cumsum(sizes.ravel()).reshape(rows, len(parts))
    begins = ends - sizes
    out = np.empty(int(ends[-1, -1]) if rows else 0, np.uint8)
    for k, p in enumerate(parts):
        if isinstance(p, bytes):
            out[begins[:, k, None] + np.arange(len(p))] = np.frombuffer(p, np.uint8)
        else:
            raw, at = p
            out[np.arange(len(raw)) + np.repeat(begins[:, k] - at[:-1], sizes[:, k])] = raw
    return out, np.concatenate([[0], ends[:, -1]]) if rows else np.zeros(1, np.int64), list(begins.T)


def format_turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, segment, loss_start, loss_end) of each row; the bytes from loss_start to loss_end are learned.

    Null roles and texts count as empty. Only assistants' texts are learned; elsewhere both bounds are equal. Other columns are
    left out, so that none can clash; repeated rows give repeated segments.
    """
    picked = df.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).alias("text")
    )
    types = {f.name: f.dataType.simpleString() for f in picked.schema.fields}

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                roles, texts = part.column("role").fill_null(""), part.column("text").fill_null("")
                pieces = [OPEN.encode(), text_bytes(escape_role(roles)), b"\n", text_bytes(escape(texts)), CLOSE.encode()]
                out, at, begins = assemble(len(part), pieces)
                segment = pa.Array.from_buffers(
                    pa.string(), len(part), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(out)]
                )
                learned = pc.equal(roles, LEARNED).to_numpy(zero_copy_only=False)
                first = begins[3] - at[:-1]
                last = np.where(learned, begins[4] - at[:-1], first)
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv"), part.column("turn"), segment, pa.array(first), pa.array(last)],
                    names=["conv", "turn", "segment", "loss_start", "loss_end"],
                )

    schema = f"conv {types['conv']}, turn {types['turn']}, segment string, loss_start long, loss_end long"
    return picked.mapInArrow(run, schema)


def read_segment(segment: str) -> tuple[str, str]:
    """Role and text of a segment."""
    line = segment.index("\n")
    end = segment.index(CLOSE, line)
    if not segment.startswith(OPEN) or end + len(CLOSE) != len(segment):
        raise ValueError("not a segment")
    return unescape_role(segment[len(OPEN) : line]), unescape(segment[line + 1 : end])


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, segment: str, a: int, b: int) -> None:
        role, text = read_segment(segment)
        self.turns.update(f"{role}\n{text}\n".encode())
        self.n_turns += 1
        self.chars += len(segment)
        if b > a:
            learned = unescape(segment.encode()[a:b].decode())
            self.loss.update(learned.encode())
            self.loss_chars += len(learned)

    def row(self):
        return [self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars]


def read_back(segments: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, read from its formatted segments as a stream in order of turn.

    Equal turns come in order of their segments. Null is a conversation of its own; a null turn comes first.
    """
    kind = dict(segments.dtypes)["conv"]
    ordered = segments.repartition("conv").sortWithinPartitions("conv", "turn", "segment")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        open_one, now = None, None
        for batch in batches:
            done = []
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv", "segment", "loss_start", "loss_end")), strict=True)
            for conv, segment, a, b in rows:
                if open_one is None or conv != now:
                    if open_one is not None:
                        done.append([now, *open_one.row()])
                    open_one, now = _Digest(), conv
                open_one.add(segment, a, b)
            if done:
                yield _batch(done, names, batch.schema.field("conv").type, types)
        if open_one is not None:
            yield _batch([[now, *open_one.row()]], names, batch.schema.field("conv").type, types)

    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return ordered.select("conv", "segment", "loss_start", "loss_end").mapInArrow(run, schema)


def _batch(rows, names, first, types):
    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [first, *types], strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=names)
