"""Column selection, recoding and encoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenframe.operators.position import with_position
from lumenframe.sources.scratch import materialize

MAX_CATEGORIES = 10_000


def _known(df: DataFrame, names: Sequence[str]) -> None:
    unknown = [n for n in names if n not in df.columns]
    if unknown:
        raise ValueError(f"no such column: {', '.join(unknown)}")


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    _known(df, names)
    return df.drop(*names)


def select_columns(df: DataFrame, *names: str) -> DataFrame:
    _known(df, names)
    return df.select(*names)


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def numeric_column(df: DataFrame, name: str) -> Column:
    _known(df, [name])
    if not isinstance(df.schema[name].dataType, T.NumericType):
        raise ValueError(f"{name} is not numeric")
    return F.col(name)


def recode(df: DataFrame, col: str, mapping: Mapping[str, str] | DataFrame, out: str) -> DataFrame:
    """Column ``out``: the value that ``mapping`` gives for ``col``, null where it has none.

    A dict becomes an expression; a table with columns (from, to) is left-joined, by broadcast when
    Spark finds it small enough.
    """
    _known(df, [col])
    if isinstance(mapping, DataFrame):
        lookup = mapping.select(F.col("from").alias(col), F.col("to").alias(out))
        return df.join(lookup, col, "left")
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return df.withColumn(out, F.try_element_at(pairs, F.col(col)))


def categories(df: DataFrame, col: str, limit: int = MAX_CATEGORIES) -> list:
    """The sorted distinct values other than null; an error if there are more than ``limit``."""
    rows = df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col).limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} values")
    return [r[0] for r in rows]


def label_codes(df: DataFrame, col: str) -> DataFrame:
    """Dictionary ``col, code``: sorted distinct values numbered from 0, of any size."""
    values = df.select(col).filter(F.col(col).isNotNull()).distinct()
    return with_position(values, [], [col], "code").select(col, (F.col("code") - 1).alias("code"))


def label_encode(df: DataFrame, col: str, out: str = "code") -> DataFrame:
    codes = materialize(label_codes(df, col), "codes")
    return df.join(codes.withColumnRenamed("code", out), col, "left")


def first_seen_codes(df: DataFrame, col: str, order: Sequence[str]) -> DataFrame:
    """Dictionary ``col, ord``: values numbered from 1 in the order of their first row."""
    first = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.min(F.struct(*order)).alias("_first"))
    flat = first.select(col, *[F.col(f"_first.{c}").alias(f"_o{i}") for i, c in enumerate(order)])
    return with_position(flat, [], [f"_o{i}" for i in range(len(order))], "ord").select(col, "ord")


def one_hot(df: DataFrame, col: str, values: Sequence | None = None, drop_first: bool = False) -> DataFrame:
    """One 0/1 double column ``col_value`` per sorted value in place of ``col``; null gives all zeros."""
    values = categories(df, col) if values is None else list(values)
    dummies = [
        F.when(F.col(col) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{col}_{v}")
        for v in values[1 if drop_first else 0 :]
    ]
    return df.select(*[c for c in df.columns if c != col], *dummies)


def features_and_target(df: DataFrame, target: str, keep: Sequence[str] = ()) -> DataFrame:
    """``label`` plus float features: string columns become dummies, a string target is encoded.

    Columns in ``keep`` pass through unchanged.
    """
    _known(df, [target, *keep])
    text = set(string_columns(df))
    if target in text:
        out = label_encode(df, target, "label").drop(target)
    else:
        out = df.withColumnRenamed(target, "label")
    for c in df.columns:
        if c == target or c in keep:
            continue
        out = one_hot(out, c) if c in text else out.withColumn(c, F.col(c).cast("double"))
    return out


def record_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Each named column with its default in place of null."""
    _known(df, list(defaults))
    return df.select(
        *[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c) for c in df.columns]
    )
