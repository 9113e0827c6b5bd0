"""Delimited text: scan with a given schema, sink with a header, sheet of valid records."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str, separator: str = ",", multi_line: bool = False
) -> DataFrame:
    """Text with a header row. Files are split unless fields may hold line breaks (``multi_line``)."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", separator)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def write_delimited(df: DataFrame, path: str, separator: str = ",") -> None:
    (
        df.write.option("header", True)
        .option("sep", separator)
        .option("quote", '"')
        .option("escape", '"')
        .option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_sheet(
    df: DataFrame, path: str, titles: Mapping[str, str], valid: Column | None = None, separator: str = ","
) -> None:
    """Valid rows only, the columns of ``titles`` in that order under their titles."""
    rows = df if valid is None else df.filter(valid)
    write_delimited(rows.select(*[F.col(c).alias(t) for c, t in titles.items()]), path, separator)
