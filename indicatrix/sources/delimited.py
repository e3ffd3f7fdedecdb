"""Delimited files: plain tables and sheets whose header is not on the first line."""

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import header_name
from ..operators.columns import quoted


def _check_extension(path: str):
    extension = os.path.splitext(path)[1][1:].lower()
    if extension in ("xlsx", "xls"):
        raise ValueError("Spreadsheet files are not read directly; save the sheet as CSV first")
    if extension != "csv":
        raise ValueError(f"Unknown file extension {extension!r}; the file must be CSV")


def read_table(spark: SparkSession, path: str, schema=None, infer: bool = False) -> DataFrame:
    """CSV with a header line. Without a schema every column is text; ``infer`` reads the file once more for types."""
    _check_extension(path)
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    df = (reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)).csv(path)
    return df if schema is not None else df.toDF(*[c.replace("\ufeff", "") for c in df.columns])


def read_sheet(spark: SparkSession, path: str, header_line: int, first_line: int, first_column: int = 0,
               last_column: int = None, numbered: bool = False) -> DataFrame:
    """CSV with a buried header: lines are counted from 0 and lines before ``first_line`` are dropped.

    Line order is only defined inside one file, so exactly one file is accepted. Sheets of this kind are written by
    hand; one file is one task.
    """
    _check_extension(path)
    raw = spark.read.option("header", False).option("multiLine", True).option("escape", '"').csv(path)
    if len(raw.inputFiles()) != 1:
        raise ValueError("A sheet with a buried header must be a single file")
    columns = raw.columns[first_column:last_column]
    lines = raw.withColumn("__line", F.monotonically_increasing_id())
    header = lines.where(F.col("__line") == header_line).select(*columns).first()
    if header is None:
        raise ValueError(f"The sheet has no line {header_line}")
    names = [header_name(h, numbered) if h is not None else f"unnamed_{i}" for i, h in enumerate(header)]
    data = lines.where(F.col("__line") >= first_line).select(*[quoted(c) for c in columns])
    return data.toDF(*names)
