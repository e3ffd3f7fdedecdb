"""Projection, renaming and schema conformance. Everything here is decided on the driver without a job."""

from pyspark.sql import DataFrame, functions as F

from ..schemas import INDEX_COLUMNS


def quoted(name: str):
    """Column reference for any name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _require(df: DataFrame, names):
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing columns {missing}; the table has {df.columns}")


def rename_strict(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename columns; fail when a source column is missing."""
    _require(df, mapping)
    return df.withColumnsRenamed(mapping)


def rename(df: DataFrame, mapping: dict) -> DataFrame:
    """Rename the columns that exist."""
    return df.withColumnsRenamed(mapping)


def drop_strict(df: DataFrame, names) -> DataFrame:
    """Drop columns; fail when one is missing."""
    _require(df, names)
    return df.drop(*names)


def drop_existing(df: DataFrame, names) -> DataFrame:
    return df.drop(*names)


def index_first(df: DataFrame, others=None, drop_others: bool = False, index=INDEX_COLUMNS) -> DataFrame:
    """Index columns first, then ``others`` in the given order, then the rest unless dropped."""
    order = list(index) + [c for c in (others or []) if c not in index]
    if others is None or not drop_others:
        order += [c for c in df.columns if c not in order]
    _require(df, order)
    return df.select(*[quoted(c) for c in order])


def add_constants(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def add_missing(df: DataFrame, names, value: str = "") -> DataFrame:
    """Add optional columns the table lacks, filled with ``value``."""
    return df.withColumns({n: F.lit(value) for n in names if n not in df.columns})


def conform(df: DataFrame, expected, label: str) -> DataFrame:
    """Require exactly the expected set of columns and put them in order."""
    extra = [c for c in df.columns if c not in expected]
    missing = [c for c in expected if c not in df.columns]
    if extra or missing:
        raise ValueError(f"Columns of {label} do not match. Extra columns: {extra}. Missing columns: {missing}")
    return df.select(*[quoted(c) for c in expected])
