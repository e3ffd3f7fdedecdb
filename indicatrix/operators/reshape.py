"""Wide, nested and transposed inputs to rows."""

import re
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.values import as_text
from .columns import quoted, rename_strict


def melt(df: DataFrame, ids, measures=None, variable: str = "indicator", value: str = "value") -> DataFrame:
    """Wide to long. Measures become text, so that columns of different types can share the value column."""
    measures = list(measures) if measures is not None else [c for c in df.columns if c not in ids]
    texts = df.select(*[quoted(c) for c in ids], *[as_text(quoted(c), df.schema[c].dataType).alias(c) for c in measures])
    return texts.unpivot([quoted(c) for c in ids], [quoted(c) for c in measures], variable, value)


def transpose(df: DataFrame, label: str, columns=None, rows=None, column_name: str = "column") -> DataFrame:
    """Rows become columns: one output row per input column, one output column per label.

    ``rows`` names the labels to keep and fixes the schema. Without it the distinct labels, which become columns, are
    read to the driver first; ``transpose_long`` gives the same cells as rows, whatever their number.
    """
    columns = list(columns) if columns is not None else [c for c in df.columns if c != label]
    if rows is None:
        rows = sorted(r[0] for r in df.where(quoted(label).isNotNull()).select(quoted(label)).distinct().collect())
    long = melt(df, [label], columns, column_name, "__value")
    return long.groupBy(column_name).pivot(label, rows).agg(F.first("__value", ignorenulls=True))


def transpose_long(df: DataFrame, label: str, columns=None, column_name: str = "column", value: str = "value") -> DataFrame:
    """The cells of the transposed table as rows: (column, label, value), the first non-null value of repeated labels."""
    long = melt(df.where(quoted(label).isNotNull()), [label], columns, column_name, value)
    return long.groupBy(quoted(column_name), quoted(label)).agg(F.first(value, ignorenulls=True).alias(value))


def transpose_map(df: DataFrame, label: str, columns=None, column_name: str = "column", into: str = "cells") -> DataFrame:
    """The transposed table with its labels as data: one row per input column, holding a map of label to value.

    Nothing is read beforehand, whatever the labels; null labels and values have no entry, of a repeated label the first value
    stays.
    """
    # Nulls are left out of the lists and not by filters, which Spark would push down into every column of the sheet.
    cells = melt(df, [label], columns, column_name).groupBy(quoted(column_name), quoted(label)).agg(
        F.first("value", ignorenulls=True).alias("value"))
    entries = F.collect_list(F.struct(quoted(label).alias("key"), "value"))
    whole = F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull())
    return cells.groupBy(quoted(column_name)).agg(F.map_from_entries(whole).alias(into))


def struct_leaves(schema: T.StructType, prefix=()):
    """Paths of all non-struct fields, depth first."""
    for field in schema:
        if isinstance(field.dataType, T.StructType):
            yield from struct_leaves(field.dataType, prefix + (field.name,))
        else:
            yield prefix + (field.name,)


def expand_struct(df: DataFrame, columns, drop=False, sep: str = ".") -> DataFrame:
    """Append ``column.key`` (and ``column.key.sub``) columns for the fields of struct columns."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    drops = drop if isinstance(drop, list) else [drop] * len(columns)
    added, dropped = {}, []
    for column, drop_column in zip(columns, drops):
        for path in struct_leaves(df.schema[column].dataType):
            leaf = quoted(column)
            for name in path:
                leaf = leaf[name]
            added[sep.join((column, *path))] = leaf
        if drop_column:
            dropped.append(column)
    return df.withColumns(added).drop(*dropped)


def _up_to(word: str) -> str:
    """Pattern of the text up to the next whole word outside strings; quoted strings are consumed whole."""
    strings = r"""'[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+\""""
    return rf"""(?s)\G((?:{strings}|[^'"{word[0]}]++|{word[0]}(?!{word[1:]}\b))*+){word}\b"""


def with_json_text(df: DataFrame, column: str) -> DataFrame:
    """Python's printed dictionaries to JSON text: None, True and False outside strings, and the escape JSON lacks.

    What strings hold stays as it is. Each step is a column of its own, so that it is computed once.
    """
    steps = {r"\x": (r"\G((?:[^\\]++|\\[^x])*+)\\x([0-9a-fA-F]{2})", r"$1\\u00$2"),
             **{word: (_up_to(word), f"$1{new}") for word, new in (("None", "null"), ("True", "true"), ("False", "false"))}}
    for part, (pattern, new) in steps.items():
        text = quoted(column)
        df = df.withColumn(column, F.when(F.contains(text, F.lit(part)), F.regexp_replace(text, pattern, new)).otherwise(text))
    return df


def _ddl(found: str) -> str:
    """The DDL of a schema found in variants: objects as structs, decimals as doubles, and text for what is null throughout, an
    object without keys, or of different types in different rows."""
    tokens = r"`(?:[^`]|``)*`|OBJECT<>|OBJECT<|DECIMAL\(\d+,\s*-?\d+\)|\b(?:VARIANT|VOID)\b(?!:)"
    new = {"OBJECT<>": "STRING", "OBJECT<": "STRUCT<", "VARIANT": "STRING", "VOID": "STRING"}
    return re.sub(tokens, lambda m: m[0] if m[0][0] == "`" else new.get(m[0], "DOUBLE"), found)


def discover_dicts(df: DataFrame, columns, text: str = "json") -> dict:
    """The keys that dictionary-text columns hold, as a struct type per column, their names sorted.

    One job merges the rows' schemas where the rows are and returns one row, whose size follows the different keys only. Keys that
    some rows lack, nested dictionaries and null texts are all right; a text that is no dictionary raises.
    """
    columns = list(columns)
    if text == "python":
        for column in columns:
            df = with_json_text(df, column)
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": str(text == "python").lower(), "mode": "FAILFAST"}
    found = df.agg(*[F.schema_of_variant_agg(F.from_json(quoted(c), "variant", options)).alias(str(i))
                     for i, c in enumerate(columns)]).first()
    kinds = {}
    for i, column in enumerate(columns):
        if found[i] in ("VOID", "OBJECT<>"):
            kinds[column] = T.StructType([])
        elif found[i].startswith("OBJECT<"):
            kinds[column] = T.DataType.fromDDL(_ddl(found[i]))
        else:
            raise ValueError(f"Column {column} holds other values than dictionaries: {found[i]}")
    return kinds


def parse_dict(df: DataFrame, column: str, schema, text: str = "json", errors: str = "raise") -> DataFrame:
    """Dictionary text to a struct. ``text='python'`` reads the printed form of a Python dictionary.

    Text that cannot be parsed raises, or with ``errors='null'`` gives null.
    """
    if text not in ("json", "python"):
        raise ValueError(f"text must be 'json' or 'python', not {text!r}")
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if text == "python":
        df = with_json_text(df, column)
    options = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": str(text == "python").lower()}
    if errors == "raise":
        return df.withColumn(column, F.from_json(quoted(column), schema, {**options, "mode": "FAILFAST"}))
    checked = T.StructType(schema.fields + [T.StructField("__bad", T.StringType())])
    parsed = F.from_json(quoted(column), checked, {**options, "columnNameOfCorruptRecord": "__bad"})
    df = df.withColumn(column, parsed)
    fields = F.struct(*[quoted(column)[f.name].alias(f.name) for f in schema])
    return df.withColumn(column, F.when(quoted(column).isNotNull() & quoted(column)["__bad"].isNull(), fields))


def expand_dict_columns(df: DataFrame, schemas: dict, drop=False, text: str = "json", sep: str = ".",
                        errors: str = "raise") -> DataFrame:
    """Parse dictionary-text columns and append one column per key; struct columns are expanded as they are.

    ``schemas`` maps columns to their keys; None stands for whatever keys the column's dictionaries hold, which are read first
    (``discover_dicts``).
    """
    texts = [c for c in schemas if not isinstance(df.schema[c].dataType, T.StructType)]
    unknown = [c for c in texts if schemas[c] is None]
    schemas = {**schemas, **(discover_dicts(df, unknown, text) if unknown else {})}
    for column in texts:
        if isinstance(schemas[column], T.StructType) and not schemas[column].fields:
            df = df.withColumn(column, F.lit(None).cast(T.StructType([])))
        else:
            df = parse_dict(df, column, schemas[column], text, errors)
    return expand_struct(df, list(schemas), drop, sep)


def union_by_name(frames) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def to_indicator(df: DataFrame, value: str, indicator=None, year="keep", drop=(), **constants) -> DataFrame:
    """A table with one measure to indicator rows.

    ``value`` is the measure column. ``indicator`` names the constant indicator; ``year`` is ``'keep'``, None for no
    year, or a year (number or column).
    """
    out = rename_strict(df.drop(*drop), {value: "value"})
    out = out.withColumn("value", as_text(F.col("value"), out.schema["value"].dataType))
    if indicator is not None:
        out = out.withColumn("indicator", F.lit(indicator))
    if not (isinstance(year, str) and year == "keep"):
        out = out.withColumn("year", (F.lit(year) if not hasattr(year, "cast") else year).cast("int"))
    return out.withColumns({k: F.lit(v) for k, v in constants.items()})
