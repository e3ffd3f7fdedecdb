"""Landed JSON payloads to rows. Many payload files are many partitions."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.checks import require_single_value
from ..operators.columns import quoted

# Nested payload: indicator -> entities -> yearly values.
NESTED_SCHEMA = ("data ARRAY<STRUCT<id: STRING, years: STRING, data: ARRAY<STRUCT<id: STRING, "
                 "data: ARRAY<STRUCT<year: INT, value: STRING>>>>>>")
DOCUMENTS_SCHEMA = ("code STRING, documents ARRAY<STRUCT<name: STRING, document_type: STRING, year: INT, "
                    "url: STRING>>")


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    """JSON files holding an object or an array of objects each."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def page_results(pages: DataFrame, field: str = "results") -> DataFrame:
    """Concatenate the result arrays of paged payloads."""
    return pages.select(F.explode(quoted(field)).alias("r")).select("r.*")


def read_page_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed page file, holding its whole text in ``value``."""
    return spark.read.text(path, wholetext=True)


def page_element_rows(pages: DataFrame, column: str, schema: str, position: int = 1, metadata: int = None) -> DataFrame:
    """Rows of pages that are arrays of unlike elements, such as ``[metadata, rows]``.

    With ``metadata``, the place of the element that holds ``page`` and ``pages``, the rows are only given if the pages that it
    announces are there, each once (``require_all_pages``).
    """
    if metadata is not None:
        pages = require_all_pages(pages, column, metadata)
    element = F.get(F.from_json(quoted(column), "array<string>", {"mode": "FAILFAST"}), F.lit(position))
    row = T.StructType.fromDDL(schema)
    parsed = F.from_json(element, T.ArrayType(row), {"mode": "FAILFAST"})
    return pages.select(F.explode(parsed).alias("r")).select("r.*")


def page_ledger(pages: DataFrame, column: str, position: int = 0) -> DataFrame:
    """One row about landed pages: ``announced`` (their number as the pages give it), ``least`` (the same, if they agree),
    ``landed`` files, ``different`` page numbers, ``first`` and ``last`` number."""
    text = F.get(F.from_json(quoted(column), "array<string>", {"mode": "FAILFAST"}), F.lit(position))
    about = pages.select(F.from_json(text, "page INT, pages INT", {"mode": "FAILFAST"}).alias("m")).select("m.*")
    per_page = about.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.max("pages").alias("most"), F.min("pages").alias("least"))
    return per_page.agg(F.max("most").alias("announced"), F.min("least").alias("least"), F.coalesce(F.sum("n"), F.lit(0)).alias("landed"),
                        F.count("page").alias("different"), F.min("page").alias("first"), F.max("page").alias("last"))


def require_all_pages(pages: DataFrame, column: str, position: int = 0) -> DataFrame:
    """Fail at run time unless the pages 1 to n are there once each, n being the number that every page announces.

    The pages' metadata are counted in a subquery; nothing comes to the driver. No pages at all are an empty table.
    """
    ledger = page_ledger(pages, column, position)
    whole = ((F.col("landed") == F.col("announced")) & (F.col("least") == F.col("announced"))
             & (F.col("different") == F.col("announced")) & (F.col("first") == 1) & (F.col("last") == F.col("announced")))
    message = F.concat(F.lit("Pages are missing or doubled: "), F.to_json(F.struct("announced", "landed", "different", "first", "last")))
    good = ledger.select(F.when((F.col("landed") == 0) | F.coalesce(whole, F.lit(False)), F.lit(True))
                         .otherwise(F.raise_error(message).cast("boolean")))
    return pages.where(good.scalar())


def flatten_nested(payload: DataFrame, check_years: bool = True) -> DataFrame:
    """Nested payload to (indicator, entity_id, year, value). Empty levels give null rows."""
    items = payload.select(F.explode_outer("data").alias("i"))
    if check_years:
        items = require_single_value(items.select("i", F.col("i.years").alias("years")), "years").drop("years")
    entities = items.select(F.col("i.id").alias("indicator"), F.explode_outer("i.data").alias("e"))
    values = entities.select("indicator", F.col("e.id").alias("entity_id"), F.explode_outer("e.data").alias("v"))
    return values.select("indicator", "entity_id", "v.year", "v.value")


def flatten_documents(payload: DataFrame) -> DataFrame:
    """Document lists to one row per document, with the code of the entity they belong to."""
    return (payload.select(F.col("code").alias("entity_id"), F.explode("documents").alias("d"))
            .select("entity_id", "d.*"))


def flatten_maps(df: DataFrame, column: str, names=("indicator", "iso3", "year"), value: str = "value") -> DataFrame:
    """JSON text of nested maps (indicator -> code -> year -> number) to rows."""
    nested = F.from_json(quoted(column), "map<string,map<string,map<string,double>>>")
    a, b, c = names
    return (df.select(F.explode(nested).alias(a, "m1"))
            .select(a, F.explode("m1").alias(b, "m2"))
            .select(a, b, F.explode("m2").alias(c, value)))


def embedded_csv(df: DataFrame, column: str, schema: str, skip: int = 2, keep=()) -> DataFrame:
    """CSV text held in a field to rows of ``schema``; further columns of the text are ignored.

    The first ``skip`` lines (header and type line) are dropped. Newlines inside quotes do not end a line.
    """
    lines = F.regexp_extract_all(quoted(column), F.lit(r'(?:[^"\r\n]++|"[^"]*+")++'), F.lit(0))
    rows = (df.select(*keep, F.posexplode(lines).alias("__pos", "__line")).where(F.col("__pos") >= skip)
            .withColumn("__row", F.from_csv("__line", F.lit(schema), {"mode": "PERMISSIVE", "escape": '"', "multiLine": "true"})))
    return rows.select(*keep, "__row.*")
