"""Row clean-up and data invariants."""

from pyspark.sql import DataFrame, functions as F

from .columns import quoted


def drop_null_keys(df: DataFrame, subset) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.na.drop("any", subset=list(subset))


def drop_empty_rows(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows that are null in all of the columns."""
    return df.na.drop("all", subset=list(subset) if subset else None)


def drop_empty_columns(df: DataFrame, keep=()) -> DataFrame:
    """Drop columns that hold no value at all. Reads the table once to count, as the result schema depends on data."""
    counts = df.agg(*[F.count(quoted(c)).alias(str(i)) for i, c in enumerate(df.columns)]).first()
    return df.select(*[quoted(c) for i, c in enumerate(df.columns) if c in keep or counts[i] > 0])


def count_per_entity(df: DataFrame, keys, counted: str, into: str) -> DataFrame:
    """Non-null count per group. Groups with a null in any key are dropped."""
    return drop_null_keys(df, keys).groupBy(*[quoted(k) for k in keys]).agg(F.count(quoted(counted)).alias(into))


def require_single_value(df: DataFrame, column: str) -> DataFrame:
    """Fail at run time unless the column holds one distinct value, by its text form."""
    text = F.coalesce(quoted(column).cast("string"), F.lit("null"))
    one = df.agg(F.when(F.coalesce(F.min(text) == F.max(text), F.lit(True)), F.lit(True))
                 .otherwise(F.raise_error(F.concat(F.lit(f"Unexpected values in {column}: "), F.min(text),
                                                   F.lit(", "), F.max(text))).cast("boolean")))
    return df.where(one.scalar())


def require_equal(df: DataFrame, column: str, value: str, message: str, only=None) -> DataFrame:
    """Fail at run time on a row whose column is not ``value``. ``only`` limits the check to rows where it holds."""
    good = quoted(column).eqNullSafe(F.lit(value))
    if only is not None:
        good = good | ~only
    return df.where(F.when(good, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def recode(df: DataFrame, column: str, labels: dict, allow_only: bool = True) -> DataFrame:
    """Replace codes by labels. With ``allow_only``, keep only rows that end up with one of the labels.

    The filter is put on the source value, codes and labels alike, so it can reach the scan.
    """
    if allow_only:
        df = df.where(quoted(column).isin(sorted({*labels, *labels.values()})))
    return df.replace({k: v for k, v in labels.items() if k != v}, subset=[column])


def recode_from(df: DataFrame, column: str, labels: DataFrame, code: str = "code", label: str = "label") -> DataFrame:
    """The same with the codes in a table: rows whose value is a code take its label, rows that already hold a
    label stay, others are dropped. Spark picks the join by the table's size."""
    pairs = labels.select(F.col(code).alias("__code"), F.col(label).alias("__label"))
    pairs = pairs.unionByName(pairs.select(F.col("__label").alias("__code"), "__label"))
    # A code wins over an equal label.
    table = (pairs.where("__code is not null")
             .groupBy("__code").agg(F.coalesce(F.max(F.when(F.col("__code") != F.col("__label"), F.col("__label"))),
                                               F.max("__label")).alias("__label")))
    return (df.withColumn("__code", quoted(column)).join(table, "__code")
            .withColumn(column, F.col("__label")).drop("__code", "__label"))
