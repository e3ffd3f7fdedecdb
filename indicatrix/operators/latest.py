"""Latest row per key.

The windows below keep row number one, so Spark drops all other rows of a key inside each map task (a partial
window group limit) before the shuffle. A hot key therefore costs one row per map task, not its whole group.
"""

from pyspark.sql import DataFrame, Window, functions as F, types as T

from .columns import quoted


def _first_per_key(df: DataFrame, keys, order) -> DataFrame:
    window = Window.partitionBy(*[quoted(k) for k in keys]).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def _ties(df: DataFrame, used, ties):
    """Remaining orderable columns, so that the choice among equal rows does not depend on row order."""
    if ties is not None:
        return [quoted(c).asc_nulls_last() for c in ties]
    return [quoted(f.name).asc_nulls_last() for f in df.schema
            if f.name not in used and not isinstance(f.dataType, (T.MapType, T.VariantType))]


def _value_order(df: DataFrame, value: str):
    """Ascending by the column's own type; text puts numbers before other text."""
    column = quoted(value)
    if isinstance(df.schema[value].dataType, T.StringType):
        return [column.try_cast("double").asc_nulls_last(), column.asc_nulls_last()]
    return [column.asc_nulls_last()]


def latest_indicators(df: DataFrame, keys=("entity_name", "indicator"), year: str = "year", value: str = "value",
                      ties=None) -> DataFrame:
    """Latest year per key; in that year the smallest value. Null keys form one group."""
    order = [quoted(year).desc_nulls_last(), *_value_order(df, value)]
    return _first_per_key(df, keys, order + _ties(df, {*keys, year, value}, ties))


def latest_per_entity(df: DataFrame, entity: str = "entity_name", year: str = "year", ties=None) -> DataFrame:
    """One row per entity: the one with the latest year."""
    order = [quoted(year).desc_nulls_last()]
    return _first_per_key(df, [entity], order + _ties(df, {entity, year}, ties))


def latest_year_rows(df: DataFrame, labels: dict, entity: str = "entity_name", indicator: str = "indicator",
                     year: str = "year", value: str = "value", yes: str = "Yes", ties=None) -> DataFrame:
    """Per entity and flag indicator, the latest year with a Yes, as a row of the indicator ``labels`` names."""
    flagged = df.where(quoted(indicator).isin(list(labels)) & (quoted(value) == yes))
    newest = _first_per_key(flagged, [entity, indicator], [
        quoted(year).desc_nulls_last(), *_ties(df, {entity, indicator, year, value}, ties)])
    return (newest.replace(labels, subset=[indicator])
            .withColumn(value, quoted(year).cast(df.schema[value].dataType)))


def with_latest_years(df: DataFrame, labels: dict, **names) -> DataFrame:
    """The table plus its latest-year rows."""
    return df.unionByName(latest_year_rows(df, labels, **names))


def repeated_keys(df: DataFrame, keys=("entity_name", "indicator", "dataset")) -> DataFrame:
    """Keys that occur more than once; empty after a latest filter."""
    return df.groupBy(*[quoted(k) for k in keys]).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
