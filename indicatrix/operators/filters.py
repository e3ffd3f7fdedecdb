"""Entity filters: validation against the registry, row filters and key restriction."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from .columns import quoted
from .registry import Registry, join_spread

MAX_INLINE_VALUES = 1_000
MAX_BROADCAST_VALUES = 100_000


def as_list(value, name: str):
    """A string becomes a one-item list; anything but a string or a list is refused."""
    if isinstance(value, str):
        return [value]
    if isinstance(value, list):
        return value
    raise TypeError(f"{name}: {value} is not a list or string")


def entity_filters(iso3=None, country=None, entity_name=None) -> dict:
    given = {"iso3": iso3, "country": country, "entity_name": entity_name}
    return {k: as_list(v, k) for k, v in given.items() if v is not None}


def validate_filters(filters: dict, registry: Registry) -> None:
    """Fail when a filter value is not in the registry. Reads back no more rows than there are values."""
    for column, values in filters.items():
        known = {r[0] for r in registry.rows.where(F.col(column).isin(values)).select(column).distinct().collect()}
        unknown = [v for v in values if v not in known]
        if unknown:
            raise ValueError(f"Unrecognised values {unknown}: not among the registry's {column} values")


def keep_values(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose column holds one of the values; for an array column, rows whose array contains one of them."""
    is_array = isinstance(df.schema[column].dataType, T.ArrayType)
    if is_array:
        wanted = F.array(*[F.lit(v) for v in values]).cast("array<string>")
        return df.where(F.coalesce(F.arrays_overlap(F.filter(quoted(column), lambda x: x.isNotNull()), wanted),
                                   F.lit(False)))
    if len(values) <= MAX_INLINE_VALUES:
        return df.where(quoted(column).isin(list(values)))
    distinct = sorted(set(values))
    kind = T.StructType([T.StructField("__wanted", df.schema[column].dataType)])
    wanted = df.sparkSession.createDataFrame([(v,) for v in distinct], kind)
    side = F.broadcast(wanted) if len(distinct) <= MAX_BROADCAST_VALUES else wanted
    return df.join(side, quoted(column) == F.col("__wanted"), "left_semi")


def filter_entities(df: DataFrame, registry: Registry, iso3=None, country=None, entity_name=None,
                    validate: bool = True) -> DataFrame:
    """Conjunctive entity filter on the index columns."""
    filters = entity_filters(iso3, country, entity_name)
    if validate:
        validate_filters(filters, registry)
    for column, values in filters.items():
        df = keep_values(df, column, values)
    return df


def source_keys(registry: Registry, filters: dict, key: str = "entity_id") -> DataFrame:
    """Keys under which a source knows the filtered entities. Entities without an id have no source rows."""
    rows = registry.rows.where("entity_id is not null")
    for column, values in filters.items():
        rows = rows.where(F.col(column).isin(list(values)))
    return rows.where(F.col(key).isNotNull()).select(key).distinct()


def restrict_to_keys(raw: DataFrame, column: str, registry: Registry, filters: dict, key: str = "entity_id",
                     ignore_case: bool = False) -> DataFrame:
    """Keep the raw rows of the filtered entities before any processing.

    The keys of a registry that was measured to be small become an IN list, which reaches the file scan; otherwise
    this is a semi join. ``ignore_case`` compares lower-cased keys: still done right after the scan, but not in it.

    A key inside JSON text (``country.iso3``) is taken out alone, so that only rows that stay are parsed whole; texts that do not
    tell the key stay too, for the filter on the finished table to decide.
    """
    keys = source_keys(registry, filters, key).withColumnRenamed(key, "__key")
    top, *fields = [column] if column in raw.columns else column.split(".")
    in_text = bool(fields) and isinstance(raw.schema[top].dataType, T.StringType)
    value = reduce(lambda c, field: c[field], fields, quoted(top)) if not in_text \
        else F.get_json_object(quoted(top), "$." + ".".join(fields))
    if ignore_case:
        keys, value = keys.select(F.lower("__key").alias("__key")).distinct(), F.lower(value)
    if registry.fits_map:
        wanted = value.isin([r[0] for r in keys.collect()])
        return raw.where(F.coalesce(wanted, F.lit(True)) if in_text else wanted)
    keyed = raw.withColumn("__key", value)
    if in_text:
        found = join_spread(keyed, registry.side(keys.withColumn("__wanted", F.lit(True))), "__key")
        return found.where("__wanted or __key is null").drop("__key", "__wanted")
    return keyed.join(registry.side(keys), "__key", "left_semi").drop("__key")
