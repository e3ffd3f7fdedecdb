"""Lookups on list elements.

A registry measured to be small becomes one map value (a scalar subquery), so list elements are looked up inside the
row and nothing is shuffled. A larger one is joined: distinct lists are exploded, joined, put back in order, and joined
to their rows by a hash; the group of a list is as long as that list, and rows without a list are dealt out evenly.
"""

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import (
    clean_list, join_list, match_key, normalise, recode_list, replace_in_order, split_list, strip)
from .columns import quoted
from .registry import ATTRIBUTES, Registry, _side, cascade_table, join_spread, lookup_table, spread_nulls


N_BUCKETS = 256


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(N_BUCKETS)).cast("int")


def _lookup_value(table: DataFrame, value: str) -> Column:
    """The table as one value: an array of small maps, indexed by a hash of the key.

    A map lookup in Spark walks over the entries, so the entries are spread over buckets.
    """
    per_bucket = table.groupBy(_bucket(F.col("lookup_key")).alias("b")).agg(
        F.map_from_entries(F.collect_list(F.struct("lookup_key", value))).alias("m"))
    maps = F.map_from_entries(F.collect_list(F.struct("b", "m")))
    return per_bucket.select(F.transform(F.sequence(F.lit(0), F.lit(N_BUCKETS - 1)), lambda i: maps[i])).scalar()


def _resolve_in_row(df, column, into, table, value, key, combine):
    def item(x):
        return combine(x, [F.col("__maps")[_bucket(k)][k] for k in key(x)])
    with_maps = df.withColumn("__maps", _lookup_value(table, value))
    return with_maps.withColumn(into, F.transform(quoted(column), item)).drop("__maps")


def _list_key(items: Column) -> Column:
    """128 bits that tell lists of texts apart, so that joins move and compare these and not the lists."""
    marked = F.transform(items, lambda x: F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")))
    return F.md5(F.array_join(marked, ",").cast("binary"))


def _resolve_by_join(df, column, into, table, value, key, combine):
    has = F.coalesce(F.size(quoted(column)) > 0, F.lit(False))
    keyed = df.withColumn("__list", spread_nulls(F.when(has, _list_key(quoted(column)))))
    lists = keyed.where(has).groupBy("__list").agg(F.first(quoted(column)).alias("__items"))
    items = lists.select("__list", F.posexplode("__items").alias("__pos", "__item"))
    hits = []
    for i, k in enumerate(key(F.col("__item"))):
        side = table.select(F.col("lookup_key").alias(f"__k{i}"), F.col(value).alias(f"__v{i}"))
        items = join_spread(items.withColumn(f"__k{i}", k), side, f"__k{i}")
        hits.append(F.col(f"__v{i}"))
    entry = F.struct("__pos", combine(F.col("__item"), hits).alias("v"))
    done = (items.groupBy("__list").agg(F.sort_array(F.collect_list(entry)).alias("__done"))
            .select("__list", F.transform("__done", lambda e: e["v"]).alias("__out")))
    empty = F.when(quoted(column).isNotNull(), F.array().cast(done.schema["__out"].dataType))
    return keyed.join(done, "__list", "left").withColumn(into, F.coalesce("__out", empty)).drop("__list", "__out")


def _in_row(registry: Registry, id_names=None) -> bool:
    """Whether the table is made from a registry that was measured to be small; a user's ids are always joined."""
    return registry.fits_map and id_names is None


def _resolve(df, registry, column, into, table, value, key, combine, id_names=None):
    if _in_row(registry, id_names):
        return _resolve_in_row(df, column, into, table, value, key, combine)
    return _resolve_by_join(df, column, into, _side(registry, id_names)(table), value, key, combine)


def resolve_list(df: DataFrame, registry: Registry, column: str, into: str = None, by: str = "country",
                 errors: str = "raise") -> DataFrame:
    """Canonical names for the elements of a list column, order kept. Unknown elements stay, or raise."""
    def combine(x, hits):
        found = hits[0]
        if errors == "raise":
            message = F.concat(F.lit(f"Unknown {by} value in data: "), x)
            return F.when(found.isNull() & x.isNotNull(), F.raise_error(message)).otherwise(found)
        if errors == "warn":
            return F.struct(F.coalesce(found, normalise(x)).alias("name"), (found.isNull() & x.isNotNull()).alias("unknown"))
        return F.coalesce(found, normalise(x))
    if errors not in ("raise", "ignore"):
        raise ValueError(f"Unrecognised values for parameter errors: {errors}")
    errors, observation = registry.policy(errors, None, column)
    table = lookup_table(registry, by, True).select("lookup_key", F.col("match")[by].alias("name"))
    out = _resolve(df, registry, column, into or column, table, "name", lambda x: [match_key(x)], combine)
    if errors != "warn":
        return out
    named = quoted(into or column)
    out = out.observe(observation, F.sum(F.size(F.filter(named, lambda e: e["unknown"]))).alias("unknown_rows"),
                      F.count(F.when(named.isNull(), 1)).alias("null_rows"))
    return out.withColumn(into or column, F.transform(named, lambda e: e["name"]))


def lookup_list(df: DataFrame, registry: Registry, column: str, target: str, into: str, by: str = "country") -> DataFrame:
    """One registry attribute per list element, same length and order; unknown elements stay as they are."""
    if target not in ATTRIBUTES:
        raise ValueError(f"Unrecognised registry column {target}")
    table = lookup_table(registry, by).select("lookup_key", F.col("match")[target].alias("name"))
    known = table.select("lookup_key", F.struct("name").alias("hit"))
    return _resolve(df, registry, column, into, known, "hit", lambda x: [F.lower(x)],
                    lambda x, hits: F.when(hits[0].isNotNull(), hits[0]["name"]).otherwise(x))


def enrich_list(df: DataFrame, registry: Registry, column: str, by: str = "country",
                targets=("entity_name", "iso3", "region")) -> DataFrame:
    """Parallel list columns with the registry attributes of each element, found in one pass over the list."""
    table = lookup_table(registry, by).select(
        "lookup_key", F.struct(*[F.col("match")[t].alias(t) for t in targets]).alias("hit"))

    def combine(x, hits):
        unknown = F.struct(*[x.alias(t) for t in targets])
        return F.when(hits[0].isNotNull(), hits[0]).otherwise(unknown)
    found = _resolve(df, registry, column, "__hits", table, "hit", lambda x: [F.lower(x)], combine)
    return found.withColumns({t: F.col("__hits")[t] for t in targets}).drop("__hits")


def resolve_id_text(df: DataFrame, registry: Registry, column: str, when: Column = None, id_names: DataFrame = None,
                    invalid=(), changed: dict = None, into: str = None) -> DataFrame:
    """Text listing ids (separated by ``,`` or ``;``) to text listing names.

    Blank and invalid tokens are dropped, changed ids replaced, ids and names resolved by the cascade, and what stays
    unknown is kept. Only rows where ``when`` holds are touched; where a join is needed, the others do not take part in it but
    are read a second time, past it, so ``df`` must give the same rows each time.
    """
    target = into or column
    tokens = F.filter(split_list(F.col(column)), lambda x: ~x.isin(list(invalid))) if invalid \
        else split_list(F.col(column))
    tokens = recode_list(tokens, changed or {})
    touched = F.lit(True) if when is None else F.coalesce(when, F.lit(False))
    chosen = touched & F.col(column).isNotNull()
    table = cascade_table(registry, id_names)

    def resolved(rows):
        found = _resolve(rows.withColumn("__tokens", F.when(chosen, tokens)), registry, "__tokens", "__names", table, "name",
                         lambda x: [F.concat(F.lit("id:"), x), F.concat(F.lit("name:"), match_key(x))],
                         lambda x, hits: F.coalesce(*hits, normalise(x)), id_names)
        return found.withColumn(target, F.when(chosen, join_list(F.col("__names"))).otherwise(F.col(column))).drop("__tokens", "__names")
    if when is None or _in_row(registry, id_names):
        return resolved(df)
    return resolved(df.where(when & F.col(column).isNotNull())).unionByName(df.where(~chosen).withColumn(target, F.col(column)))


def split_and_clean(df: DataFrame, column: str, replacements: dict, unwanted) -> DataFrame:
    """Comma text to a list: repair names that contain commas, split, strip, drop unwanted elements."""
    repaired = strip(replace_in_order(strip(F.col(column)), replacements))
    return df.withColumn(column, clean_list(F.split(repaired, ","), unwanted))
