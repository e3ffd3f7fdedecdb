"""Entity registry: alias resolution, attribute lookup, enrichment and unknown-value reports.

All lookups are left equi-joins against a many-to-one table derived from the registry. ``load_registry`` measures
the registry once; below the bounds its side of each join is broadcast, above them the join is left to Spark
(shuffle join, with adaptive skew handling for hot names).
"""

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions.text import match_key, normalise
from ..schemas import REGISTRY_SCHEMA

ATTRIBUTES = ["entity_name", "country", "iso3", "iso2", "region", "entity_id"]
ALIASES = {"entity_name": "alt_entity_names", "country": "alt_country_names"}
POLICIES = ("raise", "warn", "ignore")

MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 32 * 1024 * 1024
MAX_MAP_KEYS = 16_384
#: Values without a key are spread over so many, where a lookup shuffles.
NULL_KEYS = 4_096


class UnknownRows:
    """What lookups did not know, counted while a dataset is computed: one observation per lookup, no pass of its own.

    ``counts`` waits for the dataset's first action. Rows that filters remove before a lookup are not counted.
    """

    def __init__(self):
        self.lookups = []

    def observation(self, column: str) -> Observation:
        self.lookups.append((column, Observation()))
        return self.lookups[-1][1]

    def counts(self) -> list:
        """Per lookup: its column, the rows (of a list column: the elements) with unknown values, and the rows without a value."""
        return [{"column": column, **{k: v or 0 for k, v in found.get.items()}} for column, found in self.lookups]


@dataclass(frozen=True)
class Registry:
    """Registry rows with what was measured about them."""

    rows: DataFrame
    broadcastable: bool
    fits_map: bool
    #: Kinds of keys, as (column, with aliases), of which each was counted to occur in one row only.
    unique: frozenset = frozenset()
    #: What lookups that would raise do instead: count into an ``UnknownRows``, or ``ignore``.
    instead: object = None

    def with_policy(self, errors: str, unknown: UnknownRows = None) -> "Registry":
        """The registry for a request that wants its lookups to ``raise`` on unknown values, to ``warn`` or to ``ignore`` them."""
        if errors not in POLICIES:
            raise ValueError(f"Unrecognised values for parameter errors: {errors}")
        if errors == "warn" and unknown is None:
            raise ValueError("errors='warn' needs UnknownRows to count into")
        return replace(self, instead={"raise": None, "warn": unknown, "ignore": "ignore"}[errors])

    def policy(self, errors: str, observation, column: str):
        """A lookup's own policy, or the request's where it would raise."""
        if errors != "raise" or self.instead is None:
            return errors, observation
        return ("ignore", None) if self.instead == "ignore" else ("warn", self.instead.observation(column))

    def side(self, df: DataFrame) -> DataFrame:
        """Mark a registry-derived table as the build side when the registry was measured to be small."""
        return F.broadcast(df) if self.broadcastable else df


def load_registry(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES,
                  max_map_keys: int = MAX_MAP_KEYS) -> Registry:
    """Conform a table to the registry schema and measure it.

    The measurement is one job over at most ``max_rows + 1`` rows, so a huge table is recognised without being read. It
    counts what a lookup's build side holds (every attribute, once for each name or alias), and how often each key of each
    kind occurs, so that lookups group only by keys that repeat. Its outcome chooses a plan only; lookups give the same rows
    either way, as long as the table does not change.
    """
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REGISTRY_SCHEMA])

    def size(column):
        return F.coalesce(F.octet_length(column), F.lit(0))

    aliases = F.concat(*[F.coalesce(F.col(a), F.array().cast("array<string>")) for a in ALIASES.values()])
    alias_bytes = F.aggregate(aliases, F.lit(0).cast("long"), lambda total, x: total + size(x))
    row_bytes = sum((size(c) for c in ATTRIBUTES), F.lit(0)).cast("long")
    bytes_ = alias_bytes + (F.size(aliases) + len(ATTRIBUTES) + 1) * row_bytes
    kinds = [(by, False) for by in ATTRIBUTES] + [(by, True) for by in ALIASES]

    def found(kind, keys, size):
        return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key"), size.alias("bytes")))

    nothing = F.lit(0).cast("long")
    entries = [found(i, _keys(by, named), nothing) for i, (by, named) in enumerate(kinds)]
    entries.append(found(-1, F.array(F.lit(None).cast("string")), bytes_))
    per_key = (rows.limit(max_rows + 1).select(F.explode(F.concat(*entries)).alias("e")).select("e.*")
               .groupBy("kind", "key").agg(F.count(F.lit(1)).alias("rows"), F.sum("bytes").alias("bytes")))
    stats = {r["kind"]: r for r in per_key.groupBy("kind").agg(
        F.sum("rows").alias("rows"), F.max("rows").alias("most"), F.sum("bytes").alias("bytes")).collect()}
    if -1 not in stats:
        return Registry(rows, True, True, frozenset(kinds))
    small = stats[-1]["rows"] <= max_rows and stats[-1]["bytes"] <= max_bytes
    keys = sum(stats[i]["rows"] for i, kind in enumerate(kinds) if kind[1] and i in stats)
    unique = {kind for i, kind in enumerate(kinds) if i not in stats or stats[i]["most"] == 1}
    return Registry(rows, small, small and keys <= max_map_keys, frozenset(unique if stats[-1]["rows"] <= max_rows else ()))


def _keys(by: str, aliases: bool) -> Column:
    """The distinct lookup keys of a registry row as an array, empty where it has none."""
    own = F.array(F.col(by))
    if aliases:
        own = F.concat(own, F.coalesce(F.col(ALIASES[by]), F.array().cast("array<string>")))
    keys = F.filter(F.array_distinct(F.transform(own, lambda x: F.lower(x))), lambda x: x.isNotNull())
    return F.when(F.col(by).isNotNull(), keys).otherwise(F.array().cast("array<string>"))


def entity_names(registry: Registry) -> DataFrame:
    return registry.rows.select("entity_name")


def countries(registry: Registry) -> DataFrame:
    return registry.rows.select("country")


def iso3_codes(registry: Registry) -> DataFrame:
    return registry.rows.select("iso3")


def lookup_table(registry: Registry, by: str, aliases: bool = False) -> DataFrame:
    """``lookup_key`` (lower-cased) to one ``match`` struct holding every attribute of the entity.

    Keys are distinct, however often the registry repeats a row or shares a key: the entity that sorts last wins. Where keys
    were counted to be distinct already, nothing is grouped, so the build side of a join is not shuffled.
    """
    if by not in ATTRIBUTES:
        raise ValueError(f"Unrecognised registry column {by}")
    if aliases and by not in ALIASES:
        raise ValueError(f"Unrecognised column name for cleaning {by}")
    match = F.struct(*ATTRIBUTES).alias("match")
    if aliases:
        table = registry.rows.select(F.explode(_keys(by, True)).alias("lookup_key"), match)
    else:
        table = registry.rows.where(F.col(by).isNotNull()).select(F.lower(by).alias("lookup_key"), match)
    if (by, aliases) in registry.unique:
        return table
    order = F.struct(*[F.coalesce("match." + a, F.lit(""))
                       for a in ("iso3", "entity_name", "country", "entity_id", "iso2", "region")])
    return table.groupBy("lookup_key").agg(F.max_by("match", order).alias("match"))


def _unknown_policy(df: DataFrame, match: Column, value: Column, column: str, errors: str, observation):
    """Apply the policy for values that have no match. Nulls are not unknown.

    ``raise`` fails on the first such row the query computes; it is a row filter, so it holds whichever columns are
    read. ``warn`` counts unknown and null rows into the given Observation while the query runs (filters are then not
    pushed below the count). ``ignore`` does nothing.
    """
    if errors not in POLICIES:
        raise ValueError(f"Unrecognised values for parameter errors: {errors}")
    unknown = value.isNotNull() & match.isNull()
    if errors == "raise":
        message = F.concat(F.lit(f"Unknown {column} value in data: "), value.cast("string"))
        return df.where(F.when(unknown, F.raise_error(message).cast("boolean")).otherwise(F.lit(True)))
    if errors == "warn":
        if observation is None:
            raise ValueError("errors='warn' needs an Observation to count into")
        return df.observe(observation, F.count(F.when(unknown, 1)).alias("unknown_rows"),
                          F.count(F.when(value.isNull(), 1)).alias("null_rows"))
    return df


def spread_nulls(key: Column) -> Column:
    """A text key of its own for rows without one. They match nothing, and no partition of a shuffle gets them all."""
    return F.coalesce(key, F.concat(F.lit("\0"), F.pmod(F.monotonically_increasing_id(), F.lit(NULL_KEYS)).cast("string")))


def join_spread(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join with a table that has each ``key`` once, of any type. Rows whose key is null match nothing and are dealt out
    evenly; of a key that many rows share, Spark's adaptive joins split the partition."""
    turn = F.pmod(F.monotonically_increasing_id(), F.lit(NULL_KEYS)).cast("int") + 1
    salted = df.withColumn("__turn", F.when(F.col(key).isNull(), turn).otherwise(0))
    return salted.join(table.withColumn("__turn", F.lit(0)), [key, "__turn"], "left").drop("__turn")


def attach_match(df: DataFrame, registry: Registry, column: str, by: str, aliases: bool = False,
                 errors: str = "ignore", observation=None, into: str = "match") -> DataFrame:
    """Add a struct column with the registry attributes of the entity that ``column`` names, null if unknown.

    One join serves every attribute. With ``aliases`` the value is normalised and alternative names match too.
    """
    errors, observation = registry.policy(errors, observation, column)
    value = F.col(column).cast("string")
    key = match_key(value) if aliases else F.lower(value)
    if not registry.broadcastable:  # rows without a key match nothing: no partition gets them all
        key = spread_nulls(key)
    table = lookup_table(registry, by, aliases).withColumnsRenamed({"lookup_key": "__key", "match": "__match"})
    joined = df.withColumn("__key", key).join(registry.side(table), "__key", "left")
    joined = _unknown_policy(joined, F.col("__match"), value, column, errors, observation)
    return joined.withColumn(into, F.col("__match")).drop("__key", "__match")


def resolve_names(df: DataFrame, registry: Registry, column: str, by: str = "entity_name", errors: str = "raise",
                  observation=None, flag: str = None) -> DataFrame:
    """Replace names and aliases by the canonical name. Unknown names stay, with whitespace normalised."""
    out = attach_match(df, registry, column, by, True, errors, observation, into="__found")
    resolved = F.coalesce(F.col("__found")[by], normalise(F.col(column)))
    if flag:
        out = out.withColumn(flag, F.col("__found").isNotNull())
    return out.withColumn(column, resolved).drop("__found")


def lookup(df: DataFrame, registry: Registry, column: str, by: str, target: str, into: str = None,
           clean: bool = False, errors: str = "ignore", observation=None) -> DataFrame:
    """Add one registry attribute found under ``column``; unknown and null values give null."""
    if target not in ATTRIBUTES:
        raise ValueError(f"Unrecognised registry column {target}")
    out = attach_match(df, registry, column, by, clean, errors, observation, into="__found")
    return out.withColumn(into or target, F.col("__found")[target]).drop("__found")


def iso3_to_entity(df, registry, column, into="entity_name", errors="ignore"):
    return lookup(df, registry, column, "iso3", "entity_name", into, errors=errors)


def id_to_entity(df, registry, column, into="entity_name", errors="raise"):
    return lookup(df, registry, column, "entity_id", "entity_name", into, errors=errors)


def entity_to_id(df, registry, column, into="entity_id", clean=True, errors="raise"):
    return lookup(df, registry, column, "entity_name", "entity_id", into, clean, errors)


def country_to_entity(df, registry, column, into="entity_name", clean=True, errors="raise"):
    return lookup(df, registry, column, "country", "entity_name", into, clean, errors)


def enrich(df: DataFrame, registry: Registry, column: str, by: str, clean: bool = False, errors: str = "ignore",
           require_entity: bool = False, observation=None) -> DataFrame:
    """Fill the four index columns from one key with one join.

    ``clean`` resolves aliases first and keeps the (normalised) name of an unknown entity in its own column.
    ``require_entity`` blanks every attribute of a country that has no entity name.
    """
    out = attach_match(df, registry, column, by, clean, errors, observation, into="__found")
    found = F.col("__found")
    if require_entity:
        found = F.when(found["entity_name"].isNotNull(), found)
    filled = {c: found[c] for c in ("entity_name", "country", "iso3", "region")}
    if clean:
        filled[by] = F.coalesce(found[by], normalise(F.col(column).cast("string")))
    elif by == column:
        filled[by] = F.col(column)
    return out.withColumns(filled).drop("__found")


def unknown_values(df: DataFrame, registry: Registry, column: str, by: str, aliases: bool = True) -> DataFrame:
    """Distinct values the registry does not know, with the number of rows of each."""
    value = F.col(column).cast("string")
    key = match_key(value) if aliases else F.lower(value)
    counted = (df.where(F.col(column).isNotNull())
               .select((normalise(value) if aliases else value).alias("unknown_value"), key.alias("lookup_key"))
               .groupBy("lookup_key", "unknown_value").agg(F.count("*").alias("n_rows")))
    known = lookup_table(registry, by, aliases).select("lookup_key")
    return counted.join(registry.side(known), "lookup_key", "left_anti").drop("lookup_key")


def invert(pairs: DataFrame) -> DataFrame:
    """Swap the columns of a two-column key-value table."""
    key, value = pairs.columns
    return pairs.select(value, key)


def map_ids(df: DataFrame, pairs: DataFrame, column: str, into: str, key: str, value: str,
            reverse: bool = False) -> DataFrame:
    """Map a column through an external (id, name) table, in either direction. Unknown values give null.

    A repeated key keeps its greatest value. The table side is left to Spark's own size-based join choice.
    """
    if reverse:
        pairs, key, value = invert(pairs.select(key, value)), value, key
    table = (pairs.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key"))
             .agg(F.max(value).alias("__value")))
    return (join_spread(df.withColumn("__key", F.col(column)), table, "__key")
            .withColumn(into, F.col("__value")).drop("__key", "__value"))


def _side(registry: Registry, id_names):
    """A table made from the registry alone is as small as it; with a user's ids, whose number nobody has measured, Spark
    chooses the join."""
    return registry.side if id_names is None else lambda table: table


def cascade_table(registry: Registry, id_names: DataFrame = None) -> DataFrame:
    """Names reachable from an id, a country, an entity name or any alias: (lookup_key, name).

    ``id_names`` has the columns ``entity_id`` and ``name``; without it the registry's own names are used. Exact ids
    are kept under the prefix ``id:``, everything else lower-cased under ``name:``. Countries go before names.
    """
    own = registry.rows.where("entity_id is not null").select("entity_id", F.col("entity_name").alias("name"))
    ids = own if id_names is None else id_names.select("entity_id", "name")
    ids = ids.where("entity_id is not null and name is not null").groupBy("entity_id").agg(F.max("name").alias("name"))
    by_name = [
        lookup_table(registry, by, True).select(
            F.concat(F.lit("name:"), "lookup_key").alias("lookup_key"), F.lit(rank).alias("rank"),
            F.col("match.entity_name").alias("entity_name"), F.col("match.entity_id").alias("entity_id"))
        for rank, by in ((1, "country"), (2, "entity_name"))
    ]
    named = by_name[0].unionByName(by_name[1]).where("entity_name is not null")
    best = named.groupBy("lookup_key").agg(
        F.min_by(F.struct("entity_name", "entity_id"), "rank").alias("hit"))
    through = (best.select("lookup_key", "hit.*").join(_side(registry, id_names)(ids), "entity_id", "left")
               .select("lookup_key", F.coalesce("name", "entity_id", "entity_name").alias("name")))
    return ids.select(F.concat(F.lit("id:"), "entity_id").alias("lookup_key"), "name").unionByName(through)


def resolve_ids(df: DataFrame, registry: Registry, column: str, into: str, id_names: DataFrame = None,
                keep_unknown: bool = True) -> DataFrame:
    """Id to name, trying countries, names and aliases for values that are not ids."""
    side = _side(registry, id_names)
    table = cascade_table(registry, id_names)
    value = normalise(F.col(column).cast("string"))
    by_id = table.select(F.col("lookup_key").alias("__id"), F.col("name").alias("__by_id"))
    by_name = table.select(F.col("lookup_key").alias("__nm"), F.col("name").alias("__by_name"))
    out = join_spread(df.withColumn("__id", F.concat(F.lit("id:"), F.col(column))), side(by_id), "__id")
    # Only what is no id is looked up as a name.
    named = out.withColumn("__nm", F.when(F.col("__by_id").isNull(), F.concat(F.lit("name:"), F.lower(value))))
    out = join_spread(named, side(by_name), "__nm")
    hits = ["__by_id", "__by_name"]
    return (out.withColumn(into, F.coalesce(*hits, value) if keep_unknown else F.coalesce(*hits))
            .drop("__id", "__nm", *hits))
