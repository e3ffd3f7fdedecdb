"""Inputs derived from the given tables, and the register of queries with their SQL twins."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from indicatrix import load_registry

QUERIES, SQL = {}, {}

_registries = {}


def query(sql: str = None):
    """Register a function ``(spark, sf_dir) -> DataFrame`` under its name, with the SQL that must agree."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql.strip()
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def registry_rows(spark, sf_dir) -> DataFrame:
    """Nations as entities. Nation 24 has a country but no entity name, nation 23 has no id."""
    key = F.col("n_nationkey")
    def text(prefix):
        return F.concat(F.lit(prefix), key.cast("string"))
    def padded(prefix, width):
        return F.concat(F.lit(prefix), F.lpad(key.cast("string"), width, "0"))
    joined = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.select(
        F.when(key != 24, F.col("n_name")).alias("entity_name"), text("Country ").alias("country"),
        padded("N", 2).alias("iso3"), F.concat(F.lit("N"), F.char(key + 65)).alias("iso2"),
        F.col("r_name").alias("region"), F.when(key != 23, padded("D", 3)).alias("entity_id"),
        F.array(text("nation "), text("NATION-")).alias("alt_entity_names"),
        F.array(text("Land "), text("Republic of Country ")).alias("alt_country_names"))


def registry(spark, sf_dir):
    """The measured registry, measured once per application and input folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _registries:
        _registries[key] = load_registry(registry_rows(spark, sf_dir))
    return _registries[key]


REGISTRY = """
registry AS (
  SELECT CASE WHEN n_nationkey <> 24 THEN n_name END AS entity_name, 'Country ' || n_nationkey AS country,
         'N' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS iso3, r_name AS region,
         CASE WHEN n_nationkey <> 23 THEN 'D' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') END AS entity_id,
         n_nationkey
  FROM nation JOIN region ON n_regionkey = r_regionkey),
entity_key AS (
  SELECT lower(entity_name) AS k, * FROM registry WHERE entity_name IS NOT NULL
  UNION ALL SELECT 'nation ' || n_nationkey, * FROM registry WHERE entity_name IS NOT NULL
  UNION ALL SELECT 'nation-' || n_nationkey, * FROM registry WHERE entity_name IS NOT NULL),
country_key AS (
  SELECT lower(country) AS k, * FROM registry
  UNION ALL SELECT 'land ' || n_nationkey, * FROM registry
  UNION ALL SELECT 'republic of country ' || n_nationkey, * FROM registry)"""

DIRTY = """
dirty AS (
  SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN '  ' || n_name || ' '
         WHEN 3 THEN replace(n_name, '_', '  ') ELSE 'Unknown ' || c_custkey END AS raw_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
clean AS (SELECT c_custkey, raw_name, trim(regexp_replace(raw_name, '[\\s\\x{00A0}]+', ' ', 'g')) AS tidy FROM dirty)"""


def dirty_customers(spark, sf_dir) -> DataFrame:
    """Customers with the name of their nation written in five ways, one of them unknown."""
    name = F.col("n_name")
    way = F.col("c_custkey") % 5
    raw = (F.when(way == 0, name).when(way == 1, F.lower(name)).when(way == 2, F.concat(F.lit("  "), name, F.lit(" ")))
           .when(way == 3, F.replace(name, F.lit("_"), F.lit("  ")))
           .otherwise(F.concat(F.lit("Unknown "), F.col("c_custkey").cast("string"))))
    return (table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"),
                                                  F.col("c_nationkey") == F.col("n_nationkey"))
            .select("c_custkey", raw.alias("raw_name")))


def iso3_of(key):
    return F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0"))


def id_of(key):
    return F.concat(F.lit("D"), F.lpad(key.cast("string"), 3, "0"))


def country_of(key):
    return F.concat(F.lit("Country "), key.cast("string"))


def money(c):
    return F.col(c).cast("decimal(18,2)")
