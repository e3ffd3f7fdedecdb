"""One query per operator, over whole tables, with the SQL that must give the same rows."""

import tempfile
import uuid

from pyspark.sql import Window, functions as F

from indicatrix import load_registry
from indicatrix.functions.text import clean_list
from indicatrix.functions.values import (
    is_quantitative, not_in, rounded_percentage, strict_number, timestamp_or_null, yes_no)
from indicatrix.operators import (
    checks as C, columns as K, filters as X, latest as T, lists as L, registry as R, reshape as S)
from indicatrix.plans.collect import combine
from indicatrix.plans.datasets import COMMA_COUNTRY_NAMES, LOCATIONS_NOT_COUNTRIES
from indicatrix.schemas import INDEX_COLUMNS
from indicatrix.sources import payloads as P, snapshots as N

from .inputs import (
    DIRTY, REGISTRY, country_of, dirty_customers, id_of, iso3_of, money, query, registry, registry_rows, table)

# ---------------------------------------------------------------- registry


@query(f"""
WITH {REGISTRY}, {DIRTY}
SELECT c_custkey, coalesce(entity_name, tidy) AS entity_name, k IS NOT NULL AS resolved
FROM clean LEFT JOIN entity_key ON k = lower(tidy)""")
def alias_resolve(spark, sf_dir):
    df = R.resolve_names(dirty_customers(spark, sf_dir), registry(spark, sf_dir), "raw_name", errors="ignore",
                         flag="resolved")
    return df.select("c_custkey", F.col("raw_name").alias("entity_name"), "resolved")


@query("""
SELECT c_custkey, n_name AS entity_name, r_name AS region FROM customer JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey""")
def registry_repeated_keys(spark, sf_dir):
    """Every entity is listed twice: a lookup still gives one row."""
    twice = load_registry(registry_rows(spark, sf_dir).unionByName(registry_rows(spark, sf_dir))
                          .withColumn("entity_name", F.coalesce("entity_name", F.concat(F.lit("NATION_"), F.substring("iso3", 2, 2)))))
    df = table(spark, sf_dir, "customer").select("c_custkey", country_of(F.col("c_nationkey")).alias("place"))
    return R.enrich(df, twice, "place", "country").select("c_custkey", "entity_name", "region")


@query(f"""
WITH {REGISTRY}, {DIRTY}
SELECT tidy AS unknown_value, count(*) AS n_rows FROM clean
WHERE lower(tidy) NOT IN (SELECT k FROM entity_key) GROUP BY tidy""")
def unknown_values_report(spark, sf_dir):
    return R.unknown_values(dirty_customers(spark, sf_dir), registry(spark, sf_dir), "raw_name", "entity_name")


@query(f"""
WITH {REGISTRY}
SELECT s_suppkey, r.entity_name, CASE WHEN r.entity_name IS NOT NULL THEN r.entity_id END AS entity_id, r.region,
       c.entity_name AS via_country
FROM supplier LEFT JOIN registry r ON lower(r.iso3) = 'n' || lpad(CAST(s_nationkey AS VARCHAR), 2, '0')
LEFT JOIN country_key c ON c.k = 'land ' || s_nationkey""")
def attribute_lookup(spark, sf_dir):
    reg = registry(spark, sf_dir)
    df = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.lower(iso3_of(F.col("s_nationkey"))).alias("code"),
        F.concat(F.lit(" LAND  "), F.col("s_nationkey").cast("string")).alias("place"))
    df = R.iso3_to_entity(df, reg, "code")
    df = R.entity_to_id(df, reg, "entity_name")
    df = R.lookup(df, reg, "code", "iso3", "region")
    df = R.country_to_entity(df, reg, "place", into="via_country")
    return df.select("s_suppkey", "entity_name", "entity_id", "region", "via_country")


@query(f"""
WITH {REGISTRY}
SELECT c_custkey, r.entity_name, r.country, r.iso3, r.region
FROM customer LEFT JOIN registry r ON r.entity_id = 'D' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0')""")
def enrich_all_attributes(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", id_of(F.col("c_nationkey")).alias("id"))
    return R.enrich(df, registry(spark, sf_dir), "id", "entity_id").select("c_custkey", *INDEX_COLUMNS)


@query(f"""
WITH {REGISTRY}
SELECT c_custkey, r.entity_name, r.country, r.iso3, r.region
FROM customer LEFT JOIN registry r ON r.n_nationkey = c_nationkey AND r.entity_name IS NOT NULL""")
def enrich_two_hop(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", iso3_of(F.col("c_nationkey")).alias("code"))
    return R.enrich(df, registry(spark, sf_dir), "code", "iso3", errors="ignore", require_entity=True).select(
        "c_custkey", *INDEX_COLUMNS)


@query("""
SELECT s_suppkey, n_nationkey AS nation_id, n_name AS nation_name
FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def id_map_reverse(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    df = R.map_ids(df, nation, "s_nationkey", "nation_name", "n_nationkey", "n_name")
    df = R.map_ids(df, nation, "nation_name", "nation_id", "n_nationkey", "n_name", reverse=True)
    return df.select("s_suppkey", "nation_id", "nation_name")


CASCADE = """
mixed AS (
  SELECT c_custkey, CASE c_custkey % 6
      WHEN 0 THEN 'D' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') WHEN 1 THEN 'Country ' || c_nationkey
      WHEN 2 THEN ' republic of  country ' || c_nationkey WHEN 3 THEN 'NATION_' || c_nationkey
      WHEN 4 THEN 'nation-' || c_nationkey ELSE 'zzz ' || c_custkey END AS v
  FROM customer)"""


@query(f"""
WITH {REGISTRY}, {CASCADE},
tidy AS (SELECT c_custkey, v, trim(regexp_replace(v, '\\s+', ' ', 'g')) AS t FROM mixed)
SELECT c_custkey, coalesce(i.entity_name, c.entity_name, e.entity_name, t) AS name
FROM tidy LEFT JOIN registry i ON i.entity_id = v LEFT JOIN country_key c ON c.k = lower(t)
LEFT JOIN entity_key e ON e.k = lower(t)""")
def id_cascade_resolve(spark, sf_dir):
    nation, way = F.col("c_nationkey").cast("string"), F.col("c_custkey") % 6
    value = (F.when(way == 0, id_of(F.col("c_nationkey"))).when(way == 1, country_of(F.col("c_nationkey")))
             .when(way == 2, F.concat(F.lit(" republic of  country "), nation))
             .when(way == 3, F.concat(F.lit("NATION_"), nation)).when(way == 4, F.concat(F.lit("nation-"), nation))
             .otherwise(F.concat(F.lit("zzz "), F.col("c_custkey").cast("string"))))
    df = table(spark, sf_dir, "customer").select("c_custkey", value.alias("v"))
    return R.resolve_ids(df, registry(spark, sf_dir), "v", "name").select("c_custkey", "name")


# ---------------------------------------------------------------- latest

@query("""
SELECT user_id, event_type, year, value, event_id FROM (
  SELECT user_id, event_type, CAST(day(ts) AS INTEGER) AS year, value, event_id, row_number() OVER (
    PARTITION BY user_id, event_type ORDER BY day(ts) DESC NULLS LAST, value ASC NULLS LAST, event_id) AS rn
  FROM events) WHERE rn = 1""")
def latest_per_entity_indicator(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("user_id", "event_type", F.dayofmonth("ts").alias("year"), "value",
                                               "event_id")
    return T.latest_indicators(df, ("user_id", "event_type"), ties=["event_id"])


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_day FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""")
def latest_per_entity(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    newest = T.latest_per_entity(df, "o_custkey", "o_orderdate", ties=["o_orderkey"])
    return newest.select("o_custkey", "o_orderkey", "o_orderstatus",
                         F.to_date("o_orderdate").cast("string").alias("order_day"))


@query("""
WITH flags AS (
  SELECT o_custkey, o_orderpriority AS indicator, CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE 'No' END AS value,
         CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey FROM orders),
newest AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, indicator ORDER BY year DESC, o_orderkey) AS rn
  FROM flags WHERE value = 'Yes' AND indicator IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'))
SELECT o_custkey, indicator, value, year, o_orderkey FROM flags
UNION ALL
SELECT o_custkey, 'Year of latest ' || indicator, CAST(year AS VARCHAR), year, o_orderkey FROM newest WHERE rn = 1""")
def latest_year_derived_indicators(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderpriority").alias("indicator"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Yes")).otherwise(F.lit("No")).alias("value"),
        F.year("o_orderdate").alias("year"), "o_orderkey")
    labels = {c: f"Year of latest {c}" for c in ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")}
    return T.with_latest_years(df, labels, entity="o_custkey", ties=["o_orderkey"])


@query("""
SELECT user_id, event_type, count(*) AS n_rows FROM events GROUP BY ALL HAVING count(*) > 1""")
def repeated_key_check(spark, sf_dir):
    return T.repeated_keys(table(spark, sf_dir, "events"), ("user_id", "event_type"))


# ---------------------------------------------------------------- reshape

@query("""
WITH long AS (
  SELECT l_returnflag, l_linestatus, 'quantity' AS indicator, CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) AS value FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 'discount', CAST(CAST(l_discount AS DECIMAL(18,2)) AS VARCHAR) FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 'line', CAST(l_linenumber AS VARCHAR) FROM lineitem
  UNION ALL SELECT l_returnflag, l_linestatus, 'tax', CAST(CAST(nullif(l_tax, 0) AS DECIMAL(18,2)) AS VARCHAR) FROM lineitem)
SELECT l_returnflag, l_linestatus, indicator, value, count(*) AS n_rows FROM long GROUP BY ALL""")
def melt_measures(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", "l_linestatus", money("l_quantity").alias("quantity"), money("l_discount").alias("discount"),
        F.col("l_linenumber").alias("line"), F.nullif(F.col("l_tax"), F.lit(0.0)).cast("decimal(18,2)").alias("tax"))
    long = S.melt(df, ["l_returnflag", "l_linestatus"])
    return long.groupBy("l_returnflag", "l_linestatus", "indicator", "value").agg(F.count("*").alias("n_rows"))


def assessment_sheet(spark, sf_dir):
    """A sheet with a row per market segment and a column per nation, plus name and year rows."""
    customer = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey")
    counts = (customer.groupBy("c_mktsegment").pivot("c_nationkey", list(range(25))).agg(F.count(F.lit(1)))
              .select(F.concat(F.lit("SEG_"), "c_mktsegment").alias("Code"),
                      F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit(" "), "c_mktsegment")).alias("Name"),
                      *[F.col(str(i)).cast("string").alias(f"a{i}") for i in range(25)]))
    nation = table(spark, sf_dir, "nation")
    names = nation.groupBy().pivot("n_nationkey", list(range(25))).agg(F.max("n_name"))
    years = nation.groupBy().pivot("n_nationkey", list(range(25))).agg(F.max(F.col("n_nationkey") % 4 + 2015))
    heads = [df.select(F.lit(None).cast("string").alias("Code"), F.lit(label).alias("Name"),
                       *[F.col(str(i)).cast("string").alias(f"a{i}") for i in range(25)])
             for df, label in ((names, "National Society"), (years, "Year"))]
    return counts.unionByName(heads[0]).unionByName(heads[1])


@query("""
SELECT 'a' || n_nationkey AS assessment, n_name AS entity_name, CAST(n_nationkey % 4 + 2015 AS VARCHAR) AS year,
       CAST(nullif(count(*) FILTER (c_mktsegment = 'BUILDING'), 0) AS VARCHAR) AS building,
       CAST(nullif(count(*) FILTER (c_mktsegment = 'MACHINERY'), 0) AS VARCHAR) AS seg_machinery
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""")
def transpose_assessments(spark, sf_dir):
    sheet = assessment_sheet(spark, sf_dir)
    sheet = sheet.withColumn("label", F.trim(F.coalesce("Name", "Code"))).drop("Name", "Code")
    wide = S.transpose(sheet, "label", rows=["National Society", "Year", "BUILDING", "SEG_MACHINERY"],
                       column_name="assessment")
    return wide.withColumnsRenamed({"National Society": "entity_name", "Year": "year", "BUILDING": "building",
                                    "SEG_MACHINERY": "seg_machinery"})


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS props_k,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS repr_k, event_type AS repr_inner_kind,
       event_id % 2 = 0 AS repr_inner_even
FROM events""")
def dict_column_expand(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "props",
        F.concat(F.lit("{'k': "), F.get_json_object("props", "$.k"), F.lit(", 'note': None, 'inner': {'kind': '"),
                 "event_type", F.lit("', 'even': "),
                 F.when(F.col("event_id") % 2 == 0, F.lit("True")).otherwise(F.lit("False")), F.lit("}}")).alias("repr"))
    df = S.expand_dict_columns(events, {"props": "k BIGINT"}, drop=True, sep="_")
    df = S.expand_dict_columns(
        df, {"repr": "k BIGINT, note STRING, inner STRUCT<kind: STRING, even: BOOLEAN>"}, True, "python", "_")
    return df.drop("repr_note")


YEARLY = """
yearly AS (
  SELECT o_orderpriority AS indicator, 'D' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS entity_id,
         CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)"""


def yearly_counts(spark, sf_dir):
    """Orders per priority, nation and year: at most a few thousand rows at any scale.

    Orders are counted per customer first, so that a customer with very many orders is small before the join.
    """
    orders = (table(spark, sf_dir, "orders")
              .groupBy("o_custkey", F.col("o_orderpriority").alias("indicator"), F.year("o_orderdate").alias("year"))
              .agg(F.count("*").alias("n")))
    joined = orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return (joined.groupBy("indicator", id_of(F.col("c_nationkey")).alias("entity_id"), "year")
            .agg(F.sum("n").alias("n")))


def nested_payload(spark, sf_dir):
    """One JSON text per priority: entities (25 at most) with their yearly values (one per year)."""
    yearly = yearly_counts(spark, sf_dir)
    entities = yearly.groupBy("indicator", "entity_id").agg(F.sort_array(F.collect_list(
        F.struct(F.col("year"), F.col("n").cast("string").alias("value")))).alias("data"))
    items = entities.groupBy("indicator").agg(F.sort_array(F.collect_list(
        F.struct(F.col("entity_id").alias("id"), "data"))).alias("data"))
    item = F.struct(F.col("indicator").alias("id"), F.lit("all").alias("years"), "data")
    return items.select(F.to_json(F.struct(F.array(item).alias("data"))).alias("body"))


@query(f"""
WITH {YEARLY} SELECT indicator, entity_id, year, CAST(n AS VARCHAR) AS value FROM yearly""")
def nested_payload_flatten(spark, sf_dir):
    parsed = nested_payload(spark, sf_dir).select(F.from_json("body", P.NESTED_SCHEMA).alias("p")).select("p.*")
    return P.flatten_nested(parsed)


@query("""
SELECT o_orderkey, o_orderpriority AS indicator, o_totalprice AS value FROM orders
UNION ALL SELECT o_orderkey, 'second', NULL FROM orders""")
def paged_element_rows(spark, sf_dir):
    """One page text per order: metadata first, then the page's rows."""
    def row(indicator, value):
        return F.struct(F.col("o_orderkey").alias("o_orderkey"), indicator.alias("indicator"), value.alias("value"))
    rows = F.to_json(F.array(row(F.col("o_orderpriority"), F.col("o_totalprice")),
                             row(F.lit("second"), F.lit(None).cast("double"))))
    pages = table(spark, sf_dir, "orders").select(F.concat(F.lit('[{"page": 1, "pages": 9}, '), rows, F.lit("]")).alias("body"))
    return P.page_element_rows(pages, "body", "o_orderkey BIGINT, indicator STRING, value DOUBLE")


@query(f"""
WITH {YEARLY} SELECT indicator, entity_id AS iso3, CAST(year AS VARCHAR) AS year, CAST(n AS DOUBLE) AS value
FROM yearly""")
def map_of_maps_flatten(spark, sf_dir):
    yearly = yearly_counts(spark, sf_dir)
    def as_map(key, value):
        return F.map_from_entries(F.collect_list(F.struct(F.col(key).cast("string"), F.col(value))))
    inner = yearly.groupBy("indicator", "entity_id").agg(as_map("year", "n").alias("m1"))
    outer = inner.groupBy("indicator").agg(as_map("entity_id", "m1").alias("m2"))
    body = outer.select(F.to_json(F.create_map("indicator", "m2")).alias("body"))
    return P.flatten_maps(body, "body")


@query(f"""
WITH {YEARLY} SELECT indicator AS survey, entity_id AS entity, year, 'say "' || n || '", twice' AS answer
FROM yearly""")
def embedded_csv_rows(spark, sf_dir):
    line = F.concat_ws(",", "entity_id", F.col("year").cast("string"),
                       F.concat(F.lit('"say ""'), F.col("n").cast("string"), F.lit('"", twice"')), F.lit("extra"))
    texts = (yearly_counts(spark, sf_dir).groupBy(F.col("indicator").alias("survey"))
             .agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
             .select("survey", F.concat(F.lit("entity,year,answer,more\nstring,number,string,string\n"), "lines")
                     .alias("csv")))
    payload = texts.select("survey", F.to_json(F.struct(F.struct("csv").alias("data"))).alias("body"))
    field = payload.select("survey", F.get_json_object("body", "$.data.csv").alias("csv"))
    return P.embedded_csv(field, "csv", "entity STRING, year INT, answer STRING", keep=["survey"])


@query(f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, CAST(count(*) AS VARCHAR) AS value, 'Number of suppliers' AS indicator,
       CAST(NULL AS INTEGER) AS year
FROM supplier JOIN registry ON n_nationkey = s_nationkey WHERE entity_name IS NOT NULL GROUP BY ALL""")
def single_measure_to_indicator(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").select("s_suppkey", iso3_of(F.col("s_nationkey")).alias("code"))
    df = R.enrich(df, registry(spark, sf_dir), "code", "iso3")
    counted = C.count_per_entity(df, INDEX_COLUMNS, "s_suppkey", "n")
    return S.to_indicator(counted, "n", "Number of suppliers", None)


# ---------------------------------------------------------------- filters and checks

@query(f"""
WITH {REGISTRY}
SELECT c_custkey, entity_name, country FROM customer JOIN registry ON n_nationkey = c_nationkey
WHERE country IN ('Country 3', 'Country 8', 'Country 24') AND (entity_name IN ('NATION_3', 'NATION_8'))""")
def entity_filter_scalar(spark, sf_dir):
    reg = registry(spark, sf_dir)
    df = table(spark, sf_dir, "customer").select("c_custkey", iso3_of(F.col("c_nationkey")).alias("code"))
    df = R.enrich(df, reg, "code", "iso3")
    return X.filter_entities(df, reg, country=["Country 3", "Country 8", "Country 24"],
                             entity_name=["NATION_3", "NATION_8"]).select("c_custkey", "entity_name", "country")


@query("""
SELECT c_custkey, 'Country ' || c_nationkey || '|Country ' || (c_nationkey + c_custkey) % 25 AS countries FROM customer
WHERE c_nationkey IN (3, 8) OR (c_nationkey + c_custkey) % 25 IN (3, 8)""")
def entity_filter_array(spark, sf_dir):
    nation = F.col("c_nationkey")
    lists = F.array(country_of(nation), country_of((nation + F.col("c_custkey")) % 25), F.lit(None).cast("string"))
    df = table(spark, sf_dir, "customer").select("c_custkey", lists.alias("country"))
    df = X.filter_entities(df, registry(spark, sf_dir), country=["Country 3", "Country 8"])
    return df.select("c_custkey", F.array_join("country", "|").alias("countries"))


@query(f"""
WITH {REGISTRY}
SELECT s_suppkey, s_name, s_nationkey FROM supplier JOIN registry ON n_nationkey = s_nationkey
WHERE entity_id IS NOT NULL AND iso3 IN ('N02', 'N05', 'N11', 'N23') AND region IN ('ASIA', 'EUROPE', 'AFRICA')""")
def filter_to_source_keys(spark, sf_dir):
    df = table(spark, sf_dir, "supplier").withColumn("code", id_of(F.col("s_nationkey")))
    kept = X.restrict_to_keys(df, "code", registry(spark, sf_dir), {
        "iso3": ["N02", "N05", "N11", "N23"], "region": ["ASIA", "EUROPE", "AFRICA"]})
    return kept.select("s_suppkey", "s_name", "s_nationkey")


TYPE_LABELS = {"ECONOMY": "Economy range", "SMALL": "Small range", "PROMO": "Promoted", "LARGE": "MEDIUM"}


@query("""
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'Economy range' WHEN 'SMALL' THEN 'Small range'
       WHEN 'PROMO' THEN 'Promoted' WHEN 'LARGE' THEN 'MEDIUM' ELSE p_type END AS indicator
FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'PROMO', 'LARGE', 'MEDIUM')""")
def indicator_recode_allowlist(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("indicator"))
    return C.recode(df, "indicator", TYPE_LABELS)


@query("""
WITH codes AS (SELECT DISTINCT p_brand AS code, 'Label of ' || p_brand AS label FROM part WHERE p_size > 48 AND p_type = 'ECONOMY')
SELECT p_partkey, label AS brand FROM part JOIN codes ON code = p_brand""")
def indicator_recode_from_table(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    codes = part.where("p_size > 48 and p_type = 'ECONOMY'").select(
        F.col("p_brand").alias("code"), F.concat(F.lit("Label of "), "p_brand").alias("label")).distinct()
    df = part.select("p_partkey", F.col("p_brand").alias("brand"))
    return C.recode_from(df, "brand", codes)


MIXED_VALUES = """
mixed AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN CAST(p_size AS VARCHAR) WHEN 1 THEN p_name
  WHEN 2 THEN CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) WHEN 3 THEN '-' || p_size WHEN 4 THEN '' END AS value
  FROM part)"""


def mixed_values(spark, sf_dir):
    way = F.col("p_partkey") % 6
    value = (F.when(way == 0, F.col("p_size").cast("string")).when(way == 1, F.col("p_name"))
             .when(way == 2, money("p_retailprice").cast("string"))
             .when(way == 3, F.concat(F.lit("-"), F.col("p_size").cast("string"))).when(way == 4, F.lit("")))
    return table(spark, sf_dir, "part").select("p_partkey", value.alias("value"))


@query(f"""
WITH {MIXED_VALUES} SELECT p_partkey, CAST(value AS DOUBLE) AS value FROM mixed
WHERE regexp_matches(value, '^[0-9]+$')""")
def quantitative_only(spark, sf_dir):
    df = mixed_values(spark, sf_dir)
    return df.where(is_quantitative(F.col("value"))).withColumn("value", F.col("value").cast("double"))


@query(f"""
WITH {MIXED_VALUES} SELECT p_partkey, value FROM mixed WHERE value IS NULL OR NOT regexp_matches(value, '^[0-9]+$')""")
def qualitative_only(spark, sf_dir):
    return mixed_values(spark, sf_dir).where(~is_quantitative(F.col("value")))


@query(f"""
WITH {MIXED_VALUES} SELECT p_partkey, TRY_CAST(value AS DOUBLE) AS value FROM mixed
WHERE TRY_CAST(value AS DOUBLE) IS NOT NULL""")
def quantitative_any_number(spark, sf_dir):
    df = mixed_values(spark, sf_dir)
    return df.where(is_quantitative(F.col("value"), "any")).withColumn("value", F.col("value").cast("double"))


@query("""
SELECT o_orderkey, o_orderpriority AS indicator, CASE
  WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F' THEN 'Yes'
  WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O' THEN 'No'
  WHEN o_orderstatus = 'F' THEN 'True' WHEN o_orderstatus = 'O' THEN 'False' ELSE 'P' END AS value
FROM orders""")
def conditional_yes_no(spark, sf_dir):
    status = F.col("o_orderstatus")
    text = F.when(status == "F", F.lit("True")).when(status == "O", F.lit("False")).otherwise(F.lit("P"))
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("indicator"),
                                               text.alias("value"))
    return df.withColumn("value", yes_no(F.col("value"), F.col("indicator").isin("1-URGENT", "2-HIGH")))


@query("""
SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS year,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS day
FROM orders""")
def sentinel_to_null(spark, sf_dir):
    text = (F.when(F.col("o_orderstatus") == "P", F.lit("0001-01-01T00:00:00Z"))
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    df = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("start"))
    df = df.withColumn("start", timestamp_or_null(F.col("start"), "0001-01-01T00:00:00Z"))
    return df.select("o_orderkey", F.year("start").alias("year"), F.to_date("start").cast("string").alias("day"))


@query("""
SELECT p_partkey, 100.0 * round_even(p_retailprice / nullif((p_size - 11) * 100.0, 0), 0) AS funding FROM part""")
def ratio_rounded_pct(spark, sf_dir):
    requested = (F.col("p_size") - 11) * F.lit(100.0)
    return table(spark, sf_dir, "part").select(
        "p_partkey", rounded_percentage(F.col("p_retailprice"), requested).alias("funding"))


@query("""
SELECT p_partkey, small_size, cheap FROM (
  SELECT p_partkey, CASE WHEN p_size <= 20 THEN p_size END AS small_size,
         CASE WHEN p_retailprice < 1000 THEN p_type END AS cheap FROM part)
WHERE small_size IS NOT NULL OR cheap IS NOT NULL""")
def drop_all_null_rows(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") <= 20, F.col("p_size")).alias("small_size"),
        F.when(F.col("p_retailprice") < 1000, F.col("p_type")).alias("cheap"))
    return C.drop_empty_rows(df, ["small_size", "cheap"])


@query("""
SELECT p_partkey, CASE WHEN p_size <= 20 THEN p_size END AS small_size, p_brand FROM part""")
def drop_all_null_columns(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        "p_partkey", F.when(F.col("p_size") < 0, F.col("p_size")).alias("never"),
        F.when(F.col("p_size") <= 20, F.col("p_size")).alias("small_size"), "p_brand")
    return C.drop_empty_columns(df)


@query("""
SELECT nation, flag, count(code) AS n_codes FROM (
  SELECT CASE WHEN c_nationkey <> 5 THEN c_nationkey END AS nation,
         CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS flag,
         CASE WHEN c_acctbal > 0 THEN c_custkey END AS code FROM customer)
WHERE nation IS NOT NULL AND flag IS NOT NULL GROUP BY ALL""")
def drop_null_key_group_count(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_nationkey") != 5, F.col("c_nationkey")).alias("nation"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("flag"),
        F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).alias("code"))
    return C.count_per_entity(df, ["nation", "flag"], "code", "n_codes")


@query("""
SELECT o_orderkey, o_orderpriority, CAST(floor(o_totalprice) AS BIGINT) AS cents, 'fixed' AS label, '' AS description, '' AS url
FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') AND year(o_orderdate) IS NOT NULL""")
def column_operators(spark, sf_dir):
    df = K.rename_strict(table(spark, sf_dir, "orders"), {"o_totalprice": "price"})
    df = df.where(not_in(F.col("o_orderpriority"), ["1-URGENT", "5-LOW"]))
    df = C.drop_null_keys(K.drop_existing(df, ["not_there"]), ["o_orderdate"])
    df = K.add_constants(df.withColumn("cents", F.floor("price").cast("bigint")), label="fixed")
    df = K.index_first(K.add_missing(df, ["description", "url"]), ["o_orderpriority", "cents"],
                       index=["o_orderkey"])
    return K.conform(K.drop_strict(df, ["price", "o_custkey", "o_orderstatus", "o_orderdate"]),
                     ["o_orderkey", "o_orderpriority", "cents", "label", "description", "url"], "orders")


@query("""
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def invariant_checks(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.year("o_orderdate").cast("string"), F.lit(".0")).alias("year"),
        F.lit("public").alias("visibility"), F.when(F.col("o_orderkey") >= 0, F.lit("all")).alias("years"))
    df = C.require_equal(df, "visibility", "public", "not public")
    df = C.require_single_value(df, "years")
    return df.select("o_orderkey", strict_number(F.col("year")).alias("year"))


# ---------------------------------------------------------------- lists

@query(f"""
WITH {REGISTRY},
raw AS (SELECT o_orderkey, o_orderpriority, 'D' || lpad(CAST(o_custkey % 25 AS VARCHAR), 3, '0') || '; Country ' || o_custkey % 7
          || ',,DBE004 , nation ' || o_orderkey % 25 || ', X' || o_orderkey % 3 || ';OLD1' AS v FROM orders),
tok AS (SELECT o_orderkey, generate_subscripts(l, 1) AS pos, trim(unnest(l)) AS t
        FROM (SELECT o_orderkey, string_split(replace(v, ';', ','), ',') AS l FROM raw WHERE o_orderpriority <> '5-LOW')),
kept AS (SELECT o_orderkey, pos, CASE t WHEN 'OLD1' THEN 'D003' ELSE t END AS t FROM tok WHERE t NOT IN ('', 'DBE004')),
named AS (SELECT o_orderkey, string_agg(coalesce(i.entity_name, c.entity_name, e.entity_name, t), ', ' ORDER BY pos) AS names
  FROM kept LEFT JOIN registry i ON i.entity_id = t LEFT JOIN country_key c ON c.k = lower(t)
  LEFT JOIN entity_key e ON e.k = lower(t) GROUP BY o_orderkey)
SELECT raw.o_orderkey, coalesce(names, v) AS value FROM raw LEFT JOIN named ON named.o_orderkey = raw.o_orderkey""")
def delimited_list_resolve(spark, sf_dir):
    def text(c):
        return c.cast("string")
    orders = table(spark, sf_dir, "orders")
    value = F.concat(id_of(F.col("o_custkey") % 25), F.lit("; Country "), text(F.col("o_custkey") % 7),
                     F.lit(",,DBE004 , nation "), text(F.col("o_orderkey") % 25), F.lit(", X"),
                     text(F.col("o_orderkey") % 3), F.lit(";OLD1"))
    df = orders.select("o_orderkey", "o_orderpriority", value.alias("value"))
    df = L.resolve_id_text(df, registry(spark, sf_dir), "value", F.col("o_orderpriority") != "5-LOW",
                           invalid=("DBE004",), changed={"OLD1": "D003"})
    return df.select("o_orderkey", "value")


@query(f"""
WITH {REGISTRY},
ids AS (SELECT 'P' || p_partkey AS entity_id, p_name AS name FROM part),
raw AS (SELECT row_number() OVER () AS r, l_orderkey, l_linenumber, l_returnflag = 'R' AND l_linenumber = 7 AS wanted,
          CASE WHEN l_linenumber <> 6 THEN 'P' || l_partkey || ';X' || l_suppkey || ', Country ' || l_suppkey % 30 END AS v FROM lineitem),
tok AS (SELECT r, generate_subscripts(l, 1) AS pos, trim(unnest(l)) AS t
        FROM (SELECT *, string_split(replace(v, ';', ','), ',') AS l FROM raw WHERE wanted)),
country_name AS (SELECT k, coalesce(entity_id, entity_name) AS name FROM country_key WHERE entity_name IS NOT NULL),
named AS (SELECT r, string_agg(coalesce(i.name, c.name, t), ', ' ORDER BY pos) AS names
  FROM tok LEFT JOIN ids i ON i.entity_id = t LEFT JOIN country_name c ON c.k = lower(t) GROUP BY ALL)
SELECT raw.l_orderkey, raw.l_linenumber, coalesce(names, v) AS value
FROM raw LEFT JOIN named ON named.r = raw.r""")
def delimited_list_resolve_by_ids(spark, sf_dir):
    """Few rows list ids; their names come from a table of its own, the parts."""
    def text(c):
        return F.col(c).cast("string")
    ids = table(spark, sf_dir, "part").select(F.concat(F.lit("P"), text("p_partkey")).alias("entity_id"), F.col("p_name").alias("name"))
    value = F.concat(F.lit("P"), text("l_partkey"), F.lit(";X"), text("l_suppkey"), F.lit(", Country "),
                     (F.col("l_suppkey") % 30).cast("string"))
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                                 F.when(F.col("l_linenumber") != 6, value).alias("value"))
    wanted = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 7)
    return L.resolve_id_text(df, registry(spark, sf_dir), "value", wanted, id_names=ids).drop("l_returnflag")


@query(f"""
WITH {REGISTRY},
base AS (SELECT c_custkey, c_nationkey AS a, (c_nationkey + c_custkey) % 25 AS b FROM customer)
SELECT c_custkey, 'Country ' || a || '|Country ' || b || '|Nowhere' AS country,
       coalesce(x.entity_name, '~') || '|' || coalesce(y.entity_name, '~') || '|Nowhere' AS entity_name,
       x.iso3 || '|' || y.iso3 || '|Nowhere' AS iso3, x.region || '|' || y.region || '|Nowhere' AS region
FROM base JOIN registry x ON x.n_nationkey = a JOIN registry y ON y.n_nationkey = b""")
def array_element_enrich(spark, sf_dir):
    reg, nation = registry(spark, sf_dir), F.col("c_nationkey")
    lists = F.array(F.concat(F.lit("land "), nation.cast("string")),
                    F.upper(country_of((nation + F.col("c_custkey")) % 25)), F.lit("Nowhere"))
    df = table(spark, sf_dir, "customer").select("c_custkey", lists.alias("country"))
    df = L.enrich_list(L.resolve_list(df, reg, "country", errors="ignore"), reg, "country")
    return df.select("c_custkey", *[F.array_join(c, "|", "~").alias(c) for c in INDEX_COLUMNS])


@query("""
WITH tok AS (SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS t
             FROM (SELECT doc_id, string_split(text, ',') AS l FROM documents)),
kept AS (SELECT doc_id, pos, regexp_replace(regexp_replace(t, '^[\\s\\x{00A0}]+', ''), '[\\s\\x{00A0}]+$', '') AS t FROM tok)
SELECT d.doc_id, count(t) AS n_items, coalesce(string_agg(t, '|' ORDER BY pos), '') AS items
FROM documents d LEFT JOIN (SELECT * FROM kept WHERE lower(t) NOT IN ('de', 'the', 'of', 'und')) k ON k.doc_id = d.doc_id
GROUP BY d.doc_id""")
def list_clean_and_filter(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", F.split("text", ",").alias("items"))
    df = df.withColumn("items", clean_list(F.col("items"), ["DE", "The", "of", "und"]))
    return df.select("doc_id", F.size("items").cast("bigint").alias("n_items"), F.array_join("items", "|").alias("items"))


@query("""
SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Republic of Korea' WHEN 'MACHINERY' THEN 'Iran'
  WHEN 'FURNITURE' THEN 'Tanzania' ELSE c_mktsegment END || '|Country ' || c_nationkey AS countries
FROM customer""")
def comma_name_repair_split(spark, sf_dir):
    segment = F.col("c_mktsegment")
    first = (F.when(segment == "BUILDING", F.lit("Korea, Republic Of"))
             .when(segment == "MACHINERY", F.lit("Iran, Islamic Republic Of"))
             .when(segment == "FURNITURE", F.lit("Tanzania, United Republic Of")).otherwise(segment))
    df = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit(" Global, "), first, F.lit(" ,Africa, "), country_of(F.col("c_nationkey")),
                              F.lit(", -")).alias("countries"))
    df = L.split_and_clean(df, "countries", COMMA_COUNTRY_NAMES, LOCATIONS_NOT_COUNTRIES)
    return df.withColumn("countries", F.array_join("countries", "|"))


# ---------------------------------------------------------------- the unified table

UNIFIED = f"""
WITH {REGISTRY},
by_year AS (
  SELECT c_nationkey AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n,
         sum(CAST(o_totalprice AS DECIMAL(18,2))) AS total
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
segments AS (SELECT c_nationkey AS nation, c_mktsegment AS indicator, count(*) AS n FROM customer GROUP BY ALL),
grid AS (SELECT DISTINCT s.nation, t.indicator FROM segments s, (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY')) t(indicator)),
rows AS (
  SELECT nation, 'order count' AS indicator, CAST(n AS VARCHAR) AS value, year, '' AS description, 'orders' AS dataset FROM by_year
  UNION ALL SELECT nation, 'order total', CAST(total AS VARCHAR), year, 'sum of prices', 'orders' FROM by_year
  UNION ALL SELECT s_nationkey, 'supplier count', CAST(count(*) AS VARCHAR), NULL, '', 'suppliers' FROM supplier GROUP BY s_nationkey
  UNION ALL SELECT g.nation, g.indicator, CAST(coalesce(n, 0) AS VARCHAR), NULL, '', 'segments'
  FROM grid g LEFT JOIN segments s ON s.nation = g.nation AND s.indicator = g.indicator),
ranked AS (
  SELECT entity_name, country, iso3, region, indicator, value, year, description,
         'https://example.org/' || nation AS url, dataset,
         row_number() OVER (PARTITION BY dataset, entity_name, indicator
           ORDER BY year DESC NULLS LAST, TRY_CAST(value AS DOUBLE) NULLS LAST, value, country) AS rn
  FROM rows JOIN registry ON n_nationkey = nation)
"""


def unified_parts(spark, sf_dir):
    """Four indicator tables; each big table is aggregated before anything else happens to it."""
    customer = table(spark, sf_dir, "customer")
    # Per customer and year first: a customer with very many orders is a few rows before the join.
    per_customer = (table(spark, sf_dir, "orders")
                    .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
                    .agg(F.count("*").alias("n"), F.sum(money("o_totalprice")).alias("total")))
    by_year = (per_customer.join(customer, F.col("o_custkey") == F.col("c_custkey"))
               .groupBy(F.col("c_nationkey").alias("nation"), "year")
               .agg(F.sum("n").alias("order count"), F.sum("total").cast("decimal(28,2)").alias("order total")))
    orders = S.melt(by_year, ["nation", "year"]).withColumn(
        "description", F.when(F.col("indicator") == "order total", F.lit("sum of prices")).otherwise(F.lit("")))
    suppliers = S.to_indicator(
        table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation"))
        .agg(F.count("*").alias("n")), "n", "supplier count", None)
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    wide = customer.groupBy(F.col("c_nationkey").alias("nation")).agg(
        *[F.count_if(F.col("c_mktsegment") == s).alias(s) for s in names])
    segments = K.add_constants(S.melt(wide, ["nation"], names), year=None)
    reg = registry(spark, sf_dir)
    for label, df in (("orders", orders), ("suppliers", suppliers), ("segments", segments)):
        df = df.withColumns({"key": country_of(F.col("nation")), "url": F.concat(
            F.lit("https://example.org/"), F.col("nation").cast("string")), "year": F.col("year").cast("int")})
        df = R.enrich(K.add_missing(df, ["description"]), reg, "key", "country").drop("key", "nation")
        yield K.conform(df.withColumn("dataset", F.lit(label)), [
            *INDEX_COLUMNS, "indicator", "value", "year", "description", "url", "dataset"], label)


@query(UNIFIED + """
SELECT entity_name, country, iso3, region, indicator, value, year, description, url, dataset FROM ranked WHERE rn = 1""")
def unified_indicators_latest(spark, sf_dir):
    return combine(unified_parts(spark, sf_dir), latest=True)


@query(UNIFIED + """
SELECT entity_name, country, iso3, region, indicator, CAST(value AS DOUBLE) AS value, year, description, url, dataset
FROM ranked WHERE regexp_matches(value, '^[0-9]+$')""")
def unified_indicators_quantitative(spark, sf_dir):
    return combine(unified_parts(spark, sf_dir), quantitative=True, ordered=True)


# ---------------------------------------------------------------- keys, pages and snapshots as they come

@query("""
SELECT o_orderkey, o_orderstatus AS status, CASE WHEN o_orderkey % 2 = 0 THEN o_shown END AS total,
  CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 7 END AS clerk_n, CASE WHEN o_orderkey % 3 = 0 THEN o_custkey % 2 = 0 END AS clerk_ok,
  CASE WHEN o_orderkey % 5 = 0 THEN 'it''s "new"' END AS note, CAST(NULL AS VARCHAR) AS void
FROM (SELECT *, CAST(floor(o_totalprice) AS DOUBLE) + 0.5 AS o_shown FROM orders WHERE o_orderkey % 11 <> 0)
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, NULL FROM orders WHERE o_orderkey % 11 = 0""")
def dict_keys_discovered(spark, sf_dir):
    """Printed dictionaries whose keys differ from row to row; no schema is given."""
    key, price = F.col("o_orderkey"), F.floor("o_totalprice").cast("string")
    def part(when, *texts):
        return F.when(when, F.concat(*[F.lit(t) if isinstance(t, str) else t for t in texts])).otherwise(F.lit(""))
    ok = F.when(F.col("o_custkey") % 2 == 0, F.lit("True")).otherwise(F.lit("False"))
    words = F.concat(
        F.lit("{'status': '"), F.col("o_orderstatus"), F.lit("'"), part(key % 2 == 0, ", 'total': ", price, ".5"),
        part(key % 3 == 0, ", 'clerk': {'n': ", (F.col("o_custkey") % 7).cast("string"), ", 'ok': ", ok, "}"),
        part(key % 5 == 0, ", 'note': 'it\\'s \"new\"'"), part(key % 7 == 0, ", 'void': None"), F.lit("}"))
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.when(key % 11 != 0, words).alias("d"))
    out = S.expand_dict_columns(df, {"d": None}, drop=True, text="python")
    return out.toDF(*[c.removeprefix("d.").replace(".", "_") for c in out.columns])


@query("""SELECT c_custkey, c_name, c_nationkey FROM customer""")
def paged_rows_with_ledger(spark, sf_dir):
    """Customers landed as pages of one nation each, given back only if the pages that they announce are there once each."""
    customers = table(spark, sf_dir, "customer")
    count = customers.agg(F.count_distinct("c_nationkey")).scalar()
    place = customers.select("c_nationkey").distinct().select(
        F.col("c_nationkey").alias("of"), F.row_number().over(Window.orderBy("c_nationkey")).alias("page"))
    rows = customers.groupBy("c_nationkey").agg(F.collect_list(F.struct("c_custkey", "c_name", "c_nationkey")).alias("rows"))
    pages = rows.join(place, F.col("c_nationkey") == F.col("of")).select(F.concat(
        F.lit("["), F.to_json(F.struct("page", count.alias("pages"), F.lit("50").alias("per_page"))), F.lit(", "), F.to_json("rows"),
        F.lit("]")).alias("value"))
    return P.page_element_rows(pages, "value", "c_custkey BIGINT, c_name STRING, c_nationkey INT", metadata=0)


@query("""
SELECT c_custkey, c_nationkey, c_mktsegment, CAST(c_custkey % 5 AS INTEGER) AS five FROM customer""")
def snapshot_of_customers(spark, sf_dir):
    """The newest whole version of two, in the text form, its nested column read back by the keys it holds."""
    root = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp(prefix="snapshots-")
    root = f"{root}/snapshots-{uuid.uuid4().hex}"
    raw = table(spark, sf_dir, "customer").select("c_custkey", F.struct(
        "c_nationkey", "c_mktsegment", F.struct((F.col("c_custkey") % 5).cast("int").alias("five")).alias("more")).alias("about"))
    N.write_snapshot(raw.limit(0), root, "customer")
    N.write_snapshot(raw, root, "customer", text=True)
    back = S.expand_dict_columns(N.read_snapshot(spark, root, "customer"), {"about": None}, drop=True)
    return back.select("c_custkey", F.col("`about.c_nationkey`").cast("int").alias("c_nationkey"),
                       F.col("`about.c_mktsegment`").alias("c_mktsegment"), F.col("`about.more.five`").cast("int").alias("five"))
