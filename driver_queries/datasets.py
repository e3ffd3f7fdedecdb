"""One query per dataset. Raw tables of the shape each source has are derived row by row from the given tables."""

from pyspark.sql import functions as F

from indicatrix.operators.registry import enrich
from indicatrix.operators.reshape import union_by_name
from indicatrix.plans import collect, datasets as D
from indicatrix.plans.catalogue import filter_catalogue
from indicatrix.schemas import CATALOGUE_SCHEMA, INDEX_COLUMNS
from indicatrix.sources import pages as W, payloads as P

from .inputs import REGISTRY, country_of, id_of, iso3_of, money, query, registry, table
from .operators import YEARLY, yearly_counts
from .pages import listing_pages

PREFIX = "https://site.example.org/entity/"


def text(c):
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def latest_sql(source: str, keys: str = "entity_name, indicator", ties: str = "country, iso3, region") -> str:
    """SQL that keeps the latest row per key of a subquery."""
    return f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY year DESC NULLS LAST,
      TRY_CAST(value AS DOUBLE) NULLS LAST, value NULLS LAST, {ties}) AS rn FROM ({source})) WHERE rn = 1"""


# ---------------------------------------------------------------- databank

NO_ENTITY = ["DBE004", "NONE"]  # the tokens of the lists below that mean no entity


def databank_raw(spark, sf_dir):
    """One reported value per order; the order's priority plays the indicator code."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    code = (F.when(priority == "1-URGENT", F.lit("KPI_hasFinancialStatement")).when(priority == "2-HIGH", F.lit("ar"))
            .when(priority == "3-MEDIUM", F.lit("supported1"))
            .when(priority == "4-NOT SPECIFIED", F.lit("KPI_noLocalUnits")).otherwise(F.lit("unlisted")))
    flag = F.when(status == "F", F.lit("True")).when(status == "O", F.lit("False"))
    ids = F.concat(id_of(F.col("o_orderkey") % 25), F.lit("; Land "), text(F.col("o_custkey") % 7), F.lit(",DBE004, X1; NONE "))
    value = (F.when(priority.isin("1-URGENT", "2-HIGH"), flag).when(priority == "3-MEDIUM", ids)
             .otherwise(text(F.col("o_custkey") % 100)))
    return table(spark, sf_dir, "orders").select(
        code.alias("indicator"), id_of(F.col("o_custkey") % 25).alias("entity_id"), F.year("o_orderdate").alias("year"),
        value.alias("value"))


DATABANK = f"""
WITH {REGISTRY},
src AS (
  SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Financial statement available' WHEN '2-HIGH' THEN 'Annual report available'
      WHEN '3-MEDIUM' THEN 'Supported NSs' WHEN '4-NOT SPECIFIED' THEN 'Number of local units' END AS indicator,
    'D' || lpad(CAST(o_custkey % 25 AS VARCHAR), 3, '0') AS id, CAST(year(o_orderdate) AS INTEGER) AS year,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CASE o_orderstatus WHEN 'F' THEN 'Yes' WHEN 'O' THEN 'No' END
         WHEN o_orderpriority = '3-MEDIUM' THEN coalesce(a.entity_name, 'D' || lpad(CAST(o_orderkey % 25 AS VARCHAR), 3, '0'))
              || ', ' || b.entity_name || ', X1'
         ELSE CAST(o_custkey % 100 AS VARCHAR) END AS value
  FROM orders LEFT JOIN registry a ON a.entity_id = 'D' || lpad(CAST(o_orderkey % 25 AS VARCHAR), 3, '0')
  LEFT JOIN registry b ON b.n_nationkey = o_custkey % 7),
filled AS (
  SELECT entity_name, country, iso3, region, indicator, value, year, '{PREFIX}' || id AS url
  FROM src LEFT JOIN registry ON entity_id = id WHERE indicator IS NOT NULL AND value IS NOT NULL),
flags AS (
  SELECT *, row_number() OVER (PARTITION BY entity_name, indicator ORDER BY year DESC, url) AS rn FROM filled
  WHERE value = 'Yes')
SELECT * FROM filled
UNION ALL SELECT entity_name, country, iso3, region, CASE indicator WHEN 'Annual report available'
  THEN 'Year of latest annual report' ELSE 'Year of latest financial statement' END, CAST(year AS VARCHAR), year, url
FROM flags WHERE rn = 1"""


@query(DATABANK)
def databank_indicators(spark, sf_dir):
    return D.databank(databank_raw(spark, sf_dir), registry(spark, sf_dir), page_prefix=PREFIX, invalid_ids=NO_ENTITY)


@query(latest_sql(DATABANK, ties="country, iso3, region, url"))
def databank_indicators_latest(spark, sf_dir):
    return collect.dataset("databank", databank_raw(spark, sf_dir), registry(spark, sf_dir), latest=True,
                           options={"page_prefix": PREFIX, "invalid_ids": NO_ENTITY})


# ---------------------------------------------------------------- documents

def documents_payload(spark, sf_dir):
    """One payload per order, with two documents."""
    priority = F.col("o_orderpriority")
    kind = (F.when(priority == "1-URGENT", F.lit(" Our Annual Report ")).when(priority == "2-HIGH", F.lit("Our Emblem Law"))
            .when(priority == "3-MEDIUM", F.lit("Strategic Plan")).when(priority == "4-NOT SPECIFIED", F.lit("Other")))
    def document(kind, url):
        return F.struct(F.lit("n").alias("name"), kind.alias("document_type"), F.year("o_orderdate").alias("year"),
                        F.concat(F.lit(url), text("o_orderkey")).alias("url"))
    return table(spark, sf_dir, "orders").select(
        id_of(F.col("o_custkey") % 23).alias("code"),
        F.array(document(kind, "https://files.example.org/"), document(F.lit("Our Strategic Plan"), "plan/"))
        .alias("documents"))


DOCUMENTS = f"""
WITH {REGISTRY},
docs AS (
  SELECT o_custkey % 23 AS n, CASE o_orderpriority WHEN '1-URGENT' THEN 'Annual report' WHEN '2-HIGH' THEN 'Emblem law'
     WHEN '3-MEDIUM' THEN 'Strategic Plan' END AS indicator, 'https://files.example.org/' || o_orderkey AS value,
     CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
  UNION ALL SELECT o_custkey % 23, 'Strategic Plan', 'plan/' || o_orderkey, CAST(year(o_orderdate) AS INTEGER) FROM orders)
SELECT entity_name, country, iso3, region, indicator, value, year FROM docs JOIN registry ON n_nationkey = n
WHERE indicator IS NOT NULL"""


@query(DOCUMENTS)
def documents_indicators(spark, sf_dir):
    return D.documents(P.flatten_documents(documents_payload(spark, sf_dir)), registry(spark, sf_dir))


@query(latest_sql(DOCUMENTS))
def documents_indicators_latest(spark, sf_dir):
    return D.documents(P.flatten_documents(documents_payload(spark, sf_dir)), registry(spark, sf_dir), latest=True)


@query(f"""SELECT * FROM ({DOCUMENTS}) WHERE country IN ('Country 2', 'Country 4', 'Country 9') AND iso3 IN ('N02', 'N09')""")
def documents_filtered_at_source(spark, sf_dir):
    """Entity filters become source keys and reach the raw rows before they are processed."""
    return collect.dataset("documents", P.flatten_documents(documents_payload(spark, sf_dir)), registry(spark, sf_dir),
                           country=["Country 2", "Country 4", "Country 9"], iso3=["N02", "N09"])


# ---------------------------------------------------------------- contacts

def contacts_raw(spark, sf_dir):
    nation = text(F.col("c_nationkey") % 24)
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit(" Nation-"), nation).alias("NSO_DON_name"), F.concat(F.lit("Own "), nation).alias("country"),
        F.concat(F.lit("I"), nation).alias("iso_3"), F.lit("Zone").alias("NSO_ZON_name"),
        F.col("c_mktsegment").alias("cur_code"), F.col("c_name").alias("url"), F.lit(None).cast("string").alias("facebook"),
        F.lit("").alias("twitter"), text("c_custkey").alias("othersocial"))


CONTACTS = """
SELECT 'NATION_' || c_nationkey % 24 AS entity_name, 'Own ' || c_nationkey % 24 AS country,
  'I' || c_nationkey % 24 AS iso3, 'Zone' AS region, indicator,
  CASE indicator WHEN 'Currency' THEN c_mktsegment WHEN 'URL' THEN c_name WHEN 'Twitter' THEN ''
    WHEN 'Other social' THEN CAST(c_custkey AS VARCHAR) END AS value, CAST(NULL AS INTEGER) AS year
FROM customer, (VALUES ('Currency'), ('URL'), ('Facebook'), ('Twitter'), ('Other social')) t(indicator)"""


@query(CONTACTS)
def contacts_indicators(spark, sf_dir):
    return D.contacts(contacts_raw(spark, sf_dir), registry(spark, sf_dir))


# ---------------------------------------------------------------- assessments

def assessment_sheet(spark, sf_dir):
    """Rows are market segments, columns are nations with counts of customers; nation 24's column is a second
    assessment of nation 3."""
    nations = list(range(25))
    columns = [f"a{i}" for i in nations]
    customer = table(spark, sf_dir, "customer").select("c_mktsegment", "c_nationkey")
    counts = (customer.groupBy("c_mktsegment").pivot("c_nationkey", nations).agg(F.count(F.lit(1)))
              .toDF("segment", *columns))
    counts = counts.select(F.concat(F.lit("SEG_"), "segment").alias("Code"),
                           F.when(F.col("segment") != "MACHINERY", F.concat(F.lit(" "), "segment")).alias("Name"),
                           *[text(c).alias(c) for c in columns])
    nation = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")

    def head(label, value):
        wide = nation.groupBy().pivot("n_nationkey", nations).agg(F.max(value)).toDF(*columns)
        return wide.select(F.lit(None).cast("string").alias("Code"), F.lit(label).alias("Name"),
                           *[text(c).alias(c) for c in columns])
    name = F.when(key == 24, F.lit("nation  3")).otherwise(F.lower("n_name"))
    parts = [counts, head("National Society", name), head("Year", (key % 4 + 2015).cast("string")),
             head("Region", F.lit("source region")), head("SubRegion", F.lit(None).cast("string"))]
    sheet = parts[0]
    for part in parts[1:]:
        sheet = sheet.unionByName(part)
    return sheet


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "SEG_MACHINERY"]
ASSESSMENTS = f"""
WITH {REGISTRY},
counted AS (SELECT c_nationkey AS n, {", ".join(
    f"CAST(nullif(count(*) FILTER (c_mktsegment = '{s[-9:] if s.startswith('SEG_') else s}'), 0) AS VARCHAR) AS {s.lower()}"
    for s in SEGMENTS)} FROM customer GROUP BY c_nationkey)
SELECT r.entity_name, r.country, r.iso3, r.region, CAST(k.n_nationkey % 4 + 2015 AS INTEGER) AS year,
  {", ".join("coalesce(" + s.lower() + ", '-') AS " + s.lower() for s in SEGMENTS)}
FROM nation k JOIN registry r ON r.n_nationkey = CASE WHEN k.n_nationkey = 24 THEN 3 ELSE k.n_nationkey END
LEFT JOIN counted ON n = k.n_nationkey"""


def _segment_names(df):
    return df.select(*INDEX_COLUMNS, "year", *[F.coalesce(F.nullif(F.col(s), F.lit("0")), F.lit("-")).alias(s.lower())
                                               for s in SEGMENTS])


@query(ASSESSMENTS)
def capacity_assessments(spark, sf_dir):
    return _segment_names(D.capacity_assessments(assessment_sheet(spark, sf_dir), registry(spark, sf_dir),
                                                 indicators=SEGMENTS))


@query(f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_name ORDER BY year DESC) AS rn
FROM ({ASSESSMENTS})) WHERE rn = 1""")
def capacity_assessments_latest(spark, sf_dir):
    return _segment_names(D.capacity_assessments(assessment_sheet(spark, sf_dir), registry(spark, sf_dir), latest=True,
                                                 indicators=SEGMENTS))


@query(f"""
SELECT entity_name, country, iso3, region, year, concat_ws('|', {", ".join(
    f"CASE WHEN {x.lower()} <> '-' THEN '{x}=' || {x.lower()} END" for x in sorted(SEGMENTS))}) AS results FROM ({ASSESSMENTS})""")
def capacity_assessment_results(spark, sf_dir):
    """The dataset as it comes, its results a map: no label is named or read beforehand."""
    df = collect.dataset("capacity_assessments", assessment_sheet(spark, sf_dir), registry(spark, sf_dir))
    found = F.map_filter("results", lambda k, v: k.isin(SEGMENTS) & (v != "0"))
    return df.select(*INDEX_COLUMNS, "year", F.array_join(F.transform(
        F.array_sort(F.map_entries(found)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|").alias("results"))


def projects_by_country(spark, sf_dir):
    """Customers as rows of a sheet; some name a country that nobody knows, some none."""
    number = F.col("c_nationkey") + F.when(F.col("c_custkey") % 9 == 0, 100).otherwise(0)
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 13 != 0, F.concat(F.lit("land "), number.cast("string"))).alias("Country"),
        F.col("c_mktsegment").alias("Type"), F.lit("x").alias("Region"))


@query("""
SELECT 'Evaluations' AS dataset, count(*) FILTER (c_custkey % 9 = 0 AND c_custkey % 13 <> 0) AS unknown_rows, 0 AS null_rows FROM customer
UNION ALL SELECT 'Projects', count(*) FILTER (c_custkey % 9 = 0 AND c_custkey % 13 <> 0), count(*) FILTER (c_custkey % 13 = 0)
FROM customer""")
def datasets_with_warnings(spark, sf_dir):
    """How many rows of each dataset named what the registry does not know, counted while the datasets were computed."""
    raw = projects_by_country(spark, sf_dir)
    entries = [("Projects", "logistics_projects"), ("Evaluations", "evaluations")]
    about = {f.name: None for f in CATALOGUE_SCHEMA}
    catalogue = spark.createDataFrame([tuple({**about, "name": n, "kind": k, "archived": False}.values()) for n, k in entries], CATALOGUE_SCHEMA)
    lists = raw.select(F.concat(F.col("Country"), F.lit(", global")).alias("country"), F.col("Type").alias("title"))
    warnings = {}
    built = collect.datasets(catalogue, {"Projects": raw, "Evaluations": lists}, registry(spark, sf_dir), warnings=warnings)
    for found in built.values():
        found.write.format("noop").mode("overwrite").save()
    counted = [(name, c["unknown_rows"], c["null_rows"]) for name, w in warnings.items() for c in w.counts()]
    return spark.createDataFrame(counted, "dataset string, unknown_rows long, null_rows long")


def dates_raw(spark, sf_dir):
    """One assessment per supplier."""
    return table(spark, sf_dir, "supplier").select(
        F.lower(id_of(F.col("s_suppkey") % 23)).alias("NsId"), F.lit("x").alias("NsName"),
        F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("A"), text("s_suppkey"))).alias("AssementCode"),
        (2010 + F.col("s_suppkey") % 9).cast("int").alias("YearOfAssesment"), F.lit("2020-01-01").alias("SubmissionDate"),
        F.concat(F.lit("https://a.example.org/"), text("s_suppkey")).alias("URL"), F.col("s_name").alias("BranchName"))


def dates_sql(extra: str = "") -> str:
    return f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, CASE WHEN s_suppkey % 5 <> 0 THEN 'A' || s_suppkey END AS assessment_code,
  CAST(2010 + s_suppkey % 9 AS INTEGER) AS assessment_year, '2020-01-01' AS submission_date,
  'https://a.example.org/' || s_suppkey AS url {extra}
FROM supplier JOIN registry ON n_nationkey = s_suppkey % 23"""


@query(dates_sql())
def capacity_assessment_dates(spark, sf_dir):
    return D.capacity_assessment_dates(dates_raw(spark, sf_dir), registry(spark, sf_dir))


@query(dates_sql(", s_name AS branch_name"))
def branch_assessment_dates(spark, sf_dir):
    return D.branch_assessment_dates(dates_raw(spark, sf_dir), registry(spark, sf_dir))


# ---------------------------------------------------------------- operations and projects

def operations_pages(spark, sf_dir):
    """One result page per order, holding one operation."""
    key = F.col("o_orderkey")
    society = (F.when(key % 7 == 0, F.lit("")).when(key % 7 == 1, F.lit("null"))
               .otherwise(F.concat(F.lit("nation-"), text(key % 24))))
    country = F.when(society == "null", F.lit('{"name": "c", "society_name": null}')).otherwise(
        F.concat(F.lit('{"name": "c", "society_name": "'), society, F.lit('"}')))
    start = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    row = F.struct(
        F.concat(F.lit("Operation "), text(key)).alias("name"), F.col("o_orderpriority").alias("atype_display"),
        F.when(F.col("o_orderstatus") == "F", F.lit("Active")).otherwise(F.lit("Closed")).alias("status_display"),
        (F.col("o_custkey") % 1000).cast("int").alias("num_beneficiaries"),
        text(money("o_totalprice")).alias("amount_requested"), text((key % 40) * 10000).alias("amount_funded"),
        start.alias("start_date"), F.when(key % 3 == 0, F.lit(D.NO_DATE)).otherwise(start).alias("end_date"),
        F.concat(F.lit('{"name": "'), F.lower("o_orderpriority"), F.lit('", "id": 3}')).alias("dtype"),
        F.lit('{"id": 1, "region_name": "R"}').alias("region"), country.alias("country"))
    return table(spark, sf_dir, "orders").select(F.array(row).alias("results"))


@query(f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, 'Operation ' || o_orderkey AS operation_name, o_orderpriority AS operation_kind,
  CAST(o_custkey % 1000 AS INTEGER) AS beneficiaries, o_totalprice AS requested,
  CAST((o_orderkey % 40) * 10000 AS DOUBLE) AS funded, lower(o_orderpriority) AS disaster_type,
  100.0 * round_even(CAST((o_orderkey % 40) * 10000 AS DOUBLE) / nullif(o_totalprice, 0), 0) AS funding
FROM orders JOIN registry ON n_nationkey = o_orderkey % 24 WHERE o_orderstatus = 'F' AND o_orderkey % 7 > 1""")
def operations_active(spark, sf_dir):
    return D.operations(P.page_results(operations_pages(spark, sf_dir)), registry(spark, sf_dir))


@query(f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, 'Operation ' || o_orderkey AS operation_name, o_totalprice AS requested
FROM orders JOIN registry ON n_nationkey = o_orderkey % 24
WHERE o_orderstatus = 'F' AND o_orderkey % 7 > 1 AND iso3 IN ('N03', 'N11')""")
def operations_filtered_in_text(spark, sf_dir):
    """Two countries' operations from landed text: their key is looked at first, the rest of the other rows is never parsed. Some
    texts do not tell the key."""
    pages = P.page_results(operations_pages(spark, sf_dir))
    number = F.regexp_extract("name", r"(\d+)", 1).cast("long")
    told = F.concat(F.lit('{"iso3": "'), iso3_of(number % 24), F.lit('", '), F.substring("country", 2, 10_000))
    raw = pages.withColumn("country", F.when(number % 5 != 0, told).otherwise(F.col("country")))
    df = collect.dataset("operations", raw, registry(spark, sf_dir), iso3=["N03", "N11"])
    return df.select(*INDEX_COLUMNS, "operation_name", "requested")


def projects_raw(spark, sf_dir):
    def named(value):
        return F.concat(F.lit("{'name': '"), value, F.lit("', 'x': None}"))
    society = F.concat(F.lit("{'society_name': "), F.when(F.col("l_suppkey") % 9 == 0, F.lit("None")).otherwise(
        F.concat(F.lit("'NATION_"), text(F.col("l_suppkey") % 24), F.lit("'"))), F.lit(", 'ok': True}"))
    day = text(F.col("l_shipdate").cast("date"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("Project "), text("l_orderkey")).alias("name"), F.col("l_returnflag").alias("primary_sector_display"),
        F.col("l_linestatus").alias("programme_type_display"), F.lit("op").alias("operation_type_display"),
        F.lit("public").alias("visibility"), day.alias("start_date"), day.alias("end_date"),
        F.col("l_extendedprice").alias("budget_amount"), F.col("l_tax").alias("actual_expenditure"),
        F.col("l_quantity").alias("target_total"), F.col("l_linenumber").alias("reached_total"),
        society.alias("project_country_detail"), named(F.col("l_returnflag")).alias("dtype_detail"),
        named(F.lit("event")).alias("event_detail"), F.lit("{'society_name': 'z'}").alias("reporting_ns_detail"))


@query(f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, 'Project ' || l_orderkey AS project_name, l_returnflag AS disaster_type,
  'event' AS event_description, l_returnflag AS sector, l_linestatus AS programme_type, 'op' AS operation_type,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS start_date, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS end_date,
  l_extendedprice AS budget_amount, l_tax AS actual_expenditure, l_quantity AS target_total, l_linenumber AS reached_total
FROM lineitem JOIN registry ON n_nationkey = l_suppkey % 24 WHERE l_suppkey % 9 <> 0""")
def projects_public(spark, sf_dir):
    df = D.projects(projects_raw(spark, sf_dir), registry(spark, sf_dir), text="python")
    return df.withColumns({c: text(c) for c in ("start_date", "end_date")})


# ---------------------------------------------------------------- indexes by ISO3

def risk_raw(spark, sf_dir):
    key = F.col("c_custkey")
    code = F.when(key % 3 == 0, F.lit("INFORM")).when(key % 3 == 1, F.lit("INFORM Risk Index")).otherwise(F.lit("OTHER"))
    return table(spark, sf_dir, "customer").select(
        iso3_of(F.col("c_nationkey")).alias("Iso3"), code.alias("IndicatorId"), F.lit("n").alias("IndicatorName"),
        F.col("c_acctbal").alias("IndicatorScore"), F.lit(1).alias("nodelevel"), F.lit(2).alias("ValidityYear"),
        F.lit("u").alias("Unit"), F.lit("").alias("Note"), (2020 + key % 4).cast("int").alias("Year"))


RISK = f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, 'INFORM Risk Index' AS indicator, c_acctbal AS value,
  CAST(2020 + c_custkey % 4 AS INTEGER) AS year
FROM customer LEFT JOIN registry ON n_nationkey = c_nationkey AND entity_name IS NOT NULL WHERE c_custkey % 3 < 2"""


@query(RISK)
def risk_index(spark, sf_dir):
    return D.risk_index(risk_raw(spark, sf_dir), registry(spark, sf_dir))


@query(latest_sql(RISK))
def risk_index_latest(spark, sf_dir):
    return D.risk_index(risk_raw(spark, sf_dir), registry(spark, sf_dir), latest=True)


def development_raw(spark, sf_dir):
    priority = F.col("o_orderpriority")
    code = (F.when(priority == "1-URGENT", F.lit("SP.POP.TOTL")).when(priority == "2-HIGH", F.lit("NY.GDP.MKTP.CD"))
            .when(priority == "3-MEDIUM", F.lit("XX.OTHER")).otherwise(F.lit("SE.ADT.LITR.ZS")))
    label = F.when(F.col("o_orderkey") % 50 == 0, F.lit("null")).otherwise(F.lit('"label"'))
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit('{"id": "'), code, F.lit('", "value": '), label, F.lit("}")).alias("indicator"),
        F.lit('{"id": "XX", "value": "name"}').alias("country"),
        F.when(F.col("o_custkey") % 11 == 0, F.lit("WLD")).otherwise(iso3_of(F.col("o_custkey") % 25))
        .alias("countryiso3code"), text(F.year("o_orderdate")).alias("date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("value"), F.lit("").alias("unit"),
        F.lit("").alias("obs_status"), F.lit(0).alias("decimal"), F.lit("").alias("scale"))


DEVELOPMENT = f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, CASE o_orderpriority WHEN '1-URGENT' THEN 'Population, total'
  WHEN '2-HIGH' THEN 'GDP (US dollars)' ELSE 'Literacy rate, adult total (% of people ages 15 and above)' END AS indicator,
  o_totalprice AS value, CAST(year(o_orderdate) AS INTEGER) AS year
FROM orders JOIN registry ON n_nationkey = o_custkey % 25
WHERE o_custkey % 11 <> 0 AND entity_name IS NOT NULL AND o_orderstatus <> 'P' AND o_orderpriority <> '3-MEDIUM'
  AND o_orderkey % 50 <> 0"""


@query(DEVELOPMENT)
def development_indicators(spark, sf_dir):
    return D.development_indicators(development_raw(spark, sf_dir), registry(spark, sf_dir))


@query(latest_sql(DEVELOPMENT))
def development_indicators_latest(spark, sf_dir):
    return D.development_indicators(development_raw(spark, sf_dir), registry(spark, sf_dir), latest=True)


def perception_raw(spark, sf_dir):
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.lit("c").alias("country"), F.when(key % 13 == 0, F.lit("XXX")).otherwise(iso3_of(F.col("c_nationkey")))
        .alias("iso3"), F.lit("r").alias("region"), (2012 + key % 8).cast("int").alias("year"),
        (key % 100).cast("int").alias("score"), key.cast("int").alias("rank"), F.lit(5).alias("sources"),
        F.col("c_acctbal").alias("standardError"))


PERCEPTION = f"""
WITH {REGISTRY}
SELECT entity_name, country, coalesce(iso3, 'XXX') AS iso3, region, CAST(c_custkey % 100 AS INTEGER) AS score,
  CAST(c_custkey AS INTEGER) AS rank, 5 AS sources, c_acctbal AS standard_error, CAST(2012 + c_custkey % 8 AS INTEGER) AS year
FROM customer LEFT JOIN registry ON n_nationkey = c_nationkey AND c_custkey % 13 <> 0"""


@query(PERCEPTION)
def corruption_perception(spark, sf_dir):
    return D.corruption_perception(perception_raw(spark, sf_dir), registry(spark, sf_dir))


PERCEPTION_LATEST = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_name ORDER BY year DESC NULLS LAST,
  country NULLS LAST, iso3 NULLS LAST, region NULLS LAST, score, rank) AS rn FROM ({PERCEPTION})) WHERE rn = 1"""


@query(PERCEPTION_LATEST)
def corruption_perception_latest(spark, sf_dir):
    return D.corruption_perception(perception_raw(spark, sf_dir), registry(spark, sf_dir), latest=True)


def human_raw(spark, sf_dir):
    """Nested maps of yearly counts, as JSON text: one text per indicator, with at most 25 codes of a few years."""
    def as_map(key, value):
        return F.map_from_entries(F.collect_list(F.struct(text(key), F.col(value))))
    yearly = yearly_counts(spark, sf_dir)
    code = F.concat(F.lit("N"), F.substring("entity_id", 3, 2))
    inner = yearly.groupBy("indicator", code.alias("code")).agg(as_map("year", "n").alias("m1"))
    outer = inner.groupBy("indicator").agg(as_map("code", "m1").alias("m2"))
    name = F.when(F.col("indicator") == "1-URGENT", F.lit("137506")).otherwise(F.col("indicator"))
    body = outer.select(F.to_json(F.create_map(name, "m2")).alias("body"))
    return P.flatten_maps(body, "body")


HUMAN = f"""
WITH {REGISTRY}, {YEARLY}
SELECT entity_name, country, iso3, region, 'Human Development Index (HDI)' AS indicator, CAST(n AS DOUBLE) AS value,
  CAST(year AS INTEGER) AS year
FROM yearly JOIN registry ON iso3 = 'N' || substr(yearly.entity_id, 3, 2)
WHERE indicator = '1-URGENT' AND entity_name IS NOT NULL"""


@query(HUMAN)
def human_development(spark, sf_dir):
    return D.human_development(human_raw(spark, sf_dir), registry(spark, sf_dir))


@query(latest_sql(HUMAN))
def human_development_latest(spark, sf_dir):
    return D.human_development(human_raw(spark, sf_dir), registry(spark, sf_dir), latest=True)


# ---------------------------------------------------------------- web pages

def presence_raw(spark, sf_dir):
    key = F.col("s_suppkey")
    name = F.when(key % 10 == 0, F.lit("Sahel")).otherwise(F.concat(F.lit("Land "), text(F.col("s_nationkey"))))
    return table(spark, sf_dir, "supplier").select(
        name.alias("country"), (key % 2 == 0).alias("presence"), (key % 3 == 0).alias("key_operation"),
        F.when(key % 2 == 0, F.col("s_name")).alias("url"), F.lit(None).cast("string").alias("description"))


PRESENCE = f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, s_suppkey % 2 = 0 AS presence, s_suppkey % 3 = 0 AS key_operation,
  CASE WHEN s_suppkey % 2 = 0 THEN s_name END AS url, CAST(NULL AS VARCHAR) AS description
FROM supplier JOIN registry ON n_nationkey = s_nationkey WHERE s_suppkey % 10 <> 0"""


@query(PRESENCE)
def field_presence(spark, sf_dir):
    return D.field_presence(presence_raw(spark, sf_dir), registry(spark, sf_dir))


def law_raw(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select(
        F.upper(country_of(F.col("s_nationkey"))).alias("country"), text("s_suppkey").alias("law_id"),
        F.concat(F.lit("https://l.example.org/"), text("s_suppkey")).alias("url"), F.col("s_name").alias("description"))


LAW = f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, CAST(s_suppkey AS VARCHAR) AS law_id,
  'https://l.example.org/' || s_suppkey AS url, s_name AS description
FROM supplier JOIN registry ON n_nationkey = s_nationkey"""


@query(LAW)
def disaster_law(spark, sf_dir):
    return D.disaster_law(law_raw(spark, sf_dir), registry(spark, sf_dir))


YOUTH_CSV = ("`National Society` STRING, Region STRING, Year STRING, `Youth Policy` STRING, "
             "`Youth Engagement Strategy` STRING, `Youth in GB` STRING, `Youth-led structure` STRING")


def youth_raw(spark, sf_dir):
    """One survey payload per supplier: CSV text inside JSON, with a header, a type line and one answer."""
    line = F.concat(F.lit("nation-"), text(F.col("s_nationkey") % 24), F.lit(",R,"), text(2015 + F.col("s_suppkey") % 5),
                    F.lit('.0,Yes,"No, not yet",'), F.col("s_name"), F.lit(',,more'))
    csv = F.concat(F.lit("National Society,Region,Year,a,b,c,d,e\nstring,string,number,string,string,string,string,x\n"),
                   line)
    body = F.to_json(F.struct(F.struct(csv.alias("csv")).alias("data")))
    field = table(spark, sf_dir, "supplier").select(F.get_json_object(body, "$.data.csv").alias("csv"))
    return P.embedded_csv(field, "csv", YOUTH_CSV)


YOUTH = f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, CAST(2015 + s_suppkey % 5 AS INTEGER) AS year, 'Yes' AS youth_policy,
  'No, not yet' AS youth_strategy, s_name AS youth_in_board, CAST(NULL AS VARCHAR) AS youth_led
FROM supplier JOIN registry ON n_nationkey = s_nationkey % 24"""


@query(YOUTH)
def youth_engagement(spark, sf_dir):
    return D.youth_engagement(youth_raw(spark, sf_dir), registry(spark, sf_dir))


def evaluations_raw(spark, sf_dir):
    key = F.col("c_custkey")
    places = F.concat(F.lit("Global, "), country_of(F.col("c_nationkey")), F.lit(", land "), text(key % 25), F.lit(" ,-"))
    return table(spark, sf_dir, "customer").select(
        F.when(key % 20 == 0, F.lit("Africa")).otherwise(places).alias("country"), F.col("c_name").alias("title"))


@query(f"""
WITH {REGISTRY}
SELECT c_name AS title, CASE WHEN c_custkey % 20 = 0 THEN '' ELSE x.country || '|' || y.country END AS country,
  CASE WHEN c_custkey % 20 = 0 THEN '' ELSE coalesce(x.entity_name, '~') || '|' || coalesce(y.entity_name, '~') END AS entity_name,
  CASE WHEN c_custkey % 20 = 0 THEN '' ELSE x.iso3 || '|' || y.iso3 END AS iso3,
  CASE WHEN c_custkey % 20 = 0 THEN '' ELSE x.region || '|' || y.region END AS region
FROM customer JOIN registry x ON x.n_nationkey = c_nationkey JOIN registry y ON y.n_nationkey = c_custkey % 25""")
def evaluations(spark, sf_dir):
    df = D.evaluations(evaluations_raw(spark, sf_dir), registry(spark, sf_dir))
    return df.select("title", *[F.array_join(c, "|", "~").alias(c) for c in INDEX_COLUMNS])


@query(f"""
WITH {REGISTRY}
SELECT 'https://site.example.org/eval/' || page_id AS url, r.country, r.entity_name, r.iso3
FROM pages JOIN registry r ON n_nationkey = page_id % 23""")
def evaluations_from_pages(spark, sf_dir):
    listing = W.evaluation_listing(listing_pages(table(spark, sf_dir, "pages")), "https://site.example.org")
    df = D.evaluations(listing, registry(spark, sf_dir))
    return df.select("url", F.explode(F.arrays_zip("country", "entity_name", "iso3")).alias("z")).select("url", "z.*")


# ---------------------------------------------------------------- sheets

def sheet_raw(spark, sf_dir, titles):
    """One sheet row per supplier, every eleventh of them blank."""
    blank = F.col("s_suppkey") % 11 == 0
    def cell(c):
        return F.when(~blank, c)
    country = F.concat(F.lit(" Land  "), text("s_nationkey"))
    values = [country, F.lit("x"), F.col("s_name"), text("s_suppkey"), F.lit("k"), F.lit("c")]
    return table(spark, sf_dir, "supplier").select(*[cell(v).alias(t) for t, v in zip(titles, values)])


def sheet_sql(columns: str) -> str:
    return f"""
WITH {REGISTRY}
SELECT entity_name, country, iso3, region, {columns} FROM supplier JOIN registry ON n_nationkey = s_nationkey
WHERE s_suppkey % 11 <> 0"""


@query(sheet_sql("'x' AS answer_a, s_name AS answer_b"))
def statutes(spark, sf_dir):
    raw = sheet_raw(spark, sf_dir, ["National Society (NS)", "answer_a", "answer_b"])
    return D.statutes(raw, registry(spark, sf_dir))


@query(sheet_sql("'x' AS recognition_law"))
def recognition_laws(spark, sf_dir):
    raw = sheet_raw(spark, sf_dir, ["National Society (NS)", "Law/other regulations in force"])
    return D.recognition_laws(raw, registry(spark, sf_dir))


@query(sheet_sql("'x' AS trainings, CAST(s_suppkey AS VARCHAR) AS peer_educators, 'k' AS trainers, 'c' AS comment"))
def youth_trainings(spark, sf_dir):
    raw = sheet_raw(spark, sf_dir, ["Country", "number of YABC trainings to date", "unused", "peer educators", "trainers",
                                    "Comment"]).withColumn("empty", F.lit(None).cast("string"))
    total = raw.limit(0).unionByName(raw.agg(F.count("*").cast("string").alias("n")).select(
        F.lit("TOTAL").alias("Country"), *[F.col("n").alias(c) for c in raw.columns[1:-1]],
        F.lit(None).cast("string").alias("empty")))
    return D.youth_trainings(raw.unionByName(total), registry(spark, sf_dir))


@query(sheet_sql("'x' AS \"Type\", s_name AS \"Indicator\""))
def logistics_projects(spark, sf_dir):
    raw = sheet_raw(spark, sf_dir, ["Country", "Type", "Indicator"]).withColumn("Region", F.lit("source region"))
    return D.logistics_projects(raw.withColumn("Region", F.when(F.col("Country").isNotNull(), F.col("Region"))),
                                registry(spark, sf_dir))


# ---------------------------------------------------------------- catalogue and collection

CATALOGUE_ROWS = [
    # name, kind, type, privacy, link, label, archived
    ("Contacts", "contacts", "internal", "public", None, None, False),
    ("Capacity Dates", "capacity_assessment_dates", "Internal", "public", None, "Dates", False),
    ("Branch Dates", "branch_assessment_dates", "Internal", "public", None, "Branches", False),
    ("Presence", "field_presence", "External", "public", None, "Is present", False),
    ("Law", "disaster_law", "External", "public", None, None, False),
    ("Perception", "corruption_perception", "external", "public", None, None, False),
    ("Youth", "youth_engagement", "internal", "public", "https://y.example.org", None, False),
    ("Statutes", "statutes", "Internal", "confidential", None, None, False),
    ("Databank", "databank", "Internal", "public", None, None, False),
    ("Documents", "documents", "internal", "public", None, None, False),
    ("Risk", "risk_index", "external", "public", None, None, False),
    ("Development", "development_indicators", "external", "public", None, None, False),
    ("Human", "human_development", "External", "public", None, None, True),
]


def catalogue(spark):
    rows = [(name, kind, "file", None, type_, privacy, link, None, label, archived)
            for name, kind, type_, privacy, link, label, archived in CATALOGUE_ROWS]
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


def raw_tables(spark, sf_dir):
    sheet = sheet_raw(spark, sf_dir, ["National Society (NS)", "answer_a", "answer_b"])
    return {"Contacts": contacts_raw(spark, sf_dir), "Capacity Dates": dates_raw(spark, sf_dir),
            "Branch Dates": dates_raw(spark, sf_dir), "Presence": presence_raw(spark, sf_dir),
            "Law": law_raw(spark, sf_dir), "Perception": perception_raw(spark, sf_dir),
            "Youth": youth_raw(spark, sf_dir), "Statutes": sheet, "Databank": databank_raw(spark, sf_dir),
            "Documents": P.flatten_documents(documents_payload(spark, sf_dir)), "Risk": risk_raw(spark, sf_dir),
            "Development": development_raw(spark, sf_dir)}


OPTIONS = {"Databank": {"page_prefix": PREFIX, "invalid_ids": NO_ENTITY}}


@query("""
SELECT p_name AS name, p_type AS source, CASE WHEN p_size % 2 = 0 THEN 'Internal' ELSE 'external' END AS type
FROM part WHERE p_size % 2 = 0 AND p_size % 3 = 0""")
def catalogue_filter(spark, sf_dir):
    """A catalogue of one dataset per part."""
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"), F.lit("contacts").alias("kind"), F.col("p_type").alias("source"),
        F.when(size % 2 == 0, F.lit("Internal")).otherwise(F.lit("external")).alias("type"),
        F.when(size % 3 == 0, F.lit("Public")).otherwise(F.lit("confidential")).alias("privacy"))
    return filter_catalogue(rows, {"Type": "INTERNAL", "privacy": "public"}).select("name", "source", "type")


@query(f"""
SELECT 'Contacts' AS dataset, entity_name, country, indicator AS what, value FROM ({CONTACTS})
UNION ALL SELECT 'Presence', entity_name, country, url, CAST(presence AS VARCHAR) FROM ({PRESENCE})
UNION ALL SELECT 'Law', entity_name, country, law_id, description FROM ({LAW})""")
def dataset_selection(spark, sf_dir):
    """Names in any case; an unknown and an archived dataset are skipped."""
    built = collect.datasets(catalogue(spark), raw_tables(spark, sf_dir), registry(spark, sf_dir),
                             names=[" contacts", "LAW", "Presence", "Nothing", "Human"], filters={"privacy": "public"})
    shown = {"Contacts": ("indicator", "value"), "Law": ("law_id", "description"), "Presence": ("url", "presence")}
    return union_by_name([
        df.select(F.lit(name).alias("dataset"), "entity_name", "country", F.col(shown[name][0]).alias("what"),
                  F.col(shown[name][1]).cast("string").alias("value")) for name, df in built.items()])


@query(f"""
WITH {REGISTRY}
SELECT 'N' || lpad(CAST(c_custkey % 30 AS VARCHAR), 2, '0') AS unknown_value, count(*) AS n_rows FROM customer
WHERE c_custkey % 30 >= 25 GROUP BY 1""")
def dataset_unknown_entities(spark, sf_dir):
    """What the registry does not know, asked of a dataset that lets unknown codes pass."""
    raw = table(spark, sf_dir, "customer").select(iso3_of(F.col("c_custkey") % 30).alias("iso3"))
    return collect.unknown_entities("corruption_perception", raw, registry(spark, sf_dir))


@query(f"""
SELECT entity_name, country, title, iso3 FROM (
  SELECT entity_name, country, iso3, c_name AS title FROM (WITH {REGISTRY} SELECT r.*, c_name FROM customer
    JOIN registry r ON n_nationkey = c_nationkey)) WHERE iso3 IN ('N03', 'N05') AND country = 'Country 5'""")
def dataset_for_entities(spark, sf_dir):
    """A user-defined dataset function, filtered by entity."""
    raw = table(spark, sf_dir, "customer").select(iso3_of(F.col("c_nationkey")).alias("code"), F.col("c_name").alias("title"))
    df = collect.dataset(lambda raw, reg: enrich(raw, reg, "code", "iso3"), raw, registry(spark, sf_dir),
                         iso3=["N03", "N05"], country="Country 5")
    return df.select("entity_name", "country", "title", "iso3")


UNIFIED = f"""
SELECT entity_name, country, iso3, region, indicator, value, year, '' AS description, '' AS url, 'Contacts' AS dataset FROM ({CONTACTS})
UNION ALL SELECT entity_name, country, iso3, region, 'Dates', CAST(assessment_year AS VARCHAR), NULL, '', url, 'Capacity Dates' FROM ({dates_sql()})
UNION ALL SELECT entity_name, country, iso3, region, 'Branches', CAST(count(assessment_code) AS VARCHAR), NULL, '', '', 'Branch Dates'
  FROM ({dates_sql()}) GROUP BY entity_name, country, iso3, region
UNION ALL SELECT entity_name, country, iso3, region, 'Is present', CASE WHEN presence THEN 'True' ELSE 'False' END, 2024, description, url, 'Presence' FROM ({PRESENCE})
UNION ALL SELECT entity_name, country, iso3, region, 'Law', description, 2024, '', url, 'Law' FROM ({LAW})
UNION ALL SELECT entity_name, country, iso3, region, 'Corruption Perception Index', CAST(score AS VARCHAR), year, '', '', 'Perception' FROM ({PERCEPTION})
UNION ALL SELECT entity_name, country, iso3, region, indicator, CASE indicator WHEN 'Youth Policy' THEN youth_policy
  WHEN 'Youth Engagement Strategy' THEN youth_strategy WHEN 'Youth in GB' THEN youth_in_board ELSE youth_led END, year, '', 'https://y.example.org', 'Youth'
  FROM ({YOUTH}), (VALUES ('Youth Policy'), ('Youth Engagement Strategy'), ('Youth in GB'), ('Youth-led structure')) t(indicator)
UNION ALL SELECT entity_name, country, iso3, region, indicator, value, year, '', url, 'Databank' FROM ({DATABANK})
UNION ALL SELECT entity_name, country, iso3, region, indicator, value, year, '', '', 'Documents' FROM ({DOCUMENTS})
UNION ALL SELECT entity_name, country, iso3, region, indicator, CAST(value AS VARCHAR), year, '', '', 'Risk' FROM ({RISK})
UNION ALL SELECT entity_name, country, iso3, region, indicator, CAST(value AS VARCHAR), year, '', '', 'Development' FROM ({DEVELOPMENT})"""

# scores take their latest row as a dataset, before the unified rule
LATEST_UNIFIED = latest_sql(UNIFIED.replace(f"({PERCEPTION})", f"({PERCEPTION_LATEST})"), "dataset, entity_name, indicator", "country, iso3, region, description, url")


@query(UNIFIED)
def collected_indicators(spark, sf_dir):
    return collect.indicators(catalogue(spark), raw_tables(spark, sf_dir), registry(spark, sf_dir), as_of="2024-05-01",
                              options=OPTIONS)


@query(f"""SELECT * FROM ({UNIFIED}) WHERE value IS NULL OR NOT regexp_matches(value, '^[0-9]+$')""")
def collected_indicators_qualitative(spark, sf_dir):
    return collect.indicators(catalogue(spark), raw_tables(spark, sf_dir), registry(spark, sf_dir), as_of="2024-05-01",
                              quantitative=False, options=OPTIONS)


@query(LATEST_UNIFIED)
def collected_indicators_latest(spark, sf_dir):
    return collect.indicators(catalogue(spark), raw_tables(spark, sf_dir), registry(spark, sf_dir), as_of="2024-05-01",
                              latest=True, options=OPTIONS)


@query(f"""SELECT * REPLACE (CAST(value AS DOUBLE) AS value) FROM ({UNIFIED}) WHERE regexp_matches(value, '^[0-9]+$')""")
def collected_indicators_quantitative(spark, sf_dir):
    return collect.indicators(catalogue(spark), raw_tables(spark, sf_dir), registry(spark, sf_dir), as_of="2024-05-01",
                              quantitative=True, options=OPTIONS)
