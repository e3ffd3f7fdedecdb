"""The datasets: each function turns a raw table into index columns plus measures, as one lazy plan.

Every function takes ``(raw, registry, latest=False, **options)``. Input column names are those of the sources.
"""

from pyspark.sql import DataFrame, functions as F

from ..functions.text import strip
from ..functions.values import (
    differs, not_in, rounded_percentage, strict_number, timestamp_or_null, yes_no)
from ..operators.checks import (
    drop_empty_columns, drop_empty_rows, drop_null_keys, recode, require_equal)
from ..operators.columns import drop_existing, drop_strict, index_first, quoted, rename, rename_strict
from ..operators.latest import latest_indicators, latest_per_entity, latest_year_rows
from ..operators.lists import enrich_list, resolve_id_text, resolve_list, split_and_clean
from ..operators.registry import Registry, enrich, resolve_names
from ..operators.reshape import expand_dict_columns, melt, transpose, transpose_map
from ..schemas import INDEX_COLUMNS

INDICATOR_ROW = INDEX_COLUMNS + ["indicator", "value", "year"]

# Flag indicators of the databank and the derived indicator each one feeds.
LATEST_YEAR_LABELS = {
    "KPI_hasFinancialStatement": "Year of latest financial statement",
    "audited": "Year of latest audited financial statement",
    "ar": "Year of latest annual report",
    "sp": "Year of latest strategic plan",
}

# Databank indicator codes and their published names.
DATABANK_LABELS = {
    "KPI_noLocalUnits": "Number of local units",
    "KPI_hasFinancialStatement": "Financial statement available",
    "audited": "Audited financial statement available",
    "KPI_IncomeLC": "Total income in local currency",
    "KPI_IncomeLC_CHF": "Total income (Swiss Franc)",
    "KPI_PeopleVol_Tot": "Total number of people volunteering",
    "KPI_noVolCoveredAI_Tot": "Total number of volunteers covered by accident insurance",
    "KPI_PStaff_Tot": "Total number of paid staff",
    "KPI_PStaffCoveredAI_Tot": "Total number of paid staff covered by accident insurance",
    "ar": "Annual report available",
    "sp": "Strategic plan available",
    "supported1": "Supported NSs",
    "received_support1": "Received support from NSs",
    "KPI_ReachDRER_CPD": "Total number of people reached by disaster response and early recovery programmes",
    "KPI_ReachLTSPD_CPD": "Total number of people reached by long term services and development programmes",
    "KPI_ReachDRR_CPD": "Total number of people reached by disaster risk reduction",
    "KPI_ReachS_CPD": "Total number of people reached by shelter",
    "KPI_ReachL_CPD": "Total number of people reached by livelihoods",
    "KPI_ReachH_CPD": "Total number of people reached by health",
    "KPI_ReachWASH_CPD": "Total number of people reached by water, sanitation and hygiene",
    "KPI_ReachM_CPD": "Total number of people reached by migration",
    "KPI_ReachCTP_CPD": "Total number of people reached by cash transfer programming",
    "KPI_ReachSI_CPD":
        "Total number of people reached by social inclusion and building a culture of non-violence and peace",
    "Year of latest financial statement": "Year of latest financial statement",
    "Year of latest audited financial statement": "Year of latest audited financial statement",
    "Year of latest annual report": "Year of latest annual report",
    "Year of latest strategic plan": "Year of latest strategic plan",
}

# Indicators whose value lists entity ids, one mistyped answer, ids that changed.
ID_LIST_INDICATORS = ["supported1", "received_support1"]
MISTYPED_ANSWER = ("One of our staff was sent for support to DRC-Congo on a surge",
                   "Red Cross of the Democratic Republic of the Congo")
CHANGED_IDS = {"DCS001": "DRS001"}

# Document types and their published names.
DOCUMENT_LABELS = {
    "Our Annual Report": "Annual report",
    "Our Audited Financial Statements": "Financial statement (audited)",
    "Our Strategic Plan": "Strategic Plan",
    "Our Unaudited Financial Statement": "Financial statement (unaudited)",
    "Our Red Cross Law": "Red Cross law",
    "Our Statutes in Force": "Statutes in force",
    "Our Emblem Law": "Emblem law",
}

# Development indicator codes and their published names.
DEVELOPMENT_LABELS = {
    "SP.POP.TOTL": "Population, total",
    "NY.GDP.MKTP.CD": "GDP (US dollars)",
    "SI.POV.NAHC": "Poverty headcount ratio at national poverty lines (% of population)",
    "NY.GNP.PCAP.CD": "GNI per capita, Atlas method (current US$)",
    "SP.DYN.LE00.IN": "Life expectancy at birth, total years",
    "SE.ADT.LITR.ZS": "Literacy rate, adult total (% of people ages 15 and above)",
    "SP.URB.TOTL.IN.ZS": "Urban population (% of total)",
}

# Single-code recodings.
RISK_LABELS = {"INFORM": "INFORM Risk Index"}
HUMAN_DEVELOPMENT_LABELS = {"137506": "Human Development Index (HDI)"}

# Contact fields, in the order of the source, and the indicator each one becomes.
CONTACT_LABELS = {
    "cur_code": "Currency", "url": "URL", "facebook": "Facebook", "twitter": "Twitter", "othersocial": "Other social",
}

# Assessment sheet rows that are not results.
ASSESSMENT_ROWS_DROPPED = [
    "iso", "Region", "SubRegion", "Month", "Version", "Principal facilitator", "Second facilitator",
    "NS Focal point", "OCAC data public", "OCAC report public",
]

# Regional items of the presence list.
PRESENCE_NOT_COUNTRIES = ["Lake Chad", "Sahel", "test"]

# Country names that contain commas (applied in this order), and locations that are not countries.
COMMA_COUNTRY_NAMES = {
    "Korea, Republic Of": "Republic of Korea",
    "Iran, Islamic Republic Of": "Iran",
    "Moldova, Republic Of": "Moldova",
    "Taiwan, Province of China": "Taiwan",
    "Congo, The Democratic Republic Of The": "Democratic Republic of the Congo",
    "Korea, Democratic People'S Republic Of": "Democratic people's republic of Korea",
    "Palestinian Territory, Occupied": "Palestine",
    "Micronesia, Federated States Of": "Micronesia",
    "Tanzania, United Republic Of": "Tanzania",
}
LOCATIONS_NOT_COUNTRIES = [
    "-", "nan", "global", "europe", "middle east and north africa", "africa", "asia pacific", "americas",
]

# Text a source writes for "no date".
NO_DATE = "0001-01-01T00:00:00Z"


def databank(raw: DataFrame, registry: Registry, latest: bool = False, page_prefix: str = "", id_names=None,
             invalid_ids=None, changed_ids=None) -> DataFrame:
    """Databank indicators from (indicator, entity_id, year, value) rows.

    ``page_prefix`` is put before the entity id to form the url. ``invalid_ids`` are the tokens that this source's id lists
    hold without meaning an entity; they must be given (an empty list if there are none). The latest-year rows are made
    from the flag indicators alone, which reaches the scan; id lists are resolved once.
    """
    if invalid_ids is None:
        raise ValueError("databank needs invalid_ids: the tokens to leave out of id lists")
    df = drop_null_keys(raw, ["value", "year", "indicator"])
    df = df.withColumn("url", F.concat(F.lit(page_prefix), F.col("entity_id")))
    flags = enrich(df.where(F.col("indicator").isin(list(LATEST_YEAR_LABELS))), registry, "entity_id", "entity_id")
    flags = flags.drop("entity_id").withColumn("value", yes_no(F.col("value"), F.lit(True)))
    years = latest_year_rows(flags, LATEST_YEAR_LABELS, ties=["url"])
    df = enrich(df, registry, "entity_id", "entity_id").drop("entity_id")
    df = df.replace({MISTYPED_ANSWER[0]: MISTYPED_ANSWER[1]}, subset=["value"])
    df = resolve_id_text(df, registry, "value", F.col("indicator").isin(ID_LIST_INDICATORS), id_names,
                         invalid_ids, CHANGED_IDS if changed_ids is None else changed_ids)
    df = df.withColumn("value", yes_no(F.col("value"), F.col("indicator").isin(list(LATEST_YEAR_LABELS))))
    df = recode(df.unionByName(years), "indicator", DATABANK_LABELS)
    df = index_first(df, ["indicator", "value", "year", "url"])
    return latest_indicators(df) if latest else df


def documents(raw: DataFrame, registry: Registry, latest: bool = False) -> DataFrame:
    """Key documents from (entity_id, name, document_type, year, url) rows; an unknown id raises."""
    df = enrich(raw.select("entity_id", "document_type", "year", "url"), registry, "entity_id", "entity_id",
                errors="raise")
    df = drop_null_keys(df, ["entity_name", "document_type", "year"])
    df = rename(df, {"url": "value", "document_type": "indicator"}).withColumn("indicator", strip(F.col("indicator")))
    df = index_first(recode(df, "indicator", DOCUMENT_LABELS).drop("entity_id"), ["indicator", "value", "year"])
    return latest_indicators(df) if latest else df


def contacts(raw: DataFrame, registry: Registry) -> DataFrame:
    """Contact fields as indicators. Country, code and region are the source's own."""
    df = rename_strict(raw, {"NSO_DON_name": "entity_name"})
    df = resolve_names(df, registry, "entity_name")
    df = rename_strict(df, {"iso_3": "iso3", "NSO_ZON_name": "region", **CONTACT_LABELS})
    df = melt(df.select(*INDEX_COLUMNS, *[quoted(c) for c in CONTACT_LABELS.values()]), INDEX_COLUMNS)
    return df.withColumn("year", F.lit(None).cast("int"))


def _assessment_rows(raw: DataFrame):
    """Result rows of an assessment sheet, labelled in ``indicator``, and the names of its assessments' columns."""
    df = rename(raw, {"Name": "indicator"})
    df = df.withColumn("indicator", strip(F.coalesce("indicator", "Code"))).drop("Code")
    sheet = [c for c in df.columns if c != "indicator"]
    return drop_empty_rows(df, sheet).where(not_in(F.col("indicator"), ASSESSMENT_ROWS_DROPPED)), sheet


def assessment_results(raw: DataFrame, registry: Registry, latest: bool = False, indicators=None) -> DataFrame:
    """Assessment sheet to one row per assessment with its results as a map of label to value.

    No label is read beforehand. ``indicators`` names results that become columns instead, as in ``capacity_assessments``.
    """
    if indicators is not None:
        return capacity_assessments(raw, registry, latest, indicators)
    df, sheet = _assessment_rows(raw)
    df = transpose_map(df, "indicator", sheet, "__assessment", "cells").drop("__assessment")
    named = ["National Society", "Year"]
    df = df.select(F.col("cells")[named[0]].alias("entity_name"), strict_number(F.col("cells")[named[1]]).alias("year"),
                   F.map_filter("cells", lambda k, v: ~k.isin(named)).alias("results"))
    df = index_first(enrich(df, registry, "entity_name", "entity_name", clean=True, errors="raise"), ["year", "results"])
    return latest_per_entity(df) if latest else df


def capacity_assessments(raw: DataFrame, registry: Registry, latest: bool = False, indicators=None) -> DataFrame:
    """Assessment sheet (``Code``, ``Name``, one column per assessment) to one row per assessment.

    ``indicators`` fixes the result columns; without it the sheet's row labels, which become columns, are read first.
    """
    df, sheet = _assessment_rows(raw)
    rows = None if indicators is None else ["National Society", "Year", *indicators]
    df = transpose(df, "indicator", sheet, rows, "__assessment").drop("__assessment")
    df = rename(df, {"National Society": "entity_name", "Year": "year"})
    df = enrich(df, registry, "entity_name", "entity_name", clean=True, errors="raise")
    df = index_first(df.withColumn("year", strict_number(F.col("year"))), ["year"])
    return latest_per_entity(df) if latest else df


def _assessment_dates(raw: DataFrame, registry: Registry, extra: dict) -> DataFrame:
    df = enrich(raw, registry, "NsId", "entity_id", errors="raise")
    df = drop_strict(df, ["NsId", "NsName"])
    names = {**extra, "AssementCode": "assessment_code", "YearOfAssesment": "assessment_year",
             "SubmissionDate": "submission_date", "URL": "url"}
    return rename_strict(df, names).select(*INDEX_COLUMNS, *names.values())


def capacity_assessment_dates(raw: DataFrame, registry: Registry) -> DataFrame:
    return _assessment_dates(raw, registry, {})


def branch_assessment_dates(raw: DataFrame, registry: Registry) -> DataFrame:
    return _assessment_dates(raw, registry, {"BranchName": "branch_name"})


def operations(raw: DataFrame, registry: Registry, schemas: dict = None, text: str = "json") -> DataFrame:
    """Active operations with the funded share. Nested columns may be structs or dictionary text."""
    schemas = schemas or {"dtype": "name STRING", "region": "id INT, region_name STRING",
                          "country": "name STRING, society_name STRING"}
    df = expand_dict_columns(raw, schemas, drop=True, text=text)
    for column in ("start_date", "end_date"):
        df = df.withColumn(column, timestamp_or_null(F.col(column), NO_DATE))
    df = rename(df, {"country.society_name": "entity_name"}).where(F.col("status_display") == "Active")
    df = enrich(df.withColumn("entity_name", F.nullif("entity_name", F.lit(""))).drop("country.name"), registry,
                "entity_name", "entity_name", clean=True, errors="raise")
    # Dropped after the lookup: before it, the filter would parse the dictionary text a second time.
    df = drop_null_keys(df, ["entity_name"])
    df = df.withColumns({c: F.col(c).cast("double") for c in ("amount_funded", "amount_requested")})
    df = df.withColumn("funding", rounded_percentage(F.col("amount_funded"), F.col("amount_requested")))
    names = {"name": "operation_name", "atype_display": "operation_kind", "num_beneficiaries": "beneficiaries",
             "amount_requested": "requested", "amount_funded": "funded", "dtype.name": "disaster_type",
             "funding": "funding"}
    return rename_strict(df, names).select(*INDEX_COLUMNS, *names.values())


def projects(raw: DataFrame, registry: Registry, schemas: dict = None, text: str = "json") -> DataFrame:
    """Projects with their dates and figures; a row that is not public raises."""
    schemas = schemas or {"project_country_detail": "society_name STRING", "dtype_detail": "name STRING",
                          "event_detail": "name STRING", "reporting_ns_detail": "society_name STRING"}
    df = expand_dict_columns(raw, schemas, drop=True, text=text)
    df = df.withColumns({c: F.to_date(F.col(c), "yyyy-MM-dd") for c in ("start_date", "end_date")})
    df = rename(df, {"project_country_detail.society_name": "entity_name"})
    df = enrich(df, registry, "entity_name", "entity_name", clean=True, errors="raise")
    # Dropped after the lookup: before it, the filter would parse the dictionary text a second time.
    df = drop_null_keys(df, ["entity_name"])
    df = require_equal(df, "visibility", "public", "Dataset contains non-public data.",
                       only=F.col("entity_name").isNotNull())
    names = {"name": "project_name", "dtype_detail.name": "disaster_type", "event_detail.name": "event_description",
             "primary_sector_display": "sector", "programme_type_display": "programme_type",
             "operation_type_display": "operation_type", "start_date": "start_date", "end_date": "end_date",
             "budget_amount": "budget_amount", "actual_expenditure": "actual_expenditure",
             "target_total": "target_total", "reached_total": "reached_total"}
    return rename_strict(df, names).select(*INDEX_COLUMNS, *names.values())


def risk_index(raw: DataFrame, registry: Registry, latest: bool = False) -> DataFrame:
    """Risk scores by ISO3. A country without an entity keeps its row, without index values."""
    df = rename(raw, {"Iso3": "source_code", "IndicatorId": "indicator", "IndicatorScore": "value", "Year": "year"})
    df = enrich(df, registry, "source_code", "iso3", errors="ignore", require_entity=True)
    df = drop_strict(df, ["source_code", "IndicatorName", "nodelevel", "ValidityYear", "Unit", "Note"])
    df = index_first(recode(df, "indicator", RISK_LABELS), ["indicator", "value", "year"])
    return latest_indicators(df) if latest else df


def development_indicators(raw: DataFrame, registry: Registry, latest: bool = False, text: str = "json") -> DataFrame:
    """Development observations by ISO3. Regions and countries without an entity are dropped."""
    pair = "id STRING, value STRING"
    df = expand_dict_columns(raw, {"indicator": pair, "country": pair}, drop=True, text=text)
    df = enrich(df, registry, "countryiso3code", "iso3", errors="ignore", require_entity=True)
    df = drop_null_keys(df, ["entity_name", "`indicator.value`", "value", "date"])
    df = rename_strict(df, {"date": "year", "indicator.id": "indicator"})
    df = drop_existing(df, ["countryiso3code", "unit", "obs_status", "decimal", "scale", "indicator.value",
                            "country.id", "country.value"])
    # The recoding is one-to-one, so keeping the known codes before the latest step gives the same rows.
    df = recode(df.withColumn("year", F.col("year").cast("int")), "indicator", DEVELOPMENT_LABELS)
    if latest:
        df = latest_indicators(df)
    return index_first(df, ["indicator", "value", "year"])


def field_presence(raw: DataFrame, registry: Registry) -> DataFrame:
    """Presence by country; regional items are left out."""
    df = raw.where(not_in(F.col("country"), PRESENCE_NOT_COUNTRIES))
    df = enrich(df, registry, "country", "country", clean=True, errors="raise")
    return df.select(*INDEX_COLUMNS, "presence", "key_operation", "url", "description")


def disaster_law(raw: DataFrame, registry: Registry) -> DataFrame:
    df = enrich(raw, registry, "country", "country", clean=True, errors="raise")
    return df.select(*INDEX_COLUMNS, "law_id", "url", "description")


def corruption_perception(raw: DataFrame, registry: Registry, latest: bool = False) -> DataFrame:
    """Perception scores by ISO3; unknown codes keep their row."""
    df = drop_strict(raw, ["country", "region"])
    df = enrich(df, registry, "iso3", "iso3")
    names = {"score": "score", "rank": "rank", "sources": "sources", "standardError": "standard_error",
             "year": "year"}
    df = rename_strict(df, names).select(*INDEX_COLUMNS, *names.values())
    return latest_per_entity(df) if latest else df


def youth_engagement(raw: DataFrame, registry: Registry) -> DataFrame:
    df = rename(raw, {"National Society": "entity_name", "Year": "year"}).drop("Region")
    df = enrich(df, registry, "entity_name", "entity_name", clean=True, errors="raise")
    names = {"year": "year", "Youth Policy": "youth_policy", "Youth Engagement Strategy": "youth_strategy",
             "Youth in GB": "youth_in_board", "Youth-led structure": "youth_led"}
    df = rename_strict(df.withColumn("year", strict_number(F.col("year"))), names)
    return df.select(*INDEX_COLUMNS, *names.values())


def evaluations(raw: DataFrame, registry: Registry) -> DataFrame:
    """Evaluations, which may cover many countries: the index columns are parallel lists."""
    # On the raw text, so that the filter does not repeat the list's steps; a text that is not null gives a list.
    df = split_and_clean(raw.where(F.col("country").isNotNull()), "country", COMMA_COUNTRY_NAMES, LOCATIONS_NOT_COUNTRIES)
    df = resolve_list(df, registry, "country", by="country")
    return index_first(enrich_list(df, registry, "country"))


def statutes(raw: DataFrame, registry: Registry) -> DataFrame:
    """Statutes sheet (read with its buried header); its entity column holds countries."""
    df = rename_strict(drop_empty_rows(raw), {"National Society (NS)": "country"})
    return index_first(enrich(df, registry, "country", "country", clean=True, errors="raise"))


def recognition_laws(raw: DataFrame, registry: Registry) -> DataFrame:
    df = rename_strict(drop_empty_rows(raw), {"National Society (NS)": "country"})
    df = enrich(df, registry, "country", "country", clean=True, errors="raise")
    df = rename_strict(df, {"Law/other regulations in force": "recognition_law"})
    return df.select(*INDEX_COLUMNS, "recognition_law")


def youth_trainings(raw: DataFrame, registry: Registry) -> DataFrame:
    """Training sheet: all-null rows and columns and the totals row are dropped."""
    df = rename_strict(drop_empty_columns(drop_empty_rows(raw)), {"Country": "country"})
    df = enrich(df.where(differs(F.col("country"), "TOTAL")), registry, "country", "country", True, "raise")
    names = {"number of YABC trainings to date": "trainings", "peer educators": "peer_educators",
             "trainers": "trainers", "Comment": "comment"}
    return rename_strict(df, names).select(*INDEX_COLUMNS, *names.values())


def logistics_projects(raw: DataFrame, registry: Registry) -> DataFrame:
    df = rename(drop_empty_rows(drop_strict(raw, ["Region"])), {"Country": "country"})
    return index_first(enrich(df, registry, "country", "country", clean=True, errors="raise"))


def human_development(raw: DataFrame, registry: Registry, latest: bool = False) -> DataFrame:
    """Human development from (indicator, iso3, year, value) rows; rows with any null are dropped."""
    df = enrich(raw, registry, "iso3", "iso3", errors="ignore", require_entity=True)
    df = drop_null_keys(df.withColumn("year", F.col("year").cast("int")), [*INDICATOR_ROW])
    df = recode(df, "indicator", HUMAN_DEVELOPMENT_LABELS)
    if latest:
        df = latest_indicators(df)
    return df.select(*INDICATOR_ROW)
