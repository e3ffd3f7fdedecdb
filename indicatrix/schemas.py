"""Column contracts shared by every dataset."""

from pyspark.sql import types as T

INDEX_COLUMNS = ["entity_name", "country", "iso3", "region"]
INDICATOR_COLUMNS = INDEX_COLUMNS + ["indicator", "value", "year", "description", "url"]
UNIFIED_COLUMNS = INDICATOR_COLUMNS + ["dataset"]

REGISTRY_SCHEMA = T.StructType([
    T.StructField("entity_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("iso3", T.StringType()),
    T.StructField("iso2", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("entity_id", T.StringType()),
    T.StructField("alt_entity_names", T.ArrayType(T.StringType())),
    T.StructField("alt_country_names", T.ArrayType(T.StringType())),
])

UNIFIED_SCHEMA = T.StructType(
    [T.StructField(c, T.IntegerType() if c == "year" else T.StringType()) for c in UNIFIED_COLUMNS]
)

CATALOGUE_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("source_description", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("privacy", T.StringType()),
    T.StructField("link", T.StringType()),
    T.StructField("focal_point", T.StringType()),
    T.StructField("indicator_label", T.StringType()),
    T.StructField("archived", T.BooleanType()),
])

# The column titles of the published tables.
COLUMN_TITLES = {
    "entity_name": "National Society name",
    "country": "Country",
    "iso3": "ISO3",
    "region": "Region",
    "indicator": "Indicator",
    "value": "Value",
    "year": "Year",
    "description": "Description",
    "url": "URL",
    "dataset": "Dataset",
    "assessment_code": "Assessment code",
    "assessment_year": "Year of assessment",
    "submission_date": "Submission date",
    "branch_name": "Branch name",
    "operation_name": "Operation name",
    "operation_kind": "Type",
    "beneficiaries": "Number of beneficiaries",
    "requested": "Requested amount",
    "funded": "Funded amount",
    "disaster_type": "Disaster type",
    "funding": "Funding",
    "project_name": "Project name",
    "event_description": "Event description",
    "sector": "Sector",
    "programme_type": "Programme type",
    "operation_type": "Operation type",
    "start_date": "Start date",
    "end_date": "End date",
    "budget_amount": "Budget amount",
    "actual_expenditure": "Actual expenditure",
    "target_total": "Target total",
    "reached_total": "Reached total",
    "presence": "ICRC presence",
    "key_operation": "Key operation",
    "law_id": "ID",
    "score": "Score",
    "rank": "Rank",
    "sources": "Sources",
    "standard_error": "Standard error",
    "youth_policy": "Youth Policy",
    "youth_strategy": "Youth Engagement Strategy",
    "youth_in_board": "Youth in GB",
    "youth_led": "Youth-led structure",
    "title": "Title",
    "categories": "Categories",
    "evaluation_type": "Type",
    "organization": "Organization",
    "date": "Date",
    "management_response": "Management response",
    "document_url": "Document URL",
    "recognition_law": "NS recognition laws/ other regulations in force",
    "trainings": "Number of YABC trainings to date",
    "peer_educators": "Number of peer educators",
    "trainers": "Number of trainers",
    "comment": "Comment",
}


def with_titles(df, titles=None):
    """Rename the engine's column names to the published column titles."""
    return df.withColumnsRenamed({k: v for k, v in (titles or COLUMN_TITLES).items() if k in df.columns})
