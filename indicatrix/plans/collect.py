"""What a user calls: one dataset, several datasets, or the unified indicator table."""

import logging
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.values import as_text, is_quantitative, year_of
from ..operators.checks import count_per_entity
from ..operators.columns import add_missing, conform
from ..operators.filters import entity_filters, keep_values, restrict_to_keys, validate_filters
from ..operators.latest import latest_indicators
from ..operators.registry import Registry, UnknownRows, unknown_values
from ..operators.reshape import melt, to_indicator, union_by_name
from ..schemas import COLUMN_TITLES, INDEX_COLUMNS, INDICATOR_COLUMNS, UNIFIED_COLUMNS, UNIFIED_SCHEMA
from . import datasets as D
from .catalogue import select_datasets

log = logging.getLogger(__name__)


def _as_is(df, entry, as_of):
    return df


def _capacity_dates(df, entry, as_of):
    return to_indicator(df, "assessment_year", entry["indicator_label"] or "Capacity assessment dates", None,
                        drop=("assessment_code", "submission_date"))


def _branch_counts(df, entry, as_of):
    counted = count_per_entity(df, INDEX_COLUMNS, "assessment_code", "n")
    return to_indicator(counted, "n", entry["indicator_label"] or "Number of branch assessments", None)


def _presence(df, entry, as_of):
    text = df.withColumn("presence", F.initcap(F.col("presence").cast("string")))
    return to_indicator(text, "presence", entry["indicator_label"] or "Field presence", year_of(as_of),
                        drop=("key_operation",))


def _law(df, entry, as_of):
    return to_indicator(df, "description", entry["indicator_label"] or entry["name"], year_of(as_of),
                        drop=("law_id",))


def _perception(df, entry, as_of):
    return to_indicator(df, "score", entry["indicator_label"] or "Corruption Perception Index",
                        drop=("standard_error", "sources", "rank"))


def _youth(df, entry, as_of):
    measures = ["youth_policy", "youth_strategy", "youth_in_board", "youth_led"]
    titled = df.withColumnsRenamed({m: COLUMN_TITLES[m] for m in measures})
    return melt(titled, INDEX_COLUMNS + ["year"], [COLUMN_TITLES[m] for m in measures]).withColumn(
        "url", F.lit(entry["link"]))


@dataclass(frozen=True)
class Kind:
    """How one kind of dataset is built, and how it becomes indicator rows (None: it does not).

    ``source_key`` is the raw column (or field of a struct column) that holds a registry key, and which key: entity filters
    are then applied to the raw table as well, where it has that column, before anything else happens to it. ``entity`` is
    the raw column that names the entity, by which registry column it is looked up, and whether aliases count.
    """

    build: Callable
    has_latest: bool = False
    indicators: Callable = None
    source_key: tuple = None
    entity: tuple = None


KINDS = {
    "databank": Kind(D.databank, True, _as_is, ("entity_id", "entity_id"), ("entity_id", "entity_id", False)),
    "documents": Kind(D.documents, True, _as_is, ("entity_id", "entity_id"), ("entity_id", "entity_id", False)),
    "contacts": Kind(D.contacts, False, _as_is, ("iso_3", "iso3"), ("NSO_DON_name", "entity_name", True)),
    "capacity_assessments": Kind(D.assessment_results, True),
    "capacity_assessment_dates": Kind(D.capacity_assessment_dates, False, _capacity_dates),
    "branch_assessment_dates": Kind(D.branch_assessment_dates, False, _branch_counts),
    "operations": Kind(D.operations, source_key=("country.iso3", "iso3")),
    "projects": Kind(D.projects, source_key=("project_country_detail.iso3", "iso3")),
    "risk_index": Kind(D.risk_index, True, _as_is, None, ("Iso3", "iso3", False)),
    "development_indicators": Kind(D.development_indicators, True, _as_is, ("countryiso3code", "iso3"),
                                   ("countryiso3code", "iso3", False)),
    "field_presence": Kind(D.field_presence, False, _presence, None, ("country", "country", True)),
    "disaster_law": Kind(D.disaster_law, False, _law, None, ("country", "country", True)),
    "corruption_perception": Kind(D.corruption_perception, True, _perception, None, ("iso3", "iso3", False)),
    "youth_engagement": Kind(D.youth_engagement, False, _youth, None, ("National Society", "entity_name", True)),
    "evaluations": Kind(D.evaluations),
    "statutes": Kind(D.statutes),
    "recognition_laws": Kind(D.recognition_laws),
    "youth_trainings": Kind(D.youth_trainings),
    "logistics_projects": Kind(D.logistics_projects),
    "human_development": Kind(D.human_development, True, _as_is, None, ("iso3", "iso3", False)),
}


def _has_field(df: DataFrame, path: str) -> bool:
    """Whether the table has this column, or this field of a struct column, or a column of text that may hold the field."""
    kind = df.schema
    for name in path.split("."):
        if isinstance(kind, T.StringType):
            return True
        if not isinstance(kind, T.StructType) or name not in kind.fieldNames():
            return False
        kind = kind[name].dataType
    return True


def unknown_entities(kind, raw: DataFrame, registry: Registry, kinds: dict = None) -> DataFrame:
    """What a dataset's raw table names and the registry does not know: (unknown_value, n_rows).

    For every policy, ``ignore`` included: a report that is asked for, not a side effect of building the dataset.
    """
    spec = kind if isinstance(kind, Kind) else (kinds or KINDS)[kind]
    if spec.entity is None:
        raise ValueError(f"{kind} has no column of its own that names one entity")
    column, by, aliases = spec.entity
    return unknown_values(raw, registry, column, by, aliases)


def dataset(kind, raw: DataFrame, registry: Registry, latest: bool = False, iso3=None, country=None,
            entity_name=None, options: dict = None, kinds: dict = None, ignore_case: bool = False, errors: str = "raise",
            unknown: UnknownRows = None) -> DataFrame:
    """Build one dataset from its raw table, then filter it by entity.

    ``errors`` says what happens to values that the registry does not know, where the dataset's lookups would raise: ``raise``,
    ``ignore``, or ``warn``, which counts them into ``unknown`` while the table is computed.

    ``kind`` is a name in ``KINDS`` (or ``kinds``) or any function ``(raw, registry) -> DataFrame``. Entity filters reach
    the raw table's scan as exact keys; ``ignore_case`` also keeps raw keys in another case, at the price of a full scan.
    """
    filters = entity_filters(iso3, country, entity_name)
    validate_filters(filters, registry)
    spec = kind if isinstance(kind, Kind) else Kind(kind) if callable(kind) else (kinds or KINDS)[kind]
    options = dict(options or {})
    if spec.has_latest:
        options["latest"] = bool(latest)
    elif latest:
        log.warning("latest does not apply to %s: the whole dataset is returned", kind)
    if filters and spec.source_key and _has_field(raw, spec.source_key[0]):
        column, key = spec.source_key
        raw = restrict_to_keys(raw, column, registry, filters, key, ignore_case)
    df = spec.build(raw, registry.with_policy(errors, unknown), **options)
    for column, values in filters.items():
        df = keep_values(df, column, values)
    return df


def datasets(catalogue: DataFrame, raw: dict, registry: Registry, names=None, filters: dict = None,
             latest: bool = False, iso3=None, country=None, entity_name=None, options: dict = None,
             kinds: dict = None, only_kinds=None, warnings: dict = None) -> dict:
    """Build the selected datasets: catalogue name to lazy DataFrame.

    With a dict for ``warnings``, unknown values are counted instead of raised: it receives each built dataset's ``UnknownRows``.

    ``raw`` maps catalogue names to raw tables; a selected dataset without a raw table is skipped with a warning.
    ``options`` maps catalogue names to keyword arguments of the dataset function.
    """
    chosen = {}
    for entry in select_datasets(catalogue, names, filters, only_kinds):
        name = entry["name"]
        if name not in raw:
            log.warning("No raw table for dataset %s, skipping", name)
            continue
        if warnings is not None:
            warnings[name] = UnknownRows()
        chosen[name] = dataset(entry["kind"], raw[name], registry, latest, iso3, country, entity_name,
                               (options or {}).get(name), kinds, errors="raise" if warnings is None else "warn",
                               unknown=None if warnings is None else warnings[name])
    return chosen


def to_unified(df: DataFrame, entry, as_of=None, kinds: dict = None) -> DataFrame:
    """One built dataset in indicator form, tagged with the dataset's name. Values are text, years INT."""
    df = (kinds or KINDS)[entry["kind"]].indicators(df, entry, as_of)
    df = conform(add_missing(df, ["description", "url"]), INDICATOR_COLUMNS, entry["name"])
    typed = [F.col(c).cast("int") if c == "year" else as_text(F.col(c), df.schema[c].dataType) for c in INDICATOR_COLUMNS]
    return df.select(*[t.alias(c) for t, c in zip(typed, INDICATOR_COLUMNS)], F.lit(entry["name"]).alias("dataset"))


def combine(unified, latest: bool = False, quantitative: bool = None, numeric: str = "digits",
            ordered: bool = False) -> DataFrame:
    """Union of unified tables, then latest per dataset, entity and indicator, then the value filter."""
    df = union_by_name(unified)
    if latest:
        df = latest_indicators(df, ("dataset", "entity_name", "indicator"))
    df = df.select(*UNIFIED_COLUMNS)
    if quantitative is not None:
        numbers = is_quantitative(F.col("value"), numeric)
        df = df.where(numbers if quantitative else ~numbers)
        if quantitative:
            df = df.withColumn("value", F.col("value").cast("double"))
    if ordered:
        order = ["dataset", "entity_name", "indicator", "year", "value", "description", "url"]
        df = df.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df


def indicators(catalogue: DataFrame, raw: dict, registry: Registry, names=None, filters: dict = None,
               latest: bool = False, quantitative: bool = None, numeric: str = "digits", ordered: bool = False,
               as_of=None, options: dict = None, kinds: dict = None, warnings: dict = None) -> DataFrame:
    """The unified indicator table of the selected datasets; ``warnings`` as in ``datasets``.

    ``quantitative``: True keeps whole-number values and makes the column DOUBLE, False keeps the others, None keeps
    all. An empty selection gives an empty table.
    """
    table = kinds or KINDS
    shaped = {k for k, spec in table.items() if spec.indicators is not None}
    picked = select_datasets(catalogue, names, filters, shaped)
    built = datasets(catalogue, raw, registry, [e["name"] for e in picked], None, latest, options=options,
                     kinds=kinds, warnings=warnings)
    parts = [to_unified(built[e["name"]], e, as_of, kinds) for e in picked if e["name"] in built]
    if not parts:
        return registry.rows.sparkSession.createDataFrame([], UNIFIED_SCHEMA)
    return combine(parts, latest, quantitative, numeric, ordered)
