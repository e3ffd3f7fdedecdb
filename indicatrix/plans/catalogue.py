"""Dataset catalogue: what datasets exist, how to select them by name and by metadata.

The catalogue is metadata (a row per dataset), supplied by the user. Filters and names are applied to the table; only the
rows of the datasets that are then built, each of which becomes a plan of its own, are read to the driver.
"""

import logging

from pyspark.sql import DataFrame, functions as F

from ..schemas import CATALOGUE_SCHEMA

log = logging.getLogger(__name__)

FILTER_FIELDS = ["source", "source_description", "type", "privacy", "link", "focal_point"]


def conform_catalogue(df: DataFrame) -> DataFrame:
    """Cast to the catalogue schema; absent columns become null, an absent archived flag false."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
               else F.lit(None).cast(f.dataType).alias(f.name) for f in CATALOGUE_SCHEMA]
    return df.select(*columns).withColumn("archived", F.coalesce("archived", F.lit(False)))


def filter_catalogue(catalogue: DataFrame, filters: dict = None) -> DataFrame:
    """Catalogue rows that match all filters. Field names and values are compared without case."""
    df = conform_catalogue(catalogue)
    filters = {k.strip().lower().replace(" ", "_"): v for k, v in (filters or {}).items()}
    invalid = [k for k in filters if k not in FILTER_FIELDS]
    if invalid:
        raise ValueError(f"{invalid} are not valid filters. Choose from {FILTER_FIELDS}")
    for field, value in filters.items():
        df = df.where(F.lower(field) == value.lower())
    return df


def select_datasets(catalogue: DataFrame, names=None, filters: dict = None, only_kinds=None) -> list:
    """Catalogue rows of the wanted datasets, in the order asked for.

    Names are compared without case and outer blanks. Unknown names, archived datasets and (with ``only_kinds``)
    datasets of another kind are skipped with a warning.
    """
    key = F.lower(F.trim("name"))
    rows = conform_catalogue(catalogue)
    if names is None:
        chosen = filter_catalogue(catalogue, filters).where(~F.col("archived"))
        if only_kinds is not None:
            chosen = chosen.where(F.col("kind").isin(sorted(only_kinds)))
        return list({r["name"].strip().lower(): r for r in chosen.collect()}.values())
    given = {name.strip().lower(): name for name in names}
    wanted = list(dict.fromkeys(name.strip().lower() for name in names))
    known = {r["name"].strip().lower(): r for r in rows.where(key.isin(wanted)).collect()}
    matching = known if not filters else {
        r["name"].strip().lower() for r in filter_catalogue(catalogue, filters).where(key.isin(wanted)).select("name").collect()}
    out = []
    for name in wanted:
        if name not in known:
            log.warning("Dataset %s not recognised, skipping", given[name])
        elif known[name]["archived"]:
            log.warning("Dataset %s is archived, skipping", known[name]["name"])
        elif only_kinds is not None and known[name]["kind"] not in only_kinds:
            log.warning("Dropping dataset %s because it cannot be put in indicator form", known[name]["name"])
        elif name in matching:
            out.append(known[name])
    return out
