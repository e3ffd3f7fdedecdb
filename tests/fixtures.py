"""A small registry of invented entities plus the three the end-to-end sheets use."""

from indicatrix import load_registry
from indicatrix.schemas import REGISTRY_SCHEMA

ROWS = [
    ("Afghan Red Crescent", "Afghanistan", "AFG", "AF", "Asia Pacific", "DAF001", ["Afghan Red Crescent Society"], []),
    ("Albanian Red Cross", "Albania", "ALB", "AL", "Europe", "DAL001", [], ["Republic of Albania"]),
    ("Zimbabwe Red Cross Society", "Zimbabwe", "ZWE", "ZW", "Africa", "DZW001", ["Zimbabwe RC"], []),
    ("Ruritanian Society", "Ruritania", "RUR", None, "Europe", None, [], ["Kingdom of Ruritania"]),
    (None, "Utopia", "UTO", "UT", "Africa", None, [], []),
]


def registry(spark, **bounds):
    return load_registry(spark.createDataFrame(ROWS, REGISTRY_SCHEMA), **bounds)


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
