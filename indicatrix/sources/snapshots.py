"""Raw snapshots: land a raw table, re-read it in place of the source.

A snapshot has a folder of versions. A version is data first and, when all of it is written, a manifest; readers take the newest
version that has one, so a run that fails leaves the last whole version in place. Versions are never written over.
"""

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.columns import quoted

_MANIFEST = "manifests"


def _folder(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def write_snapshot(df: DataFrame, root: str, name: str, partition_by=None, text: bool = False) -> str:
    """Write a raw table as a new version; returns its folder. Nested columns keep their types.

    ``text`` writes CSV for people and other programs instead: nested columns as JSON, which ``parse_dict`` and
    ``expand_dict_columns`` read back. Null and the empty text stay different.
    """
    version = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S.%f}-{uuid.uuid4().hex[:8]}"
    path = f"{_folder(root, name)}/{version}"
    spark, schema = df.sparkSession, df.schema
    if text:
        nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
        df = df.select(*[F.to_json(quoted(f.name)).alias(f.name) if isinstance(f.dataType, nested) else quoted(f.name) for f in schema])
        df.write.option("header", True).option("escape", '"').option("nullValue", "\\N").csv(path)
    else:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    columns = df.select(*[c for c in df.columns if c not in (partition_by or ())], *(partition_by or ())).schema
    manifest = [(version, "csv" if text else "parquet", json.dumps(columns.jsonValue()))]
    (spark.createDataFrame(manifest, "version string, format string, columns string").coalesce(1)
     .write.mode("append").json(f"{_folder(root, name)}/{_MANIFEST}"))
    return path


def versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Whole versions of a snapshot: version, format, columns (their schema as JSON). One small row a version."""
    return spark.read.schema("version string, format string, columns string").json(f"{_folder(root, name)}/{_MANIFEST}")


def read_snapshot(spark: SparkSession, root: str, name: str, version: str = None) -> DataFrame:
    """The newest whole version, or the one asked for."""
    known = versions(spark, root, name)
    known = known if version is None else known.where(F.col("version") == version)
    newest = known.orderBy(F.col("version").desc()).first()
    if newest is None:
        raise ValueError(f"No whole version of snapshot {name}")
    reader = spark.read.schema(T.StructType.fromJson(json.loads(newest["columns"])))
    path = f"{_folder(root, name)}/{newest['version']}"
    if newest["format"] == "csv":
        return (reader.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\\N")
                .csv(path))
    return reader.parquet(path)
