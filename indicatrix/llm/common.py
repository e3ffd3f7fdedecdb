"""What the operators share: tables kept in the shared folder, hashes that SQL can repeat, and small text rules."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: The ASCII white space that separates words and is stripped from lines.
SPACES = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


_worker: dict = {}


def of_worker(operator: str, key, make):
    """What a Python worker keeps from task to task, such as words seen before. Workers outlive stages: the first task of
    another operator drops what the one before has kept, so that they do not add up."""
    if _worker.get("operator") != operator:
        _worker.clear()
        _worker["operator"] = operator
    if key not in _worker:
        _worker[key] = make()
    return _worker[key]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the one that all executors share; only where a local session names none (tests) is one made for it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", root)
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there, and no reader computes it again."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, name: str, by: str, n: int, apart: str) -> DataFrame:
    """``df`` written once as a table in ``n`` buckets of ``by``, which is grouped and joined by it without being sent.

    Rows are kept apart by ``apart``: who asks for one value of it does not read the others.
    """
    path = shared_folder(df.sparkSession, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    df.write.option("path", path).partitionBy(apart).bucketBy(n, by).saveAsTable(table)
    return df.sparkSession.table(table)


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the identifier as text modulo ``modulus``; a null identifier counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def unit_hash(*columns: Column) -> Column:
    """A number strictly between 0 and 1 from the md5 of the columns' text (null: empty), the same in any engine with md5."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def n_words(text: Column) -> Column:
    """Words of a text: runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def parts_for(rows: float, per_part: float, least: int = 1) -> int:
    """As many partitions as keep each near ``per_part`` rows."""
    return max(least, math.ceil(rows / per_part))


def numbered(df: DataFrame, name: str, into: str) -> DataFrame:
    """``df`` stored, with a gapless number from 0 of each of its rows in ``into``.

    A row's number is its place in its partition after the rows of the partitions before; only the partitions' sizes, one row
    each, are added up in one task and sent to all.
    """
    placed = stored(df.withColumn("__place", F.monotonically_increasing_id()), name)
    part = F.shiftright("__place", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = F.sum("__rows").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    in_part = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return (placed.join(F.broadcast(starts), part == F.col("__part"))
            .withColumn(into, F.col("__start") + in_part).drop("__place", "__part", "__rows", "__start"))
