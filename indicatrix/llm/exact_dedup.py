"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

Every row gets a digest and a run number. A run is sorted by digest and holds each digest once, with the identifier to
stay and the number of its rows. In each round, ``fan_in`` runs are exchanged and merged into one; equal digests meet,
keep the winning identifier and add their counts. After the last round one run per digest range is left. The results then
go back down the same tree, so a digest that a third of all rows share is spread over all runs of a level and never
meets in one task as rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

RUNS, FAN_IN = 64, 8


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", *, normalise=None, keep: str = "max",
                 runs: int = RUNS, fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when ``normalise(text)`` (default: the text itself) is identical; null counts as empty text. ``keep``
    is ``min`` or ``max``: which identifier of a group stays. Digest equality is verified at every level by the length
    and a second hash of the text, which are part of the key. Null identifiers lose against any other; rows that repeat
    the winning identifier are told apart by their place in the input, and exactly one row of a group is kept. An empty
    table gives an empty result; other columns of ``docs`` are not read.
    """
    value: Column = F.coalesce(F.col(text), F.lit(""))
    value = normalise(value) if normalise else value
    sign = 1 if keep == "max" else -1
    rows = docs.select(F.col(doc_id).alias("doc_id"), value.alias("v")).select(
        "doc_id", F.unhex(F.sha2(F.col("v").cast("binary"), 256)).alias("digest"),
        F.length("v").alias("size"), F.xxhash64("v").alias("second"), F.monotonically_increasing_id().alias("place"))
    rows = stored(rows.withColumn("run", F.pmod(F.xxhash64("place"), F.lit(runs))), "digests")

    key = ["digest", "size", "second"]
    # the larger struct wins: identifiers first (null last), then the place
    best = F.struct((F.col("doc_id") * sign).alias("rank"), F.col("place"), F.col("doc_id").alias("id"))
    level = rows.groupBy(*key, "run").agg(F.max(best).alias("best"), F.count(F.lit(1)).alias("n"))
    levels, left = [level], runs
    while left > 1:
        left = math.ceil(left / fan_in)
        level = (level.groupBy(*key, F.floor(F.col("run") / fan_in).alias("run"))
                 .agg(F.max("best").alias("best"), F.sum("n").alias("n")))
        levels.append(level)
    merged = levels.pop().select(*key, "run", F.col("best").alias("winner"), F.col("n").alias("group_size"))
    for below in reversed(levels):  # each run takes over what it was merged into
        merged = (below.select(*key, F.col("run").alias("own"), F.floor(F.col("run") / fan_in).alias("run"))
                  .join(merged, [*key, "run"]).drop("run").withColumnRenamed("own", "run"))
    return rows.join(merged, [*key, "run"]).select(
        "doc_id", F.col("winner.id").alias("keep_id"), "group_size",
        (F.col("place") == F.col("winner.place")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
