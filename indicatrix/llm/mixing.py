"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key scaled by its quality weight; within a source, documents in key order form a
weighted sample without replacement, and a prefix sum of their sizes cuts it at the source's token budget. Complete epochs
come first: a source whose target is 1.4 times its size gives every document once and the first documents worth 0.4 sizes
a second time.

The prefix sum works in two steps so that no source has to fit into one task: sizes are added per source and key range
first, which tells the one range where the budget ends; only that range's documents are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stored, unit_hash

KEY_RANGES = 2048
WEIGHTS = (5, 2, 1)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Targets by source from one row (source, source_size) per source.

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` times all sizes; none gets more
    than ``most`` times its size, and what is above is shared again by weight. The level at which that ends is found in
    one pass over the sources in order of size for weight. There is one row per source here, and no document.
    """
    total = Window.partitionBy()
    turn = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    full = Window.orderBy("fill", F.col("source").cast("binary").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod(F.row_number().over(turn) - 1, F.lit(len(weights))) + 1).cast("int"))
    cap = F.col("source_size") * float(most)
    ranked = (sizes.withColumn("weight", weight).withColumn("cap", cap).withColumn("fill", F.col("cap") / F.col("weight"))
              .withColumn("budget", F.sum("source_size").over(total) * float(share))
              .withColumn("capped", F.sum("cap").over(full) - F.col("cap"))
              .withColumn("open", F.sum("weight").over(total) - F.sum("weight").over(full) + F.col("weight")))
    # the first source in this order that stays below its cap sets the level
    level = F.min(F.when((F.col("budget") - F.col("capped")) / F.col("open") < F.col("fill"),
                         F.struct("fill", ((F.col("budget") - F.col("capped")) / F.col("open")).alias("level")))).over(total)
    return (ranked.withColumn("level", level["level"])
            .select("source", "source_size",
                    F.when(F.col("level").isNull() | (F.col("fill") <= F.col("level")), F.col("cap"))
                    .otherwise(F.col("level") * F.col("weight")).alias("target")))


def mix(docs: DataFrame, quality: DataFrame | None = None, *, doc_id: str = "doc_id", source: str = "source",
        size: Column | None = None, weights: Sequence[float] = WEIGHTS, share: float = 1.5, most: float = 2.0,
        seed: int = 0, ranges: int = KEY_RANGES, carry: Sequence[Column] = ()) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, and the columns of ``carry``.

    ``copies`` is how often the mix holds the whole document, ``taken = copies * size``. ``quality`` has one row or more
    per doc_id with a weight above 0 (the largest counts); documents without one, or with a null, weigh 1. The document at
    which a budget ends is taken if that comes nearer to the target. Documents without words have size 0 and the copies
    of their place in the order. The key is a hash of seed and identifier, so reruns agree; rows that share an identifier
    share the key and are ordered by their size. A null source is a source of its own, the last one. An empty table gives
    an empty result.
    """
    size = n_words(F.col("text")) if size is None else size
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), size.cast("long").alias("size"),
                       *carry)
    if quality is None:
        rows = rows.withColumn("quality", F.lit(1.0))
    else:
        best = (quality.where(F.col("weight") > 0).groupBy(F.col("doc_id").alias("quality_id"))
                .agg(F.max("weight").cast("double").alias("quality")))
        rows = (rows.join(best, F.col("doc_id") == F.col("quality_id"), "left").drop("quality_id")
                .withColumn("quality", F.coalesce("quality", F.lit(1.0))))
    rows = rows.withColumn("key", -F.log(unit_hash(F.lit(seed), F.col("doc_id"))) / F.col("quality"))
    rows = rows.withColumn("key_range", F.floor((1 - F.exp(-F.col("key"))) * ranges)).drop("quality")
    rows = stored(rows, "mix-rows")

    by_range = rows.groupBy("source", "key_range").agg(F.sum("size").alias("range_size"))
    by_range = stored(by_range, "mix-ranges")
    targets = source_targets(by_range.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, share, most)
    targets = (targets.withColumn("epochs", F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)))
               .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))
    before = F.sum("range_size").over(Window.partitionBy("source").orderBy("key_range")) - F.col("range_size")
    cut = (by_range.withColumn("before", before).withColumnRenamed("source", "cut_source")
           .join(targets, F.col("cut_source").eqNullSafe(F.col("source")))
           .where("before <= rest").groupBy("source", "source_size", "target", "epochs", "rest")
           .agg(F.max(F.struct("key_range", "before")).alias("cut")))
    cut = stored(cut.withColumnsRenamed({"source": "cut_source"}), "mix-cuts")

    placed = rows.join(cut, F.col("source").eqNullSafe(F.col("cut_source"))).drop("cut_source")
    outside = placed.where(F.col("key_range") != F.col("cut.key_range")).withColumn(
        "extra", (F.col("key_range") < F.col("cut.key_range")).cast("long"))
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    inside = (placed.where(F.col("key_range") == F.col("cut.key_range"))
              .withColumn("until", F.sum("size").over(order) + F.col("cut.before"))
              .withColumn("extra", (F.col("until") - F.col("size") / 2 <= F.col("rest")).cast("long")).drop("until"))
    both = outside.unionByName(inside).withColumn("copies", F.col("epochs") + F.col("extra"))
    return both.withColumn("taken", F.col("copies") * F.col("size")).drop("key", "key_range", "cut", "rest", "epochs", "extra")


def mixed(docs: DataFrame, quality: DataFrame | None = None, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents of the mix, with all their columns, each as often as the mix takes it.

    Rows that repeat an identifier and its text are all taken as often as the first of them.
    """
    key = F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit("")))
    copies = (mix(docs, quality, doc_id=doc_id, carry=[key.alias("row_key")], **options)
              .groupBy("row_key").agg(F.max("copies").cast("int").alias("copies")).where("copies > 0"))
    rows = docs.select(F.struct("*").alias("row"), key.alias("row_key")).join(copies, "row_key")
    return rows.select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
