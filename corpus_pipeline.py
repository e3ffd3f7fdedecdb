"""A training corpus from ``documents``: language, common lines, near duplicates, mixing, packing.

Each stage takes what its predecessor kept, written as Parquet and read again, and returns the columns of documents; the
last returns the pieces of the packed sequences. Some stages sum by floating point or choose by a model, so there is no SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicatrix.llm import language_id, line_dedup, mixing, near_join, packing
from indicatrix.llm.common import stored
from indicatrix.llm.queries import quality_weights, table, vocabulary


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or whose language is not found with a probability of one half, go."""
    pieces = vocabulary("piece_bpe_32k.model")
    langs, model = language_id.train(docs.select("lang", "text"), pieces)
    return language_id.accepted(docs, langs, model, pieces)


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go; documents stay, with their new length."""
    kept = line_dedup.without_common_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return near_join.one_per_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that the sources have their shares."""
    return mixing.mixed(docs, quality_weights(spark, sf_dir))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("language identification", identify_language), ("line dedup", drop_common_lines),
          ("similarity join", drop_near_duplicates), ("mixing", mix_sources), ("packing", pack_sequences)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
