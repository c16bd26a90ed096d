"""From raw documents to packed sequences: quality, language, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored as Parquet and read again as the next one's
documents.  All but the last return the columns of documents.

Stages that reject documents find the keys of those to go, (doc_id, hash of the text), and take them out by an anti join:
verdicts depend on nothing else, so repeated rows share them.  Those of the quality rules depend on lang too, which their key has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridclear.llm import fertility, jaccard_groups, language_id, mixing, packing
from gridclear.llm.common import table, written
from gridclear.llm.queries import FERTILITY_VOCABULARY, PACKING_VOCABULARY
from gridclear.llm.tokenizer_files import path
from gridclear.session import shipped

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: A text whose most likely language has less than this mean probability is of no known language.
MIN_LANGUAGE_SCORE = 0.5


#: Words that a worker keeps: few, as its memory is shared with what other stages leave in the executor.
QUALITY_MEMO, PACKING_MEMO = 1 << 15, 1 << 16


def without(docs: DataFrame, rejected: DataFrame, *more: str) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text_key), and columns ``more``, are in ``rejected``."""
    gone = [F.col(c).alias(f"gone_{c}") for c in more]
    rejected = rejected.select(F.col("doc_id").alias("gone_id"), F.col("text_key").alias("gone_key"), *gone).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("gone_id")) & (F.col("text_key") == F.col("gone_key"))
    for c in more:
        same = same & F.col(c).eqNullSafe(F.col(f"gone_{c}"))
    return docs.withColumn("text_key", fertility.text_key(F.col("text"))).join(rejected, same, "left_anti").drop("text_key")


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose tokenizer fertility is within the bands of their language."""
    judged = fertility.quality_rules(docs, path(FERTILITY_VOCABULARY), memo=QUALITY_MEMO)
    return without(docs, judged.filter("NOT kept"), "lang")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows.

    If nothing could be learned, as no row has a usable label, only null texts and texts without letters are rejected.
    """
    network = language_id.fit(docs)
    if network is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    predicted = language_id.predict(docs, network)
    unknown = (F.col("lang_pred") == language_id.UNKNOWN) | (F.col("score") < MIN_LANGUAGE_SCORE)
    return without(docs, predicted.filter(unknown))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates; all that have no shingles."""
    found = written(jaccard_groups.similar_documents(docs), "groups")
    least = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))
    stay = written(found.groupBy("component").agg(least.alias("least")).select("least.row"), "stay")
    key = ["doc_id", "text_key"]
    kept = found.join(stay, "row").select(*key, "n_shingles")
    left = without(docs, found.join(stay, "row", "left_anti").select(*key).subtract(kept.select(*key)))
    # Repeated rows have equal keys, so the anti join spares all of them.
    repeated = written(
        found.filter("n_shingles > 0").groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1").drop("rows"), "repeated"
    )
    if repeated.isEmpty():
        return left
    once = without(left, kept.select(*key).subtract(repeated)).withColumn("text_key", fertility.text_key(F.col("text")))
    return without(left, repeated).unionByName(once.dropDuplicates(key).drop("text_key"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.Mix(docs).documents()


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stored here, as that keeps the batches of text small that wait for Python."""
    return written(packing.pack(docs, path(PACKING_VOCABULARY), memo=PACKING_MEMO), "packed")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", shipped(apply_quality_rules)),
    ("language ID", shipped(identify_language)),
    ("n-gram Jaccard join", shipped(keep_one_of_each_group)),
    ("mixing sources", shipped(mix_sources)),
    ("packing", shipped(pack_sequences)),
]
ORACLE_SQL = None  # three stages use trained or published models


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
