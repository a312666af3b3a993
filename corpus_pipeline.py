"""Raw documents to packed sequences: five stages, each one operator of ``docflow.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docflow.llm.common import in_fold, staged, table
from docflow.llm.language import UNDETERMINED, fit_language_model, identify_language
from docflow.llm.line_dedup import drop_recurring_lines
from docflow.llm.mixing import mixed
from docflow.llm.near_dedup import one_of_each
from docflow.llm.packing import pack
from docflow.session import bound_batches, ship_package


def language_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Leaves out documents without a language: text that is null or has no letter.

    Only those: text with letters stays, also if no language was learned that has its
    n-grams (keys, base64, other languages). The predicted language decides nothing.
    """
    ship_package(spark)
    bound_batches(spark)
    model = fit_language_model(docs.where(in_fold(F.col("doc_id"), held_out=False)))
    return identify_language(docs, model).where(F.col("lang_pred") != UNDETERMINED).select(docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Takes recurring lines out of the texts; documents of nothing else go with them."""
    cleaned = drop_recurring_lines(docs).where("dropped_lines = 0 OR trim(text) <> ''")
    return cleaned.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: that with the smallest id.

    Documents are told apart by id and text. Of rows that repeat both, one stays; rows
    without id and texts without words are in no group and stay. Ties of the same id go by
    a hash of the text. No rows give no rows.
    """
    ship_package(spark)
    bound_batches(spark)
    return one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents of the mix: of each source as many words as its target.

    A document is in the mix as often as its words are taken, once or twice; one of which
    a part is taken is in it as a whole, and one of which nothing is taken is not. Rows
    that repeat id and text are in it as often as all of them are taken; ids, also null
    ones, with several texts are several documents. No rows give no rows.
    """
    times = F.ceil(F.col("taken") / F.col("size")).cast("int")
    taken = mixed(docs)[0].where("taken > 0").withColumn("times", times)
    # The rows of one document are alike: one of them stands for all.
    taken = taken.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.sum("times").cast("int").alias("_times"))
    joined = docs.join(taken, docs["doc_id"].eqNullSafe(taken["_id"]) & (F.xxhash64(docs["text"]) == taken["_key"]))
    repeated = docs.groupBy(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_key")).count().where("count > 1").drop("count")
    same = joined["_id"].eqNullSafe(repeated["_id"]) & (joined["_key"] == repeated["_key"])
    once = joined.join(repeated, same, "left_anti")
    of_many = joined.join(repeated, same, "left_semi").dropDuplicates(["_id", "_key"])
    return once.unionByName(of_many).withColumn("_copy", F.explode(F.expr("sequence(1, _times)"))).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token sequences: one row per piece of a document, with its ids."""
    ship_package(spark)
    bound_batches(spark)
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", language_stage),
    ("lines", line_stage),
    ("near-duplicates", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: No SQL can express the learned filters of the first stage.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The stages one after another over ``documents``, each result written and read back."""
    docs = table(spark, folder, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, folder)
        if i + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
