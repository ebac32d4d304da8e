"""The corpus pipeline: language ID, near-duplicate join, decontamination, source mixing, sharding.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.llm import decontamination, jaccard_join, language_id, mixing, sharding
from rivulet.llm.common import free_name, materialize, table, without_ids

MIN_SCORE = 0.5  # posterior of the predicted language below which a document counts as in no language


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9. Rejects documents without a letter and those whose best language is not even likely.

    The model is fitted on the labelled documents of ``docs`` itself. Where no language was learned (no
    labelled document) nothing can be told about the others: only documents without a letter are rejected.
    """
    model = language_id.train(docs.select("doc_id", "lang", "text"))
    if not model[0]:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = free_name(docs, "lang_pred"), free_name(docs, "score")  # columns of those names are the documents' own
    scored = language_id.identify(docs, model, names=found)
    return scored.where((F.col(found[0]) != "und") & (F.col(found[1]) >= MIN_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1, five words at 0.8. One row of each component stays: that with the smallest doc_id, null last,
    and of several rows of that id one; documents without words are no duplicates and stay.

    Rows are told apart by doc_id where it is unique, else by a row id that is written with them.
    """
    columns = docs.columns
    if docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 or doc_id is null").isEmpty():
        found = jaccard_join.jaccard_components(docs, k=5, percent=80).where("n_shingles > 0")
        return without_ids(docs, found.where("doc_id <> component_id").select("doc_id"), "doc_id").select(*columns)
    row = free_name(docs, "_row")
    docs = materialize(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = jaccard_join.jaccard_components(docs.select(F.col(row).alias("doc_id"), "text"), k=5, percent=80)
    found = found.where("n_shingles > 0").select(F.col("doc_id").alias("row"), "component_id")
    found = materialize(found.join(docs.select(F.col(row).alias("row"), "doc_id"), "row"), "members")
    rank = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    first = found.groupBy("component_id").agg(F.min(rank).alias("first"))
    drop = found.join(first, "component_id").where(F.col("row") != F.col("first.row")).select(F.col("row").alias(row))
    return without_ids(docs, drop, row).select(*columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4. Documents that hold a passage of ``benchmark`` go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7. Every document stays at least once; small sources repeat up to two times."""
    return mixing.mix_documents(docs, max_epochs=mixing.MAX_EPOCHS)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2. The documents with their shard, 0 to 15; a column ``shard`` of theirs is replaced."""
    return sharding.assign_shards(docs, 16)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

ORACLE_SQL = None  # the language model has no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result but the last is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
