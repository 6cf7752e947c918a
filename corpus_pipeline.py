"""A corpus made ready for training: five stages, each over all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidyforge.llm.mixing import mix_documents
from tidyforge.llm.ngram_join import jaccard_classes
from tidyforge.llm.queries import fold, packed_pieces, table
from tidyforge.llm.repeats import remove_repeats
from tidyforge.llm.toxicity import score_toxicity
from tidyforge.session import WorkTables, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leave out the documents that score 0.5 or more; the held-out labels stay unused."""
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), fold() != 0,
                            output="toxicity_score")
    return scored.where("toxicity_score < 0.5").select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near duplicates.

    Groups are made of rows, so texts under one doc_id are told apart; rows with equal doc_ids
    follow the hash of their text, rows without one come last.  Rows without words stay.
    """
    rows = materialize(docs.withColumn(" row", F.monotonically_increasing_id()), "rows")
    groups = jaccard_classes(rows, " row").select(F.col("doc_id").alias(" row"), "component_id")
    first = rows.select(" row", "doc_id", F.xxhash64("text").alias("text")).join(
        groups, " row").groupBy("component_id").agg(F.min(F.struct(
            F.col("doc_id").isNull(), "doc_id", "text", F.col(" row").alias("row"))).alias("first"))
    return rows.join(first.select(F.col("first.row").alias(" row")), " row", "left_semi").select(
        *docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut every word that a repeated window of 35 words covers; other texts stay as they are."""
    cut = remove_repeats(docs, layout=True)
    return _sized(cut, F.col("n_removed") > 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat, cut or leave out documents so that each source comes near its target."""
    return _sized(mix_documents(docs), F.lit(True)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packed_pieces(docs)


def _sized(docs: DataFrame, changed: Column) -> DataFrame:
    """``n_chars`` as the text is now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.when(changed & F.col("text").isNotNull(), F.length(
        "text").cast(kind)).otherwise(F.col("n_chars")))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", one_of_each_group),
    ("substring_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has no tokenizer and no classifier; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again.

    What a stage wrote on its way, and the result before its own, are deleted once its result
    is written; the last but one result stays, since the last stage is not yet computed.
    """
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with WorkTables(spark) as tables:
            docs = materialize(stage(spark, docs, sf_dir), name)
            tables.paths, before = [*tables.paths[:-1], *before], tables.paths[-1:]
            tables.release()
    return STAGES[-1][1](spark, docs, sf_dir)
