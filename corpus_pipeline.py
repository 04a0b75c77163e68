"""Corpus preparation: documents in, packed training sequences out.

Five stages, each an operator of ``pricelens.llm`` on all that the stage before
it kept.  Every stage but the last returns the columns of documents; each
result is written as Parquet to the shared checkpoint folder and read again
by the next, so a lost executor never runs more than one stage again.
Documents with a null doc_id leave at the first stage; a null text is empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import jaccard, linededup, mixing, packing, toxicity
from pricelens.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on all labels, does not call toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, ("lang", "source", "n_chars")).filter("predicted = 0").select(COLUMNS)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others keep."""
    kept = linededup.drop_shared_lines(docs, carry=("lang", "source"))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest doc_id."""
    kept = jaccard.link_documents(docs).filter("doc_id = component_id").select("doc_id")
    return docs.join(kept, "doc_id", "left_semi").select(COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix; one that is taken twice is there twice."""
    return mixing.mixed(docs, ("lang", "n_chars")).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the training sequences, with their token ids."""
    return packing.pack_documents(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_shared_lines), ("jaccard", one_of_each_group),
          ("mixing", mix), ("packing", pack)]

#: Training, hashing and tokenizing are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
