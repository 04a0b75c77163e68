"""The registered queries opN_<name>: operators applied to whole tables.

Each takes (spark, sf_dir); digest columns are derived here from what the
operators return.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm import (fingerprints, jaccard, langid, lattice, linededup, mixing, negatives, packing, quality, runs, substrings,
                           suffixes, toxicity)
from pricelens.llm.common import arrow_map, documents, table


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_neighbours(table(spark, sf_dir, "documents"))


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).drop("source")


def held_out(parts: int, part: int):
    """Whether crc32 of doc_id as text falls to ``part`` of ``parts``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts)) == part


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~held_out(4, 2)))
    return langid.identify(docs, model).select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(~held_out(5, 0)))
    return toxicity.score(docs, model).select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.link_documents(table(spark, sf_dir, "documents"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_passages(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", (F.size("spans") / 2).cast("long").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels").filter(~held_out(5, 0)))
    return quality.score(docs, model, 0.3).select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def repeat_tails(docs: DataFrame) -> DataFrame:
    """The documents; where crc32 of doc_id is divisible by 10, words from a place on repeat the first few of them."""
    def rows(batch):
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for k, i in enumerate(ids):
            h = zlib.crc32(str(i).encode())
            words = (texts[k] or "").encode().split() if h % 10 == 0 else []
            if words:
                g, n = h // 10, len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                tail = words[a:a + p]
                texts[k] = b" ".join(words[:a] + (tail * (-(-(n - a) // p)))[:n - a]).decode()
        yield {"doc_id": batch.column(0), "text": texts}
    return arrow_map(documents(docs), rows, "doc_id long, text string")


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(repeat_tails(table(spark, sf_dir, "documents")))
    found = found.withColumn("n_runs", (F.size("runs") / 3).cast("long")) \
        .withColumn("at", F.expr("if(n_runs = 0, array(), transform(sequence(0L, n_runs - 1), k -> cast(3 * k as int)))")) \
        .withColumn("best", F.expr("array_max(transform(at, k -> struct(runs[k + 1] as length, -runs[k] as start, -runs[k + 2] as period)))"))
    lines = F.expr("array_join(transform(at, k -> concat_ws(',', runs[k], runs[k + 1], runs[k + 2]) || chr(10)), '')")
    return found.select("doc_id", "n_runs", (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
                        (-F.col("best.period")).alias("period"),
                        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
                        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
                        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"))


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = negatives.whole_vectors(table(spark, sf_dir, "embeddings"), "if(vec_id % 7 = 0, (label + 1L) % 10, label)")
    return negatives.hard_negatives(vectors, "vec_id % 50 = 0")


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_lattice, op3_mixing, op4_langid, op5_packing,
                                   op6_linededup, op7_toxicity, op8_jaccard, op9_substrings,
                                   op10_suffixes, op11_quality, op12_runs, op13_negatives)}
