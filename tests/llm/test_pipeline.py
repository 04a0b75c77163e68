"""The pipeline's stages, each on what the one before it kept."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from pricelens.llm import mixing, packing

from .conftest import DIR
from .test_operators import linked, pieces_hold, rows_of


def test_stages(spark):
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    kept = [docs]
    for name, stage in P.STAGES[:-1]:
        kept.append(stage(spark, kept[-1], DIR).cache())
        assert kept[-1].columns == P.COLUMNS, name
    clean, lines, one, mixed = kept[1:]
    assert 0 < clean.count() < docs.count()
    labels = spark.read.parquet(f"{DIR}/labels.parquet").filter("toxic = 0")
    assert clean.join(labels, "doc_id").count() >= 0.98 * docs.join(labels, "doc_id").count()
    assert lines.count() == clean.count()
    assert lines.filter("n_chars != length(text)").count() == 0
    texts = [(r["doc_id"], r["text"]) for r in lines.collect()]
    _, label = linked(texts)
    assert set(rows_of(one)) == {i for i in label if label[i] == i}
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix_sources(one).collect()}
    size = {r["doc_id"]: len(r["text"].encode().split()) for r in one.collect()}
    got = mixed.groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] * size[r["doc_id"]] for r in got if size[r["doc_id"]]} == {i: t for i, t in taken.items() if t}
    pieces = P.STAGES[-1][1](spark, mixed.dropDuplicates(["doc_id"]), DIR)
    tok = packing.word_table(packing.TOKENIZER).tok
    ids = {r["doc_id"]: tok.encode(r["text"], add_special_tokens=False).ids + [2] for r in mixed.collect()}
    assert pieces_hold(pieces.collect(), ids) < 0.02
    assert np.all([r["ids_crc32"] >= 0 for r in pieces.select("ids_crc32").collect()])


def test_run(spark):
    out = P.run(spark, DIR)
    assert out.count() > 0 and out.filter(F.col("length") <= 0).count() == 0


def test_null_and_empty_documents(spark):
    docs = spark.createDataFrame([(1, None, None, None, None), (2, "", "en", "a", 0), (None, "x", "en", "a", 1),
                                  (3, "a b c d e f g", "en", None, 13), (4, "a b c d e f g", "en", "a", 13)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, DIR)
    docs.collect()
