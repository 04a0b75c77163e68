"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.llm.text import chunks, give_back, pack
from pricelens.session import scratch_path

#: Arrow batches of texts are cut at this size.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder.

    It cuts the lineage: a lost executor rereads the table instead of
    running everything before it again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of :func:`written` that nothing will read again."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._scratch)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def broadcast_bytes(df: DataFrame) -> int:
    """The session's bound for broadcast sides (10 MB unless set; 0 where it forbids them)."""
    jvm = df.sparkSession._jsparkSession.sessionState().conf()
    return max(0, jvm.autoBroadcastJoinThreshold())


def release(df: DataFrame) -> None:
    """Lets Spark delete the shuffle files of jobs that are over.

    It does so once the driver has collected what refers to them, which on a
    driver with memory to spare may be long after a chain of large jobs.
    """
    gc.collect()
    give_back()
    df.sparkSession.sparkContext._jvm.System.gc()


def documents(df: DataFrame, *more: str) -> DataFrame:
    """(doc_id long, text string, *more) of the rows that have a doc_id.

    A row without one can't be named in a result and is left out.  All other
    columns of ``df`` are left behind, so their names can't clash.  Where the
    session names no size for Arrow batches, it gets ``BATCH``: 10,000 texts
    at a time, as many as Spark sends otherwise, may be of any size.
    """
    if not df.sparkSession.conf.get(BATCH[0], None):
        df.sparkSession.conf.set(*BATCH)
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                     *[F.col(c) for c in more]).filter("doc_id is not null")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str) -> DataFrame:
    """``mapInArrow`` for a function from a batch to dictionaries of columns."""
    types = arrow_types(schema)

    def run(batches):
        for batch in batches:
            for cols in fn(batch):
                yield record(cols, types)
    return mapped(df, run, schema)


def mapped(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow``, after which the Python worker gives freed memory back."""
    def run(batches):
        yield from fn(batches)
        give_back()
    return df.mapInArrow(run, schema)


def record(cols: dict, types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_array(cols[n], types[n]) for n in types], names=list(types))


ARROW = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(),
         "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
         "array<int>": pa.list_(pa.int32()), "array<float>": pa.list_(pa.float32())}


def arrow_types(schema: str) -> dict[str, pa.DataType]:
    return {f.split()[0]: ARROW[f.split()[1]] for f in schema.split(", ")}


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def packed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, z): every row with its text packed."""
    def rows(batch):
        ids, texts = batch.column(0), batch.column(1)
        for c in chunks(texts):
            yield {"doc_id": ids.slice(c.lo, len(c)), "z": [pack(c.raw(i)) for i in range(len(c))]}
    return arrow_map(docs.select("doc_id", "text"), rows, "doc_id long, z binary")


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, z): one packed text per doc_id, dealt by doc_id.

    Rows that repeat a doc_id become one; of different texts the greatest
    packed one stays, so a rerun gives the same.
    """
    z = packed_rows(docs)
    return z.repartition("doc_id").groupBy("doc_id").agg(F.max("z").alias("z"))


def copies(docs: DataFrame) -> DataFrame:
    """(doc_id) of the documents whose text a smaller doc_id has."""
    named = docs.select("doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("name"))
    least = named.groupBy("name").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    least = written(least, "copied-texts")      # with both sides read, a text that very many have is split
    return named.join(least, "name").filter("doc_id > least").select("doc_id").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id in ``edges`` (a, b).

    Alternating large-star and small-star steps: each replaces a node's
    links by links to its least neighbour, until nothing changes.  The number
    of steps is logarithmic; a step is two shuffles of the links.  The least
    neighbour is an aggregate that is written, then joined: no neighbour list is
    gathered, and as both sides of the join are read, a node with very many links is
    split like any skewed join key.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")) \
        .filter("u > v").distinct()
    e = written(e, "links")
    mark = _mark(e)
    while mark[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").filter("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.distinct(), "links")
        discard(least, e)
        least = written(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        discard(least, large)
        now = _mark(e)
        if now == mark:
            break
        mark = now
    roots = e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _mark(e: DataFrame) -> tuple:
    r = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]
