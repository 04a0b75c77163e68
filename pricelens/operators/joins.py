"""Joins against a side whose bytes are counted before it is broadcast, and
joins whose hot keys are split by counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelens.session import scratch_path

# Default bound (bytes of values) under which a counted side is broadcast.
# Overridden per session with ``spark.conf.set("pricelens.broadcast.maxBytes", ...)``.
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024

SALT = "_salt"


def max_broadcast_bytes(df: DataFrame) -> int:
    v = df.sparkSession.conf.get("pricelens.broadcast.maxBytes", None)
    return int(v) if v else DEFAULT_MAX_BROADCAST_BYTES


def _width(field: T.StructField) -> Column | int:
    """Bytes of one value: a number for fixed types, else a column that measures it."""
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 8
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0)) + 16
    return 16 if isinstance(kind, T.DecimalType) and kind.precision > 18 else 8


def value_bytes(df: DataFrame) -> int:
    """Bytes that the values of ``df`` take in rows, counted (one aggregate;
    of a Parquet side only its text columns are read, the rest is in the footers)."""
    widths = [_width(f) for f in df.schema.fields]
    fixed = 8 + sum(w for w in widths if isinstance(w, int))
    total = F.count(F.lit(1)) * fixed
    for w in widths:
        if not isinstance(w, int):
            total = total + F.coalesce(F.sum(w), F.lit(0))
    return int(df.agg(total.alias("b")).first()["b"])


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner",
                 max_bytes: int | None = None, materialize: bool = True) -> DataFrame:
    """``big.join(small, on, how)`` that broadcasts ``small`` only when its
    counted bytes are within a bound.

    With ``materialize`` (the default, for aggregates and other derived
    sides) ``small`` is written once as a Parquet table under the shared
    checkpoint folder — which also cuts its lineage, so a lost executor does
    not recompute it.  Without it (a plain scan of a dimension table, cheap
    to read again) it is only measured.  At or below ``max_bytes`` it is
    broadcast and ``big`` is joined in place with no shuffle at all; above it
    both sides are shuffled by :func:`join_split`, which splits hot keys.
    Either way no rows are dropped.
    """
    limit = max_bytes if max_bytes is not None else max_broadcast_bytes(big)
    if materialize:
        path = scratch_path(small.sparkSession, "join-side")
        small.write.parquet(path)
        small = small.sparkSession.read.parquet(path)
    if value_bytes(small) <= limit:
        return big.join(F.broadcast(small), on, how)
    return join_split(big, small, on, how)


def hot_keys(big: DataFrame, keys: list[str]) -> DataFrame:
    """(*keys, _salts): the keys that hold more than a partition's even share
    of the rows of ``big``, and in how many parts to split each.

    There are fewer of them than shuffle partitions, whatever the data; the
    counts are partial sums in the map tasks first.
    """
    n = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(big.sparkSession, "key-counts")
    big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).write.parquet(path)
    counts = big.sparkSession.read.parquet(path)
    total = counts.agg(F.sum("_n")).first()[0] or 0
    return (counts.filter(F.col("_n") * n > total)
                  .select(*keys, F.ceil(F.col("_n") * n / F.lit(max(total, 1))).cast("int").alias("_salts")))


def salted(big: DataFrame, small: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with a salt column: rows of a hot key in ``big`` are dealt to
    its parts by a hash of the row, its rows in ``small`` are repeated for each
    part; other keys have the one part 0.  A row of ``big`` meets each row of
    ``small`` with its key exactly once.
    """
    hot = F.broadcast(hot_keys(big, keys))      # fewer rows than shuffle partitions
    part = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in big.columns]), F.coalesce("_salts", F.lit(1))).cast("int")
    left = big.join(hot, keys, "left").withColumn(SALT, part).drop("_salts")
    parts = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = small.join(hot, keys, "left").withColumn(SALT, F.explode(parts)).drop("_salts")
    return left, right


def join_split(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Shuffle join whose hot keys are split by counts (not by AQE, which
    cannot split every shape).  ``how`` keeps at most unmatched rows of ``big``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "leftouter", "left_outer", "left_semi", "left_anti"):
        return big.join(small, keys, how)
    left, right = salted(big, small, keys)
    return left.join(right, [*keys, SALT], how).drop(SALT)
