"""Helpers shared by the operators: shared-folder tables, size-checked joins, components, hashing."""

from __future__ import annotations

import ctypes
import functools
import os
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

U64 = np.uint64
#: Rows of a few numbers each that may be broadcast; beyond it joins shuffle.
BROADCAST_ROWS = 500_000
#: Bytes of an Arrow batch between Spark and a Python worker, unless the session sets its own bound.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started, and bound the Arrow batches they get by bytes
    (Spark's own bound of 64 MB a batch is above what a task of a small executor can hold)."""
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    have = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in have:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, have)])


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back (cuts the lineage reliably)."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions so that each holds at most ``each`` rows on average, and not fewer than the session's setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(rows) // each))


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", rows: int | None = None) -> DataFrame:
    """Join with ``small`` broadcast only if it was counted to be small; otherwise a shuffle join that AQE may split."""
    n = small.count() if rows is None else rows
    return big.join(F.broadcast(small) if n <= BROADCAST_ROWS else small.hint("merge"), on, how)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every node of ``edges`` (a, b): alternating large and small stars, with tables
    written between rounds.  Returns (node, component); nodes without an edge do not occur."""
    e = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                "cc")
    mark = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m")
                 .select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        e = written(small, "cc")
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    return (e.groupBy("u").agg(F.min("v").alias("component"))
            .select(F.col("u").alias("node"), "component")
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


# ---- hashing -----------------------------------------------------------------------------------------

def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply, shift)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_C = U64(0x9E3779B97F4A7C15)
_STEP = 1 << 18             # bytes hashed at once
_BYTE = mix(np.arange(1, 257, dtype=U64) * _C)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = np.ones(1, U64)
_inverse = np.ones(1, U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd constant modulo 2 ** 64, and of its inverse."""
    global _powers, _inverse
    if len(_powers) < n:
        _powers = np.multiply.accumulate(np.r_[U64(1), np.full(n, _C, U64)])
        _inverse = np.multiply.accumulate(np.r_[U64(1), np.full(n, U64(pow(int(_C), -1, 1 << 64)), U64)])
    return _powers, _inverse


def span_hashes(raw: np.ndarray, s: np.ndarray, e: np.ndarray, symbol: np.ndarray = _BYTE) -> np.ndarray:
    """64-bit hashes of the spans raw[s:e], which are sorted and don't overlap."""
    out, i = np.empty(len(s), U64), 0
    while i < len(s):
        j = max(i + 1, int(np.searchsorted(e, s[i] + _STEP, "right")))
        lo, hi = int(s[i]), int(e[j - 1])
        p, inv = powers(hi - lo + 1)
        total = np.zeros(hi - lo + 1, U64)
        np.cumsum(symbol[raw[lo:hi]] * p[:hi - lo], out=total[1:])
        x, y = s[i:j] - lo, e[i:j] - lo
        out[i:j] = mix((total[y] - total[x]) * inv[x])
        i = j
    return out


def joined(texts: pa.Array, before: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """All texts' bytes one after another (null: empty), each after ``before``, and each one's first index."""
    t = [before + (x or b"") for x in texts.cast(pa.binary()).to_pylist()]
    offs = np.zeros(len(t) + 1, np.int64)
    np.cumsum([len(x) for x in t], out=offs[1:])
    return np.frombuffer(b"".join(t), np.uint8), offs


def words(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ of each text, one after another, and each text's first index."""
    raw, offs = joined(texts, b"\n")
    gap = _SPACE[raw]
    s = np.flatnonzero(~gap[1:] & gap[:-1]) + 1
    e = np.flatnonzero(gap[1:] & ~gap[:-1]) + 1
    if len(e) < len(s):
        e = np.r_[e, len(raw)]
    return span_hashes(raw, s, e, _LOWER if lower else _BYTE), np.searchsorted(s, offs)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # the C library of Linux has it


def give_back() -> None:
    """Freed memory goes back to the system: a Python worker lives on after its batch, beside the next stage's."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


_remembered: list = []


def remembered(make):
    """``functools.cache`` of what a worker keeps from task to task (vocabularies, their pre-tokens), until ``forget``."""
    _remembered.append(functools.cache(make))
    return _remembered[-1]


def forget() -> None:
    """For tasks that need nothing remembered: a worker that did another operator's work before drops what it kept of it."""
    if any(x.cache_info().currsize for x in _remembered):
        for x in _remembered:
            x.cache_clear()
        give_back()


def slices(batch: pa.RecordBatch, column: str, most: int):
    """Parts of a batch of at most ``most`` bytes of ``column`` (at least one row each), so memory follows bytes."""
    col = batch.column(batch.schema.get_field_index(column))
    size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(col), 0)).astype(np.int64)
    total, first = 0, 0
    for i, n in enumerate(size.tolist()):
        if total and total + n > most:
            yield batch.slice(first, i - first)
            total, first = 0, i
        total += n
    if len(size) > first:
        yield batch.slice(first)
    give_back()


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indexes starts[0]..starts[0]+lens[0]-1, starts[1].., one after another."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(int(ends[-1]) if len(ends) else 0)
