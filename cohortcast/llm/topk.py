"""Operator 3: exact top-k inner products by aggregation without random access.

Vectors are dealt into blocks; a block keeps, for each component, its rows in order of that component.  For a query the
lists are read from their best end, a stretch at a time and all in step; a row's lower bound is what has been read of it
plus the worst that its unread components can add, its upper bound takes each unread list's last value read instead.  Reading stops
when k rows have lower bounds that no other row's upper bound (nor that of a row never read) exceeds or ties; the exact
scores of the rows still in play are resolved in 64-bit integers.  Each block returns its k best for each query,
and the k best of these are exact for the whole table.

Queries meet vectors block by block: both sides are packed into blocks (queries in blocks of 256, all joined by an
equality of block numbers), so no task holds more than one block of each.

Edge cases: vectors that are null, empty or hold null or non-finite components take no part; vectors of different
lengths are not compared; null vec_id rows take no part; rows that repeat a vec_id count as one (the lexicographically
smallest vector); ties go to the smaller vec_id; scores must fit 64 bits; further columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

SCALE = 1024
QUERY_BLOCK = 256
VECTOR_BLOCK = 8192


def quantised(vectors: DataFrame) -> DataFrame:
    """(vec_id, v array<bigint>) of the vectors that take part, one for each vec_id."""
    x = F.transform(F.col("embedding"), lambda c: c.cast("double"))
    finite = F.forall(F.col("x"), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))
            .where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & finite)
            .select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE)).alias("v"))
            .groupBy("vec_id").agg(F.min("v").alias("v")))


def blocks(rows: DataFrame, number: int, of: str) -> DataFrame:
    """Rows (block, dim, ids, values): the vectors of one length in blocks, as binary columns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for b, d, i, v in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault((b, d), []).append((i, v))
                if len(held[b, d]) >= VECTOR_BLOCK:
                    yield row(b, d, held.pop((b, d)))
        for (b, d), x in held.items():
            yield row(b, d, x)

    def row(b, d, x):
        x.sort()
        return pa.RecordBatch.from_arrays(
            [pa.array([b], pa.int32()), pa.array([d], pa.int32()),
             pa.array([np.array([i for i, _ in x], "<i8").tobytes()], pa.binary()),
             pa.array([np.array([v for _, v in x], "<i8").tobytes()], pa.binary())], ["b", "dim", "ids", "values"])
    keyed = rows.select(F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int").alias("b"), F.size("v").alias("dim"),
                        "vec_id", "v")
    return (keyed.repartition(number, "b").mapInArrow(run, "b int, dim int, ids binary, values binary")
            .withColumnsRenamed({"ids": f"{of}_ids", "values": f"{of}_values", "b": f"{of}_block"}))


class Lists:
    """A block's rows in ascending order of each component."""

    def __init__(self, v: np.ndarray):
        self.v, (self.n, self.dim) = v, v.shape
        self.order = np.argsort(v.T, axis=1, kind="stable")
        self.sorted = np.take_along_axis(v.T, self.order, 1).astype(float)

    def best(self, q: np.ndarray, k: int, own: np.ndarray) -> np.ndarray:
        """(rows, queries) flags of the rows that hold each query's k largest inner products, and maybe a few more.

        ``own``: each query's own row, which takes no part, or -1.  A query reads a list from the top where its weight is
        positive, else from the bottom, so what all queries know of a component after the same stretch is two columns."""
        out = np.ones((self.n, len(q)), bool)
        mine = np.flatnonzero(own >= 0)
        out[own[mine], mine] = False
        if self.n <= 4 * k:
            return out
        up, down = np.maximum(q, 0).T.astype(float), np.minimum(q, 0).T.astype(float)
        v, place = self.v.astype(float), np.empty((self.n, self.dim), np.int64)
        np.put_along_axis(place, self.order.T, np.arange(self.n)[:, None], 0)
        slack = 1e-9 * (1 + np.abs(q).sum(1) * np.abs(v).max())
        live, depth, step = np.arange(len(q)), 0, max(64, -(-self.n // 4))
        while depth < self.n and len(live):
            depth = min(self.n, depth + step)
            top, bottom = place >= self.n - depth, place < depth        # the entries read so far, from either end
            a, b = up[:, live], down[:, live]
            low = np.where(top, v, self.sorted[:, 0]) @ a + np.where(bottom, v, self.sorted[:, -1]) @ b
            high = (np.where(top, v, self.sorted[:, self.n - depth]) @ a
                    + np.where(bottom, v, self.sorted[:, depth - 1]) @ b)
            low[~out[:, live]] = -np.inf
            bar = np.partition(low, self.n - k, axis=0)[self.n - k]
            # the others, read or not, can no longer reach the k best
            out[:, live] &= high >= bar - slack[live]
            live = live[out[:, live].sum(0) > 2 * k]
        return out


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, qi, qv, vi, vv in zip(*(c.to_pylist() for c in batch.columns)):
                qi, vi = np.frombuffer(qi, "<i8"), np.frombuffer(vi, "<i8")
                qv, v = np.frombuffer(qv, "<i8").reshape(-1, dim), np.frombuffer(vv, "<i8").reshape(-1, dim)
                lists = Lists(v)
                q_out, v_out, s_out = [], [], []
                own = np.searchsorted(vi, qi)
                own = np.where(np.r_[vi, -1][np.minimum(own, len(vi))] == qi, own, -1)
                own[(own >= len(vi))] = -1
                hold = lists.best(qv, k, own)
                for j, i in enumerate(qi.tolist()):
                    rows = np.flatnonzero(hold[:, j])
                    score = v[rows] @ qv[j]
                    top = np.lexsort((vi[rows], -score))[:k]
                    q_out += [i] * len(top)
                    v_out.append(vi[rows][top])
                    s_out.append(score[top])
                if q_out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(q_out, pa.int64()), pa.array(np.concatenate(v_out)), pa.array(np.concatenate(s_out))],
                        ["query_id", "vec_id", "score"])
    return run


def exact_top_k(vectors: DataFrame, queries, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score of the k highest integer inner products of each row that meets the condition
    ``queries`` with all other rows."""
    rows = quantised(vectors)
    n = rows.count()
    m = rows.where(queries).count()
    nv, nq = max(1, -(-n // VECTOR_BLOCK)), max(1, -(-m // QUERY_BLOCK))
    v = blocks(rows, nv, "v").withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    q = blocks(rows.where(queries), nq, "q")
    pairs = v.join(q, ["q_block", "dim"]).select("dim", "q_ids", "q_values", "v_ids", "v_values")
    found = (pairs.repartition(max(nv * nq, 12), F.xxhash64("v_ids", "q_ids"))
             .mapInArrow(_search(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
