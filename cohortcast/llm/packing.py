"""Operator 10: packing token pieces into sequences by linear grouping, configurations and best fit.

Documents become token ids plus an end id; those over the capacity are cut into full pieces behind a first, shorter one.  All
that the plan needs is how many pieces have each length, at most ``CAPACITY`` numbers however large the corpus.  Lengths above a
quarter of the capacity are sorted, split into groups of equal cardinality and rounded up to their group's largest; the few
rounded sizes are packed by a configuration linear programme (columns generated by a knapsack), rounded down, with
first-fit-decreasing configurations for what remains.  Then actual lengths are put in for the rounded ones, longest first, and
the smaller pieces go, longest first, into the room that fits best.  The plan is kept in runs of equally filled sequences, as
rows (length, from rank, to rank, first sequence, offset), so its size too is bounded by the number of lengths.
Pieces get a rank within their length by salted counts and meet their plan row by an equality of lengths.

Edge cases: null and empty texts are one piece of the end id alone; rows that repeat are packed each; rows of null doc_id are
packed with a null id; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import join_checked, slices, written
from .tokens import CHUNK, id_rules

CAPACITY = 2048
END = 0
GROUPS = 64
SALT_ROWS = 100_000         # pieces of one length that a task ranks, on average


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and the ids, if asked for) of every piece."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = id_rules(path)
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                ids, offs = rules.ids(part.column(1))
                out = []
                for doc, s, e in zip(part.column(0).to_pylist(), offs[:-1].tolist(), offs[1:].tolist()):
                    x = np.append(ids[s:e], np.uint32(END)).astype("<u4")
                    cut = [0, *range(len(x) % capacity or capacity, len(x) + 1, capacity)]
                    for i, (a, b) in enumerate(zip(cut, cut[1:])):
                        raw = x[a:b].tobytes()
                        out.append((doc, i, a, b - a, zlib.crc32(raw), raw if with_ids else None))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                cols = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays(cols[:5 + with_ids], names[:5 + with_ids])
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, kinds)


# ---- the plan, from the histogram of lengths ---------------------------------------------------------

def linear_groups(hist: list[tuple[int, int]], groups: int) -> list[list[tuple[int, int]]]:
    """(length, count) rows, longest first, in groups of equal cardinality (rows are split where a group ends)."""
    total, out, now, room = sum(n for _, n in hist), [], [], 0
    each = max(1, -(-total // groups))
    room = each
    for length, n in hist:
        while n:
            take = min(n, room)
            now.append((length, take))
            n, room = n - take, room - take
            if not room:
                out.append(now)
                now, room = [], each
    return out + [now] * bool(now)


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(how many of each size, how often), covering the demand exactly."""
    g = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    x = demand / np.diag(basis)
    for _ in range(40 * g):
        y = np.linalg.solve(basis.T, np.ones(g))
        value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(sizes.min()), capacity + 1):          # unbounded knapsack for the column of most worth
            fit = np.where(sizes <= c, value[np.maximum(c - sizes, 0)] + y, -1.0)
            i = int(fit.argmax())
            if fit[i] > value[c - 1]:
                value[c], choice[c] = fit[i], i
            else:
                value[c] = value[c - 1]
        if value[capacity] <= 1 + 1e-7:
            break
        col, c = np.zeros(g), capacity
        while c > 0:
            if choice[c] < 0:
                c -= 1
            else:
                col[choice[c]] += 1
                c -= int(sizes[choice[c]])
        d = np.linalg.solve(basis, col)
        ratio = np.where(d > 1e-9, x / np.where(d > 1e-9, d, 1), np.inf)
        r = int(ratio.argmin())
        x = x - ratio[r] * d
        x[r] = ratio[r]
        basis[:, r] = col
        x = np.maximum(x, 0)
    out, rest = [], demand.astype(np.int64).copy()
    for j in np.argsort(-x):
        a = basis[:, j].round().astype(np.int64)
        n = int(min(np.floor(x[j] + 1e-6), min(rest[a > 0] // a[a > 0])))
        if n > 0:
            out.append((a, n))
            rest -= a * n
    while rest.any():                                            # first fit, decreasing
        a, room = np.zeros(g, np.int64), capacity
        for i in np.argsort(-sizes):
            a[i] = min(rest[i], room // sizes[i])
            room -= int(a[i] * sizes[i])
        n = int(min(rest[a > 0] // a[a > 0]))
        out.append((a, n))
        rest -= a * n
    return out


def plan(hist: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> tuple[list[tuple], int]:
    """Rows (length, from rank, to rank, first sequence, offset) that place every piece, and the number of sequences."""
    rows: list[tuple] = []
    rank: dict[int, int] = defaultdict(int)
    room: dict[int, list[list[int]]] = defaultdict(list)         # free tokens -> runs [first sequence, how many]
    free: list[int] = []                                         # the keys of room, sorted
    made = 0

    def place(length, n, first, offset):
        rows.append((length, rank[length], rank[length] + n, first, offset))
        rank[length] += n

    def keep(slack, first, n):
        if slack:
            if not room[slack]:
                bisect.insort(free, slack)
            room[slack].append([first, n])
    large = sorted(((k, n) for k, n in hist.items() if k > capacity // 4 and n), reverse=True)
    if large:
        grouped = linear_groups(large, groups)
        by_size: dict[int, list] = {}
        for g in grouped:                                        # groups that round to one size are one
            by_size.setdefault(g[0][0], []).extend(g)
        sizes = np.array(list(by_size))
        queues = [list(reversed(by_size[s])) for s in by_size]   # the longest is taken from the end
        demand = np.array([sum(n for _, n in q) for q in queues])
        for a, n in configurations(sizes, demand, capacity):
            slots = []
            for i in np.flatnonzero(a):
                for _ in range(a[i]):
                    need, got = n, []
                    while need:
                        length, m = queues[i][-1]
                        take = min(m, need)
                        got.append((length, take))
                        need -= take
                        queues[i][-1] = (length, m - take)
                        if take == m:
                            queues[i].pop()
                    slots.append(got)
            edges = sorted({0}.union(*({int(v) for v in np.cumsum([m for _, m in s])} for s in slots)))
            at = [[0, 0] for _ in slots]                         # per slot: its part, and what has been used of it
            for s, e in zip(edges, edges[1:]):
                used = 0
                for k, slot in enumerate(slots):
                    length, m = slot[at[k][0]]
                    place(length, e - s, made + s, used)
                    used += length
                    at[k][1] += e - s
                    if at[k][1] == m:
                        at[k] = [at[k][0] + 1, 0]
                keep(capacity - used, made + s, e - s)
            made += n
    for length, n in sorted(((k, n) for k, n in hist.items() if k <= capacity // 4 and n), reverse=True):
        while n:
            at = bisect.bisect_left(free, length)
            if at == len(free):
                more = -(-n // (capacity // length))
                keep(capacity, made, more)
                made += more
                continue
            slack = free[at]
            first, m = room[slack].pop()
            take = min(m, n)
            if m > take:
                room[slack].append([first + take, m - take])
            if not room[slack]:
                free.pop(at)
            place(length, take, first, capacity - slack)
            keep(slack - length, first, take)
            n -= take
    return rows, made


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset.  ``pieces`` must be a written table, as it is read more than once."""
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").count().collect()         # at most ``capacity`` rows
    rows, _ = plan({r["length"]: r["count"] for r in counted}, capacity)
    salts = max(1, -(-sum(r["count"] for r in counted) // SALT_ROWS), 16)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = (salted.groupBy("length", "salt").count()
            .withColumn("base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count"))
    inside = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = join_checked(salted.withColumn("r", F.row_number().over(inside)), base, ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("base") + F.col("r") - 1).drop("salt", "r", "base")
    places = spark.createDataFrame(
        pa.table({c: pa.array([int(r[i]) for r in rows], pa.int64()) for i, c in
                  enumerate(("p_length", "p_from", "p_to", "p_sequence", "p_offset"))}))
    p = F.broadcast(places) if len(rows) <= 400_000 else places
    at = (ranked.length == p.p_length) & (ranked["rank"] >= p.p_from) & (ranked["rank"] < p.p_to)
    return ranked.join(p, at).select(*pieces.columns, (F.col("p_sequence") + F.col("rank") - F.col("p_from"))
                                     .alias("sequence_id"), F.col("p_offset").alias("offset"))


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack_pieces(written(token_pieces(docs, path, capacity), "pieces"), capacity)
