"""Operator 7: suffix-array deduplication of 100-byte strings, built column by column over many segments.

The whole corpus's suffix array is not needed: strings of 100 bytes can only be equal around equal anchors (see
windows.py).  Segments of up to 150 bytes around anchors that a merged sketch estimates to repeat are first dealt out
by anchor as places and hashes: of wholly equal segments one is kept, the others are repeated as a whole.  Only
segments that still share an anchor with another one are cut out of the texts and dealt out by anchor with their
bytes.  A task lays its segments side by side, aligned at their anchors, and builds their collection's suffix
order column by column from the right: each round inserts one symbol in front of every segment's suffix, reorders
stably within an anchor's segments and updates the common prefixes with the neighbour in that order (smallest of
the old ones between the two, plus one, if the new symbols agree).  Wherever a neighbour's common prefix reaches
100 bytes the strings are equal; all but the first (doc_id, start) of a class are repeated.  Rounds read and write
their state in sequence; the external files of the method are Spark's shuffle files, one part of bounded size at
a time.  An anchor that makes up a hot share of all (a line that many documents hold between different
neighbours) is split: its strings are dealt out singly, by their own hash.

Edge cases: null text is empty; texts under 100 bytes keep everything; rows of null doc_id take no part and keep
all bytes; rows that repeat a doc_id are compared as the same place where start and text agree; a removal may split
a UTF-8 character (kept bytes are returned as binary); further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, joined, mix, partitions, ragged, slices, written
from .jaccard import by_part
from .substring import _part, runs_of
from .windows import (HOT_LEAST, Anchors, Rolling, attach_spans, dealt_runs, expected_anchors, led, pack, pieces,
                      repeat_flags, spans_by_document)

W, K = 100, 50
LEFT = W - K                 # most bytes of a segment before its anchor
WIDTH = LEFT + W             # columns of a part
CHUNK = 4 << 20
STEP = 1 << 19               # bytes hashed at once
CUT = 1 << 20                # bytes that segments are cut out of at once
SEGMENTS = 25_000            # segments laid out at once
END = 255                    # never a byte of UTF-8
_SYMBOL = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def _anchors_of(batch):
    for part in slices(batch, "text", CHUNK):
        raw, offs = joined(part.column(1))
        for group in pieces(offs, W, STEP):
            lo, hi = group[0][1], group[-1][2]
            yield Anchors(_SYMBOL[raw[lo:hi]], offs - lo, [(i, s - lo, e - lo) for i, s, e in group], W, K).anchor


def _keys(anchor, whole, count, rel):
    """A hash of each segment: its anchor, all its bytes, and where the anchor lies."""
    return mix(anchor ^ mix(whole + U64(1)) ^ (count * 256 + rel).astype(U64))


def _estimated(flags, parts: int):
    """Runs of windows whose anchors the sketch lets through, as places; equal ones of a slice are settled (n < 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "key", "doc", "start", "at", "n"]
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                part = part.take(pa.compute.sort_indices(part.column(0)))
                ids = np.asarray(part.column(0).fill_null(0)).astype(np.int64)
                raw, offs = joined(part.column(1))
                found = []
                for group in pieces(offs, W, STEP):
                    lo, hi = group[0][1], group[-1][2]
                    a = Anchors(_SYMBOL[raw[lo:hi]], offs - lo, [(i, s - lo, e - lo) for i, s, e in group], W, K)
                    keep = np.flatnonzero(flags.value(a.anchor))
                    if not len(keep):
                        continue
                    anchor, text, start, rel, count, base = dealt_runs(a, keep, flags.value.hot, W)
                    key = _keys(anchor, a.roll.spans(base, base + count - 1 + W), count, rel)
                    found.append((key, anchor, ids[text], start, rel.astype(np.uint8), count.astype(np.int16)))
                if not found:
                    continue
                key, anchor, doc, start, rel, count = (np.concatenate(x) for x in zip(*found))
                lead, again = led(key, doc, start)
                yield pack(_part(anchor[lead], parts), [x[lead] for x in (anchor, key, doc, start, rel, count)], names)
                if again.any():
                    none = np.zeros(int(again.sum()), U64)
                    yield pack(_part(doc[again].astype(U64), parts),
                               [none, none, doc[again], start[again], none.astype(np.uint8), -count[again]], names)
    return run


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of equal segments all but the first as runs of repeated windows (at -1); the first with its anchor, if another
    segment shares it."""
    def rows_of(doc, start, n, anchor=None, key=None, at=None):
        none = np.zeros(len(doc), np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(doc), pa.array(start), pa.array(n), pa.array(none if anchor is None else anchor.view(np.int64)),
             pa.array(none if key is None else key.view(np.int64)),
             pa.array((none - 1 if at is None else at).astype(np.int32))], ["doc", "start", "n", "anchor", "key", "at"])
    for _, rows in by_part(batches):
        kinds = ((1, U64), (2, U64), (3, np.int64), (4, np.int64), (5, np.uint8), (6, np.int16))
        anchor, key, doc, start, at, n = (np.frombuffer(b"".join(r[i] for r in rows), t) for i, t in kinds)
        n = n.astype(np.int64)
        own = n > 0
        yield rows_of(doc[~own], start[~own], -n[~own])
        order = np.flatnonzero(own)
        order = order[np.lexsort((start[order], doc[order], key[order], anchor[order]))]
        if not len(order):
            continue
        a, k, d, s = anchor[order], key[order], doc[order], start[order]
        new = np.r_[True, (a[1:] != a[:-1]) | (k[1:] != k[:-1])]
        lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        again = order[~new & ((d != d[lead]) | (s != s[lead]))]
        yield rows_of(doc[again], start[again], n[again])
        first = order[new]
        same = anchor[first][1:] == anchor[first][:-1]
        first = first[np.r_[same, False] | np.r_[False, same]]
        yield rows_of(doc[first], start[first], n[first], anchor[first], key[first], at[first])


def _segments(parts: int):
    """The bytes of segments (lists start, n, anchor, key, at) of each text, dealt out by anchor.  A segment that a
    text does not hold (another row of its doc_id does) is left to that row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CUT):
                raw, offs = joined(part.column(1))
                many = np.asarray(pa.compute.list_value_length(part.column(2))).astype(np.int64)
                row = np.repeat(np.arange(len(many)), many)
                start, n, anchor, key, at = (np.asarray(part.column(i).flatten()) for i in range(2, 7))
                s = offs[row] + start
                e = s + n - 1 + W
                inside = np.flatnonzero(e <= offs[row + 1])
                whole = Rolling(_SYMBOL[raw]).spans(s[inside], e[inside])
                anchor, key = anchor.view(U64), key.view(U64)
                ok = inside[_keys(anchor[inside], whole, n[inside], at[inside].astype(np.int64)) == key[inside]]
                if len(ok):
                    doc = np.asarray(part.column(0)).astype(np.int64)[row[ok]]
                    yield pack(_part(anchor[ok], parts),
                               [anchor[ok], doc, start[ok], at[ok].astype(np.uint8), n[ok].astype(np.int16)],
                               ["anchor", "doc", "start", "at", "n", "bytes"], (raw, s[ok], (e - s)[ok]))
    return run


def equal_strings(group: np.ndarray, columns: np.ndarray, w: int):
    """For segments sorted by ``group``, laid out as rows of ``columns`` bytes, yield for each column from the right
    (column, order, common): the order of the suffixes that start there, within their groups, and each one's common
    prefix with the one before it in that order (0 at the start of a group, and counted up to ``w``)."""
    m, width = columns.shape
    order = np.arange(m)
    start = np.r_[True, group[1:] != group[:-1]]
    common = np.zeros(m, np.int32)
    by_column = np.ascontiguousarray(columns.T)
    number = np.cumsum(start) - 1
    for c in range(width - 1, -1, -1):
        sym = by_column[c][order]
        differ = np.r_[False, sym[1:] != sym[:-1]] & ~start
        common += 1
        common[start] = 0
        if differ.any():
            mixed = np.zeros(number[-1] + 1, bool)
            mixed[number[differ]] = True                    # groups whose order may change in this round
            at = np.flatnonzero(mixed[number])
            # stable: those with the same new symbol keep the order of what follows
            new = at[np.lexsort((sym[at], number[at]))]
            old_common = common.copy()
            moved = sym[new]
            same = np.r_[False, (moved[1:] == moved[:-1]) & (number[at][1:] == number[at][:-1])]
            common[at[~same]] = 0
            k = np.flatnonzero(same)
            if len(k):                                      # the smallest common prefix between the two, old order
                bounds = np.stack([new[k - 1] + 1, new[k] + 1], 1).ravel()
                low = np.minimum.reduceat(np.r_[old_common, 0], bounds)[::2]
                common[at[k]] = low
            order[at] = order[new]
        np.minimum(common, w, out=common)
        yield c, order, common


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in by_part(batches):
        kinds = ((1, U64), (2, np.int64), (3, np.int64), (4, np.uint8), (5, np.int16), (6, np.uint8))
        anchor, doc, start, at, n, raw = (np.frombuffer(b"".join(r[i] for r in rows), t) for i, t in kinds)
        n = n.astype(np.int64)
        size = n - 1 + W
        place = np.cumsum(size) - size
        order = np.lexsort((start, doc, anchor))
        same = anchor[order][1:] == anchor[order][:-1]
        order = order[np.r_[same, False] | np.r_[False, same]] if len(order) > 1 else order[:0]
        # an anchor's segments stay together; a step holds as many anchors as fit (one just below hot may exceed it)
        group = anchor[order]
        edge = np.flatnonzero(np.r_[True, group[1:] != group[:-1]]) if len(group) else np.empty(0, np.int64)
        begin = 0
        while begin < len(order):
            j = np.searchsorted(edge, begin + SEGMENTS)
            stop = int(edge[j]) if j < len(edge) else len(order)
            take = order[begin:stop]
            begin = stop
            first = LEFT - at[take].astype(np.int64)        # column of the segment's first window
            columns = np.full((len(take), WIDTH), END, np.uint8)
            to = ragged(np.arange(len(take)) * WIDTH + first, size[take])
            columns.ravel()[to] = raw[ragged(place[take], size[take])]
            last = first + n[take] - 1
            d, s = doc[take], start[take]
            repeated: list[np.ndarray] = []
            index = np.arange(len(take))
            for c, by, common in equal_strings(group[begin - len(take):begin], columns, W):
                if c > LEFT:
                    continue
                full = common >= W                          # with the one before: equal strings of W bytes
                if not full.any():
                    continue
                lead = np.maximum.accumulate(np.where(full, 0, index))
                touched = np.flatnonzero(full)
                # the smallest row of a class is its first, as rows are in order of (anchor, doc, start)
                cls = np.unique(lead[touched])
                members = np.union1d(touched, cls)
                least = np.full(len(take), len(take))
                np.minimum.at(least, lead[members], by[members])
                x, y = by[members], least[lead[members]]
                ok = (x != y) & ((d[x] != d[y]) | (s[x] - first[x] != s[y] - first[y]))
                ok &= (c >= first[x]) & (c <= last[x])
                x = x[ok]
                if len(x):
                    repeated.append(np.stack([d[x], s[x] + c - first[x]]))
            if repeated:
                x = np.concatenate(repeated, axis=1)
                x = x[:, np.lexsort((x[1], x[0]))]
                yield runs_of(x[0], x[1])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            size, removed, number, digest, kept = [], [], [], [], []
            for t, spans in zip(part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist()):
                t = t or b""
                x = np.frombuffer(spans, "<i8").reshape(-1, 2).tolist() if spans else []
                size.append(len(t))
                number.append(len(x))
                if x:
                    cut = [0, *(v for pair in x for v in pair), len(t)]
                    t = b"".join(t[s:e] for s, e in zip(cut[::2], cut[1::2]))
                removed.append(size[-1] - len(t))
                kept.append(t)
                digest.append(hashlib.sha256(t).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(number, pa.int64()), pa.array(digest), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_strings(docs: DataFrame, hot_least: int = HOT_LEAST) -> DataFrame:
    """(doc, start, n): runs of starts of 100-byte strings that also start earlier.  Anchors that occur ``hot_least``
    times and make up a hot share are split (same result)."""
    spark = docs.sparkSession
    docs = docs.where("doc_id is not null")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    flags = repeat_flags(docs, _anchors_of, expected_anchors(size, W, K), hot_least)
    parts = partitions(spark, size, 8 << 20)
    dealt = docs.mapInArrow(_estimated(flags, parts), "part int, anchor binary, key binary, doc binary, start binary, "
                                                      "at binary, n binary")
    runs = written(dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(
        _settled, "doc long, start long, n long, anchor long, key long, at int"), "runs")
    open_ = runs.where("at >= 0")
    parts = partitions(spark, open_.count() * WIDTH, 8 << 20)
    lists = open_.groupBy("doc").agg(F.collect_list(F.struct("start", "n", "anchor", "key", "at")).alias("x"))
    lists = lists.select(F.col("doc").alias("doc_id"), "x.start", "x.n", "x.anchor", "x.key", "x.at")
    cut = docs.join(lists.hint("merge"), "doc_id").select("doc_id", "text", "start", "n", "anchor", "key", "at").mapInArrow(
        _segments(parts), "part int, anchor binary, doc binary, start binary, at binary, n binary, bytes binary")
    compared = (cut.repartition(parts, "part").sortWithinPartitions("part")
                .mapInArrow(_grouped, "doc long, start long, n long"))
    return runs.where("at < 0").select("doc", "start", "n").unionByName(compared)


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and the kept bytes."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = spans_by_document(repeated_strings(docs), W)
    return attach_spans(docs, spans).select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
