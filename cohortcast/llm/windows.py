"""Repeated windows: the machinery that the two substring operators share.

A text is a row of symbols (words or bytes).  Of every window of ``w`` symbols the leftmost smallest hash of its
``k``-symbol grams is its anchor, so equal windows have equal anchors at equal places.  A sketch counts the anchors of the
whole corpus; an anchor that occurs once proves that all windows around it occur once, and only the others
are dealt out, by anchor, to be grouped exactly.  Sketch errors can only add work.  An anchor that makes up a hot share of
all anchors is no key to deal by: its windows go singly, each by its own hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, powers, ragged, written

_STEP = 1 << 21             # symbols worked on at once
BLOCKS = 32                 # blocks of each sketch row
DEPTH = 2
MAX_BITS = 27               # log2 of the cells of a sketch row: at most 2 x 16 MB of flags are sent to the tasks
HOT_SHARE = 1 << 17         # an anchor is hot from this part of all anchors on (so there are at most about that many) ...
HOT_LEAST = 4096            # ... and from this number on


class Rolling:
    """Hashes of any span of a row of 64-bit symbols (polynomial, then mixed)."""

    def __init__(self, symbols: np.ndarray):
        p, self._inv = powers(len(symbols) + 1)
        self._sum = np.zeros(len(symbols) + 1, U64)
        np.cumsum(symbols * p[:len(symbols)], out=self._sum[1:])

    def every(self, k: int) -> np.ndarray:
        n = len(self._sum) - k
        return mix((self._sum[k:] - self._sum[:n]) * self._inv[:n]) if n > 0 else np.empty(0, U64)

    def spans(self, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        return mix((self._sum[e] - self._sum[s]) * self._inv[s])


def pieces(offs: np.ndarray, w: int, step: int = _STEP):
    """Cut texts (offsets into a row of symbols) into groups of pieces of at most about ``step`` symbols.  A long text's
    pieces overlap by w - 1, so each window lies in just one.  Yields lists of (text, from, to)."""
    held, size = [], 0
    for i, (s, e) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist())):
        at = s
        while e - at >= w:
            end = min(e, at + step + w - 1)
            held.append((i, at, end))
            size += end - at
            at += step
            if size >= step:
                yield held
                held, size = [], 0
    if held:
        yield held


class Anchors:
    """Runs of windows by anchor in one group of pieces.

    anchor: the hash; text; start: the run's first window, as an index into the text; at: the anchor's index in the
    text; count: how many windows; base: where start lies in the row of symbols; roll: the piece's hashes, lo: where
    the piece begins in the row."""

    def __init__(self, symbols: np.ndarray, offs: np.ndarray, group: list, w: int, k: int):
        lo, hi = group[0][1], group[-1][2]
        self.lo = lo
        self.roll = Rolling(symbols[lo:hi])
        grams = self.roll.every(k)
        m = w - k + 1
        n = hi - lo - w + 1
        value, place, span = grams, np.arange(len(grams), dtype=np.int32), 1
        while 2 * span <= m:                                    # leftmost smallest of 2, 4, ... grams
            value, place = _lower(value, place, span)
            span *= 2
        if span < m:
            value, place = _lower(value, place, m - span)
        ok = np.zeros(n, bool)
        owner = np.zeros(n, np.int32)
        for j, (i, s, e) in enumerate(group):
            ok[s - lo:e - lo - w + 1] = True
            owner[s - lo:e - lo - w + 1] = j
        at = np.flatnonzero(ok)
        place, owner = place[at], owner[at]
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        self.count = np.diff(np.r_[first, len(at)]).astype(np.int32)
        self.base = at[first] + lo
        pos = place[first]
        self.anchor = grams[pos]
        text = np.array([g[0] for g in group], np.int64)[owner[first]]
        self.text = text
        begin = offs[text]
        self.start = (self.base - begin).astype(np.int64)
        self.at = (pos + lo - begin).astype(np.int64)


def dealt_runs(a: Anchors, keep: np.ndarray, hot: np.ndarray, w: int):
    """(anchor, text, start, rel, count, base) of the runs ``keep``; rel: from the run's first window to its anchor, base:
    within the piece.  Runs of hot anchors (sorted) come as single windows, each under a hash of window and anchor."""
    anchor, text, start, count = a.anchor[keep], a.text[keep], a.start[keep], a.count[keep].astype(np.int64)
    rel, base = a.at[keep] - start, a.base[keep] - a.lo
    if not len(hot) or not len(anchor):
        return anchor, text, start, rel, count, base
    at = np.minimum(np.searchsorted(hot, anchor), len(hot) - 1)
    split = hot[at] == anchor
    n = np.where(split, count, 1)
    row = np.repeat(np.arange(len(n)), n)
    step = ragged(np.zeros(len(n), np.int64), n)
    anchor, text, split = anchor[row], text[row], split[row]
    start, rel, base = start[row] + step, rel[row] - step, base[row] + step
    one = base[split]
    anchor[split] = mix(anchor[split] ^ mix(a.roll.spans(one, one + w) + U64(3)))
    return anchor, text, start, rel, np.where(split, 1, count[row]), base


def _lower(value, place, d):
    a, b = value[:-d], value[d:]
    right = b < a
    return np.where(right, b, a), np.where(right, place[d:], place[:-d])


# ---- the sketch --------------------------------------------------------------------------------------

def cells(anchors: np.ndarray, bits: int) -> list[np.ndarray]:
    return [(anchors >> U64(64 - bits)).astype(np.int64),
            ((anchors * U64(0xD6E8FEB86659FD93)) >> U64(64 - bits)).astype(np.int64)]


def counted(docs: DataFrame, anchors_of, bits: int) -> DataFrame:
    """Rows (block, at, twice): per task the cells that its anchors hit, as sorted offsets, and which it hit twice.
    Blocks below 0 hold the task's frequent anchors (at least half a hot share of its own) and their counts.

    ``anchors_of(batch)`` yields arrays of anchor hashes."""
    width = (1 << bits) // BLOCKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            x = np.concatenate(held)
            out = []
            for d, c in enumerate(cells(x, bits)):
                c.sort()
                new = np.r_[True, c[1:] != c[:-1]]
                first = np.flatnonzero(new)
                c, twice = c[first], np.diff(np.r_[first, len(c)]) > 1
                edge = np.searchsorted(c, np.arange(BLOCKS + 1) * width)
                for b in range(BLOCKS):
                    s, e = edge[b], edge[b + 1]
                    if e > s:
                        gaps = np.diff(c[s:e] - b * width, prepend=0).astype("<u4")
                        out.append((d * BLOCKS + b, gaps.view(np.uint8).reshape(-1, 4).T.tobytes(),
                                    np.packbits(twice[s:e]).tobytes()))
            x.sort()
            first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            n = np.diff(np.r_[first, len(x)])
            often = n >= max(2, len(x) // (2 * HOT_SHARE))
            x, n = x[first[often]], n[often]
            own = (x % U64(BLOCKS)).astype(np.int64)
            for b in np.unique(own).tolist():
                out.append((-1 - b, x[own == b].tobytes(), n[own == b].astype("<u4").tobytes()))
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.binary()),
                 pa.array([r[2] for r in out], pa.binary())], ["block", "at", "twice"])
        for batch in batches:
            for a in anchors_of(batch):
                held.append(a)
                size += len(a)
                if size > 4_000_000:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()
    return docs.mapInArrow(run, "block int, at binary, twice binary")


def _merged(bits: int, hot: int):
    """Rows (block, flags): which cells are hit twice or more; below 0 the anchors that occur ``hot`` times or more."""
    width = (1 << bits) // BLOCKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None

        def row():
            flags = total[0][total[1] >= hot] if now < 0 else np.packbits(total >= 2)
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([flags.tobytes()], pa.binary())],
                                              ["block", "flags"])
        for batch in batches:
            for b, at, twice in zip(*(c.to_pylist() for c in batch.columns)):
                if b != now:
                    if now is not None:
                        yield row()
                    now, total = b, (np.empty(0, U64), np.empty(0, np.int64)) if b < 0 else np.zeros(width, np.uint8)
                if b < 0:
                    x, which = np.unique(np.r_[total[0], np.frombuffer(at, U64)], return_inverse=True)
                    n = np.bincount(which, np.r_[total[1], np.frombuffer(twice, "<u4")]).astype(np.int64)
                    total = x, n
                    continue
                x = np.ascontiguousarray(np.frombuffer(at, np.uint8).reshape(4, -1).T).view("<u4").ravel()
                x = np.cumsum(x.astype(np.int64))
                more = 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(x))
                total[x] = np.minimum(total[x] + more, 2)        # saturates: two is all that matters
        if now is not None:
            yield row()
    return run


class Flags:
    """Which anchors the merged sketch estimates to occur twice or more (broadcast; at most 2 ** MAX_BITS bits a row),
    and the hot ones (sorted; their share bounds them to about HOT_SHARE)."""

    def __init__(self, sketch: DataFrame, bits: int, expected: int, hot_least: int = HOT_LEAST):
        self.bits = bits
        width = (1 << bits) // BLOCKS
        merged = _merged(bits, max(hot_least, expected // HOT_SHARE))
        rows = ((sketch.repartition((DEPTH + 1) * BLOCKS, "block").sortWithinPartitions("block"))
                .mapInArrow(merged, "block int, flags binary").collect())
        flags = np.zeros((DEPTH, (1 << bits) // 8), np.uint8)
        for r in rows:
            if r.block >= 0:
                d, b = divmod(r.block, BLOCKS)
                flags[d, b * width // 8:(b + 1) * width // 8] = np.frombuffer(r.flags, np.uint8)
        self.flags = flags
        self.hot = np.sort(np.concatenate([np.empty(0, U64), *(np.frombuffer(r.flags, U64) for r in rows if r.block < 0)]))

    def __call__(self, anchors: np.ndarray) -> np.ndarray:
        ok = np.ones(len(anchors), bool)
        for f, c in zip(self.flags, cells(anchors, self.bits)):
            ok &= (f[c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 == 1
        return ok


def expected_anchors(symbols: int, w: int, k: int) -> int:
    return 2 * symbols // (w - k + 2)


def sketch_bits(anchors: int) -> int:
    """Cells per row: about eight for each expected anchor, within 2 ** 16 and 2 ** MAX_BITS."""
    return int(min(MAX_BITS, max(16, np.ceil(np.log2(8 * anchors + 1)))))


def repeat_flags(docs: DataFrame, anchors_of, anchors: int, hot_least: int):
    """The broadcast ``Flags`` of the documents' anchors."""
    bits = sketch_bits(anchors)
    return docs.sparkSession.sparkContext.broadcast(Flags(counted(docs, anchors_of, bits), bits, anchors, hot_least))


# ---- what the exact step returns ----------------------------------------------------------------------

def led(key: np.ndarray, doc: np.ndarray, start: np.ndarray):
    """Of equal runs in one slice: the indexes of the first ones, and which others repeat one at another place."""
    _, first, which = np.unique(key, return_index=True, return_inverse=True)
    of = first[which]
    return np.sort(first), (doc != doc[of]) | (start != start[of])


def spans_by_document(runs: DataFrame, w: int) -> DataFrame:
    """(doc_id, spans): of the runs (doc, start, count) of repeated windows, the union of the symbols covered, as
    int64 pairs from and to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for s, n in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                s, n = np.array(s, np.int64), np.array(n, np.int64)
                order = np.argsort(s, kind="stable")
                s, e = s[order], (s + n + w - 1)[order]
                e = np.maximum.accumulate(e)
                new = np.r_[True, s[1:] > e[:-1]]
                out.append(np.stack([s[new], e[np.r_[new[1:], True]]], 1).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["doc_id", "spans"])
    grouped = runs.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("x"))
    return grouped.select(F.col("doc").alias("doc_id"), "x.start", "x.n").mapInArrow(run, "doc_id long, spans binary")


def attach_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """documents with their spans; broadcast only if all spans together were measured to be small."""
    spans = written(spans, "spans")
    n, size = spans.agg(F.count("*"), F.coalesce(F.sum(F.length("spans")), F.lit(0))).first()
    small = n <= 400_000 and size <= 16 << 20
    return docs.join(F.broadcast(spans) if small else spans.hint("merge"), "doc_id", "left")


def pack(to: np.ndarray, columns: list[np.ndarray], names: list[str], ragged_column=None):
    """Rows (part, one binary per column) with the rows of each part together.  ``ragged_column``: (values, starts,
    lengths), gathered in the same order."""
    order = np.argsort(to, kind="stable")
    to = to[order]
    cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.empty(0, np.int64)
    ends = np.r_[cut[1:], len(to)].astype(np.int64)
    arrays = [pa.array(to[cut].astype(np.int32))]
    for c in columns:
        c = c[order]
        arrays.append(pa.array([c[s:e].tobytes() for s, e in zip(cut, ends)], pa.binary()))
    if ragged_column is not None:
        values, starts, lens = ragged_column
        blobs = []
        for s, e in zip(cut, ends):
            at = order[s:e]
            blobs.append(values[ragged(starts[at], lens[at])].tobytes())
        arrays.append(pa.array(blobs, pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["part", *names])
