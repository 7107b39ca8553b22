"""Operator 5: exact removal of repeated 20-word windows behind a count-min prefilter.

First pass: every task counts its windows into a sketch, each by its anchor (see windows.py), and the tasks'
sketches are merged; the merged estimate of a window is never below its true count.  Second pass: windows whose
estimate is one are left alone, all others are dealt out by anchor and grouped exactly by their word sequence (two
independent 64-bit hashes); in each group every window but the first (doc_id, start) is repeated.  A window that
already repeats within one task's slice of rows is settled there, so a passage that a third of all documents hold sends
one row per slice.  An anchor that makes up a hot share of all (a phrase that many documents hold between different
words) is split: its windows are dealt out singly, by their own hash.  The words covered by repeated windows are then
removed, judged on the input.

Edge cases: null text has no words and stays (n_words 0, empty hash input); texts under 20 words have no window; rows of
null doc_id take no part in the comparison and keep all words; rows that repeat a doc_id are compared in order of
start, equal ones as the same place; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, mix, partitions, ragged, slices, words
from .jaccard import by_part
from .windows import (HOT_LEAST, Anchors, attach_spans, dealt_runs, expected_anchors, led, pack, pieces, repeat_flags,
                      spans_by_document)

W, K = 20, 10
CHUNK = 8 << 20


def _anchors_of(batch):
    for part in slices(batch, "text", CHUNK):
        h, offs = words(part.column(1), lower=False)
        for group in pieces(offs, W):
            a = Anchors(h, offs, group, W, K)
            yield a.anchor


def _estimated(flags, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                part = part.take(pa.compute.sort_indices(part.column(0)))
                ids = np.asarray(part.column(0).fill_null(0)).astype(np.int64)
                h, offs = words(part.column(1), lower=False)
                for group in pieces(offs, W):
                    a = Anchors(h, offs, group, W, K)
                    keep = np.flatnonzero(flags.value(a.anchor))
                    if not len(keep):
                        continue
                    anchor, text, start, _, count, base = dealt_runs(a, keep, flags.value.hot, W)
                    # equal anchors, first and last windows: equal runs; the first in the slice stands for them
                    first, last = a.roll.spans(base, base + W), a.roll.spans(base + count - 1, base + count - 1 + W)
                    key = mix(anchor ^ mix(first + U64(1)) ^ mix(last + U64(2)) ^ count.astype(U64))
                    doc = ids[text]
                    lead, again = led(key, doc, start)
                    lens = count[lead]
                    every = a.roll.every(W)
                    yield pack(_part(anchor[lead], parts), [anchor[lead], doc[lead], start[lead], lens],
                               ["anchor", "doc", "start", "n", "hashes"], (every, base[lead], lens))
                    if again.any():
                        yield pack(_part(doc[again].astype(U64), parts),
                                   [np.zeros(int(again.sum()), U64), doc[again], start[again], -count[again]],
                                   ["anchor", "doc", "start", "n", "hashes"],
                                   (every, base[again], np.zeros(int(again.sum()), np.int64)))
    return run


def _part(x: np.ndarray, parts: int) -> np.ndarray:
    return (mix(x.copy()) % U64(parts)).astype(np.int32)


def runs_of(doc: np.ndarray, start: np.ndarray) -> pa.RecordBatch:
    """(doc, start, n) of consecutive starts; the input is sorted by both."""
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc[first]), pa.array(start[first]), pa.array(np.diff(np.r_[first, len(doc)]))],
        ["doc", "start", "n"])


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in by_part(batches):
        anchor, doc, start, n, h = (np.frombuffer(b"".join(r[i] for r in rows), t) for i, t in
                                    ((1, U64), (2, np.int64), (3, np.int64), (4, np.int64), (5, U64)))
        settled = n < 0
        if settled.any():
            yield pa.RecordBatch.from_arrays([pa.array(doc[settled]), pa.array(start[settled]), pa.array(-n[settled])],
                                             ["doc", "start", "n"])
        own = ~settled
        anchor, doc, start, n = anchor[own], doc[own], start[own], n[own]
        if not len(doc):
            continue
        at = np.cumsum(n) - n
        order = np.lexsort((start, doc))
        anchor, doc, start, n, at = anchor[order], doc[order], start[order], n[order], at[order]
        h = h[ragged(at, n)]
        start, doc, anchor = ragged(start, n), np.repeat(doc, n), np.repeat(anchor, n)
        order = np.argsort(h, kind="stable")
        if len(h) and (h[order][1:] == h[order][:-1])[anchor[order][1:] != anchor[order][:-1]].any():
            order = np.lexsort((h, anchor))
        h, anchor, doc, start = h[order], anchor[order], doc[order], start[order]
        same = np.r_[False, (h[1:] == h[:-1]) & (anchor[1:] == anchor[:-1])]
        # the same place twice (repeated rows of one doc_id) is no repetition of itself
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
        again = same & ((doc != doc[lead]) | (start != start[lead]))
        doc, start = doc[again], start[again]
        order = np.lexsort((start, doc))
        if len(order):
            yield runs_of(doc[order], start[order])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", CHUNK):
            total, removed, digest, texts = [], [], [], []
            for t, spans in zip(part.column(1).cast(pa.binary()).to_pylist(), part.column(2).to_pylist()):
                w = (t or b"").split()
                total.append(len(w))
                if spans:
                    at, kept = 0, []
                    for s, e in np.frombuffer(spans, "<i8").reshape(-1, 2).tolist():
                        kept += w[at:s]
                        at = e
                    w = kept + w[at:]
                removed.append(total[-1] - len(w))
                texts.append(b" ".join(w))
                digest.append(hashlib.sha256(texts[-1]).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest),
                 pa.array(texts, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def repeated_windows(docs: DataFrame, hot_least: int = HOT_LEAST) -> DataFrame:
    """(doc, start, n): runs of windows whose word sequence also starts earlier.  Anchors that occur ``hot_least`` times
    and make up a hot share are split (same result)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    flags = repeat_flags(docs, _anchors_of, expected_anchors(size // 6, W, K), hot_least)
    parts = partitions(spark, size // 6, 4_000_000)
    dealt = docs.where("doc_id is not null").mapInArrow(
        _estimated(flags, parts), "part int, anchor binary, doc binary, start binary, n binary, hashes binary")
    return (dealt.repartition(parts, "part").sortWithinPartitions("part")
            .mapInArrow(_grouped, "doc long, start long, n long"))


def substring_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and the kept words (kept, joined by one space)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spans = spans_by_document(repeated_windows(docs), W)
    return attach_spans(docs, spans).select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
