"""Operator 13: alignment of two tokenizers over the same bytes.

The tokens of both vocabularies (A byte-level, B sentence-piece) are laid over the text's bytes; places where both end cut them into
groups, and every stretch between two neighbouring ends of either is one link (one A and one B token that overlap there).
An identity map from A ids to the B id of the same bytes is made beforehand.  Links of the map (all one-to-one groups, unless B
fell back to bytes) are counted in vectors as long as the A vocabulary, one a task; only the other links enter the pair
shuffle, each once a document, added up within tasks first.

A pair's count is the number of documents that hold it.  Looking counts up again: those of the map and each A id's highest fit a
vector; of the other pairs, those held by at least a HOT-th of all their occurrences (at most HOT pairs, so a proven bound) are sent to all
tasks, the rest are joined, and none of these holds more than a HOT-th of the rows.

Edge cases: null and empty texts, and texts that a vocabulary does not give back byte for byte, have no tokens (zeros, empty
digest); special strings inside texts are plain text; very long texts are aligned in pieces cut at spaces, of about half a
megabyte each (a text without spaces is one piece); repeated rows are documents each, also with an id in common or null; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ragged, written
from .pieces import Digest, Table, decimals, groups, listed, sure_cuts
from .tokens import MARK, CountRules, IdRules, Units

#: Most pairs outside the identity map whose counts go to all tasks.
HOT = 500_000
#: Distinct pairs that a task adds up before it passes them on.
HELD = 1_000_000
B_BITS = 17
_PLACE = 40                                                      # bits below a document's number in a key


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 letters for themselves, the
    other bytes in order from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(rest)}}


class _A(IdRules):
    """Ids of the byte-level file; special strings are plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.model.encode_special_tokens = True
        letter = _byte_letters()
        names = [b""] * len(self.length)
        for t, i in self.model.get_vocab(with_added_tokens=False).items():
            names[i] = bytes(letter[c] for c in t)
        self.names = Table(names)

    def of(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return self.ids(pa.array(data, pa.binary()).cast(pa.string()))


class _B(CountRules):
    """Ids of the sentence-piece file; each piece of text opens with the space that the model itself would put."""

    def __init__(self, path: str):
        super().__init__(path)
        n = self.model.get_piece_size()
        self.names = Table([bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i)
                            else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)])
        self.byte = np.array([self.model.is_byte(i) for i in range(n)])
        self.ids_of = Units(self.encode_ids)

    def encode_ids(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        alone = [i for i, u in enumerate(units) if u == b" "]
        texts = [(u[1:] if u[:1] == b" " else u).decode() for u in units]
        ids = self.model.encode(texts, num_threads=1) if texts else []
        for i, u in enumerate(units):
            if u[:1] == b"\n":
                ids[i] = ids[i][1:]
        for i in alone:
            ids[i] = [self.model.piece_to_id(MARK)]
        return np.array([x for y in ids for x in y], np.uint32), np.array([len(y) for y in ids], np.int64)

    def of(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        offs = np.r_[0, np.cumsum([len(b) for b in data])]
        if not self.cuts:
            ids = self.model.encode([b[1:].decode() for b in data], num_threads=1)
            return np.array([x for y in ids for x in y], np.uint32), np.r_[0, np.cumsum([len(y) for y in ids])].astype(np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(len(data) + 1, np.int64)
        cut = sure_cuts(raw) | (raw == 10)
        cut[offs[:-1][np.diff(offs) > 0]] = True
        s = np.flatnonzero(cut)
        row = self.ids_of.rows(raw, s, np.r_[s[1:], len(raw)])
        size = self.ids_of.size[row]
        return self.ids_of.ids[ragged(self.ids_of.first[row], size)], np.r_[0, np.cumsum(size)][np.searchsorted(s, offs)]


class Pair:
    """Both vocabularies and the identity map between them."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = _A(path_a), _B(path_b)
        of = {}
        for i in range(len(self.b.pieces)):
            name = self.b.names.raw[self.b.names.first[i]:][:self.b.names.size[i]].tobytes()
            if name and (name not in of or self.b.byte[of[name]]):
                of[name] = i
        names = self.a.names
        self.same = np.array([of.get(names.raw[f:f + n].tobytes(), -1) for f, n in zip(names.first.tolist(), names.size.tolist())],
                             np.int64)
        self.digits = decimals(max(len(names.size), len(self.b.pieces)) - 1)

    def links(self, data: list[bytes]) -> dict:
        """Per piece: ok, n_a, n_b, n_groups and the groups' text; per link: piece, a, b."""
        out = {}
        (ia, fa), (ib, fb) = self.a.of(data), self.b.of(data)
        size = np.array([len(x) for x in data], np.int64)
        raw = np.frombuffer(b"".join(data), np.uint8)
        for ids, first, names in ((ia, fa, self.a.names), (ib, fb, self.b.names)):
            had = np.r_[0, np.cumsum(names.size[ids], dtype=np.int64)][first]
            out.setdefault("ok", np.ones(len(data), bool))
            out["ok"] &= np.diff(had) == size
        if not out["ok"].all():                                  # lengths differ: leave those pieces out, then compare bytes
            (ia, fa), (ib, fb) = (_kept(i, f, out["ok"]) for i, f in ((ia, fa), (ib, fb)))
            raw = np.frombuffer(b"".join([x for x, ok in zip(data, out["ok"]) if ok]), np.uint8)
            size = np.where(out["ok"], size, 0)
        place = np.r_[0, np.cumsum(size)]
        for ids, names in ((ia, self.a.names), (ib, self.b.names)):
            wrong = np.flatnonzero(names.bytes_of(ids) != raw)
            out["ok"][np.searchsorted(place, wrong, "right") - 1] = False
        ea, eb = (np.cumsum(n.size[i], dtype=np.int64) for n, i in ((self.a.names, ia), (self.b.names, ib)))
        in_a, in_b = np.zeros(len(raw) + 1, bool), np.zeros(len(raw) + 1, bool)
        in_a[ea], in_b[eb] = True, True
        ends = np.flatnonzero(in_a | in_b)                       # each closes one link
        shared = in_a[ends] & in_b[ends]
        at_a = np.cumsum(in_a[ends]) - in_a[ends]                # the tokens that cover the byte before each end
        at_b = np.cumsum(in_b[ends]) - in_b[ends]
        out["piece"] = np.searchsorted(place, ends, "left") - 1
        out["a"], out["b"] = ia[at_a].astype(np.int64), ib[at_b].astype(np.int64)
        n = len(data)
        out["n_a"], out["n_b"] = np.diff(fa), np.diff(fb)
        out["n_groups"] = np.bincount(out["piece"][shared], minlength=n)
        # the groups' text: A ids, then B ids, group by group
        group = np.cumsum(shared) - shared
        ga = group[in_a[ends]]                                   # group of each A token, of each B token
        gb = group[in_b[ends]]
        last_a, last_b = np.r_[ga[1:] != ga[:-1], True][:len(ga)], np.r_[gb[1:] != gb[:-1], True][:len(gb)]
        ids = np.empty(len(ia) + len(ib), np.int64)
        after = np.empty(len(ids), np.uint8)
        pa_, pb_ = np.arange(len(ia)) + np.searchsorted(gb, ga, "left"), np.arange(len(ib)) + np.searchsorted(ga, gb, "right")
        ids[pa_], ids[pb_] = ia, ib
        after[pa_], after[pb_] = np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))
        text, width = listed(self.digits, ids, after)
        out["text"] = memoryview(text)
        out["text_at"] = np.r_[0, np.cumsum(width)][fa + fb]
        return out


def _kept(ids: np.ndarray, first: np.ndarray, ok: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = np.diff(first)
    return ids[np.repeat(ok, size)], np.r_[0, np.cumsum(np.where(ok, size, 0))]


@functools.cache
def pair(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


_LINKS = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "same array<int>, same_n array<int>, a array<int>, b array<int>, n array<int>")


def links(docs: DataFrame, path_a: str, path_b: str, most: int | None = None) -> DataFrame:
    """Per document: a number of its own (row), counts and the groups' digest; its distinct links of the identity map (A ids ``same``
    with occurrences ``same_n``) and its others (``a``, ``b``, ``n``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        p = pair(path_a, path_b)
        number = TaskContext.get().partitionId() << 33
        for batch in batches:
            t = batch.column(1)
            some = pa.compute.fill_null(pa.compute.greater(pa.compute.binary_length(t), 0), False)
            for part in _rows(p, pa.compute.if_else(some, t, pa.scalar(None, t.type)), most):
                i = part.pop("i")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number + i), batch.column(0).take(pa.array(i)), *part.values()],
                    ["row", "doc_id", *part])
            number += len(batch)
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(run, _LINKS)


def _rows(p: Pair, texts: pa.Array, most: int | None) -> Iterator[dict]:
    """The columns of ``links`` for finished rows (i), a group of pieces at a time; only an unfinished row is carried over."""
    held: list = []                                              # keys and occurrences of the unfinished row
    sums, sha, ok = np.zeros(4, np.int64), Digest(b";"), True
    for rows, data, last in groups(texts, b" ", **({"most": most} if most else {})):
        empty = ~np.asarray(texts.take(pa.array(rows)).is_valid())
        found = p.links([b"" if e else x for x, e in zip(data, empty.tolist())])
        key = (found["piece"] << _PLACE) | (found["a"] << B_BITS) | found["b"]
        key, n = np.unique(key, return_counts=True)
        first = np.searchsorted(key, np.arange(len(data) + 1) << _PLACE)
        key &= (1 << _PLACE) - 1
        done, table, digests, keys, times = [], [], [], [], []
        for i, end in enumerate(last):
            ok = ok and bool(found["ok"][i])
            sums += (found["n_a"][i], found["n_b"][i], found["n_groups"][i], 0)
            sha.add(found["text"][found["text_at"][i]:found["text_at"][i + 1]])
            held.append((key[first[i]:first[i + 1]], n[first[i]:first[i + 1]]))
            if not end:
                continue
            k, m = held[0] if len(held) == 1 else _added(held)
            if not ok:
                sums[:], k, m = 0, k[:0], m[:0]
            sums[3] = sums[0] + sums[1] - sums[2]
            done.append(rows[i])
            table.append(sums.copy())
            digests.append(sha.hexdigest() if ok and sha.some else "")
            keys.append(k)
            times.append(m)
            held, sums, sha, ok = [], np.zeros(4, np.int64), Digest(b";"), True
        if done:
            yield _columns(p, done, table, digests, keys, times)


def _added(held: list) -> tuple[np.ndarray, np.ndarray]:
    key, inverse = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
    return key, np.bincount(inverse, np.concatenate([n for _, n in held])).astype(np.int64)


def _columns(p: Pair, done, table, digests, keys, times) -> dict:
    size = np.array([len(k) for k in keys])
    key, n = np.concatenate(keys), np.concatenate(times)
    row = np.repeat(np.arange(len(keys)), size)
    a, b = key >> B_BITS, key & ((1 << B_BITS) - 1)
    same = p.same[a] == b

    def lists(x, keep):
        at = np.r_[0, np.cumsum(np.bincount(row[keep], minlength=len(keys)))].astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(x[keep].astype(np.int32)))
    counts = np.array(table).T
    return {"i": np.array(done), **{c: pa.array(x) for c, x in zip(("n_a", "n_b", "n_groups", "n_links"), counts)},
            "groups_sha256": pa.array(digests, pa.string()), "same": lists(a, same), "same_n": lists(n, same),
            "a": lists(a, ~same), "b": lists(b, ~same), "n": lists(n, ~same)}


# ---- counts over the corpus ---------------------------------------------------------------------------

def _flat(col: pa.Array) -> np.ndarray:
    return np.asarray(col.flatten()).astype(np.int64)


def _documents_of_same(t: DataFrame, size: int) -> DataFrame:
    """a, docs: how many documents hold each link of the identity map; one vector a task."""
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_flat(batch.column(0)), minlength=size)
        a = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(total[a])], ["a", "docs"])
    return t.select("same").mapInArrow(run, "a long, docs long").groupBy("a").agg(F.sum("docs").alias("docs"))


def _documents_of_others(t: DataFrame) -> DataFrame:
    """key, docs: how many documents hold each other pair; added up within a task before the shuffle."""
    def run(batches):
        key, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                part = batch.slice(at, 1000)
                new = (_flat(part.column(0)) << B_BITS) | _flat(part.column(1))
                key, n = _added([(key, n), (new, np.ones(len(new), np.int64))])
                if len(key) > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "docs"])
                    key, n = key[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "docs"])
    return t.select("a", "b").mapInArrow(run, "key long, docs long").groupBy("key").agg(F.sum("docs").alias("docs"))


def _vector(df: DataFrame, size: int) -> np.ndarray:
    """Rows (a, docs), at most one an id of the vocabulary, as a vector."""
    x = df.toArrow()
    out = np.zeros(size, np.int64)
    out[np.asarray(x.column(0))] = np.asarray(x.column(1))
    return out


def aligned(docs: DataFrame, path_a: str, path_b: str, hot: int = HOT, most: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; and the table a, b, docs of all pairs
    of ids that are linked anywhere.  Both paths must name the vocabulary files on every worker."""
    t = written(links(docs, path_a, path_b, most), "links", compression="zstd")
    p = pair(path_a, path_b)
    size = len(p.same)
    same = written(_documents_of_same(t, size), "same")
    others = written(_documents_of_others(t), "others")
    total = others.agg(F.sum("docs")).first()[0] or 0
    often = max(1, -(-total // hot))
    top = others.select(F.shiftright("key", B_BITS).alias("a"), "docs").unionByName(same).groupBy("a").agg(
        F.max("docs").alias("docs"))
    of_same, best = _vector(same, size), _vector(top, size)
    many = others.where(F.col("docs") >= often).orderBy("key").toArrow()       # at most ``hot`` rows
    hot_key, hot_docs = np.asarray(many.column(0)), np.asarray(many.column(1))

    def look(part):
        """Occurrences' key, row and n, with the documents of hot keys (0: not hot)."""
        a, b, n = (_flat(part.column(part.schema.get_field_index(c))) for c in ("a", "b", "n"))
        row = np.repeat(np.arange(len(part)), np.asarray(pa.compute.list_value_length(part.column(
            part.schema.get_field_index("n")))))
        key = (a << B_BITS) | b
        at = np.searchsorted(hot_key, key)
        at[at == len(hot_key)] = 0
        return key, row, n, np.where(hot_key[at] == key, hot_docs[at], 0) if len(hot_key) else np.zeros(len(key), np.int64)

    def score(batches):
        for batch in batches:
            s, sn = _flat(batch.column(1)), _flat(batch.column(2))
            row = np.repeat(np.arange(len(batch)), np.asarray(pa.compute.list_value_length(batch.column(1))))
            key, r, n, d = look(batch)
            count, good = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(count, row, sn * of_same[s])
            np.add.at(good, row, sn * (of_same[s] == best[s]))
            np.add.at(count, r, n * d)
            np.add.at(good, r, n * ((d == best[key >> B_BITS]) & (d > 0)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(good), pa.array(count)],
                                             ["row", "n_best", "count_sum"])

    def cold(batches):
        for batch in batches:
            key, r, n, d = look(batch)
            k = np.flatnonzero(d == 0)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(r[k])), pa.array(key[k]), pa.array(n[k]), pa.array(
                best[key[k] >> B_BITS])], ["row", "key", "n", "best"])

    scores = t.select("row", "same", "same_n", "a", "b", "n").mapInArrow(score, "row long, n_best long, count_sum long")
    rare = t.select("row", "a", "b", "n").mapInArrow(cold, "row long, key long, n long, best long").join(
        others.where(F.col("docs") < often), "key")
    more = rare.select("row", F.when(F.col("docs") == F.col("best"), F.col("n")).otherwise(0).alias("n_best"),
                       (F.col("n") * F.col("docs")).alias("count_sum"))
    sums = scores.unionByName(more).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    out = t.select("row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums.hint("merge"), "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    both = docs.sparkSession.createDataFrame(                                  # of the vocabulary's size
        pa.table({"a": np.flatnonzero(p.same >= 0), "b": p.same[p.same >= 0]}))
    pairs = both.join(same, "a").unionByName(others.select(
        F.shiftright("key", B_BITS).alias("a"), F.expr(f"key & {(1 << B_BITS) - 1}").alias("b"), "docs"))
    return out, pairs
