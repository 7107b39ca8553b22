"""Operator 1: n-gram Jaccard join over prefix trees of globally ordered shingle sets.

A document's set is its distinct five-word shingles (64-bit hashes of lower-cased A-Z words).  All sets are
ordered alike, rare shingles first: a merged sketch of counts over the whole corpus gives each shingle a frequency
class (it only sets the order, so its errors cost time and never a link).  Two sets of Jaccard 0.75 or more share
a shingle within their first ``n - ceil(0.75 n) + 1``; such prefixes are dealt out by shingle.  Within a group of
sets that share a prefix shingle every set is first compared with a few hubs; sets that end in different components are then
compared pair by pair, so a group of near copies costs a few comparisons each and no link between components is
missed.  Pairs whose bitmap signatures already prove too many shingles of one set to be missing in the other are
left out.  A comparison puts the sets of a hub, in blocks, into a trie (sets in lexicographic order, each
entering below the prefix that it shares with the one before), walks it once with the hub's set carrying
the partial overlap of the shared path, and leaves a subtree as soon as the overlap so far plus what remains of
either set cannot reach the needed overlap.

Edge cases: null or wordless texts have an empty set, link with nothing and form their own class; texts of one to
four words have one shingle (the whole sequence); identical sets are one node (repeated rows and copies join
through it); rows that repeat a doc_id are one document (of texts that differ, that with the smallest set hash
counts); rows of null doc_id are kept out of
the join and returned as their own class (null); further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, components, forget, give_back, join_checked, mix, partitions, slices, words, written

K = 5
SKETCH_BITS = 20          # counters of the ordering sketch; a fixed 4 MB whatever the input
BLOCKS = 64
CHUNK = 4 << 20           # bytes of text held at once by a task
ROUGH, FINE = 2, 8        # bits a shingle of the signatures: to drop pairs with hubs (mostly unlike sets), and within
FINE_BITS = 2048          # groups (often sets of nearly the same words); large sets have ROUGH bits a shingle in both
HUBS = 4                  # sets of a group that all its others are compared with first
TOKEN_BYTES = 6           # of a prefix shingle's 64 bits that name its group; two that agree in them share a group, which
TOKEN = U64((1 << 8 * TOKEN_BYTES) - 1)     # only adds comparisons
GROUP = 2000              # sets of one prefix shingle that a task compares; larger groups are split into blocks
_MULT = [U64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                          0xA0761D6478BD642F)]


def shingle_sets(texts) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, offs = words(texts, lower=True)
    h = mix(h)
    full = np.zeros(max(len(h) - K + 1, 0), U64)
    for j in range(K):
        full += h[j:len(h) - K + 1 + j] * _MULT[j]
    full = mix(full)
    out = []
    for s, e in zip(offs[:-1].tolist(), offs[1:].tolist()):
        n = e - s
        if n >= K:
            x = np.sort(full[s:e - K + 1])
            keep = np.ones(len(x), bool)
            np.not_equal(x[1:], x[:-1], out=keep[1:])
            out.append(x[keep])
        elif n:
            x = U64(n)
            for j in range(n):
                x = x + h[s + j:s + j + 1] * _MULT[j]
            out.append(mix(mix(x)))
        else:
            out.append(np.empty(0, U64))
    return out


def signature(x: np.ndarray, fine: bool) -> bytes:
    """A bitmap of the set by the low bits of its hashes: ROUGH to twice as many bits a shingle; if ``fine``, FINE to
    twice as many in sets of up to FINE_BITS / FINE (as whole bytes, the first index the highest bit, so the halves of
    a longer bitmap fold onto a shorter one; sizes within 4 / 3 differ by one doubling at most)."""
    bits, least = 64, max(ROUGH * len(x), min(FINE * len(x), FINE_BITS) if fine else 0)
    while bits < least:
        bits *= 2
    flags = np.zeros(bits, np.uint8)
    flags[(x & U64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags).tobytes()


def may_link(n: int, m: int, x: bytes, y: bytes) -> bool:
    """False only if the signatures prove the Jaccard similarity of sets of n and m to be under 0.75: each bit that
    one has alone is a shingle that the other lacks."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    size = min(len(a), len(b))
    a = np.bitwise_or.reduce(a.reshape(-1, size), axis=0)
    b = np.bitwise_or.reduce(b.reshape(-1, size), axis=0)
    most = min(n - int(np.bitwise_count(a & ~b).sum()), m - int(np.bitwise_count(b & ~a).sum()))
    return 7 * most >= 3 * (n + m)


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [may_link(*row) for row in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
        yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in batch.columns[:2]], ["a", "b"])


def planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit numbers, all lowest bytes first: equal high bytes of neighbours pack well in a shuffle."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(raw: bytes, width: int) -> np.ndarray:
    """The 64-bit numbers of ``planes``; bytes that were left out are zero."""
    x = np.frombuffer(raw, np.uint8).reshape(width, -1)
    out = np.zeros((x.shape[1], 8), np.uint8)
    out[:, :width] = x.T
    return out.view(U64).reshape(-1)


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in batches:
        for part in slices(batch, "text", CHUNK // 4):
            sets = shingle_sets(part.column(1))
            dig = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
            d = np.frombuffer(b"".join(dig), np.int64).reshape(-1, 2)
            if len(sets):
                cells = np.concatenate(sets) >> U64(64 - SKETCH_BITS)
                counts += np.bincount(cells.astype(np.int64), minlength=1 << SKETCH_BITS).astype(np.uint32)
            n = len(sets)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]),
                 pa.nulls(n, pa.int32()), *(pa.array([signature(x, fine) for x in sets], pa.binary())
                                            for fine in (False, True))],
                ["doc_id", "n", "d1", "d2", "block", "bits", "fine"])
    rows = [(i, planes(x.astype(U64), 4)) for i, x in enumerate(np.split(counts, BLOCKS)) if x.any()]
    n = len(rows)
    yield pa.RecordBatch.from_arrays(
        [pa.nulls(n, pa.int64())] * 4 + [pa.array([r[0] for r in rows], pa.int32()),
                                         pa.array([r[1] for r in rows], pa.binary()), pa.nulls(n, pa.binary())],
        ["doc_id", "n", "d1", "d2", "block", "bits", "fine"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for b, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x = from_planes(c, 4)
            total[b] = total[b] + x if b in total else x
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                      pa.array([x.tobytes() for x in total.values()], pa.binary())],
                                     ["block", "counts"])


def frequency_classes(sketch: DataFrame) -> np.ndarray:
    """Class (0 to 63, as the top six bits of the order) of each cell of the merged sketch."""
    rows = sketch.repartition(BLOCKS, "block").mapInArrow(_merge, "block int, counts binary").collect()
    counts = np.zeros(1 << SKETCH_BITS)
    width = (1 << SKETCH_BITS) // BLOCKS
    for r in rows:
        counts[r.block * width:(r.block + 1) * width] += np.frombuffer(r.counts, np.uint64)
    mean = counts.mean()
    over = np.maximum(counts - mean - 4 * np.sqrt(mean + 1), 1)
    return np.minimum(np.log2(over) * 1.5, 63).astype(np.uint8)


def ordered(sets: list[np.ndarray], classes: np.ndarray) -> list[np.ndarray]:
    """Each set in the global order: frequency class, then hash."""
    return [np.sort((classes[(x >> U64(64 - SKETCH_BITS)).astype(np.int64)].astype(U64) << U64(58)) | (x >> U64(6)))
            for x in sets]


def _prefixes(classes, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                ids, pre, seen = [], [], set()
                for doc, x in zip(part.column(0).to_pylist(), ordered(shingle_sets(part.column(1)), classes.value)):
                    key = hashlib.blake2b(x.tobytes(), digest_size=16).digest()
                    if doc is None or not len(x) or key in seen:     # a copy beside its like adds nothing
                        continue
                    seen.add(key)
                    p = x[:len(x) - (3 * len(x) + 3) // 4 + 1]
                    ids.append(np.full(len(p), doc, np.int64))
                    pre.append(p)
                if not ids:
                    continue
                docs, toks = np.concatenate(ids), np.concatenate(pre) & TOKEN
                to = (mix(toks.copy()) % U64(parts)).astype(np.int32)
                order = np.argsort(to, kind="stable")
                docs, toks, to = docs[order], toks[order], to[order]
                cut = np.flatnonzero(np.r_[True, to[1:] != to[:-1]])
                ends = np.r_[cut[1:], len(to)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to[cut]), pa.array([planes(toks[s:e], TOKEN_BYTES) for s, e in zip(cut, ends)], pa.binary()),
                     pa.array([planes(docs[s:e], 8) for s, e in zip(cut, ends)], pa.binary())],
                    ["part", "tokens", "docs"])
    return run


def by_part(batches: Iterator[pa.RecordBatch]):
    """(part, its rows as lists of values) for rows sorted by their first column."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[0] != now:
                if rows:
                    yield now, rows
                now, rows = row[0], []
            rows.append(row)
    if rows:
        yield now, rows
    del rows
    give_back()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, doc) of the tokens that two or more sets have in their prefixes."""
    for _, rows in by_part(batches):
        toks = np.concatenate([from_planes(r[1], TOKEN_BYTES) for r in rows])
        docs = np.concatenate([from_planes(r[2], 8) for r in rows]).view(np.int64)
        order = np.argsort(toks, kind="stable")
        toks, docs = toks[order], docs[order]
        same = toks[1:] == toks[:-1]
        keep = np.r_[same, False] | np.r_[False, same]
        yield pa.RecordBatch.from_arrays([pa.array(toks[keep].view(np.int64)), pa.array(docs[keep])], ["token", "doc"])


def _sets(classes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", CHUNK // 4):
                sets = ordered(shingle_sets(part.column(1)), classes.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([x.astype(">u8").tobytes() for x in sets], pa.binary())], ["id", "s"])
    return run


def trie_overlaps(probe: np.ndarray, sets: list[bytes]) -> list[int]:
    """For sets in lexicographic order (big-endian bytes, no repeats): whether 7 * overlap >= 3 * both sizes.

    The sorted list is the trie: each set branches off the one before at their common prefix, whose partial
    overlap is taken over; ``cum`` holds it for each depth of the path, ``valid`` how far it has been computed."""
    out, prev, cum, valid = [], np.empty(0, U64), np.zeros(1, np.int64), 0
    for raw in sets:
        x = np.frombuffer(raw, ">u8").astype(U64)
        m = min(len(prev), len(x), valid)
        differ = np.flatnonzero(prev[:m] != x[:m])
        depth = int(differ[0]) if len(differ) else m
        need = -(-3 * (len(probe) + len(x)) // 7)
        cum = np.concatenate([cum[:depth + 1], np.zeros(len(x) - depth, np.int64)])
        ok = True
        while depth < len(x):
            left = len(probe) - (int(np.searchsorted(probe, x[depth - 1], "right")) if depth else 0)
            if cum[depth] + min(len(x) - depth, left) < need:      # the remaining lengths rule the subtree out
                ok = False
                break
            step = x[depth:depth + 256]
            at = np.searchsorted(probe, step)
            hit = probe[np.minimum(at, len(probe) - 1)] == step
            cum[depth + 1:depth + 1 + len(step)] = cum[depth] + np.cumsum(hit)
            depth += len(step)
        out.append(bool(ok and cum[len(x)] >= need))
        prev, valid = x, depth
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, block, first, id, s) sorted by (a, block, first): the hub's set, then those to compare with it."""
    def flush(hub, probe, held):
        order = sorted(range(len(held)), key=lambda i: held[i][1])
        distinct = [i for k, i in enumerate(order) if not k or held[i][1] != held[order[k - 1]][1]]
        ok = dict(zip((held[i][1] for i in distinct), trie_overlaps(probe, [held[i][1] for i in distinct])))
        got = [i for i, s in held if ok[s]]
        return pa.RecordBatch.from_arrays([pa.array([hub] * len(got), pa.int64()), pa.array(got, pa.int64())],
                                          ["a", "b"])
    now, probe, held = None, None, []
    for batch in batches:
        for a, block, first, i, s in zip(*(c.to_pylist() for c in batch.columns)):
            if (a, block) != now:
                if held:
                    yield flush(now[0], probe, held)
                now, probe, held = (a, block), None, []
            if first == 0 and probe is None:
                probe = np.frombuffer(s, ">u8").astype(U64)
            elif first:
                held.append((i, s))
    if held:
        yield flush(now[0], probe, held)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of Jaccard 0.75 or more.  ``a`` is a hub: its partners are dealt out in blocks of about 256."""
    degree = pairs.groupBy("a").agg(F.ceil(F.count("*") / 256).cast("int").alias("blocks"))
    dealt = pairs.join(degree, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("blocks")).alias("block"))
    others = dealt.join(sets, dealt.b == sets.id).select("a", "block", F.lit(1).alias("first"), "id", "s")
    hubs = dealt.select("a", "block").distinct().join(sets, F.col("a") == sets.id)
    rows = hubs.select("a", "block", F.lit(0).alias("first"), "id", "s").unionByName(others)
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(n, "a", "block").sortWithinPartitions("a", "block", "first")
            .mapInArrow(_verify, "a long, b long"))


class _Group:
    """A token's sets in ascending size, with their signatures as matrices by length, as they are and folded once."""

    def __init__(self, rows: list):
        rows.sort(key=lambda r: (r[6], r[4]))
        self.block, self.rep, self.comp, self.n = (np.array([r[i] for r in rows], np.int64) for i in (3, 4, 5, 6))
        self.bits = [np.frombuffer(r[7], np.uint8) for r in rows]
        self.size = np.array([len(x) for x in self.bits])
        self.at, self.whole, self.folded = np.zeros(len(rows), np.int64), {}, {}
        for z in np.unique(self.size).tolist():
            at = np.flatnonzero(self.size == z)
            self.at[at] = np.arange(len(at))
            self.whole[z] = np.stack([self.bits[i] for i in at])
            self.folded[z] = self.whole[z][:, :z // 2] | self.whole[z][:, z // 2:]

    def partners(self, i: int, apart: bool) -> np.ndarray:
        """Later rows that may link with row i: by component, size and signature (see may_link)."""
        end = i + 1 + int(np.searchsorted(self.n[i + 1:], self.n[i] * 4 // 3, "right"))
        js = i + 1 + np.flatnonzero((self.comp[i + 1:end] != self.comp[i])
                                    & ((self.block[i + 1:end] != self.block[i]) | (not apart)))
        out = []
        for z, of in ((self.size[i], self.whole), (2 * self.size[i], self.folded)):
            own = js[self.size[js] == z]
            for k in range(0, len(own), 4096):
                y, x = of[int(z)][self.at[own[k:k + 4096]]], self.bits[i]
                m = self.n[own[k:k + 4096]]
                most = np.minimum(self.n[i] - np.bitwise_count(x & ~y).sum(1, dtype=np.int64),
                                  m - np.bitwise_count(y & ~x).sum(1, dtype=np.int64))
                out.append(own[k:k + 4096][7 * most >= 3 * (self.n[i] + m)])
        return np.concatenate(out) if out else js[:0]


def _cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (token, i, j, block, rep, comp, n, bits) sorted by the first three: the pairs of different components that
    sizes and signatures don't exclude."""
    def flush(rows):
        apart = rows[0][1] != rows[0][2]                 # two blocks of a large group: only pairs across them
        g = _Group(rows)
        found = [np.stack([np.minimum(g.rep[i], g.rep[js]), np.maximum(g.rep[i], g.rep[js])], 1)
                 for i in range(len(rows)) if len(js := g.partners(i, apart))]
        x = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(x[:, 0]), pa.array(x[:, 1])], ["a", "b"])
    now, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:3] != now:
                if held:
                    yield flush(held)
                now, held = row[:3], []
            held.append(row)
    if held:
        yield flush(held)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, n_copies (documents with the same set) of every document."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    profile = written(docs.mapInArrow(_profile, "doc_id long, n long, d1 long, d2 long, block int, bits binary, "
                                      "fine binary"), "profile")
    classes = spark.sparkContext.broadcast(frequency_classes(profile.where("block is not null").select("block", F.col("bits").alias("counts"))))
    base = profile.where("block is null").select("doc_id", "n", "d1", "d2")
    one = base.where("n > 0 and doc_id is not null").groupBy("doc_id").agg(
        F.min(F.struct("d1", "d2", "n")).alias("x")).select("doc_id", "x.*")
    same = one.groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n_copies"))
    member = written(one.join(same, ["d1", "d2", "n"]).select("doc_id", "n", "rep", "n_copies"), "member")

    total = base.agg(F.sum("n")).first()[0] or 0
    parts = partitions(spark, total // 4, 2_000_000)
    shared = written(docs.mapInArrow(_prefixes(classes, parts), "part int, tokens binary, docs binary")
                     .repartition(parts, "part").sortWithinPartitions("part")
                     .mapInArrow(_shared, "token long, doc long"), "shared")
    # counted over a window, so that the rows are dealt by token once; small as they are, a hot token's rows fit one task
    live = written(shared.join(member.select(F.col("doc_id").alias("doc"), "rep", "n"), "doc")
                   .select("token", "rep", "n").distinct()
                   .withColumn("size", F.count("*").over(Window.partitionBy("token"))).where("size > 1"), "groups")
    # a group's hubs are its most central sets: those that meet most others, over all their prefix shingles
    weight = live.groupBy("rep").agg(F.sum(F.col("size") - 1).alias("weight"))
    live = written(live.join(weight, "rep"), "live")
    central = Window.partitionBy("token").orderBy(F.desc("weight"), "rep")
    hub = written(live.withColumn("place", F.row_number().over(central)).where(F.col("place") <= HUBS)
                  .select("token", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("weight").alias("wa")), "hub")
    stars = written(live.join(hub, "token").where("a <> rep and 4 * least(n, na) >= 3 * greatest(n, na)")
                    .select(F.when(F.struct("wa", -F.col("a")) > F.struct("weight", -F.col("rep")),
                                   F.struct("a", F.col("rep").alias("b")))
                            .otherwise(F.struct(F.col("rep").alias("a"), F.col("a").alias("b"))).alias("x")).select("x.*")
                    .distinct(), "stars")

    def signatures(bits: str) -> DataFrame:
        return profile.where("block is null and n > 0 and doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
            F.min(F.struct("d1", "d2", "n", F.col(bits).alias("bits"))).alias("x")).select("id", "x.n", "x.bits")

    def possible(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) that their signatures don't exclude."""
        side = lambda c: signatures("bits").select(F.col("id").alias(c), F.col("n").alias(f"n{c}"),
                                                   F.col("bits").alias(f"s{c}"))
        return written(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "na", "nb", "sa", "sb")
                       .mapInArrow(_possible, "a long, b long"), "possible")

    def links(some: DataFrame) -> DataFrame:
        """Those of the written pairs (a, b) that are links."""
        wanted = written(some.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "wanted")
        sets = written(join_checked(docs, wanted, "doc_id", "left_semi").mapInArrow(_sets(classes), "id long, s binary"),
                       "sets")
        return written(verified(some, sets), "links")
    first = links(possible(stars))
    comp = written(components(first), "comp")

    # what is left to compare: sets that are no hub of the group (hubs have met all others), if there are two
    rest = (live.where(F.col("size") > HUBS + 1).drop("size")
            .join(hub.select("token", F.col("a").alias("rep")), ["token", "rep"], "left_anti"))
    placed = rest.join(comp, rest.rep == comp.node, "left").select(
        "token", "rep", F.coalesce("component", "rep").alias("comp"), "n")
    # tokens of several components; those that the very same sets share are looked at once
    mixed = (placed.groupBy("token").agg(
        F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("size"),
        F.sum(F.xxhash64("rep").cast("decimal(38,0)")).alias("s"), F.bit_xor(F.xxhash64("rep", F.lit(7))).alias("t"))
        .where("x <> y").groupBy("size", "s", "t").agg(F.min("token").alias("token"))
        .select("token", F.ceil(F.col("size") / GROUP).cast("int").alias("blocks")))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = (placed.join(mixed, "token").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
            .join(signatures("fine").select(F.col("id").alias("rep"), "bits"), "rep")
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep",
                    "comp", "n", "bits"))
    known = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = (held.repartition(n, "token", "i", "j").sortWithinPartitions("token", "i", "j").mapInArrow(_cross, "a long, b long")
             .distinct().join(known, ["a", "b"], "left_anti"))
    second = links(written(pairs, "pairs"))
    final = components(first.unionByName(second))
    known = member.join(final, member.rep == final.node, "left").select(
        "doc_id", F.coalesce("component", "rep").alias("component"), "n_copies", F.col("n").alias("size"))
    return base.select("doc_id", "n").join(known, "doc_id", "left").select(
        "doc_id", F.coalesce("size", "n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))
