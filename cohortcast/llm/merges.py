"""Operator 12: byte-pair encoding and decoding, merges taken from a segment tree.

The vocabulary's own rules come first (special strings, normal form, splitting into pre-tokens), by the library's parts.  Each
distinct pre-token is then merged here: the leaves of a segment tree are the ranks of adjacent pairs, a node keeps the place of its
lowest, leftmost pair, so the root names the next merge; a merge changes three leaves and their paths upwards.  Long
pre-tokens thus cost n log n.  A text is cut into units at white space that no pre-token spans; a unit's ids are remembered
by hash in a table of bounded size a worker, so only new units are merged.  Decoding looks the ids' strings up in the vocabulary.

Edge cases: null and empty texts have no tokens and decode to the empty string; special strings inside texts become their ids as
the library does by default; very long texts are encoded in pieces cut at white space, of about half a megabyte each (a
text without white space is one piece); repeated rows are encoded each; rows of null doc_id too; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .pieces import Digest, Table, decimals, groups, listed, sure_cuts
from .tokens import Units

WORDS = "word_bpe_49k.json"
#: Pre-tokens whose merges a worker remembers beside its units.
REMEMBERED = 500_000


def merged(symbols: list, rules: dict) -> list:
    """``symbols`` after all merges of ``rules`` (pair -> (rank, symbol)), always the lowest rank, the leftmost of equals."""
    n = len(symbols)
    if n < 2:
        return list(symbols)
    none = len(rules)
    sym, nxt, prev = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))
    size = 1 << (n - 1).bit_length()
    rank = [none] * size                                        # of the pair that begins at a place
    for i in range(n - 1):
        rank[i] = rules.get((sym[i], sym[i + 1]), (none,))[0]
    tree = [0] * size + list(range(size))                       # place of the lowest rank under each node
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = b if rank[b] < rank[a] else a

    def put(i, r):
        rank[i] = r
        k = (size + i) >> 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = b if rank[b] < rank[a] else a
            k >>= 1

    while rank[tree[1]] < none:
        i = tree[1]
        j = nxt[i]
        sym[i] = rules[sym[i], sym[j]][1]
        nxt[i] = nxt[j]
        put(j, none)
        if nxt[i] < n:
            prev[nxt[i]] = i
            put(i, rules.get((sym[i], sym[nxt[i]]), (none,))[0])
        else:
            put(i, none)
        if prev[i] >= 0:
            put(prev[i], rules.get((sym[prev[i]], sym[i]), (none,))[0])
    out, i = [], 0
    while i < n:
        out.append(sym[i])
        i = nxt[i]
    return out


class Codec:
    """Ids of texts and texts of ids for a vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.check(spec)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rules = {(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in reversed(list(enumerate(pairs)))}
        self.inner = {c: i for c, i in vocab.items() if len(c) == 1}
        self.final = {c: vocab[c + self.suffix] for c in self.inner if c + self.suffix in vocab}
        self.any_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        names = [b""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            names[i] = t.encode() + b" "                         # this file's decoder joins the strings by one space
        self.names = Table(names)
        self.digits = decimals(len(names) - 1)
        self.words: dict[str, list[int]] = {}
        self.units = Units(self.encode)

    def check(self, spec: dict) -> None:
        """What this code relies on; another vocabulary needs other rules and must not pass unseen."""
        m = spec["model"]
        plain = (m["type"] == "BPE" and not m.get("byte_fallback") and not m.get("dropout") and not m.get("ignore_merges")
                 and not m.get("continuing_subword_prefix") and m.get("unk_token") is None)
        own = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"])
                  and not re.search(r"\s", t["content"]) for t in spec["added_tokens"])
        alphabet = {t for t in m["vocab"] if len(t) == 1}
        whole = len(alphabet) == 256 and all(c + self.suffix in m["vocab"] for c in alphabet)
        kinds = {k.get("type") for k in (spec["normalizer"] or {}).get("normalizers", [])}
        if not (plain and own and whole and kinds <= {"NFC", "Replace", "Lowercase"} and spec["decoder"] is None
                and spec["post_processor"] is None):
            raise ValueError("a vocabulary of another kind: its rules are not known to this operator")

    def word(self, w: str) -> list[int]:
        """Ids of a pre-token (in the vocabulary's own alphabet of bytes)."""
        ids = self.words.get(w)
        if ids is None:
            if len(self.words) >= REMEMBERED:
                self.words.clear()
            ids = self.words[w] = merged([*map(self.inner.__getitem__, w[:-1]), self.final[w[-1]]], self.rules)
        return ids

    def _plain(self, text: str, out: list[int]) -> None:
        if text:
            for w, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text)):
                out += self.word(w)

    def text(self, text: str) -> list[int]:
        out, at = [], 0
        for m in self.any_special.finditer(text):
            self._plain(text[at:m.start()], out)
            out.append(self.special[m.group()])
            at = m.end()
        self._plain(text[at:], out)
        return out

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.text(u.decode()) for u in units]
        return np.array([i for x in ids for i in x], np.uint32), np.array([len(x) for x in ids], np.int64)

    def ids(self, data: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' ids one after another, and each piece's first index."""
        offs = np.r_[0, np.cumsum([len(b) for b in data])]
        raw = np.frombuffer(b"".join(data), np.uint8)
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(len(data) + 1, np.int64)
        cut = sure_cuts(raw)
        cut[offs[:-1][np.diff(offs) > 0]] = True
        s = np.flatnonzero(cut)
        row = self.units.rows(raw, s, np.r_[s[1:], len(raw)])
        size = self.units.size[row]
        ends = np.cumsum(size)
        at = np.repeat(self.units.first[row] - (ends - size), size)
        at += np.arange(len(at))
        return self.units.ids[at], np.r_[0, ends][np.searchsorted(s, offs)]

    def decode(self, ids) -> str:
        return self.names.bytes_of(np.asarray(ids, np.int64))[:-1].tobytes().decode()


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def coded(docs: DataFrame, path: str, most: int | None = None) -> DataFrame:
    """doc_id, piece, last, ids array<int>, decoded string: every text's tokens, in pieces (0, 1, ...) of about ``most`` bytes.
    ``path`` must name the vocabulary file on every worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            at, k = -1, 0
            for rows, data, last in groups(batch.column(1), **({"most": most} if most else {})):
                ids, first = c.ids(data)
                number = []
                for r in rows:
                    k = k + 1 if r == at else 0
                    at = r
                    number.append(k)
                text = [c.decode(ids[a:b]) if b > a else "" for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)), pa.array(number, pa.int64()), pa.array(last), pa.ListArray.from_arrays(
                        pa.array(first.astype(np.int32)), pa.array(ids.astype(np.int32))), pa.array(text, pa.string())],
                    ["doc_id", "piece", "last", "ids", "decoded"])
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        run, "doc_id long, piece long, last boolean, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text, without writing ids anywhere."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for batch in batches:
            n, a, b, done = 0, Digest(b" "), Digest(b" "), []
            for _, data, last in groups(batch.column(1)):
                ids, first = c.ids(data)
                text, width = listed(c.digits, ids, 32)
                at = np.r_[0, np.cumsum(width)][first]
                names = c.names.bytes_of(ids)
                there = np.r_[0, np.cumsum(c.names.size[ids], dtype=np.int64)][first]
                text, names = memoryview(text), memoryview(names)
                for i, end in enumerate(last):
                    a.add(text[at[i]:at[i + 1]])
                    b.add(names[there[i]:there[i + 1]])
                    n += int(first[i + 1] - first[i])
                    if end:
                        done.append((n, a.hexdigest(), b.hexdigest()))
                        n, a, b = 0, Digest(b" "), Digest(b" ")
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x, t) for x, t in zip(
                zip(*done) if done else [[]] * 3, (pa.int64(), pa.string(), pa.string()))]],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
