"""Operator 8: token counts with a whole-token shortcut; also the token ids that packing needs.

A text is cut into pre-tokens at places that no token of the vocabulary can span.  For the sentence-piece model these are: before a
space (a piece holds a space only in front, which ``CountRules.check`` proves over the vocabulary) and before a newline
(in no piece).  It is proved offline, by the library itself, which vocabulary strings encode alone as one token; pre-tokens that
match one count 1 without any merging.  The rest are merged by the library, each distinct one once per task, and
remembered by a 64-bit hash in a table of bounded size.

For the byte-level vocabulary a cut is made before a space or newline that follows a character that is surely not white space;
the pre-tokenizer's pattern never joins such a pair.  Where a vocabulary breaks a rule, whole texts go to the library.

Edge cases: null and empty texts have no tokens; control strings inside texts go through the library as its default does; texts
without a space are one pre-token; repeated rows are counted each; rows of null doc_id are counted like others; further
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from .common import U64, joined, ragged, remembered, slices, span_hashes

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"
LIMIT = 4096
CHUNK = 1 << 19             # bytes of text whose pre-tokens are held as arrays at once
TABLE = 700_000             # remembered pre-tokens of a worker, and an eighth of its remembered ids
MARK = "▁"


class Units:
    """Remembers, for each pre-token's hash, its row in a table of ids (or counts); ``encode`` fills what is missing.
    The hashes are kept sorted, so a lookup is a binary search and the table costs 20 bytes a pre-token beside its ids."""

    def __init__(self, encode, most: int = TABLE):
        self.encode, self.most = encode, most
        self.clear()

    def clear(self):
        self.keys, self.at, self.size = np.empty(0, U64), np.empty(0, np.int32), np.empty(0, np.int32)
        self.ids, self.first = np.empty(0, np.uint32), np.empty(0, np.int32)

    def rows(self, raw: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
        """The table's row of each unit raw[s:e]."""
        if not len(s):
            return np.empty(0, np.int64)
        u, at, which = np.unique(span_hashes(raw, s, e), return_index=True, return_inverse=True)
        row, place = self.find(u)
        if (row < 0).any():
            if max(len(self.keys), len(self.ids) // 8) > self.most:
                self.clear()
                row, place = self.find(u)
            new = np.flatnonzero(row < 0)
            data = raw.tobytes()
            ids, size = self.encode([data[a:b] for a, b in zip(s[at[new]].tolist(), e[at[new]].tolist())])
            row[new] = len(self.keys) + np.arange(len(new))
            self.keys = np.insert(self.keys, place[new], u[new])
            self.at = np.insert(self.at, place[new], row[new])
            self.first = np.r_[self.first, (len(self.ids) + np.cumsum(size) - size).astype(np.int32)]
            self.size, self.ids = np.r_[self.size, size.astype(np.int32)], np.r_[self.ids, ids]
        return row[which]

    def find(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The row of each hash (-1: not there), and its place among the sorted ones."""
        place = np.searchsorted(self.keys, u)
        row = np.full(len(u), -1, np.int64)
        if len(self.keys):
            near = np.minimum(place, len(self.keys) - 1)
            there = self.keys[near] == u
            row[there] = self.at[near[there]]
        return row, place


# ---- the sentence-piece model -----------------------------------------------------------------------

class CountRules:
    """Cuts and counts for a sentence-piece model, with the offline proof of its single tokens."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = pb.ModelProto()
        with open(path, "rb") as f:
            spec.ParseFromString(f.read())
        self.pieces = [p.piece for p in spec.pieces]
        self.cuts = self.check(spec)
        words = [p[1:] for p in self.pieces if p[:1] == MARK and p[1:] and MARK not in p[1:]]
        self.single = {w.encode() for w, n in zip(words, self.model.encode(words, num_threads=1)) if len(n) == 1}
        self.units = Units(self.encode)

    def check(self, spec) -> bool:
        n = spec.normalizer_spec
        plain = not n.precompiled_charsmap and n.add_dummy_prefix and not n.remove_extra_whitespaces \
            and n.escape_whitespaces and not spec.trainer_spec.treat_whitespace_as_suffix
        own = any(p.type == 4 for p in spec.pieces)                       # user-defined symbols match anywhere
        return plain and not own and not any(MARK in p.lstrip(MARK) or "\n" in p for p in self.pieces)

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Counts only.  A unit opens with a space (which the model's own dummy prefix replaces) or with a newline
        (whose dummy prefix is a token of its own and is taken off)."""
        n = np.ones(len(units), np.int64)
        rest = [i for i, u in enumerate(units) if u != b" " and not (u[:1] == b" " and u[1:] in self.single)]
        texts = [(units[i][1:] if units[i][:1] == b" " else units[i]).decode() for i in rest]
        for i, t, ids in zip(rest, texts, self.model.encode(texts, num_threads=1) if texts else []):
            n[i] = len(ids) - (units[i][:1] == b"\n")
        return np.empty(0, np.uint32), n

    def counts(self, texts: pa.Array) -> np.ndarray:
        if not self.cuts:
            return np.array([len(x) for x in self.model.encode([t or "" for t in texts.to_pylist()], num_threads=1)],
                            np.int64)
        raw, offs = joined(texts, b" ")
        if not len(raw):
            return np.zeros(len(texts), np.int64)
        before = np.r_[np.uint8(0), raw[:-1]]
        space = (raw == 32) & (before != 32)
        far = np.r_[np.zeros(3, np.uint8), raw[:-3]]
        space &= ~((before == 0x81) & (far == 0xE2))      # not after the mark itself, which is a space to the model
        cut = space | (raw == 10)
        cut[offs[:-1]] = True
        s = np.flatnonzero(cut)
        e = np.r_[s[1:], len(raw)]
        row = self.units.rows(raw, s, e)
        n = np.add.reduceat(self.units.size[row], np.searchsorted(s, offs[:-1]), dtype=np.int64)
        n[np.diff(offs) == 1] = 0
        return n


# ---- the byte-level vocabulary ----------------------------------------------------------------------

class IdRules:
    """Cuts and ids for a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        import json
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        most = max([*spec.pop("model")["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])
        self.model = Tokenizer.from_file(path)
        pre = spec["pre_tokenizer"] or {}
        self.cuts = (spec["normalizer"] is None and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
                     and pre.get("use_regex", True) and not any(" " in t["content"] or "\n" in t["content"] or t["lstrip"]
                                                                or t["rstrip"] for t in spec["added_tokens"]))
        names = map(self.model.id_to_token, range(most + 1))
        self.length = np.fromiter((len(t or "") for t in names), np.int64, most + 1)     # a byte-level token has one character a byte
        for t in spec["added_tokens"]:
            self.length[t["id"]] = len(t["content"].encode())
        self.units = Units(self.encode)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units.  Those that may stand one after another go to the library as one text, and its ids are dealt
        back by their lengths in bytes; the others go one by one."""
        size = np.zeros(len(units), np.int64)
        own: list = [None] * len(units)
        chain = [i for i, u in enumerate(units) if u[0] in (32, 10) and 32 < u[-1] < 127]
        alone = sorted(set(range(len(units))) - set(chain))
        if chain:
            ids = np.array(self._ids([b"".join([units[i] for i in chain]).decode()])[0], np.uint32)
            ends = np.cumsum(self.length[ids])
            edge = np.searchsorted(ends, np.cumsum([len(units[i]) for i in chain]), "right")
            if ends[-1] != sum(len(units[i]) for i in chain):
                raise ValueError("token lengths don't add up")
            for i, s, e in zip(chain, np.r_[0, edge[:-1]].tolist(), edge.tolist()):
                own[i] = ids[s:e]
        for i, x in zip(alone, self._ids([units[i].decode() for i in alone]) if alone else []):
            own[i] = np.array(x, np.uint32)
        size[:] = [len(x) for x in own]
        return (np.concatenate(own) if own else np.empty(0, np.uint32)), size

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids one after another and each text's first index."""
        if not self.cuts:
            x = self._ids([t or "" for t in texts.to_pylist()])
            return np.array([i for y in x for i in y], np.uint32), np.r_[0, np.cumsum([len(y) for y in x])].astype(np.int64)
        raw, offs = joined(texts)
        if not len(raw):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        before = np.r_[np.uint8(0), raw[:-1]]
        two = np.r_[np.zeros(2, np.uint8), raw[:-2]]
        sure = ((before > 32) & (before < 127)) | ((before >= 0x80) & (two >= 0xC3) & (two <= 0xDF))
        cut = ((raw == 32) | (raw == 10)) & sure
        first = offs[:-1][np.diff(offs) > 0]
        cut[first] = True
        s = np.flatnonzero(cut)
        row = self.units.rows(raw, s, np.r_[s[1:], len(raw)])
        size = self.units.size[row]
        ids = self.units.ids[ragged(self.units.first[row], size)]
        ends = np.r_[0, np.cumsum(size)]
        return ids, ends[np.searchsorted(s, offs)]


@remembered
def count_rules(path: str) -> CountRules:
    return CountRules(path)


@remembered
def id_rules(path: str) -> IdRules:
    return IdRules(path)


def vocabulary(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit.  ``path`` must name the vocabulary file on every worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = count_rules(path)
        for batch in batches:
            for part in slices(batch, "text", CHUNK):
                n = rules.counts(part.column(1))
                size = pa.compute.fill_null(pa.compute.binary_length(part.column(1)), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), size, pa.array(n), pa.array(n > limit)],
                                                 ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
