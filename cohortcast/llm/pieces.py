"""Texts in pieces of bounded size, cut where the pre-tokenizers cut; rows of small numbers as text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that are held as arrays at once.
STEP = 512 << 10


def sure_cuts(raw: np.ndarray) -> np.ndarray:
    """Where a space or newline follows a character that is surely not white space: printable ASCII, or two bytes
    long from U+00C0 on.  No token of the vocabularies used here spans such a place, and no normal form does."""
    before = np.r_[np.uint8(0), raw[:-1]]
    two = np.r_[np.zeros(min(2, len(raw)), np.uint8), raw[:-2]]
    sure = ((before > 32) & (before < 127)) | ((before >= 0x80) & (two >= 0xC3) & (two <= 0xDF))
    return ((raw == 32) | (raw == 10)) & sure


def _parts(b: bytes, most: int) -> Iterator[bytes]:
    """b, cut at spaces after sure characters into parts of about ``most`` bytes (more only where no such space comes)."""
    first = 0
    while len(b) - first > most:
        at = first + most
        while True:
            at = b.find(b" ", at)
            if at < 0 or 32 < b[at - 1] < 127:
                break
            at += 1
        if at < 0:
            break
        yield b[first:at]
        first = at
    yield b[first:] if first else b


def groups(texts: pa.Array, before: bytes = b"", most: int = STEP) -> Iterator[tuple[list[int], list[bytes], list[bool]]]:
    """The texts (null: empty) in groups of pieces of about ``most`` bytes together: row, bytes and whether it is its row's last.
    The first piece of a row stands after ``before``; others open with a space."""
    row, data, last, size = [], [], [], 0
    for i, t in enumerate(texts):
        b = t.as_buffer().to_pybytes() if t.is_valid else b""
        parts = list(_parts(before + b, most)) if len(b) > most else [before + b]
        for k, p in enumerate(parts):
            if size and size + len(p) > most:
                yield row, data, last
                row, data, last, size = [], [], [], 0
            row.append(i)
            data.append(p)
            last.append(k == len(parts) - 1)
            size += len(p)
    if row:
        yield row, data, last


class Table:
    """Byte strings by number, looked up many at once."""

    def __init__(self, items: list[bytes]):
        self.raw = np.frombuffer(b"".join(items), np.uint8)
        self.size = np.array([len(x) for x in items], np.int32)
        self.first = np.cumsum(self.size, dtype=np.int64) - self.size

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size, dtype=np.int64)
        at = np.repeat(self.first[ids] - (ends - size), size)
        at += np.arange(len(at))
        return self.raw[at]


def decimals(most: int) -> np.ndarray:
    """Row n: the decimal digits of n, then zeros; one more column for a separator."""
    width = len(str(most))
    return np.array([list(str(i).encode().ljust(width + 1, b"\0")) for i in range(most + 1)], np.uint8)


def listed(table: np.ndarray, ids: np.ndarray, after) -> tuple[np.ndarray, np.ndarray]:
    """The ids in decimal, each followed by its byte of ``after``, one after another; and the length of each."""
    rows = table[ids]
    rows[:, -1] = after
    flat = rows.ravel()
    return flat[flat != 0], np.count_nonzero(rows, axis=1)


class Digest:
    """SHA-256 of parts that each end in ``mark``, without the last mark."""

    def __init__(self, mark: bytes):
        self.hash, self.mark, self.some = hashlib.sha256(), mark, False

    def add(self, part) -> None:
        if len(part):
            if self.some:
                self.hash.update(self.mark)
            self.hash.update(part[:-1])
            self.some = True

    def hexdigest(self) -> str:
        return self.hash.hexdigest()
