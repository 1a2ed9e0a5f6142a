"""Words of many texts as numpy arrays: positions, 64-bit hashes, and hashes of windows of words.

A hash of bytes b_i is the sum of (b_i + 1) * B**i modulo 2**64 with an odd B, so that prefix sums give the hash of any
stretch; it is mixed before use. Stretches over LONG bytes are hashed one by one.

Where equal hashes stand for equal words without a look at the words, a second hash goes with the first: sums modulo two
primes, which share no structure with sums modulo 2**64.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
HASHED = 1 << 16  # bytes whose sums are worked out at a time, few enough for a core's cache
LONG = 512
BASE = 0x9E3779B97F4A7C15
FIELDS = ((2**31 - 1, 1_103_515_245), (2**31 - 19, 1_664_525_017))  # primes and bases of the second hash
U = np.uint64


def inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=U)
    out[:1] = 1
    return np.multiply.accumulate(out)


POW, INV = powers(BASE, BLOCK + LONG + 1), powers(inverse(BASE), BLOCK + LONG + 1)


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x + U((salt * BASE + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def translated(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """table[data] of bytes and a table of 256 bytes or booleans; not to be written to."""
    return np.frombuffer(data.tobytes().translate(table.tobytes()), table.dtype)


def byte_class(spaces: bytes = b"", letters: bool = False) -> np.ndarray:
    """256 booleans: which bytes of UTF-8 belong to words."""
    if letters:  # digits, lower-case letters and everything beyond ASCII
        out = np.zeros(256, bool)
        out[0x30:0x3A] = out[0x61:0x7B] = out[0x80:] = True
    else:
        out = np.ones(256, bool)
        out[list(spaces)] = False
    return out


SOLID = byte_class(b"\x20\x09\x0a\x0b\x0c\x0d")
ALNUM = byte_class(letters=True)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def weighted(data: np.ndarray, power: np.ndarray) -> np.ndarray:
    out = data.astype(U)
    out += U(1)
    out *= power[: len(out)]
    return out


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes; starts ascend and stretches don't overlap."""
    out = np.empty(len(starts), U)
    long = np.flatnonzero(ends - starts > LONG)
    i = 0
    while i < len(starts):
        j = int(np.searchsorted(starts, starts[i] + HASHED))
        a = int(starts[i])
        b = int(min(ends[j - 1], a + HASHED + LONG))
        sums = np.zeros(b - a + 1, U)
        np.cumsum(weighted(data[a:b], POW), out=sums[1:])
        s, e = starts[i:j] - a, np.minimum(ends[i:j] - a, b - a)
        out[i:j] = (sums[e] - sums[s]) * INV[s]
        i = j
    for k in long:
        out[k] = int.from_bytes(hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8).digest(), "little")
    return mixed(out)


@cache
def field_powers(base: int, prime: int) -> np.ndarray:
    """base**0, base**1, ... modulo a prime below 2**31, as many as a block needs."""
    n, have = BLOCK + LONG + 1, 1
    out = np.ones(n, U)
    while have < n:
        step = min(have, n - have)
        out[have : have + step] = out[:step] * U(pow(base, have, prime)) % U(prime)
        have += step
    return out


def second_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Like `hashes`, by sums of (byte + 1) * base**i modulo two primes. A block's sum stays below 2**60."""
    out = np.zeros(len(starts), U)
    for prime, base in FIELDS:
        power, back = field_powers(base, prime), field_powers(pow(base, -1, prime), prime)
        i = 0
        while i < len(starts):
            j = int(np.searchsorted(starts, starts[i] + HASHED))
            a = int(starts[i])
            b = int(min(ends[j - 1], a + HASHED + LONG))
            sums = np.zeros(b - a + 1, U)
            np.cumsum(weighted(data[a:b], power), out=sums[1:])
            s, e = starts[i:j] - a, np.minimum(ends[i:j] - a, b - a)
            out[i:j] = (out[i:j] << U(31)) | ((sums[e] - sums[s]) % U(prime) * back[s] % U(prime))
            i = j
    for k in np.flatnonzero(ends - starts > LONG):
        digest = hashlib.blake2b(data[starts[k] : ends[k]].tobytes(), digest_size=8, salt=b"second")
        out[k] = int.from_bytes(digest.digest(), "little")
    return mixed(out)


def places(keys: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of some hashes are among the ascending keys, and where there; most others are told by their first 16 bits."""
    seen = np.zeros(1 << 16, bool)
    seen[keys >> U(48)] = True
    maybe = np.flatnonzero(seen[of >> U(48)])
    if not len(maybe):
        return maybe, maybe
    at = np.searchsorted(keys, of[maybe]).clip(0, len(keys) - 1)
    same = keys[at] == of[maybe]
    return maybe[same], at[same]


@dataclass
class Words:
    """The words of a run of texts. doc: index of each word's text; first: index of each text's first word, one more at the end."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @cached_property
    def second(self) -> np.ndarray:
        return second_hashes(self.data, self.starts, self.ends)

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def windows(self, size: int, salt: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """For each start with `size` words of one text: the start's index, and a hash of the words."""
        return windows(mixed(self.hash, salt), self.doc, size)


def windows(names: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` consecutive names with equal doc."""
    n = len(names) - size + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, U)
    at = np.flatnonzero(doc[:n] == doc[size - 1 :])
    # U(BASE) to the power of the position, shifted back: hashes depend on the words alone
    total = np.zeros(n, U)
    factor = U(1)
    if size <= 8:
        for k in range(size):
            total += names[k : k + n] * factor
            factor = U(int(factor) * BASE & 0xFFFFFFFFFFFFFFFF)
        return at, mixed(total[at])
    out = np.empty(n, U)
    for a in range(0, n, BLOCK // 2):
        b = min(n, a + BLOCK // 2)
        part = names[a : b + size - 1]
        sums = np.zeros(len(part) + 1, U)
        np.cumsum(part * POW[: len(part)], out=sums[1:])
        out[a:b] = (sums[size : size + b - a] - sums[: b - a]) * INV[: b - a]
    return at, mixed(out[at])


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an array of texts; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(at):
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool) -> Words:
    """All maximal runs of bytes of a kind, within each text."""
    if lower:
        data = translated(data, LOWER)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = translated(data, kind)
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]  # a word that ends a text must not join the next text's first
    joined = np.unique(cut[inside[cut] & inside[cut + 1]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(joined):
        starts, ends = (np.sort(np.concatenate([x, joined]), kind="stable") for x in (starts, ends))  # two ascending runs are merged
    first = np.searchsorted(starts, offsets, side="left")
    first[-1] = len(starts)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, offsets, starts, ends, doc, first, hashes(data, starts, ends))


def slices(batch: pa.RecordBatch, text: str = "text", most: int = BLOCK) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `most` bytes of text, at least one row each."""
    _, offsets = raw(batch.column(text))
    i = 0
    while i < batch.num_rows:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most)))
        yield batch.slice(i, min(j, batch.num_rows) - i)
        i = j


def of(batch: pa.RecordBatch, kind: np.ndarray = SOLID, lower: bool = False, text: str = "text") -> Words:
    return words(*raw(batch.column(text)), kind, lower)
