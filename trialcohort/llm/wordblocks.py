"""Words of one text as lists of bytes, in blocks, so that a very long text is never held as one list."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa

BLOCK = 1 << 20
SPACE = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(data: bytes, size: int = BLOCK) -> Iterator[list[bytes]]:
    """The runs of anything but ASCII white space, in lists of about `size` bytes of text; no word is cut."""
    start = 0
    while len(data) - start > size:
        found = SPACE.search(data, start + size)
        stop = found.start() if found else len(data)
        yield data[start:stop].split()
        start = stop
    yield data[start:].split()


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 of each text; nulls are empty."""
    return texts.cast(pa.large_binary()).fill_null(b"").to_pylist()
