"""Token ids of many texts with the tokenizers library.

Both public tokenizers used here cut a text before every single blank that stands between two solid characters, so what
lies between such blanks (a piece, with the blank before it) encodes on its own; texts with any other blank (doubled, or
beside other white space) are encoded whole. Both also cut between Latin letters, ASCII digits, ASCII marks and line
breaks, so pieces of nothing else are cut further. All distinct parts of many texts are encoded once: runs of letters by
the tokenizer's own merge model, all others by its whole chain.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc

MOST_PIECES, MOST_BYTES = 600_000, 32 << 20
TEXTS_AT_ONCE, ROWS_AT_ONCE = 4 << 20, 500_000  # bytes and rows of texts encoded together
SPECIAL = "<|endoftext|>"  # a special token of both tokenizers; it parts the pieces of one call
AT_ONCE = 2_000
#: Pieces are learnt anew if looking them up, which takes a pass over the memory, would cost more.
FEW = 50
# Latin letters but for the one whose lower case has a mark of its own
LETTERS = "^ ?[A-Za-zÀ-ÖØ-öø-įı-ɏ]+$"
RARE_SPACE = re.compile("[\\x09\\x0b-\\x0d\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]")
SPACE_BYTES = bytes([9, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3])  # one of them is in each rare space
ODD_BLANK = re.compile(r" (?=\s|$)|(?<=\s) |^ ")
BLANK, LETTER, DIGIT, MARK, BREAK, ODD = range(6)


def vocabulary(name: str) -> str:
    return public_tokenizers.path(name)


def is_odd(text: str) -> bool:
    """Whether some blank doesn't stand between two solid characters; true for an empty text."""
    if not text or text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text:
        return True
    data = text.encode("utf-8", "surrogatepass")
    return len(data.translate(None, SPACE_BYTES)) < len(data) and bool(RARE_SPACE.search(text) and ODD_BLANK.search(text))


def byte_letters() -> np.ndarray:
    """The character that stands for each byte in byte-level models: itself if it prints, else one from 256 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return np.array([b if b in plain else 256 + other.index(b) for b in range(256)], "<u2")


def byte_kinds() -> np.ndarray:
    """The kind of each byte; apostrophes are odd, as contractions begin with them."""
    marks = set(range(0x21, 0x7F)) - {0x27}
    return np.array(
        [
            BLANK if b == 0x20 else BREAK if b == 0x0A else DIGIT if chr(b).isdigit() else LETTER if chr(b).isalpha() else MARK if b in marks else ODD
            for b in range(128)
        ]
        + [ODD] * 128,
        np.uint8,
    )


KINDS = byte_kinds()


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8 texts: that of its character, ODD where that may depend on its neighbours."""
    out = KINDS[data]
    lead = np.flatnonzero((data >= 0xC3) & (data <= 0xC9))  # of characters from U+00C0 to U+027F
    if len(lead):
        first, second = data[lead], data[lead + 1]
        # from U+00C0 to U+024F, as in LETTERS
        other = (first == 0xC9) & (second > 0x8F) | (first == 0xC3) & ((second == 0x97) | (second == 0xB7)) | (first == 0xC4) & (second == 0xB0)
        lead = lead[~other]
        out[lead] = out[lead + 1] = LETTER
    special = np.flatnonzero(data[:-1] == ord("<"))
    out[special[data[special + 1] == ord("|")]] = ODD  # a special token may begin here
    return out


def parts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the parts of texts begin. Texts follow each other from `starts` on, none is empty, no blank is odd."""
    kind, cut = kinds(data), data == 0x20
    cut[starts] = True
    pieces = np.flatnonzero(cut)
    odd = np.maximum.reduceat(kind, pieces) == ODD
    inner = kind[1:] != kind[:-1]
    inner &= kind[:-1] != BLANK
    # of line breaks within a text the last is on its own
    last = np.flatnonzero((kind[1:-1] == BREAK) & (kind[:-2] == BREAK) & (kind[2:] != BREAK) & ~cut[2:])
    inner[last] = True
    at = np.flatnonzero(inner & ~cut[1:]) + 1
    cut[at[~odd[np.searchsorted(pieces, at, "right") - 1]]] = True
    return np.flatnonzero(cut)


def stretches(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where the stretches of texts begin and end that are cut at once; a blank begins each but the first."""
    a, text = 0, data.tobytes() if len(data) > 2 * TEXTS_AT_ONCE else b""
    while a < len(data):
        b = text.find(b" ", a + TEXTS_AT_ONCE)
        yield a, b if b > 0 else len(data)
        a = b if b > 0 else len(data)


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, in their order, in batches of about TEXTS_AT_ONCE bytes of text."""
    held, size, rows = [], 0, 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        i = 0
        while i < batch.num_rows:
            before = int(ends[i - 1]) if i else 0
            j = min(max(i + 1, int(np.searchsorted(ends, before + TEXTS_AT_ONCE - size, "right"))), i + ROWS_AT_ONCE - rows)
            j = min(j, batch.num_rows)
            held.append(batch.slice(i, j - i))
            size, rows, i = size + int(ends[j - 1]) - before, rows + j - i, j
            if i < batch.num_rows or size >= TEXTS_AT_ONCE or rows >= ROWS_AT_ONCE:
                yield pa.concat_batches(held)
                held, size, rows = [], 0, 0
    if held:
        yield pa.concat_batches(held)


class Memory:
    """Pieces and their ids. `starts` has one number more than there are pieces."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.known = pa.array([], pa.large_string())
        self.starts, self.ids, self.uses = np.zeros(1, np.int64), np.empty(0, np.uint32), np.zeros(0, np.int64)

    def forget(self) -> None:
        """Forgets what was used once, or all if that is little."""
        keep = self.uses > 1
        known = self.known.filter(pa.array(keep))
        if keep.mean() > 0.5 or known.nbytes > MOST_BYTES // 2:
            self.clear()
            return
        size = np.diff(self.starts)
        self.known, self.ids = known, self.ids[np.repeat(keep, size)]
        self.starts = np.concatenate([[0], np.cumsum(size[keep])])
        self.uses = np.zeros(len(known), np.int64)

    def add(self, pieces: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known = pa.concat_arrays([self.known, pieces])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.ids = np.concatenate([self.ids, ids])
        self.uses = np.concatenate([self.uses, np.zeros(len(pieces), np.int64)])

    def places(self, pieces: pa.Array, times: np.ndarray, learn: Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """The place of each of the distinct pieces, new ones learnt first; `times` counts their uses."""
        if len(self.known) > MOST_PIECES or self.known.nbytes > MOST_BYTES:
            self.forget()
        found = pc.index_in(pieces, value_set=self.known)
        new = found.is_null().to_numpy(zero_copy_only=False)
        at = found.fill_null(0).to_numpy().astype(np.int64)
        if new.any():
            at[new] = len(self.known) + np.arange(np.count_nonzero(new))
            fresh = pieces.filter(pa.array(new))
            self.add(fresh, *learn(fresh))
        self.uses[at] += times
        return at


class Encoder:
    """Encodes batches of texts. Up to about MOST_PIECES parts of texts are remembered, then those used only once are forgotten.

    Numpy cuts the texts and Arrow finds the distinct parts of a batch, so Python sees each of them once.
    """

    def __init__(self, path: str, leading_blank: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.special = self.tokenizer.token_to_id(SPECIAL)
        # a tokenizer for pieces without a leading blank is one that lower-cases
        self.lower, self.letters = not leading_blank, byte_letters()
        # the merge model alone, for words between line breaks
        self.model, stop = Tokenizer(self.tokenizer.model), chr(self.letters[0x0A])
        self.model.pre_tokenizer = pre_tokenizers.Split(stop, "isolated")
        (self.stop,) = [x.id for x in self.tokenizer.model.tokenize(stop)]
        self.memory = Memory()

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of runs of Latin letters, with or without a blank before them, in a row, and their numbers."""
        runs = ["\n".join(words[i : i + AT_ONCE]) + "\n" for i in range(0, len(words), AT_ONCE)]
        if self.lower:
            runs = [x.lower().replace(" ", "") for x in runs]
        runs = [self.letters[np.frombuffer(x.encode(), np.uint8)].tobytes().decode("utf-16-le") for x in runs]
        return parted([e.ids for e in self.model.encode_batch_fast(runs, add_special_tokens=False)], self.stop)

    def learn(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in a row, and their numbers."""
        word = pc.match_substring_regex(pieces, LETTERS)
        special = pc.match_substring(pieces, "<|")
        rest = pc.invert(pc.or_(word, special))
        # all others between special tokens, many in one call; those that hold such a token's beginning one by one
        texts = pieces.filter(rest).to_pylist()
        runs = ["".join(x + SPECIAL for x in texts[i : i + AT_ONCE]) for i in range(0, len(texts), AT_ONCE)]
        alone = self.whole(pieces.filter(special).to_pylist())
        found = [self.word_ids(pieces.filter(word).to_pylist()), parted(self.whole(runs), self.special)]
        found.append((np.array([x for ids in alone for x in ids], np.uint32), np.array(list(map(len, alone)), np.int64)))
        order = np.empty(len(pieces), np.int64)
        order[np.concatenate([np.flatnonzero(x.to_numpy(zero_copy_only=False)) for x in (word, rest, special)])] = np.arange(len(pieces))
        ids, sizes = (np.concatenate(x) for x in zip(*found, strict=True))
        return gather(ids, np.concatenate([[0], np.cumsum(sizes)]), order)[0], sizes[order]

    def stretch(self, data: np.ndarray, stops: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts in a row, `end` after each that stops here, and the offsets behind those ends."""
        cuts = parts(data, np.concatenate([[0], stops[stops < len(data)]]))
        coded = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(np.append(cuts, len(data))), pa.py_buffer(data)).dictionary_encode()
        index = coded.indices.to_numpy()
        memory = self.memory if FEW * len(coded.dictionary) >= len(self.memory.known) else Memory()
        place = memory.places(coded.dictionary, np.bincount(index, minlength=len(coded.dictionary)), self.learn)
        after = np.searchsorted(cuts, stops) + np.arange(len(stops))
        at = np.full(len(index) + len(stops), len(memory.starts) - 1)
        here = np.ones(len(at), bool)
        here[after] = False
        at[here] = place[index]
        flat, ends = gather(np.append(memory.ids, np.uint32(end)), np.append(memory.starts, memory.starts[-1] + 1), at)
        return flat, ends[after + 1]

    def plain(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """As encode(), for texts that aren't empty and whose blanks all stand between solid characters."""
        _, offsets, data = texts.buffers()
        flat, cuts, total = [np.empty(0, np.uint32)], [np.zeros(1, np.int64)], 0
        if len(texts):
            offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
            stops = offsets[1:] - offsets[0]
            for a, b in stretches(data):
                ids, ends = self.stretch(data[a:b], stops[(stops > a) & (stops <= b)] - a, end)
                flat.append(ids)
                cuts.append(ends + total)
                total += len(ids)
        return np.concatenate(flat), np.concatenate(cuts)

    def encode(self, texts: pa.Array | list[str | None], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, `end` after each, and the offsets of each text's ids. Null is an empty text."""
        texts = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        texts = texts.fill_null("")
        odd = [i for i, x in enumerate(texts.to_pylist()) if is_odd(x)]
        if not odd:
            return self.plain(texts, end)
        regular = np.setdiff1d(np.arange(len(texts)), odd)
        flat, cuts = self.plain(texts.take(pa.array(regular)), end)
        out = dict(zip(regular.tolist(), np.split(flat, cuts[1:-1]), strict=False)) if len(regular) else {}
        for i, ids in zip(odd, self.whole(texts.take(pa.array(odd)).to_pylist()), strict=True):
            out[i] = np.array([*ids, end], np.uint32)
        rows = [out[i] for i in range(len(texts))]
        return np.concatenate(rows), np.concatenate([[0], np.cumsum(list(map(len, rows)))])


def parted(runs: list[list[int]], stop: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of runs without their stops, in a row, and how many stand before each stop."""
    ids = np.concatenate([np.empty(0, np.uint32), *(np.array(x, np.uint32) for x in runs)])
    stops = np.flatnonzero(ids == stop)
    return np.delete(ids, stops), np.diff(stops, prepend=-1) - 1


def gather(ids: np.ndarray, starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the lists at the given places in a row, and their offsets."""
    out = pa.LargeListArray.from_arrays(pa.array(starts), pa.array(ids)).take(pa.array(at))
    return out.flatten().to_numpy(), out.offsets.to_numpy()


@lru_cache(maxsize=2)
def encoder(path: str, leading_blank: bool) -> Encoder:
    """One encoder for each worker process, kept from task to task."""
    return Encoder(path, leading_blank)
