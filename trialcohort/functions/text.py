"""Text expressions: keyword search, tokens, joining."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from itertools import groupby
from os.path import commonprefix

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word characters are letters, digits and underscore of every script. Java's own \b changed its
# meaning between JDK releases, so boundaries are spelled out.
_WORD = r"[\p{L}\p{N}_]"
_BOUNDARY = rf"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"

FEW = 6  # alternatives that are tried one by one
SEVERAL = 100  # characters that a class lists one by one
DEEP = 200


def clean_keywords(keywords: Iterable[str]) -> list[str]:
    """Lower-cased, stripped, distinct; longest first, so 'app store' wins over 'app'."""
    words = {k.strip().lower() for k in keywords if k is not None} - {""}
    return sorted(words, key=lambda k: (-len(k), k))


def _is_word(c: str) -> bool:
    return c.isalnum() or c == "_"


def _folded(word: str) -> str:
    """The word in the characters that all their case variants share, where that is one: s for the long s, k for Kelvin."""
    pairs = ((c, c.upper().lower()) for c in word)
    return "".join(f if len(f) == 1 else c for c, f in pairs)


def _quoted(text: str) -> str:
    return "".join(c if _is_word(c) else "\\" + c for c in text)


def _class(low: str, high: str) -> str:
    """A character class of a range; what equals one of its characters in another letter case belongs to it."""
    return f"[{_quoted(low)}-{_quoted(high)}]"


def _choice(branches: list[tuple[str, str]]) -> str:
    """One of the patterns, each with its first character, ascending; many are halved by that, so few are tried at any place."""
    if len(branches) <= FEW:
        return "|".join(pattern for _, pattern in branches)
    half = len(branches) // 2
    low, high = branches[:half], branches[half:]
    return f"(?={_class(low[0][0], low[-1][0])})(?:{_choice(low)})|(?={_class(high[0][0], high[-1][0])})(?:{_choice(high)})"


def _trie(words: list[str], depth: int = 0) -> str:
    """A pattern for any of the distinct words, ascending, that tries a longer word before each of its beginnings."""
    rest = [w for w in words if w]
    if not rest:
        return ""
    if depth == DEEP:  # patterns nest once for each keyword that another begins with
        return "(?:" + "|".join(_quoted(w) for w in sorted(words, key=len, reverse=True)) + ")"
    branches = []
    for first, group in groupby(rest, key=lambda w: w[0]):
        group = list(group)
        shared = commonprefix([group[0], group[-1]])
        branches.append((first, _quoted(shared) + _trie([w[len(shared) :] for w in group], depth + 1)))
    if len(rest) < len(words):
        return f"(?:{_choice(branches)})?"
    return branches[0][1] if len(branches) == 1 else f"(?:{_choice(branches)})"


def keyword_pattern(keywords: Iterable[str]) -> str:
    """One case-insensitive pattern for any number of keywords with word bounds; group 1 is the keyword, the longest at its place.

    Keywords are merged by what they begin with, so the work at a place grows with the characters it shares with some
    keyword, not with their number. Where all keywords start and end in word characters, as they mostly do, one-sided edges
    do for the bounds. A look at the first character turns most places of a text down.
    """
    words = sorted(set(map(_folded, clean_keywords(keywords))))
    if not words:
        raise ValueError("no keywords given")
    firsts = sorted({w[0] for w in words})
    look = "".join(map(_quoted, firsts)) if len(firsts) <= SEVERAL else _class(firsts[0], firsts[-1])[1:-1]
    plain = all(_is_word(w[0]) and _is_word(w[-1]) for w in words)
    before, after = (f"(?<!{_WORD})", f"(?!{_WORD})") if plain else (_BOUNDARY, _BOUNDARY)
    return f"(?iu)(?=[{look}]){before}({_trie(words)}){after}"


def keyword_hits(text: Column, pattern: str) -> Column:
    """Distinct lower-cased keywords found in the whole text, sorted; empty when the text is null."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, F.lower)))


def any_hit(hits: Sequence[Column]) -> Column:
    """1 when any of the hit lists holds something, else 0."""
    return F.greatest(F.lit(0), *[F.when(F.size(h) > 0, 1).otherwise(0) for h in hits])


def keyword_dummies(hits: Sequence[Column], keywords: Iterable[str]) -> dict[str, Column]:
    """One 0/1 column per keyword: found in any of the hit lists."""
    together = F.flatten(F.array(*hits))
    return {
        "_" + k.strip().replace(" ", "_"): F.array_contains(together, k.strip().lower()).cast("int") for k in keywords
    }


def searched_text(columns: Sequence[str]) -> Column:
    """The searched columns as one text, nulls as empty."""
    return F.concat_ws(" | ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends (trim only knows the blank)."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def tokens(text: Column) -> Column:
    """Lower-cased tokens between white space."""
    return F.filter(F.split(F.lower(text), r"(?U)\s+"), lambda t: t != "")


def has_token(text: Column, words: Iterable[str]) -> Column:
    """True when one of the words is a whole token of the text; false for null."""
    return F.coalesce(F.arrays_overlap(tokens(text), F.array(*[F.lit(w) for w in words])), F.lit(False))


def contains(text: Column, part: str) -> Column:
    """Case-sensitive substring test; false for null."""
    return F.coalesce(F.contains(text, F.lit(part)), F.lit(False))


def join_list(items: Column, separator: str = ", ") -> Column:
    """The items as one text, '' for no list; nulls inside are left out.

    The filter is a higher-order function, which Spark keeps out of a stage's one generated method, see sum_skipping_nulls.
    """
    return F.coalesce(F.array_join(F.filter(items, lambda x: x.isNotNull()), separator), F.lit(""))


def unwrap_single(items: Column) -> Column:
    """The item of a one-item list, null for any other length."""
    return F.when(F.size(items) == 1, F.get(items, F.lit(0)))
