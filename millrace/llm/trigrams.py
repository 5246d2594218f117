"""Boolean trigram queries that follow from a regular expression, and an index that answers them.

A query is True (nothing follows), a trigram, or ("and"/"or", parts). Letters are folded to lower case throughout, so
one index serves patterns of either case. Strings are bytes of UTF-8 written as Latin-1 characters.
"""

from __future__ import annotations

import re._constants as C
import re._parser as parser
from dataclasses import dataclass

import numpy as np

MOST = 64  # strings kept in a set before they are turned into a query


def fold(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def joined(op: str, parts) -> object:
    """And/or with the neutral and absorbing cases resolved."""
    flat: list = []
    for p in parts:
        if p is True:
            if op == "or":
                return True
            continue
        flat.extend(p[1] if isinstance(p, tuple) and p[0] == op else [p])
    flat = list(dict.fromkeys(flat))
    if not flat:
        return True
    return flat[0] if len(flat) == 1 else (op, tuple(flat))


def of_strings(strings) -> object:
    """One of the strings occurs: all trigrams of one of them do."""
    return joined("or", [joined("and", [s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


@dataclass(frozen=True)
class Facts:
    """What every match of an expression has: all its texts (exact), or how it begins and ends, and a query."""

    exact: frozenset | None
    prefix: frozenset
    suffix: frozenset
    query: object = True


EMPTY = Facts(frozenset([""]), frozenset([""]), frozenset([""]))
ANY = Facts(None, frozenset([""]), frozenset([""]))


def given(strings) -> Facts:
    s = frozenset(strings)
    return Facts(s, s, s)


def loosened(x: Facts) -> Facts:
    """The same without the exact texts: what they imply goes to the query."""
    if x.exact is None:
        return x
    return Facts(None, frozenset(s[:3] for s in x.exact), frozenset(s[-3:] for s in x.exact), joined("and", [x.query, of_strings(x.exact)]))


def followed(x: Facts, y: Facts) -> Facts:
    if x.exact is not None and y.exact is not None and len(x.exact) * len(y.exact) <= MOST:
        return given(a + b for a in x.exact for b in y.exact)
    ends = x.exact if x.exact is not None else x.suffix
    begins = y.exact if y.exact is not None else y.prefix
    crossing = of_strings({a[-2:] + b[:2] for a in ends for b in begins}) if len(ends) * len(begins) <= 4 * MOST else True
    lx, ly = loosened(x), loosened(y)
    prefix = frozenset((a + b)[:3] for a in x.exact for b in begins) if x.exact is not None and len(x.exact) * len(begins) <= MOST else lx.prefix
    suffix = frozenset((a + b)[-3:] for a in ends for b in y.exact) if y.exact is not None and len(y.exact) * len(ends) <= MOST else ly.suffix
    return Facts(None, prefix, suffix, joined("and", [lx.query, ly.query, crossing]))


def either(parts: list[Facts]) -> Facts:
    if all(p.exact is not None for p in parts) and sum(len(p.exact) for p in parts) <= MOST:
        return given(s for p in parts for s in p.exact)
    loose = [loosened(p) for p in parts]
    prefix, suffix = (frozenset().union(*(getattr(p, k) for p in loose)) for k in ("prefix", "suffix"))
    return Facts(None, prefix if len(prefix) <= MOST else frozenset([""]), suffix if len(suffix) <= MOST else frozenset([""]), joined("or", [p.query for p in loose]))


def _char(code: int) -> str:
    return fold(chr(code).encode().decode("latin-1"))


def _facts(node) -> Facts:
    kind, value = node
    if kind is C.LITERAL:
        return given([_char(value)])
    if kind is C.IN:
        chars: set[str] = set()
        for what, arg in value:
            if what is C.LITERAL:
                chars.add(_char(arg))
            elif what is C.RANGE and arg[1] - arg[0] < MOST:
                chars.update(_char(c) for c in range(arg[0], arg[1] + 1))
            else:
                return ANY
        return given(chars) if len(chars) <= 16 else ANY
    if kind is C.SUBPATTERN:
        return _sequence(value[-1])
    if kind is C.BRANCH:
        return either([_sequence(p) for p in value[1]])
    if kind in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
        least, most, body = value
        one = _sequence(body)
        if least == 0:
            return either([EMPTY, one]) if most == 1 and one.exact is not None else ANY
        out = EMPTY
        for _ in range(min(least, 8)):
            out = followed(out, one)
        return out if most == least <= 8 else followed(out, ANY)
    if kind in (C.AT, C.ASSERT, C.ASSERT_NOT):
        return EMPTY
    return ANY


def _sequence(nodes) -> Facts:
    out = EMPTY
    for node in nodes:
        out = followed(out, _facts(node))
    return out


def trigram_query(pattern: str) -> object:
    """What a text must hold for the pattern to match anywhere in it; True where nothing follows."""
    return loosened(_sequence(parser.parse(pattern))).query


def trigrams_of(query) -> set[str]:
    if query is True:
        return set()
    return {query} if isinstance(query, str) else set().union(*map(trigrams_of, query[1]))


class TrigramIndex:
    """Posting lists of chosen trigrams over a block of texts, one bit for each text."""

    def __init__(self, trigrams):
        self.names = sorted(trigrams)
        codes = [int.from_bytes(t.encode("latin-1"), "big") for t in self.names]
        self.number = np.full(1 << 24, -1, np.int16)
        self.number[codes] = np.arange(len(codes), dtype=np.int16)

    def postings(self, low: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        """low: the bytes of the texts, folded. Trigrams across two texts don't count."""
        texts = len(offsets) - 1
        table = np.zeros((len(self.names), texts), bool)
        if len(low) >= 3:
            code = low[:-2].astype(np.int32) << 16
            code |= low[1:-1].astype(np.int32) << 8
            code |= low[2:]
            which = self.number[code]
            at = np.flatnonzero(which >= 0)
            doc = np.searchsorted(offsets, at, side="right") - 1
            inside = at + 3 <= offsets[doc + 1]
            table[which[at[inside]], doc[inside]] = True
        return dict(zip(self.names, table))

    def candidates(self, query, postings: dict[str, np.ndarray], texts: int) -> np.ndarray:
        """The texts that satisfy the query, by intersecting and uniting posting lists."""
        if query is True:
            return np.ones(texts, bool)
        if isinstance(query, str):
            return postings[query]
        parts = [self.candidates(p, postings, texts) for p in query[1]]
        return (np.logical_and if query[0] == "and" else np.logical_or).reduce(parts)
