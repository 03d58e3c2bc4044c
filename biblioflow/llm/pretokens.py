"""Byte-level BPE pre-tokens of Arrow text columns, found by numpy passes.

The rule is the published byte-level one: contractions ``'s 't 're 've 'm 'll 'd``; runs of
letters, of numbers and of other signs, each with one leading blank; white space runs, whose
last character goes with what follows if it is a blank.  Every character lies in exactly one
pre-token, so the result is a set of boundaries.  A special token's string is a pre-token of
its own, and what stands before and behind it is split apart from it.
"""

from __future__ import annotations

import sys
import unicodedata

import numpy as np
import pyarrow as pa

from biblioflow.llm.words import buffers, ship_by_value, worker_cache

LETTER, NUMBER, SPACE, OTHER = 0, 1, 2, 3
#: The characters of Unicode's White_Space property.
WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Letters and numbers of Unicode 16.0, which the tokenizers library follows,
#: that are not assigned in the 15.1 tables of Python's unicodedata.
NEW_LETTERS = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E),
    (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0)]
NEW_NUMBERS = [
    (0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]


#: Unicode versions of Python's unicodedata whose tables, with the lists above, are those of 16.0.
KNOWN_TABLES = ("15.1.0", "16.0.0")


def character_classes() -> np.ndarray:
    def build():
        if unicodedata.unidata_version not in KNOWN_TABLES:
            raise RuntimeError(f"this worker's Python knows Unicode {unicodedata.unidata_version}; ids are only right with one of {KNOWN_TABLES}")
        kind = {"L": LETTER, "N": NUMBER}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)),
                            np.uint8, sys.maxunicode + 1)
        for value, ranges in ((LETTER, NEW_LETTERS), (NUMBER, NEW_NUMBERS)):
            for low, high in ranges:
                table[low:high + 1] = value
        table[WHITE] = SPACE
        return table

    return worker_cache("character classes", build)


def _special_edges(data: np.ndarray, special: bytes) -> list[int]:
    raw, at, out = data.tobytes(), 0, []
    while (at := raw.find(special, at)) >= 0:
        out.append(at)
        at += len(special)
    return out


def pretokens(col: pa.Array, special: str = "<|endoftext|>") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start of each pre-token plus the end, first pre-token of each text) of a
    large_string array without nulls."""
    data, off = buffers(col)
    if len(data) == 0:
        return data, np.zeros(1, np.int64), np.zeros(len(off), np.int64)
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    n = len(cp)
    lead = np.flatnonzero((data & 0xC0) != 0x80)  # byte at which each character begins
    kind = character_classes()[cp]
    sp = special.encode()
    marks = []
    for m in _special_edges(data, sp):  # only where it lies within one text
        t = np.searchsorted(off, m, side="right") - 1
        if m + len(sp) <= off[t + 1]:
            marks.append(m)
    cut = np.searchsorted(lead, np.concatenate([off, marks, np.asarray(marks, np.int64) + len(sp)]).astype(np.int64))
    edge = np.zeros(n + 3, bool)  # a separately split part of a text begins here
    edge[cut] = True
    edge[n:] = True
    first = np.ones(n + 3, bool)
    first[1:n] = (kind[1:] != kind[:-1]) | edge[1:n]

    b = np.flatnonzero(first[1:n] & ~edge[1:n]) + 1  # inner run starts
    b = b[(kind[b] != SPACE) & (kind[b - 1] == SPACE)]
    first[b - 1] = True
    first[b[cp[b - 1] == 32]] = False

    c = np.concatenate([cp, np.zeros(3, np.uint32)])
    k = np.concatenate([kind, np.full(3, SPACE, np.uint8)])
    q = np.flatnonzero((cp == 39) & first[:n])
    q = q[~edge[q + 1]]
    one, two = c[q + 1], np.where(edge[q + 2], 0, c[q + 2])
    e, l, r, v = ord("e"), ord("l"), ord("r"), ord("v")
    size = np.where(np.isin(one, [ord(x) for x in "stmd"]), 2,
                    np.where(((one == r) | (one == v)) & (two == e) | (one == l) & (two == l), 3, 0))
    q, size = q[size > 0], size[size > 0]
    first[q + 1] = False
    rest = q + size
    first[rest[k[rest] == LETTER]] = True
    for m in marks:
        a = int(np.searchsorted(lead, m))
        first[a + 1:a + len(sp)] = False
        first[a] = True
    start = lead[np.flatnonzero(first[:n])]
    return data, np.append(start, len(data)), np.searchsorted(start, off)


ship_by_value(__name__)
