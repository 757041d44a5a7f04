"""Splitting texts as byte-level tokenizers do: by a pattern, or into units that no match of the usual pattern crosses."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: White space of the tokenizers' patterns (fixed values): single bytes, and the first, second and third bytes of others.
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_TWO = (0xC2, (0x85, 0xA0))
_THREE = {(0xE1, 0x9A): (0x80,), (0xE2, 0x80): (*range(0x80, 0x8B), 0xA8, 0xA9, 0xAF), (0xE2, 0x81): (0x9F,), (0xE3, 0x80): (0x80,)}


def white(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 texts belong to white space."""
    out = _WHITE[data]
    lead = np.flatnonzero(data >= 0xC2)
    lead = lead[(data[lead] == _TWO[0]) | (data[lead] >= 0xE1) & (data[lead] <= 0xE3)]
    padded = np.append(data, (0, 0)).astype(np.uint8) if len(lead) else data
    two = lead[(padded[lead] == _TWO[0]) & np.isin(padded[lead + 1], _TWO[1])] if len(lead) else lead
    out[two] = out[two + 1] = True
    for (one, second), third in _THREE.items():
        at = lead[(padded[lead] == one) & (padded[lead + 1] == second) & np.isin(padded[lead + 2], third)] if len(lead) else lead
        out[at] = out[at + 1] = out[at + 2] = True
    return out


def units(data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Starts of units: a run of white space but for its last character, and that character with what follows up to the next run.

    ``borders`` rise from 0 to the number of bytes; units never cross one. White space before a border is one unit.
    No match of a pattern whose words may begin with one space, and whose longer runs of white space leave their last
    character to what follows, crosses a unit's start, and a unit alone is split as it is inside its text.
    """
    if not len(data):
        return np.empty(0, np.int64)
    space, edge = white(data), np.zeros(len(data), bool)
    edge[borders[borders < len(data)]] = True
    cut = edge.copy()
    cut[1:] |= space[1:] & ~space[:-1]
    follows = np.flatnonzero(~space[1:] & space[:-1] & ~edge[1:]) + 1  # what is no white space, after white space
    last = follows - 1
    for _ in range(2):
        last = np.where(data[last] & 0xC0 == 0x80, last - 1, last)
    cut[last] = True
    return np.flatnonzero(cut)


@lru_cache(maxsize=None)
def _differences(name: str) -> tuple[str, str]:
    """Characters of a class that tiktoken has and regex lacks, and the other way round, as ranges for a set."""
    import regex
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    single = tiktoken.Encoding("bytes", pat_str=name, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    theirs, ours = set(single.decode(single.encode_ordinary(every))), set(regex.findall(name, every))
    return _ranges(theirs - ours), _ranges(ours - theirs)


def _ranges(letters: set[str]) -> str:
    codes, out = sorted(map(ord, letters)), []
    for c in codes:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def with_library_classes(pattern: str) -> str:
    """The pattern for the regex module, with letters and numbers as the installed tiktoken's Unicode version has them."""
    for name in (r"\p{L}", r"\p{N}"):
        more, less = _differences(name)
        own = f"[{name}--[{less}]]" if less else name
        pattern = pattern.replace(name, f"[{own}||[{more}]]" if more else own)
    return pattern


class Splitter:
    """Matches of a pattern, in order."""

    def __init__(self, pattern: str):
        import regex

        self.matches = regex.compile(pattern, regex.V1).findall

    def distinct(self, texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(distinct pieces, index of every piece among them, bounds of each text's pieces); null texts have none."""
        split = [self.matches(t) if t else () for t in texts]
        place = {piece: k for k, piece in enumerate(dict.fromkeys(p for pieces in split for p in pieces))}
        index = np.array([place[p] for pieces in split for p in pieces], np.int64)
        return [p.encode() for p in place], index, np.concatenate(([0], np.cumsum([len(p) for p in split]))).astype(np.int64)
