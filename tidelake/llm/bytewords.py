"""Words of many texts at once, from the bytes of an Arrow string column."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np

from tidelake.llm.common import cut, utf8

#: Bytes that a task works on at once; a longer text is cut into pieces of about so many, between words.
PIECE = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Letters in lower case as they are in words: a-z, A-Z as a-z, and the bytes of characters beyond ASCII; 0: no letter.
LETTER = np.zeros(256, np.uint8)
LETTER[0x61:0x7B] = LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTER[0x80:] = np.arange(0x80, 0x100)


@lru_cache(4)
def _powers(bits: int) -> np.ndarray:
    """Odd multipliers by the place of a byte in its word, none of them twice, for 2^bits places."""
    return np.cumprod(np.full(1 << bits, 0x9E3779B97F4A7C15, np.uint64), dtype=np.uint64)


@dataclass
class Pieces:
    """Successive bytes of some rows: ``data``, cut at ``ends`` (from 0), each piece of row ``row``."""

    data: np.ndarray
    ends: np.ndarray
    row: np.ndarray


def pieces(column) -> Iterator[Pieces]:
    """All bytes of a column without nulls, in order, in groups of about ``PIECE``; empty rows are pieces too."""
    data, offsets = utf8(column)
    sizes = np.diff(offsets)
    for start, end in cut(sizes, PIECE):
        if sizes[start] <= PIECE or end > start + 1:
            yield Pieces(data[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start], np.arange(start, end))
            continue
        at, stop = int(offsets[start]), int(offsets[end])
        while at < stop:
            end_ = min(at + PIECE, stop)
            if end_ < stop:
                # Between words: after the last blank, or after the next one where a word is longer than a piece.
                blanks = np.flatnonzero(BLANK[data[at:end_]])
                later = np.flatnonzero(BLANK[data[end_:stop]]) if not len(blanks) else blanks
                end_ = at + int(blanks[-1]) + 1 if len(blanks) else end_ + int(later[0]) + 1 if len(later) else stop
            yield Pieces(data[at:end_], np.array([0, end_ - at]), np.array([start]))
            at = end_


def word_starts(p: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Where words (runs of non-blanks) begin, and the piece that each is in."""
    blank = BLANK[p.data]
    first = ~blank
    first[1:] &= blank[:-1]
    heads = p.ends[:-1][np.diff(p.ends) > 0]
    first[heads] = ~blank[heads]
    starts = np.flatnonzero(first)
    return starts, np.searchsorted(p.ends, starts, side="right") - 1


def mixed(hashes: np.ndarray) -> np.ndarray:
    """Hashes whose low bits depend on all bits."""
    hashes = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return hashes ^ (hashes >> np.uint64(32))


def word_hashes(values: np.ndarray, starts: np.ndarray, prefix: int | None = None) -> np.ndarray:
    """A 64-bit hash of each word's non-zero ``values``, of the first ``prefix`` only if given; 0 for none."""
    if not len(starts):
        return np.empty(0, np.uint64)
    kept = values > 0
    rank = np.cumsum(kept, dtype=np.int32)
    lengths = np.diff(np.append(starts, len(values)))
    place = rank - np.repeat(rank[starts] - kept[starts], lengths).astype(np.int32) if starts[0] == 0 else None
    if place is None:
        place = np.zeros(len(values), np.int32)
        place[starts[0] :] = rank[starts[0] :] - np.repeat(rank[starts] - kept[starts], lengths)
    use = kept if prefix is None else kept & (place <= prefix)
    powers = _powers(max(6, int(place.max()).bit_length()))
    terms = np.where(use, values, 0).astype(np.uint64) * powers[place]
    sums = np.add.reduceat(terms, starts)
    return np.where(sums == 0, np.uint64(0), mixed(sums))
