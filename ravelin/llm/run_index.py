"""A run-length compressed suffix index of byte strings, and what matches long in it.

The suffixes that have ``least`` bytes to come are sorted; the byte before each, in that order, is the Burrows-Wheeler
transform. Where two neighbours have the same byte before them, the suffixes one byte earlier are neighbours as well and
share one byte more, so the length that a suffix shares with its neighbour need be measured at the ends of runs only
(the sampled run ends). In the order of the text every other length is the one before less one: the matching
statistics are streamed from the samples.

Why ``least`` decides exactly: a streamed length of ``least`` or more is a real match of two suffixes in the set, as lengths
stop at a string's end; and a suffix that shares ``least`` bytes with a neighbour is either sampled or follows one
that shares at least one more.
"""

from __future__ import annotations

import numpy as np

#: UTF-8 has no such byte, so what fills up behind a string matches no text.
FILL = 0xFF


def repeated_starts(strings: list[bytes], least: int) -> list[np.ndarray]:
    """For each string, of which starts 0 .. len - least the ``least`` bytes from there start anywhere else, too.

    Elsewhere is another place of the same string or any place of another. Strings are UTF-8 of ``least`` bytes or more.
    """
    sizes = np.array([len(s) for s in strings])
    width = int(sizes.max())
    fill = bytes([FILL]) * (width - least)
    joined = fill.join([*strings, b""])
    counts = sizes - least + 1
    offsets = np.concatenate(([0], np.cumsum(sizes + len(fill))[:-1]))
    n = int(counts.sum())
    firsts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    within = np.arange(n) - np.repeat(firsts, counts)
    starts = np.repeat(offsets, counts) + within
    left = np.repeat(sizes, counts) - within

    text = joined.decode("latin-1")  # one character a byte, which sorts as bytes do and much faster
    keys = [text[i : i + width] for i in starts.tolist()]
    order = np.array(sorted(range(n), key=keys.__getitem__))
    del keys, text

    raw = np.frombuffer(joined, np.uint8)
    before = np.where(within > 0, raw[starts - 1], 0).astype(np.int16)
    before[within == 0] = -1  # nothing stands before: a run of its own
    bwt = before[order]
    ends = np.flatnonzero((bwt[1:] != bwt[:-1]) | (bwt[1:] < 0))  # a run ends at rank i, the next begins at i + 1
    a, b = order[ends], order[ends + 1]
    shared = _common(raw, starts[a], starts[b], np.minimum(left[a], left[b]), width)

    hit = np.zeros(n, bool)
    place = np.arange(n)
    for sampled, lengths in ((b, shared), (a, shared)):  # shared with the neighbour before, and with the one behind
        known, length = np.zeros(n, bool), np.zeros(n, np.int64)
        known[sampled], length[sampled] = True, lengths
        known[order[0] if sampled is b else order[-1]] = True  # the outermost has no neighbour there
        known |= within == 0
        last = np.maximum.accumulate(np.where(known, place, 0))
        hit |= length[last] - (place - last) >= least
    return np.split(hit, firsts[1:])


def _common(raw: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray, width: int) -> np.ndarray:
    """Lengths of the common beginnings of ``raw`` from ``a`` and from ``b``, where both have ``most`` bytes at least."""
    view = np.lib.stride_tricks.sliding_window_view(np.concatenate((raw, np.full(width, FILL, np.uint8))), width)
    out = np.empty(len(a), np.int64)
    for i in range(0, len(a), 8192):  # bounded memory
        differ = view[a[i : i + 8192]] != view[b[i : i + 8192]]
        out[i : i + 8192] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    return np.minimum(out, most)


def runs_of(hit: np.ndarray) -> list[tuple[int, int]]:
    """(start, length) of the runs of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
    return list(zip(edges[::2].tolist(), (edges[1::2] - edges[::2]).tolist(), strict=True))
