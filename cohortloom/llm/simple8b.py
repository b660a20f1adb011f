"""Simple-8b: as many ids in a 64-bit word as fit, in blocks that decode by themselves.

The top four bits of a word are its selector, which says how many ids of how many bits
follow in the other sixty. Selector 0 is the escape: the next word is one id as it is.
Blocks of a fixed number of ids share no word, so that any block can be decoded by its
offset, and all words of one selector are decoded together.
"""

from __future__ import annotations

import numpy as np

ESCAPE = 0
# Selector -> (ids in a word, bits of an id).
SELECTORS = {
    1: (120, 0),
    2: (60, 1),
    3: (30, 2),
    4: (20, 3),
    5: (15, 4),
    6: (12, 5),
    7: (10, 6),
    8: (8, 7),
    9: (7, 8),
    10: (6, 10),
    11: (5, 12),
    12: (4, 15),
    13: (3, 20),
    14: (2, 30),
    15: (1, 60),
}
BLOCK = 4096
TOGETHER = 1 << 17  # ids of whole blocks whose words are made together, so that a cache holds them
_COUNTS = np.array([1] + [SELECTORS[s][0] for s in range(1, 16)], dtype=np.int64)


def _selectors(ids: np.ndarray, block: int) -> np.ndarray:
    """The selector of the fullest word that starts at each id and ends in its block."""
    n = len(ids)
    least = np.ones(n, np.uint8)  # the first selector that is wide enough for an id, 16 if none
    most = int(ids.max())
    for s in range(1, 16):
        if most >> SELECTORS[s][1]:
            least += ids >= ids.dtype.type(1 << SELECTORS[s][1])
    # a column behind each block is too wide for all, so that no word goes past it
    rows = -(-n // block)
    wide = np.full((rows, block + 1), 16, np.uint8)
    full = n // block
    wide[:full, :block] = least[: full * block].reshape(full, block)
    if full < rows:
        wide[full, : n - full * block] = least[full * block :]
    wide = wide.ravel()
    # what more ids fit, fewer do: the selectors that fit a place are the last ones
    fitting = np.zeros(len(wide), np.uint8)
    widest, held = wide, 1  # of the ids from each place on, so many of them
    for s in range(15, 0, -1):
        count = SELECTORS[s][0]
        while held < count:
            more = min(held, count - held)
            if len(widest) <= more:
                break
            widest = np.maximum(widest[:-more], widest[more:])
            held += more
        if held < count:
            break
        fits = widest <= s
        if not fits.any():
            break
        fitting[: len(fits)] += fits
    selector = np.where(fitting > 0, 16 - fitting, ESCAPE).astype(np.uint8)
    return selector.reshape(rows, block + 1)[:, :block].ravel()[:n]


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the word offset at which each block starts (one more for the end)."""
    ids = np.asarray(ids)
    if ids.dtype != np.uint32:
        ids = ids.astype(np.uint64)
    size = block * max(1, TOGETHER // block)
    words, offsets, held = [np.zeros(0, np.uint64)], [], 0
    for at in range(0, len(ids), size):
        part, starts = _encode(ids[at : at + size], block)
        words.append(part)
        offsets.append(starts + held)
        held += len(part)
    return np.concatenate(words), np.concatenate([*offsets, [held]]).astype(np.uint64)


def _encode(ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Words, and the word offset at which each block starts."""
    n = len(ids)
    selector = _selectors(ids, block)
    step = _COUNTS[selector].astype(np.uint8).tobytes()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, dtype=np.int64)
    chosen = selector[starts]
    width = 1 + (chosen == ESCAPE)  # an escape takes two words
    place = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(width, out=place[1:])
    words = np.zeros(place[-1], np.uint64)
    ids = ids.astype(np.uint64)
    for s in np.unique(chosen).tolist():
        own = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            words[place[own] + 1] = ids[starts[own]]
            continue
        count, bits = SELECTORS[s]
        word = np.full(len(own), s << 60, np.uint64)
        if bits:
            first = starts[own]
            for k in range(count):
                word |= ids[first + k] << np.uint64(k * bits)
        words[place[own]] = word
    first = np.searchsorted(starts, np.arange(0, n, block))
    return words, place[first]


def decode(words: np.ndarray) -> np.ndarray:
    """The ids of any whole number of blocks."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    follows = np.zeros(len(words), bool)  # words that are an escaped id as it is
    for i in np.flatnonzero(selector == ESCAPE).tolist():
        if not follows[i]:
            follows[i + 1] = True
    heads = np.flatnonzero(~follows)
    chosen = selector[heads]
    place = np.zeros(len(heads) + 1, np.int64)
    np.cumsum(_COUNTS[chosen], out=place[1:])
    ids = np.zeros(place[-1], np.uint64)
    for s in np.unique(chosen).tolist():
        own = np.flatnonzero(chosen == s)
        if s == ESCAPE:
            ids[place[own]] = words[heads[own] + 1]
            continue
        count, bits = SELECTORS[s]
        if bits:
            mask = np.uint64((1 << bits) - 1)
            word = words[heads[own]]
            for k in range(count):
                ids[place[own] + k] = (word >> np.uint64(k * bits)) & mask
    return ids
