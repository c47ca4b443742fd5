"""Suffix arrays by induced sorting, with numpy, a bucket at a time.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour.
The leftmost-S suffixes are sorted: by their first eight bytes, and recursively, by
the next eight, inside groups that are still equal, up to ``depth`` bytes.  One
ascending and one descending sweep over the character buckets then place all
others: each suffix is put into its bucket once, by the suffix right of it.
"""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one big-endian number, zeros beyond the end."""
    padded = np.concatenate((text, np.zeros(16, np.uint8)))
    out = np.empty(len(text), np.uint64)
    for r in range(8):
        part = out[r::8]
        part[:] = np.frombuffer(padded[r:r + 8 * len(part)].tobytes(), ">u8")
    return out


def s_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the last one is not."""
    n = len(text)
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(text[1:].astype(np.int16) - text[:-1].astype(np.int16))
    step[-1] = -1
    # An equal neighbour has the type of the next position that differs.
    decided = np.where(step != 0, np.arange(n), n)
    return step[np.minimum.accumulate(decided[::-1])[::-1]] > 0


def _sorted_to(positions: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Positions by the ``depth`` bytes that follow; later words are read only inside ties."""
    n = len(words)
    order = np.argsort(words[positions], kind="stable")
    out, key = positions[order], words[positions][order]
    tied = np.concatenate(([False], key[1:] == key[:-1])) if len(key) else np.empty(0, bool)
    for at in range(8, depth, 8):
        member = tied.copy()
        member[:-1] |= tied[1:]
        places = np.flatnonzero(member)
        if not len(places):
            break
        group = np.cumsum(~tied)[places]
        own = out[places] + at
        word = np.where(own < n, words[np.minimum(own, n - 1)], np.uint64(0))
        order = np.lexsort((word, group))
        out[places] = out[places][order]
        word = word[order]
        again = np.concatenate(([False], (word[1:] == word[:-1]) & (group[1:] == group[:-1])))
        tied = np.zeros(len(out), bool)
        tied[places] = again
    return out


def suffix_array(text: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes of ``text`` (bytes) in the order of their first ``depth`` bytes at least."""
    n = len(text)
    if n < 2:
        return np.arange(n)
    small = s_types(text)
    leftmost = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    leftmost = _sorted_to(leftmost, words, depth)
    heads: list[list[np.ndarray]] = [[] for _ in range(256)]  # larger ones, ascending
    tails: list[list[np.ndarray]] = [[] for _ in range(256)]  # smaller ones, descending
    first = text[leftmost]
    bounds = np.searchsorted(first, np.arange(257))
    heads[text[-1]].append(np.array([n - 1]))  # the last suffix is the smallest of its bucket

    def send(after: np.ndarray, wanted: bool, to: list[list[np.ndarray]], c: int) -> np.ndarray:
        """Deals the left neighbours of the wanted type to their buckets, in order; returns those of bucket c."""
        left = after[after > 0] - 1
        left = left[small[left] == wanted]
        chars = text[left]
        own = left[chars == c]
        rest, chars = left[chars != c], chars[chars != c]
        order = np.argsort(chars, kind="stable")
        rest, chars = rest[order], chars[order]
        cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
        if len(rest):
            for part in np.split(rest, cuts):
                to[text[part[0]]].append(part)
        return own

    larger: list[np.ndarray] = [np.empty(0, np.int64)] * 256
    for c in range(256):
        parts = list(heads[c])
        new = np.concatenate(parts) if parts else np.empty(0, np.int64)
        while len(new):  # runs of one character
            new = send_own(new, text, small, False, c)
            if len(new):
                parts.append(new)
        larger[c] = np.concatenate(parts) if parts else np.empty(0, np.int64)
        send(np.concatenate((larger[c], leftmost[bounds[c]:bounds[c + 1]])), False, heads, c)
    smaller: list[np.ndarray] = [np.empty(0, np.int64)] * 256
    for c in range(255, -1, -1):
        parts = list(tails[c])
        new = np.concatenate(parts) if parts else np.empty(0, np.int64)
        while len(new):
            new = send_own(new, text, small, True, c)
            if len(new):
                parts.append(new)
        smaller[c] = np.concatenate(parts) if parts else np.empty(0, np.int64)
        send(np.concatenate((smaller[c], larger[c][::-1])), True, tails, c)
    return np.concatenate([x for c in range(256) for x in (larger[c], smaller[c][::-1])])


def send_own(after: np.ndarray, text: np.ndarray, small: np.ndarray, wanted: bool, c: int) -> np.ndarray:
    left = after[after > 0] - 1
    return left[(small[left] == wanted) & (text[left] == c)]


def common_prefixes(order: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Permuted common prefixes: for each position, in text order, whether its suffix shares its
    first ``depth`` bytes with the suffix before it in ``order``."""
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.flatnonzero(before >= 0)
    whole, rest = divmod(depth, 8)
    offsets = [8 * k for k in range(whole)] + ([depth - 8] if rest else [])
    for offset in offsets:
        a, b = at + offset, before[at] + offset
        inside = (a < n) & (b < n)
        at, a, b = at[inside], a[inside], b[inside]
        at = at[words[a] == words[b]]
    shared = np.zeros(n, bool)
    shared[at] = True
    return shared
