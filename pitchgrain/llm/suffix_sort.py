"""Two-stage suffix sorting of a byte text in a task, as far as a given depth."""

from __future__ import annotations

import numpy as np


def words_at(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number that sorts as they do; zeros follow the text."""
    padded = np.concatenate((text, np.zeros(16, np.uint8)))
    out = np.empty(len(text) + 1, np.uint64)
    for r in range(8):
        part = out[r::8]
        part[:] = np.frombuffer(padded, ">u8", len(part), r)
    return out


def rising(text: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the next one. The last suffix is larger than the empty one."""
    n = len(text)
    ends = np.append(np.flatnonzero(text[1:] != text[:-1]), n - 1)
    grows = np.append(text[ends[:-1] + 1] > text[ends[:-1]], False)
    return np.repeat(grows, np.diff(ends, prepend=-1))


def directly_sorted(at: np.ndarray, eight: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` ordered by their first ``depth`` bytes, ties by position: eight bytes a round,
    and in each round only what was equal so far."""
    order = at[np.argsort(eight[at], kind="stable")]
    last, key = len(eight) - 1, eight[order]
    same = key[1:] == key[:-1]
    for shift in range(8, depth, 8):
        tied = np.append(False, same) | np.append(same, False)
        where = np.flatnonzero(tied)
        if not len(where):
            break
        group = np.cumsum(~np.append(False, same))[where]
        members = order[where]
        key = eight[np.minimum(members + shift, last)]
        sort = np.lexsort((key, group))
        order[where] = members[sort]
        key, group = key[sort], group[sort]
        equal = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        same = np.zeros(len(order) - 1, bool)
        touching = np.flatnonzero(np.diff(where) == 1)
        same[where[touching]] = equal[touching]
    return order


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` in the order of their suffixes' first ``depth`` bytes at least.

    First stage: suffixes smaller than their successors are sorted directly. Second stage: a scan
    over buckets by first byte, rising, puts all others where they belong: the suffix before each
    entry of a bucket, if its first byte is larger, is the next in that byte's bucket; within a run
    of one byte it is the next in the same bucket.
    """
    n = len(text)
    if n == 0:
        return np.empty(0, np.int64)
    up = rising(text)
    eight = words_at(text)
    stars = directly_sorted(np.flatnonzero(up), eight, depth)
    edges = np.searchsorted(text[stars], np.arange(257), side="left") if len(stars) else np.zeros(257, np.int64)
    falling: list[list[np.ndarray]] = [[] for _ in range(256)]
    falling[text[n - 1]].append(np.array([n - 1]))  # it stands before the empty suffix
    out = []
    for byte in range(256):
        parts = falling[byte]
        level = np.concatenate(parts) if parts else np.empty(0, np.int64)
        bucket = [level]
        while len(level):
            before = level[level > 0] - 1
            level = before[text[before] == byte]
            bucket.append(level)
        bucket.append(stars[edges[byte] : edges[byte + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        before = whole[whole > 0] - 1
        first = text[before]
        larger = first > byte
        before, first = before[larger], first[larger]
        if len(before):
            sort = np.argsort(first, kind="stable")
            before, first = before[sort], first[sort]
            cuts = np.flatnonzero(np.diff(first)) + 1
            for part in np.split(before, cuts):
                falling[text[part[0]]].append(part)
    return np.concatenate(out)


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """For each entry but the first, the bytes it shares with the one before, counted up to ``depth``."""
    eight = words_at(text)
    a, b = order[:-1], order[1:]
    out = np.zeros(len(a), np.int64)
    open_, last = np.arange(len(a)), len(text)
    for shift in range(0, depth, 8):
        x, y = eight[np.minimum(a[open_] + shift, last)], eight[np.minimum(b[open_] + shift, last)]
        differ = x ^ y
        whole = differ == 0
        done = open_[~whole]
        if len(done):
            d = differ[~whole]
            lead = np.zeros(len(d), np.int64)
            for k in range(8):  # equal leading bytes
                lead += (lead == k) & ((d >> np.uint64(56 - 8 * k)) & np.uint64(255) == 0)
            out[done] = shift + lead
        open_ = open_[whole]
        if not len(open_):
            break
    out[open_] = depth
    return np.minimum(out, np.minimum(depth, last - np.maximum(a, b)))
