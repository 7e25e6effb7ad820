"""Word shingles and MinHash values of many texts at once, on Arrow arrays inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

SIZE = 5
#: Shingles that are hashed at a time, so that the work stays in the processor's cache.
BLOCK = 1 << 15

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed one-to-one scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def words_of(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different words of all texts (runs without ASCII blanks, A-Z lowered), each text's words as places among them, and where each text begins."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.flatten().dictionary_encode()
    words = coded.dictionary.to_numpy(zero_copy_only=False)
    index = coded.indices.to_numpy(zero_copy_only=False)
    real = np.fromiter((w != "" for w in words), bool, len(words))[index]
    owner = np.repeat(np.arange(len(counts)), counts)[real]
    begin = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(counts)))))
    return words, index[real], begin


def hashed(words: np.ndarray) -> np.ndarray:
    return pd.util.hash_array(words, categorize=False) if len(words) else np.empty(0, np.uint64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all texts' words, and where each text begins."""
    words, index, begin = words_of(texts)
    return hashed(words)[index], begin


def shingle_sets(texts: pa.Array, size: int = SIZE) -> Iterator[np.ndarray]:
    """Each text's distinct shingles as sorted 64-bit hashes; of fewer words, the whole sequence as one."""
    words, begin = word_hashes(texts)
    return sets_between(words, begin[:-1], begin[1:], size)


def sets_between(words: np.ndarray, begins: np.ndarray, ends: np.ndarray, size: int = SIZE) -> Iterator[np.ndarray]:
    """The same for each stretch of hashed words."""
    full = max(len(words) - size + 1, 0)
    runs = np.zeros(full, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            runs = runs * _STEP + words[k : k + full]
        runs = mixed(runs)
        for b, e in zip(begins.tolist(), ends.tolist(), strict=True):
            if e - b >= size:
                yield np.unique(runs[b : e - size + 1])
            elif e > b:
                value = np.uint64(e - b)
                for w in words[b:e]:
                    value = value * _STEP + w
                yield mixed(np.array([value], np.uint64))
            else:
                yield np.empty(0, np.uint64)


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that stand for the set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def leading(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The least hashes of each set, of which any two sets share one if their similarity reaches ``percent``, and where each set's begin.

    The common shingles are ``percent`` of either set at least, so of a set of n not all lie behind its first n - ceil(percent n / 100) + 1.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    counts = np.minimum(sizes, sizes + -percent * sizes // 100 + 1)
    keys = np.concatenate([s[:k] for s, k in zip(sets, counts, strict=True)]) if sets else np.empty(0, np.uint64)
    return np.concatenate(([0], np.cumsum(counts))), keys.view(np.int64)


def minhashes(sets: list[np.ndarray], count: int, seed: int = 1) -> np.ndarray:
    """A row of ``count`` 64-bit minima for each set, none of which may be empty."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    shift = rng.integers(0, 1 << 63, count, dtype=np.uint64)
    out = np.empty((len(sets), count), np.uint64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(sets):
            last, held = first, 0
            while last < len(sets) and (last == first or held + len(sets[last]) <= BLOCK):
                held += len(sets[last])
                last += 1
            part = sets[first:last]
            values = np.concatenate(part)
            at = np.cumsum([0, *(len(x) for x in part[:-1])])
            work = np.empty_like(values)
            for k in range(count):
                np.multiply(values ^ shift[k], factor[k], out=work)
                work ^= work >> np.uint64(32)
                out[first:last, k] = np.minimum.reduceat(work, at)
            first = last
    return out


def band_keys(values: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key for each band of ``rows`` minima."""
    bands = values.shape[1] // rows
    with np.errstate(over="ignore"):
        keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(values), 1))
        for k in range(rows):
            keys = keys * _STEP + values[:, k : bands * rows : rows]
        return mixed(keys).view(np.int64)


def bands_for(threshold: float, rows: int, miss: float) -> int:
    """The fewest bands of ``rows`` that overlook a pair at the threshold with probability ``miss`` at most."""
    return int(np.ceil(np.log(miss) / np.log1p(-(threshold**rows))))
