"""Shingle hashes and MinHash signatures with numpy, many texts at a time."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@lru_cache(maxsize=64)
def _odd(seed: int, n: int, dtype=np.uint64) -> np.ndarray:
    """``n`` odd multipliers, the same in every process."""
    bits = np.iinfo(dtype).bits
    return np.random.default_rng(seed).integers(0, 1 << (bits - 1), n, dtype=np.uint64).astype(dtype) * dtype(2) + dtype(1)


_WORD_BASE = np.uint64(_odd(11, 1)[0])
_PLACE = _odd(12, 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in ``raw``, and the words per text.

    Words are runs of bytes other than ``\\x20`` and ``\\x09``–``\\x0D``, with
    A-Z lower-cased.
    """
    n = len(offsets) - 1
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    low = _LOWER[raw]
    inside = ~((low == 32) | ((low >= 9) & (low <= 13)))
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][np.diff(offsets) > 0]          # a text begins a word of its own
    first[at] = inside[at]
    begin = np.flatnonzero(first)
    if not len(begin):
        return np.zeros(0, np.uint64), np.zeros(n, np.int64)
    chars = low[inside].astype(np.uint64) + np.uint64(1)
    starts = np.flatnonzero(first[inside])
    lengths = np.diff(np.append(starts, len(chars)))
    place = np.arange(len(chars)) - np.repeat(starts, lengths)
    powers = np.full(int(lengths.max()), _WORD_BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    chars *= powers[place]
    hashes = mix(np.add.reduceat(chars, starts) + lengths.astype(np.uint64) * _PLACE[63])
    return hashes, np.diff(np.searchsorted(begin, offsets))


def sequence_hashes(items: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``k`` consecutive items of each text, and how many.

    A text of fewer items, but not none, has one: its whole sequence.
    """
    texts = len(counts)
    ends = np.cumsum(counts)
    begins = ends - counts
    some = np.minimum(counts, 1)
    n = np.where(counts >= k, counts - k + 1, some)
    total = int(n.sum())
    if not total:
        return np.zeros(0, np.uint64), n
    text = np.repeat(np.arange(texts), n)
    at = np.arange(total) - np.repeat(np.cumsum(n) - n, n) + begins[text]
    size = np.minimum(counts, k)[text]
    out = size.astype(np.uint64) * _PLACE[62]
    for j in range(k):
        if total == 0:
            break
        has = size > j
        out += np.where(has, items[np.minimum(at + j, len(items) - 1)] * _PLACE[j], np.uint64(0))
    return mix(out), n


def distinct_sets(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text the distinct values, those of a text side by side, and how many."""
    text = np.repeat(np.arange(len(counts)), counts)
    # one sort by the text's number and as many of the upper bits as fit behind it
    bits = max(1, int(len(counts)).bit_length())
    order = np.argsort((text.astype(np.uint64) << np.uint64(64 - bits)) | (values >> np.uint64(bits)))
    sorted_values, sorted_text = values[order], text[order]
    same_text = sorted_text[1:] == sorted_text[:-1]
    new = sorted_values[1:] != sorted_values[:-1]
    if (same_text & new & ((sorted_values[1:] >> np.uint64(bits)) == (sorted_values[:-1] >> np.uint64(bits)))).any():
        order = np.lexsort((values, text))                 # values that differ in the lower bits only
        sorted_values, sorted_text = values[order], text[order]
        new = sorted_values[1:] != sorted_values[:-1]
    keep = np.ones(len(values), bool)
    keep[1:] = new | (sorted_text[1:] != sorted_text[:-1])
    return sorted_values[keep], np.bincount(sorted_text[keep], minlength=len(counts)).astype(np.int64)


def distinct_counts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many distinct values each text has."""
    out, ends = counts.astype(np.int64), np.cumsum(counts).tolist()
    for i, (n, end) in enumerate(zip(counts.tolist(), ends)):
        if n > 1:
            own = np.sort(values[end - n:end])
            out[i] -= np.count_nonzero(own[1:] == own[:-1])
    return out


def set_digests(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set (0 for an empty one)."""
    a, b = np.zeros(len(counts), np.uint64), np.zeros(len(counts), np.uint64)
    some = counts > 0
    if some.any():
        starts = (np.cumsum(counts) - counts)[some]
        a[some] = np.add.reduceat(mix(values + np.uint64(0x51ED27)), starts)
        b[some] = np.bitwise_xor.reduceat(mix(values ^ np.uint64(0xA7C15D3B9)), starts)
    return a, b


# values of a set that are hashed side by side, and how many such runs at a time
LANES, RUNS = 32, 512


def signatures(values: np.ndarray, counts: np.ndarray, samples: int, seed: int = 21) -> np.ndarray:
    """MinHash samples (texts × samples, uint32); all ones for an empty set.

    A sample is the smallest product of the values' upper halves (which are
    hashes) with an odd number.  Sets are cut into runs of ``LANES`` values (the
    last value fills up), which lie in the columns of a matrix: products and
    minima are taken along whole rows.
    """
    out = np.full((len(counts), samples), 0xFFFFFFFF, np.uint32)
    rows = np.flatnonzero(counts > 0)
    if not len(rows):
        return out
    n, starts = counts[rows], (np.cumsum(counts) - counts)[rows]
    runs = -(-n // LANES)
    first = np.cumsum(runs) - runs
    begin = np.repeat(starts - first * LANES, runs) + np.arange(int(runs.sum())) * LANES
    last = np.repeat(starts + n - 1, runs)
    odd = _odd(seed, samples, np.uint32)
    least = np.empty((samples, len(begin)), np.uint32)
    lanes = np.arange(LANES)[:, None]
    for c in range(0, len(begin), RUNS):
        x = values[np.minimum(begin[c:c + RUNS] + lanes, last[c:c + RUNS])]
        x = (x >> np.uint64(32)).astype(np.uint32)
        product = np.empty_like(x)
        for p in range(samples):
            np.multiply(x, odd[p], out=product)
            np.minimum.reduce(product, axis=0, out=least[p, c:c + RUNS])
    for p in range(samples):
        out[rows, p] = np.minimum.reduceat(least[p], first)
    return out


def binned_signatures(values: np.ndarray, counts: np.ndarray, bins: int, passes: int, seed: int = 51) -> np.ndarray:
    """MinHash samples (texts × ``bins * passes``, uint32) at one product per
    value and pass instead of one per value and sample.

    Each pass deals the values out to ``bins`` and keeps the smallest hash in
    each.  Sample ``i * passes + j`` is bin ``i`` of pass ``j``; all ones for a
    bin without values.  Two sets agree in a bin that either of them fills with
    a probability of their similarity, as in :func:`signatures`.
    """
    x = (values >> np.uint64(32)).astype(np.uint32)
    begin = np.repeat(np.arange(len(counts)) * bins, counts)
    odd = _odd(seed, 2 * passes, np.uint32)
    least = np.full((passes, len(counts) * bins), 0xFFFFFFFF, np.uint32)
    for j in range(passes):
        place = ((x * odd[2 * j] >> np.uint32(16)) * np.uint32(bins)) >> np.uint32(16)
        np.minimum.at(least[j], begin + place, x * odd[2 * j + 1])
    return least.reshape(passes, len(counts), bins).transpose(1, 2, 0).reshape(len(counts), bins * passes)


def band_keys(signature: np.ndarray, bands: int, rows: int, seed: int = 31) -> np.ndarray:
    """One 64-bit key per text and band of ``rows`` samples."""
    weight, number = _odd(seed, rows), _odd(seed + 1, bands)
    out = np.tile(number, (len(signature), 1))
    for j in range(rows):
        out += signature[:, j:bands * rows:rows] * weight[j]
    return mix(out)


def odd_sketches(signature: np.ndarray, words: int, seed: int = 41) -> np.ndarray:
    """Parity bitmaps (texts × ``words`` 64-bit words): each sample, with its
    number, flips one bit."""
    bits = 64 * words
    number = _odd(seed, signature.shape[1])
    flip = np.zeros((len(signature), bits), np.uint8)
    rows = np.arange(len(signature))
    for p in range(signature.shape[1]):
        at = (mix(signature[:, p].astype(np.uint64) + number[p]) % np.uint64(bits)).astype(np.int64)
        flip[rows, at] ^= 1
    return np.packbits(flip, axis=1).view(np.uint64).reshape(len(signature), words)


def most_odd_bits(samples: int, words: int, similarity: float, sigmas: float = 4.0) -> int:
    """The population count of the XOR of two odd sketches that sets of at
    least ``similarity`` stay below, but for ``sigmas`` deviations both of
    the samples that differ and of the bits they flip."""
    bits = 64 * words
    differ = samples * (1 - similarity) + sigmas * (samples * similarity * (1 - similarity)) ** 0.5
    flips = 2 * min(differ, samples)
    expected = bits / 2 * (1 - (1 - 2 / bits) ** flips)
    spread = (bits / 4 * (1 - (1 - 4 / bits) ** flips)) ** 0.5
    return int(min(bits, expected + sigmas / 2 * spread))


def char_shingles(texts: list[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``k`` consecutive characters of each text, and how
    many; none for a text of fewer."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    n = np.maximum(lengths - k + 1, 0)
    if not n.sum():
        return np.zeros(0, np.uint64), n
    size = len(points) - k + 1
    if k == 8:                                    # pairs, then pairs of pairs
        two = points[:-1] | points[1:] << np.uint64(21)
        four = two[:-2] * _PLACE[0] + two[2:] * _PLACE[1]
        out = four[:-4] * _PLACE[2] + four[4:]
    else:
        out = np.zeros(size, np.uint64)
        for j in range(k):
            out += points[j:j + size] * _PLACE[j]
    ends = np.cumsum(lengths)
    inside = np.ones(len(points) + k, bool)               # of one text: not in its last k - 1 places
    for j in range(1, k):
        inside[(ends - np.minimum(j, lengths))[lengths > 0]] = False
    return mix(out[inside[:size]]), n
