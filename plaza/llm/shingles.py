"""Word shingles as 64-bit numbers, and SuperMinHash signatures of sets of them."""

from __future__ import annotations

import numpy as np

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True

# A random number per byte, the same for A-Z as for a-z; powers of an odd number modulo 2^64.
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTE[0x41:0x5B] = _BYTE[0x61:0x7B]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a one-to-one map)."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept for the next call."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = max(1 << 16, 1 << n.bit_length())
        out, have = np.ones(size, dtype=np.uint64), 1
        while have < size:
            out[have:2 * have] = out[:have] * np.uint64(pow(base, have, 1 << 64))
            have *= 2
        known = _powers[base] = out
    return known[:n]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word (lower-case A-Z, words between white space), and the words before each text."""
    joined = b"\n".join(texts)
    raw = np.frombuffer(joined, dtype=np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    solid = ~_SPACE[raw]
    edges = np.diff(np.concatenate([[False], solid, [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[raw] * powers(_BASE, len(raw)), out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64))
    lengths = np.array([len(t) + 1 for t in texts], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(lengths)])
    return hashes, np.searchsorted(starts, first)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingles of each text; a text of fewer words is one shingle, none without words."""
    words, at = word_hashes(texts)
    n = len(words)
    full = np.zeros(max(0, n - size + 1), dtype=np.uint64)
    for k in range(size):
        full = mixed(full + words[k:n - size + 1 + k] + np.uint64(k + 1)) if len(full) else full
    out = []
    for lo, hi in zip(at[:-1], at[1:]):
        count = hi - lo
        if count >= size:
            out.append(np.unique(full[lo:hi - size + 1]))
        elif count:
            one = np.array([count], dtype=np.uint64)
            for k in range(lo, hi):
                one = mixed(one + words[k:k + 1])
            out.append(one)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _draw(element: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The fraction and the random bits of an element at a step."""
    bits = mixed(element + np.uint64((step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    return (bits >> np.uint64(11)).astype(np.float64) * 2.0 ** -53, mixed(bits + np.uint64(1)) >> np.uint64(32)


def super_minhash(sets: list[np.ndarray], m: int) -> np.ndarray:
    """SuperMinHash signatures, a row per set (not empty).

    Each element owns a random permutation of the m places and gives the place at rank j
    the value j + u, 0 <= u < 1; a place keeps its least value. A place filled at a rank
    takes no value of a later one, so a set is done as soon as its places are full: all
    sets go through the ranks together and leave when done. The permutations are drawn by
    exchanges, rank by rank.
    """
    signature = np.full((len(sets), m), np.inf)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    element = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    u, bits = _draw(element, 0)
    place = ((bits * np.uint64(m)) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(signature.reshape(-1), owner * m + place, u)
    open_sets = np.flatnonzero(np.isinf(signature).any(axis=1))
    budget = 1 << 22  # numbers in the permutations held at a time
    while len(open_sets):
        take = max(1, int(np.searchsorted(np.cumsum(sizes[open_sets]) * m, budget)))
        _further_ranks(signature, element, owner, sizes, open_sets[:take], m)
        open_sets = open_sets[take:]
    return signature


def _further_ranks(signature: np.ndarray, element: np.ndarray, owner: np.ndarray, sizes: np.ndarray, chosen: np.ndarray, m: int) -> None:
    mine = np.zeros(len(signature), dtype=bool)
    mine[chosen] = True
    rows = np.flatnonzero(mine[owner])
    own, of = element[rows], owner[rows]
    order = np.tile(np.arange(m, dtype=np.int16), (len(own), 1))
    index = np.arange(len(own))
    for step in range(m):
        u, bits = _draw(own, step)
        other = step + ((bits * np.uint64(m - step)) >> np.uint64(32)).astype(np.int64)
        place = order[index, other]
        order[index, other] = order[:, step]
        if step:
            np.minimum.at(signature.reshape(-1), of * m + place, step + u)
        done = ~np.isinf(signature[chosen]).any(axis=1)
        if done.all():
            return
        if step % 4 == 0 and done.any():
            mine[chosen[done]] = False
            chosen = chosen[~done]
            left = mine[of]
            own, of, order = own[left], of[left], order[left]
            index = np.arange(len(own))
