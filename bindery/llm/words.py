"""Words of whole texts as 64-bit hashes, for whole Arrow batches at a time (numpy).

Words are maximal runs of bytes other than [\\x20\\x09-\\x0D] of the UTF-8 text; since those are ASCII,
this is the same as by characters.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_U = np.uint64
_MULTIPLIER = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# 0: space, 1: ASCII letters and digits and all bytes of longer characters, 2: other signs
_KIND = np.full(256, 2, np.uint8)
_KIND[128:] = 1
_KIND[[c for c in range(128) if chr(c).isalnum()]] = 1
_KIND[_IS_SPACE] = 0


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose every output bit depends on every input bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=_U) * _U(_MULTIPLIER))


class Words(NamedTuple):
    hashes: np.ndarray  # one per word, all documents one after another
    first: np.ndarray  # document i has words first[i] up to first[i + 1]
    begin: np.ndarray  # byte place of each word in ``data``
    end: np.ndarray
    data: bytes  # all texts, with a newline after each


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    out[0] = 1
    return np.cumprod(out, dtype=_U)


def split_words(texts: list[bytes]) -> Words:
    return _split(texts, _IS_SPACE.astype(np.uint8) ^ 1)


def split_tokens(texts: list[bytes]) -> Words:
    """Words cut further into runs of letters and digits and runs of other signs."""
    return _split(texts, _KIND)


def _split(texts: list[bytes], kinds: np.ndarray) -> Words:
    """Runs of bytes of one kind, other than kind 0."""
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    kind = kinds[raw]
    edge = np.flatnonzero(np.diff(kind, prepend=0))  # the last byte is of kind 0
    runs = kind[edge] > 0
    begin, end = edge[runs], edge[np.flatnonzero(runs) + 1]
    n = len(raw) + 1
    sums = np.zeros(n, _U)
    np.cumsum(_BYTE_VALUE[raw] * _powers(_MULTIPLIER, n)[:-1], out=sums[1:])
    hashes = mix((sums[end] - sums[begin]) * _powers(_INVERSE, n)[begin] + (end - begin).astype(_U))
    ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.concatenate([[0], np.searchsorted(begin, ends)])
    return Words(hashes, first, begin, end, data)


def grams(hashes: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of the n words from each place on (places too near the end of the array are left out)."""
    out = np.zeros(max(len(hashes) - n + 1, 0), _U)
    for i in range(n):
        weight = _U((pow(_MULTIPLIER, i + 1, 1 << 64) + 2 * seed) % (1 << 64) | 1)
        out += hashes[i : i + len(out)] * weight
    return mix(out + _U(seed))


def document_of(first: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles per document, sorted: (hashes, first place per document).

    A document of fewer words has its whole word sequence as its one shingle; one without words
    has none.
    """
    counts = np.diff(words.first)
    all_grams = grams(words.hashes, n, n)
    doc = document_of(words.first)[: len(all_grams)]
    inside = np.arange(len(all_grams)) + n <= words.first[1:][doc]
    values, owner = [all_grams[inside]], [doc[inside]]
    for i in np.flatnonzero((counts > 0) & (counts < n)):
        own = words.hashes[words.first[i] : words.first[i + 1]]
        values.append(grams(own, len(own), len(own)))
        owner.append(np.array([i]))
    values, owner = np.concatenate(values), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    values, owner = values[order], owner[order]
    at = np.searchsorted(owner, np.arange(len(counts) + 1))
    for a, b in zip(at[:-1], at[1:]):
        values[a:b].sort()
    fresh = np.ones(len(values), bool)
    fresh[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[fresh], np.searchsorted(owner[fresh], np.arange(len(counts) + 1))


def super_minhash(values: np.ndarray, first: np.ndarray, m: int) -> np.ndarray:
    """SuperMinHash signatures (documents x m) of sets of hashes; sets without elements get the maximum.

    Each element meets the m components in the order of its own random permutation, drawn step by
    step; at step j it offers j plus a fraction. So a component's minimum is final once every
    component of the set holds less than j + 1, and the set's elements stop there.
    """
    n_docs = len(first) - 1
    best = np.full(n_docs * m, np.iinfo(np.uint64).max, _U)
    owner, x, drawn = document_of(first), values, []
    for j in range(m):
        bits = mix(x + _U(((j + 1) * _MULTIPLIER) % (1 << 64)))
        place = (((bits >> _U(32)) * _U(m - j)) >> _U(32)).astype(np.int32) + np.int32(j)
        at = place.copy()
        for t in range(j - 1, -1, -1):  # undo the swaps of the steps before
            at[at == drawn[t]] = t
        np.minimum.at(best, owner * m + at, (_U(j) << _U(32)) | (bits & _U(0xFFFFFFFF)))
        unfinished = best.reshape(n_docs, m).max(axis=1) >= (_U(j + 1) << _U(32))
        going = unfinished[owner]
        if not going.any():
            break
        drawn.append(place)
        if not going.all():
            owner, x, drawn = owner[going], x[going], [d[going] for d in drawn]
    return best.reshape(n_docs, m)
