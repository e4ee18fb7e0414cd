"""Pairwise string similarity for Arrow batches: the scoring step of the fuzzy joins.

Strings of a batch are laid out as padded matrices, so that one numpy operation advances all pairs
of the batch by one character.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

# Send the functions themselves, so that executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_CELLS = 4_000_000  # mask words held at a time, bounds memory for long texts
_CACHED = 1 << 16  # mask words that stay in the cache
_FEWEST = 512  # pairs at a time, where _CELLS allows, so that a numpy operation is worth its call


def _codes(texts: list[str]) -> np.ndarray:
    """One row of code points per text, padded with 0."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.zeros((len(texts), int(sizes.max(initial=0))), dtype=np.uint32)
    codes[np.arange(codes.shape[1]) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return codes


def _letters(left: list[str], right: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Texts as rows of letter numbers, padded with 0, and how many numbers there are."""
    a, b = _codes(left), _codes(right)
    used = np.zeros(int(max(a.max(initial=0), b.max(initial=0))) + 1, dtype=bool)
    used[0] = used[a] = used[b] = True
    number = np.cumsum(used) - 1
    return number[a], number[b], int(number[-1]) + 1


def lcs_lengths(left: list[str], right: list[str]) -> np.ndarray:
    """Length of the longest common subsequence of each pair."""
    a, b, letters = _letters(left, right)
    cells = letters * (a.shape[1] // 64 + 1)
    step = max(_CACHED // cells, min(_FEWEST, _CELLS // cells), 1)
    blocks = [_lcs_block(a[i : i + step], b[i : i + step], letters) for i in range(0, len(left), step)]
    return np.concatenate(blocks) if blocks else np.zeros(0, dtype=np.int64)


def _lcs_block(a: np.ndarray, b: np.ndarray, letters: int) -> np.ndarray:
    """Bit-parallel: bit i of a row falls once letter i of the left text is used in the best match."""
    words = a.shape[1] // 64 + 1
    rows = np.arange(len(a))
    at = np.zeros((len(a), letters, words), dtype=np.uint64)
    for i in range(a.shape[1]):
        at[rows, a[:, i], i // 64] |= np.uint64(1 << (i % 64))
    at[:, 0, :] = 0  # padding matches nothing
    return _matched((at[rows, b[:, j]] for j in range(b.shape[1])), len(a), words)


def _matched(places: Iterator[np.ndarray], rows: int, words: int) -> np.ndarray:
    """LCS lengths from the masks of the left texts' places that hold each letter of the right ones."""
    free = np.full((rows, words), np.iinfo(np.uint64).max, dtype=np.uint64)
    for here in places:
        if words == 1:
            used = free & here
            free = (free + used) | (free & ~here)
            continue
        carry = np.zeros(rows, dtype=np.uint64)
        for w in range(words):
            used = free[:, w] & here[:, w]
            low = free[:, w] + used
            total = low + carry
            carry = ((low < used) | (total < carry)).astype(np.uint64)
            free[:, w] = total | (free[:, w] & ~here[:, w])
    return 64 * words - np.bitwise_count(free).sum(axis=1, dtype=np.int64)


def _indel_percent(lcs: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.where(total > 0, 200.0 * lcs / np.maximum(total, 1), 100.0)


@F.pandas_udf(IntegerType())
def indel_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """100 x 2 LCS / (length + length), rounded half to even."""
    left, right = a.tolist(), b.tolist()
    total = np.array([len(x) + len(y) for x, y in zip(left, right)], dtype=np.int64)
    return pd.Series(np.rint(_indel_percent(lcs_lengths(left, right), total)).astype("int32"))


def _histograms(codes: np.ndarray, letters: int) -> np.ndarray:
    """How often each letter (row) is in each text (column); padding is no letter."""
    out = np.zeros((letters, len(codes)), dtype=np.int32)
    texts = np.arange(len(codes))
    for column in codes.T:
        out[column, texts] += 1
    out[0] = 0
    return out


def similar_cross(left: list[str], right: list[str], lowest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and :func:`indel_score` of all pairs of a left and a right text that score ``lowest`` or more.

    The letters in common bound each score; what is left is matched a left text at a time, so that one
    small table of masks serves all its pairs.
    """
    a, b, letters = _letters(left, right)
    mine, theirs = _histograms(a, letters), _histograms(b, letters)
    m, n = mine.sum(axis=0), theirs.sum(axis=0)
    words = a.shape[1] // 64 + 1
    columns = np.ascontiguousarray(b.T)
    found = []
    for i in range(len(left)):
        total = m[i] + n
        own = np.flatnonzero(mine[:, i])
        bound = np.minimum(theirs[own], mine[own, i, None]).sum(axis=0)
        some = np.flatnonzero(np.rint(_indel_percent(bound, total)) >= lowest)
        if not len(some):
            continue
        masks = np.zeros((letters, words), dtype=np.uint64)
        for k, c in enumerate(a[i, : m[i]]):
            masks[c, k // 64] |= np.uint64(1 << (k % 64))
        near = columns[: n[some].max(), some]
        score = np.rint(_indel_percent(_matched((masks[c] for c in near), len(some), words), total[some]))
        best = score >= lowest
        found.append((np.full(int(best.sum()), i), some[best], score[best].astype(np.int32)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    return tuple(np.concatenate(x) for x in zip(*found))


def similar_tile(lowest: int):
    """:func:`similar_cross` of the ``title`` columns of two groups."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        one, two = left.column("title").to_pylist(), right.column("title").to_pylist()
        i, j, scores = similar_cross(one, two, lowest)
        texts = {"l_title": pa.array([one[k] for k in i], pa.string()), "r_title": pa.array([two[k] for k in j], pa.string())}
        return pa.table(texts | {"t_score": pa.array(scores, pa.int32())})

    return score


@F.pandas_udf(IntegerType())
def partial_score(a: pd.Series, b: pd.Series) -> pd.Series:
    """Best ``indel_score`` of the shorter text against a part of the longer one.

    Parts are all windows as long as the shorter text and all shorter prefixes and suffixes.
    Equal lengths are tried both ways. Two empty texts score 100, one empty text scores 0.
    """
    pair, short, part = [], [], []
    score = np.zeros(len(a))
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        if not x and not y:
            score[i] = 100.0
            continue
        if not x or not y:
            continue
        ways = {(x, y), (y, x)} if len(x) == len(y) else {(min(x, y, key=len), max(x, y, key=len))}
        for s, t in ways:
            k = len(s)
            parts = {t[:j] for j in range(1, k)} | {t[j : j + k] for j in range(len(t))}
            pair += [i] * len(parts)
            short += [s] * len(parts)
            part += parts
    if pair:
        total = np.array([len(s) + len(p) for s, p in zip(short, part)], dtype=np.int64)
        np.maximum.at(score, np.array(pair), _indel_percent(lcs_lengths(short, part), total))
    return pd.Series(np.rint(score).astype("int32"))


PAIRS = 4096  # scored at once; texts of like length come together, so little of a matrix is padding


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points as a matrix, with -1 where a text has ended, and the lengths."""
    sizes = np.array([len(t) for t in texts], np.int64)
    out = np.full((len(texts), max(int(sizes.max(initial=0)), 1)), -1, np.int64)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out, sizes


def jaro_winkler(left: list[str], right: list[str]) -> np.ndarray:
    """Jaro-Winkler similarities of pairs, all pairs at a time, one step per place of the left texts.

    As usual, a character is matched with the first free equal one within reach, and a Jaro
    similarity above 0.7 gains by a common prefix of up to four characters.
    """
    x, m = _points(left)
    y, n = _points(right)
    reach = np.maximum(np.maximum(m, n) // 2 - 1, 0)
    place = np.arange(y.shape[1])
    taken, matched = np.zeros(y.shape, bool), np.zeros(x.shape, bool)
    rows = np.arange(len(left))
    for i in range(x.shape[1]):
        near = np.abs(place - i) <= reach[:, None]
        fits = (y == x[:, i : i + 1]) & near & ~taken & (i < m)[:, None]
        found = fits.any(axis=1)
        matched[found, i] = True
        taken[rows[found], fits[found].argmax(axis=1)] = True
    common = matched.sum(axis=1)
    first = np.take_along_axis(x, np.argsort(~matched, axis=1, kind="stable"), axis=1)
    second = np.take_along_axis(y, np.argsort(~taken, axis=1, kind="stable"), axis=1)
    width = min(x.shape[1], y.shape[1])
    differ = (first[:, :width] != second[:, :width]) & (np.arange(width) < common[:, None])
    swaps = differ.sum(axis=1) // 2
    some = np.maximum(common, 1)
    jaro = (common / np.maximum(m, 1) + common / np.maximum(n, 1) + (common - swaps) / some) / 3
    jaro = np.where(common > 0, jaro, 0.0)
    head = min(4, width)
    same = (x[:, :head] == y[:, :head]) & (x[:, :head] >= 0)
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    out = np.where(jaro > 0.7, jaro + prefix * 0.1 * (1 - jaro), jaro)
    equal = np.array([bool(a) and a == b for a, b in zip(left, right)], bool)
    return np.where(equal, 1.0, out)


@F.pandas_udf(DoubleType())
def jaro_winkler_score(a: pd.Series, b: pd.Series) -> pd.Series:
    left, right = a.tolist(), b.tolist()
    order = np.array(sorted(range(len(left)), key=lambda i: len(left[i]) + len(right[i])), np.int64)
    out = np.zeros(len(left))
    for start in range(0, len(order), PAIRS):
        at = order[start : start + PAIRS]
        out[at] = jaro_winkler([left[i] for i in at], [right[i] for i in at])
    return pd.Series(out, dtype="float64")
