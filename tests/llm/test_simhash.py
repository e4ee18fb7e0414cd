"""SimHash near-dedup against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from bindery.llm import simhash
from bindery.llm.queries import QUERIES
from bindery.llm.simhash import gaps, linked_pairs, linked_prints, part_counts, plan_tiles, simhash_near_duplicates, split

from .conftest import changed, frame, prose
from .test_dedup import groups_of


def fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, radius=4):
    prints = [fingerprint(t) for _, t, *_ in rows]
    links = [
        (i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius
    ]
    root = groups_of(links, range(len(rows)))
    least = {}
    for i, r in root.items():
        if rows[i][0] is not None:
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return Counter((rows[i][0], f"{prints[i]:016x}", least.get(root[i])) for i in range(len(rows)))


def found(df):
    return Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect())


def test_messy_table(messy, messy_rows):
    assert found(simhash_near_duplicates(messy)) == plain(messy_rows)


def test_near_copies_in_many_tiles(spark, monkeypatch):
    rng = random.Random(12)
    base = [prose(rng, 400) for _ in range(6)]
    rows = [(i, changed(rng, base[i % 6], rng.randrange(12)), "en", "a") for i in range(150)]
    rows += [(1000 + i, prose(rng, rng.randrange(5)), None, None) for i in range(80)]
    monkeypatch.setattr(simhash, "TILE_ROWS", (8, 8))
    monkeypatch.setattr(simhash, "BLOCK", 4)
    got = found(simhash_near_duplicates(frame(spark, rows)))
    assert got == plain(rows)
    assert max(Counter(c for _, _, c in got).values()) > 10


def test_whole_table(spark, data_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op12_simhash_dedup"](spark, data_dir)) == plain(rows)


def test_empty_table(none):
    assert simhash_near_duplicates(none).collect() == []


def planted(rng, n, copies):
    """Random fingerprints, and ones that differ from them in 1 to 7 bits, in chains."""
    prints = rng.integers(0, 2**64, n, dtype=np.uint64)
    out = [prints]
    for _ in range(copies):
        flips = np.zeros(n, np.uint64)
        for _ in range(int(rng.integers(1, 8))):
            flips |= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
        out.append(out[-1] ^ flips)
    return np.unique(np.concatenate(out))


def all_links(prints):
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4
    return [(int(i), int(j)) for i, j in zip(*np.nonzero(near)) if i < j]


@pytest.mark.parametrize("sizes", [(64, 512), (4096, 1 << 18)])
def test_all_fingerprints_within_the_radius_are_connected(spark, monkeypatch, sizes):
    prints = planted(np.random.default_rng(4), 600, 3)
    monkeypatch.setattr(simhash, "TILE_ROWS", sizes)
    signed = prints.view(np.int64).tolist()
    got = linked_prints(spark.createDataFrame([(p,) for p in signed], "_print long")).collect()
    assert got
    for a, b in got:  # links lead to a root that is reachable, so compare whole groups
        assert a != b
    want = groups_of(all_links(prints), range(len(prints)))
    place = {p: i for i, p in enumerate(signed)}
    assert groups_of([(place[a], place[b]) for a, b in got], range(len(prints))) == want


def test_forest_of_a_tile_pair(monkeypatch):
    monkeypatch.setattr(simhash, "FOUND", 50)
    prints = planted(np.random.default_rng(6), 300, 4)
    a, b = prints[::2], prints[1::2]
    place = {int(p): i for i, p in enumerate(prints)}
    links = []
    for x, y in ((a, None), (b, None), (a, b)):
        links += [(place[int(i)], place[int(j)]) for i, j in zip(*linked_pairs(x, y, 4))]
    assert groups_of(links, range(len(prints))) == groups_of(all_links(prints), range(len(prints)))


def test_skipped_tiles_hold_no_link():
    rng = np.random.default_rng(8)
    prints = planted(rng, 400, 3)
    points = part_counts(prints)
    leaves = split(points, np.ones(len(prints), np.int64), 16)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(len(prints)))
    low, high = (np.array([f(points[at], axis=0) for at in leaves]) for f in (np.min, np.max))
    box = {int(i): k for k, at in enumerate(leaves) for i in at}
    near = np.stack([gaps(low[k], high[k], low, high) for k in range(len(leaves))]) <= 4
    assert all(near[box[i], box[j]] for i, j in all_links(prints))
    assert not near.all()


def test_one_heavy_class_is_dealt_to_chunks():
    plan = plan_tiles(np.array([[8, 8, 8, 8], [9, 8, 8, 8], [3, 3, 3, 3]]), np.array([1000, 5, 5]), 100)
    assert sorted(plan.chunks.tolist())[-1] == 10
    assert len(plan.box_of) == 3
