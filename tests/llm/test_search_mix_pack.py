"""Exact top-k, source mixing, best-fit packing and the pipeline against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bindery.llm import mixing, packing
from bindery.llm.mixing import mix_sources, permuted, source_targets
from bindery.llm.queries import QUERIES, special_tokens, vocabulary
from bindery.llm.topk import top_k
from bindery.operators.ordered import running_totals

from .conftest import frame
from .test_dedup import words


# --- top-k -------------------------------------------------------------------------------------


def brute_top(rows, queries, k):
    sound = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v)
    out = []
    for q, v in queries:
        if q is None or not sound(v):
            continue
        scores = [
            (-sum(int(a) * int(b) for a, b in zip(v, w)), i)
            for i, w in rows
            if i is not None and i != q and sound(w) and len(w) == len(v)
        ]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("top", [2, 300, 10**5, 10**9])
def test_top_k(spark, top):
    rng = random.Random(top)
    rows = [(i, [float(rng.randint(-top, top)) for _ in range(5)]) for i in range(200)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(7, None), (8, [1.0, None, 0.0, 0.0, 1.0]), (9, [float("nan")] * 5), (10, [float("inf")] * 5), (None, [1.0] * 5)]
    rows += [(3, rows[3][1]), (2000, [1.0, 2.0]), (2001, [3.0, 1.0]), (2002, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, block string")
    out = top_k(df.filter("vec_id % 4 = 0"), df, k=5, shard_rows=32, query_rows=16).collect()
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in out)
    assert got == brute_top(rows, [(i, v) for i, v in rows if i is not None and i % 4 == 0], 5)


def test_top_k_of_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<double>")
    assert top_k(df.limit(0), df).count() == 0
    assert top_k(df, df.limit(0)).count() == 0
    assert top_k(df, df).count() == 0  # no row but its own


# --- mixing ------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(1, 2, 3), repeats=3):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > repeats * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: repeats * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, None: 70, "é": 0}, {"x": 3}, {"p": 1, "q": 2, "r": 300, "s": 40}])
def test_source_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(df).collect()}
    want = brute_targets(sizes)
    assert set(got) == set(want)
    assert all(got[s] == pytest.approx(want[s]) for s in want)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 97, 1000, 4099])
def test_permutation_is_one(spark, n):
    out = spark.range(n).select(permuted(F.col("id"), F.lit(n).cast("long"), F.lit(9)).alias("p")).collect()
    assert sorted(r["p"] for r in out) == list(range(n))


def test_mix(messy, messy_rows):
    mix = mix_sources(messy, block=8, shard=16)
    rows = mix.taken().collect()
    size = {i: len(words(t)) if len(t or "") < 20000 else len(t.split()) for i, t, *_ in messy_rows}
    by_source = defaultdict(int)
    for i, _, _, s in messy_rows:
        by_source[s] += size[i]
    target = brute_targets(by_source)
    taken = defaultdict(int)
    assert Counter((r["id"], r["size"], r["source_size"]) for r in rows) == Counter(
        (i, size[i], by_source[s]) for i, _, _, s in messy_rows
    )
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 12 for s in target)
    pieces = mix.pieces.collect()
    slots = {(p["slot"], p["shard"], p["source_no"], p["pass"], p["block"]) for p in pieces}
    assert sorted(s[0] for s in slots) == list(range(len(slots)))  # every slot is filled once
    assert all(s[1] == s[0] // 16 for s in slots)
    assert len({s[2:] for s in slots}) == len(slots)  # a pass takes a block once
    again = mix_sources(messy.repartition(3), block=8, shard=16).taken().collect()
    key = lambda r: (str(r["id"]), r["size"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, rows))


def test_shards_draw_multinomial_counts(spark):
    """Counts per shard are those of one draw per slot; only surplus draws of the last shards change source."""
    draws, shard, seed = {0: 700, 1: 3, 2: 0, 3: 297}, 64, 5
    rows = [(s, 10_000, d) for s, d in draws.items()]
    dealt = spark.createDataFrame(rows, "source_no long, _blocks long, _draws long")
    dealt = running_totals(dealt, [F.col("source_no")], ["_draws"])
    slots = mixing._slots(dealt, seed, shard).collect()
    assert sorted(r["slot"] for r in slots) == list(range(1000))
    assert all(r["shard"] == r["slot"] // shard for r in slots)
    assert Counter(r["source_no"] for r in slots) == Counter({s: d for s, d in draws.items() if d})
    place = F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(1000).cast("long"))
    places = spark.range(1000).select("id", place.alias("u")).collect()
    drawn = Counter((r["id"] // shard, 0 if r["u"] < 700 else 1 if r["u"] < 703 else 3) for r in places)
    sums = Counter()
    for (_, s), n in drawn.items():
        sums[s] += n
    surplus = sum(max(sums[s] - draws[s], 0) for s in draws)
    got = Counter((r["shard"], r["source_no"]) for r in slots)
    assert surplus > 0 and sum((drawn - got).values()) <= surplus
    assert len({n for (_, s), n in got.items() if s == 0}) > 4  # no fixed quota per shard
    kept = {s: 0 for s in draws}
    for (at, s), n in sorted(drawn.items()):  # a source keeps its draws shard by shard until it has all
        kept[s] += n
        assert got[at, s] >= n or kept[s] > draws[s]


def test_slots_come_from_many_tasks(spark):
    dealt = spark.createDataFrame([(0, 1000, 2500), (1, 1000, 700)], "source_no long, _blocks long, _draws long")
    slots = mixing._slots(running_totals(dealt, [F.col("source_no")], ["_draws"]), 0, 64)
    sizes = slots.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 3200 / 2
    assert slots.select("source_no", "pass", "block").distinct().count() == 3200


# --- packing -----------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["small", "mixed", "big", "one", "none"])
def test_histogram_packing(kind):
    rng = np.random.default_rng(1)
    n = {"one": 1, "none": 0}.get(kind, 3000)
    low, high = {"small": (1, 90), "mixed": (1, 129), "big": (40, 90)}.get(kind, (1, 129))
    histogram = np.bincount(rng.integers(low, high, n), minlength=129)
    bins = packing.pack_histogram(histogram, 128, steps=100)
    assert (sum((c * k for c, k in bins), np.zeros(129, int)) == histogram).all()
    assert all(c @ np.arange(129) <= 128 for c, _ in bins)
    plain = sum(k for _, k in packing.best_fit(histogram, 128))
    lower = -(-int(histogram @ np.arange(129)) // 128)
    assert lower <= sum(k for _, k in bins) <= plain * 1.002 + 1


def test_knapsack_is_optimal():
    rng = random.Random(3)
    for _ in range(20):
        prices = np.zeros(31)
        for length in rng.sample(range(1, 31), 6):
            prices[length] = rng.randint(1, 20)
        best = [0.0] * 31
        for room in range(1, 31):
            best[room] = max([best[room - 1]] + [best[room - n] + prices[n] for n in range(1, room + 1) if prices[n]])
        config = packing.best_configuration(prices, 30)
        assert config @ np.arange(31) <= 30 and config @ prices == best[30]


def encoded(text):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def check_packing(out, texts):
    ids = {i: encoded(t) for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in out:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    assert set(pieces) == set(ids)
    for i, rows in pieces.items():
        rows.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        assert [r["start"] for r in rows] == np.cumsum([0] + [r["length"] for r in rows])[:-1].tolist()
        assert sum(r["length"] for r in rows) == len(ids[i]) and all(r["length"] == 1024 for r in rows[1:])
        for r in rows:
            assert r["ids_crc32"] == zlib.crc32(ids[i][r["start"] : r["start"] + r["length"]].tobytes())
    for rows in sequences.values():
        rows.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rows] == np.cumsum([0] + [r["length"] for r in rows])[:-1].tolist()
        assert sum(r["length"] for r in rows) <= 1024


def test_packing(spark, messy_rows, none):
    marked = ["<|endoftext|> x", "a <|endoftext|> b", "in<|endoftext|>side", "x\n<|endoftext|>", "<|endoftext|>" * 3, "<|endoftext|", "é<|endoftext|>1 2"]
    rows = [(k, t, None, None) for k, (_, t, *_) in enumerate(messy_rows)]
    rows += [(900 + k, t, None, None) for k, t in enumerate(marked)]
    assert 50256 in encoded(marked[2]) and 50256 not in encoded(marked[5])
    out = packing.best_fit_pack(frame(spark, rows), **vocabulary(), specials=special_tokens()).collect()
    check_packing(out, {i: t for i, t, *_ in rows})
    total = sum(r["length"] for r in out)
    assert len({r["sequence_id"] for r in out}) <= -(-total // 1024) + 2
    repeated = packing.best_fit_pack(frame(spark, [rows[3], rows[3]]), **vocabulary()).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in repeated}) == 2
    assert packing.best_fit_pack(none, **vocabulary()).count() == 0


# --- the pipeline and the registered queries ------------------------------------------------------


def test_pipeline_stages(spark, data_dir, messy, none):
    columns = messy.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (messy, none):
            out = stage(spark, docs, data_dir)
            assert out.columns == columns and out.dtypes == docs.dtypes, name
            assert out.count() <= 3 * docs.count()
    exact = corpus_pipeline.exact_deduplication(spark, messy, data_dir)
    texts = ["".join((r["text"] or "").split()) for r in exact.collect()]
    assert len(set(texts)) == len(texts)
    near = corpus_pipeline.near_deduplication(spark, messy, data_dir)
    assert near.filter("doc_id = 8 or doc_id = 9 or doc_id = 10").count() == 1


def test_mixing_stage_takes_what_the_mix_takes(spark, data_dir, messy, messy_rows):
    out = corpus_pipeline.source_mixing(spark, messy, data_dir).collect()
    taken = {r["_row"]: r for r in mix_sources(messy).taken().collect()}
    assert sum(len((r["text"] or "").split()) for r in out) == sum(r["taken"] for r in taken.values())
    whole = {t for _, t, *_ in messy_rows}
    plain = [set((t or "").split()) for t in whole]
    assert all(r["text"] in whole or any(set(r["text"].split()) <= p for p in plain) for r in out)


def test_run(spark, data_dir):
    out = corpus_pipeline.run(spark, data_dir).collect()
    assert out and all(1 <= r["length"] <= 1024 for r in out)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_keep_their_contract(spark, data_dir, name):
    want = {
        "op1": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
        "op3": "query_id bigint, rank int, vec_id bigint, score bigint",
        "op4": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
        "op6": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
        "op7": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
        "op8": "doc_id bigint, held_out boolean, lang_pred string, score double",
        "op9": "doc_id bigint, held_out boolean, score double, predicted int",
        "op10": "doc_id bigint, keep_id bigint, group_size bigint, kept boolean, text_sha256 string",
    }
    out = QUERIES[name](spark, data_dir)
    if prefix := want.get(name.split("_")[0]):
        assert ", ".join(f"{c} {t}" for c, t in out.dtypes) == prefix
    assert out.count() > 0
