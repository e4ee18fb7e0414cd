"""Language, quality and licence models: held-out accuracy and defined results on odd input."""

import random
import textwrap

import numpy as np
from pyspark.sql import functions as F

from bindery.llm import language, licences, quality

from .conftest import frame, prose

SYLLABLES = {"aa": "ka lo mi ru te no".split(), "bb": "sch ein ung ber ost ich".split(), "cc": "eau oui tion ment ais que".split()}


def invented(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def test_language_of_held_out_documents(spark):
    rng = random.Random(1)
    rows = [(i, invented(rng, lang, rng.randint(3, 60)).title() + "!", lang, None) for i, lang in enumerate(rng.choices("aa bb cc".split(), k=300))]
    docs = frame(spark, rows)
    model = language.fit(docs.filter("doc_id % 4 <> 2"), seed=F.xxhash64("doc_id"))
    out = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    right = [out[i]["lang_pred"] == lang for i, _, lang, _ in rows if i % 4 == 2]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 for r in out.values())


def test_language_of_odd_texts(spark, messy, messy_rows, none):
    model = language.fit(messy)
    out = language.identify(messy, model).collect()
    assert len(out) == len(messy_rows)
    learned = {r[2] for r in messy_rows} - {None}
    for r in out:
        text = next(t for i, t, *_ in messy_rows if i == r["doc_id"])
        letters = any(c.isalpha() for c in text or "")
        assert (r["lang_pred"] in learned) if letters else (r["lang_pred"], r["score"]) == ("und", 0.0)
    assert language.fit(none) is None
    assert language.identify(none, model).count() == 0
    assert {r["lang_pred"] for r in language.identify(messy, None).collect()} == {"und"}


def test_word_scores_fall_back_to_shorter_grams():
    import pyarrow as pa

    keys = lambda w, n: np.unique(language.character_grams([w], n)[0])
    grams = [keys("ab", 1), keys("ab", 2), *([np.zeros(0, np.uint64)] * 3)]
    scores = [np.full((len(g), 2), -n - 1.0, np.float32) for n, g in enumerate(grams)]
    model = language.Model(["x", "y"], np.zeros(2), pa.array(["known"]), np.array([[-9.0, -8.0]], np.float32), grams, scores)
    got = language.word_scores(model, pa.array(["known", "abz", "bza", "qqq"]))
    # a bigram of "ab" first, else its letters and ends; every word has ends, so "qqq" has only those
    assert got.tolist() == [[-9, -8], [-2, -2], [-1, -1], [-1, -1]]


def junk(rng, n):
    kind = rng.randrange(3)
    words = prose(rng, n).split()
    if kind == 0:
        return " ".join(w + rng.choice(["###", "***"]) for w in words)
    return " ".join(w.upper() + "!!" for w in words) if kind == 1 else " ".join([words[0]] * n)


def test_quality_of_held_out_documents(spark):
    rng = random.Random(2)
    rows, marks = [], []
    for i in range(500):
        good = rng.random() < 0.8
        rows.append((i, prose(rng, rng.randint(20, 80)) if good else junk(rng, rng.randint(20, 80)), None, None))
        marks.append((i, int(good)))
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    out = quality.quality_scores(frame(spark, rows), labels, learn_from=F.col("doc_id") % 5 != 0).collect()
    right = [(r["score"] >= 0.5) == bool(marks[r["doc_id"]][1]) for r in out if r["doc_id"] % 5 == 0]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in out)


def test_quality_of_odd_texts_and_labels(spark, messy, messy_rows, none):
    marks = [(4, 1), (4, 1), (5, 0), (8, None), (9, 1), (None, 1), (999999, 0), (11, 5), (16, 0), (102, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    out = quality.quality_scores(messy, labels).collect()
    assert len(out) == len(messy_rows) and all(0 <= r["score"] <= 1 for r in out)
    same = {r["score"] for r in out if r["doc_id"] == 9}
    assert len(same) == 1
    assert quality.quality_scores(none, labels).count() == 0
    assert {r["score"] for r in quality.quality_scores(messy, labels.limit(0)).collect()} == {1.0}
    assert {r["score"] for r in quality.quality_scores(messy, labels.filter("quality = 0")).collect()} == {0.0}


def test_context_vectors_by_hand(spark):
    docs = frame(spark, [(1, "red green blue", None, None), (2, None, None, None)])
    vectors = quality.word_vectors(docs)
    from bindery.llm.words import split_tokens

    at = (split_tokens([b"red green blue"]).hashes % np.uint64(quality.BUCKETS)).astype(int)
    places, signs = quality.index_vectors()
    want = np.zeros((3, quality.DIM))
    for i in range(3):
        for j in range(3):
            if i != j:
                np.add.at(want[i], places[at[j]], signs[at[j]])
    want /= np.linalg.norm(want, axis=1, keepdims=True)
    assert np.allclose(vectors[at], want, atol=1e-6)


def test_gradient_network_is_calibrated():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    p = quality.probabilities(quality.train(x, y), x)
    for low in (0.1, 0.4, 0.7):
        some = (p >= low) & (p < low + 0.2)
        assert abs(y[some].mean() - p[some].mean()) < 0.08


def test_licence_scan(spark, none):
    rng = random.Random(6)
    named = {
        "mit": "Released under the MIT License.",
        "apache": 'Licensed under the Apache License, Version 2.0 (the "License");',
        "gpl": "This work is licensed under the GNU General Public License, version 3.",
        "cc-by-nc": "# Licensed under CC BY-NC 4.0.",
        "cc-by-sa": "Text is available under the Creative Commons Attribution-ShareAlike License",
    }
    rows = [(i, "\n".join([prose(rng, 30), line, prose(rng, 5)]), None, None) for i, line in enumerate(named.values())]
    rows += [(50 + i, prose(rng, 60) + "\nThe license of the driver was old and the version was free", None, None) for i in range(20)]
    rows += [(90, None, None, None), (91, "", None, None), (92, "\n\n", None, None), (0, rows[0][1], None, None)]
    out = licences.licence_scan(frame(spark, rows)).collect()
    confirmed = sorted((r["doc_id"], r["paragraph"], r["family"]) for r in out if r["confirmed"])
    want = sorted([(i, 1, family) for i, family in enumerate(named)] + [(0, 1, "mit")])
    assert confirmed == want
    assert all(0 <= r["probability"] <= 1 and r["family"] in licences.TEMPLATES for r in out)
    assert licences.licence_scan(none).count() == 0


def test_licence_wrapped_over_lines(spark):
    rng = random.Random(7)
    grants = {
        "mit": licences.TEMPLATES["mit"][2], "gpl": licences.TEMPLATES["gpl"][2],
        "bsd": licences.TEMPLATES["bsd"][2], "isc": licences.TEMPLATES["isc"][1],
    }
    rows, want = [], []
    for k, (width, mark) in enumerate([(76, ""), (60, "# "), (40, " * "), (30, "REM ")]):
        for i, (family, grant) in enumerate(grants.items()):
            body = textwrap.wrap(grant, width)
            text = [prose(rng, 12), "", *[mark + x for x in body], prose(rng, 12)]
            rows.append((10 * k + i, "\n".join(text), None, None))
            want.append((10 * k + i, 2, len(body), family))
    rows += [(90 + i, f"{prose(rng, 12)}\n{prose(rng, 9)}", None, None) for i in range(20)]
    out = [r for r in licences.licence_scan(frame(spark, rows)).collect() if r["confirmed"]]
    assert sorted((r["doc_id"], r["paragraph"], r["lines"], r["family"]) for r in out) == want
