"""Licence scans: a trained paragraph classifier, an unknown class, and comparison with templates."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.llm.stages import at_most, slices
from bindery.llm.words import document_of, grams, split_tokens

# The wording by which each licence family is usually named or granted.
TEMPLATES = {
    "agpl": ["This program is licensed under the GNU Affero General Public License, version 3.",
             "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "bsd": ["Released under the BSD License.", "Use of this source code is governed by a BSD-style license.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "cc-by": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "Text is available under the Creative Commons Attribution-ShareAlike License"],
    "cc0": ["Released into the public domain under CC0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is licensed under the GNU General Public License, version 2.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"],
    "isc": ["Released under the ISC License.",
            "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "lgpl": ["Licensed under the GNU Lesser General Public License, version 3.",
             "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "mpl": ["Licensed under the Mozilla Public License, version 2.0.",
            "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "proprietary": ["All rights reserved.", "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential."],
}
UNKNOWN = "unknown"
ORDER = 3  # word n-grams up to this length
FEATURES = 1 << 20  # hash space of n-grams
PARAGRAPHS = 5000  # paragraphs of the corpus in the training set
LONGEST = 10000
NAMED = r"(?i)licen|copyright|public domain|rights reserved|permission"
COPIES = 60  # altered copies of every template
EPOCHS = 200
CONFIRM = 0.7  # share of a template's bigrams that a paragraph must hold
SLICE = 1 << 20  # bytes
COMMENT = re.compile(rb"(?i)^\s*(?:rem|dnl)\s")  # comment marks that are words; signs do not count anyway


class Model(NamedTuple):
    families: list[str]  # the first is the unknown class
    slot: np.ndarray  # weight row of each hashed n-gram, 0 for those without weight
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: list[tuple[int, np.ndarray]]  # family, sorted bigram hashes
    longest: int  # words of the longest template


def paragraph_grams(paragraphs: list[bytes], order: int = ORDER) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all word n-grams up to ``order`` and the paragraph of each. Words are runs of letters
    and digits; case and other signs do not count."""
    tokens = split_tokens([p.lower() for p in paragraphs])
    first_byte = np.frombuffer(tokens.data, np.uint8)[tokens.begin] if len(tokens.begin) else np.zeros(0, np.uint8)
    word = (first_byte >= 128) | (first_byte >= 97) & (first_byte <= 122) | (first_byte >= 48) & (first_byte <= 57)
    hashes, doc = tokens.hashes[word], document_of(tokens.first)[word]
    out, owner = [hashes], [doc]
    for n in range(2, order + 1):
        runs = grams(hashes, n, n)
        inside = doc[: len(runs)] == doc[n - 1 :] if len(runs) else np.zeros(0, bool)
        out.append(runs[inside])
        owner.append(doc[: len(runs)][inside])
    return np.concatenate(out), np.concatenate(owner)


def _bigrams(paragraph: bytes) -> np.ndarray:
    values, _ = paragraph_grams([paragraph], 2)
    singles, _ = paragraph_grams([paragraph], 1)
    pairs = values[len(singles) :]
    return np.unique(pairs if len(pairs) else singles)


def altered(template: str, rng: np.random.Generator) -> str:
    """A template as it is met: cut, with words lost or around it."""
    words = template.split()
    if len(words) > 8 and rng.random() < 0.4:
        words = words[: int(rng.integers(8, len(words) + 1))]
    words = [w for w in words if rng.random() > 0.05] or words
    before = ["Copyright (c) 2019 the authors.", "//", "#", "*", "NOTICE:", "the project is", ""]
    return f"{before[rng.integers(len(before))]} {' '.join(words)}"


def train(negatives: list[str], templates: dict[str, list[str]] = TEMPLATES, epochs: int = EPOCHS, seed: int = 3) -> Model:
    """Multinomial logistic regression on sparse n-grams, with a temperature set on held-out rows.

    Only n-grams that some template holds have weights. The unknown class learns from ``negatives``
    and from shuffled words of the templates, so single words do not make a licence.
    """
    rng = np.random.default_rng(seed)
    families = [UNKNOWN, *sorted(templates)]
    texts, y = list(negatives), [0] * len(negatives)
    for i, family in enumerate(families[1:], 1):
        for template in templates[family]:
            texts += [template] + [altered(template, rng) for _ in range(COPIES)]
            y += [i] * (COPIES + 1)
            for _ in range(COPIES // 4):
                words = template.split()
                some = rng.permutation(words)[: int(rng.integers(1, len(words) + 1))]
                texts.append(" ".join(some))
                y.append(0)
    y = np.array(y)
    known, _ = paragraph_grams([t.encode() for family in families[1:] for t in templates[family]])
    slot = np.zeros(FEATURES, np.int32)
    places = np.unique(known % np.uint64(FEATURES)).astype(np.int64)
    slot[places] = np.arange(1, len(places) + 1)
    values, owner = paragraph_grams([t.encode() for t in texts])
    x = np.zeros((len(texts), len(places) + 1), np.float32)
    x[owner, slot[(values % np.uint64(FEATURES)).astype(np.int64)]] = 1
    x[:, 0] = 0
    held = rng.random(len(y)) < 0.2
    rows, target = x[~held], np.eye(len(families))[y[~held]]
    share = 1 / np.bincount(y[~held], minlength=len(families)).clip(1)[y[~held]]
    share = (share / share.sum())[:, None]
    w, b = np.zeros((x.shape[1], len(families))), np.zeros(len(families))
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(epochs):
        z = rows @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        d = (p / p.sum(axis=1, keepdims=True) - target) * share
        speed_w = 0.9 * speed_w - 2.0 * (rows.T @ d + 1e-5 * w)
        speed_b = 0.9 * speed_b - 2.0 * d.sum(axis=0)
        w, b = w + speed_w, b + speed_b
    z = x[held] @ w + b

    def loss(t: float) -> float:
        s = z / t - (z / t).max(axis=1, keepdims=True)
        return float((np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), y[held]]).sum())

    heat = min((float(t) for t in np.geomspace(0.25, 8, 21)), key=loss)
    compared = [(i, _bigrams(t.encode())) for i, f in enumerate(families[1:], 1) for t in templates[f]]
    longest = max((len(paragraph_grams([t.encode()], 1)[0]) for f in families[1:] for t in templates[f]), default=0)
    return Model(families, slot, w.astype(np.float32), b, heat, compared, longest)


def classify(model: Model, paragraphs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Family and probability of each paragraph."""
    values, owner = paragraph_grams(paragraphs)
    slot = model.slot[(values % np.uint64(FEATURES)).astype(np.int64)]
    owner, slot = owner[slot > 0], slot[slot > 0].astype(np.int64)
    pairs = np.unique(owner * len(model.weights) + slot)  # an n-gram counts once per paragraph
    owner, slot = pairs // len(model.weights), pairs % len(model.weights)
    z = np.tile(model.bias, (len(paragraphs), 1))
    if len(owner):
        head = np.flatnonzero(np.diff(owner, prepend=-1))
        z[owner[head]] += np.add.reduceat(model.weights[slot], head)
    z = z / model.temperature
    p = np.exp(z - z.max(axis=1, keepdims=True))
    family = z.argmax(axis=1)
    return family, p[np.arange(len(p)), family] / p.sum(axis=1)


def template_share(model: Model, paragraph: bytes, family: int) -> float:
    """The largest share of a template of the family whose bigrams the paragraph holds."""
    held = _bigrams(paragraph)
    return max(float(np.isin(t, held).mean()) for i, t in model.templates if i == family)


def runs(model: Model, lines: list[bytes], doc: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last line of every run of lines in which a wrapped template can lie: lines of one text
    with words in each, as many as a template that starts in the first can reach, however it is wrapped.
    Runs whose first or last line holds no word of a template are left out, as a shorter one says the same."""
    hashes, owner = paragraph_grams(lines, 1)
    words = np.bincount(owner, minlength=len(lines)).tolist()
    some = np.zeros(len(lines), bool)
    some[owner[model.slot[(hashes % np.uint64(FEATURES)).astype(np.int64)] > 0]] = True
    some, doc = some.tolist(), doc.tolist()
    for i in np.flatnonzero(some).tolist():
        j, reached = i + 1, 0
        while j < len(lines) and doc[j] == doc[i] and words[j] and reached < model.longest:
            if some[j]:
                yield i, j
            reached += words[j]
            j += 1


def wrapped(
    model: Model, lines: list[bytes], doc: np.ndarray, confirm: float, single: list[tuple[int, int, int, float, float]]
) -> list[tuple[int, int, int, float, float]]:
    """First and last line, family, probability and share: of the rows ``single`` (lines by themselves) and
    of each confirmed grant that goes over several lines. Of overlapping runs of one family the best stays,
    the shortest of equals, and none overlaps a line that is confirmed alone for its family. Lines and
    runs inside one that holds more of its template are fragments of that and left out."""
    found = []

    def look(some: list[tuple[int, int]], texts: list[bytes]) -> None:
        family, probability = classify(model, texts)
        for k in np.flatnonzero(family).tolist():
            share = template_share(model, texts[k], int(family[k]))
            if share >= confirm:
                found.append((*some[k], int(family[k]), float(probability[k]), share))

    stripped = [COMMENT.sub(b"", x) for x in lines]
    some, texts, held = [], [], 0
    for i, j in runs(model, stripped, doc):
        some.append((i, j))
        texts.append(b" ".join(stripped[i : j + 1]))
        held += len(texts[-1])
        if held >= SLICE:
            look(some, texts)
            some, texts, held = [], [], 0
    if some:
        look(some, texts)
    taken = {(r[0], r[2]) for r in single if r[4] >= confirm}
    out, best = [], {}  # the runs that stay, and those at each line
    for run in sorted(found, key=lambda r: (-r[4], r[1] - r[0], r[0])):
        places = {(line, run[2]) for line in range(run[0], run[1] + 1)}
        if not places & taken:
            taken |= places
            if not _inside(run, best):
                out.append(run)
                for line in range(run[0], run[1] + 1):
                    best.setdefault(line, []).append(run)
    return [r for r in single if not _inside(r, best)] + out


def _inside(run: tuple, best: dict[int, list[tuple]]) -> bool:
    """Whether a run that holds more of its template holds this one."""
    return any(r[0] <= run[0] and run[1] <= r[1] and run[4] < r[4] for r in best.get(run[0], []))


def _scanner(shared, confirm: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        for batch in slices(batches, "_text", SLICE):
            texts = [(t or "").encode("utf-8", "surrogatepass").split(b"\n") for t in batch.column("_text").to_pylist()]
            doc = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
            number = np.concatenate([np.arange(len(t)) for t in texts])
            lines = [p for t in texts for p in t]
            family, probability = classify(model, lines)
            rows = []
            for i in np.flatnonzero(family).tolist():
                rows.append((i, i, int(family[i]), float(probability[i]), template_share(model, lines[i], int(family[i]))))
            rows = wrapped(model, lines, doc, confirm, rows)
            at = np.array([r[0] for r in rows], np.int64)
            yield pa.record_batch(
                {
                    "_id": batch.column("_id").take(pa.array(doc[at])),
                    "paragraph": pa.array(number[at].astype(np.int32)),
                    "lines": pa.array([r[1] - r[0] + 1 for r in rows], pa.int32()),
                    "family": pa.array([model.families[r[2]] for r in rows], pa.string()),
                    "probability": pa.array([r[3] for r in rows], pa.float64()),
                    "template_share": pa.array([r[4] for r in rows], pa.float64()),
                    "text": pa.array([b"\n".join(lines[r[0] : r[1] + 1]).decode("utf-8", "replace") for r in rows], pa.string()),
                }
            )

    return scan


def sample_paragraphs(docs: DataFrame, id_col: str, text_col: str, most: int = PARAGRAPHS) -> list[str]:
    """Paragraphs of the corpus that name no licence: about ``most``, chosen by hash, none of more
    than ``LONGEST`` characters, so that the training set has a bounded size."""
    lines = docs.select(F.col(id_col).alias("d"), F.posexplode(F.split(F.col(text_col), "\n")).alias("i", "p"))
    plain = (F.length(F.trim("p")) > 0) & (F.length("p") <= LONGEST) & ~F.col("p").rlike(NAMED)
    return [r["p"] for r in at_most(lines.filter(plain), most, "d", "i", "p").select("p").collect()]


def licence_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    templates: dict[str, list[str]] = TEMPLATES,
    paragraphs: int = PARAGRAPHS,
    confirm: float = CONFIRM,
) -> DataFrame:
    """Every line of every whole text that the classifier gives to a licence family, and every confirmed
    grant that is wrapped over several lines.

    The classifier learns from ``templates``, altered copies of them, and about ``paragraphs``
    paragraphs of the corpus that name no licence, which with scrambled templates make the unknown
    class. A prediction is confirmed if the paragraph holds at least ``confirm`` of the word pairs of
    one of the family's templates. Runs of neighbouring lines without a blank one between them are judged
    by their joined words, and reported in place of their lines if confirmed as a whole where no line of
    them is for that family. Null and blank texts have no paragraphs to report; repeated rows
    are reported as often as they occur; an empty table gives an empty result. Columns: ``id_col``,
    paragraph (first line, from 0), lines (how many), family, probability, template_share, confirmed, text.
    """
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast(train(sample_paragraphs(docs, id_col, text_col, paragraphs), templates))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = dict(rows.dtypes)["_id"]
    schema = f"_id {kind}, paragraph int, lines int, family string, probability double, template_share double, text string"
    found = rows.mapInArrow(_scanner(model, confirm), schema)
    return found.select(
        F.col("_id").alias(id_col), "paragraph", "lines", "family", "probability", "template_share",
        (F.col("template_share") >= confirm).alias("confirmed"), "text",
    )
