"""Cross-tokenizer alignment against a plain walk over both tokenizations."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from bindery.llm.alignment import align_tokenizers, alignment_report, piece_bytes, shared_cuts
from bindery.llm.queries import QUERIES, vocabulary

from .conftest import frame

PIECES = public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True  # the contract: their strings inside texts are plain text
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def printable():
    """Byte of every character of a byte-level vocabulary: the printable ones stand for themselves."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def plain(rows, tokenizers):
    """The contract, one token after another."""
    a, b = tokenizers
    byte, b_bytes, walked, counts = printable(), piece_bytes(b), [], Counter()
    for key, text, *_ in rows:
        whole = (" " + (text or "")).encode()
        a_ids, b_ids = a.encode(" " + (text or ""), add_special_tokens=False).ids, b.encode(text or "")
        a_parts = [bytes(byte[c] for c in a.id_to_token(i)) for i in a_ids]
        b_parts = [b_bytes[i] for i in b_ids]
        if not text or b"".join(a_parts) != whole or b"".join(b_parts) != whole:
            walked.append((key, 0, 0, [], []))
            continue
        groups, links, own, i, j = [], [], ([], []), 0, 0
        at_a = at_b = 0
        while i < len(a_ids) or j < len(b_ids):
            if at_a <= at_b and i < len(a_ids):
                own[0].append(a_ids[i])
                at_a, i = at_a + len(a_parts[i]), i + 1
            else:
                own[1].append(b_ids[j])
                at_b, j = at_b + len(b_parts[j]), j + 1
            if at_a == at_b:
                groups.append(own)
                links.append((own[0][-1], own[1][-1]))
                own = ([], [])
        counts.update(links)
        walked.append((key, len(a_ids), len(b_ids), groups, links))
    highest = Counter()
    for (_, y), n in counts.items():
        highest[y] = max(highest[y], n)
    out = Counter()
    for key, n_a, n_b, groups, links in walked:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(counts[p] == highest[p[1]] for p in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out[(key, n_a, n_b, len(groups), len(links), best, sum(counts[p] for p in links), digest)] += 1
    return out


def report(spark, rows):
    return alignment_report(frame(spark, rows), pieces=PIECES, **vocabulary())


def found(df):
    return Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


ODD = [
    "<|endoftext|>", "a<|endoftext|><|endoftext|>b", "<s> </s> <unk> <0x41>", "a ▁ b", "▁", " ", "  \n\t ", "a\0b",
    "ﬁ é é 中文字 ναι \U0001f600\U0001f468‍\U0001f469", "don't we'll", "1234567890 0x1F", "﻿x", "  y",
    "internationalisation " * 5, "x" * 3000, "\n" * 70, "    indented\n        more", "Ünïcödé\r\nline",
]


def test_odd_texts(spark, tokenizers):
    rows = [(i, t, "en", "a") for i, t in enumerate(ODD * 2)]
    assert found(report(spark, rows)) == plain(rows, tokenizers)


def test_messy_table(spark, messy_rows, tokenizers):
    df = report(spark, messy_rows)
    assert df.columns == COLUMNS
    assert found(df) == plain(messy_rows, tokenizers)


def test_random_texts(spark, tokenizers):
    rng = random.Random(11)
    signs = "abcdeABC  \n\t.,-_<>|#é中\U0001f600▁" + "́"
    rows = [(i, "".join(rng.choice(signs) for _ in range(rng.randrange(60))), None, None) for i in range(300)]
    assert found(report(spark, rows)) == plain(rows, tokenizers)


def test_whole_table(spark, data_dir, tokenizers):
    rows = [tuple(r) for r in spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()]
    assert found(QUERIES["op11_tokenizer_alignment"](spark, data_dir)) == plain(rows, tokenizers)


def test_empty_table(spark, none):
    found_ = align_tokenizers(none, pieces=PIECES, **vocabulary())
    assert found_.rows.count() == found_.pairs.count() == found_.links_of_rows().count() == 0


def test_pairs_beyond_the_broadcast(spark, messy_rows, monkeypatch):
    want = found(report(spark, messy_rows))
    monkeypatch.setattr("bindery.llm.alignment.BROADCAST_PAIRS", 0)
    assert found(report(spark, messy_rows)) == want


def test_shared_cuts_are_the_common_ends():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 500, 20000):
        for share in (0.001, 0.3, 1.0):
            texts = rng.integers(1, n + 1, 4)
            ends, firsts = [], []
            for _ in range(2):
                picked = [np.flatnonzero(np.append(rng.random(t - 1) < share, True)) + 1 for t in texts]
                base = np.concatenate([[0], np.cumsum(texts)[:-1]])
                ends.append(np.concatenate([p + b for p, b in zip(picked, base)]))
                firsts.append(np.concatenate([[0], np.cumsum([len(p) for p in picked])]))
            a, b = shared_cuts(*ends, *firsts)
            assert (ends[0][a] == ends[1][b]).all()
            assert ends[0][a].tolist() == np.intersect1d(*ends).tolist()
