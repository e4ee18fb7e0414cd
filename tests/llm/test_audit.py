"""Filter interaction audit against brute force; retraction, resumed runs."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest

from bindery.llm.audit import FOLDED, changes, count_masks, filter_audit, judged, order_report

from .conftest import SCHEMA, frame

COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(text, key, firsts):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = set()
    if len(words) < 50:
        out.add("A")
    if 100 * len(set(words)) < 65 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text):
        out.add("C")
    if re.search("[#$%&*|]", text):
        out.add("D")
    if key is not None and key > firsts.get(text, key):
        out.add("E")
    return out


def plain(rows, labels):
    firsts = {}
    for key, text, *_ in rows:
        if key is not None:
            firsts[text or ""] = min(firsts.get(text or "", key), key)
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    docs = [(s or "", fails(t or "", i, firsts), i in good, i in toxic) for i, t, _, s in rows]
    orders = ["".join(p) for p in permutations("ABCDE")]
    out = {}
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        total = Counter()
        for order in orders:
            left = own
            for step, f in enumerate(order, 1):
                removed = [d for d in left if f in d[1]]
                gone = [d for d in own if d[1] & set(order[: step - 1])]
                left = [d for d in left if f not in d[1]]
                total[f] += len(removed)
                out[part, order, step] = [
                    len(left), len(removed), sum(f in d[1] for d in gone), sum(d[1] == {f} for d in own),
                    sum(d[2] for d in removed), sum(d[3] for d in removed),
                ]
        for order in orders:
            for step, f in enumerate(order, 1):
                out[part, order, step].append(total[f])
    return out


def found(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COUNTS] for r in rows}
    assert len(out) == len(rows)
    return out


def labels_of(spark, labels):
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def documents(rng, n):
    """Texts of all kinds of failures, many of them copies, under ids in no order."""
    texts = [
        " ".join(f"{rng.choice(['w', 'W', 'w', 'é'])}{rng.randrange(v)}" for _ in range(m)) + rng.choice(["", "", " #", "|"])
        for v, m in ((1000, 80), (20, 60), (1000, 10), (5, 50), (1000, 49), (1000, 50)) for _ in range(4)
    ] + [None, "", " ", "A", "ABC def $"]
    ids = [*range(n - 6), None, None, 5, 5, 9, 9]
    rng.shuffle(ids)
    rows = [(i, rng.choice(texts), None, rng.choice(["a", "b", "b", None, ""])) for i in ids]
    labels = [(rng.randrange(n), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(n)] + [(None, 1, 1)]
    return rows, labels


def test_smaller_ids_retract_earlier_ones(spark, tmp_path):
    rows, labels = documents(random.Random(13), 200)
    for start in range(0, len(rows), 25):  # one file each, so that the smallest id of a text comes late
        frame(spark, rows[start : start + 25]).coalesce(1).write.mode("append").parquet(str(tmp_path / "docs"))
    df = filter_audit(spark, str(tmp_path / "docs"), labels_of(spark, labels), files_per_batch=1)
    assert dict(df.dtypes) == {"part": "string", "filter_order": "string", "step": "int"} | {c: "bigint" for c in COUNTS}
    assert found(df) == plain(rows, labels)


def test_later_files_and_a_run_that_failed(spark, tmp_path, monkeypatch):
    rows, labels = documents(random.Random(17), 120)
    docs, folder = str(tmp_path / "docs"), str(tmp_path / "audit")
    flags = labels_of(spark, labels)
    frame(spark, rows[:40]).repartition(3).write.parquet(docs)
    first = count_masks(spark, docs, flags, folder, files_per_batch=1)
    assert found(order_report(first)) == plain(rows[:40], labels)
    frame(spark, rows[40:80]).repartition(3).write.mode("append").parquet(docs)

    # The changes of a batch are written but the run ends before the batch is committed.
    log = sorted((tmp_path / "audit/checkpoint/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    log[-1].unlink()
    (log[-1].parent / f".{log[-1].name}.crc").unlink(missing_ok=True)
    second = count_masks(spark, docs, flags, folder, files_per_batch=1)
    assert found(order_report(second)) == plain(rows[:80], labels)
    frame(spark, rows[80:]).repartition(2).write.mode("append").parquet(docs)
    assert found(order_report(count_masks(spark, docs, flags, folder))) == plain(rows, labels)


def test_messy_table(spark, messy, messy_rows, tmp_path):
    messy.repartition(5).write.parquet(str(tmp_path / "docs"))
    labels = [(i, i % 2, i % 3) for i in range(1, 400)]
    got = found(filter_audit(spark, str(tmp_path / "docs"), labels_of(spark, labels), files_per_batch=2))
    assert got == plain(messy_rows, labels)


@pytest.mark.parametrize("files", [0, 1])
def test_empty_table(spark, none, tmp_path, files):
    docs = str(tmp_path / "docs")
    none.coalesce(1).write.parquet(docs)
    if not files:
        docs = f"{docs}/part-*.parquet"
    assert filter_audit(spark, docs, labels_of(spark, [])).collect() == []
    assert SCHEMA  # the table has columns of clashing names


def test_changes_of_a_text(spark):
    """A smaller id retracts, an equal one adds up, a larger one is a repeat; other texts' state is left alone."""

    def rows(*values):
        return spark.createDataFrame([(bytes([k]), *v) for k, *v in values], FOLDED)

    held = rows((1, 7, "a", 3, True, False, 2), (1, 9, "a", 3, False, False, 1), (2, 1, "z", 0, False, False, 1))
    for new, want in (
        ((1, 8, "b", 3, False, True, 1), [("b", 19, False, True, 1)]),
        ((1, 7, "b", 3, False, True, 1), [("b", 3, False, True, 1)]),
        (
            (1, 2, "b", 3, False, True, 1),
            [("b", 3, False, True, 1), ("a", 3, True, False, -2), ("a", 19, True, False, 2)],
        ),
        ((3, 2, "b", 3, False, True, 5), [("b", 3, False, True, 5)]),
    ):
        got = [tuple(r) for r in changes(judged(rows(new), held)).collect()]
        assert sorted(got) == sorted(want)
