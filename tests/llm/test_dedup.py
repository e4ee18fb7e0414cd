"""Exact, near, line and substring dedup against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bindery.llm import linededup, neardup
from bindery.llm.components import components
from bindery.llm.exact import exact_dedup
from bindery.llm.linededup import fuzzy_line_dedup
from bindery.llm.neardup import near_duplicates
from bindery.llm.substring import substring_dedup

from .conftest import changed, frame, prose

SPACES = " \t\n\x0b\f\r"


def groups_of(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


def stripped(text):
    return "".join(c for c in text or "" if c not in SPACES)


def id_key(i):
    return (i is None, i or 0)


def check_exact(out, rows):
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[stripped(t)].append((-len(t or ""), *id_key(i), i))
    want = Counter()
    for text, members in groups.items():
        best = min(members)
        sha = hashlib.sha256(text.encode()).hexdigest()
        left = {best: 1}
        for m in sorted(members):
            kept = left.pop(m, 0) == 1
            want[(m[3], best[3], len(members), kept, sha)] += 1
    got = Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in out.collect())
    assert got == want


def test_exact_dedup(messy, messy_rows):
    check_exact(exact_dedup(messy), messy_rows)


@pytest.mark.parametrize("weak", [lambda c: F.length(c), lambda c: F.lit(0)])
def test_exact_dedup_when_chunk_identifiers_collide(messy, messy_rows, weak):
    check_exact(exact_dedup(messy, chunk_id=weak), messy_rows)


def test_exact_dedup_of_long_texts_that_differ_in_one_place(spark):
    rng = random.Random(2)
    long = prose(rng, 8000, 3000)
    rows = [(i, changed(rng, long, 1) if i % 2 else long + " " * i, None, None) for i in range(6)]
    check_exact(exact_dedup(frame(spark, rows)), rows)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACES:
            out, word = out + [word] * bool(word), ""
        else:
            word += c
    return out + [word] * bool(word)


def near_brute(rows, n):
    sets = []
    for _, t, *_ in rows:
        w = words(lower(t)) if len(t or "") < 20000 else lower(t).split()
        sets.append({tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                links.append((i, j))
    root = groups_of(links, range(len(rows)))
    least = {}
    for i, r in root.items():
        least[r] = min(least.get(r, id_key(rows[i][0])), id_key(rows[i][0]))
    smallest = {r: None if k[0] else k[1] for r, k in least.items()}
    return Counter((rows[i][0], len(sets[i]), smallest[r], rows[i][0] == smallest[r]) for i, r in root.items())


@pytest.mark.parametrize("n", [2, 5])
def test_near_duplicates(messy, messy_rows, n):
    out = near_duplicates(messy, n=n)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out.collect())
    assert got == near_brute(messy_rows, n)
    per_component = out.filter("stays").groupBy("component_id", "n_shingles").count()
    assert out.filter("stays").count() <= len(got)
    assert per_component.count() > 0


@pytest.mark.parametrize("crowd", [3, 64])
def test_near_duplicates_in_a_group_of_copies_that_are_not_all_alike(spark, monkeypatch, crowd):
    monkeypatch.setattr("bindery.llm.components.CROWD", crowd)
    rng = random.Random(11)
    base = prose(rng, 60, 10**6)
    rows = [(i, changed(rng, base, rng.randrange(0, 9)), None, None) for i in range(150)]
    got = Counter(
        (r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
        for r in near_duplicates(frame(spark, rows), n=2).collect()
    )
    assert got == near_brute(rows, 2)


def optimized(spy, name):
    return [df._jdf.queryExecution().optimizedPlan().toString() for df, n in spy if n == name]


def test_pairs_have_the_sizes_of_their_sets_without_a_join(spark, monkeypatch):
    written, write = [], neardup.keep
    monkeypatch.setattr(neardup, "keep", lambda df, name: written.append((df, name)) or write(df, name))
    rng = random.Random(12)
    base = prose(rng, 60, 10**6)
    rows = [(i, changed(rng, base, rng.randrange(0, 12)), None, None) for i in range(40)]
    rows += [(40 + i, f"{base} {prose(rng, i, 10**6)}", None, None) for i in range(1, 30)]
    out = near_duplicates(frame(spark, rows), n=2).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in out) == near_brute(rows, 2)
    plans = optimized(written, "pairs")
    assert plans and not any(re.search(r"Join Inner, \(b#", p) for p in plans)


def test_lines_without_a_copy_are_not_moved_to_find_those_with_one(spark, monkeypatch):
    written, write = [], linededup.keep
    monkeypatch.setattr(linededup, "keep", lambda df, name: written.append((df, name)) or write(df, name))
    rng = random.Random(13)
    lines = [prose(rng, 8, 50) for _ in range(60)]
    rows = [(i, "\n".join(rng.choice(lines) if i % 3 else f"{i} {k} {prose(rng, 8, 50)}" for k in range(9)), None, None) for i in range(30)]
    rows.append((99, " \n\nONE line\none line\n one line ", None, None))
    want, root, all_lines = line_brute(rows)
    assert Counter((r["doc_id"], r["line_no"], r["kept"]) for r in fuzzy_line_dedup(frame(spark, rows)).collect()) == want
    (plan,) = optimized(written, "class-lines")
    assert "LeftSemi" not in plan and "Union" in plan  # one part moves nothing, the other what the filter lets through


def test_pairs_of_lines_that_cannot_be_linked_move_no_text(spark, monkeypatch):
    written, write = [], neardup.keep
    monkeypatch.setattr(neardup, "keep", lambda df, name: written.append((out := write(df, name), name, out.count())) or out)
    rng = random.Random(14)
    head = prose(rng, 12, 10**6)
    rows = [(i, f"{head} {prose(rng, 14, 10**6)}", None, None) for i in range(60)]
    rows += [(100 + i, changed(rng, rng.choice(rows[:20])[1], 1), None, None) for i in range(20)]
    check_lines(spark, rows)
    assert 0 < sum(n for _, name, n in written if name == "asked-texts") < 60


@pytest.mark.parametrize("threshold", [50, 80, 95])
def test_no_linked_pair_of_lines_is_ruled_out(spark, threshold):
    rng = random.Random(15)
    base = [prose(rng, rng.randrange(1, 60), 10**6) for _ in range(8)] + ["ab", "abcdef" * 500, prose(rng, 3000, 10**6)]
    lines = base + [changed(rng, b, rng.randrange(1, 1 + max(1, len(b) // 40))) for b in base for _ in range(6)] + [b + "!" for b in base]
    texts = spark.createDataFrame(list(enumerate(lines)), "_row long, _text string")
    pairs = [(i, j) for i in range(len(lines)) for j in range(i + 1, len(lines))]
    left = linededup.possible_pairs(spark.createDataFrame(pairs, "a long, b long"), texts, 5, threshold).collect()
    sets = [{s[k : k + 5] for k in range(max(len(s) - 4, 1))} for s in lines]
    linked = {(i, j) for i, j in pairs if 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])}
    assert linked and linked <= {(r["a"], r["b"]) for r in left}
    assert len(left) < len(pairs) / 2


def line_brute(rows, n=5):
    lines = [(d, k, line) for d, (_, t, *_) in enumerate(rows) for k, line in enumerate((t or "").split("\n")) if t is not None]
    sets = []
    for _, _, line in lines:
        s = line.strip(" ").lower()
        sets.append({s} if 0 < len(s) < n else {s[i : i + n] for i in range(len(s) - n + 1)})
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 80 * (len(a) + len(sets[j]) - both):
                links.append((i, j))
    root = groups_of(links, range(len(lines)))
    return Counter((rows[d][0], k, root[i] == i) for i, (d, k, _) in enumerate(lines)), root, lines


def test_fuzzy_line_dedup(spark):
    rng = random.Random(3)
    base = [prose(rng, rng.randrange(6, 40), 10**6) for _ in range(12)]
    rows = [(1, None, None, None), (2, "", None, None), (3, "\n\n", None, None), (4, "ab\nAB \nabc", None, None)]
    for i in range(40):
        lines = [changed(rng, rng.choice(base), 1) if rng.random() < 0.5 else rng.choice(base) for _ in range(3)]
        rows.append((10 + i, "\n".join([*lines, prose(rng, 12, 10**6)]), None, None))
    rows += [(50, "same line of text here", None, None), (50, "same line of text here", None, None)]
    rows.append((51, "word " * 9000, None, None))
    want, root, lines = line_brute(rows)
    out = fuzzy_line_dedup(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["line_no"]) for r in out) == Counter((i, k) for i, k, _ in want.elements())
    # Which of several equal lines stays may depend on the order of rows, the number per component not.
    names = defaultdict(set)
    for r in out:
        names[(r["keep_id"], r["keep_line_no"])].add((r["doc_id"], r["line_no"]))
    brute = defaultdict(set)
    for i, (d, k, _) in enumerate(lines):
        brute[root[i]].add((rows[d][0], k))
    assert Counter(map(frozenset, names.values())) == Counter(map(frozenset, brute.values()))
    assert sum(r["kept"] for r in out) == len(brute)


def check_lines(spark, rows):
    want, root, _ = line_brute(rows)
    out = fuzzy_line_dedup(frame(spark, rows)).collect()
    assert sum(r["kept"] for r in out) == len(set(root.values()))
    assert Counter((r["doc_id"], r["line_no"], r["kept"]) for r in out) == want


def test_lines_without_spaces_that_differ_at_their_start(spark):
    path = "example.org/data/exports/2019/quarterly-figures-of-all-branches.parquet"
    rows = [(1, f"http://{path}\nhttps://{path}", None, None), (2, "/data/" + path + "\n\\data/" + path, None, None)]
    csv = "00417,2019-03-04,schmidt,hamburg,4711,paid,eur,129.90,card,completed"
    rows += [(3, f"{csv}\n9{csv[1:]}", None, None), (4, "https://other.example.net/x\nhttps://third.example.com/y", None, None)]
    rows += [(5, "ภาษาไทยไม่มีช่องว่างระหว่างคำในประโยคยาวๆ\nกภาษาไทยไม่มีช่องว่างระหว่างคำในประโยคยาวๆ", None, None)]
    check_lines(spark, rows)


def test_lines_of_few_words_with_one_character_edits(spark):
    rng = random.Random(12)
    rows = [(1, "download internationalisation1\ndownload internationalisation2", None, None)]
    rows += [(2, "stteen erachtz.\nstteen erachtz!\nstteen erachtzen", None, None), (3, "aaaaaa\naaaaaaaa\nabcde\nabcdef", None, None)]
    for i in range(150):
        line = " ".join("".join(rng.choices("abcdefghijklmnop", k=rng.randrange(4, 24))) for _ in range(1 + i % 5))
        at = rng.randrange(len(line))
        rows.append((10 + i, f"{line}\n{line[:at]}#{line[at + rng.randrange(2) :]}", None, None))
    check_lines(spark, rows)


def test_substring_dedup(messy, messy_rows):
    texts = [(i, (t or "").split() if len(t or "") > 20000 else words(t)) for i, t, *_ in messy_rows]
    seen = Counter(tuple(w[i : i + 35]) for _, w in texts for i in range(len(w) - 34))
    want = Counter()
    for i, w in texts:
        gone = {p + k for p in range(len(w) - 34) if seen[tuple(w[p : p + 35])] > 1 for k in range(35)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[(i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())] += 1
    out = substring_dedup(messy).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out) == want
    assert all(r["n_removed"] == sum(s["length"] for s in r["spans"]) for r in out)


def test_a_passage_shared_by_texts_that_differ_around_it(spark):
    rng = random.Random(8)
    passage = prose(rng, 50, 10**6)
    rows = [(i, f"{prose(rng, 40, 10**6)} {passage} {prose(rng, 40, 10**6)}", None, None) for i in range(20)]
    rows.append((99, f"{prose(rng, 90, 10**6)} {' '.join(passage.split()[3:37])}", None, None))
    out = {r["doc_id"]: r for r in substring_dedup(frame(spark, rows)).collect()}
    assert all(out[i]["spans"] == [(40, 50)] for i in range(20))
    assert out[99]["n_removed"] == 0


def test_components(spark):
    rng = random.Random(4)
    links = [(rng.randrange(500), rng.randrange(500)) for _ in range(350)] + [(i, i + 1) for i in range(1000, 1100)]
    links += [(2000, 2000 + i) for i in range(1, 200)]
    want = groups_of(links, {x for e in links for x in e})
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: r for n, r in want.items() if n != r}


def test_empty_tables(none):
    for operator in (exact_dedup, near_duplicates, fuzzy_line_dedup, substring_dedup):
        assert operator(none).count() == 0
