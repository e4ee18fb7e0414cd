"""The fuzzy joins against brute force, and the scorers against plain definitions."""

import functools
import random

import pytest
from pyspark.sql import functions as F

from bindery.functions.similarity import indel_score, jaro_winkler, lcs_lengths, partial_score, similar_cross
from bindery.operators import fuzzy

WORDS = "the a of red blue gear bolt king night day house of leaves stone river ab b moon cat dark tower zed".split()
AUTHORS = ["stephen king", "king s", "j k rowling", "rowling", "", "ann lee", "anne lee", "lee ann", "bo", "x"]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def ratio(a, b):
    return 100.0 if not a and not b else 200.0 * lcs(a, b) / (len(a) + len(b))


def title_score(a, b):
    return round(ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))


@functools.lru_cache(None)
def author_score(a, b):
    if not a and not b:
        return 100
    if not a or not b:
        return 0
    if len(a) > len(b):
        a, b = b, a
    best = 0
    for s, t in [(a, b), (b, a)] if len(a) == len(b) else [(a, b)]:
        for i in range(1, len(s)):
            best = max(best, ratio(s, t[:i]))
        for i in range(len(t)):
            best = max(best, ratio(s, t[i : i + len(s)]))
    return round(best)


def rows(n, seed):
    rnd = random.Random(seed)
    out = [(0, "", "ann lee"), (1, "a", "x"), (2, "a b", "bo")]
    for i in range(3, n):
        t = list(" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 4))))
        for _ in range(rnd.randint(0, 3)):
            k = rnd.randrange(len(t)) if t else 0
            kind = rnd.random()
            if t and kind < 0.4:
                del t[k]
            elif t and kind < 0.7:
                t[k] = rnd.choice("abcxyz ")
            else:
                t.insert(k, rnd.choice("abcxyz "))
        out.append((i, "".join(t), rnd.choice(AUTHORS)))
    # A third of the rows are copies of one book.
    return [(i, "dark tower", "stephen king") if i % 3 == 0 and i else (i, t, a) for i, t, a in out]


def brute_force(base, labels):
    found = set()
    for i, t, a in base:
        best, match = 0, None
        if not t.split():
            continue
        for j, t2, a2 in labels:
            ts = title_score(t, t2)
            if ts < 65:
                continue
            score = author_score(a, a2)
            if score < 55:
                continue
            combined = 0.7 * ts + 0.3 * score
            if combined > best:
                best, match = combined, (j, ts, score)
        if best >= 85:
            found.add((i, *match))
    return found


@pytest.mark.parametrize("tile", [2000, 15])
def test_title_author_join(spark, monkeypatch, tile):
    monkeypatch.setattr(fuzzy, "TILE", tile)
    base, labels = rows(240, 1), rows(200, 2)
    b = spark.createDataFrame(base, "id long, t string, a string")
    lab = spark.createDataFrame(labels, "lid long, t string, a string").repartition(5)
    out = fuzzy.fuzzy_title_author_join(
        b, lab, base_id="id", base_title="t", base_author="a", label_id="lid", label_title="t", label_author="a"
    )
    got = {(r["id"], r["lid"], r["t_score"], r["a_score"]) for r in out.collect()}
    assert got == brute_force(base, labels)
    assert len(got) > 60


@pytest.mark.parametrize("rule", [fuzzy.FuzzyRule(), fuzzy.FuzzyRule(threshold=60.0, title_floor=40)])
def test_title_author_join_in_passes(spark, monkeypatch, rule):
    """Rows with a good match are settled by stricter passes; only the others meet labels at the low threshold."""
    monkeypatch.setattr(fuzzy, "FEW", 0)
    monkeypatch.setattr(fuzzy, "PASSES", (99.0, 90.0))
    asked, plain = [], fuzzy._similar
    monkeypatch.setattr(fuzzy, "_similar", lambda l, r, lowest: asked.append((lowest, l.count())) or plain(l, r, lowest))
    base, labels = rows(70, 3), rows(50, 4)
    labels += [(500 + i, t, a) for i, t, a in base[::2]]
    b = spark.createDataFrame([*base, (900, "dark tower", None)], "id long, t string, a string")
    lab = spark.createDataFrame([*labels, (901, "dark tower", None)], "lid long, t string, a string")

    def run():
        out = fuzzy.fuzzy_title_author_join(
            b, lab, base_id="id", base_title="t", base_author="a", label_id="lid", label_title="t", label_author="a", rule=rule
        )
        return sorted(tuple(r) for r in out.collect())

    got, passes = run(), asked[:]
    assert [lowest for lowest, _ in passes] == [99, 86, rule.lowest_title()]
    assert passes[-1][1] < passes[0][1] * 0.75
    if rule == fuzzy.FuzzyRule():
        assert {(i, j, ts, s) for i, j, ts, s, _ in got} == brute_force(base, labels)
    monkeypatch.setattr(fuzzy, "PASSES", ())
    assert run() == got and len(got) > 30


def test_pairs_down_to_the_loosest_threshold(spark):
    """Every pair of short strings, where a guaranteed shared bigram is hardest."""
    texts = sorted({a + b + c + d for a in ["", "a", "b"] for b in ["", "b"] for c in ["a", "c"] for d in ["", "a", "cc"]})
    df = spark.createDataFrame([(x,) for x in texts], "title string")
    for lowest in (1, 35, 50, 60, 67, 68, 78, 79, 95):
        got = {(r[0], r[1]) for r in fuzzy.similar_titles(df, df, lowest).select("l_title", "r_title").collect()}
        assert got == {(x, y) for x in texts for y in texts if round(ratio(x, y)) >= lowest}
    with pytest.raises(ValueError):
        fuzzy.similar_titles(df, df, 0)


def test_pairs_of_mixed_titles_at_loose_thresholds(spark):
    texts = sorted({t for _, t, _ in rows(90, 8) if t})
    df = spark.createDataFrame([(x,) for x in texts], "title string")
    for lowest in (50, 64, 72):
        got = {(r[0], r[1]) for r in fuzzy.similar_titles(df, df, lowest).select("l_title", "r_title").collect()}
        assert got == {(x, y) for x in texts for y in texts if round(ratio(x, y)) >= lowest}


def test_adaptations_down_to_any_similarity(spark):
    rnd = random.Random(21)
    names = sorted({"".join(rnd.choices("abcde ", k=rnd.randint(1, 9))).strip() for _ in range(60)} - {"", "a", "an"})
    names = [n for n in names if not n.startswith(("a ", "an ")) and "  " not in n]
    books, films = names[::2], names[1::2]
    b = spark.createDataFrame([(i, t, None) for i, t in enumerate(books)], "id long, t string, y int")
    f = spark.createDataFrame([(i, t, None) for i, t in enumerate(films)], "f long, ft string, fy int")
    for threshold in (0.2, 0.45, 0.7, 0.71, 0.8):
        out = fuzzy.adaptation_fuzzy_join(
            b, f, book_id="id", book_title="t", book_year="y", adaptation_id="f", adaptation_title="ft",
            adaptation_year="fy", threshold=threshold,
        )
        want = {}
        for i, t in enumerate(books):
            scores = jaro_winkler([t] * len(films), films)
            k = int(scores.argmax())
            want[i] = films[k] if scores[k] >= threshold else None
        assert {r["id"]: r["adaptation_title"] for r in out.collect()} == want


@pytest.mark.parametrize("tile", [2000, 15])
def test_adaptations(spark, monkeypatch, tile):
    monkeypatch.setattr(fuzzy, "TILE", tile)
    rnd = random.Random(5)

    def year():
        return rnd.choice([None, 1990, 1994, 1999, 2004, 2010])

    def norm(t):
        for a in ("the ", "a ", "an "):
            t = t[len(a) :] if t.startswith(a) else t
        return t.strip()

    books = [(i, t, year()) for i, t, _ in rows(200, 3)]
    movies = [(i, t, year()) for i, t, _ in rows(180, 4)]
    want = {}
    for i, t, y in books:
        best = None
        for _, t2, y2 in movies:
            if not norm(t) or not norm(t2) or (y and y2 and abs(y - y2) > 5):
                continue
            s = jaro_winkler([norm(t)], [norm(t2)])[0]
            if s >= 0.9 and (best is None or s > best[0]):
                best = (s, t2)
        want[i] = (1, best[1]) if best else (0, None)
    out = fuzzy.adaptation_fuzzy_join(
        spark.createDataFrame(books, "id long, t string, y int"),
        spark.createDataFrame(movies, "lid long, t2 string, y2 int"),
        book_id="id", book_title="t", book_year="y", adaptation_id="lid", adaptation_title="t2", adaptation_year="y2",
    )
    assert {r["id"]: (r["adapted_to_screen"], r["adaptation_title"]) for r in out.collect()} == want


def test_adaptations_with_authors(spark):
    books = spark.createDataFrame([(1, "Dune", None, "a"), (2, "Dune", None, "b")], "id long, t string, y int, who string")
    movies = spark.createDataFrame([(7, "dune!", None, "b")], "lid long, t2 string, y2 int, who2 string")
    out = fuzzy.adaptation_fuzzy_join(
        books, movies, book_id="id", book_title="t", book_year="y", adaptation_id="lid", adaptation_title="t2",
        adaptation_year="y2", authors=(F.col("who"), F.col("who2")),
    )
    assert {r["id"]: r["adapted_to_screen"] for r in out.collect()} == {1: 0, 2: 1}


def test_adaptations_by_identifier_first(spark):
    """An identifier beats a better title, ends the search for its book only, and null identifiers match nothing."""
    books = spark.createDataFrame(
        [(1, "Dune", 1965, "978A"), (2, "Dune", 1965, None), (3, "Emma", None, "978B"), (4, "Emna", 1815, "978C"), (5, "Zed", 1, None)],
        "id long, t string, y int, isbn string",
    )
    films = spark.createDataFrame(
        [(7, "Dune", 1966, None), (8, "Sand", 1984, "978A"), (9, "Sand II", 1985, "978A"), (6, "Emma", 1817, None), (5, None, None, "978B")],
        "fid long, ft string, fy int, fisbn string",
    )
    out = fuzzy.adaptation_fuzzy_join(
        books, films, book_id="id", book_title="t", book_year="y", adaptation_id="fid", adaptation_title="ft",
        adaptation_year="fy", threshold=0.85, identifiers=(F.col("isbn"), F.col("fisbn")),
    )
    assert out.columns == ["id", "t", "y", "isbn", "adaptation_title", "match_method", "adapted_to_screen"]
    assert {r["id"]: (r["match_method"], r["adaptation_title"], r["adapted_to_screen"]) for r in out.collect()} == {
        1: ("identifier", "Sand", 1), 2: ("title", "Dune", 1), 3: ("identifier", None, 1),
        4: ("similar_title", "Emma", 1), 5: ("unmatched", None, 0),
    }


def test_titles_are_compared_once_whatever_their_years(spark, monkeypatch):
    """Pairs that reach the scorer don't grow with the number of years per title."""
    sizes = []
    write = fuzzy.materialize

    def counted(df, name="stage", **options):
        out = write(df, name, **options)
        if name == "title-pairs":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(fuzzy, "materialize", counted)
    for years in (1, 12):
        films = [(100 * i + y, t, 1950 + y) for i, t in enumerate(("dark tower", "red dragon", "blue moon")) for y in range(years)]
        books = [(100 * i + y, t, 1950 + y) for i, t in enumerate(("dark towers", "red dragons", "dark river")) for y in range(years)]
        out = fuzzy.adaptation_fuzzy_join(
            spark.createDataFrame(books, "id long, t string, y int"), spark.createDataFrame(films, "f long, ft string, fy int"),
            book_id="id", book_title="t", book_year="y", adaptation_id="f", adaptation_title="ft", adaptation_year="fy",
        )
        assert out.filter("adapted_to_screen = 1").count() == 2 * years
    assert sizes[0] == sizes[1] <= 9


def test_lcs_of_long_and_empty_texts():
    rnd = random.Random(3)
    sizes = [0, 1, 5, 63, 64, 65, 128, 200]
    left = ["".join(rnd.choice("abcé ") for _ in range(rnd.choice(sizes))) for _ in range(200)]
    right = ["".join(rnd.choice("abcdé ") for _ in range(rnd.choice(sizes))) for _ in range(200)]
    assert [int(x) for x in lcs_lengths(left, right)] == [lcs(a, b) for a, b in zip(left, right)]


def test_scores(spark):
    pairs = [("stephen king", "king stephen"), ("abc", "abd"), ("", ""), ("a", ""), ("j k rowling", "rowling j k and others")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select(indel_score("a", "b").alias("i"), partial_score("a", "b").alias("p")).collect()
    assert [(r["i"], r["p"]) for r in got] == [(round(ratio(a, b)), author_score(a, b)) for a, b in pairs]
    assert abs(jaro_winkler(["martha"], ["marhta"])[0] - 0.9611111111111111) < 1e-12


def test_jaro_winkler_against_another_engine():
    import duckdb

    rng = random.Random(1)
    word = lambda: "".join(rng.choices("abcde ", k=rng.randint(1, 14)))
    left = [word() for _ in range(2000)]
    right = [word() if rng.random() < 0.5 else a[:5] + word()[:4] for a in left]
    con = duckdb.connect()
    con.execute("CREATE TABLE p (i INT, a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?, ?)", [[i, a, b] for i, (a, b) in enumerate(zip(left, right))])
    want = [s for (s,) in con.execute("SELECT jaro_winkler_similarity(a, b) FROM p ORDER BY i").fetchall()]
    got = jaro_winkler(left, right)
    assert all(abs(x - y) < 1e-12 for x, y in zip(got, want))
    assert jaro_winkler(["", "", "a"], ["", "a", ""]).tolist() == [0.0, 0.0, 0.0]


def test_one_to_one(spark):
    base = spark.createDataFrame([(1, "red dragon", "ann lee"), (2, "red dragon s", "ann lee"), (3, "blue", "x")], "i int, t string, a string")
    labels = spark.createDataFrame([(7, "red dragon", "ann lee"), (8, "green", "y")], "l int, t string, a string")
    names = dict(base_id="i", base_title="t", base_author="a", label_id="l", label_title="t", label_author="a")
    many = fuzzy.fuzzy_title_author_join(base, labels, **names).collect()
    one = fuzzy.fuzzy_title_author_join(base, labels, **names, one_to_one=True).collect()
    assert sorted((r["i"], r["l"]) for r in many) == [(1, 7), (2, 7)]
    assert [(r["i"], r["l"]) for r in one] == [(1, 7)]


@pytest.mark.parametrize("at_once", [True, False])
def test_similar_titles_either_way(spark, monkeypatch, at_once):
    """All pairs at once or by their rarest tokens: the same pairs, each once, and none of them shuffled."""
    monkeypatch.setattr(fuzzy, "TILE", 7)
    monkeypatch.setattr(fuzzy, "_meets_more_than_all", lambda l, r: at_once)
    named = []
    plain = fuzzy.materialize
    monkeypatch.setattr(fuzzy, "materialize", lambda df, name="stage", **o: named.append(name) or plain(df, name, **o))
    left, right = ({t for _, t, _ in rows(60, seed) if t} for seed in (1, 2))
    sides = [spark.createDataFrame([(t,) for t in sorted(side)], "title string") for side in (left, right)]
    for lowest in (60, 79):
        got = [(r["l_title"], r["r_title"], r["t_score"]) for r in fuzzy.similar_titles(*sides, lowest).collect()]
        want = [(a, b, round(ratio(a, b))) for a in left for b in right if round(ratio(a, b)) >= lowest]
        assert sorted(got) == sorted(want)
    assert "title-pairs" not in named


def test_cross_of_long_texts():
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("abé \U0001f600") for _ in range(rnd.randint(0, 150))) for _ in range(30)]
    i, j, score = similar_cross(texts, texts[::-1], 60)
    want = {(x, y): round(ratio(s, t)) for x, s in enumerate(texts) for y, t in enumerate(texts[::-1]) if round(ratio(s, t)) >= 60}
    assert {(x, y): z for x, y, z in zip(i.tolist(), j.tolist(), score.tolist())} == want
    assert [len(x) for x in similar_cross(["a"], ["b"], 60)] == [0, 0, 0]
