"""Fuzzy joins without a cross join and without losing a match.

Both joins first combine copies: only distinct titles are compared, whatever number of rows share
them. Candidate titles come from a prefix filter: two strings that reach the threshold must share
a computable number of tokens, so they share at least one among each side's rarest tokens. The
join on those tokens carries bounds on length and on missing tokens (bit counts of hashed token
sets) in its condition, so pairs that cannot reach the threshold are dropped inside the join. What
is left is scored in Arrow batches.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions.binding import bound
from bindery.functions.similarity import indel_score, jaro_winkler_score, partial_score, similar_tile
from bindery.functions.text import norm_title_nfkd
from bindery.operators.keyed import above_share, append_rows, keep_best_per_key, lookup_join
from bindery.session import materialize

TILE = 2000  # postings of one token per join key and side; hotter tokens are split into tiles
PASSES = (99.0, 97.0, 94.0, 90.0)  # scores above the threshold that are asked for first, see :func:`_best_labels`
FEW = 1 << 24  # pairs of titles that need no stricter pass before


@dataclass(frozen=True)
class FuzzyRule:
    """Accept if title and author reach their floors and the weighted score the threshold."""

    threshold: float = 85.0
    title_floor: int = 65
    author_floor: int = 55
    title_weight: float = 0.7
    author_weight: float = 0.3

    def lowest_title(self) -> int:
        """The lowest title score with which a perfect author still reaches the threshold."""
        for t in range(self.title_floor, 101):
            if self.title_weight * t + self.author_weight * 100 >= self.threshold:
                return t
        return 101


def sorted_tokens(title: Column) -> Column:
    words = F.filter(F.split(title, r"\s+"), lambda w: w != "")
    return F.array_join(F.array_sort(words), " ")


def _numbered(items: Column) -> Column:
    """Make the items of an array distinct by appending their occurrence number."""

    def number(all_items: Column) -> Column:
        def nth(x: Column, i: Column) -> Column:
            upto = F.filter(F.slice(all_items, 1, i + 1), lambda y: y == x)
            return F.concat_ws("\u0001", x, F.size(upto))

        return F.transform(all_items, nth)

    return bound(items, number)


def _pieces(text: Column, size: int) -> Column:
    """All substrings of a length, left to right."""

    def cut(t: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(t) - (size - 1))
        return F.when(F.length(t) >= size, F.transform(starts, lambda i: F.substring(t, i, F.lit(size))))

    return F.coalesce(bound(text, cut), F.array().cast("array<string>"))


def bigram_tokens(text: Column) -> Column:
    """Distinct tokens for the bigrams of the text with a mark at either end."""
    return _numbered(_pieces(F.concat(F.lit("\u0002"), text, F.lit("\u0003")), 2))


def letter_tokens(text: Column) -> Column:
    return _numbered(_pieces(text, 1))


def _bitmap(tokens: Column, prefix: str) -> Column:
    """256 bits in an array of four, one bit per hashed token."""

    none = F.lit(0).cast("long")

    def word(hashes: Column, w: int) -> Column:
        def put(acc: Column, h: Column) -> Column:
            at = F.pmod(F.shiftright(h, 2), F.lit(64)).cast("int")
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), at)
            return acc.bitwiseOR(F.when(F.pmod(h, F.lit(4)) == w, bit).otherwise(none))

        return F.aggregate(hashes, none, put)

    # One array of the four: the tokens and their hashes are made once.
    hashed = F.transform(tokens, lambda t: F.xxhash64(t))
    words = bound(hashed, lambda hs: F.array(*[word(hs, w) for w in range(4)]))
    return words.alias(prefix)


def _missing(a: str, b: str, prefix: str) -> Column:
    """At most this many tokens of side ``a`` are absent from side ``b`` (hash collisions lower it)."""
    total = F.lit(0)
    for w in range(4):
        total = total + F.bit_count(F.get(f"{a}{prefix}", F.lit(w)).bitwiseAND(F.bitwise_not(F.get(f"{b}{prefix}", F.lit(w)))))
    return total


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _rank_tokens(left: DataFrame, right: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Order the ``tokens`` of every ``title`` by rarity over both sides."""
    both = left.select("tokens").unionByName(right.select("tokens"))
    freq = both.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("_df"))
    freq = materialize(freq, "token-frequency")
    hot = above_share(freq, "_df").select("token")

    def ordered(side: DataFrame) -> DataFrame:
        one = side.select("title", F.explode("tokens").alias("token"))
        one = lookup_join(one, freq, ["token"], hot=hot, row_id=["title", "token"])
        packed = F.array_sort(F.collect_list(F.struct("_df", "token")))
        ranked = one.groupBy("title").agg(packed.alias("_packed"))
        return ranked.select("title", F.transform("_packed", lambda x: x["token"]).alias("tokens"))

    return ordered(left), ordered(right)


def _tiled_join(left: DataFrame, right: DataFrame, condition: Column, own: tuple[str, ...] = ("title",)) -> DataFrame:
    """Join postings (``key``, ...) of both sides; the columns are prefixed l_ and r_.

    A key with many postings is split into a grid: each left row goes to one row of the grid and
    is copied to its columns, each right row the other way round. Every pair still meets once.
    """
    sizes = (
        left.select("key", F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select("key", F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .groupBy("key")
        .agg(
            F.ceil(F.sum("_l") / TILE).cast("int").alias("_rows"),
            F.ceil(F.sum("_r") / TILE).cast("int").alias("_cols"),
            F.count("*").alias("_n"),
        )
        .filter("_rows > 0 and _cols > 0")  # keys of one side only have no pairs
    )
    sizes = materialize(sizes, "tile-sizes")
    hot = above_share(sizes, "_n").select("key")
    place = F.pmod(F.xxhash64(*own), F.lit(1 << 30)).cast("int")

    def spread(side: DataFrame, mine: str, other: str, prefix: str) -> DataFrame:
        # A token of very many postings is spread over the lookup too, not only over its tiles.
        found = lookup_join(side, sizes.drop("_n"), ["key"], hot=hot, row_id=list(own)).filter("_rows is not null")
        placed = found.withColumns(
            {mine[1:]: place % F.col(mine), other[1:]: F.explode(F.sequence(F.lit(0), F.col(other) - 1))}
        )
        return placed.select(
            "key", "rows", "cols", *[F.col(c).alias(prefix + c) for c in side.columns if c != "key"]
        )

    l = spread(left, "_rows", "_cols", "l_")
    r = spread(right, "_cols", "_rows", "r_")
    # The work per byte is high, so the partition number is fixed: adaptive coalescing, which goes
    # by bytes, would leave few tasks. Catalyst moves the condition into the inner join itself.
    cell = ["key", "rows", "cols"]
    l, r = (side.repartition(_parts(left), *cell) for side in (l, r))
    return l.join(r, cell).filter(condition)


def _first_shared() -> Column:
    """The rarest token both prefixes hold; a pair is kept only at this key, so it appears once."""
    return F.get(F.array_intersect("l_rarest", "r_rarest"), F.lit(0))


def similar_titles(left: DataFrame, right: DataFrame, lowest: int) -> DataFrame:
    """All pairs of non-empty ``title`` values whose indel score is at least ``lowest``.

    With L the common subsequence of lengths m and n, the score asks for L >= h (m + n), where
    h = (lowest - 0.5) / 200. Every inserted character breaks at most one bigram and every deleted
    one at most two, so with end marks the strings share at least 3 L - (m + n) + 1 bigrams. Scores of
    67 or less guarantee none; there the postings are letters, of which L are shared.
    """
    return _similar(*_prepared(left, right, _by_letter(lowest)), lowest)


def _by_letter(lowest: int) -> bool:
    """Whether the score guarantees no shared bigram, so that the postings are letters."""
    if lowest < 1:
        raise ValueError("a title score of 0 asks for nothing in common")
    return 3 * (lowest - 0.5) / 200 <= 1


def _prepared(left: DataFrame, right: DataFrame, by_letter: bool) -> tuple[DataFrame, DataFrame]:
    """Distinct titles of both sides with what :func:`_similar` compares, which no score has a part in:
    hashes of the tokens, rarest first, and bits of bigrams and letters."""
    title = F.col("title")

    def titles(df: DataFrame) -> DataFrame:
        # Far more work than bytes, so titles are dealt out first.
        distinct = df.select("title").filter("title <> ''").distinct().repartition(_parts(df), "title")
        tokens = letter_tokens if by_letter else bigram_tokens
        return materialize(distinct, "distinct-titles").withColumn("tokens", tokens(title))

    def ready(df: DataFrame) -> DataFrame:
        # Tokens of one hash count as one, here as at the join, so a pair has a first shared one in any case.
        hashes = F.transform("tokens", lambda t: F.hash(t)).alias("hashes")
        bits = _bitmap(bigram_tokens(title), "bigram"), _bitmap(letter_tokens(title), "letter")
        dealt = df.repartition(_parts(df), "title")
        return materialize(dealt.select("title", F.length("title").alias("len"), hashes, *bits), "titles")

    return tuple(ready(side) for side in _rank_tokens(titles(left), titles(right)))


def _similar(left: DataFrame, right: DataFrame, lowest: int) -> DataFrame:
    """:func:`similar_titles` of prepared sides."""
    h = (lowest - 0.5) / 200
    by_letter = _by_letter(lowest)
    # Fewest shared tokens per character, over all fitting lengths: n is at least m h / (1 - h).
    slope = (h if by_letter else 3 * h - 1) / (1 - h)

    def with_prefix(df: DataFrame) -> DataFrame:
        shared = F.ceil(F.col("len") * slope + (0 if by_letter else 1) - 1e-9)
        rarest = F.slice(F.col("hashes"), F.lit(1), (F.size("hashes") + 1 - shared).cast("int"))
        return df.select("title", F.array_distinct(rarest).alias("rarest"), "len", "bigram", "letter")

    l, r = with_prefix(left), with_prefix(right)
    m, n = F.col("l_len"), F.col("r_len")
    needed = F.ceil((m + n) * h - 1e-9)
    bigrams = needed * 3 - (m + n) + 1
    condition = (
        (F.least(m, n) >= needed)
        & (_missing("l_", "r_", "letter") <= m - needed)
        & (_missing("r_", "l_", "letter") <= n - needed)
        & (_missing("l_", "r_", "bigram") <= m + 1 - bigrams)
        & (_missing("r_", "l_", "bigram") <= n + 1 - bigrams)
    )
    if _meets_more_than_all(l, r):
        return materialize(_all_similar(l.select("title"), r.select("title"), lowest), "similar-titles")
    # A pair is scored where it meets first: no pair is shuffled, and only similar ones are written.
    met = _tiled_join(_postings(l), _postings(r), condition & (F.col("l__token") == _first_shared()))
    scored = met.select("l_title", "r_title", indel_score("l_title", "r_title").alias("t_score"))
    return materialize(scored.filter(F.col("t_score") >= lowest), "similar-titles")


def _all_similar(left: DataFrame, right: DataFrame, lowest: int) -> DataFrame:
    """Every pair of titles scored once, in tiles of some ``TILE`` titles of either side."""
    rows, columns = (-(-side.count() // TILE) for side in (left, right))
    place = F.xxhash64("title")

    def dealt(side: DataFrame, mine: Column, other: int, mark: str, first: bool):
        every = F.explode(F.sequence(F.lit(0), F.lit(other - 1)))
        cell = (mine.alias(f"_{mark}i"), every.alias(f"_{mark}j")) if first else (every.alias(f"_{mark}i"), mine.alias(f"_{mark}j"))
        # A fixed number of partitions, as in :func:`_tiled_join`.
        return side.select("title", *cell).repartition(_parts(side), f"_{mark}i", f"_{mark}j").groupBy(f"_{mark}i", f"_{mark}j")

    l = dealt(left, F.pmod(place, F.lit(rows)).cast("int"), columns, "l", True)
    r = dealt(right, F.pmod(place, F.lit(columns)).cast("int"), rows, "r", False)
    return l.cogroup(r).applyInArrow(similar_tile(lowest), "l_title string, r_title string, t_score int")


def _meets_more_than_all(left: DataFrame, right: DataFrame) -> bool:
    """Whether pairs would meet at their tokens more often than there are pairs.

    Long titles of a low threshold have most of their tokens among the rarest, and each pair that meets
    does so many times. Then every pair is looked at once, by :func:`_all_similar`.
    """
    counts = [
        side.select(F.explode("rarest").alias("key")).groupBy("key").agg(F.count("*").cast("double").alias(n))
        for side, n in ((left, "_l"), (right, "_r"))
    ]
    met = counts[0].join(counts[1], "key").agg(F.sum(F.col("_l") * F.col("_r"))).first()[0]
    return met is not None and met > float(left.count()) * right.count()


def _postings(titles: DataFrame) -> DataFrame:
    return titles.withColumn("key", F.explode("rarest")).withColumn("_token", F.col("key"))


def fuzzy_title_author_join(
    base: DataFrame,
    labels: DataFrame,
    *,
    base_id: str,
    base_title: str,
    base_author: str,
    label_id: str,
    label_title: str,
    label_author: str,
    rule: FuzzyRule = FuzzyRule(),
    one_to_one: bool = False,
) -> DataFrame:
    """Best label row per base row: columns base id, label id, ``t_score``, ``a_score``, ``fuzzy_score``.

    Titles and authors are expected normalised. The lowest label id wins a tie; several base rows
    may get the same label row, unless ``one_to_one`` leaves it to the best of them (ties: lowest
    base id). Base rows without an accepted label are not in the result.
    """
    b = base.select(
        F.col(base_id), sorted_tokens(F.col(base_title)).alias("l_title"), F.col(base_author).alias("l_author")
    ).filter("l_title <> ''")
    distinct_base = materialize(b.select("l_title", "l_author").distinct(), "base-titles")
    distinct_labels = materialize(
        labels.select(
            sorted_tokens(F.col(label_title)).alias("r_title"),
            F.col(label_author).alias("r_author"),
            F.col(label_id).alias("_label"),
        )
        .groupBy("r_title", "r_author")
        .agg(F.min("_label").alias("_label")),
        "label-titles",
    )
    best = _best_labels(distinct_base, distinct_labels, rule)
    found = lookup_join(b, best, ["l_title", "l_author"], row_id=[base_id])
    found = found.filter(F.col("_label").isNotNull())
    if one_to_one:
        found = keep_best_per_key(found, ["_label"], [F.desc("fuzzy_score"), F.asc(base_id)])
    return found.select(base_id, F.col("_label").alias(label_id), "t_score", "a_score", "fuzzy_score")


def _best_labels(base: DataFrame, labels: DataFrame, rule: FuzzyRule) -> DataFrame:
    """Best label of each distinct (l_title, l_author) that has an accepted one, in passes of falling thresholds.

    A stricter pass sees all labels that reach its score, so a row that finds one there has its best label, ties
    included, and takes no part in later passes. High scores leave few candidates, and most rows have a good match; so
    only the rest is compared at the rule's own threshold. A row without author is never looked up.
    """
    open_rows, n = base.filter("l_author is not null"), labels.count()
    titles = open_rows.select(F.col("l_title").alias("title")), labels.select(F.col("r_title").alias("title"))
    ready: dict[bool, tuple[DataFrame, DataFrame]] = {}

    def labels_at(now: FuzzyRule) -> DataFrame:
        lowest = now.lowest_title()
        kind = _by_letter(lowest)
        if kind not in ready:
            ready[kind] = _prepared(*titles, kind)
        left, right = ready[kind]
        if found:
            left = materialize(left.join(open_rows.select(F.col("l_title").alias("title")), "title", "left_semi"), "open-titles")
        return _labels_at(open_rows, labels, _similar(left, right, lowest), now)

    found: list[DataFrame] = []
    for score in PASSES:
        stricter = replace(rule, threshold=score)
        if score <= rule.threshold or stricter.lowest_title() > 100:
            continue
        if open_rows.count() * n <= FEW:
            break
        found.append(labels_at(stricter))
        done = found[-1].select("l_title", "l_author")
        open_rows = materialize(open_rows.join(done, ["l_title", "l_author"], "left_anti"), "open-rows")
    return append_rows(*found, labels_at(rule))


def _labels_at(base: DataFrame, labels: DataFrame, titles: DataFrame, rule: FuzzyRule) -> DataFrame:
    """Best label of each (l_title, l_author) among all that the rule accepts, given the similar titles."""
    # Upper bound of the author score from the letters in common, checked before exact scoring.
    lower_author = F.greatest(
        F.lit(float(rule.author_floor)),
        (F.lit(rule.threshold) - F.col("l_t_score") * rule.title_weight) / rule.author_weight,
    ) - 0.5
    common = F.size(F.array_intersect("l_letters", "r_letters"))
    shorter = F.least(F.length("l_author"), F.length("r_author"))
    highest = F.when(F.greatest(F.length("l_author"), F.length("r_author")) == 0, 100.0).otherwise(
        F.coalesce(F.try_divide(common * 200.0, shorter + common), F.lit(0.0))
    )
    left = titles.join(base, "l_title").select(
        F.col("r_title").alias("key"), F.col("l_title").alias("title"), F.col("l_author").alias("author"),
        "t_score", letter_tokens(F.col("l_author")).alias("letters"),
    )
    right = labels.select(
        F.col("r_title").alias("key"), F.col("r_author").alias("author"), "_label",
        letter_tokens(F.col("r_author")).alias("letters"),
    )
    # A title with very many authors on both sides is split like a frequent token.
    pairs = _tiled_join(
        materialize(left, "author-left"), materialize(right, "author-right"), highest + 1e-9 >= lower_author, ("author",)
    ).select("l_title", "l_author", "r_author", F.col("l_t_score").alias("t_score"), F.col("r__label").alias("_label"))
    score = F.col("t_score") * F.lit(rule.title_weight) + F.col("a_score") * F.lit(rule.author_weight)
    accepted = (
        pairs.withColumn("a_score", partial_score("l_author", "r_author"))
        .filter(F.col("a_score") >= rule.author_floor)
        .withColumn("fuzzy_score", score)
        .filter(F.col("fuzzy_score") >= rule.threshold)
        .drop("r_author")
    )
    best = keep_best_per_key(accepted, ["l_title", "l_author"], [F.desc("fuzzy_score"), F.asc("_label")])
    return materialize(best, "best-labels")


def adaptation_fuzzy_join(
    books: DataFrame,
    adaptations: DataFrame,
    *,
    book_id: str,
    book_title: str,
    book_year: str,
    adaptation_id: str,
    adaptation_title: str,
    adaptation_year: str,
    threshold: float = 0.90,
    tolerance: int = 5,
    authors: tuple[Column, Column] | None = None,
    identifiers: tuple[Column, Column] | None = None,
) -> DataFrame:
    """Add ``adapted_to_screen`` (0/1), ``adaptation_title`` and ``match_method`` to every book.

    With ``identifiers`` (normalised keys of both sides, null where there is none) books whose key an
    adaptation has are matched by it first, to the lowest adaptation id, and take no part in the
    second stage. There a match has the same normalised title or a Jaro-Winkler similarity of at least
    ``threshold``, and years within the tolerance where both are known. With ``authors``
    (normalised keys of both sides) they must be equal too. The best score wins, then the lowest
    adaptation id. Methods: identifier, title (equal), similar_title, unmatched.
    """
    none = F.lit("")
    b = books.withColumns(
        {"_t": norm_title_nfkd(F.col(book_title)), "_y": F.col(book_year), "_a": authors[0] if authors else none}
    )
    m = adaptations.select(
        F.col(adaptation_id).alias("_id"),
        F.col(adaptation_title).alias("adaptation_title"),
        norm_title_nfkd(F.col(adaptation_title)).alias("title"),
        F.col(adaptation_year).alias("year"),
        (authors[1] if authors else none).alias("author"),
        (identifiers[1] if identifiers else F.lit(None)).cast("string").alias("_key"),
    )
    by_key = F.lit(False)
    if identifiers:
        first = F.min(F.struct("_id", "adaptation_title"))["adaptation_title"].alias("_known_title")
        known = m.filter("_key is not null").groupBy("_key").agg(first, F.lit(True).alias("_known"))
        b = b.withColumn("_key", identifiers[0].cast("string"))
        b = lookup_join(b, materialize(known, "identifiers"), ["_key"], row_id=[book_id]).drop("_key")
        b = materialize(b.withColumn("_known", F.coalesce("_known", F.lit(False))), "books-by-identifier")
        by_key = F.col("_known")
    left = b.filter(~by_key).select(F.col("_t").alias("title"), F.col("_y").alias("year"), F.col("_a").alias("author"))
    left = left.filter("title <> ''").distinct()
    right = m.filter("title <> ''").groupBy("title", "year", "author").agg(F.min("_id").alias("_id"))
    pairs = _jaro_winkler_pairs(materialize(left, "books"), materialize(right, "adaptations"), threshold, tolerance)
    best = keep_best_per_key(
        pairs.select(F.col("title").alias("_t"), F.col("year").alias("_y"), F.col("author").alias("_a"), "score", "_id"),
        ["_t", "_y", "_a"],
        [F.desc("score"), F.asc("_id")],
    )
    # A null year is a value of its own here; the lookup needs keys without nulls.
    unknown = F.coalesce("_y", F.lit(-(2**31)))
    method = F.when(F.col("score") == 1, "title").otherwise("similar_title").alias("match_method")
    best = best.withColumn("_y", unknown).join(m.select("_id", "adaptation_title"), "_id")
    best = best.select("_t", "_y", "_a", "adaptation_title", method)
    found = lookup_join(
        b.withColumn("_y", unknown), materialize(best, "best-adaptations"), ["_t", "_y", "_a"], row_id=[book_id]
    )
    if identifiers:
        title = F.when(by_key, F.col("_known_title")).otherwise(F.col("adaptation_title"))
        found = found.withColumns(
            {"adaptation_title": title, "match_method": F.when(by_key, "identifier").otherwise(F.col("match_method"))}
        ).drop("_known", "_known_title")
    flag = F.col("match_method").isNotNull().cast("int")
    method = F.coalesce("match_method", F.lit("unmatched"))
    return found.withColumns({"adapted_to_screen": flag, "match_method": method}).drop("_t", "_y", "_a")


def _jaro_winkler_pairs(left: DataFrame, right: DataFrame, threshold: float, tolerance: int) -> DataFrame:
    """Rows (title, year, author) of the left side with the ``_id`` and ``score`` of every right row that
    reaches the threshold within the year tolerance.

    Titles are compared once per pair and author, whatever number of years they come with. A common prefix of p <= 4 characters lifts Jaro j to j + 0.1 p (1 - j). With c matching
    characters of lengths m and n, 3 j - 1 <= c / m + c / n. Pairs that agree in the first two
    characters meet on these; all others have p <= 1, so j is high enough for a prefix filter on
    their rarest letters.
    """
    if threshold <= 0:
        raise ValueError("a similarity of 0 asks for nothing in common")
    # Only a Jaro similarity above 0.7 is lifted, so up to there the threshold holds for it as it is.
    jaro_any, jaro_low = (max(0.7, (threshold - x) / (1 - x)) if threshold > 0.7 else threshold for x in (0.4, 0.1))
    need_any, need_low = 3 * jaro_any - 1, 3 * jaro_low - 1
    titles_l, titles_r = (
        side.select("title").distinct().withColumn("tokens", letter_tokens(F.col("title"))) for side in (left, right)
    )

    def prepared(side: DataFrame, ranked: DataFrame) -> DataFrame:
        m = F.length("title")
        # Over all lengths that can reach the threshold; any similarity takes one letter.
        fewest = F.greatest(F.ceil(m * (need_low - 1) - 1e-9), F.lit(1))
        rarest = F.slice(F.col("tokens"), F.lit(1), (m + 1 - fewest).cast("int"))
        return materialize(side.join(ranked, "title").withColumn("rarest", rarest), "letters")

    ranked_l, ranked_r = _rank_tokens(titles_l, titles_r)

    # Years within the tolerance fall into one of two neighbouring bands; unknown years meet all.
    width = 2 * tolerance
    known, unknown = F.lit("y"), F.lit("any")

    def band(year: Column) -> Column:
        return F.concat(known, F.floor(year / width).cast("string"))

    year = F.col("year")
    left_bands = F.when(year.isNull(), F.array(unknown)).otherwise(F.array(band(year), F.lit("open")))
    right_bands = F.when(year.isNull(), F.array(unknown, F.lit("open"))).otherwise(
        F.array_distinct(F.array(band(year - tolerance), band(year + tolerance), unknown))
    )

    def postings(side: DataFrame, bands: Column, ranked: DataFrame) -> DataFrame:
        side = prepared(side.select("title", "author", F.explode(bands).alias("_band")).distinct(), ranked)
        start = F.when(F.length("title") >= 2, F.array(F.concat(F.lit("2:"), F.substring("title", 1, 2))))
        rare = F.transform("rarest", lambda t: F.concat(F.lit("r:"), t))
        blocks = F.concat(F.coalesce(start, F.array().cast("array<string>")), rare)
        out = side.withColumn("_block", F.explode(blocks))
        return out.withColumn("key", F.concat_ws("\u0004", "author", "_band", "_block")).drop("_band")

    same_start = F.coalesce(
        (F.length("l_title") >= 2) & (F.substring("l_title", 1, 2) == F.substring("r_title", 1, 2)), F.lit(False)
    )
    m, n = F.length("l_title"), F.length("r_title")
    common = F.size(F.array_intersect("l_tokens", "r_tokens"))
    reach = common / m + common / n + 1e-9
    by_start = F.col("l__block").startswith("2:") & (reach >= need_any)
    by_letter = (
        ~same_start
        & (F.col("l__block") == F.concat(F.lit("r:"), _first_shared()))
        & (reach >= need_low)
    )
    met = _tiled_join(postings(left, left_bands, ranked_l), postings(right, right_bands, ranked_r), by_start | by_letter)
    met = met.select("l_title", "r_title", F.col("l_author").alias("author")).distinct()
    met = materialize(met.repartition(_parts(left), "l_title", "r_title"), "title-pairs")
    scored = met.withColumn("score", jaro_winkler_score("l_title", "r_title")).filter(F.col("score") >= threshold)
    scored = materialize(scored, "similar-titles")
    books = left.select(F.col("title").alias("l_title"), "author", "year")
    films = right.select(F.col("title").alias("r_title"), "author", F.col("year").alias("_year"), "_id")
    near = F.col("year").isNull() | F.col("_year").isNull() | (F.abs(F.col("year") - F.col("_year")) <= tolerance)
    rows = scored.join(books, ["l_title", "author"]).join(films, ["r_title", "author"]).filter(near)
    return rows.select(F.col("l_title").alias("title"), "year", "author", "score", "_id")
