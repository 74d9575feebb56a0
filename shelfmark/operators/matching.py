"""Matching records that are spelled differently.

All pair searches run on distinct key texts inside a block, found by the edit-distance or containment joins,
never on rows against rows. The matching rule: the same title by another author is another book.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import author_key, product_key, product_title_key, series_word_key, word_key
from shelfmark.functions.nulls import col, present, to_number
from shelfmark.functions.similarity import key_similarity, similarity
from shelfmark.functions.titles import normalize_title
from shelfmark.operators.containment import touching_pairs
from shelfmark.operators.editjoin import edit_candidates, one_edit_pairs
from shelfmark.operators.groups import top_per_key
from shelfmark.operators.nearest import best_by_points
from shelfmark.session import cut_lineage

STRATEGIES = ("exact", "fuzzy_title", "core_title", "series")


def match_keys(df: DataFrame, row_id: str, title: str, author: str, series: str | None = None, number: str | None = None) -> DataFrame:
    """(id, standard, core, author, author_fuzzy, series, number): every key the strategies compare, once per row."""
    df = df.withColumn("__n", normalize_title(title))
    n = F.col("__n")
    given_series = F.lower(present(series)) if series else F.lit(None).cast("string")
    given_number = to_number(F.col(number).cast("string")) if number else F.lit(None).cast("double")
    return df.select(
        F.col(row_id).alias("id"),
        n["standard"].alias("standard"),
        n["core_title"].alias("core"),
        author_key(author).alias("author"),
        author_key(author, "fuzzy").alias("author_fuzzy"),
        F.coalesce(given_series, F.lower(n["series_name"])).alias("series"),
        F.coalesce(given_number, n["book_number"].try_cast("double")).alias("number"),
    )


def widest_share(threshold: float) -> float:
    """Largest edit-distance share of a pair whose similarity reaches the threshold.

    A pair with share d has an edit ratio of 1 - d and a matching-blocks ratio of at most 1 - d / 2 (common
    blocks form a common subsequence), so its similarity, the mean of both, is at most 1 - 0.75 d.
    """
    return round((1 - threshold) / 0.75, 6)


def similar_texts(left: DataFrame, left_text: str, right: DataFrame, right_text: str, threshold: float, block: Sequence[str] = (), share: float | None = None) -> DataFrame:
    """Distinct (block, left_text, right_text, sim) with similarity from the threshold on.

    Complete with the default share; a smaller share gives the pairs that are at most so far apart.
    """
    pairs = edit_candidates(left, left_text, right, right_text, share or widest_share(threshold), block)
    return pairs.withColumn("sim", similarity("left_text", "right_text")).filter(F.col("sim") >= threshold)


def _author_links(s: DataFrame, t: DataFrame, threshold: float) -> DataFrame:
    """(s_author, t_author) of equal or similar fuzzy author keys."""
    return similar_texts(s, "author_fuzzy", t, "author_fuzzy", threshold).select(
        F.col("left_text").alias("s_author"), F.col("right_text").alias("t_author")
    )


def _title_stage(s: DataFrame, t: DataFrame, links: DataFrame, column: str, threshold: float, strategy: str) -> DataFrame:
    wanted = (
        s.filter((F.length(column) > 0) & (F.length("author_fuzzy") > 0))
        .select(F.col("author_fuzzy").alias("s_author"), F.col(column).alias("s_title"))
        .distinct()
        .join(links, "s_author")
        .withColumnRenamed("t_author", "block")
    )
    offered = (
        t.filter(F.length(column) > 0)
        .groupBy(F.col("author_fuzzy").alias("block"), F.col(column).alias("t_title"))
        .agg(F.min("id").alias("match_id"))
    )
    best = _most_similar(wanted, offered, threshold)
    return s.join(best, (F.col("author_fuzzy") == F.col("s_author")) & (F.col(column) == F.col("s_title"))).select(
        "id", F.col("b.match_id").alias("match_id"), (-F.col("b.neg")).alias("confidence"), F.lit(strategy).alias("strategy")
    )


def _most_similar(wanted: DataFrame, offered: DataFrame, threshold: float) -> DataFrame:
    """(s_author, s_title, b): most similar offered title, lowest match_id on a tie.

    Searched in two rings: titles one edit apart, then the whole range. A title is settled in the first ring
    once its best match beats everything two edits apart (at most 1 - 1.5 / (length + 2)), so a block of many
    near-equal titles, such as numbered ones, is settled by its nearest neighbours and never compared as a
    whole.
    """

    def best_of(open_titles: DataFrame, pairs: DataFrame) -> DataFrame:
        named = pairs.withColumnsRenamed({"left_text": "s_title", "right_text": "t_title"})
        return cut_lineage(
            open_titles.join(named, ["block", "s_title"])
            .join(offered, ["block", "t_title"])
            .groupBy("s_author", "s_title")
            .agg(F.min(F.struct((-F.col("sim")).alias("neg"), "match_id")).alias("b"))
        )

    near = one_edit_pairs(wanted, "s_title", offered, "t_title", ["block"])
    near = near.withColumn("sim", similarity("left_text", "right_text")).filter(F.col("sim") >= threshold)
    settled = best_of(wanted, near).filter(-F.col("b.neg") > 1 - 1.5 / (F.length("s_title") + 2))
    rest = wanted.join(settled.select("s_author", "s_title"), ["s_author", "s_title"], "left_anti")
    return settled.union(best_of(rest, similar_texts(rest, "s_title", offered, "t_title", threshold, ["block"])))


def _series_stage(s: DataFrame, t: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    wanted = (
        s.filter(F.col("series").isNotNull() & F.col("number").isNotNull())
        .select(F.col("author_fuzzy").alias("s_author"), F.col("series").alias("s_series"), "number")
        .distinct()
        .join(links, "s_author")
        .withColumnRenamed("t_author", "block")
    )
    offered = (
        t.filter(F.col("series").isNotNull() & F.col("number").isNotNull())
        .groupBy(F.col("author_fuzzy").alias("block"), "number", F.col("series").alias("t_series"))
        .agg(F.min("id").alias("match_id"))
    )
    pairs = similar_texts(wanted, "s_series", offered, "t_series", threshold, ["block", "number"])
    best = (
        wanted.join(pairs.withColumnsRenamed({"left_text": "s_series", "right_text": "t_series"}), ["block", "number", "s_series"])
        .join(offered, ["block", "number", "t_series"])
        .groupBy("s_author", "s_series", "number")
        .agg(F.min(F.struct("match_id", "sim")).alias("b"))
        .withColumnRenamed("number", "s_number")
    )
    condition = (
        (F.col("author_fuzzy") == F.col("s_author")) & (F.col("series") == F.col("s_series")) & (F.col("number") == F.col("s_number"))
    )
    return s.join(best, condition).select(
        "id", F.col("b.match_id").alias("match_id"), F.col("b.sim").alias("confidence"), F.lit("series").alias("strategy")
    )


def cascade_match(
    search: DataFrame,
    target: DataFrame,
    strategies: Sequence[str] = STRATEGIES,
    title_threshold: float = 0.85,
    author_threshold: float = 0.90,
    series_threshold: float = 0.80,
) -> DataFrame:
    """(id, match_id, confidence, strategy) of every search row; NULL match when no strategy finds one.

    Both sides come from ``match_keys``; ids order the target. The first strategy in the list that finds a
    match is used; it takes the most similar target row, the lowest id on a tie (``series``: the lowest id).
    Runs jobs: the two key tables, the author links and the title searches are written once.
    """
    # the key tables are read by every strategy, so they are written once
    search, target = cut_lineage(search), cut_lineage(target)
    found = []
    open_rows = search
    if "exact" in strategies:
        keyed = (
            target.filter((F.length("standard") > 0) & (F.length("author") > 0))
            .groupBy(F.col("standard").alias("t_standard"), F.col("author").alias("t_author"))
            .agg(F.min("id").alias("match_id"))
        )
        exact = search.join(keyed, (F.col("standard") == F.col("t_standard")) & (F.col("author") == F.col("t_author")))
        exact = exact.select("id", "match_id", F.lit(1.0).alias("confidence"), F.lit("exact").alias("strategy"))
        found.append(exact)
        if strategies[0] == "exact":
            open_rows = search.join(exact.select("id"), "id", "left_anti")
    if set(strategies) - {"exact"}:
        links = cut_lineage(_author_links(open_rows, target, author_threshold))
        if "fuzzy_title" in strategies:
            found.append(_title_stage(open_rows, target, links, "standard", title_threshold, "fuzzy_title"))
        if "core_title" in strategies:
            found.append(_title_stage(open_rows, target, links, "core", title_threshold, "core_title"))
        if "series" in strategies:
            found.append(_series_stage(open_rows, target, links, series_threshold))
    every = found[0]
    for part in found[1:]:
        every = every.union(part)
    priority = F.array_position(F.array(*[F.lit(s) for s in strategies]), F.col("strategy"))
    best = every.groupBy("id").agg(
        F.min(F.struct(priority.alias("p"), (-F.col("confidence")).alias("c"), "match_id", "strategy")).alias("b")
    )
    return search.select("id").join(best, "id", "left").select(
        "id",
        F.col("b.match_id").alias("match_id"),
        F.coalesce(-F.col("b.c"), F.lit(0.0)).alias("confidence"),
        F.coalesce(F.col("b.strategy"), F.lit("none")).alias("strategy"),
    )


def is_blank(name: str, dtype: str) -> Column:
    """NULL, the empty text or 0."""
    c = F.col(name)
    if dtype == "string":
        return c.isNull() | (F.trim(c) == "")
    if dtype in ("int", "bigint", "double", "float", "smallint", "tinyint") or dtype.startswith("decimal"):
        return c.isNull() | (c == 0)
    return c.isNull()


def merge_fill(
    target: DataFrame, source: DataFrame, matches: DataFrame, row_id: str, columns: Sequence[str], order: str, same: Sequence[Column] = (), update_existing: bool = True, add_new: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(merged, counts): blank target cells filled from the matching source rows, unmatched rows appended.

    ``matches``: (id, match_id) of the source rows. Several source rows for one target row fill in their order, cell by cell.
    ``same`` are keys of the source rows: unmatched rows that agree in all of them are one book, so the first in the order is
    appended, and the others match it and fill its blank cells; rows with a NULL or empty key are books of their own. Without
    ``update_existing`` no cell is filled, without ``add_new`` unmatched rows are skipped. Counts: matched (rows), updated (cells),
    added, skipped.
    """
    types = dict(target.dtypes)
    zero = F.lit(0).cast("long")
    hits = matches.filter("match_id IS NOT NULL").select(F.col("id").alias(row_id), "match_id")
    matched = source.join(hits, row_id)
    unmatched = source.join(hits.select(row_id), row_id, "left_anti")

    def fill(base: DataFrame, rows: DataFrame) -> DataFrame:
        """The base rows with ``__rows`` and ``__cells``: matching rows and filled cells."""
        filled = rows.groupBy("match_id").agg(
            F.count(F.lit(1)).alias("__rows"), *[F.min_by(c, F.when(~is_blank(c, types[c]), F.col(order))).alias(f"__{c}") for c in columns]
        )
        joined = base.join(filled, F.col(row_id) == F.col("match_id"), "left")
        use = {c: F.lit(update_existing) & is_blank(c, types[c]) & F.col(f"__{c}").isNotNull() for c in columns}
        cells = sum((u.cast("long") for u in use.values()), zero)
        out = joined.withColumn("__cells", cells).withColumn("__rows", F.coalesce("__rows", zero))
        return out.withColumns({c: F.when(u, F.col(f"__{c}")).otherwise(F.col(c)) for c, u in use.items()}).select(*base.columns, "__rows", "__cells")

    merged = fill(target, matched)
    tally = merged.select(F.col("__rows").alias("m"), F.col("__cells").alias("u"), zero.alias("a"), zero.alias("s"))
    out = merged.drop("__rows", "__cells")
    if add_new:
        added = unmatched.withColumns({"__rows": zero, "__cells": zero})
        if same:
            names = [f"__s{k}" for k in range(len(same))]
            known = F.lit(True)
            for n in names:
                known = known & F.col(n).isNotNull() & (F.col(n).cast("string") != "")
            # a row without a key is told apart by its id
            alone = F.when(~known, F.col(row_id).cast("string"))
            keyed = unmatched.withColumns(dict(zip(names, same))).withColumns({"__own": alone, **{n: F.when(known, F.col(n)) for n in names}})
            heads = keyed.groupBy(*names, "__own").agg(F.min(F.struct(F.col(order).alias("o"), F.col(row_id).alias("i"))).alias("h"))
            pairs = heads.select(*[F.col(n).alias(f"{n}h") for n in names], F.col("__own").alias("__ownh"), F.col("h.i").alias("match_id"))
            condition = F.col("__own").eqNullSafe(F.col("__ownh"))
            for n in names:
                condition = condition & F.col(n).eqNullSafe(F.col(f"{n}h"))
            placed = keyed.join(pairs, condition).select(*source.columns, "match_id")
            first = placed.filter(F.col(row_id) == F.col("match_id")).select(*source.columns)
            added = fill(first, placed.filter(F.col(row_id) != F.col("match_id")))
        tally = tally.union(added.select("__rows", "__cells", F.lit(1).cast("long"), zero))
        out = out.unionByName(added.select(*[c for c in source.columns if c in target.columns]), allowMissingColumns=True)
    else:
        tally = tally.union(unmatched.select(zero, zero, zero, F.lit(1).cast("long")))
    counts = tally.agg(*[F.coalesce(F.sum(c), zero).alias(n) for c, n in (("m", "matched"), ("u", "updated"), ("a", "added"), ("s", "skipped"))])
    return out, counts


def lineage_match(df: DataFrame, supports: Sequence[tuple[str, DataFrame]], author: str, series: str, first_book: str, columns: Sequence[str]) -> DataFrame:
    """Blank columns filled from the first support table that has the row exactly once.

    Per table the key is (author, series), then (author, first book). ``lineage_source`` and
    ``lineage_match`` record where the values came from.
    """
    a, s, f = word_key(author), word_key(series), word_key(first_book)
    out = df.withColumns({"__a": a, "__s": s, "__f": f})
    candidates = []
    for i, (name, table) in enumerate(supports):
        row = F.struct(*[F.col(c) for c in columns])
        for j, (kind, key, own) in enumerate((("author+series", series, "__s"), ("author+first-book", first_book, "__f"))):
            tag = f"__m{i}{j}"
            unique = (
                table.select(word_key(author).alias(f"{tag}a"), word_key(key).alias(f"{tag}k"), row.alias("r"))
                .filter((F.col(f"{tag}a") != "") & (F.col(f"{tag}k") != ""))
                .groupBy(f"{tag}a", f"{tag}k")
                .agg(F.count(F.lit(1)).alias("n"), F.any_value("r").alias(tag))
                .filter("n = 1")
                .drop("n")
            )
            out = out.join(unique, (F.col("__a") == F.col(f"{tag}a")) & (F.col(own) == F.col(f"{tag}k")), "left")
            candidates.append((F.col(tag), name, kind))
    chosen = F.coalesce(
        *[F.when(c.isNotNull(), F.struct(F.lit(n).alias("source"), F.lit(k).alias("kind"), c.alias("r"))) for c, n, k in candidates]
    )
    out = out.withColumn("__c", chosen)
    types = dict(df.dtypes)
    changed = {c: F.when(is_blank(c, types[c]), F.col(f"__c.r.{c}")).otherwise(F.col(c)) for c in columns}
    return out.withColumns({**changed, "lineage_source": F.col("__c.source"), "lineage_match": F.col("__c.kind")}).select(
        *df.columns, "lineage_source", "lineage_match"
    )


def local_series_match(rows: DataFrame, books: DataFrame, row_id: str, author: str, series: str, first_book: str) -> DataFrame:
    """(row_id, match_series, reason): series of the catalogue that a row belongs to, by four steps.

    ``books``: author, series, title, book_order. Steps: the first book is a book of the author; the author
    has that series; the series name is a book of the author; the most similar series of the author, from a
    similarity of 0.78 on. Runs jobs.
    """
    # the keys are read by every step, so they are computed once and written
    keyed = rows.select(
        F.col(row_id).alias("rid"),
        series_word_key(author).alias("a"),
        series_word_key(series).alias("s"),
        series_word_key(first_book).alias("f"),
    )
    offers = books.select(
        series_word_key("author").alias("ba"), series_word_key("series").alias("bs"), series_word_key("title").alias("bt"), "book_order"
    )
    r, b = cut_lineage(keyed), cut_lineage(offers)
    by_book = b.groupBy("ba", "bt").agg(F.max_by("bs", "book_order").alias("bs"))
    known = b.groupBy("ba", "bs").agg(F.min("book_order").alias("o"))

    def hit(frame: DataFrame, column: Column, step: int, reason: str) -> DataFrame:
        return frame.select("rid", F.lit(step).alias("step"), F.lit(0.0).alias("neg"), F.lit(0).cast("long").alias("o"), column.alias("match"), F.lit(reason).alias("reason"))

    first = hit(r.filter("f <> ''").join(by_book, (F.col("a") == F.col("ba")) & (F.col("f") == F.col("bt"))), F.col("bs"), 1, "local-first-book")
    same = hit(r.join(known, (F.col("a") == F.col("ba")) & (F.col("s") == F.col("bs"))), F.col("bs"), 2, "local-series")
    is_book = hit(r.join(by_book, (F.col("a") == F.col("ba")) & (F.col("s") == F.col("bt"))), F.col("bs"), 3, "local-series-is-book")

    settled = first.union(same).union(is_book)
    unsettled = r.join(settled.select("rid").distinct(), "rid", "left_anti")
    spelled = unsettled.select("rid", "a", F.explode(F.array("s", "f")).alias("w")).filter("w <> ''")
    offered = known.select(F.col("ba").alias("a"), F.col("bs").alias("w2")).filter("w2 <> ''")
    near = edit_candidates(spelled, "w", offered, "w2", 0.44, ["a"]).union(touching_pairs(spelled, "w", offered, "w2", ["a"])).distinct()
    scored = near.withColumn("sim", key_similarity(F.col("left_text"), F.col("right_text"))).filter("sim >= 0.78")
    # the best series of a text is the same for every row that holds it, so it is chosen before rows are joined
    chosen = (
        scored.join(known, (F.col("a") == F.col("ba")) & (F.col("right_text") == F.col("bs")))
        .groupBy("a", F.col("left_text").alias("w"))
        .agg(F.min(F.struct((-F.col("sim")).alias("neg"), F.col("o").cast("long").alias("o"), F.col("bs").alias("match"))).alias("c"))
    )
    close = spelled.join(chosen, ["a", "w"]).select("rid", F.lit(4).alias("step"), "c.neg", "c.o", "c.match", F.lit("local-fuzzy").alias("reason"))
    best = settled.union(close).groupBy("rid").agg(F.min(F.struct("step", "neg", "o", "match", "reason")).alias("b"))
    return r.select("rid").join(best, "rid", "left").select(
        F.col("rid").alias(row_id), F.col("b.match").alias("match_series"), F.col("b.reason").alias("reason")
    )


def author_correction(rows: DataFrame, books: DataFrame, row_id: str, author: str, series: str, first_book: str) -> DataFrame:
    """(row_id, proposed_author, reason, points) for rows whose author may be wrong.

    A book with the row's first title by any author: 4 title + 2.5 series + 1 author similarity, from 5 on.
    Else a series: 3 series + best title of its first three books + 0.5 author similarity, from 3.4 on, searched completely
    (``nearest``). Runs jobs.
    """
    r = rows.select(
        F.col(row_id).alias("rid"), series_word_key(author).alias("a"), series_word_key(series).alias("s"), series_word_key(first_book).alias("f")
    )
    b = books.select(
        F.col("author").alias("name"), series_word_key("author").alias("ba"), series_word_key("series").alias("bs"),
        series_word_key("title").alias("bt"), "book_order",
    )
    b = cut_lineage(b)
    # equal titles have similarity 1, so the points start at 4; copies of a book count once
    distinct_books = b.filter("bt <> ''").groupBy("ba", "bs", "bt").agg(F.min(F.struct("book_order", "name")).alias("n"))
    asked = cut_lineage(r.select("a", "s", "f").distinct())

    def by_title(open_rows: DataFrame, condition: Column, series_part: Column) -> DataFrame:
        return (
            open_rows.join(distinct_books, condition)
            .withColumn("points", 4.0 + series_part + key_similarity(F.col("ba"), F.col("a")))
            .filter("points >= 5.0")
            .groupBy("a", "s", "f")
            .agg(F.min(F.struct((-F.col("points")).alias("neg"), F.col("n.book_order").alias("o"), F.col("n.name").alias("name"))).alias("b1"))
        )

    # a book of the same series too gives more than any other book from 7.25 on, so a title that many books share is
    # compared with all of them only where this leaves a row open
    same = cut_lineage(by_title(asked, (F.col("f") == F.col("bt")) & (F.col("s") == F.col("bs")), F.when(F.col("s") == "", 0.0).otherwise(2.5)).filter("b1.neg < -7.25"))
    others = asked.join(same, ["a", "s", "f"], "left_anti")
    first = cut_lineage(same.union(by_title(others, F.col("f") == F.col("bt"), 2.5 * key_similarity(F.col("bs"), F.col("s")))))
    titled = top_per_key(b, ["ba", "bs"], [F.col("book_order")], 3)
    series_rows = titled.groupBy("ba", "bs").agg(
        F.min(F.struct("book_order", "name")).alias("n"), F.array_sort(F.collect_list(F.struct("book_order", "bt"))).alias("ts")
    )
    left_over = asked.join(first, ["a", "s", "f"], "left_anti")
    offered = series_rows.select("ba", "bs", F.col("ts.bt").alias("ts"), F.col("n.book_order").cast("long").alias("book_order"), F.col("n.name").alias("name"))
    second = best_by_points(left_over, offered, (3.0, 1.0, 0.5), 3.4).select("a", "s", "f", F.struct((-F.col("points")).alias("neg"), "name").alias("b2"))
    return r.join(first, ["a", "s", "f"], "left").join(second, ["a", "s", "f"], "left").select(
        F.col("rid").alias(row_id),
        F.coalesce("b1.name", "b2.name").alias("proposed_author"),
        F.when(F.col("b1").isNotNull(), F.lit("local-first-book-any-author"))
        .when(F.col("b2").isNotNull(), F.lit("local-series-any-author"))
        .alias("reason"),
        F.round(-F.coalesce("b1.neg", "b2.neg"), 6).alias("points"),
    )


def choose_search_result(requests: DataFrame, results: DataFrame, request_id: str, least: float = 4.5) -> DataFrame:
    """Best result row per request by weighted similarity, none below ``least`` points.

    ``requests``: request_id, author, title, series. ``results``: request_id, result_order, author, title,
    title_base. Points: 5 for an equal author, else twice the author similarity; 3 title; 1.5 series.
    """
    q = requests.select(
        request_id, series_word_key("author").alias("qa"), series_word_key("title").alias("qt"), series_word_key("series").alias("qs")
    )
    keyed = results.withColumns({"ka": series_word_key("author"), "kt": series_word_key("title_base"), "ks": series_word_key("title")})
    joined = keyed.join(q, request_id)
    points = (
        F.when(F.col("ka") == F.col("qa"), 5.0).otherwise(2.0 * key_similarity(F.col("ka"), F.col("qa")))
        + 3.0 * key_similarity(F.col("kt"), F.col("qt"))
        + 1.5 * key_similarity(F.col("ks"), F.col("qs"))
    )
    scored = joined.withColumn("points", points).filter(F.col("points") >= least).drop("qa", "qt", "qs", "ka", "kt", "ks")
    return top_per_key(scored, [request_id], [F.col("points").desc(), F.col("result_order")])


def product_match(query_title, product_title, expected_author, product_author, series) -> Column:
    """STRUCT(score, confidence, notes) of a shop product against the wanted title and author."""
    q, p, s = product_title_key(query_title), product_title_key(product_title), product_title_key(series)
    want, got = product_key(expected_author), product_key(product_author)
    title = (
        F.when((q != "") & (p == q), F.struct(F.lit(60).alias("n"), F.lit("exact_title").alias("t")))
        .when((q != "") & p.contains(q), F.struct(F.lit(45).alias("n"), F.lit("title_contains").alias("t")))
        .when((s != "") & p.startswith(s), F.struct(F.lit(25).alias("n"), F.lit("series_prefix").alias("t")))
        .otherwise(F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("t")))
    )
    both = (want != "") & (got != "")
    author = (
        F.when(both & (want == got), F.struct(F.lit(40).alias("n"), F.lit("exact_author").alias("t")))
        .when(both & (got.contains(want) | want.contains(got)), F.struct(F.lit(25).alias("n"), F.lit("partial_author").alias("t")))
        .when(both, F.struct(F.lit(-25).alias("n"), F.lit("author_mismatch").alias("t")))
        .otherwise(F.struct(F.lit(0).alias("n"), F.lit(None).cast("string").alias("t")))
    )
    score = title["n"] + author["n"]
    return F.struct(
        score.alias("score"),
        F.when(score >= 95, F.lit("high")).when(score >= 70, F.lit("medium")).otherwise(F.lit("low")).alias("confidence"),
        F.concat_ws(",", title["t"], author["t"]).alias("notes"),
    )


def record_points(pages, rating_count, number, source, source_points: dict[str, int]) -> Column:
    """Quality points of a catalogue record: pages 3, ratings 2, book number 2, plus its source."""
    out = (
        F.when(F.coalesce(col(pages), F.lit(0)) != 0, 3).otherwise(0)
        + F.when(F.coalesce(col(rating_count), F.lit(0)) != 0, 2).otherwise(0)
        + F.when(col(number).isNotNull(), 2).otherwise(0)
    )
    for name, points in source_points.items():
        out = out + F.when(col(source) == name, points).otherwise(0)
    return out


def best_record(records: DataFrame, link_id: Column, title: str, author: str, points: Column, order: Sequence[Column]) -> DataFrame:
    """Record with the most points per catalogue id, or per (title, author) without an id."""
    key = F.coalesce(link_id, F.concat(series_word_key(title), F.lit("|"), series_word_key(author)))
    return top_per_key(records, [key], [points.desc(), *order])
