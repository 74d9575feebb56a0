"""Repeated passages and similar documents against brute force."""

import collections
import itertools
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from shelfmark import session
from shelfmark.llm import jaccard, passages, places
from shelfmark.llm.components import connected_components
from shelfmark.llm.jaccard import Similarity, one_of_each_group, similar_groups
from shelfmark.llm.passages import COVER, PERIOD, cut_repeated, remove_repeated

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_the_cover_holds_every_difference():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def cut(texts, width=35):
    words = [WORD.findall(t or "") for t in texts]
    counts = collections.Counter(tuple(w[j : j + width]) for w in words for j in range(len(w) - width + 1))
    out = []
    for w in words:
        gone = {q for j in range(len(w) - width + 1) if counts[tuple(w[j : j + width])] > 1 for q in range(j, j + width)}
        out.append((len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(2000)]
    shared = [[rng.choice(vocabulary) for _ in range(rng.choice([30, 34, 35, 36, 40, 60, 120]))] for _ in range(6)]
    texts = []
    for _ in range(50):
        words = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.5:
                words += rng.choice(shared)[rng.choice([0, 0, 3]) :]
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        texts.append(rng.choice([" ", "\n", "\t "]).join(words))
    return [*texts, "x " * 90, None, "", "x " * 20, texts[0], texts[0]]


@pytest.mark.parametrize("seed,gathered,size", [(1, 2_000_000, 4 << 20), (2, 500, 2000)])
def test_repeated_passages_equal_brute_force(spark, monkeypatch, seed, gathered, size):
    monkeypatch.setattr(places, "GATHERED", gathered)
    monkeypatch.setattr(places, "RANGE_BYTES", size)
    texts = corpus(seed)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in remove_repeated(rows).collect()}
    assert found == dict(enumerate(cut(texts)))


def test_ids_need_not_tell_rows_apart(spark):
    text = " ".join(f"w{k}" for k in range(50))
    rows = spark.createDataFrame([(1, text, "a"), (1, text, "b"), (None, "one  two", "c"), (None, None, None)], "doc_id long, text string, row string")
    assert sorted((r.n_words, r.n_removed) for r in remove_repeated(rows).collect()) == [(0, 0), (2, 0), (50, 50), (50, 50)]
    left = cut_repeated(rows)
    assert left.columns == rows.columns
    assert sorted(map(str, left.collect())) == sorted(
        ["Row(doc_id=1, text='', row='a')", "Row(doc_id=1, text='', row='b')", "Row(doc_id=None, text='one  two', row='c')", "Row(doc_id=None, text=None, row=None)"]
    )
    assert remove_repeated(rows.limit(0)).count() == 0 and cut_repeated(rows.limit(0)).count() == 0


def test_untouched_texts_keep_their_white_space(spark):
    texts = corpus(3)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {k: t if not gone else kept for k, (t, (_, gone, kept)) in enumerate(zip(texts, cut(texts)))}
    assert {r.doc_id: r.text for r in cut_repeated(rows).collect()} == want


def family(seed):
    rng = random.Random(seed)
    vocabulary, docs = [f"w{i}" for i in range(300)], []
    for _ in range(9):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 7, 12, 20, 30, 60, 150]))]
        for _ in range(rng.randint(1, 14)):
            words = list(docs[-1].split() if docs and rng.random() < 0.4 else base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
                place = rng.randrange(len(words)) if words else 0
                kind = rng.random()
                if kind < 0.5 and words:
                    words[place] = rng.choice(vocabulary)
                elif kind < 0.75 and words:
                    del words[place]
                else:
                    words.insert(place, rng.choice(vocabulary))
            docs.append(" ".join(words))
    return [*docs, "", None, "A b c", "a B  c\n"]


def groups(texts, kind):
    sets = []
    for text in texts:
        words = WORD.findall((text or "").lower())
        grams = {tuple(words[j : j + kind.words]) for j in range(len(words) - kind.words + 1)}
        sets.append(grams or ({tuple(words)} if words else set()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(sets)), 2):
        if sets[a] and sets[b] and kind.linked(len(sets[a] & sets[b]), len(sets[a]), len(sets[b])):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(s), root(k)) for k, s in enumerate(sets)}


@pytest.mark.parametrize(
    "seed,kind,paired,joined",
    [(1, Similarity(3, 90, 100), 64, 1024), (2, Similarity(), 2, 1024), (3, Similarity(3, 90, 100), 1, 1024), (4, Similarity(2, 7, 10), 1, 1024), (5, Similarity(2, 8, 10), 1, 2)],
)
def test_groups_equal_brute_force(spark, monkeypatch, seed, kind, paired, joined):
    monkeypatch.setattr(jaccard, "PAIRED", paired)
    monkeypatch.setattr(jaccard, "JOINED", joined)
    texts = family(seed)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(rows, kind).collect()} == groups(texts, kind)


@pytest.mark.parametrize("seed,kind,joined", [(2, Similarity(), 1024), (4, Similarity(2, 7, 10), 1024), (5, Similarity(2, 8, 10), 2)])
def test_groups_with_a_pivot_equal_brute_force(spark, monkeypatch, seed, kind, joined):
    monkeypatch.setattr(jaccard, "PAIRED", 1)
    monkeypatch.setattr(jaccard, "SEPARATED", 0)
    monkeypatch.setattr(jaccard, "JOINED", joined)
    texts = family(seed)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(rows, kind).collect()} == groups(texts, kind)


def test_texts_that_share_one_passage_get_no_pivot(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRED", 2)
    passage = " ".join(f"p{k}" for k in range(160))
    texts = [f"{passage} " + " ".join(f"d{n}w{k}" for k in range(120)) for n in range(60)]
    texts.append(texts[7] + " more")
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    tables, written = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda table: tables.append((table.columns, made := written(table), made.count())) or made)
    assert {r.doc_id: r.component_id for r in similar_groups(rows).collect()} == {**{n: n for n in range(60)}, 60: 7}
    stars = [n for columns, _, n in tables if columns == ["line", "pivot", "member"]]
    assert stars and sum(stars) == 0


def test_separated_sets_are_not_linked():
    import numpy as np

    rng = np.random.default_rng(3)
    for kind in (Similarity(3, 90, 100), Similarity(), Similarity(2, 3, 10)):
        sets = []
        for size in (1, 3, 20, 70, 130, 260, 600):
            base = rng.integers(0, 2**64, size, dtype=np.uint64)
            for lost in (0, 0, 1, size // 12, size // 5, size // 2, size):
                sets.append(np.unique(np.concatenate([rng.permutation(base)[lost:], rng.integers(0, 2**64, rng.integers(0, lost + 1), dtype=np.uint64)])))
        sets = [x for x in sets if len(x)]
        sketches = [b"" if k % 13 == 5 else jaccard.sketch_of(x) for k, x in enumerate(sets)]
        part = jaccard.separated(np.array([len(x) for x in sets]), sketches, kind)
        assert part.min() == 0 and (part.max() > 1 or kind.num < 5)
        for a, b in itertools.combinations(range(len(sets)), 2):
            if kind.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])):
                assert part[a] == part[b]


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    near = text + " more"
    rows = spark.createDataFrame(
        [(5, text, "x"), (5, text, "x"), (2, near, "y"), (None, "alone in here with null id", None), (7, "", "z"), (8, None, "z")], "doc_id long, text string, row string"
    )
    left = one_of_each_group(rows)
    assert left.columns == rows.columns and left.count() == 4
    assert left.filter("text LIKE 'w0%'").count() == 1 and left.filter("doc_id IS NULL").count() == 1
    assert one_of_each_group(rows.limit(0)).count() == 0 and similar_groups(rows.limit(0)).count() == 0


def test_index_keys_of_linked_sets_meet():
    import numpy as np

    rng = np.random.default_rng(4)
    for kind in (Similarity(3, 90, 100), Similarity(), Similarity(2, 7, 10)):
        for size in (2, 3, 5, 9, 14, 20, 33, 60, 150, 400, 900):
            for _ in range(12):
                base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
                lost = rng.integers(0, kind.difference(2 * size) + 1)
                other = np.unique(np.concatenate([rng.permutation(base)[lost // 2 :], rng.integers(0, 2**64, lost - lost // 2, dtype=np.uint64)]))
                if not kind.linked(len(np.intersect1d(base, other)), len(base), len(other)) or np.array_equal(base, other):
                    continue
                with np.errstate(over="ignore"):
                    keys = [set(np.concatenate([*jaccard.keys_of(x, kind), np.zeros(0, np.uint64)]).tolist()) for x in (base, other)]
                assert keys[0] & keys[1]


def test_texts_with_many_grams_of_their_own_are_not_compared(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"b{k}" for k in range(300)]
    texts = [" ".join(base), " ".join([*base, "more"])]
    for n in range(80):
        words = list(base)
        for k in rng.sample(range(300), 30):
            words[k] = f"n{n}k{k}"
        texts.append(" ".join(words))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    tables, written = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda table: tables.append((table.columns, made := written(table), made.count())) or made)
    assert {r.doc_id: r.component_id for r in similar_groups(rows).collect()} == {**{n: n for n in range(82)}, 1: 0}
    assert sum(n for columns, _, n in tables if "linked" in columns) == 1


@pytest.mark.parametrize("seed,kind,long", [(2, Similarity(), 1), (4, Similarity(2, 7, 10), 0), (6, Similarity(2, 6, 10), 0)])
def test_long_lines_are_settled_at_once(spark, monkeypatch, seed, kind, long):
    for name, value in {"PAIRED": 1, "SEPARATED": 0, "LONG": long}.items():
        monkeypatch.setattr(jaccard, name, value)
    tables, written = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda table: (tables.append(table.columns), written(table))[1])
    texts = family(seed)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(rows, kind).collect()} == groups(texts, kind)
    # no line is left for another level
    assert long or not any("is_a" in columns for columns in tables)


def test_members_of_a_pivot_are_tied():
    import numpy as np

    rng = np.random.default_rng(6)
    for kind in (Similarity(3, 90, 100), Similarity(), Similarity(2, 6, 10)):
        for _ in range(20):
            pivot = rng.integers(0, 2**63, 60)
            edits = [rng.integers(0, 2**63, 9) for _ in range(4)]
            sets = [np.unique(np.concatenate([rng.permutation(pivot)[rng.integers(0, 20) :], edits[rng.integers(4)][: rng.integers(0, 10)]])) for _ in range(25)]
            linked = np.array([kind.linked(len(np.intersect1d(x, pivot)), len(x), 60) for x in sets])
            near = jaccard.tied(linked, np.array([len(x) for x in sets]), [np.setxor1d(x, pivot) for x in sets], kind)

            def parts(edges, linked=linked):
                part = np.where(linked, -1, np.arange(25))
                for a, b in edges:
                    part[part == part[b]] = part[a]
                return {tuple(np.flatnonzero(part == k).tolist()) for k in part.tolist()}

            every = [(a, b) for a, b in itertools.combinations(range(25), 2) if kind.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))]
            assert set(near) <= {*every, *[(b, a) for a, b in every]} and parts(near) == parts(every)


def test_groups_of_the_same_members_keep_the_earliest_place(spark):
    rows = [(1, 10, 100, 80), (1, 11, 100, 125), (2, 10, 100, 125), (2, 11, 100, 80), (3, 12, 90, 90)]
    live = jaccard._live(spark.createDataFrame(rows, "key long, member long, size long, wide long"))
    assert sorted((r.member, r.size, r.wide, r.n, r.grams) for r in live.collect()) == [(10, 100, 125, 2, 200), (11, 100, 125, 2, 200)]
    assert [tuple(r) for r in jaccard._pairs(live).collect()] == [(10, 11)]


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (5, 4), (4, 4), (3, 1), (20, 21)] + [(100, k) for k in range(101, 130)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**dict.fromkeys([1, 2, 3], 1), **dict.fromkeys(range(4, 10), 4), 20: 20, 21: 20, **dict.fromkeys(range(100, 130), 100)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_the_anchor_needs_a_window_longer_than_the_period():
    with pytest.raises(ValueError):
        passages.anchor_width(20)


def test_differences_of_a_level_are_shuffled_once(spark):
    stars = spark.createDataFrame([(1, 5, k) for k in range(6, 30)], "line long, pivot long, member long")
    done = spark.createDataFrame(
        [(5, k, k % 2 == 0, 50, 3, [k, 77], [77]) for k in range(6, 30)],
        "pivot long, member long, linked boolean, size long, differ long, a array<long>, b array<long>",
    )
    info, following = jaccard._next(stars, done)
    assert info.count() == 24 and {r["member"] for r in following.collect()} == set(range(6, 30))
    plan = following._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan, plan


def test_tables_of_finished_steps_are_deleted(spark, monkeypatch):
    docs = spark.createDataFrame([(k, f"a b c d e f g h x{k}") for k in range(3)], "doc_id long, text string")
    gone, removed = [], jaccard.removed
    monkeypatch.setattr(jaccard, "removed", lambda table: (gone.append(table.columns), removed(table)))
    assert {r["component_id"] for r in similar_groups(docs, Similarity(words=1, num=6, den=10)).collect()} == {0}
    assert ["key", "doc"] in gone and ["pivot", "member"] in gone and ["rep", "body"] in gone


@pytest.mark.parametrize("kind,joined", [(Similarity(2, 7, 10), 1024), (Similarity(2, 8, 10), 2)])
def test_differences_in_several_parts_give_the_same_groups(spark, monkeypatch, kind, joined):
    monkeypatch.setattr(jaccard, "PAIRED", 1)
    monkeypatch.setattr(jaccard, "JOINED", joined)
    monkeypatch.setattr(jaccard, "PART_KEYS", 20)
    monkeypatch.setattr(jaccard, "PART_BYTES", 2000)
    tables, written = [], jaccard.written
    monkeypatch.setattr(jaccard, "written", lambda table: (tables.append(table.columns), written(table))[1])
    texts = family(7)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(rows, kind).collect()} == groups(texts, kind)
    assert sum("is_a" in columns for columns in tables) > 1
    # the differences are written where they are found, not a second time
    assert not any("line" in columns and "a" in columns for columns in tables)


def test_shuffle_files_of_a_written_table_are_deleted(spark):
    def stored():
        manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {str(f) for f in manager.getAllFiles().mkString("\n").split("\n") if "shuffle_" in str(f)}

    before = stored()
    places.written(spark.range(5000).groupBy((F.col("id") % 2500).alias("k")).count())
    for _ in range(50):
        if stored() <= before:
            break
        time.sleep(0.1)
    assert stored() <= before
    assert spark.conf.get(session.SHUFFLE_CLEANUP, "false") == "false"
