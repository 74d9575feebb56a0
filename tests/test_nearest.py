"""The weighted best partner against comparing everything with everything."""

import random
from difflib import SequenceMatcher

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfmark.functions import common
from shelfmark.operators import nearest
from shelfmark.operators.nearest import Side, best_by_points, best_in_tile

TEXT = st.text(alphabet="abcé 中", max_size=70)


def sim(a, b):
    return 0.0 if not a or not b else 1.0 if a == b else 0.9 if a in b or b in a else SequenceMatcher(None, a, b).ratio()


def longest(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for k, y in enumerate(b, 1):
            last, row[k] = row[k], last + 1 if x == y else max(row[k], row[k - 1])
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=5))
def test_bounds_are_never_below_the_similarity(pairs):
    left, right = map(list, zip(*pairs))
    alphabet = common.alphabet_of(left, right)
    a, b = common.Texts(left, alphabet), common.Texts(right, alphabet)
    bags = np.matmul(*(x if k == 0 else x.T for k, x in enumerate(common.unary(a.counts(), b.counts()))))
    wide = common.bound(bags, a.lengths, b.lengths)
    for k, (x, y) in enumerate(pairs):
        assert wide[k, k] >= sim(x, y) - 1e-6
        if max(len(x), len(y)) <= common.WORD:
            found = common.subsequences(a.matches(), b.codes(), a.lengths, np.array([k]), np.array([k]))
            assert found[0] == longest(x, y) <= bags[k, k]
            assert common.bound(found, a.lengths[[k]], b.lengths[[k]])[0] >= sim(x, y) - 1e-9
        assert common.exact(x, y) == sim(x, y)


def invented(rng, n):
    syllables = "ka ro mi ten sal vor el an dri qu zo ne ba th or lin gar fe du os".split()
    name = lambda: " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(1, 4)))

    def bent(x):
        for _ in range(rng.randint(0, 6)):
            k = rng.randrange(len(x) + 1)
            x = rng.choice([x[:k] + rng.choice("aeiou rst") + x[k:], x[:k] + x[k + 1 :]])
        return x

    shelf = [(name(), name(), [name() for _ in range(rng.choice([1, 2, 3]))], k // 2, f"name {k}") for k in range(n)]
    shelf[3] = (shelf[3][0], "", ["", None], 9, "empty")
    asked = []
    for _ in range(n):
        author, series, titles, _, _ = rng.choice(shelf)
        asked.append(rng.choice([(bent(author), bent(series), bent(rng.choice(titles) or "x")), (bent(author), series[:4], rng.choice(titles) or ""), (name(), name(), name())]))
    return sorted(set(asked)), shelf


@pytest.mark.parametrize("seed,tile,strip,pairs", [(1, 16384, 512, 500_000), (2, 40, 7, 50)])
def test_best_partner_equals_brute_force(spark, monkeypatch, seed, tile, strip, pairs):
    monkeypatch.setattr(nearest, "TILE", tile)
    monkeypatch.setattr(nearest, "STRIP", strip)
    monkeypatch.setattr(nearest, "PAIRS", pairs)
    asked, shelf = invented(random.Random(seed), 160)
    asked += [("", "", ""), ("a" * 80, "b" * 90, "c" * 70)]
    shelf += [("a" * 80, "b" * 89, ["c" * 66], 500, "long")]
    found = best_by_points(
        spark.createDataFrame(asked, "a string, s string, f string"),
        spark.createDataFrame(shelf, "ba string, bs string, ts array<string>, book_order long, name string"),
        (3.0, 1.0, 0.5), 3.4,
    ).collect()
    want = {}
    for a, s, f in asked:
        best = min((-(3 * sim(bs, s) + max(sim(t or "", f) for t in ts) + 0.5 * sim(ba, a)), o, name) for ba, bs, ts, o, name in shelf)
        if best[0] <= -3.4:
            want[a, s, f] = (pytest.approx(-best[0]), best[1], best[2])
    assert {(r.a, r.s, r.f): (r.points, r.book_order, r.name) for r in found} == want and len(found) == len(want) > 30


def test_few_pairs_need_the_exact_ratio():
    asked, shelf = invented(random.Random(3), 1500)
    titles = [[t or "" for t in ts] + [""] * (3 - len(ts)) for _, _, ts, _, _ in shelf]
    alphabet = common.alphabet_of(*map(list, zip(*asked)), [x[0] for x in shelf], [x[1] for x in shelf], *titles)
    left = Side([x[1] for x in asked], [[x[2]] for x in asked], [x[0] for x in asked], alphabet)
    right = Side([x[1] for x in shelf], titles, [x[0] for x in shelf], alphabet)
    _, decided = best_in_tile(left, right, list(range(len(shelf))), (3.0, 1.0, 0.5), 3.4)
    assert decided < 0.01 * len(asked) * len(shelf)


def test_empty_tables(spark):
    asked = spark.createDataFrame([("a", "b", "c")], "a string, s string, f string")
    shelf = spark.createDataFrame([("a", "b", ["c"], 1, "n")], "ba string, bs string, ts array<string>, book_order long, name string")
    assert best_by_points(asked, shelf.limit(0), (3.0, 1.0, 0.5), 3.4).count() == 0
    assert best_by_points(asked.limit(0), shelf, (3.0, 1.0, 0.5), 3.4).count() == 0
    assert best_by_points(asked, shelf, (3.0, 1.0, 0.5), 3.4).first().points == 4.5
