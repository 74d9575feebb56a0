"""Filter orders against running the filters one after the other."""

import itertools
import random
import re
from collections import Counter

import pytest

from shelfmark.llm.audit import Diagram, audit_filters, audit_masks, order_steps, plain_changes

NAMES = "ABCDE"


@pytest.mark.parametrize("n", range(1, 7))
def test_plain_changes_reach_every_order(n):
    order, seen = list(range(n)), {tuple(range(n))}
    for k in plain_changes(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.add(tuple(order))
    assert seen == set(itertools.permutations(range(n))) and len(list(plain_changes(n))) == len(seen) - 1


@pytest.mark.parametrize("seed", range(4))
def test_swaps_keep_the_counts_of_every_mask(seed):
    rng = random.Random(seed)
    counts = {m: (rng.choice([0, 0, 1, 5]), 0, 0) for m in range(32)}
    diagram = Diagram(NAMES, counts)
    for level in plain_changes(5):
        diagram.swap(level)
        for m in range(32):
            node = diagram.root
            for name in diagram.order:
                node = diagram.children[node][m >> NAMES.index(name) & 1]
            assert diagram.weights[node] == counts[m]
    assert diagram.weights[diagram.root] == tuple(map(sum, zip(*counts.values())))


def test_equal_parts_of_a_diagram_are_one_node():
    diagram = Diagram(NAMES, {m: (1, 0, 0) for m in range(32)})
    assert len(diagram.weights) == 6  # one node for each level and one leaf


def run_filters(docs, names):
    """docs: (set of failed filters, good, toxic)."""
    rows, shapley = {}, Counter()
    for order in itertools.permutations(names):
        left = docs
        for step, name in enumerate(order, 1):
            gone = [d for d in left if name in d[0]]
            left = [d for d in left if name not in d[0]]
            fails = sum(name in d[0] for d in docs)
            rows["".join(order), step] = [len(left), len(gone), fails - len(gone), sum(d[0] == {name} for d in docs), sum(d[1] for d in gone), sum(d[2] for d in gone)]
            shapley[name] += len(gone)
    return {(order, step): (*row, shapley[order[step - 1]]) for (order, step), row in rows.items()}


@pytest.mark.parametrize("names", ["A", "AB", "XYZ", NAMES])
def test_orders_equal_running_the_filters(names):
    rng = random.Random(len(names))
    docs = [({x for x in names if rng.random() < 0.4}, rng.randint(0, 1), rng.randint(0, 1)) for _ in range(60)]
    counts = {}
    for failed, good, toxic in docs:
        m = sum(1 << k for k, x in enumerate(names) if x in failed)
        n, g, t = counts.get(m, (0, 0, 0))
        counts[m] = (n + 1, g + good, t + toxic)
    assert {(o, s): tuple(rest) for o, s, *rest in order_steps(list(names), counts)} == run_filters(docs, names)


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def failed(text, id, all):
    text = text or ""
    words = WORD.findall(text)
    out = set()
    if len(words) < 200:
        out.add("A")
    if 100 * len(set(words)) < 50 * len(words):
        out.add("B")
    if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
        out.add("C")
    if re.search(r"[#$%&*|]", text):
        out.add("D")
    if id is not None and any(other is not None and other < id and (body or "") == text for other, body in all):
        out.add("E")
    return out


def test_whole_audit_equals_brute_force(spark):
    rng = random.Random(3)
    some = lambda n, k: " ".join(rng.choice(["é", "x", "Y", "zz"]) + str(rng.randrange(k)) for _ in range(n))
    texts = [None, "", "A", "a|b", "\x85 é　x", some(199, 900), some(200, 900), some(250, 5), some(400, 90), "#" + some(300, 900), "ab " * 5000, "  \n"]
    rows = []
    for k in range(90):
        rows.append((k, rng.choice(texts), rng.choice(["s0", "s0", "s1", "", None]), "own"))
    rows += [(5, rows[5][1], "s1", None), (5, rows[5][1], "s0", None), (None, rows[3][1], "s0", None), (None, rows[3][1], "s0", None), (None, None, None, None)]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None]), "x") for k in range(0, 95, 2)] + [(4, 1, 1, "y"), (4, 0, 0, "y"), (None, 1, 1, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, mask string").repartition(3)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int, source string")
    every = [(r[0], r[1]) for r in rows]
    good, toxic = {r[0] for r in labels if r[1] == 1} - {None}, {r[0] for r in labels if r[2] == 1} - {None}
    want = {}
    for part in {r[2] or "" for r in rows}:
        own = [(failed(r[1], r[0], every), r[0] in good, r[0] in toxic) for r in rows if (r[2] or "") == part]
        want |= {(part, *key): value for key, value in run_filters(own, NAMES).items()}
    out = audit_filters(docs, known)
    assert out.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r)[:3]: tuple(r)[3:] for r in out.collect()} == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(docs.limit(0), labels).count() == 0
    assert {r.filter_order: r.good_lost for r in audit_filters(docs, labels).filter("step = 1").collect()} == {"".join(p): 0 for p in itertools.permutations(NAMES)}


def test_filters_are_few_and_told_apart(spark):
    counts = spark.createDataFrame([], "part string, mask int, n long, good long, toxic long")
    for names in ([], ["AB"], ["A", "A"], list("ABCDEFGH")):
        with pytest.raises(ValueError):
            audit_masks(counts, names)


def test_the_smallest_id_of_a_text_is_found_before_the_shuffle(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    plan = audit_filters(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
