"""Benchmark passages against brute force over word lists."""

import random
import re

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import decontamination
from shelfmark.llm.decontamination import build_index, find_contamination, find_phrases

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def windows(text, width=10):
    own = words(text)
    size = min(len(own), width)
    return [(k, tuple(own[k : k + size])) for k in range(len(own) - size + 1)] if own else []


def brute(texts, items, width=10):
    out = []
    for text in texts:
        own, hit, names = words(text), set(), set()
        for name, body in items:
            for _, window in windows(body, width):
                size = len(window)
                for s in range(len(own) - size + 1):
                    if tuple(own[s : s + size]) == window:
                        hit.update(range(s, s + size))
                        names.add("" if name is None else str(name))
        out.append((len(own), sorted(hit), sorted(names)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(25)] + ["É", "中文", "ÀB"]
    run = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(k, " ".join(run(rng.choice([1, 3, 9, 10, 11, 14, 30])))) for k in range(12)]
    items += [(90, items[0][1]), (91, None), (92, " ... "), (7, "w1-w2, W3!"), (None, "zz yy xx"), (10, items[6][1])]
    texts = []
    for _ in range(40):
        body = run(rng.randint(0, 60))
        for _ in range(rng.choice([0, 0, 1, 2])):
            copied = (rng.choice(items)[1] or "").split()
            begin = rng.randint(0, max(0, len(copied) - 10))
            body[rng.randint(0, len(body)) : 0] = [x.upper() if x.isascii() else x for x in copied[begin:]]
        texts.append(rng.choice([" ", "\n", ", ", "_"]).join(body))
    return [*texts, None, "", "!!", "zz  yy\txx", texts[0], " ".join(["w1"] * 400)], items


@pytest.mark.parametrize("seed,segment,group,candidates", [(1, 300_000, 500_000, 1_000_000), (2, 60, 25, 7), (3, 1, 1, 1)])
def test_hits_equal_brute_force(spark, monkeypatch, seed, segment, group, candidates):
    monkeypatch.setattr(decontamination, "SEGMENT", segment)
    monkeypatch.setattr(decontamination, "GROUP_WORDS", group)
    monkeypatch.setattr(decontamination, "CANDIDATES", candidates)
    texts, items = corpus(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.doc_id: (r.n_words, [k for x in r.spans for k in range(x.begin, x.end)], r["items"], r.n_hit) for r in find_contamination(docs, bench).collect()}
    want = brute(texts, items)
    assert {k: v[:3] for k, v in found.items()} == dict(enumerate(want))
    assert all(v[3] == len(v[1]) for v in found.values())


def phrases(texts, items, width, slop):
    """(document, item, window, start) where every word of the window lies within the slop of its place."""
    out = set()
    for d, text in enumerate(texts):
        own = words(text)
        for name, body in items:
            for k, window in windows(body, width):
                for s in range(-slop, len(own) + slop):
                    near = [[s + j + x for x in range(-slop, slop + 1) if 0 <= s + j + x < len(own) and own[s + j + x] == w] for j, w in enumerate(window)]
                    if all(near):
                        out.add((d, "" if name is None else str(name), k, s))
    return out


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_phrase_and_proximity_matches_equal_brute_force(spark, monkeypatch, slop):
    monkeypatch.setattr(decontamination, "SEGMENT", 100)
    monkeypatch.setattr(decontamination, "GROUP_WORDS", 30)
    monkeypatch.setattr(decontamination, "CANDIDATES", 50)
    texts, items = corpus(5)
    texts, items = texts[:14] + ["w1 w2 x w3 w4 w5", "w5 w4 w3 w2 w1"], items[:6] + [(50, "w1 w2 w3 w4 w5")]
    index = build_index(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2))
    rows = find_phrases(index, spark.createDataFrame(items, "item_id long, text string"), width=5, slop=slop).collect()
    want = phrases(texts, items, 5, slop)
    bodies = {(str(name), k): w for name, body in items for k, w in windows(body, 5)}
    # runs of neighbouring starts as (begin, end) of the words within reach
    runs = set()
    for d, name, k, s in want:
        if slop and (d, name, k, s - 1) in want:
            continue
        last = s
        while slop and (d, name, k, last + 1) in want:
            last += 1
        own, body = words(texts[d]), bodies[name, k]
        exact = any(tuple(own[x : x + len(body)]) == body for x in range(max(s, 0), last + 1))
        runs.add((d, name, k, max(0, s - slop), min(len(own), last + len(body) + slop), exact))
    assert {(r.id, r.item, r.window, r.begin, r.end, r.exact) for r in rows} == runs and len(rows) == len(runs)


def test_rows_need_no_ids_and_tables_may_be_empty(spark):
    text = "a b c d e f g h i j k"
    docs = spark.createDataFrame([(1, text, 5), (1, text, 6), (None, text, 7), (None, None, None)], "doc_id long, text string, n_words int")
    bench = spark.createDataFrame([("q", "b c d e f g h i j k", 1)], "item_id string, text string, doc_id int")
    rows = find_contamination(docs, bench).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r["items"]) for r in rows) == [("1", 11, 10, ["q"]), ("1", 11, 10, ["q"]), ("None", 0, 0, []), ("None", 11, 10, ["q"])]
    assert [r.n_hit for r in find_contamination(docs, bench.limit(0)).collect()] == [0] * 4
    assert find_contamination(docs.limit(0), bench).count() == 0
    assert find_phrases(build_index(docs), bench.limit(0)).count() == 0


def test_one_very_long_text_and_ties(spark):
    rng = random.Random(9)
    body = [f"t{rng.randrange(5000)}" for _ in range(300_000)]
    body[123_456:123_456] = body[77:97]
    docs = spark.createDataFrame([(1, " ".join(body)), (2, "no word of it")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(body[77:97])), (2, " ".join(body[77:97]))], "item_id long, text string")
    row = find_contamination(docs, bench).filter("doc_id = 1").first()
    assert (row.n_words, row["items"]) == (300_020, ["1", "2"])
    assert [(x.begin, x.end) for x in row.spans] == [(77, 97), (123_456, 123_476)]


def test_nothing_is_shuffled(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = find_contamination(docs, docs.select(F.col("doc_id").alias("item_id"), "text"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
